"""Personal data: patterns, and terms that give a protected value away.

Addresses, card and phone numbers found by pattern are the protected entities. A term (a word of letters
and digits) discloses an entity as far as seeing the term tells that the entity is there. Over all
documents, with PMI(e; t) = ln(p(e, t) / (p(e) p(t))) and the entity's information IC(e) = -ln p(e),
the disclosure is PMI / IC: 0 for an independent term, 1 for one that occurs with the entity only. In the
documents that mention the entity a term of ``REMOVE`` or more is removed, one of ``GENERALISE`` or more
is replaced by a general word.

A pair seen in ``SUPPORT`` distinct texts or more is measured as it stands. Below that p(e | t) is discounted by
one text, to (k - 1) / k of what was counted, where k counts texts that are no near copies of each other (they
share no band of a sketch of their three-word runs, directly or by others): the rare words of one document and
its copies are no sign, those of two are a weak one. A value that occurs once is judged by its group, which
its label hides as well: mail domain, first two parts of an IP, first six digits of a card, a phone number
without its last seven digits. A group's statistics are those of all its values. With k = 1 a value backs off to
p(group | t) p(e | group), so its disclosure PMI(group; t) / IC(e) is never above that of its group.

All of it is DataFrame functions. Positions come from splitting a text by a pattern: the lengths of the gaps
and of the matches add up to them. The patterns are possessive and start only where a match can, so no
text makes them back up.

Nulls and odd rows: a null text is empty here and stays null when sanitised. Exact copies and repeated rows count
as documents but not as further support; every row gets its own result. A value alone in its group and in one
text (or its copies) has no second text to tell a sign from chance by; of it only the base spans are replaced. An empty table gives no rows. Columns other than doc_id
and text do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import components, keep, own_column

SUPPORT = 5
GENERALISE = 0.9
REMOVE = 0.97
# The patterns, in order of kind, written so that they match alike without backing up.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried at all.
_HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
_LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "general": "[TERM]", "remove": ""}
_TERM = r"[\p{L}\p{N}]++"
#: Bands of a sketch and smallest hashes in each: copies with 3/4 of their runs in common meet with 96 %.
_BANDS, _ROWS = 6, 3
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """All matches as (kind, start, end, value), in code points."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), part["hit"].alias("value"))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(part["hit"].isNull(), done["spans"]).otherwise(F.concat(done["spans"], F.array(span))).alias("spans"),
        )

    none = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(parts, none, add, lambda done: done["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    number = F.reverse(_digits(value))

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(number, at, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(at % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(part))
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _valid(text: Column, pattern: str, kind: str) -> Column:
    return F.filter(_matches(text, pattern, kind), lambda s: _holds(kind, s["value"]))


def base_spans(text: Column) -> Column:
    """The pattern matches of all kinds that hold, by kind and then start."""
    kinds = []
    for kind, pattern in PATTERNS.items():
        kinds.append(F.when(text.rlike(_HINTS[kind]), _valid(text, pattern, kind)).otherwise(F.array().cast(_SPANS)))
    return F.concat(*kinds)


def _entity(span: Column) -> Column:
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _group(entity: Column) -> Column:
    """The group of an entity: what its value shares with others of its kind."""
    kind, value = F.substring_index(entity, ":", 1), F.regexp_replace(entity, "^[a-z]+:", "")
    part = (
        F.when(kind == "email", F.substring_index(value, "@", -1))
        .when(kind == "ip", F.substring_index(value, ".", 2))
        .when(kind == "card", F.substring(value, 1, 6))
        .otherwise(F.regexp_replace(value, "[0-9]{7}$", ""))
    )
    return F.concat(kind, F.lit("/"), part)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def _terms(text: Column) -> Column:
    return F.array_distinct(_words(text))


def _sketch(text: Column) -> Column:
    """Hashes that near copies have in common: smallest hashes of three-word runs, in bands."""
    runs = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - 2)), lambda i: F.xxhash64(F.slice(w, i, F.lit(3)))
    )
    least = lambda h, at: F.array_min(F.transform(h, lambda x: F.xxhash64(x.bitwiseXOR(F.lit(at)))))
    bands = lambda h: F.array(
        *[F.xxhash64(F.lit(b), *[least(h, b * _ROWS + i) for i in range(_ROWS)]) for b in range(_BANDS)]
    )
    # An array of one binds what is used more than once.
    hashes = F.element_at(F.transform(F.array(_words(text)), runs), 1)
    return F.element_at(F.transform(F.array(hashes), bands), 1)


def _holders(documents: DataFrame) -> DataFrame:
    """(found_id, mark, entities, terms, sketch) of the documents that mention an entity; ``mark`` is a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("found_id"), F.xxhash64("text").alias("mark"), text.alias("text"),
        F.array_distinct(F.transform(base_spans(text), _entity)).alias("entities"),
    )
    return rows.where(F.size("entities") > 0).select(
        "found_id", "mark", "entities", _terms(F.col("text")).alias("terms"), _sketch(F.col("text")).alias("sketch")
    )


def _texts(holders: DataFrame) -> DataFrame:
    """(mark, copies, protected, terms, family) per distinct text: its entities and their groups; near copies are a family."""
    texts = holders.groupBy("mark").agg(
        *[F.first(c).alias(c) for c in ("entities", "terms", "sketch")], F.count(F.lit(1)).alias("copies")
    )
    texts = keep(texts, "pii")
    bands = texts.select("mark", F.explode("sketch").alias("band"))
    least = bands.groupBy("band").agg(F.min("mark").alias("least"))
    families = components(bands.join(least, "band").select(F.col("mark").alias("a"), F.col("least").alias("b")), "pii")
    protected = F.array_distinct(F.concat("entities", F.transform("entities", _group)))
    return texts.join(families, texts["mark"] == families["node"], "left").select(
        "mark", "copies", protected.alias("protected"), "terms", F.coalesce("root", "mark").alias("family")
    )


def _pairs(documents: DataFrame, holders: DataFrame, support: int) -> DataFrame:
    """(entity, term, measured, estimated) of values and groups; ``measured`` is null below ``support`` and for groups."""
    texts = keep(_texts(holders), "pii")
    entity = F.explode("protected").alias("entity")
    # By family first: a family is one text for the estimate.
    counts = lambda rows, *by: (
        rows.groupBy(*by, "family").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("texts"))
        .groupBy(*by).agg(F.sum("copies").alias("n"), F.sum("texts").alias("n_texts"), F.count(F.lit(1)).alias("k"))
    )
    enough = (F.col("k") >= 2) | (F.col("n_texts") >= support)
    entities = counts(texts.select("copies", "family", entity), "entity").where(enough)
    entities = entities.select("entity", F.col("n").alias("n_entity"))
    held = texts.select("copies", "family", "terms", entity).join(entities, "entity")
    pairs = counts(held.select("copies", "family", "entity", "n_entity", F.explode("terms").alias("term")), "entity", "n_entity", "term")
    total = F.lit(float(max(2, documents.count())))
    # Counted before joining, so that a word of every text is one row, not one per text.
    spread = documents.select(F.explode(_terms(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_term")
    )
    pmi, information = F.ln(F.col("n") * total / (F.col("n_entity") * F.col("n_term"))), F.nullif(F.ln(total / F.col("n_entity")), F.lit(0.0))
    is_value = F.substring_index("entity", "/", 1).contains(":")
    measured = F.when(is_value & (F.col("n_texts") >= support), pmi / information)
    estimated = F.when(F.col("k") >= 2, (pmi + F.ln((F.col("k") - 1) / F.col("k"))) / information)
    return pairs.where(enough).join(spread, "term").select(
        "entity", "term", measured.alias("measured"), estimated.alias("estimated")
    )


def disclosures(documents: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(entity, term, disclosure) of the pairs measured as they stand; statistics over all documents."""
    pairs = _pairs(documents, keep(_holders(documents), "pii"), support).where("measured IS NOT NULL")
    return pairs.select("entity", "term", F.col("measured").alias("disclosure"))


def estimates(documents: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(entity, term, disclosure) of all values and groups that are judged: measured, or else estimated."""
    return _estimates(documents, keep(_holders(documents), "pii"), support)


def _estimates(documents: DataFrame, holders: DataFrame, support: int) -> DataFrame:
    return _pairs(documents, holders, support).select("entity", "term", F.coalesce("measured", "estimated").alias("disclosure"))


def _given_away(documents: DataFrame, support: int) -> DataFrame:
    """(found_id, found_mark, found_terms): the terms to treat in each document that has any."""
    holders = keep(_holders(documents), "pii")
    strong = keep(_estimates(documents, holders, support).where(F.col("disclosure") >= GENERALISE), "pii")
    protected = F.array_distinct(F.concat("entities", F.transform("entities", _group)))
    mentions = holders.select("found_id", F.col("mark").alias("found_mark"), F.explode(protected).alias("entity")).distinct()
    per_term = mentions.join(strong, "entity").groupBy("found_id", "found_mark", "term").agg(F.max("disclosure").alias("disclosure"))
    found = per_term.groupBy("found_id", "found_mark").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("found_terms")
    )
    return keep(found, "pii")


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Spans of the terms to treat that do not touch a base span."""
    spans = F.filter(
        _matches(text, _TERM, "remove"),
        lambda s: F.map_contains_key(terms, F.lower(s["value"]))
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    kind = lambda s: F.when(F.element_at(terms, F.lower(s["value"])) >= REMOVE, "remove").otherwise("general")
    spans = F.transform(
        spans, lambda s: F.struct(kind(s).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    )
    return F.when(terms.isNull(), F.array().cast(_SPANS)).otherwise(spans)


def detect(documents: DataFrame, base: str, added: str, support: int = SUPPORT) -> DataFrame:
    """The documents with two more columns: the spans found by pattern and those the statistics add."""
    ident, mark, terms = (own_column(documents, n) for n in ("_id", "_mark", "_terms"))
    found = _given_away(documents, support).toDF(ident, mark, terms)
    same = documents["doc_id"].cast("long").eqNullSafe(found[ident]) & (F.xxhash64(documents["text"]) == found[mark])
    joined = documents.join(found, same, "left").drop(ident, mark)
    text = F.coalesce("text", F.lit(""))
    joined = joined.withColumn(base, base_spans(text))
    return joined.withColumn(added, _term_spans(text, F.col(terms), F.col(base))).drop(terms)


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(documents: DataFrame, support: int = SUPPORT) -> DataFrame:
    """The documents with their own columns; every span of the text is replaced by its label."""
    base, added = own_column(documents, "_base"), own_column(documents, "_added")
    found = detect(documents, base, added, support)
    by_start = F.array_sort(
        F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    labels = F.create_map(*[F.lit(x) for pair in _LABELS.items() for x in pair])

    def add(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        piece = F.concat(
            done["out"], F.substr(F.col("text"), done["at"] + 1, span["start"] - done["at"]), F.element_at(labels, span["kind"])
        )
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(fresh, piece).otherwise(done["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(by_start, start, add, lambda done: F.concat(done["out"], F.substr(F.col("text"), done["at"] + 1)))
    clean = F.when(F.size(F.concat(base, added)) > 0, clean).otherwise(F.col("text"))
    return found.withColumn("text", clean).select(*[F.col(f"`{c}`") for c in documents.columns])
