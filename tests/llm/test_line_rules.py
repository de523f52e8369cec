from collections import Counter, defaultdict

import duckdb
import pytest

from strata.llm import line_rules
from strata.llm.oracle import ORACLE
from strata.llm.queries import REGISTRY


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE['op6_line_frequency']})").fetchall())
    got = sorted(tuple(r[n] for n in names) for r in REGISTRY["op6_line_frequency"](spark, sf).collect())
    assert got == want
    assert any(r[-1] for r in got) and any(r[-2] for r in got)


def test_repeated_words():
    assert line_rules.repeated_words(b"a b c d".split()) == 0
    assert line_rules.repeated_words(b"a b c d e x a b c d e".split()) == 10
    assert line_rules.repeated_words([b"a"] * 6) == 6


def test_depleted_documents_and_odd_rows(spark):
    menu = "Home about contact 24 imprint more\n"
    own = lambda i, n=30: " ".join(chr(97 + i % 26) * (k + 1) for k in range(n))
    rows = [(i, menu.replace("24", str(i)) * 3 + own(i, 12), "h", 1) for i in range(8)]
    rows += [(20 + i, own(i), "h", 2) for i in range(5)] + [(30, own(99) + "\nHome about contact 7 imprint more", "other", 1)]
    rows += [(40, None, None, 0), (41, "", "h", 0), (None, own(25), None, 0), (42, own(50), "h", 0), (42, own(50), "h", 0), (43, "x" * 200_000 + own(3), None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = defaultdict(set)
    for r in line_rules.judge(frame).collect():
        got[r.doc_id].add((r.base_failed, r.kept, r.n_removed_words))
    assert all(got[i] == {(True, False, 18)} for i in range(8))
    assert all(got[i] == {(False, True, 0)} for i in (20, 30, None, 42, 43))
    assert got[40] == got[41] == {(True, False, 0)}
    assert line_rules.judge(frame).count() == len(rows)
    assert line_rules.judge(frame.limit(0)).count() == 0
    texts = Counter((r.doc_id, r.text) for r in line_rules.cleaned(frame, few=7).collect())
    assert texts[30, rows[13][1]] == 1 and texts[42, own(50)] == 2
