from strata.plans import queries
from strata.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def test_tasks_of_a_fixed_size_join_all_lines(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_shipdate").collect()
    ordered = dict(spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate").collect())
    pairs = [(ordered[k], shipped) for k, shipped in rows if k in ordered]
    late = sum(o is not None and s is not None and o.date() > s.date() for o, s in pairs)
    monkeypatch.setattr(queries, "JOINED_AT_ONCE", 100, raising=False)
    found = REGISTRY["event_order"](spark, SF)
    assert [(r.population, r.failures) for r in found.collect()] == [(len(pairs), late)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "coalesced" not in plan
    assert "hashpartitioning(l_orderkey#" in plan and f", {-(-len(rows) // 100)}), REPARTITION_BY_NUM" in plan
