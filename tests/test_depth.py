"""Chains of any length with default arguments."""

from eventweir.operators import graph, qa


def test_long_chains_and_cycles_with_defaults(spark):
    rows = [(s, i, i - 1 if i else None, False, i * 1000, i, 0) for s, n in (("a", 12), ("b", 100)) for i in range(n)]
    rows += [("c", 0, None, False, 0, 0, 0), ("c", 1, 2, False, 1, 1, 0), ("c", 2, 1, False, 2, 2, 0), ("c", 3, 2, False, 3, 3, 0)]
    e = spark.createDataFrame(rows, "stream_id string, event_id long, parent_id long, is_background boolean, us long, depth int, root_id long")
    truth = {(r["stream_id"], r["event_id"]): r["path"] for r in graph.ground_truth(e).collect()}
    assert len(truth) == 113 and truth["b", 99] == ",".join(map(str, range(100))) and ("c", 3) not in truth
    asked = {r["stream_id"]: r["target_event_id"] for r in qa.causal_path(e).collect()}
    assert asked == {"a": 11, "b": 99}
    nodes = e.selectExpr("stream_id", "event_id AS node")
    edges = e.where("parent_id is not null").selectExpr("stream_id", "parent_id AS source", "event_id AS target")
    assert {r["stream_id"]: r["is_dag"] for r in graph.dag_check(edges, nodes).collect()} == {"a": True, "b": True, "c": False}
