"""Graph, validation, questions, quality, generation and sources."""

import json

import pytest

from eventweir.operators import graph, qa, quality, simulate
from eventweir.operators import validate as V
from eventweir.sources import tables as S

EV = "stream_id string, event_id long, pos long, us long, event_type string, is_background boolean, parent_id long, root_id long, depth int, relation string, delta_us long"


def stream(spark, *rows):
    return spark.createDataFrame([("s", i, i, us, "T", bg, p, r, d, rel, du) for i, us, bg, p, r, d, rel, du in rows], EV)


GOOD = [(0, 0, False, None, 0, 0, None, None), (3, 200000, True, None, None, 0, None, None), (1, 1500000, False, 0, 0, 1, "direct_trigger", 1500000), (2, 3000000, False, 1, 0, 2, "recovery", 1500000)]


def said(df):
    return {r["error"] for r in df.collect()}


def test_a_good_stream_passes(spark):
    e = stream(spark, *GOOD)
    assert not said(V.structural_errors(e)) and not said(V.temporal_errors(e))


@pytest.mark.parametrize(
    "row, error",
    [
        ((2, 3000000, False, 99, 0, 2, "recovery", 1), "missing parent"),
        ((2, 3000000, False, 3, 0, 1, "recovery", 2800000), "uses background event as parent"),
        ((2, 1500000, False, 1, 0, 2, "recovery", 1), "not later than parent"),
        ((2, 3000000, False, 1, 1, 2, "recovery", 1500000), "incorrect root_id"),
        ((2, 3000000, False, 1, 0, 1, "recovery", 1500000), "incorrect cascade depth"),
        ((2, 3000000, False, 1, 0, 2, "because", 1500000), "invalid relation type"),
        ((2, 3000000, True, 1, 0, 2, None, None), "background event has causal ids"),
        ((1, 3000000, False, 0, 0, 1, "recovery", 3000000), "duplicate event_id"),
    ],
)
def test_each_structural_defect_is_named(spark, row, error):
    assert error in said(V.structural_errors(stream(spark, *GOOD[:3], row)))


def test_temporal_defects(spark):
    assert said(V.temporal_errors(stream(spark, *GOOD[:3], (2, 3000000, False, 1, 0, 2, "recovery", 1000000)))) == {"delta_t mismatch"}
    assert said(V.temporal_errors(stream(spark, *GOOD[:3], (2, 3000000, False, 1, 0, 2, "recovery", 0)))) == {"non-positive delta_t"}


def test_paths_and_cycles(spark):
    e = stream(spark, *GOOD)
    got = {r["event_id"]: (r["root_id"], r["depth"], r["path"]) for r in graph.paths(e.where("not is_background")).collect()}
    assert got == {0: (0, 0, [0]), 1: (0, 1, [0, 1]), 2: (0, 2, [0, 1, 2])}
    rows = [("s", i, i - 1 if i else None) for i in range(40)]
    deep = spark.createDataFrame(rows, "stream_id string, event_id long, parent_id long")
    assert graph.paths(deep, 64).where("event_id = 39").first()["depth"] == 39
    ring = spark.createDataFrame([("s", "a", "b"), ("s", "b", "a")], "stream_id string, source string, target string")
    nodes = spark.createDataFrame([("s", "a"), ("s", "b")], "stream_id string, node string")
    assert not graph.dag_check(ring, nodes).first()["is_dag"] and graph.dag_check(ring.limit(1), nodes).first()["is_dag"]


def test_questions(spark):
    e = stream(spark, *GOOD)
    got = {r["qa_type"]: (r["target_event_id"], r["answer"]) for r in qa.all_pairs(e).collect()}
    assert got == {"direct_parent": (2, "1"), "root_cause": (2, "0"), "temporal_order": (None, "[0, 3, 1, 2]"), "time_delay": (1, "1500000"), "causal_path": (2, "[0, 1, 2]")}
    pairs = qa.all_pairs(e)
    assert qa.label_check(pairs, e).count() == 0
    assert said(qa.label_check(pairs.replace("1", "7", ["answer"]), e)) == {"wrong answer"}
    assert said(qa.label_check(pairs.limit(0), e)) == {"no qa pairs"}
    text = qa.export_instruction(pairs, e).first()["input"]
    assert not any(w in text for w in ("parent_id", "root_id", "regime", "is_background"))


def test_quality(spark):
    rows = [
        ("good", "A long enough description of what happened", ["database pool saturation", "api timeout alert storm"], ["saturation of the pool delays every request"]),
        ("bad", "Scenario.", ["event", "event", "update"], ["related", "causes"]),
    ]
    s = {r["stream_id"]: r for r in quality.score(spark.createDataFrame(rows, "stream_id string, description string, phrases array<string>, relations array<string>")).collect()}
    assert s["good"]["approved"] and s["good"]["score"] == 1.0
    assert s["bad"]["score"] == 0.0 and len(s["bad"]["issues"]) == 5 and s["bad"]["duplicate"] == 1


def test_generation_is_deterministic_whatever_the_partitions(spark):
    samples = simulate.stratified(spark, 24)
    a = sorted(map(tuple, simulate.simulate(samples.repartition(1)).collect()), key=str)
    b = sorted(map(tuple, simulate.simulate(samples.repartition(7)).collect()), key=str)
    assert a == b and a != sorted(map(tuple, simulate.simulate(samples, seed=43).collect()), key=str)
    assert {r["topology"] for r in samples.collect()} == {"chain", "tree"}


def test_generated_streams_validate(spark):
    from pyspark.sql import functions as F

    g = simulate.simulate(simulate.stratified(spark, 24))
    us = lambda c: F.round(F.col(c) * 1e6).cast("bigint")
    e = g.select("stream_id", "event_id", us("timestamp").alias("us"), "is_background", "parent_id", "root_id", F.col("cascade_depth").alias("depth"), F.col("relation_to_parent").alias("relation"), us("delta_t_from_parent").alias("delta_us"))
    assert said(V.structural_errors(e)) <= set() and said(V.temporal_errors(e)) <= set()


def test_calibrated_chain(spark):
    rows = [(int(t * 1e6), f"s{i}", k) for i in range(25) for t, k in ((0, "E5"), (0.5, "E11"), (1.75, "E21"))]
    prior = simulate.load_prior(spark.createDataFrame(rows, "us long, stream_id string, event_type string"), alpha=0.0)
    out = simulate.simulate(simulate.stratified(spark, 3), prior=prior).where("not is_background").orderBy("stream_id", "event_id").collect()
    assert [r["abstract_type"] for r in out[:3]] == ["E5", "E11", "E21"] and [r["delta_t_from_parent"] for r in out[1:3]] == [0.5, 1.25] and out[1]["regime"] == "deterministic_backoff"


def test_trees_keep_their_limits(spark):
    t = graph.build_tree(spark.range(20).selectExpr("cast(id as string) stream_id"), __import__("pyspark.sql.functions", fromlist=["lit"]).lit(15), 3, 2)
    assert t.groupBy("stream_id", "parent_node").count().where("parent_node is not null and count > 2").count() == 0
    assert t.where("depth > 3").count() == 0 and t.groupBy("stream_id").count().where("count > 15").count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text('BlockId,Features,TimeInterval\nblk_1,"[E1,E2,E3]","[0,0.5,1.5]"\nblk_2,"[E1,E3]","[0,2.0]"\n')
    got = S.read_trace_csv(spark, str(tmp_path / "t.csv"), max_streams=1).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["stream_id"], r["event_type"]) for r in got] == [(0.0, "blk_1", "E1"), (0.5, "blk_1", "E2"), (2.0, "blk_1", "E3")]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/driver_1.json").write_text(json.dumps([{"time": 2.0, "TPP_attribute": {"event_type": 4}}, {"time": 1.0, "TPP_attribute": {"event_type": 3}}]))
    (tmp_path / "d/driver_2.json").write_text("{not json")
    got = S.read_json_dir(spark, str(tmp_path / "d")).orderBy("timestamp").collect()
    assert [(r["stream_id"], r["event_type"]) for r in got] == [("driver_1", "taxi_event_3"), ("driver_1", "taxi_event_4")]
    line = lambda day, code: "\t".join({4: day, 5: "USA", 15: "CHN", 26: code}.get(i, "") for i in range(58))
    (tmp_path / "g.tsv").write_text("\n".join([line("2026.010", "010"), line("2026.011", "020"), line("2026.012", "030"), "short\tline"]))
    got = S.read_gdelt_tsv(spark, str(tmp_path / "g.tsv")).orderBy("timestamp").collect()
    assert [(r["stream_id"], r["event_type"]) for r in got] == [("USA->CHN", c) for c in ("cameo_010", "cameo_020", "cameo_030")]
    (tmp_path / "e.csv").write_text("ts,case,code\n1, s1 ,A\n2,,B\n3,s1,C\n")
    assert S.read_event_csv(spark, str(tmp_path / "e.csv"), "ts", "case", "code").count() == 2
    with pytest.raises(ValueError):
        S.read_event_csv(spark, str(tmp_path / "e.csv"), "ts", "case", "nope")
    with pytest.raises(ValueError):
        S.get_adapter("nope")
