"""Scenarios, clients, datasets, the shell and the streaming fold."""

import json

import pytest
from pyspark.sql import functions as F

from eventweir.operators import semantics
from eventweir.plans import cli, pipelines
from eventweir.streaming import folds


def test_phrases_go_round_and_fall_back(spark):
    phrases = spark.createDataFrame([("IT", ["a b", "c d"], ["bg"])], "domain string, event_phrases array<string>, background_phrases array<string>")
    streams = semantics.domain_phrases(spark.createDataFrame([("s", "Nowhere")], "stream_id string, domain string"), phrases, "IT")
    ev = spark.createDataFrame([("s", 0, "E0", False), ("s", 1, None, True), ("s", 2, "E1", False), ("s", 3, "E2", False), ("s", 4, None, True)], "stream_id string, pos int, node_id string, is_background boolean")
    got = [r["semantic_type"] for r in semantics.instantiate(ev, streams).orderBy("pos").collect()]
    assert got == ["a b", "bg", "c d", "a b #2", "bg #2"]


def fake():
    class Fake:
        def complete(self, prompt):
            if "rejected" not in prompt:
                return "no object here"
            return '```json\n{"scenario_description": "x", "event_mapping": {"E0": "a", "E1": "b"}}\n```'

    return Fake


def test_client_retries_and_cache(spark):
    Fake = fake()
    prompts = spark.createDataFrame([("s1", "tell", ["E0", "E1"]), ("s2", "say", ["E0", "E1"])], "stream_id string, prompt string, nodes array<string>")
    none = spark.createDataFrame([], semantics.ANSWER)
    answers, new = semantics.ask_cached(prompts, none, Fake)
    rows = answers.collect()
    assert [r["attempts"] for r in rows] == [2, 2] and all(json.loads(r["scenario"])["event_mapping"] == {"E0": "a", "E1": "b"} for r in rows)
    again, new = semantics.ask_cached(prompts, spark.createDataFrame(rows, semantics.ANSWER), Fake)
    assert new.count() == 0 and again.count() == 2
    assert semantics.ask_cached(prompts, none, Fake, retries=0)[0].where("scenario is null").count() == 2


def test_scenario_errors():
    assert semantics.scenario_errors({"scenario_description": " ", "event_mapping": {"E9": "x"}, "a": [{"root_id": 1}]}, ["E0"]) == ["missing mapping for E0", "extra mapping for E9", "empty scenario description", "forbidden field root_id"]
    with pytest.raises(ValueError):
        semantics.extract_json("nothing")


def test_dataset_and_manifest(spark, tmp_path):
    d = pipelines.build_dataset(spark, pipelines.DatasetConfig(n_streams=8), scratch=f"file://{tmp_path}/scratch")
    n = d.events.select("stream_id").distinct().count()
    assert n + d.rejected.count() == 8 and d.qa.select("stream_id").distinct().count() == n
    m = pipelines.write_dataset(d, f"file://{tmp_path}/out")
    assert m["outputs"]["events"].startswith(f"{d.events.count()}-")
    assert spark.read.json(f"file://{tmp_path}/out/training").count() == d.qa.count()


def test_shell_modes(spark, tmp_path):
    assert cli.parser().parse_args(["generate-generic", "--output", "x"]).mode == "generate-generic" and set(cli.ALIASES.values()) <= {"generic", "calibrate", "calibrated", "evaluate"}
    (tmp_path / "e.csv").write_text("timestamp,stream_id,event_type\n" + "".join(f"{t},s{i},{k}\n" for i in range(25) for t, k in ((0, "A"), (1 + i / 50, "B"))))
    rows = __import__("eventweir.sources.tables", fromlist=["x"]).get_adapter("standard_csv")(spark, str(tmp_path / "e.csv"))
    tables = pipelines.calibrate(pipelines.to_canonical(rows.withColumn("timestamp", rows["timestamp"].cast("double"))))
    assert tables["trans1"].first()["n"] == 25 and tables["fits"].first()["sample_count"] == 25


def test_streaming_fold_equals_batch(spark, tmp_path):
    from eventweir.operators.transitions import positive, steps

    rows = [(i % 3, i * 1_000_000 + i % 2, "abc"[i * 7 % 3]) for i in range(60)]
    schema = "stream_id long, us long, event_type string"
    for k in range(3):
        spark.createDataFrame(rows[20 * k : 20 * k + 20], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = folds.run_to_table(folds.transitions(s), "fold", "append", f"{tmp_path}/cp").groupBy("source", "target").count()
    want = positive(steps(spark.createDataFrame(rows, schema))).groupBy(F.col("a").alias("source"), F.col("b").alias("target")).count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
