"""Readers of odd rows, configuration, plug-ins, the client and the judge, and datasets whose streams are told and checked."""

import io
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweir.operators import fitting, graph, quality, regimes, semantics, simulate, transitions, validate
from eventweir.plans import cli, config, pipelines
from eventweir.sources import tables
from eventweir.streaming import folds


def test_bracket_lists(spark):
    said = ['"[E1, E2]"', "[E1,'',E3]", "[E1,,E3]", "[]", "", None, "E1,'E2'", "[0, x]"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, s string").select("i", tables.parse_list(F.col("s")).alias("l")).orderBy("i").collect()
    assert [r["l"] for r in rows] == [["E1", "E2"], ["E1", "", "E3"], ["E1", "E3"], [], [], [], ["E1", "E2"], ["0", "x"]]


def test_traces_with_blanks_and_malformed_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text('BlockId,Features,TimeInterval\nblk_1,"[E1,E2,E3]","[0,0.5,1.5]"\nblk_2,"[E1,\'\',E3]","[0,1,2]"\nblk_3,x,y,[E7,E8],[5,2.5]\nblk_4,[E1,E2],[0,0.5]\n,"[E1]","[0]"\n')
    got = sorted(map(tuple, tables.read_trace_csv(spark, str(tmp_path / "t.csv")).collect()))
    assert got == sorted([(0.0, "blk_1", "E1"), (0.5, "blk_1", "E2"), (2.0, "blk_1", "E3"), (0.0, "blk_2", "E1"), (3.0, "blk_2", "E3"), (0.0, "blk_3", "E7"), (2.5, "blk_3", "E8")])
    assert tables.read_trace_csv(spark, str(tmp_path / "t.csv"), max_streams=1).count() == 3


def test_actors_without_a_name(spark, tmp_path):
    def line(day, a, b):
        c = ["x"] * 58
        c[4], c[5], c[7], c[15], c[17], c[26] = day, a, "", b, "", "010"
        return "\t".join(c)

    (tmp_path / "g.tsv").write_text("\n".join(line(f"2026.0{i}", "", "") for i in range(3)) + "\nshort\n")
    assert {r["stream_id"] for r in tables.read_gdelt_tsv(spark, str(tmp_path / "g.tsv")).collect()} == {"UNK1->UNK2"}


def test_timestamps_as_text(spark, tmp_path):
    rows = spark.createDataFrame([(0.0, "s", "A"), (1e-5, "s", "B"), (1234567.125, "s", "C"), (0.1 + 0.2, "s", "D")], "timestamp double, stream_id string, event_type string")
    tables.write_standard_csv(rows.coalesce(1), f"file://{tmp_path}/out")
    assert [r["timestamp"] for r in tables.read_standard_csv(spark, f"{tmp_path}/out")[0].orderBy("event_type").collect()] == ["0", "1e-05", "1234567.125", "0.3"]


def test_plug_ins(spark):
    with pytest.raises(ValueError):
        regimes.get_regime("none")
    with pytest.raises(ValueError):
        regimes.register(regimes.get_regime("gamma"))
    with pytest.raises(ValueError):
        tables.register_adapter("gdelt", None)
    assert regimes.get_regime("gamma").describe() == {"name": "gamma", "parameters": ["shape", "scale"]}
    params = {"exponential": {"lambda": 2.0}, "gamma": {"shape": 2.5, "scale": 0.4}, "lognormal": {"mu": 0.0, "sigma": 0.5}, "weibull": {"shape": 1.0, "scale": 2.0}, "deterministic_backoff": {"value": 3.0}}
    means = {"exponential": 0.5, "gamma": 1.0, "lognormal": math.exp(0.125), "weibull": 2.0, "deterministic_backoff": 3.0}
    for name, p in params.items():
        r = regimes.get_regime(name)
        m = F.map_from_entries(F.array(*[F.struct(F.lit(k), F.lit(v)) for k, v in p.items()]))
        got = spark.range(20_000).select(r.draw(m, F.lit(name), "id").alias("x"), r.valid(m).alias("ok"), r.valid(F.create_map(F.lit("none"), F.lit(1.0))).alias("no"))
        row = got.agg(F.avg("x"), F.min("x"), F.bool_and("ok"), F.bool_or("no")).first()
        assert row[0] == pytest.approx(means[name], rel=0.03) and row[1] > 0 and row[2] and not row[3]
    low = spark.range(20_000).select(regimes.R.gamma(F.lit(0.5), F.lit(2.0), "id").alias("x")).agg(F.avg("x")).first()[0]
    assert low == pytest.approx(1.0, rel=0.05)


def test_configuration(spark, tmp_path):
    base = {"stream": {"min_events": 5, "max_events": 80}, "a": 1}
    assert config.merged(base, {"stream": {"max_events": 60, "min_events": None}, "b": [1]}) == {"stream": {"min_events": 5, "max_events": 60}, "a": 1, "b": [1]}
    assert base["stream"]["max_events"] == 80
    path = f"file://{tmp_path}/c.json"
    config.write_json(spark, path, base)
    assert config.load(spark, path) == base and config.exists(spark, path) and not config.exists(spark, path + ".no")
    yaml = f"file://{tmp_path}/c.yaml"
    config.write_yaml(spark, yaml, base)
    pytest.importorskip("yaml")
    assert config.load(spark, yaml) == base
    config.write_text(spark, path, "[1]")
    with pytest.raises(ValueError):
        config.load(spark, path)
    assert config.as_list("a, b,") == ["a", "b"] and config.as_list(None) == [] and config.as_list(3) == ["3"] and config.optional_int("") is None and config.optional_int("7") == 7
    assert config.min_events_for(5, [3, 9]) == 3 and config.min_events_for(2, []) == 2
    assert config.domain_of({}, "/x/HDFS.csv") == "HDFS" and config.domain_of({"domain": "IT"}, "x") == "IT"
    assert config.resolved("a/b", "file:///r/") == "file:///r/a/b" and config.resolved("/a", "r") == "/a"
    lines = f"file://{tmp_path}/l.jsonl"
    config.write_text(spark, lines, "{}\n\n{}\n")
    assert config.count_lines(spark, lines) == 2 and config.count_lines(spark, lines + ".no") == 0
    assert config.move_or_touch(spark, lines, lines + ".moved") and config.count_lines(spark, lines + ".moved") == 2
    assert not config.move_or_touch(spark, lines, lines + ".empty") and config.count_lines(spark, lines + ".empty") == 0
    assert config.entry_command(["generic", "--output", "a b"]) == "python -m eventweir.plans.cli generic --output 'a b'"
    config.write_progress(spark, path, "running", 10, 3, 1)
    assert config.load(spark, path)["completed"] == 4


def test_http_client_and_judge(spark):
    class Answer(io.StringIO):
        def __exit__(self, *a):
            pass

    asked = []

    def send(request, timeout):
        asked.append((json.loads(request.data), request.get_header("Authorization"), timeout))
        return Answer(json.dumps({"output": [{"content": [{"type": "output_text", "text": ' {"approved": true, "score": 0.9, "issues": []} '}]}]}))

    client = semantics.HttpClient("http://localhost/x", "m", "k", send=send)
    assert semantics.judged(client, "{}") == {"approved": True, "score": 0.9, "issues": [], "suggestions": []}
    assert asked[0][1] == "Bearer k" and asked[0][0]["model"] == "m" and asked[0][2] == 60.0
    with pytest.raises(ValueError):
        semantics.HttpClient("", "", "")

    class Fake:
        def complete(self, prompt):
            if "bad" in prompt:
                raise RuntimeError("down")
            return '{"approved": true, "score": 0.4}'

    rows = spark.createDataFrame([("a", "{}"), ("b", "bad"), ("c", None)], "stream_id string, scenario string")
    got = {r["stream_id"]: r for r in semantics.judge_scenarios(rows, Fake).collect()}
    assert got["a"]["issues"] == ["score below threshold"] and not got["a"]["approved"] and got["b"]["issues"] == ["judge failed: down"] and len(got) == 2
    empty = quality.judge_summary(rows.select(F.lit(True).alias("approved"), F.lit(1.0).alias("score")).limit(0)).first()
    assert tuple(empty) == (0, 0, 0.0, 0.0, 0.0, 0.0)


def test_missing_phrases_are_an_error(spark):
    phrases = spark.createDataFrame([("IT", ["a"], ["b"])], "domain string, event_phrases array<string>, background_phrases array<string>")
    streams = spark.createDataFrame([("s", "IT"), ("t", "Nowhere")], "stream_id string, domain string")
    with pytest.raises(ValueError):
        semantics.domain_phrases(streams, phrases, "generic")
    assert semantics.domain_phrases(streams.limit(1), phrases, "generic").count() == 1


def test_every_event_of_deep_streams_has_its_truth(spark):
    e = pipelines.long_form(simulate.simulate(simulate.stratified(spark, 60))).cache()
    causal = e.where("not is_background").count()
    assert graph.ground_truth(e).count() == causal and graph.parent_cycles(e).count() == 0
    assert pipelines.qa.causal_path(e).count() == 60 and pipelines.qa.all_pairs(e).groupBy("qa_type").count().where("count = 60").count() == 5


def test_trees_follow_a_prior():
    prior = {"first": {"A": [("B", 1.0)], "B": [("A", 1.0)]}, "second": {}, "fits": {}, "starts": [("A", 1.0)], "lengths": [(5, 1.0)]}
    rows = [r for r in simulate.one_stream("s", "tree", "direct_trigger", "exponential", 1, 0, "low", prior) if not r[9]]
    kind = {r[1]: r[3] for r in rows}
    assert len(rows) >= 6 and {kind[r[4]] + r[3] for r in rows if r[4] is not None} <= {"AB", "BA"}
    assert len({r[4] for r in rows}) < len(rows) - 1  # some node has two children
    assert [r[3] for r in simulate.one_stream("s", "chain", "direct_trigger", "exponential", 1, 0, "low", prior) if not r[9]] == ["A", "B", "A", "B", "A"]


def test_prior_is_bounded(spark):
    e = spark.createDataFrame([("s", i, f"T{i % 9}") for i in range(50)], "stream_id string, us long, event_type string")
    with pytest.raises(ValueError):
        simulate.load_prior(e, max_rows=5)


def test_told_streams_pass_their_rules(spark, tmp_path):
    phrases = spark.createDataFrame([("generic", ["queue grows behind gate", "pump slows under load", "valve opens by hand"], ["routine check of panel"])], "domain string, event_phrases array<string>, background_phrases array<string>")
    progress = f"file://{tmp_path}/progress.json"
    d = pipelines.build_dataset(spark, pipelines.DatasetConfig(n_streams=6, attempts=2), phrases=phrases, progress=progress)
    assert d.events.where("semantic_type is null").count() == 0 and d.accepted.count() + d.rejected.count() == 6 and d.accepted.count() > 0
    assert config.load(spark, progress)["status"] == "finished"
    gated = pipelines.build_dataset(spark, pipelines.DatasetConfig(n_streams=3, attempts=1, min_quality=1.1), phrases=phrases)
    assert gated.accepted.count() == 0 and {r["stage"] for r in gated.rejected.collect()} <= {"semantic_quality_gate", "temporal", "structural"}
    e = pipelines.long_form(simulate.simulate(simulate.stratified(spark, 2)))
    bent = e.withColumn("parent_id", F.when(F.col("depth") == 0, F.lit(1)).otherwise(F.col("parent_id"))).where("not is_background")
    assert "parent cycle" in {r["error"] for r in pipelines.find_errors(bent, pipelines.DatasetConfig()).collect()}


def test_pvalues_and_records():
    assert fitting.ks_pvalue(0.274, 10) == pytest.approx(1 - 0.6284796154565, abs=1e-9)
    assert fitting.ks_pvalue(0.0, 5) == 1.0 and fitting.ks_pvalue(1.0, 5) == 0.0
    assert fitting.ks_pvalue(0.05, 400) == pytest.approx(fitting.ks_pvalue(0.05, 401), abs=0.003)
    r = np.random.default_rng(1)
    x = np.sort(np.round(r.exponential(2.0, 500), 6))
    got = fitting.best_fit(x, np.ones(500), 20)
    assert got["status"] == "fitted" and 0 < got["ks_pvalue"] <= 1 and got["bic"] > got["aic"]


def test_order_statistics_are_exact(spark):
    r = np.random.default_rng(2)
    for x in (r.normal(0, 1000, 3000), np.array([0.0, -1.0, 999.6, 1000.2, 1000.0, 0.00999, 0.01, 1e-30, -1e30]), np.full(50, 7.5)):
        df = spark.createDataFrame([(float(v),) for v in x], "v double")
        every = sorted(map(float, x))
        ranks = sorted({0, len(x) - 1, len(x) // 2, len(x) // 3})
        assert quality.ranked(df, "v", lambda n: {"all": ranks})["all"] == [every[k] for k in ranks]
    assert quality.ranked(df.limit(0), "v", lambda n: {"a": [0]}) == {}


def test_history_across_micro_batches(spark, tmp_path):
    rows = [(i % 3, i * 400_000, "abc"[i * 7 % 3]) for i in range(60)]
    schema = "stream_id long, us long, event_type string"
    for k in range(3):
        spark.createDataFrame(rows[20 * k : 20 * k + 20], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = folds.run_to_files(folds.history(s), f"file://{tmp_path}/run")
    want = transitions.history_state(spark.createDataFrame(rows, schema))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_stored_order_and_finite_times(spark):
    e = spark.createDataFrame([("s", 0, 5), ("s", 1, 3), ("s", 2, 9), ("t", 0, 1)], "stream_id string, pos long, us long")
    got = {r["stream_id"]: (r["min_gap_us"], r["is_sorted"]) for r in validate.stored_gaps(e).collect()}
    assert got == {"s": (-2, False), "t": (None, True)}
    x = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double").select(validate.finite(F.col("x")).alias("ok"))
    assert [r["ok"] for r in x.collect()] == [True, False, False, False]


def test_shell(spark, tmp_path):
    (tmp_path / "e.csv").write_text("timestamp,stream_id,event_type\n" + "".join(f"{t},s{i},{k}\n" for i in range(25) for t, k in ((0, "A"), (1 + i / 50, "B"), (3 + i / 9, "C"))))
    (tmp_path / "c.json").write_text(json.dumps({"mode": "calibrate-dataset", "input": str(tmp_path / "e.csv"), "output": f"file://{tmp_path}/prior", "min-samples": 5}))
    assert cli.main(["--config", f"file://{tmp_path}/c.json"], spark) == 0
    assert spark.read.json(f"{tmp_path}/prior/trans1").count() == 2 and config.load(spark, f"file://{tmp_path}/prior/calibration.json")["domain"] == "e"
    assert cli.main(["build-dataset", "--streams", "3", "--output", f"file://{tmp_path}/set"], spark) == 0
    assert cli.main(["export-training", "--input", f"file://{tmp_path}/set", "--output", f"file://{tmp_path}/train"], spark) == 0
    assert spark.read.json(f"{tmp_path}/train/training").where("input like '%domain=%' and metadata.domain is not null").count() > 0
    (tmp_path / "s.jsonl").write_text('{"stream_id": "a", "domain": "IT", "description": "x", "phrases": ["one two three"], "relations": []}\n')
    assert cli.main(["audit-semantics", "--input", str(tmp_path / "s.jsonl"), "--output", f"file://{tmp_path}/audit"], spark) == 0
    assert cli.main(["evaluate-llm-semantics", "--input", str(tmp_path / "s.jsonl"), "--output", f"file://{tmp_path}/llm"], spark) == 0
    assert spark.read.json(f"{tmp_path}/llm/report").first()["accepted_count"] == 1
    assert set(cli.MODES) >= {"calibrate-hdfs", "evaluate", "calibrated", "evaluate-calibration-dataset"}
    with pytest.raises(SystemExit):
        cli.settings(spark, ["evaluate", "--output", "x"])
