"""python -m eventweir.plans.cli MODE ... or --config FILE: the pipelines from a shell. A configuration holds mode and options by their names;
options of the command line go before it."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import qa, quality, simulate
from ..sources import tables as S
from . import config as C
from . import pipelines as P

MODES = [
    "audit-semantics", "build-dataset", "generic", "calibrated", "calibrate", "calibrate-dataset", "calibrate-hdfs", "evaluate", "evaluate-calibration-dataset", "evaluate-llm-semantics", "export-training",
]
ALIASES = {"generate-generic": "generic", "calibrate-events": "calibrate", "generate-calibrated": "calibrated", "evaluate-generation": "evaluate"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("mode", nargs="?", choices=[*MODES, *ALIASES])
    p.add_argument("--config", help="JSON or YAML with the mode and options")
    p.add_argument("--input", help="events: a file or folder that --adapter reads; streams or scenarios as JSON lines for the modes that read these")
    p.add_argument("--rejected", help="rejected streams as JSON lines, for evaluate-llm-semantics")
    p.add_argument("--adapter", choices=sorted(S.ADAPTERS))
    p.add_argument("--output")
    p.add_argument("--domain")
    p.add_argument("--streams", type=int)
    p.add_argument("--seed", type=int)
    p.add_argument("--min-samples", type=int)
    p.add_argument("--max-streams", type=int)
    p.add_argument("--min-events", type=int)
    p.add_argument("--max-events", type=int)
    p.add_argument("--progress")
    return p


DEFAULTS = {"adapter": "standard_csv", "streams": 100, "seed": 42, "min_samples": 20, "min_events": 5, "max_events": 80}


def settings(spark, argv: list[str]) -> dict:
    """Defaults, then the configuration, then the command line."""
    said = vars(parser().parse_args(argv))
    given = {k.replace("-", "_"): v for k, v in C.load(spark, said["config"]).items()} if said["config"] else {}
    out = C.merged(C.merged(DEFAULTS, given), said)
    if not out.get("mode"):
        raise SystemExit("a mode is needed, on the command line or in the configuration")
    out["mode"] = ALIASES.get(out["mode"], out["mode"])
    if out["mode"] not in MODES:
        raise SystemExit(f"unknown mode {out['mode']!r}; there are {', '.join(MODES)}")
    if not out.get("output"):
        raise SystemExit("--output is needed")
    if not out.get("input") and out["mode"] not in ("generic", "build-dataset"):
        raise SystemExit("--input is needed")
    return out


def events_of(spark, a: dict):
    options = {"max_streams": C.optional_int(a["max_streams"])} if a.get("max_streams") and a["adapter"] != "standard_csv" else {}
    rows = S.get_adapter(a["adapter"])(spark, a["input"], **options)
    return P.to_canonical(rows.withColumn("timestamp", rows["timestamp"].cast("double")))


def write_tables(tables: dict, path: str) -> None:
    for name, t in tables.items():
        P.write_jsonl(t, f"{path}/{name}")


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.builder.appName("eventweir").getOrCreate()
    a = settings(spark, sys.argv[1:] if argv is None else argv)
    mode, out = a["mode"], a["output"]
    made = P.DatasetConfig(n_streams=int(a["streams"]), seed=int(a["seed"]), min_events=int(a["min_events"]), max_events=int(a["max_events"]), domains=tuple(C.as_list(a.get("domain"))) if mode in ("generic", "build-dataset") else ())
    if mode == "calibrate-hdfs":
        a["adapter"] = "hdfs_event_traces"
    if mode in ("generic", "build-dataset"):
        print(json.dumps(P.write_dataset(P.build_dataset(spark, made, progress=a.get("progress")), out)))
    elif mode in ("calibrate", "calibrate-dataset", "calibrate-hdfs"):
        events = events_of(spark, a)
        if mode == "calibrate-dataset":  # the standard events are kept beside the prior
            S.write_standard_csv(events.select((F.col("us") / 1e6).alias("timestamp"), "stream_id", "event_type"), f"{out}/standard")
        write_tables(P.calibrate(events, int(a["min_samples"])), out)
        C.write_json(spark, f"{out}/calibration.json", {"domain": C.domain_of(a, a["input"]), "min_samples": int(a["min_samples"]), "command": C.entry_command(argv)})
    elif mode == "calibrated":
        events = events_of(spark, a)
        prior = simulate.load_prior(events, int(a["min_samples"]))
        made = replace(made, min_events=C.min_events_for(made.min_events, [n for n, _ in prior["lengths"]]))
        print(json.dumps(P.write_dataset(P.build_dataset(spark, made, prior, progress=a.get("progress")), out, {"events": events})))
    elif mode in ("evaluate", "evaluate-calibration-dataset"):
        events = events_of(spark, a)
        prior = simulate.load_prior(events, int(a["min_samples"]))
        low = replace(made, min_events=C.min_events_for(made.min_events, [n for n, _ in prior["lengths"]]))
        own = lambda c, p: P.build_dataset(spark, c, p).events.where("not is_background").select("stream_id", "us", "event_type")
        report, effect = P.evaluate(events, own(made, None), own(replace(low, seed=made.seed + 1_000_003), prior))
        report.coalesce(1).write.mode("overwrite").csv(f"{out}/report", header=True)
        effect.coalesce(1).write.mode("overwrite").csv(f"{out}/effect", header=True)
        if mode == "evaluate-calibration-dataset":
            write_tables(P.calibrate(events, int(a["min_samples"])), f"{out}/prior")
    elif mode == "audit-semantics":
        scored = quality.score(spark.read.json(a["input"]))
        cols = [c for c in ("domain", "mechanism_type", "topology", "method") if c in scored.columns]
        write_tables({"summary": quality.summary(scored), "groups": quality.summary(scored, [[c] for c in cols]) if cols else scored.limit(0), "issues": quality.exploded_counts(scored, "issues"), "lowest": quality.lowest(scored, 20)}, out)
    elif mode == "evaluate-llm-semantics":
        accepted = spark.read.schema("stream_id string, domain string, semantic_method string, semantic_approved boolean, attempts int, description string").json(a["input"])
        rejected = S.read_streams(spark, a["rejected"], "stream_id string, stage string, errors array<string>") if a.get("rejected") else spark.createDataFrame([], "stream_id string, stage string, errors array<string>")
        stages = rejected.select(F.coalesce("stage", F.lit("unknown")).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        write_tables({"report": quality.client_quality(accepted, rejected), "domains": quality.coverage(accepted, ["domain"]), "stages": stages, "errors": quality.exploded_counts(rejected, "errors"), "previews": quality.previews(accepted, 5)}, out)
    else:  # export-training: a dataset's own events, questions and accepted streams
        read = lambda name: spark.read.json(f"{a['input']}/{name}")
        write_tables({"training": qa.export_instruction(read("qa"), read("events"), read("accepted")), "chat": qa.export_chat(read("qa"), read("events"), streams=read("accepted"))}, out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
