"""Whole runs: calibrate a prior, build a dataset, evaluate populations; and the files they leave."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import distances, fitting, graph, qa, quality, semantics, simulate, transitions
from ..operators import validate as V
from ..operators.semantics import config_hash
from ..sources import scratch as shared
from . import config


@dataclass(frozen=True)
class DatasetConfig:
    n_streams: int = 100
    seed: int = 42
    density: str = "medium"
    min_events: int = 5
    max_events: int = 80
    ratio: tuple[float, float] = (0.0, 0.75)
    attempts: int = 5
    domains: tuple[str, ...] = ()
    max_children: int = 3
    max_depth: int = 6
    min_quality: float | None = None  # scenarios that score less, or have issues, are turned away; None: no gate


@dataclass(frozen=True)
class Dataset:
    events: DataFrame
    accepted: DataFrame
    rejected: DataFrame
    qa: DataFrame
    truth: DataFrame
    config: DatasetConfig = field(default_factory=DatasetConfig)


def to_canonical(events_table: DataFrame) -> DataFrame:
    """Standard events with a time in seconds as (stream_id, us, event_type)."""
    return events_table.select("stream_id", F.round(F.col("timestamp") * 1e6).cast("bigint").alias("us"), "event_type")


def calibrate(events: DataFrame, min_samples: int = 20) -> dict[str, DataFrame]:
    """The prior as tables; JSON only comes at the sink."""
    return {
        "event_freq": transitions.event_frequencies(events),
        "trans1": transitions.transition_probs(events),
        "trans2": transitions.second_order_probs(events),
        "fits": fitting.calibrate(events, min_samples),
        "levels": transitions.delta_summary_levels(events),
        "delta_profile": transitions.delta_profile(events),
        "seq_len": transitions.sequence_length_hist(events),
    }


def long_form(generated: DataFrame) -> DataFrame:
    """Generated events as the validators and questions read them: times in whole microseconds, positions in time order."""
    us = lambda c: F.round(F.col(c) * 1e6).cast("bigint")
    pos = F.row_number().over(Window.partitionBy("stream_id").orderBy("timestamp", "event_id")) - 1
    return generated.select(
        "stream_id", "event_id", pos.cast("bigint").alias("pos"), us("timestamp").alias("us"), F.col("abstract_type").alias("event_type"), "is_background", "parent_id", "root_id",
        F.col("cascade_depth").alias("depth"), F.col("relation_to_parent").alias("relation"), us("delta_t_from_parent").alias("delta_us"), "regime",
    )


def mechanism_of(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mechanism that generated events stand for: nodes (stream_id, pos, node_id, role) and edges (stream_id, pos, source, target, relation)."""
    name = lambda c: F.concat(F.lit("E"), F.col(c).cast("string"))
    causal = e.where("not is_background")
    parents = causal.where("parent_id is not null").select("stream_id", F.col("parent_id").alias("event_id"), F.lit(True).alias("is_parent")).distinct()
    role = F.when(F.col("parent_id").isNull(), "root").when(F.col("is_parent"), "intermediate").otherwise("target")
    nodes = causal.join(parents, ["stream_id", "event_id"], "left").select("stream_id", F.col("event_id").alias("pos"), name("event_id").alias("node_id"), role.alias("role"))
    at = (F.row_number().over(Window.partitionBy("stream_id").orderBy("event_id")) - 1).cast("bigint")
    edges = causal.where("parent_id is not null").select("stream_id", at.alias("pos"), name("parent_id").alias("source"), name("event_id").alias("target"), "relation")
    return nodes, edges


def tell(e: DataFrame, streams: DataFrame, phrases: DataFrame, fallback: str) -> tuple[DataFrame, DataFrame]:
    """(events with semantic_type, scenarios (stream_id, scenario, description, status, phrases, relations)) by rule; phrases: a row for each domain."""
    nodes, edges = mechanism_of(e)
    named = e.withColumn("node_id", F.when(~F.col("is_background"), F.concat(F.lit("E"), F.col("event_id").cast("string"))))
    told = semantics.instantiate(named, semantics.domain_phrases(streams, phrases, fallback))
    own = told.where("not is_background").groupBy("stream_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "node_id", F.col("semantic_type").alias("phrase")))).alias("m"))
    mapping = told.where("not is_background").select("stream_id", "node_id", F.col("semantic_type").alias("phrase"))
    both = edges.join(mapping.select("stream_id", F.col("node_id").alias("source"), F.col("phrase").alias("a")), ["stream_id", "source"]).join(mapping.select("stream_id", F.col("node_id").alias("target"), F.col("phrase").alias("b")), ["stream_id", "target"])
    said = both.withColumn("explanation", semantics.relation_explanation(F.col("a"), F.col("relation"), F.col("b")))
    said = said.groupBy("stream_id").agg(F.array_sort(F.collect_list(F.struct("pos", "source", "target", "relation", "explanation"))).alias("r"))
    s = own.join(said, "stream_id", "left").join(streams, "stream_id")
    listed = F.transform("m", lambda x: x["phrase"])
    s = s.withColumn("description", semantics.scenario_description(F.col("domain"), F.col("topology"), F.col("mechanism_type"), listed))
    doc = F.to_json(F.struct(F.col("description").alias("scenario_description"), F.map_from_entries(F.transform("m", lambda x: F.struct(x["node_id"], x["phrase"]))).alias("event_mapping"), F.col("r").alias("relation_explanations")))
    relations = F.transform(F.coalesce("r", F.array().cast("array<struct<pos:bigint,source:string,target:string,relation:string,explanation:string>>")), lambda x: x["explanation"])
    return told, s.select("stream_id", doc.alias("scenario"), "description", F.lit("instantiated").alias("status"), listed.alias("phrases"), relations.alias("relations"), "m", "r")


def find_errors(e: DataFrame, c: DatasetConfig, streams: DataFrame | None = None, scenarios: DataFrame | None = None) -> DataFrame:
    """(stream_id, stage, error) of every validator. streams tells which are trees; scenarios (as ``tell`` gives them) adds the semantic rules and,
    if it is set, the quality gate. The questions' answers are held against the events."""
    at = lambda df, stage: df.select("stream_id", F.lit(stage).alias("stage"), "error")
    nodes, edges = mechanism_of(e)
    named = e.withColumn("node_id", F.when(~F.col("is_background"), F.concat(F.lit("E"), F.col("event_id").cast("string"))))
    found = [
        at(V.structural_errors(e), "structural"),
        at(graph.parent_cycles(e).withColumn("error", F.lit("parent cycle")), "structural"),
        at(V.mechanism_errors(nodes, edges, named), "structural"),
        at(V.temporal_errors(e), "temporal"),
        at(V.stream_errors(V.temporal_metrics(e), V.stored_gaps(e), c.min_events, c.max_events, c.ratio), "temporal"),
    ]
    if streams is not None:
        found.append(at(V.tree_errors(edges, e, streams.where("topology = 'tree'"), c.max_children, c.max_depth), "structural"))
    if scenarios is not None:
        mapping = scenarios.select("stream_id", F.explode("m").alias("x")).select("stream_id", "x.node_id", "x.phrase")
        said = scenarios.select("stream_id", F.explode("r").alias("x")).select("stream_id", "x.*")
        found.append(at(semantics.semantic_errors(scenarios, nodes, mapping, named, edges, said), "semantic"))
        if c.min_quality is not None:
            gated = quality.gate(quality.score(scenarios), c.min_quality).where("stage is not null")
            found.append(gated.select("stream_id", "stage", F.explode(F.when(F.size("issues") > 0, F.col("issues")).otherwise(F.array(F.lit("semantic quality below threshold")))).alias("error")))
    found.append(at(qa.label_check(qa.all_pairs(e), e), "label"))
    return reduce(DataFrame.unionAll, found)


def build_dataset(spark: SparkSession, c: DatasetConfig = DatasetConfig(), prior: dict | None = None, scratch: str | None = None, phrases: DataFrame | None = None, fallback: str = "generic", progress: str | None = None) -> Dataset:
    """Generates, validates and labels streams. A stream that fails is tried again with the next attempt, all failures of a round together;
    every round is written to scratch, so later ones don't compute it again. With phrases (domain, event_phrases, background_phrases) events
    are told by rule, and scenarios are checked too. progress names a file that says how far it has come."""
    left = simulate.stratified(spark, c.n_streams)
    if c.domains:
        left = simulate.select_known(left, "domain", list(c.domains), simulate.DOMAINS)
    scratch = scratch or shared.path(spark, "dataset")
    good, bad = None, None
    for attempt in range(c.attempts):
        e, told = _kept(long_form(simulate.simulate(left, c.seed, attempt, c.density, prior)), f"{scratch}/events-{attempt}"), None
        if phrases is not None:
            e, told = tell(e, left, phrases, fallback)
            e, told = _kept(e.drop("node_id"), f"{scratch}/told-{attempt}"), _kept(told, f"{scratch}/scenarios-{attempt}")
        wrong = _kept(find_errors(e, c, left, told), f"{scratch}/errors-{attempt}")
        fine = e.join(wrong.select("stream_id").distinct(), "stream_id", "left_anti")
        good = fine if good is None else good.unionByName(fine)
        bad = wrong.withColumn("attempt", F.lit(attempt))
        left = left.join(wrong.select("stream_id").distinct(), "stream_id", "left_semi")
        failed = left.count()
        config.write_progress(spark, progress, "running" if failed and attempt + 1 < c.attempts else "finished", c.n_streams, c.n_streams - failed, failed if attempt + 1 == c.attempts else 0)
        if not failed:
            break
    stage = V.reject_stage(bad, ["structural", "temporal", "semantic", "semantic_quality_gate", "label"])
    rejected = bad.groupBy("stream_id").agg(F.array_sort(F.collect_set("error")).alias("errors")).join(stage, "stream_id").select("stream_id", "stage", F.lit(False).alias("approved"), "errors")
    return Dataset(good, simulate.stratified(spark, c.n_streams).join(good.select("stream_id").distinct(), "stream_id", "left_semi"), rejected, qa.all_pairs(good), graph.ground_truth(good), c)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def content_hash(df: DataFrame) -> str:
    """A hash of a table's rows that doesn't depend on their order."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("s")).first()
    return f"{r['n']}-{r['s'] or 0}"


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_dataset(d: Dataset, path: str, inputs: dict[str, DataFrame] | None = None) -> dict:
    """accepted, rejected, events, qa and training files with a manifest: the configuration and its hash, hashes of the inputs' and the outputs' rows,
    the command. The manifest's own hash is taken before it is put in."""
    tables = {"accepted": d.accepted, "rejected": d.rejected, "events": d.events, "qa": d.qa, "training": qa.export_instruction(d.qa, d.events, d.accepted), "chat": qa.export_chat(d.qa, d.events, streams=d.accepted), "ground_truth": d.truth}
    for name, t in tables.items():
        write_jsonl(t, f"{path}/{name}")
    quality.coverage(d.accepted, ["domain", "topology", "mechanism_type", "primary_regime"]).coalesce(1).write.mode("overwrite").csv(f"{path}/coverage", header=True)
    spark = d.events.sparkSession
    made = {n: content_hash(spark.read.schema(t.schema).json(f"{path}/{n}")) for n, t in tables.items()}
    given = {n: content_hash(t) for n, t in (inputs or {}).items()}
    manifest = {"config": asdict(d.config), "config_sha256": config_hash(asdict(d.config)), "inputs": given, "outputs": made, "command": config.entry_command(), "created_at": datetime.now(timezone.utc).isoformat()}
    manifest["manifest_sha256"] = config_hash(manifest)
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def evaluate(real: DataFrame, generic: DataFrame, calibrated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, effect of the calibration) of three tables of canonical events."""
    tag = lambda df, p: df.select(F.col("stream_id").cast("string"), "us", "event_type", F.lit(p).alias("population"))
    report = distances.comparison_report(tag(real, "real").unionAll(tag(generic, "generic")).unionAll(tag(calibrated, "calibrated")))
    return report, distances.calibration_effect(report)
