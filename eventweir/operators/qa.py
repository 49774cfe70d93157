"""Questions and answers of generated streams, their check, and training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import paths


def deepest(events: DataFrame) -> DataFrame:
    """Per stream the causal event with the greatest (depth, us, event_id)."""
    return events.where("not is_background").groupBy("stream_id").agg(F.max(F.struct("depth", "us", "event_id", "parent_id", "root_id")).alias("e")).select("stream_id", "e.event_id", "e.parent_id", "e.root_id", "e.depth")


def first_parented(events: DataFrame) -> DataFrame:
    """Per stream the causal event with a parent that has the least (depth, us), ties by stored order."""
    e = events.where("not is_background and parent_id is not null")
    return e.groupBy("stream_id").agg(F.min(F.struct("depth", "us", "pos", "event_id", "parent_id", "delta_us")).alias("e")).select("stream_id", "e.event_id", "e.parent_id", "e.delta_us")


def _pair(rows: DataFrame, kind: str, target: Column, answer: Column, source: Column | None = None) -> DataFrame:
    return rows.select("stream_id", F.concat(F.col("stream_id").cast("string"), F.lit(f"_qa_{kind}_1")).alias("qa_id"), F.lit(kind).alias("qa_type"), target.cast("bigint").alias("target_event_id"), (source if source is not None else F.lit(None)).cast("bigint").alias("source_event_id"), answer.cast("string").alias("answer"))


def direct_parent(events: DataFrame) -> DataFrame:
    return _pair(deepest(events).where("parent_id is not null"), "direct_parent", F.col("event_id"), F.col("parent_id"))


def root_cause(events: DataFrame) -> DataFrame:
    return _pair(deepest(events), "root_cause", F.col("event_id"), F.col("root_id"))


def temporal_order(events: DataFrame) -> DataFrame:
    order = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("us", "event_id"))), lambda x: x["event_id"].cast("string")), ", "), F.lit("]"))
    return _pair(events.groupBy("stream_id").agg(order.alias("a")), "temporal_order", F.lit(None), F.col("a"))


def time_delay(events: DataFrame) -> DataFrame:
    return _pair(first_parented(events), "time_delay", F.col("event_id"), F.col("delta_us"), F.col("parent_id"))


def causal_path(events: DataFrame, max_depth: int | None = None) -> DataFrame:
    p = paths(events.where("not is_background"), max_depth).select("stream_id", "event_id", "path")
    return _pair(deepest(events).join(p, ["stream_id", "event_id"]), "causal_path", F.col("event_id"), F.concat(F.lit("["), F.array_join(F.col("path").cast("array<string>"), ", "), F.lit("]")))


KINDS = (direct_parent, root_cause, temporal_order, time_delay, causal_path)


def all_pairs(events: DataFrame) -> DataFrame:
    """Every kind of pair. One aggregate of each stream gives all but the path, whose event it names."""
    c, bg = F.col, F.col("is_background")
    deep = F.max(F.when(~bg, F.struct("depth", "us", "event_id", "parent_id", "root_id")))
    first = F.min(F.when(~bg & c("parent_id").isNotNull(), F.struct("depth", "us", "pos", "event_id", "parent_id", "delta_us")))
    own = events.groupBy("stream_id").agg(deep.alias("e"), first.alias("f"), F.array_sort(F.collect_list(F.struct("us", "event_id"))).alias("o"))
    order = F.concat(F.lit("["), F.array_join(F.transform("o", lambda x: x["event_id"].cast("string")), ", "), F.lit("]"))

    def pair(kind: str, target: Column, answer: Column, there: Column, source: Column | None = None) -> Column:
        s = F.struct(F.lit(kind).alias("qa_type"), target.cast("bigint").alias("t"), (source if source is not None else F.lit(None)).cast("bigint").alias("s"), answer.cast("string").alias("a"))
        return F.when(there, s)

    each = F.array_compact(
        F.array(
            pair("direct_parent", c("e.event_id"), c("e.parent_id"), c("e.parent_id").isNotNull()),
            pair("root_cause", c("e.event_id"), c("e.root_id"), c("e").isNotNull()),
            pair("temporal_order", F.lit(None), order, F.lit(True)),
            pair("time_delay", c("f.event_id"), c("f.delta_us"), c("f").isNotNull(), c("f.parent_id")),
        )
    )
    x = own.select("stream_id", F.explode(each).alias("x"))
    four = x.select("stream_id", F.concat(c("stream_id").cast("string"), F.lit("_qa_"), "x.qa_type", F.lit("_1")).alias("qa_id"), "x.qa_type", c("x.t").alias("target_event_id"), c("x.s").alias("source_event_id"), c("x.a").alias("answer"))
    return four.unionByName(causal_path(events))


def label_check(qa: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs whose answer isn't the one the events give, and streams without any pair."""
    known = [f.__name__ for f in KINDS]
    mine = all_pairs(events).select("stream_id", "qa_type", "target_event_id", F.col("answer").alias("expected"))
    j = qa.join(mine, qa["stream_id"].eqNullSafe(mine["stream_id"]) & (qa["qa_type"] == mine["qa_type"]) & qa["target_event_id"].eqNullSafe(mine["target_event_id"]), "left")
    said = F.when(~qa["qa_type"].isin(*known), "unsupported type").when(~qa["answer"].eqNullSafe(F.col("expected")), "wrong answer")
    wrong = j.select(qa["stream_id"], qa["qa_id"], said.alias("error")).where("error is not null")
    none = events.select("stream_id").distinct().join(qa, "stream_id", "left_anti").select("stream_id", F.lit(None).cast("string").alias("qa_id"), F.lit("no qa pairs").alias("error"))
    return wrong.unionAll(none)


def event_label(event_id: Column, event_type: Column, semantic: Column) -> Column:
    return F.concat(F.lit("event "), event_id.cast("string"), F.lit(" ["), event_type, F.lit("]"), F.when(F.coalesce(semantic, F.lit("")) != "", F.concat(F.lit(" ("), semantic, F.lit(")"))).otherwise(""))


def answer_text(values: Column) -> Column:
    """A list as JSON text with a space behind each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", "")), ", "), F.lit("]"))


def render(events: DataFrame, streams: DataFrame | None = None) -> DataFrame:
    """The input text of a stream's examples: its events in time order, without any simulator label. An event is told by its semantic type, if
    there is such a column and it isn't empty, else by its type. With streams (stream_id, domain, topology) the text says these too."""
    kind = F.coalesce(F.nullif(F.col("semantic_type"), F.lit("")), "event_type") if "semantic_type" in events.columns else F.col("event_type")
    line = F.concat(F.lit("- event_id="), F.col("event_id").cast("string"), F.lit("; timestamp="), F.col("us").cast("string"), F.lit("; event="), F.coalesce(kind, F.lit("event")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("us", "event_id", line.alias("s")))), lambda x: x["s"])
    text = events.groupBy("stream_id").agg(F.array_join(lines, "\n").alias("lines"))
    if streams is None:
        return text.select("stream_id", F.concat(F.lit("Event stream:\nevents in timestamp order:\n"), "lines").alias("input"))
    said = lambda c: F.coalesce(c, F.lit("unknown"))
    about = streams.select("stream_id", F.concat(F.lit("domain="), said("domain"), F.lit("\ntopology="), said("topology")).alias("about"))
    about = text.join(about, "stream_id", "left").withColumn("about", F.coalesce("about", F.lit("domain=unknown\ntopology=unknown")))
    return about.select("stream_id", F.concat(F.lit("Event stream:\n"), "about", F.lit("\nevents in timestamp order:\n"), "lines").alias("input"))


METADATA = ("domain", "topology", "mechanism_type", "primary_regime", "semantic_method", "semantic_skeleton_version", "semantic_compatibility")


def metadata(streams: DataFrame) -> DataFrame:
    """(stream_id, metadata): what examples say about their stream; what a table lacks is null."""
    has = [F.col(c).cast("string").alias(c) if c in streams.columns else F.lit(None).cast("string").alias(c) for c in METADATA]
    return streams.select("stream_id", F.struct(*has).alias("metadata"))


def question(kind: Column, target: Column, source: Column) -> Column:
    t, s = target.cast("string"), source.cast("string")
    return (
        F.when(kind == "direct_parent", F.concat(F.lit("Which event directly caused event "), t, F.lit("?")))
        .when(kind == "root_cause", F.concat(F.lit("Which event is the root cause of event "), t, F.lit("?")))
        .when(kind == "time_delay", F.concat(F.lit("How long after event "), s, F.lit(" did event "), t, F.lit(" happen?")))
        .when(kind == "causal_path", F.concat(F.lit("What is the causal path to event "), t, F.lit("?")))
        .otherwise("In which order did the events happen?")
    )


def export_instruction(qa: DataFrame, events: DataFrame, streams: DataFrame | None = None) -> DataFrame:
    """Examples; with streams their input names domain and topology, and a metadata column comes along."""
    j = qa.join(render(events, streams), "stream_id")
    if streams is not None:
        j = j.join(metadata(streams), "stream_id", "left")
    return j.select(*(["metadata"] if streams is not None else []), F.concat_ws(":", F.col("stream_id").cast("string"), "qa_id").alias("example_id"), F.col("qa_type").alias("task_type"), question(F.col("qa_type"), F.col("target_event_id"), F.col("source_event_id")).alias("instruction"), "input", F.col("answer").alias("output"))


def export_chat(qa: DataFrame, events: DataFrame, system: str = "You reason about event streams.", streams: DataFrame | None = None) -> DataFrame:
    x = export_instruction(qa, events, streams)
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return x.select(*(["metadata"] if streams is not None else []), "example_id", "task_type", F.array(turn("system", F.lit(system)), turn("user", F.concat_ws("\n\n", "instruction", "input")), turn("assistant", F.col("output"))).alias("messages"))
