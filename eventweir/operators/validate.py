"""Constraint queries over generated streams: every rule is a predicate and a message; violations come as rows.

Events are in long form: stream_id, event_id, us, is_background, parent_id, root_id, depth, relation, delta_us.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
RELATIONS = ["direct_trigger", "delayed_trigger", "weak_trigger", "recovery"]
PARAMETERS = {"exponential": ["lambda"], "gamma": ["shape", "scale"], "lognormal": ["sigma"], "weibull": ["shape", "scale"], "deterministic_backoff": ["value"]}


def parent_join(events: DataFrame) -> DataFrame:
    """Every event beside its parent, co-partitioned by stream."""
    p = events.select("stream_id", F.col("event_id").alias("parent_id"), F.col("us").alias("p_us"), F.col("is_background").alias("p_background"), F.col("parent_id").alias("p_parent"), F.col("root_id").alias("p_root"), F.col("depth").alias("p_depth"))
    return events.join(p, ["stream_id", "parent_id"], "left")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def errors(rows: DataFrame, rules: list[tuple[Column, Column | str]]) -> DataFrame:
    """(stream_id, event_id, error) of each rule that a row breaks."""
    said = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(m) if isinstance(m, str) else m) for test, m in rules]))
    return rows.select("stream_id", "event_id", F.explode(said).alias("error"))


def structural_errors(events: DataFrame) -> DataFrame:
    """Duplicate ids, bad times and relations, and for causal events their parents, roots and depths. A missing parent ends an event's checks.
    If there is a timestamp column, its values must be finite; cycles of parents are graph.parent_cycles' part."""
    n = F.count(F.lit(1)).over(Window.partitionBy("stream_id", "event_id"))
    j = parent_join(events.withColumn("n_same", n))
    c = F.col
    bg, rooted = c("is_background"), c("parent_id").isNull()
    found = ~bg & ~rooted & c("p_us").isNotNull()
    root = F.when(c("p_parent").isNotNull(), c("p_root")).otherwise(c("parent_id"))
    return errors(
        j,
        [
            (c("n_same") > 1, "duplicate event_id"),
            ((c("us") < 0) | (~finite(c("timestamp")) if "timestamp" in events.columns else F.lit(False)), "invalid timestamp"),
            (c("relation").isNotNull() & ~c("relation").isin(*RELATIONS), "invalid relation type"),
            (bg & (~rooted | c("root_id").isNotNull()), "background event has causal ids"),
            (~bg & rooted & ~c("root_id").eqNullSafe(c("event_id")), "incorrect root_id"),
            (~bg & rooted & (c("depth") != 0), "nonzero cascade depth"),
            (~bg & ~rooted & c("p_us").isNull(), "missing parent"),
            (found & c("p_background"), "uses background event as parent"),
            (found & (c("us") <= c("p_us")), "not later than parent"),
            (found & ~c("root_id").eqNullSafe(root), "incorrect root_id"),
            (found & (c("depth") != c("p_depth") + 1), "incorrect cascade depth"),
        ],
    )


def temporal_errors(events: DataFrame, tolerance_us: int = 1, extreme_us: int = 10**12) -> DataFrame:
    """Gaps to parents: positive, as stored, not extreme; where there are columns regime and regime_params (a map), the regime must be there,
    known and its parameters valid. A gap that isn't positive ends an event's checks."""
    j = parent_join(events).where("not is_background and p_us is not null")
    c, ok = F.col, F.coalesce(F.col("delta_us") > 0, F.lit(False))
    rules = [(~ok, "non-positive delta_t"), (ok & (F.abs(c("us") - c("p_us") - c("delta_us")) > tolerance_us), "delta_t mismatch"), (ok & (c("delta_us") > extreme_us), "extreme delta_t")]
    if "regime" in events.columns:
        rules.append((ok & c("regime").isNull(), "no regime"))
        rules.append((ok & c("regime").isNotNull() & ~c("regime").isin(*PARAMETERS), "unknown regime"))
        if "regime_params" in events.columns:
            rules.append((ok & c("regime").isin(*PARAMETERS) & ~params_valid(c("regime"), c("regime_params")), "invalid regime params"))
    return errors(j, rules)


def stored_gaps(events: DataFrame, order: str = "pos") -> DataFrame:
    """Per stream, over the order in which events are stored, not over time: the least gap and whether times never go back."""
    gap = F.col("us") - F.lag("us").over(Window.partitionBy("stream_id").orderBy(order))
    return events.select("stream_id", gap.alias("gap")).groupBy("stream_id").agg(F.min("gap").alias("min_gap_us"), F.count(F.lit(1)).alias("n"), (F.coalesce(F.min("gap"), F.lit(0)) >= 0).alias("is_sorted"))


def temporal_metrics(events: DataFrame) -> DataFrame:
    j = parent_join(events)
    d = F.when(~F.col("is_background") & F.col("p_us").isNotNull() & (F.col("delta_us") > 0), F.col("delta_us").cast("double") / 1e6)
    r = lambda x: F.round(F.coalesce(x, F.lit(0.0)), 6)
    return j.groupBy("stream_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if(~F.col("is_background")).alias("causal_event_count"), F.count_if("is_background").alias("background_event_count"),
        F.round(F.avg(F.col("is_background").cast("double")), 6).alias("background_ratio"), r(F.avg(d)).alias("delta_mean"), r(F.min(d)).alias("delta_min"), r(F.max(d)).alias("delta_max"),
    )


def stream_errors(metrics: DataFrame, min_gaps: DataFrame, min_events: int = 5, max_events: int = 80, ratio: tuple[float, float] = (0.0, 0.75), min_gap_us: int = 1) -> DataFrame:
    j = metrics.join(min_gaps.drop("n"), "stream_id", "left").withColumn("event_id", F.lit(None).cast("bigint"))
    c = F.col
    late = [(~c("is_sorted"), "events are not sorted by timestamp")] if "is_sorted" in min_gaps.columns else []
    return errors(
        j,
        [
            *late,
            (c("min_gap_us") < min_gap_us, "sequence is too dense"),
            ((c("event_count") < min_events) | (c("event_count") > max_events), "event count outside configured range"),
            ((c("background_ratio") < ratio[0]) | (c("background_ratio") > ratio[1]), "background ratio outside configured range"),
        ],
    ).drop("event_id")


def min_gap_threshold(min_positive: Column, calibrated: Column, default: float = 1e-12) -> Column:
    return F.when(calibrated & (min_positive > 0), F.least(F.lit(default), F.greatest(min_positive * 0.1, F.lit(0.0)))).otherwise(F.lit(default))


def params_valid(regime: Column, params: Column) -> Column:
    """Whether a regime is known and all its parameters are positive; lognormal's mu may be any number but must be there."""
    tests = F.lit(False)
    for name, keys in PARAMETERS.items():
        ok = reduce(lambda a, b: a & b, [F.coalesce(F.try_element_at(params, F.lit(k)) > 0, F.lit(False)) for k in keys])
        if name == "lognormal":
            ok &= F.try_element_at(params, F.lit("mu")).isNotNull()
        tests = F.when(regime == name, ok).otherwise(tests)
    return tests


def mechanism_errors(nodes: DataFrame, edges: DataFrame, events: DataFrame) -> DataFrame:
    """(stream_id, error) where mechanism and events disagree: nodes (stream_id, node_id) that no causal event stands for, edges
    (stream_id, source, target, relation) with an end that is no node or a relation that isn't known."""
    silent = nodes_without_event(nodes, events.where("not is_background and node_id is not null"))
    lost = dangling_edges(edges, nodes.select("stream_id", F.col("node_id").alias("node")))
    odd = edges.where(~F.coalesce(F.col("relation").isin(*RELATIONS), F.lit(False)))
    said = [
        silent.select("stream_id", F.concat(F.lit("mechanism node "), "node_id", F.lit(" has no event")).alias("error")),
        lost.select("stream_id", F.concat(F.lit("mechanism edge "), "missing", F.lit(" "), F.when(F.col("missing") == "source", F.col("source")).otherwise(F.col("target")), F.lit(" has no node")).alias("error")),
        odd.select("stream_id", F.concat(F.lit("mechanism edge "), "source", F.lit("->"), "target", F.lit(" has invalid relation type")).alias("error")),
    ]
    return reduce(DataFrame.unionAll, said)


def tree_errors(edges: DataFrame, events: DataFrame, trees: DataFrame, max_children: int | None = 3, max_depth: int | None = 6) -> DataFrame:
    """(stream_id, error) of streams in trees (stream_id) with a node of too many children or an event too deep."""
    out = trees.select("stream_id", F.lit(None).cast("string").alias("error")).where("false")
    if max_children is not None:
        wide = fanout_violations(edges, max_children).join(trees.select("stream_id"), "stream_id", "left_semi")
        out = out.unionAll(wide.select("stream_id", F.concat(F.lit("too many tree children for "), F.col("source").cast("string"), F.lit(": "), F.col("children").cast("string")).alias("error")))
    if max_depth is not None:
        deep = events.where(~F.col("is_background") & (F.col("depth") > max_depth)).join(trees.select("stream_id"), "stream_id", "left_semi")
        out = out.unionAll(deep.select("stream_id", F.concat(F.lit("tree event "), F.col("event_id").cast("string"), F.lit(" exceeds max depth")).alias("error")))
    return out


def merge_rejected(rejected: DataFrame, gated: DataFrame) -> DataFrame:
    """Rejected streams and those a quality gate turned away, (stream_id, stage, approved, errors)."""
    return rejected.select("stream_id", "stage", "approved", "errors").unionByName(gated.select("stream_id", "stage", F.lit(False).alias("approved"), F.col("issues").alias("errors")))


def nodes_without_event(nodes: DataFrame, events: DataFrame) -> DataFrame:
    return nodes.join(events.select("stream_id", "node_id"), ["stream_id", "node_id"], "left_anti")


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(stream_id, source, target, missing): edges with an end that is no node."""
    out = []
    for end in ("source", "target"):
        ends = nodes.select("stream_id", F.col("node").alias(end))
        out.append(edges.select("stream_id", "source", "target").join(ends, ["stream_id", end], "left_anti").select("stream_id", "source", "target", F.lit(end).alias("missing")))
    return out[0].unionAll(out[1])


def fanout_violations(edges: DataFrame, limit: int) -> DataFrame:
    return edges.groupBy("stream_id", "source").agg(F.count(F.lit(1)).alias("children")).where(F.col("children") > limit)


def mapping_diff(nodes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Nodes without a phrase and phrases without a node: (stream_id, node_id, side)."""
    j = nodes.withColumn("n", F.lit(1)).join(mapping.withColumn("m", F.lit(1)), ["stream_id", "node_id"], "full_outer")
    return j.where("n is null or m is null").select("stream_id", "node_id", F.when(F.col("m").isNull(), "missing").otherwise("extra").alias("side"))


def zip_compare(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Positional comparison (stream_id, pos, value): a stream with another count gives one row at position -1 and nothing else."""
    na, ne = (x.groupBy("stream_id").agg(F.count(F.lit(1)).alias(n)) for x, n in ((actual, "na"), (expected, "ne")))
    counts = na.join(ne, "stream_id", "full_outer").fillna(0, ["na", "ne"])
    short = counts.where("na <> ne").select("stream_id", F.lit(-1).cast("bigint").alias("pos"), F.lit("count mismatch").alias("error"))
    same = actual.join(counts.where("na = ne").select("stream_id"), "stream_id", "left_semi").join(expected.withColumnRenamed("value", "wanted"), ["stream_id", "pos"])
    return same.where(~F.col("value").eqNullSafe(F.col("wanted"))).select("stream_id", F.col("pos").cast("bigint").alias("pos"), F.lit("value mismatch").alias("error")).unionAll(short)


def reject_stage(found: DataFrame, stages: list[str]) -> DataFrame:
    """Per stream the first of the stages that failed. found: (stream_id, stage)."""
    order = F.array_position(F.array(*map(F.lit, stages)), F.col("stage"))
    return found.groupBy("stream_id").agg(F.min_by("stage", order).alias("stage"))


def diversity_missing(rows: DataFrame, column: str, expected: list[str]) -> DataFrame:
    """Expected values that never occur, if there are several and rows enough to hold them all."""
    seen = rows.agg(F.collect_set(F.col(column).cast("string")).alias("seen"), F.count(F.lit(1)).alias("n"))  # values of a small category
    missing = F.array_except(F.array(*map(F.lit, expected)), F.col("seen"))
    return seen.where((F.col("n") >= len(expected)) & F.lit(len(expected) > 1)).select(F.lit(column).alias("field"), F.explode(missing).alias("missing"))
