"""The relational half of calibration: transitions between consecutive events, their gaps and their summaries.

Events are ordered within a stream by (us, event_type). One shuffle by stream serves every lead and lag here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import ranked

def in_order():
    return Window.partitionBy("stream_id").orderBy("us", "event_type")


def seconds(us: Column) -> Column:
    return us.cast("double") / 1e6


def steps(events: DataFrame) -> DataFrame:
    """Every event with the next one and the one after it: a, b, c and the gaps ab, bc in microseconds."""
    W = in_order()
    nxt, gap = F.lead("event_type").over(W), F.lead("us").over(W) - F.col("us")
    rows = events.select("stream_id", "us", "event_type", nxt.alias("b"), F.lead("event_type", 2).over(W).alias("c"), gap.alias("ab"), (F.lead("us", 2).over(W) - F.lead("us").over(W)).alias("bc"))
    return rows.withColumnRenamed("event_type", "a")


def positive(steps_: DataFrame) -> DataFrame:
    """Pairs with a positive gap; a pair without one is dropped, not bridged."""
    return steps_.where("ab > 0")


def event_frequencies(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _shares(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.withColumn("probability", F.round(F.col("n").cast("double") / F.sum("n").over(Window.partitionBy(*by)), 9))


def transition_probs(events: DataFrame) -> DataFrame:
    counts = positive(steps(events)).groupBy(F.col("a").alias("source"), F.col("b").alias("target")).agg(F.count(F.lit(1)).alias("n"))
    return _shares(counts, ["source"])


def second_order_probs(events: DataFrame) -> DataFrame:
    counts = steps(events).where("ab > 0 and bc > 0").groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))
    return _shares(counts, ["a", "b"])


def sequence_length_hist(events: DataFrame) -> DataFrame:
    sizes = events.groupBy("stream_id").agg(F.count(F.lit(1)).alias("length"))
    return sizes.groupBy(F.col("length").cast("string").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def delta_summary_levels(events: DataFrame) -> DataFrame:
    """Count, least, mean and greatest gap for each transition, each source type and all, in one pass."""
    gaps = positive(steps(events)).select(F.col("a").alias("source"), F.col("b").alias("target"), seconds(F.col("ab")).alias("d"))
    levels = gaps.groupingSets([["source", "target"], ["source"], []], "source", "target")
    return levels.agg(
        F.expr("grouping_id(source, target)").cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.min("d"), 6).alias("min_delta"), F.round(F.avg("d"), 6).alias("mean_delta"), F.round(F.max("d"), 6).alias("max_delta")
    )


def delta_profile(events: DataFrame) -> DataFrame:
    """Linear-interpolated quantiles of all positive gaps; zeros without any. The quantiles are exact and no task sees all gaps."""
    d = positive(steps(events)).select(seconds(F.col("ab")).alias("d"))
    shares = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    found = ranked(d, "d", lambda n: {k: [math.floor((n - 1) * q), math.ceil((n - 1) * q)] for k, q in shares.items()})
    n = F.count("d")
    r = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    out = d.agg(n.alias("n"), r(F.min("d")).alias("min_delta"), r(F.max("d")).alias("max_delta"), r(F.avg("d")).alias("mean_delta"))
    low = {k: F.lit(found[k][0] if found else 0.0) for k in shares}
    high = {k: F.lit(found[k][1] if found else 0.0) for k in shares}
    part = {k: (F.greatest(F.col("n") - 1, F.lit(0)) * q) % 1 for k, q in shares.items()}
    return out.select("n", "min_delta", *[r(low[k] + (high[k] - low[k]) * part[k]).alias(k) for k in shares], "max_delta", "mean_delta")


def start_events(events: DataFrame) -> DataFrame:
    """Source types that are never a target, or all source types if there are none, weighted by frequency."""
    t = transition_probs(events)
    sources = t.select("source").distinct()
    roots = sources.join(t.select(F.col("target").alias("source")).distinct(), "source", "left_anti")
    either = roots.withColumn("own", F.lit(0)).unionAll(sources.withColumn("own", F.lit(1)))
    best = either.withColumn("least", F.min("own").over(Window.partitionBy())).where("own = least").select("source")  # one row for each type
    return best.join(event_frequencies(events).withColumnRenamed("event_type", "source"), "source", "left").select(F.col("source").alias("event_type"), F.coalesce("n", F.lit(1)).alias("weight"))


def smoothed_weights(probs: DataFrame, alpha: float = 0.01, temperature: float = 1.0) -> DataFrame:
    """(source, target, weight): alpha is added for every source type as a target; weights aren't normalised again."""
    types = probs.select("source").distinct()
    grid = types.crossJoin(types.select(F.col("source").alias("target")))  # types by types: bounded by the vocabulary
    full = grid.withColumn("alpha", F.lit(alpha)).join(probs.select("source", "target", "probability"), ["source", "target"], "full_outer")
    w = F.coalesce("probability", F.lit(0.0)) + F.coalesce("alpha", F.lit(0.0))
    return full.select("source", "target", F.round(F.pow(w, F.lit(1.0 / temperature)), 9).alias("weight"))


def history_state(events: DataFrame, window_us: int = 2_000_000, burst: int = 3) -> DataFrame:
    """Per event: the two types before it, how many events of any and of its own type the window up to it holds, whether that is a burst,
    the time since the stream's first event."""
    W = in_order()
    recent = Window.partitionBy("stream_id").orderBy("us").rangeBetween(-window_us, 0)
    same = Window.partitionBy("stream_id", "event_type").orderBy("us").rangeBetween(-window_us, 0)
    n = F.count(F.lit(1)).over(recent)
    return events.select(
        "stream_id", "us", "event_type", F.lag("event_type").over(W).alias("previous"), F.lag("event_type", 2).over(W).alias("before_previous"), n.alias("recent"),
        F.count(F.lit(1)).over(same).alias("recent_same"), (n >= burst).alias("is_bursty"), F.round(seconds(F.col("us") - F.min("us").over(Window.partitionBy("stream_id"))), 6).alias("since_root"),
    )


def active_sources(events: DataFrame) -> DataFrame:
    """Per event how many different roots the causal events of its stream up to it have, one at least. events: (stream_id, us, event_id,
    is_background, root_id)."""
    known = ~F.col("is_background") & F.col("root_id").isNotNull()
    first = F.row_number().over(Window.partitionBy("stream_id", "root_id", known).orderBy("us", "event_id")) == 1
    so_far = Window.partitionBy("stream_id").orderBy("us", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = events.withColumn("_new", (known & first).cast("int"))
    return rows.select("stream_id", "event_id", F.greatest(F.sum("_new").over(so_far), F.lit(1)).alias("active_sources"))


def min_gaps(events: DataFrame) -> DataFrame:
    own = in_order()
    gaps = events.select("stream_id", (F.col("us") - F.lag("us").over(own)).alias("gap"))
    return gaps.groupBy("stream_id").agg(F.min("gap").alias("min_gap_us"), F.count(F.lit(1)).alias("n"))


def background_ratio(events: DataFrame, background: Column) -> DataFrame:
    return events.groupBy("stream_id").agg(F.round(F.avg(background.cast("double")), 6).alias("background_ratio"))
