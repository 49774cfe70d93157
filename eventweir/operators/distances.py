"""Distances between populations of streams. Populations carry a column ``population``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .transitions import seconds


def summaries(events: DataFrame) -> DataFrame:
    """Consecutive pairs within (population, stream): transitions keep zero gaps, gaps alone must be positive."""
    own = Window.partitionBy("population", "stream_id").orderBy("us", "event_type")
    return events.select("population", "stream_id", F.col("event_type").alias("a"), F.lead("event_type").over(own).alias("b"), (F.lead("us").over(own) - F.col("us")).alias("ab"))


def ks_wasserstein(values: DataFrame, left: str, right: str) -> DataFrame:
    """(ks, wasserstein) of x in two populations: one pass over the distinct points, both distribution functions running along. An empty
    side counts as no distance.

    Points are summed in buckets of x first, so that only bucket sums meet in one task and the running sums go on in all.
    """
    v = values.where(F.col("population").isin(left, right)).withColumn("l", (F.col("population") == left).cast("long"))
    g = v.groupBy("x").agg(F.sum("l").alias("a"), F.sum(1 - F.col("l")).alias("b"))
    span = g.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("a").alias("na"), F.sum("b").alias("nb"))
    g = g.crossJoin(F.broadcast(span)).withColumn("k", F.when(F.col("hi") > F.col("lo"), F.floor(256 * (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")))).otherwise(0))
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)  # at most 257 rows
    zero = F.lit(0).cast("long")
    bins = g.groupBy("k").agg(F.sum("a").alias("ka"), F.sum("b").alias("kb"), F.min("x").alias("first"))
    bins = bins.select("k", F.coalesce(F.sum("ka").over(before), zero).alias("pa"), F.coalesce(F.sum("kb").over(before), zero).alias("pb"), F.lead("first").over(Window.orderBy("k")).alias("next_first"))
    own = Window.partitionBy("k").orderBy("x")
    p = g.join(F.broadcast(bins), "k").select("na", "nb", (F.col("pa") + F.sum("a").over(own)).alias("ca"), (F.col("pb") + F.sum("b").over(own)).alias("cb"), (F.coalesce(F.lead("x").over(own), F.col("next_first")) - F.col("x")).alias("dx"))
    gap = F.abs(F.col("ca").cast("double") / F.col("na") - F.col("cb").cast("double") / F.col("nb"))
    full = (F.col("na") > 0) & (F.col("nb") > 0)
    return p.where(full).agg(F.round(F.coalesce(F.max(gap), F.lit(0.0)), 6).alias("ks"), F.round(F.coalesce(F.sum(gap * F.col("dx")), F.lit(0.0)), 6).alias("wasserstein"))


def l1(values: DataFrame, key: list[str], left: str, right: str) -> DataFrame:
    """L1 distance of the normalised frequencies of key in two populations."""
    counts = values.where(F.col("population").isin(left, right)).groupBy(*key).agg(F.count_if(F.col("population") == left).alias("_l"), F.count_if(F.col("population") == right).alias("_r"))
    total = counts.agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    part = lambda c, n: F.coalesce(F.col(c).cast("double") / F.nullif(F.col(n), F.lit(0)), F.lit(0.0))
    return counts.crossJoin(F.broadcast(total)).agg(F.round(F.coalesce(F.sum(F.abs(part("_l", "_nl") - part("_r", "_nr"))), F.lit(0.0)), 6).alias("l1"))  # one row of totals


def repeated_ratio(events: DataFrame) -> DataFrame:
    """Per population: the share of a stream's events whose type occurs more than once in it, averaged over streams."""
    types = events.groupBy("population", "stream_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    streams = types.groupBy("population", "stream_id").agg((F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("double") / F.sum("n")).alias("r"))
    return streams.groupBy("population").agg(F.round(F.avg("r"), 6).alias("repeated_ratio"))


def burstiness(events: DataFrame) -> DataFrame:
    """Per population: (sigma - mu) / (sigma + mu) of the positive gaps; 0 with fewer than two."""
    d = summaries(events).where("ab > 0").select("population", seconds(F.col("ab")).alias("d"))
    s, m = F.stddev_pop("d"), F.avg("d")
    value = F.when((F.count("d") < 2) | (s + m == 0), F.lit(0.0)).otherwise((s - m) / (s + m))
    found = d.groupBy("population").agg(value.alias("v"))
    return events.select("population").distinct().join(found, "population", "left").select("population", F.round(F.coalesce("v", F.lit(0.0)), 6).alias("burstiness"))


def curve_distances(values: DataFrame, real: str, others: tuple[str, ...]) -> DataFrame:
    """(metric, population, ks, wasserstein) of values (metric, population, x): each other population against the real one, all metrics and
    populations in one pass over the distinct points. Points of a third population don't change a distance. An empty side counts as no distance."""
    every = [real, *others]
    g = values.groupBy("metric", "x").agg(*[F.count_if(F.col("population") == p).alias(f"n{i}") for i, p in enumerate(every)])
    span = g.groupBy("metric").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), *[F.sum(f"n{i}").alias(f"t{i}") for i in range(len(every))])
    g = g.join(F.broadcast(span), "metric")  # one row for each metric
    g = g.withColumn("k", F.when(F.col("hi") > F.col("lo"), F.floor(256 * (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")))).otherwise(0))
    bins = g.groupBy("metric", "k").agg(F.min("x").alias("first"), *[F.sum(f"n{i}").alias(f"s{i}") for i in range(len(every))])
    by_bin = Window.partitionBy("metric").orderBy("k")  # at most 257 rows for each metric
    before = by_bin.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bins = bins.select("metric", "k", F.lead("first").over(by_bin).alias("next"), *[F.coalesce(F.sum(f"s{i}").over(before), zero).alias(f"p{i}") for i in range(len(every))])
    own = Window.partitionBy("metric", "k").orderBy("x")
    share = [((F.col(f"p{i}") + F.sum(f"n{i}").over(own)).cast("double") / F.nullif(F.col(f"t{i}"), zero)).alias(f"f{i}") for i in range(len(every))]
    p = g.join(F.broadcast(bins), ["metric", "k"]).select("metric", (F.coalesce(F.lead("x").over(own), "next") - F.col("x")).alias("dx"), *share)
    r = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    gap = [F.abs(F.col(f"f{i + 1}") - F.col("f0")) for i in range(len(others))]
    found = [F.struct(F.lit(o).alias("population"), r(F.max(gap[i])).alias("ks"), r(F.sum(gap[i] * F.col("dx"))).alias("wasserstein")) for i, o in enumerate(others)]
    return p.groupBy("metric").agg(F.array(*found).alias("d")).select("metric", F.explode("d").alias("d")).select("metric", "d.*")


def frequency_distances(values: DataFrame, real: str, others: tuple[str, ...]) -> DataFrame:
    """(metric, population, l1) of values (metric, population, key): L1 distances of normalised frequencies, all in one pass."""
    every = [real, *others]
    g = values.groupBy("metric", "key").agg(*[F.count_if(F.col("population") == p).alias(f"n{i}") for i, p in enumerate(every)])
    total = g.groupBy("metric").agg(*[F.nullif(F.sum(f"n{i}"), F.lit(0).cast("long")).alias(f"t{i}") for i in range(len(every))])
    g = g.join(F.broadcast(total), "metric")  # one row for each metric
    part = [F.coalesce(F.col(f"n{i}").cast("double") / F.col(f"t{i}"), F.lit(0.0)) for i in range(len(every))]
    found = [F.struct(F.lit(o).alias("population"), F.round(F.sum(F.abs(part[i + 1] - part[0])), 6).alias("l1")) for i, o in enumerate(others)]
    return g.groupBy("metric").agg(F.array(*found).alias("d")).select("metric", F.explode("d").alias("d")).select("metric", "d.*")


def comparison_report(events: DataFrame, real: str = "real", others: tuple[str, ...] = ("generic", "calibrated")) -> DataFrame:
    """(metric, comparison, value) rows of every distance of each other population from the real one; 0 where there is nothing to compare."""
    pairs = summaries(events)
    gaps = pairs.where("ab > 0").select(F.lit("inter_event_time").alias("metric"), "population", seconds(F.col("ab")).alias("x"))
    sizes = events.groupBy("population", "stream_id").agg(F.count(F.lit(1)).cast("double").alias("x")).select(F.lit("sequence_length").alias("metric"), "population", "x")
    kinds = pairs.select(F.lit("event_type_frequency").alias("metric"), "population", F.array("a").alias("key"))
    steps = pairs.where("b is not null").select(F.lit("transition_frequency").alias("metric"), "population", F.array("a", "b").alias("key"))
    curves, freqs = curve_distances(gaps.unionAll(sizes), real, others), frequency_distances(kinds.unionAll(steps), real, others)
    said = lambda c: F.struct(F.concat("metric", F.lit(f"_{c}")).alias("metric"), "population", F.col(c).alias("value"))
    found = curves.select(F.explode(F.array(said("ks"), said("wasserstein"))).alias("r")).unionAll(freqs.select(said("l1").alias("r"))).select("r.*")
    names = ["inter_event_time_ks", "inter_event_time_wasserstein", "sequence_length_ks", "sequence_length_wasserstein", "event_type_frequency_l1", "transition_frequency_l1"]
    wanted = events.sparkSession.createDataFrame([(m, o) for m in names for o in others], "metric string, population string")
    out = F.broadcast(wanted).join(found, ["metric", "population"], "left")
    return out.select("metric", F.concat("population", F.lit(f"_vs_{real}")).alias("comparison"), F.coalesce("value", F.lit(0.0)).alias("value"))


def calibration_effect(report: DataFrame) -> DataFrame:
    """Per metric: what calibration takes off the generic distance, absolutely and relatively, and whether it improves."""
    p = report.groupBy("metric").pivot("comparison", ["generic_vs_real", "calibrated_vs_real"]).agg(F.first("value"))
    g, c = F.col("generic_vs_real"), F.col("calibrated_vs_real")
    return p.select("metric", F.round(g - c, 6).alias("absolute"), F.round(F.when(g == 0, 0.0).otherwise((g - c) / g), 5).alias("relative"), (c < g).alias("improved"))
