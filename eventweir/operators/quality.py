"""Rule-based quality of scenarios (description, phrases array, relations array), the gate on it, summaries and audits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def score(scenarios: DataFrame) -> DataFrame:
    """Adds the counts, score, issues and approved."""
    s = scenarios.withColumns(
        {
            "short": T.count_where(F.col("phrases"), lambda p: T.word_count(p) < 3),
            "duplicate": T.duplicates(F.col("phrases")),
            "generic": T.count_where(F.col("phrases"), T.is_generic_phrase),
            "weak": T.count_where(F.col("relations"), T.is_weak_relation),
            "description_words": T.word_count(F.col("description")),
        }
    )
    flag = (F.col("description_words") < 6).cast("int")
    counts = {k: F.col(k) for k in ("short", "duplicate", "generic", "weak")} | {"description": flag}
    loss = sum((c.cast("double") * T.PENALTIES[k] for k, c in counts.items()), F.lit(0.0))
    s = s.withColumn("score", F.greatest(F.round(1 - loss, 6), F.lit(0.0))).withColumn("issues", F.array_compact(F.array(*[F.when(c > 0, T.ISSUES[k]) for k, c in counts.items()])))
    return s.withColumn("approved", (F.col("score") >= 0.7) & (F.size("issues") == 0))


def gate(scored: DataFrame, min_score: float = 0.7, reject_issues: bool = True) -> DataFrame:
    """Adds stage: null for what passes, semantic_quality_gate for the rest."""
    bad = (F.col("score") < min_score) | (F.lit(reject_issues) & (F.size("issues") > 0))
    return scored.withColumn("stage", F.when(bad, "semantic_quality_gate"))


def summary(scored: DataFrame, by: list[list[str]] | None = None) -> DataFrame:
    """Counts and scores of all, or of each grouping set in by."""
    aggs = [F.count(F.lit(1)).alias("sample_count"), F.count_if("approved").alias("approved_count"), F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 6).alias("average_score"), F.coalesce(F.min("score"), F.lit(0.0)).alias("min_score"), F.coalesce(F.max("score"), F.lit(0.0)).alias("max_score")]
    if not by:
        return scored.agg(*aggs)
    cols = list(dict.fromkeys(c for g in by for c in g))
    return scored.groupingSets(by, *cols).agg(*aggs)


def by_member(scored: DataFrame, members: str, empty: str = "unknown") -> DataFrame:
    """A summary for each distinct member of an array column; rows without any count under ``empty``."""
    m = F.array_distinct(F.coalesce(F.col(members), F.array().cast("array<string>")))
    return summary(scored.withColumn("member", F.explode(F.when(F.size(m) > 0, m).otherwise(F.array(F.lit(empty))))), [["member"]])


def exploded_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.explode(column).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def lowest(scored: DataFrame, n: int, key: str = "stream_id") -> DataFrame:
    return scored.orderBy("score", key).limit(max(0, n)).select(key, "score", F.array_join("issues", "; ").alias("issues"))


def significant(x, digits: int):
    """x rounded to so many significant digits; it never falls where x rises."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * scale) / scale)


def bucket(x):
    """A whole number for each three leading digits of x, which never falls where x rises."""
    power = F.floor(F.log10(F.abs(x)))
    lead = F.round(F.abs(x) / F.pow(F.lit(10.0), power - 2)).cast("long")
    carried = F.when(lead >= 1000, (power + 1) * 1000 + 100).otherwise(power * 1000 + lead)
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("long") * (carried + 400_000)).cast("long")


def ranked(values: DataFrame, column: str, ranks: Callable[[int], dict[str, list[int]]]) -> dict[str, list[float]]:
    """Exact order statistics: for each name the values at its 0-based ranks; ranks gets the count. Empty without values.

    Values are counted in buckets of three significant digits, at most 900 for each power of ten and sign. Then only the buckets that a rank falls
    into are counted value by value, and each is ranked by itself.
    """
    x = values.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x")).withColumn("b", bucket(F.col("x")))
    counts = sorted((r["b"], r["c"]) for r in x.groupBy("b").agg(F.count(F.lit(1)).alias("c")).collect())  # bounded by the powers of ten
    total = sum(c for _, c in counts)
    if not total:
        return {}
    wanted, starts, at = ranks(total), {}, 0
    for b, c in counts:
        starts[b] = at
        at += c
    every = sorted({k for v in wanted.values() for k in v})
    of = {k: max(b for b, s in starts.items() if s <= k) for k in every}
    near = x.where(F.col("b").isin(sorted(set(of.values())))).groupBy("b", "x").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("b").orderBy("x"))
    asked = F.array(*[F.struct(F.lit(of[k]).cast("long").alias("b"), F.lit(k - starts[of[k]]).cast("long").alias("k"), F.lit(k).cast("long").alias("rank")) for k in every])
    hit = F.filter(asked, lambda a: (a["b"] == F.col("b")) & (a["k"] < F.col("upto")) & (a["k"] >= F.col("upto") - F.col("c")))
    got = near.withColumn("upto", upto).select("x", F.explode(hit).alias("a")).select("x", "a.rank").collect()  # one row for each rank
    value = {r["rank"]: r["x"] for r in got}
    return {name: [value[k] for k in v] for name, v in wanted.items()}


def coverage(rows: DataFrame, dims: list[str]) -> DataFrame:
    """(dimension, value, n) of each dimension's values, nulls kept, in one pass."""
    stacked = rows.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])).alias("x"))
    return stacked.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n")).select("dimension", "value", "n")


def coverage_report(rows: DataFrame) -> DataFrame:
    """(dimension, value, n) over domain, topology, mechanism_type, primary_regime, background_density, and of n_nodes the lengths of chains and
    the sizes of trees. Nulls count as a value, but for the last two, which only their own topology has."""
    own = lambda kind: F.when(F.col("topology") == kind, F.col("n_nodes"))
    dims = ["domain", "topology", "mechanism_type", "primary_regime", "background_density", "chain_length", "tree_nodes"]
    got = coverage(rows.withColumns({"chain_length": own("chain"), "tree_nodes": own("tree")}), dims)
    return got.where(~F.col("dimension").isin("chain_length", "tree_nodes") | F.col("value").isNotNull())


def judge_summary(results: DataFrame) -> DataFrame:
    """One row about a judge's results (approved, score): counts, pass rate and scores; zeros without any. exploded_counts counts their issues."""
    n, score = F.count(F.lit(1)), F.coalesce(F.col("score"), F.lit(0.0))
    r = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    return results.agg(
        n.alias("sample_count"), F.count_if("approved").alias("approved_count"), r(F.try_divide(F.count_if("approved").cast("double"), n)).alias("pass_rate"), r(F.avg(score)).alias("average_score"),
        F.coalesce(F.min(score), F.lit(0.0)).alias("min_score"), F.coalesce(F.max(score), F.lit(0.0)).alias("max_score"),
    )


def client_quality(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: how streams whose scenario a client wrote fared. accepted: (semantic_method, semantic_approved, attempts), rejected: any rows."""
    own = F.col("semantic_method") == "llm"
    r = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    tried = F.when(own, F.coalesce("attempts", F.lit(0)))
    a = accepted.agg(
        F.count(F.lit(1)).alias("accepted_count"), F.count_if(own).alias("llm_semantic_count"), r(F.avg(F.when(own, F.coalesce("semantic_approved", F.lit(False)).cast("double")))).alias("semantic_pass_rate"),
        r(F.avg(tried)).alias("average_attempts"), F.coalesce(F.max(tried), F.lit(0)).cast("long").alias("max_attempts"),
    )
    return a.crossJoin(rejected.agg(F.count(F.lit(1)).alias("rejected_count")))  # one row by one row


def previews(accepted: DataFrame, n: int, order: str = "stream_id") -> DataFrame:
    """The first n accepted streams by name, as a report shows them."""
    cols = [c for c in ("stream_id", "domain", "description", "event_mapping", "attempts") if c in accepted.columns]
    return accepted.orderBy(order).limit(max(0, n)).select(*cols)


def nearest_rank(values: DataFrame, column: str) -> DataFrame:
    """min, p25, p50, p75 and max by rank round((n - 1) q), halves to even; zeros for an empty column."""
    names = {"min": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max": 1.0}
    found = ranked(values, column, lambda n: {k: [round((n - 1) * q)] for k, q in names.items()})
    row = {k: round(v[0], 6) for k, v in found.items()} if found else dict.fromkeys(names, 0.0)
    return values.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"{k} double" for k in row))
