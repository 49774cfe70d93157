"""Generation: combinations, regimes, delays, background arrivals and whole streams.

Every draw is a counter-based uniform keyed by seed, stream, attempt and draw, so streams don't depend on partitions. What is
sequential within a stream (history changes the next delay) runs in a kernel over Arrow batches of streams; the rest is columns.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.randomness import exponential, uniform

# ---- fixed values: the taxonomy and the generic prior.

DOMAINS = ["IT/System", "Finance", "Healthcare", "Politics", "Social", "Supply Chain", "Transportation", "Industrial", "Cybersecurity", "Scientific Process"]
TOPOLOGIES = ["chain", "tree"]
MECHANISMS = ["direct_trigger", "delayed_trigger", "multi_hop_propagation", "burst", "recovery"]
REGIMES = ["exponential", "gamma", "lognormal", "weibull"]
RELATION_OF = {"direct_trigger": "direct_trigger", "delayed_trigger": "delayed_trigger", "multi_hop_propagation": "direct_trigger", "burst": "weak_trigger", "recovery": "recovery"}
REGIME_WEIGHTS = {
    "direct_trigger": [("exponential", 0.5), ("gamma", 0.5)],
    "delayed_trigger": [("gamma", 0.4), ("lognormal", 0.4), ("weibull", 0.2)],
    "weak_trigger": [("exponential", 0.3), ("lognormal", 0.5), ("weibull", 0.2)],
    "recovery": [("gamma", 0.4), ("lognormal", 0.4), ("weibull", 0.2)],
}
REGIME_PARAMS = {"exponential": {"lambda": 1.0}, "gamma": {"shape": 2.0, "scale": 0.8}, "lognormal": {"mu": 0.2, "sigma": 0.5}, "weibull": {"shape": 1.5, "scale": 1.0}}
ADJUST = {"bursty": 0.65, "depth": 0.08, "delayed_trigger": 2.0, "weak_trigger": 1.4, "recovery": 2.5}
DISTRACTORS = ["near_time_unrelated", "similar_type_unrelated", "invalid_trigger_timing", "post_target_non_cause"]
BACKGROUND_RATES = {"low": 0.05, "medium": 0.15, "high": 0.35}
ISSUE_CAPS = {"tree": (10, 3, 2), "recovery_tree": (8, 3, 2), "chain": 8, "recovery_chain": 6, "recovery_events": 45}


# ---- combinations


def taxonomy(spark: SparkSession) -> DataFrame:
    """domain x topology x mechanism_type x primary_regime: at most a few hundred rows."""
    out = spark.range(1)
    for name, values in (("domain", DOMAINS), ("topology", TOPOLOGIES), ("mechanism_type", MECHANISMS), ("primary_regime", REGIMES)):
        out = out.crossJoin(spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name)))
    return out.drop("id")


def balanced_order(combos: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Always next the combination whose values were used least so far, then the one least like the one before, then the first by name."""
    left, out, used = set(combos), [], {}
    while left:
        def cost(c: tuple[str, ...]) -> tuple:
            return sum(used.get((i, v), 0) for i, v in enumerate(c)), sum(a == b for a, b in zip(c, out[-1])) if out else 0, c
        best = min(left, key=cost)
        left.remove(best)
        out.append(best)
        for key in enumerate(best):
            used[key] = used.get(key, 0) + 1
    return out


def stratified(spark: SparkSession, n: int) -> DataFrame:
    """Combination of each of n samples: sample i takes the (i mod m)-th of the balanced order."""
    order = balanced_order(list(itertools.product(DOMAINS, TOPOLOGIES, MECHANISMS, REGIMES)))
    dim = spark.createDataFrame([(i, *c) for i, c in enumerate(order)], "ordinal long, domain string, topology string, mechanism_type string, primary_regime string")
    ids = spark.range(n).select("id", F.pmod("id", F.lit(len(order))).alias("ordinal"))
    return ids.join(F.broadcast(dim), "ordinal").select("id", F.format_string("stream_%06d", "id").alias("stream_id"), "domain", "topology", "mechanism_type", "primary_regime")


def select_known(rows: DataFrame, column: str, wanted: list[str], known: list[str]) -> DataFrame:
    unknown = [x for x in wanted if x not in known]
    if unknown:
        raise ValueError(f"unknown {column}: {', '.join(unknown)}")
    return rows.where(F.col(column).isin(*wanted))


def compatible_caps(combos: DataFrame, max_nodes: int = 30, max_depth: int = 6, max_children: int = 3, min_nodes: int = 6, max_length: int = 12, min_length: int = 4, max_events: int = 80) -> DataFrame:
    """The sizes that scenarios of a combination stay readable at; least sizes never exceed greatest ones."""
    tree, chain, rec = F.col("topology") == "tree", F.col("topology") == "chain", F.col("mechanism_type") == "recovery"
    n = F.when(tree & rec, min(max_nodes, ISSUE_CAPS["recovery_tree"][0])).when(tree, min(max_nodes, ISSUE_CAPS["tree"][0])).otherwise(max_nodes)
    k = F.when(chain & rec, min(max_length, ISSUE_CAPS["recovery_chain"])).when(chain, min(max_length, ISSUE_CAPS["chain"])).otherwise(max_length)
    e = F.when(rec, min(max_events, ISSUE_CAPS["recovery_events"])).otherwise(max_events)
    return combos.select(
        "domain", "topology", "mechanism_type", "primary_regime", n.alias("max_nodes"), F.when(tree, min(max_depth, 3)).otherwise(max_depth).alias("max_depth"), F.when(tree, min(max_children, 2)).otherwise(max_children).alias("max_children"),
        F.least(F.lit(min_nodes), n).alias("min_nodes"), k.alias("max_length"), F.least(F.lit(min_length), k).alias("min_length"), e.alias("max_events"),
    )


def relation_of(mechanism: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in RELATION_OF.items():
        out = F.when(mechanism == k, v).otherwise(out)
    return out


# ---- regimes


def weighted_choice(u: Column, weights: list[tuple[str, float]]) -> Column:
    """The first name whose cumulative weight reaches u times the total; the last one if rounding leaves none."""
    total = sum(w for _, w in weights)
    if total <= 0:
        raise ValueError("weights must sum to a positive value")
    out = F.lit(weights[-1][0])
    for i in range(len(weights) - 1, -1, -1):
        out = F.when(u * total <= sum(w for _, w in weights[: i + 1]), weights[i][0]).otherwise(out)
    return out


def select_regime(relation: Column, preferred: Column, u: Column) -> Column:
    """The preferred regime if the relation lists it, else a weighted choice among those it lists."""
    out = F.lit(None).cast("string")
    for k, w in REGIME_WEIGHTS.items():
        out = F.when(relation == k, F.when(preferred.isin(*[n for n, _ in w]), preferred).otherwise(weighted_choice(u, w))).otherwise(out)
    return out


def scale_factor(relation: Column, bursty: Column, depth: Column) -> Column:
    rel = F.lit(1.0)
    for k in ("delayed_trigger", "weak_trigger", "recovery"):
        rel = F.when(relation == k, ADJUST[k]).otherwise(rel)
    return F.when(bursty, ADJUST["bursty"]).otherwise(1.0) * F.when(depth > 0, 1.0 + ADJUST["depth"] * depth).otherwise(1.0) * rel


def adjust_params(regime: Column, params: Column, factor: Column) -> Column:
    """Rates are divided by the factor, scales multiplied, and mu moves by its logarithm."""
    return F.transform_values(params, lambda k, v: F.when((regime == "exponential") & (k == "lambda"), F.greatest(F.lit(1e-9), v / factor)).when(regime.isin("gamma", "weibull") & (k == "scale"), F.greatest(F.lit(1e-9), v * factor)).when((regime == "lognormal") & (k == "mu"), v + F.ln(F.greatest(factor, F.lit(1e-9)))).otherwise(v))


# ---- background


def background_arrivals(streams: DataFrame, end: Column, rate: float, most: int, seed: str = "bg") -> DataFrame:
    """A Poisson process on (0, end) for each stream, at most ``most`` events: running sums of exponential gaps."""
    draws = streams.select("stream_id", end.alias("end"), F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("i"))
    gap = exponential(uniform(F.lit(seed), F.col("stream_id"), F.col("i")), F.lit(rate))
    own = Window.partitionBy("stream_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    at = draws.withColumn("t", F.sum(gap).over(own)).where("t < end")
    kinds = F.array(*map(F.lit, DISTRACTORS))
    return at.select("stream_id", F.col("i").cast("bigint").alias("i"), F.round("t", 6).alias("t"), F.concat(F.lit("BG"), F.col("i").cast("string")).alias("event_type"), F.get(kinds, F.col("i") % 4).alias("distractor_type"))


def interleave_repair(events: DataFrame) -> DataFrame:
    """One background event half-way between root and first child, for each stream whose ids already are in time order.

    events: (stream_id, us, event_id, is_background)."""
    own = Window.partitionBy("stream_id").orderBy("us", "event_id")
    later = events.withColumn("fell", F.col("event_id") < F.lag("event_id").over(own))
    first = Window.partitionBy("stream_id", "is_background").orderBy("event_id")
    ranked = later.withColumn("k", F.row_number().over(first))
    s = ranked.groupBy("stream_id").agg(F.max(F.coalesce("fell", F.lit(False))).alias("fell"), F.max(F.when(~F.col("is_background") & (F.col("k") == 1), F.col("us"))).alias("a"), F.max(F.when(~F.col("is_background") & (F.col("k") == 2), F.col("us"))).alias("b"), F.count_if(F.col("is_background")).alias("n_bg"), F.max("event_id").alias("last"))
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("bigint")
    return s.where("not fell and b is not null").select("stream_id", F.when(mid <= F.col("a"), F.col("a") + 1).otherwise(mid).alias("us"), (F.col("last") + 1).alias("event_id"), F.concat(F.lit("BG"), F.col("n_bg").cast("string")).alias("event_type"))


def retry_first_success(attempts: DataFrame) -> DataFrame:
    """Of each stream's attempts the first that was approved. attempts: (stream_id, attempt, approved, ...)."""
    return attempts.where("approved").groupBy("stream_id").agg(F.min("attempt").alias("attempt"))


# ---- whole streams

OUT = "stream_id string, event_id long, timestamp double, abstract_type string, parent_id long, root_id long, relation_to_parent string, delta_t_from_parent double, regime string, is_background boolean, cascade_depth int, distractor_type string"


class Draws:
    """The same uniforms as functions.randomness.uniform, one after the other."""

    def __init__(self, *keys):
        self.head, self.i = "|".join(map(str, keys)), 0

    def u(self) -> float:
        self.i += 1
        return int(hashlib.md5(f"{self.head}|{self.i}".encode()).hexdigest()[:13], 16) / (1 << 52)

    def pick(self, weights: list[tuple]) -> object:
        at, total = self.u() * sum(w for _, w in weights), 0.0
        for x, w in weights:
            total += w
            if at <= total:
                return x
        return weights[-1][0]


def draw_delay(d: Draws, regime: str, p: dict) -> float:
    if regime == "deterministic_backoff":
        return p["value"]
    if regime == "exponential":
        return max(-math.log(1 - d.u()) / p["lambda"], 1e-9)
    if regime == "weibull":
        return max(p["scale"] * (-math.log(1 - d.u())) ** (1 / p["shape"]), 1e-9)
    normal = lambda: math.sqrt(-2 * math.log(max(d.u(), 1e-15))) * math.cos(2 * math.pi * d.u())
    if regime == "lognormal":
        return max(math.exp(p["mu"] + p["sigma"] * normal()), 1e-9)
    shape, boost = (p["shape"], 1.0) if p["shape"] >= 1 else (p["shape"] + 1, (1 - d.u()) ** (1 / p["shape"]))
    c = shape - 1 / 3
    while True:  # Marsaglia and Tsang's rejection
        z = normal()
        v = (1 + z / math.sqrt(9 * c)) ** 3
        if v > 0 and math.log(max(d.u(), 1e-300)) < z * z / 2 + c - c * v + c * math.log(v):
            return max(c * v * boost * p["scale"], 1e-9)


def one_stream(name: str, topology: str, mechanism: str, regime: str, seed: int, attempt: int, density: str, prior: dict | None) -> list[tuple]:
    """The events of one stream in time order. With a calibrated prior types and delays follow it, along the chain or from parent to child."""
    d, relation = Draws(seed, name, attempt), RELATION_OF[mechanism]
    parents, kinds = [-1], ["T0"]
    if prior:
        following = lambda kind: prior["first"].get(kind) or [(s, 1.0) for s in prior["first"]]
    if prior and topology != "tree":
        at, before = d.pick(prior["starts"]), None
        n, kinds = d.pick(prior["lengths"]), [at]
        while len(kinds) < max(2, n):
            before, at = at, d.pick(prior["second"].get((before, at)) or following(at))
            kinds.append(at)
        parents = [*range(-1, len(kinds) - 1)]
    elif topology == "chain":
        n = 4 + int(d.u() * 9)
        parents, kinds = [*range(-1, n - 1)], [f"T{i}" for i in range(n)]
    else:
        kinds = [d.pick(prior["starts"])] if prior else kinds
        n, depth, kids = 6 + int(d.u() * 25), [0], [0]
        while len(parents) < n:
            room = [i for i in range(len(parents)) if depth[i] < 6 and kids[i] < 3]
            if not room:
                break
            p = room[min(int(d.u() * len(room)), len(room) - 1)]
            kids[p] += 1
            parents.append(p)
            depth.append(depth[p] + 1)
            kids.append(0)
            kinds.append(d.pick(following(kinds[p])) if prior else f"T{len(parents) - 1}")
    deep = [0] * len(parents)
    for i, p in enumerate(parents[1:], 1):
        deep[i] = deep[p] + 1
    order = [0, *sorted(range(1, len(parents)), key=lambda i: (deep[parents[i]], f"E{parents[i]}", f"E{i}"))]
    ids = {node: k for k, node in enumerate(order)}
    time, rows = {0: 0.0}, [(name, 0, 0.0, kinds[0], None, 0, None, None, None, False, 0, None)]
    for node in order[1:]:
        p = parents[node]
        fit = prior and prior["fits"].get((kinds[p], kinds[node]))
        if fit:
            chosen, params = fit
        else:
            listed = REGIME_WEIGHTS[relation]
            chosen = regime if regime in dict(listed) else d.pick(listed)
            recent = sum(0 <= time[p] - t <= 2.0 for t in time.values())
            f = (ADJUST["bursty"] if recent >= 3 else 1.0) * (1 + ADJUST["depth"] * deep[p]) * ADJUST.get(relation, 1.0)
            params = dict(REGIME_PARAMS[chosen])
            if chosen == "exponential":
                params["lambda"] = max(1e-9, params["lambda"] / f)
            elif chosen == "lognormal":
                params["mu"] += math.log(f)
            else:
                params["scale"] = max(1e-9, params["scale"] * f)
        delay = round(draw_delay(d, chosen, params), 9)
        time[node] = round(time[p] + delay, 9)
        rows.append((name, ids[node], time[node], kinds[node], ids[p], 0, relation, delay, chosen, False, deep[node], None))
    rate, t, end, back = BACKGROUND_RATES.get(density, 0.0), 0.0, max(max(time.values()) + 3.0, 10.0), []
    while rate > 0 and len(back) < min(60, 80 - len(rows)):
        t += -math.log(1 - d.u()) / rate
        if t >= end:
            break
        back.append(round(t, 9))
    def row(i: int, at: float, kind: str) -> tuple:
        return name, len(ids) + i, at, f"BG{i}", None, None, None, None, "exponential", True, 0, kind
    out = rows + [row(i, at, DISTRACTORS[i % 4]) for i, at in enumerate(back)]
    out.sort(key=lambda r: (r[2], r[1]))
    if rate > 0 and len(back) < 60 and [r[1] for r in out] == sorted(r[1] for r in out):
        mid = round((rows[0][2] + rows[1][2]) / 2, 9)
        out.append(row(len(back), mid if mid > rows[0][2] else rows[0][2] + 1e-6, DISTRACTORS[0]))
        out.sort(key=lambda r: (r[2], r[1]))
    return out


def simulate(samples: DataFrame, seed: int = 42, attempt: int = 0, density: str = "medium", prior: dict | None = None) -> DataFrame:
    """Events of a stream for each row of samples (stream_id, topology, mechanism_type, primary_regime). Streams are small (at most 80
    events beside calibrated chains), so a batch of them is a bounded piece of work."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in OUT.split(", ")]
        for pdf in batches:
            rows = [r for x in pdf.itertuples() for r in one_stream(x.stream_id, x.topology, x.mechanism_type, x.primary_regime, seed, attempt, density, prior)]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"parent_id": "Int64", "root_id": "Int64", "cascade_depth": "int32"})

    return samples.select("stream_id", "topology", "mechanism_type", "primary_regime").mapInPandas(run, OUT)


def load_prior(events: DataFrame, min_samples: int = 20, alpha: float = 0.01, temperature: float = 1.0, max_rows: int = 1 << 20) -> dict:
    """A calibrated prior for the kernel: tables over event types, held by the driver and sent to every task. They grow with the vocabulary of
    types, not with the events; a vocabulary that would take more than ``max_rows`` rows is refused."""
    from .fitting import calibrate
    from .transitions import second_order_probs, sequence_length_hist, smoothed_weights, start_events, transition_probs

    probs = transition_probs(events)
    n_types, n_triples = probs.select("source").distinct().count(), second_order_probs(events).count()
    if max(n_types**2, n_triples) > max_rows:
        raise ValueError(f"a prior of {n_types} types and {n_triples} triples is more than {max_rows} rows; merge rare types first")
    first: dict = {}
    for r in smoothed_weights(probs, alpha, temperature).where("weight > 0").orderBy("source", "target").collect():
        first.setdefault(r["source"], []).append((r["target"], r["weight"]))
    second: dict = {}
    for r in second_order_probs(events).orderBy("a", "b", "c").collect():
        second.setdefault((r["a"], r["b"]), []).append((r["c"], r["probability"]))
    fits = {(r["source"], r["target"]): (r["regime"], {k: v for k, v in ((r["p1_name"], r["p1"]), (r["p2_name"], r["p2"])) if k}) for r in calibrate(events, min_samples).collect() if r["regime"] != "generic_backoff"}
    return {"first": first, "second": second, "fits": fits, "starts": [(r["event_type"], float(r["weight"])) for r in start_events(events).orderBy("event_type").collect()], "lengths": [(int(r["length"]), float(r["n"])) for r in sequence_length_hist(events).orderBy("length").collect()]}
