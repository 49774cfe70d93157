"""The operators bound to the driver's tables, each with the SQL that gives the same rows.

E is the events table (stream = user), O the orders table (stream = customer; it has ties), C conversations. G reads E as generated
streams: type "error" is background, the other events form chains of five, each caused by the one before; a few rows are
spoilt by rule, so that the validators find something.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import randomness as R
from ..functions import text as T
from ..operators import distances as D
from ..operators import fitting, graph, qa, quality, simulate, transitions as X, validate as V
from ..sources import tables as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql.strip()
        return f

    return add


# ---- bindings

E_SQL = "e AS (SELECT user_id AS stream_id, epoch_us(ts) AS us, event_type FROM events)"
O_SQL = "e AS (SELECT o_custkey AS stream_id, epoch_us(o_orderdate) AS us, o_orderpriority AS event_type FROM orders)"
STEPS_SQL = """x AS (SELECT stream_id, us, event_type AS a, lead(event_type) OVER w AS b, lead(event_type, 2) OVER w AS c, lead(us) OVER w - us AS ab, lead(us, 2) OVER w - lead(us) OVER w AS bc
  FROM e WINDOW w AS (PARTITION BY stream_id ORDER BY us, event_type))"""
GAPS_SQL = f"{E_SQL}, {STEPS_SQL}, g AS (SELECT a AS source, b AS target, ab / 1e6 AS d FROM x WHERE ab > 0)"


def G(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.events(spark, sf_dir)
    own = Window.partitionBy("stream_id").orderBy("us", "event_type")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumns({"pos": (F.row_number().over(own) - 1).cast("bigint"), "is_background": F.col("event_type") == "error"})
    e = e.withColumn("ci", F.sum((~F.col("is_background")).cast("int")).over(upto) - 1)
    chain = Window.partitionBy("stream_id", "is_background").orderBy("pos")
    episode = Window.partitionBy("stream_id", "is_background", F.floor(F.col("ci") / 5)).orderBy("pos")
    causal = ~F.col("is_background")
    depth = F.when(causal, F.col("ci") % 5).otherwise(0).cast("int")
    e = e.withColumns({"depth": depth, "prev_pos": F.lag("pos").over(chain), "prev_us": F.lag("us").over(chain), "first_pos": F.first("pos").over(episode)})
    parented = causal & (F.col("depth") > 0)
    relation = F.when(F.col("event_type") == "click", "direct_trigger").when(F.col("event_type") == "view", "delayed_trigger").when(F.col("event_type") == "purchase", "weak_trigger").otherwise("recovery")
    return e.select(
        "stream_id", "pos", F.col("pos").alias("event_id"), "us", "event_type", "is_background", "depth",
        F.when(parented, F.when(F.col("pos") % 83 == 82, F.lit(-1).cast("bigint")).otherwise(F.col("prev_pos"))).alias("parent_id"),
        F.when(causal, F.col("first_pos") + F.when(F.col("pos") % 89 == 88, 1).otherwise(0)).alias("root_id"),
        F.when(parented, F.when(F.col("pos") % 101 == 100, "unknown").otherwise(relation)).alias("relation"),
        F.when(parented, F.col("us") - F.col("prev_us") + F.when(F.col("pos") % 97 == 96, 1000000).otherwise(0)).alias("delta_us"),
        F.when(causal, F.concat(F.lit("E"), F.col("ci").cast("string"))).alias("node_id"),
    )


G_SQL = """e0 AS (SELECT user_id AS stream_id, epoch_us(ts) AS us, event_type, event_type = 'error' AS is_background, row_number() OVER w - 1 AS pos, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER w - 1 AS ci
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts), event_type ROWS UNBOUNDED PRECEDING)),
e1 AS (SELECT *, CASE WHEN is_background THEN 0 ELSE (ci % 5)::INT END AS depth, lag(pos) OVER c AS prev_pos, lag(us) OVER c AS prev_us, first_value(pos) OVER (PARTITION BY stream_id, is_background, floor(ci / 5) ORDER BY pos) AS first_pos
  FROM e0 WINDOW c AS (PARTITION BY stream_id, is_background ORDER BY pos)),
g AS (SELECT stream_id, pos, pos AS event_id, us, event_type, is_background, depth,
  CASE WHEN NOT is_background AND depth > 0 THEN CASE WHEN pos % 83 = 82 THEN -1 ELSE prev_pos END END AS parent_id,
  CASE WHEN NOT is_background THEN first_pos + CASE WHEN pos % 89 = 88 THEN 1 ELSE 0 END END AS root_id,
  CASE WHEN NOT is_background AND depth > 0 THEN CASE WHEN pos % 101 = 100 THEN 'unknown' WHEN event_type = 'click' THEN 'direct_trigger' WHEN event_type = 'view' THEN 'delayed_trigger' WHEN event_type = 'purchase' THEN 'weak_trigger' ELSE 'recovery' END END AS relation,
  CASE WHEN NOT is_background AND depth > 0 THEN us - prev_us + CASE WHEN pos % 97 = 96 THEN 1000000 ELSE 0 END END AS delta_us,
  CASE WHEN NOT is_background THEN 'E' || ci::BIGINT END AS node_id FROM e1),
j AS (SELECT g.*, p.us AS p_us, p.is_background AS p_background, p.parent_id AS p_parent, p.root_id AS p_root, p.depth AS p_depth FROM g LEFT JOIN g p ON g.stream_id = p.stream_id AND g.parent_id = p.event_id)"""
TREE_SQL = f"""{G_SQL}, t AS (SELECT stream_id, event_id, parent_id, root_id AS claimed FROM g WHERE NOT is_background),
r AS (SELECT stream_id, event_id, parent_id, event_id AS root_id, event_id::VARCHAR AS path, 0 AS depth FROM t WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.stream_id = t.stream_id AND u.event_id = t.parent_id)
  UNION ALL SELECT t.stream_id, t.event_id, t.parent_id, r.root_id, r.path || ',' || t.event_id, r.depth + 1 FROM r JOIN t ON t.stream_id = r.stream_id AND t.parent_id = r.event_id)"""
TREE_WITH = "WITH RECURSIVE " + TREE_SQL


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.get(F.array(F.lit("real"), F.lit("generic"), F.lit("calibrated")), (F.col("stream_id") % 3).cast("int"))
    return S.events(spark, sf_dir).withColumn("population", p)


P_SQL = f"{E_SQL}, p AS (SELECT *, ['real', 'generic', 'calibrated'][stream_id % 3 + 1] AS population FROM e), y AS (SELECT population, stream_id, event_type AS a, lead(event_type) OVER w AS b, lead(us) OVER w - us AS ab FROM p WINDOW w AS (PARTITION BY population, stream_id ORDER BY us, event_type))"


def ks_sql(values: str, left: str, right: str, tag: str) -> str:
    return f"""v{tag} AS (SELECT x, (population = '{left}')::INT AS l FROM ({values}) WHERE population IN ('{left}', '{right}')), n{tag} AS (SELECT sum(l) nl, sum(1 - l) nr FROM v{tag}), g{tag} AS (SELECT x, sum(l) a, sum(1 - l) b FROM v{tag} GROUP BY x),
k{tag} AS (SELECT x, lead(x) OVER (ORDER BY x) nx, sum(a) OVER (ORDER BY x) ca, sum(b) OVER (ORDER BY x) cb FROM g{tag}),
d{tag} AS (SELECT round(coalesce(max(abs(ca::DOUBLE / nl - cb::DOUBLE / nr)), 0), 6) AS ks, round(coalesce(sum(abs(ca::DOUBLE / nl - cb::DOUBLE / nr) * (nx - x)), 0), 6) AS wasserstein FROM k{tag}, n{tag})"""


def l1_sql(values: str, key: str, left: str, right: str, tag: str) -> str:
    return f"""c{tag} AS (SELECT {key}, sum((population = '{left}')::INT)::DOUBLE fl, sum((population = '{right}')::INT)::DOUBLE fr FROM ({values}) WHERE population IN ('{left}', '{right}') GROUP BY {key}),
d{tag} AS (SELECT round(sum(abs(fl / (SELECT sum(fl) FROM c{tag}) - fr / (SELECT sum(fr) FROM c{tag}))), 6) AS l1 FROM c{tag})"""


GAPS_P = "SELECT population, ab / 1e6 AS x FROM y WHERE ab > 0"
SIZES_P = "SELECT population, count(*)::DOUBLE AS x FROM p GROUP BY population, stream_id"
PAIRS_P = "SELECT population, a, b FROM y WHERE b IS NOT NULL"


def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").withColumn("ws", F.split("text", " "))
    short = F.array_join(F.slice("ws", F.lit(1), (1 + F.col("turn") % 5).cast("int")), " ")
    rel = F.array_join(F.slice("ws", F.lit(1), (3 + F.col("turn") % 4).cast("int")), " ")
    pick = lambda role, col: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("turn", col.alias("s"))))), lambda x: x["s"])
    g = c.groupBy(F.col("conv_id").alias("stream_id")).agg(pick("user", short).alias("phrases"), pick("assistant", rel).alias("relations"), F.min_by("text", "turn").alias("first"))
    domains = F.array(*map(F.lit, simulate.DOMAINS))
    return g.select("stream_id", F.get(domains, (F.col("stream_id") % 10).cast("int")).alias("domain"), F.when(F.col("stream_id") % 2 == 0, "chain").otherwise("tree").alias("topology"), F.array_join(F.slice(F.split("first", " "), F.lit(1), (4 + F.col("stream_id") % 4).cast("int")), " ").alias("description"), F.transform("phrases", F.trim).alias("phrases"), F.transform("relations", F.trim).alias("relations"),
                    F.when(F.col("stream_id") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(F.get(F.array(*map(F.lit, simulate.REGIMES)), (F.col("stream_id") % 4).cast("int")), F.get(F.array(*map(F.lit, simulate.REGIMES)), (F.col("stream_id") % 3).cast("int")))).alias("regimes"))


_WC = "len(regexp_extract_all({}, '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?'))"
_NORM = r"regexp_replace(lower(trim({})), '\s+', ' ', 'g')"
_DOMAINS = "[" + ", ".join(f"'{d}'" for d in simulate.DOMAINS) + "]"
_REGIMES = "['exponential', 'gamma', 'lognormal', 'weibull']"
SCEN_SQL = rf"""s0 AS (SELECT conv_id AS stream_id, list(trim(array_to_string(string_split(text, ' ')[1:1 + turn % 5], ' ')) ORDER BY turn) FILTER (WHERE role = 'user') AS phrases,
  list(trim(array_to_string(string_split(text, ' ')[1:3 + turn % 4], ' ')) ORDER BY turn) FILTER (WHERE role = 'assistant') AS relations, arg_min(text, turn) AS first FROM conversations GROUP BY conv_id),
s AS (SELECT stream_id, {_DOMAINS}[stream_id % 10 + 1] AS domain, CASE WHEN stream_id % 2 = 0 THEN 'chain' ELSE 'tree' END AS topology, array_to_string(string_split(first, ' ')[1:4 + stream_id % 4], ' ') AS description, coalesce(phrases, []) AS phrases, coalesce(relations, []) AS relations,
  CASE WHEN stream_id % 7 = 0 THEN [] ELSE [{_REGIMES}[stream_id % 4 + 1], {_REGIMES}[stream_id % 3 + 1]] END AS regimes FROM s0),
m AS (SELECT *, len(list_filter(phrases, lambda p: {_WC.format('p')} < 3)) AS short,
  len(list_filter(phrases, lambda p: {_NORM.format('p')} <> '')) - len(list_distinct(list_filter(list_transform(phrases, lambda p: {_NORM.format('p')}), lambda p: p <> ''))) AS duplicate,
  len(list_filter(phrases, lambda p: len(regexp_extract_all(p, '[A-Za-z]+')) > 0 AND len(list_filter(regexp_extract_all(lower(p), '[A-Za-z]+'), lambda w: w NOT IN ('event','update','issue','problem','alert','incident','thing','something','state'))) = 0)) AS generic,
  len(list_filter(relations, lambda r: {_WC.format('r')} < 5 OR {_NORM.format('r')} IN ('related','causes','a causes b','triggered','leads to'))) AS weak, {_WC.format('description')} AS description_words FROM s),
q AS (SELECT *, greatest(round(1 - (short * 0.12::DOUBLE + duplicate * 0.18::DOUBLE + generic * 0.1::DOUBLE + weak * 0.12::DOUBLE + (description_words < 6)::INT * 0.1::DOUBLE), 6), 0.0::DOUBLE) AS score,
  list_filter([CASE WHEN short > 0 THEN 'event mapping contains short phrases' END, CASE WHEN duplicate > 0 THEN 'event mapping contains duplicate phrases' END, CASE WHEN generic > 0 THEN 'event mapping contains generic phrases' END,
   CASE WHEN weak > 0 THEN 'relation explanations are too short or generic' END, CASE WHEN description_words < 6 THEN 'scenario description is too short' END], lambda x: x IS NOT NULL) AS issues FROM m),
z AS (SELECT *, score >= 0.7 AND len(issues) = 0 AS approved FROM q)"""
SUMMARY_SQL = "count(*) AS sample_count, sum(approved::INT)::BIGINT AS approved_count, round(avg(score), 6) AS average_score, min(score) AS min_score, max(score) AS max_score"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(scenarios(spark, sf_dir))


# ---- scans, projections, limits


@query("SELECT user_id AS stream_id, epoch_us(ts) AS us, event_type FROM events")
def scan_events(spark, d):
    return S.events(spark, d)


@query("SELECT count(DISTINCT user_id) AS stream_count, count(*) AS event_count FROM events WHERE coalesce(trim(event_type), '') <> ''")
def adapter_standard(spark, d):
    e = S.events(spark, d).where("coalesce(trim(event_type), '') <> ''")
    return e.agg(F.count_distinct("stream_id").alias("stream_count"), F.count(F.lit(1)).alias("event_count"))


@query("SELECT doc_id, n FROM (SELECT event_id AS doc_id, len(list_filter(string_split(regexp_replace(props, '[{}\"]', '', 'g'), ','), lambda x: trim(x) <> '')) AS n FROM events)")
def parse_list(spark, d):
    p = spark.read.parquet(f"{d}/events.parquet")
    return p.select(F.col("event_id").alias("doc_id"), F.size(S.parse_list(F.concat(F.lit("["), F.regexp_replace("props", r"[{}]", ""), F.lit("]")))).cast("bigint").alias("n"))


def traces(spark, d):
    e = S.orders(spark, d)
    own = F.transform(F.array_sort(F.collect_list(F.struct("us", "event_type"))), lambda x: x)
    t = e.groupBy("stream_id").agg(own.alias("l"))
    types = F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["event_type"]), ","), F.lit("]"))
    gaps = F.concat(F.lit("["), F.array_join(F.transform("l", lambda x, i: ((x["us"] - F.get("l", F.greatest(i - 1, F.lit(0)))["us"]) / F.lit(1000000)).cast("bigint").cast("string")), ","), F.lit("]"))
    return t.select(F.col("stream_id").cast("string").alias("s"), types.alias("t"), gaps.alias("i"))


@query(f"""WITH {O_SQL}, x AS (SELECT stream_id, us, event_type, row_number() OVER w - 1 AS pos, (us - coalesce(lag(us) OVER w, us)) // 1000000 AS gap FROM e WINDOW w AS (PARTITION BY stream_id ORDER BY us, event_type))
SELECT stream_id::VARCHAR AS stream_id, pos, (sum(gap) OVER (PARTITION BY stream_id ORDER BY pos))::DOUBLE AS timestamp, event_type FROM x""")
def adapter_traces(spark, d):
    return S.explode_traces(traces(spark, d), "s", "t", "i").withColumn("pos", F.col("pos").cast("bigint"))


@query(f"WITH {E_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY us, event_type) - 1 AS n FROM e) SELECT stream_id, n, us + n AS us, event_type FROM k WHERE n < 10")
def topk_per_stream(spark, d):
    own = Window.partitionBy("stream_id").orderBy("us", "event_type")
    k = S.events(spark, d).withColumn("n", (F.row_number().over(own) - 1).cast("bigint")).where("n < 10")
    return k.select("stream_id", "n", (F.col("us") + F.col("n")).alias("us"), "event_type")


@query(f"WITH {O_SQL} SELECT stream_id, count(*) AS n FROM e GROUP BY stream_id HAVING count(*) >= 12")
def streams_min_events(spark, d):
    return S.keep_streams(S.orders(spark, d), 12).groupBy("stream_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {G_SQL} SELECT stream_id, event_id, event_type FROM g WHERE NOT is_background")
def causal_only(spark, d):
    return G(spark, d).where("not is_background").select("stream_id", "event_id", "event_type")


@query(f"WITH {G_SQL} SELECT stream_id, us, event_type FROM g WHERE NOT is_background")
def explode_causal(spark, d):
    nested = G(spark, d).groupBy("stream_id").agg(F.collect_list(F.struct("us", "event_type", "is_background")).alias("events"))
    return nested.select("stream_id", F.explode("events").alias("e")).where("not e.is_background").select("stream_id", "e.us", "e.event_type")


# ---- calibration


@query(f"WITH {E_SQL} SELECT event_type, count(*) AS n FROM e GROUP BY event_type")
def event_frequencies(spark, d):
    return X.event_frequencies(S.events(spark, d))


@query(f"WITH {E_SQL}, {STEPS_SQL} SELECT stream_id, us, a, b, ab FROM x WHERE b IS NOT NULL")
def inter_event_times(spark, d):
    return X.steps(S.events(spark, d)).where("b is not null").select("stream_id", "us", "a", "b", "ab")


@query(f"WITH {O_SQL}, {STEPS_SQL} SELECT a AS source, b AS target, count(*) AS n FROM x WHERE ab > 0 GROUP BY a, b")
def transition_counts(spark, d):
    return X.positive(X.steps(S.orders(spark, d))).groupBy(F.col("a").alias("source"), F.col("b").alias("target")).agg(F.count(F.lit(1)).alias("n"))


PROBS_SQL = "SELECT a AS source, b AS target, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY a), 9) AS probability FROM x WHERE ab > 0 GROUP BY a, b"


@query(f"WITH {E_SQL}, {STEPS_SQL} {PROBS_SQL}")
def transition_probs(spark, d):
    return X.transition_probs(S.events(spark, d))


@query(f"WITH {O_SQL}, {STEPS_SQL} SELECT a, b, c, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY a, b), 9) AS probability FROM x WHERE ab > 0 AND bc > 0 GROUP BY a, b, c")
def second_order_probs(spark, d):
    return X.second_order_probs(S.orders(spark, d))


@query(f"WITH {E_SQL} SELECT l::VARCHAR AS length, count(*) AS n FROM (SELECT count(*) AS l FROM e GROUP BY stream_id) GROUP BY l")
def sequence_length_hist(spark, d):
    return X.sequence_length_hist(S.events(spark, d))


@query(f"WITH {GAPS_SQL} SELECT source, target, grouping_id(source, target)::INT AS level, count(*) AS n, round(min(d), 6) AS min_delta, round(avg(d), 6) AS mean_delta, round(max(d), 6) AS max_delta FROM g GROUP BY GROUPING SETS ((source, target), (source), ())")
def delta_summary_levels(spark, d):
    return X.delta_summary_levels(S.events(spark, d))


@query(f"WITH {GAPS_SQL} SELECT count(*) AS n, round(min(d), 6) AS min_delta, round(quantile_cont(d, 0.05), 6) AS p05, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95, round(max(d), 6) AS max_delta, round(avg(d), 6) AS mean_delta FROM g")
def delta_profile(spark, d):
    return X.delta_profile(S.events(spark, d))


@query(f"WITH {GAPS_SQL} SELECT source, target, count(*) AS n, round(1 / avg(d), 6) AS rate, round(avg(ln(d)), 6) AS mu, round(stddev_pop(ln(d)), 6) AS sigma FROM g GROUP BY source, target HAVING count(*) >= 20")
def fit_exponential_lognormal(spark, d):
    gaps = X.positive(X.steps(S.events(spark, d))).select(F.col("a").alias("source"), F.col("b").alias("target"), X.seconds(F.col("ab")).alias("d"))
    return fitting.closed_form(gaps, ["source", "target"])


@query()
def fit_regimes(spark, d):
    return fitting.calibrate(S.events(spark, d))


@query(f"""WITH {GAPS_SQL}, t AS (SELECT source, target, count(*) AS n FROM g GROUP BY source, target)
SELECT source, target, n, CASE WHEN n >= 400 THEN 'transition' WHEN sum(n) OVER (PARTITION BY source) >= 400 THEN 'event_type' WHEN sum(n) OVER () >= 400 THEN 'domain' ELSE 'generic' END AS backoff_source FROM t""")
def backoff_source(spark, d):
    return fitting.backoff_levels(S.events(spark, d), 400)


@query(f"""WITH {E_SQL}, {STEPS_SQL}, t AS ({PROBS_SQL}) SELECT event_type, n AS weight FROM (SELECT event_type, count(*) AS n FROM e GROUP BY event_type)
WHERE event_type IN (SELECT source FROM t) AND (event_type NOT IN (SELECT target FROM t) OR NOT EXISTS (SELECT 1 FROM t WHERE source NOT IN (SELECT target FROM t)))""")
def start_events(spark, d):
    return X.start_events(S.events(spark, d))


@query(f"""WITH {E_SQL}, {STEPS_SQL}, t AS ({PROBS_SQL}), k AS (SELECT DISTINCT source FROM t), gr AS (SELECT a.source, b.source AS target FROM k a, k b)
SELECT coalesce(gr.source, t.source) AS source, coalesce(gr.target, t.target) AS target, round(pow(coalesce(probability, 0) + CASE WHEN gr.source IS NULL THEN 0 ELSE 0.01::DOUBLE END, 1 / 0.5::DOUBLE), 9) AS weight FROM gr FULL JOIN t ON gr.source = t.source AND gr.target = t.target""")
def smoothed_weights(spark, d):
    return X.smoothed_weights(X.transition_probs(S.events(spark, d)), 0.01, 0.5)


@query(f"""WITH {E_SQL} SELECT stream_id, us, event_type, lag(event_type) OVER w AS previous, lag(event_type, 2) OVER w AS before_previous, count(*) OVER r AS recent,
count(*) OVER (PARTITION BY stream_id, event_type ORDER BY us RANGE BETWEEN 7200000000 PRECEDING AND CURRENT ROW) AS recent_same, count(*) OVER r >= 3 AS is_bursty, round((us - min(us) OVER (PARTITION BY stream_id)) / 1e6, 6) AS since_root
FROM e WINDOW w AS (PARTITION BY stream_id ORDER BY us, event_type), r AS (PARTITION BY stream_id ORDER BY us RANGE BETWEEN 7200000000 PRECEDING AND CURRENT ROW)""")
def history_state(spark, d):
    return X.history_state(S.events(spark, d), 7_200_000_000)


@query(f"WITH {O_SQL}, k AS (SELECT stream_id, us - lag(us) OVER (PARTITION BY stream_id ORDER BY us, event_type) AS gap FROM e) SELECT stream_id, coalesce(min(gap), -1) AS min_gap_us, count(*) AS n FROM k GROUP BY stream_id")
def min_gap(spark, d):
    return X.min_gaps(S.orders(spark, d)).fillna(-1, ["min_gap_us"])  # a single event has no gap


@query(f"WITH {G_SQL} SELECT stream_id, round(avg(is_background::INT), 6) AS background_ratio FROM g GROUP BY stream_id")
def background_ratio(spark, d):
    return X.background_ratio(G(spark, d), F.col("is_background"))


# ---- evaluation


@query(f"WITH {P_SQL}, {ks_sql(GAPS_P, 'generic', 'real', '1')} SELECT * FROM d1")
def ks_wasserstein_inter_event(spark, d):
    return D.ks_wasserstein(D.summaries(populations(spark, d)).where("ab > 0").select("population", X.seconds(F.col("ab")).alias("x")), "generic", "real")


@query(f"WITH {P_SQL}, {ks_sql(SIZES_P, 'generic', 'real', '1')} SELECT * FROM d1")
def ks_wasserstein_sequence_length(spark, d):
    sizes = populations(spark, d).groupBy("population", "stream_id").agg(F.count(F.lit(1)).cast("double").alias("x"))
    return D.ks_wasserstein(sizes.select("population", "x"), "generic", "real")


@query(f"WITH {P_SQL}, {l1_sql('SELECT * FROM p', 'event_type', 'generic', 'real', '1')} SELECT l1 FROM d1")
def l1_event_type(spark, d):
    return D.l1(populations(spark, d), ["event_type"], "generic", "real")


@query(f"WITH {P_SQL}, {l1_sql(PAIRS_P, 'a, b', 'generic', 'real', '1')} SELECT l1 FROM d1")
def l1_transition(spark, d):
    return D.l1(D.summaries(populations(spark, d)).where("b is not null"), ["a", "b"], "generic", "real")


@query(f"WITH {P_SQL}, c AS (SELECT population, stream_id, event_type, count(*) AS n FROM p GROUP BY ALL), s AS (SELECT population, stream_id, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::DOUBLE / sum(n) AS r FROM c GROUP BY ALL) SELECT population, round(avg(r), 6) AS repeated_ratio FROM s GROUP BY population")
def repeated_ratio(spark, d):
    return D.repeated_ratio(populations(spark, d))


@query(f"WITH {P_SQL} SELECT population, round(CASE WHEN count(*) < 2 OR stddev_pop(ab / 1e6) + avg(ab / 1e6) = 0 THEN 0 ELSE (stddev_pop(ab / 1e6) - avg(ab / 1e6)) / (stddev_pop(ab / 1e6) + avg(ab / 1e6)) END, 6) AS burstiness FROM y WHERE ab > 0 GROUP BY population")
def burstiness(spark, d):
    return D.burstiness(populations(spark, d))


def _report_sql() -> str:
    ctes, rows = [], []
    for i, other in enumerate(("generic", "calibrated")):
        for k, (metric, values) in enumerate((("inter_event_time", GAPS_P), ("sequence_length", SIZES_P))):
            ctes.append(ks_sql(values, other, "real", f"{i}{k}"))
            rows += [f"SELECT '{metric}_{m}' AS metric, '{other}_vs_real' AS comparison, {m} AS value FROM d{i}{k}" for m in ("ks", "wasserstein")]
        ctes += [l1_sql("SELECT * FROM p", "event_type", other, "real", f"{i}8"), l1_sql(PAIRS_P, "a, b", other, "real", f"{i}9")]
        rows += [f"SELECT 'event_type_frequency_l1' AS metric, '{other}_vs_real' AS comparison, l1 AS value FROM d{i}8", f"SELECT 'transition_frequency_l1' AS metric, '{other}_vs_real' AS comparison, l1 AS value FROM d{i}9"]
    return f"WITH {P_SQL}, {', '.join(ctes)}, rep AS ({' UNION ALL '.join(rows)})"


@query(_report_sql() + " SELECT * FROM rep")
def comparison_report(spark, d):
    return D.comparison_report(populations(spark, d))


@query(_report_sql() + """, w AS (SELECT metric, max(value) FILTER (WHERE comparison = 'generic_vs_real') AS g, max(value) FILTER (WHERE comparison = 'calibrated_vs_real') AS c FROM rep GROUP BY metric)
SELECT metric, round(g - c, 6) AS absolute, round(CASE WHEN g = 0 THEN 0 ELSE (g - c) / g END, 5) AS relative, c < g AS improved FROM w""")
def calibration_effect(spark, d):
    return D.calibration_effect(D.comparison_report(populations(spark, d)))


# ---- validation


@query(f"WITH {G_SQL} SELECT stream_id, event_id, coalesce(p_us, -1) AS p_us, coalesce(p_root, -1) AS p_root FROM j WHERE parent_id IS NOT NULL")
def parent_join(spark, d):
    return V.parent_join(G(spark, d)).where("parent_id is not null").select("stream_id", "event_id", "p_us", "p_root").fillna(-1)


FOUND = "NOT is_background AND parent_id IS NOT NULL AND p_us IS NOT NULL"


@query(f"""WITH {G_SQL}, k AS (SELECT stream_id, event_id, unnest(list_filter([
 CASE WHEN us < 0 THEN 'invalid timestamp' END, CASE WHEN relation NOT IN ('direct_trigger','delayed_trigger','weak_trigger','recovery') THEN 'invalid relation type' END,
 CASE WHEN is_background AND (parent_id IS NOT NULL OR root_id IS NOT NULL) THEN 'background event has causal ids' END,
 CASE WHEN NOT is_background AND parent_id IS NULL AND root_id IS DISTINCT FROM event_id THEN 'incorrect root_id' END, CASE WHEN NOT is_background AND parent_id IS NULL AND depth <> 0 THEN 'nonzero cascade depth' END,
 CASE WHEN NOT is_background AND parent_id IS NOT NULL AND p_us IS NULL THEN 'missing parent' END, CASE WHEN {FOUND} AND p_background THEN 'uses background event as parent' END, CASE WHEN {FOUND} AND us <= p_us THEN 'not later than parent' END,
 CASE WHEN {FOUND} AND root_id IS DISTINCT FROM (CASE WHEN p_parent IS NOT NULL THEN p_root ELSE parent_id END) THEN 'incorrect root_id' END, CASE WHEN {FOUND} AND depth <> p_depth + 1 THEN 'incorrect cascade depth' END], lambda x: x IS NOT NULL)) AS error FROM j) SELECT * FROM k""")
def structural_errors(spark, d):
    return V.structural_errors(G(spark, d))


@query(f"""WITH {G_SQL}, k AS (SELECT stream_id, event_id, unnest(list_filter([CASE WHEN NOT coalesce(delta_us > 0, false) THEN 'non-positive delta_t' END, CASE WHEN delta_us > 0 AND abs(us - p_us - delta_us) > 1 THEN 'delta_t mismatch' END,
 CASE WHEN delta_us > 1000000000000 THEN 'extreme delta_t' END], lambda x: x IS NOT NULL)) AS error FROM j WHERE NOT is_background AND p_us IS NOT NULL) SELECT * FROM k""")
def temporal_errors(spark, d):
    return V.temporal_errors(G(spark, d))


METRICS_SQL = """SELECT stream_id, count(*) AS event_count, sum((NOT is_background)::INT)::BIGINT AS causal_event_count, sum(is_background::INT)::BIGINT AS background_event_count, round(avg(is_background::INT), 6) AS background_ratio,
 round(coalesce(avg(d), 0), 6) AS delta_mean, round(coalesce(min(d), 0), 6) AS delta_min, round(coalesce(max(d), 0), 6) AS delta_max FROM (SELECT *, CASE WHEN NOT is_background AND p_us IS NOT NULL AND delta_us > 0 THEN delta_us / 1e6 END AS d FROM j) GROUP BY stream_id"""


@query(f"WITH {G_SQL} {METRICS_SQL}")
def temporal_metrics(spark, d):
    return V.temporal_metrics(G(spark, d))


@query(f"""WITH {G_SQL}, mt AS ({METRICS_SQL}), mg AS (SELECT stream_id, min(gap) AS gap FROM (SELECT stream_id, us - lag(us) OVER (PARTITION BY stream_id ORDER BY us, event_type) AS gap FROM g) GROUP BY stream_id)
SELECT stream_id, unnest(list_filter([CASE WHEN gap < 1000000 THEN 'sequence is too dense' END, CASE WHEN event_count < 60 OR event_count > 70 THEN 'event count outside configured range' END, CASE WHEN background_ratio < 0.15 OR background_ratio > 0.25 THEN 'background ratio outside configured range' END], lambda x: x IS NOT NULL)) AS error FROM mt JOIN mg USING (stream_id)""")
def stream_errors(spark, d):
    g = G(spark, d)
    return V.stream_errors(V.temporal_metrics(g), X.min_gaps(g), 60, 70, (0.15, 0.25), 1_000_000)


NODES_SQL = "nd AS (SELECT stream_id, node_id FROM g WHERE node_id IS NOT NULL), ed AS (SELECT stream_id, parent_id AS source, event_id AS target FROM g WHERE parent_id IS NOT NULL)"


def nodes(g: DataFrame) -> DataFrame:
    return g.where("node_id is not null").select("stream_id", "node_id")


def edges(g: DataFrame) -> DataFrame:
    return g.where("parent_id is not null").select("stream_id", F.col("parent_id").alias("source"), F.col("event_id").alias("target"))


@query(f"WITH {G_SQL}, {NODES_SQL} SELECT * FROM nd EXCEPT SELECT stream_id, node_id FROM g WHERE pos % 7 <> 0")
def nodes_without_event(spark, d):
    g = G(spark, d)
    return V.nodes_without_event(nodes(g), g.where("pos % 7 <> 0").where("node_id is not null"))


@query(f"""WITH {G_SQL}, {NODES_SQL}, k AS (SELECT stream_id, event_id AS node FROM g WHERE pos % 50 <> 49) SELECT stream_id, source, target, 'source' AS missing FROM ed WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.stream_id = ed.stream_id AND node = source)
UNION ALL SELECT stream_id, source, target, 'target' FROM ed WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.stream_id = ed.stream_id AND node = target)""")
def dangling_edges(spark, d):
    g = G(spark, d)
    return V.dangling_edges(edges(g), g.where("pos % 50 <> 49").select("stream_id", F.col("event_id").alias("node")))


@query(f"WITH {G_SQL} SELECT stream_id, root_id AS source, count(*) AS children FROM g WHERE parent_id IS NOT NULL GROUP BY ALL HAVING count(*) > 3")
def fanout_violations(spark, d):
    star = G(spark, d).where("parent_id is not null").select("stream_id", F.col("root_id").alias("source"), F.col("event_id").alias("target"))
    return V.fanout_violations(star, 3)


@query(f"WITH {G_SQL}, nd AS (SELECT stream_id, node_id FROM g WHERE node_id IS NOT NULL AND pos % 11 <> 0), mp AS (SELECT stream_id, node_id FROM g WHERE node_id IS NOT NULL AND pos % 13 <> 0) SELECT coalesce(nd.stream_id, mp.stream_id) AS stream_id, coalesce(nd.node_id, mp.node_id) AS node_id, CASE WHEN mp.node_id IS NULL THEN 'missing' ELSE 'extra' END AS side FROM nd FULL JOIN mp ON nd.stream_id = mp.stream_id AND nd.node_id = mp.node_id WHERE nd.node_id IS NULL OR mp.node_id IS NULL")
def mapping_diff(spark, d):
    g = G(spark, d).where("node_id is not null")
    return V.mapping_diff(g.where("pos % 11 <> 0").select("stream_id", "node_id"), g.where("pos % 13 <> 0").select("stream_id", "node_id"))


@query(f"""WITH {G_SQL}, ac AS (SELECT stream_id, pos, event_type AS value FROM g WHERE stream_id % 5 <> 0 OR pos > 0), ex AS (SELECT stream_id, pos, CASE WHEN pos % 17 = 16 THEN 'other' ELSE event_type END AS value FROM g),
n AS (SELECT stream_id, (SELECT count(*) FROM ac WHERE ac.stream_id = s.stream_id) AS na, (SELECT count(*) FROM ex WHERE ex.stream_id = s.stream_id) AS ne FROM (SELECT DISTINCT stream_id FROM g) s)
SELECT stream_id, pos, 'value mismatch' AS error FROM ac JOIN ex USING (stream_id, pos) WHERE ac.value <> ex.value AND stream_id IN (SELECT stream_id FROM n WHERE na = ne) UNION ALL SELECT stream_id, -1, 'count mismatch' FROM n WHERE na <> ne""")
def zip_compare(spark, d):
    g = G(spark, d)
    actual = g.where("stream_id % 5 <> 0 or pos > 0").select("stream_id", "pos", F.col("event_type").alias("value"))
    return V.zip_compare(actual, g.select("stream_id", "pos", F.when(F.col("pos") % 17 == 16, "other").otherwise(F.col("event_type")).alias("value")))


@query(f"WITH {G_SQL}, f AS (SELECT DISTINCT stream_id, CASE event_type WHEN 'click' THEN 'label' WHEN 'view' THEN 'temporal' ELSE 'semantic' END AS stage FROM g WHERE pos % 29 = 0) SELECT stream_id, CASE WHEN bool_or(stage = 'structural') THEN 'structural' WHEN bool_or(stage = 'temporal') THEN 'temporal' WHEN bool_or(stage = 'semantic') THEN 'semantic' ELSE 'label' END AS stage FROM f GROUP BY stream_id")
def reject_stage(spark, d):
    f = G(spark, d).where("pos % 29 = 0").select("stream_id", F.when(F.col("event_type") == "click", "label").when(F.col("event_type") == "view", "temporal").otherwise("semantic").alias("stage"))
    return V.reject_stage(f, ["structural", "temporal", "semantic", "label"])


@query("SELECT 'event_type' AS field, unnest(['refund', 'transfer']) AS missing")
def diversity_missing(spark, d):
    return V.diversity_missing(S.events(spark, d), "event_type", ["click", "refund", "transfer"])




@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN value - 50 > 0 WHEN 1 THEN value > 0 AND value - 80 > 0 WHEN 2 THEN value - 20 > 0 ELSE false END AS valid FROM events""")
def param_check(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "value")
    k = F.col("event_id") % 4
    regime = F.when(k == 0, "exponential").when(k == 1, "gamma").when(k == 2, "lognormal").otherwise("no such regime")
    v = F.col("value")
    params = F.when(k == 0, F.create_map(F.lit("lambda"), v - 50)).when(k == 1, F.create_map(F.lit("shape"), v, F.lit("scale"), v - 80)).otherwise(F.create_map(F.lit("mu"), F.lit(-1.0), F.lit("sigma"), v - 20))
    return e.select("event_id", V.params_valid(regime, params).alias("valid"))


# ---- graph


@query(f"{TREE_WITH} SELECT stream_id, event_id, root_id, depth, path FROM r")
def causal_paths(spark, d):
    return graph.paths(G(spark, d).where("not is_background")).withColumn("path", F.array_join(F.col("path").cast("array<string>"), ","))


@query(f"{TREE_WITH} SELECT stream_id, event_id, coalesce(parent_id, -1) AS parent_id, root_id, path FROM r")
def ground_truth(spark, d):
    return graph.ground_truth(G(spark, d)).fillna(-1, ["parent_id"])


@query(f"{TREE_WITH} SELECT r.stream_id, r.event_id, t.claimed AS root_id, r.root_id AS expected_root FROM r JOIN t ON r.stream_id = t.stream_id AND r.event_id = t.event_id WHERE r.root_id <> t.claimed")
def ground_truth_check(spark, d):
    g = G(spark, d)
    claimed = graph.ground_truth(g).drop("root_id").join(g.select("stream_id", "event_id", "root_id"), ["stream_id", "event_id"])
    return graph.ground_truth_check(g, claimed).select("stream_id", "event_id", "root_id", "expected_root")


@query(f"WITH {G_SQL}, t AS (SELECT stream_id, event_id, parent_id FROM g WHERE NOT is_background), k AS (SELECT stream_id, event_id AS node, CASE WHEN event_id % 61 = 60 THEN event_id ELSE parent_id END AS source FROM t) SELECT stream_id, NOT bool_or(coalesce(node = source, false)) AS is_dag FROM k GROUP BY stream_id")
def dag_check(spark, d):
    t = G(spark, d).where("not is_background").select("stream_id", F.col("event_id").alias("node"), F.when(F.col("event_id") % 61 == 60, F.col("event_id")).otherwise(F.col("parent_id")).alias("source"))
    e = t.where("source is not null").select("stream_id", "source", F.col("node").alias("target"))
    return graph.dag_check(e, t.select("stream_id", "node"))


STAR_SQL = f"{G_SQL}, st AS (SELECT stream_id, root_id AS source, event_id AS target FROM g WHERE parent_id IS NOT NULL)"


@query(f"WITH {STAR_SQL} SELECT stream_id, target, 'children_of_' || source AS sibling_group FROM (SELECT *, count(*) OVER (PARTITION BY stream_id, source) AS n FROM st) WHERE n > 1")
def sibling_groups(spark, d):
    return graph.sibling_groups(G(spark, d).where("parent_id is not null").select("stream_id", F.col("root_id").alias("source"), F.col("event_id").alias("target")))


@query(f"WITH {G_SQL}, {NODES_SQL} SELECT ed.stream_id, row_number() OVER (PARTITION BY ed.stream_id ORDER BY g.depth, source::VARCHAR, target::VARCHAR) AS ordinal, source, target FROM ed JOIN g ON g.stream_id = ed.stream_id AND g.event_id = source")
def edge_order(spark, d):
    g = G(spark, d)
    return graph.edge_order(edges(g), g.select("stream_id", F.col("event_id").alias("node"), "depth"))


@query("SELECT user_id AS stream_id, 'E' || i AS node_id, CASE WHEN i = 0 THEN 'root' WHEN i = n - 1 THEN 'target' ELSE 'intermediate' END AS role, CASE WHEN i > 0 THEN 'E' || (i - 1) END AS parent_node FROM (SELECT user_id, n, unnest(range(n)) AS i FROM (SELECT DISTINCT user_id, greatest(user_id % 9, 2) AS n FROM events))")
def build_chain(spark, d):
    s = S.events(spark, d).select("stream_id").distinct()
    return graph.build_chain(s, F.col("stream_id") % 9)


@query()
def build_tree(spark, d):
    return graph.build_tree(S.events(spark, d).select("stream_id").distinct(), 6 + F.col("stream_id") % 20)


# ---- order, questions, export


@query(f"WITH {G_SQL} SELECT stream_id, event_id, row_number() OVER (PARTITION BY stream_id ORDER BY us, event_id) AS n FROM g")
def merged_order(spark, d):
    g = G(spark, d)
    both = g.where("not is_background").unionByName(g.where("is_background"))
    return both.select("stream_id", "event_id", F.row_number().over(Window.partitionBy("stream_id").orderBy("us", "event_id")).cast("bigint").alias("n"))


DEEP_SQL = "dp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY depth DESC, us DESC, event_id DESC) AS k FROM g WHERE NOT is_background) WHERE k = 1), fp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY depth, us, pos) AS k FROM g WHERE parent_id IS NOT NULL) WHERE k = 1)"


@query(f"WITH {G_SQL}, {DEEP_SQL} SELECT stream_id, event_id, depth FROM dp")
def qa_deepest(spark, d):
    return qa.deepest(G(spark, d)).select("stream_id", "event_id", "depth")


@query(f"WITH {G_SQL}, {DEEP_SQL} SELECT stream_id, event_id, parent_id, delta_us FROM fp")
def qa_first_parented(spark, d):
    return qa.first_parented(G(spark, d))


def _qa(kind: str, target: str, answer: str, source: str = "NULL") -> str:
    return f"SELECT stream_id, stream_id || '_qa_{kind}_1' AS qa_id, '{kind}' AS qa_type, coalesce(({target})::BIGINT, -1) AS target_event_id, coalesce(({source})::BIGINT, -1) AS source_event_id, ({answer})::VARCHAR AS answer"


QA_SQL = {
    "direct_parent": _qa("direct_parent", "event_id", "parent_id") + " FROM dp WHERE parent_id IS NOT NULL",
    "root_cause": _qa("root_cause", "event_id", "root_id") + " FROM dp",
    "temporal_order": _qa("temporal_order", "NULL", "'[' || string_agg(event_id::VARCHAR, ', ' ORDER BY us, event_id) || ']'") + " FROM g GROUP BY stream_id",
    "time_delay": _qa("time_delay", "event_id", "delta_us", "parent_id") + " FROM fp",
    "causal_path": _qa("causal_path", "event_id", "'[' || replace(path, ',', ', ') || ']'") + " FROM (SELECT r.* FROM r JOIN dp ON r.stream_id = dp.stream_id AND r.event_id = dp.event_id)",
}
def _ids(pairs: DataFrame) -> DataFrame:
    """Missing ids as -1, so that results compare as whole numbers everywhere."""
    return pairs.fillna(-1, ["target_event_id", "source_event_id"])


for _kind, _sql in QA_SQL.items():
    QUERIES[f"qa_{_kind}"] = lambda spark, d, f=getattr(qa, _kind): _ids(f(G(spark, d)))
    ORACLES[f"qa_{_kind}"] = f"{TREE_WITH}, {DEEP_SQL} {_sql}"
ALL_QA = f"{TREE_WITH}, {DEEP_SQL}, qa AS ({' UNION ALL '.join(QA_SQL.values())})"


@query(f"{ALL_QA} SELECT * FROM qa")
def qa_all(spark, d):
    return _ids(qa.all_pairs(G(spark, d)))


@query(f"{ALL_QA} SELECT stream_id, qa_id, 'wrong answer' AS error FROM qa WHERE stream_id % 4 = 1 AND stream_id % 6 <> 0 UNION ALL SELECT DISTINCT stream_id, NULL, 'no qa pairs' FROM g WHERE stream_id % 6 = 0")
def qa_label_check(spark, d):
    g = G(spark, d)
    told = qa.all_pairs(g).where("stream_id % 6 <> 0").withColumn("answer", F.when(F.col("stream_id") % 4 == 1, F.concat("answer", F.lit("?"))).otherwise(F.col("answer")))
    return qa.label_check(told, g)


RENDER_SQL = "rd AS (SELECT stream_id, 'Event stream:' || chr(10) || 'events in timestamp order:' || chr(10) || string_agg('- event_id=' || event_id || '; timestamp=' || us || '; event=' || event_type, chr(10) ORDER BY us, event_id) AS input FROM g GROUP BY stream_id)"
EXPORT_SQL = f"""{RENDER_SQL}, ex AS (SELECT stream_id || ':' || qa_id AS example_id, qa_type AS task_type, CASE qa_type WHEN 'direct_parent' THEN 'Which event directly caused event ' || target_event_id || '?' WHEN 'root_cause' THEN 'Which event is the root cause of event ' || target_event_id || '?'
 WHEN 'time_delay' THEN 'How long after event ' || source_event_id || ' did event ' || target_event_id || ' happen?' WHEN 'causal_path' THEN 'What is the causal path to event ' || target_event_id || '?' ELSE 'In which order did the events happen?' END AS instruction, input, answer AS output FROM qa JOIN rd USING (stream_id))"""


@query(f"{ALL_QA}, {EXPORT_SQL} SELECT * FROM ex")
def export_instruction(spark, d):
    g = G(spark, d)
    return qa.export_instruction(qa.all_pairs(g), g)


@query(f"{ALL_QA}, {EXPORT_SQL} SELECT example_id, task_type, 3::BIGINT AS n_messages, 'system user assistant' AS roles, sha256('You reason about event streams.' || chr(10) || instruction || chr(10) || chr(10) || input || chr(10) || output) AS content_sha256 FROM ex")
def export_chat(spark, d):
    g = G(spark, d)
    c = qa.export_chat(qa.all_pairs(g), g)
    return c.select("example_id", "task_type", F.size("messages").cast("bigint").alias("n_messages"), F.array_join("messages.role", " ").alias("roles"), F.sha2(F.array_join("messages.content", "\n"), 256).alias("content_sha256"))


@query(f"{ALL_QA} SELECT qa_type AS task_type, count(*) AS n FROM qa GROUP BY qa_type")
def training_counts(spark, d):
    return qa.all_pairs(G(spark, d)).groupBy(F.col("qa_type").alias("task_type")).agg(F.count(F.lit(1)).alias("n"))


# ---- quality


@query(f"WITH {SCEN_SQL} SELECT stream_id, short::INT AS short, duplicate::INT AS duplicate, generic::INT AS generic, weak::INT AS weak, description_words::INT AS description_words, score, approved, array_to_string(issues, '; ') AS issues FROM z")
def semantic_score(spark, d):
    return scored(spark, d).select("stream_id", "short", "duplicate", "generic", "weak", "description_words", "score", "approved", F.array_join("issues", "; ").alias("issues"))


@query(f"WITH {SCEN_SQL} SELECT stream_id, CASE WHEN score < 0.7 OR len(issues) > 0 THEN 'semantic_quality_gate' END AS stage FROM z")
def quality_gate(spark, d):
    return quality.gate(scored(spark, d)).select("stream_id", "stage")


@query(f"WITH {SCEN_SQL} SELECT {SUMMARY_SQL} FROM z")
def quality_summary(spark, d):
    return quality.summary(scored(spark, d))


@query(f"WITH {SCEN_SQL} SELECT domain, topology, {SUMMARY_SQL} FROM z GROUP BY GROUPING SETS ((domain), (topology))")
def audit_groups(spark, d):
    return quality.summary(scored(spark, d), [["domain"], ["topology"]])


@query(f"WITH {SCEN_SQL}, k AS (SELECT *, unnest(CASE WHEN len(regimes) = 0 THEN ['unknown'] ELSE list_distinct(regimes) END) AS member FROM z) SELECT member, {SUMMARY_SQL} FROM k GROUP BY member")
def audit_by_regime(spark, d):
    return quality.by_member(scored(spark, d), "regimes")


@query(f"WITH {SCEN_SQL} SELECT value, count(*) AS n FROM (SELECT unnest(issues) AS value FROM z) GROUP BY value")
def error_counts(spark, d):
    return quality.exploded_counts(scored(spark, d), "issues")


@query(f"WITH {SCEN_SQL} SELECT stream_id, score, array_to_string(issues, '; ') AS issues FROM z ORDER BY score, stream_id LIMIT 10")
def low_quality_topk(spark, d):
    return quality.lowest(scored(spark, d), 10)


@query(f"""WITH {SCEN_SQL}, r AS (SELECT 'all' AS section, 'all' AS key, * FROM (SELECT {SUMMARY_SQL} FROM z) UNION ALL SELECT 'domain', domain, {SUMMARY_SQL} FROM z GROUP BY domain UNION ALL SELECT 'topology', topology, {SUMMARY_SQL} FROM z GROUP BY topology)
SELECT section, key, sample_count, approved_count, average_score, min_score, max_score FROM r""")
def audit_report(spark, d):
    s = quality.summary(scored(spark, d), [["domain"], ["topology"], []])
    section = F.when(F.col("domain").isNotNull(), "domain").when(F.col("topology").isNotNull(), "topology").otherwise("all")
    return s.select(section.alias("section"), F.coalesce("domain", "topology", F.lit("all")).alias("key"), "sample_count", "approved_count", "average_score", "min_score", "max_score")


@query(f"WITH {SCEN_SQL}, k AS (SELECT unnest([{{'dimension': 'domain', 'value': domain}}, {{'dimension': 'topology', 'value': topology}}]) AS x FROM s) SELECT x.dimension AS dimension, x.value AS value, count(*) AS n FROM k GROUP BY ALL")
def coverage_report(spark, d):
    return quality.coverage(scenarios(spark, d), ["domain", "topology"])


@query("SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def dist_event_type(spark, d):
    e = S.events(spark, d).where("event_type is not null")
    return e.groupBy(F.col("event_type").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {E_SQL}, v AS (SELECT count(*)::DOUBLE AS x FROM e GROUP BY stream_id), o AS (SELECT list(x ORDER BY x) AS l, count(*) AS n FROM v)
SELECT l[1] AS min, l[round_even((n - 1) * 0.25, 0)::INT + 1] AS p25, l[round_even((n - 1) * 0.5, 0)::INT + 1] AS p50, l[round_even((n - 1) * 0.75, 0)::INT + 1] AS p75, l[n] AS max FROM o""")
def nearest_rank_quantiles(spark, d):
    return quality.nearest_rank(S.events(spark, d).groupBy("stream_id").agg(F.count(F.lit(1)).alias("x")), "x")


@query(f"WITH {SCEN_SQL} SELECT stream_id, 'In the ' || domain || ' domain, a ' || topology || ' event stream links ' || array_to_string(phrases, '; ') || '.' AS scenario FROM s")
def scenario_text(spark, d):
    return scenarios(spark, d).select("stream_id", F.concat(F.lit("In the "), "domain", F.lit(" domain, a "), "topology", F.lit(" event stream links "), F.array_join("phrases", "; "), F.lit(".")).alias("scenario"))


@query(f"WITH {SCEN_SQL} SELECT stream_id, bool_or(x) AS has_alias FROM (SELECT stream_id, unnest([contains(lower(description), 'the'), contains(lower(description), 'ing')]) AS x FROM s) GROUP BY stream_id")
def words_in_description(spark, d):
    return scenarios(spark, d).select("stream_id", T.has_any(F.col("description"), ["the", "ing"]).alias("has_alias"))


# ---- joins with dimensions


@query(f"""WITH {G_SQL}, ph AS (SELECT unnest(range(4)) AS k, unnest(['queue buildup', 'latency spike', 'timeout', 'recovery']) AS phrase), n AS (SELECT stream_id, event_id, row_number() OVER (PARTITION BY stream_id, is_background ORDER BY pos) - 1 AS i FROM g)
SELECT stream_id, event_id, phrase || CASE WHEN i // 4 > 0 THEN ' #' || (i // 4 + 1) ELSE '' END AS phrase FROM n JOIN ph ON i % 4 = k""")
def phrase_assign(spark, d):
    phrases = spark.createDataFrame(list(enumerate(["queue buildup", "latency spike", "timeout", "recovery"])), "k long, phrase string")
    own = Window.partitionBy("stream_id", "is_background").orderBy("pos")
    n = G(spark, d).select("stream_id", "event_id", (F.row_number().over(own) - 1).cast("bigint").alias("i")).withColumn("k", F.pmod("i", F.lit(4)))
    again = F.floor(F.col("i") / 4)
    return n.join(F.broadcast(phrases), "k").select("stream_id", "event_id", F.concat("phrase", F.when(again > 0, F.concat(F.lit(" #"), (again + 1).cast("string"))).otherwise("")).alias("phrase"))


@query(f"""WITH {G_SQL}, {STEPS_SQL.replace('FROM e ', 'FROM (SELECT stream_id, us, event_type FROM g) ')}, t AS (SELECT a, b, count(*) AS n FROM x WHERE ab > 0 GROUP BY a, b HAVING count(*) >= 400), ed AS (SELECT j.stream_id, j.event_id, p.event_type AS s, j.event_type AS t FROM j JOIN g p ON p.stream_id = j.stream_id AND p.event_id = j.parent_id)
SELECT stream_id, event_id, CASE WHEN n IS NULL THEN 'generic_backoff' ELSE 'calibrated' END AS regime FROM ed LEFT JOIN t ON ed.s = t.a AND ed.t = t.b""")
def edge_prior_join(spark, d):
    g = G(spark, d)
    prior = X.positive(X.steps(g.select("stream_id", "us", "event_type"))).groupBy(F.col("a").alias("s"), F.col("b").alias("t")).agg(F.count(F.lit(1)).alias("n")).where("n >= 400")
    p = g.select("stream_id", F.col("event_id").alias("parent_id"), F.col("event_type").alias("s"))
    e = g.select("stream_id", "event_id", "parent_id", F.col("event_type").alias("t")).join(p, ["stream_id", "parent_id"])
    return e.join(prior, ["s", "t"], "left").select("stream_id", "event_id", F.when(F.col("n").isNull(), "generic_backoff").otherwise("calibrated").alias("regime"))  # prior: pairs of event types


def _values(name: str, xs: list[str]) -> str:
    return f"(SELECT unnest([{', '.join(repr(x) for x in xs)}]) AS {name})"


TAX_SQL = f"SELECT * FROM {_values('domain', simulate.DOMAINS)}, {_values('topology', simulate.TOPOLOGIES)}, {_values('mechanism_type', simulate.MECHANISMS)}, {_values('primary_regime', simulate.REGIMES)}"


@query(TAX_SQL)
def taxonomy_cross(spark, d):
    return simulate.taxonomy(spark)


@query(f"""WITH t AS ({TAX_SQL}) SELECT domain, topology, mechanism_type, primary_regime, CASE WHEN topology = 'tree' AND mechanism_type = 'recovery' THEN 8 WHEN topology = 'tree' THEN 10 ELSE 30 END AS max_nodes, CASE WHEN topology = 'tree' THEN 3 ELSE 6 END AS max_depth,
CASE WHEN topology = 'tree' THEN 2 ELSE 3 END AS max_children, 6 AS min_nodes, CASE WHEN topology = 'chain' AND mechanism_type = 'recovery' THEN 6 WHEN topology = 'chain' THEN 8 ELSE 12 END AS max_length, 4 AS min_length, CASE WHEN mechanism_type = 'recovery' THEN 45 ELSE 80 END AS max_events FROM t""")
def compat_caps(spark, d):
    return simulate.compatible_caps(simulate.taxonomy(spark))


@query()
def stratified_assign(spark, d):
    return simulate.stratified(spark, S.events(spark, d).select("stream_id").distinct().count())


@query(f"WITH t AS ({TAX_SQL}) SELECT DISTINCT mechanism_type, CASE mechanism_type WHEN 'multi_hop_propagation' THEN 'direct_trigger' WHEN 'burst' THEN 'weak_trigger' ELSE mechanism_type END AS relation FROM t")
def relation_map(spark, d):
    return simulate.taxonomy(spark).select("mechanism_type", simulate.relation_of(F.col("mechanism_type")).alias("relation")).distinct()


# ---- draws


def _u(*keys: str) -> str:
    return f"(('0x' || substr(md5({' || chr(124) || '.join(f'({k})::VARCHAR' for k in keys)}), 1, 13))::BIGINT::DOUBLE / 4503599627370496)"


@query(f"""SELECT event_id, round(greatest(-ln(1 - {_u("'s'", 'event_id', '1')}) / 1.2, 1e-9), 6) AS exponential, round(greatest(exp(0.2 + 0.5 * sqrt(-2 * ln(greatest({_u("'s'", 'event_id', '2')}, 1e-15))) * cos(2 * pi() * {_u("'s'", 'event_id', '3')})), 1e-9), 6) AS lognormal,
round(greatest(1.2 * pow(-ln(1 - {_u("'s'", 'event_id', '4')}), 1 / 1.5), 1e-9), 6) AS weibull FROM events""")
def sample_regimes(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id")
    u = lambda i: R.uniform(F.lit("s"), F.col("event_id"), F.lit(i))
    return e.select("event_id", F.round(R.exponential(u(1), F.lit(1.2)), 6).alias("exponential"), F.round(R.lognormal(u(2), u(3), F.lit(0.2), F.lit(0.5)), 6).alias("lognormal"), F.round(R.weibull(u(4), F.lit(1.5), F.lit(1.2)), 6).alias("weibull"))


@query(f"SELECT event_id, round(0.8 * (-ln(1 - {_u(chr(39) + 'g' + chr(39), 'event_id', '1')}) - ln(1 - {_u(chr(39) + 'g' + chr(39), 'event_id', '2')})), 6) AS gamma FROM events")
def sample_gamma(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id")
    u = lambda i: R.uniform(F.lit("g"), F.col("event_id"), F.lit(i))
    return e.select("event_id", F.round(R.gamma_whole([u(1), u(2)], F.lit(0.8)), 6).alias("gamma"))


@query(f"SELECT event_id, CASE WHEN u <= 0.3 THEN 'exponential' WHEN u <= 0.8 THEN 'lognormal' ELSE 'weibull' END AS choice FROM (SELECT event_id, {_u(chr(39) + 'w' + chr(39), 'event_id')} AS u FROM events)")
def weighted_choice(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id")
    return e.select("event_id", simulate.weighted_choice(R.uniform(F.lit("w"), F.col("event_id")), simulate.REGIME_WEIGHTS["weak_trigger"]).alias("choice"))


@query(f"""WITH t AS ({TAX_SQL}), k AS (SELECT *, {_u('domain', 'topology', 'mechanism_type', 'primary_regime')} AS u, CASE mechanism_type WHEN 'multi_hop_propagation' THEN 'direct_trigger' WHEN 'burst' THEN 'weak_trigger' ELSE mechanism_type END AS rel FROM t)
SELECT domain, topology, mechanism_type, primary_regime, CASE rel WHEN 'direct_trigger' THEN CASE WHEN primary_regime IN ('exponential', 'gamma') THEN primary_regime WHEN u <= 0.5 THEN 'exponential' ELSE 'gamma' END
WHEN 'weak_trigger' THEN CASE WHEN primary_regime IN ('exponential', 'lognormal', 'weibull') THEN primary_regime WHEN u <= 0.3 THEN 'exponential' WHEN u <= 0.8 THEN 'lognormal' ELSE 'weibull' END
ELSE CASE WHEN primary_regime IN ('gamma', 'lognormal', 'weibull') THEN primary_regime WHEN u <= 0.4 THEN 'gamma' WHEN u <= 0.8 THEN 'lognormal' ELSE 'weibull' END END AS regime FROM k""")
def select_regime(spark, d):
    t = simulate.taxonomy(spark)
    u = R.uniform("domain", "topology", "mechanism_type", "primary_regime")
    return t.select("*", simulate.select_regime(simulate.relation_of(F.col("mechanism_type")), F.col("primary_regime"), u).alias("regime"))


@query(f"""WITH {G_SQL}, k AS (SELECT stream_id, event_id, relation, (CASE WHEN pos % 3 = 0 THEN 0.65::DOUBLE ELSE 1 END) * (CASE WHEN depth > 0 THEN 1 + 0.08::DOUBLE * depth ELSE 1 END) * (CASE relation WHEN 'delayed_trigger' THEN 2.0 WHEN 'weak_trigger' THEN 1.4 WHEN 'recovery' THEN 2.5 ELSE 1 END)::DOUBLE AS f FROM g WHERE relation IS NOT NULL)
SELECT stream_id, event_id, round(1.0 / f, 6) AS rate, round(0.8 * f, 6) AS scale, round(0.2 + ln(f), 6) AS mu FROM k""")
def adjust_params(spark, d):
    g = G(spark, d).where("relation is not null")
    f = simulate.scale_factor(F.col("relation"), F.col("pos") % 3 == 0, F.col("depth"))
    m = lambda r, k, v: F.round(simulate.adjust_params(F.lit(r), F.create_map(F.lit(k), F.lit(v)), f)[k], 6)
    return g.select("stream_id", "event_id", m("exponential", "lambda", 1.0).alias("rate"), m("gamma", "scale", 0.8).alias("scale"), m("lognormal", "mu", 0.2).alias("mu"))


@query(f"""WITH s AS (SELECT DISTINCT user_id AS stream_id FROM events), k AS (SELECT stream_id, unnest(range(60)) AS i FROM s), a AS (SELECT stream_id, i, sum(greatest(-ln(1 - {_u(chr(39) + 'bg' + chr(39), 'stream_id', 'i')}) / 0.15, 1e-9)) OVER (PARTITION BY stream_id ORDER BY i) AS t FROM k)
SELECT stream_id, i, round(t, 6) AS t, 'BG' || i AS event_type, ['near_time_unrelated', 'similar_type_unrelated', 'invalid_trigger_timing', 'post_target_non_cause'][i % 4 + 1] AS distractor_type FROM a WHERE t < 10 + stream_id % 50""")
def background_arrivals(spark, d):
    return simulate.background_arrivals(S.events(spark, d).select("stream_id").distinct(), F.lit(10) + F.col("stream_id") % 50, 0.15, 60)


@query(f"""WITH {G_SQL}, k AS (SELECT stream_id, us, CASE WHEN stream_id % 3 = 0 THEN event_id ELSE event_id + CASE WHEN pos = 1 THEN 1000 ELSE 0 END END AS event_id, is_background FROM g),
o AS (SELECT *, event_id < lag(event_id) OVER (PARTITION BY stream_id ORDER BY us, event_id) AS fell, row_number() OVER (PARTITION BY stream_id, is_background ORDER BY event_id) AS n FROM k),
s AS (SELECT stream_id, bool_or(coalesce(fell, false)) AS fell, max(us) FILTER (WHERE NOT is_background AND n = 1) AS a, max(us) FILTER (WHERE NOT is_background AND n = 2) AS b, count(*) FILTER (WHERE is_background) AS bg, max(event_id) AS last FROM o GROUP BY stream_id)
SELECT stream_id, CASE WHEN floor((a + b) / 2)::BIGINT <= a THEN a + 1 ELSE floor((a + b) / 2)::BIGINT END AS us, last + 1 AS event_id, 'BG' || bg AS event_type FROM s WHERE NOT fell AND b IS NOT NULL""")
def interleave_repair(spark, d):
    moved = F.when(F.col("stream_id") % 3 == 0, F.col("event_id")).otherwise(F.col("event_id") + F.when(F.col("pos") == 1, 1000).otherwise(0))
    return simulate.interleave_repair(G(spark, d).select("stream_id", "us", moved.alias("event_id"), "is_background"))


@query(f"WITH s AS (SELECT DISTINCT user_id AS stream_id FROM events), a AS (SELECT stream_id, unnest(range(5)) AS attempt FROM s) SELECT stream_id, min(attempt) AS attempt FROM a WHERE {_u('stream_id', 'attempt')} < 0.4 GROUP BY stream_id")
def retry_first_success(spark, d):
    s = S.events(spark, d).select("stream_id").distinct().select("stream_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("attempt"))
    return simulate.retry_first_success(s.select("stream_id", F.col("attempt").cast("bigint").alias("attempt"), (R.uniform("stream_id", "attempt") < 0.4).alias("approved")))


@query()
def simulate_streams(spark, d):
    n = S.events(spark, d).select("stream_id").distinct().count()
    return simulate.simulate(simulate.stratified(spark, n))


@query()
def simulate_calibrated(spark, d):
    e = S.events(spark, d)
    n = e.select("stream_id").distinct().count()
    return simulate.simulate(simulate.stratified(spark, n), prior=simulate.load_prior(e))


@query(f"WITH {E_SQL}, {STEPS_SQL} SELECT a AS source, b AS target, count(*) AS n FROM x WHERE ab > 0 GROUP BY a, b")
def stream_transitions(spark, d):
    """The batch form of the streaming fold: the same kernel's result over one run of all there is, counted."""
    from ..sources import scratch
    from ..streaming import folds

    e = folds.read_events(spark, d).select(F.col("user_id").alias("stream_id"), S.micros("ts").alias("us"), "event_type")
    out = folds.run_to_files(folds.transitions(e), scratch.path(spark, "stream-transitions"))
    return out.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, count(*) AS n_sessions, sum(n)::BIGINT AS n FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s) GROUP BY user_id")
def sessions(spark, d):
    from ..streaming import folds

    return folds.sessions(spark.read.parquet(f"{d}/events.parquet")).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("n").alias("n"))


def queries() -> dict[str, Query]:
    from . import registry_rules  # noqa: F401  # adds its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import registry_rules  # noqa: F401

    return dict(ORACLES)
