"""More operators bound to the driver's tables: rules over scenarios and mechanisms, reports, texts of examples, and paths of any depth.

Everything is read from G (registry), whose causal events stand here for nodes named E and their event id.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graph, qa, quality, semantics, simulate, transitions as X, validate as V
from ..sources import scratch, tables as S
from .registry import E_SQL, G, G_SQL, SCEN_SQL, SUMMARY_SQL, query, scenarios, scored


# ---- order and depth


@query("""WITH k AS (SELECT user_id AS stream_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events)
SELECT stream_id, coalesce(min(gap), 0) AS min_gap_us, count(*) AS n, coalesce(min(gap), 0) >= 0 AS is_sorted FROM k GROUP BY stream_id""")
def stored_order_gaps(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").alias("stream_id"), S.micros("ts").alias("us"), F.col("event_id").alias("pos"))
    return V.stored_gaps(e).fillna(0, ["min_gap_us"])


@query("""WITH e AS (SELECT user_id // 3 AS stream_id, event_id, epoch_us(ts) AS us FROM events)
SELECT stream_id, event_id, first_value(event_id) OVER w AS root_id, (row_number() OVER w - 1)::INT AS depth FROM e WINDOW w AS (PARTITION BY stream_id ORDER BY us, event_id)""")
def deep_paths(spark, d):
    """One chain of causes through all events of three users: hundreds of events deep."""
    e = spark.read.parquet(f"{d}/events.parquet").select(F.floor(F.col("user_id") / 3).alias("stream_id"), "event_id", S.micros("ts").alias("us"))
    own = Window.partitionBy("stream_id").orderBy("us", "event_id")
    return graph.paths(e.withColumn("parent_id", F.lag("event_id").over(own))).select("stream_id", "event_id", "root_id", "depth")


@query(f"""WITH RECURSIVE {G_SQL}, c AS (SELECT *, substr(node_id, 2)::BIGINT AS ci FROM g WHERE NOT is_background),
p AS (SELECT c.stream_id, c.event_id, CASE WHEN c.depth = 0 AND c.ci % 25 = 0 THEN l.event_id ELSE c.parent_id END AS parent_id FROM c LEFT JOIN c l ON l.stream_id = c.stream_id AND l.ci = c.ci + 4),
u AS (SELECT stream_id, event_id, parent_id AS up, 0 AS n FROM p UNION ALL SELECT u.stream_id, u.event_id, p.parent_id, n + 1 FROM u JOIN p ON p.stream_id = u.stream_id AND p.event_id = u.up WHERE n < 12)
SELECT DISTINCT stream_id, event_id FROM u WHERE n = 12""")
def parent_cycles(spark, d):
    """Every fifth episode's first event is made the child of its last."""
    c = G(spark, d).where("not is_background").withColumn("ci", F.substr("node_id", F.lit(2)).cast("bigint"))
    last = c.select("stream_id", (F.col("ci") - 4).alias("ci"), F.col("event_id").alias("loop"))
    bent = F.when((F.col("depth") == 0) & (F.col("ci") % 25 == 0), F.col("loop")).otherwise(F.col("parent_id"))
    return graph.parent_cycles(c.join(last, ["stream_id", "ci"], "left").withColumn("parent_id", bent))


@query(f"""WITH {G_SQL} SELECT a.stream_id, a.event_id, greatest(count(DISTINCT b.root_id), 1) AS active_sources FROM g a
LEFT JOIN g b ON a.stream_id = b.stream_id AND NOT b.is_background AND (b.us < a.us OR (b.us = a.us AND b.event_id <= a.event_id)) GROUP BY a.stream_id, a.event_id""")
def active_sources(spark, d):
    return X.active_sources(G(spark, d))


# ---- rules

RULES_SQL = f"""{G_SQL}, s AS (SELECT stream_id, CASE WHEN stream_id % 11 = 5 THEN NULL ELSE '{{"scenario_description": "x", "event_mapping": {{"E0": "say \\"root_id\\": 1"}}' || CASE WHEN stream_id % 7 = 3 THEN ', "extra": [{{"parent_id" : 1}}, {{"regime": {{"root_id": 2}}}}]' ELSE '' END || '}}' END AS scenario,
  CASE WHEN stream_id % 13 = 2 THEN '  ' ELSE 'text' END AS description, CASE WHEN stream_id % 9 = 4 THEN 'pending' ELSE 'instantiated' END AS status FROM (SELECT DISTINCT stream_id FROM g)),
ev AS (SELECT *, CASE WHEN NOT is_background THEN 'E' || event_id WHEN event_id % 40 = 3 THEN 'E1' END AS nid, CASE WHEN event_id % 37 = 5 THEN 'other' ELSE event_type || ' step' END AS semantic_type FROM g),
m AS (SELECT stream_id, nid, event_type || ' step' AS phrase FROM ev WHERE NOT is_background AND event_id % 31 <> 7 UNION ALL SELECT stream_id, 'X1', 'extra' FROM s WHERE stream_id % 6 = 1),
ed AS (SELECT stream_id, row_number() OVER (PARTITION BY stream_id ORDER BY event_id) - 1 AS pos, 'E' || parent_id AS source, 'E' || event_id AS target, relation, event_id FROM g WHERE NOT is_background AND parent_id IS NOT NULL),
ex AS (SELECT stream_id, pos, source, target, CASE WHEN event_id % 53 = 9 THEN 'another' ELSE relation END AS relation, CASE WHEN event_id % 17 = 0 THEN 'the route is BLOCKED here' WHEN event_id % 19 = 0 THEN 'so risk increases' WHEN event_id % 23 = 0 THEN '' ELSE 'fine' END AS explanation
  FROM ed WHERE NOT (stream_id % 10 = 0 AND pos = 0))"""


def rules(spark, d) -> dict:
    c, when = F.col, F.when
    g = G(spark, d)
    doc = F.concat(F.lit('{"scenario_description": "x", "event_mapping": {"E0": "say \\"root_id\\": 1"}'), when(c("stream_id") % 7 == 3, ', "extra": [{"parent_id" : 1}, {"regime": {"root_id": 2}}]').otherwise(""), F.lit("}"))
    streams = g.select("stream_id").distinct().select(
        "stream_id", when(c("stream_id") % 11 == 5, None).otherwise(doc).alias("scenario"), when(c("stream_id") % 13 == 2, "  ").otherwise("text").alias("description"),
        when(c("stream_id") % 9 == 4, "pending").otherwise("instantiated").alias("status"),
    )
    name = lambda x: F.concat(F.lit("E"), c(x).cast("string"))
    step = F.concat("event_type", F.lit(" step"))
    events = g.withColumns({"node_id": when(~c("is_background"), name("event_id")).when(c("event_id") % 40 == 3, "E1"), "semantic_type": when(c("event_id") % 37 == 5, "other").otherwise(step)})
    nodes = events.where("not is_background").select("stream_id", "node_id")
    mapping = events.where("not is_background and event_id % 31 <> 7").select("stream_id", "node_id", step.alias("phrase"))
    mapping = mapping.unionAll(streams.where("stream_id % 6 = 1").select("stream_id", F.lit("X1"), F.lit("extra")))
    at = (F.row_number().over(Window.partitionBy("stream_id").orderBy("event_id")) - 1).cast("bigint")
    edges = g.where("not is_background and parent_id is not null").select("stream_id", at.alias("pos"), name("parent_id").alias("source"), name("event_id").alias("target"), "relation", "event_id")
    said = when(c("event_id") % 17 == 0, "the route is BLOCKED here").when(c("event_id") % 19 == 0, "so risk increases").when(c("event_id") % 23 == 0, "").otherwise("fine")
    told = edges.where("not (stream_id % 10 = 0 and pos = 0)").select("stream_id", "pos", "source", "target", when(c("event_id") % 53 == 9, "another").otherwise(c("relation")).alias("relation"), said.alias("explanation"))
    return {"streams": streams, "nodes": nodes, "mapping": mapping, "events": events, "edges": edges.drop("event_id"), "explanations": told}


@query(rf"""WITH {RULES_SQL}, t AS (SELECT * FROM s WHERE scenario IS NOT NULL), n AS (SELECT stream_id, nid FROM ev WHERE NOT is_background AND stream_id IN (SELECT stream_id FROM t)), tm AS (SELECT * FROM m WHERE stream_id IN (SELECT stream_id FROM t)),
k AS (SELECT stream_id, unnest(['parent_id', 'regime', 'root_id']) AS k FROM t WHERE stream_id % 7 = 3),
ne AS (SELECT t.stream_id, (SELECT count(*) FROM ed WHERE ed.stream_id = t.stream_id) AS a, (SELECT count(*) FROM ex WHERE ex.stream_id = t.stream_id) AS b FROM t),
r AS (SELECT ed.stream_id, ed.target, lower(coalesce(m.phrase, '') || ' ' || coalesce(ex.explanation, '')) AS x FROM ed JOIN t USING (stream_id) LEFT JOIN ex ON ex.stream_id = ed.stream_id AND ex.target = ed.target LEFT JOIN m ON m.stream_id = ed.stream_id AND m.nid = ed.target WHERE ed.relation = 'recovery'),
f AS (SELECT stream_id, target, CASE WHEN contains(x, 'new fault') OR contains(x, 'new failure') THEN 'new fault' WHEN contains(x, 'new outage') THEN 'new outage' WHEN contains(x, 'new blockage') OR contains(x, 'blockage') OR contains(x, 'blocks') OR contains(x, 'blocked') THEN 'new blockage'
  WHEN contains(x, 'risk escalation') OR contains(x, 'risk increases') OR contains(x, 'escalates risk') THEN 'risk escalation' END AS effect FROM r)
SELECT stream_id, 'semantic_scenario is missing' AS error FROM s WHERE scenario IS NULL
UNION ALL SELECT stream_id, 'forbidden semantic field: ' || k FROM k
UNION ALL SELECT stream_id, 'scenario_description is empty' FROM t WHERE trim(description) = ''
UNION ALL SELECT stream_id, 'metadata.semantic_status is not instantiated' FROM t WHERE status <> 'instantiated'
UNION ALL SELECT stream_id, 'missing semantic mapping for ' || nid FROM n ANTI JOIN m USING (stream_id, nid)
UNION ALL SELECT stream_id, 'extra semantic mapping for ' || nid FROM tm ANTI JOIN n USING (stream_id, nid)
UNION ALL SELECT ev.stream_id, 'background event ' || event_id || ' appears in event_mapping' FROM ev JOIN tm USING (stream_id, nid) WHERE is_background
UNION ALL SELECT ev.stream_id, 'event ' || event_id || ' semantic_type does not match mapping' FROM ev JOIN t USING (stream_id) LEFT JOIN m ON m.stream_id = ev.stream_id AND m.nid = ev.nid WHERE NOT is_background AND semantic_type IS DISTINCT FROM phrase
UNION ALL SELECT stream_id, 'relation explanation count mismatch' FROM ne WHERE a <> b
UNION ALL SELECT ed.stream_id, 'relation explanation mismatch' FROM ed JOIN ne ON ne.stream_id = ed.stream_id AND a = b JOIN ex ON ex.stream_id = ed.stream_id AND ex.pos = ed.pos WHERE ed.relation <> ex.relation
UNION ALL SELECT stream_id, 'recovery target introduces disallowed effect: ' || target || ' contains ' || effect FROM f WHERE effect IS NOT NULL""")
def semantic_errors(spark, d):
    return semantics.semantic_errors(**rules(spark, d))


@query(f"""WITH {RULES_SQL}, n AS (SELECT stream_id, nid FROM ev WHERE NOT is_background UNION ALL SELECT stream_id, 'E-7' FROM s WHERE stream_id % 5 = 0)
SELECT stream_id, 'mechanism node ' || nid || ' has no event' AS error FROM n WHERE nid = 'E-7'
UNION ALL SELECT stream_id, 'mechanism edge source ' || source || ' has no node' FROM ed WHERE source = 'E-1'
UNION ALL SELECT stream_id, 'mechanism edge ' || source || '->' || target || ' has invalid relation type' FROM ed WHERE relation = 'unknown'""")
def mechanism_rules(spark, d):
    x = rules(spark, d)
    nodes = x["nodes"].unionAll(x["streams"].where("stream_id % 5 = 0").select("stream_id", F.lit("E-7")))
    return V.mechanism_errors(nodes, x["edges"], x["events"])


@query(f"""WITH {G_SQL}, ed AS (SELECT stream_id, 'E' || root_id AS source FROM g WHERE NOT is_background AND parent_id IS NOT NULL AND stream_id % 2 = 0)
SELECT stream_id, 'too many tree children for ' || source || ': ' || count(*) AS error FROM ed GROUP BY stream_id, source HAVING count(*) > 3
UNION ALL SELECT stream_id, 'tree event ' || event_id || ' exceeds max depth' FROM g WHERE NOT is_background AND depth > 3 AND stream_id % 2 = 0""")
def tree_rules(spark, d):
    g = G(spark, d)
    star = g.where("not is_background and parent_id is not null").select("stream_id", F.concat(F.lit("E"), F.col("root_id").cast("string")).alias("source"), F.col("event_id").alias("target"))
    return V.tree_errors(star, g, g.select("stream_id").distinct().where("stream_id % 2 = 0"), 3, 3)


REGIME_SQL = "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'gamma' WHEN 2 THEN 'lognormal' WHEN 3 THEN 'deterministic_backoff' WHEN 4 THEN 'no such' ELSE 'exponential' END"


@query(f"""WITH {G_SQL}, r AS (SELECT g.*, {REGIME_SQL} AS regime, p.us AS p_us FROM g JOIN g p ON p.stream_id = g.stream_id AND p.event_id = g.parent_id WHERE NOT g.is_background), o AS (SELECT *, coalesce(delta_us > 0, false) AS ok FROM r)
SELECT stream_id, event_id, 'non-positive delta_t' AS error FROM o WHERE NOT ok UNION ALL SELECT stream_id, event_id, 'delta_t mismatch' FROM o WHERE ok AND abs(us - p_us - delta_us) > 1 UNION ALL SELECT stream_id, event_id, 'extreme delta_t' FROM o WHERE ok AND delta_us > 1000000000000
UNION ALL SELECT stream_id, event_id, 'no regime' FROM o WHERE ok AND regime IS NULL UNION ALL SELECT stream_id, event_id, 'unknown regime' FROM o WHERE ok AND regime = 'no such'
UNION ALL SELECT stream_id, event_id, 'invalid regime params' FROM o WHERE ok AND (regime = 'gamma' OR regime = 'exponential' AND event_id % 5 = 0 OR regime = 'lognormal' AND event_id % 3 = 0)""".replace("g.*, CASE event_id", "g.*, CASE g.event_id"))
def temporal_regimes(spark, d):
    """Gamma lacks its scale, every fifth rate is zero, every third mu is missing."""
    i = F.col("event_id")
    regime = F.when(i % 7 == 0, None).when(i % 7 == 1, "gamma").when(i % 7 == 2, "lognormal").when(i % 7 == 3, "deterministic_backoff").when(i % 7 == 4, "no such").otherwise("exponential")
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("double").alias("v"))
    params = F.map_from_entries(F.array_compact(F.array(pair("shape", F.lit(2.0)), pair("value", F.lit(1.0)), pair("lambda", F.when(i % 5 == 0, 0.0).otherwise(0.5)), pair("sigma", F.lit(0.3)), F.when(i % 3 != 0, pair("mu", F.lit(-1.0))))))
    return V.temporal_errors(G(spark, d).withColumns({"regime": regime, "regime_params": params}))


@query(f"""WITH {RULES_SQL} SELECT ed.stream_id, ed.pos, ed.source, ed.target, ed.relation, coalesce(nullif(trim(ex.explanation), ''), ed.source || ' has a ' || ed.relation || ' relation to ' || ed.target || '.') AS explanation
FROM ed LEFT JOIN ex ON ex.stream_id = ed.stream_id AND ex.pos = ed.pos""")
def relation_texts(spark, d):
    x = rules(spark, d)
    return semantics.relation_texts(x["edges"], x["explanations"].select("stream_id", "pos", "explanation"))


MECHANISM = "['direct_trigger', 'delayed_trigger', 'multi_hop_propagation', 'recovery', 'burst'][stream_id % 5 + 1]"


def _mechanism(col: str = "stream_id"):
    return F.get(F.array(*map(F.lit, ["direct_trigger", "delayed_trigger", "multi_hop_propagation", "recovery", "burst"])), (F.col(col) % 5).cast("int"))


def _list(xs: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _case(col: str, table: dict, other) -> str:
    one = lambda v: _list(v) if isinstance(v, list) else "'" + v.replace("'", "''") + "'"
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {one(v)}" for k, v in table.items()) + f" ELSE {one(other)} END"


@query(f"""WITH {G_SQL}, n AS (SELECT stream_id, 'E' || event_id AS node_id, row_number() OVER (PARTITION BY stream_id ORDER BY event_id) - 1 AS slot, CASE WHEN depth = 0 THEN 'root' WHEN depth = 4 THEN 'target' ELSE 'intermediate' END AS role, {MECHANISM} AS mt FROM g WHERE NOT is_background),
ed AS (SELECT stream_id, 'E' || root_id AS source, 'E' || event_id AS target FROM g WHERE NOT is_background AND parent_id IS NOT NULL), sg AS (SELECT stream_id, target AS node_id, 'children_of_' || source AS sibling_group FROM (SELECT *, count(*) OVER (PARTITION BY stream_id, source) AS c FROM ed) WHERE c > 1),
jj AS (SELECT n.*, sibling_group, {_case('mt', semantics.EFFECTS, semantics.OTHER_EFFECTS)} AS e, slot + coalesce(list_sum(list_transform(string_split(sibling_group, ''), lambda x: ord(x))) % 7, 0) AS turn FROM n LEFT JOIN sg USING (stream_id, node_id))
SELECT stream_id, node_id, slot::INT AS slot, role, CASE WHEN role = 'root' THEN 'initial condition or triggering observation' WHEN mt = 'recovery' THEN 'recovery step or recovery outcome' WHEN role = 'intermediate' THEN 'intermediate state transition' ELSE 'observable downstream consequence' END AS semantic_role,
e[(turn % len(e))::INT + 1] AS preferred_effect, CASE WHEN mt = 'recovery' THEN {_list(semantics.RECOVERY_STAGES)}[CASE WHEN role = 'root' OR slot = 0 THEN 1 ELSE least(slot, 2)::INT + 1 END] END AS recovery_stage, sibling_group FROM jj""")
def semantic_slots(spark, d):
    g = G(spark, d).where("not is_background")
    name = lambda x: F.concat(F.lit("E"), F.col(x).cast("string"))
    nodes = g.select("stream_id", F.col("event_id").alias("pos"), name("event_id").alias("node_id"), F.when(F.col("depth") == 0, "root").when(F.col("depth") == 4, "target").otherwise("intermediate").alias("role"))
    star = g.where("parent_id is not null").select("stream_id", name("root_id").alias("source"), name("event_id").alias("target"))
    return semantics.slots(nodes, star, g.select("stream_id").distinct().withColumn("mechanism_type", _mechanism()))


@query(f"""WITH {RULES_SQL}, jj AS (SELECT *, {MECHANISM} AS mt FROM ed) SELECT stream_id, source, target, relation, {_case('relation', semantics.BRIDGES, semantics.OTHER_BRIDGE)} AS bridge,
array_to_string({_case('mt', semantics.EFFECTS, semantics.OTHER_EFFECTS)}, '; ') AS allowed, array_to_string({_case('relation', semantics.DISALLOWED, semantics.OTHER_DISALLOWED)}, '; ') AS disallowed FROM jj""")
def edge_constraints(spark, d):
    x = rules(spark, d)
    out = semantics.edge_constraints(x["edges"], x["streams"].withColumn("mechanism_type", _mechanism()))
    return out.withColumns({"allowed": F.array_join("allowed", "; "), "disallowed": F.array_join("disallowed", "; ")})


@query("SELECT conv_id, turn, 'conv,text,ground_truth,at' AS keys FROM conversations")
def json_keys(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    odd = F.concat(F.col("text"), F.lit(' "root_id": {"x": 1} \\'))
    doc = F.to_json(F.struct(F.col("conv_id").alias("conv"), odd.alias("text"), F.struct(F.array(F.struct(F.col("turn").alias("at")))[0].alias("ground_truth")).alias("_")), {"ignoreNullFields": "false"})
    return c.select("conv_id", "turn", F.array_join(F.filter(semantics.keys_of(doc), lambda k: k != "_"), ",").alias("keys"))


@query(r"""SELECT conv_id, turn, regexp_replace(CASE WHEN conv_id % 2 = 0 THEN text || chr(10) || role ELSE text END, '^\s+|\s+$', '', 'g') AS said FROM conversations""")
def response_texts(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    part = lambda t, s: F.struct(F.lit(t).alias("type"), s.alias("text"))
    listed = F.to_json(F.struct(F.array(F.struct(F.array(part("reasoning", F.lit("no")), part("output_text", F.col("text"))).alias("content")), F.struct(F.array(part("text", F.col("role"))).alias("content"))).alias("output")))
    plain = F.to_json(F.struct(F.col("text").alias("output_text")))
    return c.select("conv_id", "turn", semantics.response_text(F.when(F.col("conv_id") % 2 == 0, listed).otherwise(plain)).alias("said"))


# ---- reports


@query(f"WITH {SCEN_SQL} SELECT count(*) AS sample_count, sum(approved::INT)::BIGINT AS approved_count, round(avg(approved::INT), 6) AS pass_rate, round(avg(score), 6) AS average_score, min(score) AS min_score, max(score) AS max_score FROM z")
def judge_summary(spark, d):
    return quality.judge_summary(scored(spark, d))


@query(f"""WITH {SCEN_SQL}, a AS (SELECT stream_id % 3 <> 0 AS own, stream_id % 4 <> 1 AS ok, CASE WHEN stream_id % 7 = 0 THEN 0 ELSE stream_id % 5 END AS n FROM s)
SELECT count(*) AS accepted_count, sum(own::INT)::BIGINT AS llm_semantic_count, round(avg(ok::INT) FILTER (WHERE own), 6) AS semantic_pass_rate, round(avg(n) FILTER (WHERE own), 6) AS average_attempts, max(n) FILTER (WHERE own)::BIGINT AS max_attempts, (SELECT count(*) FROM labels WHERE toxic = 1) AS rejected_count FROM a""")
def client_quality(spark, d):
    s = F.col("stream_id")
    accepted = scenarios(spark, d).select(F.when(s % 3 == 0, "rule").otherwise("llm").alias("semantic_method"), (s % 4 != 1).alias("semantic_approved"), F.when(s % 7 != 0, s % 5).alias("attempts"))
    return quality.client_quality(accepted, spark.read.parquet(f"{d}/labels.parquet").where("toxic = 1"))


@query(f"""WITH {SCEN_SQL}, y AS (SELECT *, {MECHANISM} AS mechanism_type, CASE WHEN stream_id % 3 = 0 THEN 'rule' ELSE 'llm' END AS method FROM z)
SELECT domain, mechanism_type, topology, method, {SUMMARY_SQL} FROM y GROUP BY GROUPING SETS ((domain), (mechanism_type), (topology), (method))""")
def audit_groups_all(spark, d):
    s = scored(spark, d).withColumns({"mechanism_type": _mechanism(), "method": F.when(F.col("stream_id") % 3 == 0, "rule").otherwise("llm")})
    return quality.summary(s, [["domain"], ["mechanism_type"], ["topology"], ["method"]])


@query(f"""WITH {SCEN_SQL}, y AS (SELECT domain, topology, {MECHANISM} AS mechanism_type, regimes[1] AS primary_regime, CASE WHEN stream_id % 4 = 0 THEN NULL ELSE 'd' || stream_id % 3 END AS background_density, len(phrases) AS n FROM s),
x AS (SELECT unnest([{{'dimension': 'domain', 'value': domain}}, {{'dimension': 'topology', 'value': topology}}, {{'dimension': 'mechanism_type', 'value': mechanism_type}}, {{'dimension': 'primary_regime', 'value': primary_regime}}, {{'dimension': 'background_density', 'value': background_density}}]) AS x FROM y
  UNION ALL SELECT {{'dimension': CASE topology WHEN 'chain' THEN 'chain_length' ELSE 'tree_nodes' END, 'value': n::VARCHAR}} FROM y)
SELECT x.dimension AS dimension, x.value AS value, count(*) AS n FROM x GROUP BY ALL""")
def coverage_all(spark, d):
    s = F.col("stream_id")
    rows = scenarios(spark, d).withColumns({"mechanism_type": _mechanism(), "primary_regime": F.get("regimes", F.lit(0)), "background_density": F.when(s % 4 != 0, F.concat(F.lit("d"), (s % 3).cast("string"))), "n_nodes": F.size("phrases")})
    return quality.coverage_report(rows)


@query(f"WITH {SCEN_SQL} SELECT stream_id, domain, description FROM s ORDER BY stream_id LIMIT 5")
def preview_rows(spark, d):
    return quality.previews(scenarios(spark, d), 5)


@query(f"""WITH {SCEN_SQL} SELECT stream_id, 'semantic_quality_gate' AS stage, array_to_string(issues, '; ') AS errors FROM z WHERE score < 0.7 OR len(issues) > 0
UNION ALL SELECT user_id, 'temporal', 'first' FROM events WHERE event_id % 50 = 0""")
def rejected_and_gated(spark, d):
    first = spark.read.parquet(f"{d}/events.parquet").where("event_id % 50 = 0").select(F.col("user_id").alias("stream_id"), F.lit("temporal").alias("stage"), F.lit(False).alias("approved"), F.array(F.lit("first")).alias("errors"))
    out = V.merge_rejected(first, quality.gate(scored(spark, d)).where("stage is not null"))
    return out.select("stream_id", "stage", F.array_join("errors", "; ").alias("errors"))


# ---- texts


@query(f"WITH {G_SQL} SELECT stream_id, event_id, 'event ' || event_id || ' [' || event_type || ']' || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '' ELSE ' (seen)' END AS label FROM g")
def event_labels(spark, d):
    i = F.col("event_id")
    return G(spark, d).select("stream_id", "event_id", qa.event_label(i, F.col("event_type"), F.when(i % 3 == 1, "").when(i % 3 == 2, "seen")).alias("label"))


@query(f"""WITH {G_SQL}, l AS (SELECT stream_id, string_agg('- event_id=' || event_id || '; timestamp=' || us || '; event=' || CASE WHEN event_id % 4 = 0 THEN 'told' ELSE event_type END, chr(10) ORDER BY us, event_id) AS x FROM g GROUP BY stream_id)
SELECT stream_id, 'Event stream:' || chr(10) || 'domain=' || CASE WHEN stream_id % 5 = 0 THEN 'unknown' ELSE 'D' || stream_id END || chr(10) || 'topology=' || CASE WHEN stream_id % 5 = 0 OR stream_id % 3 = 0 THEN 'unknown' ELSE 'chain' END || chr(10) || 'events in timestamp order:' || chr(10) || x AS input FROM l""")
def rendered_input(spark, d):
    g = G(spark, d).withColumn("semantic_type", F.when(F.col("event_id") % 4 == 0, "told").when(F.col("event_id") % 4 == 1, ""))
    s = F.col("stream_id")
    streams = g.select("stream_id").distinct().where("stream_id % 5 <> 0").select("stream_id", F.concat(F.lit("D"), s.cast("string")).alias("domain"), F.when(s % 3 != 0, "chain").alias("topology"))
    return qa.render(g, streams)


@query(f"WITH {SCEN_SQL} SELECT stream_id, 'In the ' || domain || ' domain, a ' || topology || ' ' || {MECHANISM} || ' event stream links ' || array_to_string(phrases, '; ') || '.' AS scenario FROM s")
def scenario_description(spark, d):
    return scenarios(spark, d).select("stream_id", semantics.scenario_description(F.col("domain"), F.col("topology"), _mechanism(), F.col("phrases")).alias("scenario"))


# ---- streaming


@query(f"""WITH {E_SQL} SELECT stream_id, us, event_type, lag(event_type) OVER w AS previous, lag(event_type, 2) OVER w AS before_previous, count(*) OVER r AS recent,
count(*) OVER (PARTITION BY stream_id, event_type ORDER BY us RANGE BETWEEN 7200000000 PRECEDING AND CURRENT ROW) AS recent_same, count(*) OVER r >= 3 AS is_bursty, round((us - min(us) OVER (PARTITION BY stream_id)) / 1e6, 6) AS since_root
FROM e WINDOW w AS (PARTITION BY stream_id ORDER BY us, event_type), r AS (PARTITION BY stream_id ORDER BY us RANGE BETWEEN 7200000000 PRECEDING AND CURRENT ROW)""")
def stream_history(spark, d):
    """The state of history_state kept by a streaming query."""
    from ..streaming import folds

    e = folds.read_events(spark, d).select(F.col("user_id").alias("stream_id"), S.micros("ts").alias("us"), "event_type")
    return folds.run_to_files(folds.history(e, 7_200_000_000), scratch.path(spark, "stream-history"))
