"""Scenarios: slots of a mechanism, phrases for them, and the client that may write them instead.

Rule mode is a lookup of phrases by position. Client mode calls an injected object with ``complete(prompt) -> str`` for each stream, with
retries that name the errors, behind a cache table keyed by the prompt's hash, so that a rerun only asks for what is missing.
"""

from __future__ import annotations

import hashlib
import json
import os
import urllib.request
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .validate import mapping_diff, zip_compare

# ---- fixed values

RECOVERY_STAGES = ["fault detection or diagnosis", "containment or routing mitigation", "repair action or restoration verification"]
ROLES = {
    "root": "initial condition or triggering observation",
    "recovery": "recovery step or recovery outcome",
    "intermediate": "intermediate state transition",
    "target": "observable downstream consequence",
    "other": "event state",
}
EXPLANATION = "{source} has a {relation} relation to {target}."
EFFECTS = {
    "direct_trigger": ["immediate operational effect", "detected downstream state change", "triggered workflow action"],
    "delayed_trigger": ["accumulated condition", "delayed review outcome", "threshold-crossing effect"],
    "multi_hop_propagation": ["propagated state transition", "intermediate dependency activation", "downstream impact"],
    "recovery": ["diagnosis", "mitigation", "repair action", "reroute action", "restoration verification"],
}
OTHER_EFFECTS = ["domain-specific state change", "workflow action", "observable consequence"]
BRIDGES = {
    "direct_trigger": "Explain the immediate mechanism that makes the target follow from the source.",
    "delayed_trigger": "Explain the waiting condition, accumulation, or review latency between source and target.",
    "weak_trigger": "Explain why the source increases the likelihood of the target without making it inevitable.",
    "recovery": "Explain how the target mitigates, repairs, reroutes, restores, or verifies recovery from the source.",
}
OTHER_BRIDGE = "Explain the concrete cause-effect bridge for this edge."
DISALLOWED = {
    "recovery": ["new fault", "new outage", "new blockage", "risk escalation"],
    "direct_trigger": ["unexplained hidden intermediate", "unrelated administrative follow-up"],
    "delayed_trigger": ["instantaneous effect", "unexplained direct jump"],
    "weak_trigger": ["deterministic guarantee", "unrelated event"],
}
OTHER_DISALLOWED = ["unrelated event", "duplicated sibling meaning"]
EFFECT_ALIASES = {
    "new fault": ["new fault", "new failure"],
    "new outage": ["new outage"],
    "new blockage": ["new blockage", "blockage", "blocks", "blocked"],
    "risk escalation": ["risk escalation", "risk increases", "escalates risk"],
}
FORBIDDEN = ["ground_truth", "parent_id", "root_id", "relation_to_parent", "regime", "is_background"]


class Client(Protocol):
    def complete(self, prompt: str) -> str: ...


class HttpClient:
    """Asks a responses endpoint over HTTP. Address, model and key come as arguments or from EVENTWEIR_URL, EVENTWEIR_MODEL and EVENTWEIR_KEY."""

    def __init__(self, url: str | None = None, model: str | None = None, key: str | None = None, timeout: float = 60.0, max_tokens: int = 1200, send: Callable = urllib.request.urlopen):
        self.url, self.model, self.key = url or os.environ.get("EVENTWEIR_URL", ""), model or os.environ.get("EVENTWEIR_MODEL", ""), key or os.environ.get("EVENTWEIR_KEY", "")
        if not (self.url and self.model and self.key):
            raise ValueError("an address, a model and a key are needed")
        self.timeout, self.max_tokens, self.send = timeout, max_tokens, send

    def complete(self, prompt: str) -> str:
        body = json.dumps({"model": self.model, "input": prompt, "max_output_tokens": self.max_tokens}).encode()
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with self.send(request, timeout=self.timeout) as answer:
            doc = json.load(answer)
        texts = [str(c.get("text", "")) for o in doc.get("output") or [] for c in o.get("content") or [] if c.get("type") in ("output_text", "text")]
        if not texts and "output_text" not in doc:
            raise ValueError("the answer holds no output text")
        return ("\n".join(texts) if texts else str(doc["output_text"])).strip()


JUDGE = """Score how plausible and concrete this scenario is. Answer with one JSON object with the keys approved, score (0 to 1), issues and suggestions.
Scenario: """


def judged(client: Client, scenario: str, threshold: float = 0.7) -> dict:
    """approved, score, issues and suggestions of one scenario (JSON text); an answer that can't be read is a failed judgement."""
    try:
        got = extract_json(client.complete(JUDGE + scenario))
        score, issues = float(got.get("score", 0.0)), [str(x) for x in got.get("issues") or []]
        if score < threshold and "score below threshold" not in issues:
            issues.append("score below threshold")
        return {"approved": bool(got.get("approved", False)) and score >= threshold, "score": round(score, 6), "issues": issues, "suggestions": [str(x) for x in got.get("suggestions") or []]}
    except Exception as e:  # whatever the client raises is this scenario's failure, not the job's
        return {"approved": False, "score": 0.0, "issues": [f"judge failed: {e}"], "suggestions": []}


def judge_scenarios(scenarios: DataFrame, client: Callable[[], Client], threshold: float = 0.7, concurrency: int = 8) -> DataFrame:
    """(stream_id, approved, score, issues, suggestions) for scenarios (stream_id, scenario) that aren't null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = client()
        for pdf in batches:
            yield pd.DataFrame([{"stream_id": x.stream_id} | judged(c, x.scenario, threshold) for x in pdf.itertuples()], columns=["stream_id", "approved", "score", "issues", "suggestions"])

    rows = scenarios.where("scenario is not null").select(F.col("stream_id").cast("string").alias("stream_id"), "scenario")
    return rows.repartition(concurrency, "stream_id").mapInPandas(run, "stream_id string, approved boolean, score double, issues array<string>, suggestions array<string>")


def phrase(phrases: Column, i: Column) -> Column:
    """The i-th phrase, going round; from the second round on with its number."""
    n = F.size(phrases)
    again = F.floor(i / n).cast("int")
    return F.concat(F.get(phrases, (i % n).cast("int")), F.when(again > 0, F.concat(F.lit(" #"), (again + 1).cast("string"))).otherwise(""))


def domain_phrases(streams: DataFrame, phrases: DataFrame, fallback: str) -> DataFrame:
    """streams with event_phrases and background_phrases of their domain or the fallback one; phrases has one row for each domain."""
    spare = phrases.where(F.col("domain") == fallback).select(F.struct("event_phrases", "background_phrases").alias("_spare"))
    own = phrases.select("domain", F.struct("event_phrases", "background_phrases").alias("_own"))
    if spare.isEmpty():
        lost = streams.join(own, "domain", "left_anti").select("domain").distinct().limit(5).collect()
        if lost:
            raise ValueError(f"no phrases for {', '.join(str(r[0]) for r in lost)} and none for the fallback {fallback!r}")
    j = streams.join(own, "domain", "left").join(spare, F.lit(True), "left")  # spare is one row, or none where it isn't needed
    return j.withColumn("_p", F.coalesce("_own", "_spare")).select(*streams.columns, "_p.event_phrases", "_p.background_phrases")


def instantiate(events: DataFrame, streams: DataFrame) -> DataFrame:
    """events (stream_id, pos, node_id, is_background) with semantic_type: causal events by their node's number, background ones by their order.
    streams: (stream_id, event_phrases, background_phrases)."""
    own = Window.partitionBy("stream_id", "is_background").orderBy("pos")
    j = events.withColumn("_i", (F.row_number().over(own) - 1)).join(streams.select("stream_id", "event_phrases", "background_phrases"), "stream_id")
    node = F.coalesce(F.expr("try_cast(substr(node_id, 2) as int)"), F.col("_i"))
    return j.withColumn("semantic_type", F.when(F.col("is_background"), phrase(F.col("background_phrases"), F.col("_i"))).otherwise(phrase(F.col("event_phrases"), node))).drop("_i", "event_phrases", "background_phrases")


def relation_explanation(source: Column, relation: Column, target: Column) -> Column:
    a, b, c = EXPLANATION.replace("{relation}", "|").replace("{source}", "").replace("{target}", "|").split("|")
    return F.concat(source, F.lit(a), F.replace(relation, F.lit("_"), F.lit(" ")), F.lit(b), target, F.lit(c))


def relation_texts(edges: DataFrame, given: DataFrame) -> DataFrame:
    """Each edge (stream_id, pos, source, target, relation) with the explanation given at its position (stream_id, pos, explanation), or a plain
    sentence where there is none or a blank one."""
    j = edges.join(given.select("stream_id", "pos", F.nullif(F.trim("explanation"), F.lit("")).alias("_said")), ["stream_id", "pos"], "left")
    a, b, c = EXPLANATION.replace("{relation}", "|").replace("{source}", "").replace("{target}", "|").split("|")
    plain = F.concat("source", F.lit(a), "relation", F.lit(b), "target", F.lit(c))
    return j.select(*edges.columns, F.coalesce("_said", plain).alias("explanation"))


def scenario_description(domain: Column, topology: Column, mechanism: Column, phrases: Column) -> Column:
    return F.concat(F.lit("In the "), domain, F.lit(" domain, a "), topology, F.lit(" "), mechanism, F.lit(" event stream links "), F.array_join(phrases, "; "), F.lit("."))


def stable_offset(text: Column) -> Column:
    """Sum of the characters' codes modulo 7."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda a, c: a + F.ascii(c)) % 7


def semantic_role(role: Column, mechanism: Column) -> Column:
    first = F.when(role == "root", ROLES["root"]).when(mechanism == "recovery", ROLES["recovery"])
    return first.when(role == "intermediate", ROLES["intermediate"]).when(role == "target", ROLES["target"]).otherwise(ROLES["other"])


def recovery_stage(role: Column, i: Column, mechanism: Column) -> Column:
    stages = F.array(*map(F.lit, RECOVERY_STAGES))
    return F.when(mechanism == "recovery", F.when((role == "root") | (i == 0), F.get(stages, F.lit(0))).otherwise(F.get(stages, F.least(i.cast("int"), F.lit(len(RECOVERY_STAGES) - 1)))))


def by_name(table: dict[str, list[str]], other: list[str], name: Column) -> Column:
    out = F.array(*map(F.lit, other))
    for k, v in table.items():
        out = F.when(name == k, F.array(*map(F.lit, v))).otherwise(out)
    return out


def slots(nodes: DataFrame, edges: DataFrame, streams: DataFrame) -> DataFrame:
    """What each node (stream_id, pos, node_id, role) of a mechanism may stand for: its place among the nodes named E..., role, preferred kind of
    effect, recovery stage and group of siblings. edges: (stream_id, source, target), streams: (stream_id, mechanism_type)."""
    own = causal_nodes(nodes).withColumn("slot", F.row_number().over(Window.partitionBy("stream_id").orderBy("pos")) - 1)
    ends = edges.where(F.col("source").startswith("E") & F.col("target").startswith("E"))
    n = F.count(F.lit(1)).over(Window.partitionBy("stream_id", "source"))
    group = ends.withColumn("n", n).where("n > 1").groupBy("stream_id", F.col("target").alias("node_id")).agg(F.concat(F.lit("children_of_"), F.min("source")).alias("sibling_group"))
    j = own.join(group, ["stream_id", "node_id"], "left").join(streams.select("stream_id", "mechanism_type"), "stream_id")
    effects = by_name(EFFECTS, OTHER_EFFECTS, F.col("mechanism_type"))
    turn = F.col("slot") + F.when(F.col("sibling_group").isNull(), 0).otherwise(stable_offset(F.coalesce("sibling_group", F.lit(""))))
    return j.withColumn("_e", effects).select(
        "stream_id", "node_id", F.col("slot").cast("int").alias("slot"), "role", semantic_role(F.col("role"), F.col("mechanism_type")).alias("semantic_role"),
        F.get("_e", (turn % F.size("_e")).cast("int")).alias("preferred_effect"), recovery_stage(F.col("role"), F.col("slot"), F.col("mechanism_type")).alias("recovery_stage"), "sibling_group",
    )


def edge_constraints(edges: DataFrame, streams: DataFrame) -> DataFrame:
    """For each edge between nodes named E...: the bridge its explanation must give, the effects its mechanism allows and those its relation rules
    out. A missing relation is the stream's mechanism type."""
    j = edges.where(F.col("source").startswith("E") & F.col("target").startswith("E")).join(streams.select("stream_id", "mechanism_type"), "stream_id")
    j = j.withColumn("relation", F.coalesce("relation", "mechanism_type"))
    bridge = F.get(by_name({k: [v] for k, v in BRIDGES.items()}, [OTHER_BRIDGE], F.col("relation")), F.lit(0))
    return j.select("stream_id", "source", "target", "relation", bridge.alias("bridge"), by_name(EFFECTS, OTHER_EFFECTS, F.col("mechanism_type")).alias("allowed"), by_name(DISALLOWED, OTHER_DISALLOWED, F.col("relation")).alias("disallowed"))


def causal_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("node_id").startswith("E"))


def keys_of(doc: Column) -> Column:
    """Every key of a JSON text, at any depth, in order. All its strings are read one after the other, so text that looks like a key isn't one."""
    strings = F.regexp_extract_all(doc, F.lit(r'("(?:[^"\\]|\\.)*"\s*:?)'), F.lit(1))
    return F.transform(F.filter(strings, lambda s: s.endswith(":")), lambda s: F.regexp_replace(s, r'^"|"\s*:$', ""))


def disallowed_effect(text: Column, effects: Column) -> Column:
    """The first of the effects that the text names, by any of its words for it; null for none."""
    low = F.lower(text)

    def named(effect: Column) -> Column:
        words = by_name(EFFECT_ALIASES, [], effect).cast("array<string>")
        return F.exists(F.when(F.size(words) > 0, words).otherwise(F.array(effect)), lambda w: F.contains(low, w))

    return F.get(F.filter(effects, named), F.lit(0))


def semantic_errors(streams: DataFrame, nodes: DataFrame, mapping: DataFrame, events: DataFrame, edges: DataFrame, explanations: DataFrame) -> DataFrame:
    """(stream_id, error) of every rule a scenario breaks.

    streams: (stream_id, scenario (JSON text or null), description, status), nodes: (stream_id, node_id), mapping: (stream_id, node_id, phrase),
    events: (stream_id, event_id, node_id, is_background, semantic_type), edges: (stream_id, pos, source, target, relation), explanations: the same
    and explanation. A stream without a scenario breaks that rule and is looked at no further.
    """
    c, say = F.col, lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x]).alias("error")
    told = streams.where("scenario is not null")
    own = lambda df: df.join(told.select("stream_id"), "stream_id", "left_semi")
    out = [streams.where("scenario is null").select("stream_id", say("semantic_scenario is missing"))]
    keys = told.select("stream_id", F.explode(keys_of(c("scenario"))).alias("k"))
    out.append(keys.where(c("k").isin(*FORBIDDEN)).select("stream_id", say("forbidden semantic field: ", c("k"))))
    out.append(told.where(F.trim(F.coalesce("description", F.lit(""))) == "").select("stream_id", say("scenario_description is empty")))
    out.append(told.where(~c("status").eqNullSafe(F.lit("instantiated"))).select("stream_id", say("metadata.semantic_status is not instantiated")))
    diff = mapping_diff(own(causal_nodes(nodes)).select("stream_id", "node_id").distinct(), own(mapping).select("stream_id", "node_id"))
    out.append(diff.select("stream_id", say(c("side"), " semantic mapping for ", c("node_id"))))
    out.append(mapping_mismatch(own(events), mapping))
    triple = F.concat_ws("|", F.coalesce("source", F.lit("None")), F.coalesce("target", F.lit("None")), F.coalesce("relation", F.lit("None")))
    pairs = zip_compare(own(explanations).select("stream_id", "pos", triple.alias("value")), own(edges).select("stream_id", "pos", triple.alias("value")))
    out.append(pairs.select("stream_id", say("relation explanation ", F.when(c("pos") < 0, "count mismatch").otherwise("mismatch"))))
    last = explanations.groupBy("stream_id", "target").agg(F.max_by("explanation", "pos").alias("said"))
    ends = own(edges).where("relation = 'recovery' and source like 'E%' and target like 'E%'").select("stream_id", "target").join(last, ["stream_id", "target"], "left")
    ends = ends.join(mapping.select("stream_id", c("node_id").alias("target"), "phrase"), ["stream_id", "target"], "left")
    text = F.concat(F.coalesce("phrase", F.lit("")), F.lit(" "), F.coalesce("said", F.lit("")))
    bad = ends.select("stream_id", "target", disallowed_effect(text, F.array(*map(F.lit, DISALLOWED["recovery"]))).alias("effect")).where("effect is not null")
    out.append(bad.select("stream_id", say("recovery target introduces disallowed effect: ", c("target"), " contains ", c("effect"))))
    return reduce(DataFrame.unionAll, out)


def mapping_mismatch(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """(stream_id, error): causal events told otherwise than their node is mapped, and background events whose node is mapped at all."""
    c = F.col
    j = events.join(mapping.select("stream_id", "node_id", "phrase", F.lit(True).alias("_mapped")), ["stream_id", "node_id"], "left")
    said = F.when(c("is_background") & c("_mapped").isNotNull(), F.concat(F.lit("background event "), c("event_id").cast("string"), F.lit(" appears in event_mapping")))
    said = said.when(~c("is_background") & ~c("semantic_type").eqNullSafe(c("phrase")), F.concat(F.lit("event "), c("event_id").cast("string"), F.lit(" semantic_type does not match mapping")))
    return j.select("stream_id", said.alias("error")).where("error is not null")


def response_text(payload: Column) -> Column:
    """The text of an answer in the responses format: its output_text and text parts, a line each, else its output_text field, else an error."""
    kind = "output array<struct<content:array<struct<type:string,text:string>>>>, output_text string"
    p = F.from_json(payload, kind)
    parts = F.flatten(F.transform(F.coalesce(p["output"], F.array()), lambda o: F.coalesce(o["content"], F.array())))
    texts = F.transform(F.filter(parts, lambda x: x["type"].isin("output_text", "text")), lambda x: F.coalesce(x["text"], F.lit("")))
    strip = lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")
    return F.when(F.size(texts) > 0, strip(F.array_join(texts, "\n"))).when(p["output_text"].isNotNull(), strip(p["output_text"])).otherwise(F.raise_error(F.lit("the answer holds no output text")).cast("string"))


def forbidden_keys(doc: str) -> list[str]:
    """Forbidden keys anywhere in a JSON document."""
    out, todo = set(), [json.loads(doc)]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            out |= set(x) & set(FORBIDDEN)
            todo += x.values()
        elif isinstance(x, list):
            todo += x
    return sorted(out)


def extract_json(text: str) -> dict:
    """The object between the first { and the last } of an answer."""
    a, b = text.find("{"), text.rfind("}")
    if a < 0 or b <= a:
        raise ValueError("no JSON object in the answer")
    return json.loads(text[a : b + 1])


def scenario_errors(doc: dict, nodes: list[str]) -> list[str]:
    got = doc.get("event_mapping") or {}
    out = [f"missing mapping for {n}" for n in nodes if not str(got.get(n, "")).strip()] + [f"extra mapping for {n}" for n in sorted(set(got) - set(nodes))]
    out += ["empty scenario description"] * (not str(doc.get("scenario_description", "")).strip())
    return out + [f"forbidden field {k}" for k in forbidden_keys(json.dumps(doc))]


ANSWER = "key string, stream_id string, scenario string, attempts int, errors array<string>"


def ask(prompts: DataFrame, client: Callable[[], Client], retries: int = 2, judge: Callable[[dict], tuple[float, str]] | None = None, threshold: float = 0.8, concurrency: int = 8) -> DataFrame:
    """Scenarios for prompts (key, stream_id, prompt, nodes): each asked up to 1 + retries times, the errors of one attempt, and the judge's word
    if its score is below the threshold, added to the next prompt."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = client()
        for pdf in batches:
            rows = []
            for x in pdf.itertuples():
                said, errors, doc = x.prompt, [], None
                for attempt in range(1, retries + 2):
                    try:
                        doc = extract_json(c.complete(said))
                        errors = scenario_errors(doc, list(x.nodes))
                        if not errors and judge:
                            score, word = judge(doc)
                            errors = [] if score >= threshold else [word]
                    except ValueError as e:
                        errors = [str(e)]
                    if not errors:
                        break
                    said = x.prompt + "\nThe last answer was rejected: " + "; ".join(errors)
                rows.append((x.key, x.stream_id, json.dumps(doc, sort_keys=True, ensure_ascii=False) if doc and not errors else None, attempt, errors))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in ANSWER.split(", ")])

    return prompts.repartition(concurrency, "key").mapInPandas(run, ANSWER)


def ask_cached(prompts: DataFrame, cache: DataFrame, client: Callable[[], Client], version: str = "1", **kw) -> tuple[DataFrame, DataFrame]:
    """(answers, rows to append to the cache). cache has the columns of ANSWER; only prompts without an accepted answer are asked."""
    keyed = prompts.withColumn("key", F.sha2(F.concat_ws("|", F.lit(version), "prompt"), 256))
    good = cache.where("scenario is not null")
    new = ask(keyed.join(good, "key", "left_anti"), client, **kw)
    old = keyed.select("key", "stream_id").join(good.drop("stream_id"), "key").select(*new.columns)
    return old.unionByName(new), new


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
