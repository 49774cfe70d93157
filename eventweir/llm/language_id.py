"""Language identification by Bayesian evidence fusion.

    log P(lang | evidence) = log prior(lang | host) + log P(text | lang) + log P(declared | lang) + log P(suffix | lang) + constant

* Text: a naive Bayes model over hashed byte trigrams of the lower-cased text. Its languages are the ``max_languages`` most frequent
  declared values with at least ``min_rows`` rows that hold a letter; it counts the trigrams of all their rows. Trigrams of running
  text aren't independent, so the sum is divided by ``temper``.
* Declared markup language and address suffix: P(value | lang) from counts over all rows, smoothed.
* Host prior: counts over all rows of each host's languages, smoothed towards the parent domain, that towards its parent, and so
  on to the whole table: p_child = (counts_child + kappa * p_parent) / (n_child + kappa).

Counts come from grouped aggregation of each row's best language by text alone, pre-aggregated before the shuffle, so that a
host with a third of all rows costs one row for each task. No row is evidence about itself: its own vote is taken out of the counts of
its host, its host's parents, its declared language and its suffix before they speak about it. The declared language teaches the text model
and is evidence of its own; ``use_declared=False`` holds the second use back, which is how tests measure what the rest is worth. A row is
accepted if it holds a letter and the best posterior reaches ``accept``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._batches import flat_bytes, pieces
from ._shared import materialise

BUCKETS = 1 << 15

# ---- text likelihood


def trigram_buckets(flat: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at each of the first len - 2 bytes; A-Z count as a-z, digits and ASCII punctuation as a space."""
    f = FOLD[flat].astype(np.uint32)
    return ((f[:-2] * np.uint32(0x9E3779B1) ^ f[1:-1] * np.uint32(0x85EBCA6B) ^ f[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)) if len(f) > 2 else np.zeros(0, np.uint32)


FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32
assert 32 - 17 == BUCKETS.bit_length() - 1


def languages(rows: DataFrame, max_languages: int, min_rows: int) -> list[str]:
    """The declared values that count as languages, in order of the alphabet."""
    letter = F.col("_text").rlike(r"[A-Za-z\x{80}-\x{10FFFF}]")
    n = rows.where(F.col("_declared").isNotNull() & letter).groupBy("_declared").count().where(F.col("count") >= min_rows)
    return sorted(r[0] for r in n.orderBy(F.desc("count"), "_declared").limit(max_languages).collect())


def trigram_counts(rows: DataFrame, langs: list[str]) -> np.ndarray:
    """Counts (languages x buckets) over all rows of each language; every task adds up its own before anything is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS), np.int64)
        for part, text in pieces(batches, "_text", 1 << 20):
            flat, offs = flat_bytes(text)
            b = trigram_buckets(flat)
            of = part.column(part.schema.get_field_index("_lang")).to_numpy()
            a, e = offs[:-1], np.maximum(offs[1:] - 2, offs[:-1])
            inside = np.zeros(len(b) + 1, np.int32)
            lang = np.repeat(of, np.diff(offs))[: len(b)]
            full = e > a
            np.add.at(inside, a[full], 1)
            np.add.at(inside, e[full], -1)
            keep = np.cumsum(inside[:-1]) > 0
            total += np.bincount(lang[keep] * BUCKETS + b[keep], minlength=total.size).reshape(total.shape)
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total.reshape(-1)[i])], ["i", "n"])

    known = rows.where(F.col("_declared").isin(langs)).select((F.array_position(F.array(*map(F.lit, langs)), F.col("_declared")) - 1).alias("_lang"), "_text")
    out = np.zeros(len(langs) * BUCKETS, np.int64)
    summed = known.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows for each language
    out[summed.column("i").to_numpy()] = summed.column("n").to_numpy()
    return out.reshape(len(langs), BUCKETS)


def text_model(rows: DataFrame, max_languages: int, min_rows: int, alpha: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities of shape languages x buckets)."""
    langs = languages(rows, max_languages, min_rows)
    if not langs:
        return ["und"], np.full((1, BUCKETS), -np.log(BUCKETS))
    c = trigram_counts(rows, langs) + alpha
    return langs, np.log(c / c.sum(1, keepdims=True))


def text_scores(rows: DataFrame, langs: list[str], logp: np.ndarray, temper: float) -> DataFrame:
    """Adds _ll (array, one value for each language) and _letters (the text holds a letter)."""
    table = np.ascontiguousarray(logp, np.float32)
    keep = [c for c in rows.columns if c != "_text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = (FOLD != 32) & (np.arange(256) >= 32)
        for part, text in pieces(batches, "_text", 1 << 20):
            flat, offs = flat_bytes(text)
            b = trigram_buckets(flat)
            out = np.zeros((len(text), len(langs)))
            a, e = offs[:-1], np.maximum(offs[1:] - 2, offs[:-1])
            full = np.flatnonzero(e > a)
            if len(full):
                bounds = np.stack([a[full], e[full]], axis=1).reshape(-1)
                for k in range(len(langs)):  # one language at a time, so that memory doesn't grow with their number
                    out[full, k] = np.add.reduceat(np.append(table[k][b], np.float32(0)), bounds, dtype=np.float64)[::2]
            has = np.concatenate([[0], np.cumsum(letter[flat])])
            scores = pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1) * len(langs), pa.int32()), pa.array((out / temper).reshape(-1)))
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in keep], scores, pa.array(has[offs[1:]] > has[offs[:-1]])], [*keep, "_ll", "_letters"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", _ll array<double>, _letters boolean")


# ---- evidence tables


def levels(host: Column, n: int) -> list[Column]:
    """The host itself, then its parent domains, n in all; the last is the top-level domain."""
    return [F.coalesce(host, F.lit(""))] + [F.substring_index(F.coalesce(host, F.lit("")), ".", k) for k in range(-(n - 1), 0)]


def tallies(rows: DataFrame, key: Column, n: int, name: str) -> DataFrame:
    """(_key, name): how many rows of each key have each of the n languages as their best."""
    votes = rows.groupBy(key.alias("_key"), "_best").agg(F.count(F.lit(1)).alias("c"))
    got = votes.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("_best", "c"))).alias("m"))  # at most n entries
    return got.select("_key", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at("m", i.cast("long")), F.lit(0)).cast("double")).alias(name))


def listed(df: DataFrame, name: str, most: int) -> DataFrame:
    """df, written, and sent to every task if its counted rows are no more than most."""
    df = materialise(df, name)
    return F.broadcast(df) if df.count() <= most else df


def host_counts(sure: DataFrame, n: int, depth: int, most: int) -> DataFrame:
    """(_key, _host_counts): for each host the counts of itself, then of its parent domains."""
    hosts = materialise(tallies(sure, F.coalesce("_host", F.lit("")), n, "_c0"), "hosts")
    keys = levels(F.col("_key"), depth)
    out = hosts
    for j in range(1, depth):
        level = hosts.groupBy(keys[j].alias("_up")).agg(F.array(*[F.sum(F.col("_c0")[i]) for i in range(n)]).alias(f"_c{j}"))
        out = out.withColumn("_k", keys[j]).join(listed(level, "domains", most), F.col("_k") == F.col("_up")).drop("_k", "_up")
    return out.select("_key", F.array(*[f"_c{j}" for j in range(depth)]).alias("_host_counts"))


def total_of(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def without(counts: Column, own: Column) -> Column:
    """Counts less the row's own vote."""
    return F.zip_with(counts, own, lambda c, o: F.greatest(c - o, F.lit(0.0)))


def identify(
    rows: DataFrame, id_col: str, text: Column, declared: Column | None = None, suffix: Column | None = None, host: Column | None = None, max_languages: int = 64, min_rows: int = 5, temper: float = 8.0, kappa: float = 20.0, accept: float = 0.6, host_levels: int = 3,
    broadcast_rows: int = 1 << 17, use_declared: bool = True,
) -> DataFrame:
    """One row per input row: id_col, _uid, lang, posterior, text_lang, accepted.

    _uid is 64 bits of hash of what the answer depends on; rows that share it and their id have the same answer. lang is null, posterior
    0 and accepted false where the text holds no letter (null and empty texts included). Missing declared languages, suffixes and hosts
    say nothing. Equal posteriors go to the language first in the alphabet. An empty table, or one without any declared language of
    ``min_rows`` rows, gives "und" for all. Null ids stay null. Other columns, whatever their names, aren't looked at.
    """
    none = F.lit(None).cast("string")
    own = rows.select(
        rows[id_col].alias("_id"), F.coalesce(text.cast("string"), F.lit("")).alias("_text"), F.lower(declared if declared is not None else none).alias("_declared"),
        F.lower(suffix if suffix is not None else none).alias("_suffix"), F.lower(host if host is not None else none).alias("_host"),
    ).withColumn("_uid", uid("_text", "_declared", "_suffix", "_host"))
    langs, logp = text_model(own, max_languages, min_rows)
    n = len(langs)
    scored = text_scores(own, langs, logp, temper)
    scored = materialise(scored.withColumn("_best", F.array_position("_ll", F.array_max("_ll")) - 1), "text-scores")
    sure = scored.where("_letters")
    votes = {r["_best"]: r["c"] for r in sure.groupBy("_best").agg(F.count(F.lit(1)).alias("c")).collect()}  # one row for each language
    total = F.array(*[F.lit(float(votes.get(i, 0))) for i in range(n)])
    own_vote = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(F.col("_letters") & (F.col("_best") == i), 1.0).otherwise(0.0))
    out = beside(scored, listed(host_counts(sure, n, host_levels, broadcast_rows), "evidence", broadcast_rows), F.coalesce("_host", F.lit("")))
    for name, given in (("_declared", declared if use_declared else None), ("_suffix", suffix)):
        if given is not None:
            counts = listed(tallies(sure.where(F.col(name).isNotNull()), F.col(name), n, f"{name}_counts"), "evidence", broadcast_rows)
            totals = counts.agg(*[F.coalesce(F.sum(F.col(f"{name}_counts")[i]), F.lit(0.0)).alias(f"t{i}") for i in range(n)], F.count(F.lit(1)).alias("k")).first()
            out = beside(out, counts, F.col(name)).withColumn(f"{name}_all", F.array(*[F.lit(float(totals[f"t{i}"])) for i in range(n)])).withColumn(f"{name}_k", F.lit(float(totals["k"] + 1)))
    # The host's prior: from the whole table down to the host itself, each level less the row's own vote. Sums are columns of their own, not
    # reckoned anew for each language.
    out = out.withColumn("_own", own_vote).withColumn("_all", F.transform(without(total, F.col("_own")), lambda c: c + 1.0))
    out = out.withColumn("_n", total_of(F.col("_all")))
    steps = F.reverse(F.transform(F.coalesce("_host_counts", F.array().cast("array<array<double>>")), lambda c: without(c, F.col("_own"))))
    out = out.withColumn("_steps", F.transform(steps, lambda c: F.struct(c.alias("c"), (total_of(c) + kappa).alias("n"))))
    prior = F.aggregate("_steps", F.transform("_all", lambda c: c / F.col("_n")), lambda p, s: F.zip_with(s["c"], p, lambda x, q: (x + kappa * q) / s["n"]))
    out = out.withColumn("_sum", F.zip_with("_ll", prior, lambda a, q: a + F.ln(q)))
    for name, given in (("_declared", declared if use_declared else None), ("_suffix", suffix)):
        if given is not None:
            of = without(F.col(f"{name}_counts"), F.col("_own"))
            among = without(F.col(f"{name}_all"), F.col("_own"))
            ll = F.zip_with(of, among, lambda c, t: F.ln((c + 1.0) / (t + F.col(f"{name}_k"))))
            out = out.withColumn("_sum", F.when(F.col(f"{name}_counts").isNull(), F.col("_sum")).otherwise(F.zip_with("_sum", ll, lambda a, b: a + b)))
    out = out.withColumn("_top", F.array_max("_sum"))
    best = F.array_position("_sum", F.col("_top")).cast("int")
    post = F.lit(1.0) / F.aggregate("_sum", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))
    names = F.array(*map(F.lit, langs))
    return out.select(
        F.col("_id").alias(id_col), "_uid", F.when(F.col("_letters"), names[best - 1]).alias("lang"), F.when(F.col("_letters"), post).otherwise(0.0).alias("posterior"),
        F.when(F.col("_letters"), names[(F.col("_best")).cast("int")]).alias("text_lang"), (F.col("_letters") & (post >= accept)).alias("accepted"),
    )


def uid(*cols: Column | str) -> Column:
    """64 bits of hash; where nulls are counts too."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def beside(rows: DataFrame, table: DataFrame, col: Column) -> DataFrame:
    return rows.withColumn("_jk", col).join(table, F.col("_jk") == table["_key"], "left").drop("_jk", "_key")


# ---- tables


def identify_documents(docs: DataFrame, **kw) -> DataFrame:
    """documents (doc_id, text, lang, source): lang is the declared language, source the host."""
    return identify(docs, "doc_id", docs["text"], declared=docs["lang"], host=docs["source"], **kw)


def identify_pages(pages: DataFrame, **kw) -> DataFrame:
    """pages (page_id, url, html): the language of the markup, the address's last path language or top-level domain, and its host."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    declared = F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1), F.lit(""))
    host = F.nullif(F.regexp_extract(pages["url"], r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    path = F.nullif(F.regexp_extract(pages["url"], r"^[^:]+://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1), F.lit(""))
    return identify(pages, "page_id", text, declared=declared, suffix=F.coalesce(path, F.substring_index(host, ".", -1)), host=host, **kw)


def keep_identified(docs: DataFrame, broadcast_rows: int = 1 << 19, **kw) -> DataFrame:
    """docs that are accepted, all columns as they were.

    Null and empty texts and texts without a letter go; null ids don't matter; rows that repeat stay or go together; an empty table stays
    empty; extra columns are kept. Texts are shuffled only if the counted rows that go are too many to broadcast.
    """
    found = identify_documents(docs, **kw).where("not accepted").select(F.col("doc_id").alias("__ew_id"), F.col("_uid").alias("__ew_uid")).distinct()
    no = materialise(found, "not-identified")
    no = F.broadcast(no) if no.count() <= broadcast_rows else no
    none = F.lit(None).cast("string")
    own = uid(F.coalesce(docs["text"].cast("string"), F.lit("")), F.lower(docs["lang"]), F.lower(none), F.lower(docs["source"]))
    return docs.join(no, docs["doc_id"].eqNullSafe(no["__ew_id"]) & (own == no["__ew_uid"]), "left_anti")
