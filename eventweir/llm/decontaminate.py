"""Benchmark decontamination by a broadcast hash set of normalised test n-grams, with DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words. An item's windows are its runs of ``n`` consecutive words (an item with fewer
words is one window). A document window of m words holds, wherever it starts, a whole block of g = (m + 1) // 2 words that
begins at a multiple of g; so only every g-th block of a document is hashed and looked up in the set of all g-grams of the
windows. Around each block that is found the full windows are rebuilt and compared as strings: a hash decides nothing.

Texts are known by 128 bits of hash, since what is hit depends on the text alone. One pass over the documents looks up the blocks of all
window lengths at once and carries no words along; only texts with a block in the set are read again and cut into windows.

The sets are broadcast only while the counted number of their rows times a bound on the bytes of a row stays within
``broadcast_bytes``; beyond that the same joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import materialise, text_or_empty

# What separates words, after lower-casing.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    text = text_or_empty(text)
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def window_at(ws: Column, start: Column, m: int) -> Column:
    """The m words from the 0-based start, joined by a space."""
    return F.array_join(F.slice(ws, start + 1, m), " ")


def item_windows(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """(window, m, items): every distinct window, its words and the items it occurs in."""
    w = benchmark.select(benchmark[item_col].cast("string").alias("_item"), words(benchmark[text_col]).alias("_w")).where(F.size("_w") > 0)
    w = w.withColumn("m", F.least(F.size("_w"), F.lit(n)))
    at = w.select("_item", "m", "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - F.col("m"))).alias("_s"))
    return (
        at.select("_item", "m", F.array_join(F.slice("_w", F.col("_s") + 1, F.col("m")), " ").alias("window"))
        .groupBy("window", "m")
        .agg(F.collect_set("_item").alias("items"))
    )


TEXT = ["_t1", "_t2"]


def text_key(text: Column) -> list[Column]:
    t = text_or_empty(text)
    return [F.xxhash64(t).alias("_t1"), F.xxhash64(F.lit(1), t).alias("_t2")]


def bounded(df: DataFrame, size: int, most: int) -> DataFrame:
    return F.broadcast(df) if size <= most else df


def find_hits(texts: DataFrame, windows: DataFrame, broadcast_bytes: int) -> DataFrame | None:
    """(_t1, _t2, _s, m, items) for each place where a window occurs; None if there are no windows. texts has (_t1, _t2, text)."""
    sizes = {r["m"]: (r["n"], r["b"]) for r in windows.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("window") + 16 + 40 * F.size("items")).alias("b")).collect()}  # at most n rows
    if not sizes:
        return None
    block = {m: (m + 1) // 2 for m in sizes}
    g = (F.col("m") + 1).cast("int") / 2
    parts = windows.select(F.split("window", " ").alias("_x"), "m", F.floor(g).cast("int").alias("g"))
    grams = parts.select("g", F.explode(F.transform(F.sequence(F.lit(0), F.col("m") - F.col("g")), lambda i: F.xxhash64("g", F.slice("_x", i + 1, F.col("g"))))).alias("h")).distinct()
    grams = bounded(grams, sum(n * (m - block[m] + 1) * 32 for m, (n, _) in sizes.items()), broadcast_bytes)

    def blocks(k: int) -> Column:
        at = F.sequence(F.lit(0), F.size("_w") - k, F.lit(k))
        found = F.transform(at, lambda p: F.struct(F.lit(k).alias("g"), p.alias("p"), F.xxhash64(F.lit(k), F.slice("_w", p + 1, k)).alias("h")))
        return F.when(F.size("_w") >= min(m for m in block if block[m] == k), found).otherwise(found_none)

    found_none = F.array().cast("array<struct<g:int,p:int,h:bigint>>")
    cut = texts.select(*TEXT, words(F.col("text")).alias("_w"))
    each = cut.select(*TEXT, F.explode(F.concat(*[blocks(k) for k in sorted(set(block.values()))])).alias("_b")).select(*TEXT, "_b.*")
    near = materialise(each.join(grams, ["g", "h"], "left_semi").select(*TEXT, "g", "p").distinct(), "near-blocks")
    n_near = near.count()
    at = near.groupBy(*TEXT).agg(F.collect_list(F.struct("g", "p")).alias("_at"))
    held = texts.join(bounded(at, n_near * 48, broadcast_bytes), TEXT).select(*TEXT, "_at", words(F.col("text")).alias("_w"))

    def around(m: int) -> Column:
        low = lambda a: F.greatest(a["p"] - (m - block[m]), F.lit(0))
        mine = F.filter("_at", lambda a: (a["g"] == block[m]) & (low(a) <= F.size("_w") - m))
        starts = F.array_distinct(F.flatten(F.transform(mine, lambda a: F.sequence(low(a), F.least(a["p"], F.size("_w") - m)))))
        return F.transform(starts, lambda s: F.struct(F.lit(m).alias("m"), s.alias("_s"), window_at(F.col("_w"), s, m).alias("window")))

    whole = held.select(*TEXT, F.explode(F.concat(*[around(m) for m in sorted(sizes)])).alias("_c")).select(*TEXT, "_c.*")
    return whole.join(bounded(windows, sum(b for _, b in sizes.values()), broadcast_bytes), ["window", "m"]).select(*TEXT, "_s", "m", "items")


def hits_of(docs: DataFrame, benchmark: DataFrame, n: int, text_col: str, item_col: str, item_text_col: str, broadcast_bytes: int) -> DataFrame | None:
    windows = materialise(item_windows(benchmark, n, item_col, item_text_col), "item-windows")
    return find_hits(docs.select(*text_key(docs[text_col]), text_or_empty(docs[text_col]).alias("text")), windows, broadcast_bytes)


def hits_by_text(hits: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(_t1, _t2, _items, _hit): items and positions of each text that is hit; broadcast if its counted size allows."""
    per = (
        hits.groupBy(*TEXT)
        .agg(F.collect_set(F.struct("_s", "m")).alias("_spans"), F.collect_set("items").alias("_lists"))
        .select(
            *TEXT,
            F.array_sort(F.array_distinct(F.flatten("_lists"))).alias("_items"),
            F.array_sort(F.array_distinct(F.flatten(F.transform("_spans", lambda a: F.sequence(a["_s"], a["_s"] + a["m"] - 1))))).alias("_hit"),
        )
    )
    per = materialise(per, "hits-by-text")
    size = per.agg(F.sum(64 + 4 * F.size("_hit").cast("long") + F.octet_length(F.array_join("_items", " ")) + 24 * F.size("_items"))).first()[0] or 0
    return bounded(per, size, broadcast_bytes)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: id_col, n_words, n_hit, n_items, items (array, sorted), hit_words (sorted positions), contaminated.

    A null or empty text has no words and is clean; an empty benchmark leaves all documents clean; items without words have no
    window. Rows that repeat get the same answer each, null ids stay null, an empty table gives an empty result. Other columns,
    whatever their names, are not looked at.
    """
    hits = hits_of(docs, benchmark, n, text_col, item_col, item_text_col, broadcast_bytes)
    rows = docs.select(docs[id_col].alias("_id"), *text_key(docs[text_col]), F.size(words(docs[text_col])).alias("n_words"))
    none = F.array().cast("array<string>")
    if hits is None:
        out = rows.withColumns({"items": none, "hit_words": F.array().cast("array<int>")})
    else:
        out = rows.join(hits_by_text(hits, broadcast_bytes), TEXT, "left")
        out = out.withColumns({"items": F.coalesce("_items", none), "hit_words": F.coalesce("_hit", F.array().cast("array<int>"))})
    return out.select(
        F.col("_id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", "hit_words", (F.size("hit_words") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """docs without those that hold a window of the benchmark; all columns as they were.

    Null and empty texts, texts shorter than every window, and all texts where the benchmark is empty or has no words, stay; ids aren't looked
    at, so null and repeated ids don't matter; rows that repeat stay or go together. Texts are shuffled only if the counted list of
    those that go is too large to broadcast.
    """
    hits = hits_of(docs, benchmark, n, text_col, item_col, item_text_col, broadcast_bytes)
    if hits is None:
        return docs
    bad = materialise(hits.select(*[F.col(k).alias(f"__ew{k}") for k in TEXT]).distinct(), "contaminated")
    t1, t2 = text_key(docs[text_col])
    return docs.join(bounded(bad, bad.count() * 32, broadcast_bytes), (t1 == bad["__ew_t1"]) & (t2 == bad["__ew_t2"]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(id_col, text): of each text that is hit, the normalised words that aren't, joined by a space; other texts as they were, nulls too.

    A text's hits are looked up by the text, so rows that share an id keep their own words. An empty benchmark changes nothing.
    """
    hits = hits_of(docs, benchmark, n, text_col, item_col, item_text_col, broadcast_bytes)
    own = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_said"), *text_key(docs[text_col]))
    if hits is None:
        return own.select(F.col("_id").alias(id_col), F.col("_said").alias("text"))
    own = own.join(hits_by_text(hits, broadcast_bytes), TEXT, "left")
    own = own.select("_id", "_said", "_hit", F.when(F.col("_hit").isNotNull(), words(F.col("_said"))).alias("_w"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_w") - 1), "_hit")
    kept = F.array_join(F.transform(left, lambda i: F.get("_w", i)), " ")
    return own.select(F.col("_id").alias(id_col), F.when(F.col("_hit").isNull(), F.col("_said")).otherwise(kept).alias("text"))
