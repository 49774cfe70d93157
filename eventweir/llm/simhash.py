"""SimHash near-dedup with pigeonring filtering.

A fingerprint has a bit where more than half of the shingles' hashes have it. Two fingerprints link at ``distance`` differing bits
or fewer. The bits are laid out as a ring of distance + 1 segments. By the pigeonring principle, two linked fingerprints have a
segment from which every chain of l consecutive segments differs in at most floor(l * distance / segments) bits: the first
segment not at all, the first two in no more than one bit, and so on round the ring.

Candidates meet in buckets keyed by the start of such a chain: the first segment, and one of the pieces into which the next segment
is cut so that at least one piece is untouched by the differences its chain still allows. A bucket with more than ``most`` rows
is cut further by pieces of the third segment and then of the fourth, under their own budgets, so no link is lost and buckets
stay small. Within a bucket the remaining chain budgets are checked before the full distance, and only a spanning
forest of the verified links leaves it, not all pairs. Components then follow from alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import as_bytes, pieces
from ._shared import materialise

BITS = 64
U = np.uint64


# ---- fingerprints


def shingle_hashes(text: bytes, width: int) -> list[int]:
    from xxhash import xxh64_intdigest as h

    words = text.lower().split()
    if len(words) <= width:
        return [h(b" ".join(words), 42)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [h(line[a:b], 42) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of counts[i] hashes; zero for none."""
    out = np.zeros(len(counts), U)
    full = np.flatnonzero(counts)
    if len(full):
        n = counts[full]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        bits = np.unpackbits(np.ascontiguousarray(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(votes * 2 > n[:, None], axis=1).view(">u8").reshape(-1).astype(U)
    return out


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the long columns ``also``, fp) of each row: whole texts, A-Z lower-cased, words between ASCII white space. A null text has no words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in pieces(batches, "text", 1 << 20):
            each = [shingle_hashes(t, width) for t in as_bytes(text)]
            counts = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.array([h for x in each for h in x], U)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("doc_id", *also)), pa.array(majority(flat, counts).view(np.int64))], ["doc_id", *also, "fp"])

    given = docs.select(docs[id_col].cast("long").alias("doc_id"), *also, docs[text_col].cast("string").alias("text"))
    return given.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", *also, "fp")))


# ---- candidates


def ring(distance: int) -> list[tuple[int, int]]:
    """(shift, bits) of each segment."""
    m = distance + 1
    ends = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def cut(shift: int, bits: int, n: int) -> list[tuple[int, int]]:
    ends = [bits * i // n for i in range(n + 1)]
    return [(shift + a, b - a) for a, b in zip(ends, ends[1:])]


def keyed(rows: DataFrame, distance: int, link: int) -> DataFrame:
    """Adds to rows the keys of chains of ``link`` + 1 segments. Link 0 starts with the first segment alone."""
    segs = ring(distance)
    m = len(segs)

    def field(shift: int, bits: int):
        return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << bits) - 1)

    if link == 0:
        each = [F.struct(F.lit(i).alias("start"), F.array(F.lit(i).cast("long"), field(*segs[i])).alias("key")) for i in range(m)]
    else:
        each = []
        for i in range(m):
            budget = (link + 1) * distance // m
            for j, piece in enumerate(cut(*segs[(i + link) % m], budget + 1)):
                each.append(F.struct(F.lit(i).alias("start"), F.concat(F.col("key"), F.array(F.lit(j).cast("long"), field(*piece))).alias("key")))
        if "key" in rows.columns:
            keys = F.filter(F.array(*each), lambda e: e["start"] == F.col("start"))
            return rows.withColumn("_k", F.explode(keys)).select("fp", "rep", F.col("_k.start").alias("start"), F.col("_k.key").alias("key"))
    return rows.withColumn("_k", F.explode(F.array(*each))).select("fp", "rep", F.col("_k.start").alias("start"), F.col("_k.key").alias("key"))


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def chain_ok(x: np.ndarray, start: np.ndarray | int, distance: int) -> np.ndarray:
    """Whether the differences x keep within the budget of every chain from segment start."""
    segs = ring(distance)
    m = len(segs)
    per = np.stack([np.bitwise_count((x >> U(s)) & U((1 << b) - 1)) for s, b in segs])
    ok, total = np.ones(x.shape, bool), np.zeros(x.shape, np.int64)
    cols = np.arange(len(x))
    for l in range(1, m + 1):
        total += per[(start + l - 1) % m, cols]
        ok &= total <= l * distance // m
    return ok


def forest(fp: np.ndarray, start: int, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over one bucket, as pairs of positions: a search that compares one row with all that are left."""
    left, links = np.arange(len(fp)), []
    while len(left) > 1:
        hub, left = left[0], left[1:]
        todo = [hub]
        while todo and len(left):
            at = todo.pop()
            near = differing(fp[left], fp[at]) <= distance
            near[near] = chain_ok(fp[left[near]] ^ fp[at], np.full(near.sum(), start), distance)
            links += [(int(at), int(i)) for i in left[near]]
            todo += left[near].tolist()
            left = left[~near]
    return links


SMALL = 6


def bucket_links(distance: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def links(t: pa.Table) -> pa.RecordBatch:
            h, fp, rep, start = (t.column(c).to_numpy() for c in ("bucket", "fp", "rep", "start"))
            fp = fp.view(U)
            edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(np.concatenate([edges, [len(h)]]))
            of = np.repeat(size, size)
            a, b = [], []
            for d in range(1, SMALL):
                i = np.flatnonzero((h[d:] == h[:-d]) & (of[d:] <= SMALL)) if len(h) > d else np.zeros(0, np.int64)
                x = fp[i] ^ fp[i + d]
                ok = np.bitwise_count(x) <= distance
                ok[ok] = chain_ok(x[ok], start[i[ok]], distance)
                a.append(rep[i[ok]])
                b.append(rep[i[ok] + d])
            for s, n in zip(edges[size > SMALL], size[size > SMALL]):
                got = np.array(forest(fp[s : s + n], int(start[s]), distance), np.int64).reshape(-1, 2)
                a.append(rep[s + got[:, 0]])
                b.append(rep[s + got[:, 1]])
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            t = pa.concat_tables(held)
            h = t.column("bucket").to_numpy()
            last = int(np.searchsorted(h, h[-1])) if len(h) else 0  # the last bucket may go on in the next batch
            if last:
                yield links(t.slice(0, last))
            held = [t.slice(last)] if len(h) else []
        if held:
            yield links(pa.concat_tables(held))

    return run


def fingerprint_links(distinct: DataFrame, distance: int, most: int) -> DataFrame:
    """(u, v), u > v: links between the representatives of distinct fingerprints (fp, rep), enough to connect what is linked."""
    rows = keyed(distinct, distance, 0)
    done = None
    for link in range(1, distance + 1):
        rows = keyed(rows, distance, link).withColumn("bucket", F.xxhash64("start", "key"))
        if link == distance:
            fine = rows
        else:
            hot = rows.groupBy("bucket").count().where(F.col("count") > most).select("bucket")
            fine, rows = rows.join(hot, "bucket", "left_anti"), rows.join(hot, "bucket", "left_semi")
        fine = fine.select("bucket", "fp", "rep", "start")
        done = fine if done is None else done.unionAll(fine)
    if done is None:  # distance 0 links nothing but equal fingerprints
        return distinct.select(F.col("rep").alias("u"), F.col("rep").alias("v")).where("false")
    return done.repartition("bucket").sortWithinPartitions("bucket", "fp").mapInArrow(bucket_links(distance), "u long, v long").distinct()


# ---- components


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node that has a link: root is the smallest node it is connected to. Alternating large and small stars."""
    state = materialise(links, "links")
    before = None
    while True:
        both = state.unionAll(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")  # so that a star with many links can be split in the join
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "links")
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        state = materialise(small, "links")
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def fingerprint_components(prints: DataFrame, distance: int, most: int) -> DataFrame:
    """(fp, root, component_id) of each fingerprint. Nodes are fingerprints, whatever the ids of their rows; component_id is the smallest id."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(fingerprint_links(distinct.select("fp", F.col("fp").alias("rep")), distance, most))
    rooted = materialise(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "roots")
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return materialise(rooted.join(low, "root").select("fp", "root", "component_id"), "components")  # so that the rows of a hot fingerprint can be split in the join


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text", most: int = 1024) -> DataFrame:
    """One row per input row: id_col, fingerprint (16 hex digits), component_id (the smallest id reachable over links).

    Empty and null texts share fingerprint zero and link like any other. Equal fingerprints are one node, so copies are never paired.
    Rows with a null id link like any other; a component of null ids only has a null component_id. Rows that repeat an id are rows
    of their own: they meet only if their fingerprints do.
    """
    prints = materialise(fingerprints(docs, width, id_col, text_col), "fingerprints")
    of_fp = fingerprint_components(prints, distance, most)
    return prints.join(of_fp, "fp").select(F.col("doc_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


ROW = ("__ew_row1", "__ew_row2")


def row_keys(docs: DataFrame) -> DataFrame:
    """docs with a key of 128 bits for each row, taken from all columns that can be hashed; rows that are equal in them share it."""
    cols = [docs[c] for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    # a null leaves xxhash64 as it is, so where nulls are is hashed too
    return docs.withColumns({name: F.xxhash64(F.lit(i), *cols, *[c.isNull() for c in cols]) for i, name in enumerate(ROW)})


def first_of_each(rows: DataFrame, rooted: DataFrame, broadcast_rows: int = 1 << 20) -> DataFrame:
    """rows, without their keys, of which exactly one stays for each root: that of the smallest id, nulls last. rooted: (doc_id, keys, root).
    Whole rows are shuffled only if the counted rows that go are too many to broadcast; of rows that stay only those that repeat are."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW)
    shared = materialise(rooted.groupBy("root").agg(F.min(order).alias("s"), F.count(F.lit(1)).alias("n")).where("n > 1").select("root", *[F.col(f"s.{k}").alias(f"{k}_first") for k in ROW]), "first")
    stays = (F.col(ROW[0]) == F.col(f"{ROW[0]}_first")) & (F.col(ROW[1]) == F.col(f"{ROW[1]}_first"))
    keys = materialise(rooted.join(shared, "root").groupBy(*ROW).agg(F.max(stays).alias("stays"), F.count(F.lit(1)).alias("n")).where("not stays or n > 1"), "keys")
    goes, repeated = keys.where("not stays").select(*ROW), keys.where("stays").select(*ROW)

    def small(df: DataFrame, n: int) -> DataFrame:
        return F.broadcast(df) if n <= broadcast_rows else df

    n_goes, n_repeated = goes.count(), repeated.count()
    left = rows.join(small(goes, n_goes), list(ROW), "left_anti") if n_goes else rows
    if n_repeated:
        again = small(repeated, n_repeated)
        left = left.join(again, list(ROW), "left_anti").unionByName(left.join(again, list(ROW), "left_semi").dropDuplicates(list(ROW)))
    return left.drop(*ROW)


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text", most: int = 1024) -> DataFrame:
    """docs with exactly one row of each component: that of the smallest id, null ids last; of rows with that id the one with the smallest hash of its
    columns. Null and empty texts are one component; of rows that repeat one stays; an empty table stays empty; extra columns are kept."""
    rows = row_keys(docs)
    prints = materialise(fingerprints(rows, width, id_col, text_col, ROW), "fingerprints")
    return first_of_each(rows, prints.join(fingerprint_components(prints, distance, most), "fp"))
