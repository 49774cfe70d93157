"""Near copies by Jaccard similarity of word shingles: SimHash fingerprints, candidates by pigeonring chains, each verified on the whole shingle sets.

Two sets link at 4/5 or more. The majority bits of such sets differ in 15 % of all places at most, give or take chance, whatever their
length; sets link loosely if they keep within BUDGET, 28 %. The fingerprint's bits are a ring. By the pigeonring principle two
prints within the budget have starts on the ring from which every chain of bits keeps within it. Exact chains of so wide a budget would
have to begin with segments too short to filter, so a chain begins with ``width`` bits that agree, which the index looks up at ``starts``
places of the ring, as many as make a pair at 4/5 agree somewhere with probability 0.9999; closer pairs do more surely. width grows
with the number of texts, and the ring with both, so that buckets stay short and segments don't overlap. Within a bucket the chain is
followed for 64 and for 128 bits more, each within its budget, and a spanning forest of what holds leaves it.

Every loose component then gets the shingle sets of its members once, and all pairs in it are compared exactly, so that neither a chance
likeness of prints links anything nor a missed chain between two members loses anything. A component of more than ``most`` members is dealt out
to pairs of its parts. Nodes are distinct shingle sets, so equal sets are never paired. Texts without words are alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import as_bytes, pieces
from ._shared import materialise
from .simhash import ROW, components, first_of_each, row_keys, shingle_hashes

ALIKE = (4, 5)
DIFFER = 0.1516  # share of bits in which the prints of two sets at 4/5 differ: arccos(8 / 9) / pi
BUDGET = 0.28
MISS = 1e-4
FILL = 1024  # texts to a bucket
CODE = 12  # bits of the size that a key ends with
NEAR_SIZES = 12  # sizes at 4/5 differ by so many steps of 2 % at most
LONG = 4096  # a bucket of more rows is searched hub by hub
FILTERED = 1 << 21  # so many wanted texts are told apart by a filter of two bits each
U = np.uint64
ODD = U(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: The eight bits of a byte as the bytes of a word, so that one addition counts eight places.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(U)[:, 0]


class Ring(NamedTuple):
    width: int
    starts: int
    bits: int

    @classmethod
    def of(cls, texts: int) -> Ring:
        width = max(4, math.ceil(math.log2(max(texts, 1) / FILL)))
        starts = math.ceil(-math.log(MISS) / (1 - DIFFER) ** width)
        return cls(width, starts, max(512, -(-starts * width // 64) * 64))


def shingle_sets(text: pa.Array, width: int) -> list[np.ndarray]:
    return [np.unique(np.array(shingle_hashes(t, width), U)) for t in as_bytes(text)]


def prints(flat: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """The fingerprint of each run of counts[i] > 0 hashes, as rows of bytes: a bit is set where more than half of the hashes, mixed anew for each word, have it."""
    cuts = -(-counts // 255)  # a byte counts to 255
    first = np.cumsum(cuts) - cuts
    starts = np.repeat(np.cumsum(counts) - counts, cuts) + 255 * (np.arange(cuts.sum()) - np.repeat(first, cuts))
    out = np.empty((len(counts), bits), bool)
    for word in range(bits // 64):
        each = mixed(flat ^ (np.array([word], U) * ODD)).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            some = np.add.reduceat(SPREAD[each[:, byte]], starts).view(np.uint8).reshape(-1, 8)
            votes = np.add.reduceat(some, first, axis=0, dtype=np.int64)
            at = word * 64 + byte * 8
            out[:, at : at + 8] = votes * 2 > counts[:, None]
    return np.packbits(out, axis=1, bitorder="little")


def signatures(rows: DataFrame, width: int, bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row key, node, n, print): node is the hash of the shingle set, n its size; print is null for a text without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as h

        for batch, text in pieces(batches, "text", 1 << 20):
            sets = shingle_sets(text, width)
            counts = np.fromiter(map(len, sets), np.int64, len(sets))
            full = counts > 0
            made = iter(prints(np.concatenate(sets), counts[full], bits) if full.any() else ())
            each = pa.array([next(made).tobytes() if n else None for n in counts], pa.binary())
            node = np.fromiter((h(s.tobytes()) for s in sets), U, len(sets)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *ROW)), pa.array(node), pa.array(counts), each], ["doc_id", *ROW, "node", "n", "print"])

    given = rows.select(rows[id_col].cast("long").alias("doc_id"), *ROW, rows[text_col].cast("string").alias("text"))
    return given.mapInArrow(run, f"doc_id long, {ROW[0]} long, {ROW[1]} long, node long, n long, print binary")


def chains(nodes: DataFrame, ring: Ring) -> DataFrame:
    """(k, node, near, far) for each start: k holds the start, the segment there and the size of the set, near and far the next 64 bits of the ring each."""
    width, starts, bits = ring

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            each = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, bits // 8)
            around = np.unpackbits(each, axis=1, bitorder="little")
            around = np.concatenate([around, around[:, : width + 128]], axis=1)
            code = (np.log(batch.column(1).to_numpy()) / math.log(1.02)).astype(np.int64)
            powers = 1 << np.arange(width, dtype=np.int64)
            for i in range(starts):
                at = i * bits // starts
                k = (((i << width) + around[:, at : at + width] @ powers) << CODE) + code
                after = np.packbits(around[:, at + width : at + width + 128], axis=1, bitorder="little").view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k), batch.column(0), pa.array(after[:, 0].copy()), pa.array(after[:, 1].copy())], ["k", "node", "near", "far"])

    return nodes.select("node", "n", "print").mapInArrow(run, "k long, node long, near long, far long")


def runs(batches: Iterable[pa.RecordBatch], key: Callable[[pa.Table], np.ndarray]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys; the last run of a batch may go on in the next one."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        k = key(t)
        if held and k[-1] == key(held[0])[0]:
            held.append(t)
            continue
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        if held or last:
            yield pa.concat_tables([*held, t.slice(0, last)])
        held = [t.slice(last)]
    if held:
        yield pa.concat_tables(held)


def edges_of(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return at, np.diff(np.concatenate([at, [len(k)]]))


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it is connected to) of the nodes that are not the least themselves."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = np.minimum(low, low[low])
        if (low == root).all():
            break
        root = low
    less = np.flatnonzero(root != np.arange(len(root)))
    return nodes[less], nodes[root[less]]


def bucket_links(ring: Ring) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    most_near, most_far = (int((ring.width + n) * BUDGET) for n in (64, 128))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, lambda t: t.column("k").to_numpy() >> CODE):
            k, node, near, far = (t.column(c).to_numpy() for c in ("k", "node", "near", "far"))
            near, far = near.view(U), far.view(U)

            def hold(i: np.ndarray, j: np.ndarray | int) -> np.ndarray:
                """Which chains keep within their budgets."""
                first = np.bitwise_count(near[i] ^ near[j])
                ok = np.flatnonzero(first <= most_near)
                j = j if np.ndim(j) == 0 else j[ok]
                return ok[first[ok].astype(np.int64) + np.bitwise_count(far[i[ok]] ^ far[j]) <= most_far]

            u, v = [], []
            at, n = edges_of(k >> CODE)
            i, d = np.flatnonzero(np.repeat(n <= LONG, n)), 0
            while len(i):
                d += 1
                i = i[: np.searchsorted(i, len(k) - d)]
                i = i[k[i + d] - k[i] <= NEAR_SIZES]  # no size fills its bits, so rows of two buckets lie further apart
                ok = hold(i, i + d)
                u.append(node[i[ok]])
                v.append(node[i[ok] + d])
            for s, m in zip(at[n > LONG].tolist(), n[n > LONG].tolist()):
                left = np.arange(s, s + m)
                while len(left) > 1:
                    todo, left = [int(left[0])], left[1:]
                    while todo and len(left):
                        hub = todo.pop()
                        a, b = np.searchsorted(k[left], [k[hub] - NEAR_SIZES, k[hub] + NEAR_SIZES + 1])
                        ok = a + hold(left[a:b], hub)
                        u.append(np.full(len(ok), node[hub]))
                        v.append(node[left[ok]])
                        todo += left[ok].tolist()
                        left = np.delete(left, ok)
            if u:
                u, v = stars(np.concatenate(u), np.concatenate(v))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def verified(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a spanning forest over sets, as pairs of positions: a search that compares one set with all that are left."""
    a, b = ALIKE
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    left, links = np.arange(len(sets)), []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            hub = todo.pop()
            can = left[np.minimum(size[left], size[hub]) * b >= np.maximum(size[left], size[hub]) * a]
            if not len(can):
                continue
            flat, mine = np.concatenate([sets[i] for i in can]), sets[hub]
            hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
            both = np.add.reduceat(hit, np.cumsum(size[can]) - size[can], dtype=np.int64)
            near = can[both * b >= (size[can] + size[hub] - both) * a]
            links += [(int(hub), int(i)) for i in near]
            todo += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    return links


def group_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in runs(batches, lambda t: t.column("part").to_numpy()):
        at, n = edges_of(t.column("part").to_numpy())
        node, u, v = t.column("node").to_numpy(), [], []
        for s, m in zip(at.tolist(), n.tolist()):
            got = verified([np.frombuffer(x.as_buffer(), U) for x in t.column("shingles").slice(s, m)])
            u += [node[s + i] for i, _ in got]
            v += [node[s + j] for _, j in got]
        u, v = np.array(u, np.int64), np.array(v, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])


def places(keys: np.ndarray, mask: int) -> np.ndarray:
    return np.concatenate([mixed(keys.view(U)) & U(mask), mixed(keys.view(U) ^ ODD) & U(mask)]).astype(np.int64)


def shingles_of(rows: DataFrame, wanted: DataFrame, width: int, text_col: str) -> DataFrame:
    """(node, shingles) of the nodes of wanted (node, row key). Texts aren't shuffled where a filter can tell nearly all that aren't wanted."""
    n, passing = wanted.count(), None
    if n <= FILTERED:
        keys = wanted.select(ROW[0]).toArrow().column(0).to_numpy()
        mask = (1 << max(10, (16 * n).bit_length())) - 1
        passing = np.zeros(mask + 1, bool)
        passing[places(keys, mask)] = True
        passing = np.packbits(passing, bitorder="little")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if passing is not None:
                at = places(batch.column(0).to_numpy(), len(passing) * 8 - 1)
                both = ((passing[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).reshape(2, -1)
                batch = batch.filter(pa.array(both[0] & both[1]))
            for some, text in pieces([batch], "text", 1 << 20):
                each = pa.array([s.tobytes() for s in shingle_sets(text, width)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), each], [*ROW, "shingles"])

    texts = rows.select(*ROW, rows[text_col].cast("string").alias("text"))
    if passing is None:
        texts = texts.join(wanted.select(*ROW), list(ROW), "left_semi")
    made = texts.mapInArrow(sets, f"{ROW[0]} long, {ROW[1]} long, shingles binary")
    return made.join(wanted, list(ROW)).select("node", "shingles").dropDuplicates(["node"])


def set_links(rows: DataFrame, signed: DataFrame, ring: Ring, width: int, text_col: str, most: int) -> DataFrame:
    """(u, v), u > v: links between nodes, enough to connect what is linked."""
    nodes = materialise(signed.where("n > 0").groupBy("node").agg(F.min(F.struct(*ROW, "n", "print")).alias("s")).select("node", "s.*"), "nodes")
    buckets = chains(nodes, ring).repartition(F.shiftright("k", CODE)).sortWithinPartitions("k")
    loose = components(buckets.mapInArrow(bucket_links(ring), "u long, v long").distinct())
    groups = materialise(loose.select(F.col("root").alias("group"), "node").unionAll(loose.select("root", "root").distinct()), "groups")
    wanted = materialise(nodes.join(groups, "node", "left_semi").select("node", *ROW), "candidates")
    return links_within(groups, shingles_of(rows, wanted, width, text_col), most)


def links_within(groups: DataFrame, own: DataFrame, most: int) -> DataFrame:
    """(u, v), u > v: a spanning forest of the verified links of each group (group, node); own: (node, shingles)."""
    large = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    dealt = groups.join(materialise(large, "large"), "group", "left").withColumn("parts", F.coalesce(F.ceil(F.col("n") / most), F.lit(1)).cast("int"))
    mine = F.pmod(F.xxhash64("node", "group"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("i", mine).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    part = F.when(F.col("parts") == 1, F.col("group")).otherwise(F.xxhash64("group", F.least("i", "j"), F.greatest("i", "j")))
    sent = dealt.select(part.alias("part"), "node").join(own, "node").select("part", "node", "shingles")
    return sent.repartition("part").sortWithinPartitions("part").mapInArrow(group_links, "u long, v long").distinct()


def one_of_alike(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text", most: int = 4096) -> DataFrame:
    """docs with exactly one row of each component of near copies: that of the smallest id, null ids last; of rows with that id the one with the
    smallest hash of its columns. Null and empty texts are one component; of rows that repeat one stays; an empty table stays empty; extra columns
    are kept."""
    rows, ring = row_keys(docs), Ring.of(docs.count())
    signed = materialise(signatures(rows, width, ring.bits, id_col, text_col), "signatures")
    roots = components(set_links(rows, signed, ring, width, text_col, most))
    of_node = signed.select("doc_id", *ROW, "node").join(materialise(roots, "roots"), "node", "left")
    return first_of_each(rows, of_node.select("doc_id", *ROW, F.coalesce("root", "node").alias("root")))
