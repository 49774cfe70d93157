"""What the two substring operators share: where in a corpus to look for repeated windows, and bringing their contexts together.

A text is a sequence of symbols (words or bytes) and a window is ``length`` consecutive symbols of one text. Whether a window
occurs twice must be found without shipping every suffix. So only some suffixes are sampled: in each window, the one that begins
with the window's smallest gram of ``gram`` symbols (by hash, the leftmost of equals). The choice depends on the window's symbols
alone, so equal windows sample suffixes at the same offset, and it changes seldom as the window moves on: about 2 / (length - gram + 2)
of all suffixes are sampled. The windows that sample one suffix are consecutive: they start ``far`` to ``least`` symbols before it.

1. Equal texts are counted first (by 128 bits of hash). All windows of a text that occurs twice are repeated, so one row stands for
   all copies from there on, and rows that repeat cost no more than rows that don't.
2. Sampled suffixes are counted by the hash of their gram; a gram that occurs once can't lie in a repeated window.
3. The others are joined back to their texts (shuffled once; the last join with the texts uses the same exchange), which yields each
   one's context: the symbols of all its windows. Contexts meet by gram; the operator's own ``solve`` decides within a group, exactly,
   which windows are equal, and returns the repeated ones as ranges of starts.
4. A gram that more than ``most`` suffixes share never meets as a group. First, equal contexts are counted: all windows of one that occurs
   twice are repeated, and one suffix stands for it. Where more than ``most`` different contexts are left, the prefix is lengthened
   until what shares it fits: the windows that start a to b symbols before the suffix all hold the symbols from a before it to
   length - b behind, so halving [a, b] gives two longer prefixes with shorter contexts, which may be equal and are counted anew. The
   longest prefixes are whole windows, of which there is one context. Keys with many members are only counted and
   joined with their (counted) list; no group of them is gathered anywhere.
5. Ranges go back to their texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import as_bytes, flat_bytes, pieces
from ._shared import materialise

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 18  # values that are hashed at once
PIECE = 1 << 18  # bytes of text that are sampled or cut at once: numpy holds about 100 times that
TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


@cache
def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def power(base: int, n: int) -> np.ndarray:
    return powers(base, 1 << max(16, int(n).bit_length()))[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2 ** 64."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * power(BASE, len(values)), out=out[1:])
    return out


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of the k values from each place where k are left. It doesn't depend on the place, so blocks are hashed by themselves."""
    out = np.empty(max(0, len(values) - k + 1), U)
    for a in range(0, len(out), BLOCK):
        p = prefix_sums(values[a : a + BLOCK + k - 1])
        out[a : a + BLOCK] = mix((p[k:] - p[:-k]) * power(INVERSE, len(p) - k))
    return out


def word_spans(flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word in the flat bytes, and the offsets of rows in the list of words. Words end with their row."""
    solid = ~((flat == 32) | ((flat >= 9) & (flat <= 13)))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offs[(offs > 0) & (offs < len(flat))]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    a, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return a, e, np.searchsorted(a, offs)


def word_values(flat: np.ndarray, a: np.ndarray, e: np.ndarray) -> np.ndarray:
    p = prefix_sums(TABLE[flat])
    return mix((p[e] - p[a]) * power(INVERSE, len(p))[a])


def sampled(values: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, row, place in the row, fewest and most symbols before it in its windows) of each sampled suffix."""
    n = np.diff(offs)
    grams = rolling(values, gram)
    w = length - gram + 1
    none = (np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(4)))
    if len(grams) < w:
        return none
    m = (grams & ~U(0xFFFFFFFF)) | np.arange(len(grams), dtype=U)
    size = 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < w:
        m = np.minimum(m[: len(m) - (w - size)], m[w - size :])
    ok = np.zeros(len(m) + 1, np.int32)
    has = n >= length
    np.add.at(ok, offs[:-1][has], 1)
    np.add.at(ok, offs[:-1][has] + n[has] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(ok[:-1]))
    if not len(starts):
        return none
    at = (m[starts] & U(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    lo, hi, at = starts[edge], starts[np.concatenate([edge[1:] - 1, [len(starts) - 1]])], at[edge]
    row = np.searchsorted(offs, at, side="right") - 1
    return grams[at], row, at - offs[row], at - hi, at - lo


def values_of(text: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    flat, offs = flat_bytes(text)
    if not words:
        return TABLE[flat], offs
    a, e, offs = word_spans(flat, offs)
    return word_values(flat, a, e), offs


PACK = 12  # bits of each of the two offsets beside the place
TEXT = ["_t1", "_t2"]  # 128 bits that tell texts apart
KEY = ["k1", "k2"]
SAME = ["c1", "c2"]
BATCH = 4096  # contexts that are solved together where groups are smaller
SUFFIX = [*TEXT, "p", "context", "lo", "hi"]
SUFFIX_DDL = "_t1 long, _t2 long, p long, context binary, lo int, hi int"


def small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """df, sent to every task if its counted rows are no more than most."""
    return F.broadcast(df) if rows <= most else df


def fewer(df: DataFrame) -> DataFrame:
    """df in at most eight parts for each core, or a sixteenth of the shuffle partitions if that is more.

    Hadoop's local file system forks the executor for each file and folder that it makes, so hundreds of small files cost more
    time than what is in them, and while it is forked, the executor's memory is seen twice.
    """
    spark = df.sparkSession
    return df.coalesce(max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16))


def written(df: DataFrame, name: str) -> DataFrame:
    return materialise(fewer(df), name)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _t1, _t2, text): null texts are empty."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].alias("_id"), F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text).alias("_t2"), text.alias("text"))


def marked_texts(keyed: DataFrame, broadcast_rows: int) -> tuple[DataFrame, DataFrame]:
    """(all rows with _copied, one row of each distinct text): _copied is true where the text occurs twice.

    The row that stands for copies is that of the smallest id; if that id's row itself is repeated, one of its equals.
    """
    of_id = keyed.groupBy(*TEXT, "_id").agg(F.count(F.lit(1)).alias("m")).groupBy(*TEXT)
    copies = of_id.agg(F.sum("m").alias("n"), F.min(F.struct("_id", "m")).alias("s")).where("n > 1")
    copies = written(copies.select(*TEXT, F.col("s._id").alias("_rep"), F.col("s.m").alias("_m"), F.lit(True).alias("_copied")), "copied-texts")
    n, again = copies.agg(F.count(F.lit(1)), F.max("_m")).first()
    marked = keyed.join(small(copies, n, broadcast_rows), TEXT, "left") if n else keyed.withColumns({"_rep": F.col("_id"), "_m": F.lit(1).cast("long"), "_copied": F.lit(None).cast("boolean")})
    cols = [F.col("_id"), *map(F.col, TEXT), F.col("text"), F.coalesce("_copied", F.lit(False)).alias("_copied")]
    first = F.col("_id").eqNullSafe(F.col("_rep"))
    distinct = marked.where(F.col("_copied").isNull() | (first & (F.col("_m") == 1))).select(*cols)
    if (again or 0) > 1:
        distinct = distinct.unionAll(marked.where(first & (F.col("_m") > 1)).select(*cols).dropDuplicates(TEXT))
    return marked.select(*cols), distinct


def unpacked(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return p >> 2 * PACK, p >> PACK & (1 << PACK) - 1, p & (1 << PACK) - 1


def column(rows: pa.RecordBatch, name: str) -> pa.Array:
    return rows.column(rows.schema.get_field_index(name))


def cut_contexts(text: pa.Array, words: bool, length: int, row: np.ndarray, at: np.ndarray, least: np.ndarray, far: np.ndarray) -> pa.Array:
    """The symbols of all windows of each sampled suffix, as bytes."""
    flat, offs = flat_bytes(text)
    if words:
        a, e, woffs = word_spans(flat, offs)
        i = woffs[row] + at
        s, t = a[i - far], e[i - least + length - 1]
    else:
        s = offs[row] + at - far
        t = offs[row] + at - least + length
    raw = flat.tobytes()
    return pa.array([raw[x:y] for x, y in zip(s.tolist(), t.tolist())], pa.binary())


def find_ranges(distinct: DataFrame, words: bool, length: int, gram: int, most: int, solve: Callable, broadcast_rows: int, keep_samples: bool = True) -> DataFrame:
    """(_t1, _t2, _ranges): the repeated windows of each of the distinct texts, as ranges of starts.

    keep_samples writes the sampled suffixes to the shared folder; without it they are sampled again for the join, which saves that disk.
    """
    if not 0 < gram <= length < 1 << PACK:
        raise ValueError(f"0 < gram <= length < {1 << PACK} is needed, not {gram} and {length}")

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in pieces(batches, "text", PIECE):
            g, row, at, least, far = sampled(*values_of(text, words), length, gram)
            own = [pa.array(column(rows, c).to_numpy()[row]) for c in TEXT]
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), *own, pa.array(at << 2 * PACK | least << PACK | far)], ["g", *TEXT, "p"])

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in pieces(batches, "text", PIECE):
            found = column(rows, "_found")
            counts = np.diff(np.array(found.offsets))
            g, p = (found.flatten().field(i).to_numpy() for i in range(2))
            row = np.repeat(np.arange(len(counts)), counts)
            said = cut_contexts(text, words, length, row, *unpacked(p))
            own = [pa.array(column(rows, c).to_numpy()[row]) for c in TEXT]
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.zeros(len(g), np.int64)), *own, pa.array(p), said], [*KEY, *TEXT, "p", "context"])

    spots = distinct.mapInArrow(sample, "g long, _t1 long, _t2 long, p long")
    if keep_samples:
        spots = written(spots, "sampled-suffixes")
    shared = written(spots.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-grams")
    hot = shared.where(F.col("n") > most).select("g")
    n_hot = hot.count()
    calm = spots.join(small(hot, n_hot, broadcast_rows), "g", "left_anti") if n_hot else spots
    found = calm.join(shared.select("g"), "g").groupBy(*TEXT).agg(F.collect_list(F.struct("g", "p")).alias("_found"))
    near = distinct.join(found, TEXT).mapInArrow(contexts, "k1 long, k2 long, _t1 long, _t2 long, p long, context binary")
    told = decided(near, most, solve)
    if n_hot:
        for more in longer_prefixes(hot_contexts(distinct, spots, hot, n_hot, words, length, gram, broadcast_rows), words, length, gram, most, solve, broadcast_rows):
            told = told.unionAll(more)
    return told.groupBy(*TEXT).agg(F.collect_list(F.struct("a", "b")).alias("_ranges"))


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by KEY as tables of whole groups, of at most BATCH rows or of one group."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        k1, k2 = (t.column(c).to_numpy() for c in KEY)
        edge, at = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1, 0
        while t.num_rows - at > BATCH:
            after = edge[np.searchsorted(edge, at, side="right") :]
            if not len(after):  # the last group may go on
                break
            cut = int(after[max(0, np.searchsorted(after, at + BATCH, side="right") - 1)])
            yield t.slice(at, cut - at)
            at = cut
        rest = t.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def decided(near: DataFrame, most: int, solve: Callable) -> DataFrame:
    """(_t1, _t2, a, b): ranges of starts of repeated windows, from groups (k1, k2) of at most ``most`` contexts each."""

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(solved, whole_groups(batches))

    def solved(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        k1, k2, t1, t2, p = (t.column(c).to_numpy() for c in (*KEY, *TEXT, "p"))
        group = np.cumsum(np.concatenate([[0], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        at, least, far = unpacked(p)
        member, lo, hi = solve(t.column("context").to_pylist(), group, least, far)
        # lo and hi are symbols before the sampled suffix: the windows start hi to lo symbols before it
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (t1[member], t2[member], at[member] - hi, at[member] - lo)], [*TEXT, "a", "b"])

    return near.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(decide, "_t1 long, _t2 long, a long, b long")


def hot_contexts(distinct: DataFrame, spots: DataFrame, hot: DataFrame, n_hot: int, words: bool, length: int, gram: int, broadcast_rows: int) -> DataFrame:
    """(_t1, _t2, p, context, lo, hi) of the suffixes whose gram is among hot; lo..hi are the offsets that the prefix so far, the gram, stands for."""

    def whole(rows: pa.RecordBatch, text: pa.Array, row: np.ndarray, at: np.ndarray, least: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
        own = [pa.array(column(rows, c).to_numpy()[row]) for c in TEXT]
        ends = [pa.array(np.full(len(row), x, np.int32)) for x in (0, length - gram)]
        return pa.RecordBatch.from_arrays([*own, pa.array(at << 2 * PACK | least << PACK | far), cut_contexts(text, words, length, row, at, least, far), *ends], SUFFIX)

    if n_hot <= broadcast_rows:  # the list goes along with the function: each text is sampled and cut where it lies
        listed = np.sort(np.array([r[0] for r in hot.collect()], np.int64).view(U))

        def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, text in pieces(batches, "text", PIECE):
                g, row, at, least, far = sampled(*values_of(text, words), length, gram)
                mine = listed[np.minimum(np.searchsorted(listed, g), len(listed) - 1)] == g
                if mine.any():
                    yield whole(rows, text, row[mine], at[mine], least[mine], far[mine])

        return written(distinct.mapInArrow(sample, SUFFIX_DDL), "hot-contexts")

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in pieces(batches, "text", PIECE):
            found = column(rows, "_found")
            counts = np.diff(np.array(found.offsets))
            yield whole(rows, text, np.repeat(np.arange(len(counts)), counts), *unpacked(found.flatten().to_numpy()))

    found = spots.join(hot, "g").groupBy(*TEXT).agg(F.collect_list("p").alias("_found"))
    return written(distinct.join(found, TEXT).mapInArrow(joined, SUFFIX_DDL), "hot-contexts")


def longer_prefixes(hot: DataFrame, words: bool, length: int, gram: int, most: int, solve: Callable, broadcast_rows: int) -> Iterator[DataFrame]:
    """Ranges of repeated windows (as ``decided``) of suffixes whose group is too large, by prefixes that get longer from round to round."""

    def pair(digests: list[bytes]) -> list[pa.Array]:
        k = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return [pa.array(k[:, 0]), pa.array(k[:, 1])]

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the digests of the context with its offsets and of the prefix that stands for offsets lo to hi."""
        for b in batches:
            _, least, far = unpacked(column(b, "p").to_numpy())
            same, core = [], []
            for c, t, f, lo, hi in zip(column(b, "context").to_pylist(), least.tolist(), far.tolist(), column(b, "lo").to_pylist(), column(b, "hi").to_pylist()):
                c = c.split() if words else c
                x = c[f - lo : f + length - hi]
                c, x = (b" ".join(c), b" ".join(x)) if words else (c, x)
                core.append(blake2b(x, digest_size=16, salt=b"%d %d" % (lo, hi)).digest())
                same.append(blake2b(c, digest_size=16, salt=b"%d %d %d" % (t, f, hi)).digest())
            yield pa.RecordBatch.from_arrays([*pair(same), *pair(core), *b.columns], [*SAME, *KEY, *SUFFIX])

    def halves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, ps, said, los, his = [], [], [], [], []
            at, least, far = unpacked(column(b, "p").to_numpy())
            for i, (x, c, t, f, lo, hi) in enumerate(zip(at.tolist(), column(b, "context").to_pylist(), least.tolist(), far.tolist(), column(b, "lo").to_pylist(), column(b, "hi").to_pylist())):
                c, mid = c.split() if words else c, (lo + hi) // 2
                for u, v in ((lo, mid), (mid + 1, hi)):
                    s, e = max(t, u), min(f, v)
                    if s <= e:
                        part = c[f - e : f + length - s]  # the windows that start s to e symbols before the suffix
                        row.append(i)
                        ps.append(x << 2 * PACK | s << PACK | e)
                        said.append(b" ".join(part) if words else part)
                        los.append(u)
                        his.append(v)
            own = [column(b, c).take(pa.array(row, pa.int64())) for c in TEXT]
            yield pa.RecordBatch.from_arrays([*own, pa.array(ps, pa.int64()), pa.array(said, pa.binary()), pa.array(los, pa.int32()), pa.array(his, pa.int32())], SUFFIX)

    at, least, far = F.shiftright("p", 2 * PACK), F.shiftright("p", PACK).bitwiseAND((1 << PACK) - 1), F.col("p").bitwiseAND((1 << PACK) - 1)
    member = F.struct(*TEXT, "p")
    while True:
        rows = hot.mapInArrow(named, f"c1 long, c2 long, k1 long, k2 long, {SUFFIX_DDL}")
        same = rows.groupBy(*SAME).agg(F.count(F.lit(1)).alias("n"), F.min(member).alias("s"), *[F.first(k).alias(k) for k in KEY])
        same = written(same.select(*SAME, *KEY, "n", "s.*"), "contexts")
        twice = same.where("n > 1").select(*SAME)
        yield rows.join(small(twice, twice.count(), broadcast_rows), SAME).select(*TEXT, (at - far).alias("a"), (at - least).alias("b"))
        groups = written(same.groupBy(*KEY).agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "prefixes")
        stands = written(same.join(small(groups, groups.count(), broadcast_rows), KEY).select(*SAME, *TEXT, "p", "d"), "stand-ins")
        n, n_large = stands.agg(F.count(F.lit(1)), F.count_if(F.col("d") > most)).first()
        if not n:
            return
        chosen = rows.join(small(stands, n, broadcast_rows), [*SAME, *TEXT, "p"])
        yield decided(chosen.where(F.col("d") <= most).select(*KEY, *TEXT, "p", "context"), most, solve)
        if not n_large:
            return
        hot = written(chosen.where(F.col("d") > most).select(*SUFFIX).mapInArrow(halves, SUFFIX_DDL), "hot-contexts")


def covered(ranges: pa.ListArray | None, i: int, n: int, length: int) -> np.ndarray | None:
    """Which of n symbols lie in a window that starts in one of row i's ranges, or in any window if there are no ranges to look at; None for none."""
    if ranges is None:
        return np.ones(n, bool) if n >= length else None
    r = ranges[i].values if ranges[i].is_valid else None
    if r is None or not len(r):
        return None
    a, b = (r.field(k).to_numpy() for k in range(2))
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, a, 1)
    np.add.at(d, b + length, -1)
    return np.cumsum(d[:-1]) > 0


def finished(docs: DataFrame, id_col: str, text_col: str, words: bool, length: int, gram: int, most: int, solve: Callable, broadcast_rows: int, keep_samples: bool, answer: Callable, cols: list[tuple[str, pa.DataType]]) -> DataFrame:
    """One row per row of docs: _id and what answer(text, gone) says, gone being the mask of symbols to remove or None.

    answer gets the text as bytes and a function from its number of symbols to the mask.
    """
    keyed = keyed_texts(docs, id_col, text_col)
    marked, distinct = marked_texts(keyed, broadcast_rows)
    ranges = find_ranges(distinct, words, length, gram, most, solve, broadcast_rows, keep_samples)
    names = ["_id", *(c for c, _ in cols)]

    def finish(copied: bool) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, text in pieces(batches, "text"):
                found = None if copied else column(rows, "_ranges")
                mine = np.flatnonzero(column(rows, "_copied").to_numpy(zero_copy_only=False) == copied)
                texts = as_bytes(text)
                said = [answer(texts[i], lambda n, i=i: covered(found, i, n, length)) for i in mine.tolist()]
                each = list(zip(*said)) or [()] * len(cols)
                yield pa.RecordBatch.from_arrays([column(rows, "_id").take(pa.array(mine)), *(pa.array(v, t) for v, (_, t) in zip(each, cols))], names)

        return run

    ddl = ", ".join([f"_id {keyed.schema['_id'].dataType.simpleString()}", *(f"{c} {DDL[t]}" for c, t in cols)])
    # Copies are left out behind the join, not before it, so that the texts' exchange is the one that contexts came from.
    alone = distinct.join(ranges, TEXT, "left").mapInArrow(finish(False), ddl)
    return alone.unionAll(fewer(marked.where("_copied").mapInArrow(finish(True), ddl)))


DDL = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def repeated_classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """A number for each member: equal where members share ``depth`` symbols. order sorts members, lcp is what each has in common with the one before."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth)
    return out


def equal_windows(right: tuple, left: tuple, least: np.ndarray, far: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, lo, hi): the offsets of each member whose windows another member has too, as ranges.

    right and left hold both sides' order and the depths of the nodes that join neighbours. A window at offset o is a node of depth
    length - o of the right tree and one of depth o of the left tree; it is repeated where two members are below both.
    """
    m, first = len(least), int(least.min())
    hit = np.zeros((m, int(far.max()) - first + 2), np.int8)  # its last column stays empty: ranges end with their member
    for o in range(first, int(far.max()) + 1):
        live = np.flatnonzero((least <= o) & (far >= o))
        if len(live) < 2:
            continue
        key = repeated_classes(*right, length - o)[live] * m + repeated_classes(*left, o)[live]
        by = np.argsort(key, kind="stable")
        k = key[by]
        same = k[1:] == k[:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        hit[live[by[twice]], o - first] = 1
    step = np.diff(hit.ravel(), prepend=np.int8(0))
    member, lo = np.divmod(np.flatnonzero(step == 1), hit.shape[1])
    return member, lo + first, np.flatnonzero(step == -1) % hit.shape[1] + first - 1
