"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

The ids of the whole corpus are counted (one count for each id of the vocabulary, so the table is bounded by it) and an id is
replaced by its rank, the most frequent first. A rank takes 1 to 4 bytes, least significant first; four 2-bit lengths make one
control byte, and control bytes and data bytes are kept apart, so that a block is decoded with one table lookup for each control
byte and no branches.

Files are Parquet tables of blocks (part, block, doc_ids, counts, control, data): any store that Spark writes to will do. Blocks
follow ascending document ids; the rank table lies beside them.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._batches import Memo, flat_bytes, pieces
from ._shared import scratch_path

#: What a worker's words with their ids, and its memo of the pieces of mixed words, may take; frequent words come back after they were
#: dropped, so only time depends on them.
KNOWN_BYTES = 12 << 20
PIECE_BYTES = 16 << 20
BLOCK_IDS = 1 << 19
#: Bytes of text that are cut, and words that go to the library, at a time.
TEXT_BYTES = 1 << 23
WORDS_AT_ONCE = 1000

LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


# ---- the coding


def encode_block(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    most = 2 if not len(values) or values.max() <= 0xFFFF else 4
    v = np.ascontiguousarray(values, f"<u{most}")
    n_bytes = 1 + (v > 0xFF).astype(np.uint8)
    if most == 4:
        n_bytes += (v > 0xFFFF).astype(np.uint8) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[: len(v)] = n_bytes - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, most)[np.arange(most, dtype=np.uint8) < n_bytes[:, None]]
    return control.tobytes(), data.tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of a block."""
    n_bytes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    most = 2 if len(data) <= 2 * n and not (n_bytes > 2).any() else 4
    out = np.zeros((n, most), np.uint8)
    out[np.arange(most, dtype=np.uint8) < n_bytes[:, None]] = np.frombuffer(data, np.uint8)
    return out.view(f"<u{most}").reshape(-1).astype("<u4", copy=False)


# ---- the tokenizer


def byte_symbols() -> dict[int, str]:
    """Byte -> the printable character that byte-level vocabularies write for it."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(plain))}


class WordEncoder:
    """Ids of white-space-free words as little-endian bytes, through the tokenizers library.

    No rule of the vocabulary looks across white space, so the ids of a text are those of its words in order. Words of letters go to the
    library's model lower-cased, many at a time: letters of ASCII, and those of which the library itself, asked about each when the file
    is loaded, says that they are part of a word and lower-cased as here. Other ASCII words are cut by the file's own pattern, and each
    distinct lower-cased piece goes to the model once. All others go through
    the library whole, whose tables of characters needn't be those of any other package; so do words that might hold an added
    token, and all words if the file's rules aren't the ones known here.
    """

    # The rules under which the short way holds.
    KNOWN = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
    #: A piece of its own behind a letter at the end of a word.
    CLOSING = b".,;:!?)"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        spec = json.loads(open(path, encoding="utf-8").read())
        self.tok = Tokenizer.from_file(path)
        steps = [*(spec["normalizer"] or {}).get("normalizers", []), *(spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.known = [s["type"] for s in steps] == self.KNOWN
        self.cut = regex.compile(steps[3]["pattern"]["Regex"]).findall if self.known else None
        self.added = sorted({t["content"][:2].encode() for t in spec["added_tokens"]})
        self.symbols = byte_symbols()
        self.by_byte = "".join(" " if b == 0x20 else self.symbols[b] for b in range(256))
        self.width, self.code = ("<u2", "H") if self.tok.get_vocab_size() + 1 < 1 << 16 else ("<u4", "I")
        plain = self.plain_letters() if self.known else []
        self.letters = re.compile(f"[A-Za-z{re.escape(''.join(plain))}]+").fullmatch
        self.parts = Memo(self.pieces_of, PIECE_BYTES)
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        suffix = spec["model"].get("end_of_word_suffix")
        self.last = np.zeros(self.tok.get_vocab_size(), bool)  # of ids that end a word
        self.last[[i for t, i in self.model.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.closing, self.ends_letter = np.zeros(256, bool), np.zeros(1 << 16, bool)  # by a byte; by two bytes, the first one low
        self.closing[list(self.CLOSING)] = True
        for c in plain:
            self.ends_letter[int.from_bytes(c.encode(), "little")] = True

    def plain_letters(self) -> list[str]:
        """Letters beyond ASCII (Latin, Greek, Cyrillic) that the library keeps as they are but for their case, within a word: no mark among
        them composes with a neighbour."""
        out = []
        for c in map(chr, range(0xC0, 0x530)):
            low = c.lower()
            if not c.isalpha() or len(low) != 1 or unicodedata.normalize("NFC", c) != c or unicodedata.combining(c) or c in "\u03a3\u03c3\u03c2":
                continue
            said = self.tok.normalizer.normalize_str(f"a{c}b")
            cut = self.tok.pre_tokenizer.pre_tokenize_str(said)
            if said == f"a{low}b" and len(cut) == 1 and cut[0][0] == said.encode().decode("latin-1").translate(self.symbols):
                out.append(c)
        return out

    def runs(self, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and where those of each text begin (one more than texts).

        Under the known rules capital letters of ASCII are made small and a closing mark behind a letter is a word of its own: neither
        changes the ids. A capital before anything from U+0300 on stays as it is, as a mark there may compose with one case only; all do where
        an added token may be.
        """
        flat, offs = flat_bytes(text)
        inner = (flat != 0x20) & ((flat - np.uint8(9)) > 4)
        behind, before = np.ones(len(flat) + 1, bool), np.ones(len(flat) + 1, bool)  # white space or the border of a text
        np.logical_not(inner, out=behind[:-1])
        before[1:] = behind[:-1]
        behind[offs], before[offs] = True, True
        starts = inner & before[:-1]
        if self.known:
            at = np.flatnonzero(inner & behind[1:])
            at = at[self.closing[flat[at]] & ~before[at]]
            last = flat[at - 1]
            small = (last | 0x20) - np.uint8(97) < 26
            two = at > 1
            two[two] = self.ends_letter[flat[at[two] - 2] | last[two].astype(np.uint16) << 8]
            starts[at[small | two]] = True
            whole = flat.tobytes()
            if not any(a in whole for a in self.added):
                capital = (flat - np.uint8(65)) < 26
                capital[:-1] &= flat[1:] < 0xCC
                flat = flat | (capital.view(np.uint8) << 5)
        first = np.searchsorted(np.flatnonzero(starts), offs)
        flat, at = flat[inner], np.flatnonzero(starts[inner])
        ends = np.append(at, len(flat)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(flat)]), first

    def pieces_of(self, parts: list[str]) -> list[bytes]:
        tokenize, symbols, code = self.tok.model.tokenize, self.symbols, self.code
        return [array(code, [t.id for t in tokenize(p.encode().decode("latin-1").translate(symbols))]).tobytes() for p in parts]

    def whole(self, words: list[str]) -> list[bytes]:
        return [np.array(self.tok.encode(w, add_special_tokens=False).ids, self.width).tobytes() for w in words]

    def of_letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of plain letters. Some hundred at a time are one text for the library's model; the ids tell by themselves where a word ends."""
        out, parts = [], [words[a : a + WORDS_AT_ONCE] for a in range(0, len(words), WORDS_AT_ONCE)]
        said = [b" ".join(p).lower() for p in parts]
        said = [t.decode() if t.isascii() else charmap_decode(t.decode().lower().encode(), "strict", self.by_byte)[0] for t in said]
        for part, got in zip(parts, self.model.encode_batch_fast(said, add_special_tokens=False)):
            ids = np.array(got.ids, self.width)
            ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
            if len(ends) == len(part):
                held, ends = ids.tobytes(), ends.tolist()
                out += [held[i:j] for i, j in zip([0, *ends], ends)]
            else:
                out += self.pieces_of([w.decode().lower() for w in part])
        return out

    def __call__(self, words: list[bytes]) -> list[bytes]:
        if not self.known:
            return self.whole([w.decode() for w in words])
        letters = self.letters
        simple = [w.isalpha() or letters(w.decode()) is not None for w in words]
        out = iter(self.of_letters([*compress(words, simple)]))
        if all(simple):
            return list(out)
        mixed = [w.decode() for w, e in zip(words, simple) if not e]
        odd = [a.decode() for a in self.added]
        easy = [w.isascii() and not any([a in w for a in odd]) for w in mixed]
        cut = [self.cut(w.lower()) for w, e in zip(mixed, easy) if e]
        self.parts.learn(chain.from_iterable(cut))
        short = iter([b"".join([self.parts[p] for p in x]) for x in cut])
        rest = iter(self.whole([w for w, e in zip(mixed, easy) if not e]))
        other = iter([next(short) if e else next(rest) for e in easy])
        return [next(out) if e else next(other) for e in simple]


class KnownWords:
    """The words that a worker met, as one Arrow array, and their ids as another: some 30 bytes for a word.

    New words are told from known ones by one hashing of both; for few words that would take longer than to ask the library. Of more than ``most_bytes`` only the words of the last texts stay, words
    of more than ``LONG`` bytes never.
    """

    LONG = 256
    FEW = 48  # known words that are hashed while the library encodes one

    def __init__(self, compute: Callable[[list[bytes]], list[bytes]], most_bytes: int):
        self.compute, self.most_bytes, self.said = compute, most_bytes, {}
        self.words = self.ids = pa.array([], pa.binary())

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(which, ids): the ids of words[i] are ids[which[i]]."""
        n = len(self.words)
        if len(words) * self.FEW < n:
            own = words.dictionary_encode()
            return own.indices.to_numpy(zero_copy_only=False), pa.array(self.compute(own.dictionary.to_pylist()), pa.binary())
        both = pa.concat_arrays([self.words, words]).dictionary_encode()
        new = both.dictionary[n:].to_pylist()
        known, which = both.dictionary, both.indices[n:].to_numpy(zero_copy_only=False)
        ids = pa.concat_arrays([self.ids, pa.array(self.compute(new), pa.binary())]) if new else self.ids
        keep = np.ones(len(known), bool)
        if known.nbytes + ids.nbytes > self.most_bytes:
            keep[:] = False
            keep[which] = True
        if max(map(len, new), default=0) > self.LONG:
            keep &= pc.binary_length(known).to_numpy(zero_copy_only=False) <= self.LONG
        self.words, self.ids = (known, ids) if keep.all() else (known.filter(pa.array(keep)), ids.filter(pa.array(keep)))
        if self.words.nbytes + self.ids.nbytes > self.most_bytes:
            self.words = self.ids = pa.array([], pa.binary())
        return which, ids

    def learn(self, words: Iterable[bytes]) -> None:
        """The ids of these words, and of no others, can be had by [word] from now on."""
        words = list(words)
        which, ids = self.look_up(pa.array(words, pa.binary()))
        self.said = dict(zip(words, ids.take(pa.array(which)).to_pylist()))

    def __getitem__(self, word: bytes) -> bytes:
        return self.said[word]


def ids_of_texts(enc: WordEncoder, known: KnownWords, text: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with end_id behind it, and where those of each text begin (one more than texts)."""
    words, first = enc.runs(text)
    which, held = known.look_up(words)
    end = pa.array([np.array([] if end_id is None else [end_id], enc.width).tobytes()], pa.binary())
    which = np.insert(which, first[1:], len(held))
    ids, at = flat_ids(pa.concat_arrays([held, end]).take(pa.array(which)), enc.width)
    return ids, at[first + np.arange(len(first))]


_ENCODERS: dict[str, tuple[WordEncoder, KnownWords]] = {}


def encoder(path: str) -> tuple[WordEncoder, KnownWords]:
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        e = WordEncoder(path)
        _ENCODERS[path] = e, KnownWords(e, KNOWN_BYTES)
    return _ENCODERS[path]


# ---- the passes


def binaries(ids: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary value for the ids of each row; first has where they begin (one more than rows)."""
    if len(ids) * ids.itemsize >= 1 << 31:
        raise ValueError("the ids of one batch take 2 GB")
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])


def flat_ids(col: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """What binaries() was made of."""
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    size = np.dtype(width).itemsize
    flat = np.frombuffer(data, width, (offs[-1] - offs[0]) // size, offs[0]) if offs[-1] > offs[0] else np.zeros(0, width)
    return flat, (offs - offs[0]) // size


def tokenised(docs: DataFrame, tokenizer: str, end_id: int | None, bounds: list[int]) -> DataFrame:
    """(_part, doc_id, ids, id, n): the ids of each row of docs (doc_id, text) as bytes, and rows (id, n) that count ids by task.

    bounds are the first doc_ids of parts 1, 2 and so on, sorted; null ids belong to part 0.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, known = encoder(tokenizer)
        total = np.zeros(1 << 16, np.int64)
        for rows, text in pieces(batches, "text", TEXT_BYTES):
            ids, first = ids_of_texts(enc, known, text, end_id)
            got = np.bincount(ids)
            total = np.pad(total, (0, max(0, len(got) - len(total))))
            total[: len(got)] += got
            ids = binaries(ids, first)
            none, doc_id = pa.nulls(len(ids), pa.int64()), rows.column(0)
            part = np.searchsorted(np.array(bounds, np.int64), doc_id.fill_null(0).to_numpy(), side="right")
            part[doc_id.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), doc_id, ids, none, none], ["_part", "doc_id", "ids", "id", "n"])
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.int64()), pa.nulls(len(i), pa.binary()), pa.array(i, pa.int64()), pa.array(total[i])], ["_part", "doc_id", "ids", "id", "n"])

    return docs.mapInArrow(run, "_part int, doc_id long, ids binary, id long, n long")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> None:
    """Writes path/blocks and path/ranks. Documents follow id_col, nulls first; rows with the same id follow their texts' ids.

    A null text is empty; an empty table gives empty tables. Other columns aren't looked at. Texts are tokenised once: their ids wait
    in the shared folder until the whole corpus is counted.
    """
    spark = docs.sparkSession
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = own.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    waiting = scratch_path(spark, "token-ids")
    tokenised(own, tokenizer, end_id, bounds).write.option("compression", "zstd").parquet(waiting)
    waiting = spark.read.parquet(waiting)
    counted = waiting.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most one row for each id of the vocabulary
    by_rank = sorted(counted, key=lambda r: (-r["n"], r["id"]))
    spark.createDataFrame([(i, r["id"]) for i, r in enumerate(by_rank)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(max((r["id"] for r in counted), default=0) + 1, np.int64)
    for i, r in enumerate(by_rank):
        rank[r["id"]] = i
    width = encoder(tokenizer)[0].width

    def to_ranks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank.astype(width)
        for b in batches:
            if b.num_rows:
                ids, first = flat_ids(b.column(2), width)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), binaries(table[ids], first)], ["_part", "doc_id", "r"])

    def to_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, ranks, held, last, block = [], [], 0, None, 0

        def flush() -> pa.RecordBatch:
            control, data = encode_block(np.frombuffer(b"".join(ranks), width))
            sizes = [len(x) // np.dtype(width).itemsize for x in ranks]
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([block], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([control], pa.binary()), pa.array([data], pa.binary())], ["part", "block", "doc_ids", "counts", "control", "data"])

        for b in batches:
            for p, d, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if ranks and (p != last or held >= BLOCK_IDS):
                    yield flush()
                    doc_ids, ranks, held, block = [], [], 0, block + 1 if p == last else 0
                last = p
                doc_ids.append(d)
                ranks.append(r)
                held += len(r) // np.dtype(width).itemsize
        if ranks:
            yield flush()

    (
        waiting.where("id is null").select("_part", "doc_id", "ids")
        .mapInArrow(to_ranks, "_part int, doc_id long, r binary")
        .repartitionById(parts, "_part")
        .sortWithinPartitions("_part", F.asc_nulls_first("doc_id"), "r")
        .mapInArrow(to_blocks, "part int, block int, doc_ids array<long>, counts array<long>, control binary, data binary")
        .write.option("compression", "zstd").parquet(f"{path}/blocks")
    )


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids before it), n_tokens and ids (array), or ids_crc32 instead of ids if digest."""
    blocks = spark.read.parquet(f"{path}/blocks")
    back = {r["rank"]: r["id"] for r in spark.read.parquet(f"{path}/ranks").collect()}  # at most one row for each id of the vocabulary
    table = np.zeros(max(back, default=0) + 1, "<u4")
    for r, i in back.items():
        table[r] = i
    sizes = blocks.select("part", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before, at = {}, 0
    for r in sizes.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one row for each range of ids
        before[r["part"]], at = at, at + r["n"]
    starts = spark.createDataFrame(list(before.items()), "part int, before long")
    own = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0))).join(F.broadcast(starts), "part")
    placed = blocks.join(sizes.select("part", "block", (F.col("own") + F.col("before")).alias("start")), ["part", "block"])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                n = np.array(x["counts"], np.int64)
                ids = table[decode_block(x["control"], x["data"], int(n.sum()))] if n.sum() else table[:0]
                ends = np.cumsum(n)
                each = [ids[e - k : e] for e, k in zip(ends, n)]
                last = pa.array([zlib.crc32(i.tobytes()) for i in each], pa.int64()) if digest else pa.array([i.astype(np.int64) for i in each], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(x["doc_ids"], pa.int64()), pa.array(x["start"] + ends - n, pa.int64()), pa.array(n, pa.int64()), last], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return placed.select("doc_ids", "counts", "control", "data", "start").mapInArrow(decode, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>"))


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int | None = None, **cols) -> DataFrame:
    """Writes the files to the shared folder and returns what is read back from them."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id, **cols)
    return read_token_files(docs.sparkSession, path, digest=True)
