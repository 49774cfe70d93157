"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie of pieces, with byte fallback.

Pieces come from a SentencePiece model file (read here; the format is a public protocol buffer). A model of type unigram brings log
scores; one of type BPE brings ranks, which a fixed rule turns into log scores: ln(1 / (rank + OFFSET)), Zipf's law. Nothing is
trained.

A space is the white-space marker inside pieces; text starts with one more, which decoding takes off. A literal marker character
in a text is not a space: it is spelt in bytes, so decoding gives every text back. Characters without a piece cost UNKNOWN below
the worst piece and are spelt in byte pieces.

No piece goes on after a space that follows something else (checked when a model is loaded) and none holds a line feed, so
the best path of a text is that of its units, runs of spaces and what follows them, one after the other. Each distinct unit is
decoded once: all units of about the same length step through the trie together in numpy. A long unit, such as a text without spaces, is
cut where no piece lies across, which every path passes; so its parts go side by side too, and only parts that overlapping pieces hold
together for more than SIDE_BY_SIDE bytes are decoded alone.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import Memo, as_bytes, pieces

MARKER = "▁"
OFFSET = 10.0
UNKNOWN = 10.0
#: What each worker's memo of units may take.
MEMO_BYTES = 128 << 20
#: Units up to so many bytes are decoded side by side.
SIDE_BY_SIDE = 64
UNITS = re.compile(rb"\n| *[^ \n]+| +").findall


# ---- the model file


def _varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (b[i] & 0x7F) << shift
        shift += 7
        i += 1
        if b[i - 1] < 0x80:
            return n, i


def _fields(b: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of each field of a protocol-buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        if tag & 7 == 0:
            v, i = _varint(b, i)
        else:
            n, i = (8, i) if tag & 7 == 1 else (4, i) if tag & 7 == 5 else _varint(b, i)
            v, i = b[i : i + n], i + n
        yield tag >> 3, v


def read_model(path: str) -> tuple[list[tuple[str, float, int]], int]:
    """Pieces as (piece, score, type) in the order of their ids, and the model's type (1 unigram, 2 BPE)."""
    out, kind = [], 1
    with open(path, "rb") as f:
        for number, v in _fields(f.read()):
            if number == 1:
                m = dict(_fields(v))
                out.append((m[1].decode(), float(np.frombuffer(m.get(2, b"\0\0\0\0"), "<f4")[0]), m.get(3, 1)))
            elif number == 2:
                kind = dict(_fields(v)).get(3, 1)
    return out, kind


# ---- the trie


class DoubleArray:
    """base, check and value arrays: the child of s by byte c is base[s] + c + 1 if check there is s."""

    def __init__(self, keys: dict[bytes, int]):
        n = 1 << 12
        self.base, self.check, self.value = [0] * n, [-1] * n, [-1] * n
        self.check[0] = 0
        nodes: dict = {}
        for k, v in keys.items():
            at = nodes
            for c in k:
                at = at.setdefault(c, {})
            at[-1] = v
        low, todo = 1, [(0, nodes)]
        while todo:
            s, kids = todo.pop()
            if -1 in kids:
                self.value[s] = kids[-1]
            codes = sorted(c for c in kids if c >= 0)
            if not codes:
                continue
            b, tried = max(1, low - codes[0] - 1), 0
            while True:
                if b + 258 >= len(self.check):
                    self.base += [0] * len(self.base)
                    self.value += [-1] * len(self.value)
                    self.check += [-1] * len(self.check)
                if all(self.check[b + c + 1] < 0 for c in codes):
                    break
                b += 1
                tried += 1
            if tried > 200:  # what lies before is nearly full: later nodes begin their search behind it
                low = b + codes[0] + 1
            self.base[s] = b
            for c in codes:
                self.check[b + c + 1] = s
            todo += [(b + c + 1, kids[c]) for c in codes]
        self.arrays = tuple(np.array(x, np.int32) for x in (self.base, self.check, self.value))


class Unigram:
    def __init__(self, path: str):
        listed, kind = read_model(path)
        rank = {i: r for r, i in enumerate(sorted((i for i, p in enumerate(listed) if p[2] == 1 and p[1] > -1e8), key=lambda i: -listed[i][1]))}
        #: Normal pieces only; user-defined ones and those with a score that bars them don't take part.
        self.score = np.array([(-math.log(rank[i] + OFFSET) if kind == 2 else p[1]) if i in rank else 0.0 for i, p in enumerate(listed)])
        spelt = {p.replace(MARKER, " ").encode(): i for i, (p, _, _) in enumerate(listed) if i in rank}
        if any(re.search(rb"[^ ] |\n", k) for k in spelt):
            raise ValueError("a piece goes on after a space or holds a line feed: units can't be decoded apart")
        self.trie = DoubleArray(spelt)
        self.byte_id = np.full(256, -1, np.int64)
        for i, (p, _, t) in enumerate(listed):
            if t == 6:
                self.byte_id[int(p[1:-1], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("no byte pieces")
        self.unknown = float(self.score.min()) - UNKNOWN
        self.bytes_of = [b""] * len(listed)
        for k, i in spelt.items():
            self.bytes_of[i] = k
        for b, i in enumerate(self.byte_id):
            self.bytes_of[i] = bytes([b])
        self.longest = max(map(len, spelt))
        self.width = "<u2" if len(listed) < 1 << 16 else "<u4"

    # -- Viterbi

    def one(self, unit: bytes) -> list[int]:
        """Best ids of one unit. Of equal scores the path whose last piece is longest wins, at every point."""
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        n = len(unit)
        best, back, last = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if unit[i] & 0xC0 == 0x80:
                continue
            wide = 1
            while i + wide < n and unit[i + wide] & 0xC0 == 0x80:
                wide += 1
            s, single = 0, False
            for j in range(i, n):
                t = base[s] + unit[j] + 1
                if check[t] != s:
                    break
                s, v = t, value[t]
                if v >= 0:
                    single |= j + 1 - i == wide
                    got = best[i] + score[v]
                    if got > best[j + 1]:
                        best[j + 1], back[j + 1], last[j + 1] = got, i, v
            if not single and best[i] + self.unknown > best[i + wide]:
                best[i + wide], back[i + wide], last[i + wide] = best[i] + self.unknown, i, -1
        out, at = [], n
        while at:
            out.append([last[at]] if last[at] >= 0 else [int(self.byte_id[b]) for b in unit[back[at] : at]])
            at = back[at]
        return [x for p in reversed(out) for x in p]

    def many(self, units: list[bytes]) -> list[bytes]:
        """Ids of units of at most SIDE_BY_SIDE bytes, as little-endian bytes."""
        n, wide = len(units), max(map(len, units))
        text = np.zeros((n, wide + 1), np.uint8)
        lens = np.fromiter(map(len, units), np.int64, n)
        text[np.arange(wide + 1) < lens[:, None]] = np.frombuffer(b"".join(units), np.uint8)
        base, check, value = self.trie.arrays
        rows = np.arange(n)
        best = np.full((n, wide + 1), -np.inf)
        best[:, 0] = 0.0
        back, last = np.zeros((n, wide + 1), np.int32), np.full((n, wide + 1), -1, np.int32)
        starts = (text & 0xC0) != 0x80
        starts[np.arange(wide + 1) >= lens[:, None]] = True  # what stands behind a unit ends its last character
        after = np.empty((n, wide + 1), np.int32)  # where the character ends that begins here
        at = np.full(n, wide, np.int32)
        for j in range(wide, -1, -1):
            after[:, j] = at
            at = np.where(starts[:, j], j, at)
        for i in range(wide):
            live = rows[(lens > i) & starts[:, i]]
            s = np.zeros(len(live), np.int32)
            first, single = live, np.zeros(n, bool)
            for j in range(i, min(wide, i + self.longest)):
                t = base[s] + text[live, j] + 1
                ok = (check[t] == s) & (lens[live] > j)
                live, s = live[ok], t[ok]
                if not len(live):
                    break
                v = value[s]
                end = v >= 0
                r, v = live[end], v[end]
                single[r[after[r, i] == j + 1]] = True
                got = best[r, i] + self.score[v]
                up = got > best[r, j + 1]
                r, v = r[up], v[up]
                best[r, j + 1], back[r, j + 1], last[r, j + 1] = got[up], i, v
            r = first[~single[first]]
            e = np.minimum(after[r, i], lens[r])
            up = best[r, i] + self.unknown > best[r, e]
            r, e = r[up], e[up]
            best[r, e], back[r, e], last[r, e] = best[r, i] + self.unknown, i, -1
        out: list[list[int]] = [[] for _ in range(n)]
        back_l, last_l = back.tolist(), last.tolist()
        for k, u in enumerate(units):
            at, ids, b, l = len(u), [], back_l[k], last_l[k]
            while at:
                if l[at] >= 0:
                    ids.append(l[at])
                else:
                    ids += [int(self.byte_id[c]) for c in reversed(u[b[at] : at])]
                at = b[at]
            out[k] = ids[::-1]
        return [np.array(x, self.width).tobytes() for x in out]

    def cuts(self, unit: bytes) -> list[int]:
        """The places of a unit, its ends among them, that neither a piece nor a character lies across."""
        base, check, value = self.trie.arrays
        text = np.frombuffer(unit, np.uint8)
        n = len(text)
        start = (text & 0xC0) != 0x80
        start[0] = True
        live = np.flatnonzero(start)
        reach = np.arange(n)
        reach[live] = np.append(live[1:], n)
        s = np.zeros(len(live), np.int32)
        for j in range(self.longest):
            inside = live + j < n
            live, s = live[inside], s[inside]
            t = base[s] + text[live + j] + 1
            ok = check[t] == s
            live, s = live[ok], t[ok]
            if not len(live):
                break
            end = value[s] >= 0
            at = live[end]
            reach[at] = np.maximum(reach[at], at + j + 1)
        far = np.concatenate([[0], np.maximum.accumulate(reach)])
        return np.flatnonzero((far <= np.arange(n + 1)) & np.append(start, True)).tolist()

    def __call__(self, units: list[bytes]) -> list[bytes]:
        parts = {u: [u[a:e] for a, e in itertools.pairwise(self.cuts(u))] for u in units if len(u) > SIDE_BY_SIDE}
        if not parts:
            return self.each(units)
        short = list({u for u in units if u not in parts} | {x for p in parts.values() for x in p})
        ids = dict(zip(short, self.each(short)))
        return [b"".join([ids[x] for x in parts[u]]) if u in parts else ids[u] for u in units]

    def each(self, units: list[bytes]) -> list[bytes]:
        out: dict[bytes, bytes] = {}
        by_size: dict[int, list[bytes]] = {}
        for u in units:
            by_size.setdefault(len(u) + 7 >> 3 if len(u) <= SIDE_BY_SIDE else -1, []).append(u)
        for k, same in by_size.items():
            for a in range(0, len(same), 1 << 14):
                part = same[a : a + (1 << 14)]
                out.update(zip(part, self.many(part) if k >= 0 else [np.array(self.one(u), self.width).tobytes() for u in part]))
        return [out[u] for u in units]

    # -- texts

    def encode_with(self, memo: Memo, texts: list[bytes]) -> list[np.ndarray]:
        units = [UNITS(b" " + t) if t else [] for t in texts]
        memo.learn(itertools.chain.from_iterable(units))
        return [np.frombuffer(b"".join(map(memo.__getitem__, x)), self.width) for x in units]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


@cache
def loaded(path: str) -> tuple[Unigram, Memo]:
    m = Unigram(path)
    return m, Memo(m, MEMO_BYTES)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per row: id_col, n_tokens, ids (array; unsigned crc32 of the little-endian 32-bit ids as ids_crc32 if digest), n_bytes_spelt
    (byte pieces), lossless (the ids decode to the text).

    A null or empty text has no ids. Repeated rows are encoded each; other columns aren't looked at.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memo = loaded(model)
        low, high = m.byte_id.min(), m.byte_id.max()
        for rows, text in pieces(batches, "text", 1 << 20):
            texts = as_bytes(text)
            ids = m.encode_with(memo, texts)
            said = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()) if digest else pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]), pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, m.width)]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), pa.array([len(x) for x in ids], pa.int64()), said,
                    pa.array([int(((x >= low) & (x <= high)).sum()) for x in ids], pa.int64()),
                    pa.array([m.decode(x) == t for x, t in zip(ids, texts)], pa.bool_()),
                ],
                ["id", "n_tokens", "ids", "n_bytes_spelt", "lossless"],
            )

    out = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id long, n_tokens long, ids {'long' if digest else 'array<int>'}, n_bytes_spelt long, lossless boolean")
    return out.select(F.col("id").alias(id_col), "n_tokens", F.col("ids").alias("ids_crc32" if digest else "ids"), "n_bytes_spelt", "lossless")


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of ids; null ids give a null text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, _ = loaded(model)
        for b in batches:
            said = [None if x is None else m.decode(np.array(x, np.int64)).decode(errors="replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(said, pa.string())], ["id", "text"])

    return tokens.select(tokens[id_col].cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
