"""Arrow batches cut into pieces of bounded text, and a bounded memo that lives as long as a Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces(batches: Iterable[pa.RecordBatch], col: str, limit: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, their texts with nulls as empty), about ``limit`` bytes of text at a time; a longer text comes whole and alone."""
    for batch in batches:
        text = pc.fill_null(batch.column(batch.schema.get_field_index(col)), "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at), text.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def as_bytes(text: pa.Array) -> list[bytes]:
    return text.cast(pa.binary()).to_pylist() if not pa.types.is_large_string(text.type) else text.cast(pa.large_binary()).to_pylist()


def flat_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text array, and the offsets of its rows (one more than rows)."""
    text = text.cast(pa.large_string())
    _, offsets, data = text.buffers()
    offs = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    flat = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(text) else np.zeros(0, np.uint8)
    return flat, offs - (offs[0] if len(offs) else 0)


class Memo(dict):
    """word -> bytes of its ids. Whole batches of unknown words are computed at once.

    It holds about ``most_bytes`` at most and then starts anew. Words of more than ``LONG`` bytes are kept for their own batch only.
    """

    ENTRY = 130  # about what an entry takes beside the bytes of its two strings
    LONG = 256

    def __init__(self, compute: Callable[[list], list[bytes]], most_bytes: int):
        super().__init__()
        self.compute, self.most_bytes, self.held = compute, most_bytes, 0
        self.once: dict = {}

    def learn(self, words: Iterable) -> None:
        words = set(words)
        new = [w for w in words if w not in self]
        long = [w for w in new if len(w) > self.LONG]
        self.once = dict(zip(long, self.compute(long))) if long else {}
        new = [w for w in new if len(w) <= self.LONG] if long else new
        if not new:
            return
        got = self.compute(new)
        size = sum(map(len, new)) + sum(map(len, got)) + self.ENTRY * len(new)
        if self.held + size > self.most_bytes:
            self.once |= {w: self[w] for w in words if w in self}
            self.clear()
            self.held = 0
        if size > self.most_bytes:  # one batch of little else than new words
            self.once |= zip(new, got)
            return
        self.update(zip(new, got))
        self.held += size

    def __missing__(self, word) -> bytes:
        return self.once[word]
