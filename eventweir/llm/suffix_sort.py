"""Substring dedup on bytes: hash-compared suffix sort.

Groups of sampled suffixes (see _repeats) are put in order by a mergesort whose comparisons cost the logarithm of the length
compared: polynomial hashes of all prefixes give the hash of any substring in two lookups, a binary search over lengths finds how
far two suffixes agree, and the next byte decides. All merges of a level run side by side in numpy: every suffix finds its
rank in the run beside its own by binary search. What precedes the suffixes is sorted the same way, backwards.

Hashes can collide, so every common length between neighbours of the final order is verified on the bytes themselves, as are the byte
behind it and thus the order; where that fails the group is sorted again by plain comparison.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._repeats import BASE, TABLE, U, equal_windows, finished, power

ROWS = 1024  # suffixes whose bytes are looked at together


class Suffixes:
    """Suffixes flat[at : at + size] of one buffer, compared by hashes of their prefixes, which each suffix has for itself."""

    def __init__(self, flat: np.ndarray, at: np.ndarray, size: np.ndarray):
        self.flat, self.at, self.size = flat, at, size
        self.own = np.cumsum(size) - size
        self.sums, scale = np.zeros(int(size.sum()) + 1, U), power(BASE, int(size.max(initial=0)))
        for a in range(0, len(size), ROWS):
            n, first = size[a : a + ROWS], int(self.own[a])
            inner = np.arange(int(n.sum())) - np.repeat(self.own[a : a + ROWS] - first, n)
            sums = self.sums[first + 1 : first + 1 + len(inner)]
            np.cumsum(TABLE[flat[np.repeat(at[a : a + ROWS], n) + inner]] * scale[inner], out=sums)
            sums += self.sums[first]
        self.steps = [1 << b for b in range(int(size.max(initial=0)).bit_length() - 1, -1, -1)]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bytes suffixes i and j share, by binary search over lengths."""
        x, y = self.own[i], self.own[j]
        most, n = np.minimum(self.size[i], self.size[j]), np.zeros(len(i), np.int64)
        sx, sy = self.sums[x], self.sums[y]
        for step in self.steps:
            ok = n + step <= most
            t = np.where(ok, n + step, 0)
            same = self.sums[x + t] - sx == self.sums[y + t] - sy
            n = np.where(ok & same, t, n)
        return n

    def before(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether i < j and whether they are equal."""
        n = self.common(i, j)
        end_i, end_j = n >= self.size[i], n >= self.size[j]
        a = self.flat[np.minimum(self.at[i] + n, len(self.flat) - 1)]
        b = self.flat[np.minimum(self.at[j] + n, len(self.flat) - 1)]
        return np.where(end_i | end_j, end_i & ~end_j, a < b), end_i & end_j


def merge_sort(s: Suffixes, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes within their groups, which are consecutive; stable."""
    m = len(group)
    order = np.arange(m)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if m else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([edge, [m]]))
    base, end = np.repeat(edge, size), np.repeat(edge + size, size)
    place = np.arange(m) - base
    run = 1
    while run < size.max(initial=0):
        todo = np.flatnonzero(end - base > run)  # slots of groups with more than one run
        if not len(todo):
            break
        own = place[todo] // run
        sibling = own ^ 1
        a = base[todo] + sibling * run
        lo, hi = np.minimum(a, end[todo]), np.minimum(a + run, end[todo])
        low, high, left = lo.copy(), hi.copy(), own & 1 == 0
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) // 2
            less, same = s.before(order[mid], order[todo[live]])
            right = less | (same & ~left[live])  # equals of the left run stay before those of the right run
            low[live] = np.where(right, mid + 1, low[live])
            high[live] = np.where(right, high[live], mid)
            live = live[low[live] < high[live]]
        new = base[todo] + (own >> 1) * 2 * run + (place[todo] - own * run) + (low - lo)
        moved = order.copy()
        moved[new] = order[todo]
        order = moved
        run *= 2
    return order


def sorted_suffixes(flat: np.ndarray, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common length with the one before; -1 between groups), verified on the bytes."""
    s = Suffixes(flat, at, size)
    order = merge_sort(s, group)
    i, j = order[:-1], order[1:]
    lcp = s.common(i, j)
    inside = group[i] == group[j]
    if not verified(s, i[inside], j[inside], lcp[inside]):
        order = np.array(sorted(range(len(group)), key=lambda k: (group[k], flat[at[k] : at[k] + size[k]].tobytes())), np.int64)
        i, j = order[:-1], order[1:]
        lcp = np.array([plain_common(flat, at[a], size[a], at[b], size[b]) for a, b in zip(i, j)], np.int64)
    return order, np.concatenate([[-1], np.where(inside if len(inside) == len(lcp) else True, lcp, -1)]) if len(order) else np.zeros(0, np.int64)


def plain_common(flat: np.ndarray, a: int, n: int, b: int, k: int) -> int:
    n = min(n, k)
    differ = np.flatnonzero(flat[a : a + n] != flat[b : b + n])
    return int(differ[0]) if len(differ) else int(n)


def verified(s: Suffixes, i: np.ndarray, j: np.ndarray, lcp: np.ndarray) -> bool:
    """Whether neighbours agree in just lcp bytes and are in order, byte by byte."""
    for a in range(0, len(i), ROWS):
        x, y, n = s.at[i[a : a + ROWS]], s.at[j[a : a + ROWS]], lcp[a : a + ROWS]
        wide = np.arange(int(n.max(initial=0)))
        last = len(s.flat) - 1
        same = s.flat[np.minimum(x[:, None] + wide, last)] == s.flat[np.minimum(y[:, None] + wide, last)]
        if not (same | (wide >= n[:, None])).all():
            return False
        ended = n >= s.size[i[a : a + ROWS]]
        other = ~ended & (n < s.size[j[a : a + ROWS]])
        if not (ended | other).all() or not (s.flat[x[other] + n[other]] < s.flat[y[other] + n[other]]).all():
            return False
    return True


def solver(length: int):
    def solve(contexts: list[bytes], group: np.ndarray, least: np.ndarray, far: np.ndarray) -> tuple:
        flat = np.frombuffer(b"".join(contexts), np.uint8)
        size = np.fromiter(map(len, contexts), np.int64, len(contexts))
        at = np.cumsum(size) - size
        right = sorted_suffixes(flat, at + far, size - far, group)
        left = sorted_suffixes(np.ascontiguousarray(flat[::-1]), len(flat) - (at + far), far, group)
        return equal_windows(right, left, least, far, length)

    return solve


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, most: int = 1 << 15, id_col: str = "doc_id", text_col: str = "text", texts: bool = False, broadcast_rows: int = 1 << 20) -> DataFrame:
    """One row per input row: id_col, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, or kept (binary) if texts.

    A byte of the UTF-8 text goes if it lies in a string of ``length`` bytes that starts anywhere else too, in the same text or
    another; strings are judged on the input and may overlap. Null texts are empty; repeated rows are each other's repeats; null ids
    stay null; an empty table gives an empty result; other columns, whatever their names, aren't looked at. Lists of copied texts and of
    prefixes with over ``most`` members are broadcast only up to ``broadcast_rows`` counted rows. A group of ``most``
    contexts takes about 90 MB to solve.
    """

    def answer(text: bytes, gone) -> tuple:
        gone = gone(len(text))
        kept = text if gone is None else np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = 0 if gone is None else int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        return len(text), len(text) - len(kept), spans, kept if texts else sha256(kept).hexdigest()

    cols = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept" if texts else "kept_sha256", pa.binary() if texts else pa.string())]
    out = finished(docs, id_col, text_col, False, length, gram, most, solver(length), broadcast_rows, False, answer, cols)
    return out.withColumnRenamed("_id", id_col)
