"""Substring dedup on words: prefix-partitioned suffix trees.

Suffixes are split by prefix: by the first ``gram`` words, and where more than ``most`` suffixes share these, by prefixes that are made
longer until what shares one fits (see _repeats, step 4). Every group fits in memory and gets a subtree. The subtree is held
as the sorted suffixes and the depths of the internal nodes between neighbours; the suffixes below one internal node of depth d
are those whose neighbours have at least d words in common. A second subtree holds the reversed words before each
suffix. A deep internal node of the one, cut by the nodes of the other, is a repeat, and of window length or more it is
removed: two leaves below a node of depth r of the one and of depth l of the other share a maximal repeat of l + r words, whose windows
go. Words are compared as words: a group's distinct words are numbered, and hashes only choose who meets whom.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._repeats import equal_windows, finished


def subtree(group: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, depth): suffixes sorted by group and symbols, and the depth of the node that joins each to the one before; -1 between groups.

    path has a row of symbols for each suffix; negative numbers, all different, stand behind its end.
    """
    rows = np.concatenate([group[:, None], path], axis=1).astype(">i8")
    raw = np.ascontiguousarray(rows ^ np.int64(-(1 << 63))).astype(">i8").view(f"V{8 * rows.shape[1]}").reshape(-1)
    order = np.array(sorted(range(len(rows)), key=raw.tolist().__getitem__), np.int64) if len(rows) else np.zeros(0, np.int64)
    s = rows[order]
    same = np.cumprod(s[1:] == s[:-1], axis=1).sum(axis=1) - 1
    return order, np.concatenate([[-1], same]) if len(s) else np.zeros(0, np.int64)


def solver(length: int):
    def solve(contexts: list[bytes], group: np.ndarray, least: np.ndarray, far: np.ndarray) -> tuple:
        number: dict[bytes, int] = {}
        ids = [[number.setdefault(w, len(number)) for w in c.split()] for c in contexts]
        m, deep, back = len(ids), int((length - least).max()), int(far.max())
        after, before = np.empty((m, deep), np.int64), np.empty((m, max(back, 1)), np.int64)
        after[:] = before[:] = -1 - np.arange(m)[:, None]
        for i, (x, f) in enumerate(zip(ids, far.tolist())):
            after[i, : len(x) - f] = x[f:]
            before[i, :f] = x[:f][::-1]
        return equal_windows(subtree(group, after), subtree(group, before), least, far, length)

    return solve


def remove_repeats(docs: DataFrame, length: int = 35, gram: int = 8, most: int = 1 << 15, id_col: str = "doc_id", text_col: str = "text", texts: bool = False, broadcast_rows: int = 1 << 20) -> DataFrame:
    """One row per input row: id_col, n_words, n_removed, kept_sha256 (of the kept words joined by a space), or kept if texts.

    A word goes if it lies in a window of ``length`` words that starts anywhere else too, in the same text or another. Windows are
    judged on the input. Null and empty texts have no words; repeated rows are each other's repeats; null ids stay null; an empty table
    gives an empty result; other columns, whatever their names, aren't looked at. Lists of copied texts and of prefixes with
    over ``most`` members are broadcast only up to ``broadcast_rows`` counted rows. A group of ``most``
    contexts takes about 300 MB to solve.
    """

    def answer(text: bytes, gone) -> tuple:
        w = text.split()
        gone = gone(len(w))
        kept = w if gone is None else list(compress(w, (~gone).tolist()))
        said = b" ".join(kept)
        return len(w), len(w) - len(kept), said.decode() if texts else sha256(said).hexdigest()

    cols = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept" if texts else "kept_sha256", pa.string())]
    out = finished(docs, id_col, text_col, True, length, gram, most, solver(length), broadcast_rows, True, answer, cols)
    return out.withColumnRenamed("_id", id_col)
