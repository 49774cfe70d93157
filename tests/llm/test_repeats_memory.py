"""What a Python worker of the substring operators holds: it shares an executor's memory with another worker and the JVM."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from eventweir.llm import _repeats, suffix_sort


def held(run):
    """What run() returns, the MB that it needs at most and the MB that stay, beside what it returns."""
    _repeats.powers.cache_clear()
    tracemalloc.start()
    try:
        out = run()
        now, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    return out, peak / 1e6, now / 1e6


def hot_group(n):
    """Contexts around a common gram, with a few differing bytes on both sides."""
    r = np.random.default_rng(6)
    flat = np.full((n, 336), 97, np.uint8)
    flat[:, ::9] = r.integers(97, 99, (n, 38))
    flat[:, 136:200] = 98
    return [x.tobytes() for x in flat], np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, 136)


def test_a_large_group_is_solved_in_little_memory():
    (member, lo, hi), peak, stays = held(lambda: suffix_sort.solver(200)(*hot_group(16384)))
    assert peak < 100 and stays < 10  # the contexts themselves take 12 of them
    assert len(member) and (lo <= hi).all() and lo.min() >= 0 and hi.max() <= 136


def test_ranges_are_those_of_a_count_of_windows():
    contexts, group, least, far = hot_group(400)
    r = np.random.default_rng(7)
    group, least, far = np.sort(r.integers(0, 40, 400)), r.integers(0, 60, 400), r.integers(60, 137, 400)
    mixed = [contexts[x][:150] + contexts[y][150:] for x, y in r.integers(0, 3, (400, 2))]  # three ways to begin, three to end
    contexts = [c[136 - f : 336 - a] for c, a, f in zip(mixed, least.tolist(), far.tolist())]
    windows = lambda i: ((o, contexts[i][far[i] - o : far[i] - o + 200]) for o in range(least[i], far[i] + 1))
    n = Counter((group[i], w) for i in range(400) for w in windows(i))
    want = {(i, o) for i in range(400) for o, w in windows(i) if n[group[i], (o, w)] > 1}
    got = [(int(i), o) for i, a, b in zip(*suffix_sort.solver(200)(contexts, group, least, far)) for o in range(a, b + 1)]
    assert 400 < len(want) < sum(far - least + 1) and len(got) == len(set(got)) and set(got) == want


def test_small_groups_are_solved_few_at_a_time():
    r = np.random.default_rng(8)
    sizes = [*r.integers(1, 9, 6000), 9000, 3, 4096, 4097, 1, *r.integers(1, 9, 3000), 25000]
    k2 = np.repeat(np.arange(len(sizes)), sizes)
    table = pa.table({"k1": k2 // 7, "k2": k2, "p": np.arange(len(k2))})
    got = list(_repeats.whole_groups(table.to_batches(max_chunksize=10000)))
    assert pa.concat_tables(got).combine_chunks().equals(table.combine_chunks())
    groups = [t.column("k2").to_numpy() for t in got]
    assert all(t.num_rows <= _repeats.BATCH or k[0] == k[-1] for t, k in zip(got, groups))
    assert all(a[-1] != b[0] for a, b in zip(groups, groups[1:]))
    assert len(got) < 2 * len(k2) / _repeats.BATCH + 10
    assert list(_repeats.whole_groups([])) == list(_repeats.whole_groups(table.slice(0, 0).to_batches())) == []


def test_hashes_of_a_long_text_leave_no_large_tables():
    values = np.random.default_rng(9).integers(0, 1 << 62, 3_000_000).astype(np.uint64)
    grams, _, stays = held(lambda: _repeats.rolling(values, 64))
    assert stays < grams.nbytes / 1e6 + 20
    assert (grams[-100:] == _repeats.rolling(values[-163:], 64)).all() and len(_repeats.rolling(values[:63], 64)) == 0
