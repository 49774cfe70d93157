"""The near-dedup stage's SimHash prints, what its chains find, and what it shuffles."""

import random

import numpy as np
import pytest


def held(a, b, ring):
    """Whether two prints meet at a start and their chain keeps within its budgets."""
    from eventweir.llm.near_copies import BUDGET

    x = np.unpackbits(a ^ b, bitorder="little").astype(int)
    x = np.concatenate([x, x[: ring.width + 128]])
    for i in range(ring.starts):
        at = i * ring.bits // ring.starts
        near, far = (x[at : at + ring.width + n].sum() for n in (64, 128))
        if not x[at : at + ring.width].any() and near <= int((ring.width + 64) * BUDGET) and far <= int((ring.width + 128) * BUDGET):
            return True
    return False


def test_prints_are_majorities():
    from eventweir.llm.near_copies import ODD, mixed, prints

    r = np.random.default_rng(4)
    counts = np.array([1, 2, 7, 255, 256, 1000])
    flat = r.integers(0, 2**64, counts.sum(), np.uint64)
    got, at = prints(flat, counts, 128), 0
    for row, n in zip(got, counts):
        each = np.concatenate([np.unpackbits(mixed(flat[at : at + n] ^ (np.uint64(k) * ODD)).view(np.uint8).reshape(n, 8), axis=1, bitorder="little") for k in range(2)], axis=1)
        assert (np.unpackbits(row, bitorder="little") == (each.astype(int).sum(axis=0) * 2 > n)).all()
        at += n


@pytest.mark.parametrize("texts", [1, 50_000, 250_000, 15_000_000])
def test_chains_find_pairs_at_four_fifths(texts):
    from eventweir.llm.near_copies import Ring, prints

    r, ring, found = np.random.default_rng(6), Ring.of(texts), 0
    for _ in range(400):
        n = 9 * int(r.integers(2, 60))
        h = r.integers(0, 2**64, n // 9 * 10, np.uint64)  # of 10 parts both have 8
        a, b = prints(np.concatenate([h[:n], h[n // 9 :]]), np.array([n, n]), ring.bits)
        found += held(a, b, ring)
    other = prints(r.integers(0, 2**64, 40_000, np.uint64), np.full(400, 100), ring.bits)
    assert found >= 398 and sum(held(a, b, ring) for a, b in zip(other, other[1:])) == 0


def test_stage_links_through_simhash(spark, monkeypatch):
    """Prints that no chain can link leave every row in place."""
    from eventweir.llm import near_copies

    r = random.Random(9)
    w = [f"w{r.randrange(4000)}" for _ in range(200)]
    docs = spark.createDataFrame([(1, " ".join(w)), (2, " ".join([*w, "x"]))], "doc_id long, text string")
    assert [x["doc_id"] for x in near_copies.one_of_alike(docs).collect()] == [1]
    monkeypatch.setattr(near_copies, "BUDGET", -1.0)
    assert sorted(x["doc_id"] for x in near_copies.one_of_alike(docs).collect()) == [1, 2]


def test_long_buckets_link_like_short_ones(spark, monkeypatch):
    from eventweir.llm import near_copies

    from test_near_copies import made, parts

    rows = made(11)
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(near_copies, "LONG", 3)
    monkeypatch.setattr(near_copies, "FILTERED", 0)
    assert sorted(x["doc_id"] for x in near_copies.one_of_alike(docs).collect()) == sorted(set(parts(rows)))


def test_stage_returns_rows_without_shuffling_texts(spark):
    from eventweir.llm.near_copies import one_of_alike

    docs = spark.createDataFrame([(i, f"the cat sat on the mat number {i // 2} today") for i in range(12)], "doc_id long, text string")
    out = one_of_alike(docs)
    assert out.count() == 6 and "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
