"""The near-dedup stage: word-level near copies, and null and repeated ids."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string"


def words(t):
    w = (t or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def parts(rows):
    """Components of five-word Jaccard 0.8 or more, by brute force, as root of each row."""
    sets, root = [words(t) for _, t in rows], list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if root[a] != root[b] and len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def made(seed=5):
    r = random.Random(seed)
    rows = []
    for _ in range(40):
        w = [f"w{r.randrange(4000)}" for _ in range(r.randint(3, 400))]
        for _ in range(r.randint(1, 4)):
            c = list(w)
            for at in r.sample(range(len(c)), len(c) * r.randint(0, 4) // 100):
                c[at] = f"x{r.randrange(4000)}"
            rows.append((len(rows), " ".join(c)))
    return rows


@pytest.mark.parametrize("most", [4096, 2])
def test_stage_keeps_one_of_each_at_jaccard(spark, most):
    from eventweir.llm.near_copies import one_of_alike

    rows = made()
    root = parts(rows)
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).repartition(3)
    assert sorted(r["doc_id"] for r in one_of_alike(docs, most=most).collect()) == sorted(set(root))


def test_pipeline_stage_drops_near_copies_beyond_three_bits(spark):
    import corpus_pipeline

    rows = made()
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).repartition(3)
    assert sorted(r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()) == sorted(set(parts(rows)))
