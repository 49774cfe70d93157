"""The substring operators where copies, hot prefixes and long texts strain them."""

import random
import re
import time

import pytest

from test_operators import hexsum, repeats


def want_words(rows, length=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    out = []
    for (i, _), w, gone in zip(rows, words, repeats(words, length)):
        kept = [x for x, y in zip(w, gone) if not y]
        out.append((str(i), str(len(w)), str(len(w) - len(kept)), hexsum(" ".join(kept))))
    return sorted(out)


def got_words(docs, **kw):
    from eventweir.llm.suffix_tree import remove_repeats

    return sorted(tuple(str(x) for x in (r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in remove_repeats(docs, **kw).collect())


@pytest.mark.parametrize("broadcast_rows", [1 << 20, 0])
def test_prefixes_grow_until_a_group_fits(spark, broadcast_rows):
    r = random.Random(3)
    word = lambda: f"v{r.randrange(400)}"
    common = [word() for _ in range(30)]  # shorter than a window: only what stands around it decides
    around = [[word() for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(60):
        a, b = r.choice(around), r.choice(around)
        rows.append((i, " ".join([*(word() for _ in range(r.randrange(20))), *a, *common[r.randrange(8) :], *b, *(word() for _ in range(r.randrange(20)))])))
    rows += [(100, rows[0][1]), (None, rows[1][1]), (None, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got_words(docs, most=3, broadcast_rows=broadcast_rows) == want_words(rows)


def test_repeated_rows_cost_no_more_than_others(spark):
    r = random.Random(4)
    texts = [" ".join(f"x{r.randrange(10**6)}" for _ in range(600)) for _ in range(400)]
    same = spark.createDataFrame([(7, texts[0])] * 400, "doc_id long, text string").repartition(4)
    other = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got_words(other)
    t = time.time()
    assert {x[2] for x in got_words(other)} == {"0"}
    base = time.time() - t
    t = time.time()
    got = got_words(same)
    assert len(got) == 400 and {x[2] for x in got} == {"600"}
    assert time.time() - t < 2 * base + 2


def test_long_texts(spark):
    from eventweir.llm.suffix_sort import remove_repeats

    r = random.Random(5)
    long = " ".join(f"y{r.randrange(10**7)}" for _ in range(400_000))  # over 3 MB, more than a piece
    words = long.split(" ")
    rows = [(1, long), (2, " ".join(words[390_000:390_040])), (3, "short"), (4, "q" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert {x[0]: x[2] for x in got_words(docs)} == {"1": "40", "2": "40", "3": "0", "4": "0"}
    said = " ".join(words[390_000:390_040])
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"]) for x in remove_repeats(docs).collect()}
    assert got[1] == got[2] == (len(said), 1) and got[3] == got[4] == (0, 0)


def test_lengths_that_do_not_fit_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        got_words(docs, length=4096)
    with pytest.raises(ValueError):
        got_words(docs, length=7)


def test_many_partitions_do_not_make_many_files(spark):
    from eventweir.llm import _shared
    from eventweir.llm.suffix_sort import remove_repeats

    r = random.Random(6)
    word = lambda: f"z{r.randrange(10**6)}"
    common = " ".join(word() for _ in range(14))  # under 200 bytes: contexts of one prefix differ
    parts = [" ".join(word() for _ in range(60)) for _ in range(100)]
    rows = [(i, " ".join([parts[i % 100], common, word(), parts[i * 7 % 100], word()])) for i in range(300)]
    rows += [(i + 300, rows[i][1]) for i in range(0, 300, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(80)
    held = {"spark.sql.shuffle.partitions": "120", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in held}
    at = len(_shared._SCRATCH)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = remove_repeats(docs, most=20)
        got = sorted((x["doc_id"], x["n_removed"], x["kept_sha256"]) for x in out.collect())
        parts = out.rdd.getNumPartitions()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    most = 8 * spark.sparkContext.defaultParallelism  # the result has the parts of its exchange besides
    files = [len(spark.read.parquet(p).inputFiles()) for p in _shared._SCRATCH[at:]]
    assert len(files) > 4 and max(files) <= most and parts <= 120 + most
    texts = [t.encode() for _, t in rows]
    want = [(i, sum(gone), hexsum(bytes(x for x, y in zip(b, gone) if not y))) for (i, _), b, gone in zip(rows, texts, repeats(texts, 200))]
    assert got == sorted(want)
