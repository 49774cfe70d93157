"""Decontamination where ids repeat, names clash and texts are long."""

import time

import pytest


def test_rows_that_share_an_id_keep_their_own_words(spark):
    from eventweir.llm.decontaminate import decontaminate, drop_contaminated, remove_spans

    leak = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    clean = "one two three four five six seven eight nine ten eleven twelve zero"
    rows = [(7, f"zero {leak} zero", "x"), (7, clean, "x"), (None, clean, "x"), (None, f"so {leak}", "x"), (8, None, "x"), (9, "", "x"), (7, f"zero {leak} zero", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hit_words string")
    bench = spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in remove_spans(docs, bench).collect())
    assert got == sorted([("7", "zero zero"), ("7", clean), ("None", clean), ("None", "so"), ("8", "None"), ("9", ""), ("7", "zero zero")])
    assert sorted(r["n_hit"] for r in decontaminate(docs, bench).collect()) == [0, 0, 0, 0, 10, 10, 10]
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(str(r["text"]) for r in left.collect()) == sorted([clean, clean, "None", ""])
    assert remove_spans(docs, bench.limit(0)).count() == len(rows) and drop_contaminated(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_time_grows_with_the_text_not_with_its_square(spark, broadcast_bytes):
    from eventweir.llm.decontaminate import decontaminate

    leak = " ".join(f"leak{i}" for i in range(10))
    bench = spark.createDataFrame([(1, leak), (2, "lone word")], "item_id long, text string")
    took = []
    for n in (1000, 100_000, 400_000):
        docs = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(n)) + " " + leak)], "doc_id long, text string")
        t = time.time()
        (row,) = decontaminate(docs, bench, broadcast_bytes=broadcast_bytes).collect()
        took.append(time.time() - t)
        assert row["n_words"] == n + 10 and row["hit_words"] == list(range(n, n + 10))
    assert took[2] < 6 * took[1] + 1
