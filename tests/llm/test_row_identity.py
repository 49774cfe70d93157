"""Null and repeated ids in near-dedup: rows are what is kept or dropped, not ids."""

import random


def rows():
    r = random.Random(3)
    say = lambda n: " ".join(f"w{r.randrange(3000)}" for _ in range(n))
    a, b, c, d, e = (say(60) for _ in range(5))
    return [(None, a), (None, b), (7, c), (7, d), (7, c.upper()), (9, d.replace(" ", "\n")), (None, e), (3, e.upper()), (None, a.upper()), (None, b), (None, None), (None, "")], (a, b, c, d, e)


def kept(out):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -1), " ".join((r["text"] or "").lower().split())) for r in out.collect())


def test_one_row_stays_of_each_component(spark):
    from eventweir.llm.simhash import one_of_each

    import corpus_pipeline

    given, (a, b, c, d, e) = rows()
    docs = spark.createDataFrame([(i, t, "en") for i, t in given], "doc_id long, text string, lang string").repartition(4)
    want = sorted([(-1, a), (-1, b), (7, c), (7, d), (3, e), (-1, "")])
    assert kept(one_of_each(docs)) == want
    assert kept(corpus_pipeline.simhash_near_dedup(spark, docs, "")) == want


def test_repeated_ids_do_not_fuse_components(spark):
    from eventweir.llm.simhash import near_duplicates

    given, (a, b, c, d, e) = rows()
    docs = spark.createDataFrame([(7, a), (7, b), (2, a.upper()), (8, c), (None, c.upper())], "doc_id long, text string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [(-1, 8), (2, 2), (7, 2), (7, 7), (8, 8)]
