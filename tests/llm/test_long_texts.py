"""Texts of several megabytes, longer than the pieces that batches are cut into."""

import random

from eventweir.llm import chat_format, near_copies, simhash


def test_chat_formatting(spark):
    from pyspark.sql import functions as F

    long = "a <b> \\ c é " * 300_000
    turns = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    out = chat_format.format_chats(turns)
    got = {r["conv_id"]: r for r in out.select("conv_id", chat_format.read_back(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    assert [t["text"] for t in got[1]["t"]] == [long, long] and got[1]["l"] == long and got[2]["l"] == "x"


def test_near_duplicates(spark):
    r = random.Random(2)
    words = [f"w{r.randrange(10**6)}" for _ in range(400_000)]
    near = list(words)
    for at in r.sample(range(len(near)), 3000):
        near[at] = "other"
    texts = [" ".join(words), " ".join(words).upper(), " ".join(near), "short text of its own", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in simhash.near_duplicates(docs).collect()}
    assert got[0] == got[1] and got[3][1] == 3 and got[4] == ("0" * 16, 4)
    assert sorted(x["doc_id"] for x in near_copies.one_of_alike(docs).collect()) == [0, 3, 4]
