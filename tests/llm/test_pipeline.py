"""The pipeline against plain Python over the same rows."""

import random
import re

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")


def brute(rows, items):
    """The stages in plain Python over rows (id, text, language, source): language by the formulas, equal texts, five-word Jaccard, item windows."""
    from test_language_id import plain
    from test_near_copies import parts

    told = plain([(k, t, lang, host) for k, (_, t, lang, host) in enumerate(rows)])
    rows = [(rows[k][0], rows[k][1]) for k, lang, posterior in told if lang is not None and posterior >= 0.6]
    rows = sorted((max(i for i, u in rows if u == t), t) for t in {t for _, t in rows})
    rows = [r for k, r in enumerate(rows) if parts(rows)[k] == k]
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = {tuple(cut(x)[a : a + 10]) for x in items for a in range(max(1, len(cut(x)) - 9))} - {()}
    return [(i, t) for i, t in rows if not any(tuple(cut(t)[s : s + len(g)]) == g for g in grams for s in range(len(cut(t))))]


def test_run_equals_plain_python(spark, tmp_path):
    import corpus_pipeline
    from eventweir.llm.unigram import decode

    r = random.Random(8)
    vocab = {"en": [f"the{c}{d}" for c in "abcdef" for d in "xyz"], "de": [f"der{c}{d}ß" for c in "abcdef" for d in "uvw"]}
    say = lambda lang, n: " ".join(r.choice(vocab[lang]) for _ in range(n))
    rows = [(i, say("en" if i % 2 else "de", r.randint(30, 80))) for i in range(40)]
    item = say("en", 14)
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[4][1] + " x"), (103, say("en", 20) + " " + item.upper() + "!"), (104, None), (105, "12 34"), (106, ""), (107, rows[6][1].replace(" ", "\n")), (108, " ".join(rows[8][1].split()[:-2] + ["thenew"]))]
    docs = [(i, t, "en" if i % 2 else "de", f"src{i % 3}", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = {x["doc_id"]: x["text"] for x in decode(out, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == dict(brute([x[:4] for x in docs], [item]))
    assert 100 not in got and 103 not in got and all(x["lossless"] for x in out.collect())


def test_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = "_id string, _t1 string, _uid string, g string, words array<string>, _copied string, hit_words string, u string"
    empty = spark.createDataFrame([], f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    few = spark.createDataFrame([(i, f"the cat sat on mat number {i // 2} today", "en", "h", 9, *("c",) * 4, ["c"], *("c",) * 3) for i in [*range(12), 3]] + [(None, None, None, None, None, *("c",) * 4, None, *("c",) * 3)], empty.schema)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES:
        out, some = stage(spark, empty, str(tmp_path)), stage(spark, few, str(tmp_path))
        assert out.count() == 0 and some.count() > 0
        if name != "sentencepiece":
            assert out.columns == some.columns == empty.columns
