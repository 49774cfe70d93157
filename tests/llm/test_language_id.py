"""Language identification against plain Python, and its accuracy without the declared language."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest


def plain(rows, temper=8.0, kappa=20.0, min_rows=5, depth=3, use_declared=True):
    """(lang, posterior) of each (id, text, declared, host) by the formulas, row by row."""
    from eventweir.llm.language_id import trigram_buckets

    def grams(t):
        return trigram_buckets(np.frombuffer((t or "").encode(), np.uint8)).tolist()

    def letters(t):
        return any(c.isalpha() or ord(c) > 127 for c in t or "")

    low = lambda s: None if s is None else s.lower()
    n = Counter(low(d) for _, t, d, _ in rows if d is not None and letters(t))
    langs = sorted(l for l, c in n.items() if c >= min_rows) or ["und"]
    counts = {l: Counter() for l in langs}
    for _, t, d, _ in rows:
        if low(d) in counts:
            counts[low(d)].update(grams(t))
    logp = {l: (lambda c, s: lambda g: math.log((c[g] + 0.5) / s))(c, sum(c.values()) + 0.5 * (1 << 15)) for l, c in counts.items()}
    ll = [[sum(logp[l](g) for g in grams(t)) / temper for l in langs] for _, t, _, _ in rows]
    best = [max(range(len(langs)), key=lambda i: (x[i], -i)) for x in ll]
    ok = [letters(t) for _, t, _, _ in rows]
    keys = [[h] + [".".join(h.split(".")[-k:]) for k in range(depth - 1, 0, -1)] for h in [low(h) or "" for *_, h in rows]]
    hosts, said = [defaultdict(Counter) for _ in range(depth)], defaultdict(Counter)
    for k, b, o, (_, _, d, _) in zip(keys, best, ok, rows):
        if o:
            for j in range(depth):
                hosts[j][k[j]][b] += 1
            if d is not None:
                said[low(d)][b] += 1
    total = Counter(b for b, o in zip(best, ok) if o)
    all_said = Counter()
    for c in said.values():
        all_said.update(c)
    out = []
    for k, b, o, x, (i, _, d, _) in zip(keys, best, ok, ll, rows):
        if not o:
            out.append((i, None, 0.0))
            continue
        own = [float(j == b) for j in range(len(langs))]
        top = [total[j] - own[j] + 1 for j in range(len(langs))]
        p = [v / sum(top) for v in top]
        for j in reversed(range(depth)):
            c = [hosts[j][k[j]][q] - own[q] for q in range(len(langs))]
            p = [(c[q] + kappa * p[q]) / (sum(c) + kappa) for q in range(len(langs))]
        s = [a + math.log(q) for a, q in zip(x, p)]
        if use_declared and d is not None:
            s = [a + math.log((said[low(d)][q] - own[q] + 1) / (all_said[q] - own[q] + len(said) + 1)) for q, a in enumerate(s)]
        m = max(s)
        out.append((i, langs[s.index(m)], 1 / sum(math.exp(a - m) for a in s)))
    return out


def made(n, seed=4):
    r = random.Random(seed)
    words = {"en": "the and of that with have this from they which".split(), "de": "der und das nicht mit auch für über haben werden".split(), "fr": "les des une est dans pour qui avec sur être".split()}
    return [(i, " ".join(r.choice(words[l]) for _ in range(r.randint(1, 12))), l, r.choice([f"{l}.site.example.com", "mixed.org", None])) for i, l in enumerate(["en", "de", "fr"] * n)]


@pytest.mark.parametrize("use_declared", [True, False])
@pytest.mark.parametrize("broadcast_rows", [1 << 17, 0])
def test_posteriors_are_those_of_the_formulas(spark, use_declared, broadcast_rows):
    from eventweir.llm.language_id import identify_documents

    rows = made(25)
    rows += [(500, None, "en", "x"), (501, "", None, None), (502, "12 34", "de", "mixed.org"), (503, rows[0][1], "FR", "mixed.org"), (504, rows[1][1], None, None), (505, "rare words", "xx", "lone.host"), (0, rows[0][1], "en", rows[0][3]), (None, rows[2][1], "fr", None), (506, "ab", "de", "mixed.org")]
    docs = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, lang string, source string, posterior string").repartition(3)
    order = lambda rows: sorted(rows, key=lambda x: (str(x[0]), x[2]))
    got = order((r["doc_id"], r["lang"], r["posterior"]) for r in identify_documents(docs, use_declared=use_declared, broadcast_rows=broadcast_rows).collect())
    want = order(plain(rows, use_declared=use_declared))
    assert [x[:2] for x in got] == [x[:2] for x in want] and [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-5)


def test_held_out_accuracy_without_the_declared_language(spark):
    """Half of the driver's documents teach; the others, with neither label nor host, are told by their text."""
    from pyspark.sql import functions as F

    from eventweir.llm.language_id import identify_documents

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and length(text) >= 40")
    held = F.col("doc_id") % 2 == 0
    rows = docs.select("doc_id", "text", F.when(~held, F.col("lang")).alias("lang"), F.lit(None).cast("string").alias("source"))
    told = identify_documents(rows).join(docs.select("doc_id", F.col("lang").alias("true")), "doc_id").where(held & F.col("lang").isNotNull())
    n, right = told.agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.lower("true"))).first()
    assert n > 300 and right / n > 0.95


def test_languages_are_bounded(spark):
    from eventweir.llm.language_id import identify_documents

    rows = [(i, f"word{i} text", f"l{i % 40:02d}", "h") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert identify_documents(docs, max_languages=3).select("lang").distinct().count() <= 3


def test_long_texts(spark):
    from eventweir.llm.language_id import identify_documents

    rows = [*made(10), (900, "und das nicht " * 300_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r["doc_id"]: r["lang"] for r in identify_documents(docs).collect()}[900] == "de"
