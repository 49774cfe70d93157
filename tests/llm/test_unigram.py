import math
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from eventweir.llm.unigram import Unigram, decode, encode, loaded  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return loaded(PATH)


def brute(m: Unigram, text: bytes) -> float:
    """The best score of a whole text over all pieces, without units."""
    pieces = {p: m.score[i] for i, p in enumerate(m.bytes_of) if p and i not in set(m.byte_id.tolist())}
    s = (b" " + text) if text else b""
    best = [0.0] + [-math.inf] * len(s)
    chars = [i for i in range(len(s)) if s[i] & 0xC0 != 0x80] + [len(s)]
    for a, e in zip(chars, chars[1:]):
        if s[a:e] not in pieces:
            best[e] = max(best[e], best[a] + m.unknown)
        for n in range(1, m.longest + 1):
            if s[a : a + n] in pieces and a + n <= len(s):
                best[a + n] = max(best[a + n], best[a] + pieces[s[a : a + n]])
    return best[-1]


def score(m: Unigram, ids: np.ndarray, text: bytes) -> float:
    spelt, total, run = set(m.byte_id.tolist()), 0.0, []
    for i in [*ids.tolist(), None]:
        if i in spelt:
            run.append(i)
            continue
        total += m.unknown * len(b"".join(m.bytes_of[x] for x in run).decode())
        run = []
        total += m.score[i] if i is not None else 0
    return total


TEXTS = ["", " ", "  a  b\n\n c", "The quick brown fox", "été — naïve ﬁ Ⅷ", "▁literal ▁▁ marker", "漢字かな交じり文", "\x00\x01\t tab", "a" * 300, " " * 70 + "x", "😀👩‍👩‍👧"]


@pytest.mark.parametrize("text", TEXTS)
def test_best_path_and_round_trip(model, text):
    m, memo = model
    ids = m.encode_with(memo, [text.encode()])[0]
    assert m.decode(ids).decode() == text
    assert score(m, ids, text.encode()) == pytest.approx(brute(m, text.encode()))


def test_side_by_side_equals_alone(model):
    m, _ = model
    rng = random.Random(3)
    units = list({("".join(rng.choice("  abcdeé漢ing.▁😀") for _ in range(rng.randint(1, 20)))).encode().replace(b"\n", b"") for _ in range(400)})
    from eventweir.llm.unigram import UNITS

    units = list({u for x in units for u in UNITS(x)})
    assert [np.frombuffer(b, m.width).tolist() for b in m(units)] == [m.one(u) for u in units]


def test_tables(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (None, "z", "y"), (3, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode(docs, PATH)
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["lossless"]) for r in got.collect()) == [(-1, 1, True), (1, 2, True), (1, 2, True), (2, 0, True), (3, 0, True)]
    assert sorted((r["doc_id"] or -1, r["text"]) for r in decode(got, PATH).collect()) == [(-1, "z"), (1, "a b"), (1, "a b"), (2, ""), (3, "")]
    assert encode(docs.limit(0), PATH).count() == 0
