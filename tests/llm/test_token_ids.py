"""Token ids against the tokenizers library, character by character, and memory on texts without spaces."""

import random
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(WORDS)


def ids_of(texts):
    from eventweir.llm.token_files import encoder

    enc, memo = encoder(WORDS)
    out = []
    for t in texts:
        units = t.encode().split()
        memo.learn(units)
        out.append(np.frombuffer(b"".join(map(memo.__getitem__, units)), enc.width).tolist())
    return out


def test_every_code_point_between_letters(library):
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(texts), 1 << 16):
        part = texts[a : a + (1 << 16)]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert ids_of([" ".join(part)])[0] == [i for x in want for i in x]


def test_random_strings(library):
    r = random.Random(8)
    alphabet = [*"abcXYZ019 .,'-<|>_\t\n", "'s", "'LL", "é", "é", "Σ", "ς", "İ", "漢", " ", " ", "‍", "😀", "ﬁ", "½", "<|endoftext|>", "ا", "̀"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(100_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = ids_of(texts)
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_text_without_spaces(library, spark):
    from eventweir.llm.token_files import token_file_digests

    r = random.Random(9)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(5_000_000)), "漢字かな交じり文" * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: (x["n_tokens"], x["ids_crc32"]) for x in token_file_digests(docs, WORDS, end_id=1).collect()}
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


def test_memo_is_bounded():
    from eventweir.llm._batches import Memo

    memo = Memo(lambda words: [w * 2 for w in words], 50_000)
    for i in range(50):
        words = [f"{i}-{k}".encode() for k in range(30 if i % 7 else 400)] + [b"x" * 1000 + bytes([i]), b"often"]
        memo.learn(words)
        assert all(memo[w] == w * 2 for w in words)
        assert memo.held <= 50_000 and not any(len(w) > memo.LONG for w in memo)


def test_long_units_are_cut_where_no_piece_lies_across():
    from eventweir.llm.unigram import Unigram

    m = Unigram(public_tokenizers.path("piece_bpe_32k.model"))
    r = random.Random(10)
    for alphabet in ("abcdefgh", "漢字かな交り文é", "0123456789+/=", "a", "▁😀x"):
        unit = "".join(r.choice(alphabet) for _ in range(700)).encode()
        assert np.frombuffer(m([unit])[0], m.width).tolist() == m.one(unit)
    big = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(5_000_000)).encode()
    assert m.decode(np.frombuffer(b"".join(m([b" " + big])), m.width)) == big
