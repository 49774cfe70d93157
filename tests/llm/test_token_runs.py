"""Token ids of whole texts, cut at marks and made small before the library sees them, and what a worker holds."""

import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts, known):
    from eventweir.llm.token_files import encoder, ids_of_texts

    ids, first = ids_of_texts(encoder(WORDS)[0], known, pa.array(texts, pa.string()), 1)
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_texts_against_the_library():
    from eventweir.llm.token_files import KnownWords, encoder

    r = random.Random(11)
    alphabet = [*"abHSTxyz019 .,;:!?)('-<|>_\t\n\r\v\f\x1c\x00", "'S", "'ll", "H̱", "ẖ", "J̌", "J", "̱", "̣", "ẖ", "É", "é", "ß", "Ж", "ж", "Σ", "ς", "İ", "K", "Å", "漢", " ", " ", "‍", "😀", "ﬁ", "½", "”", "…", "<|endoftext|>", "<|ENDOFTEXT|>", "ا", "word", "Ward"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(14))) for _ in range(60_000)]
    texts += [None, "", " ", "x", "X.", ".", "<|endoftext|>.", "a" * 300 + ".", "B" * 300]
    want = [[*e.ids, 1] for e in tokenizers.Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    known = KnownWords(encoder(WORDS)[0], 200_000)
    got = []
    for a in range(0, len(texts), 701):
        got += ids_of(texts[a : a + 701], known)
        assert known.words.nbytes + known.ids.nbytes <= 200_000 and max(map(len, known.words.to_pylist()), default=0) <= known.LONG
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
    assert ids_of([], known) == [] and ids_of([None], known) == [[1]]


def test_every_code_point_before_a_closing_mark():
    from eventweir.llm.token_files import KnownWords, encoder

    lib, known = tokenizers.Tokenizer.from_file(WORDS), KnownWords(encoder(WORDS)[0], 1 << 24)
    chars = [chr(c) for c in range(0x3000) if not chr(c).isspace()]
    for mark in ".,;:!?)":
        texts = [f"{c}{mark} B{c} {c}A{mark}" for c in chars]
        want = [[*e.ids, 1] for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert [t for t, a, b in zip(texts, ids_of(texts, known), want) if a != b] == []


def test_blocks_of_values_of_any_width():
    from eventweir.llm.token_files import decode_block, encode_block

    r = np.random.default_rng(3)
    for top in (1, 200, 60_000, 1 << 16, 1 << 24, 1 << 32):
        for n in (0, 1, 2, 5, 1000):
            v = r.integers(0, top, n).astype("<u4")
            control, data = encode_block(v)
            assert len(data) == sum(1 + (x > 0xFF) + (x > 0xFFFF) + (x > 0xFFFFFF) for x in v.tolist())
            assert decode_block(control, data, n).tolist() == v.tolist()


HOLDS = """
import random, re, sys
import numpy as np, pyarrow as pa
from eventweir.llm import token_files as t
anon = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
docs = lambda k, n: pa.RecordBatch.from_arrays([pa.array([0]), pa.array([" ".join("".join(x) for x in np.random.default_rng(k).choice([*"abcdefghijklmnop"], (n, 9))) + "."])], ["doc_id", "text"])

class Docs:
    def mapInArrow(self, run, schema):
        self.run = run
d = Docs()
t.tokenised(d, sys.argv[1], 1, [])
for _ in d.run([docs(999, 10)]):
    pass
before = anon()
for _ in d.run(docs(k, 100_000) for k in range(24)):
    pass
print(anon() - before)
"""


def test_a_worker_holds_little_of_many_words():
    out = subprocess.run([sys.executable, "-c", HOLDS, WORDS], capture_output=True, text=True, timeout=300)
    assert int(out.stdout) < 160, out.stderr
