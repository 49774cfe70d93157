"""Personal data: fixed patterns, plus a linear-chain conditional random field over word-shape features.

The patterns find e-mail addresses, IP addresses, card and phone numbers (checked by range, Luhn sum and number of digits). The
field labels words and adds spans that the patterns can't express: phone numbers without a plus sign, addresses spelt with "at" and "dot",
and secrets (access keys, passwords, tokens, headers of private keys). It is trained here from a small labelled table (pii_lines), each line
of which is varied a few times. Its features are shapes: kinds of characters and their runs, lengths, what stands before an equals sign,
the first letters of words with digits, the words that the table has near its spans, and the same of three words to either side. Its spans never
replace a pattern's: what touches one is dropped.

Only words near a signal (a digit, an at-sign, an equals sign, a word that the table has before a secret, ...) are decoded; all others are no
personal data to the field.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cache, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import pieces
from .pii_lines import LINES

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret",)

# ---- fixed values: the patterns. The look-behinds only skip starts inside a run of digits, where the run's first digit failed too.

IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, at-sign and host: each at-sign with a host takes the run of local characters before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        m = HOST.match(text, at)
        if m:
            a = at
            while a > done and text[a - 1] in LOCAL:
                a -= 1
            if a < at:
                out.append((a, m.end()))
                done = m.end()
        at = text.find("@", at + 1 if not out or done <= at else done)
    return out


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if HAS_DIGIT(text):
        out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out["card"] = [m.span() for m in CARD.finditer(text) if 13 <= len(d := digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return out


HAS_DIGIT = re.compile("[0-9]").search
TOKEN = re.compile(r"\S+")

# ---- the labelled table

LABELS = ("O", "email", "email+", "phone", "phone+", "secret", "secret+")
SPAN = re.compile(r"\{(\w+)\|(?:([^|{}]*)\|)?([^|{}]*)\}")
AT_DOT = frozenset("at dot (at) (dot) [at] [dot]".split())
EDGE = ".,;:!?\"'([{)]}"


def parsed(line: str) -> list[tuple[str, str, str, bool]]:
    """(text, kind, what is kept of it, whether what follows is varied) of a line's parts; kind is empty outside spans."""
    out, at = [], 0
    for m in SPAN.finditer(line):
        out += [(line[at : m.start()], "", "", True), (m[3], m[1], m[2] or "", True)]
        at = m.end()
    return [*out, (line[at:], "", "", True)]


def _other(r: random.Random, s: str) -> str:
    """Other characters of the same sorts; hexadecimal stays so."""
    small = "abcdef" if re.fullmatch(r"[0-9a-f]{10,}", s) else "abcdefghijklmnopqrstuvwxyz"
    pick = lambda c: r.choice("0123456789") if c.isdigit() else r.choice(small) if c.islower() else r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isupper() else c
    return "".join(pick(c) if c.isascii() else c for c in s)


def _word(r: random.Random) -> str:
    return "".join(r.choice("bcdfghlmnprstvw") + r.choice("aeiou") + r.choice(["", "", "n", "r", "s"]) for _ in range(r.randint(1, 4)))


def varied(r: random.Random, line: str, first: bool) -> list[tuple[str, str]]:
    """(word, label) of a line: as it stands if first, else with other values, and other words away from its spans."""
    text, marks = "", []
    for said, kind, kept, _ in parsed(line):
        if kind == "email" and not first:
            said = re.sub(r"[A-Za-z]+(?:[._][A-Za-z]+)*", lambda m: m[0] if m[0].lower() in ("at", "dot", "com", "org", "net", "uk", "de", "fr", "es") else _word(r), said)
        elif not first:
            said = _other(r, said) if kind else re.sub(r"[0-9]", lambda m: r.choice("0123456789") if m[0] == "0" else r.choice("123456789"), said)
        if kind:
            marks.append((len(text), len(text) + len(kept) + len(said), kind))
        text += kept + said
    words = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    labels, seen = [], None
    for a, e in words:
        hit = next((k for k in marks if k[0] < e and a < k[1]), None)
        labels.append("O" if hit is None else hit[2] + "+" * (hit is seen))
        seen = hit
    out = []
    for i, ((a, e), label) in enumerate(zip(words, labels)):
        w, near = text[a:e], any(x != "O" for x in labels[max(0, i - 2) : i + 3])
        if label == "O" and not first and w.isalpha() and w.islower() and w not in AT_DOT and r.random() < (0.15 if near else 0.5):
            w = _word(r)
        out.append((w, label))
    if not first:  # running text around it
        more = lambda: [(_word(r).capitalize() if r.random() < 0.15 else _word(r), "O") for _ in range(r.randint(0, 4))]
        out = more() + out + more()
    return out


def labelled_table(copies: int = 5, seed: int = 11) -> list[list[tuple[str, str]]]:
    """The lines of the table, each with its variants."""
    r = random.Random(seed)
    return [varied(r, line, k == 0) for line in LINES.strip().split("\n") for k in range(copies)]


@cache
def lexicon() -> tuple[frozenset[str], frozenset[str]]:
    """(words that the table has up to three before a span or inside one, those of them directly or next but one before a secret)."""
    near, cues = set(AT_DOT), set()
    for line in LINES.strip().split("\n"):
        words = varied(random.Random(0), line, True)
        for i, (w, label) in enumerate(words):
            if label == "O":
                ahead = [x for _, x in words[i + 1 : i + 4]]
                low = w.strip(EDGE + "=").lower()
                if low.isalpha() and any(x != "O" for x in ahead):
                    near.add(low)
                    if len(low) > 2 and "secret" in ahead[:2]:
                        cues.add(low)
    usual = {w.strip(EDGE).lower() for line in LINES.strip().split("\n") if "{" not in line for w in line.split()}
    return frozenset(near), frozenset(c for c in cues if c in SECRET_CUES or c not in usual)


#: Words that name a secret, though they also stand in lines without any.
SECRET_CUES = frozenset("password passwd pwd pass passwort secret token key apikey bearer".split())

# ---- features

SHAPE = re.compile(r"([A-Z])[A-Z]*|([a-z])[a-z]*|([0-9])[0-9]*|([^\x00-\x7f])[^\x00-\x7f]*")
ASSIGNED = re.compile(r"([A-Za-z][A-Za-z_-]*)([=:])(.+)")
NUMBER_LIKE = re.compile(r"[-+(0-9)./:]+")


def shape(word: str) -> str:
    return SHAPE.sub(lambda m: "A" if m[1] else "a" if m[2] else "9" if m[3] else "é", word)[:14]


def composition(s: str) -> list[str]:
    """Length, kinds of characters, and how often the kind changes."""
    n, digits = len(s), sum("0" <= c <= "9" for c in s)
    kinds = "".join(k for k, yes in (("a", any("a" <= c <= "z" for c in s)), ("A", any("A" <= c <= "Z" for c in s)), ("9", digits)) if yes)
    size = next(x for x in (3, 5, 7, 9, 12, 15, 19, 23, 31, 47, 1 << 30) if n <= x)
    turns = len(SHAPE.findall(s))
    out = [f"size={size}", f"kinds={kinds}", f"size={size},kinds={kinds}", f"turns={min(turns, 9)}"]
    if re.fullmatch(r"[0-9a-fA-F]+", s) and n >= 8 and digits and digits < n:
        out += ["hex", f"hex,size={size}"]
    return out


@lru_cache(1 << 16)
def features(word: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Names of a word's own features and of those its neighbours see; plain words outside the lexicon have none."""
    bare = word.strip(EDGE)
    low = bare.lower()
    known = low if low in lexicon()[0] else word.lower() if word.lower() in AT_DOT else low.rstrip("=") if low.rstrip("=") in lexicon()[0] else None
    said = [f"w={known}"] if known else []
    if known and word[-1:] in ":=":
        said.append("w:")
    if bare.isalpha() and not (len(bare) >= 16 and bare.isupper()):
        return tuple(said), tuple(said)
    own, near = list(said), list(said)
    kind = f"shape={shape(bare)}"
    own += [kind, f"whole={shape(word)}", *composition(bare)]
    near.append(kind)
    if NUMBER_LIKE.fullmatch(word.strip(",;!?\"'")):
        runs = re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 9)), word.strip(",;!?\"'."))
        own += [f"runs={runs}", f"digits={min(sum(c.isdigit() for c in word), 16)}"]
        near.append(f"runs={runs}")
    elif len(bare) >= 8 and not low.startswith("http"):
        own += [f"pre={low[:4]}", f"pre={low[:3]}"]
    m = ASSIGNED.fullmatch(bare)
    if m:
        own += [f"key={m[1].lower()}", "assigned" + m[2]]
        if any(c in m[1].lower() for c in SECRET_CUES):
            own.append("key-cue")
        own += [f"v:{x}" for x in composition(m[3].strip(EDGE))]
    if word[:1] in "\"'" or word[-1:] in "\"'":
        own.append("quoted")
    for mark in ("at", "dot"):
        if f"({mark})" in low or f"[{mark}]" in low:
            own.append(f"inner-{mark}")
    return tuple(own), tuple(near)


REACH = (-3, -2, -1, 1, 2, 3)


def context(words: list[str]) -> list[list[str]]:
    each = [features(w) for w in words]
    n = len(words)
    return [[*own, *(f"{d:+d}:{f}" for d in REACH if 0 <= i + d < n for f in each[i + d][1])] for i, (own, _) in enumerate(each)]


# ---- where to look

TRIGGERS = (re.compile(r"[0-9@=]").search, re.compile(r"(?i)\b(?:dot|password|passwd|pwd|pass|passwort|secret|token|key|apikey|bearer)\b").search, re.compile(r"-----|[A-Z]{16}").search)


def trigger_lines(text: str) -> list[tuple[int, int]]:
    """(start, end) of the lines that may hold a signal."""
    out = set()
    for search in TRIGGERS:
        at = 0
        while m := search(text, at):
            at = text.find("\n", m.start())
            at = len(text) if at < 0 else at
            out.add((text.rfind("\n", 0, m.start()) + 1, at))
    return sorted(out)


@lru_cache(1 << 16)
def signal(word: str) -> bool:
    bare = word.strip(EDGE)
    if bare.isalpha():
        low = bare.lower()
        return low == "dot" or low in lexicon()[1] or (len(bare) >= 16 and bare.isupper())
    return any(c in "0123456789@=" for c in word) or word.startswith("-----") or any(x in word.lower() for x in ("(at)", "[at]", "(dot)", "[dot]"))


AROUND, LONGEST, MARGIN = 8, 200, 20


def windows(words: list[str]) -> list[tuple[int, int, int, int]]:
    """(first, end, from, to): runs of words within AROUND of a signal; spans that begin in from..to count. Long runs are cut, with margins."""
    runs: list[list[int]] = []
    for i, w in enumerate(words):
        if signal(w):
            a, e = max(0, i - AROUND), min(len(words), i + AROUND + 1)
            if runs and a <= runs[-1][1]:
                runs[-1][1] = e
            else:
                runs.append([a, e])
    return [(max(a, k - MARGIN), min(e, k + LONGEST + MARGIN), k, min(e, k + LONGEST)) for a, e in runs for k in range(a, e, LONGEST)]


# ---- the field


class Field:
    def __init__(self, lines: list[list[tuple[str, str]]], rounds: int = 110, l2: float = 1e-4, rate: float = 0.2):
        feats = [context([w for w, _ in x]) for x in lines]
        often = Counter(f for x in feats for w in x for f in w)
        self.index = {f: i + 1 for i, f in enumerate(sorted(f for f, c in often.items() if c > 2))}  # 0 is the bias
        k, n = len(LABELS), max(map(len, lines))
        x, mask = self.matrix(feats, n)
        y = np.zeros((len(lines), n), np.int64)
        for i, line in enumerate(lines):
            y[i, : len(line)] = [LABELS.index(t) for _, t in line]
        self.w, self.t = np.zeros((len(self.index) + 1, k)), np.zeros((k, k))
        g2w, g2t, total = np.zeros_like(self.w), np.zeros_like(self.t), mask.sum()
        for _ in range(rounds):
            gw, gt = self.gradient(x, mask, y, total)
            gw += l2 * self.w
            gt += l2 * self.t
            g2w, g2t = 0.9 * g2w + 0.1 * gw**2, 0.9 * g2t + 0.1 * gt**2
            self.w -= rate * gw / (np.sqrt(g2w) + 1e-4)
            self.t -= rate * gt / (np.sqrt(g2t) + 1e-4)
            rate *= 0.985
        # What follows must go on from what it continues: other moves are barred.
        for a, la in enumerate(LABELS):
            for b, lb in enumerate(LABELS):
                if lb.endswith("+") and la.rstrip("+") != lb[:-1]:
                    self.t[a, b] = -1e3

    def matrix(self, feats: list[list[list[str]]], n: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Feature ids as (line, place, feature) triples flattened, and the mask of real words."""
        line, place, feat = [], [], []
        mask = np.zeros((len(feats), n), bool)
        for i, x in enumerate(feats):
            mask[i, : len(x)] = True
            for j, fs in enumerate(x):
                ids = [0, *(self.index[f] for f in fs if f in self.index)]
                line += [i] * len(ids)
                place += [j] * len(ids)
                feat += ids
        return [np.array(a, np.int64) for a in (line, place, feat)], mask

    def emissions(self, x: list[np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        e = np.zeros((*shape, len(LABELS)))
        if len(x[0]):
            first = np.flatnonzero(x[2] == 0)  # each word's bias comes first
            e[x[0][first], x[1][first]] = np.add.reduceat(self.w[x[2]], first, axis=0)
        return e

    def gradient(self, x, mask, y, total) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean negative log-likelihood of a word: expected less observed counts, by forward and backward sums."""
        e = self.emissions(x, mask.shape)
        lines, n, k = e.shape
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for j in range(1, n):
            f[:, j] = np.where(mask[:, j, None], lse(f[:, j - 1, :, None] + self.t, 1) + e[:, j], f[:, j - 1])
        for j in range(n - 2, -1, -1):
            b[:, j] = np.where(mask[:, j + 1, None], lse(self.t + (e[:, j + 1] + b[:, j + 1])[:, None, :], 2), 0)
        z = lse(f[:, -1], 1)
        p = np.exp(f + b - z[:, None, None]) * mask[..., None]
        p[np.arange(lines)[:, None], np.arange(n), y] -= mask
        q = p[x[0], x[1]]
        gw = np.stack([np.bincount(x[2], q[:, c], len(self.w)) for c in range(k)], axis=1)
        gt = np.zeros_like(self.t)
        for j in range(1, n):
            q = np.exp(f[:, j - 1, :, None] + self.t + (e[:, j] + b[:, j])[:, None, :] - z[:, None, None]) * mask[:, j, None, None]
            gt += q.sum(0)
            np.add.at(gt, (y[mask[:, j], j - 1], y[mask[:, j], j]), -1)
        return gw / total, gt / total

    def decode(self, lines: list[list[str]]) -> list[list[int]]:
        """Best labels of each line: Viterbi over all lines of a batch at once, place by place."""
        if not lines:
            return []
        feats = [context(x) for x in lines]
        n = max(map(len, lines))
        x, mask = self.matrix(feats, n)
        e = self.emissions(x, mask.shape)
        best, back = e[:, 0], np.zeros((len(lines), n, len(LABELS)), np.int8)
        best = best + np.array([-1e3 if k.endswith("+") else 0.0 for k in LABELS])
        for j in range(1, n):
            s = best[:, :, None] + self.t
            back[:, j] = np.where(mask[:, j, None], s.argmax(1), np.arange(len(LABELS)))
            best = np.where(mask[:, j, None], s.max(1) + e[:, j], best)
        out = np.zeros((len(lines), n), np.int64)
        out[:, -1] = best.argmax(1)
        for j in range(n - 1, 0, -1):
            out[:, j - 1] = back[np.arange(len(lines)), j, out[:, j]]
        return [o[: len(x)].tolist() for o, x in zip(out, lines)]


@cache
def field() -> Field:
    return Field(labelled_table())


def clear_of(taken: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span touches none of those taken, by binary search."""
    ends: list[list[int]] = []
    for a, e in sorted(taken):
        if ends and a <= ends[-1][1]:
            ends[-1][1] = max(ends[-1][1], e)
        else:
            ends.append([a, e])
    starts = [a for a, _ in ends]

    def clear(a: int, e: int) -> bool:
        i = bisect_left(starts, e)
        return not (i and ends[i - 1][1] > a)

    return clear


def trimmed(text: str, kind: str, s: int, e: int) -> tuple[int, int]:
    """The span without punctuation at its ends; of an assigned secret only the value."""
    if kind == "secret":
        while e > s and text[e - 1] in EDGE:
            e -= 1
        m = ASSIGNED.match(text, s, e)
        if m and not text.startswith("-----", s):
            s = m.start(3)
    while s < e and text[s] in EDGE and not (kind == "phone" and text[s] == "(") and not (kind == "email" and text.startswith(("(at)", "[at]"), s)):
        s += 1
    while s < e and text[e - 1] in EDGE:
        e -= 1
    return s, e


def field_spans(model: Field, texts: list[str], taken: list[list[tuple[int, int]]]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) that the field adds to each text, in order, clear of the spans already taken and of each other."""
    runs, where = [], []
    for i, t in enumerate(texts):
        for start, end in trigger_lines(t):
            spans = [w.span() for w in TOKEN.finditer(t, start, end)]
            words = [t[a:e] for a, e in spans]
            for a, e, first, last in windows(words):
                runs.append(words[a:e])
                where.append((i, spans[a:e], first - a, last - a))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    clear = [clear_of(x) if x else None for x in taken]
    live = sorted(range(len(runs)), key=lambda j: len(runs[j]))
    for a in range(0, len(live), 512):
        part = live[a : a + 512]
        for j, labels in zip(part, model.decode([runs[j] for j in part])):
            i, words, first, last = where[j]
            k = 0
            while k < len(labels):
                kind, e = LABELS[labels[k]].rstrip("+"), k + 1
                if kind != "O":
                    while e < len(labels) and LABELS[labels[e]] == kind + "+":
                        e += 1
                    s, t = trimmed(texts[i], kind, words[k][0], words[e - 1][1])
                    if first <= k < last and s < t and (clear[i] is None or clear[i](s, t)):
                        out[i].append((kind, s, t))
                k = e
    return [sorted(set(x), key=lambda v: v[1]) for x in out]


def listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in sorted(spans.get(k, [])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_email, n_ip, n_card, n_phone (by pattern), base_sha256, spans, n_added (by the field), n_spans (all).

    spans lists kind:start:end in code points, the end exclusive, by kind (email, ip, card, phone, then secret) and start, patterns'
    and field's together. A null text is empty; an empty text has no spans. Rows that repeat are answered each; other columns aren't
    looked at.
    """

    model = field()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in pieces(batches, "text"):
            texts = text.to_pylist()
            base = [base_spans(t) for t in texts]
            more = field_spans(model, texts, [[s for k in b.values() for s in k] for b in base])
            said = []
            for b, m in zip(base, more):
                every = {k: list(v) for k, v in b.items()}
                for k, s, e in m:
                    every.setdefault(k, []).append((s, e))
                said.append(listed(every, KINDS + MORE_KINDS))
            cols = [pa.array([len(b[k]) for b in base], pa.int64()) for k in KINDS]
            sums = pa.array([sha256(listed(b, KINDS).encode()).hexdigest() for b in base])
            yield pa.RecordBatch.from_arrays([rows.column(0), *cols, sums, pa.array(said, pa.string()), pa.array([len(m) for m in more], pa.int64()), pa.array([len(m) + sum(map(len, b.values())) for m, b in zip(more, base)], pa.int64())], ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"])

    out = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text) with every span replaced by its kind in square brackets. A null text becomes an empty one; null ids stay null; rows that
    repeat are answered each; an empty table gives an empty result."""

    model = field()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in pieces(batches, "text"):
            texts = text.to_pylist()
            base = [base_spans(t) for t in texts]
            more = field_spans(model, texts, [[s for k in b.values() for s in k] for b in base])
            said = []
            for t, b, m in zip(texts, base, more):
                at, out = 0, []
                for s, e, k in sorted([(s, e, k) for k, v in b.items() for s, e in v] + [(s, e, k) for k, s, e in m]):
                    if s >= at:
                        out += [t[at:s], f"[{k}]"]
                    at = max(at, e)
                said.append("".join([*out, t[at:]]))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(said, pa.string())], ["id", "text"])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
