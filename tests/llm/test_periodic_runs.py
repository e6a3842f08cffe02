"""Periodic runs against their definition, tried at every start and period."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratacast.llm import periodic_runs
from stratacast.llm import queries as corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    "a b " * 3,
    "a b " * 4,
    "a b c " * 4 + "a b",
    "x " + "a b c " * 5 + "d " + "a b " * 6,
    "a a a a a",
    "a a a a a a",
    "a a b " * 4 + "a a a a a a a",
    " ".join("a b c d e f g h".split() * 9 + ["z"] + "a b c d e f g h".split() * 3),
    "a\x0bb\x0cc\ta b\nc a\r\nb c a b c",
    "é ü é ü é ü é ü  no\xa0break no\xa0break \x1c \x1c \x1c \x1c \x1c \x1c",
    "A a " * 5,
]


def plain_runs(words):
    """All (start, length, period): grown from every start, for every period."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(part[k:] == part[:-k] for k in range(1, q)):
                    found.add((i, length, q))
            i = j + 1
    return sorted(found)


def plain_row(id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(id).encode()) if id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (id, len(runs), *four, *digests)


def test_query_equals_the_definition(awkward, monkeypatch):
    rng = random.Random(3)
    many = [" ".join(rng.choices("abc", k=rng.randint(0, 60))) for _ in range(120)]
    frame, rows = awkward(TEXTS + many)
    rows = [r for r in rows if len(r[1] or "") < 5000]
    frame = frame.where("text IS NULL OR length(text) < 5000")
    monkeypatch.setattr(periodic_runs, "table", lambda *a: frame)
    got = corpus.QUERIES["op12_periodic_runs"](frame.sparkSession, "").collect()
    assert Counter(map(tuple, got)) == Counter(plain_row(*r) for r in rows)
    # Some of the rows were made to repeat themselves.
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 4), st.lists(st.integers(0, 3), max_size=90), st.integers(1, 6))
def test_runs_equal_the_definition(letters, values, times):
    words = [str(v % letters).encode() for v in values] * times
    assert periodic_runs.runs_of(words) == plain_runs(words)


def test_long_texts_of_few_words_are_scanned_whole():
    rng = np.random.default_rng(5)
    block = rng.integers(0, 30, 3000)
    ids = np.concatenate([rng.integers(0, 3, 50_000), np.tile(block, 5), np.full(60_000, 7)])
    found = periodic_runs.lag_scan(ids)
    assert (110_000 - 45_000 + 0, 60_000, 1) in [(s, n, q) for s, n, q in found if q == 1]
    assert any(q == 3000 and n >= 15_000 for _, n, q in found)
    assert all((ids[s : s + n - q] == ids[s + q : s + n]).all() for s, n, q in found)


def test_segments_hold_no_rare_word():
    rng = np.random.default_rng(8)
    ids = rng.zipf(1.3, 3000) % 500
    for begin, end in periodic_runs.segments(ids):
        assert np.unique(ids[begin:end], return_counts=True)[1].min() >= 4


@pytest.mark.parametrize("texts", [[], [None], [""]])
def test_without_words(spark, texts):
    frame = spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "doc_id long, text string"
    )
    got = periodic_runs.periodic_runs(frame).collect()
    assert [(r["doc_id"], r["runs"], r["collapsed"]) for r in got] == [
        (i, [], "") for i in range(len(texts))
    ]
