"""Periodic runs of words: segments by word frequency, then a scan of lags."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import tokens
from stratacast.llm.common import given_id, known_id, table, text_of, written_by_python

# A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_BASE = 0x9E3779B97F4A7C15


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (begin, end) in which every word occurs LEAST_PERIODS times or more.

    Every word of a run occurs in it once a period, and so does a word that would extend it.
    A word that is rarer within a segment is therefore in none, and splits it. What is split
    is counted anew, until nothing splits.
    """
    found, open_ = [], [(0, len(ids))]
    while open_:
        begin, end = open_.pop()
        if end - begin < LEAST_WORDS:
            continue
        part = ids[begin:end]
        if 4 * len(part) < len(ids):
            _, part = np.unique(part, return_inverse=True)
        rare = np.flatnonzero(np.bincount(part)[part] < LEAST_PERIODS)
        if not len(rare):
            found.append((begin, end))
            continue
        cuts = np.concatenate(([-1], rare, [end - begin]))
        for k in np.flatnonzero(np.diff(cuts) > LEAST_WORDS):
            open_.append((begin + int(cuts[k]) + 1, begin + int(cuts[k + 1])))
    return sorted(found)


def _stretches(mask: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def lag_scan(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a segment, by start, then period.

    A run of period q and four periods holds three whole blocks of q words that begin at
    multiples of q. So only such blocks are compared at lag q, by hash: n / q of them, and
    n log n over all lags. Where three in a row agree, the words themselves decide how far
    they go on agreeing, which is less than a block either way. Lags are taken from
    small to large; a stretch that was found at a smaller lag has that smaller period.
    """
    n = len(ids)
    powers = np.full(n + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(tokens.mix(ids.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    runs: dict[tuple[int, int], int] = {}
    # The run found last at each word: multiples of its period need no second look at it.
    over = np.full(n, -1, np.int64)
    order: list[tuple[int, int, int]] = []
    for q in range(1, n // LEAST_PERIODS + 1):
        blocks = np.diff(sums[::q])
        same = blocks[1:] == blocks[:-1] * powers[q]
        both = same[1:] & same[:-1]
        if not both.any():
            continue
        for first, last in _stretches(both):
            low, high = first * q, (last + 2) * q
            k = over[low]
            if k >= 0 and q % order[k][2] == 0 and high <= order[k][1]:
                continue
            left, right = max(low - q, 0), min(high + q, n)
            agree = ids[left : right - q] == ids[left + q : right]
            for a, b in _stretches(agree):
                start, end = left + a, left + b + q
                if end - start < max(LEAST_WORDS, LEAST_PERIODS * q) or (start, end) in runs:
                    continue
                runs[start, end] = q
                over[start:end] = len(order)
                order.append((start, end, q))
    return sorted((start, end - start, q) for (start, end), q in runs.items())


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    numbers: dict[bytes, int] = {}
    own = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = []
    for begin, end in segments(own):
        found += [(begin + s, length, q) for s, length, q in lag_scan(own[begin:end])]
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of repetitions: of each run its first period stays."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def _found(prepare):
    kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def scan(batches):
        for batch in batches:
            runs, texts = [], []
            for id, text in zip(batch.column("_given"), batch.column("text")):
                # Splits at exactly the six white-space bytes.
                words = text.as_py().encode().split()
                if prepare is not None:
                    words = prepare(id.as_py(), words)
                runs.append(runs_of(words))
                texts.append(collapsed(words, runs[-1]).decode())
            sizes = np.cumsum([0, *map(len, runs)], dtype=np.int32)
            columns = np.array([*chain.from_iterable(runs)], np.int64).reshape(-1, 3).T
            flat = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.ListArray.from_arrays(pa.array(sizes), flat),
                    pa.array(texts, pa.string()),
                ],
                ["_id", "runs", "collapsed"],
            )

    return scan


def periodic_runs(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Runs of repeated words in every whole text, and the texts without the repetitions.

    A run is a stretch of words with smallest period q, of six words and four periods or
    more, that no neighbouring word extends. Returns one row per input row: doc_id;
    ``runs``, an array of (start, length, period) in words from 0, by start, then period;
    ``collapsed``, the words that no run holds after its first period, joined by one space.
    ``prepare`` may change a text's words, given its id, before they are searched.

    Texts are read once and not shuffled; a text of n words takes n log n steps and is never
    cut. Words are compared as they are. Null and empty texts have no words and no runs, null
    ids stay null, repeated rows are searched each, runs that tie in start are all listed,
    other columns are ignored, and an empty table gives no rows.
    """
    rows = docs.select(known_id(id).alias("_id"), text_of(text).alias("text"))
    rows = rows.withColumn("_given", given_id("_id"))
    found = rows.mapInArrow(_found(prepare), f"_id long, runs {_RUNS}, collapsed string")
    found = written_by_python(found, "runs")
    return found.select(given_id("_id").alias("doc_id"), "runs", "collapsed")


def planted(id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by the checksum of its id, repeats itself from some word on."""
    if id is None or not words:
        return words
    h = zlib.crc32(str(id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=planted)
    # Greatest length first, then smallest start, then smallest period.
    best = F.array_min(
        F.transform(
            "runs",
            lambda r: F.struct(
                (-r["length"]).alias("shortness"),
                r["start"].alias("start"),
                r["period"].alias("period"),
                r["length"].alias("length"),
            ),
        )
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat(
            F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]),
            F.lit("\n"),
        ),
    )
    length, period = best["length"], best["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", F.lit(1000) * length, period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
