"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import tokens
from stratacast.llm.common import (
    given_id,
    known_id,
    table,
    text_of,
    written_by_python,
)
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

# Bytes of texts that are scored together: the words and pairs they hold are looked up once.
PART_BYTES = 1 << 23
# Bytes of texts whose pairs meet in one group, and pairs that a task holds before it sends them.
GROUP_BYTES, HELD_PAIRS = 1 << 24, 500_000
# Bytes of texts, or of the model, to a bucket of the model.
BUCKET_BYTES = 1 << 24
# Bytes of texts whose words a task hashes at once, unless one text is longer.
TEXT_BYTES = 1 << 20
# Most rounds in which pairs are counted and parts are scored, and parts to a round: the
# shuffle files of a round are removed before the next one.
COUNT_ROUNDS, SCORE_ROUNDS, ROUND_PARTS = 2, 8, 6
# What a model says of a word: p(w) of each class, the weight of p(w') after it and one
# over its count; of a pair: its discounted counts.
VALUES = ["a0", "a1", "back0", "back1", "each0", "each1"]
# See features().
FEATURES, STRETCH, LIMIT, TAIL, TAIL_FLOOR = 3, 4, 5.0, 3.0, 1e-4
# Rows that calibrate the score: those with the smallest hash of their id.
CALIBRATION_ROWS = 20_000
REJECT_AT = 0.7
# Documents with the first remainders are learnt from, as two folds; the rest is held out.
FOLDS, HELD_OUT_REMAINDER = (0, 2), 1
# The models, by the folds they have counted: one of each fold, and the whole one.
MODELS = ((0,), (1,), (0, 1))
WHOLE = 2
# Which models score a part, by its number modulo three: rows that calibrate nothing, and
# those of either fold, which the other one scores too.
SCORED_BY = ((WHOLE,), (WHOLE, 1), (WHOLE, 0))
# Counts of a pair: in toxic and other rows of each fold.
COUNTS = [f"c{k}_{fold}" for fold in FOLDS for k in (1, 0)]
# Of a word, for each model and class (other, toxic): different words before it; words after
# it that were seen once, twice and more often; its occurrences before another word.
STATS = [f"{of}{k}_{m}" for m in range(len(MODELS)) for k in (0, 1) for of in ("n", "one", "two", "more", "s")]
# And different words before it in all texts, with or without a label.
SHARED = "n"


def remainder(id: str):
    """crc32 of the id as text, modulo three; a null id is held out."""
    own = F.pmod(F.crc32(F.col(id).cast("string")), F.lit(3))
    return F.coalesce(own, F.lit(HELD_OUT_REMAINDER))


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; numpy's own way with long integers is much slower."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]][: len(keys)]]


def _words(data, offsets):
    hashes, _, _, rows = tokens.words(data, offsets, tokens.PLAIN, tokens.FOLD)
    pairs, at = tokens.runs(hashes, rows, 2)
    return hashes, rows, pairs, at


def _wide_enough(counts: np.ndarray) -> type:
    """A type that holds any sum of some of the counts."""
    return np.int32 if counts.sum(dtype=np.int64) < 1 << 31 else np.int64


@dataclass
class Pairs:
    """Word pairs: hash of the pair, of its words, and COUNTS, which are zero without a label."""

    pair: np.ndarray
    h: np.ndarray
    w: np.ndarray
    counts: np.ndarray  # COUNTS by pairs

    def distinct(self) -> Pairs:
        order = np.argsort(self.pair, kind="stable")
        pair = self.pair[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][: len(pair)])
        at = order[first]
        counts = np.zeros((len(COUNTS), len(at)), _wide_enough(self.counts))
        for k in range(len(COUNTS) if len(at) else 0):
            np.add.reduceat(self.counts[k][order], first, dtype=counts.dtype, out=counts[k])
        return Pairs(pair[first], self.h[at], self.w[at], counts)

    def some(self, which) -> Pairs:
        return Pairs(self.pair[which], self.h[which], self.w[which], self.counts[:, which])


def _joined(parts: list[Pairs]) -> Pairs:
    columns = [np.concatenate([getattr(p, c) for p in parts]) for c in ("pair", "h", "w")]
    return Pairs(*columns, np.concatenate([p.counts for p in parts], axis=1))


def _planes(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes byte by byte, so that their high bytes lie together."""
    numbers = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return np.ascontiguousarray(numbers.T).tobytes()


def _of_planes(planes: np.ndarray, width: int = 4) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}")[:, 0]


def _steps(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), 8)


def _pack(pairs: Pairs) -> tuple[int, int, bytes]:
    """A block of distinct pairs: how many, how many words, and both compressed.

    Words are listed once; pairs are sorted and name their words by position.
    """
    words, at = np.unique(np.concatenate([pairs.w, pairs.h]), return_inverse=True)
    w, h = np.split(at, 2)
    order = np.lexsort((h, w))
    parts = [_steps(words), _planes(np.diff(w[order], prepend=0)), _planes(h[order])]
    parts += [_planes(c[order]) for c in pairs.counts]
    return len(w), len(words), pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _unpack(n: int, m: int, block: bytes) -> Pairs:
    raw = pa.decompress(block, 8 * m + 4 * n * (2 + len(COUNTS)), codec="zstd", asbytes=True)
    words = np.cumsum(_of_planes(np.frombuffer(raw, np.uint8, 8 * m), 8), dtype=np.uint64)
    planes = np.frombuffer(raw, np.uint8, offset=8 * m).reshape(-1, 4, n)
    w, h, *counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[..., 0]
    w, h = words[np.cumsum(w)], words[h]
    pair, _ = tokens.runs(np.stack([h, w], 1).ravel(), np.repeat(np.arange(n), 2), 2)
    return Pairs(pair, h, w, np.array(counts))


def _group_of(h: np.ndarray, w: np.ndarray, side: int) -> np.ndarray:
    """By both words, so that all words before a frequent one are not one group."""
    return (w % side * side + h % side).astype(np.int64)


BLOCKS = "group long, n long, m long, block binary"


def _pair_blocks(side: int, turn: int = 0, rounds: int = 1):
    """Distinct word pairs of a task's documents, as blocks of ``side`` x ``side`` groups.

    Of several rounds each has the pairs of its share of second words.
    """

    def blocks(pairs: Pairs):
        group = _group_of(pairs.h, pairs.w, side)
        order = np.argsort(group, kind="stable")
        cut = tokens.bounds(group[order], side * side)
        made = [
            (g, *_pack(pairs.some(order[cut[g] : cut[g + 1]])))
            for g in range(side * side)
            if cut[g] < cut[g + 1]
        ]
        if made:
            names = ["group", "n", "m", "block"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(),) * 3 + (pa.binary(),))], names
            )

    def mapped(batches):
        held, size = [], 0
        for batch in batches:
            # Which of COUNTS a row adds to; one more for rows without a label.
            toxic = batch.column("toxic").fill_null(-1).to_numpy(zero_copy_only=False)
            second = batch.column("_r").to_numpy() == FOLDS[1]
            kind = np.where(toxic < 0, len(COUNTS), 2 * second + (toxic == 0)).astype(np.int64)
            for low, data, offsets in tokens.groups(batch.column("text"), TEXT_BYTES):
                hashes, rows, pairs, at = _words(data, offsets)
                if rounds > 1:
                    own = np.flatnonzero(hashes[at + 1] % side % rounds == turn)
                    pairs, at = pairs[own], at[own]
                counts = kind[low + rows[at]] == np.arange(len(COUNTS))[:, None]
                own = Pairs(pairs, hashes[at], hashes[at + 1], counts.astype(np.int32))
                held.append(own.distinct())
                size += len(held[-1].pair)
                if size > HELD_PAIRS:
                    held = [_joined(held).distinct()]
                    size = len(held[0].pair)
                    if size > HELD_PAIRS // 2:
                        yield from blocks(held[0])
                        held, size = [], 0
        if held:
            yield from blocks(_joined(held).distinct())

    return mapped


def _group_counts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, Pairs]:
    """Words of a group, SHARED and STATS by words, and its labelled pairs with COUNTS.

    One group holds a pair with all its counts, and for a word a part of its STATS.
    """
    columns = [rows.column(c).to_pylist() for c in ("n", "m", "block")]
    pairs = _joined([_unpack(*block) for block in zip(*columns)]).distinct()
    words, at = np.unique(np.concatenate([pairs.w, pairs.h]), return_inverse=True)
    stats = np.empty((1 + len(STATS), len(words)), _wide_enough(pairs.counts))
    stats[0] = np.bincount(at[: len(pairs.w)], minlength=len(words))
    labelled = np.flatnonzero(pairs.counts.any(axis=0))
    w, h = at[labelled], at[len(pairs.w) + labelled]
    pairs, row = pairs.some(labelled), 1
    del at
    for folds in MODELS:
        for k in (0, 1):
            c = sum(pairs.counts[2 * fold + 1 - k] for fold in folds)
            for of, seen in ((w, c > 0), (h, c == 1), (h, c == 2), (h, c > 2)):
                stats[row] = np.bincount(of[seen], minlength=len(words))
                row += 1
            stats[row] = np.bincount(h, c, len(words))
            row += 1
    return words, stats, pairs


def _group_types(rows: pa.Table) -> pa.Table:
    """_group_counts as rows."""
    words, stats, pairs = _group_counts(rows)
    labelled = pairs.pair
    made = {"key": np.r_[words, pairs.pair].view(np.int64)}
    for name, own in zip([SHARED, *STATS], stats):
        made[name] = pa.concat_arrays([pa.array(own, pa.int64()), pa.nulls(len(labelled), pa.int64())])
    for name, own in zip(COUNTS, pairs.counts):
        made[name] = pa.concat_arrays([pa.nulls(len(words), pa.int64()), pa.array(own, pa.int64())])
    return pa.table(made)


@dataclass
class Model:
    """All words and labelled pairs, and the calibration of the ratio's features.

    ``entries`` has a key (64-bit hash of a word or pair) and VALUES of each of MODELS,
    model by model; of a pair, only the first two of each.
    """

    entries: DataFrame | None  # none where the counts stay packed
    size: int  # measured bytes of the entries
    unseen: list[tuple[float, float]]  # p(w) in each class of a word that was not counted
    weights: np.ndarray | None = None
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None


class Known:
    """Values of the words and pairs that some texts hold, by hash, in one of MODELS."""

    def __init__(self, words, pairs, unseen: tuple[float, float], k: int):
        """``words`` and ``pairs``: sorted keys, and values by key, model and kind."""
        self.word_keys, self.words = self._with_missing(*words, k, [*unseen, 1, 1, 0, 0])
        self.pair_keys, self.pairs = self._with_missing(*pairs, k, [0, 0])

    @staticmethod
    def _with_missing(keys, values, k, missing):
        """Values by the k-th model, with a last column for what is not among the keys."""
        return keys, np.c_[values[:, k].T, np.array(missing, np.float32)]

    @staticmethod
    def _at(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        # In order, each search goes on near the one before: three times as fast.
        order = np.argsort(hashes)
        found = np.empty(len(hashes), np.int64)
        found[order] = np.searchsorted(keys, hashes[order])
        if len(keys):
            same = keys[np.minimum(found, len(keys) - 1)] == hashes
            found[~same] = len(keys)
        return found

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return self.words[:, self._at(self.word_keys, hashes)]

    def of_pairs(self, hashes: np.ndarray) -> np.ndarray:
        return self.pairs[:, self._at(self.pair_keys, hashes)]


def _discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (max(x, 1) for x in n)
    y = n1 / (n1 + 2 * n2)
    found = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(found, [0, 0.5, 0.5, 0.5], [0, 1, 2, 3])


def _number_less(c: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return cut[np.minimum(c, 3)]


def _less(c, cut: np.ndarray):
    """What is taken off a count."""
    return (
        F.when(c >= 3, float(cut[3]))
        .when(c == 2, float(cut[2]))
        .when(c == 1, float(cut[1]))
        .otherwise(0.0)
    )


def _few(count, name: str) -> list:
    """How many rows have a count of 1, 2, 3 and 4."""
    return [F.count(F.when(count == k, 1)).alias(f"{name}_{k}") for k in range(1, 5)]


def _count(m: int, k: int):
    """The count of a pair in a model's folds, in class ``k``."""
    return sum(F.col(f"c{k}_{FOLDS[fold]}") for fold in MODELS[m])


_EACH = [(m, k) for m in range(len(MODELS)) for k in (0, 1)]


_TOTALS = [f"{k}_{m}_{c}" for m, k in _EACH for c in range(1, 5)]
# What is summed up over all pairs, and over all words.
PAIR_TOTALS = ["pairs", *_TOTALS]
WORD_TOTALS = ["all", "words", *_TOTALS] + [f"{of}{k}_{m}" for m, k in _EACH for of in ("sum", "some")]


class Law:
    """What turns counts into probabilities: discounts and totals, by model and class."""

    def __init__(self, of_pairs, of_words):
        """PAIR_TOTALS and WORD_TOTALS."""
        # One more for all words that were not counted.
        self.every = (of_words["all"] or 0) + of_words["words"] + 1
        self.pair_cuts, self.word_cuts, self.totals, self.rests = {}, {}, {}, {}
        for e in _EACH:
            m, k = e
            n = [of_words[f"{k}_{m}_{c}"] for c in range(1, 5)]
            cut, total = _discounts(n), of_words[f"sum{k}_{m}"] or 0
            off = cut[1] * n[0] + cut[2] * n[1] + cut[3] * (of_words[f"some{k}_{m}"] - n[0] - n[1])
            self.word_cuts[e], self.totals[e] = cut, float(max(total, 1))
            self.rests[e] = float(off / total) if total else 1.0
            self.pair_cuts[e] = _discounts([of_pairs[f"{k}_{m}_{c}"] for c in range(1, 5)])
        self.unseen = [
            tuple(self.rests[m, k] / self.every for k in (0, 1)) for m in range(len(MODELS))
        ]

    def of_words(self, stats: np.ndarray, m: int) -> np.ndarray:
        """VALUES by words from SHARED and STATS, as count_model has them of a model."""
        shared = (stats[0] + 1) / float(self.every)
        values = []
        for k in (0, 1):
            at = 1 + 5 * _EACH.index((m, k))
            own, *few, s = stats[at : at + 5]
            cut = self.word_cuts[m, k]
            p = (own - _number_less(own, cut)) / self.totals[m, k] + shared * self.rests[m, k]
            taken = sum(d * n for d, n in zip(self.pair_cuts[m, k][1:], few))
            some = np.maximum(s, 1)
            values.append((p, np.where(s > 0, np.maximum(taken / some, 1e-3), 1.0), 1 / some))
        return np.array([v[i] for i in range(3) for v in values], np.float32).T

    def of_pairs(self, counts: np.ndarray, m: int) -> np.ndarray:
        """Discounted COUNTS by pairs, likewise."""
        values = []
        for k in (0, 1):
            c = sum(counts[2 * fold + 1 - k] for fold in MODELS[m])
            values.append(c - _number_less(c, self.pair_cuts[m, k]))
        return np.array(values, np.float32).T


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_of(text)).cast("bigint"))).first()[0] or 0


def count_types(training: DataFrame, size: int | None = None) -> DataFrame:
    """Words and labelled pairs of ``training`` rows (_r, toxic or null, text), written.

    Rows of words have a key and STATS (to be summed up by key), rows of pairs a key
    and COUNTS. A pair that only texts without a label hold is counted in SHARED of its
    second word and goes no further.
    """
    size = text_bytes(training) if size is None else size
    side = math.isqrt(size // GROUP_BYTES) + 1
    blocks = training.select("_r", "toxic", "text").mapInArrow(_pair_blocks(side), BLOCKS)
    types = blocks.groupBy("group").applyInArrow(
        _group_types, ", ".join(f"{c} long" for c in ["key", SHARED, *STATS, *COUNTS])
    )
    return written_by_python(types, "types")


def count_model(types: DataFrame) -> Model:
    """The models of all words and pairs of ``types``; they grow with them.

    A class's probability of a word after another is its discounted count, backing off
    to the number of different words before it in that class, and that to the number in
    all texts, labelled or not: there, what is rare in either class is equally likely.
    What reaches the driver is two rows of totals.
    """
    pairs = types.where(f"{SHARED} IS NULL").select("key", *COUNTS)
    of_pairs = pairs.agg(
        F.count("*").alias("pairs"), *[c for m, k in _EACH for c in _few(_count(m, k), f"{k}_{m}")]
    ).first()
    words = types.where(f"{SHARED} IS NOT NULL").groupBy("key")
    words = materialize(words.agg(*[F.sum(c).alias(c) for c in (SHARED, *STATS)]), "words")
    totals = [F.sum(SHARED).alias("all"), F.count("*").alias("words")]
    for m, k in _EACH:
        own = F.col(f"n{k}_{m}")
        totals += _few(own, f"{k}_{m}")
        totals += [F.sum(own).alias(f"sum{k}_{m}"), F.count(F.when(own > 0, 1)).alias(f"some{k}_{m}")]
    of_words = words.agg(*totals).first()
    law = Law(of_pairs, of_words)
    shared, values = (F.col(SHARED) + 1) / float(law.every), []
    for m in range(len(MODELS)):
        p, back, each = [], [], []
        for k in (0, 1):
            own = F.col(f"n{k}_{m}")
            less = _less(own, law.word_cuts[m, k])
            p.append((own - less) / law.totals[m, k] + law.rests[m, k] * shared)
            taken = zip(law.pair_cuts[m, k][1:], ("one", "two", "more"))
            taken = sum(float(d) * F.col(f"{name}{k}_{m}") for d, name in taken)
            s = F.col(f"s{k}_{m}")
            back.append(F.when(s > 0, F.greatest(taken / s, F.lit(1e-3))).otherwise(1.0))
            each.append(1 / F.greatest(s, F.lit(1)))
        values += [*p, *back, *each]
    entries = words.select("key", F.array(*[v.cast("float") for v in values]).alias("v"))
    left = [(_count(m, k) - _less(_count(m, k), law.pair_cuts[m, k])).cast("float") for m, k in _EACH]
    entries = entries.unionByName(pairs.select("key", F.array(*left).alias("v")))
    width = 48 + 4 * len(VALUES) * len(MODELS)
    return Model(entries, width * (of_pairs["pairs"] + of_words["words"]), law.unseen)


def features(known: Known, data, offsets) -> np.ndarray:
    """Log-likelihood ratios per word of each text, three ways, all length-normalised.

    The mean with pairs, where one word counts LIMIT at most: copies of a training text
    would otherwise outweigh everything. The best mean of STRETCH consecutive words and
    the logarithm of what words exceed TAIL by, on average, both without pairs.
    """
    n = len(offsets) - 1
    found = np.zeros((n, FEATURES))
    found[:, 2] = np.log(TAIL_FLOOR)
    hashes, rows, pairs, at = _words(data, offsets)
    if not len(hashes):
        return found
    word = known.of_words(hashes)
    p, back, each = word[:2], word[2:4], word[4:]
    single = np.log(p[1]).astype(np.float64) - np.log(p[0])
    p[:, at + 1] = known.of_pairs(pairs) * each[:, at] + back[:, at] * p[:, at + 1]
    ratio = np.clip(np.log(p[1]).astype(np.float64) - np.log(p[0]), -LIMIT, LIMIT)
    edge = tokens.bounds(rows, n)
    count = np.diff(edge)
    full = np.flatnonzero(count)

    def means(values):
        sums = np.r_[0.0, np.cumsum(values)]
        return (sums[edge[1:]] - sums[edge[:-1]])[full] / count[full], sums

    found[full, 0], _ = means(ratio)
    tail, _ = means(np.maximum(single - TAIL, 0))
    found[full, 2] = np.log(np.maximum(tail, 0) + TAIL_FLOOR)
    _, sums = means(single)
    # A stretch at the end of a text is moved back; a short text is one stretch.
    last, at = edge[1:][rows], np.arange(len(single))
    low = np.maximum(np.minimum(at, last - STRETCH), edge[:-1][rows])
    high = np.minimum(low + STRETCH, last)
    best = (sums[high] - sums[low]) / (high - low)
    found[full, 1] = np.maximum.reduceat(best, edge[full])
    return found


# Numbers that the model has of a word and of a pair.
WIDTHS = {"words": len(VALUES) * len(MODELS), "pairs": 2 * len(MODELS)}


def _squeeze(numbers: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(numbers).tobytes(), codec="zstd", asbytes=True)


def _expand(block: bytes, n: int, kind) -> np.ndarray:
    raw = pa.decompress(block, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(raw, kind, n)


def _high(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(32)).astype(np.uint32)


def _pack_sorted(numbers: np.ndarray) -> bytes:
    """Sorted 32-bit numbers by their differences."""
    return _squeeze(np.frombuffer(_planes(np.diff(numbers.astype(np.int64), prepend=0)), np.uint8))


def _unpack_planes(block: bytes, n: int) -> np.ndarray:
    return _of_planes(_expand(block, 4 * n, np.uint8))


def _unpack_sorted(block: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack_planes(block, n), dtype=np.uint64)


def _asked(buckets: int):
    """What each part asks of each bucket of the model: the high halves of its distinct keys.

    A bucket answers with whole keys, so those that only share a high half do no harm.
    """

    def asked(rows: pa.Table) -> pa.Table:
        keys = [np.empty(0, np.uint64)]
        for _, data, offsets in tokens.groups(rows.column("text").combine_chunks(), TEXT_BYTES):
            hashes, _, pairs, _ = _words(data, offsets)
            keys += [_distinct(hashes), _distinct(pairs)]
        keys = _distinct(np.concatenate(keys))
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = tokens.bounds(bucket[order], buckets)
        some = np.flatnonzero(np.diff(cut))
        halves = [_distinct(_high(keys[order[cut[b] : cut[b + 1]]])) for b in some]
        columns = {
            "_part": pa.repeat(rows.column("_part")[0], len(some)),
            "bucket": pa.array(some, pa.int64()),
            "n": pa.array([len(h) for h in halves], pa.int64()),
            "halves": pa.array([_pack_sorted(h) for h in halves], pa.binary()),
        }
        return pa.table(columns)

    return asked


def _answered(asked: pa.Table, entries: pa.Table) -> pa.Table:
    """For each part's keys those that the bucket knows, with their values."""
    keys = entries.column("key").to_numpy().view(np.uint64)
    lists = entries.column("v").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    values = lists.flatten().to_numpy()
    known = {}
    for name, width in WIDTHS.items():
        own = lengths == width
        order = np.argsort(keys[own])
        held = values[np.repeat(own, lengths)].reshape(-1, width)
        known[name] = keys[own][order], _high(keys[own][order]), held[order]
    made = []
    for part, n, block in zip(*(asked.column(c).to_pylist() for c in ("_part", "n", "halves"))):
        wanted = _unpack_sorted(block, n).astype(np.uint32)
        row, models = [part], list(SCORED_BY[part % 3])
        for own, halves, held in known.values():
            low, high = (np.searchsorted(halves, wanted, side) for side in ("left", "right"))
            count = high - low
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            packed = _planes((own[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            row += [len(at), _pack_sorted(halves[at]), _squeeze(np.frombuffer(packed, np.uint8))]
            held = held[at].reshape(len(at), len(MODELS), held.shape[1] // len(MODELS))
            row.append(_squeeze(held[:, models].astype("<f4")))
        made.append(row)
    return pa.Table.from_pylist([dict(zip(ANSWER.names, row)) for row in made], ANSWER)


ANSWER = pa.schema(
    [("_part", pa.int64())]
    + [(f"{name}_{c}", t) for name in WIDTHS for c, t in
       (("n", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("values", pa.binary()))]
)


def _gathered(answers: pa.Table, name: str, models: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys out of all answers to a part, and values by key, model and kind."""
    width = WIDTHS[name] // len(MODELS) * models
    keys, values = [np.empty(0, np.uint64)], [np.empty((0, width), "<f4")]
    columns = [answers.column(f"{name}_{c}").to_pylist() for c in ("n", "high", "low", "values")]
    for n, high, low, held in zip(*columns):
        keys.append(_unpack_sorted(high, n) << np.uint64(32) | _unpack_planes(low, n).astype(np.uint64))
        values.append(_expand(held, n * width, "<f4").reshape(n, width))
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    values = np.concatenate(values)[order]
    return keys[order], values.reshape(len(keys), models, width // models)


def _features_of(unseen):
    def found(rows, answers):
        models = SCORED_BY[rows.column("_part")[0].as_py() % 3]
        words, pairs = (_gathered(answers, name, len(models)) for name in WIDTHS)
        out = np.zeros((2, rows.num_rows, FEATURES))
        for k, m in enumerate(models):
            known = Known(words, pairs, unseen[m], k)
            for low, data, offsets in tokens.groups(rows.column("text").combine_chunks(), TEXT_BYTES):
                out[k, low : low + len(offsets) - 1] = features(known, data, offsets)
        rest = rows.drop_columns(["_part", "text"])
        made = [pa.array(np.ascontiguousarray(c)) for side in out for c in side.T]
        return pa.table([*rest.columns, *made], [*rest.column_names, *NAMES])

    return found


# Features by the whole model, and by that of the other fold.
NAMES = [f"{side}{k}" for side in "xy" for k in range(FEATURES)]


def with_features(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (text, _fold or null, others) without the text, with NAMES.

    Rows are dealt into parts of about PART_BYTES of text, and the model into buckets of
    keys. Each part sends its distinct words and pairs to the buckets and gets those that
    were counted, packed, so neither the model nor every word of every text has to be
    in one place or in the shuffle.
    """
    schema = [f"`{n}` {t}" for n, t in rows.dtypes if n != "text"] + [f"{n} double" for n in NAMES]
    # By content, so that a row is in the same part whenever it is read.
    kind = F.coalesce("_fold", F.lit(-1)) + 1
    sizes = rows.groupBy(kind.alias("kind")).agg(F.sum(F.octet_length("text").cast("bigint")).alias("n"))
    sizes = {r["kind"]: r["n"] for r in sizes.collect()}
    count = F.lit(1)
    for k in range(len(SCORED_BY)):
        count = F.when(kind == k, sizes.get(k, 0) // PART_BYTES + 1).otherwise(count)
    parts = F.pmod(F.xxhash64(*rows.columns), count) * len(SCORED_BY) + kind
    rows = rows.withColumn("_part", parts).repartition("_part")
    buckets = max([model.size, *sizes.values()]) // BUCKET_BYTES + 1
    asked = rows.groupBy("_part").applyInArrow(
        _asked(buckets), "_part long, bucket long, n long, halves binary"
    )
    # The remainder of the key as an unsigned number.
    wrapped = F.when(F.col("key") < 0, (1 << 64) % buckets).otherwise(0)
    bucket = F.pmod(F.pmod("key", F.lit(buckets)) + wrapped, F.lit(buckets))
    entries = model.entries.withColumn("bucket", bucket)
    kinds = {pa.int64(): "long", pa.binary(): "binary"}
    answers = asked.groupBy("bucket").cogroup(entries.groupBy("bucket")).applyInArrow(
        _answered, ", ".join(f"{f.name} {kinds[f.type]}" for f in ANSWER)
    )
    return rows.groupBy("_part").cogroup(answers.groupBy("_part")).applyInArrow(
        _features_of(model.unseen), ", ".join(schema)
    )


# Words and pairs by bucket, as counted: sorted keys with SHARED and STATS, or with COUNTS.
# And their WORD_TOTALS or PAIR_TOTALS.
KINDS = {"words": 1 + len(STATS), "pairs": len(COUNTS)}
COUNTED = "kind string, bucket long, n long, keys binary, numbers binary, totals array<long>"


def _pack_numbers(numbers: np.ndarray) -> bytes:
    return _squeeze(np.frombuffer(_planes(numbers.ravel(), 8), np.uint8))


def _unpack_numbers(block: bytes, n: int, kinds: int) -> np.ndarray:
    return _of_planes(_expand(block, 8 * n * kinds, np.uint8), 8).view(np.int64).reshape(kinds, n)


def _pack_counted(kind: str, bucket: int, keys: np.ndarray, numbers: np.ndarray, totals) -> dict:
    block = _squeeze(np.frombuffer(_steps(keys), np.uint8))
    row = [kind, bucket, len(keys), block, _pack_numbers(numbers), [int(t) for t in totals]]
    return dict(zip(COUNTED_ROWS.names, row))


COUNTED_ROWS = pa.schema(
    [("kind", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()),
     ("numbers", pa.binary()), ("totals", pa.list_(pa.int64()))]
)


def _unpack_counted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    n = row["n"]
    keys = np.cumsum(_of_planes(_expand(row["keys"], 8 * n, np.uint8), 8), dtype=np.uint64)
    return keys, _unpack_numbers(row["numbers"], n, KINDS[row["kind"]])


def _counts_of(numbers: np.ndarray) -> list[int]:
    """How many are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(numbers, 5), minlength=6)[1:5].tolist()


def _group_packed(buckets: int):
    def packed(rows: pa.Table) -> pa.Table:
        """The pairs of a group, which is their bucket, and what it adds to words, by bucket."""
        words, stats, pairs = _group_counts(rows)
        totals = [len(pairs.pair)]
        for m, k in _EACH:
            totals += _counts_of(sum(pairs.counts[2 * fold + 1 - k] for fold in MODELS[m]))
        group = rows.column("group")[0].as_py()
        made = [_pack_counted("pairs", group, pairs.pair, pairs.counts, totals)]
        bucket = (words % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = tokens.bounds(bucket[order], buckets)
        for b in np.flatnonzero(np.diff(cut)):
            own = order[cut[b] : cut[b + 1]]
            made.append(_pack_counted("words", int(b), words[own], stats[:, own], []))
        return pa.Table.from_pylist(made, COUNTED_ROWS)

    return packed


def _word_sums(rows: pa.Table) -> pa.Table:
    """A bucket's words with what all groups add to them."""
    keys, stats = zip(*map(_unpack_counted, rows.to_pylist()))
    keys, stats = np.concatenate(keys), np.concatenate(stats, axis=1)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    stats = np.add.reduceat(stats[:, order], first, axis=1)
    own = [stats[1 + 5 * k] for k in range(len(_EACH))]
    totals = [stats[0].sum(), len(first)] + [c for n in own for c in _counts_of(n)]
    totals += [t for n in own for t in (n.sum(), np.count_nonzero(n))]
    bucket = rows.column("bucket")[0].as_py()
    return pa.Table.from_pylist(
        [_pack_counted("words", bucket, keys[first], stats, totals)], COUNTED_ROWS
    )


def _summed(counted: DataFrame, names: list[str]) -> dict[str, int]:
    of = [F.sum(F.col("totals")[k]).alias(name) for k, name in enumerate(names)]
    return {name: n or 0 for name, n in counted.agg(*of).first().asDict().items()}


def count_packed(training: DataFrame, side: int, buckets: int) -> tuple[DataFrame, Law]:
    """What count_types and count_model find, as few rows of packed COUNTED, written.

    Pairs are in ``side`` x ``side`` buckets by their words, words in ``buckets`` by key.
    """
    rounds, made = min(side, COUNT_ROUNDS), []
    for turn in range(rounds):
        blocks = training.select("_r", "toxic", "text").mapInArrow(
            _pair_blocks(side, turn, rounds), BLOCKS
        )
        counted = blocks.groupBy("group").applyInArrow(_group_packed(buckets), COUNTED)
        made.append(written_by_python(counted, "counted"))
    counted = reduce(DataFrame.unionByName, made)
    words = counted.where("kind = 'words'").groupBy("bucket").applyInArrow(_word_sums, COUNTED)
    words, pairs = materialize(words, "words"), counted.where("kind = 'pairs'")
    law = Law(_summed(pairs, PAIR_TOTALS), _summed(words, WORD_TOTALS))
    return words.unionByName(pairs).drop("totals"), law


def _asked_of(side: int, buckets: int):
    """What each part asks of each bucket: the high halves of its distinct keys."""

    def asked(rows: pa.Table) -> pa.Table:
        words, pairs, groups = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for _, data, offsets in tokens.groups(rows.column("text").combine_chunks(), TEXT_BYTES):
            hashes, _, own, at = _words(data, offsets)
            words.append(_distinct(hashes))
            pairs.append(own)
            groups.append(_group_of(hashes[at], hashes[at + 1], side))
        words = _distinct(np.concatenate(words))
        found = {
            "words": (words, (words % np.uint64(buckets)).astype(np.int64), buckets),
            "pairs": (np.concatenate(pairs), np.concatenate(groups), side * side),
        }
        made = []
        part = rows.column("_part")[0].as_py()
        for kind, (keys, bucket, count) in found.items():
            order = np.argsort(bucket, kind="stable")
            cut = tokens.bounds(bucket[order], count)
            for b in np.flatnonzero(np.diff(cut)):
                halves = _distinct(_high(keys[order[cut[b] : cut[b + 1]]]))
                made.append((part, kind, int(b), len(halves), _pack_sorted(halves)))
        return pa.Table.from_pylist([dict(zip(ASKED.names, row)) for row in made], ASKED)

    return asked


ASKED = pa.schema(
    [("_part", pa.int64()), ("kind", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()),
     ("halves", pa.binary())]
)
ANSWERS = pa.schema(
    [("_part", pa.int64()), ("kind", pa.string()), ("n", pa.int64()), ("high", pa.binary()),
     ("low", pa.binary()), ("numbers", pa.binary())]
)


def _matching(halves: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of all that have one of the wanted halves, sorted ones both."""
    low, high = (np.searchsorted(halves, wanted, side) for side in ("left", "right"))
    count = high - low
    return np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())


def _answers_of(asked: pa.Table, counted: pa.Table) -> pa.Table:
    """For each part's keys those that were counted, with their numbers."""
    made = []
    for row in counted.to_pylist():
        keys, numbers = _unpack_counted(row)
        halves = _high(keys)
        for part, n, block in zip(*(asked.column(c).to_pylist() for c in ("_part", "n", "halves"))):
            at = _matching(halves, _unpack_sorted(block, n).astype(np.uint32))
            low = _planes((keys[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            made.append((part, row["kind"], len(at), _pack_sorted(halves[at]),
                         _squeeze(np.frombuffer(low, np.uint8)), _pack_numbers(numbers[:, at])))
    return pa.Table.from_pylist([dict(zip(ANSWERS.names, row)) for row in made], ANSWERS)


def _answered_to(answers: pa.Table, kind: str, valued, models) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys out of all answers to a part, and their values by key, model and kind.

    Each answer is valued at once: its numbers take several times the room.
    """
    keys = [np.empty(0, np.uint64)]
    values = [np.empty((0, len(models), WIDTHS[kind] // len(MODELS)), np.float32)]
    columns = [answers.column(c).to_pylist() for c in ("kind", "n", "high", "low", "numbers")]
    for of, n, high, low, block in zip(*columns):
        if of == kind:
            keys.append(_unpack_sorted(high, n) << np.uint64(32) | _unpack_planes(low, n).astype(np.uint64))
            numbers = _unpack_numbers(block, n, KINDS[kind])
            values.append(np.stack([valued(numbers, m) for m in models], axis=1))
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    return keys[order], np.concatenate(values)[order]


def _features_by(law: Law):
    def found(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = np.zeros((2, rows.num_rows, FEATURES))
        text = rows.column("text").combine_chunks()
        fold = rows.column("_fold").fill_null(-1).to_numpy()
        # The whole model scores all, and that of one fold the rows of the other.
        scored = {WHOLE: (0, np.arange(len(fold)))}
        scored |= {1 - f: (1, np.flatnonzero(fold == f)) for f in np.unique(fold[fold >= 0]).tolist()}
        words = _answered_to(answers, "words", law.of_words, [*scored])
        pairs = _answered_to(answers, "pairs", law.of_pairs, [*scored])
        for at_model, (m, (k, own)) in enumerate(scored.items()):
            known = Known(words, pairs, law.unseen[m], at_model)
            texts = text if len(own) == len(text) else text.take(pa.array(own))
            for low, data, offsets in tokens.groups(texts, TEXT_BYTES):
                at = own[low : low + len(offsets) - 1]
                out[k, at] = features(known, data, offsets)
        rest = rows.drop_columns(["_part", "text"])
        made = [pa.array(np.ascontiguousarray(c)) for side in out for c in side.T]
        return pa.table([*rest.columns, *made], [*rest.column_names, *NAMES])

    return found


def _own_features(own: DataFrame) -> tuple[DataFrame, Law]:
    """Counts rows (_r, toxic, text, _fold, others) and gives each its NAMES, written.

    Like count_types, count_model and with_features, but counts stay packed and in the
    groups in which they were counted. Parts of about PART_BYTES of text are scored in
    rounds. A part asks all groups by half a key and gets whole keys and counts.
    """
    size = text_bytes(own)
    side, buckets = math.isqrt(size // GROUP_BYTES) + 1, size // BUCKET_BYTES + 1
    counted, law = count_packed(own.where(f"_r <> {HELD_OUT_REMAINDER}"), side, buckets)
    parts = size // PART_BYTES + 1
    rounds = min(SCORE_ROUNDS, -(-parts // ROUND_PARTS))
    # By content, so that a row is in the same part whenever it is read.
    rows = own.drop("_r").withColumn("_part", F.pmod(F.xxhash64("_id", "_mark"), F.lit(parts)))
    schema = [f"`{n}` {t}" for n, t in rows.dtypes if n not in ("text", "_part")]
    schema = ", ".join(schema + [f"{n} double" for n in NAMES])
    types = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    of_asked, of_answers = (", ".join(f"{f.name} {types[f.type]}" for f in s) for s in (ASKED, ANSWERS))
    made = []
    for turn in range(rounds):
        some = rows.where(F.col("_part") % rounds == turn).repartition("_part")
        asked = some.groupBy("_part").applyInArrow(_asked_of(side, buckets), of_asked)
        answers = asked.groupBy("kind", "bucket").cogroup(counted.groupBy("kind", "bucket"))
        answers = answers.applyInArrow(_answers_of, of_answers).groupBy("_part")
        found = some.groupBy("_part").cogroup(answers).applyInArrow(_features_by(law), schema)
        made.append(written_by_python(found, "features"))
    return reduce(DataFrame.unionByName, made), law


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a lightly penalised logistic regression, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 0.01 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _labelled(docs: DataFrame, labels: DataFrame, id: str, text: str) -> DataFrame:
    """Documents (_id, _mark, text, _r, toxic, _fold); labels of held out ones are null."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.select(F.col("doc_id").alias("_id"), "toxic")
    known = known.where(remainder("_id") != HELD_OUT_REMAINDER)
    known = broadcast_if_small(*materialize_sized(known, "labels"))
    own = docs.select(known_id(id).alias("_id"), text_of(text).alias("text"))
    own = own.withColumns({"_mark": F.xxhash64("text"), "_given": given_id("_id")})
    own = own.withColumn("_r", remainder("_given")).drop("_given").join(known, "_id", "left")
    fold = F.when(F.col("toxic").isNotNull(), F.when(F.col("_r") == FOLDS[0], 0).otherwise(1))
    return own.withColumn("_fold", fold)


def _calibrate(model: Model, found: DataFrame) -> Model:
    """Fits the weights to labelled rows, at most CALIBRATION_ROWS, scored by the other fold.

    What a model has counted looks likelier than what is new. Without rows of both
    classes every score is the share of toxic rows (0 without rows).
    """
    sample = found.where("_fold IS NOT NULL").orderBy(F.xxhash64("_id"), "_id", "_mark")
    sample = sample.limit(CALIBRATION_ROWS).select("toxic", *NAMES[FEATURES:]).toPandas()
    x = sample[NAMES[FEATURES:]].to_numpy()
    y = sample["toxic"].to_numpy().astype(float)
    model.centre, model.scale = np.zeros(x.shape[1]), np.ones(x.shape[1])
    if len(set(y)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0, 1e-9, 1 - 1e-9))
        model.weights = np.r_[np.log(share / (1 - share)), np.zeros(x.shape[1])]
        return model
    model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    model.weights = _logistic((x - model.centre) / model.scale, y)
    return model


def _score(model: Model):
    z = F.lit(float(model.weights[0]))
    for name, w, c, s in zip(NAMES, model.weights[1:], model.centre, model.scale):
        z = z + (F.col(name) - float(c)) / float(s) * float(w)
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> Model:
    """A calibrated model that ``score`` can apply to other documents."""
    own = _labelled(docs, labels, id, text)
    # Texts that are not held out are counted, labels of both folds by class.
    types = count_types(own.where(f"_r <> {HELD_OUT_REMAINDER}"), text_bytes(own))
    model = count_model(types)
    sample = with_features(own.where("_fold IS NOT NULL"), model)
    return _calibrate(model, written_by_python(sample, "features"))


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and score."""
    rows = docs.select(
        F.col(id).alias("doc_id"), text_of(text).alias("text"), F.lit(None).cast("int").alias("_fold")
    )
    return with_features(rows, model).select("doc_id", _score(model).alias("score"))


def scored_rows(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Learns from the documents and scores them: _id (common.known_id), _mark and score.

    ``_mark`` is xxhash64 of the text, null being empty, and tells rows of one id apart.
    All texts are sent once, for the calibration and for the scores.
    """
    found, law = _own_features(_labelled(docs, labels, id, text))
    model = _calibrate(Model(None, 0, law.unseen), found)
    return found.select("_id", "_mark", _score(model).alias("score"))


def toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1) and predicted (0 or 1).

    Words are runs of letters and digits, in lower case for ASCII. Null and empty texts
    are scored like a text whose words tell nothing; texts of any length are read whole.
    Labels of the same id count once, toxic if any says so; null labels and labels of
    unknown documents are not used. A null id is held out. Repeated rows are counted and
    scored one by one; an empty table gives no rows. Other columns are ignored.
    """
    found = scored_rows(docs, labels, id, text).withColumn("doc_id", given_id("_id"))
    return found.select(
        "doc_id",
        (remainder("doc_id") == HELD_OUT_REMAINDER).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_AT).cast("int").alias("predicted"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
