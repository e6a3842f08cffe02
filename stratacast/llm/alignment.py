"""Alignment of two tokenizers over a corpus, each distinct text done once."""

from __future__ import annotations

import hashlib
from base64 import b64decode
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import tokens
from stratacast.llm.common import small_batches, table, text_of, written_by_python
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

# Words longer than this go to the tokenizer whose time does not grow with the square of
# their length.
LONG_WORD = 2000
_CODEC = "zstd"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_PART = """part bigint, digests array<binary>, groups array<binary>, n_a array<int>, n_b array<int>,
    n_groups array<int>, n_links array<int>, links binary, codes array<bigint>, weights array<bigint>"""
_FOUND = "digest binary, groups_sha256 string, " + ", ".join(f"{m} long" for m in MEASURES)


@dataclass(frozen=True)
class Tokenizers:
    """Files of the two tokenizers: A is byte-level, with its ranks and pattern; B has pieces."""

    a_file: str
    a_ranks: str
    a_pattern: str
    b_file: str

    def b_size(self) -> int:
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.b_file).get_piece_size()


def public_pair() -> Tokenizers:
    import public_tokenizers as public

    return Tokenizers(
        public.path("byte_bpe_50k.json"),
        public.path("byte_bpe_50k.tiktoken"),
        public.PATTERN,
        public.path("piece_bpe_32k.model"),
    )


class Side:
    """What the tokens of a tokenizer stand for: their bytes, lengths, and ids as text."""

    def __init__(self, values: list[bytes]):
        self.bytes = values
        self.lengths = np.array([len(v) for v in values], np.int64)
        names = [str(i).encode() for i in range(len(values))]
        # Each id as it is written before another token of its side, and before the other side.
        self.inner = np.array([n + b"," for n in names], object)
        self.outer: np.ndarray = np.empty(0, object)
        self._names = names

    def ending(self, mark: bytes) -> Side:
        self.outer = np.array([n + mark for n in self._names], object)
        return self

    def spelled(self, ids: list[int]) -> bytes:
        values = self.bytes
        return b"".join([values[i] for i in ids])


class Pair:
    """Both tokenizers, loaded once per task."""

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(files.a_file)
        self.whole.encode_special_tokens = True
        with open(files.a_ranks, "rb") as lines:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=files.a_pattern, mergeable_ranks=ranks, special_tokens={}
        )
        # Special tokens are never made, so only what has a rank stands for bytes.
        entries = [b""] * self.whole.get_vocab_size()
        for entry, i in ranks.items():
            entries[i] = entry
        self.a = Side(entries).ending(b"|")
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.b_file)
        found = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            if self.pieces.is_byte(i):
                found.append(bytes([int(piece[1:-1], 16)]))
            else:
                found.append(piece.replace("▁", " ").encode())
        self.b = Side(found).ending(b";")

    def encode_a(self, text: str) -> list[int]:
        sizes = list(map(len, text.split()))
        gaps = len(text) - sum(sizes) - len(sizes)
        if max(sizes, default=0) > LONG_WORD or gaps > LONG_WORD:
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and B, or none if either does not spell a space and the text."""
        if not text:
            return [], []
        spelled = b" " + text.encode()
        a, b = self.encode_a(" " + text), self.pieces.encode(text)
        if self.a.spelled(a) != spelled or self.b.spelled(b) != spelled:
            return [], []
        return a, b


def align(a: np.ndarray, b: np.ndarray, pair: Pair):
    """Links and groups of ids that spell the same bytes.

    Returns the positions (in a, in b) of every link, tokens whose bytes overlap, in order;
    the end of each group, the byte offsets where tokens of both end; and ends of tokens.
    """
    end_a, end_b = np.cumsum(pair.a.lengths[a]), np.cumsum(pair.b.lengths[b])
    size = int(end_a[-1]) if len(end_a) else 0
    is_a, is_b = np.zeros(size + 1, np.int8), np.zeros(size + 1, np.int8)
    is_a[end_a], is_b[end_b] = 1, 1
    # Between two neighbouring ends lies one token of each side: that is one link.
    cuts = np.flatnonzero(is_a | is_b)
    at_a = np.cumsum(is_a[cuts]) - is_a[cuts]
    at_b = np.cumsum(is_b[cuts]) - is_b[cuts]
    return at_a, at_b, np.flatnonzero(is_a & is_b), end_a, end_b


def written_groups(a, b, groups, end_a, end_b, pair: Pair) -> tuple[np.ndarray, np.ndarray]:
    """Every id as text with the mark that follows it, group by group; ids up to each group."""
    last_a, last_b = np.searchsorted(end_a, groups), np.searchsorted(end_b, groups)
    texts_a, texts_b = pair.a.inner[a], pair.b.inner[b]
    texts_a[last_a], texts_b[last_b] = pair.a.outer[a[last_a]], pair.b.outer[b[last_b]]
    of_a = np.searchsorted(groups, end_a)
    of_b = np.searchsorted(groups, end_b)
    before_b = np.concatenate(([0], last_b + 1))
    out = np.empty(len(a) + len(b), object)
    out[np.arange(len(a)) + before_b[of_a]] = texts_a
    out[np.arange(len(b)) + last_a[of_b] + 1] = texts_b
    return out, last_a + last_b + 2


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values, np.int32), codec=_CODEC, asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * n, codec=_CODEC, asbytes=True)
    return np.frombuffer(raw, np.int32)


def _one_part(pair: Pair, number: int, texts: list[str], copies: np.ndarray) -> list:
    """The row of a part: some distinct texts, aligned together."""
    digests = [hashlib.sha256(t.encode()).digest() for t in texts]
    ids = [pair.encode(t) for t in texts]
    n_a = np.array([len(x) for x, _ in ids], np.int64)
    n_b = np.array([len(x) for _, x in ids], np.int64)
    a = np.fromiter((i for x, _ in ids for i in x), np.int64, n_a.sum())
    b = np.fromiter((i for _, x in ids for i in x), np.int64, n_b.sum())
    # Texts follow each other; all their ends are ends of both sides, so none is linked
    # with another.
    at_a, at_b, groups, end_a, end_b = align(a, b, pair)
    text_of_a = np.repeat(np.arange(len(texts)), n_a)
    text_of_link = text_of_a[at_a]
    n_links = np.bincount(text_of_link, minlength=len(texts))
    n_groups = np.bincount(text_of_a[np.searchsorted(end_a, groups)], minlength=len(texts))
    codes, link = np.unique(a[at_a] * len(pair.b.bytes) + b[at_b], return_inverse=True)
    weights = np.bincount(link, copies[text_of_link], minlength=len(codes)).astype(np.int64)
    marked, upto = written_groups(a, b, groups, end_a, end_b, pair)
    edges = np.concatenate(([0], np.cumsum(n_groups)))
    hashes = []
    for k in range(len(texts)):
        low, high = edges[k], edges[k + 1]
        if low == high:
            hashes.append(b"")
            continue
        first = upto[low - 1] if low else 0
        joined = b"".join(marked[first : upto[high - 1]])
        hashes.append(hashlib.sha256(joined[:-1]).digest())
    counts = [pa.array([x.astype(np.int32)]) for x in (n_a, n_b, n_groups, n_links)]
    return [
        pa.array([number]),
        pa.array([digests], pa.list_(pa.binary())),
        pa.array([hashes], pa.list_(pa.binary())),
        *counts,
        pa.array([_packed(link)], pa.binary()),
        pa.array([codes]),
        pa.array([weights]),
    ]


_PART_NAMES = [
    "part", "digests", "groups", "n_a", "n_b", "n_groups", "n_links", "links", "codes", "weights",
]


def _aligned(files: Tokenizers):
    def aligned(batches):
        pair = Pair(files)
        # Unique among the parts that are written, also if a task runs again.
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column("text")
            copies = batch.column("copies").to_numpy()
            for low, _, offsets in tokens.groups(column):
                high = low + len(offsets) - 1
                texts = column.slice(low, high - low).to_pylist()
                row = _one_part(pair, number, texts, copies[low:high])
                number += 1
                yield pa.RecordBatch.from_arrays(row, _PART_NAMES)

    return aligned


def _measured(part, answers):
    """Each text's links looked up among the answers to its part's pairs."""
    at = answers.column("at").to_numpy()
    count = np.zeros(len(at), np.int64)
    best = np.zeros(len(at), bool)
    count[at] = answers.column("count").to_numpy()
    best[at] = answers.column("best").to_numpy(zero_copy_only=False)

    def listed(name):
        return part.column(name).combine_chunks().flatten()

    n_links = listed("n_links").to_numpy().astype(np.int64)
    link = _unpacked(part.column("links")[0].as_py(), int(n_links.sum()))
    edges = np.concatenate(([0], np.cumsum(n_links)))

    def total(values):
        sums = np.concatenate(([0], np.cumsum(values[link], dtype=np.int64)))
        return pa.array(sums[edges[1:]] - sums[edges[:-1]])

    long = [listed(m).cast(pa.int64()) for m in MEASURES[:4]]
    hashes = pa.array([x.as_py().hex() for x in listed("groups")], pa.string())
    columns = [listed("digests"), hashes, *long, total(best), total(count)]
    return pa.table(columns, ["digest", "groups_sha256", *MEASURES])


def pair_counts(parts: DataFrame, b_ids: int) -> DataFrame:
    """(code, count, best) of every pair of ids that is linked anywhere in the corpus.

    A pair's code is a * ``b_ids`` + b. Parts come summed, so no pair has more rows than
    there are parts. The highest count per id of B has at most ``b_ids`` rows.
    """
    counts = (
        parts.select(F.explode(F.arrays_zip("codes", "weights")).alias("x"))
        .groupBy(F.col("x.codes").alias("code"))
        .agg(F.sum("x.weights").alias("count"))
    )
    counts = materialize(counts.withColumn("b", F.pmod("code", F.lit(b_ids))), "pairs")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    highest = broadcast_if_small(*materialize_sized(highest, "highest"))
    return counts.join(highest, "b").select(
        "code", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def align_corpus(
    docs: DataFrame, files: Tokenizers, id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Aligns the tokens of two tokenizers in every text.

    Returns a frame of one row per input row (doc_id, ``digest`` of the text, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256) and a frame of pairs (a, b, count,
    best). Tokens are linked where their bytes overlap; a group ends where tokens of both
    end; a pair's count is how many links of the corpus hold it, copies included, and ``best``
    says that no other pair of its B id has a higher one.

    Texts are shuffled once, by the whole text, and grouped: each distinct one is tokenised
    and aligned once, with its number of copies as weight. Only its numbers are joined back
    to documents, by the SHA-256 of the text. Links stay in written parts of about 4 MiB of
    text, and each part asks for the counts of its distinct pairs.

    Null and empty texts, and texts that either tokenizer does not spell byte by byte, have
    no tokens: zeros and an empty ``groups_sha256``. Texts of any length are encoded whole.
    Repeated rows and rows without an id are rows of their own; pairs that tie for the
    highest count are all best; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    distinct = rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    parts = written_by_python(distinct.mapInArrow(_aligned(files), _PART), "parts")
    b_ids = files.b_size()
    pairs, size = materialize_sized(pair_counts(parts, b_ids), "counts")
    asked = parts.select(F.col("part").alias("asker"), F.posexplode("codes").alias("at", "code"))
    answers = asked.join(broadcast_if_small(pairs, size), "code").drop("code")
    links = parts.drop("codes", "weights")
    measured = links.groupBy("part").cogroup(answers.groupBy("asker")).applyInArrow(
        _measured, _FOUND
    )
    with small_batches(docs.sparkSession):
        measured, size = materialize_sized(measured, "measures")
    # Digests and hashes are 32 and 64 bytes, which the measured size counts as one number.
    measured = broadcast_if_small(measured, 2 * size)
    keyed = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    zeros = [F.coalesce(m, F.lit(0).cast("bigint")).alias(m) for m in MEASURES]
    found = keyed.join(measured, "digest", "left").select(
        "doc_id", "digest", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )
    pairs = pairs.select(
        F.floor(F.col("code") / b_ids).alias("a"),
        F.pmod("code", F.lit(b_ids)).alias("b"),
        "count",
        "best",
    )
    return found, pairs


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = align_corpus(table(spark, sf_dir, "documents"), public_pair())
    return found.drop("digest")
