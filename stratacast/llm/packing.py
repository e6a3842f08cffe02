"""Packing into fixed-length sequences: shortest pack first over the length histogram."""

from __future__ import annotations

import zlib
from array import array
from base64 import b64decode

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm.common import (
    given_id,
    known_id,
    ranked,
    table,
    text_of,
    written_by_python,
)
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

SEQUENCE_TOKENS = 2048
END_ID = 1
# Words or gaps longer than this go to the tokenizer whose time does not grow with the
# square of their length.
LONG_WORD = 2000

_PIECES = "`_id` long, `start` long, `length` long, `ids_crc32` long, `doc_tokens` long"


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, as the tokenizer's file gives them.

    The same merges are taken from its file of ranks, several times as fast. Texts that
    spell a special token, or hold a very long word or gap, are encoded by the tokenizer.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_file:
            import tiktoken

            with open(ranks_file, "rb") as lines:
                ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )

    def _plain(self, text: str) -> bool:
        if self.fast is None or any(s in text for s in self.special):
            return False
        if len(text) <= LONG_WORD:
            return True
        sizes = list(map(len, text.split()))
        return max(sizes, default=0) <= LONG_WORD and len(text) - sum(sizes) - len(
            sizes
        ) <= LONG_WORD

    def __call__(self, text: str) -> bytes:
        if self._plain(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


def _encoded(batches, tokenizer, end_id):
    encode = Encoder(*tokenizer)
    end = int(end_id).to_bytes(4, "little")
    for batch in batches:
        ids, texts = batch.column("_id"), batch.column("text")
        for i, text in zip(ids, texts):
            yield i.as_py(), encode(text.as_py()) + end


def token_pieces(
    docs: DataFrame,
    tokenizer: tuple,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Token ids of every document, with an end id, cut into pieces of at most ``size``.

    ``tokenizer`` is the tokenizer's file and, or None, its ranks and pattern; see Encoder.
    Texts are not shuffled: only lengths and a checksum leave the task, unless the ids
    themselves are asked for.
    """

    def pieces(batches):
        rows: list[list] = [[], [], [], [], [], []]

        def made():
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(rows, kinds)][: 6 if with_ids else 5]
            names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            for c in rows:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

        weight = 0
        for i, buf in _encoded(batches, tokenizer, end_id):
            n = len(buf) // 4
            for start in range(0, n, size):
                part = buf[4 * start : 4 * (start + size)]
                values = (i, start, len(part) // 4, zlib.crc32(part), n)
                for c, v in zip(rows, values):
                    c.append(v)
                if with_ids:
                    rows[5].append(memoryview(part).cast("I").tolist())
                    weight += len(part)
            if len(rows[0]) >= 10_000 or weight > 1 << 24:
                weight = 0
                yield made()
        if rows[0]:
            yield made()

    schema = _PIECES + (", `ids` array<int>" if with_ids else "")
    return docs.select(known_id(id).alias("_id"), text_of(text).alias("text")).mapInArrow(
        pieces, schema
    )


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, list]]:
    """Packing patterns (count, [(length, times), ...]) for ``histogram`` {length: count}.

    Lengths go longest first, each to the packs with the fewest tokens if it fits there,
    else to new packs; packs that look alike are one pattern with a count. The work and
    the result depend on ``size`` and not on the number of documents.
    """
    packs: dict[int, list[tuple[int, tuple]]] = {}  # by free tokens

    def put(free, count, pattern):
        packs.setdefault(free, []).append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for free in sorted((f for f in packs if f >= length), reverse=True):
            while left and packs.get(free):
                count, pattern = packs[free].pop()
                times = 1
                # Spread over all packs of a pattern first; only a rest goes on filling.
                take = min(count, left)
                if count > take:
                    packs[free].append((count - take, pattern))
                put(free - times * length, take, (pattern, length, times))
                left -= take
            if not packs.get(free):
                packs.pop(free, None)
            if not left:
                break
        while left:
            # Nothing has room: open as few packs as hold the rest, evenly filled.
            each = size // length
            new = -(-left // each)
            times, more = divmod(left, new)
            for n, count in ((times + 1, more), (times, new - more)):
                if count and n:
                    put(size - n * length, count, ((), length, n))
            left = 0
    found = []
    for entries in packs.values():
        for count, pattern in entries:
            slots = []
            while pattern:
                pattern, length, times = pattern
                slots.append((length, times))
            found.append((count, slots[::-1]))
    return found


def _placements(patterns) -> list[tuple]:
    """Runs of ranks of one length: (length, first rank, ranks, times, sequence, offset)."""
    rank: dict[int, int] = {}
    found, sequence = [], 0
    for count, slots in patterns:
        offset = 0
        for length, times in slots:
            first = rank.get(length, 0)
            found.append((length, first, count * times, times, sequence, offset))
            rank[length] = first + count * times
            offset += length * times
        sequence += count
    return found


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` (``_id``, ``start``, ``length``, ...) with ``sequence_id`` and ``offset``.

    The histogram has at most ``size`` rows, whatever the input; its patterns are computed
    on the driver and come back as a table of at most a few thousand runs of ranks. Each
    piece finds its place by its rank among the pieces of its length: by ``_position``, if
    given, which also numbers the sequences by the earliest position in them.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count("*").alias("n")
    ).collect()}
    runs = _placements(pack_histogram(histogram, size))
    runs = spark.createDataFrame(
        runs, "length long, first long, ranks long, times long, sequence long, place long"
    )
    # One row per length: at most ``size`` of them, so the broadcast is bounded.
    starts = F.array_sort(F.collect_list(F.struct("first", "ranks", "times", "sequence", "place")))
    runs = runs.groupBy("length").agg(starts.alias("runs"))
    order = [c for c in ("_position", "_id", "start") if c in pieces.columns]
    numbered = ranked(pieces, ["length"], order, "_rank")
    own = F.filter(
        "runs",
        lambda r: (r["first"] <= F.col("_rank")) & (F.col("_rank") < r["first"] + r["ranks"]),
    )[0]
    inside = F.col("_rank") - F.col("_run.first")
    placed = (
        numbered.join(broadcast_if_small(runs, 0), "length")
        .withColumn("_run", own)
        .withColumn(
            "sequence_id", F.col("_run.sequence") + F.floor(inside / F.col("_run.times"))
        )
        .withColumn(
            "offset", F.col("_run.place") + F.pmod(inside, F.col("_run.times")) * F.col("length")
        )
        .drop("runs", "_run", "_rank")
    )
    if "_position" not in pieces.columns:
        return placed
    placed = materialize(placed, "placed")
    first = placed.groupBy("sequence_id").agg(F.min("_position").alias("_first"))
    numbers = ranked(first, [], ["_first", "sequence_id"], "_number").drop("_first")
    numbers = broadcast_if_small(*materialize_sized(numbers, "numbers"))
    numbered = placed.join(numbers, "sequence_id").withColumn("sequence_id", F.col("_number"))
    return numbered.drop("_number", "_position")


def pack_documents(
    docs: DataFrame,
    tokenizer: tuple,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    id: str = "doc_id",
    text: str = "text",
    order: DataFrame | None = None,
) -> DataFrame:
    """One row per piece of a document: where its ids lie in which sequence.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Documents
    longer than ``size`` are cut at multiples of it. Null and empty texts are the end id
    alone. Null ids stay null; repeated rows are packed as often as they occur; other
    columns are ignored; an empty table gives no rows. With ``order`` (doc_id, position, for
    every document), pieces of a length are placed and sequences numbered by position.
    """
    pieces = token_pieces(docs, tokenizer, size, end_id, id, text)
    pieces = written_by_python(pieces, "pieces")
    if order is not None:
        order = order.groupBy(known_id("doc_id").alias("_id")).agg(F.min("position").alias("_position"))
        pieces = pieces.join(broadcast_if_small(*materialize_sized(order, "order")), "_id")
    return pack(pieces, size).select(
        given_id("_id").alias("doc_id"),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.col("sequence_id").cast("bigint").alias("sequence_id"),
        F.col("offset").cast("bigint").alias("offset"),
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: tuple, **options) -> DataFrame:
    """The sequences themselves: sequence_id and its token ids, not padded.

    Encodes again instead of keeping ids on disk; needs ids of documents to be unique.
    """
    pieces = token_pieces(docs, tokenizer, with_ids=True, **options)
    pieces = pieces.select(given_id("_id").alias("doc_id"), "start", "ids")
    placed = pieces.join(packed.select("doc_id", "start", "sequence_id", "offset"), ["doc_id", "start"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )


def public_tokenizer() -> tuple[str, str, str]:
    """The public byte-level tokenizer: its file, the same merges as ranks, the pattern."""
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizer())
