"""Exact duplicates by composable polynomial fingerprints, then chunkwise comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import tokens
from stratacast.llm.common import given_id, known_id, table, text_of, written_by_python
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

CHUNK_CHARS = 1 << 16
# Two primes below 2**31: products of residues fit a long.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525)
# A representative's chunks are repeated once per so many members to compare with it.
MEMBERS_PER_SALT = 256

_tables: dict[tuple, np.ndarray] = {}


def normalised(text: str) -> Column:
    """White space `[\\x20\\x09-\\x0D]+` as one space; null as empty."""
    return F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", " ")


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo prime; doubling keeps it vectorised."""
    key, n = (base, prime), max(n, 4 * CHUNK_CHARS + 1)
    if key not in _tables or len(_tables[key]) < n:
        p = np.ones(1, np.int64)
        while len(p) < n:
            p = np.concatenate([p, p * pow(base, len(p), prime) % prime])
        _tables[key] = p
    return _tables[key]


def chunk_hash(data: np.ndarray, prime: int, base: int) -> tuple[int, int]:
    """Hash of a chunk and the shift its length gives to what stands before it.

    Texts compose: hash(xy) = hash(x) * shift(y) + hash(y), all modulo ``prime``.
    """
    n = len(data)
    power = _powers(base, prime, n + 1)
    value = int((data.astype(np.int64) + 1) @ power[:n][::-1] % prime) if n else 0
    return value, int(power[n])


def _hash_batches(primes):
    def hashed(batches):
        for batch in batches:
            data, offsets = tokens.buffers(batch.column("chunk"))
            found = []
            for low, high in zip(offsets[:-1], offsets[1:]):
                part = data[low:high]
                pair = [chunk_hash(part, p, b) for p, b in zip(primes, BASES)]
                found.append((pair[0][0], pair[0][1], pair[1][0], pair[1][1], high - low))
            made = np.array(found, np.int64).reshape(-1, 5).T
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "chunk"]
            names = [n for n in batch.schema.names if n != "chunk"]
            yield pa.RecordBatch.from_arrays(
                [*columns, *map(pa.array, made)], [*names, "h1", "s1", "h2", "s2", "n_bytes"]
            )

    return hashed


def _hashed(chunks: DataFrame, primes) -> DataFrame:
    kept = ", ".join(f"`{n}` {t}" for n, t in chunks.dtypes if n != "chunk")
    schema = f"{kept}, h1 long, s1 long, h2 long, s2 long, n_bytes long"
    return chunks.mapInArrow(_hash_batches(primes), schema)


def _chunks(text: str) -> Column:
    """Pieces of CHUNK_CHARS characters; an empty text has one empty piece."""
    last = F.greatest(F.length(text) - 1, F.lit(0)) / F.lit(CHUNK_CHARS)
    cut = F.transform(
        F.sequence(F.lit(0), F.floor(last).cast("int")),
        lambda i: F.substring(F.col(text), i * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS)),
    )
    return F.when(F.length(text) <= CHUNK_CHARS, F.array(F.col(text))).otherwise(cut)


def fingerprints(docs: DataFrame, text: str, keep: list[str], primes=PRIMES) -> DataFrame:
    """``keep`` columns of every row with the fingerprint and byte length of its text.

    Texts of one chunk are hashed where they are read. The chunks of longer ones are
    dealt out over the cluster, hashed in parallel and combined by their shifts.
    """
    base = docs.select(*keep, F.col(text).alias("chunk"))
    short = _hashed(base.where(F.length("chunk") <= CHUNK_CHARS), primes)
    long_ = (
        base.where(F.length("chunk") > CHUNK_CHARS)
        .withColumn("_row", F.monotonically_increasing_id())
        .select(*keep, "_row", F.posexplode(_chunks("chunk")).alias("_no", "chunk"))
        .repartition("_row", "_no")
    )
    pieces = F.array_sort(F.collect_list(F.struct("_no", "h1", "s1", "h2", "s2", "n_bytes")))

    def add(total, piece):
        return F.struct(
            ((total["h1"] * piece["s1"] + piece["h1"]) % primes[0]).alias("h1"),
            ((total["h2"] * piece["s2"] + piece["h2"]) % primes[1]).alias("h2"),
            (total["n_bytes"] + piece["n_bytes"]).alias("n_bytes"),
        )

    nothing = F.struct(
        F.lit(0).cast("long").alias("h1"),
        F.lit(0).cast("long").alias("h2"),
        F.lit(0).cast("long").alias("n_bytes"),
    )
    whole = (
        _hashed(long_, primes)
        .groupBy("_row")
        .agg(*[F.first(c).alias(c) for c in keep], F.aggregate(pieces, nothing, add).alias("_t"))
        .select(*keep, "_t.h1", "_t.h2", "_t.n_bytes")
    )
    both = short.select(*keep, "h1", "h2", "n_bytes").unionByName(whole)
    return both.select(*keep, (F.col("h1") * (1 << 31) + F.col("h2")).alias("fp"), "n_bytes")


def _compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Whether the text of each (_id, _key) equals that of its (rep, rep_key), chunk by chunk."""
    salts = F.floor((F.count("*") - 1) / MEMBERS_PER_SALT) + 1
    reps = pairs.groupBy("rep", "rep_key").agg(salts.cast("int").alias("salts"))
    reps = broadcast_if_small(*materialize_sized(reps, "reps"))
    own = texts.join(
        reps, (texts["_id"] == reps["rep"]) & (texts["_key"] == reps["rep_key"])
    ).select(
        "rep",
        "rep_key",
        F.posexplode(_chunks("chunk")).alias("no", "rep_chunk"),
        F.sequence(F.lit(0), F.col("salts") - 1).alias("s"),
    )
    own = own.select("rep", "rep_key", "no", "rep_chunk", F.explode("s").alias("salt"))
    own = own.dropDuplicates(["rep", "rep_key", "no", "salt"])
    dealt = pairs.join(reps, ["rep", "rep_key"]).withColumn(
        "salt", F.pmod(F.xxhash64("_id", "_key"), F.col("salts")).cast("int")
    )
    members = texts.join(
        broadcast_if_small(*materialize_sized(dealt, "members")), ["_id", "_key"]
    ).select(
        "_id", "_key", "rep", "rep_key", "salt", F.posexplode(_chunks("chunk")).alias("no", "chunk")
    )
    same = members.join(own, ["rep", "rep_key", "no", "salt"], "left").select(
        "_id", "_key", "rep", "rep_key", F.col("chunk").eqNullSafe(F.col("rep_chunk")).alias("eq")
    )
    return same.groupBy("_id", "_key", "rep", "rep_key").agg(F.min("eq").alias("same"))


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", primes=PRIMES
) -> DataFrame:
    """Groups of texts that are equal after white space is normalised.

    Returns one row per input row: ``doc_id``, ``keep_id`` (smallest id of the group),
    ``group_size`` (rows), ``kept`` and ``text_sha256`` (lower-case hex of the normalised
    text). Equal fingerprints only nominate: each member is then compared with its
    representative chunk by chunk, and members that differ are grouped again among
    themselves, until none differs.

    Null texts count as empty, and empty texts equal each other. Null ids sort last. Rows
    that repeat an id and text are one document and marked alike, each counting in
    ``group_size``; rows that share only the id are different documents. Other columns,
    whatever their names, are ignored.
    """
    texts = docs.select(known_id(id).alias("_id"), normalised(text).alias("chunk"))
    keyed = texts.select("_id", F.xxhash64("chunk").alias("_key"), "chunk")
    marked = keyed.withColumn("sha", F.sha2("chunk", 256))
    prints = written_by_python(
        fingerprints(marked, "chunk", ["_id", "_key", "sha"], primes), "fingerprints"
    )
    alike = prints.groupBy("fp", "n_bytes").agg(F.count("*").alias("n"))
    alike = broadcast_if_small(*materialize_sized(alike.where("n > 1").drop("n"), "alike"))
    pending = prints.join(alike, ["fp", "n_bytes"]).select("fp", "n_bytes", "_id", "_key")
    pending = materialize(pending, "pending")
    settled = None
    while not pending.isEmpty():
        least = pending.groupBy("fp", "n_bytes").agg(F.min(F.struct("_id", "_key")).alias("r"))
        least = least.select(
            "fp", "n_bytes", F.col("r._id").alias("rep"), F.col("r._key").alias("rep_key")
        )
        pairs = pending.join(
            broadcast_if_small(*materialize_sized(least, "least")), ["fp", "n_bytes"]
        ).select("_id", "_key", "rep", "rep_key", "fp", "n_bytes")
        found = _compared(keyed, pairs.drop("fp", "n_bytes").distinct())
        found = materialize(found, "compared")
        equal = found.where("same").drop("same")
        settled = equal if settled is None else settled.unionByName(equal)
        differ = found.where(~F.col("same")).select("_id", "_key")
        pending = materialize(pending.join(differ, ["_id", "_key"], "left_semi"), "pending")
    if settled is None:
        grouped = prints.withColumn("rep", F.col("_id")).withColumn("rep_key", F.col("_key"))
    else:
        settled = broadcast_if_small(*materialize_sized(settled, "settled"))
        grouped = prints.join(settled, ["_id", "_key"], "left").withColumns(
            {
                "rep": F.coalesce("rep", "_id"),
                "rep_key": F.coalesce("rep_key", "_key"),
            }
        )
    sizes = grouped.groupBy("rep", "rep_key").agg(F.count("*").alias("group_size"))
    several = sizes.where("group_size > 1")
    several = broadcast_if_small(*materialize_sized(several, "sizes"))
    return grouped.join(several, ["rep", "rep_key"], "left").select(
        given_id("_id").alias("doc_id"),
        given_id("rep").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("_id") == F.col("rep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept,
       sha256(t) AS text_sha256
FROM norm
WINDOW g AS (PARTITION BY t)
"""
