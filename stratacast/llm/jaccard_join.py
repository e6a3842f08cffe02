"""Near duplicates: MinHash LSH forest over word shingles, then exact verification."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import tokens
from stratacast.llm.common import (
    components,
    given_id,
    known_id,
    ranked,
    table,
    text_of,
    written_by_python,
)
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

SHINGLE_WORDS = 5
# Similarity as a fraction, so that the test is in integers.
THRESHOLD = (4, 5)
TREES = 24
MAX_PREFIX = 8
# Chance that a pair at the threshold itself shares a prefix in some tree.
TARGET_RECALL = 0.9999
# A group of candidates is handled in chunks of so many texts, and in pairs of so many chunks.
CHUNK_TEXTS = 128
CHUNKS_A_SIDE = 8


def prefix_length(threshold: float, trees: int, longest: int, recall: float) -> int:
    """The longest prefix whose trees find a pair at the threshold with that recall.

    Starts at the whole depth of the tries and shortens the matched prefix step by step.
    """
    length = longest
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    if 1 - (1 - threshold**length) ** trees < recall:
        raise ValueError("no prefix reaches this recall: use more trees")
    return length


def _signatures(trees: int, length: int, size: int):
    """Per text: the key of its signature's prefix in each tree of the forest."""
    rng = np.random.default_rng(7)
    times = rng.integers(0, 2**63, trees * length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 2**63, trees * length, dtype=np.uint64)
    step = rng.integers(0, 2**63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signed(batches):
        for batch in batches:
            for low, data, offsets in tokens.groups(batch.column("text")):
                n = len(offsets) - 1
                hashes, _, _, rows = tokens.words(data, offsets)
                shingles, at = tokens.runs(hashes, rows, size)
                rows = rows[at]
                edge = tokens.bounds(rows, n)
                full = np.flatnonzero(edge[1:] > edge[:-1])
                keys = np.zeros((trees, len(full)), np.uint64)
                if len(full):
                    for k, (a, b) in enumerate(zip(times, plus)):
                        least = np.minimum.reduceat(tokens.mix(shingles * a + b), edge[full])
                        keys[k // length] += least * step[k % length]
                keys = tokens.mix(keys).view(np.int64).T
                counts = np.zeros(n + 1, np.int64)
                counts[full + 1] = trees
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum(counts).astype(np.int32)), pa.array(keys.reshape(-1))
                )
                part = batch.slice(low, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("sha"), lists], ["_id", "sha", "keys"]
                )

    return signed


def _sets(size: int):
    """Per text: its distinct shingles, sorted, as bytes of 64-bit hashes."""

    def made(batches):
        for batch in batches:
            for low, data, offsets in tokens.groups(batch.column("text")):
                n = len(offsets) - 1
                hashes, _, _, rows = tokens.words(data, offsets)
                shingles, at = tokens.runs(hashes, rows, size)
                edge = tokens.bounds(rows[at], n)
                sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(edge[:-1], edge[1:])]
                part = batch.slice(low, n).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sets, pa.binary())], [*part.schema.names, "set"]
                )

    return made


def _entries(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, text) entries of several sets, sorted by shingle."""
    shingles = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    texts = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(shingles, kind="stable")
    return shingles[order], texts[order]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of each text of one side with each of the other.

    Common shingles of many texts are multiplied as 0/1 matrices, a slice at a time;
    those of few texts are paired up. Memory follows the number of entries.
    """
    found = np.zeros((len(left), len(right)), np.float32)
    (ls, lt), (rs, rt) = _entries(left), _entries(right)
    both = np.intersect1d(ls, rs)
    if not len(both):
        return found.astype(np.int64)
    l0, l1 = np.searchsorted(ls, both, "left"), np.searchsorted(ls, both, "right")
    r0, r1 = np.searchsorted(rs, both, "left"), np.searchsorted(rs, both, "right")
    nl, nr = l1 - l0, r1 - r0
    dense = nl * nr > 64

    def spread(start, count):
        """start[i], start[i] + 1, ... count[i] of them, for all i in one array."""
        ends = np.cumsum(count)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + count, count)

    some = np.flatnonzero(dense)
    for k in range(0, len(some), 2048):
        part = some[k : k + 2048]
        a = np.zeros((len(left), len(part)), np.float32)
        b = np.zeros((len(right), len(part)), np.float32)
        a[lt[spread(l0[part], nl[part])], np.repeat(np.arange(len(part)), nl[part])] = 1
        b[rt[spread(r0[part], nr[part])], np.repeat(np.arange(len(part)), nr[part])] = 1
        found += a @ b.T
    few = np.flatnonzero(~dense)
    if len(few):
        pair = np.repeat(few, nl[few])
        lefts = lt[spread(l0[few], nl[few])]
        rights = rt[spread(r0[pair], nr[pair])]
        lefts = np.repeat(lefts, nr[pair])
        flat = np.bincount(lefts * len(right) + rights, minlength=found.size)
        found += flat.reshape(found.shape).astype(np.float32)
    return np.rint(found).astype(np.int64)


def _links(left, right, same: bool, threshold) -> np.ndarray:
    """Which pairs are similar: |A & B| / |A | B| >= threshold, without the pair of itself."""
    up, down = threshold
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    linked = shared_counts(left, right) * (up + down) >= up * sizes
    linked &= sizes > 0
    if same:
        np.fill_diagonal(linked, False)
    return linked


def _forest(nodes_l, nodes_r, linked) -> list[tuple[int, int]]:
    """Edges that join each text to the smallest of its group among these texts."""
    big = np.iinfo(np.int64).max
    left, right = nodes_l.copy(), nodes_r.copy()
    while True:
        new_l = np.minimum(left, np.where(linked, right[None, :], big).min(1, initial=big))
        new_r = np.minimum(right, np.where(linked, new_l[:, None], big).min(0, initial=big))
        if (new_l == left).all() and (new_r == right).all():
            break
        left, right = new_l, new_r
    pairs = [*zip(nodes_l, left), *zip(nodes_r, right)]
    return [(int(a), int(b)) for a, b in pairs if a != b]


def _found(nodes_l, nodes_r, linked, same) -> pd.DataFrame:
    counts = [(int(n), None, int(c)) for n, c in zip(nodes_l, linked.sum(1)) if c]
    if not same:
        counts += [(int(n), None, int(c)) for n, c in zip(nodes_r, linked.sum(0)) if c]
    edges = [(a, b, 0) for a, b in _forest(nodes_l, nodes_r, linked)]
    return pd.DataFrame(counts + edges, columns=["a", "b", "links"]).astype(
        {"a": "int64", "b": "Int64", "links": "int64"}
    )


def _packed(nodes: np.ndarray, sets: list[np.ndarray]) -> bytes:
    """A chunk of sets: each distinct shingle once, sets as steps in that vocabulary."""
    vocabulary = np.unique(np.concatenate(sets))
    steps = [np.diff(np.searchsorted(vocabulary, s), prepend=0).astype(np.int32) for s in sets]
    head = np.array([len(nodes), len(vocabulary)], np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    raw = [head, nodes.astype(np.int64), sizes, vocabulary, np.concatenate(steps)]
    return zlib.compress(b"".join(a.tobytes() for a in raw), 1)


def _unpacked(block: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    raw = zlib.decompress(block)
    n, m = np.frombuffer(raw, np.int64, 2)
    nodes = np.frombuffer(raw, np.int64, n, 16)
    sizes = np.frombuffer(raw, np.int64, n, 16 + 8 * n)
    vocabulary = np.frombuffer(raw, np.uint64, m, 16 + 16 * n)
    steps = np.frombuffer(raw, np.int32, int(sizes.sum()), 16 + 16 * n + 8 * m)
    cuts = np.split(steps, np.cumsum(sizes)[:-1])
    return nodes, [vocabulary[np.cumsum(c)] for c in cuts]


def _verify(sets: DataFrame, threshold) -> DataFrame:
    """Verified links: rows (a, null, number of links of a) and edges (a, b, 0).

    ``sets`` has component, chunk, n_chunks, _id, set. A group of one chunk is compared
    in one task. Larger ones become one packed row per chunk, and every pair of sides
    of CHUNKS_A_SIDE chunks is compared in a task of its own; pairs are counted there
    and never leave it as rows.
    """

    def chunk(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["_id", "set"])
        nodes = frame["_id"].to_numpy()
        own = [np.frombuffer(s, np.uint64) for s in frame["set"]]
        if frame["n_chunks"].iloc[0] == 1:
            made = _found(nodes, nodes, _links(own, own, True, threshold), True)
            return made.assign(component=0, chunk=0, n_chunks=1, block=None)
        return pd.DataFrame(
            {
                "a": [0],
                "b": pd.array([None], "Int64"),
                "links": [0],
                "component": [frame["component"].iloc[0]],
                "chunk": [frame["chunk"].iloc[0]],
                "n_chunks": [frame["n_chunks"].iloc[0]],
                "block": [_packed(nodes, own)],
            }
        )

    def side_pair(frame: pd.DataFrame) -> pd.DataFrame:
        side = frame["chunk"].to_numpy() // CHUNKS_A_SIDE
        i, j = frame["i"].iloc[0], frame["j"].iloc[0]

        def read(which):
            nodes, sets = [], []
            for block in frame["block"][side == which]:
                n, s = _unpacked(block)
                nodes.append(n)
                sets += s
            return np.concatenate(nodes), sets

        nodes_l, left = read(i)
        nodes_r, right = (nodes_l, left) if i == j else read(j)
        linked = _links(left, right, i == j, threshold)
        return _found(nodes_l, nodes_r, linked, i == j)

    first = written_by_python(
        sets.groupBy("component", "chunk").applyInPandas(
            chunk,
            "a long, b long, links long, component long, chunk long, n_chunks long, block binary",
        ),
        "chunks",
    )
    blocks = first.where("block IS NOT NULL")
    side = F.floor(F.col("chunk") / CHUNKS_A_SIDE)
    sides = F.floor((F.col("n_chunks") - 1) / CHUNKS_A_SIDE)
    pairs = blocks.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), sides))).select(
        "component", "chunk", "block", F.least(side, "o").alias("i"), F.greatest(side, "o").alias("j")
    )
    crossed = pairs.groupBy("component", "i", "j").applyInPandas(
        side_pair, "a long, b long, links long"
    )
    return first.where("block IS NULL").select("a", "b", "links").unionByName(crossed)


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    trees: int = TREES,
    recall: float = TARGET_RECALL,
) -> DataFrame:
    """Similarity join of all texts on their sets of ``size``-word shingles.

    Returns one row per input row: ``doc_id``; ``class_id``, the smallest id among all
    documents linked to it directly or through others; ``text_id``, the smallest id with
    the same words; ``n_copies``, the rows with the same words; ``n_links``, the number of
    different texts whose Jaccard similarity with this one is at least the threshold.

    Rows with the same words are joined once, as one text. The words of a text are what
    white space `[\\x20\\x09-\\x0D]+` separates, unchanged. Texts with fewer than ``size``
    words have no shingles: they link to nothing but their copies; null counts as empty,
    and empty texts are copies of each other. Candidates are groups that share prefixes
    in the forest; inside a group, all pairs are compared exactly, so the forest can only
    miss pairs none of whose prefixes meet. Null ids sort last; rows that share an id
    count as one document. Other columns are ignored.
    """
    length = prefix_length(threshold[0] / threshold[1], trees, MAX_PREFIX, recall)
    source = docs.select(known_id(id).alias("_id"), text_of(text).alias("text"))
    words = F.regexp_replace(
        F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "), "^ | $", ""
    )
    signed = written_by_python(
        source.withColumn("sha", F.sha2(words, 256)).select("_id", "sha", "text").mapInArrow(
            _signatures(trees, length, size), "_id long, sha string, keys array<long>"
        ),
        "signatures",
    )
    texts = signed.groupBy("sha").agg(
        F.min("_id").alias("text_id"), F.count("*").alias("n_copies"), F.first("keys").alias("keys")
    )
    texts = materialize(texts, "texts")
    prefixes = texts.select("text_id", F.posexplode("keys").alias("tree", "key"))
    shared = prefixes.groupBy("tree", "key").agg(
        F.min("text_id").alias("least"), F.max("text_id").alias("most")
    )
    shared = shared.where("least < most").drop("most")
    shared = broadcast_if_small(*materialize_sized(shared, "prefixes"))
    near = prefixes.join(shared, ["tree", "key"]).where("text_id <> least")
    groups = components(near.select(F.col("text_id").alias("a"), F.col("least").alias("b")))
    placed = ranked(groups, ["component"], ["node"], "at").withColumn(
        "chunk", F.floor(F.col("at") / CHUNK_TEXTS)
    )
    placed = materialize(placed.drop("at"), "placed")
    counts = placed.groupBy("component").agg((F.max("chunk") + 1).alias("n_chunks"))
    counts = broadcast_if_small(*materialize_sized(counts, "counts"))
    placed = placed.join(counts, "component").withColumnRenamed("node", "_id")
    wanted = broadcast_if_small(*materialize_sized(placed, "candidates"))
    sets = source.join(wanted, "_id").mapInArrow(
        _sets(size), "_id long, component long, chunk long, n_chunks long, set binary"
    )
    found = written_by_python(_verify(sets, threshold), "links")
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("n_links"))
    classes = components(found.where("b IS NOT NULL").select("a", "b"))
    known = links.join(classes, links["a"] == classes["node"], "full").select(
        F.coalesce("a", "node").alias("text_id"), "n_links", "component"
    )
    known = broadcast_if_small(*materialize_sized(known, "known"))
    own = texts.select("sha", "text_id", "n_copies").join(known, "text_id", "left")
    repeated = own.where("n_copies > 1 OR n_links > 0")
    repeated = broadcast_if_small(*materialize_sized(repeated, "repeated"))
    return signed.select("_id", "sha").join(repeated, "sha", "left").select(
        given_id("_id").alias("doc_id"),
        F.when(
            F.coalesce("component", "text_id", "_id") != (1 << 63) - 1,
            F.coalesce("component", "text_id", "_id"),
        ).alias("class_id"),
        F.when(F.coalesce("text_id", "_id") != (1 << 63) - 1, F.coalesce("text_id", "_id")).alias(
            "text_id"
        ),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), texts AS (
  SELECT w, min(doc_id) AS text_id, count(*) AS n_copies FROM words GROUP BY w
), shingles AS (
  SELECT DISTINCT text_id, array_to_string(w[p:p + 4], ' ') AS g
  FROM (SELECT text_id, w, unnest(range(1, len(w) - 3)) AS p FROM texts)
), sizes AS (
  SELECT text_id, count(*) AS n FROM shingles GROUP BY text_id
), common AS (
  SELECT a.text_id AS a, b.text_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.text_id <> b.text_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.text_id = a JOIN sizes y ON y.text_id = b
  WHERE c.n * 5 >= 4 * (x.n + y.n - c.n)
), reach AS (
  SELECT text_id AS a, text_id AS b FROM texts
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (
  SELECT a, min(b) AS class_id FROM reach GROUP BY a
), degrees AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, class_id, text_id, n_copies, coalesce(n_links, 0) AS n_links
FROM words JOIN texts USING (w) JOIN classes c ON c.a = text_id LEFT JOIN degrees d ON d.a = text_id
"""
