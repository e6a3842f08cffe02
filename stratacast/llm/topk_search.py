"""Exact top-k by inner product, pruned with segment means and deviations."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.llm.common import table
from stratacast.session import materialize

TOP = 10
SCALE = 1024
# Vectors of a block: queries and candidates.
QUERY_BLOCK, CANDIDATE_BLOCK = 256, 1024
# Segments per vector, coarse to fine.
LEVELS = (1, 4, 16)


def _segments(dim: int, n: int) -> np.ndarray:
    return np.unique(np.linspace(0, dim, min(n, dim) + 1).astype(int))


def statistics(vectors: np.ndarray, n: int) -> np.ndarray:
    """Per segment: mean and deviation, weighted so that products of rows bound products.

    For parts x and y of length m: x.y = m mean(x) mean(y) + rest, and the rest is at most
    m dev(x) dev(y). Summed over segments this bounds the inner product from above, and
    with the norms the distance from below; finer segments bound it tighter.
    """
    cuts = _segments(vectors.shape[1], n)
    size = np.diff(cuts)
    mean = np.add.reduceat(vectors, cuts[:-1], 1) / size
    square = np.add.reduceat(vectors * vectors, cuts[:-1], 1) / size
    dev = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean * np.sqrt(size), dev * np.sqrt(size)], 1)


def _whole(left: np.ndarray, right: np.ndarray) -> type:
    """Numbers that hold every product of rows exactly: doubles, longs or Python's own."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


def _as(kind: type, rows: np.ndarray) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)
    return rows.astype(kind)


def _longs(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; one that no long holds is an error and never another score."""
    if scores.dtype == np.float64:
        return np.rint(scores).astype(np.int64)
    if scores.dtype == object and any(abs(s) >= 2**63 for s in scores):
        raise OverflowError("an inner product of scaled components does not fit a long")
    return scores.astype(np.int64)


def best_of_block(q_ids, queries, c_ids, candidates, top: int):
    """(query, candidate, score) of the ``top`` best of a block for each query."""
    if len(c_ids) <= 2 * top:
        alive = np.ones((len(q_ids), len(c_ids)), bool)
    else:
        alive = None
        floor = None
        # Room for rounding in what follows, the deviations' cancellation above all: bounds may
        # only be too high, and what is not a number excludes nothing.
        length = [np.sqrt((x * x).sum(1)) for x in (queries, candidates)]
        for level in LEVELS:
            bound = statistics(queries, level) @ statistics(candidates, level).T
            bound += 1e-7 * length[0][:, None] * length[1][None, :] + 1
            bound = np.where(q_ids[:, None] == c_ids[None, :], -np.inf, bound)
            if floor is None:
                likely = np.argpartition(-bound, top, 1)[:, : top + 1]
                exact = np.einsum("qd,qkd->qk", queries, candidates[likely])
                own = c_ids[likely] == q_ids[:, None]
                exact = np.sort(np.where(own, -np.inf, exact), 1)[:, ::-1]
                floor = exact[:, top - 1] - 1e-7 * length[0] * length[1].max() - 1
                floor = np.where(np.isfinite(floor), floor, -np.inf)
                alive = ~(bound < floor[:, None])
            else:
                alive &= ~(bound < floor[:, None])
    kind = _whole(queries, candidates)
    where_q, where_c = np.nonzero(alive)
    queries, candidates = _as(kind, queries), _as(kind, candidates)
    if alive.mean() > 0.2:
        score = _longs((queries @ candidates.T)[where_q, where_c])
    else:
        score = np.empty(len(where_q), np.int64)
        for k in range(0, len(score), 65536):
            a, b = queries[where_q[k : k + 65536]], candidates[where_c[k : k + 65536]]
            score[k : k + 65536] = _longs((a * b).sum(1))
    other = q_ids[where_q] != c_ids[where_c]
    where_q, where_c, score = where_q[other], where_c[other], score[other]
    order = np.lexsort((c_ids[where_c], -score, where_q))
    where_q, where_c, score = where_q[order], where_c[order], score[order]
    first = np.searchsorted(where_q, where_q)
    keep = np.arange(len(where_q)) - first < top
    return q_ids[where_q[keep]], c_ids[where_c[keep]], score[keep]


def _blocks(size, scale):
    """Vectors of a task as rows of scaled integers, ``size`` of equal length to a row."""

    def made(batches):
        held: dict[int, list] = {}

        def block(dim):
            ids, rows = zip(*held.pop(dim))
            ids, rows = np.array(ids, np.int64), np.array(rows, np.float64)
            return pa.RecordBatch.from_pydict(
                {"dim": [dim], "n": [len(ids)], "ids": [ids.tobytes()], "vectors": [rows.tobytes()]},
                pa.schema(
                    [("dim", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]
                ),
            )

        for batch in batches:
            ids, lists = batch.column("_id").to_pylist(), batch.column("vector")
            flat, ends = lists.flatten().to_numpy(False), lists.offsets.to_numpy()
            flat = np.floor(flat.astype(np.float64) * scale)
            for i, low, high in zip(ids, ends[:-1], ends[1:]):
                mine = held.setdefault(int(high - low), [])
                mine.append((i, flat[low:high]))
                if len(mine) == size:
                    yield block(int(high - low))
        for dim in list(held):
            yield block(dim)

    return made


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    scale: int = SCALE,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``top`` highest integer inner products of each query with all other vectors.

    Components become floor(scale * x). Returns query_id, rank from 1, vec_id, score; ties
    go to the smaller id. Queries and candidates are packed into blocks; each pair of
    blocks is one small row on both sides, and bounds from 1, 4 and 16 segments leave the
    few pairs that are multiplied out. What a pair of blocks returns is at most ``top``
    rows a query, cut again before the last shuffle.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do
    null ids; vectors of other lengths than the query's are not its candidates. Repeated
    rows count once, and rows with the query's id are its own. Components of any size count in full; a product that
    no long holds is an error. Other columns are ignored; an empty table gives no rows.
    """

    def usable(rows):
        own = F.col(vector).cast("array<double>")
        rows = rows.select(F.col(id).cast("long").alias("_id"), own.alias("vector"))
        rows = rows.where(F.col("_id").isNotNull() & (F.size("vector") > 0))
        finite = F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
        )
        return rows.where(finite).dropDuplicates()

    schema = "dim long, n long, ids binary, vectors binary"

    def packed(rows, size, name):
        made = materialize(usable(rows).mapInArrow(_blocks(size, scale), schema), name)
        numbered = made.withColumn("block", F.monotonically_increasing_id())
        return materialize(numbered, name)

    left, right = packed(queries, QUERY_BLOCK, "queries"), packed(vectors, CANDIDATE_BLOCK, "blocks")
    # The pairs of blocks are keys on both sides, so that none meets all others in one task.
    pairs = left.select("dim", F.col("block").alias("q")).join(
        right.select("dim", F.col("block").alias("c")), "dim"
    )
    pairs = materialize(pairs, "pairs")
    jobs = (
        pairs.join(left.select(F.col("block").alias("q"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "q")
        .join(right.select(F.col("block").alias("c"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors")), "c")
        .select("dim", "q_ids", "q_vectors", "c_ids", "c_vectors")
    )

    def search(frames):
        for frame in frames:
            for job in frame.itertuples(index=False):
                q_ids, c_ids = np.frombuffer(job.q_ids, np.int64), np.frombuffer(job.c_ids, np.int64)
                q = np.frombuffer(job.q_vectors).reshape(len(q_ids), job.dim)
                c = np.frombuffer(job.c_vectors).reshape(len(c_ids), job.dim)
                found = best_of_block(q_ids, q, c_ids, c, top)
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    hits = jobs.mapInPandas(search, "query_id long, vec_id long, score long").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
