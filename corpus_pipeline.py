"""A training corpus from raw documents: five stages, each written and read again.

Stages take (spark, docs, sf_dir) and return the documents that go on, with the columns
they came with; the last one returns the packed pieces. Whether a document stays is decided
on all documents that reached the stage.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from stratacast.llm.common import known_id, table, text_of
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` whose id is not among ``gone``, a frame of ids; a null id is an id."""
    gone = broadcast_if_small(*materialize_sized(gone.toDF("_gone"), "gone"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the threshold."""
    scored = toxicity.scored_rows(docs, table(spark, sf_dir, "labels"))
    bad = scored.where(F.col("score") >= toxicity.REJECT_AT).select(
        F.col("_id").alias("_of"), F.col("_mark").alias("_sha")
    )
    bad = broadcast_if_small(*materialize_sized(bad.distinct(), "toxic"))
    own = (known_id("doc_id") == bad["_of"]) & (F.xxhash64(text_of("text")) == bad["_sha"])
    return docs.join(bad, own, "left_anti")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id; of repeated rows, one."""
    found = exact_dedup.exact_duplicates(docs)
    key = F.sha2(exact_dedup.normalised("text"), 256)
    own = found.select(F.col("doc_id").alias("_of"), F.col("text_sha256").alias("_sha"), "kept")
    marked = own.groupBy("_of", "_sha").agg(F.min("kept").alias("_kept"), F.count("*").alias("_n"))
    marked = marked.where("NOT _kept OR _n > 1").select("_of", "_sha", "_kept")
    marked = broadcast_if_small(*materialize_sized(marked, "copies"))
    keyed = docs.withColumn("_key", key)
    same = keyed["doc_id"].eqNullSafe(marked["_of"]) & (keyed["_key"] == marked["_sha"])
    single = keyed.join(marked, same, "left_anti").select(*docs.columns)
    repeated = keyed.join(marked.where("_kept"), same, "left_semi")
    return single.unionByName(repeated.dropDuplicates(["doc_id", "_key"]).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents, the one with the smallest id."""
    found = jaccard_join.near_duplicates(docs)
    return _without(docs, found.where("doc_id <> class_id").select("doc_id").distinct())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which sources are mixed."""
    order = mixing.mix(docs).groupBy(F.col("doc_id").alias("_of")).agg(
        F.min("position").alias("_position")
    )
    order = broadcast_if_small(*materialize_sized(order, "order"))
    placed = docs.join(order, docs["doc_id"].eqNullSafe(order["_of"]))
    return placed.orderBy("_position").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences, in mixed order.

    Rows have no order of their own once read: the same documents are mixed again, which
    gives the same positions.
    """
    return packing.pack_documents(docs, packing.public_tokenizer(), order=mixing.mix(docs))


# The columns that stages read.
READ = ("doc_id", "text", "source")


def _apart(stage):
    """The stage with all columns that it does not read under names it does not use."""

    @wraps(stage)
    def shielded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in READ else f"extra{k}" for k, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*names), sf_dir)
        return out.toDF(*docs.columns) if out.columns == names else out

    return shielded


STAGES = [
    ("toxicity", _apart(drop_toxic)),
    ("exact_dedup", _apart(drop_exact_copies)),
    ("near_dedup", _apart(drop_near_copies)),
    ("mixing", _apart(mix_sources)),
    ("packing", _apart(pack_sequences)),
]

# The first and fourth stage learn a model and schedule slots: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
