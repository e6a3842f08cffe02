"""Mixing sources to target weights: Pfair windows, earliest deadline first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.llm.common import given_id, known_id, ranked, table
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

BLOCK_DOCS = 16
# Default shares are whole numbers that sum to about this.
SHARES = 1000


def tempered_shares(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, n_docs) with a ``share`` in proportion to the root of the size.

    A usual target: large sources weigh less than their size, small ones more.
    """
    every = Window.partitionBy(F.lit(0))
    root = F.sqrt("n_docs")
    share = F.greatest(F.lit(1), F.round(F.lit(SHARES) * root / F.sum(root).over(every)))
    return sizes.withColumn("share", share.cast("long"))


def _cycle(shares: Column) -> Column:
    """Order of the blocks of one period: an array of (slot, member, number).

    ``shares`` is an array of each member's blocks a period; D is their sum. Block j of a
    member with s blocks is released at slot floor(j * D / s) and due by
    ceil((j + 1) * D / s); every slot takes the released block that is due first. The
    windows of one machine always fit, so no member is ever a block ahead or behind.
    """
    total = F.aggregate(shares, F.lit(0).cast("long"), lambda a, s: a + s)
    members = F.sequence(F.lit(0), F.size(shares) - 1)

    def share(m):
        return F.element_at(shares, m + 1)

    def slot(state, t):
        done = state["done"]

        def block(m):
            number = F.element_at(done, m + 1)
            released = F.floor(number * total / share(m))
            due = F.ceil((number + 1) * total / share(m))
            ready = (number < share(m)) & (released <= t)
            return F.when(ready, F.struct(due.alias("due"), m.alias("m"), number.alias("number")))

        # array_min skips the nulls of members that are not ready
        chosen = F.array_min(F.transform(members, block))
        return F.struct(
            F.transform(
                done, lambda n, m: F.when(m == chosen["m"], n + 1).otherwise(n)
            ).alias("done"),
            F.concat(
                state["order"],
                F.array(
                    F.struct(t.alias("slot"), chosen["m"].alias("m"), chosen["number"].alias("number"))
                ),
            ).alias("order"),
        )

    start = F.struct(
        F.transform(shares, lambda s: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<struct<slot:bigint,m:int,number:bigint>>").alias("order"),
    )
    slots = F.sequence(F.lit(0).cast("long"), total - 1)
    return F.aggregate(slots, start, slot, lambda state: state["order"])


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    block_docs: int = BLOCK_DOCS,
    id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """An order of all documents that follows the target weights block by block.

    ``weights`` has ``source`` and ``share``, a positive whole number; a source's target
    weight is its share of their sum. Sources without a share get 1. Without ``weights``,
    shares go by the root of the sources' sizes.

    Returns one row per input row: doc_id, source, share, block (of block_docs documents
    of the source, which are in pseudo-random but repeatable order), period, slot and
    position (gapless from 0). While a source lasts it has share blocks in every period,
    and at each slot its blocks so far differ by less than one from its weight times the
    slots. A source that has run out leaves; the others go on with weights relative to
    each other, so every document appears exactly once.

    The periods between two such departures are alike: one period is scheduled for each
    set of sources still present, and blocks look their slot up. That table has at most
    (sources x sum of shares) rows, whatever the number of documents. A null source is the
    source ``""``. Null ids sort last; repeated rows are placed one by one; other columns
    are ignored.
    """
    rows = docs.select(
        known_id(id).alias("_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
    )
    rows = rows.withColumn("_mixed", F.xxhash64("_id", F.lit(1)))
    dealt = ranked(rows, ["source"], ["_mixed", "_id"], "_rank")
    dealt = materialize(dealt.drop("_mixed"), "dealt")
    sizes = dealt.groupBy("source").agg(F.count("*").alias("n_docs"))
    if weights is None:
        shares = tempered_shares(sizes)
    else:
        given = weights.where("share > 0").groupBy(
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")
        ).agg(F.max("share").cast("long").alias("share"))
        shares = sizes.join(given, "source", "left").withColumn(
            "share", F.coalesce("share", F.lit(1).cast("long"))
        )
    periods = F.ceil(F.ceil(F.col("n_docs") / block_docs) / F.col("share"))
    shares = shares.withColumn("periods", periods)
    every = Window.partitionBy(F.lit(0))
    # A phase begins at period 0 and wherever a source has run out.
    shares = shares.withColumn(
        "phases",
        F.array_union(F.array(F.lit(0).cast("long")), F.sort_array(F.collect_set("periods").over(every))),
    )
    shares, size = materialize_sized_shares(shares)
    present = shares.select(
        "source", "share", "periods", F.explode("phases").alias("phase")
    ).where(F.col("phase") < F.col("periods"))
    cycles = present.groupBy("phase").agg(
        F.array_sort(F.collect_list(F.struct("source", "share"))).alias("members")
    )
    cycles = cycles.withColumn("order", _cycle(F.col("members.share")))
    cycles = cycles.select("phase", "members", F.explode("order").alias("o")).select(
        "phase",
        F.element_at("members", F.col("o.m") + 1)["source"].alias("source"),
        F.col("o.number").alias("number"),
        F.col("o.slot").alias("slot"),
    )
    cycles = broadcast_if_small(*materialize_sized(cycles, "cycles"))
    blocks = dealt.join(broadcast_if_small(shares, size), "source")
    block = F.expr(f"_rank div {block_docs}L")
    period = F.expr("block div share")
    blocks = (
        blocks.withColumn("block", block)
        .withColumn("period", period)
        .withColumn("number", F.pmod("block", "share"))
        .withColumn("phase", F.array_max(F.filter("phases", lambda p: p <= F.col("period"))))
        .drop("phases", "periods", "n_docs")
    )
    placed = blocks.join(cycles, ["phase", "source", "number"]).select(
        "_id", "source", "share", "block", "period", "slot", "_rank"
    )
    placed = materialize(placed, "slots")
    return ranked(placed, [], ["period", "slot", "_rank"], "position").select(
        given_id("_id").alias("doc_id"), "source", "share", "block", "period", "slot", "position"
    )


def materialize_sized_shares(shares: DataFrame) -> tuple[DataFrame, int]:
    """The written sources and their bytes, which the phases of each count into."""
    written = materialize(shares, "shares")
    width = F.octet_length("source") + F.size("phases") * 8 + 64
    return written, written.agg(F.sum(width)).first()[0] or 0


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
