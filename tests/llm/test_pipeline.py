"""The corpus pipeline on a small table: each stage's decisions take effect."""

import corpus_pipeline
from pyspark.sql import functions as F


def test_stages_keep_columns_and_drop_what_they_should(spark, tmp_path):
    base = [f"word{i}" for i in range(80)]
    texts = [" ".join(f"d{i}n{k % 50}" for k in range(60)) for i in range(30)]
    texts += [texts[0], texts[0].replace(" ", "  "), " ".join(base), " ".join([*base[:-1], "end"]), None, ""]
    rows = [(i, t, "en", f"s{i % 3}", 1) for i, t in enumerate(texts)]
    rows.append(rows[5])
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = sorted(r["doc_id"] for r in docs.collect())
    every = sorted(r[0] for r in rows)
    assert left["toxicity"] == every
    assert left["exact_dedup"] == [i for i in range(36) if i not in (30, 31, 35)]
    assert left["near_dedup"] == [i for i in left["exact_dedup"] if i != 33]
    assert left["mixing"] == left["near_dedup"]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r["doc_id"] for r in packed.collect()}) == left["mixing"]


def test_the_mixed_order_decides_the_packed_rows(spark, monkeypatch):
    # Texts of one length in tokens, several to a sequence.
    rows = [(i, "a b c d " * 200, f"s{i % 2}") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = 24

    def packed(position):
        order = docs.select("doc_id", position.cast("long").alias("position"))
        monkeypatch.setattr(corpus_pipeline.mixing, "mix", lambda docs: order)
        found = corpus_pipeline.pack_sequences(spark, docs, "").collect()
        return [r["doc_id"] for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"]))]

    assert packed(F.col("doc_id")) == list(range(size))
    assert packed(size - F.col("doc_id")) == list(range(size))[::-1]


def test_sequences_are_numbered_by_their_earliest_position(spark):
    rows = [(i, i, 0, 1500 if i % 2 else 700) for i in range(20)]
    pieces = spark.createDataFrame(rows, "_position long, _id long, start long, length long")
    first = {}
    for r in corpus_pipeline.packing.pack(pieces).collect():
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], 99), r["_id"])
    earliest = [first[k] for k in sorted(first)]
    assert sorted(first) == list(range(len(first))) and earliest == sorted(earliest)


def test_columns_of_any_name_come_through(spark, tmp_path):
    names = ["_key", "_part", "_text", "_of", "_sha", "_kept", "_gone", "_position", "_toxicity", "kept"]
    rows = [(i, f"text {i % 5} of {i % 6}", "s", *[f"{n}{i}" for n in names]) for i in range(12)]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names)
    )
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = docs.collect()
    assert left and all(r[n] == f"{n}{r['doc_id']}" for r in left for n in names)
