import pytest

LONG = " ".join(f"w{i % 89}x{i % 7}" for i in range(20_000))


@pytest.fixture
def awkward(spark):
    """Makes a table of given texts, with nulls, repeated rows and columns of clashing names."""

    def make(texts):
        rows = [(i, t) for i, t in enumerate([None, "", " \t\n", *texts, LONG])]
        rows += [(None, texts[0]), rows[3], rows[3], (7 * 10**12, texts[0])]
        clash = ["_id", "_given", "base", "spans", "runs", "digest", "part", "code", "copies"]
        frame = spark.createDataFrame(
            [(*r, *[-1] * len(clash)) for r in rows],
            "doc_id long, text string, " + ", ".join(f"{c} int" for c in clash),
        )
        return frame, rows

    return make
