"""Boosted trees against a plain version that looks at every cut of every node."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacast.operators import boosting
from stratacast.operators.boosting import BoostedTrees, Settings, fit_trees

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    x = spark.range(3000).selectExpr(
        "sin(id) * 10 AS a", "CAST(id % 17 AS double) AS b", "cos(id * 0.37) AS c", "id"
    )
    return x.selectExpr("a", "b", "c", "a * b + 30 * c + id % 5 AS y")


def plain(x, y, cuts, settings):
    """Predictions by recursion over the rows of each node; all rows and columns are used."""
    now = np.full(len(y), y.mean())

    def leaf(of):
        return -settings.rate * (now - y)[of].sum() / (of.sum() + settings.penalty)

    def score(of):
        return (now - y)[of].sum() ** 2 / (of.sum() + settings.penalty)

    def grow(of, depth):
        found = [(0.0, None, None)]
        if depth < settings.depth:
            for f, own in enumerate(cuts):
                for cut in own:
                    left = of & (x[f] < cut)
                    right = of & ~left
                    if left.any() and right.any():
                        found.append((score(left) + score(right) - score(of), f, cut))
        gain, f, cut = max(found, key=lambda g: g[0])
        if f is None or gain <= 1e-6:
            add[of] = leaf(of)
        else:
            grow(of & (x[f] < cut), depth + 1)
            grow(of & (x[f] >= cut), depth + 1)

    for _ in range(settings.trees):
        add = np.zeros(len(y))
        grow(np.ones(len(y), bool), 0)
        now = now + add
    return now


@pytest.mark.parametrize("trees", [1, 3])
def test_trees_equal_a_plain_search(spark, rows, trees, monkeypatch):
    monkeypatch.setattr(boosting, "BINS", 16)
    settings = Settings(trees, depth=3, rate=0.3, row_fraction=1.0, column_fraction=1.0, seed=1)
    model = fit_trees(rows, NAMES, "y", settings)
    data = rows.toPandas()
    x = data[NAMES].to_numpy().T
    cuts = boosting.cut_points(rows, NAMES)
    want = plain(x, data["y"].to_numpy(), cuts, settings)
    np.testing.assert_allclose(model.predict(x), want, rtol=1e-6)
    got = model.transform(rows, "p").select("p").toPandas()["p"]
    np.testing.assert_allclose(np.sort(got), np.sort(want), rtol=1e-6)


def test_tasks_do_not_change_the_trees(rows):
    settings = Settings(9, depth=4, rate=0.1, row_fraction=0.8, column_fraction=0.8, seed=42)
    alone = fit_trees(rows, NAMES, "y", settings)
    dealt = fit_trees(rows.repartition(5), NAMES, "y", settings, task_rows=700)
    for one, other in zip(alone.trees, dealt.trees, strict=True):
        for field in ("feature", "cut", "threshold", "value", "gain"):
            np.testing.assert_array_equal(getattr(one, field), getattr(other, field))


def test_rows_beyond_one_task_are_dealt_to_all_cores(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    cores, dealt, plain_passes = spark.sparkContext.defaultParallelism, [], boosting._by_passes

    def passes(state, job, ks):
        dealt.append(state.map(lambda block: len(block[1])).glom().map(sum).collect())
        return plain_passes(state, job, ks)

    monkeypatch.setattr(boosting, "_by_passes", passes)
    settings = Settings(1, depth=2, rate=0.1, row_fraction=1.0, column_fraction=1.0, seed=42)
    fit_trees(rows.coalesce(1), NAMES, "y", settings, task_rows=2900)
    (sizes,) = dealt
    assert len(sizes) == cores > 1 and sum(sizes) == 3000
    assert max(sizes) - min(sizes) <= 100
    # A task that grows all trees alone takes its time by its rows.
    assert boosting.TASK_ROWS <= 1 << 18


def test_only_one_side_of_a_split_is_added_up(rows, monkeypatch):
    asked, plain_grow = [], boosting.Job.grow

    def grow(job, k, summed):
        def noted(tree, level, drawn, wanted):
            asked.append((level, len(wanted)))
            sums = summed(tree, level, drawn, wanted)
            assert level == 0 or 2 * sums[1, 0].sum() <= 3000
            return sums

        return plain_grow(job, k, noted)

    monkeypatch.setattr(boosting.Job, "grow", grow)
    monkeypatch.setattr(boosting, "_in_one_task", boosting._by_passes)
    settings = Settings(2, depth=4, rate=0.1, row_fraction=1.0, column_fraction=1.0, seed=42)
    fit_trees(rows, NAMES, "y", settings)
    assert asked == [(0, 1), (1, 1), (2, 2), (3, 4)] * 2


def test_rows_and_columns_are_drawn_per_tree(rows):
    settings = Settings(40, depth=2, rate=0.1, row_fraction=0.8, column_fraction=0.4, seed=3)
    model = fit_trees(rows, NAMES, "y", settings)
    used = [set(t.feature[t.feature >= 0]) for t in model.trees]
    assert all(len(u) == 1 for u in used) and len(set().union(*used)) == 3
    drawn = [boosting._drawn(settings, k, 3) for k in range(40)]
    assert len({(a, b) for _, a, b in drawn}) == 40
    numbers = np.random.default_rng(1).integers(0, boosting._PRIME, 20_000)
    shares = [((numbers * a + b) % boosting._PRIME < 0.8 * boosting._PRIME).mean() for _, a, b in drawn]
    assert all(abs(s - 0.8) < 0.02 for s in shares)


def test_importance_and_error(rows):
    settings = Settings(60, depth=4, rate=0.1, row_fraction=0.8, column_fraction=0.8, seed=42)
    model = fit_trees(rows, NAMES, "y", settings)
    assert sum(model.importance().values()) == pytest.approx(1.0)
    scored = model.transform(rows, "p")
    error = scored.agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0]
    spread = rows.agg(F.stddev("y")).first()[0]
    assert error < 0.2 * spread


def test_save_and_load(spark, rows, tmp_path):
    settings = Settings(3, depth=2, rate=0.1, row_fraction=0.8, column_fraction=1.0, seed=42)
    model = fit_trees(rows, NAMES, "y", settings)
    model.save(spark, str(tmp_path / "model"))
    again = BoostedTrees.load(spark, str(tmp_path / "model"))
    x = rows.toPandas()[NAMES].to_numpy().T
    np.testing.assert_array_equal(model.predict(x), again.predict(x))
    assert again.importance() == model.importance()


def test_few_rows(spark):
    settings = Settings(2, depth=2, rate=0.1, row_fraction=0.8, column_fraction=0.8, seed=42)
    none = spark.createDataFrame([], "a double, b double, c double, y double")
    one = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], none.schema)
    assert fit_trees(none, NAMES, "y", settings).trees == []
    model = fit_trees(one, NAMES, "y", settings)
    holes = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (None, 2.0, 3.0, 4.0)], none.schema)
    assert [r["p"] for r in model.transform(holes, "p").collect()] == [4.0, None]
