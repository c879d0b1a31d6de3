import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import impute
from tabprep.operators import gap_neighbours
from tabprep.operators.gap_neighbours import GapTree, nearest_per_cell, zero_distance
from tabprep.operators.knn import fit_knn
from tests.conftest import by, rows


def test_median_mean_and_empty_column(make):
    df = make([(1.0, 1, None), (2.0, 2, None), (None, None, None), (10.0, 4, None)], "x double, i int, e double")
    out = impute.fit_median(df, ["x", "i", "e", "absent"]).transform(df)
    assert rows(out) == [(1.0, 1, 0.0), (2.0, 2, 0.0), (2.0, 2, 0.0), (10.0, 4, 0.0)]
    assert dict(out.dtypes) == {"x": "double", "i": "int", "e": "double"}
    mean = impute.fit_mean(df, ["x", "i"], skip=["x"]).transform(df)
    assert [r["i"] for r in mean.collect()] == pytest.approx([1, 2, 7 / 3, 4]) and mean.where("x is null").count() == 1


def test_mode_takes_the_smallest_on_a_tie(make):
    df = make([(3, "b", None, True), (1, "a", None, None), (1, "b", None, False), (3, "a", None, False), (None, None, None, None)],
              "i int, s string, e string, f boolean")
    model = impute.fit_mode(df, ["i", "s", "e", "f", "absent"])
    assert model.values == {"i": 1, "s": "a", "f": False}
    assert tuple(model.transform(df).where("i = 1 and s = 'a' and f = false").select("e").distinct().first()) == (None,)


def test_fitted_values_apply_to_other_rows(make, spark):
    model = impute.fit_median(make([(1.0,), (3.0,)], "x double"), ["x"])
    assert rows(model.transform(make([(None,), (7.0,)], "x double"))) == [(2.0,), (7.0,)]
    assert rows(model.to_table(spark)) == [("x", "median", "2.0")]


def test_report(make):
    df = make([(1.0, None), (None, None)], "a double, b double")
    out = by(impute.imputation_report(df, impute.fit_mean(df, ["a"]).transform(df), ["a", "b"]), "variable")
    assert tuple(out["a"])[1:] == (1, 0, 1) and tuple(out["b"])[1:] == (2, 2, 0)


def brute(fit, new, k):
    """Null-aware nearest-neighbour imputation, every pair looked at."""
    width, out, means = fit.shape[1], new.copy(), [np.nan if np.isnan(c).all() else np.nanmean(c) for c in fit.T]
    for i, row in enumerate(new):
        shared = ~np.isnan(fit) & ~np.isnan(row)
        square = np.zeros(len(fit))
        for j in range(width):
            square += np.where(shared[:, j], (np.nan_to_num(fit[:, j]) - np.nan_to_num(row[j])) ** 2, 0)
        with np.errstate(all="ignore"):
            distance = np.where(shared.any(1), np.sqrt(square * (width / shared.sum(1))), np.nan)
        for c in np.flatnonzero(np.isnan(row)):
            donors = np.flatnonzero(~np.isnan(fit[:, c]) & ~np.isnan(distance))
            if not len(donors):
                out[i, c] = means[c]
                continue
            near = donors[np.lexsort((donors, distance[donors]))][:k]
            d, v = distance[near], fit[near, c]
            out[i, c] = v[d == 0].mean() if (d == 0).any() else (v / d).sum() / (1 / d).sum()
    return out


def frame(spark, values):
    names = "abcdefghijklmnop"[: values.shape[1]]
    data = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(values)]
    return spark.createDataFrame(data, "id long, " + ", ".join(f"{n} double" for n in names)), list(names)


def cells(df, names):
    return np.array([[r[n] for n in names] for r in df.orderBy("id").collect()], dtype=float)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    values = rng.normal(size=(900, 4)).round(1) * np.array([1, 2, 3, 1])
    values[:350] = values[0]  # over a third of the rows share one point
    values[rng.random(values.shape) < np.array([0.05, 0.1, 0.02, 0.15])] = np.nan
    values[5] = np.nan
    return values


@pytest.mark.parametrize("box, chunk", [(2048, 16384), (100, 50), (10, 40)])
def test_neighbours_equal_brute_force(spark, points, box, chunk):
    """One box, one box in chunks, many boxes."""
    df, names = frame(spark, points)
    got = cells(fit_knn(df, names, ["id"], 5, box, chunk).transform(df), names)
    assert got == pytest.approx(brute(points, points, 5), abs=1e-12)


def test_neighbours_do_not_depend_on_partitions(spark, points):
    df, names = frame(spark, points)
    results = [cells(fit_knn(df.repartition(n), names, ["id"], 3, 50, 50).transform(df.repartition(n)), names) for n in (1, 7)]
    assert results[0] == pytest.approx(results[1], abs=1e-12)


def test_fitted_donors_serve_new_rows(spark, points):
    df, names = frame(spark, points)
    new = np.array([[0.1, np.nan, 0.3, np.nan], [np.nan, 1.0, np.nan, np.nan], [1.0, 2.0, 3.0, 4.0], [np.nan] * 4])
    table, _ = frame(spark, new)
    assert cells(fit_knn(df, names, ["id"]).transform(table), names) == pytest.approx(brute(points, new, 5), abs=1e-12)


def test_few_donors_ties_and_empty_columns(spark):
    values = np.array([[1, 10, np.nan], [3, 30, np.nan], [2, np.nan, np.nan], [1, np.nan, np.nan]], dtype=float)
    df, names = frame(spark, values)
    got = cells(fit_knn(df, names, ["id"], 5).transform(df), names)
    # Row 2 has two donors at equal distance; row 3 sits on a donor; the last column has no value anywhere.
    assert got[2, 1] == 20 and got[3, 1] == 10 and np.isnan(got[:, 2]).all()


def test_composite_key_and_no_columns(spark, make):
    df = make([(1, "x", 1.0, None), (1, "y", 1.0, 4.0)], "i int, c string, a double, b double")
    assert [r["b"] for r in fit_knn(df, ["a", "b"], ["i", "c"]).transform(df).collect()] == [4.0, 4.0]
    assert fit_knn(df, ["absent"], ["i"]).transform(df) is df


def test_observed_cells_stay(spark, points):
    df, names = frame(spark, points)
    out = fit_knn(df, names, ["id"]).transform(df)
    both = df.join(out.withColumnsRenamed({n: f"{n}_new" for n in names}), "id")
    assert both.where(" or ".join(f"({n} is not null and {n} <> {n}_new) or {n}_new is null" for n in names)).count() == 0
    assert out.count() == df.count()


def test_plan_keeps_complete_rows_out_of_the_shuffle(spark, points):
    df, names = frame(spark, points)
    plan = fit_knn(df, names, ["id"]).transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "Union" in plan


def test_infinity_free_distance(make):
    df = make([(1, 0.0, 1.0), (2, float("nan"), 5.0)], "id int, a double, b double")
    assert [r["a"] for r in fit_knn(df, ["a", "b"], ["id"]).transform(df).orderBy("id").collect()] == [0.0, 0.0]
    assert df.where(F.isnan("a")).count() == 1


def scattered(rows, width, seed, share=0.3):
    """Correlated columns with nearly as many patterns of gaps as rows."""
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(rows, 3)) @ rng.normal(size=(3, width)) + 0.3 * rng.normal(size=(rows, width))
    values[rng.random(values.shape) < share] = np.nan
    return values


@pytest.mark.parametrize("rows, width, box, chunk", [(300, 8, 2048, 16384), (300, 8, 20, 40), (500, 12, 30, 70), (400, 3, 10, 30)])
def test_many_patterns_equal_brute_force(spark, rows, width, box, chunk):
    values = scattered(rows, width, rows + width)
    if width > 3:
        assert len({tuple(r) for r in np.isnan(values)}) > rows // 3
    df, names = frame(spark, values)
    got = cells(fit_knn(df, names, ["id"], 5, box, chunk).transform(df), names)
    assert got == pytest.approx(brute(values, values, 5), abs=1e-9)


def test_tree_bounds_never_exceed_a_distance():
    values = scattered(900, 6, 3)
    tree = GapTree.build(values, 30, 5)
    assert tree.boxes > 20
    box = tree.locate(values, donors=True)
    queries = scattered(60, 6, 4)
    shared = ~np.isnan(queries)[:, None, :] & ~np.isnan(values)[None, :, :]
    square = np.where(shared, np.nan_to_num(queries)[:, None, :] - np.nan_to_num(values)[None, :, :], 0) ** 2
    with np.errstate(all="ignore"):
        distance = square.sum(axis=2) * 6 / shared.sum(axis=2)
    for radius in (0.0, 0.5, 3.0, np.inf):
        row, met = tree.touched(queries, np.full(60, radius))
        pairs = set(zip(row.tolist(), met.tolist()))
        assert len(pairs) == len(row)
        q, d = np.nonzero((distance <= radius) & shared.any(axis=2))
        assert {(i, box[j]) for i, j in zip(q.tolist(), d.tolist())} <= pairs
    row, _ = tree.touched(queries, np.full(60, 0.05))
    assert len(row) < 60 * tree.boxes  # small radii leave boxes out


def test_ties_and_distant_values_are_settled_exactly():
    # Values far from zero, where a matrix product alone would round, and many donors at one distance.
    donors = np.array([[1e8 + (n % 7), float(n)] for n in range(200)])
    queries = np.array([[1e8 + 3.0, np.nan], [1e8 + 3.5, np.nan]])
    q, cell, d, distance = nearest_per_cell(donors, queries, 4)
    assert d[q == 0].tolist() == [3, 10, 17, 24] and (distance[q == 0] == 0).all() and (cell == 1).all()
    assert d[q == 1].tolist() == [3, 4, 10, 11]


def test_donors_at_distance_zero_settle_a_query():
    donors = np.array([[1, 5, np.nan], [np.nan, 5, 7], [1, np.nan, 8], [2, np.nan, 9], [1, 5, 6], [np.nan, np.nan, 3]])
    queries = np.array([[1, 5, np.nan], [2, np.nan, np.nan], [-0.0, np.nan, np.nan], [1, 2, 3]])
    q, cell, d = zero_distance(donors, queries, 2)
    # Donors 1, 2 and 4 agree with query 0 on what both know; query 1 has one donor only, and none for its second column.
    assert list(zip(q.tolist(), cell.tolist(), d.tolist())) == [(0, 2, 1), (0, 2, 2)]
    q, cell, d = zero_distance(np.array([[0.0, 4.0], [np.inf, 5.0]]), np.array([[-0.0, np.nan], [np.inf, np.nan]]), 1)
    assert (q.tolist(), cell.tolist(), d.tolist()) == ([0], [1], [0])


def grid_points(rows, width, seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 4, (rows, width)).astype(float)
    values[:, -1] = rng.normal(size=rows).round(2)
    values[rng.random(values.shape) < 0.35] = np.nan
    return values


def test_few_queries_reach_the_boxes_where_values_repeat(spark, monkeypatch):
    values = grid_points(600, 5, 8)
    df, names = frame(spark, values)
    asked = []
    near = gap_neighbours._near
    monkeypatch.setattr(gap_neighbours, "_near", lambda *args: asked.append(args[4]) or near(*args))
    got = cells(fit_knn(df, names, ["id"], 3, 10, 40).transform(df), names)
    assert got == pytest.approx(brute(values, values, 3), abs=1e-9)
    assert sum(asked) < 150


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_frequent_patterns_have_trees_of_their_own(spark, scale):
    """One axis far wider than the others, and donors that share only narrow axes with the queries."""
    rng = np.random.default_rng(4)
    values = rng.normal(size=(700, 4)) * np.array([5.0, 0.01, 0.02, scale])
    kind = rng.integers(0, 5, 700)
    for n, missing in enumerate(([0], [3], [2, 3], [0, 3], [])):
        values[np.ix_(kind == n, missing)] = np.nan
    df, names = frame(spark, values)
    got = cells(fit_knn(df, names, ["id"], 5, 10, 40).transform(df), names)
    want = brute(values, values, 5)
    assert np.abs((got - want) / np.array([5.0, 0.01, 0.02, scale])).max() < 1e-6


def test_own_trees_split_only_axes_that_their_queries_know(spark):
    rng = np.random.default_rng(6)
    values = rng.normal(size=(800, 3)) * np.array([100.0, 1.0, 1.0])
    df, names = frame(spark, values)
    tree = gap_neighbours._plan(df.withColumnRenamed("id", "key"), names, "key", 800, 800, 5, 10, ["b", "c"])
    assert tree.boxes > 20 and set(tree.axis.tolist()) == {-1, 1, 2}


def test_few_queries_that_know_one_axis_have_a_tree_of_their_own(spark, monkeypatch):
    """In the shared tree, whose splits they mostly do not know, each would look in nearly every box."""
    rng = np.random.default_rng(9)
    values = rng.normal(size=(700, 4)) * np.array([5.0, 4.0, 0.5, 3.0])
    values[:200, 0] = np.nan
    values[200:220, [0, 1, 3]] = np.nan
    df, names = frame(spark, values)
    searched = []
    near = gap_neighbours._near
    monkeypatch.setattr(gap_neighbours, "_near", lambda *args: searched.append((args[4], args[7])) or near(*args))
    got = cells(fit_knn(df, names, ["id"], 5, 10, 160).transform(df), names)
    assert got == pytest.approx(brute(values, values, 5), abs=1e-9)
    assert sorted(searched) == [(20, ["v__2"]), (200, ["v__1", "v__2", "v__3"])]


def test_boxes_that_a_pattern_reaches():
    # Axis 0 is split first, its known halves by axis 1.
    tree = GapTree(np.array([0, 1, 1, -1, -1, -1, -1, -1, -1, -1]), np.zeros(10), np.array([1, 4, 7, 0, 0, 0, 0, 0, 0, 0]))
    assert tree.boxes == 7 and tree.reached([False, False]) == 7
    assert tree.reached([True, False]) == 4 and tree.reached([False, True]) == 5 and tree.reached([True, True]) == 3
