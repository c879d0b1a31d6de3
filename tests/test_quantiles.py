import numpy as np
import pytest

from tabprep.functions.quantiles import approximate_quantiles, exact_quantiles, median_of

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]
BRACKETED = {"one_task_bytes": 0, "one_task_rows": 0}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 6000
    group = rng.choice(["a", "b", "c"], n, p=[0.9, 0.09, 0.01])
    spread = rng.exponential(50, n)
    tied = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 20, n))  # one value holds over a third of the rows
    gaps = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
    rows = [(str(g), float(s), float(t), None if np.isnan(x) else float(x), None) for g, s, t, x in zip(group, spread, tied, gaps)]
    return spark.createDataFrame(rows, "g string, spread double, tied double, gaps double, empty double"), group, {
        "spread": spread, "tied": tied, "gaps": gaps}


@pytest.mark.parametrize("options", [{"one_task_bytes": 1 << 62}, {**BRACKETED, "accuracy": 100}, {**BRACKETED, "accuracy": 1000}, BRACKETED])
def test_against_numpy(data, options):
    df, _, columns = data
    found = {r["variable"]: r["q"] for r in exact_quantiles(df, [*columns, "empty"], PROBS, **options).collect()}
    assert found.pop("empty") is None
    for name, q in found.items():
        assert q == pytest.approx(list(np.nanquantile(columns[name], PROBS)), abs=1e-9)


def test_missed_brackets_are_widened(data, monkeypatch):
    monkeypatch.setattr("tabprep.functions.quantiles.BRACKET_MARGIN", 1e-3)
    df, group, columns = data
    found = {(r["g"], r["variable"]): r["q"] for r in exact_quantiles(
        df, list(columns), PROBS, by=["g"], **{**BRACKETED, "accuracy": 20}).collect()}
    for (g, name), q in found.items():
        assert q == pytest.approx(list(np.nanquantile(columns[name][group == g], PROBS)), abs=1e-9)


@pytest.mark.parametrize("options", [{"one_task_bytes": 1 << 62}, {**BRACKETED, "accuracy": 100}, {}])
def test_groups(data, options):
    df, group, columns = data
    found = {(r["g"], r["variable"]): r["q"] for r in exact_quantiles(df, list(columns), [0.25, 0.5], by=["g"], **options).collect()}
    assert len(found) == 9
    for (g, name), q in found.items():
        assert q == pytest.approx(list(np.nanquantile(columns[name][group == g], [0.25, 0.5])), abs=1e-9)


@pytest.mark.parametrize("options", [{}, BRACKETED, {**BRACKETED, "accuracy": 2}])
def test_tiny_inputs(make, options):
    assert median_of(make([(3.0,)], "x double"), ["x"], **options).first()["median"] == 3.0
    assert median_of(make([(1.0,), (2.0,), (3.0,), (10.0,)], "x double"), ["x"], **options).first()["median"] == 2.5
    assert median_of(make([], "x double"), ["x"], **options).first()["median"] is None
    assert median_of(make([(None,)], "x double"), ["x"], **options).first()["median"] is None


def test_approximate(data):
    df, _, columns = data
    found = approximate_quantiles(df, ["spread"], [0.5]).first()["q"][0]
    assert abs((columns["spread"] <= found).mean() - 0.5) < 0.001
