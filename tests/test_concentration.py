"""Concentration statistics against their array definitions."""

from __future__ import annotations

import numpy as np
import pytest

from cartmill.operators import concentration as con

VALUES = {
    "few": [5.0, 1.0, 3.0],
    "many": [float(v) for v in np.random.default_rng(3).pareto(1.5, 37) * 100 + 1],
    "equal": [2.0] * 12,
}


@pytest.fixture(scope="module")
def frame(spark):
    data = [(g, i, v) for g, vs in VALUES.items() for i, v in enumerate(vs)]
    data += [("few", 98, float("nan")), ("few", 99, None)]
    return spark.createDataFrame(data, "g string, k int, v double")


def lorenz(values):
    v = np.sort(np.asarray(values))
    return np.insert(np.arange(1, len(v) + 1) / len(v), 0, 0), np.insert(np.cumsum(v) / v.sum(), 0, 0)


def area_gini(values):
    x, y = lorenz(values)
    return 1 - 2 * float(np.trapezoid(y, x))


def top(values, k):
    v = np.sort(values)[::-1]
    return v[:k].sum() / v.sum()


def test_summary(frame):
    got = {r.g: r for r in con.concentration_summary(frame, "v", "k", ["g"]).collect()}
    for g, vs in VALUES.items():
        n = len(vs)
        assert got[g].n_entities == n
        assert got[g].gini == pytest.approx(area_gini(vs), abs=1e-9)
        assert got[g].hhi == pytest.approx(float(((np.array(vs) / sum(vs)) ** 2).sum() * 10_000))
        assert got[g].top_20pct_share == pytest.approx(top(vs, max(1, int(np.ceil(n * 0.2)))))
        for k in (4, 10):
            want = top(vs, k) if n >= k else None
            assert got[g][f"cr{k}"] == (pytest.approx(want) if want is not None else None)


def test_lorenz_curve(frame):
    points = con.lorenz_curve(frame.filter("g = 'many'"), "v", "k").orderBy("x").collect()
    x, y = lorenz(VALUES["many"])
    assert [p.x for p in points] == pytest.approx(list(x))
    assert [p.y for p in points] == pytest.approx(list(y))


def test_pareto_and_share_reaching(frame):
    curve = con.pareto_curve(frame.filter("g = 'many'"), "v", "k")
    vs = np.sort(VALUES["many"])[::-1]
    want = 100 * np.cumsum(vs) / vs.sum()
    assert [r.cum_value_pct for r in curve.orderBy("rank").collect()] == pytest.approx(list(want))
    first = int(np.argmax(want >= 80)) + 1
    assert con.share_reaching(curve).first().entity_pct == pytest.approx(100 * first / len(vs))


def test_rounding_modes_and_minimum(frame):
    many = frame.filter("g = 'many'")
    floor = con.concentration_summary(many, "v", "k", rounding="floor").first()
    assert floor.top_20pct_share == pytest.approx(top(VALUES["many"], 7))
    assert con.concentration_summary(frame, "v", "k", ["g"], min_entities=12).count() == 2
    with pytest.raises(ValueError):
        con.concentration_summary(many, "v", "k", rounding="up")


def test_zero_total_gives_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "k int, v double")
    row = con.concentration_summary(df, "v", "k").first()
    assert (row.gini, row.hhi, row.n_entities) == (None, None, 2)


def test_diversification(frame):
    label = {r.g: r.market for r in con.diversification(con.concentration_summary(frame, "v", "k", ["g"])).collect()}
    assert label["equal"] == "diversified" and label["few"] == "concentrated"


def test_top_share_and_hhi(frame):
    assert {r.g: r.cr10 for r in con.top_share(frame, "v", "k", 10, ["g"]).collect()}["few"] is None
    assert {r.g: r.hhi for r in con.hhi(frame, "v", ["g"]).collect()}["equal"] == pytest.approx(10_000 / 12)
    assert {r.g: r.gini for r in con.gini(frame, "v", "k", ["g"]).collect()}["equal"] == pytest.approx(0)
