from __future__ import annotations

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartmill.llm import posting

SMALL = posting.Settings(list_rows=40, part_rows=30, query_rows=20, tested_queries=64, target=0.95)
EXACT = posting.Settings(list_rows=10**9)
SCHEMA = "vec_id long, embedding array<float>, id string, vec int, lists int, key int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0, 0, 0) for i, v in rows], SCHEMA)


def brute(rows, k):
    """{query: [(score, id)]} by comparing every row."""
    seen = sorted({(i, tuple(np.float32(c).item() for c in v)) for i, v in rows})
    out = {}
    for i, v in seen:
        if i % 20 == 0:
            found = [(sum_in_order(v, w), j) for j, w in seen if j != i]
            out[i] = sorted(found, key=lambda p: (-p[0], p[1]))[:k]
    return out


def sum_in_order(v, w):
    total = 0.0
    for a, b in zip(v, w, strict=True):
        total += a * b
    return total


def answers(df, k, settings):
    out = {}
    for r in sorted(posting.nearest(df, F.col("id") % 20 == 0, k, settings=settings).collect(), key=lambda r: (r["query_id"], r["rank"])):
        hits = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(hits) + 1
        hits.append((r["score"], r["id"]))
    return out


def cloud(n, size, seed, groups=8, spread=0.4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, size))
    return centers[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, size))


def recall(got, want):
    return sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_one_list_is_exact_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, size=4).astype(float).tolist()) for i in range(300)]
    rows = [(i, v if any(v) else [1.0, 0.0, 0.0, 0.0]) for i, v in rows]
    assert answers(table(spark, rows), 7, EXACT) == brute(rows, 7)


@pytest.mark.parametrize("norms", ["equal", "different"])
def test_recall_and_scores(spark, norms):
    x = cloud(900, 12, 5)
    if norms == "equal":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got, want = answers(table(spark, rows), 10, SMALL), brute(rows, 10)
    assert set(got) == set(want) and all(len(h) == 10 for h in got.values())
    assert recall(got, want) >= 0.9
    by_id = {i: tuple(np.float32(c).item() for c in v) for i, v in rows}
    assert all(s == sum_in_order(by_id[q], by_id[i]) for q, hits in got.items() for s, i in hits)
    assert all(h == sorted(h, key=lambda p: (-p[0], p[1])) for h in got.values())


def test_third_of_all_rows_equal(spark):
    x = cloud(400, 6, 9)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(i, x[3].tolist()) for i in range(400, 600)]
    got, want = answers(table(spark, rows), 20, SMALL), brute(rows, 20)
    assert len(got) == 30 and recall(got, want) >= 0.9
    # the copies' queries find the copies with the smallest ids, never themselves
    assert got[400] == want[400] and got[500] == want[500]
    assert 400 not in {i for _, i in got[400]}


def test_awkward_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [0.0, 0.0]), (40, [-1.0, 0.0]), (None, [1.0, 1.0]),
    ]
    got = answers(table(spark, rows), 20, SMALL)
    assert got == {0: [(0.5, 1), (-1.0, 40)], 40: [(-0.5, 1), (-1.0, 0)]}
    assert answers(table(spark, []), 20, SMALL) == {}
    assert answers(table(spark, [(1, [1.0, 0.0])]), 20, SMALL) == {}
    assert answers(table(spark, [(20, [1.0, 0.0])]), 20, SMALL) == {}


def test_doubles(spark):
    df = spark.createDataFrame([(0, [0.1, 0.2]), (1, [0.3, 0.4])], "vec_id long, embedding array<double>")
    assert answers(df, 3, SMALL) == {0: [(0.1 * 0.3 + 0.2 * 0.4, 1)]}


def test_graph_reaches_every_centroid():
    x = posting.lifted(cloud(500, 5, 1, groups=40, spread=0.01), 20.0)
    graph = posting.CentroidGraph(posting.balanced_means(x, 60), 20.0)
    ids, distance = graph.search(x[:50], 60)
    assert all(sorted(row) == list(range(60)) for row in ids.tolist())
    assert (np.diff(distance, axis=1) >= 0).all()
    # a narrow beam finds nearly always the nearest centroid
    near = graph.search(x, 8)[0][:, 0]
    squares = (graph.centroids**2).sum(1)
    assert (near == (squares - 2 * x @ graph.centroids.T).argmin(1)).mean() > 0.97


def test_balanced_sizes():
    x = cloud(4000, 8, 3)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centroids = posting.balanced_means(x, 32)
    sizes = np.bincount((x @ centroids.T).argmax(1), minlength=32)
    assert sizes.min() > 0 and sizes.max() < 4 * 4000 / 32


def test_boundary_vectors_are_replicated():
    centroids = np.array([[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [-1.0, 0.0, 0.0]])
    graph = posting.CentroidGraph(centroids, 1.0)
    homes = graph.homes(np.array([[1.0, 0.0], [0.71, 0.704]]), 3, 1.2)
    assert homes.tolist() == [[0, -1, -1], [0, 1, -1]]


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e25])
@pytest.mark.parametrize("n", [5, 700, 5000])
def test_candidates_hold_the_nearest(n, scale):
    """No product needed is lost to single precision or to the groups, and few others are looked at."""
    rng = np.random.default_rng(n)
    vectors, x = rng.normal(size=(n, 16)) * scale, rng.normal(size=(40, 16)) * scale
    vectors[: n // 3] = vectors[0]  # ties
    vectors[-1] *= 1e-3
    with np.errstate(over="ignore"):
        fast = vectors.astype(np.float32)
    row, near = posting._candidates(x, vectors, fast, np.sqrt((vectors**2).sum(1).max()), 10)
    scores = np.stack([posting._dots(np.repeat(x[i : i + 1], n, 0), vectors) for i in range(40)])
    found = np.zeros(scores.shape, bool)
    found[row, near] = True
    needed = scores >= np.sort(scores, axis=1)[:, ::-1][:, min(9, n - 1)][:, None]
    assert (found | ~needed).all()
    other = found.copy()
    other[:, : n // 3] = False
    assert other.sum(axis=1).mean() <= min(n, 60)


def test_beam_reads_few_centroids_rightly():
    """The search's distances are those of the centroids it names, nearest first, none twice, for beams of any width."""
    x = posting.lifted(cloud(3000, 8, 4, groups=60, spread=0.2), 30.0)
    graph = posting.CentroidGraph(posting.balanced_means(x, 200), 30.0)
    for width in (1, 16, 90, 200, 500):
        ids, distance = graph.search(x[:300], width)
        assert ids.shape == distance.shape == (300, min(width, 200))
        for i, (row, far) in enumerate(zip(ids, distance, strict=True)):
            real = row >= 0
            assert len(set(row[real])) == real.sum() and (np.diff(far) >= 0).all() and np.isinf(far[~real]).all()
            assert np.abs(far[real] - np.linalg.norm(graph.centroids[row[real]] - x[i], axis=1)).max() < 1e-6
    true = ((graph.centroids[None] - x[:300, None]) ** 2).sum(2).argmin(1)
    assert (graph.search(x[:300], 16)[0][:, 0] == true).mean() > 0.97


def test_answers_of_many_lists_are_merged_in_time(spark):
    """Pairs of one query from thousands of lists, each found in several: work grows with their number, not its square."""
    score = "(pmod(xxhash64(id), 1000) / 8.0D) score, id"
    near = spark.sql(f"SELECT key, collect_list(struct({score})) near FROM (SELECT id % 2 key, id div 4 id FROM range(400000)) GROUP BY key, id % 5000")
    pairs = spark.sql(f"SELECT DISTINCT {score} FROM (SELECT id div 4 id FROM range(400000))").collect()
    want = [(-s, i) for s, i in sorted(((r["score"], r["id"]) for r in pairs), key=lambda p: (-p[0], p[1]))[:21]]
    began = time.monotonic()
    got = posting._merged(near, 21).collect()
    assert time.monotonic() - began < 40
    assert [[tuple(p) for p in r["near"]] for r in got] == [want, want]
    few = spark.sql("SELECT 1L key, array(struct(0.5D score, 3L id), struct(0.5D score, 1L id), struct(0.5D score, 3L id)) near")
    assert [tuple(p) for p in posting._merged(few, 21).first()["near"]] == [(-0.5, 1), (-0.5, 3)]
