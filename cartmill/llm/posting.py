"""Nearest neighbours by inner product, through balanced posting lists.

Vectors are shortened to one row per distinct vector with its ``k`` + 1 smallest ids: of equal vectors, which have equal
scores, no more can be among a query's ``k`` nearest. Inner product becomes distance by one more component that brings
every vector to the largest norm found. Centroids are fitted by balanced means (a cluster's distances count more as it
grows) on a bounded sample; every vector is indexed.

* The centroids are searched by a graph held in memory: best-first, with a beam, from fixed entries.
* A vector near a boundary is replicated: it goes to each of its nearest lists within ``boundary`` times the least
  distance, at most ``replicas``, but not to a list whose centroid is nearer to one chosen before than to the vector.
* A query goes to all lists whose centroid lies within a ratio of the least distance. The ratio, and with it the width of
  the beam, is the least at which a sample of queries, compared with every vector, would find the share ``target`` of its
  nearest. Data without clusters therefore cost more lists, not recall.
* Lists are dealt to tasks in parts of bounded size, and a list asked by very many queries also by queries. A task
  holds one part, then streams its queries past it. Scores are sums of products in double precision, in order of the
  components, of the original vectors.

Bounds: the sample for fitting (``sample_rows``), for the ratio (``tested_queries``) and the number of lists
(``max_lists``). Nothing caps candidates: every vector of a list searched is compared.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without an id; where vectors differ in length only those of the most frequent length (the longest of several) take part.
Rows with the same id and vector count once; a query never finds a row with its own id. An empty table, or one without
queries, gives an empty result. Only the two columns named are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm.common import field, release, stored

_DEGREE, _EXPAND, _BLOCK = 16, 4, 256


@dataclass(frozen=True)
class Settings:
    list_rows: int = 1024  # vectors for each centroid, while there are no more than max_lists
    max_lists: int = 1024
    sample_rows: int = 32_768
    part_rows: int = 16_384  # vectors of a list that one task holds
    query_rows: int = 100_000  # queries that one task streams past a part
    replicas: int = 4
    boundary: float = 1.1
    tested_queries: int = 256
    target: float = 0.97


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def balanced_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """``k`` centroids of the rows of ``x``, which are of equal norm; a cluster repels rows as it holds more than its share."""
    rng = np.random.default_rng(seed)
    centroids, radius = x[rng.choice(len(x), k, replace=False)], np.sqrt(_squares(x[:1])[0])
    size = np.full(k, len(x) / k)
    for _ in range(rounds):
        factor = np.maximum(size * k / len(x), 0.1) ** 0.1
        near = np.empty(len(x), np.int64)
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            distance = np.maximum(_squares(part)[:, None] + _squares(centroids) - 2 * part @ centroids.T, 0)
            near[a : a + 4096] = (distance * factor).argmin(1)
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        empty = _squares(sums) < 1e-12 * radius**2
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        centroids = sums * (radius / np.sqrt(_squares(sums)))[:, None]
        size = (size + count) / 2
    return centroids


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with the component that makes the largest inner product the least distance."""
    return np.column_stack([x, np.sqrt(np.maximum(largest**2 - _squares(x), 0))])


class CentroidGraph:
    """Centroids, each linked to near ones in different directions, so that any of them is reached from the entries."""

    def __init__(self, centroids: np.ndarray, largest: float):
        self.centroids, self.largest = centroids, largest
        k = len(centroids)
        self.squares = _squares(centroids)
        distance = np.maximum(self.squares[:, None] + self.squares - 2 * centroids @ centroids.T, 0)
        self.between = np.sqrt(distance)
        self.entries = np.arange(0, k, max(1, k // 16))
        links = []
        for node in range(k):
            chosen: list[int] = []
            near = [int(c) for c in np.argsort(distance[node], kind="stable")[: 8 * _DEGREE] if c != node]
            for c in near:
                if len(chosen) < _DEGREE and (distance[c, chosen] > distance[node, c]).all():
                    chosen.append(c)
            chosen += [c for c in near if c not in chosen][: _DEGREE // 2 - len(chosen)]
            links.append(chosen)
        for node in range(k):  # links lead both ways
            for c in links[node]:
                if node not in links[c] and len(links[c]) < 2 * _DEGREE:
                    links[c].append(node)
        reached = set(self.entries.tolist())
        waiting = list(reached)
        for node in [*waiting, *range(k)]:
            if node not in reached:
                nearest = min(reached, key=lambda r: distance[node, r])
                links[nearest].append(node)
                reached.add(node)
                waiting = [node]
            while waiting:
                for c in links[waiting.pop()]:
                    if c not in reached:
                        reached.add(c)
                        waiting.append(c)
        self.links = np.full((k, max(1, max(map(len, links)))), -1)
        for node, chosen in enumerate(links):
            self.links[node, : len(chosen)] = chosen

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Queries as ``lifted`` places vectors; their length does not count, so they get the largest norm and lie flat."""
        return np.column_stack([x * (self.largest / np.sqrt(_squares(x)))[:, None], np.zeros(len(x))])

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids that a best-first search finds for each row, and their distances."""
        width = min(width, len(self.centroids))
        lists, distances = [], []
        for a in range(0, len(x), _BLOCK):
            ids, found = self._beam(x[a : a + _BLOCK], width)
            lists.append(ids)
            distances.append(found)
        if not lists:
            return np.empty((0, width), np.int64), np.empty((0, width))
        return np.concatenate(lists), np.sqrt(np.maximum(np.concatenate(distances), 0))

    def _beam(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(x), len(self.centroids)
        beam = max(width, len(self.entries))
        expand = max(_EXPAND, beam // 16)  # of a wide beam more at once
        # there are no more than max_lists centroids: one product costs less than gathering those that are reached
        table = _squares(x)[:, None] + self.squares - 2 * x @ self.centroids.T
        table = np.column_stack([table, np.full(n, np.inf)])  # for places without a centroid, numbered k
        links = np.where(self.links < 0, k, self.links)
        links = np.concatenate([links, np.full((1, links.shape[1]), k)])
        seen = np.zeros((n, k + 1), bool)
        seen[:, k] = True
        seen[:, self.entries] = True
        ids = np.full((n, beam), k)
        ids[:, : len(self.entries)] = self.entries
        distance = np.take_along_axis(table, ids, 1)
        waiting = distance.copy()  # infinite where a centroid's links have been followed
        rows = np.arange(n)
        while len(rows):
            own = waiting[rows]
            pick = np.argpartition(own, min(expand, beam) - 1, axis=1)[:, :expand]
            near_to = np.where(np.isfinite(np.take_along_axis(own, pick, 1)), np.take_along_axis(ids[rows], pick, 1), k)
            going = np.flatnonzero((near_to < k).any(axis=1))
            rows, own, pick, near_to = rows[going], own[going], pick[going], near_to[going]
            if not len(rows):
                break
            np.put_along_axis(own, pick, np.inf, 1)
            fresh = np.zeros((len(rows), k + 1), bool)
            at = np.arange(len(rows))[:, None]
            for j in range(near_to.shape[1]):
                fresh[at, links[near_to[:, j]]] = True
            fresh &= ~seen[rows]
            seen[rows] |= fresh
            at, c = np.nonzero(fresh)
            counts = np.bincount(at, minlength=len(rows))
            near = np.full((len(rows), max(1, counts.max())), k)
            near[at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)] = c
            found = table[rows[:, None], near]
            all_found = np.concatenate([distance[rows], found], axis=1)
            best = np.argpartition(all_found, beam - 1, axis=1)[:, :beam]
            distance[rows] = np.take_along_axis(all_found, best, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], axis=1), best, 1)
            waiting[rows] = np.take_along_axis(np.concatenate([own, found], axis=1), best, 1)
        ids = np.where(ids < k, ids, -1)
        order = np.lexsort((ids, distance), axis=1)[:, :width]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(distance, order, 1)

    def within(self, x: np.ndarray, limit: float, width: int, sizes: np.ndarray, least: int) -> np.ndarray:
        """Lists whose centroid lies within ``limit`` times the least distance from each query, then -1.

        Further lists follow until they hold ``least`` vectors; ``sizes`` has those of every list.
        """
        ids, distance = self.search(self.lifted(x), width)
        held = np.where(ids >= 0, sizes[ids], 0)
        short = np.cumsum(held, axis=1) - held < least
        out = np.where(short | (distance <= limit * np.maximum(distance[:, :1], 1e-12)), ids, -1)
        full = np.flatnonzero(out[:, -1] >= 0)
        if len(full) and out.shape[1] < len(self.centroids):  # the beam was too narrow to see where the ratio ends
            wider = self.within(x[full], limit, 2 * width, sizes, least)
            out = np.column_stack([out, np.full((len(out), wider.shape[1] - out.shape[1]), -1)])
            out[full] = wider
        return out

    def homes(self, x: np.ndarray, replicas: int, boundary: float) -> np.ndarray:
        """Lists that hold each vector, -1 where there are fewer than ``replicas``."""
        ids, distance = self.search(lifted(x, self.largest), 4 * replicas)
        out = np.full((len(x), replicas), -1)
        out[:, 0] = ids[:, 0]
        held = np.ones(len(x), np.int64)
        for j in range(1, ids.shape[1]):
            near = (ids[:, j] >= 0) & (distance[:, j] <= boundary * distance[:, 0]) & (held < replicas)
            for i in range(replicas):
                chosen = out[:, i]
                near &= (chosen < 0) | (self.between[np.maximum(chosen, 0), np.maximum(ids[:, j], 0)] > distance[:, j])
            at = np.flatnonzero(near)
            out[at, held[at]] = ids[at, j]
            held[at] += 1
        return out


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, added in order of the components."""
    return np.cumsum(x * y, axis=1)[:, -1]


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, vectors as floats if they come so, or else as doubles."""
    column = field(df, vec_col)
    vec = F.col(f"`{column.name}`")
    if not isinstance(column.dataType.elementType, T.FloatType):
        vec = vec.cast("array<double>")
    rows = df.select(F.col(f"`{field(df, id_col).name}`").cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    rows = rows.filter(F.col("id").isNotNull() & finite & F.exists("vec", lambda v: v != 0))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.filter(F.size("vec") == (length[0]["n"] if length else 0))


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, ids): each distinct vector with its ``keep`` smallest ids."""
    by_vector = Window.partitionBy("vec").orderBy("id")  # limited in each task before the shuffle
    ranked = rows.withColumn("n", F.dense_rank().over(by_vector)).filter(F.col("n") <= keep)
    return ranked.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def _scan(vectors: DataFrame, queries: np.ndarray, keep: int) -> DataFrame:
    """(query, score, vec): each task's nearest distinct vectors of a bounded set of queries."""
    size = queries.shape[1]
    kind = vectors.schema["vec"].dataType
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("vec", kind)])

    def run(batches):
        best = np.full((len(queries), 0), -np.inf)
        kept = np.empty((len(queries), 0, size))
        for batch in batches:
            x = _matrix(batch.column(0), size)
            for a in range(0, len(x), 4096):
                part = x[a : a + 4096]
                scores = np.concatenate([best, queries @ part.T], axis=1)
                most = min(keep, scores.shape[1])
                top = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                n = best.shape[1]
                rows = np.empty((len(queries), top.shape[1], size))
                for i in range(len(queries)):
                    old = top[i] < n
                    rows[i, old], rows[i, ~old] = kept[i, top[i, old]], part[top[i, ~old] - n]
                best, kept = np.take_along_axis(scores, top, 1), rows
        if best.shape[1]:
            query = np.repeat(np.arange(len(queries)), best.shape[1])
            flat = kept.reshape(-1)
            value = pa.float32() if isinstance(kind.elementType, T.FloatType) else pa.float64()
            offsets = pa.array(np.arange(0, len(flat) + 1, size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(best.reshape(-1)), pa.ListArray.from_arrays(offsets, pa.array(flat).cast(value))],
                names=["query", "score", "vec"],
            )
        release()

    return vectors.select("vec").mapInArrow(run, schema)


def calibrated(graph: CentroidGraph, vectors: DataFrame, queries: np.ndarray, k: int, settings: Settings) -> tuple[float, int]:
    """Ratio of distances up to which lists are searched and the beam's width, for the recall aimed at."""
    lists = len(graph.centroids)
    if lists == 1 or not len(queries):
        return 1.0, lists
    by_query = Window.partitionBy("query").orderBy(F.desc("score"))
    nearest = _scan(vectors, queries, k + 1).withColumn("n", F.row_number().over(by_query)).filter(F.col("n") <= k + 1)
    found = nearest.select("query", "vec").collect()
    asked = np.array([r["query"] for r in found])
    x = np.array([r["vec"] for r in found], np.float64)
    other = (x != queries[asked]).any(axis=1)
    asked, x = asked[other], x[other]
    if not len(x):
        return 1.0, lists
    homes = graph.homes(x, settings.replicas, settings.boundary)
    width = min(lists, 32)
    while True:
        ids, distance = graph.search(graph.lifted(queries), width)
        ratio = distance / np.maximum(distance[:, :1], 1e-12)
        place = np.full((len(queries), lists), np.inf)
        np.put_along_axis(place, np.maximum(ids, 0), np.where(ids < 0, np.inf, ratio), 1)
        needed = np.where(homes < 0, np.inf, place[asked[:, None], np.maximum(homes, 0)]).min(axis=1)
        limit = float(np.sort(needed)[max(0, ceil(settings.target * len(needed)) - 1)])
        if np.isfinite(limit) or width == lists:
            # a wider beam than any tested query used; the search ends when nothing nearer is left
            used = int((ratio <= limit).sum(axis=1).max())
            return limit * (1 + 1e-9), min(lists, max(32, used + used // 4))
        width = min(lists, 2 * width)


def _assigned(rows: DataFrame, graph: CentroidGraph, lists, size: int) -> DataFrame:
    """``rows`` with the array ``lists`` that ``lists`` (a function of a matrix of vectors) gives for their ``vec``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*rows.schema.fields, T.StructField("lists", T.ArrayType(T.IntegerType()))])
    target = to_arrow_schema(schema)
    at = rows.columns.index("vec")

    def run(batches):
        for batch in batches:
            found = lists(graph, _matrix(batch.column(at), size))
            kept = found >= 0
            offsets = np.append(0, np.cumsum(kept.sum(axis=1)))
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found[kept], pa.int32()))
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, target, strict=False)], column], schema=target)
        release()

    return rows.mapInArrow(run, schema)


def _sizes(rows: DataFrame, lists: int) -> np.ndarray:
    """Rows of each list; there are no more lists than ``max_lists``."""
    counts = rows.select(F.explode("lists").alias("list")).groupBy("list").count().collect()
    out = np.zeros(lists, np.int64)
    for r in counts:
        out[r["list"]] = r["count"]
    return out


def _parts(sizes: np.ndarray, most: int, key: str) -> Column:
    """Parts of the list in column ``key``, so that none has more than about ``most`` rows."""
    several = {i: ceil(n / most) for i, n in enumerate(sizes.tolist()) if n > most}
    if not several:
        return F.lit(1)
    return F.coalesce(F.create_map(*[F.lit(v) for pair in several.items() for v in pair])[F.col(key)], F.lit(1))


def _candidates(x: np.ndarray, vectors: np.ndarray, fast: np.ndarray, longest: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, vector) of all pairs that a fast product cannot tell from a row's ``k`` largest inner products.

    ``fast`` holds the vectors in single precision, in which products are found where they stay within its range;
    ``longest`` is the largest norm among them.
    """
    lengths, n = np.sqrt(_squares(x)), len(vectors)
    if 1e-12 < longest < 1e12 and 1e-12 < lengths.min() and lengths.max() < 1e12:
        scores = x.astype(np.float32) @ fast.T
    else:
        scores = x @ vectors.T
    # twice what rounding of the factors, products and sums can make of a score
    reach = 2 * (x.shape[1] + 4) * np.finfo(scores.dtype).eps * longest * lengths
    groups = n // 32
    if groups >= 2 * k:  # the k-th largest of the groups' largest has k scores at or above it
        tops = scores[:, : 32 * groups].reshape(len(x), 32, groups).max(axis=1)
    else:
        tops = scores
    at = max(0, tops.shape[1] - k)
    last = np.partition(tops, at, axis=1)[:, at]
    # rounded towards less, as scores may be in single precision
    low = np.nextafter((last - reach).astype(scores.dtype), scores.dtype.type(-np.inf))
    return np.nonzero(scores >= low[:, None])


def _searched(dealt: DataFrame, k: int, size: int) -> DataFrame:
    """(key, near): the nearest (score, id) of each query in each part of a list, parts standing before their queries."""
    pair = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("id", T.LongType())])
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("near", T.ArrayType(pair))])
    arrow_pair = pa.struct([("score", pa.float64()), ("id", pa.int64())])

    def answers(keys, queries, vectors, fast, longest, ids, offsets):
        for a in range(0, len(keys), 256):
            x = queries[a : a + 256]
            row, near = _candidates(x, vectors, fast, longest, k)
            exact = _dots(x[row], vectors[near])
            copies = offsets[near + 1] - offsets[near]
            row, score = np.repeat(row, copies), np.repeat(exact, copies)
            which = ids[np.repeat(offsets[near] - np.cumsum(copies) + copies, copies) + np.arange(len(row))]
            order = np.lexsort((which, -score, row))
            row, score, which = row[order], score[order], which[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, score, which = row[place < k], score[place < k], which[place < k]
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(x))))
            pairs = pa.StructArray.from_arrays(
                [pa.array(score), pa.array(which)], fields=list(arrow_pair)
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[a : a + 256]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], names=["key", "near"]
            )

    def run(batches):
        # (list, part, share, key, vec, ids) by list, part and share, the list's vectors (no key) first
        current, vectors, ids, ready = None, [], [], None
        for batch in batches:
            place = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            asks = np.asarray(batch.column(3).is_valid())
            x = _matrix(batch.column(4), size)
            keys = batch.column(3).fill_null(0).to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1) | (asks[1:] != asks[:-1])))
            for a, z in zip(change, np.append(change[1:], len(place)), strict=True):
                if current != tuple(place[a]):
                    current, vectors, ids, ready = tuple(place[a]), [], [], None
                if not asks[a]:
                    vectors.append(x[a:z])
                    ids.append(batch.column(5).slice(a, z - a))
                    continue
                if ready is None and vectors:
                    lists = pa.chunked_array(ids).combine_chunks()
                    lengths = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
                    held = np.concatenate(vectors)
                    ready = (held, held.astype(np.float32), np.sqrt(_squares(held).max()), lists.flatten().to_numpy(zero_copy_only=False), lengths)
                if ready is not None:
                    yield from answers(keys[a:z], x[a:z], *ready)
        release()

    return dealt.mapInArrow(run, schema)


def _merged(near: DataFrame, keep: int) -> DataFrame:
    """(key, near): the ``keep`` nearest (far, id) of each key, ``far`` being the score's negative.

    A replicated vector comes from several lists; equal pairs lie side by side once sorted, so none is sought among all.
    """
    near = near.groupBy("key").agg(F.flatten(F.collect_list("near")).alias("near"))
    pair = F.transform("near", lambda p: F.struct((-p["score"]).alias("far"), p["id"].alias("id")))
    near = near.select("key", F.sort_array(pair).alias("near"))
    first = F.filter("near", lambda p, i: ~p.eqNullSafe(F.get("near", i - 1)))
    return near.select("key", F.slice(first, 1, keep).alias("near"))


def nearest(
    df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows found with the largest inner product for each row where ``is_query``.

    ``is_query`` is a condition on the column ``id``. Nearest first, ties to the smaller id; ranks start at 1.
    """
    rows = _valid(df, id_col, vec_col)
    vectors = stored(_distinct(rows, k + 1), "ann-vectors")
    asked = rows.filter(is_query)
    queries = stored(asked.groupBy("vec").agg(F.min("id").alias("key")), "ann-queries")
    facts = vectors.agg(
        F.count("*").alias("n"),
        F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))).alias("largest"),
        F.max(F.size("vec")).alias("size"),
    ).first()
    n, size = facts["n"], facts["size"] or 1
    out_schema = "query_id long, rank int, id long, score double"
    if not n:
        return df.sparkSession.createDataFrame([], out_schema)

    def sample(table: DataFrame, total: int, most: int) -> np.ndarray:
        """About ``most`` rows, chosen by a hash of the vector."""
        share = min(1.0, 1.2 * most / max(1, total))
        chosen = table.filter(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("vec")
        found = _matrix(chosen.limit(most).toArrow().column("vec").combine_chunks(), size)
        return found[np.lexsort(found.T)]

    fitted = sample(vectors, n, settings.sample_rows)
    k_lists = max(1, min(settings.max_lists, ceil(n / settings.list_rows), len(fitted) // 4))
    largest = facts["largest"]
    graph = CentroidGraph(balanced_means(lifted(fitted, largest), k_lists), largest)
    tested = sample(queries, queries.count(), settings.tested_queries)
    limit, width = calibrated(graph, vectors, tested, k, settings)

    def home(g: CentroidGraph, x: np.ndarray) -> np.ndarray:
        return g.homes(x, settings.replicas, settings.boundary)

    indexed = stored(_assigned(vectors, graph, home, size), "ann-index")
    sizes = _sizes(indexed, k_lists)

    def chosen(g: CentroidGraph, x: np.ndarray) -> np.ndarray:
        return g.within(x, limit, width, sizes, settings.replicas * (k + 1))

    asking = stored(_assigned(queries, graph, chosen, size), "ann-asking")
    parts = _parts(sizes, settings.part_rows, "list")
    shares = _parts(_sizes(asking, k_lists), settings.query_rows, "list")
    part = F.pmod(F.xxhash64("vec"), parts).cast("int")
    share = F.pmod(F.xxhash64("vec", F.lit(1)), shares).cast("int")
    held = indexed.select(F.explode("lists").alias("list"), "vec", "ids").withColumn("part", part)
    held = held.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    sent = asking.select(F.explode("lists").alias("list"), "key", "vec").withColumn("share", share)
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    columns = ["list", "part", "share", "key", "vec", "ids"]
    dealt = held.withColumn("key", F.lit(None).cast("long")).select(columns)
    dealt = dealt.unionByName(sent.withColumn("ids", F.lit(None).cast("array<bigint>")).select(columns))
    dealt = dealt.repartition("list", "part", "share").sortWithinPartitions("list", "part", "share", F.col("key").asc_nulls_first())
    near = _merged(_searched(dealt, k + 1, size), k + 1)
    # every query takes the answer of its vector, without itself
    own = asked.dropDuplicates(["vec", "id"]).join(queries, "vec").select(F.col("id").alias("query_id"), "key")
    answered = own.join(near, "key").select(
        "query_id", F.slice(F.filter("near", lambda p: p["id"] != F.col("query_id")), 1, k).alias("near")
    )
    flat_rows = answered.select("query_id", F.posexplode("near").alias("at", "hit"))
    return flat_rows.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), (-F.col("hit.far")).alias("score")
    )
