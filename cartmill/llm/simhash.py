"""SimHash near-duplicates, found through vantage points.

Distinct fingerprints are dealt into shards by their Hamming distances to a few fixed vantage points. By the triangle
inequality two fingerprints within ``max_bits`` of each other differ by no more than that in each of these distances,
and by the same parity in all: a fingerprint stands in its own shard and visits those neighbouring shards that such a
change could reach, every pair of shards in one direction only. Inside a shard a vantage-point tree prunes branches
by the same bound, and what is left is compared exactly. A shard reports a spanning star of each group it finds,
never its pairs. A shard with many fingerprints is divided by its queries, and more vantage points are used as
fingerprints grow in number, which only spreads the same work.

Components of all stars come from rounds of large and small stars, each written to the shared folder.

Defined results: null and empty texts have fingerprint zero and link like any other; equal rows are linked; a null id
does not count for the smallest id of a component, which is null if it has no other.
"""

from __future__ import annotations

import itertools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common

SHARD_ROWS = 4_000
_LEAF = 64
_BLOCK = 1 << 21  # distances computed at once


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over the XXH64 of every word shingle, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A to Z and ASCII white space only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    size = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    hashed, digest = [], xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    n = len(words) - size + 1
    last = ends[size - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        hashed = [digest(joined[a:b], seed) for a, b in zip(starts[at : min(n, at + (1 << 16))], last[at : at + (1 << 16)], strict=True)]
        bits = np.unpackbits(np.array(hashed, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, keys: list[Column] | None = None) -> DataFrame:
    """(id, fp, *keys): the signed fingerprint of each row."""
    id_field = common.field(docs, id_col)
    extra = keys or []
    source = docs.select(F.col(f"`{id_field.name}`"), F.col(f"`{common.field(docs, text_col).name}`").alias("_text"), *extra)
    schema = common.schema_of(id_field, ("fp", T.LongType()), *source.schema.fields[2:])

    def rows(batch):
        for key, text, *rest in batch:
            value = fingerprint(text, shingle)
            yield (key, value - (1 << 64) if value >> 63 else value, *rest)

    return common.arrow_map(source, rows, schema)


def _vantage_points(n: int) -> list[int]:
    """Fixed 64-bit values that look random, as signed numbers."""
    return [xxhash.xxh64_intdigest(f"vantage point {i}".encode()) - (1 << 63) for i in range(n)]


def _levels(n: int, target: int = 4096) -> int:
    """Vantage points needed for shards of about ``target``: the commonest distance has a tenth of random values."""
    levels = 1
    while n * 0.1**levels > target:
        levels += 1
    return levels


def _reachable(levels: int, radius: int) -> list[tuple[int, ...]]:
    """Changes of the distances that flipping up to ``radius`` bits can make, one of each pair of opposite ones."""
    found = set()
    for bits in range(radius + 1):
        found.update(itertools.product(range(-bits, bits + 1, 2), repeat=levels))
    origin = (0,) * levels
    return sorted(c for c in found if c > origin)


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


class _Groups:
    """Groups of numbered items, each named by its smallest number."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def link_within(resident: np.ndarray, query: np.ndarray, radius: int, groups: _Groups, offset: int) -> None:
    """Join the query items (numbered from ``offset``) with the residents (numbered from 0) within ``radius`` bits."""
    stack = [(np.arange(len(resident)), np.arange(len(query)))]
    while stack:
        held, asked = stack.pop()
        if not len(held) or not len(asked):
            continue
        near = None
        if len(held) > _LEAF:
            distance = popcount(resident[held] ^ resident[held[0]])
            middle = int(np.median(distance))
            near = distance <= middle
        if near is None or near.all():
            step = max(1, _BLOCK // len(held))
            for at in range(0, len(asked), step):
                part = asked[at : at + step]
                q, r = np.nonzero(popcount(query[part][:, None] ^ resident[held][None, :]) <= radius)
                groups.join(part[q] + offset, held[r])
            continue
        from_vantage = popcount(query[asked] ^ resident[held[0]]).astype(np.int64)
        stack.append((held[near], asked[from_vantage - radius <= middle]))
        stack.append((held[~near], asked[from_vantage + radius > middle]))


def _stars(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): edges of spanning stars over all pairs of distinct fingerprints within ``max_bits``."""
    levels = _levels(distinct.count())
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(v))).cast("long") for v in _vantage_points(levels)]
    scale = 128  # leaves room for distances beyond 0 and 64
    cell = sum((d * scale**i for i, d in enumerate(distances)), F.lit(0).cast("long"))
    moves = [sum(x * scale**i for i, x in enumerate(c)) for c in _reachable(levels, max_bits)]
    visits = F.explode(F.array(F.struct(F.lit(0).cast("long").alias("move")), *[F.struct(F.lit(m).cast("long").alias("move")) for m in moves]))
    placed = distinct.select("fp", cell.alias("home"), visits.alias("v")).select(
        "fp", (F.col("home") + F.col("v.move")).alias("cell"), (F.col("v.move") == 0).alias("resident")
    )
    homes = distinct.select(cell.alias("cell")).distinct()
    placed = placed.join(homes, "cell", "left_semi")  # visits to shards where nothing stands
    crowded = (
        placed.groupBy("cell")
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > SHARD_ROWS)
        .select("cell", F.ceil(F.col("rows") / SHARD_ROWS).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    # queries of a crowded shard are divided, its residents stand in each part
    dealt = placed.join(crowded, "cell", "left").select(
        "cell",
        "fp",
        "resident",
        own.alias("own"),
        F.explode(F.when(F.col("resident"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(own))).alias("part"),
    )
    edges = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def search(pdf):
        import pandas as pd

        stands = pdf["resident"].to_numpy(dtype=bool)
        asks = (pdf["own"] == pdf["part"]).to_numpy()
        values = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        resident, visitor = values[stands], values[~stands]
        groups = _Groups(len(values))
        asking = np.flatnonzero(asks[stands])
        # residents that ask are among the residents: link them under their own numbers
        if len(asking):
            inner = _Groups(len(resident) + len(asking))
            link_within(resident, resident[asking], max_bits, inner, len(resident))
            inner.join(np.arange(len(asking)) + len(resident), asking)
            groups.join(np.arange(len(resident)), inner.label[: len(resident)])
        link_within(resident, visitor, max_bits, groups, len(resident))
        ordered = np.concatenate((resident, visitor)).view(np.int64)
        inside = np.flatnonzero(groups.label != np.arange(len(values)))
        return pd.DataFrame({"a": ordered[inside], "b": ordered[groups.label[inside]]})

    # the join has dealt rows by cell alone, which would leave the parts of a cell together
    spread = dealt.repartition("cell", "part")
    return spread.groupBy("cell", "part").applyInPandas(search, edges).filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) other than roots; a root is its component's smallest node."""
    edges = common.stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links"
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        smallest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.unionByName(smallest.select("a", F.col("m").alias("b")))
        edges = common.stored(
            small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _roots(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint."""
    linked = components(_stars(distinct.select("fp"), max_bits))
    return distinct.join(linked, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id linked directly or indirectly."""
    name = common.field(docs, id_col).name
    found = common.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = common.stored(found.groupBy("fp").agg(F.min(f"`{name}`").alias("least")), "distinct-fingerprints")
    rooted = _roots(distinct, max_bits)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    joined = found.join(named, "fp")
    return joined.select(F.col(f"`{name}`"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each component that with the smallest id, null ids last, then any."""
    name = common.field(docs, id_col).name
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    mark, at, of = (common.free(docs, c) for c in ("_row", "_chosen", "_chosen_id"))
    found = common.stored(fingerprints(docs, id_col, text_col, shingle, [row.alias(mark)]), "fingerprints")
    first = F.min(F.struct(F.col(f"`{name}`").isNull().alias("unknown"), F.col(f"`{name}`").alias("id"), F.col(mark).alias("row")))
    distinct = common.stored(found.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    chosen = _roots(distinct, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    chosen = chosen.select(F.col("first.row").alias(at), F.col("first.id").alias(of))
    marked = docs.withColumn(mark, row)
    kept = marked.join(chosen, (F.col(mark) == F.col(at)) & F.col(f"`{name}`").eqNullSafe(F.col(of)), "left_semi")
    # equal rows have equal marks; only one of them stays
    return kept.dropDuplicates([name, mark]).select(*[F.col(f"`{c}`") for c in docs.columns])
