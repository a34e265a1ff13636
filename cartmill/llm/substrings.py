"""Removal of repeated byte strings: distributed prefix doubling over sampled positions.

A string of ``length`` bytes counts as repeated if an equal one starts earlier, in a document of smaller id or earlier
in the same one. Doubling over every position would sort as many rank pairs as the corpus has bytes, seven times over.
Instead each window of ``length`` bytes names one position inside it, that of the smallest hash of ``_SEED`` bytes,
which equal windows name alike: neighbouring windows mostly agree, so some fortieth of all positions is left.

Rank one of such a position is the hash of its first bytes, itself doubled up from single bytes. Spark sorts positions
by it; those with a unique rank are out. The second offset takes in all windows that named the position, as one
segment: sorted by the pair of ranks, a segment that is not the first of its kind is repeated as a whole, and one
whose position has no other kind of segment is done as well. What is left are the first segments of kinds that share a
rank, where only some windows may agree. Their windows, now past the threshold, are compared one by one, in the order
of the documents and among the segments of that rank alone.

A rank that many segments share, such as that of a very common line, is known in each task: equal segments are
reduced to the task's first before they are shuffled, and positions that are frequent in a task take another route,
dealt by the pair of ranks and then by the windows themselves, on which their group is spread over all tasks.

Defined results: null and empty texts have no bytes; documents shorter than ``length`` keep all; rows equal in id and
text count as one document and get the same result; documents of one id are ordered by a hash of their text; null ids
come first; an id that is no integer is refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.llm import common

_SEED = 16
_FREQUENT = 48  # positions of one rank in a slice of some megabytes from which on they take the other route
_MARK, _PLAIN, _SPREAD, _DONE, _SINGLE = range(5)
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([b]), 99) for b in range(256)], dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``_SEED`` bytes from each position on, doubled up from single bytes."""
    h, span = _TABLE[data], 1
    with np.errstate(over="ignore"):
        while span < _SEED:
            h = h[:-span] * np.uint64(pow(_BASE, span, 2**64)) + h[span:]
            span *= 2
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def first_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value in each run of ``width``."""
    n = len(h) - width + 1
    low, at, span = h, np.arange(len(h), dtype=np.int32), 1

    def joined(low, at, step, count):
        right = low[step : step + count] < low[:count]
        return np.where(right, low[step : step + count], low[:count]), np.where(right, at[step : step + count], at[:count])

    while 2 * span <= width:
        low, at = joined(low, at, span, len(low) - span)
        span *= 2
    if span < width:
        low, at = joined(low, at, width - span, n)
    return at[:n]


def segments(data: bytes, length: int) -> tuple[np.ndarray, ...] | None:
    """(rank, content, start, count): for each sampled position its hash, the hash of all windows naming it, and these."""
    if len(data) < length:
        return None
    h = seed_hashes(np.frombuffer(data, dtype=np.uint8))
    named = first_minima(h, length - _SEED + 1)
    starts = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1])))
    ends = np.append(starts[1:], len(named))
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    offsets = (named[starts] - starts).tolist()
    content = [digest(view[a : b + length - 1], o) for a, b, o in zip(starts.tolist(), ends.tolist(), offsets, strict=True)]
    return h[named[starts]], np.array(content, dtype=np.uint64), starts, ends - starts


_ROWS = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("content", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("text_key", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("count", T.IntegerType()),
    ]
)
_COLUMNS = [f.name for f in _ROWS]


def _route() -> Column:
    """What rows are dealt by; computed on the way, not sent."""
    spread = F.when(F.col("kind") == _SPREAD, F.col("rank").bitwiseXOR(F.col("content"))).otherwise(F.col("id"))
    return F.when(F.col("kind") <= _PLAIN, F.col("rank")).otherwise(spread)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _first_of(keys: list[np.ndarray], order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For rows grouped by ``keys``: the place of each row's group's first row by ``order``, and the group's number."""
    by = np.lexsort([*order[::-1], *keys[::-1]])
    new = np.ones(len(by), dtype=bool)
    if len(by):
        new[1:] = np.any([k[by][1:] != k[by][:-1] for k in keys], axis=0)
    group, first = np.empty(len(by), dtype=np.int64), np.empty(len(by), dtype=np.int64)
    number = np.cumsum(new) - 1
    group[by], first[by] = number, by[np.flatnonzero(new)][number]
    return first, group


def _sampled(docs: DataFrame, length: int) -> DataFrame:
    """Segments of all documents, reduced in each slice of documents."""
    target = common.arrow_schema(_ROWS)

    def run(batches):
        for b in batches:
            for part in common.slices(b, 2):
                found = []
                for key, text_key, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if text and (s := segments(text.encode(), length)) is not None:
                        n = len(s[0])
                        found.append((*s, np.full(n, _null_first(key)), np.full(n, text_key)))
                if not found:
                    continue
                rank, content, start, count, key, text_key = (np.concatenate(x) for x in zip(*found, strict=True))
                rank, content = _signed(rank), _signed(content)
                kind = np.full(len(rank), _PLAIN, dtype=np.int32)
                first, _ = _first_of([rank, content], [key, text_key, start])
                # not even the first here: an equal one is earlier, and it is the earlier one that others must know
                same = (key == key[first]) & (text_key == text_key[first]) & (start == start[first])
                kind[~same] = _DONE
                keep = ~same | (first == np.arange(len(first)))
                _, group = _first_of([rank], [content])
                waiting = kind == _PLAIN
                often = np.bincount(group[waiting & keep], minlength=len(rank))[group] >= _FREQUENT
                kind[waiting & often] = _SPREAD
                columns = [kind, rank, content, key, text_key, start, count]
                marks = np.unique(rank[kind == _SPREAD])
                zero = np.zeros(len(marks), dtype=np.int64)
                extra = [np.full(len(marks), _MARK), marks, zero, zero, zero, zero, zero]
                yield _batch([np.concatenate((c[keep], e)) for c, e in zip(columns, extra, strict=True)], target)

    return docs.mapInArrow(run, _ROWS)


_NULL = -(1 << 63)


def _null_first(key: int | None) -> int:
    return _NULL if key is None else key


def _batch(columns: list[np.ndarray], target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)


class _Runs:
    """Groups in sorted rows that arrive in batches: which rows are first of a group, and which repeat the first."""

    def __init__(self):
        self.last = None

    def read(self, keys: list[np.ndarray], place: list[np.ndarray]):
        """(new, repeats): row opens a group; row stands elsewhere than its group's first."""
        n = len(keys[0])
        new = np.empty(n, dtype=bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        new[0] = self.last is None or any(k[0] != v for k, v in zip(keys, self.last[0], strict=True))
        opened = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        repeats = np.zeros(n, dtype=bool)
        for p, carried in zip(place, self.last[1] if self.last else [0] * len(place), strict=True):
            repeats |= p != np.where(opened >= 0, p[opened], carried)
        at = opened[-1]
        self.last = ([k[-1] for k in keys], [p[at] if at >= 0 else c for p, c in zip(place, self.last[1] if self.last else place, strict=True)])
        return new, repeats


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {n: c.to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def _by_rank(rows: DataFrame) -> DataFrame:
    """First reranking: drop positions of unique rank, settle groups with one kind of segment.

    What leaves has kind _DONE for repeated segments, _PLAIN for firsts whose windows are still to be compared, and
    _SPREAD for the members of frequent ranks.
    """
    target = common.arrow_schema(_ROWS)

    def run(batches):
        ranks, pairs = _Runs(), _Runs()
        marked, several = False, False  # of the rank that is open
        held = None  # its first row, until another kind of segment shows up
        for b in batches:
            c = _columns(b)
            waiting = c["kind"] <= _PLAIN
            others = {k: v[~waiting] for k, v in c.items()}
            if len(others["kind"]):
                yield _batch([others[k] for k in _COLUMNS], target)
            c = {k: v[waiting] for k, v in c.items()}
            n = len(c["kind"])
            if not n:
                continue
            new_rank, _ = ranks.read([c["rank"]], [c["start"]])
            new_pair, repeats = pairs.read([c["rank"], c["kind"], c["content"]], [c["id"], c["text_key"], c["start"]])
            group = np.cumsum(new_rank)  # 0 is the rank still open from the batch before
            has_mark = np.zeros(group[-1] + 1, dtype=bool)
            has_mark[0] = marked
            np.logical_or.at(has_mark, group, c["kind"] == _MARK)
            other_kind = new_pair & ~new_rank & (c["kind"] == _PLAIN)
            mixed = np.zeros(group[-1] + 1, dtype=bool)
            mixed[0] = several
            np.logical_or.at(mixed, group, other_kind)
            if held is not None and group[0] == 0 and mixed[0]:
                yield _batch([np.array([v]) for v in held], target)
                held = None
            elif held is not None and group[0] > 0:
                held = None
            plain, spread = c["kind"] == _PLAIN, has_mark[group]
            kind = np.where(spread, _SPREAD, np.where(repeats, _DONE, _PLAIN)).astype(np.int32)
            out = plain & (spread | repeats | (new_pair & mixed[group]))
            c["kind"] = kind
            last = group[-1]
            if not has_mark[last] and not mixed[last] and new_rank.any():
                at = np.flatnonzero(new_rank)[-1]
                held = [c[k][at] for k in _COLUMNS]
            elif new_rank.any():
                held = None
            marked, several = bool(has_mark[last]), bool(mixed[last])
            if out.any():
                yield _batch([c[k][out] for k in _COLUMNS], target)

    order = ["rank", "kind", "content", "id", "text_key", "start"]
    return rows.repartition(_route()).sortWithinPartitions(*order).mapInArrow(run, _ROWS)


def _by_pair(rows: DataFrame) -> DataFrame:
    """Second reranking, of frequent ranks: repeated segments are done, the first of each kind becomes _SINGLE windows."""
    target = common.arrow_schema(_ROWS)

    def run(batches):
        pairs = _Runs()
        for b in batches:
            c = _columns(b)
            spread = c["kind"] == _SPREAD
            if not spread.all():
                yield _batch([c[k][~spread] for k in _COLUMNS], target)
            c = {k: v[spread] for k, v in c.items()}
            if not len(c["kind"]):
                continue
            new, repeats = pairs.read([c["rank"], c["content"]], [c["id"], c["text_key"], c["start"]])
            c["kind"] = np.where(repeats, _DONE, _SINGLE).astype(np.int32)
            out = new | repeats
            yield _batch([c[k][out] for k in _COLUMNS], target)

    order = ["rank", "content", "id", "text_key", "start"]
    return rows.repartition(_route()).sortWithinPartitions(*order).mapInArrow(run, _ROWS)


_OPEN = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("text_key", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("body", T.BinaryType()),
    ]
)
_RANGES = T.StructType([_OPEN["id"], _OPEN["text_key"], _OPEN["start"], T.StructField("count", T.IntegerType())])


def _open_segments(found: DataFrame, length: int) -> DataFrame:
    """Bytes of the segments still to be compared; of frequent ranks instead the windows' hashes, reduced in each slice."""
    target = common.arrow_schema(_OPEN)

    def run(batches):
        for b in batches:
            for part in common.slices(b, 2):
                plain: list[tuple] = []
                hashes, ids, keys, starts = [], [], [], []
                for key, text_key, text, parts in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    data = memoryview(text.encode())
                    for p in parts:
                        start, end = p["start"], p["start"] + p["count"]
                        if p["kind"] == _PLAIN:
                            body = bytes(data[start : end + length - 1])
                            plain.append((_PLAIN, p["rank"], 0, 0, key, text_key, start, body))
                        elif p["kind"] == _SINGLE:
                            hashes += [xxhash.xxh3_128_digest(data[i : i + length]) for i in range(start, end)]
                            starts += range(start, end)
                            ids += [key] * p["count"]
                            keys += [text_key] * p["count"]
                if plain:
                    yield common.to_batch(plain, target)
                if not hashes:
                    continue
                high, low = np.frombuffer(b"".join(hashes), dtype=">u8").astype(np.uint64).view(np.int64).reshape(-1, 2).T
                ids, keys, starts = (np.array(x, dtype=np.int64) for x in (ids, keys, starts))
                first, _ = _first_of([high, low], [ids, keys, starts])
                same = (ids == ids[first]) & (keys == keys[first]) & (starts == starts[first])
                keep = ~same | (first == np.arange(len(first)))
                kind, zero = np.where(same, _SINGLE, _DONE), np.zeros(len(ids), dtype=np.int64)
                columns = [x[keep] for x in (kind, zero, high, low, ids, keys, starts)]
                arrays = [pa.array(c).cast(f.type) for c, f in zip(columns, target, strict=False)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(columns[0]), pa.binary())], schema=target)

    return found.mapInArrow(run, _OPEN)


class _Rank:
    """Windows met so far in the segments of one rank, which come in the order of the documents."""

    def __init__(self, length: int):
        self.length, self.rank, self.place, self.met = length, None, None, set()

    def repeated(self, rank: int, place: tuple, body: bytes) -> list[tuple[int, int]]:
        """Runs (first, count) of the segment's windows that were met before."""
        if rank != self.rank:
            self.rank, self.place, self.met = rank, None, set()
        if place == self.place:  # an equal row
            return []
        self.place = place
        view, length, met, digest = memoryview(body), self.length, self.met, xxhash.xxh3_128_intdigest
        found = [digest(view[i : i + length]) for i in range(len(body) - length + 1)]
        runs: list[tuple[int, int]] = []
        if not met.isdisjoint(found):
            hit = np.flatnonzero(np.diff(np.array([False, *[h in met for h in found], False], dtype=np.int8)))
            runs = [(int(a), int(b - a)) for a, b in hit.reshape(-1, 2)]
        for i, h in enumerate(found):  # a window may repeat inside its own segment
            if h in met and not any(a <= i < a + n for a, n in runs):
                runs.append((i, 1))
            met.add(h)
        return runs


def _repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """(id, text_key, start, count): runs of windows that are not the first of their kind."""
    target = common.arrow_schema(_RANGES)

    def run(batches):
        runs, rank = _Runs(), _Rank(length)
        for b in batches:
            c = _columns(b)
            if (plain := np.flatnonzero(c["kind"] == _PLAIN)).size:
                out = []
                for r, key, text_key, start, body in zip(*[c[n][plain].tolist() for n in ("rank", "id", "text_key", "start", "body")], strict=True):
                    out += [(key, text_key, start + a, n) for a, n in rank.repeated(r, (key, text_key, start), body)]
                if out:
                    yield common.to_batch(out, target)
            c = {k: v[c["kind"] != _PLAIN] for k, v in c.items() if k != "body"}
            single = c["kind"] == _SINGLE
            repeats = ~single
            if single.any():
                at = [c[n][single] for n in ("high", "low", "id", "text_key", "start")]
                repeats[single] = runs.read(at[:2], at[2:])[1]
            if repeats.any():
                ones = np.ones(int(repeats.sum()), dtype=np.int32)
                yield _batch([*[c[n][repeats] for n in _RANGES.names[:3]], ones], target)

    order = ["kind", "rank", "high", "low", "id", "text_key", "start"]
    single = F.when(F.col("kind") == _SINGLE, F.col("high").bitwiseXOR(F.col("low"))).otherwise(F.col("id"))
    route = F.when(F.col("kind") == _PLAIN, F.col("rank")).otherwise(single)
    return rows.repartition(route).sortWithinPartitions(*order).mapInArrow(run, _RANGES)


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(r) for r in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per row: id, n_bytes, spans (start and end of the removed runs, in bytes) and kept, the bytes that stay."""
    if length < 2 * _SEED:
        raise ValueError(f"strings of fewer than {2 * _SEED} bytes are not supported")
    id_field = common.field(docs, id_col)
    if not isinstance(id_field.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"{id_field.name} must be an integer")
    text = F.coalesce(F.col(f"`{common.field(docs, text_col).name}`"), F.lit(""))
    source = docs.select(F.col(f"`{id_field.name}`").cast("long").alias("id"), F.hash(text).alias("text_key"), text.alias("text"))
    settled = _by_pair(_by_rank(_sampled(source, length)))
    known = F.coalesce("id", F.lit(_NULL))
    # documents are dealt once; both joins read that exchange
    dealt = source.withColumn("id", known).repartition("id", "text_key")
    segment = F.struct("kind", "rank", "start", "count")
    parts = settled.groupBy("id", "text_key").agg(F.collect_list(segment).alias("parts"))
    unsettled = parts.filter(F.exists("parts", lambda p: p["kind"] != _DONE))
    compared = dealt.join(unsettled, ["id", "text_key"]).select("id", "text_key", "text", "parts")
    repeated = _repeated_windows(_open_segments(compared, length), length)
    ranges = repeated.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "count")).alias("ranges"))
    joined = dealt.join(parts, ["id", "text_key"], "left").join(ranges, ["id", "text_key"], "left")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = common.schema_of(
        id_field, ("n_bytes", T.LongType()), ("spans", T.ArrayType(span)), ("kept", T.BinaryType())
    )

    def rows(batch):
        for key, text, parts, ranges in batch:
            data = text.encode()
            repeats = [*[p for p in parts or () if p["kind"] == _DONE], *(ranges or ())]
            removed = _union([(p["start"], p["start"] + p["count"] - 1 + length) for p in repeats])
            kept, at = [], 0
            for start, end in removed:
                kept.append(data[at:start])
                at = end
            kept.append(data[at:])
            yield (
                None if key == _NULL else key,
                len(data),
                [{"start": a, "end": b} for a, b in removed],
                b"".join(kept),
            )

    return common.arrow_map(joined.select("id", "text", "parts", "ranges"), rows, schema, batch=512)
