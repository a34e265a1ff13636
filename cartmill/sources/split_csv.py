"""CSV files with line breaks inside quotes, read by many tasks.

Spark reads such files with one task each, as a line break alone does not tell whether a record ends. Here a file is read
as lines, in the blocks Spark splits it into, and the state of the quotes is settled by a parallel scan:

1. each block counts its quotes; their parity says whether it turns 'outside quotes' into 'inside' or leaves it,
2. running parities over the blocks of a file give the state at each block's start, whichever block it is,
3. each task follows the state from line to line, joins the lines of a record and passes on what its block holds only
   part of: the end of a record begun before it, and the beginning of one it does not end,
4. those few parts are put together in the order of the blocks.

Records are then parsed by Spark's own CSV expression. No line is shuffled, but for the parts at the borders.

A quote must open or close a field or be doubled inside one, as CSV writers produce it. Records end with a line feed or,
where the first line does so, with a carriage return and a line feed, which inside quotes then reads as a line feed.
Blank lines are no records. Blocks must be the same in steps 1 and 3; if the session
splits files differently by then, reading fails instead of guessing.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.session import importable

#: So many blocks are known to every task (some 10 MB); of more, lines are sorted to their block's state.
BROADCAST_BLOCKS = 100_000
_WHOLE, _OPENS, _BETWEEN, _CLOSES = 0, 1, 2, 3
_RECORDS = "kind int, file string, block long, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, size, line, value): physical lines with their block's start and size and an order inside it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("size"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def block_states(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(file, block, size, inside, leaves, returns): whether a quoted field is open at the start and at the end of each block.

    ``returns``: whether the first line of the file ends with a carriage return.
    """
    odd = (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2
    flips = lines.groupBy("file", "block", "size").agg(
        F.sum(odd).alias("n"), F.min_by(F.endswith("value", F.lit("\r")), "line").alias("returns")
    )
    upto = Window.partitionBy("file").orderBy("block")
    return flips.select(
        "file",
        "block",
        "size",
        ((F.sum("n").over(upto) - F.col("n")) % 2 == 1).alias("inside"),
        (F.sum("n").over(upto) % 2 == 1).alias("leaves"),
        F.first("returns").over(upto).alias("returns"),
    )


class _Cutter:
    """Cuts the lines of one block into records."""

    def __init__(self, inside: bool, header: bool):
        self.inside, self.header = inside, header
        self.begun_before, self.open = inside, []

    def cut(self, lines: pa.Array, quote: str) -> tuple[pa.Array, pa.Array]:
        """(records, parts): records that end in these lines, and the end of one begun in an earlier block."""
        quotes = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False)
        inside = (np.cumsum(quotes) + self.inside) % 2 == 1
        self.inside = bool(inside[-1])
        ends = np.flatnonzero(~inside)
        if not len(ends):
            self.open.append(lines)
            return lines.slice(0, 0), lines.slice(0, 0)
        last = int(ends[-1]) + 1
        held = pa.concat_arrays([*self.open, lines.slice(0, last)])
        self.open = [lines.slice(last)] if last < len(lines) else []
        offsets = np.append(0, ends + 1 + len(held) - last)
        records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), held), "\n")
        parts = records.slice(0, 0)
        if self.begun_before:
            parts, records, self.begun_before = records.slice(0, 1), records.slice(1), False
        records = records.filter(pc.not_equal(records, ""))
        if self.header and len(records):
            records, self.header = records.slice(1), False
        return records, parts

    def rest(self) -> tuple[int, pa.Array | None]:
        """Lines of a record that this block does not end. An unended header is passed on by no one."""
        if not self.open or (self.header and not self.begun_before):
            return _OPENS, None
        lines = pa.concat_arrays(self.open)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")
        return (_BETWEEN if self.begun_before else _OPENS), joined


def _cut(lines: DataFrame, header: bool, quote: str, whole: bool) -> DataFrame:
    """Records that lie within a block, or else the parts of those that do not."""

    def run(batches):
        place, cutter = None, None

        def rows(kind: int, records: pa.Array | None):
            if records is not None and len(records) and (kind == _WHOLE) == whole:
                n = len(records)
                file, block = (None, None) if whole else place
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * n, pa.int32()), pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), records],
                    names=["kind", "file", "block", "record"],
                )

        for batch in batches:
            starts = batch.column(1).to_numpy(zero_copy_only=False)
            files = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.append(True, (starts[1:] != starts[:-1]) | (files[1:] != files[:-1])))
            for a, z in zip(change.tolist(), [*change[1:].tolist(), batch.num_rows], strict=True):
                here = (batch.column(0)[a].as_py(), int(starts[a]))
                if here != place:
                    if cutter:
                        yield from rows(*cutter.rest())
                    inside = batch.column(2)[a].as_py()
                    if inside is None:
                        raise RuntimeError(f"{here[0]} is split differently than when its quotes were counted; read it again")
                    place, cutter = here, _Cutter(inside, header and here[1] == 0)
                values = batch.column(4).slice(a, z - a)
                if batch.column(3)[a].as_py():
                    values = pc.replace_substring_regex(values, "\r$", "")
                records, parts = cutter.cut(values, quote)
                yield from rows(_WHOLE, records)
                yield from rows(_CLOSES, parts)
        if cutter:
            yield from rows(*cutter.rest())

    return lines.select("file", "block", "inside", "returns", "value").mapInArrow(run, _RECORDS)


def split_records(spark: SparkSession, path: str, header: bool = True, quote: str = '"') -> DataFrame:
    """(record): the records of CSV files, line breaks inside quotes and all, without the header of each file."""
    lines = _lines(importable(spark), path)
    states = block_states(lines, quote)
    known = states.collect() if states.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS else None
    if known is not None:
        states = spark.createDataFrame(known, states.schema)
        stated = lines.join(F.broadcast(states), ["file", "block", "size"], "left")
        # only blocks that a record crosses a border of have parts to put together
        border = states.filter("inside or leaves").select("file", "block", "size")
        crossing = stated.join(F.broadcast(border), ["file", "block", "size"], "left_semi")
        within, crossing = (_cut(t, header, quote, w) for t, w in ((stated, True), (crossing, False)))
        if not any(r["inside"] or r["leaves"] for r in known):
            return within.select("record")
    else:
        stated = lines.join(states, ["file", "block", "size"], "left").repartition("file", "block")
        stated = stated.sortWithinPartitions("file", "block", "line")
        within, crossing = (_cut(stated, header, quote, w) for w in (True, False))
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == _OPENS)
    numbered = crossing.withColumn("n", F.sum((F.col("kind") == _OPENS).cast("int")).over(order))
    part = F.struct("block", "record")
    joined = numbered.groupBy("file", "n").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.max((F.col("kind") == _OPENS).cast("int")).alias("opened")
    )
    whole = joined.filter("opened = 1").select(F.array_join("parts.record", "\n").alias("record"))
    return within.select("record").unionByName(whole.filter("record <> ''"))


def read_split_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The columns of CSV files whose quoted fields may hold line breaks, equal to reading them with ``multiLine``."""
    found = split_records(spark, path, header, (options or {}).get("quote", '"'))
    parsed = F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), {"escape": '"', "multiLine": "true", **(options or {})})
    return found.select(parsed.alias("r")).select(*[F.col(f"r.`{f.name}`") for f in schema])
