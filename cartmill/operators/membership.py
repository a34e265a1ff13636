"""Which rows have a parent, without shuffling those that do.

Keys that are whole numbers or dates are kept as a set of bits, a word of 64 keys per row. A set small enough comes to the
driver and goes to every task that scans the child, which then passes on none but true orphans: the set is exact. (A Bloom filter of the
parent's keys would not do, as it says 'perhaps' for every row that has a parent.) Larger sets and other keys take an
anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a set that may be sent to every task: 16 bytes each, 16 MiB in all.
MOST_WORDS = 1 << 20
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def _number(column: str | Column, kind: T.DataType) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return (F.unix_date(c) if isinstance(kind, T.DateType) else c).cast("bigint")


def key_set(parent: DataFrame, field: str) -> DataFrame | None:
    """(word, bits) of the parent's keys, or None if they are of another kind or take more than ``MOST_WORDS``."""
    kind = parent.schema[field].dataType
    if not isinstance(kind, _WHOLE):
        return None
    key = _number(field, kind)
    words = parent.filter(F.col(field).isNotNull()).groupBy(F.shiftright(key, 6).alias("word"))
    words = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(63).cast("int"))).alias("bits"))
    found = words.limit(MOST_WORDS + 1).toArrow()
    return parent.sparkSession.createDataFrame(found) if found.num_rows <= MOST_WORDS else None


def marked(child: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: true for rows whose key is not in the set; a null key is passed over. No row is shuffled."""
    key = _number(column, child.schema[column].dataType)
    bits, word = F.broadcast(known.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))), F.shiftright(key, 6)
    bit = F.call_function("shiftright", F.col("_bits"), key.bitwiseAND(63).cast("int")).bitwiseAND(1)
    joined = child.join(bits, word == F.col("_word"), "left")
    return joined.withColumn(name, F.col(column).isNotNull() & (F.coalesce(bit, F.lit(0)) == 0)).drop("_word", "_bits")


def alike(child: DataFrame, column: str, parent: DataFrame, field: str) -> bool:
    """Whether both keys are whole numbers or both dates."""
    kinds = (child.schema[column].dataType, parent.schema[field].dataType)
    return all(isinstance(k, _WHOLE) for k in kinds) and len({isinstance(k, T.DateType) for k in kinds}) == 1


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows of the child whose key is not null and not among the parent's."""
    known = key_set(parent, field) if alike(child, column, parent, field) else None
    if known is not None:
        return marked(child, column, known, "_lost").filter("_lost").drop("_lost")
    keys = parent.select(F.col(field).alias("_parent_key"))
    present = child.filter(F.col(column).isNotNull())
    return present.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")
