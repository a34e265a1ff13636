"""What the operators share: reading tables, Arrow plumbing and the registry of their queries."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmill.session import WRITTEN, apply_semantics, scratch_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) under ``name``, with the SQL that checks it."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepared(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


#: Rows of an Arrow batch, a tenth of Spark's default, as whole texts are long. Characters of a plan's description: Spark
#: keeps those of a thousand executions on the driver, and the literal rank map alone is a megabyte.
_MOST = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.maxPlanStringLength": 1 << 16}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that results and the memory of workers and driver depend on."""
    importable(spark)
    for name, most in _MOST.items():
        found = spark.conf.get(name)
        if not found.isdigit() or not 0 < int(found) <= most:
            spark.conf.set(name, most)
    return apply_semantics(spark)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; a cluster may ship it with --py-files."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field(df: DataFrame, name: str) -> T.StructField:
    """The field of exactly this name, or else the one that matches without regard to case."""
    return next((f for f in df.schema if f.name == name), None) or next(
        f for f in df.schema if f.name.lower() == name.lower()
    )


def free(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has, whatever its case: the one given, with underscores if need be."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_map(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterable[tuple]], schema: T.StructType, batch: int = 4096):
    """Map tuples of ``df``'s rows to tuples of ``schema``, batch by batch, without a shuffle.

    ``rows`` sees one Arrow batch at a time as an iterator of tuples and returns tuples.
    """
    target = arrow_schema(schema)

    def run(batches):
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            out: list[tuple] = []
            for row in rows(zip(*columns, strict=True)):
                out.append(row)
                if len(out) >= batch:
                    yield to_batch(out, target)
                    out = []
            if out:
                yield to_batch(out, target)
        release()

    return df.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def schema_of(*fields: T.StructField | tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([f if isinstance(f, T.StructField) else T.StructField(*f) for f in fields])


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared scratch folder, deleted by ``clear_scratch``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    WRITTEN.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: lost executors cost nothing later."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_rows(df: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """Only the identifier and the columns asked for, in this order, whatever else the table has."""
    return df.select(*[F.col(f"`{field(df, c).name}`") for c in (id_col, *columns)])


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20):
    """A batch in parts of about ``most`` bytes of one text column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


#: Lists of broadcast values that whoever stores results wants to take back afterwards.
_OWNERS: list[list] = []


def share(context, value):
    """Broadcast a value."""
    shared = context.broadcast(value)
    if _OWNERS:
        _OWNERS[-1].append(shared)
    return shared


@contextlib.contextmanager
def owning(values: list):
    """Collect in ``values`` what is broadcast meanwhile."""
    _OWNERS.append(values)
    try:
        yield
    finally:
        _OWNERS.pop()


_HELD: list = [None, None]


def held(key: tuple, build):
    """What ``build`` makes, kept in the worker until something else is asked for.

    Workers live on from task to task and from one operator to the next; only one thing is kept in each.
    """
    if _HELD[0] is None or len(_HELD[0]) != len(key) or any(a is not b and a != b for a, b in zip(_HELD[0], key, strict=True)):
        _HELD[:] = [None, None]
        release()
        _HELD[:] = [key, build()]
    return _HELD[1]


def release() -> None:
    """Give freed memory back to the system before the worker waits for its next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has this
        ctypes.CDLL(None).malloc_trim(0)
