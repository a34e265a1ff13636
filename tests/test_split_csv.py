"""CSV with line breaks inside quotes, cut at every place, against Spark's reader of whole files."""

from __future__ import annotations

import random
from contextlib import contextmanager

import pytest
from conftest import plan
from pyspark.sql import types as T

from cartmill.sources import raw, split_csv

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "xyz"])


@contextmanager
def blocks_of(spark, size):
    """Files are split into blocks of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, (size, 1), strict=True):
            spark.conf.set(n, str(v))
        yield
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)


def whole(spark, path):
    reader = spark.read.schema(SCHEMA).option("header", True).option("escape", '"').option("multiLine", True)
    return sorted(map(repr, reader.csv(str(path)).collect()))


def cut(spark, path):
    return sorted(map(repr, split_csv.read_split_csv(spark, str(path), SCHEMA).collect()))


def cell(rng):
    kind = rng.randint(0, 6)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    if kind < 5:
        return '"' + "".join(rng.choices(["a", "é", "\n", "\r\n", '""', ",", " ", "\n\n"], k=rng.randint(0, 12))) + '"'
    return f"plain{rng.randint(0, 99)}"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three files: no last line break, header only, carriage returns."""
    rng, path = random.Random(4), tmp_path_factory.mktemp("csv")
    for i, (rows, end) in enumerate([(40, "\n"), (0, "\n"), (40, "\r\n")]):
        lines = ["﻿x,y,z", *(",".join(cell(rng) for _ in range(3)) for _ in range(rows))]
        text = end.join(lines) + (end if i else "")
        (path / f"{i}.csv").write_text(text, encoding="utf8", newline="")
    return path


@pytest.mark.parametrize("size", [10_000, 200, 61, 29, 13])
def test_equals_whole_files(spark, folder, size):
    want = whole(spark, folder)
    with blocks_of(spark, size):
        assert cut(spark, folder) == want


def test_more_blocks_than_tasks_may_know(spark, folder, monkeypatch):
    monkeypatch.setattr(split_csv, "BROADCAST_BLOCKS", 3)
    want = whole(spark, folder)
    with blocks_of(spark, 61):
        assert cut(spark, folder) == want


def test_every_border(spark, tmp_path):
    """One file of one quoted record after another, its blocks one byte longer each time."""
    text = 'x,y,z\n"1\n2",a,"\n"\n"""\n""\n",b,\n\n3,"c\n\n",4\n'
    (tmp_path / "f.csv").write_text(text, newline="")
    want = whole(spark, tmp_path)
    assert len(want) == 3
    for size in range(1, len(text) + 1, 3):
        with blocks_of(spark, size):
            assert cut(spark, tmp_path) == want, size


def test_record_longer_than_many_blocks(spark, tmp_path):
    body = "line\n" * 400
    (tmp_path / "f.csv").write_text(f'x,y,z\n1,"{body}",2\n3,4,5\n')
    with blocks_of(spark, 50):
        got = split_csv.read_split_csv(spark, str(tmp_path), SCHEMA)
        assert sorted(map(tuple, got.collect())) == [("1", body, "2"), ("3", "4", "5")]
        assert split_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_header_longer_than_a_block(spark, tmp_path):
    (tmp_path / "f.csv").write_text('"x\n\nlong","y\n\n",z\n1,2,3\n')
    for size in (2, 5, 9, 100):
        with blocks_of(spark, size):
            assert cut(spark, tmp_path) == ["Row(x='1', y='2', z='3')"], size


def test_lines_are_not_shuffled(spark, folder):
    with blocks_of(spark, 61):
        within = plan(split_csv.split_records(spark, str(folder))).split("MapInArrow")[1]
    assert "BroadcastHashJoin" in within
    assert "Exchange hashpartitioning" not in within.split("Window")[0].split("Union")[0].split("Project [kind")[0]


def test_splits_that_changed_are_refused(spark, folder):
    with blocks_of(spark, 61):
        read = split_csv.split_records(spark, str(folder))
    with pytest.raises(Exception, match="split differently"):
        read.collect()


def test_reviews_with_line_breaks(spark, tmp_path):
    header = ",".join(raw.ENTITIES["order_reviews"].columns)
    (tmp_path / "reviews.csv").write_text(f'{header}\nr1,o1,5,,"two\nlines",2018-01-01,2018-01-02\nr2,o2,4,"","x",,\n')
    with blocks_of(spark, 40):
        got = sorted(map(tuple, raw.read_raw(spark, str(tmp_path), "order_reviews").collect()))
    assert got == [("r1", "o1", "5", "", "two\nlines", "2018-01-01", "2018-01-02"), ("r2", "o2", "4", "", "x", "", "")]
