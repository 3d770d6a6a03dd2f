"""Quoted line breaks read range by range, against Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from chartloom.sources.landing import read_records_csv
from chartloom.sources.quotedcsv import read_quoted_csv


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def plain(spark, path):
    return spark.read.csv(str(path), header=True, multiLine=True, escape='"')


def value(rng):
    kind = rng.random()
    if kind < 0.2:
        return ""
    if kind < 0.5:
        return rng.choice(["a", "plain text", "é 漢", "1"])
    parts = ["x", "\n", '""', ",", "\r\n", " ", "long " * 30, "\n\n", '""""']
    return '"' + "".join(rng.choice(parts) for _ in range(rng.randrange(12))) + '"'


@pytest.mark.parametrize("seed, ending", [(0, "\n"), (1, "\r\n"), (2, "\n")])
def test_equals_the_one_task_reader(spark, tmp_path, rows, small_ranges, seed, ending):
    rng = random.Random(seed)
    for part in range(3):
        lines = ["id,left,right"] + [f"{part}-{i},{value(rng)},{value(rng)}" for i in range(120)]
        if seed == 2:
            lines.insert(5, "")
        (tmp_path / f"{part}.csv").write_bytes((ending.join(lines) + (ending if part else "")).encode())
    found, expected = read_quoted_csv(spark, str(tmp_path)), plain(spark, tmp_path)
    if ending == "\r\n":
        # Spark's reader turns what looks like a line's end into \n, inside values too; here values stay as they are.
        assert not found.where(F.contains("left", F.lit("\r\n"))).isEmpty()
        found, expected = (d.select("id", *[F.regexp_replace(c, "\r\n", "\n").alias(c) for c in ("left", "right")]) for d in (found, expected))
    assert rows(found) == rows(expected) and found.count() == 360


def test_a_file_is_read_by_many_tasks_and_records_may_cover_whole_ranges(spark, tmp_path, rows, small_ranges):
    path = tmp_path / "t.csv"
    long = "line\n" * 1000
    path.write_text('a,"b\nb"\n1,"' + long + '"\n2,"' + long + '""' + long + '"\n3,c\n')
    lines = spark.read.text(str(path), lineSep="\n").select("_metadata.file_block_start").distinct().count()
    assert lines > 10
    found = read_quoted_csv(spark, str(path))
    assert found.columns == ["a", "b\nb"]
    assert rows(found) == [("1", long), ("2", f'{long}"{long}'), ("3", "c")]


def test_header_alone_empty_file_and_typed_columns(spark, tmp_path, rows):
    (tmp_path / "h.csv").write_text("a,b\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "t.csv").write_text('B,A\n"x\ny",007\n"",\n')
    assert read_quoted_csv(spark, str(tmp_path / "h.csv")).collect() == []
    assert read_quoted_csv(spark, str(tmp_path / "e.csv")).collect() == []
    typed = read_records_csv(spark, str(tmp_path / "t.csv"), "A int, B string, C date")
    assert rows(typed) == sorted([(7, "x\ny", None), (None, None, None)], key=str) or rows(typed) == sorted(
        [(7, "x\ny", None), (None, "", None)], key=str
    )
    assert rows(typed.drop("C").select(F.col("B"))) == rows(plain(spark, tmp_path / "t.csv").select("B"))
