"""Files read by byte ranges against the reader for whole files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from quillspark.sources import csv_blocks
from quillspark.sources.tables import read_csv


@pytest.fixture
def small_ranges(spark):
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", size), spark.conf.set("spark.sql.files.openCostInBytes", 1))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(draw, rows, line_end, bom, header="text"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow(["id", header, "z"])
    for k in range(rows):
        cell = "".join(draw.choice(["a", '"', "\n", ",", " ", "é", "🙂", "xx", ""]) for _ in range(draw.randrange(30)))
        writer.writerow([k, ("long " * 200 + "\n") * 3 if draw.random() < 0.05 else cell, draw.choice(["", "q\n\nr", '"'])])
    return ("﻿" if bom else "") + out.getvalue()


STRAY = '900,5" disk,3\n\n901,a"b"c,"x"y\n902\n903,1,2,3,4\n\n904,"open, to the\nend'


@pytest.mark.parametrize(("size", "line_end", "bom", "header", "tail"), [(41, "\n", True, "text", STRAY), (97, "\n", False, "te\nxt", ""), (3000, "\n", True, "te\nxt", STRAY), (60, "\r\n", True, "text", "")])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, small_ranges, size, line_end, bom, header, tail):
    draw = random.Random(size)
    (tmp_path / "a.csv").write_text(made(draw, 25, line_end, bom, header) + tail, newline="")
    (tmp_path / "b.csv").write_text(made(draw, 5, line_end, False, header), newline="")
    small_ranges(size)
    want = read_csv(spark, str(tmp_path))
    got = read_csv(spark, str(tmp_path), large=0)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert csv_blocks._lines(spark, str(tmp_path)).select("file", "block").distinct().count() > (10 if size < 100 else 1)


def test_one_cell_over_many_ranges(spark, tmp_path, small_ranges):
    """A range that lies wholly inside a cell belongs to the record that began before it; headers alone and empty files have no records."""
    cell = "line, of text\n" * 300
    (tmp_path / "a.csv").write_text(f'id,text\n1,x\n2,"{cell}"\n3,"{cell}"\n4,y\n')
    (tmp_path / "b.csv").write_text("id,text\n")
    (tmp_path / "c.csv").write_text("")
    small_ranges(200)
    got = {r.id: r.text for r in read_csv(spark, str(tmp_path), large=0).collect()}
    assert got == {"1": "x", "2": cell, "3": cell, "4": "y"}


def test_large_files_are_read_by_ranges_and_moved_lines_are_few(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{k},"a\nb"\n' for k in range(2000)))
    small_ranges(2000)
    assert csv_blocks.largest_file(spark, str(tmp_path)) == (tmp_path / "a.csv").stat().st_size
    df = read_csv(spark, str(tmp_path), large=1000)
    assert df.select(F.count("*"), F.sum("id")).first()[:] == (2000, 1999000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_transitions():
    opens = csv_blocks.ends_inside
    assert [opens(x, False) for x in ("a,b", '"a', 'a"b', '"a"b', '"a""', 'x,"', '"a","b', '5" disk,"x"')] == [False, True, False, False, True, True, True, False]
    assert [opens(x, True) for x in ("a,b", 'a"', 'a""', 'a","b', 'a",b', '"')] == [True, False, True, True, False, False]
    assert opens('"' + '""' * 200_000, False)
