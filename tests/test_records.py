"""Quoted values that span lines, blocks and files; how many jobs and tasks reading takes."""

from __future__ import annotations

import csv
import io
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources.records import line_ends, with_beginnings
from tallyhouse.sources.text import Hints, read_delimited, sniff

HEADER = ["id", "name", "note"]


@pytest.fixture
def small_blocks(spark):
    """Splits of some bytes, as a file of gigabytes has splits of megabytes."""
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def value(rng: random.Random, newline: str) -> str:
    parts = ["a", "Пётр", "x y", ",", '"', newline, newline, 'say "hi"', newline + ",", '",', '""', "5 in"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 7)))


def table(seed: int, rows: int, newline: str = "\n") -> tuple[list[list[str]], str]:
    rng = random.Random(seed)
    data = [[str(i), value(rng, newline), value(rng, newline)] for i in range(rows)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(HEADER)
    for row in data:
        writer.writerow(row)
    return data, out.getvalue()


def ordered(frame) -> list[list[str]]:
    rows = frame.orderBy("seq_part", "seq_block", "seq_row").collect()
    return [[r[c] for c in HEADER] for r in rows]


@pytest.mark.parametrize(("encoding", "newline"), [("utf-8", "\n"), ("utf-8", "\r\n"), ("cp1251", "\n"), ("utf-8-sig", "\n")])
def test_values_that_span_lines(spark, tmp_path, small_blocks, encoding, newline):
    data, text = table(1, 60, newline)
    path = tmp_path / "feed.csv"
    path.write_bytes(text.encode(encoding))
    found = read_delimited(spark, [str(path)], HEADER)
    assert ordered(found) == data
    assert found.select("seq_block").distinct().count() > 10


def test_as_one_piece(spark, tmp_path, small_blocks):
    """Quotes in places where the standard has none: the same rows as from a reader that takes the file whole."""
    text = 'id,name,note\n1,a"b,"x\n2"\n3,"q""\n\n,",5" pipe\n4,"",""""\n\n5,"a"tail,z\n6,"""\n""",\n7, "not quoted,y\n8,"last\nline"'
    path = tmp_path / "odd.csv"
    path.write_text(text)
    whole = spark.read.schema("id string, name string, note string").option("header", True).option("escape", '"').option("multiLine", True).csv(str(path))
    assert ordered(read_delimited(spark, [str(path)], HEADER)) == [list(r) for r in whole.collect()]


def test_a_file_with_quoted_newlines_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    data, text = table(2, 40)
    path = tmp_path / "feed.csv"
    path.write_text(text)
    assert sniff(spark, [str(path)])[0].quoted_newlines
    found = read_delimited(spark, [str(path)], HEADER)
    lines = spark.read.option("lineSep", "\n").text(found.inputFiles())
    assert lines.select(F.spark_partition_id()).distinct().count() > 1
    assert ordered(found) == data


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    note = "\n".join(f"line {i}, with more" for i in range(100))
    path = tmp_path / "feed.csv"
    path.write_text(f'id,name,note\n1,a,"{note}"\n2,b,c\n')
    assert ordered(read_delimited(spark, [str(path)], HEADER)) == [["1", "a", note], ["2", "b", "c"]]


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(files: int) -> int:
        folder = tmp_path / f"set{files}"
        folder.mkdir()
        paths, want = [], []
        for i in range(files):
            data, text = table(i, 3)
            (folder / f"{i:03}.csv").write_text(text if i % 2 else "id,name,note\n1,a,b\n")
            paths.append(str(folder / f"{i:03}.csv"))
            want += data if i % 2 else [["1", "a", "b"]]
        group = f"files-{files}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            frame = read_delimited(spark, paths, HEADER)
            planning = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert ordered(frame) == want
        return planning

    assert jobs(4) == jobs(28)


def test_hints_spare_the_pass(spark, tmp_path):
    data, text = table(3, 10)
    path = tmp_path / "feed.csv"
    path.write_text(text)
    assert ordered(read_delimited(spark, [str(path)], HEADER, hints=Hints("UTF-8", True))) == data


def plain_ends(line: str, inside: bool) -> bool:
    i, field = 0, not inside
    while i < len(line):
        if inside:
            if line[i] == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    inside = False
            field = False
        elif line[i] == '"' and field:
            inside = True
        else:
            field = line[i] == ","
        i += 1
    return inside


def test_line_ends_equal_a_walk(spark):
    lines = ["".join(p) for n in range(7) for p in product('",a', repeat=n)]
    frame = spark.createDataFrame([(x,) for x in lines], "line string").select("line", line_ends(F.col("line"), ",").alias("e"))
    for r in frame.collect():
        assert (r.e.outside, r.e.inside) == (plain_ends(r.line, False), plain_ends(r.line, True)), r.line


def test_states_compose(spark):
    rng = random.Random(8)
    groups = [[(rng.random() < 0.4, rng.random() < 0.6) for _ in range(rng.randint(1, 30))] for _ in range(25)]
    rows = [(g, i, ends) for g, steps in enumerate(groups) for i, ends in enumerate(steps)]
    frame = spark.createDataFrame(rows, "g int, i int, ends struct<outside: boolean, inside: boolean>")
    found = {(r.g, r.i): (r.begins0, r.begins1) for r in with_beginnings(frame, ("g",), "i").collect()}
    for g, steps in enumerate(groups):
        states = [False, True]
        for i, ends in enumerate(steps):
            assert found[g, i] == tuple(states)
            states = [ends[s] for s in states]
