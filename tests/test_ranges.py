"""Files read in byte ranges against the reader that takes a file as one piece."""

import csv
import io
import json
import random

import pytest

from notemill.plans import queries
from notemill.sources import landed, ranges

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=["97", "100000"])
def small_splits(spark, request):
    before, cost = spark.conf.get(SPLIT), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(SPLIT, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield int(request.param)
    spark.conf.set(SPLIT, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def objects(count, seed):
    r = random.Random(seed)
    odd = ['plain', 'quote " inside', 'brace } { ] [', 'back\\slash', 'ends in \\', 'tab\tline\nend', '', 'é 漢 😀', '},{"id":9}', '\\"}']
    return [
        {"id": i, "name": r.choice(odd) + str(i), "tags": [r.choice(odd) for _ in range(r.randint(0, 3))], "info": {"a": r.choice(odd), "b": {"c": r.choice([None, 1.5, i])}}}
        for i in range(count)
    ]


SCHEMA = "id bigint, name string, tags array<string>, info struct<a: string, b: struct<c: double>>"


@pytest.mark.parametrize("layout", ["compact", "indented", "spaced", "ascii"])
def test_arrays_equal_the_whole_file_reader(spark, tmp_path, small_splits, layout):
    for k, count in enumerate((30, 1, 0, 7)):
        rows = objects(count, k)
        text = {
            "compact": lambda: json.dumps(rows, separators=(",", ":"), ensure_ascii=False), "indented": lambda: json.dumps(rows, indent=2, ensure_ascii=False),
            "spaced": lambda: "\n [ " + " ,\r\n ".join(json.dumps(x, ensure_ascii=False) for x in rows) + "\n]\n\n", "ascii": lambda: json.dumps(rows),
        }[layout]()
        (tmp_path / f"f{k}.json").write_text(text, encoding="utf-8", newline="")
    (tmp_path / "one.json").write_text(json.dumps(objects(1, 9)[0], indent=1))
    got = ranges.read_arrays(spark, str(tmp_path), SCHEMA)
    want = spark.read.schema(SCHEMA).json(str(tmp_path), multiLine=True).filter("id IS NOT NULL")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    if small_splits == 97:
        assert ranges.pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() > 25


def test_an_object_cut_off_stays_as_an_empty_row(spark, tmp_path, small_splits):
    (tmp_path / "cut.json").write_text(json.dumps(objects(20, 1))[:-60])
    got = ranges.read_arrays(spark, str(tmp_path / "cut.json"), SCHEMA)
    assert [r.id for r in got.orderBy("id").collect()].count(None) == 1 and got.filter("id < 19").count() == 19


def sheet_rows(count, seed):
    r = random.Random(seed)
    odd = ["plain", "with, comma", 'say "hi"', "two\nlines", "\n\nblank\n\nlines\n", '"', '""\n"', "", "é\r\nü", "ends\n", "a\n,b"]
    return [[r.choice(odd), "", r.choice(odd), str(i), r.choice(odd)] for i in range(count)]


def written(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def test_sheets_equal_the_whole_file_reader(spark, tmp_path, small_splits, rows):
    data = sheet_rows(80, 3)
    head = [["", "", "", "", ""], ["Song Name", "", "Old\nDiff", "New Diff!", "Date"]]
    path = tmp_path / "2001 Difficulty Changes.csv"
    path.write_text(written([*head, *data[:40]]) + "\n\n" + written(data[40:]), encoding="utf-8", newline="")
    sheet = landed.read_sheet(spark, str(tmp_path), "2001 Difficulty Changes")
    got = [tuple(r) for r in sheet.orderBy("sheet_row").collect()]
    plain = lambda text: text.replace("\r\n", "\n")
    assert sheet.columns == ["Song Name", "Old\nDiff", "New Diff!", "Date", "sheet_row"]
    assert [r[-1] for r in got] == list(range(1, 81))
    assert [tuple(plain(c or "") for c in r[:-1]) for r in got] == [tuple(plain(r[i]) for i in (0, 2, 3, 4)) for r in data]
    one_task = spark.read.csv(str(path), multiLine=True, escape='"').collect()
    assert [tuple(r[:-1]) for r in got] == [tuple(plain(c) if c else c for i, c in enumerate(r) if i != 1) for r in one_task[2:]]


def test_sheets_of_part_files(spark, tmp_path, small_splits):
    data, folder = sheet_rows(60, 4), tmp_path / "2002 Difficulty Changes.csv"
    folder.mkdir()
    head = [[""] * 5, ["A", "", "B", "N", "C"]]
    for k, part in enumerate([head + data[:25], data[25:26], data[26:]]):
        (folder / f"part-{k:05d}.csv").write_text(written(part), encoding="utf-8", newline="")
    got = landed.read_sheet(spark, str(tmp_path), "2002 Difficulty Changes").orderBy("sheet_row").collect()
    assert [(r.sheet_row, r.N) for r in got] == [(i + 1, str(i)) for i in range(60)]


def test_the_number_of_small_ranges_is_bounded(spark, tmp_path, monkeypatch):
    """Each range is a task that reports to the driver."""
    monkeypatch.setattr(queries, "RANGES", 8)
    for name, lines in (("short", 20), ("long", 20_000)):
        (tmp_path / name).write_text("ten bytes\n" * lines)
    before = spark.conf.get(SPLIT)
    counts = []
    for name in ("short", "long"):
        with queries.small_ranges(spark, str(tmp_path / name), 40):
            counts.append(spark.read.text(str(tmp_path / name)).select("value", "_metadata.file_block_start").distinct().select("file_block_start").distinct().count())
            assert spark.read.text(str(tmp_path / name)).count() == {"short": 20, "long": 20_000}[name]
    assert counts == [5, 8] and spark.conf.get(SPLIT) == before
