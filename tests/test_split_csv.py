"""Large CSV files with line breaks in fields: split over tasks, equal to the one-task read."""

import random

import pytest

from tallymart.sources import files, split_csv
from tallymart.sources.files import read_reference


@pytest.fixture
def small_splits(spark):
    """Splits of 2 KB, a file each, so that small files are cut into many."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "2048")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def table(n, rng, odd=True):
    fields = ["plain", "", '""', '"quoted"', '"a, b"', '"two\nlines"', '"say ""no""\nand\n\ngo"', "ü ß", '" "', "  ", '"""x"""', "5"]
    rows = [",".join([f"id{k}", *[rng.choice(fields) for _ in range(3)]]) for k in range(n)]
    if odd:
        rows[3:3] = ["", "short,row", "long,a,b,c,d,e", "   ", '"' + "wide\n" * 2_000 + '",x,y,z']
    return "id,one,two,three\n" + "\n".join(rows) + "\n"


def rows(frame):
    return [tuple(r)[:-1] for r in sorted(frame.collect(), key=lambda r: tuple(r["_order"]))]


def whole(spark, path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(files, "is_split", lambda *_: False)
        return rows(read_reference(spark, path))


@pytest.mark.parametrize("bom", ["", "﻿"])
def test_equal_to_the_one_task_read(spark, tmp_path, small_splits, monkeypatch, bom):
    rng = random.Random(2)
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / f"in/{k}.csv").write_text(bom + table(400, rng), encoding="utf-8")
    path = str(tmp_path / "in")
    records = split_csv.read_records(spark, path)
    assert records.select("file", "block").distinct().count() > 12
    frame = read_reference(spark, path)
    assert frame.columns == ["id", "one", "two", "three", "_order"]
    found = rows(frame)
    assert found == whole(spark, path, monkeypatch) and len(found) == 808
    assert {r[0].count("\n") for r in found} == {0, 2_000}  # records that span several splits


@pytest.mark.parametrize("damage", ['id9,a"b"c,d,e', 'id9,"open,c,d', 'id9,"a"b,c,d', "id9,a\r,c,d"])
def test_stray_quotes_are_read_from_the_start(spark, tmp_path, small_splits, monkeypatch, damage):
    lines = table(300, random.Random(4), odd=False).split("\n")
    lines.insert(200, damage)
    path = tmp_path / "x.csv"
    path.write_text("\n".join(lines))
    assert split_csv.is_split(spark, str(path))
    assert split_csv.read_records(spark, str(path)) is None
    assert rows(read_reference(spark, str(path))) == whole(spark, str(path), monkeypatch)


def test_a_record_that_is_too_long(spark, tmp_path, small_splits, monkeypatch):
    path = tmp_path / "x.csv"
    path.write_text(table(50, random.Random(5)))
    monkeypatch.setattr(split_csv, "RECORD_BYTES", 5_000)
    assert split_csv.read_records(spark, str(path)) is None
    assert rows(read_reference(spark, str(path))) == whole(spark, str(path), monkeypatch)


def test_another_header_and_small_files(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/0.csv").write_text("a,b\n" + "1,2\n" * 2_000)
    assert read_reference(spark, str(tmp_path / "in/0.csv")).count() == 2_000
    (tmp_path / "in/1.csv").write_text("a,c\n" + "1,2\n" * 2_000)
    with pytest.raises(Exception, match="header|CSV"):
        read_reference(spark, str(tmp_path / "in")).count()
    (tmp_path / "small.csv").write_text('a,b\n1,"x\ny"\n')
    assert not split_csv.is_split(spark, str(tmp_path / "small.csv"))
    assert rows(read_reference(spark, str(tmp_path / "small.csv"))) == [("1", "x\ny")]
