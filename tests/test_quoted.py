"""Text with line breaks in quotes, read in many splits."""

import random

import pytest
from pyspark.sql.types import IntegerType, StringType, StructType

from fleetmart.sources import raw as raw_files
from fleetmart.sources.quoted import records

SCHEMA = StructType().add("id", IntegerType()).add("note", StringType()).add("more", StringType())


def text_of(seed, rows, end="\n"):
    rnd = random.Random(seed)
    parts = ["a", ",", "\n", '""', "\n\n", "word ", "é", '"",""', "\n,5,", ""]
    out = [f"id,note,more{end}"]
    for k in range(rows):
        note = "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 12)))
        field = rnd.choice([f'"{note}"', "plain", "", '""'])
        out.append(f"{k},{field},{rnd.choice(['x', '', '\"y\n\n\"'])}{end}")
        if rnd.random() < 0.05:
            out.append(end)
    return "".join(out)


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (str(size), "0"), strict=True)]
    for name, value in zip(names, old, strict=True):
        spark.conf.set(name, value)


def multiline(spark, path):
    read = spark.read.schema(SCHEMA).options(header=True, mode="FAILFAST", nullValue=r"\N", escape='"')
    return sorted(map(tuple, read.option("multiLine", True).csv(path).collect()), key=repr)


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_splits_equal_one_task_a_file(spark, tmp_path, small_splits, size):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.csv").write_text(text_of(k, 150 if size > 7 else 20))
    (folder / "none.csv").write_text("")
    (folder / "head.csv").write_text("id,note,more\n")
    want = multiline(spark, str(folder))
    small_splits(size)
    got = raw_files.read_csv(spark, str(folder), SCHEMA, multiline=True)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 5
    text = raw_files.read_text(spark, str(folder), SCHEMA, multiline=True)
    assert text.count() == len(want) and dict(text.dtypes)["id"] == "string"


def test_a_record_longer_than_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    long = "\n".join(str(n) for n in range(2000))
    path.write_text(f'"id\n",note,more\n1,"{long}",x\n2,b,"c\n"')
    small_splits(50)
    got = sorted(map(tuple, raw_files.read_csv(spark, str(path), SCHEMA, multiline=True).collect()))
    assert got == [(1, long, "x"), (2, "b", "c\n")]


def test_windows_line_ends_and_blank_starts(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_bytes(b'\r\n\r\nid,note,more\r\n1,"a\r\nb",x\r\n\r\n2,,"y"\r\n')
    small_splits(9)
    got = sorted(map(tuple, raw_files.read_csv(spark, str(path), SCHEMA, multiline=True).collect()))
    assert got == [(1, "a\r\nb", "x"), (2, None, "y")]


def test_malformed_rows_fail(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,note,more\none,"a\nb",x\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        raw_files.read_csv(spark, str(path), SCHEMA, multiline=True).collect()
    assert raw_files.read_text(spark, str(path), SCHEMA, multiline=True).first()["id"] == "one"


def test_the_header_is_marked(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(text_of(9, 50))
    found = records(spark, str(path))
    assert [r["record"] for r in found.where("is_header").collect()] == ["id,note,more"]
    assert found.count() == 51
