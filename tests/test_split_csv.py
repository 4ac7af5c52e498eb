"""CSV read by ranges against the reader that takes a file whole."""

import random

import pytest

from casewise.sources.readers import read_text_columns
from casewise.sources.split_csv import csv_records
from checking import plan


@pytest.fixture
def ranged(spark):
    """A session that splits files into ranges of the given size."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def cell(rng):
    value = "".join(rng.choices(["a", "é", ",", '"', "\n", "\r\n", " ", "bc", "x"], k=rng.choice([0, 1, 3, 12])))
    return '"' + value.replace('"', '""') + '"' if rng.random() < 0.3 or set(value) & set(',"\n\r') else value


def write(folder, end, seed):
    rng = random.Random(seed)
    for name in ("one.csv", "two.csv"):
        rows = [["id", '"te""xt"', "more"]] + [[str(i), cell(rng), cell(rng)] for i in range(60)]
        lines = [",".join(row) for row in rows]
        for _ in range(5):
            lines.insert(rng.randrange(1, len(lines)), "")
        (folder / name).write_bytes(end.join(lines).encode() + (end.encode() if name == "one.csv" else b""))
    return str(folder)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [97, 1 << 27])
def test_ranges_equal_whole_files(spark, tmp_path, ranged, end, size):
    path = write(tmp_path, end, size)
    columns = ["more", 'te"xt', "id"]
    whole = sorted(map(tuple, read_text_columns(spark, path, columns, by_ranges=False).collect()))
    ranged(size)
    found = read_text_columns(spark, path, columns)
    assert sorted(map(tuple, found.collect())) == whole and len(whole) == 120
    if size == 97:
        assert csv_records(spark, path).rdd.getNumPartitions() > 4


def test_one_record_over_many_ranges(spark, tmp_path, ranged):
    text = "line, and\n" * 1000
    (tmp_path / "a.csv").write_text(f'id,text\n1,"{text}"\n2,plain\n')
    ranged(1000)
    rows = read_text_columns(spark, str(tmp_path), ["id", "text"]).collect()
    assert sorted((r["id"], r["text"]) for r in rows) == [("1", text), ("2", "plain")]


def test_header_alone_and_header_with_a_break(spark, tmp_path, ranged):
    (tmp_path / "a.csv").write_text("id,text\n")
    assert read_text_columns(spark, str(tmp_path), ["id", "text"]).collect() == []
    (tmp_path / "b.csv").write_text('id,"te\nxt"\n3,"x\ny"\n')
    ranged(5)
    assert [tuple(r) for r in read_text_columns(spark, str(tmp_path / "b.csv"), ["id", "te\nxt"]).collect()] == [("3", "x\ny")]


def test_an_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"open\n2,x\n')
    with pytest.raises(Exception, match="not closed"):
        read_text_columns(spark, str(tmp_path), ["id", "text"]).collect()


def test_whole_records_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    text = plan(csv_records(spark, str(tmp_path)))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1  # the lines of records with line breaks
