import csv
import io
import random

import pyarrow as pa
import pytest
from conftest import rows

from tideline.sources import csv_blocks, landed


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few dozen bytes, so that records, and single lines, span many."""
    old = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        for name in old:
            spark.conf.set(name, str(size))

    yield cut
    for name, value in old.items():
        spark.conf.set(name, value)


def write(folder, texts):
    for name, text in texts.items():
        target = folder / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(text.encode())
    return str(folder)


def key(row):
    return tuple("" if value is None else value for value in row)


def csv_text(data, end):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(data)
    return out.getvalue()


@pytest.mark.parametrize("size", [40, 173, 4000, 1_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_files_against_a_serial_parser(spark, tmp_path, small_blocks, size, end):
    rng = random.Random(size)
    pieces = ["a", "é", "two words", ",", '"', '""', "\n", "\n\n", ", ", "x" * 30, "\n" * 12]
    files, want = {}, []
    for n in range(3):
        names = ["A", "B", "C", "unused"]
        rng.shuffle(names)
        data = [["".join(rng.choices(pieces, k=rng.randrange(4))) + "." for _ in names] for _ in range(120)]
        files[f"day=0{n}/part.csv"] = csv_text([names, *data], end)
        want += [(*[row[names.index(c)] for c in "ABC"], f"0{n}") for row in data]
    path = write(tmp_path, files)
    small_blocks(size)
    out = csv_blocks.read_csv_blocks(spark, path, ["A", "B", "C"], ["day"])
    if size == 40:
        assert spark.read.text(path).rdd.getNumPartitions() > 100
    assert out.columns == ["A", "B", "C", "day"]
    assert sorted(rows(out)) == sorted(want)


def test_equals_the_reader_of_whole_files(spark, tmp_path, small_blocks):
    path = write(
        tmp_path,
        {
            "s=01/a.csv": '﻿B,A,A\r\n1,"x\ny",z\r\n,"",\r\n\r\n"q ""r""",  padded ,\r\n',
            "s=02/a.csv": "A,C\n5,6\n7\n8,9,10\n",
            "s=03/a.csv": "C\nonly\n",
            "s=04/a.csv": "",
            "s=05/a.csv": "A,B\n",
            "s=06/a.csv": "A,B\nno,end",
        },
    )
    small_blocks(11)
    got = csv_blocks.read_csv_blocks(spark, path, ["A", "B"], ["s"])
    want = landed.read_csv_text(spark, path, ["A", "B"], ["s"])
    assert sorted(rows(got), key=key) == sorted(rows(want), key=key)
    assert got.count() == 8


def test_no_files_but_empty_ones(spark, tmp_path):
    path = write(tmp_path, {"s=1/a.csv": ""})
    assert csv_blocks.read_csv_blocks(spark, path, ["A"], ["s"]).count() == 0


@pytest.mark.parametrize(
    ("text", "message"),
    [('A,B\n1,"open\n2,3\n', "odd number of quotes"), ('A,B\n1,5" pipe\n2,6" pipe\n', "not quoted"), ('A,B\n1,x"y"z\n', "not quoted")],
)
def test_other_quotes_fail_with_the_name_of_the_file(spark, tmp_path, text, message):
    path = write(tmp_path, {"s=1/odd.csv": text})
    with pytest.raises(Exception, match=f"{message}.*odd.csv"):
        csv_blocks.read_csv_blocks(spark, path, ["A", "B"], ["s"]).collect()


def test_files_without_line_breaks_are_not_shuffled(spark, tmp_path):
    path = write(tmp_path, {"s=1/a.csv": "A,B\n" + "1,2\n" * 50})
    plan = csv_blocks.read_csv_blocks(spark, path, ["A", "B"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("FileScan text") == 1


def test_the_pass_that_counts_quotes_gives_rows_of_blocks_not_of_lines():
    names = {"value": ["h", "1", '"2', '3"', "4"], "_file": ["f"] * 4 + ["g"], "_block": [0] * 5, "_length": [9] * 5}
    [found] = csv_blocks._counted_blocks([pa.RecordBatch.from_pydict(names)])
    assert found.drop_columns(["_length", "_block"]).to_pylist() == [
        {"_file": "f", "_number": 3, "_odd": 0, "_start0": 2, "_start1": 3, "_any": 1, "_head": "h"},
        {"_file": "g", "_number": 0, "_odd": 0, "_start0": 0, "_start1": -1, "_any": 0, "_head": "4"},
    ]
