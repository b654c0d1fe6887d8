"""Multi-line CSV in byte ranges: records over split borders, quotes, line ends."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textrail.sources.csv_ranges import csv_records, read_csv_ranges

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text", "note")])


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "text", "note"])
        w.writerows(rows)


def test_a_file_is_read_by_several_tasks_whatever_lies_on_the_borders(spark, tmp_path, small_splits):
    rng = random.Random(5)
    parts = ["plain", "a \"quoted\" word", "line\nbreak", "\n\n", "comma, here", "\"", "é and 漢", "x" * 90]
    want = [(f"f{k}-{i}", " ".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 5, 30]))), "end") for k in range(2) for i in range(200)]
    want[50] = ("f0-50", "a very long value\n" * 300, "end")  # spans whole splits
    for k in range(2):
        _write(tmp_path / f"part{k}.csv", [r for r in want if r[0].startswith(f"f{k}-")])
    records = csv_records(spark, str(tmp_path))
    assert records.groupBy("file").agg(F.countDistinct("block").alias("n")).where("n > 10").count() == 2
    got = read_csv_ranges(spark, str(tmp_path), SCHEMA).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_line_ends_marks_blank_and_short_records(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffid,text,note\r\n1,\"two\r\nlines\",x\r\n\r\n2,,\r\n3,only".encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    got = {r.id: (r.text, r.note) for r in read_csv_ranges(spark, str(tmp_path), SCHEMA).collect()}
    assert got.keys() == {"1", "2", "3"} and got["2"] == (None, None) and got["3"] == ("only", None)
    assert got["1"][0].replace("\r", "") == "two\nlines" and got["1"][1] == "x"
