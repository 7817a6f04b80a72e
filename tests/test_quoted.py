"""Delimited files with newlines inside quotes, cut into pieces anywhere."""

import csv
import io
import random

import pytest

from inkmill.sources import readers
from inkmill.sources.quoted import quoted_records

FIELDS = ["", "plain", 'a "quoted" word', "two\nlines", "\n", "\n\n\n", '"', '""', ",", "ends\r", "a\r\nb", "ä€𝄞", '\n"\n"\n', "x" * 300 + "\n" + "y" * 300]


def write(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL)
    writer.writerow(["id", "a", "b"])
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.fixture()
def small_pieces(spark):
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size,end", [(37, "\n"), (64, "\r\n"), (500, "\n"), (1 << 20, "\n")])
def test_rows_of_pieces(spark, small_pieces, tmp_path, size, end):
    rng = random.Random(size)
    files = {}
    for f in range(3):
        files[f] = [(f * 100 + i, rng.choice(FIELDS), rng.choice(FIELDS)) for i in range(12 * f)]
        write(tmp_path / f"{f}.csv", files[f], end)
    small_pieces(size)
    back = readers.scan_csv(spark, {"all": str(tmp_path)}, "id bigint, a string, b string", multi_line=True)
    want = sorted((i, a or None, b or None) for rows in files.values() for i, a, b in rows)
    assert sorted((r.id, r.a, r.b) for r in back.collect()) == want


def test_one_file_is_many_tasks(spark, small_pieces, tmp_path):
    write(tmp_path / "x.csv", [(i, "two\nlines", "b") for i in range(400)])
    small_pieces(1000)
    back = readers.scan_csv(spark, {"all": str(tmp_path / "x.csv")}, "id bigint, a string, b string", multi_line=True)
    assert back.rdd.getNumPartitions() > 8 and back.count() == 400
    assert sum(1 for n in back.rdd.glom().map(len).collect() if n) > 8


def test_record_over_many_pieces(spark, small_pieces, tmp_path):
    long = "\n".join(f"line {i}" for i in range(500))
    write(tmp_path / "x.csv", [(1, long, "b"), (2, "c", long), (3, "d", "e")])
    small_pieces(100)
    back = readers.scan_csv(spark, {"all": str(tmp_path)}, "id bigint, a string, b string", multi_line=True)
    assert {r.id: (r.a, r.b) for r in back.collect()} == {1: (long, "b"), 2: ("c", long), 3: ("d", "e")}


def test_odd_files(spark, small_pieces, tmp_path):
    """Empty files, a long header, empty lines, no line end at the end, a quote that is never closed."""
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text('id,"a\nlong\nhead\ner\nof\nlines",b')
    (tmp_path / "rows.csv").write_text('id,a,b\n\n1,"x\n\ny",z\n\n2,,\n3,"never\nclosed')
    for size in (5, 1 << 20):
        small_pieces(size)
        records = quoted_records(spark, str(tmp_path)).collect()
        assert sorted(r.record for r in records) == ['1,"x\n\ny",z', "2,,", '3,"never\nclosed']
    assert len(quoted_records(spark, str(tmp_path), header=False).collect()) == 5
