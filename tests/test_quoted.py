"""Line breaks inside quotes, with splits of a few bytes, against a sequential reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from nightgrid.sources import exports, quoted

VALUES = ["", "a", "plain text", 'say "x"', "two\nlines", "\n", "three\n\nlines, and more", '"', 'stray " in text', "NoID", 'end"\n"begin', " pad "]


def sequential(spark, path):
    """What one task that reads a whole file finds."""
    raw = exports.read_all_string_csv(spark, path, ["n", "auto_id", "in_file", "note"], multi_line=True)
    return [list(r) for r in raw.coalesce(1).collect()]


def written_csv(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["N", "Auto\nId", "IN FILE", "note"])
    for i in range(n):
        writer.writerow([i + 1, rng.choice(VALUES), f"AAAA{i:012d}_x.wav", rng.choice(VALUES)])
    return out.getvalue()


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [90, 700, 1 << 20])
def test_splits_of_any_size_equal_a_sequential_reader(spark, tmp_path, tiny_splits, size):
    texts = {f"f{k}.csv": written_csv(k, 40) for k in range(2)}
    texts["clean.csv"] = "IN FILE,N,note\nBBBB_1.wav,7,x\n\n  \nBBBB_2.wav,8,y\n"
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    tiny_splits(size)
    found = exports.load_flat_dir(spark, str(tmp_path), keep_invalid=True).rows
    for name, text in texts.items():
        rows = found.where(F.col("source_file") == name).orderBy("_read_order").collect()
        if name == "clean.csv":
            assert [(r.in_file, r.n, r.auto_id) for r in rows] == [("BBBB_1.wav", "7", None), ("BBBB_2.wav", "8", None)]
        else:
            assert [[r.n, r.auto_id, r.in_file, r.note] for r in rows] == sequential(spark, str(tmp_path / name))


def test_a_value_over_many_splits(spark, tmp_path, tiny_splits):
    long = "\n".join(f"line {i}" for i in range(200))
    (tmp_path / "a.csv").write_text(f'N,note,IN FILE\n1,"{long}",x\n2,"a\nb",y\n3,"{long}",z\n')
    tiny_splits(64)
    rows = exports.load_flat_dir(spark, str(tmp_path)).rows.orderBy("_read_order").collect()
    assert [(r.n, r.note, r.in_file) for r in rows] == [("1", long, "x"), ("2", "a\nb", "y"), ("3", long, "z")]


def test_broken_species_codes_stay_whole(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('IN FILE,"Auto\nId",N\nx.wav,"MYO\nLUC",3\ny.wav,EPTFUS,1\n')
    found = exports.load_flat_dir(spark, str(tmp_path)).rows
    assert rows(found, "in_file", "auto_id", "n") == [("x.wav", "MYO\nLUC", "3"), ("y.wav", "EPTFUS", "1")]


def test_other_line_ends_and_an_open_end(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfN,IN FILE,note\r\n1,x,"a\r\nb"\r\n2,y,c\r\n3,z,"never closed\r\n4,w,d\r\n')
    rows = exports.load_flat_dir(spark, str(tmp_path)).rows.orderBy("_read_order").collect()
    assert [(r.n, r.in_file) for r in rows] == [("1", "x"), ("2", "y"), ("3", "z")]
    assert rows[0].note == "a\nb" and rows[1].note == "c"


def test_nothing_to_do_without_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('N,IN FILE,note\n1,x,"a, ""b"""\n2,y,5" mic\n3,z,"q"\n')
    assert quoted.open_splits(spark, str(tmp_path)) is None
    rows = exports.load_flat_dir(spark, str(tmp_path)).rows.orderBy("_read_order").collect()
    assert [r.note for r in rows] == ['a, "b"', '5" mic', "q"]


def test_states_of_lines(spark):
    """Bit 1: begun outside quotes it ends inside; bit 0: begun inside it ends outside."""
    cases = {
        "a,b": 0, '""': 0, 'b"",c': 0, 'b",c': 1, 'x"y': 1, 'a,"b"': 1, 'a,"b",c"d': 1, 'b",c,"d': 2, 'a,"b': 3, '"': 3, '"a""': 3,
    }
    df = spark.createDataFrame([(k,) for k in cases], "value string").select("value", quoted._turn(F.col("value")).alias("turn"))
    assert {r.value: r.turn for r in df.collect()} == cases
