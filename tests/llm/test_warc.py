import gzip
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In

from nightgrid.llm import warc


def pages(spark, path):
    return spark.read.parquet(f"{path}/pages.parquet")


def expected(spark, path):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages(spark, path).collect()]
    newest = {}
    for i, data in rows:
        if i is not None:
            newest[data] = max(i, newest.get(data, i))
    out = []
    for i, data in rows:
        other = i is not None and newest[data] != i
        out.append((i, len(data), warc.sha1_base32(data), "revisit" if other else "response", newest[data] if other else None))
    return sorted(out, key=repr)


def test_round_trip(spark, any_dir, rows):
    assert rows(warc.op3_warc(spark, any_dir)) == expected(spark, any_dir)


@pytest.fixture(scope="module")
def archive(spark, odd_dir, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('warc')}/out"
    warc.archive_pages(pages(spark, odd_dir), path)
    return path


def test_filters_are_pushed_down(spark, archive):
    found = warc.read_archives(spark, archive).where("record_type = 'revisit' AND refers_to IN ('5', '11')")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\) Filter|- Filter", text)
    assert {r.record_id for r in found.collect()} == {"0", "1", "3", "4", "10"}
    reader = warc.WarcReader({"path": archive}, found.schema)
    tests = [EqualTo(("record_type",), "response"), EqualTo(("payload_length",), 3), In(("target_uri",), ("a", "b"))]
    assert list(reader.pushFilters(tests)) == tests[1:2] and reader.filters == [tests[0], tests[2]]


def test_headers_alone(spark, archive):
    full = warc.read_archives(spark, archive).where("record_id RLIKE '^[0-9]+$'")
    light = warc.read_archives(spark, archive, payload=False).where("record_id RLIKE '^[0-9]+$'")
    columns = ["record_id", "record_type", "target_uri", "payload_length", "payload_digest"]
    key = F.to_json(F.struct(*columns)).alias("row")
    assert sorted(r.row for r in full.select(key).collect()) == sorted(r.row for r in light.select(key).collect())
    assert light.where("payload IS NOT NULL").count() == 0 and full.where("digest_ok").count() > 0
    assert full.where("target_uri LIKE '%Injected%'").first().target_uri == "http://q.net/fr/4%0D%0AInjected:%20yes"


def other_forms(tmp_path, compress):
    records = [
        warc.page_record({"record_id": str(k), "target_uri": "http://a/", "payload": bytes([65 + k % 26]) * k, "refers_to": None}, "2026-01-01T00:00:00Z")
        for k in (0, 10, 100_000, 3, 2_500_000, 1)
    ]
    path = tmp_path / f"x.warc{'.gz' if compress else ''}"
    path.write_bytes(b"".join(gzip.compress(r) if compress else r for r in records))
    return str(tmp_path)


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("payload", [True, False])
def test_foreign_archives(spark, tmp_path, compress, payload):
    """Members without lengths, and files without compression."""
    found = warc.read_archives(spark, other_forms(tmp_path, compress), payload)
    assert sorted(r.payload_length for r in found.collect()) == [0, 1, 3, 10, 100_000, 2_500_000]
    assert found.where("record_id = '3'").count() == 1


def test_files_are_bounded_and_tasks_even(spark, odd_dir, tmp_path):
    warc.register(spark)
    rows = spark.range(50).selectExpr("string(id) record_id", "'u' target_uri", "binary(repeat(uuid(), 50)) payload", "string(null) refers_to")
    rows.coalesce(1).write.format("warc").option("fileBytes", 2000).mode("append").save(str(tmp_path / "a"))
    files = list((tmp_path / "a").glob("*.warc.gz"))
    assert len(files) > 3
    found = spark.read.format("warc").option("partitionBytes", 5_000).load(str(tmp_path / "a")).where("record_type = 'response'")
    assert found.count() == 50 and 1 < found.rdd.getNumPartitions() < len(files)


def test_a_broken_archive_is_an_error(spark, tmp_path):
    (tmp_path / "bad.warc.gz").write_bytes(gzip.compress(b"not a record"))
    with pytest.raises(Exception, match="no WARC record"):
        warc.read_archives(spark, str(tmp_path)).count()
