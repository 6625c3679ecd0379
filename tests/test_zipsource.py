"""The archive data source against the plain scan, in batch and as a stream."""

import os

import pytest
from pyspark.sql import functions as F
from test_extract import GOOD, MEMBERS, archive

from almsflow.sources import archives, zipsource


@pytest.fixture
def land(tmp_path):
    folder = tmp_path / "land"
    folder.mkdir()
    (folder / "a.zip").write_bytes(archive(MEMBERS))
    (folder / "b.zip").write_bytes(archive({}, True))
    (folder / "c.zip").write_bytes(archive({f"{i}_p.xml": GOOD + " " * i for i in range(40)}))
    (folder / "empty.zip").write_bytes(b"")
    (folder / "other.txt").write_bytes(b"x")
    return folder


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("partition_bytes", [1 << 20, 700, 50])
def test_rows_of_the_plain_scan(spark, land, partition_bytes):
    zipsource.register(spark)
    got = spark.read.format(zipsource.FORMAT).option("partitionBytes", partition_bytes).load(str(land))
    assert rows_of(got) == rows_of(archives.scan_documents(spark, str(land)))
    assert rows_of(spark.read.format(zipsource.FORMAT).load(str(land)).limit(0)) == []


def test_tests_and_columns_reach_the_archives(spark, land, monkeypatch):
    zipsource.register(spark)
    read = spark.read.format(zipsource.FORMAT)
    every = archives.scan_documents(spark, str(land))
    for test in ("zip_name = 'a.zip'", "zip_name IN ('a.zip', 'b.zip')", "member LIKE '1%'", "member LIKE '%_x.xml' AND zip_name = 'a.zip'", "member LIKE '%2%'",
                 "error IS NOT NULL", "length(member) > 8", "member = '3_p.xml' AND xml LIKE '%5%'"):
        assert rows_of(read.load(str(land)).filter(test)) == rows_of(every.filter(test)), test
    plan = read.load(str(land)).filter("member LIKE '1%' AND zip_name = 'c.zip'")._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "StartsWith" not in plan.split("Filter")[0]
    # Only the wanted archive is planned, and without the xml column nothing is inflated.
    reader = zipsource._Reader({"path": str(land)}, read.load(str(land)).schema)
    assert list(reader.pushFilters([zipsource.EqualTo(("zip_name",), "c.zip"), zipsource.In(("member",), ("3_p.xml",)), zipsource.EqualTo(("error",), "e")])) == \
        [zipsource.EqualTo(("error",), "e")]
    planned = reader.partitions()
    assert [[p[0].rsplit("/", 1)[-1] for p in s.parts] for s in planned] == [["c.zip"]]
    assert [b.num_rows for s in planned for b in reader.read(s)] == [1]
    monkeypatch.setattr(zipsource, "read_member", lambda *a: 1 / 0)
    names = zipsource._Reader({"path": str(land)}, spark.createDataFrame([], "member string, zip_name string").schema)
    assert sum(b.num_rows for s in names.partitions() for b in names.read(s)) == 46


def test_a_folder_is_listed_once(spark, land, monkeypatch):
    calls = []
    monkeypatch.setattr(zipsource, "entries", lambda folder, missing_ok=False: calls.append(folder) or [])
    assert len(zipsource._Reader({"path": str(land)}, None).partitions()) == 1 and calls == [str(land)]


def test_stream_takes_every_archive_once(spark, land, tmp_path):
    zipsource.register(spark)
    out, checkpoint, log = (str(tmp_path / n) for n in ("out", "checkpoint", "log"))

    def run():
        stream = spark.readStream.format(zipsource.FORMAT).option("log", log).load(str(land))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return rows_of(spark.read.parquet(out))

    first = rows_of(archives.scan_documents(spark, str(land)))
    assert run() == first and run() == first
    (land / "late.zip").write_bytes(archive({"9_p.xml": GOOD}))
    os.utime(land / "late.zip", (1, 1))  # lands late with an old date
    (land / "b.zip").write_bytes(archive({"8_p.xml": GOOD}))  # repaired
    added = run()
    assert sorted(r[:2] for r in added if r not in first) == [("b.zip", "8_p.xml"), ("late.zip", "9_p.xml")] and len(added) == len(first) + 2
    with pytest.raises(Exception, match="log"):
        zipsource._StreamReader({"path": str(land)}, None)
    # A replayed batch reads what it read first, whatever has landed since.
    (land / "more.zip").write_bytes(archive({"7_p.xml": GOOD}))
    reader = zipsource._StreamReader({"path": str(land), "log": log}, spark.read.parquet(out).schema)
    assert sorted(p[0].rsplit("/", 1)[-1] for s in reader.partitions({"entries": 0}, {"entries": 1}) for p in s.parts) == ["a.zip", "b.zip", "c.zip"]
    assert reader.latestOffset() == {"entries": 3} == reader.latestOffset()


def test_many_slices_share_partitions(spark, land, monkeypatch):
    """However small the slices are asked to be, the number of partitions stays bounded, and no member is lost or doubled."""
    sized = [(f"/x/{i}.zip", 1 << 20) for i in range(7_000)]
    planned = zipsource._planned(sized, 64 << 10)
    assert len(planned) <= zipsource.MOST_PARTITIONS
    spans = sorted(p for s in planned for p in s.parts)
    assert sum(stop - first for _, _, first, stop, _ in spans) == 7_000 * 16 and {p[0] for p in spans} == {p for p, _ in sized}
    assert len(zipsource._planned(sized[:100], 64 << 10)) == 1600  # few ones are left as they were asked for
    large = zipsource._planned([("/x/large.zip", zipsource.MOST_PARTITIONS << 21)], 64 << 10)
    assert [p.parts[0][2] for p in large[1:]] == [p.parts[0][3] for p in large[:-1]] and len(large) == zipsource.MOST_PARTITIONS
    schema = archives.scan_documents(spark, str(land)).schema
    monkeypatch.setattr(zipsource, "MOST_PARTITIONS", 3)
    reader = zipsource._Reader({"path": str(land), "partitionBytes": "50"}, schema)
    parts = reader.partitions()
    got = sorted((tuple(r.values()) for s in parts for b in reader.read(s) for r in b.to_pylist()), key=str)
    assert len(parts) <= 6 and got == rows_of(archives.scan_documents(spark, str(land)))
