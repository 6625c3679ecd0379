import pytest
from pyspark.sql import functions as F, types as T

from almsflow import schemas as S
from almsflow.runtime import fresh_path, shared_dir
from almsflow.sources import csvfiles, files, incremental, links

SCHEMA = T.StructType([T.StructField("ein", S.LONG), T.StructField("name", S.STR), T.StructField("amt", S.DBL)])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text('ein,name,amt\n1,"x, ""q""\ny",2.5\n2,NA,\n')
    (tmp_path / "b.csv").write_text("amt,ein,name,extra\n7,3,none,z\nbad,4,w,z\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n")
    return tmp_path


def test_columns_matched_by_name_and_bad_rows_set_aside(spark, folder):
    good, bad = csvfiles.read_csv(spark, str(folder), SCHEMA, required=("ein",))
    assert sorted(map(tuple, good.collect())) == [(1, 'x, "q"\ny', 2.5), (2, None, None), (3, "none", 7.0)]
    assert sorted((r.file.rsplit("/", 1)[-1], r.record == "no header") for r in bad.collect()) == [("b.csv", False), ("blank.csv", True)]


def test_skip_file_policy(spark, folder):
    good, _ = csvfiles.read_csv(spark, str(folder), SCHEMA, required=("ein",), bad_file_policy="skip_file")
    assert sorted(r.ein for r in good.collect()) == [1, 2]
    with pytest.raises(ValueError):
        csvfiles.read_csv(spark, str(folder), SCHEMA, bad_file_policy="x")


def test_registry_order_decides_the_last_row(spark, tmp_path):
    (tmp_path / "r1.csv").write_text("EIN,NAME,ICO,CITY,STATE,ZIP\n1,A,,X,CT,06510-1\n2,A,,X,CT,6510\n")
    (tmp_path / "r2.csv").write_text("EIN,NAME,ICO,CITY,STATE,ZIP\n3,A,,X,CT,06510\n")
    rows = csvfiles.read_registry(spark, str(tmp_path))[0].orderBy("ord").collect()
    assert [(r.EIN, r.ZIP) for r in rows] == [(1, "06510-1"), (2, "6510"), (3, "06510")]


def test_inventory(spark, folder):
    rows = {r.name: r for r in files.inventory(spark, str(folder)).collect()}
    assert set(rows) == {"a.csv", "b.csv", "blank.csv", "empty.csv"}
    assert [n for n, r in rows.items() if not r.valid] == ["empty.csv"]
    assert rows["blank.csv"].size_bytes == 1 and rows["a.csv"].size_mb == 0.0
    assert files.landed(files.listing(spark, str(folder))).count() == 3
    scan = files.listing(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scan


def test_links(spark):
    html = '<a href="/a/x.zip">1</a><A HREF=\'y.csv\'>2</A><a href="Z.ZIP"><a href="x.zip?v=1&amp;w=2"><a name="n">'
    df = spark.createDataFrame([(1, "https://h.org/d/p.html", html), (2, "https://h.org", None)], "page_id long, url string, html string")
    rows = links.page_links(df).orderBy("pos").collect()
    assert [(r.href, r.full_url, r.kind) for r in rows] == [
        ("/a/x.zip", "https://h.org/a/x.zip", "zip"), ("y.csv", "https://h.org/d/y.csv", "csv"),
        ("Z.ZIP", "https://h.org/d/Z.ZIP", "other"), ("x.zip?v=1&w=2", "https://h.org/d/x.zip?v=1&w=2", "other")]


def test_incremental(spark):
    inputs = spark.createDataFrame([("a.zip",), ("b.zip",)], "name string")
    done = incremental.committed(inputs.filter("name = 'a.zip'"))
    assert [r.name for r in incremental.pending(inputs, done).collect()] == ["b.zip"]
    assert incremental.pending(inputs, done, force=True).count() == 2
    assert incremental.pending(inputs, incremental.committed(inputs)).count() == 0


def test_scratch_paths_never_repeat(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x") and fresh_path(spark, "x").startswith(shared_dir(spark))


def test_blank_first_line_long_header_and_headless_files(spark, tmp_path):
    wide = ",".join(["EIN", "NAME", "CITY", "STATE", "ZIP", *(f"c{i:06d}" for i in range(9000))])
    (tmp_path / "a.csv").write_text("\n\nEIN,NAME,CITY,STATE,ZIP\n1,A,B,NY,10001\n")
    (tmp_path / "b.csv").write_text(wide + "\n2,A,B,NY,10001" + "," * 9000 + "\n")
    (tmp_path / "c.csv").write_text("\n \n")
    (tmp_path / "d.csv").write_text('EIN,NAME,CITY,STATE,ZIP\n3,"two\nlines",B,NY,10001\nx,bad,B,NY,1\n')
    rows, rejected = csvfiles.read_registry(spark, str(tmp_path))
    assert sorted(r.EIN for r in rows.collect()) == [1, 2, 3]
    assert {r.file.rsplit("/", 1)[-1] for r in rejected.collect()} == {"c.csv", "d.csv"}
