"""CSV files cut into byte ranges give what reading them whole gives."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from almsflow import schemas as S
from almsflow.sources import csvfiles, csvranges as C


def plain_states(raw, state):
    """A parser that goes byte by byte."""
    border = -1
    for i, c in enumerate(raw.decode("latin-1")):
        if state in (C.RECORD, C.FIELD) and c == '"':
            state = C.QUOTED
        elif state == C.QUOTED:
            state = C.AFTER if c == '"' else C.QUOTED
        elif state == C.AFTER and c == '"':
            state = C.QUOTED
        elif c == "\n":
            state, border = C.RECORD, i + 1 if border < 0 else border
        elif c in ",\r":
            state = C.FIELD
        else:
            state = C.PLAIN
    return state, border


def test_states_of_random_bytes():
    rnd = random.Random(2)
    for _ in range(3000):
        raw = "".join(rnd.choice('"",\n\nab\r') for _ in range(rnd.randint(1, 14))).encode()
        ends, borders = C.scan_all(raw)
        assert list(zip(ends, borders)) == [plain_states(raw, s) for s in range(5)], raw


WORDS = ["", "a", "two words", 'say "hi"', "line\nbreak", "cr\r\nlf", ",", '"', "é – 日本", 'a,"b"\n\n"', "x" * 300, "NA", " lead"]


def write(path, rows, **options):
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out, **options).writerows(rows)


SCHEMA = T.StructType([T.StructField("id", S.LONG), T.StructField("one", S.STR), T.StructField("two", S.STR)])


@pytest.mark.parametrize("quoting,end", [(csv.QUOTE_MINIMAL, "\n"), (csv.QUOTE_ALL, "\r\n")])
def test_one_file_in_sixty_four_ranges(spark, tmp_path, quoting, end):
    rnd = random.Random(4)
    rows = [(i, rnd.choice(WORDS), rnd.choice(WORDS)) for i in range(1500)]
    write(tmp_path / "f.csv", [("id", "one", "two"), *rows], quoting=quoting, lineterminator=end)
    size = (tmp_path / "f.csv").stat().st_size
    want = [(i, *(None if w in ("", "NA") else w for w in x)) for i, *x in rows]
    for ranges in (1, 64):
        good, bad = csvfiles.read_csv(spark, str(tmp_path), SCHEMA, required=("id",), with_order=True, range_bytes=-(-size // ranges))
        found = good.orderBy("ord").collect()
        assert [tuple(r)[:3] for r in found] == want and bad.count() == 0
    # Every range holds its own part: most of the 64 have records that begin in them.
    cut = C.regions(spark, str(tmp_path), range_bytes=-(-size // 64)).orderBy("first").collect()
    assert len(cut) > 40 and cut[0].first == 0 and cut[-1].stop == size and all(a.stop == b.first for a, b in zip(cut, cut[1:]))


@pytest.mark.parametrize("range_bytes", [1, 2, 3, 7, 1 << 20])
def test_any_cut_gives_the_same_rows(spark, tmp_path, range_bytes):
    (tmp_path / "a.csv").write_text('﻿"id","one",two\n1,"x, ""q""\n\ny",2\n2,"",pl"ain\n\n3,"a"b,"\r\n"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("\n \ntwo,id\nw,4\nbad\nlast,5")
    (tmp_path / "c.csv").write_text("\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("id,one,two")
    good, bad = csvfiles.read_csv(spark, str(tmp_path), SCHEMA, required=("id",), with_order=True, range_bytes=range_bytes)
    assert [tuple(r)[:3] for r in good.orderBy("ord").collect()] == [(1, 'x, "q"\n\ny', "2"), (2, None, 'pl"ain'), (3, "ab", "\r\n"), (4, None, "w"), (5, None, "last")]
    assert sorted((r.file.rsplit("/", 1)[-1], r.record) for r in bad.collect()) == [("b.csv", "bad"), ("c.csv", "no header")]


def test_record_over_many_ranges_and_no_path_list(spark, tmp_path):
    big = "long \n,\"\" field " * 4000
    out = io.StringIO()
    csv.writer(out).writerows([("id", "one", "two"), (1, big, "a"), (2, "b", big), (3, "", "")])
    (tmp_path / "f.csv").write_text(out.getvalue(), newline="")
    good, _ = csvfiles.read_csv(spark, str(tmp_path), SCHEMA, required=("id",), range_bytes=1000)
    assert sorted((r.id, r.one, r.two) for r in good.collect()) == [(1, big, "a"), (2, "b", big), (3, None, None)]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "binaryfile" in plan.lower() and "content" not in plan


def test_small_files_share_tasks_and_are_parsed_once(spark, tmp_path):
    for i in range(60):
        write(tmp_path / f"{i}.csv", [("id", "one", "two"), (i, 'a"\nb', "x"), ("no number", "c", "y")])
    cut = C.regions(spark, str(tmp_path))
    assert cut.rdd.getNumPartitions() <= C.TASKS_AT_LEAST * spark.sparkContext.defaultParallelism < 60
    # Nothing has to be scanned for where records begin: only large files pass through Python before they are parsed.
    assert "MapInArrow" not in cut._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.first, r.stop) for r in cut.collect()) == sorted((0, (tmp_path / f"{i}.csv").stat().st_size) for i in range(60))
    good, bad = csvfiles.read_csv(spark, str(tmp_path), SCHEMA, required=("id",), keep=str(tmp_path / "parsed"))
    assert sorted((r.id, r.one, r.two) for r in good.collect()) == [(i, 'a"\nb', "x") for i in range(60)] and bad.count() == 60
    assert not any("MapInArrow" in x._jdf.queryExecution().executedPlan().toString() for x in (good, bad))


def test_small_and_large_files_of_one_folder(spark, tmp_path):
    want = [(i, "x" * (i % 7) + "\n", "y") for i in range(900)]
    write(tmp_path / "large.csv", [("id", "one", "two"), *want[:800]])
    for i in range(800, 900):
        write(tmp_path / f"{i}.csv", [("two", "one", "id"), want[i][::-1]])
    good, bad = csvfiles.read_csv(spark, str(tmp_path), SCHEMA, required=("id",), range_bytes=1000)
    assert sorted((r.id, r.one, r.two) for r in good.collect()) == want and bad.isEmpty()
