import io
import random
import re
import xml.etree.ElementTree as ET
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from almsflow.operators import extract as E
from almsflow.plans import filingdocs as FD, jobs as J
from almsflow.plans.specs import SPECS, Spec
from almsflow.sources import archives, tables
from almsflow.streaming.ingest import ingest_archives

BY_NAME = {s.name: s for s in SPECS}


def filing(form, body, year="2020", ns=' xmlns="http://www.irs.gov/efile"'):
    tax_year = f"<TaxYr>{year}</TaxYr>" if year else ""
    return (f'<?xml version="1.0" encoding="utf-8"?><Return{ns}><ReturnHeader>{tax_year}<ReturnTypeCd>{form}</ReturnTypeCd>'
            f"<Filer><EIN>12</EIN></Filer></ReturnHeader><ReturnData>{body}</ReturnData></Return>")


def rows(xml, name="grant_details", spec=None, member="a/202301349349100000_public.xml"):
    return E.filing_rows("z.zip", member, xml, [spec or BY_NAME[name]])


def test_grants_of_each_form():
    two = "<RecipientTable><CashGrantAmt>5</CashGrantAmt></RecipientTable>" * 2
    got = rows(filing("990", two))
    assert [r["fields"]["CashGrantAmt"] for r in got] == ["5", "5"] and got[0]["filing_number"] == "202301349349100000"
    pf = "<GrantOrContributionPdDurYrGrp><Amt>7</Amt><GrantOrContributionPurposeTxt>Aid</GrantOrContributionPurposeTxt></GrantOrContributionPdDurYrGrp>"
    fields = rows(filing("990PF", pf))[0]["fields"]
    assert fields["CashGrantAmt"] == "7" and fields["GrantOrContributionPurposeTxt"] == "Aid" and fields["RecipientEIN"] is None
    assert rows(filing("990EZ", two)) == []
    assert all(rows(filing("990T", two + pf), name) == [] for name in BY_NAME)


def test_keep_rule():
    empty = rows(filing("990", "<RecipientTable><CashGrantAmt/></RecipientTable>"))
    assert len(empty) == 1 and set(empty[0]["fields"].values()) == {None}
    none = filing("990", "<RecipientTable><Other>1</Other></RecipientTable>")
    assert rows(none) == []
    g = BY_NAME["grant_details"]
    keep = Spec(g.name, g.subroots, g.fields, keep_empty=True)
    assert len(rows(none, spec=keep)) == 1
    assert rows(filing("990", ""), spec=keep) == []


def test_any_depth_and_first_in_document_order():
    deep = "<RecipientTable><A><B><CityNm>Ely</CityNm></B></A><CityNm>Ada</CityNm></RecipientTable>"
    assert rows(filing("990", deep))[0]["fields"]["CityNm"] == "Ely"
    nested = "<RecipientTable><CityNm>Ely</CityNm><RecipientTable><CityNm>Ada</CityNm></RecipientTable></RecipientTable>"
    assert [r["fields"]["CityNm"] for r in rows(filing("990", nested))] == ["Ely", "Ada"]


def test_nested_records_equal_a_plain_search():
    rnd, tags = random.Random(8), ["RecipientTable", "CityNm", "CashGrantAmt", "BusinessNameLine1Txt", "Other"]

    def element(depth):
        tag = rnd.choice(tags)
        inner = "".join(element(depth - 1) for _ in range(rnd.randrange(4))) if depth else str(rnd.randrange(100))
        return f"<{tag}>{inner}</{tag}>"

    spec = BY_NAME["grant_details"]
    for _ in range(60):
        xml = filing("990", "".join(element(5) for _ in range(3)))
        want = []
        for seq, record in enumerate(ET.fromstring(xml).iter(E._NS + "RecipientTable")):
            found = {c: record.find(f".//{E._NS}{by_form['990']}") if by_form.get("990") else None for c, by_form in spec.fields.items()}
            if any(e is not None for e in found.values()):
                want.append((seq, {c: None if e is None else e.text for c, e in found.items()}))
        assert [(r["seq"], r["fields"]) for r in rows(xml)] == want


def archive(members, broken=False):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return b"not a zip" if broken else buffer.getvalue()


GOOD = filing("990", "<RecipientTable><CashGrantAmt>5</CashGrantAmt></RecipientTable>")
MEMBERS = {"1_public.xml": GOOD, "sub/2_x.xml": GOOD.encode().replace(b"12", b"1\xff2"), "3_a.xml": filing("990", "", year=None),
           "4_a.xml": "<broken", "5_a.xml": filing("990", "", ns=""), "readme.txt": "no"}


def check(rows):
    good = {r.filing_number: r.ein for r in rows if r.dataset == "grant_details"}
    assert good == {"1": "12", "2": "12"}
    bad = {r.member: r.error for r in rows if r.error}
    assert set(bad) == {"3_a.xml", "4_a.xml", "5_a.xml", None}
    assert "tax_yr" in bad["3_a.xml"] and bad["4_a.xml"].startswith("ParseError") and "unreadable_archive" in bad[None]


def test_archives_in_memory(spark):
    df = spark.createDataFrame([("/x/a.zip", archive(MEMBERS)), ("/x/b.zip", archive({}, True)), ("/x/c.zip", archive({"r.txt": "x"}))],
                               "path string, content binary")
    check(E.extract(E.documents(df)).collect())
    assert E.quarantined(E.extract(E.documents(df))).count() == 4


def test_archives_on_disk_jobs_and_stream(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.zip").write_bytes(archive(MEMBERS))
    (land / "b.zip").write_bytes(archive({}, True))
    (land / "empty.zip").write_bytes(b"")
    check(archives.extract_archives(archives.zip_listing(spark, str(land))).collect())
    assert archives.scan_documents(spark, str(land)).filter("xml IS NOT NULL").count() == 5

    J.run_extract(spark, str(land), str(tmp_path / "extracted"))
    assert J.run_extract(spark, str(land), str(tmp_path / "extracted")).count() == 0
    (land / "b.zip").write_bytes(archive({"8_public.xml": GOOD}))  # a repaired archive is taken in again
    assert [r.name for r in J.run_extract(spark, str(land), str(tmp_path / "extracted")).collect()] == ["b.zip"]
    assert J.run_extract(spark, str(land), str(tmp_path / "extracted"), force=True).count() == 2
    got = [r.filing_number for r in J.read_extracted(spark, str(tmp_path / "extracted")).filter("dataset = 'grant_details'").collect()]
    assert sorted(got) == ["1", "2", "8"]
    (land / "b.zip").write_bytes(archive({}, True))
    J.run_compile(spark, str(tmp_path / "extracted"), str(tmp_path / "compiled"))
    grants = spark.read.parquet(str(tmp_path / "compiled/grant_details_compiled"))
    assert [(r.filing_number, r.grant_amt) for r in grants.collect()] == []  # no filer fields, so no surviving filing

    args = (spark, str(land), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    for _ in range(2):
        ingest_archives(*args).awaitTermination()
    read = lambda: sorted(r.filing_number for r in J.read_extracted(spark, str(tmp_path / "out")).filter("dataset = 'grant_details'").collect())
    assert read() == ["1", "2"]
    (land / "later.zip").write_bytes(archive({"9_public.xml": GOOD}))
    ingest_archives(*args).awaitTermination()
    assert read() == ["1", "2", "9"]


def test_batch_and_stream_share_one_manifest(spark, tmp_path, monkeypatch):
    land, out, checkpoint = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    land.mkdir()
    seen = lambda: sorted(r.filing_number for r in J.read_extracted(spark, out).filter("dataset = 'grant_details'").collect())
    (land / "a.zip").write_bytes(archive({"1_p.xml": GOOD}))
    J.run_extract(spark, str(land), out)

    def die(*_):
        raise RuntimeError("killed")

    (land / "b.zip").write_bytes(archive({"2_p.xml": GOOD}))
    commit = J.commit_run
    monkeypatch.setattr(J, "commit_run", die)
    with pytest.raises(RuntimeError, match="killed"):  # between the write and the commit
        J.run_extract(spark, str(land), out)
    assert seen() == ["1"] and spark.read.parquet(f"{out}/rows").filter("dataset = 'grant_details'").count() == 2
    with pytest.raises(Exception, match="killed"):
        ingest_archives(spark, str(land), out, checkpoint).awaitTermination()
    assert seen() == ["1"]
    monkeypatch.setattr(J, "commit_run", commit)
    (land / "c.zip").write_bytes(archive({"3_p.xml": GOOD}))
    ingest_archives(spark, str(land), out, checkpoint).awaitTermination()  # replays its batch, then takes what is new
    assert seen() == ["1", "2", "3"]
    (land / "d.zip").write_bytes(archive({"4_p.xml": GOOD}))
    assert [r.name for r in J.run_extract(spark, str(land), out).collect()] == ["d.zip"]
    ingest_archives(spark, str(land), out, checkpoint).awaitTermination()
    assert seen() == ["1", "2", "3", "4"]
    runs = {r.name: r.run.split("-")[0] for r in spark.read.schema(J.MANIFEST).parquet(f"{out}/manifest").collect()}
    assert runs == {"a.zip": "batch", "b.zip": "stream", "c.zip": "stream", "d.zip": "batch"}


def test_a_file_per_archive_and_compile_from_csv(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    body = ("<RecipientTable><RecipientBusinessName><BusinessNameLine1Txt>Food, \"Bank\"\nof Ely</BusinessNameLine1Txt></RecipientBusinessName>"
            "<CashGrantAmt>5</CashGrantAmt></RecipientTable>")
    named = lambda n: filing("990", body).replace("<EIN>12</EIN>", f"<EIN>{n}</EIN><BusinessNameLine1Txt>Giver {n}</BusinessNameLine1Txt><ZIPCd>123</ZIPCd>")
    for k in range(3):
        (land / f"y{k}.zip").write_bytes(archive({f"{10 * k + i}_p.xml": named(10 * k + i) for i in range(4)} | ({"x.xml": "<bad"} if k == 2 else {})))
    out = str(tmp_path / "out")
    J.run_extract(spark, str(land), out)
    for form in ("csv", "parquet"):
        written = J.export_extracted(spark, out, str(tmp_path / form), form).collect()
        assert {(r.file, r.rows) for r in written if r.dataset == "grant_details"} == {(f"grant_details__y{k}.{form}", 4) for k in range(3)}
        assert sorted(f.name for f in (tmp_path / form).iterdir()) == sorted(r.file for r in written)
    assert J.export_extracted(spark, out, str(tmp_path / "csv")).count() == len(written)  # replaced, not added to
    with pytest.raises(ValueError):
        J.export_extracted(spark, out, str(tmp_path / "x"), "json")
    grants = spark.read.parquet(str(tmp_path / "parquet/grant_details__y1.parquet"))
    assert [r.filing_number for r in grants.collect()] == ["10", "11", "12", "13"]
    J.run_compile(spark, out, str(tmp_path / "from_rows"))
    (tmp_path / "csv/grant_details__zz.csv").write_text("filing_number,zip_name,ein,tax_yr,form\nbad,zz,1,2020,990\n")
    J.run_compile(spark, str(tmp_path / "csv"), str(tmp_path / "from_csv"), form="csv")
    for name in ("organization_details_compiled", "grant_details_compiled"):
        both = [sorted(map(str, spark.read.parquet(str(tmp_path / form / name)).collect())) for form in ("from_rows", "from_csv")]
        assert both[0] == both[1] and len(both[0]) == 12
    bad = spark.read.parquet(str(tmp_path / "from_csv/quarantined")).collect()
    assert [(r.zip_name, r.error.split(" ")[0]) for r in bad] == [("zz", "bad_record:")]
    counts = {r.dataset: r.rows for r in tables.last_report(spark, str(tmp_path / "from_csv/report")).collect()}
    assert counts == {"quarantined": 1, "organization_details_compiled": 12, "grant_details_compiled": 12, "independent_contractor_details_compiled": 0,
                      "program_related_investments_compiled": 0, "direct_charitable_activity_details_compiled": 0}


def test_chunks_split_a_large_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "CHUNK_MEMBERS", 10)
    (tmp_path / "big.zip").write_bytes(archive({f"{i}_p.xml": GOOD for i in range(35)}))
    listed = archives.zip_listing(spark, str(tmp_path))
    assert archives.member_chunks(listed).count() == 4
    assert archives.extract_archives(listed, [BY_NAME["grant_details"]]).count() == 35


def test_bad_keys_and_missing_tokens_on_the_job_path(spark):
    schema = dict((spec.name, kind) for spec, kind in J.EXTRACTED)["grant_details"]
    spec = BY_NAME["grant_details"]
    fields = lambda **own: {c: own.get(c) for c in spec.fields}
    name, person = list(spec.fields)[:2]
    rows = [("z", f"m{i}", "grant_details", 0, str(i), "12" if i == 3 else "bad", "2020", "990", fields(**{name: "N/A", person: "Jane"}), None) for i in range(4)]
    extracted = spark.createDataFrame(rows, "zip_name string, member string, dataset string, seq int, filing_number string, ein string, "
                                            "tax_yr string, form string, fields map<string,string>, error string")
    kept = E.dataset(extracted, spec, schema).collect()
    assert [r[name] for r in kept] == [None] and len(kept) == 1
    assert E.bad_keys(extracted, spec, schema).count() == 3


def test_archives_are_small_and_read_in_one_pass(spark, monkeypatch):
    """Archives of a bounded number of members, read one at a time, give the rows of the two-step way."""
    docs = spark.createDataFrame([("z", f"{i}_public.xml", GOOD) for i in range(30)], "zip_name string, member string, xml string").coalesce(1)
    monkeypatch.setattr(FD, "ARCHIVE_MEMBERS", 7)
    packed = FD.zipped(docs)
    assert sorted(len(zipfile.ZipFile(io.BytesIO(r.content)).namelist()) for r in packed.collect()) == [2, 7, 7, 7, 7]
    df = packed.union(spark.createDataFrame([("/x/a.zip", archive(MEMBERS)), ("/x/b.zip", archive({}, True))], "path string, content binary"))
    one, two = (sorted(map(str, d.collect())) for d in (E.extract_contents(df), E.extract(E.documents(df))))
    assert one == two and len(one) == 36


def test_wide_rows_equal_mapped_ones(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(archive(MEMBERS))
    (tmp_path / "b.zip").write_bytes(archive({}, True))
    listed = archives.zip_listing(spark, str(tmp_path))
    fields = list(dict.fromkeys(f for s in SPECS for f in s.fields))
    head = ["dataset", "seq", "filing_number", "zip_name", "ein", "tax_yr", "form", "member", "error"]
    wide = archives.extract_archives(listed, SPECS, wide=True).select(*head, *fields).collect()
    mapped = archives.extract_archives(listed, SPECS).selectExpr(*head, *[f"fields['{c}'] AS {c}" for c in fields]).collect()
    assert sorted(map(str, wide)) == sorted(map(str, mapped)) and {r.dataset for r in wide} == {None, "grant_details"}


def test_a_large_record_is_searched_like_a_small_one(monkeypatch):
    xml = filing("990", "".join(f"<RecipientTable><A><CityNm>{i}</CityNm></A><CityNm/><CashGrantAmt>{i}</CashGrantAmt></RecipientTable>" for i in range(9)))
    small = rows(xml)
    monkeypatch.setattr(E, "_SMALL_RECORD", 1)
    assert rows(xml) == small and [r["fields"]["CityNm"] for r in small] == [str(i) for i in range(9)]


class _Counted(io.BytesIO):
    reads = 0

    def read(self, *size):
        type(self).reads += 1
        return super().read(*size)


def test_neighbouring_members_come_with_one_read():
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(300):
            z.writestr(f"{i}.xml", f"<a>{i}</a>" * 20)
    source = _Counted(held.getvalue())
    got = list(E.archive_documents("z.zip", source))
    assert [d["xml"] for d in got] == [f"<a>{i}</a>" * 20 for i in range(300)] and all(d["error"] is None for d in got)
    assert _Counted.reads < 30


def _one_by_one(content, names):
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return [E.read_member(z, n) for n in names]


@pytest.mark.parametrize("ahead", [1, 2_000, 4 << 20])
def test_odd_members_read_like_one_by_one(monkeypatch, ahead):
    monkeypatch.setattr(E, "_READ_AHEAD", ahead)
    rnd, held = random.Random(5), io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(60):
            text = "".join(rnd.choices("abc <>&\u00e9", k=rnd.choice([0, 1, 50, 5_000])))
            kind = rnd.choice([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
            z.writestr(rnd.choice([f"{i}.xml", f"d/\u00e9{i}.xml"]), text, kind)
    content = held.getvalue()
    names = zipfile.ZipFile(io.BytesIO(content)).namelist()
    seen = set()
    for trial in range(40):
        broken = bytearray(content)
        for _ in range(trial):
            broken[rnd.randrange(len(content) - 8_000)] ^= 1 << rnd.randrange(8)
        order = rnd.sample(names, len(names)) if trial % 2 else names
        got = [(d["xml"], d["error"]) for d in E.archive_documents("z.zip", io.BytesIO(bytes(broken)), order)]
        assert got == _one_by_one(bytes(broken), order)
        seen |= {e.split(":")[0] for _, e in got if e}
    assert "unreadable_member" in seen


def test_documents_are_built_by_compiled_methods(spark, capsys):
    """A stage whose one generated method is above 8,000 bytes is interpreted, several times as slow."""
    orders = spark.createDataFrame([(i, i % 2, "O", 10.5, datetime(1995, 1, 2), f"{i}-X") for i in range(1, 6)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    customer = spark.createDataFrame([(i, "A & <B>", 3, 7.5, "M") for i in range(2)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    lineitem = spark.createDataFrame([(i, n, n, n, 2.0, 5.5, "R") for i in range(1, 5) for n in (2, 3)],
                                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string")
    docs = FD.filing_documents(orders, customer, lineitem)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs.explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
    texts = {r["member"]: r["xml"] for r in docs.collect()}
    person = "<PersonNm>Worker {}</PersonNm>{}<ZIPCd>{}</ZIPCd><{}>R</{}><CompensationAmt>2</CompensationAmt>"
    assert texts["1_public.xml"].endswith("".join(
        f"<RecipientTable><BusinessNameLine1Txt>Fund {n}</BusinessNameLine1Txt><RecipientPersonNm>Person {n}</RecipientPersonNm><RecipientEIN>{n}</RecipientEIN>"
        f"<CityNm>Saint R</CityNm><StateAbbreviationCd>ny</StateAbbreviationCd><ZIPCd>{n}</ZIPCd><PurposeOfGrantTxt>R</PurposeOfGrantTxt><CashGrantAmt>5</CashGrantAmt></RecipientTable>"
        f"<ContractorCompensationGrp>{person.format(n, firm, n, 'ServicesDesc', 'ServicesDesc')}</ContractorCompensationGrp>"
        for n, firm in ((2, ""), (3, "<BusinessNameLine1Txt>Firm 3</BusinessNameLine1Txt>"))) + "</ReturnData></Return>")
    assert "RecipientEIN" not in texts["2_public.xml"] and "<Amt>5</Amt>" in texts["2_public.xml"] and texts["2_public.xml"].count("<GrantOrContributionPdDurYrGrp>") == 2
    assert "RecipientPersonNm" not in texts["3_public.xml"] and "<ServiceTypeTxt>R</ServiceTypeTxt>" in texts["3_public.xml"]
    assert texts["4_public.xml"].endswith("<ReturnData></ReturnData></Return>") and "A &amp; &lt;B&gt;" in texts["4_public.xml"]
    assert texts["5_public.xml"].count("<RecipientTable>") == 0  # no line items


def test_documents_of_some_filings_alone(spark):
    """The documents of a lot are built by themselves: no copy of all has to lie on disk, and both lots are the whole."""
    when = datetime(1995, 1, 2)
    orders = spark.createDataFrame([(i, 0, s, 10.5, when, f"{1 + i % 3}-X") for i, s in enumerate(["O", "F", "F", "P", None, "O"], 1)] + [(2, 0, "O", 9.5, when, "1-X")],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    customer = spark.createDataFrame([(0, "A", 3, 7.5, "M")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    lineitem = spark.createDataFrame([(i, n, n, n, 2.0, 5.5, "R") for i in range(1, 6) for n in (2, 3)],
                                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string")
    first = F.col("zip_name").like("batch_O%")
    whole = FD.filing_documents(orders, customer, lineitem)
    for only, other in ((first, ["batch_F%", "batch_P%"]), (~first, ["batch_O%"])):
        got = FD.filing_documents(orders, customer, lineitem, only)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.filter(only).collect()))
        assert not got.filter(F.col("zip_name").like(other[0])).count()
    lots = FD.filing_documents(orders, customer, lineitem, first).union(FD.filing_documents(orders, customer, lineitem, ~first)).select("zip_name", "member")
    assert sorted(map(tuple, lots.collect())) == sorted(map(tuple, whole.filter("zip_name IS NOT NULL").select("zip_name", "member").collect()))
