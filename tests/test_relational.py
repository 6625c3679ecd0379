import pytest
from pyspark.sql import functions as F

from almsflow import schemas as S
from almsflow.functions import text as X
from almsflow.operators import aggregates as A, dedupe, relational as R, reshape
from almsflow.plans import jobs as J


def one(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_cleaning(spark):
    assert one(spark, X.zip5, ["06510", "6510", "123456789", "12", None]) == ["06510", "06510", "12345", "00012", None]
    assert one(spark, X.clean_zip, ["06510-1234", "6510", "x123456789", None]) == ["06510", "", "12345", ""]
    assert one(spark, X.clean_name, ["The Saint-Luke's Foundation and Trust Co., Incorporated", "A & B", "ÉCOLE-1", "foo_inc", None, "inc"]) == [
        "THE SAINT LUKE S FDN & TR", "A B", "ÉCOLE 1", "FOO_INC", "", ""]
    assert one(spark, X.clean_city, ["Saint-Louis", "St. Louis", "Fort Worth", None]) == ["ST LOUIS", "ST LOUIS", "FT WORTH", ""]
    assert one(spark, X.clean_state, [" ca ", "Calif", None]) == ["CA", "CA", ""]
    assert one(spark, X.stem_token, ["a/b/123_public.xml", "9.xml", "x_y_z"]) == ["123", "9", "x"]
    assert one(spark, X.na_to_null, ["", "NA", "N/A", "None", "null", "nan", "none", "NONE", "-"]) == [None] * 6 + ["none", "NONE", "-"]
    assert one(spark, X.upper_strip, ["\t a ", "b\n"]) == ["A", "B"]


def test_placeholders(spark):
    texts = [" see statement 4", "(See Statement)", "None", "NONESUCH FUND", None, "Scholarships", "PLEASE SEE STATEMENT"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    assert sorted(r.d for r in R.drop_placeholders(df, "d").collect()) == ["PLEASE SEE STATEMENT", "Scholarships"]


KEY = (1, "a.zip", 9, 2020, "990PF")
WIDE = "filing_number long, zip_name string, ein long, tax_yr long, form string, D1 string, E1 double, D2 string, E2 double"


def test_pairing(spark):
    df = spark.createDataFrame([(*KEY, "x", 1.0, None, 2.0), (*KEY, "y", 3.0, "None", 4.0)], WIDE)
    count = lambda p: reshape.pair_to_rows(df, S.FILING_KEY, ["D1", "D2"], ["E1", "E2"], p)
    by_row = {(r.DescriptionTxt, r.ExpensesAmt) for r in count("row").select("DescriptionTxt", "ExpensesAmt").collect()}
    assert by_row == {("x", 1.0), ("y", 3.0)}
    num = df.select(*S.FILING_KEY, F.col("D1").alias("Description1Txt"), F.col("E1").alias("Expenses1Amt"))
    melted = reshape.pair_to_rows(num, S.FILING_KEY, ["Description1Txt"], ["Expenses1Amt"], "melt_join")
    assert melted.count() == 4
    with pytest.raises(ValueError):
        count("other")


def test_other_investments(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, None)], "k int, AllOtherProgramRltdInvstTotAmt double")
    got = {r.k: r.Description3Txt for r in reshape.add_other_pair(rows).collect()}
    assert got == {1: reshape.OTHER_INVESTMENTS, 2: None, 3: None}


FIN = "filing_number long, zip_name string, ein long, tax_yr long, form string, a double, managed double"


def test_dedupe_order_and_plan(spark):
    df = spark.createDataFrame([(1, "a", 9, 2020, "990", 1.0, -5.0), (1, "b", 9, 2020, "990", 2.0, None)], FIN)
    row = dedupe.largest_amounts(df, "managed").collect()
    assert [(r.zip_name, r.managed) for r in row] == [("b", 0.0)]
    ties = spark.createDataFrame([(1, "a", 9, 2020, "990", 1.0, 3.0), (1, "b", 9, 2020, "990", 0.0, 3.0)], FIN)
    assert dedupe.largest_amounts(ties, "managed").first().zip_name == "b"
    plan = dedupe.latest_filings(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # limited before and after the shuffle


def test_filing_in_two_archives_misses_amounts(spark):
    text = "filing_number long, zip_name string, ein long, tax_yr long, form string"
    filings = spark.createDataFrame([(1, "b", 9, 2020, "990", "N", "A", "C", "6510")],
                                    text + ", BusinessNameLine1Txt string, AddressLine1Txt string, CityNm string, ZIPCd string")
    fin = spark.createDataFrame([(1, "c", 9, 2020, "990", 5.0, 6.0, 7.0)], S.FINANCES)
    daf = spark.createDataFrame([(1, "b", 9, 2020, "990", 1.0, 2.0, 3.0, 4.0)], S.DONOR_ADVISED)
    mission = spark.createDataFrame([], S.MISSIONS)
    row = J.compile_organizations(filings, fin, daf, mission).collect()
    assert [(r.contribution_amt, r.daf_count_at_eoy, r.foundation_zip, r.organization_mission_pt1_990_only) for r in row] == [(0.0, 4.0, "06510", None)]


def test_counter_is_a_side_product(spark):
    df, seen = A.counted(spark.range(7), "rows")
    assert df.count() == 7 and seen.get["rows"] == 7


def test_union_keeps_extra_columns(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1)
    assert {(r.id, r.x) for r in R.union_all(a, b).collect()} == {(0, 1), (0, None)}
    assert R.union_all(a, b).columns == ["id", "x"]


def test_combinations_are_made_in_pieces(spark, monkeypatch):
    """Repeated ids, one of them very often: all combinations, in more tasks than the few rows would get."""
    rows = [(i % 3 if i % 2 else 7, f"d{i}", float(i), None if i % 5 == 0 else f"e{i}", 2.0 * i) for i in range(60)] + [(None, "n", 1.0, "m", 2.0)] + [(7, "same", 1.0, "same", 1.0)] * 3
    df = spark.createDataFrame(rows, "k int, Description1Txt string, Expenses1Amt double, Description2Txt string, Expenses2Amt double")
    numbered = [[f"{s}{i}{t}" for i in (1, 2)] for s, t in (("Description", "Txt"), ("Expenses", "Amt"))]
    monkeypatch.setattr(reshape, "PIECE", 50)
    got = reshape.pair_to_rows(df, ["k"], *numbered, "melt_join")
    assert "_piece" in got._jdf.queryExecution().optimizedPlan().toString()
    want = [(a[0], a[j], b[j + 1]) for j in (1, 3) for a in rows for b in rows if a[j] is not None and a[0] is not None and a[0] == b[0]]
    assert sorted(map(tuple, got.collect())) == sorted(want)
