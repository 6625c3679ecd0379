"""XML filings built from relational rows, for checking extraction end to end.

One filing per order: the customer files it, its line items are the grants.
The value of every element is a SQL expression that both Spark and the
checking engine evaluate, so expected rows need no second definition.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from almsflow.plans.specs import NAMESPACE, SPECS, Spec
from almsflow.runtime import no_leftovers
from almsflow.sources.files import write_path

BASE_SQL = """
SELECT o_orderkey AS filing_number, concat('batch_', o_orderstatus, '_', CAST(CAST(floor(o_orderkey / 4000) AS BIGINT) AS STRING), '.zip') AS zip_name, o_custkey AS ein,
       CAST(year(o_orderdate) AS BIGINT) AS tax_yr,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '990' WHEN '2' THEN '990PF' WHEN '3' THEN '990EZ'
            WHEN '4' THEN '990T' ELSE '990' END AS form,
       o_totalprice, o_orderpriority, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""
LINES_SQL = "SELECT b.*, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag FROM ({base}) b JOIN {lineitem} ON l_orderkey = filing_number"

PRICE = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
BALANCE = "CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING)"
GRANT = "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)"

# dataset -> column -> value; a null value leaves the element out of the document.
FILING_VALUES = {
    "filing_details": {
        "BusinessNameLine1Txt": "c_name", "AddressLine1Txt": "concat(c_nationkey, ' Oak & <Elm>')",
        "CityNm": "c_mktsegment", "ZIPCd": "CAST(ein * 37 AS STRING)"},
    "contributions_grants_assets": {
        "contribution_amt": PRICE, "grant_amt": f"CASE WHEN ein % 5 <> 0 THEN {BALANCE} END",
        "managed_assets_at_eoy": BALANCE},
    "donor_advised_fund_details": {
        "daf_contribution_amt": f"CASE WHEN ein % 2 = 0 THEN {PRICE} END",
        "daf_count_at_eoy": "CASE WHEN ein % 2 = 0 THEN CAST(c_nationkey AS STRING) END"},
    "exemption_and_service_description": {
        "PrimaryExemptPurposeTxt": "concat('Aid ', o_orderpriority)",
        "DescriptionProgramSrvcAccomTxt": "CASE WHEN ein % 3 = 0 THEN c_mktsegment END"},
    "program_related_investments": {
        "Description1Txt": "concat('Loan ', c_mktsegment)", "Expenses1Amt": PRICE,
        "Description2Txt": "CASE WHEN ein % 2 = 0 THEN 'see statement 7' ELSE 'Guarantee' END",
        "AllOtherProgramRltdInvstTotAmt": "CAST(ein % 4 AS STRING)", "TotalAmt": PRICE},
    "program_related_investments_summary": {
        "expenses_and_contributions_amt": PRICE, "total_qualifying_distributions_amt": BALANCE},
    "direct_charitable_activity_details": {
        "Description1Txt": "concat('Meals ', c_mktsegment)", "Expenses1Amt": PRICE,
        "Description2Txt": "CASE WHEN ein % 3 = 0 THEN ' None ' ELSE 'Shelter' END",
        "Expenses2Amt": "CASE WHEN ein % 7 = 0 THEN 'n/k' ELSE '12.5' END",
        "Description4Txt": "CASE WHEN ein % 5 = 0 THEN 'Books' END", "Expenses4Amt": BALANCE},
}
LINE_VALUES = {
    "grant_details": {
        "BusinessNameLine1Txt": "CASE WHEN l_suppkey % 4 <> 0 THEN concat('Fund ', l_suppkey) END",
        "RecipientPersonNm": "concat('Person ', l_suppkey)", "RecipientEIN": "CAST(l_suppkey AS STRING)",
        "CityNm": "concat('Saint ', l_returnflag)", "StateAbbreviationCd": "'ny'", "ZIPCd": "CAST(l_partkey AS STRING)",
        "GrantOrContributionPurposeTxt": "l_returnflag", "CashGrantAmt": GRANT},
    "independent_contractor_details": {
        "PersonNm": "concat('Worker ', l_partkey)",
        "BusinessNameLine1Txt": "CASE WHEN l_partkey % 3 = 0 THEN concat('Firm ', l_partkey) END",
        "ZIPCd": "CAST(l_suppkey AS STRING)", "ServicesDesc": "l_returnflag",
        "CompensationAmt": "CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING)"},
}
BY_NAME = {s.name: s for s in SPECS}


def base(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(BASE_SQL, orders=orders, customer=customer)


def _escaped(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def _element(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"<{name}>"), _escaped(value), F.lit(f"</{name}>")), F.lit(""))


def _group(name: str, inner: list[Column]) -> Column:
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def _by_form(build) -> Column:
    chosen = reduce(lambda acc, form: acc.when(F.col("form") == form, build(form)), ("990", "990PF", "990EZ"), F)
    return chosen.otherwise(F.lit(""))


def _body(form: str) -> Column:
    """All single-record datasets of a form; datasets that share a subroot share its element."""
    groups: dict[str, list[Column]] = {}
    for name, values in FILING_VALUES.items():
        spec = BY_NAME[name]
        if name != "filing_details" and form in spec.subroots:
            groups.setdefault(spec.subroots[form], []).extend(
                _element(spec.fields[c][form], F.expr(v)) for c, v in values.items() if spec.fields[c].get(form))
    return F.concat(*[_group(root, parts) for root, parts in groups.items()])


def _tags(names: Mapping[str, str]) -> tuple[Column, Column]:
    """Opening and closing tag of an element whose name depends on the form."""
    first, *others = dict.fromkeys(names.values())

    def chosen(start: str) -> Column:
        forms = {name: [f for f, own in names.items() if own == name] for name in others}
        return (reduce(lambda acc, name: acc.when(F.col("form").isin(forms[name]), F.lit(f"{start}{name}>")), others, F)
                .otherwise(F.lit(f"{start}{first}>")) if others else F.lit(f"{start}{first}>"))

    return chosen("<"), chosen("</")


def _of_forms(names: Mapping[str, str], inner: list[Column], among: Iterable[str] = ()) -> Column:
    """An element that only some forms have, empty on others and when a part is null. Of forms ``among`` it is only asked there."""
    opened, closed = _tags(names)
    whole = F.concat(opened, *inner, closed)
    return F.coalesce(whole if set(among) == set(names) else F.when(F.col("form").isin([*names]), whole), F.lit(""))


def _records() -> Column:
    """The records of one line item.

    Every value stands in the expression once, and not once per form: the JVM leaves methods above 8,000 bytes uncompiled.
    """
    parts = []
    for name, values in LINE_VALUES.items():
        spec = BY_NAME[name]
        elements = (({f: spec.fields[c][f] for f in spec.subroots if spec.fields[c].get(f)}, v) for c, v in values.items())
        parts.append(_of_forms(spec.subroots, [_of_forms(names, [_escaped(F.expr(v))], spec.subroots) for names, v in elements if names]))
    return F.concat(*parts)


#: Filings written and read by one task, archives made from a batch of documents, and tasks that write archives per slot.
TASK_FILINGS, ARCHIVE_MEMBERS, TASKS_PER_SLOT = 20_000, 500, 16


def filing_documents(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, only: Column | None = None) -> DataFrame:
    """``(zip_name, member, xml, error)``: one document per order, or of those alone whose filing passes the test ``only``.

    The number of tasks is explicit: documents are many times as large as the rows they come from, by whose size
    adaptive execution would fold them into few tasks.
    """
    width = max(orders.sparkSession.sparkContext.defaultParallelism, -(-orders.count() // TASK_FILINGS))
    listed_for = filings = base(orders, customer).repartition(width, "filing_number")
    if only is not None:
        filings = filings.filter(only)
        # A number may stand for several filings, whose documents share their records.
        listed_for = listed_for.join(filings.select("filing_number"), "filing_number", "left_semi")
    lines = orders.sparkSession.sql(LINES_SQL.format(base="SELECT * FROM {b}", lineitem="{lineitem}"),
                                    b=listed_for, lineitem=lineitem.repartition(width, "l_orderkey"))
    listed = lines.select("filing_number", _records().alias("record")).groupBy("filing_number").agg(F.collect_list("record").alias("records"))
    # Sorting the list here, not in the aggregate, also keeps the long expression below out of the stage's one method.
    records = F.array_join(F.array_sort("records"), "")
    header = _group("ReturnHeader", [
        _element("TaxYr", F.col("tax_yr").cast("string")), _element("ReturnTypeCd", F.col("form")),
        _group("Filer", [_element("EIN", F.col("ein").cast("string")),
                         *[_element(c, F.expr(v)) for c, v in FILING_VALUES["filing_details"].items()]])])
    xml = F.concat(F.lit(f'<?xml version="1.0" encoding="utf-8"?><Return xmlns="{NAMESPACE}">'), header,
                   _group("ReturnData", [_by_form(_body), F.coalesce(records, F.lit(""))]), F.lit("</Return>"))
    return (filings.join(listed, "filing_number", "left")
            .select("zip_name", F.concat(F.col("filing_number").cast("string"), F.lit("_public.xml")).alias("member"),
                    xml.alias("xml"), F.lit(None).cast("string").alias("error")))


def _archive(members: Iterable[str], texts: Iterable[str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
        for member, xml in zip(members, texts, strict=True):
            archive.writestr(member, xml)
    return buffer.getvalue()


def zipped(docs: DataFrame) -> DataFrame:
    """``(path, content)`` archives of the documents, each of at most ``ARCHIVE_MEMBERS``, handed on one at a time."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(at, ARCHIVE_MEMBERS) for b in batches for at in range(0, b.num_rows, ARCHIVE_MEMBERS))
        for n, part in enumerate(parts):
            content = _archive(part.column("member").to_pylist(), part.column("xml").to_pylist())
            yield pa.RecordBatch.from_pydict({"path": [f"/landing/{n}.zip"], "content": [content]})

    return docs.select("member", "xml").mapInArrow(pack, "path string, content binary")


def write_archives(docs: DataFrame, directory: str) -> None:
    """One archive file per zip name; a name covers a bounded range of orders."""
    def pack(table):  # annotations would switch Spark to another signature
        write_path(f"{directory}/{table.column('zip_name')[0].as_py()}", _archive(table.column("member").to_pylist(), table.column("xml").to_pylist()))
        return pa.table({"members": pa.array([table.num_rows], pa.int64())})

    width = TASKS_PER_SLOT * docs.sparkSession.sparkContext.defaultParallelism
    dealt = docs.select("zip_name", "member", "xml").repartition(width, "zip_name")
    with no_leftovers(docs.sparkSession):
        dealt.groupBy("zip_name").applyInArrow(pack, "members long").agg(F.sum("members")).collect()


def _sql_base() -> str:
    return BASE_SQL.format(orders="orders", customer="customer")


def sql_lines() -> str:
    return LINES_SQL.format(base=_sql_base(), lineitem="lineitem")


def expected_sql(specs: tuple[Spec, ...] = SPECS) -> str:
    """``(dataset, filing_number, field, value)`` rows extraction should give, as SQL over the source tables."""
    parts = []
    for spec in specs:
        values, source = ((FILING_VALUES[spec.name], "base") if spec.name in FILING_VALUES
                          else (LINE_VALUES[spec.name], "lines"))
        for form in spec.subroots:
            shown = {c: v for c, v in values.items() if spec.fields[c].get(form)}
            if shown:
                names = ", ".join(f"'{c}'" for c in shown)
                exprs = ", ".join(shown.values())
                parts.append(f"SELECT '{spec.name}' AS dataset, filing_number, unnest([{names}]) AS field, "
                             f"unnest([{exprs}]) AS value FROM {source} WHERE form = '{form}'")
    return (f"WITH base AS ({_sql_base()}), lines AS ({sql_lines()}) SELECT * FROM (" + " UNION ALL ".join(parts)
            + ") WHERE value IS NOT NULL")
