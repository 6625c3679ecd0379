"""Every checked query: a Spark plan over the given tables and, where SQL can say it, its SQL twin.

All queries read whole tables. The matching queries take the title and address of a page for an
organisation's name and place.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from almsflow import schemas as S
from almsflow.functions import columns as C, text as X, vectors as V
from almsflow.functions.similarity import token_sort_score
from almsflow.operators import aggregates as A, dedupe, extract as E, ids as I, match as M, recommend as RC
from almsflow.operators import relational as R, reshape, sampling as SM, train as TR
from almsflow.plans import filingdocs as FD, jobs as J
from almsflow.plans.specs import SPECS, Spec
from almsflow.runtime import cut_lineage, fresh_path, remove
from almsflow.sources import archives, csvfiles, files, incremental, links, tables, zipsource
from almsflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load(spark: SparkSession, sf: str, *names: str) -> list[DataFrame] | DataFrame:
    found = [spark.read.parquet(f"{sf}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found


# --- SQL building blocks of the twins -------------------------------------------------

def _sql_words(e: str) -> str:
    return (rf"string_split(trim(regexp_replace(upper(replace({e}, 'ß', 'SS')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')), ' ')")


def _sql_mapped(e: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items())
    return f"list_transform({_sql_words(e)}, lambda w: CASE w {cases} ELSE w END)"


def sql_name(e: str) -> str:
    gone = ", ".join(f"'{w}'" for w in X.NAME_SUFFIXES)
    return f"coalesce(array_to_string(list_filter({_sql_mapped(e, X.NAME_WORDS)}, lambda w: w NOT IN ({gone})), ' '), '')"


def sql_city(e: str) -> str:
    return f"coalesce(array_to_string({_sql_mapped(e, X.CITY_WORDS)}, ' '), '')"


def sql_sorted(e: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split_regex({e}, '\\s+'), lambda w: w <> '')), ' ')"


def sql_lcs(a: str, b: str) -> str:
    """Longest common subsequence by the row recurrence."""
    row = (f"list_reduce(range(1, len({b}) + 1), lambda acc, j: list_append(acc, "
           f"CASE WHEN {b}[j] = ch THEN prev[j] + 1 ELSE greatest(prev[j + 1], acc[len(acc)]) END), [0])")
    steps = f"list_reduce(list_transform(string_split({a}, ''), lambda c: c), lambda prev, ch: {row}, X)"
    zeros = f"list_transform(range(0, len({b}) + 1), lambda z: 0)"
    return f"list_last({steps.replace('X', zeros)})"


def sql_draw(a: str, b: str, seed: int) -> str:
    keys, left, right = [f"(({a}) & 4294967295)", f"(({a}) >> 32)"], f"(({b}) & 4294967295)", f"(({b}) >> 32)"
    for i, (multiplier, constant) in enumerate(zip(SM.MULTIPLIERS, SM.round_constants(seed))):
        mixed = f"(xor(xor({right}, {keys[i % 2]}), {constant}::BIGINT) * {multiplier}::BIGINT)"
        left, right = right, f"xor({left}, ({mixed} >> 15) & 4294967295)"
    return f"(({left} << 31) | ({right} >> 1))"


PAIRS_SQL = """
pairs AS (SELECT o_custkey AS donor_ein, l_suppkey AS receiver_ein, CAST(sum(CAST(l_extendedprice AS DECIMAL(24,2))) AS DOUBLE) AS grant_amt
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
d_ids AS (SELECT donor_ein AS ein, row_number() OVER (ORDER BY max(grant_amt) DESC, donor_ein) - 1 AS id FROM pairs GROUP BY donor_ein),
r_ids AS (SELECT receiver_ein AS ein, row_number() OVER (ORDER BY max(grant_amt) DESC, receiver_ein) - 1 AS id FROM pairs GROUP BY receiver_ein),
id_pairs AS (SELECT d.id AS donor_id, r.id AS receiver_id, grant_amt FROM pairs
             JOIN d_ids d ON d.ein = donor_ein JOIN r_ids r ON r.ein = receiver_ein)"""

NEGATIVES_SQL = PAIRS_SQL + f""",
wants AS (SELECT donor_id, count(*) AS n FROM id_pairs GROUP BY donor_id),
tried AS (SELECT donor_id, n, unnest(range(0, n * 15)) AS attempt FROM wants),
drawn AS (SELECT donor_id, n, attempt, {sql_draw("donor_id", "attempt", 42)} % (SELECT count(*) FROM r_ids) AS receiver_id FROM tried),
missed AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY attempt) AS nth FROM drawn ANTI JOIN id_pairs USING (donor_id, receiver_id)),
negatives AS (SELECT donor_id, receiver_id FROM missed WHERE nth <= n * 5),
samples AS (SELECT donor_id, receiver_id, 1 AS label FROM id_pairs UNION ALL SELECT donor_id, receiver_id, 0 FROM negatives)"""


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as grants from the ordering customer to the supplier."""
    lineitem, orders = load(spark, sf, "lineitem", "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("donor_ein"), F.col("l_suppkey").alias("receiver_ein"),
        F.col("l_extendedprice").alias("grant_amt"))


def id_pairs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    totals = cut_lineage(A.pair_totals(edges(spark, sf)))
    donors, receivers = I.dense_ids(totals, "donor_ein"), I.dense_ids(totals, "receiver_ein")
    return I.with_ids(totals, donors, receivers), donors, receivers


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


# --- scalar functions -------------------------------------------------------------------

@query("zip5", "SELECT c_custkey, lpad(substr(CAST(c_custkey * 37 AS VARCHAR), 1, 5), 5, '0') AS zip, "
               "lpad(substr(nullif(c_mktsegment, 'BUILDING'), 1, 5), 5, '0') AS zip_or_null FROM customer")
def _(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", X.zip5((F.col("c_custkey") * 37).cast("string")).alias("zip"),
                    X.zip5(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("zip_or_null"))


_SUFFIXED = "text || CASE doc_id % 5 WHEN 0 THEN ' Foundation, Inc.' WHEN 1 THEN ' and Trust Co' WHEN 2 THEN ' National Association LLC' WHEN 3 THEN ' University' ELSE '' END"


@query("clean_name_docs", f"SELECT doc_id, {sql_name(_SUFFIXED)} AS name, CAST(length({sql_name(_SUFFIXED)}) AS INT) AS n FROM documents")
def _(spark, sf):
    named = load(spark, sf, "documents").select("doc_id", X.clean_name(F.expr(_SUFFIXED)).alias("name"))
    return named.withColumn("n", F.length("name"))


_CITY = "CASE doc_id % 3 WHEN 0 THEN 'SAINT-' WHEN 1 THEN 'Fort ' ELSE 'Mount.' END || text"


@query("clean_city_docs", f"SELECT doc_id, {sql_city(_CITY)} AS city FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", X.clean_city(F.expr(_CITY)).alias("city"))


@query("clean_state_zip", r"SELECT c_custkey, coalesce(left(upper(trim(nullif(c_mktsegment, 'BUILDING'))), 2), '') AS state, "
                          r"regexp_extract(c_name, '(\d{5})', 1) AS zip, regexp_extract(c_mktsegment, '(\d{5})', 1) AS no_zip FROM customer")
def _(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", X.clean_state(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("state"),
        X.clean_zip(F.col("c_name")).alias("zip"), X.clean_zip(F.col("c_mktsegment")).alias("no_zip"))


@query("coalesce_fill", """SELECT event_id, coalesce(nullif(event_type, 'error'), props) AS kind,
    coalesce(CASE WHEN value < 50 THEN value END, 0) AS amount,
    coalesce(CASE WHEN event_type = 'click' THEN user_id END, 0) AS clicker FROM events""")
def _(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id", C.first_present(F.nullif(F.col("event_type"), F.lit("error")), F.col("props")).alias("kind"),
        F.when(F.col("value") < 50, F.col("value")).alias("amount"),
        C.zero_filled_int(F.when(F.col("event_type") == "click", F.col("user_id"))).alias("clicker"))
    return C.fill_zero(e, ["amount"])


@query("rename_cast", """SELECT CAST(o_orderkey AS VARCHAR) AS filing_number, o_custkey AS ein,
    TRY_CAST(o_orderpriority AS DOUBLE) AS priority, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS level FROM orders""")
def _(spark, sf):
    o = load(spark, sf, "orders").withColumn("first", F.substring("o_orderpriority", 1, 1)).drop("o_orderdate")
    named = C.select_renamed(o, {"o_orderkey": "filing_number", "o_custkey": "ein", "o_orderpriority": "priority", "first": "level"})
    return C.cast_to(named, S.table(("filing_number", S.STR), ("ein", S.LONG), ("priority", S.DBL), ("level", S.LONG), key=False))


@query("conditional_label", "SELECT l_orderkey, l_linenumber, CASE WHEN coalesce(l_tax, 0) <> 0 THEN 'taxed' END AS note, 1 AS label FROM lineitem")
def _(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", C.text_when_amount(F.col("l_tax"), "taxed").alias("note"), F.lit(1).alias("label"))


@query("composite_key", "SELECT p_partkey, p_name || '|' || p_type AS k FROM part")
def _(spark, sf):
    return load(spark, sf, "part").select("p_partkey", X.lookup_key(F.col("p_name"), F.col("p_type")).alias("k"))


@query("lcs_ratio", f"""WITH t AS (SELECT page_id, {sql_sorted("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS s FROM pages),
    p AS (SELECT a.page_id, a.s AS sa, string_split(b.s, '') AS sb, b.s AS tb FROM t a JOIN t b ON b.page_id = a.page_id + 1)
    SELECT page_id, round(200.0 * {sql_lcs("sa", "sb")} / (length(sa) + length(tb)), 6) AS score FROM p""")
def _(spark, sf):
    t = load(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("t"))
    following = t.select((F.col("page_id") - 1).alias("page_id"), F.col("t").alias("u"))
    return t.join(following, "page_id").select("page_id", F.round(token_sort_score(F.col("t"), F.col("u")), 6).alias("score"))


# --- filters and reshaping ----------------------------------------------------------------

_DESCRIBED = ("CASE doc_id % 8 WHEN 0 THEN ' see statement 4 ' WHEN 1 THEN '(See Statement)' WHEN 2 THEN 'None' WHEN 3 THEN 'See attachment ' "
              "WHEN 4 THEN 'see general explanation ' WHEN 5 THEN 'PLEASE SEE STATEMENT' WHEN 6 THEN '' END || text")
_PHRASES = " OR ".join(f"starts_with(u, '{p}')" for p in R.PLACEHOLDERS)


@query("placeholder_filter", f"""SELECT doc_id, d FROM (SELECT doc_id, {_DESCRIBED} AS d,
    regexp_replace(upper({_DESCRIBED}), '^\\s+|\\s+$', '', 'g') AS u FROM documents) WHERE d IS NOT NULL AND NOT ({_PHRASES})""")
def _(spark, sf):
    return R.drop_placeholders(load(spark, sf, "documents").select("doc_id", F.expr(_DESCRIBED).alias("d")), "d")


@query("nonempty_positive", f"SELECT c_custkey, {sql_name('c_mktsegment')} AS name, c_acctbal FROM customer WHERE c_mktsegment <> 'FURNITURE' AND c_acctbal > 0")
def _(spark, sf):
    c = load(spark, sf, "customer").select(
        "c_custkey", X.clean_name(F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE"))).alias("name"), "c_acctbal")
    return R.positive(R.nonempty(c, "name"), "c_acctbal")


@query("unpivot_prices", """SELECT l_orderkey, l_linenumber, '1' AS num, l_quantity AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, '2', l_extendedprice FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, '3', l_discount FROM lineitem""")
def _(spark, sf):
    wide = C.select_renamed(load(spark, sf, "lineitem"), {
        "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_quantity": "Measure1Amt",
        "l_extendedprice": "Measure2Amt", "l_discount": "Measure3Amt"})
    return reshape.unpivot_numbered(wide, ["l_orderkey", "l_linenumber"], ["Measure1Amt", "Measure2Amt", "Measure3Amt"], "amount")


def _wide_parts(spark, sf):
    part = load(spark, sf, "part").select(
        "p_partkey", "p_type", "p_size", F.col("p_name").alias("Description1Txt"), F.col("p_size").cast("double").alias("Expenses1Amt"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN 'None given' ELSE p_brand END").alias("Description2Txt"),
        F.col("p_retailprice").alias("Expenses2Amt"), F.expr("CAST(nullif(p_partkey % 4, 3) AS DOUBLE)").alias("other"))
    return reshape.add_other_pair(part, "other")


_D3, _E3 = [f"Description{i}Txt" for i in (1, 2, 3)], [f"Expenses{i}Amt" for i in (1, 2, 3)]
_WIDE_SQL = f"""WITH long AS (
    SELECT p_partkey, p_type, p_size, 1 AS num, p_name AS d, CAST(p_size AS DOUBLE) AS e FROM part
    UNION ALL SELECT p_partkey, p_type, p_size, 2, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, p_retailprice FROM part
    UNION ALL SELECT p_partkey, p_type, p_size, 3, CASE WHEN coalesce(nullif(p_partkey % 4, 3), 0) <> 0 THEN '{reshape.OTHER_INVESTMENTS}' END,
              CAST(nullif(p_partkey % 4, 3) AS DOUBLE) FROM part)"""


@query("pair_row", _WIDE_SQL + ' SELECT p_partkey, d AS "DescriptionTxt", coalesce(e, 0) AS "ExpensesAmt" FROM long WHERE d IS NOT NULL')
def _(spark, sf):
    return reshape.pair_to_rows(_wide_parts(spark, sf), ["p_partkey"], _D3, _E3)


@query("pair_melt_join", _WIDE_SQL + """ SELECT a.p_type, a.p_size, a.d AS "DescriptionTxt", coalesce(b.e, 0) AS "ExpensesAmt"
    FROM long a JOIN long b ON a.p_type = b.p_type AND a.p_size = b.p_size AND a.num = b.num WHERE a.d IS NOT NULL""")
def _(spark, sf):
    return reshape.pair_to_rows(_wide_parts(spark, sf), ["p_type", "p_size"], _D3, _E3, "melt_join")


# --- deduplication and filing joins ----------------------------------------------------------

_FILING_COLS = {"filing_number": "o_orderkey", "zip_name": "concat('batch_', o_orderstatus)", "ein": "o_custkey",
                "tax_yr": "CAST(year(o_orderdate) AS BIGINT)", "form": "o_orderpriority"}
_FILING_SQL = ", ".join(f"{e} AS {n}" for n, e in _FILING_COLS.items())
_LATEST_SQL = f"""filings AS (SELECT {_FILING_SQL}, o_totalprice FROM orders),
    latest AS (SELECT * FROM filings QUALIFY row_number() OVER (PARTITION BY ein, tax_yr, form ORDER BY filing_number DESC) = 1)"""


def _filings(spark, sf):
    return load(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in _FILING_COLS.items()], "o_totalprice")


@query("keep_latest", f"WITH {_LATEST_SQL} SELECT * FROM latest")
def _(spark, sf):
    return dedupe.latest_filings(_filings(spark, sf))


@query("keep_largest_zero_filled", """WITH a AS (SELECT CAST(c_nationkey AS BIGINT) AS filing_number, c_name AS zip_name, CAST(c_nationkey AS BIGINT) AS ein,
      CAST(2020 AS BIGINT) AS tax_yr, c_mktsegment AS form, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_acctbal - 5000 END, 0) AS managed FROM customer)
    SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY filing_number, ein, tax_yr, form ORDER BY managed DESC, zip_name DESC) = 1""")
def _(spark, sf):
    nation = F.col("c_nationkey").cast("bigint")
    a = load(spark, sf, "customer").select(
        nation.alias("filing_number"), F.col("c_name").alias("zip_name"), nation.alias("ein"), F.lit(2020).cast("bigint").alias("tax_yr"),
        F.col("c_mktsegment").alias("form"), F.expr("CASE WHEN c_custkey % 3 > 0 THEN c_acctbal - 5000 END").alias("managed"))
    return dedupe.largest_amounts(a, "managed")


@query("keep_greatest_text", """WITH a AS (SELECT CAST(p_size AS BIGINT) AS filing_number, p_type AS zip_name, CAST(p_size AS BIGINT) AS ein, CAST(2020 AS BIGINT) AS tax_yr,
      p_brand AS form, nullif(p_name, 'red ring') AS mission, p_partkey FROM part)
    SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY filing_number, ein, tax_yr, form ORDER BY mission DESC NULLS LAST, zip_name DESC, p_partkey DESC) = 1""")
def _(spark, sf):
    size = F.col("p_size").cast("bigint")
    a = load(spark, sf, "part").select(
        size.alias("filing_number"), F.col("p_type").alias("zip_name"), size.alias("ein"), F.lit(2020).cast("bigint").alias("tax_yr"),
        F.col("p_brand").alias("form"), F.nullif(F.col("p_name"), F.lit("red ring")).alias("mission"), "p_partkey")
    return dedupe.greatest_text(a, "mission")


@query("left_chain", """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(spent, 0) AS spent, coalesce(n_events, 0) AS n_events, coalesce(open_orders, 0) AS open_orders
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(24,2))) AS DOUBLE) AS spent FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1) b ON b.user_id = c_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS open_orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) c ON c.o_custkey = c_custkey""")
def _(spark, sf):
    customer, orders, events = load(spark, sf, "customer", "orders", "events")
    key = F.col("o_custkey").alias("c_custkey")
    spent = F.sum(F.col("o_totalprice").cast("decimal(24,2)")).cast("double")
    a = orders.groupBy(key).agg(F.count(F.lit(1)).alias("n_orders"), spent.alias("spent"))
    b = events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_events"))
    c = orders.filter("o_orderstatus = 'O'").groupBy(key).agg(F.count(F.lit(1)).alias("open_orders"))
    return C.fill_zero(R.left_chain(customer.select("c_custkey"), [a, b, c], ["c_custkey"]))


@query("survivor_semi", f"WITH {_LATEST_SQL} SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem WHERE l_orderkey IN (SELECT filing_number FROM latest)")
def _(spark, sf):
    kept = dedupe.latest_filings(_filings(spark, sf)).withColumnRenamed("filing_number", "l_orderkey")
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return R.of_survivors(rows, kept, ["l_orderkey"])


@query("survivor_keys", f"WITH {_LATEST_SQL} SELECT DISTINCT ein, tax_yr FROM latest")
def _(spark, sf):
    return R.survivors(dedupe.latest_filings(_filings(spark, sf)), ["ein", "tax_yr"])


@query("compile_grants_flow", f"""WITH {_LATEST_SQL} SELECT ein AS donor_ein, l_suppkey AS receiver_ein, CAST(sum(CAST(l_extendedprice AS DECIMAL(24,2))) AS DOUBLE) AS grant_amt
    FROM lineitem JOIN latest ON l_orderkey = filing_number WHERE l_suppkey > 0 AND l_extendedprice > 0 AND l_returnflag <> 'A' GROUP BY ALL""")
def compile_grants_flow(spark, sf):
    filings = _filings(spark, sf)
    organizations = dedupe.latest_filings(filings)
    lines = load(spark, sf, "lineitem")
    missing = F.lit(None).cast("string")
    grants = lines.join(filings, F.col("l_orderkey") == F.col("filing_number")).select(
        *S.FILING_KEY, F.when(F.col("l_returnflag") != "A", F.col("l_suppkey")).alias("RecipientEIN"),
        F.col("l_returnflag").alias("BusinessNameLine1Txt"), missing.alias("RecipientPersonNm"), missing.alias("AddressLine1Txt"),
        missing.alias("CityNm"), missing.alias("StateAbbreviationCd"), F.col("l_partkey").cast("string").alias("ZIPCd"),
        missing.alias("GrantOrContributionPurposeTxt"), F.col("l_extendedprice").alias("CashGrantAmt"))
    compiled = J.compile_grants(grants, organizations).withColumn("inferred_ein", F.lit(None).cast("bigint"))
    return A.grant_edges(compiled)


# --- aggregates ---------------------------------------------------------------------------------

@query("unique_recipients", f"""WITH c AS (SELECT doc_id, {sql_name('text')} AS clean_recipient_name, {sql_city('source')} AS clean_recipient_city, left(upper(lang), 2) AS clean_recipient_state,
      nullif(source, 'src0') AS recipient_city, CASE WHEN doc_id % 2 = 0 THEN doc_id END AS even_id FROM documents)
    SELECT clean_recipient_name, clean_recipient_city, clean_recipient_state, arg_min(recipient_city, doc_id) AS recipient_city,
      arg_min(even_id, doc_id) AS even_id FROM c GROUP BY ALL""")
def _(spark, sf):
    c = load(spark, sf, "documents").select(
        "doc_id", X.clean_name(F.col("text")).alias(M.CLEAN_KEY[0]), X.clean_city(F.col("source")).alias(M.CLEAN_KEY[1]),
        X.clean_state(F.col("lang")).alias(M.CLEAN_KEY[2]), F.nullif(F.col("source"), F.lit("src0")).alias("recipient_city"),
        F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).alias("even_id"))
    return A.first_by(c, M.CLEAN_KEY[:3], ["recipient_city", "even_id"], F.col("doc_id"))


@query("last_wins_lookup", "SELECT p_name || '|' || p_type AS key, arg_max(p_partkey, p_partkey) AS ein, min(p_partkey) AS ord FROM part GROUP BY 1")
def _(spark, sf):
    rows = load(spark, sf, "part").select(X.lookup_key(F.col("p_name"), F.col("p_type")).alias("key"),
                                          F.col("p_partkey").alias("ein"), F.col("p_partkey").alias("ord"))
    return M.last_wins(rows, ["key"])


@query("pair_totals", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def _(spark, sf):
    return A.largest_first(A.pair_totals(edges(spark, sf)))


@query("grand_total", "SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(24,2))) AS DOUBLE) AS grant_total FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(spark, sf):
    return A.grand_total(edges(spark, sf))


@query("entity_counts", "SELECT count(DISTINCT o_custkey) AS n_donors, count(DISTINCT l_suppkey) AS n_receivers FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(spark, sf):
    return A.entity_counts(edges(spark, sf))


@query("grants_per_donor", f"WITH {PAIRS_SQL} SELECT donor_ein, count(*) AS n FROM pairs GROUP BY 1")
def _(spark, sf):
    return A.rows_per(A.pair_totals(edges(spark, sf)), "donor_ein")


# --- recipient resolution -----------------------------------------------------------------------

_TITLE, _HOST = "regexp_extract(html, '<title>([^<]*)</title>', 1)", "regexp_extract(url, '//([^/]*)', 1)"
_PLACE = {"NAME": _TITLE, "CITY": f"regexp_extract({_HOST}, '([a-z]+)$', 1)", "STATE": "regexp_extract(url, '//[^/]*/([a-z]+)', 1)",
          "ZIP": f"lpad(CAST(length({_HOST}) AS STRING), 5, '0')"}


def _sites(spark, sf):
    """Plain-http pages are recipients, https pages the registry: titles repeat and nearly repeat between them."""
    pages = load(spark, sf, "pages")
    grants = pages.filter("url LIKE 'http:%'").select("page_id", *[F.expr(e).alias(f"recipient_{n.lower()}") for n, e in _PLACE.items()])
    registry = pages.filter("url LIKE 'https:%'").select(
        F.col("page_id").alias("EIN"), *[F.expr(e).alias(n) for n, e in _PLACE.items()], F.col("page_id").alias("ord"))
    return grants, registry


_PLACE_SQL = ", ".join(f"{e} AS {n.lower()}" for n, e in _PLACE.items())
def match_sql(threshold: int) -> str:
    return f"""
raw AS (SELECT page_id, url LIKE 'https:%' AS registered, {_PLACE_SQL} FROM pages),
clean AS (SELECT page_id, registered, {sql_name('name')} AS n, {sql_city('city')} AS c, left(upper(trim(state)), 2) AS st,
          regexp_extract(zip, '(\\d{{5}})', 1) AS z FROM raw),
keyed AS (SELECT *, n || '|' || c AS k, {sql_sorted("n || '|' || c")} AS t FROM clean),
who AS (SELECT * FROM keyed WHERE NOT registered AND n <> '' AND st <> ''),
org AS (SELECT *, max_by(page_id, page_id) OVER (PARTITION BY st, k) AS ein FROM (SELECT * FROM keyed WHERE registered)),
pairs AS (SELECT DISTINCT w.st, w.t AS wt, o.t AS ot FROM who w JOIN org o ON w.st = o.st
          WHERE least(length(w.t), length(o.t)) * {200 - threshold} >= greatest(length(w.t), length(o.t)) * {threshold}),
scored AS (SELECT st, wt, ot, 200.0 * {sql_lcs("wt", "os")} / (length(wt) + length(ot)) AS score
           FROM (SELECT *, string_split(ot, '') AS os FROM pairs)),
hits AS (SELECT w.n, w.c, w.st, w.z, o.ein, o.z = w.z AND w.z <> '' AS same_zip, s.score,
         row_number() OVER (PARTITION BY w.n, w.c, w.st, w.z ORDER BY o.z = w.z AND w.z <> '' DESC, s.score DESC, o.page_id) AS rank
         FROM (SELECT DISTINCT n, c, st, z, t FROM who) w JOIN scored s ON s.st = w.st AND s.wt = w.t JOIN org o ON o.st = s.st AND o.t = s.ot
         WHERE s.score >= {threshold}),
matched AS (SELECT w.page_id, w.n AS clean_recipient_name, w.c AS clean_recipient_city, w.st AS clean_recipient_state, w.z AS clean_recipient_zip,
            h.ein AS inferred_ein, coalesce(h.score, CASE WHEN w.st IN (SELECT st FROM org) THEN 0 END) AS match_score,
            CASE WHEN h.same_zip THEN 'zip+fuzzy' WHEN h.ein IS NOT NULL THEN 'state_fuzzy' WHEN w.st IN (SELECT st FROM org) THEN 'no_match' END AS match_type
            FROM who w LEFT JOIN hits h ON h.rank = 1 AND h.n = w.n AND h.c = w.c AND h.st = w.st AND h.z = w.z)"""


MATCH_SQL = match_sql(85)
_MATCH_COLS = ["page_id", *M.CLEAN_KEY, "inferred_ein", "match_score", "match_type"]
_ROUNDED = "page_id, clean_recipient_name, clean_recipient_city, clean_recipient_state, clean_recipient_zip, inferred_ein, round(match_score, 6) AS match_score, match_type"


def _matched(spark, sf):
    found = M.infer_recipients(*_sites(spark, sf)).select(*_MATCH_COLS)
    return found.withColumn("match_score", F.round("match_score", 6))


@query("fuzzy_match", f"WITH {MATCH_SQL} SELECT {_ROUNDED} FROM matched")
def _(spark, sf):
    return _matched(spark, sf)


@query("fuzzy_zip_block", f"WITH {MATCH_SQL} SELECT {_ROUNDED} FROM matched WHERE match_type = 'zip+fuzzy'")
def _(spark, sf):
    return _matched(spark, sf).filter("match_type = 'zip+fuzzy'")


@query("fuzzy_state_fallback", f"WITH {MATCH_SQL} SELECT {_ROUNDED} FROM matched WHERE match_type <> 'zip+fuzzy'")
def _(spark, sf):
    return _matched(spark, sf).filter("match_type <> 'zip+fuzzy'")


@query("fuzzy_low_threshold", f"WITH {match_sql(75)} SELECT {_ROUNDED} FROM matched")
def _(spark, sf):
    found = M.infer_recipients(*_sites(spark, sf), threshold=75).select(*_MATCH_COLS)
    return found.withColumn("match_score", F.round("match_score", 6))


@query("fuzzy_custom_scorer", """WITH l AS (SELECT DISTINCT p_brand, p_name AS text FROM part), r AS (SELECT p_brand, p_type AS t, min(p_partkey) AS ein FROM part GROUP BY ALL)
    SELECT l.p_brand, text, 100 - 10 * CAST(abs(length(text) - length(t)) AS DOUBLE) AS score, ein FROM l JOIN r ON l.p_brand = r.p_brand
    WHERE abs(length(text) - length(t)) <= 5 QUALIFY row_number() OVER (PARTITION BY l.p_brand, text ORDER BY score DESC, ein) = 1""")
def _(spark, sf):
    """A scorer that has nothing to do with common characters: no pair may be pruned by their bounds."""
    part = load(spark, sf, "part")
    texts = part.select("p_brand", F.col("p_name").alias("text")).distinct()
    known = part.groupBy("p_brand", F.col("p_type").alias("text")).agg(F.min("p_partkey").alias("ein")).withColumns({"ord": F.col("ein"), "key": F.col("text")})
    scorer = lambda a, b: 100 - 10 * F.abs(F.length(a) - F.length(b)).cast("double")
    return M.best_matches(texts, known, ["p_brand"], 50, scorer).drop("key")


@query("run_infer_flow", f"WITH {MATCH_SQL} SELECT {_ROUNDED} FROM matched UNION ALL "
                         "SELECT count(*), match_type, '', '', '', 0, 0, 'report' FROM matched WHERE match_type IS NOT NULL GROUP BY 2")
def _(spark, sf):
    """The job from files to files: a grants table, registry files in EIN order, the resolved table and its report."""
    grants, registry = _sites(spark, sf)
    path = fresh_path(spark, "infer")
    tables.write_table(grants, f"{path}/grants")
    csvfiles.write_csv(registry.select("EIN", "NAME", "CITY", "STATE", "ZIP").sort("EIN"), f"{path}/registry")
    J.run_infer_recipients(spark, f"{path}/grants", f"{path}/registry", f"{path}/resolved")
    resolved = tables.read_table(spark, f"{path}/resolved", _MATCH_COLS).withColumn("match_score", F.round("match_score", 6))
    report = tables.read_table(spark, f"{path}/resolved_report")
    return resolved.unionByName(report.select(
        F.col("n").alias("page_id"), F.col("match_type").alias(M.CLEAN_KEY[0]), *[F.lit("").alias(c) for c in M.CLEAN_KEY[1:]],
        F.lit(0).cast("long").alias("inferred_ein"), F.lit(0.0).alias("match_score"), F.lit("report").alias("match_type")))


@query("match_rate", f"WITH {MATCH_SQL} SELECT count(inferred_ein) AS matched, count(*) AS total, round(count(inferred_ein) / count(*) * 100, 1) AS percent FROM matched")
def _(spark, sf):
    return A.match_rate(_matched(spark, sf))


@query("match_summary", f"WITH {MATCH_SQL} SELECT match_type, count(*) AS n FROM matched WHERE match_type IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return A.match_breakdown(_matched(spark, sf))


# --- ids, samples, split ------------------------------------------------------------------------

@query("entity_ids", f"WITH {PAIRS_SQL} SELECT 'donor' AS side, ein, id FROM d_ids UNION ALL SELECT 'receiver', ein, id FROM r_ids")
def _(spark, sf):
    _, donors, receivers = id_pairs(spark, sf)
    return R.union_all(donors.select(F.lit("donor").alias("side"), "ein", "id"), receivers.select(F.lit("receiver").alias("side"), "ein", "id"))


@query("id_lookup", f"WITH {PAIRS_SQL} SELECT donor_id, receiver_id, grant_amt FROM id_pairs")
def _(spark, sf):
    return id_pairs(spark, sf)[0].select("donor_id", "receiver_id", "grant_amt")


def _negatives(spark, sf):
    pairs, _, receivers = id_pairs(spark, sf)
    pairs = cut_lineage(pairs.select("donor_id", "receiver_id"))
    return pairs, SM.negative_samples(pairs, receivers.count())


@query("negative_samples", f"WITH {NEGATIVES_SQL} SELECT * FROM negatives")
def _(spark, sf):
    return _negatives(spark, sf)[1]


@query("training_set", f"WITH {NEGATIVES_SQL} SELECT * FROM samples")
def _(spark, sf):
    return SM.shuffled(SM.training_set(*_negatives(spark, sf)))


@query("split_85_15", f"WITH {NEGATIVES_SQL} SELECT *, CASE WHEN {sql_draw('donor_id', 'receiver_id', 42)} % 100 < 85 THEN 'train' ELSE 'val' END AS split FROM samples")
def _(spark, sf):
    return SM.with_split(SM.training_set(*_negatives(spark, sf)))


@query("split_exact", f"""WITH {NEGATIVES_SQL}, placed AS (SELECT label, row_number() OVER (ORDER BY {sql_draw('donor_id', 'receiver_id', 42)}, donor_id, receiver_id, label) - 1 AS pos FROM samples)
    SELECT CASE WHEN pos < ceil((SELECT count(*) FROM samples) * 0.15) THEN 'val' ELSE 'train' END AS split, label, count(*) AS n FROM placed GROUP BY ALL""")
def _(spark, sf):
    samples = cut_lineage(SM.training_set(*_negatives(spark, sf)))
    return A.rows_per(SM.with_exact_split(samples), "split", "label")


# --- vectors and recommendation ------------------------------------------------------------------

_DOT = "list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def _dot_sql(a: str, b: str) -> str:
    return _DOT.format(a=a, b=b)


def _top_sql(k: int, condition: str = "TRUE", digits: int = 6) -> str:
    return f"""WITH s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {_dot_sql('q.embedding', 'c.embedding')} AS score
        FROM embeddings q JOIN embeddings c ON {condition}),
    r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank, id, score FROM s)
    SELECT query_id, rank, id, round(score, {digits}) AS score FROM r WHERE rank <= {k}"""


def _six(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


@query("dot_scores", f"SELECT c.vec_id AS id, round({_dot_sql('q.embedding', 'c.embedding')}, 6) AS score FROM embeddings c JOIN embeddings q ON q.vec_id = (SELECT min(vec_id) FROM embeddings)")
def _(spark, sf):
    v = vectors(spark, sf)
    first = v.agg(F.min("id")).first()[0]
    return _six(RC.score_against(v, RC.embedding_of(v, first)).select("id", "score"))


_PARTNER_SQL = "partner AS (SELECT vec_id AS donor_id, (7 * vec_id + 3) % (SELECT count(*) FROM embeddings) AS receiver_id, label FROM embeddings)"
_SCORED_SQL = f"""{_PARTNER_SQL}, scored AS (SELECT donor_id, receiver_id, {_dot_sql('d.embedding', 'r.embedding')} AS score, CAST(d.label = r.label AS INT) AS label
    FROM partner JOIN embeddings d ON d.vec_id = donor_id JOIN embeddings r ON r.vec_id = receiver_id)"""


def _partners(spark, sf):
    v = vectors(spark, sf)
    n = v.count()
    pairs = v.select(F.col("id").alias("donor_id"), ((7 * F.col("id") + 3) % n).alias("receiver_id"), F.col("label").alias("own"))
    other = v.select(F.col("id").alias("receiver_id"), F.col("label").alias("theirs"))
    return v, pairs.join(other, "receiver_id").select("donor_id", "receiver_id", (F.col("own") == F.col("theirs")).cast("int").alias("label"))


@query("pair_scores", f"WITH {_SCORED_SQL} SELECT donor_id, receiver_id, label, round(score, 6) AS score FROM scored")
def _(spark, sf):
    v, pairs = _partners(spark, sf)
    return _six(RC.pair_scores(pairs, v, v))


@query("bce_metrics", f"""WITH {_SCORED_SQL} SELECT round(avg(greatest(score, 0) - score * label + ln(1 + exp(-abs(score)))), 6) AS loss,
    round(avg(CAST((1 / (1 + exp(-score)) > 0.5) = (label = 1) AS INT)), 6) AS accuracy FROM scored""")
def _(spark, sf):
    v, pairs = _partners(spark, sf)
    m = A.split_metrics(RC.pair_scores(pairs, v, v))
    return m.select(F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@query("gradient_step", f"""WITH {_SCORED_SQL}, slopes AS (SELECT *, (1 / (1 + exp(-score)) - label) / (SELECT count(*) FROM scored) AS slope FROM scored),
    g AS (SELECT donor_id AS id, i AS pos, sum(slope * CAST(r.embedding[i] AS DOUBLE)) AS grad FROM slopes JOIN embeddings r ON r.vec_id = receiver_id, range(1, 65) t(i) GROUP BY ALL)
    SELECT vec_id AS id, CAST(i AS INT) AS pos, round(CAST(embedding[i] AS DOUBLE) - 50.0 * coalesce(grad, 0), 6) AS value
    FROM embeddings CROSS JOIN range(1, 65) t(i) LEFT JOIN g ON g.id = vec_id AND g.pos = i""")
def _(spark, sf):
    v, pairs = _partners(spark, sf)
    moved = TR.descend(v, TR.gradients(pairs, v, v, 64), "d", 50.0)
    return moved.select("id", F.posexplode("vec").alias("p", "x")).select("id", (F.col("p") + 1).alias("pos"), F.round("x", 6).alias("value"))


@query("top_k_d2r", _top_sql(10))
def _(spark, sf):
    v = vectors(spark, sf)
    return _six(RC.top_k(v, v, 10))


@query("top_k_r2d", _top_sql(20))
def _(spark, sf):
    v = vectors(spark, sf)
    return _six(RC.top_k(v, v, 20))


@query("top_k_candidates", _top_sql(10, "c.label = 3"))
def _(spark, sf):
    v = vectors(spark, sf)
    return _six(RC.top_k_among(v, v, v.filter("label = 3"), 10))


@query("top_k_first", _top_sql(10, "c.vec_id < 1000"))
def _(spark, sf):
    """The quick look over the lowest ids is the feature."""
    v = vectors(spark, sf)
    return _six(RC.top_k(v, RC.first_ids(v, 1000), 10))


@query("similar_entities", _top_sql(5, "q.vec_id <> c.vec_id"))
def _(spark, sf):
    return _six(RC.similar(vectors(spark, sf)))


_ID_MAP = "ids AS (SELECT vec_id AS id, vec_id * 1000 + 7 AS ein FROM embeddings)"


def _with_eins(spark, sf):
    v = vectors(spark, sf)
    ids = v.select((F.col("id") * 1000 + 7).alias("ein"), "id")
    asked = R.union_all(ids.select("ein"), v.select((F.col("id") * 1000 + 8).alias("ein")))
    return asked, RC.recommend(asked, ids, v, ids, v, 3), ids, v


@query("unknown_keys", f"""WITH {_ID_MAP}, top AS ({_top_sql(3)}), known AS (SELECT q.ein AS query_ein, count(*) AS n, max(CASE WHEN rank = 1 THEN c.ein END) AS best FROM top JOIN ids q ON q.id = query_id JOIN ids c ON c.id = top.id GROUP BY 1),
    asked AS (SELECT ein AS query_ein FROM ids UNION ALL SELECT ein + 1 FROM ids)
    SELECT query_ein, CAST(coalesce(n, 0) AS INT) AS n, best FROM asked LEFT JOIN known USING (query_ein)""")
def _(spark, sf):
    asked, results, _, _ = _with_eins(spark, sf)
    lists = RC.recommend_lists(asked, results)
    return lists.select("query_ein", F.size("results").alias("n"), F.try_element_at("results", F.lit(1))["ein"].alias("best"))


@query("recommend_single", f"""WITH {_ID_MAP}, top AS ({_top_sql(10)}) SELECT q.ein AS query_ein, rank, c.ein AS ein, score FROM top JOIN ids q ON q.id = query_id JOIN ids c ON c.id = top.id
    WHERE query_id = (SELECT max(vec_id) FROM embeddings)""")
def _(spark, sf):
    v = vectors(spark, sf)
    ids = v.select((F.col("id") * 1000 + 7).alias("ein"), "id")
    return _six(RC.recommend_one(ids.agg(F.max("ein")).first()[0], ids, v, ids, v, 10))


@query("format_results", f"""WITH {_ID_MAP}, top AS ({_top_sql(3, digits=15)}) SELECT q.ein AS query_ein, rank, printf('%2d. Receiver EIN %12d | Score: %7.4f', rank, c.ein, score) AS line
    FROM top JOIN ids q ON q.id = query_id JOIN ids c ON c.id = top.id""")
def _(spark, sf):
    return RC.display_lines(_with_eins(spark, sf)[1])


_HEAD_SQL = ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS h{i}" for i in range(1, 11))


@query("vector_profile", f"""SELECT vec_id AS id, round(list_avg(e), 6) AS mean, round(list_stddev_samp(e), 6) AS std, round(sqrt(list_dot_product(e, e)), 6) AS norm, {_HEAD_SQL}
    FROM (SELECT *, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""")
def _(spark, sf):
    p = RC.vector_profile(vectors(spark, sf))
    return p.select("id", *[F.round(c, 6).alias(c) for c in ("mean", "std", "norm")],
                    *[F.col("head")[i].cast("double").alias(f"h{i + 1}") for i in range(10)])


@query("analyse_entity", """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), own AS (SELECT * FROM v WHERE id = (SELECT max(id) FROM v)),
    near AS (SELECT v.id, row_number() OVER (ORDER BY list_dot_product(v.e, own.e) DESC, v.id) AS r FROM v, own WHERE v.id <> own.id)
    SELECT id * 1000 + 7 AS ein, id, round(list_avg(e), 6) AS mean, round(list_stddev_samp(e), 6) AS std, round(sqrt(list_dot_product(e, e)), 6) AS norm,
    (SELECT string_agg(r || ':' || (id * 1000 + 7), ',' ORDER BY r) FROM near WHERE r <= 5) AS similar FROM own""")
def _(spark, sf):
    """Profile of one entity, the last, with its five most similar among all."""
    v = vectors(spark, sf)
    ids = v.select((F.col("id") * 1000 + 7).alias("ein"), "id")
    found = RC.analyse(ids.agg(F.max("ein")).first()[0], ids, v)
    near = F.array_join(F.transform("similar", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["ein"].cast("string"))), ",")
    return found.select("ein", "id", *[F.round(c, 6).alias(c) for c in ("mean", "std", "norm")], near.alias("similar"))


@query("model_roundtrip", f"""SELECT 'd' AS side, vec_id AS id, vec_id * 1000 + 7 AS ein, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings
    UNION ALL SELECT 'r', vec_id, vec_id * 1000 + 7, CAST(embedding[64] AS DOUBLE) FROM embeddings""")
def _(spark, sf):
    v, path = vectors(spark, sf), fresh_path(spark, "model")
    ids = v.select((F.col("id") * 1000 + 7).alias("ein"), "id")
    tables.save_ids(ids, ids, path)
    state = R.union_all(v.select(F.lit("d").alias("side"), "id", "vec"), v.select(F.lit("r").alias("side"), "id", F.reverse("vec").alias("vec")))
    TR.save_state(state.withColumn("vec", F.reverse("vec")), f"{path}/vectors", "best")
    TR.save_state(state, f"{path}/vectors", "epoch_1")
    TR.save_state(state, f"{path}/vectors", "best")
    both = zip(("d", "r"), TR.load_vectors(spark, f"{path}/vectors"), tables.load_ids(spark, path))
    return R.union_all(*[vec.join(i, "id").select(F.lit(side).alias("side"), "id", "ein", F.col("vec")[0].cast("double").alias("x")) for side, vec, i in both])


_SMALL = TR.Settings(dim=16, epochs=2, batch=512, learning_rate=0.02, blocks=4)


def _trained(spark, sf):
    pairs, negatives = _negatives(spark, sf)
    path, held = fresh_path(spark, "model"), fresh_path(spark, "samples")
    samples = cut_lineage(SM.with_split(SM.training_set(pairs, negatives)), held)
    donors, receivers = (pairs.select(F.col(c).alias("id")).distinct() for c in ("donor_id", "receiver_id"))
    history = TR.train(samples.filter("split = 'train'"), samples.filter("split = 'val'"), donors, receivers, path, _SMALL)
    remove(spark, held)
    return history, path


@query("train_blocks")
def _(spark, sf):
    return _trained(spark, sf)[0]


@query("train_and_recommend")
def _(spark, sf):
    donors, receivers = TR.load_vectors(spark, _trained(spark, sf)[1])
    return RC.top_k(donors, receivers, 10)


@query("train_invariants", f"""WITH {PAIRS_SQL} SELECT 'epochs' AS item, CAST({_SMALL.epochs} AS BIGINT) AS n, true AS holds UNION ALL SELECT 'donors', count(*), true FROM d_ids
    UNION ALL SELECT 'receivers', count(*), true FROM r_ids UNION ALL SELECT 'ranked', (SELECT count(*) FROM d_ids) * least(10, count(*)), true FROM r_ids""")
def _(spark, sf):
    """What must hold of any training: falling loss, one finite vector per id and side, full ranked lists of known receivers."""
    history, path = _trained(spark, sf)
    donors, receivers = TR.load_vectors(spark, path)
    finite = F.forall("vec", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("vec") == _SMALL.dim)
    sides = [v.agg(F.lit(name).alias("item"), F.countDistinct("id").alias("n"), (F.bool_and(finite) & (F.count(F.lit(1)) == F.countDistinct("id"))).alias("holds"))
             for name, v in (("donors", donors), ("receivers", receivers))]
    top = RC.top_k(donors, receivers, 10)
    ranked = top.join(receivers.select("id", F.lit(True).alias("known")), "id", "left").agg(
        F.lit("ranked").alias("item"), F.countDistinct("query_id", "rank").alias("n"),
        (F.bool_and(F.coalesce("known", F.lit(False))) & (F.countDistinct("query_id", "id") == F.count(F.lit(1)))).alias("holds"))
    epochs = history.agg(F.lit("epochs").alias("item"), F.countDistinct("epoch").alias("n"),
                         (F.bool_and(F.col("val_loss") < float(np.log(2))) & (F.max_by("train_loss", "epoch") < F.min_by("train_loss", "epoch"))).alias("holds"))
    return R.union_all(epochs, *sides, ranked)


# --- extraction and compile jobs -----------------------------------------------------------------

_BASE_SQL = FD.BASE_SQL.format(orders="orders", customer="customer")
_DOC_SQL = f"""base AS ({_BASE_SQL}), lines AS ({FD.sql_lines()}),
    latest AS (SELECT * FROM base WHERE form <> '990T' QUALIFY row_number() OVER (PARTITION BY ein, tax_yr, form ORDER BY filing_number DESC) = 1)"""


def _docs(spark, sf, only=None):
    return FD.filing_documents(*load(spark, sf, "orders", "customer", "lineitem"), only)


def _extracted(spark, sf, *names):
    """Extracted and cast tables of the named datasets, written once."""
    wanted = [(spec, schema) for spec, schema in J.EXTRACTED if spec.name in ("filing_details", *names)]
    rows = cut_lineage(E.extract(_docs(spark, sf), [spec for spec, _ in wanted]))
    return {spec.name: E.dataset(rows, spec, schema) for spec, schema in wanted}


def _expected(name: str, column: str, kind: str = "VARCHAR") -> str:
    values = FD.FILING_VALUES.get(name) or FD.LINE_VALUES[name]
    return f"TRY_CAST({values[column]} AS {kind})" if column in values else f"CAST(NULL AS {kind})"


@query("extract_roundtrip", f"""SELECT CAST(filing_number AS VARCHAR) AS filing_number, CAST(ein AS VARCHAR) AS ein, CAST(tax_yr AS VARCHAR) AS tax_yr, form,
    {_expected('filing_details', 'BusinessNameLine1Txt')} AS name, {_expected('filing_details', 'AddressLine1Txt')} AS address,
    {_expected('filing_details', 'ZIPCd')} AS zip FROM ({_BASE_SQL}) WHERE form <> '990T'""")
def _(spark, sf):
    rows = E.extract_contents(FD.zipped(_docs(spark, sf)), SPECS[:1])
    return E.dataset(rows, SPECS[0]).select("filing_number", "ein", "tax_yr", "form", F.col("BusinessNameLine1Txt").alias("name"),
                                            F.col("AddressLine1Txt").alias("address"), F.col("ZIPCd").alias("zip"))


_HEADER_SPEC = Spec("header", dict.fromkeys(("990", "990PF", "990EZ", "990T"), "ReturnHeader"),
                    {"year": dict.fromkeys(("990", "990PF", "990EZ", "990T"), "TaxYr")})


@query("extract_specs", FD.expected_sql() + " UNION ALL SELECT 'header', filing_number, 'year', CAST(tax_yr AS VARCHAR) FROM base")
def _(spark, sf):
    rows = E.extract(_docs(spark, sf), [*SPECS, _HEADER_SPEC])
    return (rows.select("dataset", F.col("filing_number").cast("bigint").alias("filing_number"), F.explode("fields").alias("field", "value"))
            .filter("value IS NOT NULL"))


def _amount(name: str, column: str) -> str:
    return f"coalesce({_expected(name, column, 'DOUBLE')}, 0) AS {column}"


_FORM_ONLY = "CASE WHEN form = '990' THEN {} ELSE 0 END"


@query("compile_orgs_flow", f"""WITH {_DOC_SQL} SELECT filing_number, zip_name, ein, tax_yr, form, c_name AS foundation_name,
    {_expected('filing_details', 'AddressLine1Txt')} AS foundation_address, c_mktsegment AS foundation_city,
    lpad(substr(CAST(ein * 37 AS VARCHAR), 1, 5), 5, '0') AS foundation_zip,
    CASE WHEN form <> '990PF' THEN {FD.FILING_VALUES['exemption_and_service_description']['PrimaryExemptPurposeTxt']} END AS organization_mission_pt1_990_only,
    CASE WHEN form <> '990PF' THEN {FD.FILING_VALUES['exemption_and_service_description']['DescriptionProgramSrvcAccomTxt']} END AS organization_mission_pt2_990_only,
    {_amount('contributions_grants_assets', 'contribution_amt')}, {_amount('contributions_grants_assets', 'grant_amt')}, {_amount('contributions_grants_assets', 'managed_assets_at_eoy')},
    CASE WHEN form = '990' THEN {_amount('donor_advised_fund_details', 'daf_contribution_amt').replace(' AS daf_contribution_amt', '')} ELSE 0 END AS daf_contribution_amt,
    CAST(0 AS DOUBLE) AS daf_grant_amt, CAST(0 AS DOUBLE) AS daf_managed_assets_at_eoy,
    CASE WHEN form = '990' THEN {_amount('donor_advised_fund_details', 'daf_count_at_eoy').replace(' AS daf_count_at_eoy', '')} ELSE 0 END AS daf_count_at_eoy FROM latest""")
def _(spark, sf):
    t = _extracted(spark, sf, "contributions_grants_assets", "donor_advised_fund_details", "exemption_and_service_description")
    return J.compile_organizations(*t.values())


@query("compile_grants_job", f"""WITH {_DOC_SQL} SELECT filing_number, zip_name, ein, tax_yr, form, CASE WHEN form = '990' THEN l_suppkey END AS recipient_ein,
    coalesce({_expected('grant_details', 'BusinessNameLine1Txt')}, {_expected('grant_details', 'RecipientPersonNm')}) AS recipient_name, CAST(NULL AS VARCHAR) AS recipient_address,
    {_expected('grant_details', 'CityNm')} AS recipient_city, 'ny' AS recipient_state, lpad(substr(CAST(l_partkey AS VARCHAR), 1, 5), 5, '0') AS recipient_zip,
    l_returnflag AS grant_purpose, {_expected('grant_details', 'CashGrantAmt', 'DOUBLE')} AS grant_amt
    FROM lines SEMI JOIN latest USING (filing_number) WHERE form IN ('990', '990PF')""")
def _(spark, sf):
    t = _extracted(spark, sf, "grant_details")
    return J.compile_grants(t["grant_details"], dedupe.latest_filings(t["filing_details"]))


@query("compile_contractors_flow", f"""WITH {_DOC_SQL} SELECT filing_number, zip_name, ein, tax_yr, form,
    coalesce({_expected('independent_contractor_details', 'BusinessNameLine1Txt')}, {_expected('independent_contractor_details', 'PersonNm')}) AS contractor_name,
    CAST(NULL AS VARCHAR) AS contractor_address, CAST(NULL AS VARCHAR) AS contractor_city, CAST(NULL AS VARCHAR) AS contractor_state,
    lpad(substr(CAST(l_suppkey AS VARCHAR), 1, 5), 5, '0') AS contractor_zip, l_returnflag AS service_description,
    {_expected('independent_contractor_details', 'CompensationAmt', 'DOUBLE')} AS compensation_amt FROM lines SEMI JOIN latest USING (filing_number) WHERE form <> '990T'""")
def _(spark, sf):
    t = _extracted(spark, sf, "independent_contractor_details")
    return J.compile_contractors(t["independent_contractor_details"], dedupe.latest_filings(t["filing_details"]))


def _long_sql(name: str, pairs: list[tuple[str, str]]) -> str:
    """Description/expense rows of surviving private-foundation filings, in the twin."""
    parts = [f"""SELECT filing_number, zip_name, ein, tax_yr, form, {d} AS "DescriptionTxt", coalesce({e}, 0) AS "ExpensesAmt" FROM latest WHERE form = '990PF'""" for d, e in pairs]
    phrases = " OR ".join(f"""starts_with(upper(trim("DescriptionTxt")), '{p}')""" for p in R.PLACEHOLDERS)
    return f"""WITH {_DOC_SQL} SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE "DescriptionTxt" IS NOT NULL AND NOT ({phrases})"""


def _numbered_pairs(name: str, n: int) -> list[tuple[str, str]]:
    return [(_expected(name, f"Description{i}Txt"), _expected(name, f"Expenses{i}Amt", "DOUBLE")) for i in range(1, n + 1)]


_OTHER = _expected("program_related_investments", "AllOtherProgramRltdInvstTotAmt", "DOUBLE")


@query("compile_investments_flow", _long_sql("program_related_investments", [
    *_numbered_pairs("program_related_investments", 2), (f"CASE WHEN coalesce({_OTHER}, 0) <> 0 THEN '{reshape.OTHER_INVESTMENTS}' END", _OTHER)]))
def _(spark, sf):
    t = _extracted(spark, sf, "program_related_investments")
    return J.compile_investments(t["program_related_investments"], dedupe.latest_filings(t["filing_details"]))


@query("compile_activities_flow", _long_sql("direct_charitable_activity_details", _numbered_pairs("direct_charitable_activity_details", 4)))
def _(spark, sf):
    t = _extracted(spark, sf, "direct_charitable_activity_details")
    return J.compile_activities(t["direct_charitable_activity_details"], dedupe.latest_filings(t["filing_details"]))


_COMPILED = {
    "organization_details_compiled": ("compile_orgs_flow", ["foundation_name", "foundation_address", "foundation_city", "foundation_zip",
                                      "organization_mission_pt1_990_only", "organization_mission_pt2_990_only"],
                                      ["contribution_amt", "grant_amt", "managed_assets_at_eoy", "daf_contribution_amt", "daf_grant_amt",
                                       "daf_managed_assets_at_eoy", "daf_count_at_eoy"]),
    "grant_details_compiled": ("compile_grants_job", ["recipient_ein", "recipient_name", "recipient_address", "recipient_city",
                               "recipient_state", "recipient_zip", "grant_purpose"], ["grant_amt"]),
    "independent_contractor_details_compiled": ("compile_contractors_flow", ["contractor_name", "contractor_address", "contractor_city",
                                                "contractor_state", "contractor_zip", "service_description"], ["compensation_amt"]),
    "program_related_investments_compiled": ("compile_investments_flow", ["DescriptionTxt"], ["ExpensesAmt"]),
    "direct_charitable_activity_details_compiled": ("compile_activities_flow", ["DescriptionTxt"], ["ExpensesAmt"]),
}


def _row_text(texts: list[str], amounts: list[str]) -> str:
    """A whole compiled row as one text, the same expression in both engines."""
    shown = [f"CAST({c} AS STRING)" for c in [*S.FILING_KEY, *texts]] + [f"CAST(CAST({c} AS DECIMAL(24, 2)) AS STRING)" for c in amounts]
    return "concat_ws('|', " + ", ".join(f"coalesce({c}, '~')" for c in shown) + ")"


def _run_compile_sql(bad: bool = True) -> str:
    parts = [f"SELECT '{name}' AS dataset, {_row_text(texts, amounts)} AS content FROM ({ORACLES[flow]}) AS t"
             for name, (flow, texts, amounts) in _COMPILED.items()]
    return " UNION ALL ".join([*parts, *(["SELECT 'quarantined', 'broken.zip'"] if bad else [])])


@query("run_compile_flow", _run_compile_sql())
def _(spark, sf):
    """The jobs from archive files to compiled tables: all nine datasets, one broken archive, every compiled row whole."""
    path = fresh_path(spark, "jobs")
    FD.write_archives(_docs(spark, sf), f"{path}/landing")
    files.write_path(f"{path}/landing/broken.zip", b"no archive")
    J.run_extract(spark, f"{path}/landing", f"{path}/extracted")
    remove(spark, f"{path}/landing")
    J.run_compile(spark, f"{path}/extracted", f"{path}/compiled")
    remove(spark, f"{path}/extracted")
    parts = [tables.read_table(spark, f"{path}/compiled/{name}").select(F.lit(name).alias("dataset"), F.expr(_row_text(texts, amounts)).alias("content"))
             for name, (_, texts, amounts) in _COMPILED.items()]
    bad = tables.read_table(spark, f"{path}/compiled/quarantined").select(F.lit("quarantined").alias("dataset"), F.col("zip_name").alias("content"))
    return R.union_all(*parts, bad)


def _fields_of(rows: DataFrame, spec: Spec) -> DataFrame:
    """The filled fields of one dataset, read from its own folders and columns alone."""
    shown = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in spec.fields]))
    return (rows.filter(F.col("dataset") == spec.name).select("dataset", F.col("filing_number").cast("bigint").alias("filing_number"), shown.alias("x"))
            .select("dataset", "filing_number", "x.field", "x.value").filter("value IS NOT NULL"))


@query("run_extract_flow", FD.expected_sql())
def _(spark, sf):
    """Archives land in two lots, the second run takes only the new ones, a third is forced: no row is lost or doubled."""
    path, second = fresh_path(spark, "jobs"), F.col("zip_name").like("batch_F%")
    FD.write_archives(_docs(spark, sf, ~second), f"{path}/landing")
    J.run_extract(spark, f"{path}/landing", f"{path}/extracted")
    FD.write_archives(_docs(spark, sf, second), f"{path}/landing")
    added = J.run_extract(spark, f"{path}/landing", f"{path}/extracted")
    if not added.filter("name NOT LIKE 'batch_F%'").isEmpty():
        raise AssertionError("an archive was extracted twice without being asked for")
    J.run_extract(spark, f"{path}/landing", f"{path}/extracted", force=True)
    remove(spark, f"{path}/landing")
    rows = J.read_extracted(spark, f"{path}/extracted")
    return R.union_all(*[_fields_of(rows, spec) for spec in SPECS])


@query("job_bad_keys", f"SELECT filing_number, CASE WHEN ein % 3 = 0 THEN 'bad_key' ELSE 'kept' END AS fate FROM ({_BASE_SQL}) WHERE form <> '990T'")
def _(spark, sf):
    """A third of the filings has an identifier that is no number; none of them is lost or merged."""
    spec, schema = J.EXTRACTED[0]
    rows = E.extract(_docs(spark, sf), [spec]).withColumn("ein", F.expr("CASE WHEN ein % 3 = 0 THEN concat('E', ein) ELSE ein END"))
    rows = cut_lineage(rows)
    kept = E.dataset(rows, spec, schema).select("filing_number", F.lit("kept").alias("fate"))
    bad = E.bad_keys(rows, spec, schema).select(F.regexp_extract("member", r"^(\d+)_", 1).cast("long").alias("filing_number"),
                                                F.regexp_extract("error", "^([a-z_]+)", 1).alias("fate"))
    return kept.unionByName(bad)


@query("archive_source", f"""SELECT CAST(filing_number AS VARCHAR) AS filing_number, CAST(ein AS VARCHAR) AS ein, form,
    {_expected('filing_details', 'BusinessNameLine1Txt')} AS name FROM ({_BASE_SQL}) WHERE form <> '990T'""")
def _(spark, sf):
    """The archives' documents through the data source, in partitions smaller than an archive."""
    path = fresh_path(spark, "archives")
    FD.write_archives(_docs(spark, sf), path)
    zipsource.register(spark)
    docs = spark.read.format(zipsource.FORMAT).option("partitionBytes", 64 << 10).load(path)
    return E.dataset(E.extract(docs, SPECS[:1]), SPECS[0]).select("filing_number", "ein", "form", F.col("BusinessNameLine1Txt").alias("name"))


@query("commit_flow", FD.expected_sql(SPECS[:1]))
def _(spark, sf):
    """A batch run takes a part, the next one dies between write and commit, a stream takes the rest, a last run nothing: every archive counts once."""
    path, second = fresh_path(spark, "jobs"), F.col("zip_name").like("batch_F%")
    FD.write_archives(_docs(spark, sf, ~second), f"{path}/landing")
    J.run_extract(spark, f"{path}/landing", f"{path}/out", SPECS[:1])
    FD.write_archives(_docs(spark, sf, second), f"{path}/landing")
    # What a run that dies leaves behind: rows without a manifest entry.
    tables.write_extracted(archives.extract_archives(archives.zip_listing(spark, f"{path}/landing"), SPECS[:1]), f"{path}/out/rows", "batch-dead", list(SPECS[0].fields))
    ingest.ingest_archives(spark, f"{path}/landing", f"{path}/out", f"{path}/checkpoint", SPECS[:1]).awaitTermination()
    if not J.run_extract(spark, f"{path}/landing", f"{path}/out", SPECS[:1]).isEmpty():
        raise AssertionError("an archive was extracted twice without being asked for")
    remove(spark, f"{path}/landing")
    return _fields_of(J.read_extracted(spark, f"{path}/out"), SPECS[0])


def _landed(spark, sf) -> str:
    path = fresh_path(spark, "jobs")
    FD.write_archives(_docs(spark, sf), f"{path}/landing")
    J.run_extract(spark, f"{path}/landing", f"{path}/extracted")
    remove(spark, f"{path}/landing")
    return path


@query("compile_csv_flow", _run_compile_sql(bad=False))
def _(spark, sf):
    """Extracted datasets as one CSV file per archive, and all five tables compiled from these files."""
    path = _landed(spark, sf)
    J.export_extracted(spark, f"{path}/extracted", f"{path}/csv")
    remove(spark, f"{path}/extracted")
    J.run_compile(spark, f"{path}/csv", f"{path}/compiled", form="csv")
    remove(spark, f"{path}/csv")
    return R.union_all(*[tables.read_table(spark, f"{path}/compiled/{name}").select(F.lit(name).alias("dataset"), F.expr(_row_text(texts, amounts)).alias("content"))
                         for name, (_, texts, amounts) in _COMPILED.items()])


@query("job_counts", " UNION ALL ".join([f"SELECT 'compile' AS job, '{name}' AS dataset, count(*) AS rows FROM ({ORACLES[flow]})" for name, (flow, _, _) in _COMPILED.items()]
                                        + ["SELECT 'compile', 'quarantined', 0", f"SELECT 'extract', 'archives', count(DISTINCT zip_name) FROM ({_BASE_SQL})"]))
def _(spark, sf):
    """The row counts that the jobs themselves report, counted while they write."""
    path = _landed(spark, sf)
    J.run_compile(spark, f"{path}/extracted", f"{path}/compiled")
    remove(spark, f"{path}/extracted/rows")
    extract = tables.last_report(spark, f"{path}/extracted/report").filter("dataset = 'archives'")
    return tables.last_report(spark, f"{path}/compiled/report").unionByName(extract)


# --- sources and sinks ------------------------------------------------------------------------------

@query("csv_roundtrip", """SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'none' ELSE c_mktsegment || ', "x"' || chr(10) || 'y' END AS note,
    CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal FROM customer""")
def _(spark, sf):
    """Two folders of files with different column orders, missing-value tokens, quotes and line breaks."""
    path = fresh_path(spark, "csv")
    note = "CASE c_custkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN 'none' ELSE concat(c_mktsegment, ', \"x\"\\ny') END AS note"
    wide = load(spark, sf, "customer").selectExpr("c_custkey", "c_name", note, "CASE WHEN c_custkey % 3 = 0 THEN 'NaN' ELSE c_acctbal END AS c_acctbal")
    csvfiles.write_csv(wide.filter("c_custkey % 2 = 0"), f"{path}/a")
    csvfiles.write_csv(wide.filter("c_custkey % 2 = 1").select("c_acctbal", "note", "c_name", "c_custkey"), f"{path}/b")
    schema = T.StructType([T.StructField("c_custkey", S.LONG), T.StructField("c_name", S.STR), T.StructField("note", S.STR), T.StructField("c_acctbal", S.DBL)])
    return csvfiles.read_csv(spark, f"{path}/*", schema, required=("c_custkey",))[0]


@query("csv_blank_first_line", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf):
    """Files of a thousand customers each, with blank lines above the header."""
    path = fresh_path(spark, "csv")

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        n = pdf["part"].iloc[0]
        files.write_path(f"{path}/{n}.csv", ("\n" * (n % 3) + pdf[["c_custkey", "c_name"]].to_csv(index=False)).encode())
        return pd.DataFrame({"n": [len(pdf)]})

    rows = load(spark, sf, "customer").selectExpr("CAST(floor(c_custkey / 1000) AS BIGINT) AS part", "c_custkey", "c_name")
    rows.groupBy("part").applyInPandas(put, "n long").agg(F.sum("n")).collect()
    return csvfiles.read_csv(spark, path, T.StructType([T.StructField("c_custkey", S.LONG), T.StructField("c_name", S.STR)]), required=("c_custkey",))[0]


@query("registry_scan", """SELECT st AS "STATE", k, max_by(p_partkey, p_partkey) AS ein FROM (SELECT p_partkey, left(p_type, 2) AS st, p_name || '|' || p_brand AS k FROM part) GROUP BY ALL""")
def _(spark, sf):
    """Regional registry files with an extra column; later files win."""
    path = fresh_path(spark, "registry")
    rows = load(spark, sf, "part").selectExpr("p_partkey AS EIN", "p_name AS NAME", "p_size AS ICO", "p_brand AS CITY", "left(p_type, 2) AS STATE", "'01234' AS ZIP")
    csvfiles.write_csv(rows.repartitionByRange(4, "EIN").sortWithinPartitions("EIN"), f"{path}/1")
    registry, _ = csvfiles.read_registry(spark, f"{path}/*")
    keyed = registry.filter("ZIP = '01234'").select("STATE", X.lookup_key(F.col("NAME"), F.col("CITY")).alias("k"), F.col("EIN").alias("ein"), "ord")
    return M.last_wins(keyed, ["STATE", "k"]).drop("ord")


@query("parquet_roundtrip", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    path = fresh_path(spark, "orders")
    tables.write_table(load(spark, sf, "orders"), path, ["o_orderstatus"])
    return tables.read_table(spark, path, ["o_orderkey", "o_totalprice", "o_orderstatus"]).filter("o_orderstatus = 'F'")


@query("inventory", """SELECT 'o_' || (o_orderkey // 2000) || '.txt' AS name, CAST(sum(length(o_comment_) + 1) AS BIGINT) AS size_bytes,
    round(sum(length(o_comment_) + 1) / 1048576.0, 2) AS size_mb, true AS valid
    FROM (SELECT o_orderkey, o_orderkey || '|' || o_orderpriority || '|' || o_orderstatus AS o_comment_ FROM orders) GROUP BY 1
    UNION ALL SELECT 'empty.txt', 0, 0.0, false""")
def _(spark, sf):
    """Files of known sizes, written from the orders, and an empty one, which is listed and not valid."""
    path = fresh_path(spark, "files")
    lines = load(spark, sf, "orders").select(
        F.concat(F.lit("o_"), F.floor(F.col("o_orderkey") / 2000).cast("string"), F.lit(".txt")).alias("name"),
        F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority", "o_orderstatus").alias("line"))

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        files.write_path(f"{path}/{pdf['name'].iloc[0]}", "".join(f"{x}\n" for x in pdf["line"]).encode())
        return pd.DataFrame({"lines": [len(pdf)]})

    lines.groupBy("name").applyInPandas(put, "lines long").agg(F.sum("lines")).collect()
    files.write_path(f"{path}/empty.txt", b"")
    return files.inventory(spark, path).select("name", "size_bytes", "size_mb", "valid")


@query("incremental_batch", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, sf):
    orders = load(spark, sf, "orders").withColumn("name", F.concat(F.lit("archive-"), F.col("o_orderkey").cast("string")))
    manifest = incremental.committed(orders.filter("o_orderstatus = 'F'"))
    return incremental.pending(orders, manifest).select("o_orderkey", "o_totalprice")


@query("incremental_stream", "SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(24,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1")
def _(spark, sf):
    """Line items landed as files are taken in once, although the stream runs twice."""
    landing, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "out", "stream"))
    lines = load(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    lines.write.parquet(landing)
    for _ in range(2):
        stream = spark.readStream.schema(lines.schema).parquet(landing)
        ingest.run_available(stream, ingest.batch_writer(out), checkpoint).awaitTermination()
    taken = spark.read.schema(lines.schema).parquet(f"{out}/*")
    return taken.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(24,2)")).cast("double").alias("total"))


@query("page_links", """SELECT page_id, CAST(i - 1 AS INT) AS pos, h[i] AS href, regexp_extract(url, '^(https?://[^/]*)', 1) || h[i] AS full_url,
    CASE WHEN h[i] LIKE '%.zip' THEN 'zip' WHEN h[i] LIKE '%.csv' THEN 'csv' ELSE 'other' END AS kind
    FROM (SELECT page_id, url, h, unnest(range(1, len(h) + 1)) AS i FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\s+href="([^"]*)"', 1) AS h FROM pages))""")
def _(spark, sf):
    return links.page_links(load(spark, sf, "pages"))


@query("url_names", r"SELECT page_id, regexp_extract(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '([^/]*)$', 1) AS name FROM pages")
def _(spark, sf):
    return load(spark, sf, "pages").select("page_id", X.url_file_name(F.col("url")).alias("name"))
