"""Dataset jobs: lazy plans over extracted tables, and runners that write them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from almsflow import schemas as S
from almsflow.functions.columns import first_present, select_renamed
from almsflow.functions.text import zip5
from almsflow.operators import dedupe, match, relational as R, reshape
from almsflow.operators.aggregates import counted, grant_edges, match_breakdown, match_rate
from almsflow.operators.ids import dense_ids, with_ids
from almsflow.operators.recommend import recommend
from almsflow.operators.sampling import negative_samples, training_set, with_split
from almsflow.operators.train import Settings, load_vectors, train
from almsflow.plans import specs
from almsflow.runtime import cut_lineage, fresh_path, remove
from almsflow.sources.archives import extract_archives, zip_listing
from almsflow.sources.csvfiles import read_csv, read_registry
from almsflow.sources.files import file_name
from almsflow.sources.incremental import committed, pending
from almsflow.sources.tables import (add_to_report, export_files, load_ids, read_or_empty, read_table, save_ids, write_counted, write_extracted,
                                     write_table)

_AMOUNTS = ["contribution_amt", "grant_amt", "managed_assets_at_eoy", "daf_contribution_amt", "daf_grant_amt",
            "daf_managed_assets_at_eoy", "daf_count_at_eoy"]


def _keyed(names: Mapping[str, str]) -> dict[str, str]:
    return {k: k for k in S.FILING_KEY} | dict(names)


def compile_organizations(filings: DataFrame, finances: DataFrame, donor_advised: DataFrame,
                          missions: DataFrame) -> DataFrame:
    """One row per organisation, year and form: its latest filing with mission texts and amounts.

    Amounts and texts are deduplicated per filing but joined with the archive
    name, so a filing landed in two archives can miss its amounts and read 0.
    """
    base = select_renamed(dedupe.latest_filings(filings), _keyed({
        "BusinessNameLine1Txt": "foundation_name", "AddressLine1Txt": "foundation_address",
        "CityNm": "foundation_city", "ZIPCd": "foundation_zip",
    })).withColumn("foundation_zip", zip5(F.col("foundation_zip")))
    texts = select_renamed(dedupe.greatest_text(missions, "PrimaryExemptPurposeTxt"), _keyed({
        "PrimaryExemptPurposeTxt": "organization_mission_pt1_990_only",
        "DescriptionProgramSrvcAccomTxt": "organization_mission_pt2_990_only",
    }))
    amounts = dedupe.largest_amounts(finances, "managed_assets_at_eoy")
    funds = dedupe.largest_amounts(donor_advised, "daf_managed_assets_at_eoy")
    return R.left_chain(base, [texts, amounts, funds]).fillna(0, subset=_AMOUNTS)


def compile_grants(grants: DataFrame, organizations: DataFrame) -> DataFrame:
    """Grants of surviving filings; the recipient is the business name, else the person."""
    rows = select_renamed(
        grants.withColumn("RecipientNm", first_present(F.col("BusinessNameLine1Txt"), F.col("RecipientPersonNm"))),
        _keyed({"RecipientEIN": "recipient_ein", "RecipientNm": "recipient_name", "AddressLine1Txt": "recipient_address",
                "CityNm": "recipient_city", "StateAbbreviationCd": "recipient_state", "ZIPCd": "recipient_zip",
                "GrantOrContributionPurposeTxt": "grant_purpose", "CashGrantAmt": "grant_amt"}))
    return R.of_survivors(rows.withColumn("recipient_zip", zip5(F.col("recipient_zip"))), organizations)


def compile_contractors(contractors: DataFrame, organizations: DataFrame) -> DataFrame:
    """Contractors of surviving filings; the name is the business, else the person."""
    rows = select_renamed(
        contractors.withColumn("EntityNm", first_present(F.col("BusinessNameLine1Txt"), F.col("PersonNm"))),
        _keyed({"EntityNm": "contractor_name", "AddressLine1Txt": "contractor_address", "CityNm": "contractor_city",
                "StateAbbreviationCd": "contractor_state", "ZIPCd": "contractor_zip",
                "ServicesDesc": "service_description", "CompensationAmt": "compensation_amt"}))
    return R.of_survivors(rows.withColumn("contractor_zip", zip5(F.col("contractor_zip"))), organizations)


def _numbered(stem: str, tail: str, n: int) -> list[str]:
    return [f"{stem}{i}{tail}" for i in range(1, n + 1)]


def compile_investments(investments: DataFrame, organizations: DataFrame, pairing: str = "row") -> DataFrame:
    """Programme-related investments in long form, with the 'all other' total as a third pair."""
    kept = R.of_survivors(reshape.add_other_pair(investments), organizations)
    return reshape.pair_to_rows(kept, S.FILING_KEY, _numbered("Description", "Txt", 3),
                                _numbered("Expenses", "Amt", 3), pairing)


def compile_activities(activities: DataFrame, organizations: DataFrame, pairing: str = "row") -> DataFrame:
    """Direct charitable activities in long form."""
    kept = R.of_survivors(activities, organizations)
    return reshape.pair_to_rows(kept, S.FILING_KEY, _numbered("Description", "Txt", 4),
                                _numbered("Expenses", "Amt", 4), pairing)


# Datasets that get compiled, with the schema their extracted rows are cast to.
EXTRACTED = (
    (specs.filing_details, S.FILING_DETAILS),
    (specs.contributions_grants_assets, S.FINANCES),
    (specs.donor_advised_fund_details, S.DONOR_ADVISED),
    (specs.exemption_and_service_description, S.MISSIONS),
    (specs.grant_details, S.GRANTS),
    (specs.independent_contractor_details, S.CONTRACTORS),
    (specs.program_related_investments, S.INVESTMENTS),
    (specs.direct_charitable_activity_details, S.ACTIVITIES),
)


def compile_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All five compiled datasets from extracted tables keyed by dataset name."""
    organizations = compile_organizations(
        tables["filing_details"], tables["contributions_grants_assets"], tables["donor_advised_fund_details"],
        tables["exemption_and_service_description"])
    return {
        "organization_details_compiled": organizations,
        "grant_details_compiled": compile_grants(tables["grant_details"], organizations),
        "independent_contractor_details_compiled": compile_contractors(tables["independent_contractor_details"], organizations),
        "program_related_investments_compiled": compile_investments(tables["program_related_investments"], organizations),
        "direct_charitable_activity_details_compiled": compile_activities(tables["direct_charitable_activity_details"], organizations),
    }


MANIFEST = "name string, length long, modificationTime timestamp, run string, committed_at timestamp"


def land_archives(listed: DataFrame, output: str, run: str, dataset_specs: Sequence[specs.Spec] = specs.SPECS, force: bool = False) -> DataFrame:
    """Extract listed archives (path, length, modificationTime) and commit them as transaction ``run``; the one
    way, for batch jobs and streams alike, in which archives become rows that readers see.

    Archives the manifest already has, by name, size and time, are left out unless ``force``. Rows land in the
    folder of the run and count only once its manifest file names the archives, which is written last: a run
    that died leaves nothing behind that a reader sees, and one that is repeated under its name replaces what it left.
    Returns the manifest rows of this run.
    """
    spark = listed.sparkSession
    # A repeated transaction is no reason to leave its own archives out.
    known = read_or_empty(spark, f"{output}/manifest", MANIFEST).filter(F.col("run") != run)
    named = listed.select("path", "length", "modificationTime").withColumn("name", file_name())
    # Written, so that what is extracted is what gets committed, whatever lands meanwhile.
    todo = cut_lineage(pending(named, known, ["name", "length", "modificationTime"], force))
    names = list(dict.fromkeys(f for s in dataset_specs for f in s.fields))
    rows, seen = counted(extract_archives(todo, dataset_specs, wide=True), f"extract_{run}")
    write_extracted(rows, f"{output}/rows", run, names)
    add_to_report(spark, f"{output}/report", "extract", {"rows": int(seen.get.get("rows", 0)), "archives": todo.count()})
    commit_run(todo, output, run)
    return spark.read.schema(MANIFEST).parquet(f"{output}/manifest").filter(F.col("run") == run)


def commit_run(todo: DataFrame, output: str, run: str) -> None:
    """The moment from which the rows of a run count."""
    done = committed(todo, "name", "length", "modificationTime").select("name", "length", "modificationTime", "committed_at")
    done.coalesce(1).write.mode("overwrite").parquet(f"{output}/manifest/run={run}")


def run_extract(spark: SparkSession, landing: str, output: str, dataset_specs: Sequence[specs.Spec] = specs.SPECS,
                force: bool = False, store_all: bool = False) -> DataFrame:
    """Extract the archives of a folder that are new or have changed; with ``force`` all of them.

    ``store_all`` keeps records without any wanted element. Returns the manifest rows of this run.
    """
    if store_all:
        dataset_specs = [replace(s, keep_empty=True) for s in dataset_specs]
    return land_archives(zip_listing(spark, landing), output, f"batch-{uuid.uuid4().hex}", dataset_specs, force)


def read_extracted(spark: SparkSession, output: str) -> DataFrame:
    """Extracted rows; of an archive extracted more than once, those of its latest run."""
    latest = (read_or_empty(spark, f"{output}/manifest", MANIFEST)
              .groupBy(F.col("name").alias("zip_name")).agg(F.max_by("run", F.struct("committed_at", "run")).alias("run")))
    rows = spark.read.option("mergeSchema", True).parquet(f"{output}/rows")
    return rows.join(latest, ["zip_name", "run"], "left_semi")


def export_extracted(spark: SparkSession, output: str, path: str, form: str = "csv") -> DataFrame:
    """Every extracted dataset as one file per archive; returns (dataset, zip_name, file, rows)."""
    return export_files(read_extracted(spark, output), path, {spec.name: [*S.FILING_KEY, *spec.fields] for spec in specs.SPECS}, form)


def read_exported(spark: SparkSession, path: str, keep: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The compiled datasets' tables from a folder of CSV files per archive, and the records that do not fit; both from a copy below ``keep``."""
    found = {spec.name: read_csv(spark, path, schema, f"{spec.name}__*.csv", keep=f"{keep}/{spec.name}") for spec, schema in EXTRACTED}
    bad = [rejected.select(F.regexp_extract("file", r"__([^/]*)\.csv$", 1).alias("zip_name"), F.lit(None).cast("string").alias("member"),
                           F.concat(F.lit(f"bad_record: {name} "), "record").alias("error")) for name, (_, rejected) in found.items()]
    return {name: rows for name, (rows, _) in found.items()}, reduce(DataFrame.unionByName, bad)


def run_compile(spark: SparkSession, extracted: str, output: str, form: str = "rows") -> None:
    """Compile all datasets. Organisations are written first and read back, since four datasets need them.

    ``form`` says what ``extracted`` is: the output of :func:`run_extract` (``rows``), or a folder of ``csv`` files per dataset and
    archive. Unreadable documents and rows without a whole filing key go to ``quarantined``, row counts to ``report``.
    """
    from almsflow.operators.extract import bad_keys, dataset, quarantined

    report, parsed = f"{output}/report", fresh_path(spark, "parsed")
    if form == "csv":
        tables, bad = read_exported(spark, extracted, parsed)
    else:
        rows = read_extracted(spark, extracted)
        bad = reduce(DataFrame.unionByName, [quarantined(rows), *(bad_keys(rows, spec, schema) for spec, schema in EXTRACTED)])
        tables = {spec.name: dataset(rows, spec, schema) for spec, schema in EXTRACTED}
    write_counted(bad, f"{output}/quarantined", report, "compile", "quarantined")
    first = f"{output}/organization_details_compiled"
    write_counted(compile_organizations(
        tables["filing_details"], tables["contributions_grants_assets"], tables["donor_advised_fund_details"],
        tables["exemption_and_service_description"]), first, report, "compile", "organization_details_compiled")
    organizations = read_table(spark, first, S.FILING_KEY)
    for name, build, source in [
        ("grant_details_compiled", compile_grants, "grant_details"),
        ("independent_contractor_details_compiled", compile_contractors, "independent_contractor_details"),
        ("program_related_investments_compiled", compile_investments, "program_related_investments"),
        ("direct_charitable_activity_details_compiled", compile_activities, "direct_charitable_activity_details"),
    ]:
        write_counted(build(tables[source], organizations), f"{output}/{name}", report, "compile", name)
    remove(spark, parsed)


def run_infer_recipients(spark: SparkSession, grants_path: str, registry_dir: str, output: str,
                         threshold: float = 85, scorer: match.Scorer = match.indel_score) -> None:
    """Resolve recipients; rejected registry records, the match report and row counts are written next to the output."""
    base, grants = output.rstrip("/"), read_table(spark, grants_path)
    registry, rejected = read_registry(spark, registry_dir)
    write_counted(rejected, f"{base}_rejected", f"{base}_counts", "infer", "rejected")
    write_counted(match.infer_recipients(grants, registry, threshold, scorer), output, f"{base}_counts", "infer", "resolved")
    resolved = read_table(spark, output)
    write_table(match_rate(resolved), f"{base}_rate")
    write_table(match_breakdown(resolved), f"{base}_report")


def run_train(spark: SparkSession, grants_path: str, model_dir: str, settings: Settings = Settings(),
              negative_ratio: int = 5) -> DataFrame:
    """Edges -> ids -> samples -> trained states under ``model_dir``; returns the epoch history."""
    edges = cut_lineage(grant_edges(read_table(spark, grants_path)))
    save_ids(dense_ids(edges, "donor_ein"), dense_ids(edges, "receiver_ein"), model_dir)
    donors, receivers = load_ids(spark, model_dir)
    pairs = cut_lineage(with_ids(edges, donors, receivers).select("donor_id", "receiver_id"))
    negatives = negative_samples(pairs, receivers.count(), negative_ratio, seed=settings.seed)
    samples = cut_lineage(with_split(training_set(pairs, negatives), seed=settings.seed))
    return train(samples.filter("split = 'train'"), samples.filter("split = 'val'"), donors, receivers,
                 f"{model_dir}/vectors", settings)


def run_recommend(spark: SparkSession, model_dir: str, requested: DataFrame, k: int | None = None,
                  for_receivers: bool = False, tag: str = "best") -> DataFrame:
    """Receivers for donors (k = 10), or donors for receivers (k = 20)."""
    ids, vectors = load_ids(spark, model_dir), load_vectors(spark, f"{model_dir}/vectors", tag)
    q, c = (1, 0) if for_receivers else (0, 1)
    return recommend(requested, ids[q], vectors[q], ids[c], vectors[c], k or (20 if for_receivers else 10))
