"""Declared schemas of the extracted, compiled and recommender tables."""

from __future__ import annotations

from pyspark.sql import types as T

FILING_KEY = ["filing_number", "zip_name", "ein", "tax_yr", "form"]
FILING_ID = ["filing_number", "ein", "tax_yr", "form"]

LONG, STR, DBL = T.LongType(), T.StringType(), T.DoubleType()

_KEY_FIELDS = [("filing_number", LONG), ("zip_name", STR), ("ein", LONG), ("tax_yr", LONG), ("form", STR)]


def table(*columns: tuple[str, T.DataType], key: bool = True) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in (_KEY_FIELDS if key else []) + list(columns)])


def _all(kind: T.DataType, *names: str) -> list[tuple[str, T.DataType]]:
    return [(n, kind) for n in names]


FILING_DETAILS = table(*_all(STR, "BusinessNameLine1Txt", "AddressLine1Txt", "CityNm", "ZIPCd"))
FINANCES = table(*_all(DBL, "contribution_amt", "grant_amt", "managed_assets_at_eoy"))
DONOR_ADVISED = table(
    *_all(DBL, "daf_contribution_amt", "daf_grant_amt", "daf_managed_assets_at_eoy", "daf_count_at_eoy")
)
MISSIONS = table(*_all(STR, "PrimaryExemptPurposeTxt", "DescriptionProgramSrvcAccomTxt"))
GRANTS = table(
    *_all(STR, "BusinessNameLine1Txt", "BusinessNameLine2Txt", "RecipientPersonNm"),
    ("RecipientEIN", LONG),
    *_all(STR, "AddressLine1Txt", "CityNm", "StateAbbreviationCd", "ZIPCd", "GrantOrContributionPurposeTxt"),
    ("CashGrantAmt", DBL),
)
CONTRACTORS = table(
    *_all(STR, "PersonNm", "BusinessNameLine1Txt", "AddressLine1Txt", "CityNm", "StateAbbreviationCd", "ZIPCd"),
    ("ServicesDesc", STR),
    ("CompensationAmt", DBL),
)
INVESTMENTS = table(
    ("Description1Txt", STR),
    ("Expenses1Amt", DBL),
    ("Description2Txt", STR),
    ("Expenses2Amt", DBL),
    ("AllOtherProgramRelatedInvestmentsSchedule", STR),
    ("AllOtherProgramRltdInvstTotAmt", DBL),
    ("TotalAmt", DBL),
)
ACTIVITIES = table(*[(f"{stem}{i}{tail}", STR) for i in (1, 2, 3, 4)
                     for stem, tail in (("Description", "Txt"), ("Expenses", "Amt"))])
REGISTRY = table(("EIN", LONG), *_all(STR, "NAME", "CITY", "STATE", "ZIP"), key=False)

# The tokens a CSV reader treats as missing, in any column.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
