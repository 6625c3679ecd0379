"""The nine extraction datasets, declared as data.

Element names are fixed values of the filing format. A form left out has no
such element; a dataset left without a subroot for a form yields no rows there.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

NAMESPACE = "http://www.irs.gov/efile"
METADATA = {"ein": "EIN", "tax_yr": "TaxYr", "form": "ReturnTypeCd"}
FORMS = ("990", "990PF", "990EZ")


@dataclass(frozen=True)
class Spec:
    """One dataset: where its records start in each form, and the columns to read.

    ``fields`` maps a column to ``{form: element}``. ``keep_empty`` emits a
    record even when none of its elements exist.
    """

    name: str
    subroots: Mapping[str, str]
    fields: Mapping[str, Mapping[str, str]]
    keep_empty: bool = False


def everywhere(*names: str) -> dict[str, dict[str, str]]:
    """Columns named like their element on every form."""
    return {n: dict.fromkeys(FORMS, n) for n in names}


def only(form: str, **names: str) -> dict[str, dict[str, str]]:
    """Columns that exist on a single form."""
    return {column: {form: element} for column, element in names.items()}


def by_form(pf: str, others: str | None = None, *, f990: str | None = None, ez: str | None = None) -> dict[str, str]:
    return {"990": f990 or others, "990PF": pf, "990EZ": ez or others}


filing_details = Spec(
    "filing_details",
    dict.fromkeys(FORMS, "Filer"),
    everywhere("BusinessNameLine1Txt", "AddressLine1Txt", "CityNm", "ZIPCd"),
)

contributions_grants_assets = Spec(
    "contributions_grants_assets",
    {"990": "IRS990", "990PF": "IRS990PF", "990EZ": "IRS990EZ"},
    {
        "contribution_amt": by_form("ContriRcvdRevAndExpnssAmt", f990="PYContributionsGrantsAmt",
                                    ez="ContributionsGiftsGrantsEtcAmt"),
        "grant_amt": by_form("ContriPaidRevAndExpnssAmt", f990="PYGrantsAndSimilarPaidAmt",
                             ez="GrantsAndSimilarAmountsPaidAmt"),
        "managed_assets_at_eoy": by_form("TotNetAstOrFundBalancesEOYAmt", "NetAssetsOrFundBalancesEOYAmt"),
    },
)

donor_advised_fund_details = Spec(
    "donor_advised_fund_details",
    {"990": "IRS990ScheduleD"},
    only("990", daf_contribution_amt="DonorAdvisedFundsContriAmt", daf_grant_amt="DonorAdvisedFundsGrantsAmt",
         daf_managed_assets_at_eoy="DonorAdvisedFundsVlEOYAmt", daf_count_at_eoy="DonorAdvisedFundsHeldCnt"),
)

exemption_and_service_description = Spec(
    "exemption_and_service_description",
    {"990": "IRS990", "990PF": "IRS990PF", "990EZ": "IRS990EZ"},
    {c: {"990": c, "990EZ": c} for c in ("PrimaryExemptPurposeTxt", "DescriptionProgramSrvcAccomTxt")},
)

grant_details = Spec(
    "grant_details",
    {"990": "RecipientTable", "990PF": "GrantOrContributionPdDurYrGrp"},
    {
        **everywhere("BusinessNameLine1Txt", "BusinessNameLine2Txt", "RecipientPersonNm"),
        "RecipientEIN": {"990": "RecipientEIN", "990EZ": "RecipientEIN"},
        **everywhere("AddressLine1Txt", "CityNm", "StateAbbreviationCd", "ZIPCd"),
        "GrantOrContributionPurposeTxt": by_form("GrantOrContributionPurposeTxt", "PurposeOfGrantTxt"),
        "CashGrantAmt": by_form("Amt", "CashGrantAmt"),
    },
)

independent_contractor_details = Spec(
    "independent_contractor_details",
    by_form("CompensationOfHghstPdCntrctGrp", f990="ContractorCompensationGrp", ez="CompensationOfHghstPdCntrctGrp"),
    {
        **everywhere("PersonNm", "BusinessNameLine1Txt", "AddressLine1Txt", "CityNm", "StateAbbreviationCd", "ZIPCd"),
        "ServicesDesc": by_form("ServiceTypeTxt", f990="ServicesDesc", ez="ServiceTypeTxt"),
        **everywhere("CompensationAmt"),
    },
)


def _private_foundation(name: str, subroot: str, *columns: str, **renamed: str) -> Spec:
    return Spec(name, {"990PF": subroot}, only("990PF", **dict(zip(columns, columns)), **renamed))


program_related_investments = _private_foundation(
    "program_related_investments", "SumOfProgramRelatedInvstGrp",
    "Description1Txt", "Expenses1Amt", "Description2Txt", "Expenses2Amt",
    "AllOtherProgramRelatedInvestmentsSchedule", "AllOtherProgramRltdInvstTotAmt", "TotalAmt",
)

program_related_investments_summary = _private_foundation(
    "program_related_investments_summary", "PFQualifyingDistributionsGrp",
    expenses_and_contributions_amt="ExpensesAndContributionsAmt",
    program_related_investments_amt="ProgramRelatedInvstTotalAmt",
    total_qualifying_distributions_amt="QualifyingDistributionsAmt",
)

direct_charitable_activity_details = _private_foundation(
    "direct_charitable_activity_details", "SummaryOfDirectChrtblActyGrp",
    "Description1Txt", "Expenses1Amt", "Description2Txt", "Expenses2Amt",
    "Description3Txt", "Expenses3Amt", "Description4Txt", "Expenses4Amt",
)

SPECS = (
    filing_details, contributions_grants_assets, donor_advised_fund_details, exemption_and_service_description,
    grant_details, independent_contractor_details, program_related_investments,
    program_related_investments_summary, direct_charitable_activity_details,
)
