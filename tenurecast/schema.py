"""Column roles, types and lookup values of the employee-year table."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: column names and roles -------------------------------

BUSINESS = "BUSINESS_ID"
PARTICIPANT = "MASTER_PARTICIPANT_ID"
AS_OF = "TERM_AS_OF_DATE"
LABEL = "TERM_NEXT_YEAR"
PROBABILITY = "PRED_TERM_PROB"
EXPECTED = "EXPECTED_VALUE"

# Columns of a table that holds several calendars.
CALENDAR = "calendar"
YEAR = "YEAR"

DESCRIPTIVE = [
    "HOME_CITY",
    "HOME_STATE_PROVINCE",
    "HOME_COUNTRY_CODE",
    "HIRE_AS_OF_DATE",
    "TITLE_NAME_YR_END",
]

CATEGORICAL = ["TITLE_CATEGORY_YR_END", "INDUSTRY", "OWNERSHIP"]

NUMERIC_FEATURES = [
    "PR_TARGET_USD",
    "SALARY_USD",
    "COUNT_MONTH_EMPLOYED_TIL_DEC",
    "COUNT_MONTHS_GOT_PAYMENT",
    "LAST_PAYMENT_UNTIL_YR_END",
    "YEAR_PAYMENT",
    "COUNT_UNIQ_QUOTA",
    "COUNT_AVG_MONTH_PAID_QUOTA",
    "LAST_QUOTA_PAID_UNTIL_YR_END",
    "SUM_CREDIT_AMT_USD",
    "MIN_CREDIT_AMT_USD",
    "DIFF_QUOTA_AMT_USD",
    "COUNT_UNIQ_TITLE_NAME",
    "COUNT_UNIQ_MGR_ID",
]

# Feature used by the gregorian score-only layout.
PAYEE_COUNT = "COMP_AVG_MONTH_PAYEECOUNT"

# new column -> (minuend, subtrahend)
DIFFERENCES = {
    "DIFF_MONTH_ORDER": ("COUNT_MAX_MONTH_ORDER", "COUNT_MIN_MONTH_ORDER"),
    "DIFF_QUOTA_AMT_USD": ("MAX_QUOTA_AMT_USD", "MIN_QUOTA_AMT_USD"),
}

INTEGER_COLUMNS = [
    "BUSINESS_ID",
    "MASTER_PARTICIPANT_ID",
    "CAL_YEAR",
    "FISCAL_YEAR",
    "TERM_AS_OF_DATE",
    "HIRE_AS_OF_DATE",
    "COUNT_UNIQ_TITLE_NAME",
    "COUNT_UNIQ_MGR_ID",
    "COUNT_MONTHS_GOT_PAYMENT",
    "TERM_NEXT_YEAR",
]

STRING_COLUMNS = [
    "TITLE_NAME_YR_END",
    "TITLE_CATEGORY_YR_END",
    "HOME_CITY",
    "HOME_STATE_PROVINCE",
    "HOME_COUNTRY_CODE",
    "INDUSTRY",
    "OWNERSHIP",
]

# ---- fixed values: category consolidation --------------------------------

# consolidated title -> raw titles
TITLE_GROUPS = {
    "ACCOUNT_EXECUTIVE": ["ACCOUNT_EXECUTIVE", "ACCOUNT_MANAGER"],
    "REPRESENTATIVE": [
        "FIELD_SALES_REPRESENTATIVE",
        "INSIDE_SALES_REPRESENTATIVE",
        "LEAD_GENERATION_REPRESENTATIVE",
        "BUSINESS_DEVELOPMENT_ALLIANCE_PARTNERSHIP_REP",
        "SERVICES_REPRESENTATIVE",
        "CUSTOMER_SUCCESS_REPRESENTATIVE",
        "CHANNEL_SALES_REPRESENTATIVE",
    ],
    "CONSULTANT": [
        "SALES_SYSTEMS_APPLICATIONS_ENGINEER",
        "SALES_SUPPORT_OPERATIONS",
        "PRE_SALES_CONSULTANT",
        "PRODUCT_INDUSTRY_SPECIALIST",
    ],
    "MANAGER": [
        "SALES_MANAGER",
        "SERVICES_MANAGER",
        "STRATEGIC_KEY_GLOBAL_ACCOUNT_MANAGER",
        "MANAGER_SALES_SYSTEMS_APPLICATION_ENGINEERING",
        "MANAGER_CHANNEL_SALES",
        "MANAGER_BUSINESS_DEVELOPMENT_ALLIANCE_PARTNERSHIPS",
        "MANAGER_INSIDE_SALES",
        "MANAGER_LEAD_GENERATION",
    ],
    "DIRECTOR": ["SALES_DIRECTOR", "SALES_EXECUTIVE"],
}

# consolidated industry -> raw industries
INDUSTRY_GROUPS = {
    "SaaS & Cloud": ["Software", "Media & Internet", "SaaS & Cloud"],
    "Business Services": ["Financial Services", "Business Services"],
    "Communications": ["Travel & Hospitality", "Communications"],
    "Life Sciences & Pharma": ["Medical Devices", "Healthcare", "Life Sciences & Pharma"],
    "Retail": ["Consumer Goods", "Retail"],
    "Manufacturing": ["Manufacturing", "High-Tech Manufacturing"],
    "Government/Public Sector": ["Energy", "Other", "Government/Public Sector"],
}

# ---- fixed values: the score-only layout of indicator columns ------------

FIXED_TITLES = ["ACCOUNT_EXECUTIVE", "CONSULTANT", "DIRECTOR", "MANAGER", "REPRESENTATIVE"]
FIXED_INDUSTRIES = [
    "SaaS & Cloud",
    "Business Services",
    "Communications",
    "Government/Public Sector",
    "Life Sciences & Pharma",
    "Manufacturing",
]
FIXED_OWNERSHIP = ["Private", "Public"]

SPARSE_SHARE = 0.5
OUTLIER_SIGMAS = 3
SEED = 42
RETENTION_DAYS = 14


def invert(groups: dict[str, list[str]]) -> dict[str, str]:
    """``{mapped: [raw, ...]}`` as ``{raw: mapped}``."""
    return {raw: mapped for mapped, raws in groups.items() for raw in raws}


TITLE_LOOKUP = invert(TITLE_GROUPS)
INDUSTRY_LOOKUP = invert(INDUSTRY_GROUPS)


@dataclass(frozen=True)
class Calendar:
    """One of the two variants of the employee-year table."""

    name: str
    year: str
    shift_months: int

    @property
    def grain(self) -> list[str]:
        return [BUSINESS, PARTICIPANT, self.year]

    @property
    def keys(self) -> list[str]:
        return [BUSINESS, self.year, AS_OF, PARTICIPANT]


GREGORIAN = Calendar("gregorian", "CAL_YEAR", 0)
FISCAL = Calendar("fiscal", "FISCAL_YEAR", 6)
CALENDARS = {c.name: c for c in (GREGORIAN, FISCAL)}


def calendar(name: str) -> Calendar:
    if name not in CALENDARS:
        raise ValueError(f"unknown calendar {name!r}; expected one of {sorted(CALENDARS)}")
    return CALENDARS[name]


def indicator(feature: str, level: str) -> str:
    """Name of the 0/1 column for one level of a categorical feature."""
    return f"{feature}_{level}"


def quoted(name: str) -> str:
    """Column reference safe for names with spaces, ``&`` and ``/``."""
    return "`" + name.replace("`", "``") + "`"


def number(value: float) -> str:
    """SQL text of a double, exact to the last bit.

    Wide projections are written as SQL text: one parsed string per column is
    far cheaper to build than a tree of column calls.
    """
    return f"double('{float(value)!r}')"
