"""Fixed code lists, rate tables and deal settings.

Everything here is a fixed value of the regulatory templates or of the deals: it must be exactly
as stated for results to be right.  The frames are local relations of at most a few hundred rows,
which is the proof of size behind every broadcast of them.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# fixed values: code lists of the loan template, field code -> list
REF_TABLES: dict[str, dict[str, str]] = {
    "account_status": {
        "1": "Performing", "2": "Arrears", "3": "Default or Foreclosure", "4": "Redeemed",
        "5": "Repurchased by Seller", "6": "Other", "ND": "No Data",
    },
    "employment_status": {
        "1": "Employed or full loan is guaranteed", "2": "Employed with partial support",
        "3": "Protected life-time employment", "4": "Unemployed", "5": "Self-employed",
        "6": "No employment, borrower is legal entity", "7": "Student", "8": "Pensioner",
        "9": "Other", "ND": "No Data",
    },
    "epc_rating": {
        "A": "EPC A", "B": "EPC B", "C": "EPC C", "D": "EPC D", "E": "EPC E", "F": "EPC F", "G": "EPC G",
        "NR": "Not required to have EPC rating", "ND": "No Data",
    },
    "forbearance_type": {
        "1": "Term extension", "2": "Temporary transfer to IO", "3": "Permanent transfer to IO",
        "4": "Arrears capitalisation", "5": "Payment arrangement", "6": "Non contractual payment holiday",
        "7": "Other", "8": "Multiple forbearance options exercised", "9": "Not in forbearance",
    },
    "income_verification": {
        "1": "Self-certified no checks", "2": "Self-certified with affordability confirmation",
        "3": "Verified", "4": "Non-Verified Income", "5": "Other", "ND": "No Data",
    },
    "interest_rate_index": {
        "1": "1 month LIBOR", "2": "1 month EURIBOR", "3": "3 month LIBOR", "4": "3 month EURIBOR",
        "5": "6 month LIBOR", "6": "6 month EURIBOR", "7": "12 month LIBOR", "8": "12 month EURIBOR",
        "9": "BoE Base Rate", "10": "ECB Base Rate", "11": "Standard Variable Rate", "12": "Other",
        "ND": "No Data",
    },
    "interest_rate_type": {
        "1": "Floating rate loan (for life)", "2": "Floating rate loan linked to Libor/Euribor/BoE SVR",
        "3": "Fixed rate loan (for life)", "4": "Fixed with future periodic resets",
        "5": "Fixed rate loan with compulsory future switch to floating", "6": "Capped", "7": "Discount",
        "8": "Other", "ND": "No Data",
    },
    "lien": {"1": "1st Lien", "2": "2nd Lien", "3": "3rd Lien", "4": "Other", "ND": "No Data"},
    "loan_purpose": {
        "1": "Purchase", "2": "Re-mortgage", "3": "Renovation", "4": "Equity release", "5": "Construction",
        "6": "Debt consolidation", "7": "Other", "8": "Re-mortgage with Equity Release",
        "9": "Re-mortgage on Different Terms", "10": "Combination Mortgage", "11": "Investment Mortgage",
        "12": "Right to Buy", "13": "Government Sponsored Loan", "14": "SCPI", "15": "Besson",
        "16": "Perissol", "17": "DOM", "18": "Other", "ND": "No Data",
    },
    "occupancy": {
        "1": "Owner-occupied", "2": "Partially owner-occupied", "3": "Non-owner-occupied / Buy-to-let",
        "4": "Holiday / Second home", "ND": "No Data",
    },
    "origination_channel": {
        "1": "Office / branch network", "2": "Central / Direct", "3": "Broker", "4": "Internet",
        "5": "Packager", "ND": "No Data",
    },
    "payment_frequency": {
        "1": "Monthly", "2": "Quarterly", "3": "Semi annually", "4": "Annual", "5": "Bullet",
        "6": "Other", "ND": "No Data",
    },
    "property_type": {
        "1": "Residential (House)", "2": "Residential (Flat/Apartment)", "3": "Residential (Bungalow)",
        "4": "Residential (Terraced House)", "5": "Multifamily house with recourse",
        "6": "Multifamily house without recourse", "7": "Partially commercial use",
        "8": "Commercial/business use with recourse", "9": "Commercial/business use without recourse",
        "10": "Land Only", "11": "Other", "ND": "No Data",
    },
    "region": {
        "UKC": "North East England", "UKD": "North West England", "UKE": "Yorkshire and The Humber",
        "UKF": "East Midlands", "UKG": "West Midlands", "UKH": "East of England", "UKI": "London",
        "UKJ": "South East England", "UKK": "South West England", "UKL": "Wales", "UKM": "Scotland",
        "UKN": "Northern Ireland", "ND": "No Data",
    },
    "repayment_method": {
        "1": "Interest Only", "2": "Repayment", "3": "Endowment", "4": "Pension", "5": "ISA/PEP",
        "6": "Index-Linked", "7": "Part & Part", "8": "Savings Mortgage", "9": "Other", "ND": "No Data",
    },
    "shared_ownership": {
        "1": "Not Shared Ownership", "2": "Central Government Scheme", "3": "Local Government Scheme",
        "4": "Housing Associations", "5": "Building Developers", "6": "Other", "ND": "No Data",
    },
    "valuation_type": {
        "1": "Full, internal and external inspection", "2": "Full, only external inspection",
        "3": "Drive-by", "4": "AVM", "5": "Indexed", "6": "Desktop", "7": "Managing Agent / Estate Agent",
        "8": "Tax Authority", "9": "Other", "ND": "No Data",
    },
}

# fixed values: the tape field each list decodes
REF_FIELDS = {
    "account_status": "AR166", "employment_status": "AR21", "epc_rating": "AR162", "forbearance_type": "AR123",
    "income_verification": "AR27", "interest_rate_index": "AR108", "interest_rate_type": "AR107", "lien": "AR84",
    "loan_purpose": "AR59", "occupancy": "AR130", "origination_channel": "AR58", "payment_frequency": "AR70",
    "property_type": "AR131", "region": "AR128", "repayment_method": "AR69", "shared_ownership": "AR60",
    "valuation_type": "AR144",
}

# fixed values: postcode area and region
POSTCODE_AREAS = [
    ("DH", "UKC"), ("DL", "UKC"), ("NE", "UKC"), ("SR", "UKC"), ("TS", "UKC"),
    ("BB", "UKD"), ("BL", "UKD"), ("CA", "UKD"), ("CH", "UKD"), ("CW", "UKD"), ("FY", "UKD"), ("L", "UKD"),
    ("LA", "UKD"), ("M", "UKD"), ("OL", "UKD"), ("PR", "UKD"), ("SK", "UKD"), ("WA", "UKD"), ("WN", "UKD"),
    ("BD", "UKE"), ("DN", "UKE"), ("HD", "UKE"), ("HG", "UKE"), ("HU", "UKE"), ("HX", "UKE"), ("LS", "UKE"),
    ("S", "UKE"), ("WF", "UKE"), ("YO", "UKE"),
    ("DE", "UKF"), ("LE", "UKF"), ("LN", "UKF"), ("NG", "UKF"), ("NN", "UKF"),
    ("B", "UKG"), ("CV", "UKG"), ("DY", "UKG"), ("HR", "UKG"), ("ST", "UKG"), ("TF", "UKG"), ("WR", "UKG"),
    ("WS", "UKG"), ("WV", "UKG"),
    ("AL", "UKH"), ("CB", "UKH"), ("CM", "UKH"), ("CO", "UKH"), ("IP", "UKH"), ("LU", "UKH"), ("NR", "UKH"),
    ("PE", "UKH"), ("SG", "UKH"), ("SS", "UKH"), ("HP", "UKH"),
    ("E", "UKI"), ("EC", "UKI"), ("N", "UKI"), ("NW", "UKI"), ("SE", "UKI"), ("SW", "UKI"), ("W", "UKI"),
    ("WC", "UKI"), ("BR", "UKI"), ("CR", "UKI"), ("DA", "UKI"), ("EN", "UKI"), ("HA", "UKI"), ("IG", "UKI"),
    ("KT", "UKI"), ("RM", "UKI"), ("SM", "UKI"), ("TW", "UKI"), ("UB", "UKI"), ("WD", "UKI"),
    ("BN", "UKJ"), ("CT", "UKJ"), ("GU", "UKJ"), ("ME", "UKJ"), ("MK", "UKJ"), ("OX", "UKJ"), ("PO", "UKJ"),
    ("RG", "UKJ"), ("RH", "UKJ"), ("SL", "UKJ"), ("SO", "UKJ"), ("TN", "UKJ"),
    ("BA", "UKK"), ("BH", "UKK"), ("BS", "UKK"), ("DT", "UKK"), ("EX", "UKK"), ("GL", "UKK"), ("PL", "UKK"),
    ("SN", "UKK"), ("SP", "UKK"), ("TA", "UKK"), ("TQ", "UKK"), ("TR", "UKK"),
    ("CF", "UKL"), ("LD", "UKL"), ("LL", "UKL"), ("NP", "UKL"), ("SA", "UKL"), ("SY", "UKL"),
    ("AB", "UKM"), ("DD", "UKM"), ("DG", "UKM"), ("EH", "UKM"), ("FK", "UKM"), ("G", "UKM"), ("HS", "UKM"),
    ("IV", "UKM"), ("KA", "UKM"), ("KW", "UKM"), ("KY", "UKM"), ("ML", "UKM"), ("PA", "UKM"), ("PH", "UKM"),
    ("TD", "UKM"), ("ZE", "UKM"),
    ("BT", "UKN"),
]

# fixed values: display labels of the monthly preparation path (wording differs from the lists above)
PREP_LABELS: dict[str, dict[str, str]] = {
    "purpose": {
        "1": "Purchase", "2": "Re-mortgage", "3": "Renovation", "4": "Equity Release", "5": "Construction",
        "6": "Debt Consolidation", "7": "Other", "8": "Re-mortgage w/ Equity Release",
        "9": "Re-mortgage Different Terms", "10": "Combination", "11": "Investment (BTL)", "12": "Right to Buy",
        "13": "Government Sponsored", "18": "Other",
    },
    "repayment": {
        "1": "Interest Only", "2": "Repayment", "3": "Endowment", "4": "Pension", "5": "ISA/PEP",
        "6": "Index-Linked", "7": "Part & Part", "8": "Savings", "9": "Other",
    },
    "rate_type": {
        "1": "Floating (for life)", "2": "Floating reverting to SVR", "3": "Fixed (for life)",
        "4": "Fixed w/ resets", "5": "Fixed then Floating", "6": "Capped", "7": "Discount", "8": "Other",
    },
    "rate_index": {
        "1": "1M LIBOR", "2": "1M EURIBOR", "3": "3M LIBOR", "4": "3M EURIBOR", "5": "6M LIBOR",
        "6": "6M EURIBOR", "7": "12M LIBOR", "8": "12M EURIBOR", "9": "BoE Base Rate", "10": "ECB Base Rate",
        "11": "Standard Variable Rate", "12": "Other",
    },
    "occupancy": {
        "1": "Owner-Occupied", "2": "Partially Owner-Occupied", "3": "Buy-to-Let / Non-OO",
        "4": "Holiday / Second Home",
    },
    "property_type": {
        "1": "House (detached/semi)", "2": "Flat / Apartment", "3": "Bungalow", "4": "Terraced House",
        "5": "Multifamily (recourse)", "6": "Multifamily (no recourse)", "7": "Partially Commercial",
        "8": "Commercial (recourse)", "9": "Commercial (no recourse)", "10": "Land Only", "11": "Other",
    },
    "account_status": {
        "1": "Performing", "2": "Arrears", "3": "Default / Foreclosure", "4": "Redeemed",
        "5": "Repurchased by Seller", "6": "Other", "7": "Repossessed",
    },
    "channel": {
        "1": "Branch Network", "2": "Central / Direct", "3": "Broker", "4": "Internet", "5": "Packager",
    },
    "income_verification": {
        "1": "Self-cert, no checks", "2": "Self-cert w/ affordability", "3": "Verified", "4": "Non-Verified",
        "5": "Other",
    },
    "region": {
        "UKC": "North East", "UKD": "North West", "UKE": "Yorkshire & Humber", "UKF": "East Midlands",
        "UKG": "West Midlands", "UKH": "East of England", "UKI": "London", "UKJ": "South East",
        "UKK": "South West", "UKL": "Wales", "UKM": "Scotland", "UKN": "Northern Ireland",
    },
    "regulated": {"Y": "Regulated", "N": "Unregulated"},
}

# fixed values: arrears buckets in display order
DQ_BUCKETS = [
    "<= 1 Month", "1 - 2 Months", "2 - 3 Months", "3 - 4 Months", "4 - 5 Months", "5 - 6 Months", "> 6 Months",
]

# fixed values: anchor risk weights (rating, senior 1y, senior 5y, non-senior 1y, non-senior 5y)
COMMON_WEIGHTS = [
    ("AAA", 0.15, 0.20, 0.15, 0.30),
    ("AA+", 0.15, 0.25, 0.15, 0.40),
    ("AA", 0.20, 0.30, 0.25, 0.50),
    ("AA-", 0.25, 0.35, 0.30, 0.55),
    ("A+", 0.30, 0.45, 0.40, 0.65),
    ("A", 0.35, 0.55, 0.50, 0.80),
    ("A-", 0.45, 0.70, 0.60, 0.95),
    ("BBB+", 0.55, 0.85, 0.75, 1.15),
    ("BBB", 0.70, 1.05, 0.90, 1.40),
    ("BBB-", 0.90, 1.40, 1.20, 1.85),
    ("BB+", 1.20, 1.85, 1.40, 2.70),
    ("BB", 1.40, 2.50, 1.70, 3.30),
    ("BB-", 1.70, 3.00, 2.20, 4.20),
    ("B+", 2.20, 3.80, 3.30, 5.80),
    ("B", 2.80, 4.60, 4.70, 7.50),
    ("B-", 3.80, 6.20, 6.50, 10.50),
]
LIBRARY_WEIGHTS = COMMON_WEIGHTS + [
    ("CCC+", 5.20, 9.20, 10.00, 12.50),
    ("CCC", 7.00, 12.50, 12.50, 12.50),
    ("CCC-", 12.50, 12.50, 12.50, 12.50),
]
EXPORT_WEIGHTS = COMMON_WEIGHTS + [
    ("CCC+", 5.30, 8.00, 9.00, 13.50),
    ("CCC", 7.00, 10.50, 12.00, 18.00),
    ("CCC-", 9.50, 13.50, 12.50, 12.50),
    ("NR", 12.50, 12.50, 12.50, 12.50),
]

# fixed values: spellings of one agency scale -> the other
RATING_SPELLINGS = {
    "Aaa": "AAA", "Aa1": "AA+", "Aa2": "AA", "Aa3": "AA-", "A1": "A+", "A2": "A", "A3": "A-",
    "Baa1": "BBB+", "Baa2": "BBB", "Baa3": "BBB-", "Ba1": "BB+", "Ba2": "BB", "Ba3": "BB-",
    "B1": "B+", "B2": "B", "B3": "B-", "Caa1": "CCC+", "Caa2": "CCC", "Caa3": "CCC-",
}

# fixed values: regulatory constants
FLOOR_WEIGHT, UNRATED_WEIGHT, CAPITAL_RATIO, THIN_LIMIT = 0.15, 12.5, 0.08, 0.10

# fixed values: rating, seniority and weighted average life per deal and class
TRANCHE_CONFIG = [
    ("AVON2", "Class A", "AAA", "senior", 3.5),
    ("AVON2", "Class B", "AA", "non-senior", 4.0),
    ("AVON2", "Class C", "A", "non-senior", 4.5),
    ("AVON2", "Class D", "BBB", "non-senior", 5.0),
    ("AVON2", "Class E", "BB", "non-senior", 5.0),
    ("AVON2", "Class F", "B", "non-senior", 5.0),
    ("AVON2", "Class Z", "NR", "non-senior", 5.0),
    ("BLETCHLEY", "Class A", "AAA", "senior", 3.0),
    ("BLETCHLEY", "Class B", "AA", "non-senior", 3.5),
    ("BLETCHLEY", "Class C", "A", "non-senior", 4.0),
    ("BLETCHLEY", "Class D", "BBB", "non-senior", 4.5),
    ("BLETCHLEY", "Class E", "BB", "non-senior", 5.0),
    ("BLETCHLEY", "Class X1", "NR", "non-senior", 2.0),
    ("BLETCHLEY", "Class X2", "NR", "non-senior", 3.0),
]

# fixed values: class, rating, share of pool, attachment, detachment, life, seniority
STRUCTURE_TEMPLATE = [
    ("Class A", "AAA", 0.85, 0.15, 1.00, 3.5, "senior"),
    ("Class B", "AA", 0.07, 0.08, 0.15, 4.0, "non-senior"),
    ("Class C", "A", 0.04, 0.04, 0.08, 4.5, "non-senior"),
    ("Class D", "BBB", 0.03, 0.01, 0.04, 5.0, "non-senior"),
    ("FLP", None, 0.01, 0.00, 0.01, 5.0, "non-senior"),
]

# fixed values: note classes of the first deal (class, rating, original, current, factor, margin %, role)
NOTE_CLASSES = [
    ("Class A", "AAA", 666345000.0, 419265186.12, 0.629201, 0.90, "Senior"),
    ("Class B", "AA", 32504000.0, 32504000.0, 1.0, 1.50, "Mezzanine"),
    ("Class C", "A", 32505000.0, 32505000.0, 1.0, 2.00, "Mezzanine"),
    ("Class D", "BBB", 24378000.0, 24378000.0, 1.0, 2.50, "Mezzanine"),
    ("Class E", "BB", 20316000.0, 20316000.0, 1.0, 3.00, "Junior"),
    ("Class F", "B", 8126000.0, 8126000.0, 1.0, 3.25, "Junior"),
    ("Class Z", "NR", 28441000.0, 28441000.0, 1.0, None, "Residual"),
    ("VRR Loan Note", "NR", 42770000.0, 29765799.28, 0.695950, None, "Risk Retention"),
]

# fixed values: what-if values of the stress parameters
HPI_SHOCKS = [-40, -35, -30, -25, -20, -15, -10, -5, 0, 5, 10]
CDR_MULTIPLIERS = [0.5, 0.75, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0]
SEVERITY_MULTIPLIERS = [0.5, 0.75, 1.0, 1.25, 1.5, 1.75, 2.0]
CPR_ASSUMPTIONS = [0, 2, 4, 6, 8, 10, 12, 15, 20, 25, 30]

# fixed values: reported pool figures that open a new history
REPORTED_POOL = [
    dict(Period="2022-12", CutoffDate=date(2022, 12, 31), Source="Investor Report", NumLoans=6389,
         CurrentBalance=Decimal("633249943.04"), AvgLoanSize=99115.66, WA_CurrentLTV=75.38, WA_Coupon=4.80,
         WA_Seasoning_Months=193.11, CPR_1m=13.82, CPR_3m=15.18, CPR_12m=3.51, PPR_1m=15.18, PPR_3m=16.54,
         PPR_12m=13.06, CDR_1m=0.35, CDR_3m=0.22, CDR_Lifetime=0.16, CumLossSeverity=16.57,
         Pct_Delinquent_1m_plus=7.83),
    dict(Period="2023-02", CutoffDate=date(2023, 2, 28), Source="Investor Report", NumLoans=6187,
         CurrentBalance=Decimal("610011165.79"), AvgLoanSize=98595.63, WA_CurrentLTV=75.48, WA_Coupon=5.92,
         WA_Seasoning_Months=196.12, CPR_1m=9.62, CPR_3m=12.70, CPR_12m=9.04, PPR_1m=11.24, PPR_3m=14.15,
         PPR_12m=15.82, CDR_1m=0.51, CDR_3m=0.29, CDR_Lifetime=0.18, CumLossSeverity=16.57,
         Pct_Delinquent_1m_plus=9.54),
]
# fixed values: reported arrears buckets (balance, number, % of balance) in bucket order
REPORTED_DELINQUENCY = {
    "2023-02": [
        (551839344.10, 5692, 90.46), (19458288.25, 176, 3.19), (12681433.87, 96, 2.08), (7115631.62, 68, 1.17),
        (5408076.84, 41, 0.89), (2593440.82, 23, 0.43), (10914950.29, 91, 1.79),
    ],
    "2022-12": [
        (583682282.48, 5953, 92.17), (17858594.69, 158, 2.82), (8249693.14, 80, 1.30), (5334040.57, 43, 0.84),
        (4707824.52, 36, 0.74), (2772906.62, 28, 0.44), (10644601.02, 91, 1.68),
    ],
}

# fixed values: deal registry (id, name, folder, asset class, status, tape pattern, report pattern)
DEALS = [
    ("AVON2", "Avon Finance No.2 PLC", "Avon Finance No 2 Plc", "UK RMBS (non-conforming)", "active",
     "*Data_Tape*.xlsx", "*IR*.pdf"),
    ("BLETCHLEY", "Bletchley Park Funding 2024-1 PLC", "Bletchley Park Funding 2024-1 PLC 1", "UK RMBS", "active",
     "*boe*.xlsx", "*IR*.pdf"),
    ("CANTERBURY", "Canterbury Finance No 3", "Canterbury Finance No 3", "UK RMBS", "active",
     "BOE_Canby3*.xlsx", "*Investor Report*.pdf"),
    ("HADRIAN", "Hadrian Funding 2025-1 PLC", "Hadrian Funding 2025-1 PLC", "UK RMBS", "active",
     "*Data_Tape*.xlsx", "*IR*.pdf"),
    ("STRATTON2021_1", "Stratton Mortgage Funding 2021-1 PLC", "Stratton Mortgage Funding 2021-1 Plc 1", "UK RMBS",
     "active", "*Data_Tape*.xlsx", "*IR*.pdf"),
]

# fixed values: report settings per deal (file name pattern, original Class A balance, notes below Class A)
REPORT_CONFIG = [
    ("AVON2", "(?i)Avon 2.*IR.*\\.pdf|Avon 2.*Monthly.*Report.*\\.pdf", 666345000.0, 146270000.0),
    ("BLETCHLEY", "(?i)Bletchley.*IR.*\\.pdf", 207150000.0, 37393000.0),
]


def _frame(spark: SparkSession, names: str, rows: list[tuple], types: list[pa.DataType] | None = None) -> DataFrame:
    """A local relation: its size is known to Spark, so small joins broadcast without a Python job."""
    names_ = names.split()
    columns = [list(c) for c in zip(*rows)]
    arrays = [pa.array(c, type=types[i] if types else None) for i, c in enumerate(columns)]
    return spark.createDataFrame(pa.table(dict(zip(names_, arrays))))


def ref_table(spark: SparkSession, name: str) -> DataFrame:
    """``(code, label)`` list by name; ``postcode_to_region`` gives ``(postcode_area, region_code)``."""
    if name == "postcode_to_region":
        return _frame(spark, "postcode_area region_code", POSTCODE_AREAS)
    return _frame(spark, "code label", list(REF_TABLES[name].items()))


def risk_weights(spark: SparkSession, variant: str = "library") -> DataFrame:
    """``(Rating, Seniority, rw1, rw5)`` anchor weights; ``variant`` is ``library`` or ``export``."""
    table = {"library": LIBRARY_WEIGHTS, "export": EXPORT_WEIGHTS}[variant]
    rows = [(r, "senior", s1, s5) for r, s1, s5, _, _ in table] + [(r, "non-senior", n1, n5) for r, _, _, n1, n5 in table]
    return _frame(spark, "Rating Seniority rw1 rw5", rows)


def rating_spellings() -> dict[str, str]:
    """Every accepted spelling -> canonical rating."""
    return {**RATING_SPELLINGS, **{r[0]: r[0] for r in LIBRARY_WEIGHTS}}


def tranche_config(spark: SparkSession) -> DataFrame:
    return _frame(spark, "DealID TrancheID Rating Seniority WAL", TRANCHE_CONFIG)


def structure_template(spark: SparkSession) -> DataFrame:
    return _frame(spark, "TrancheID Rating Share Attachment Detachment WAL Seniority", STRUCTURE_TEMPLATE)


def note_classes(spark: SparkSession, deal_id: str = "AVON2") -> DataFrame:
    rows = [(deal_id, *row) for row in NOTE_CLASSES]
    return _frame(spark, "DealID Class Rating OrigBalance CurrentBalance Factor Margin_pct Subordination", rows)


def deals(spark: SparkSession) -> DataFrame:
    return _frame(spark, "DealID name folder asset_class status tape_pattern ir_pattern", DEALS)


def report_config(spark: SparkSession) -> DataFrame:
    return _frame(spark, "deal_id ir_pattern original_class_a subordination", REPORT_CONFIG)


def dq_buckets(spark: SparkSession) -> DataFrame:
    return _frame(spark, "Bucket BucketOrder", [(b, i + 1) for i, b in enumerate(DQ_BUCKETS)], [pa.string(), pa.int32()])


def reported_pool(spark: SparkSession) -> DataFrame:
    table = pa.Table.from_pylist(REPORTED_POOL)
    at = table.schema.get_field_index("CurrentBalance")
    return spark.createDataFrame(table.set_column(at, "CurrentBalance", table.column(at).cast(pa.decimal128(38, 2))))


def reported_delinquency(spark: SparkSession) -> DataFrame:
    """Reported buckets; the cut-off is always day 28 of the period, also in December."""
    rows = [
        (period, date.fromisoformat(f"{period}-28"), "Investor Report", DQ_BUCKETS[i], i + 1, Decimal(f"{bal:.2f}"), n, pct)
        for period, buckets in REPORTED_DELINQUENCY.items()
        for i, (bal, n, pct) in enumerate(buckets)
    ]
    types = [pa.string(), pa.date32(), pa.string(), pa.string(), pa.int32(), pa.decimal128(38, 2), pa.int64(), pa.float64()]
    return _frame(spark, "Period CutoffDate Source Bucket BucketOrder Balance Number PctBalance", rows, types)


def scenario_table(spark: SparkSession, name: str) -> DataFrame:
    """One what-if table: ``HPI_Shock_pct``, ``CDR_Multiplier``, ``Severity_Multiplier`` or ``CPR_Assumption_pct``."""
    values = {
        "HPI_Shock_pct": HPI_SHOCKS,
        "CDR_Multiplier": CDR_MULTIPLIERS,
        "Severity_Multiplier": SEVERITY_MULTIPLIERS,
        "CPR_Assumption_pct": CPR_ASSUMPTIONS,
    }[name]
    return _frame(spark, name, [(float(v),) for v in values])
