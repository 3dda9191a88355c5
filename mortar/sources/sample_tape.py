"""Loan tape, note tape and report pages derived from the order tables.

The supplied tables are order data, the operators need loan tapes.  The rules below turn every
order into one loan followed over six month-ends.  They are written once in the SQL both Spark
and DuckDB read (``{...}`` marks the few spots where the dialects differ) and use integer
arithmetic only, so both engines derive the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


DIALECT = {
    "spark": {
        "div": "div",
        "orig": "add_months(odate, CAST(-60 * (k % 5) AS INT))",
        "cutoff": "last_day(add_months(DATE '2001-09-01', p))",
        "plus_months": "add_months({d}, {n})",
        "mon": "date_format({d}, 'MMM')",
        "yyyymmdd": "date_format({d}, 'yyyyMMdd')",
        "ddmonyyyy": "date_format({d}, 'dd-MMM-yyyy')",
        "commas": "format_number({x}, 0)",
    },
    "duckdb": {
        "div": "//",
        "orig": "CAST(odate - to_months(CAST(60 * (k % 5) AS INT)) AS DATE)",
        "cutoff": "last_day(CAST(DATE '2001-09-01' + to_months(CAST(p AS INT)) AS DATE))",
        "plus_months": "CAST({d} + to_months({n}) AS DATE)",
        "mon": "strftime({d}, '%b')",
        "yyyymmdd": "strftime({d}, '%Y%m%d')",
        "ddmonyyyy": "strftime({d}, '%d-%b-%Y')",
        "commas": "format('{{:,}}', CAST({x} AS BIGINT))",
    },
}


def _sql(rule: str, dialect: str) -> str:
    return rule.replace("{div}", DIALECT[dialect]["div"])


def _call(dialect: str, name: str, **args: str) -> str:
    return DIALECT[dialect][name].format(**args)


def _cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(14,0)) * 0.01 AS STRING)"


def _bp(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(10,0)) * 0.0001 AS STRING)"


def _choice(index: str, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {index} {arms} END"


# ------------------------------------------------------------------ loan tape

#: integer facts of one loan-period; later stages may use earlier names
LOAN_INTEGERS = [
    {
        "bal": "CASE WHEN k % 1009 = 0 THEN NULL WHEN k % 997 = 0 THEN -1"
        " ELSE cents * (1000 - 5 * p - 10 * (k % 7)) {div} 1000 END",
        "ltv": "CASE WHEN k % 211 = 0 THEN NULL ELSE 3000 + (k * 37) % 9000 END",
        "due": "cents {div} 200",
        "mia": "CASE WHEN k % 8 IN (0, 3) THEN ((k {div} 8 + p) * 3) % 90 ELSE 0 END",
        "mia1": "CASE WHEN k % 8 IN (0, 3) AND p >= 1 THEN ((k {div} 8 + p - 1) * 3) % 90 ELSE 0 END",
        "mia2": "CASE WHEN k % 8 IN (0, 3) AND p >= 2 THEN ((k {div} 8 + p - 2) * 3) % 90 ELSE 0 END",
        "rate": "150 + (k * 13) % 500",
        "margin": "50 + (k * 7) % 300",
    },
    {
        "oltv": "COALESCE(ltv, 4500) + 500",
        "prepay": "CASE WHEN (k + p) % 20 = 0 THEN GREATEST(bal, 0) {div} 50 ELSE 0 END",
        "status": "CASE WHEN k % 101 = 0 THEN '3' WHEN k % 103 = 0 THEN '4' WHEN k % 107 = 0 THEN NULL"
        " WHEN k % 109 = 0 THEN '5' WHEN mia >= 10 THEN '2' ELSE '1' END",
    },
]


def _code(field: str, n: int) -> tuple[str, str]:
    return field, f"CASE WHEN k % 53 = 0 THEN NULL ELSE CAST((k % {n}) + 1 AS STRING) END"


def _plain_code(field: str, n: int) -> tuple[str, str]:
    return field, f"CAST((k % {n}) + 1 AS STRING)"


def loan_fields(dialect: str) -> dict[str, str]:
    """Field code -> text expression over the integer facts (NULL where the tape says ``ND``)."""
    avon = "k % 2 = 0"
    rate = lambda x: f"CASE WHEN {avon} THEN {_cents(x)} ELSE {_bp(x)} END"
    not_avon = lambda x: f"CASE WHEN {avon} THEN NULL ELSE {x} END"
    sparse = lambda x: f"CASE WHEN k % 61 = 0 THEN NULL ELSE {x} END"
    later = lambda d, n: f"CAST({_call(dialect, 'plus_months', d=d, n=str(n))} AS STRING)"
    fields = {
        "DealID": f"CASE WHEN {avon} THEN 'AVON2' ELSE 'BLETCHLEY' END",
        "AR1": "CAST(cutoff AS STRING)",
        "AR2": "'POOL' || CAST(k % 3 AS STRING)",
        "AR3": "CASE WHEN k % 499 = 1 THEN NULL ELSE CAST(k AS STRING) END",
        "AR4": "CASE k % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
        "AR5": "'ORIG' || CAST(k % 4 AS STRING)",
        "AR6": "'SERV' || CAST(k % 2 AS STRING)",
        "AR7": "'B' || CAST(custkey AS STRING)",
        "AR8": "CASE WHEN k % 503 = 2 THEN NULL ELSE 'P' || CAST(k AS STRING) END",
        "AR17": "CASE k % 3 WHEN 0 THEN 'Prime' WHEN 1 THEN 'Non-conforming' END",
        "AR19": sparse("CAST((k % 3) + 1 AS STRING)"),
        "AR22": "CASE WHEN k % 4 = 0 THEN 'Y' ELSE 'N' END",
        "AR26": sparse(_cents("cents {div} 4")),
        "AR28": sparse(_cents("cents {div} 16")),
        "AR33": "CAST(k % 4 AS STRING)",
        "AR36": "CASE WHEN k % 41 = 0 THEN 'Y' ELSE 'N' END",
        "AR55": "CASE WHEN k % 307 = 0 THEN NULL WHEN k % 2 = 0 THEN 'Q' || CAST(quarter(orig) AS STRING)"
        " || '-' || CAST(year(orig) AS STRING) ELSE CAST(orig AS STRING) END",
        "AR56": later("orig", 300),
        "AR57": "CAST(orig AS STRING)",
        "AR61": "CASE WHEN k % 61 = 0 THEN NULL WHEN k % 67 = 0 THEN '300.0' ELSE '300' END",
        "AR66": _cents("cents"),
        "AR67": _cents("bal"),
        "AR71": _cents("due"),
        "AR97": _cents("prepay"),
        "AR100": _cents("prepay * (p + 1)"),
        "AR109": rate("rate"),
        "AR110": rate("margin"),
        "AR111": sparse("CAST((k % 4) * 3 AS STRING)"),
        "AR113": later("cutoff", 3),
        "AR128": "'UK' || substr('CDEFGHIJKLMN', CAST(nk % 12 AS INT) + 1, 1)",
        "AR135": _bp("oltv"),
        "AR136": _cents("cents * 10000 {div} oltv"),
        "AR138": "CAST(orig AS STRING)",
        "AR141": _bp("ltv"),
        "AR143": _cents("GREATEST(bal, 0) * 10000 {div} ltv"),
        "AR145": "CAST(cutoff AS STRING)",
        "AR154": _cents("CASE WHEN k % 4 = 2 THEN cents {div} 20 END"),
        "AR155": "CASE WHEN k % 4 = 2 THEN CAST(k % 6 AS STRING) END",
        "AR156": "CASE WHEN k % 4 = 2 THEN " + _cents("80 + k % 170") + " END",
        "AR162": not_avon("CASE WHEN k % 59 = 0 THEN 'NR' ELSE substr('ABCDEFG', CAST(k % 7 AS INT) + 1, 1) END"),
        "AR166": "status",
        "AR169": _cents("due * mia {div} 10"),
        "AR170": "CAST(CAST(mia AS DECIMAL(6,0)) * 0.1 AS STRING)",
        "AR171": "CAST(CAST(mia1 AS DECIMAL(6,0)) * 0.1 AS STRING)",
        "AR172": "CAST(CAST(mia2 AS DECIMAL(6,0)) * 0.1 AS STRING)",
        "AR173": not_avon("CASE WHEN k % 9 = 4 THEN CAST(cutoff AS STRING) END"),
        "AR174": "CASE WHEN k % 43 = 0 THEN 'Y' ELSE 'N' END",
        "AR175": "CASE WHEN status = '4' THEN CAST(cutoff AS STRING) END",
        "AR177": "CASE WHEN status = '3' THEN " + _cents("bal") + " END",
        "AR178": "CASE WHEN status = '3' THEN CAST(cutoff AS STRING) END",
        "AR179": "CASE WHEN status = '3' THEN " + _cents("GREATEST(bal, 0) * 70 {div} 100") + " END",
        "AR180": "CASE WHEN status = '3' THEN " + _cents("GREATEST(bal, 0) * 30 {div} 100") + " END",
        "AR181": "CASE WHEN status = '3' THEN " + _cents("GREATEST(bal, 0) * 5 {div} 100") + " END",
    }
    fields.update(
        [_code("AR21", 9), _code("AR27", 5), _code("AR58", 5), _code("AR59", 18), _code("AR69", 9)]
        + [_code("AR130", 4), _code("AR131", 11), _code("AR60", 6), _code("AR70", 6), _code("AR84", 4)]
        + [_plain_code("AR107", 8), _plain_code("AR108", 12), _plain_code("AR137", 9), _plain_code("AR144", 9)]
    )
    fields["AR123"] = not_avon("CAST((k % 9) + 1 AS STRING)")
    ordered = ["DealID"] + sorted((f for f in fields if f != "DealID"), key=lambda f: int(f[2:]))
    return {f: _sql(fields[f], dialect) for f in ordered}


LOAN_FIELDS = list(loan_fields("spark"))

#: messy headers as issuers deliver them; all other fields come with their bare code
RAW_HEADERS = {"AR3": "AR3 Loan Identifier", "AR67": "AR67 Current Balance", "AR162": "AR162_"}

#: the null spelling a raw tape uses for a field; all other fields use ``ND``
RAW_NULLS = {"AR4": "nan", "AR8": "", "AR178": "NaT"}


#: orders that one task turns into tape rows, notes or pages: six to fourteen wide rows come from each
ORDERS_A_TASK = 5000
#: more tasks than this take more orders each, but no more than the next number: every task writes a block for each task
#: of the following shuffle, and sums up its rows for itself
MANY_TASKS, MOST_ORDERS_A_TASK = 300, 20_000
#: the same for tasks after a shuffle that hold and sort the rows made of the orders
MANY_PARTS, MOST_ORDERS_A_PART = 64, 40_000


def _tasks(spark: SparkSession, sf_dir: str, many: int, most: int) -> int:
    """Tasks of ``ORDERS_A_TASK`` orders, or ``many`` larger ones, or as many as ``most`` orders a task ask for.

    The count comes from Parquet footers.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    return max(1, -(-orders // most), min(-(-orders // ORDERS_A_TASK), many))


def _dealt(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows by order dealt over tasks of bounded size, however large the table is.

    Without a number the shuffle, small as it is, would be coalesced to a few tasks, and what is made of it is many
    times larger.
    """
    return rows.repartition(_tasks(spark, sf_dir, MANY_TASKS, MOST_ORDERS_A_TASK), "k")


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Number of tasks that keep the rows of one, made of orders and shuffled by loan or note, to a bounded size."""
    return _tasks(spark, sf_dir, MANY_PARTS, MOST_ORDERS_A_PART)


def _periods(spark: SparkSession, sf_dir: str, region: bool) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS k",
        "o_custkey AS custkey",
        "CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents",
        "CAST(o_orderdate AS DATE) AS odate",
    )
    if region:
        customer = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey AS custkey", "c_nationkey")
        nation = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey AS c_nationkey", "n_nationkey AS nk")
        orders = orders.join(customer, "custkey").join(nation, "c_nationkey").drop("c_nationkey")
    # after the join, whose own shuffle would be coalesced too
    return _dealt(spark, sf_dir, orders).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(5))))


def _loan_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = DIALECT["spark"]
    df = _periods(spark, sf_dir, True).selectExpr("*", f"{d['orig']} AS orig", f"{d['cutoff']} AS cutoff")
    for stage in LOAN_INTEGERS:
        df = df.selectExpr("*", *[f"{_sql(rule, 'spark')} AS {name}" for name, rule in stage.items()])
    return df


def loan_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged tape: ``DealID`` and ``AR*`` columns, all text, nulls already nulled."""
    fields = loan_fields("spark")
    return _loan_periods(spark, sf_dir).selectExpr(*[f"{rule} AS {name}" for name, rule in fields.items()])


def raw_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tape as delivered: messy headers, null spellings, an extra column, description and blank rows."""
    noise = {"AR2": "'Pool Identifier'", "AR3": "'Loan Identifier'", "AR7": "'Borrower Identifier'"}
    fields = loan_fields("spark")
    out = [f"{fields['DealID']} AS DealID"]
    for field in LOAN_FIELDS[1:]:
        described = noise.get(field, f"'{field} description of the reported Balance or Date field'")
        value = f"COALESCE({fields[field]}, '{RAW_NULLS.get(field, 'ND')}')"
        out.append(
            f"CASE WHEN kind = 1 THEN {described} WHEN kind = 2 THEN NULL ELSE {value} END"
            f" AS `{RAW_HEADERS.get(field, field)}`"
        )
    out += ["CASE WHEN kind = 0 THEN 'x' END AS EXTRA1", "kind = 1 AS FirstRow"]
    # kinds first: fields that a query does not look at are then not made
    return _loan_periods(spark, sf_dir).selectExpr("*", f"explode({RAW_KIND}) AS kind").selectExpr(*out)


#: every 1201st loan begins a file with a description row, every 1301st follows a blank row
RAW_KIND = "CASE WHEN k % 1201 = 7 THEN array(0, 1) WHEN k % 1301 = 9 THEN array(0, 2) ELSE array(0) END"


def loan_tape_sql() -> str:
    """DuckDB common table expressions ending in ``tape`` (same content as :func:`loan_tape`)."""
    d = DIALECT["duckdb"]
    parts = [
        "orders0 AS (SELECT o_orderkey AS k, o_custkey AS custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,"
        " CAST(o_orderdate AS DATE) AS odate, n_nationkey AS nk FROM orders"
        " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)",
        "orders1 AS (SELECT *, unnest([0, 1, 2, 3, 4, 5]) AS p FROM orders0)",
        f"loan0 AS (SELECT *, {d['orig']} AS orig, {d['cutoff']} AS cutoff FROM orders1)",
    ]
    for i, stage in enumerate(LOAN_INTEGERS):
        cols = ", ".join(f"{_sql(rule, 'duckdb')} AS {name}" for name, rule in stage.items())
        parts.append(f"loan{i + 1} AS (SELECT *, {cols} FROM loan{i})")
    cols = ", ".join(f"{rule} AS {name}" for name, rule in loan_fields("duckdb").items())
    parts.append(f"tape AS (SELECT {cols} FROM loan{len(LOAN_INTEGERS)})")
    return ",\n".join(parts)


# ------------------------------------------------------------------ note tape

RAW_RATINGS = [
    "AAA", "Aa1", " AA ", "Aa3", "A+", "A2", "A-", "Baa1", "BBB", "BBB-", "Ba1", "BB", "BB-",
    "B1", "B", "B-", "CCC+", "Caa2", "CCC-", "XYZ", None, "NR",
]
NOTE_CLASSES = ["Class A", "Class B", "Class C", "Class D", "Class E", "Class F", "Class Z", "Class X1", "Class X2"]

NOTE_INTEGERS = [
    {
        "cls": "(k {div} 3) % 9",
        "bal": "cents * (1000 - 5 * p - 10 * (k % 7)) {div} 1000",
        "att": "CASE WHEN k % 409 = 6 THEN -1000 ELSE (k * 7) % 9000 END",
        "thick": "CASE WHEN k % 401 = 5 THEN -100 ELSE 100 + (k * 11) % 1500 END",
    },
    {"det": "CASE WHEN cls = 0 AND k % 2 = 0 THEN 10000 ELSE LEAST(10000, att + thick) END"},
]


def note_fields(dialect: str) -> dict[str, str]:
    """One note per order and month-end; a third of all notes sits in each of two deals."""
    fields = {
        "DealID": "CASE k % 3 WHEN 0 THEN 'AVON2' WHEN 1 THEN 'BLETCHLEY' ELSE 'DEAL' || CAST(custkey AS STRING) END",
        "NoteID": "'XS' || CAST(k AS STRING)",
        "TrancheID": _choice("cls", NOTE_CLASSES),
        "CutoffDate": "cutoff",
        "Rating": _choice("(k {div} 2 + p {div} 3) % 22", RAW_RATINGS),
        "Seniority": "CASE WHEN cls = 0 THEN 'senior' ELSE 'non-senior' END",
        "WAL": "CAST((k * 3) % 14 AS DOUBLE) / 2",
        "OriginalBalance": "CAST(CAST(cents AS DECIMAL(14,0)) * 0.01 AS DECIMAL(18,2))",
        "CurrentBalance": "CAST(CAST(bal AS DECIMAL(14,0)) * 0.01 AS DECIMAL(18,2))",
        "Attachment": "CAST(CAST(att AS DECIMAL(6,0)) * 0.0001 AS DECIMAL(9,4))",
        "Detachment": "CAST(CAST(det AS DECIMAL(6,0)) * 0.0001 AS DECIMAL(9,4))",
    }
    return {name: _sql(rule, dialect) for name, rule in fields.items()}


def note_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tranche positions per deal and cut-off date."""
    df = _periods(spark, sf_dir, False).selectExpr("*", f"{DIALECT['spark']['cutoff']} AS cutoff")
    for stage in NOTE_INTEGERS:
        df = df.selectExpr("*", *[f"{_sql(rule, 'spark')} AS {name}" for name, rule in stage.items()])
    return df.selectExpr(*[f"{rule} AS {name}" for name, rule in note_fields("spark").items()])


def note_tape_sql() -> str:
    """DuckDB common table expressions ending in ``notes`` (same content as :func:`note_tape`)."""
    parts = [
        "n0 AS (SELECT o_orderkey AS k, o_custkey AS custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,"
        " unnest([0, 1, 2, 3, 4, 5]) AS p FROM orders)",
        f"n1 AS (SELECT *, {DIALECT['duckdb']['cutoff']} AS cutoff FROM n0)",
    ]
    for i, stage in enumerate(NOTE_INTEGERS):
        cols = ", ".join(f"{_sql(rule, 'duckdb')} AS {name}" for name, rule in stage.items())
        parts.append(f"n{i + 2} AS (SELECT *, {cols} FROM n{i + 1})")
    cols = ", ".join(f"{rule} AS {name}" for name, rule in note_fields("duckdb").items())
    parts.append(f"notes AS (SELECT {cols} FROM n{len(NOTE_INTEGERS) + 1})")
    return ",\n".join(parts)


# ------------------------------------------------------------------ reported history

REPORTED_FIELDS = {
    "DealID": "CASE WHEN k % 2 = 0 THEN 'AVON2' ELSE 'BLETCHLEY' END",
    "Period": "substr(CAST(cutoff AS STRING), 1, 7)",
    "CutoffDate": "cutoff",
    "Source": "'Investor Report ' || CAST(custkey % 20 AS STRING)",
    "Delivery": "k",
    "Batch": "CASE WHEN k % 4 = 3 THEN 1 ELSE 0 END",
    "CurrentBalance": "CAST(CAST(cents * (1000 - k % 9) {div} 1000 AS DECIMAL(14,0)) * 0.01 AS DECIMAL(18,2))",
    "WA_Coupon": "CAST(150 + k % 450 AS DOUBLE) / 100",
    "WA_CurrentLTV": "CAST(5000 + k % 4000 AS DOUBLE) / 100",
    "WA_Seasoning_Months": "CAST(k % 240 AS DOUBLE)",
    "CPR_1m": "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k % 300 AS DOUBLE) / 10 END",
    "CPR_3m": "CAST(k % 290 AS DOUBLE) / 10",
    "CPR_12m": "CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 280 AS DOUBLE) / 10 END",
    "CDR_1m": "CAST(k % 50 AS DOUBLE) / 100",
    "CDR_Lifetime": "CAST(k % 30 AS DOUBLE) / 100",
    "CumLossSeverity": "CAST(k % 400 AS DOUBLE) / 10",
    "Pct_Delinquent_1m_plus": "CAST(k % 120 AS DOUBLE) / 10",
}


def reported_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported pool metrics; the same key is delivered again and again (``Delivery`` orders them)."""
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS k",
        "o_custkey AS custkey",
        "CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents",
        "last_day(CAST(o_orderdate AS DATE)) AS cutoff",
    )
    return _dealt(spark, sf_dir, df).selectExpr(*[f"{_sql(rule, 'spark')} AS {name}" for name, rule in REPORTED_FIELDS.items()])


def reported_history_sql() -> str:
    cols = ", ".join(f"{_sql(rule, 'duckdb')} AS {name}" for name, rule in REPORTED_FIELDS.items())
    return (
        "rep0 AS (SELECT o_orderkey AS k, o_custkey AS custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,"
        " last_day(CAST(o_orderdate AS DATE)) AS cutoff FROM orders),\n"
        f"reported AS (SELECT {cols} FROM rep0)"
    )


# ------------------------------------------------------------------ report pages


def _page_text(dialect: str) -> dict[str, str]:
    """File name and the text of the four pages of one report."""
    commas = lambda x: _call(dialect, "commas", x=x)
    money = lambda x: f"({commas(f'({x}) {{div}} 100')} || '.' || lpad(CAST(({x}) % 100 AS STRING), 2, '0'))"
    pct = lambda x: f"(CAST(CAST({x} AS DECIMAL(8,0)) * 0.01 AS STRING) || '%')"
    mon, day = _call(dialect, "mon", d="cutoff"), _call(dialect, "ddmonyyyy", d="cutoff")
    stamp = _call(dialect, "yyyymmdd", d="cutoff")
    tail = (
        "CASE WHEN k % 17 = 3 THEN ' DBRS' WHEN k % 19 = 4 THEN ' Rating update' ELSE '' END"
        " || ' no ' || CAST(k AS STRING) || '.pdf'"
    )
    name = (
        f"CASE WHEN k % 2 = 1 AND k % 5 = 1 THEN 'Bletchley Park IR'"
        f" WHEN k % 2 = 1 THEN 'Bletchley Park IR ' || {stamp}"
        f" WHEN k % 4 = 0 THEN 'Avon 2 IR ' || {stamp}"
        f" WHEN k % 10 = 6 THEN 'Avon 2 prospectus'"
        f" ELSE 'Avon 2 Monthly Report ' || {mon} || ' ' || CAST(year(cutoff) AS STRING) END || {tail}"
    )
    cover = (
        f"CASE k % 3 WHEN 0 THEN 'Investor Report{{nl}}Reporting Period End Date: ' || {day}"
        f" WHEN 1 THEN 'Issued for the period to ' || {day} ELSE 'Investor Report' END"
    )
    pool = (
        f"CASE WHEN k % 2 = 0 THEN 'Current Balance of Mortgage Loans ' || {money('cents * 997')}"
        f" || '{{nl}}Number of all Mortgage Loans ' || {commas('1000 + k % 9000')}"
        f" || '{{nl}}Weighted Average Loan to Value ' || {pct('5000 + k % 4000')}"
        f" || '{{nl}}Annualised CPR ' || {pct('k % 2000')}"
        f" || '{{nl}}Constant Principal Pre-payment Rate ' || {pct('k % 3 * 71')}"
        f" ELSE 'Outstanding Current Balance of the Portfolio GBP ' || {money('cents * 313')}"
        f" || '{{nl}}Weighted average current loan to value ' || {pct('5000 + k % 4000')}"
        f" || '{{nl}}Current CPR ' || {pct('k % 700')} || ' ' || {pct('k % 650')} END"
    )
    arrears = (
        f"CASE WHEN k % 2 = 1 THEN 'Current Months in Arrears{{nl}}>= 3 ' || CAST(k % 40 AS STRING) || ' 1.11% '"
        f" || {money('cents')} || ' ' || {pct('k % 300')}"
        f" WHEN k % 6 = 0 THEN '3.0 Months in Arrears ' || {money('cents')} || ' 12 ' || {pct('k % 90')}"
        f" || '{{nl}}4.0 Months in Arrears ' || {money('cents')} || ' 7 ' || {pct('k % 80')}"
        f" ELSE '> 6.0 Months in Arrears ' || {money('cents')} || ' 91 ' || {pct('k % 4 * 60')}"
        f" || '{{nl}}5.0 Months in Arrears ' || {money('cents')} || ' 7 ' || {pct('k % 70')} END"
    )
    notes = (
        f"CASE WHEN k % 8 = 2 THEN 'Notes{{nl}}Class A Notes XS GBP 1,000,000.00'"
        f" WHEN k % 2 = 0 THEN 'Note details{{nl}}Class A XS' || CAST(k % 1000 AS STRING) || ' ' || {money('66634500000')} || ' '"
        f" || {money('64818808184 - cents')} || ' GBP SONIA{{nl}}Class B XS ' || {money('3250400000')} || ' GBP'"
        f" ELSE 'Principal distributions, Ending Balance{{nl}}Class A 207,150,000 ' || {money('20700000000')} || ' '"
        f" || {money('cents {div} 10')} || ' ' || {money('20604981926 - cents')} || ' 0.'"
        f" || lpad(CAST(9000 + k % 1000 AS STRING), 4, '0') || '{{nl}}Class B 13,058,000' END"
    )
    pages = {"file_name": name, "cover": cover, "pool": pool, "arrears": arrears, "notes": notes}
    newline = "\\n" if dialect == "spark" else "' || chr(10) || '"
    return {key: _sql(rule.replace("{nl}", newline), dialect) for key, rule in pages.items()}


#: some reports begin with this many pages of other matter
_FRONT = "(CASE WHEN k % 7 = 5 THEN 10 ELSE 0 END)"
_PAGE_NO = (
    f"CASE page_no - {_FRONT} WHEN 1 THEN cover WHEN 2 THEN pool WHEN 3 THEN arrears WHEN 4 THEN notes"
    " ELSE 'Important notice' END"
)


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted page text of investor reports: one file per order, of four pages or fourteen."""
    text = _page_text("spark")
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS k",
        "CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents",
        "last_day(add_months(CAST(o_orderdate AS DATE), 6)) AS cutoff",
    )
    return (
        _dealt(spark, sf_dir, df).selectExpr(
            "k",
            "CASE WHEN k % 2 = 0 THEN 'AVON2' ELSE 'BLETCHLEY' END AS deal_id",
            *[f"{rule} AS {name}" for name, rule in text.items()],
        )
        .withColumn("page_no", F.explode(F.sequence(F.lit(1), F.expr(f"4 + {_FRONT}"))))
        .selectExpr("deal_id", "file_name", "page_no", f"{_PAGE_NO} AS text")
    )


def report_pages_sql() -> str:
    cols = ", ".join(f"{rule} AS {name}" for name, rule in _page_text("duckdb").items())
    return (
        "rp0 AS (SELECT o_orderkey AS k, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,"
        " last_day(CAST(CAST(o_orderdate AS DATE) + to_months(6) AS DATE)) AS cutoff FROM orders),\n"
        f"rp1 AS (SELECT k, CASE WHEN k % 2 = 0 THEN 'AVON2' ELSE 'BLETCHLEY' END AS deal_id, {cols},"
        f" unnest(range(1, 5 + {_FRONT})) AS page_no FROM rp0),\n"
        f"report_pages AS (SELECT deal_id, file_name, page_no, {_PAGE_NO} AS text FROM rp1)"
    )
