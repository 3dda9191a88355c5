"""Queries on sources, staging, conformed tables and controls."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from mortar.functions import casts, dates
from mortar.operators import conform as cf
from mortar.operators import controls, marts, prep, reports, star
from mortar.plans.frames import Frames, present
from mortar.plans.registry import register
from mortar.plans.sqltext import AREAS, DIM, EXITS, FACT, LOANS, PAGES, REFS, STAR, TAPE, conformed, d, n, prep_label, query, r, shown, values
from mortar.session import shuffles_removed, work_folder
from mortar.sources import seeds
from mortar.sources import tape as tp
from mortar.sources.sample_tape import LOAN_FIELDS, RAW_NULLS
from mortar.streaming import upsert as stream
from mortar.streaming.keyed_state import KeyedState

# ------------------------------------------------------------------ staging

register("stage_tape", lambda x: tp.stage_tape(x.raw()), query(f"SELECT {', '.join(LOAN_FIELDS)} FROM tape", TAPE))

register(
    "stage_drop_description_rows",
    lambda x: tp.description_rows(x.raw()),
    query(
        "SELECT DealID, count(*) * 6 + sum(extra) * 6 AS RawRows, count(*) * 6 + sum(blank) * 6 AS KeptRows FROM loans1 GROUP BY DealID",
        "loans1 AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'AVON2' ELSE 'BLETCHLEY' END AS DealID,"
        " CASE WHEN o_orderkey % 1201 = 7 OR o_orderkey % 1301 = 9 THEN 1 ELSE 0 END AS extra,"
        " CASE WHEN o_orderkey % 1201 <> 7 AND o_orderkey % 1301 = 9 THEN 1 ELSE 0 END AS blank FROM orders)",
    ).replace("count(*) * 6 + sum(extra) * 6", n("count(*) * 6 + sum(extra) * 6")).replace(
        "count(*) * 6 + sum(blank) * 6", n("count(*) * 6 + sum(blank) * 6")
    ),
)


def _tape_from_files(x: Frames):
    """The raw tape written as files of three layouts, read by header name and staged."""
    folder = work_folder(x.spark, "tapes")
    raw = x.raw().filter("NOT FirstRow").drop("FirstRow")
    part = F.pmod(F.xxhash64("AR3 Loan Identifier", "AR1"), F.lit(3))
    layouts = {
        "as-made": (part == 0, raw.columns),
        "reversed": ((part == 1) | ((part == 2) & (F.col("DealID") != "AVON2")), raw.columns[::-1]),
        "one-field-less": ((part == 2) & (F.col("DealID") == "AVON2"), [c for c in raw.columns if c != "AR123"]),
    }
    paths = [f"{folder}/{name}" for name in layouts]
    with shuffles_removed(x.spark):
        for path, (rows, columns) in zip(paths, layouts.values()):
            tp.write_csv(raw.filter(rows).select(*[F.col(f"`{c}`") for c in columns]), path, "gzip")
    return tp.stage_tape(tp.read_tape(x.spark, paths, "*.csv.gz"))


register("read_tape_files", _tape_from_files, query(f"SELECT {', '.join(LOAN_FIELDS)} FROM tape", TAPE))


def _malformed(x: Frames):
    """Tape rows of which some have a cell too many, written without quotes and read back."""
    folder = work_folder(x.spark, "malformed")
    extra = F.when(F.col("AR3").cast("bigint") % 50 == 0, "SERV,more").otherwise("SERV")
    rows = x.tape().select("DealID", "AR1", "AR3", extra.alias("AR6"))
    rows.write.option("header", True).option("quote", "").csv(folder)
    read = tp.read_tape(x.spark, folder, "*.csv")
    return present(
        read.groupBy("DealID").agg(
            F.count("*").alias("Rows"), F.count_if(F.col(tp.MALFORMED).isNotNull()).alias("MalformedRows")
        )
    )


register(
    "control_malformed_rows",
    _malformed,
    query(
        f"SELECT DealID, count(*) AS Rows, {n('count(CASE WHEN CAST(AR3 AS BIGINT) % 50 = 0 THEN 1 END)')} AS MalformedRows"
        " FROM tape GROUP BY DealID",
        TAPE,
    ),
)


def _tape_files(x: Frames):
    """Files the tapes came in: one per deal and month, the last month of one pool was sent again."""
    again = (F.col("AR2") == "POOL0") & (F.col("AR1") == "2002-02-28")
    kind = F.when(F.col("DealID") == "AVON2", "Data_Tape").otherwise("boe_tape")
    version = F.when(again, "_v2").otherwise("")
    name = F.concat("DealID", F.lit("_"), kind, F.lit("_"), F.substring("AR1", 1, 7), version, F.lit(".xlsx"))
    return x.tape().select("DealID", F.substring("AR1", 1, 7).alias("period"), name.alias("file_name")).distinct()


register(
    "source_registry_check",
    lambda x: tp.registry_check(seeds.deals(x.spark), _tape_files(x)),
    query(
        "SELECT g.DealID, g.status, f.period, count(CASE WHEN f.file_name GLOB g.pattern THEN 1 END) AS matches,"
        " CASE WHEN g.status <> 'active' THEN 'inactive'"
        "  WHEN count(CASE WHEN f.file_name GLOB g.pattern THEN 1 END) = 0 THEN 'no tape'"
        "  WHEN count(CASE WHEN f.file_name GLOB g.pattern THEN 1 END) > 1 THEN 'ambiguous' ELSE 'ok' END AS verdict"
        " FROM registry g LEFT JOIN files f ON g.DealID = f.DealID GROUP BY g.DealID, g.status, f.period",
        TAPE,
        values("registry", "DealID, status, pattern", [(row[0], row[4], row[5]) for row in seeds.DEALS]),
        "files AS (SELECT DISTINCT DealID, substr(AR1, 1, 7) AS period, DealID || '_' ||"
        " CASE WHEN DealID = 'AVON2' THEN 'Data_Tape' ELSE 'boe_tape' END || '_' || substr(AR1, 1, 7) ||"
        " CASE WHEN AR2 = 'POOL0' AND AR1 = '2002-02-28' THEN '_v2' ELSE '' END || '.xlsx' AS file_name FROM tape)",
    ),
)


def _staging_roundtrip(x: Frames):
    """Stage one half of all fields, append the other, replace one deal's slice, read back and count."""
    path = work_folder(x.spark, "staging")
    fields = LOAN_FIELDS[1:]
    rows = x.tape().withColumn("half", F.pmod(F.xxhash64("AR3", "AR1"), F.lit(2)))
    tp.write_staging(rows.filter("half = 0").drop("half"), path)
    tp.write_staging(rows.filter("half = 1").drop("half"), path, append=True)
    tp.write_staging(rows.filter("DealID = 'AVON2'").drop("half"), path)
    back = tp.read_staging(x.spark, path, fields)
    return present(
        back.groupBy("DealID", "AR1").agg(
            F.count("*").alias("Rows"), F.count("AR3").alias("Loans"), F.sum(casts.money(F.col("AR67"))).alias("Balance")
        )
    )


register(
    "staging_roundtrip",
    _staging_roundtrip,
    query(
        f"SELECT DealID, AR1, count(*) AS Rows, count(AR3) AS Loans, {d('sum(CAST(AR67 AS DECIMAL(18,2)))')} AS Balance"
        " FROM tape GROUP BY DealID, AR1",
        TAPE,
    ),
)

for _name, _field in seeds.REF_FIELDS.items():

    def _usage(x: Frames, name=_name, field=_field):
        """The code list with the number of tape rows that carry each code."""
        used = x.tape().groupBy(field).agg(F.count("*").alias("TapeRows"))
        ref = seeds.ref_table(x.spark, name)
        joined = ref.join(used, F.col("code") == F.col(field), "left")
        return joined.select("code", "label", F.coalesce("TapeRows", F.lit(0)).alias("TapeRows"))

    register(
        f"ref_{_name}",
        _usage,
        query(
            f"SELECT code, label, count({_field}) AS TapeRows FROM ref_{_name} LEFT JOIN tape ON code = {_field} GROUP BY code, label",
            TAPE,
            REFS,
        ),
    )

#: the same loans with their region spelled as a postcode, a region code or rubbish
_SPELLED = ["SW1A 2AA", "M15", "L1 8JQ", "EH3", "UKI", "ZZ9"]


def _spelled(x: Frames):
    words = F.array(*[F.lit(w) for w in _SPELLED])
    at = F.pmod(F.coalesce(F.col("AR3").cast("bigint"), F.lit(6)), F.lit(7)).cast("int")
    return x.tape().withColumn("AR128", F.when(at < 6, F.get(words, at)).otherwise(F.col("AR128")))


_SPELLED_SQL = (
    "spelled AS (SELECT DealID, CASE COALESCE(CAST(AR3 AS BIGINT), 6) % 7 "
    + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_SPELLED))
    + " ELSE AR128 END AS AR128 FROM tape),\n"
    "placed AS (SELECT s.DealID, s.AR128, COALESCE(a.region_code, s.AR128) AS RegionCode FROM spelled s"
    " LEFT JOIN areas a ON a.area = regexp_extract(upper(s.AR128), '^([A-Z]{1,2})', 1))"
)

register(
    "region_from_postcode",
    lambda x: cf.region_from_postcode(_spelled(x), "AR128")
    .groupBy("DealID", "AR128", "RegionCode", "Region").agg(F.count("*").alias("TapeRows")),
    query(
        "SELECT p.DealID, p.AR128, p.RegionCode, g.label AS Region, count(*) AS TapeRows FROM placed p"
        " LEFT JOIN ref_region g ON p.RegionCode = g.code GROUP BY ALL",
        TAPE, REFS, AREAS, _SPELLED_SQL,
    ),
)
register(
    "ref_postcode_to_region",
    lambda x: seeds.ref_table(x.spark, "postcode_to_region").join(
        _spelled(x).groupBy(F.regexp_extract(F.upper("AR128"), r"^([A-Z]{1,2})", 1).alias("postcode_area"))
        .agg(F.count("*").alias("TapeRows")),
        "postcode_area", "left",
    ).select("postcode_area", "region_code", F.coalesce("TapeRows", F.lit(0)).alias("TapeRows")),
    query(
        "SELECT area AS postcode_area, region_code, count(AR128) AS TapeRows FROM areas LEFT JOIN spelled"
        " ON area = regexp_extract(upper(AR128), '^([A-Z]{1,2})', 1) GROUP BY area, region_code",
        TAPE, AREAS, _SPELLED_SQL,
    ),
)

# ------------------------------------------------------------------ conform

for _fmt in cf.FORMATS:
    _short = {"AVON2": "avon", "BLETCHLEY": "bletchley"}[_fmt.deal_id]
    register(
        f"conform_{_short}_dim_loan",
        lambda x, fmt=_fmt: present(cf.conform_dim_loan(x.tape(), fmt)),
        query(
            f"SELECT {shown(cf.DIM_PLAIN, cf.DIM_DECODED)} FROM c", TAPE, REFS,
            conformed("c", _fmt, cf.DIM_PLAIN, cf.DIM_DECODED, True),
        ),
    )
    register(
        f"conform_{_short}_fact_loan_period",
        lambda x, fmt=_fmt: present(cf.conform_fact_loan_period(x.tape(), fmt)),
        query(
            f"SELECT {shown(cf.FACT_PLAIN, cf.FACT_DECODED)} FROM c", TAPE, REFS,
            conformed("c", _fmt, cf.FACT_PLAIN, cf.FACT_DECODED, False),
        ),
    )

register(
    "conform_extended_dim",
    lambda x: present(
        cf.conform_extended_dim(x.tape(), *cf.FORMATS)
    ),
    query(
        " UNION ALL ".join(
            f"SELECT {shown({**cf.DIM_PLAIN, **cf.DIM_EXTENDED_PLAIN}, cf.DIM_DECODED + cf.DIM_EXTENDED_DECODED)} FROM {c}"
            for c in ("ca", "cb")
        ),
        TAPE, REFS,
        *[
            conformed(c, f, {**cf.DIM_PLAIN, **cf.DIM_EXTENDED_PLAIN}, cf.DIM_DECODED + cf.DIM_EXTENDED_DECODED, True)
            for c, f in (("ca", cf.AVON), ("cb", cf.BLETCHLEY))
        ],
    ),
)

#: a third deal described as a row: rates in basis points, origination by quarter, no index, no flag of bankruptcy
_THIRD = cf.DealFormat(
    "CASTLE", Decimal("0.0001"), quarter_dates=True, absent=frozenset({"AR108", "AR145", "AR36"}), keep_null_ids=True
)
_THREE = (*cf.FORMATS, _THIRD)


def _three_deals(x: Frames):
    """The tape with one pool of BLETCHLEY as a deal of its own, spelled in its own way."""
    third = (F.col("DealID") == "BLETCHLEY") & (F.col("AR2") == "POOL2")
    start = F.col("AR55").try_cast("date")
    spelled = {
        "DealID": F.lit("CASTLE"),
        "AR55": F.concat(F.lit("Q"), F.quarter(start).cast("string"), F.lit("-"), F.year(start).cast("string")),
        **{c: (F.col(c).try_cast("decimal(18,4)") * 10000).cast("string") for c in ("AR109", "AR110")},
    }
    return x.tape().withColumns({c: F.when(third, v).otherwise(F.col(c)) for c, v in spelled.items()})


_SPELL = "CASE WHEN DealID = 'BLETCHLEY' AND AR2 = 'POOL2' THEN {} ELSE {} END AS {}"
_THREE_SQL = (
    "tape3 AS (SELECT * REPLACE ("
    + ", ".join(
        _SPELL.format(v, c, c)
        for c, v in {
            "DealID": "'CASTLE'",
            "AR55": "'Q' || quarter(TRY_CAST(AR55 AS DATE)) || '-' || year(TRY_CAST(AR55 AS DATE))",
            "AR109": "CAST(TRY_CAST(AR109 AS DECIMAL(18,4)) * 10000 AS VARCHAR)",
            "AR110": "CAST(TRY_CAST(AR110 AS DECIMAL(18,4)) * 10000 AS VARCHAR)",
        }.items()
    )
    + ") FROM tape)"
)
for _name, _build, _plain, _decoded, _latest in (
    ("conform_generic", cf.conform_fact_loan_period_by_table, cf.FACT_PLAIN, cf.FACT_DECODED, False),
    ("conform_generic_dim_loan", cf.conform_dim_loan_by_table, cf.DIM_PLAIN, cf.DIM_DECODED, True),
):
    register(
        _name,
        lambda x, build=_build: present(build(_three_deals(x), cf.format_table(x.spark, _THREE))),
        query(
            " UNION ALL ".join(f"SELECT {shown(_plain, _decoded)} FROM c{i}" for i in range(len(_THREE))),
            TAPE, REFS, _THREE_SQL,
            *[
                conformed(f"c{i}", f, _plain, _decoded, _latest).replace("FROM tape ", "FROM tape3 ")
                for i, f in enumerate(_THREE)
            ],
        ),
    )


def _cast_sql() -> str:
    arms = []
    for name, (field, kind) in cf.CAST_FIELDS.items():
        failed = " OR ".join(
            f"(t.DealID = '{f.deal_id}' AND {_typed_sql(field, kind, f)} IS NULL)" for f in cf.FORMATS
        )
        arms.append(
            f"SELECT DealID, '{name}' AS ColumnName, count({field}) AS Delivered,"
            f" count(CASE WHEN {field} IS NOT NULL AND ({failed}) THEN 1 END) AS Failed FROM tape t GROUP BY DealID"
        )
    return " UNION ALL ".join(arms)


def _typed_sql(field: str, kind: str, fmt) -> str:
    from mortar.plans.sqltext import typed

    return typed(field, kind, fmt)


register("safe_casts", lambda x: cf.cast_failures(x.tape()), query(_cast_sql(), TAPE))

def _decoded(x: Frames):
    """Codes counted first, then decoded by join: the join sees one row per combination."""
    codes = x.tape().select("DealID", *[F.col(f).alias(f"{c}_code") for c, f, _ in cf.FACT_DECODED])
    rows = codes.groupBy(*codes.columns).agg(F.count("*").alias("n"))
    for name, _, ref in cf.FACT_DECODED:
        rows = cf.decode_join(rows, f"{name}_code", seeds.ref_table(x.spark, ref), name)
    return rows.groupBy("DealID", *[c for c, _, _ in cf.FACT_DECODED]).agg(F.sum("n").alias("Rows"))


register(
    "decode_codes",
    _decoded,
    query(
        "SELECT t.DealID, " + ", ".join(f"r{i}.label AS {c}" for i, (c, _, _) in enumerate(cf.FACT_DECODED))
        + ", count(*) AS Rows FROM tape t "
        + " ".join(f"LEFT JOIN ref_{ref} r{i} ON t.{f} = r{i}.code" for i, (_, f, ref) in enumerate(cf.FACT_DECODED))
        + " GROUP BY ALL",
        TAPE, REFS,
    ),
)
register(
    "prep_decode_defaults",
    lambda x: x.loans().groupBy("DealID", *prep.DECODED).agg(F.count("*").alias("Rows")),
    query(
        "SELECT DealID, " + ", ".join(f"{prep_label(f, ls, dflt)} AS {c}" for c, (f, ls, dflt) in prep.DECODED.items())
        + ", count(*) AS Rows FROM tape WHERE AR3 IS NOT NULL GROUP BY ALL",
        TAPE,
    ),
)

_TAPE_COLUMNS = ["AR1", "AR55", "AR66", "AR67", "AR135", "AR166"]
register(
    "latest_per_loan",
    lambda x: cf.latest_per_loan(x.tape()).select("DealID", "AR3", "AR8", *_TAPE_COLUMNS),
    query(
        f"SELECT DealID, AR3, AR8, {', '.join(_TAPE_COLUMNS)} FROM tape QUALIFY row_number() OVER (PARTITION BY DealID, AR3"
        " ORDER BY AR1 DESC, " + ", ".join(f"{c} NULLS LAST" for c in cf.TIE_BREAK) + ") = 1",
        TAPE,
    ),
)
register(
    "dim_loan", lambda x: present(x.dim()), query(f"SELECT {shown(cf.DIM_PLAIN, cf.DIM_DECODED)} FROM dim", TAPE, DIM)
)
register(
    "fact_loan_period",
    lambda x: present(x.fact()),
    query(f"SELECT {shown(cf.FACT_PLAIN, cf.FACT_DECODED)} FROM fact", TAPE, REFS, FACT),
)
register(
    "star_join",
    lambda x: present(
        x.star(*marts.STAR_COLUMNS).select("DealID", "LoanID", "CutoffDate", "CurrentBalance", *marts.STAR_COLUMNS)
    ),
    query(
        f"SELECT DealID, LoanID, CutoffDate, {d('CurrentBalance')} AS CurrentBalance, Region, OccupancyType,"
        " RepaymentMethod, LoanOriginationDate FROM star",
        TAPE, STAR,
    ),
)

# ------------------------------------------------------------------ controls

_EXC = "SELECT '{check}' AS check_name, DealID, '0' AS expected, CAST(count(*) AS VARCHAR) AS actual, '{text}' AS difference"
CONTROL_SQL = {
    "control_row_count": "SELECT 'ROW_COUNT_MISMATCH' AS check_name, s.DealID, CAST(s.n AS VARCHAR) AS expected,"
    " CAST(c.n AS VARCHAR) AS actual, CAST(s.n - c.n AS VARCHAR) AS difference FROM"
    " (SELECT DealID, count(*) AS n FROM (SELECT DISTINCT DealID, AR3 FROM tape) GROUP BY DealID) s"
    " LEFT JOIN (SELECT DealID, count(*) AS n FROM dim GROUP BY DealID) c ON s.DealID = c.DealID"
    " WHERE s.n <> COALESCE(c.n, 0)",
    "control_balance": "SELECT 'BALANCE_MISMATCH' AS check_name, s.DealID, CAST(s.b AS VARCHAR) AS expected,"
    " CAST(m.b AS VARCHAR) AS actual, CAST(s.b - m.b AS VARCHAR) AS difference FROM"
    " (SELECT DealID, sum(TRY_CAST(AR67 AS DECIMAL(18,2))) AS b FROM tape GROUP BY DealID) s"
    " JOIN (SELECT DealID, sum(CurrentBalance) AS b FROM fact GROUP BY DealID) m ON s.DealID = m.DealID"
    " WHERE abs(s.b - m.b) > 0.01",
    "control_null_loan_id": _EXC.format(check="NULL_LOAN_ID", text="LoanID should not be NULL")
    + " FROM dim WHERE LoanID IS NULL GROUP BY DealID",
    "control_null_balance": _EXC.format(check="NULL_BALANCE", text="CurrentBalance should not be NULL")
    + " FROM fact WHERE CurrentBalance IS NULL GROUP BY DealID",
    "control_orphans": _EXC.format(check="ORPHAN_FACT_ROWS", text="fact rows with no matching dim")
    + " FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim l WHERE l.DealID = f.DealID AND l.LoanID = f.LoanID) GROUP BY DealID",
    "control_negative_balance": _EXC.format(check="NEGATIVE_BALANCE", text="Loans with negative balance")
    + " FROM fact WHERE CurrentBalance < 0 GROUP BY DealID",
}
_CONTROLS = {
    "control_row_count": lambda x: controls.control_row_count(x.tape(), x.dim()),
    "control_balance": lambda x: controls.control_balance(x.tape(), x.fact()),
    "control_null_loan_id": lambda x: controls.control_null_loan_id(x.dim()),
    "control_null_balance": lambda x: controls.control_null_balance(x.fact()),
    "control_orphans": lambda x: controls.control_orphans(x.fact(), x.dim()),
    "control_negative_balance": lambda x: controls.control_negative_balance(x.fact()),
}
for _name, _build in _CONTROLS.items():
    register(_name, _build, query(CONTROL_SQL[_name], TAPE, DIM, FACT))
register(
    "controls_all",
    lambda x: controls.controls_all(x.tape(), x.dim(), x.fact()),
    query(" UNION ALL ".join(f"({sql})" for sql in CONTROL_SQL.values()), TAPE, DIM, FACT),
)
register(
    "control_row_count_as_coded",
    lambda x: controls.control_row_count(x.tape(), x.dim(), distinct_loans=False),
    query(CONTROL_SQL["control_row_count"].replace("SELECT DISTINCT DealID, AR3", "SELECT DealID, AR3"), TAPE, DIM),
)
register(
    "control_unique_keys",
    lambda x: controls.control_unique_keys(x.fact(), ["DealID", "LoanID", "CutoffDate"], "fact_loan_period").unionByName(
        controls.control_unique_keys(x.dim(), ["DealID", "LoanID"], "dim_loan")
    ),
    query(
        "SELECT 'DUPLICATE_KEY' AS check_name, DealID, '0' AS expected, CAST(count(*) AS VARCHAR) AS actual,"
        " 'duplicate DealID, LoanID, CutoffDate in fact_loan_period' AS difference FROM"
        " (SELECT DealID FROM fact GROUP BY DealID, LoanID, CutoffDate HAVING count(*) > 1) GROUP BY DealID"
        " UNION ALL SELECT 'DUPLICATE_KEY', DealID, '0', CAST(count(*) AS VARCHAR),"
        " 'duplicate DealID, LoanID in dim_loan' FROM"
        " (SELECT DealID FROM dim GROUP BY DealID, LoanID HAVING count(*) > 1) GROUP BY DealID",
        TAPE, DIM, FACT,
    ),
)

# ------------------------------------------------------------------ curated loans and exits

_LOAN_MONEY = (
    "PrimaryIncome OrigBalance CurrentBalance PaymentDue OrigValuation CurrentValuation ArrearsBalance"
    " PrepayAmountMonth CumulativePrepay"
).split()
_LOAN_DOUBLE = "OrigTermMonths CurrentRate Margin OrigLTV CurrentLTV MonthsInArrears CurrentLTV_pct OrigLTV_pct".split()
_LOAN_COUNT = "SeasoningMonths RemainingTermMonths VintageYear IsDelinquent IsSeriousArrears".split()
register(
    "prep_loans",
    lambda x: present(
        prep.prep_loans(
            x.tape().withColumn("TapeID", F.concat("DealID", F.lit("_"), F.substring("AR1", 1, 7))), ["TapeID"]
        )
    ),
    query(
        "SELECT * REPLACE ("
        + ", ".join(
            [f"{d(c)} AS {c}" for c in _LOAN_MONEY]
            + [f"{r(c)} AS {c}" for c in _LOAN_DOUBLE]
            + [f"{n(c)} AS {c}" for c in _LOAN_COUNT]
        )
        + ") FROM loans",
        TAPE, LOANS,
    ),
)
register(
    "prep_exits",
    lambda x: present(x.exits()),
    query(
        "SELECT * REPLACE ("
        + ", ".join(f"{d(c)} AS {c}" for c in ("DefaultBalance", "SalePrice", "LossOnSale"))
        + f", {r('LossSeverity')} AS LossSeverity, {r('RecoveryRate')} AS RecoveryRate,"
        f" {n('IsDefault')} AS IsDefault, {n('IsRedemption')} AS IsRedemption) FROM exits",
        TAPE, EXITS,
    ),
)
_EXIT_MONEY = "DefaultAmount SalePrice LossOnSale CumulativeRecoveries".split()
register(
    "exits_view",
    lambda x: present(prep.exits_view(x.fact())),
    query(
        "SELECT DealID, LoanID, CutoffDate, AccountStatus, DateOfDefault, RedemptionDate, "
        + ", ".join(f"{d(c)} AS {c}" for c in _EXIT_MONEY)
        + f", {d('LossOnSale - CumulativeRecoveries')} AS NetLoss, CASE WHEN DefaultAmount > 0 THEN"
        f" {r(d('LossOnSale - CumulativeRecoveries') + ' / ' + d('DefaultAmount'))} END AS LossSeverity"
        " FROM fact WHERE DefaultAmount > 0 OR RedemptionDate IS NOT NULL",
        TAPE, REFS, FACT,
    ),
)

# ------------------------------------------------------------------ scalar functions over whole columns

register(
    "parse_orig_date",
    lambda x: x.tape().groupBy(
        "DealID", dates.parse_origination(F.col("AR55")).alias("MidQuarter"),
        dates.quarter_end(F.col("AR55")).alias("QuarterEnd"),
    ).agg(F.count("*").alias("Rows")),
    query(
        "SELECT DealID, CASE WHEN AR55 LIKE 'Q%' THEN make_date(CAST(right(AR55, 4) AS INT),"
        " CAST(substr(AR55, 2, 1) AS INT) * 3 - 1, 1) ELSE TRY_CAST(AR55 AS DATE) END AS MidQuarter,"
        " CASE WHEN AR55 LIKE 'Q%' THEN last_day(make_date(CAST(right(AR55, 4) AS INT),"
        " CAST(substr(AR55, 2, 1) AS INT) * 3, 1)) END AS QuarterEnd, count(*) AS Rows FROM tape GROUP BY ALL",
        TAPE,
    ),
)
register(
    "parse_number",
    lambda x: present(
        x.pages().select("deal_id", F.explode(F.split("text", r"\s+")).alias("word"))
        .filter(casts.may_be_figure(F.col("word")))  # the others need no counting
        .groupBy("deal_id", "word").agg(F.count("*").alias("Words"))
        .select("deal_id", "word", "Words", casts.parse_number(F.col("word")).alias("Value"))
        .filter("Value IS NOT NULL"), Value=4,
    ),
    query(
        "SELECT deal_id, word, count(*) AS Words, round_even(TRY_CAST(replace(replace(replace(replace(word, ',', ''), '%', ''),"
        " '£', ''), 'GBP', '') AS DOUBLE), 4) AS Value FROM"
        " (SELECT deal_id, unnest(regexp_split_to_array(text, '\\s+')) AS word FROM report_pages)"
        " WHERE TRY_CAST(replace(replace(replace(replace(word, ',', ''), '%', ''), '£', ''), 'GBP', '') AS DOUBLE) IS NOT NULL"
        " AND word NOT IN ('', 'N/A', 'null', '-') GROUP BY ALL",
        PAGES,
    ),
)
register(
    "date_table",
    lambda x: prep.month_calendar(x.spark).join(
        x.loans().groupBy(F.trunc("OrigDate", "month").alias("Date")).agg(F.count("*").alias("LoanRows")), "Date", "left"
    ).select(
        "Date", F.col("Year").cast("bigint").alias("Year"), "Quarter", F.col("Month").cast("bigint").alias("Month"),
        "MonthName", "YearMonth", F.coalesce("LoanRows", F.lit(0)).alias("LoanRows"),
    ),
    query(
        "SELECT CAST(m AS DATE) AS Date, CAST(year(m) AS BIGINT) AS Year, 'Q' || quarter(m) AS Quarter,"
        " CAST(month(m) AS BIGINT) AS Month, strftime(m, '%b') AS MonthName, strftime(m, '%Y-%m') AS YearMonth,"
        " count(LoanID) AS LoanRows FROM"
        " (SELECT unnest(generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '2030-12-01', INTERVAL 1 MONTH)) AS m)"
        " LEFT JOIN loans ON date_trunc('month', OrigDate) = m GROUP BY m",
        TAPE, LOANS,
    ),
)


# ------------------------------------------------------------------ stream


def _stream_upsert(x: Frames):
    """Orders arrive in several files, one a batch, become loan rows and are merged by key; the result is summed up."""
    log, checkpoint = work_folder(x.spark, "tape-log"), work_folder(x.spark, "tape-checkpoint")
    orders, arrived = x.spark.read.parquet(f"{x.sf_dir}/orders.parquet"), work_folder(x.spark, "arrived")
    orders.repartition(4, "o_orderdate").write.parquet(arrived)
    source = x.spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    deal = F.when(F.col("o_orderkey") % 2 == 0, "AVON2").otherwise("BLETCHLEY")
    rows = source.select(
        deal.alias("DealID"), F.col("o_custkey").alias("BorrowerID"), F.col("o_orderkey").alias("Delivery"),
        F.last_day("o_orderdate").alias("CutoffDate"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("Cents"),
    )
    stream.land_batches(rows, log, checkpoint)
    current = stream.current_rows(x.spark, log, ["DealID", "BorrowerID", "CutoffDate"], "Delivery", by_batch=False)
    return current.groupBy("DealID", "CutoffDate").agg(F.count("*").alias("Rows"), F.sum("Cents").alias("Cents"))


def _stream_state(x: Frames):
    """The same from streaming state: half of the files, a fold, then the rest with the first half delivered again."""
    orders, arrived = x.spark.read.parquet(f"{x.sf_dir}/orders.parquet"), work_folder(x.spark, "arrived")
    deal = F.when(F.col("o_orderkey") % 2 == 0, "AVON2").otherwise("BLETCHLEY")
    rows = orders.select(
        deal.alias("DealID"), F.col("o_custkey").alias("BorrowerID"), F.last_day("o_orderdate").alias("CutoffDate"),
        F.col("o_orderkey").alias("Delivery"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("Cents"),
    )
    late = F.pmod(F.xxhash64("Delivery"), F.lit(2)) == 0
    state = KeyedState(work_folder(x.spark, "state"), ["DealID", "BorrowerID", "CutoffDate"], ["Delivery"])
    rows.filter(~late).repartition(2, "CutoffDate").write.parquet(arrived)
    source = x.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    state.run(source)
    state.fold(x.spark, rows.schema)
    rows.repartition(2, "Delivery").write.mode("append").parquet(arrived)
    state.run(source)
    return state.current(x.spark, rows.schema).groupBy("DealID", "CutoffDate").agg(
        F.count("*").alias("Rows"), F.sum("Cents").alias("Cents")
    )


for _name, _build in (("stream_tape_upsert", _stream_upsert), ("stream_keyed_state", _stream_state)):
    register(
        _name,
        _build,
        "SELECT DealID, CutoffDate, count(*) AS Rows, CAST(sum(Cents) AS BIGINT) AS Cents FROM (SELECT"
        " CASE WHEN o_orderkey % 2 = 0 THEN 'AVON2' ELSE 'BLETCHLEY' END AS DealID, o_custkey,"
        " last_day(CAST(o_orderdate AS DATE)) AS CutoffDate, CAST(round(o_totalprice * 100) AS BIGINT) AS Cents, o_orderkey"
        " FROM orders QUALIFY row_number() OVER (PARTITION BY DealID, o_custkey, CutoffDate ORDER BY o_orderkey DESC) = 1)"
        " GROUP BY DealID, CutoffDate",
    )
