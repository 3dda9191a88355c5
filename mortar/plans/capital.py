"""Queries on risk weights, tranches, structures and deals."""

from __future__ import annotations

from pyspark.sql import functions as F

from mortar.operators import marts, rwa, star
from mortar.plans.frames import Frames, present
from mortar.plans.loans import G, POOL_SUMMARY_COLUMNS
from mortar.plans.registry import register
from mortar.plans.sqltext import NOTES, STAR, TAPE, d, hd, he, query, r, ratio, values
from mortar.session import work_folder
from mortar.sources import seeds
from mortar.sources.ordered import read_ordered, write_ordered

_SPELLINGS = values("spellings", "raw, canonical", seeds.rating_spellings().items())


def _weights(name: str, table: list[tuple]) -> str:
    rows = [(x[0], "senior", x[1], x[2]) for x in table] + [(x[0], "non-senior", x[3], x[4]) for x in table]
    return values(name, "Rating, Seniority, rw1, rw5", rows)


LIBRARY = _weights("library_weights", seeds.LIBRARY_WEIGHTS)
EXPORT = _weights("export_weights", seeds.EXPORT_WEIGHTS)


def _between(years: str) -> str:
    rw1, rw5 = d("rw1"), d("rw5")
    return f"(CASE WHEN {years} <= 1 THEN {rw1} WHEN {years} >= 5 THEN {rw5} ELSE {rw1} + ({rw5} - {rw1}) * ({years} - 1) / 4 END)"


WEIGHED = f"""rated AS (SELECT t.*, {d('t.Detachment')} - {d('t.Attachment')} AS Thickness, w.rw1, w.rw5
 FROM notes t LEFT JOIN spellings s ON trim(t.Rating) = s.raw
 LEFT JOIN library_weights w ON s.canonical = w.Rating AND t.Seniority = w.Seniority),
weighed AS (SELECT *, CASE WHEN rw1 IS NULL THEN 12.5 ELSE {he(f'''GREATEST(0.15, {_between('WAL')} *
 CASE WHEN Seniority = 'non-senior' AND Thickness < 0.10 THEN 1 + (0.10::DOUBLE - Thickness) * 2 ELSE 1 END)''', 4)} END AS RiskWeight FROM rated),
amounts AS (SELECT * EXCLUDE (rw1, rw5), CurrentBalance * CAST(RiskWeight AS DECIMAL(9,4)) AS RWA FROM weighed),
tranches AS (SELECT *, RWA * 0.08 AS Capital FROM amounts)"""
PARTS = (NOTES, _SPELLINGS, LIBRARY, WEIGHED)
_MONEY = "OriginalBalance CurrentBalance Attachment Detachment".split()


def _tranches(x: Frames):
    return rwa.rwa_tranche(x.notes())


register(
    "rating_normalise",
    lambda x: x.notes().groupBy("Rating", rwa.normalise_rating(F.col("Rating")).alias("Canonical")).agg(F.count("*").alias("Notes")),
    query(
        "SELECT t.Rating, s.canonical AS Canonical, count(*) AS Notes FROM notes t LEFT JOIN spellings s"
        " ON trim(t.Rating) = s.raw GROUP BY t.Rating, s.canonical",
        NOTES, _SPELLINGS,
    ),
)
register(
    "maturity_interpolate",
    lambda x: present(
        x.notes().groupBy("WAL").agg(F.count("*").alias("Notes")).withColumns(
            {f"RW_{r1}_{r5}".replace(".", "_"): rwa.interpolate(F.lit(r1), F.lit(r5), F.col("WAL")) for r1, r5 in ((0.15, 0.20), (0.9, 1.4))}
        )
    ),
    query(
        "SELECT WAL, count(*) AS Notes, "
        + ", ".join(
            f"{r(f'CASE WHEN WAL <= 1 THEN {a} WHEN WAL >= 5 THEN {b} ELSE {a} + ({b} - {a}) * (WAL - 1) / 4 END')}"
            f" AS RW_{str(a).replace('.', '_')}_{str(b).replace('.', '_')}"
            for a, b in ((0.15, 0.2), (0.9, 1.4))
        ).replace("0.15", "0.15::DOUBLE").replace("0.2 ", "0.2::DOUBLE ").replace("1.4 ", "1.4::DOUBLE ")
        + " FROM notes GROUP BY WAL",
        NOTES,
    ),
)
register(
    "rwa_tranche",
    lambda x: present(_tranches(x), RWA=2, Capital=2),
    query(
        f"SELECT * REPLACE ({', '.join(f'{d(c)} AS {c}' for c in _MONEY)}, {r('Thickness')} AS Thickness,"
        f" {r(d('RiskWeight'))} AS RiskWeight, {hd('RWA', 2)} AS RWA, {hd('Capital', 2)} AS Capital) FROM tranches",
        *PARTS,
    ),
)
register(
    "rwa_export",
    lambda x: present(rwa.rwa_export(x.notes())),
    query(
        f"""SELECT DealID, NoteID, TrancheID, CutoffDate, Rating, Seniority, {r('WAL')} AS WAL,
 {d('OriginalBalance')} AS OriginalBalance, {d('CurrentBalance')} AS CurrentBalance, {d('Attachment')} AS Attachment,
 {d('Detachment')} AS Detachment, {he(d('Detachment') + ' - ' + d('Attachment'), 4)} AS Thickness,
 {he('w', 4)} AS RiskWeight, {he('w * 100', 2)} AS RiskWeight_Pct, {he(d('CurrentBalance') + ' * w', 2)} AS RWA,
 {he(d('CurrentBalance') + ' * w * 0.08::DOUBLE', 2)} AS Capital FROM
 (SELECT c.*, COALESCE({_between('c.WAL')}, 12.5) AS w FROM
  (SELECT t.* EXCLUDE (Rating, Seniority, WAL), COALESCE(g.Rating, 'NR') AS Rating,
   COALESCE(g.Seniority, 'non-senior') AS Seniority, {d('COALESCE(g.WAL, 5.0)')} AS WAL
   FROM notes t LEFT JOIN config g ON t.DealID = g.DealID AND t.TrancheID = g.TrancheID) c
  LEFT JOIN export_weights e ON c.Rating = e.Rating AND c.Seniority = e.Seniority)""",
        NOTES, EXPORT, values("config", "DealID, TrancheID, Rating, Seniority, WAL", seeds.TRANCHE_CONFIG),
    ),
)
_PLACED = ["DealID", "Attachment", "NoteID", "CutoffDate"]


def _in_order(x: Frames):
    """The export written by deal, the most junior notes first, and read back with the place of every row."""
    path, rows = work_folder(x.spark, "export"), rwa.rwa_export(x.notes())
    write_ordered(rows, path, ["DealID", F.col("Attachment").desc_nulls_last(), "NoteID", "CutoffDate"], ranges=x.parts())
    return read_ordered(x.spark, path, rows.schema, "Place")


register(
    "rwa_export_ordered",
    lambda x: present(_in_order(x).select(*_PLACED, "Place")),
    query(
        f"SELECT DealID, {d('Attachment')} AS Attachment, NoteID, CutoffDate, row_number() OVER (ORDER BY DealID NULLS FIRST,"
        " Attachment DESC NULLS LAST, NoteID NULLS FIRST, CutoffDate NULLS FIRST) AS Place FROM notes",
        NOTES,
    ),
)
register(
    "rwa_deal",
    lambda x: present(rwa.rwa_deal(_tranches(x)), TotalRWA=2, CapitalRequired=2),
    query(
        f"SELECT {G}, {d('SUM(CurrentBalance)')} AS NoteBalance, {hd('SUM(RWA)', 2)} AS TotalRWA,"
        f" {hd('SUM(Capital)', 2)} AS CapitalRequired, {r(ratio('SUM(RWA)', 'SUM(CurrentBalance)'))} AS AvgRiskWeight,"
        f" {r(ratio('SUM(RWA)', 'SUM(CurrentBalance)'))} AS Density FROM tranches GROUP BY {G}",
        *PARTS,
    ),
)
_POOL = f"pool AS (SELECT {POOL_SUMMARY_COLUMNS} FROM star GROUP BY {G})"
_TEMPLATE = values("template", "TrancheID, Rating, Share, Attachment, Detachment, WAL, Seniority", seeds.STRUCTURE_TEMPLATE)
_BUILT = f"""built AS (SELECT p.DealID, p.CutoffDate, p.TotalBalance AS PoolBalance, p.DealID || ' ' || t.TrancheID AS NoteID,
 t.TrancheID, t.Rating, {d('t.Attachment')} AS Attachment, {d('t.Detachment')} AS Detachment, {d('t.WAL')} AS WAL,
 t.Seniority, CAST(p.TotalBalance AS DECIMAL(18,2)) * CAST(t.Share AS DECIMAL(3,2)) AS CurrentBalance FROM pool p CROSS JOIN template t)"""


def _built(x: Frames):
    return rwa.structure_from_pool(marts.pool_summary(x.star("LoanOriginationDate")))


register(
    "structure_from_pool",
    lambda x: present(_built(x), CurrentBalance=2),
    query(f"SELECT * REPLACE ({hd('CurrentBalance', 2)} AS CurrentBalance) FROM built", TAPE, STAR, _POOL, _TEMPLATE, _BUILT),
)
register(
    "rwa_deal_of_pool",
    lambda x: present(
        rwa.rwa_deal(rwa.rwa_tranche(_built(x)), marts.pool_summary(x.star("LoanOriginationDate"))),
        NoteBalance=2, TotalRWA=2, CapitalRequired=2,
    ),
    query(
        f"SELECT {G}, {hd('SUM(CurrentBalance)', 2)} AS NoteBalance, {hd('SUM(RWA)', 2)} AS TotalRWA,"
        f" {hd('SUM(Capital)', 2)} AS CapitalRequired, {r(ratio('SUM(RWA)', 'SUM(CurrentBalance)'))} AS AvgRiskWeight,"
        f" max(PoolBalance) AS PoolBalance, {r(ratio('SUM(RWA)', 'max(PoolBalance)'))} AS Density FROM tranches GROUP BY {G}",
        TAPE, STAR, _POOL, _TEMPLATE, _BUILT.replace("built AS", "notes AS"), _SPELLINGS, LIBRARY, WEIGHED,
    ),
)
register(
    "rwa_share",
    lambda x: present(rwa.rwa_share(_tranches(x)).select("DealID", "CutoffDate", "NoteID", "RWA", "RWA_Share"), RWA=2, RWA_Share=9),
    query(
        f"SELECT {G}, NoteID, {hd('RWA', 2)} AS RWA, {r(ratio('RWA', f'SUM(RWA) OVER (PARTITION BY {G})'), 9)} AS RWA_Share FROM tranches",
        *PARTS,
    ),
)
register(
    "rwa_movement",
    lambda x: present(rwa.rwa_movement(_tranches(x), x.parts()), RWA=2, PreviousRWA=2, RWAChange=2),
    query(
        f"SELECT DealID, NoteID, CutoffDate, {d('CurrentBalance')} AS CurrentBalance, {hd('RWA', 2)} AS RWA,"
        f" {hd('prev', 2)} AS PreviousRWA, {hd('RWA - prev', 2)} AS RWAChange FROM (SELECT *,"
        " lag(RWA) OVER (PARTITION BY DealID, NoteID ORDER BY CutoffDate) AS prev FROM tranches)",
        *PARTS,
    ),
)


def _fixed(x: str, suffix: str) -> str:
    return f"CAST(CAST({he(x, 1)} AS DECIMAL(18,1)) AS VARCHAR) || '{suffix}'"


register(
    "rwa_report_table",
    lambda x: present(rwa.report_table(_tranches(x))),
    query(
        f"SELECT {G}, NoteID, TrancheID AS tranche, COALESCE(NULLIF(Rating, ''), 'NR') AS rating, Seniority AS seniority,"
        f" {d('CurrentBalance')} AS balance, {_fixed('Thickness * 100', '%')} AS thickness, {_fixed('WAL', 'yr')} AS maturity,"
        f" {_fixed('RiskWeight * 100', '%')} AS risk_weight, {hd('RWA', 2)} AS rwa, {hd('Capital', 2)} AS capital FROM tranches",
        *PARTS,
    ),
)

# ------------------------------------------------------------------ structures

register(
    "tranche_row_checks",
    lambda x: present(rwa.tranche_row_checks(x.notes())),
    query(
        f"SELECT DealID, NoteID, CutoffDate, {d('Attachment')} AS Attachment, {d('Detachment')} AS Detachment, error FROM"
        " (SELECT *, CASE WHEN Attachment NOT BETWEEN 0 AND 1 THEN 'ATTACHMENT_OUT_OF_RANGE'"
        " WHEN Detachment NOT BETWEEN 0 AND 1 THEN 'DETACHMENT_OUT_OF_RANGE'"
        " WHEN Detachment <= Attachment THEN 'DETACHMENT_NOT_ABOVE_ATTACHMENT' END AS error FROM notes) WHERE error IS NOT NULL",
        NOTES,
    ),
)
register(
    "structure_checks",
    lambda x: rwa.structure_checks(x.notes()),
    query(
        f"""SELECT {G}, 'OVERLAP' AS check_name, NoteID || ' / ' || partner AS detail FROM (
 SELECT n.*, CASE WHEN n.NoteID = p.l THEN p.nf ELSE p.l END AS partner, CASE WHEN n.NoteID = p.l THEN p.na ELSE n.Attachment END AS border
 FROM notes n JOIN (SELECT *, lead(f) OVER w AS nf, lead(Attachment) OVER w AS na FROM
  (SELECT {G}, Attachment, min(NoteID) AS f, max(NoteID) AS l FROM notes GROUP BY {G}, Attachment)
  WINDOW w AS (PARTITION BY {G} ORDER BY Attachment)) p USING ({G}, Attachment)) WHERE Detachment > border
 UNION ALL SELECT {G}, 'SENIOR_COUNT', CAST(count(CASE WHEN Seniority = 'senior' THEN 1 END) AS VARCHAR) FROM notes GROUP BY {G}
 HAVING count(CASE WHEN Seniority = 'senior' THEN 1 END) <> 1
 UNION ALL SELECT {G}, 'SENIOR_NOT_TOP', NoteID FROM
 (SELECT *, max(Detachment) OVER (PARTITION BY {G}) AS top FROM notes) WHERE Seniority = 'senior' AND Detachment <> top""",
        NOTES,
    ),
)
register(
    "credit_enhancement",
    lambda x: present(rwa.credit_enhancement(x.notes())),
    query(
        f"SELECT {G}, {d('COALESCE(first(Attachment ORDER BY NoteID) FILTER (WHERE Seniority = ' + chr(39) + 'senior' + chr(39) + '), 0)')}"
        f" AS CreditEnhancement, {d('SUM(CurrentBalance)')} AS TotalTrancheBalance FROM notes GROUP BY {G}",
        NOTES,
    ),
)
register(
    "deal_rollup",
    lambda x: present(star.deal_rollup(marts.pool_summary(x.star("LoanOriginationDate")), x.notes())),
    query(
        f"""SELECT g.DealID, g.name, g.asset_class, g.status, p.CutoffDate AS LatestCutoff, p.TotalBalance AS PoolBalance,
 p.LoanCount, {d('t.bal')} AS NoteBalance, t.cnt AS NoteCount FROM registry g
 LEFT JOIN (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY DealID ORDER BY CutoffDate DESC) = 1) p ON g.DealID = p.DealID
 LEFT JOIN (SELECT DealID, SUM(CurrentBalance) AS bal, count(*) AS cnt FROM notes GROUP BY DealID, CutoffDate
  QUALIFY row_number() OVER (PARTITION BY DealID ORDER BY CutoffDate DESC) = 1) t ON g.DealID = t.DealID""",
        TAPE, STAR, _POOL, NOTES,
        values("registry", "DealID, name, asset_class, status", [(x[0], x[1], x[3], x[4]) for x in seeds.DEALS]),
    ),
)
