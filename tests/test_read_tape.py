"""Many tape files of many layouts in one scan."""

import random

import pytest

from mortar.operators import conform
from mortar.session import work_folder
from mortar.sources import tape
from mortar.sources.history_table import _files


def put(spark, path, text):
    system, make = _files(spark, path)
    out = system.create(make(path))
    out.write(bytearray(text.encode()))
    out.close()


def test_a_thousand_files_of_twenty_layouts(spark):
    rng, folder, want = random.Random(2), work_folder(spark, "many"), []
    fields = [f"AR{i}" for i in (1, 3, 5, 67, 128, 166)]
    layouts = []
    for _ in range(20):
        names = rng.sample(fields, rng.randint(3, 6))
        layouts.append(["AR3", *[n for n in names if n != "AR3"]])
        rng.shuffle(layouts[-1])
    for k in range(1000):
        names = layouts[k % 20]
        rows = [{n: rng.choice([f"{n} {k} {i}", 'a "quoted", cell', "", "x"]) for n in names} for i in range(rng.randint(1, 3))]
        cell = lambda v: '"' + v.replace('"', '""') + '"' if '"' in v or "," in v else v
        head = ",".join(rng.choice([n, f"{n} Some Words", f" {n}"]) for n in names)
        lines = [head, *[",".join(cell(r[n]) for n in names) for r in rows]]
        put(spark, f"{folder}/f{k:04d}.csv", "\n".join(lines) + "\n")
        want += [(f"f{k:04d}.csv", *[r.get(f) or None for f in fields]) for r in rows if any(r[n] for n in names) or len(names) > 1]
    read = tape.read_tape(spark, folder, "*.csv")
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the headers, and the lines
    got = [tuple(r) for r in read.select(tape.FILE, *sorted(fields, key=lambda f: int(f[2:]))).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert read.filter(f"{tape.MALFORMED} IS NOT NULL").count() == 0
    # AR7, AR55 and most others are in no file
    fact = conform.conform_fact_loan_period(tape.stage_tape(read, "BLETCHLEY"), conform.BLETCHLEY)
    assert {r["CurrentInterestRate"] for r in fact.collect()} == {None}


def test_lines_that_do_not_fit_and_odd_headers(spark):
    folder = work_folder(spark, "odd")
    put(spark, f"{folder}/a.csv", "﻿AR1,AR3 Loan,1st col,AR3\n\n2020-01-31,L1,x,second\n2020-01-31,L2\n,L3,y,z,more\n,,,\n")
    put(spark, f"{folder}/b.csv", "AR3\r\nL9\r\n")
    put(spark, f"{folder}/c.csv", "AR3,AR1\n")
    got = {(r["AR1"], r["AR3"], r["_1st_col"], r[tape.MALFORMED], r[tape.FIRST]) for r in tape.read_tape(spark, folder).collect()}
    assert got == {
        ("2020-01-31", "L1", "x", None, True), ("2020-01-31", "L2", None, "2020-01-31,L2", False),
        (None, "L3", "y", ",L3,y,z,more", False), (None, None, None, None, False), (None, "L9", None, None, True),
    }
    with pytest.raises(ValueError, match="no tape file"):
        tape.read_tape(spark, folder, "*.txt")
