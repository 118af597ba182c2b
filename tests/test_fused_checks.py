"""Fused checks find what the single checks find, in one scan of each table."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import fused, quality


def _tables(spark):
    day = lambda d: dt.date(2026, 1, d)
    dim = [("a", 1, day(1), day(5), False), ("a", 2, day(5), day(9), True), ("a", 3, day(20), day(25), None), ("b", 4, day(1), day(2), False), ("c", 4, day(1), day(3), True), (None, None, day(1), day(9), True), (None, 7, day(3), day(4), True), ("d", 8, None, None, True)]
    facts = [(1, "x", 5), (1, "x", -1), (2, None, None), (9, "y", 1), (None, "z", 2), (None, "z", 3), (9, "y", 1)]
    return {"dim": spark.createDataFrame(dim, "nk string, sk int, f date, t date, cur boolean").repartition(3), "fact": spark.createDataFrame(facts, "sk int, v string, m int").repartition(3)}


def _checks():
    return [
        fused.unique("sk unique", "dim", "sk"), fused.unique("grain", "fact", "sk", "v", nulls=True), fused.accepted_values("v", "fact", "v", ["x"]), fused.one_current("current", "dim", "nk", "cur"),
        fused.relation("parent", "fact", "sk", "dim", "sk"), fused.apart("apart", "dim", "nk", "f", "t"), fused.rows_where("m", "fact", F.col("m") < 0), fused.rows_where("sk null", "dim", F.col("sk").isNull()),
    ]


def _single(t):
    dim, fact = t["dim"], t["fact"]
    found = {
        "sk unique": quality.unique(dim, "sk"), "grain": quality.unique_grain(fact, "sk", "v"), "v": quality.accepted_values(fact, "v", ["x"]), "current": quality.one_current(dim, "nk", "cur"),
        "parent": quality.relationships(fact, "sk", dim, "sk"), "apart": quality.overlaps(dim, "nk", "f", "t"), "m": quality.non_negative(fact, ["m"]), "sk null": quality.not_null(dim, "sk"),
    }
    return {k: v.count() for k, v in found.items()}


def test_fused_equals_single_checks(spark):
    t = _tables(spark)
    got = {r["check"]: (r["violations"], r["outcome"]) for r in fused.violations(t, _checks()).collect()}
    want = _single(t)
    assert {k: v for k, (v, _) in got.items()} == want and all(want.values())
    assert {o for _, o in got.values()} == {"fail"}
    nothing = {n: df.where("false") for n, df in t.items()}
    assert {r["outcome"] for r in fused.violations(nothing, _checks()).collect()} == {"pass"}


def test_each_table_is_read_once_and_rows_are_counted_while_written(spark, tmp_path, capfd):
    stored, known = {}, {}
    for name, df in _tables(spark).items():
        stored[name], counts, rows = fused.stored(df, str(tmp_path / name), [c for c in _checks() if c.table == name])
        known |= counts
        assert rows == df.count()
    assert known == {"m": 1, "sk null": 1}
    report = fused.violations(stored, _checks(), known)
    assert {r["check"]: r["violations"] for r in report.collect()} == _single(stored)
    capfd.readouterr()
    fused.violations(stored, _checks(), known).explain()
    plan = capfd.readouterr().out
    assert plan.count("FileScan") == 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_the_star_is_checked_in_one_scan_of_each_table(spark, data, tmp_path, capfd):
    from tidemark.plans import samples, staging
    from tidemark.plans.star import checked, checks

    tables, report = checked(staging.silver(samples.raw_records(spark, data)), str(tmp_path / "star"))
    capfd.readouterr()
    report.explain()
    assert capfd.readouterr().out.count("FileScan") == 8
    single = quality.report(spark, checks({k: v for k, v in tables.items() if not k.startswith("vw")}))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, single.select(*report.columns).collect()))
