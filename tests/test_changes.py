"""Matching of multisets, ordered reports, order across files: small cases, hot keys, null keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering, parity
from tidemark.sources import raw


def _path(tmp_path, n=[0]):  # noqa: B006
    n[0] += 1
    return str(tmp_path / f"p{n[0]}")


def test_multisets_match_like_counters(spark, tmp_path):
    rng = random.Random(1)
    side = lambda: [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.randrange(4), rng.choice(["x", None])) for _ in range(400)]
    before, after = side() + [("hot", 9, "same")] * 300, side() + [("hot", 9, "same")] * 100 + [("new", 1, "x")]
    frames = [spark.createDataFrame(x, "k string, v int, w string").repartition(5) for x in (before, after)]
    got = {r["k"]: tuple(r)[1:] for r in parity.multiset_diff(*frames, ["k"], ["v", "w"]).collect()}
    want = {}
    for k in {x[0] for x in before + after}:
        b, a = (Counter(x for x in s if x[0] == k) for s in (before, after))
        same, lb, la = (b & a).total(), (b - a).total(), (a - b).total()
        want[k] = (same, min(la, lb), la - min(la, lb), lb - min(la, lb))
    assert got == want
    pairs = parity.multiset_pairs(*frames, ["k"], ["v", "w"], _path(tmp_path)).collect()
    kinds = Counter((r["k"], r["status"]) for r in pairs)
    assert all((kinds[k, "CHANGED"], kinds[k, "NEW"], kinds[k, "REMOVED"]) == w[1:] for k, w in want.items())
    left = Counter(before) - Counter(after)
    assert Counter((r["k"], r["before_v"], r["before_w"]) for r in pairs if r["status"] != "NEW") == left
    assert parity.multiset_diff(frames[0].where("false"), frames[1].where("false"), ["k"], ["v", "w"]).count() == 0


def test_numbers_follow_the_order_and_split_a_hot_row(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "ä"])) for _ in range(500)] + [(2, "hot")] * 3000
    df = spark.createDataFrame(rows, "g int, t string").repartition(6)
    path = _path(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.numbered(df, ["t"], path, by=["g"]).collect()
        parts = spark.read.parquet(path).where("t = 'hot'").groupBy(F.shiftright("_place", 33)).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    key = lambda t: (t is not None, (t or "").encode())
    for g in (None, 1, 2, 3):
        mine = sorted((r["position"], r["t"]) for r in got if r["g"] == g) if g else sorted(((r["position"], r["t"]) for r in got if r["g"] is None), key=lambda x: x[0])
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1))
        assert [t for _, t in mine] == sorted((t for x, t in rows if x == g), key=key)
    assert parts > 1
    assert ordering.numbered(df.where("false"), ["t"], _path(tmp_path)).count() == 0


def test_report_is_ordered_by_contents(spark, tmp_path):
    a = spark.createDataFrame([("k1", 1, "x"), ("k2", 2, None), ("k3", 3, "z")], "k string, v int, w string")
    b = spark.createDataFrame([("k2", 3, ""), ("k3", 3, "z"), ("k4", 1, "q")], "k string, v int, w string")
    diff = parity.keyed_diff(a, b, ["k"], ["v", "w"])
    for parts in (1, 4):
        rows = parity.ordered_report({"B": (diff.repartition(parts), ["k"], ["v", "w"]), "A": (diff.where("false"), ["k"], ["v", "w"])}, _path(tmp_path)).orderBy("position").collect()
        lines = [(r["section"], r["status"], r["key"], r["field"], r["before"], r["after"], r["delta"] and int(r["delta"]), r["percent"] and float(r["percent"])) for r in rows]
        assert lines == [
            (0, "CHANGED", None, None, None, "1", None, None), (0, "IDENTICAL", None, None, None, "1", None, None), (0, "NEW", None, None, None, "1", None, None), (0, "REMOVED", None, None, None, "1", None, None),
            (1, "NEW", "k4", None, None, None, None, None), (2, "REMOVED", "k1", None, None, None, None, None), (3, "CHANGED", "k2", "v", "2", "3", 1, 50.0), (3, "CHANGED", "k2", "w", "(none)", "", None, None),
        ]


@pytest.mark.parametrize("block", [None, "200b"])
def test_order_is_restored_from_files_and_their_blocks(spark, tmp_path, block):
    rows = [(f"{i:05d}", str(i % 7)) for i in range(2000)]
    random.Random(3).shuffle(rows)
    target = _path(tmp_path)
    raw.write_sorted_csv(spark.createDataFrame(rows, "k string, v string"), target, ["k"], 5)
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    try:
        files = raw.read_text_csv(spark, target)
        got = {r["position"]: r["k"] for r in ordering.restored(files, _path(tmp_path)).collect()}
        assert [got[i] for i in range(1, 2001)] == sorted(k for k, _ in rows)
        assert ordering.order_problems(files, ["k"], _path(tmp_path)).count() == 0
        falls = ordering.order_problems(files, ["v"], _path(tmp_path)).collect()
        assert {r["position"] for r in falls} == {i + 1 for i in range(7, 2000, 7)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_file_in_the_wrong_place_is_found(spark, tmp_path):
    target = _path(tmp_path)
    for ks in (["b", "c"], ["a", "d"]):
        spark.createDataFrame([(k,) for k in ks], "k string").coalesce(1).sortWithinPartitions("k").write.mode("append").csv(target, header=True)
    files = raw.read_text_csv(spark, target)
    assert ordering.order_problems(files, ["k"], _path(tmp_path)).count() in (0, 1)  # by the files' names, which are random here
    names = [r[0] for r in files.select("k", "_metadata.file_name").orderBy("file_name", "k").select("k").collect()]
    falls = sum(x > y for x, y in zip(names, names[1:], strict=False))
    assert ordering.order_problems(files, ["k"], _path(tmp_path)).count() == falls
