"""Loads that die, repeat and compete; facts that are read by their statistics; sketches by day."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches
from tidemark.sources import raw
from tidemark.sources.clustered import ClusteredFact
from tidemark.sources.commits import CommittedBatches


def _rows(spark, n, day="2026-01-02"):
    return spark.range(n).select(F.lit("meta_ads").alias("source"), F.lit(day).cast("date").alias("reference_date"), F.lit("2026-01-03").cast("timestamp").alias("extracted_at"), F.parse_json(F.to_json(F.struct("id"))).alias("payload"))


def test_a_batch_is_loaded_once(spark, tmp_path):
    batches = CommittedBatches(spark, str(tmp_path))
    assert batches.rows().count() == 0 and batches.commits().count() == 0
    assert batches.load([_rows(spark, 5), _rows(spark, 3, "2026-01-04")], "2026-01")
    assert not batches.load([_rows(spark, 99)], "2026-01")
    assert batches.rows().count() == 8 and {r["batch_id"] for r in raw.ingestion_log(batches.rows()).collect()} == {"2026-01"}
    assert batches.load([_rows(spark, 2)], "7")  # ids stay text, and a batch may be named like a number
    assert sorted(r["batch_id"] for r in batches.rows().select("batch_id").distinct().collect()) == ["2026-01", "7"]
    for bad in ("../x", "", "a/b", "_hidden", ".x"):
        with pytest.raises(ValueError):
            batches.load([_rows(spark, 1)], bad)
    with pytest.raises(ValueError, match="null payload"):
        batches.load([_rows(spark, 1).withColumn("payload", F.lit(None).cast("variant"))], "bad")
    assert batches.winner("bad") is None


def test_a_dead_load_leaves_nothing_to_see_and_is_repeated(spark, tmp_path, monkeypatch):
    batches = CommittedBatches(spark, str(tmp_path))
    batches.load([_rows(spark, 4)], "a")

    def dies(*_):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(CommittedBatches, "commit", dies)
        with pytest.raises(OSError):
            batches.load([_rows(spark, 6)], "b")
    assert batches.rows().count() == 4
    assert batches.sweep() == []  # it could still be writing
    assert batches.load([_rows(spark, 6)], "b") and batches.rows().count() == 10
    gone = batches.sweep(dt.timedelta(0))
    assert len(gone) == 1 and gone[0].startswith("b/") and batches.rows().count() == 10
    (tmp_path / "commits" / "c").touch()  # a writer that died before it named its attempt
    assert batches.winner("c") is None and batches.commits().count() == 2
    assert "c" in batches.sweep(dt.timedelta(0)) and batches.load([_rows(spark, 1)], "c")


def test_of_competing_loads_one_wins(spark, tmp_path):
    won, lock = [], threading.Lock()

    def one(n):
        got = CommittedBatches(spark, str(tmp_path)).load([_rows(spark, n)], "same")
        with lock:
            won.append((got, n))

    threads = [threading.Thread(target=one, args=(n,)) for n in (11, 12, 13, 14)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [n for got, n in won if got]
    batches = CommittedBatches(spark, str(tmp_path))
    assert len(won) == 4 and len(winners) == 1 and batches.rows().count() == winners[0]
    assert batches.sweep(dt.timedelta(0)) == []


def test_few_files_are_read(spark, tmp_path):
    rows = raw.generated_fact(spark, 60_000)
    fact = ClusteredFact(spark, str(tmp_path))
    fact.write(rows, 24)
    stored = spark.read.parquet(fact.path)
    files, newest = len(stored.inputFiles()), stored.agg(F.max("data")).first()[0]
    last, history = fact.last_days(7), fact.history(33)
    assert files >= 20 and len(last.inputFiles()) <= files / 3 and len(history.inputFiles()) <= files / 4
    assert last.count() == stored.where(F.col("data") > F.lit(newest - dt.timedelta(7))).count() > 0
    assert history.count() == stored.where("anuncio_id = 33").count() > 0
    assert fact.history(-5).count() == 0 and fact.statistics().agg(F.sum("rows")).first()[0] == stored.count()
    nothing = ClusteredFact(spark, str(tmp_path / "none"))
    nothing.write(rows.where("false"))
    assert nothing.last_days().count() == 0 == nothing.history(1).count()


def test_sketches_of_any_range_stay_within_their_error(spark):
    rows = spark.range(200_000).select((F.col("id") % 70_001).alias("v"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("day"), (F.col("id") % 2).alias("g"))
    stored = sketches.daily(rows, "day", ["g"], "v").persist()
    for first, last in (("2026-01-01", "2026-01-30"), ("2026-01-04", "2026-01-09"), ("2026-01-11", "2026-01-11")):
        exact = {r["g"]: r["n"] for r in rows.where(F.col("day").between(first, last)).groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
        got = {r["g"]: r["distinct"] for r in sketches.merged(stored, "day", first, last, ["g"]).collect()}
        assert got.keys() == exact.keys() and all(abs(got[g] - n) <= 4 * sketches.standard_error() * n for g, n in exact.items())
    stored.unpersist()
    assert sketches.merged(sketches.daily(rows, "day", [], "v", 16), "day", "2026-01-01", "2026-01-30", []).first()["distinct"] == pytest.approx(70_001, rel=4 * sketches.standard_error(16))


def test_missing_and_empty_sources_have_no_records(spark, tmp_path):
    with pytest.warns(UserWarning, match="no file"):
        assert raw.read_json_array(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "some.json").write_text('[{"a": 1}, {"a": 2}]')
    assert raw.read_json_array(spark, str(tmp_path / "empty.json")).count() == 0
    assert raw.read_json_array(spark, str(tmp_path / "*.json")).count() == 2
