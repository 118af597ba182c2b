"""Layers that follow late snapshots equal a full rebuild and leave other files alone."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans.incremental import Layers
from tidemark.plans.star import star
from tidemark.plans.staging import unified
from tidemark.sources.registry import LEVELS, METRICS

DAYS = [dt.date(2026, 3, d) for d in range(1, 11)]


def _silver(spark, rows):
    """(platform, day, ad, name of the ad) -> silver; accounts, campaigns and sets follow from the ad."""
    out = [(p, d, f"A{ad % 2}", "acc", f"C{ad % 4}", f"camp {d.day // 6}", f"S{ad % 8}", None, f"U{ad}", name, *range(len(METRICS))) for p, d, ad, name in rows]
    levels = ", ".join(f"{x}_external_id string, {x}_nome string" for x in LEVELS)
    df = spark.createDataFrame(out, f"plataforma string, data date, {levels}, {', '.join(f'{m} bigint' for m in METRICS)}")
    return unified(df.withColumn("extracted_at", F.lit("2026-04-01").cast("timestamp")))


def _files(folder):
    return {os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.startswith("part-")}


def _rows(tables):
    return {name: sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr) for name, df in tables.items()}


@pytest.fixture
def built(spark, tmp_path):
    rng = random.Random(3)
    rows = {(p, d, ad): f"name {ad}" if rng.random() < 0.9 else "renamed" for p in ("Meta Ads", "Google Ads") for d in DAYS for ad in range(12) if rng.random() < 0.8}
    layers = Layers(spark, str(tmp_path / "layers"), buckets=6)
    layers.build(_silver(spark, [(*k, v) for k, v in rows.items()]))
    return layers, rows


def _follow(spark, layers, rows, days):
    silver = _silver(spark, [(*k, v) for k, v in rows.items()])
    before = _files(layers.folder)
    replaced = layers.refresh(silver.where(F.col("data").isin(days)), days)
    assert _rows(layers.tables()) == _rows(star(silver))
    return replaced, before, _files(layers.folder)


def test_metrics_alone_touch_their_days(spark, built):
    layers, rows = built
    silver = _silver(spark, [(*k, v) for k, v in rows.items()]).withColumn("spend", F.when(F.col("data") == DAYS[4], F.col("spend") + 7).otherwise(F.col("spend")))
    before = _files(layers.folder)
    replaced = layers.refresh(silver.where(F.col("data").isin(DAYS[3:6])), DAYS[3:6])
    assert replaced == {"fato_metricas": [DAYS[4]], "silver": [DAYS[4]]}
    assert _rows(layers.tables()) == _rows(star(silver))
    gone = before - _files(layers.folder)
    assert gone and all(f"={DAYS[4]}" in f for f in gone)


def test_late_names_renumber_versions(spark, built):
    layers, rows = built
    for ad in (1, 2):
        for p in ("Meta Ads", "Google Ads"):
            rows[p, DAYS[2], ad] = "late name"
    replaced, before, after = _follow(spark, layers, rows, DAYS[1:4])
    assert set(replaced) == {"silver", "fato_metricas", "seen_anuncio", "dim_anuncio"} | {k for k in replaced if k.startswith("seen_")}
    assert replaced["silver"] == [DAYS[2]] and set(DAYS[4:]) & set(replaced["fato_metricas"])
    kept = [f for f in before if f.startswith("silver") and f"={DAYS[2]}" not in f]
    assert kept and set(kept) <= after and len(replaced["dim_anuncio"]) < 6


def test_new_and_lost_entities_days_and_platforms(spark, built):
    layers, rows = built
    lost = {k: v for k, v in rows.items() if not (k[0] == "Google Ads" or k[2] == 5)}
    _follow(spark, layers, lost, DAYS)
    assert [r["nome"] for r in layers.tables()["dim_plataforma"].collect()] == ["Meta Ads"]
    new = dict(lost)
    new["Meta Ads", dt.date(2026, 3, 20), 99] = None
    new["Google Ads", dt.date(2026, 3, 20), 3] = "back"
    replaced, before, after = _follow(spark, layers, new, [dt.date(2026, 3, 20)])
    assert replaced["silver"] == [dt.date(2026, 3, 20)] and {f for f in before if f.startswith("silver")} <= after
    assert _follow(spark, layers, new, DAYS)[0] == {}


def test_a_refresh_that_died_is_repeated(spark, built, monkeypatch):
    from tidemark.plans import incremental

    layers, rows = built
    rows["Meta Ads", DAYS[2], 1] = "late name"
    silver, real, calls = _silver(spark, [(*k, v) for k, v in rows.items()]), incremental._replace, []

    def dies(df, path, *rest):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("lost")
        real(df, path, *rest)

    monkeypatch.setattr(incremental, "_replace", dies)
    with pytest.raises(OSError):
        layers.refresh(silver.where(F.col("data") == DAYS[2]), [DAYS[2]])
    monkeypatch.setattr(incremental, "_replace", real)
    layers.refresh(silver.where(F.col("data") == DAYS[2]), [DAYS[2]])
    assert _rows(layers.tables()) == _rows(star(silver))
