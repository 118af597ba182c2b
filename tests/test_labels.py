"""Labels at a size where eight digits no longer tell all entities apart, and audits that read stored rows a few times only."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tests.test_warehouse import KEY, bronze, tables, view  # noqa: F401  (fixtures)
from tidemark.operators import audit, exposure
from tidemark.plans import publish
from tidemark.sources import raw


@pytest.fixture(scope="module")
def shared():
    """Two keys of ads whose labels have the same eight digits."""
    seen: dict[str, str] = {}
    for i in range(1_000_000):
        digits = hmac.new(KEY, f"anuncio|n{i}".encode(), hashlib.sha256).hexdigest()[:8]
        if digits in seen:
            return seen[digits], f"n{i}"
        seen[digits] = f"n{i}"
    raise AssertionError("no two keys share eight digits")


@pytest.fixture(scope="module")
def crowded(spark, view, shared, tmp_path_factory):  # noqa: F811
    """The view with two of its ads under those keys."""
    two = [r[0] for r in view.select("anuncio_nk").distinct().orderBy("anuncio_nk").limit(2).collect()]
    path = str(tmp_path_factory.mktemp("crowded") / "v")
    view.withColumn("anuncio_nk", F.when(F.col("anuncio_nk") == two[0], shared[0]).when(F.col("anuncio_nk") == two[1], shared[1]).otherwise(F.col("anuncio_nk"))).write.parquet(path)
    return spark.read.parquet(path)


def test_wide_labels_are_told_apart_and_begin_with_the_short_ones(spark, crowded, shared, tmp_path):
    ads = crowded.select("anuncio_nk").distinct().count()
    short, wide = exposure.exposed(crowded, KEY), exposure.exposed(crowded, KEY, exposure.WIDE)
    assert exposure.export_manifest(short).first()["n_anuncio"] == ads - 1 and exposure.export_manifest(wide).first()["n_anuncio"] == ads
    assert "two keys of anuncio share a label" in {r["problem"] for r in exposure.post_checks(crowded, short).collect()}
    assert exposure.post_checks(crowded, wide).count() == 0
    with pytest.raises(ValueError, match="two keys of anuncio share a label"):
        publish.export(crowded, KEY.decode(), f"{tmp_path}/short", f"{tmp_path}/public")
    assert publish.export(crowded, KEY.decode(), f"{tmp_path}/wide", f"{tmp_path}/public", blocks=exposure.WIDE).first()["cardinalidades"]["anuncio"] == ads
    text = raw.read_text_csv(spark, f"{tmp_path}/wide/{publish.DATA_NAME}")
    cut = text.withColumns({c: exposure.first_block(c) for c in audit.ID_SHAPES})
    assert raw.fingerprint(cut).first() == raw.fingerprint(raw.as_text(short)).first()
    assert audit.audited(text, crowded, blocks=exposure.WIDE).count() == 0
    assert {"conta_id out of shape", "anuncio_id out of shape"} <= {r["problem"] for r in audit.audited(text, crowded).collect()}


def test_audit_counts_levels_in_one_scan(spark, view, tmp_path):  # noqa: F811
    raw.as_text(exposure.exposed(view, KEY)).write.parquet(f"{tmp_path}/t")
    text = spark.read.parquet(f"{tmp_path}/t")
    lost = text.where("anuncio_id <> (SELECT min(anuncio_id) FROM {t})".replace("{t}", f"parquet.`{tmp_path}/t`")).withColumn("adset_versao", F.lit("2"))
    found = {r["problem"]: r["count"] for r in audit.invariant_problems(lost, view).collect()}
    assert found["the number of anuncio differs"] == 1 and found["versions of adset differ"] == 2 and "versions of conta differ" in found
    none = {r["problem"]: r["count"] for r in audit.invariant_problems(text.limit(0), view).collect()}
    assert none["the number of campanha differs"] == 8
    plan = audit.audited(text, view)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 12
