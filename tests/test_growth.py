"""Steps whose cost must follow the input: searches, reports, refreshed layers, order of files, anonymised records."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tests.test_warehouse import KEY, bronze  # noqa: F401  (a fixture)
from tidemark.operators import audit, exposure, ordering, parity
from tidemark.plans import change_queries, publish
from tidemark.sources import raw


def test_only_grams_that_are_waited_at_are_shuffled(spark):
    cells = spark.createDataFrame([("common words of all, unique7x",), ("common words of all, other",)], "c string")
    values = spark.createDataFrame([("unique7",), ("words",), ("absent",)], "v string")
    found = audit.contained(cells, "c", values, "v")
    assert sorted(map(tuple, found.collect())) == [("common words of all, other", "words"), ("common words of all, unique7x", "unique7"), ("common words of all, unique7x", "words")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and "strategy=broadcast" in plan


def test_a_report_reads_stored_comparisons(spark, tmp_path):
    a, b = (spark.createDataFrame(r, "k string, v int, w int") for r in ([("a", 1, 1), ("b", 2, 2), ("c", 3, 3)], [("b", 2, 5), ("c", 4, 6), ("d", 1, 1)]))
    diff = parity.keyed_diff(a, b, ["k"], ["v", "w"])
    rows = [(r["section"], r["key"], r["field"], r["before"], r["after"]) for r in parity.ordered_report({"x": (diff, ["k"], ["v", "w"])}, f"{tmp_path}/r").orderBy("position").collect()]
    assert rows[3:] == [(1, "d", None, None, None), (2, "a", None, None, None), (3, "b", "w", "2", "5"), (3, "c", "v", "3", "4"), (3, "c", "w", "3", "6")]
    assert spark.read.parquet(f"{tmp_path}/r/block-0").count() == 4


def test_refreshed_layers_read_stored_records(spark, data, monkeypatch):
    class Seen(Exception):
        pass

    def silver(records):
        raise Seen(records._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(change_queries.staging, "silver", silver)
    with pytest.raises(Seen) as seen:
        change_queries._caught_up(spark, data)
    assert "Aggregate" not in str(seen.value)


def test_order_is_checked_in_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "_RUN", 2)
    values = [f"{i:03d}" for i in range(40)]
    for i, j in ((3, 4), (17, 30)):
        values[i], values[j] = values[j], values[i]
    (tmp_path / "f.csv").write_text("k\n" + "\n".join(values) + "\n")
    found = ordering.order_problems(raw.read_text_csv(spark, f"{tmp_path}/f.csv"), ["k"], f"{tmp_path}/p").collect()
    want = sorted((i + 1, values[i - 1], values[i]) for i in range(1, 40) if values[i - 1] > values[i])
    assert sorted((r["position"], r["previous"]["k"], r["current"]["k"]) for r in found) == want


def test_anonymised_files_of_ids_that_share_digits(spark, bronze, tmp_path):  # noqa: F811
    seen: dict[str, str] = {}
    for i in range(1_000_000):
        digits = hmac.new(KEY, f"bruto:v1|meta|{i}".encode(), hashlib.sha256).hexdigest()[:8]
        if digits in seen:
            break
        seen[digits] = str(i)
    meta = bronze.where("source = 'meta_ads'").limit(2).withColumn("n", F.row_number().over(__import__("pyspark").sql.Window.orderBy("row_id")))
    text = F.regexp_replace(F.to_json("payload"), '"ad_id":"[^"]*"', F.concat(F.lit('"ad_id":"'), F.when(F.col("n") == 1, seen[digits]).otherwise(str(i)), F.lit('"')))
    rows = meta.select("row_id", F.parse_json(text).alias("payload"))
    labels = [*exposure.ALLOWED_LABELS, "onsite_conversion.ig_profile_view", "purchase", "omni_purchase"]
    with pytest.raises(ValueError, match="one label for two of"):
        publish.publish_anonymised(rows, "meta_ads", "meta", KEY.decode(), f"{tmp_path}/a", labels)
    publish.publish_anonymised(rows, "meta_ads", "meta", KEY.decode(), f"{tmp_path}/a", labels, blocks=exposure.WIDE)
    v = F.parse_json("value")
    assert spark.read.text(f"{tmp_path}/a/records.json").select(F.variant_get(v, "$.ad_id", "string")).distinct().count() == 2
