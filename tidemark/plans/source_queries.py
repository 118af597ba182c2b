"""Registered queries on what reads, describes and stores sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ordering, parity, quality
from tidemark.plans import reports
from tidemark.plans.queries import query
from tidemark.plans.samples import FLAT_SQL, STAR_SQL, flat_fact, table, tables
from tidemark.sources import raw
from tidemark.sources.registry import METRICS, SOURCES


@query("source string, rows bigint, first_day date, last_day date", "SELECT 'meta' AS source, count(*) AS rows, min(CAST(ts AS DATE)) first_day, max(CAST(ts AS DATE)) last_day FROM events UNION ALL SELECT 'google', 0, NULL, NULL")
def records_of_sources(spark, sf_dir):
    """`events` as files of JSON arrays for one source, and no file for the other, which has no rows then."""
    where, parts = raw.scratch_path(spark, "artifacts"), []
    record = F.struct(F.to_date("ts").cast("string").alias("date_start"), "event_id")
    arrays = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("part").text(f"{where}/meta")
    for name in ("meta", "google"):
        rows = raw.dated(raw.read_json_array(spark, f"{where}/{name}/part=*"), SOURCES["meta"], "b")[0]
        parts.append(rows.agg(F.count("*").alias("rows"), F.min("reference_date").alias("first_day"), F.max("reference_date").alias("last_day")).withColumn("source", F.lit(name)))
    return parts[0].unionByName(parts[1])


def _described(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Hashes of an artifact with the suppliers, and its manifest."""
    where = raw.scratch_path(spark, "described")
    lines = table(spark, sf_dir, "supplier").select(F.to_json(F.struct("s_suppkey", "s_name")).alias("value"))
    lines.coalesce(1).write.text(f"{where}/data")
    raw.write_manifest(spark, f"{where}/data/part-*", f"{where}/manifest", SOURCES["meta"], "run 1", "2026-01-01", "2026-01-31", lines.count())
    return raw.file_hashes(spark, f"{where}/data/part-*"), spark.read.schema(raw.MANIFEST).json(f"{where}/manifest")


@query("fonte string, run_id string, start_date string, end_date string, registros bigint, described boolean", "SELECT 'meta_ads' fonte, 'run 1' run_id, '2026-01-01' start_date, '2026-01-31' end_date, count(*) registros, TRUE described FROM supplier")
def artifact_manifest(spark, sf_dir):
    """The manifest that is written beside an artifact, and whether its hash is that of the content."""
    hashes, manifest = _described(spark, sf_dir)
    return manifest.join(hashes.withColumn("described", F.lit(True)), "sha256", "left")


@query("expected string, problem string", "SELECT unnest(['another run', 'another source', 'another source', 'other window']) expected, unnest(['run', 'source', 'window', 'window']) problem WHERE (SELECT count(*) FROM supplier) > 0")
def artifact_problems(spark, sf_dir):
    """What a load finds that expects another run, source or window than the manifest's; nothing if it expects the right ones."""
    hashes, manifest = _described(spark, sf_dir)
    wanted = {"the same": (SOURCES["meta"], "run 1", "2026-01-01", "2026-01-31"), "another run": (SOURCES["meta"], "run 2", "2026-01-01", "2026-01-31"), "another source": (SOURCES["google"], "run 1", "2026-01-01", "2026-02-01"), "other window": (SOURCES["meta"], "run 1", "2026-01-02", "2026-01-31")}
    found = [raw.validate_artifacts(hashes, manifest, *w).select(F.lit(name).alias("expected"), "problem") for name, w in wanted.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("event_id bigint, k bigint, missing string", "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) k, NULL AS missing FROM events")
def flattened_props(spark, sf_dir):
    """Nested fields of `events` as flat columns; one that no record has is null."""
    e = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("payload"))
    return raw.flattened(e.select(F.parse_json(F.to_json(F.struct("event_id", F.col("payload").alias("p")))).alias("payload")), "payload", {"event_id": ("event_id", "bigint"), "k": ("p.k", "bigint"), "missing": ("p.none", "string")})


@query("anuncio_id bigint, rows bigint, spend money", f"WITH {FLAT_SQL} SELECT anuncio_id, count(*) AS rows, sum(spend) spend FROM fact GROUP BY 1")
def stored_fact(spark, sf_dir):
    """The flat fact as written in ranges of its key with Snappy, summed by key from the files."""
    path = raw.scratch_path(spark, "fact")
    raw.write_fact(flat_fact(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("anuncio_id").agg(F.count("*").alias("rows"), F.sum("spend").alias("spend"))


@query("position bigint, line string", """WITH t AS (SELECT '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS line FROM orders) SELECT row_number() OVER (ORDER BY line) AS position, line FROM t""")
def sorted_json_lines(spark, sf_dir):
    """Orders as JSON lines in the order of their text, over several files, with the place of each line."""
    path = raw.scratch_path(spark, "lines")
    raw.write_sorted_json(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), path)
    return ordering.restored(spark.read.text(path), raw.scratch_path(spark, "restored")).withColumnRenamed("value", "line")


@query("column_name string, position_a bigint, position_b bigint", """WITH a AS (SELECT column_name, row_number() OVER () - 1 p FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders)), b AS (SELECT column_name, row_number() OVER () - 1 p FROM (DESCRIBE SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice FROM orders))
  SELECT coalesce(a.column_name, b.column_name) column_name, a.p position_a, b.p position_b FROM a FULL JOIN b ON a.column_name = b.column_name WHERE a.p IS DISTINCT FROM b.p""")
def contract_differences(spark, sf_dir):
    """Columns that two tables don't have at the same place."""
    orders = table(spark, sf_dir, "orders")
    return quality.same_contract(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), orders.select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice"))


@query("status string, rows bigint", f"WITH {STAR_SQL} SELECT CASE WHEN day(data) = 9 THEN 'CHANGED' ELSE 'IDENTICAL' END status, count(*) AS rows FROM (SELECT DISTINCT plataforma, data FROM silver) GROUP BY 1")
def golden_against_later_state(spark, sf_dir):
    """Sums by platform and day, frozen as files, against a later state in which the ninth day's spend has grown."""
    path = raw.scratch_path(spark, "golden")
    blocks = reports.collect_aggregates(tables(spark, sf_dir))
    reports.freeze_golden({"por_plataforma_dia": blocks["por_plataforma_dia"]}, path)
    exact = lambda df: df.select("plataforma", F.col("data").cast("date").alias("data"), *(F.col(m).cast("decimal(28,6)").alias(m) for m in METRICS))
    frozen = exact(spark.read.json(f"{path}/por_plataforma_dia"))
    later = exact(blocks["por_plataforma_dia"]).withColumn("spend", (F.col("spend") + F.when(F.day("data") == 9, 1).otherwise(0)).cast("decimal(28,6)"))
    return parity.diff_report(parity.keyed_diff(frozen, later, ["plataforma", "data"], METRICS))
