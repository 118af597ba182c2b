"""Raw records: reading JSON, dating, appending with an audit log, manifests, CSV and Parquet in and out."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import parsed_date
from tidemark.operators.quality import not_null
from tidemark.sources.registry import SOURCES, Source

MANIFEST_VERSION = 1
MANIFEST = "versao int, fonte string, run_id string, start_date string, end_date string, extraido_em string, registros long, sha256 string"
LOG = "batch_id string, source string, start_date date, end_date date, row_count long, ingested_at timestamp"


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """One row a record, as VARIANT column `payload`, of files that hold one JSON array each. No file, or an empty one, has no records; a missing file is warned of."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where):
        warnings.warn(f"there is no file at {path}", stacklevel=2)
        return spark.createDataFrame([], "payload variant")
    docs = spark.read.format("json").option("multiLine", True).option("singleVariantColumn", "doc").load(path)
    return docs.select(F.explode(F.variant_get("doc", "$", "array<variant>")).alias("payload"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """As read_json_array for files with one record a line, which can be split."""
    return spark.read.format("json").option("singleVariantColumn", "payload").load(path)


def dated(records: DataFrame, source: Source, batch_id: str | None = None, extracted_at: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows of the raw table, rejected ones, whose date is missing or invalid). Batch and instant are stamped once."""
    stamp = extracted_at or dt.datetime.now(dt.UTC)
    rows = records.select(
        F.lit(source.name).alias("source"),
        parsed_date(F.variant_get("payload", f"$.{source.date_field}", "string")).alias("reference_date"),
        F.lit(stamp.astimezone(dt.UTC).isoformat()).cast("timestamp").alias("extracted_at"),
        F.lit(batch_id or str(uuid.uuid4())).alias("batch_id"),
        "payload",
    )
    return rows.where("reference_date is not null"), not_null(rows, "reference_date")


def ingestion_log(raw: DataFrame) -> DataFrame:
    """One row for each batch that has rows."""
    return raw.groupBy("batch_id", "source").agg(F.min("reference_date").alias("start_date"), F.max("reference_date").alias("end_date"), F.count("*").alias("row_count"), F.max("extracted_at").alias("ingested_at")).select("batch_id", "source", "start_date", "end_date", "row_count", "ingested_at")


def constraint_violations(rows: DataFrame) -> DataFrame:
    """Source, problem and rows of what the raw table doesn't take: sources that aren't registered, and nulls in its columns."""
    known = F.col("source").isin([s.name for s in SOURCES.values()])
    wrong = {"unknown source": F.col("source").isNotNull() & ~known} | {f"null {c}": F.col(c).isNull() for c in ("source", "reference_date", "extracted_at", "batch_id", "payload")}
    return rows.select("source", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in wrong.items())))).alias("problem")).groupBy("source", "problem").agg(F.count("*").alias("rows"))


def append_bronze(raw: DataFrame, path: str) -> None:
    """Appends rows, partitioned by source and day; nothing is ever updated. A large day is split over several tasks."""
    raw.hint("rebalance", "source", "reference_date").write.mode("append").partitionBy("source", "reference_date").parquet(path)


def load_sources(parts: list[DataFrame], bronze: str, log: str) -> DataFrame:
    """Appends several sources in one job; the log rows, written afterwards, are the commit mark that readers join."""
    rows = reduce(DataFrame.unionByName, parts)
    if broken := constraint_violations(rows).select("problem").distinct().collect():
        raise ValueError("; ".join(sorted(r["problem"] for r in broken)))
    append_bronze(rows, bronze)
    spark = rows.sparkSession
    # sources and days are the table's partitions, so only those of this load are read
    loaded = rows.select("source", "reference_date", "batch_id").distinct()
    entries = ingestion_log(read_bronze(spark, bronze).join(loaded, ["source", "reference_date", "batch_id"], "left_semi"))
    entries.coalesce(1).write.mode("append").parquet(log)
    return entries


def read_bronze(spark: SparkSession, bronze: str, log: str | None = None) -> DataFrame:
    """The raw table; with a log, only batches that were committed."""
    rows = spark.read.parquet(bronze)
    return rows if log is None else rows.join(spark.read.parquet(log).select("batch_id"), "batch_id", "left_semi")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and SHA-256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def folder_hash(spark: SparkSession, path: str) -> DataFrame:
    """One row: the SHA-256 of the hashes of a folder's files in the order of their names. Only names and hashes meet in one place."""
    files = F.array_sort(F.collect_list(F.struct(F.substring_index("path", "/", -1).alias("name"), "sha256")))
    return file_hashes(spark, path).agg(F.sha2(F.array_join(files["sha256"], "\n"), 256).alias("sha256"))


def write_manifest(spark: SparkSession, artifact: str, target: str, source: Source, run_id: str, start: str, end: str, records: int) -> None:
    """Describes an artifact beside it: what it is, its window and its content's hash."""
    made = dt.datetime.now(dt.UTC).isoformat()
    fields = [F.lit(MANIFEST_VERSION).alias("versao"), F.lit(source.name).alias("fonte"), F.lit(run_id).alias("run_id"), F.lit(start).alias("start_date"), F.lit(end).alias("end_date"), F.lit(made).alias("extraido_em"), F.lit(records).cast("long").alias("registros"), "sha256"]
    file_hashes(spark, artifact).select(*fields).coalesce(1).write.mode("overwrite").json(target)


def validate_artifacts(hashes: DataFrame, manifests: DataFrame, source: Source, run_id: str, start: str, end: str) -> DataFrame:
    """All problems of a source's artifacts against their manifests, one a row; none is valid. Zero records are legitimate, an unreadable manifest has every problem."""
    both = manifests.withColumn("described", F.lit(True)).alias("m").join(hashes.select("path", F.col("sha256").alias("found")).alias("h"), F.col("m.sha256") == F.col("found"), "full_outer")
    other = lambda c, v: F.col("described") & ~F.col(c).eqNullSafe(F.lit(v))
    wrong = {
        "version": other("versao", MANIFEST_VERSION), "source": other("fonte", source.name), "run": other("run_id", run_id), "window": other("start_date", start) | other("end_date", end),
        "no number of records": F.col("described") & F.coalesce(F.col("registros") < 0, F.lit(True)), "no file of this content": F.col("path").isNull(), "no manifest of this content": F.col("m.sha256").isNull() & F.col("path").isNotNull(),
    }
    problems = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in wrong.items())))
    return both.select("path", F.explode(problems).alias("problem"))


def load_verified(spark: SparkSession, artifacts: Mapping[Source, tuple[str, str]], run_id: str, start: str, end: str, bronze: str, log: str, batch_id: str | None = None) -> DataFrame:
    """Loads the artifacts of a run, source -> (artifact, manifest), all or none: every source is checked before anything is appended.

    A missing manifest, one of another run or window, another content, another number of records, or records without a date refuse the load.
    """
    found, parts = [], []
    for source, (artifact, manifest) in artifacts.items():
        described = spark.read.schema(MANIFEST).json(manifest)
        if described.limit(1).count() == 0:
            found.append(f"{source.name}: no manifest")
            continue
        found += [f"{source.name}: {r['problem']}" for r in validate_artifacts(file_hashes(spark, artifact), described, source, run_id, start, end).select("problem").distinct().collect()]
        good, bad = dated(read_json_array(spark, artifact), source, batch_id)
        counts = good.unionByName(bad).agg(F.count("*").alias("n"), F.count_if(F.col("reference_date").isNull()).alias("bad")).join(described.agg(F.sum("registros").alias("registros")), F.lit(True)).first()
        found += [f"{source.name}: another number of records"] * (counts["n"] != counts["registros"]) + [f"{source.name}: records without a date"] * (counts["bad"] > 0)
        parts.append(good)
    if found:
        raise ValueError("; ".join(sorted(found)))
    return load_sources(parts, bronze, log)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose cells stay text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as exact text; decimals without trailing zeros."""
    text = lambda c, kind: F.regexp_replace(F.col(c).cast("string"), r"\.?0+$", "") if kind.startswith("decimal") and not kind.endswith(",0)") else F.col(c).cast("string")
    return df.select(*(text(c, kind).alias(c) for c, kind in df.dtypes))


def ranged(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Rows dealt to sorted ranges of the keys; without `parts` there are as many as their size asks for, so that no task's sort grows with the table."""
    dealt = df.repartitionByRange(*keys) if parts is None else df.repartitionByRange(parts, *keys)
    return dealt.sortWithinPartitions(*keys)


def write_sorted_csv(df: DataFrame, path: str, keys: list[str], parts: int | None = None) -> None:
    """CSV parts in the order of the keys, with exact decimals as text; Spark's job commit publishes them together."""
    ranged(as_text(df), keys, parts).write.mode("overwrite").csv(path, header=True)


def write_sorted_json(df: DataFrame, path: str, parts: int | None = None) -> None:
    """JSON lines in the order of their text."""
    lines = df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value"))
    ranged(lines, ["value"], parts).write.mode("overwrite").text(path)


def write_fact(df: DataFrame, path: str, key: str = "anuncio_id", day: str = "data") -> None:
    """A flat fact as Parquet with Snappy, in ranges of its key, so that a look-up of one key reads few row groups."""
    df.repartitionByRange(key, day).sortWithinPartitions(key, day).write.mode("overwrite").option("compression", "snappy").parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share; a local session without that setting gets a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows and an order-insensitive sum of row hashes; repeated rows count."""
    return df.agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("fingerprint"))


def merged(parts: list[DataFrame], key: str, keep: Column | None = None) -> DataFrame:
    """The union of tables by key; of equal keys the row of the last table wins, then of all the rows that pass `keep`."""
    ranked = reduce(DataFrame.unionByName, (df.withColumn("_rank", F.lit(i)) for i, df in enumerate(parts)))
    first = ranked.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_rank"), *(c for c in parts[0].columns if c != key))))
    out = first.where("_n = 1").drop("_n", "_rank")
    return out if keep is None else out.where(keep)


def flattened(df: DataFrame, payload: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Nested records as flat columns: name -> (path, type)."""
    return df.select(*(F.variant_get(payload, f"$.{path}", kind).alias(name) for name, (path, kind) in fields.items()))


def generated_fact(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    """A synthetic flat fact of about so many rows: spend log-normal, impressions from its price, clicks and conversions from rates by ad.

    The number of ads grows with the square root of the rows, the rest are days; a hierarchy follows from the ad's number.
    """
    ads = max(50, int(3 * rows**0.5))
    days = max(1, rows // ads)
    ids = spark.range(ads * days).select((F.col("id") % ads).alias("anuncio_id"), F.floor(F.col("id") / ads).cast("int").alias("day"))
    rate = lambda salt, low, high: low + (high - low) * F.pmod(F.xxhash64("anuncio_id", F.lit(salt + seed)), F.lit(10_000)) / 10_000
    base = ids.withColumn("spend", F.round(F.exp(2.5 + 1.2 * F.randn(seed)), 2)).withColumn("impressions", F.greatest(F.lit(1), F.round(F.col("spend") / (8 + 14 * F.rand(seed + 1)) * 1000)).cast("long"))
    base = base.withColumn("link_clicks", F.round(F.col("impressions") * rate(1, 0.005, 0.03)).cast("long")).withColumn("conversions", F.round(F.col("link_clicks") * rate(2, 0.01, 0.08), 2))
    return base.select(
        "anuncio_id", F.floor(F.col("anuncio_id") / 3).alias("adset_id"), F.floor(F.col("anuncio_id") / 9).alias("campanha_id"), F.floor(F.col("anuncio_id") / 36).alias("conta_id"),
        (F.col("anuncio_id") % 2 + 1).cast("int").alias("plataforma_id"), F.date_add(F.lit("2023-01-01").cast("date"), F.col("day")).alias("data"), "spend", "impressions", "link_clicks", "conversions",
        F.round(F.col("conversions") * rate(3, 20, 200), 2).alias("conversion_value"), F.round(F.col("impressions") * 0.1).cast("long").alias("video_views"), F.round(F.col("impressions") * 0.7).cast("long").alias("reach"),
    )
