"""Publishing: an artifact is written aside, read back, checked and described, and only then takes the place of the former one.

Whatever fails before leaves the former artifact as it was. The swap is two renames of folders; on a store without atomic renames a reader
may see neither for a moment.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import exposure
from tidemark.plans.incremental import aside
from tidemark.sources import raw
from tidemark.sources.registry import LEVELS, METRICS

CONTRACT_VERSION = 1
#: Fixed values of the artifact's format.
DATA_NAME, MANIFEST_NAME = "metricas.csv", "manifesto.json"
GRAIN = "1 anuncio x 1 dia (anuncio_id, data)"
TYPES = {"data": "date", "plataforma": "text", **{f"{x}_{c}": "text" if c == "id" else "integer" for x in LEVELS for c in ("id", "versao")}, **{m: "decimal" if m in ("spend", "conversions", "conversion_value") else "integer" for m in METRICS}}
WARNINGS = {
    "video_views": "the platforms define a view differently; don't add it up over platforms",
    "metricas_ausentes_no_google": "reach, profile_views and purchases are zero for want of support, not of data",
}


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def swap(spark: SparkSession, partial: str, target: str) -> None:
    """Puts a finished folder in the place of another; the former one comes back if that fails."""
    old, new, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, partial, f"{target}.former"))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(aside, True)
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError("the former artifact can't be moved")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError("the artifact can't be moved to its place")
    fs.delete(aside, True)


def _described(rows: DataFrame, day: str, fields: dict, data: str) -> DataFrame:
    """One row: the given fields, those that come from the rows, and the hash of the files."""
    made = dt.datetime.now(dt.UTC).isoformat(timespec="seconds")
    counted = rows.agg(F.count("*").alias("linhas"), F.min(day).cast("string").alias("data_min"), F.max(day).cast("string").alias("data_max"))
    return counted.join(raw.folder_hash(rows.sparkSession, data), F.lit(True)).withColumns({"gerado_em": F.lit(made), **fields})


def _text_map(values: dict[str, str]):
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def export(view: DataFrame, key: str | None, target: str, published: str, allow: bool = False, parts: int | None = None, blocks: int = 1) -> DataFrame:
    """Exports a view as sorted CSV with a manifest beside it, and returns the manifest.

    Refused are the publication folder (unless allowed), a bad key, columns that nobody classified, an empty view, and an artifact that
    fails any post-check. The checks read what was written. Several jobs read the view, so pass a stored one. A part file must stay
    below 2 GB; without `parts` their number follows the size. Labels of one block of digits are shared, and so refused, from some
    65,000 entities on: take `blocks` = exposure.WIDE for more.
    """
    target = exposure.guard_target(target.rstrip("/"), published, allow)
    secret = exposure.checked_key(key)
    artifact = exposure.exposed(view, secret, blocks)
    spark, partial = view.sparkSession, f"{target}.partial"
    if view.limit(1).count() == 0:
        raise ValueError("the view has no rows")
    try:
        data = f"{partial}/{DATA_NAME}"
        raw.write_sorted_csv(artifact, data, ["data", "plataforma", *(f"{level}_id" for level in LEVELS)], parts)
        back = raw.read_text_csv(spark, data)
        back = back.select(*(F.col(c).cast(kind).alias(c) for c, kind in artifact.dtypes))
        if problems := [r["problem"] for r in exposure.post_checks(view, back).collect()]:
            raise ValueError("; ".join(sorted(problems)))
        entities = back.agg(F.struct(*(F.count_distinct(f"{level}_id").alias(level) for level in LEVELS)).alias("cardinalidades"))
        fields = {
            "versao_contrato": F.lit(CONTRACT_VERSION), "artefato": F.lit(DATA_NAME), "colunas": F.array(*(F.lit(c) for c in exposure.EXPORTED)), "tipos": _text_map(TYPES),
            "grao": F.lit(GRAIN), "fingerprint_chave": F.lit(exposure.key_fingerprint(secret)), "avisos": _text_map(WARNINGS), "blocos_rotulo": F.lit(blocks),
        }
        _described(back, "data", fields, data).join(entities, F.lit(True)).coalesce(1).write.mode("overwrite").json(f"{partial}/{MANIFEST_NAME}")
        swap(spark, partial, target)
    finally:
        _delete(spark, partial)
    return spark.read.json(f"{target}/{MANIFEST_NAME}")


def publish_anonymised(rows: DataFrame, source: str, platform: str, key: str | None, target: str, allowed: list[str] = exposure.ALLOWED_LABELS, parts: int | None = None, blocks: int = 1) -> DataFrame:
    """Writes the anonymised records of a source (`row_id`, VARIANT `payload`) as sorted JSON lines with a manifest, which is returned.

    Refused are records that break the contract or hold labels that aren't allowed, labels of two identities, values that changed or
    identifiers that didn't, and files that read back differently. Several jobs read the rows, so pass stored ones. Records are made once
    and stored beside their payloads, so that both are compared in a row. `blocks` of digits as in export.
    """
    secret, contract = exposure.checked_key(key), exposure.CONTRACTS[source]
    spark, target = rows.sparkSession, target.rstrip("/")
    of = lambda *uses: [k for k, f in contract.items() if f.use in uses]
    found = exposure.contract_violations(rows, source).select("problem")
    if nested := of(exposure.NESTED):
        found = found.unionByName(exposure.nested_violations(rows, nested, allowed).select("problem"))
    _refuse(found)
    records = aside(exposure.anonymised_raw(rows, source, platform, secret, blocks, carried=["payload"]), "records")
    if records.count() != rows.count():
        raise ValueError("records were lost")
    text = lambda payload, prefix: [F.variant_get(payload, f"$.{k}", "string").alias(f"{prefix}{k}") for k in contract]
    both = records.withColumn("after", F.parse_json("record")).select(*text("payload", ""), *text("after", "_"))
    names = {k: k.rsplit("_", 1)[0] + "_id" for k in of(exposure.NAME)}
    _refuse(both.select(F.explode(exposure.preservation_problems(of(exposure.DAY, exposure.METRIC_FIELD, exposure.NESTED), of(exposure.ID, exposure.NAME), names)).alias("problem")))
    labels = both.select(F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.col(k).alias("identity"), F.col(f"_{k}").alias("label")) for k in names.values()))).alias("x")).select("x.*")
    _refuse(exposure.label_collisions(labels, ["level"], "label", "identity").select(F.concat(F.lit("one label for two of "), "level").alias("problem")))
    partial = f"{target}.partial"
    try:
        data = f"{partial}/records.json"
        lines = records.select(F.col("record").alias("value"))
        raw.ranged(lines, ["value"], parts).write.mode("overwrite").text(data)
        back = spark.read.text(data)
        if raw.fingerprint(back).first() != raw.fingerprint(lines).first():
            raise ValueError("the records read back differently")
        day = of(exposure.DAY)[0]
        fields = {
            "versao": F.lit(CONTRACT_VERSION), "fonte": F.lit(source), "arquivo": F.lit("records.json"), "campos_esperados": F.array(*(F.lit(k) for k in contract)),
            "classificacao": _text_map({k: f.use for k, f in contract.items()}), "fingerprint_chave": F.lit(exposure.key_fingerprint(secret)), "blocos_rotulo": F.lit(blocks),
        }
        _described(back.select(F.variant_get(F.parse_json("value"), f"$.{day}", "string").alias(day)), day, fields, data).coalesce(1).write.mode("overwrite").json(f"{partial}/{MANIFEST_NAME}")
        swap(spark, partial, target)
    finally:
        _delete(spark, partial)
    return spark.read.json(f"{target}/{MANIFEST_NAME}")


def _refuse(problems: DataFrame) -> None:
    """Raises if there is any problem, naming some of the kinds."""
    if kinds := [r["problem"] for r in problems.distinct().limit(20).collect()]:
        raise ValueError("; ".join(sorted(kinds)))
