"""The registered queries on the given tables, each with the SQL that must give the same rows.

An entry declares its output columns with their types once; both sides are cast to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import audit, exposure, parity, quality, snapshots
from tidemark.operators.dimensional import top_k
from tidemark.plans import reports, samples, staging
from tidemark.plans.samples import FLAT_SQL, RAW_SQL, SILVER_SQL, STAR_SQL, flat_fact, raw_records, table, tables, view_sql
from tidemark.plans.publish import DATA_NAME, export, publish_anonymised
from tidemark.plans.star import checks, consumption, materialise
from tidemark.sources import raw
from tidemark.sources.registry import LEVELS, METRICS, SOURCES

#: A key for demonstrations on synthetic data; a real one comes from the caller.
DEMO_KEY = b"demonstration key of synthetic data only"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_SQL_TYPES = {"string": "VARCHAR", "timestamp": "TIMESTAMP"}
M = {m: "decimal(18,6)" if m in ("spend", "conversions", "conversion_value") else "bigint" for m in METRICS}
MONEY = "decimal(18,6)"


def query(columns: str | dict[str, str], sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name. `columns`: names with types, as a mapping or "a bigint, b string"."""
    kinds = columns if isinstance(columns, dict) else dict(c.strip().split(" ", 1) for c in columns.replace("decimal(18,6)", "money").split(", "))
    kinds = {c: MONEY if k == "money" else k for c, k in kinds.items()}

    def wrap(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, sf_dir).select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items()))
        if sql is not None:
            ORACLES[f.__name__] = f"SELECT {', '.join(f'CAST(\"{c}\" AS {_SQL_TYPES.get(k, k.upper())}) AS \"{c}\"' for c, k in kinds.items())} FROM ({sql}) AS q"
        return f

    return wrap


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumption(tables(spark, sf_dir))


# Reports on the consumption view; the first is the flagship.

_COMPARISON = "plataforma string, linhas bigint, investimento money, impressoes bigint, cliques bigint, conversoes money, ctr_pct money, cpc money, cpa money"


@query(_COMPARISON, f"""WITH {view_sql()} SELECT plataforma, count(*) linhas, round(sum(spend), 2) investimento, sum(impressions) impressoes, sum(link_clicks) cliques, round(sum(conversions), 2) conversoes,
  round(100.0 * sum(link_clicks) / nullif(sum(impressions), 0), 2) ctr_pct, round(CAST(sum(spend) AS DOUBLE) / nullif(CAST(sum(link_clicks) AS DOUBLE), 0), 2) cpc, round(CAST(sum(spend) AS DOUBLE) / nullif(CAST(sum(conversions) AS DOUBLE), 0), 2) cpa FROM vw GROUP BY plataforma""")
def platform_comparison(spark, sf_dir):
    return reports.platform_comparison(_view(spark, sf_dir))


@query("plataforma string, conta_nome string, campanha_nome string, investimento money, impressoes bigint, cliques bigint, ctr_pct money", f"""WITH {view_sql()} SELECT plataforma, conta_nome, campanha_nome, round(sum(spend), 2) investimento, sum(impressions) impressoes, sum(link_clicks) cliques,
  round(100.0 * sum(link_clicks) / nullif(sum(impressions), 0), 2) ctr_pct FROM vw GROUP BY 1, 2, 3 ORDER BY investimento DESC, 1, 2, 3 LIMIT 10""")
def top_campaigns(spark, sf_dir):
    return reports.top_campaigns(_view(spark, sf_dir))


@query("data date, dia_semana bigint, investimento money, impressoes bigint, anuncios_com_entrega bigint", f"WITH {STAR_SQL} SELECT t.data, t.dia_semana, round(sum(f.spend), 2) investimento, sum(f.impressions) impressoes, count(*) anuncios_com_entrega FROM fato_metricas f JOIN dim_tempo t ON t.tempo_sk = f.tempo_sk GROUP BY 1, 2")
def daily_series(spark, sf_dir):
    return reports.daily_series(tables(spark, sf_dir))


@query("plataforma string, linhas bigint, com_reach bigint, com_video_views bigint, com_conversoes bigint, com_compras bigint", f"WITH {view_sql()} SELECT plataforma, count(*) linhas, count(*) FILTER (WHERE reach > 0) com_reach, count(*) FILTER (WHERE video_views > 0) com_video_views, count(*) FILTER (WHERE conversions > 0) com_conversoes, count(*) FILTER (WHERE purchases > 0) com_compras FROM vw GROUP BY 1")
def metric_coverage(spark, sf_dir):
    return reports.metric_coverage(_view(spark, sf_dir))


@query("external_id string, versao bigint, valido_de date, valido_ate date, nome string, linhas_do_fato bigint, investimento money", f"""WITH {view_sql()} SELECT c.external_id, c.versao, c.valido_de, c.valido_ate, c.nome, count(*) linhas_do_fato, round(sum(v.spend), 2) investimento
  FROM vw v JOIN dim_campanha c ON c.campanha_nk = v.campanha_nk AND c.versao = v.campanha_versao WHERE c.campanha_nk IN (SELECT campanha_nk FROM dim_campanha GROUP BY 1 HAVING count(*) > 1) GROUP BY 1, 2, 3, 4, 5""")
def rename_history(spark, sf_dir):
    t = tables(spark, sf_dir)
    return reports.rename_history(t, consumption(t))


@query("nivel string, versao bigint, linhas bigint", f"WITH {view_sql()} " + " UNION ALL ".join(f"SELECT '{x}' nivel, {x}_versao versao, count(*) linhas FROM vw GROUP BY 2" for x in LEVELS))
def version_distribution(spark, sf_dir):
    return reports.version_distribution(_view(spark, sf_dir))


@query("object string, rows bigint", f"WITH {STAR_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS object, count(*) AS rows FROM {t}" for n, t in [("stg_ads_unified", "silver"), ("dim_plataforma", "dim_plataforma"), *((f"dim_{x}", f"dim_{x}") for x in LEVELS), ("dim_tempo", "dim_tempo"), ("fato_metricas", "fato_metricas")]))
def layer_volumetry(spark, sf_dir):
    return reports.layer_volumetry(tables(spark, sf_dir))


@query("anuncio_sk string, tempo_sk string, occurrences bigint", f"WITH {STAR_SQL} SELECT anuncio_sk, tempo_sk, count(*) occurrences FROM fato_metricas GROUP BY 1, 2 HAVING count(*) > 1")
def idempotency_proof(spark, sf_dir):
    return reports.idempotency_proof(tables(spark, sf_dir))


@query({"plataforma": "string", "data": "date", **dict.fromkeys(METRICS, MONEY)}, f"WITH {view_sql()} SELECT plataforma, data, {', '.join(f'sum({m}) {m}' for m in METRICS)} FROM vw GROUP BY 1, 2")
def golden_by_platform_day(spark, sf_dir):
    return reports.collect_aggregates(tables(spark, sf_dir))["por_plataforma_dia"]


@query("objeto string, linhas bigint, entidades bigint", f"WITH {STAR_SQL} " + " UNION ALL ".join(f"SELECT 'dim_{x}' objeto, count(*) linhas, count(DISTINCT {x}_nk) entidades FROM dim_{x}" for x in LEVELS))
def golden_counts(spark, sf_dir):
    return reports.collect_aggregates(tables(spark, sf_dir))["contagens"]


@query({"linhas": "bigint", **{m: MONEY for m in METRICS}}, f"WITH {STAR_SQL} SELECT count(*) linhas, {', '.join(f'sum({m}) {m}' for m in METRICS)} FROM fato_metricas")
def golden_fact_totals(spark, sf_dir):
    return reports.collect_aggregates(tables(spark, sf_dir))["totais_fato"]


@query("linhas bigint, spend money", f"WITH {view_sql()} SELECT count(*) linhas, sum(spend) spend FROM vw")
def golden_traversal(spark, sf_dir):
    return reports.collect_aggregates(tables(spark, sf_dir))["travessia"]


# Layers.


@query("object string, rows bigint", f"WITH {STAR_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS object, count(*) AS rows FROM {t}" for n, t in [("stg_ads_unified", "silver"), ("dim_plataforma", "dim_plataforma"), *((f"dim_{x}", f"dim_{x}") for x in LEVELS), ("dim_tempo", "dim_tempo"), ("fato_metricas", "fato_metricas")]))
def stored_layers(spark, sf_dir):
    """The star as stored tables, counted."""
    return reports.layer_volumetry(materialise(staging.silver(raw_records(spark, sf_dir)), raw.scratch_path(spark, "layers")))


@query("batch_id string, source string, start_date date, end_date date, row_count bigint", f"WITH {RAW_SQL} SELECT substr(source, 1, 1) || extracted_day batch_id, source, min(reference_date) start_date, max(reference_date) end_date, count(*) row_count FROM raw GROUP BY 1, 2")
def bronze_load(spark, sf_dir):
    """Raw records appended to a stored raw table; the log of the committed batches as read back."""
    where = raw.scratch_path(spark, "bronze")
    raw.load_sources([raw_records(spark, sf_dir).drop("row_id")], f"{where}/raw", f"{where}/log")
    return raw.ingestion_log(raw.read_bronze(spark, f"{where}/raw", f"{where}/log"))


@query("problem string, rows bigint", "SELECT unnest(['null extracted_at', 'null payload', 'null reference_date', 'unknown source']) problem, unnest([count(*) FILTER (WHERE event_id % 5 = 0), count(*) FILTER (WHERE props IS NULL), count(*) FILTER (WHERE user_id % 7 = 0), count(*) FILTER (WHERE user_id % 3 = 0)]) AS rows FROM events")
def raw_constraints(spark, sf_dir):
    """`events` as raw rows of which some break the raw table's constraints; a constraint that holds has 0 rows."""
    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.when(F.col("user_id") % 3 == 0, "other").otherwise("meta_ads").alias("source"), F.when(F.col("user_id") % 7 != 0, F.to_date("ts")).alias("reference_date"), F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("extracted_at"),
        F.lit("b").alias("batch_id"), F.parse_json("props").alias("payload"),
    )
    known = spark.createDataFrame([(p,) for p in ("null extracted_at", "null payload", "null reference_date", "unknown source")], "problem string")
    found = raw.constraint_violations(rows).groupBy("problem").agg(F.sum("rows").alias("rows"))
    return known.join(found, "problem", "full_outer").select("problem", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("accepted bigint, rejected bigint, first_day date, last_day date", "SELECT count(*) FILTER (WHERE user_id % 4 > 0) accepted, count(*) FILTER (WHERE user_id % 4 = 0) rejected, min(CAST(ts AS DATE)) FILTER (WHERE user_id % 4 > 0) first_day, max(CAST(ts AS DATE)) FILTER (WHERE user_id % 4 > 0) last_day FROM events")
def dated_records(spark, sf_dir):
    """`events` as records whose date is missing, empty, impossible or not a date for every fourth user: accepted and rejected."""
    e = table(spark, sf_dir, "events")
    bad = F.element_at(F.array(F.lit(None).cast("string"), F.lit(""), F.lit("2026-02-30"), F.lit("soon")), (F.col("event_id") % 4 + 1).cast("int"))
    records = e.select(F.parse_json(F.to_json(F.struct(F.when(F.col("user_id") % 4 == 0, bad).otherwise(F.to_date("ts").cast("string")).alias("date_start")))).alias("payload"))
    good, rejected = raw.dated(records, SOURCES["meta"], "b")
    n = good.agg(F.count("*").alias("accepted"), F.min("reference_date").alias("first_day"), F.max("reference_date").alias("last_day"))
    return n.join(rejected.agg(F.count("*").alias("rejected")), F.lit(True))


@query({"source": "string", "reference_date": "date", "extracted_day": "date", "ad": "string", "spend": MONEY}, f"WITH {RAW_SQL} SELECT source, reference_date, extracted_day, anuncio_external_id ad, spend FROM raw r WHERE extracted_day = (SELECT max(extracted_day) FROM raw x WHERE x.source = r.source AND x.reference_date = r.reference_date)")
def latest_snapshot(spark, sf_dir):
    return _amounts(snapshots.latest_snapshot(raw_records(spark, sf_dir), ["source", "reference_date"], "extracted_at"))


def _amounts(df: DataFrame) -> DataFrame:
    spend = F.coalesce(F.variant_get("payload", "$.spend", C.METRIC), F.variant_get("payload", "$.cost", C.METRIC), F.lit(0).cast(C.METRIC))
    return df.select("source", "reference_date", F.to_date("extracted_at").alias("extracted_day"), F.variant_get("payload", "$.ad_id", "string").alias("ad"), spend.alias("spend"))


@query({"source": "string", "reference_date": "date", "extracted_day": "date", "ad": "string", "spend": MONEY}, f"WITH {RAW_SQL} SELECT source, reference_date, extracted_day, anuncio_external_id ad, spend FROM (SELECT *, dense_rank() OVER (PARTITION BY source, reference_date ORDER BY extracted_day DESC) r FROM raw) WHERE r = 2")
def previous_snapshot(spark, sf_dir):
    return _amounts(snapshots.nth_snapshot(raw_records(spark, sf_dir), ["source", "reference_date"], "extracted_at", 2))


@query("source string, reference_date date, previous_amount money, current_amount money, drift money", f"""WITH {RAW_SQL}, r AS (SELECT *, dense_rank() OVER (PARTITION BY source, reference_date ORDER BY extracted_day DESC) r FROM raw)
  SELECT source, reference_date, round(sum(spend) FILTER (WHERE r = 2), 2) previous_amount, round(sum(spend) FILTER (WHERE r = 1), 2) current_amount, round(sum(spend) FILTER (WHERE r = 1) - sum(spend) FILTER (WHERE r = 2), 2) drift FROM r WHERE r <= 2 GROUP BY 1, 2 HAVING count(*) FILTER (WHERE r = 2) > 0""")
def snapshot_drift(spark, sf_dir):
    return reports.spend_drift(raw_records(spark, sf_dir))


@query("source string, reference_date date, ad string, lost_amount money", f"""WITH {RAW_SQL}, r AS (SELECT *, dense_rank() OVER (PARTITION BY source, reference_date ORDER BY extracted_day DESC) r FROM raw)
  SELECT source, reference_date, anuncio_external_id ad, sum(spend) lost_amount FROM r WHERE r = 2 AND spend > 0 AND NOT EXISTS (SELECT 1 FROM r x WHERE x.r = 1 AND x.source = r.source AND x.reference_date = r.reference_date AND x.anuncio_external_id = r.anuncio_external_id) GROUP BY 1, 2, 3""")
def lost_spend(spark, sf_dir):
    df = raw_records(spark, sf_dir).withColumn("ad", F.variant_get("payload", "$.ad_id", "string"))
    amount = F.coalesce(F.variant_get("payload", "$.spend", C.METRIC), F.variant_get("payload", "$.cost", C.METRIC), F.lit(0).cast(C.METRIC))
    return snapshots.lost_rows(df, ["source", "reference_date"], "extracted_at", "ad", amount)


@query("batch_id string, source string, start_date date, end_date date, row_count bigint", f"WITH {RAW_SQL} SELECT substr(source, 1, 1) || extracted_day batch_id, source, min(reference_date) start_date, max(reference_date) end_date, count(*) row_count FROM raw GROUP BY 1, 2")
def ingestion_log(spark, sf_dir):
    return raw.ingestion_log(raw_records(spark, sf_dir))


@query("source string, key string, occurrences bigint", f"""WITH {RAW_SQL}, last AS (SELECT source, max(extracted_day) x FROM raw GROUP BY 1), r AS (SELECT raw.* FROM raw JOIN last ON raw.source = last.source AND raw.extracted_day = last.x)
  SELECT source, key, count(*) occurrences FROM (SELECT source, unnest(['reach', 'action_values']) AS key FROM r WHERE source = 'meta_ads' UNION ALL SELECT source, 'cost' FROM r WHERE source = 'google_ads') GROUP BY 1, 2""")
def unconsumed_fields(spark, sf_dir):
    """The check on the newest batches, with three consumed fields left out of what is known so that it has something to find."""
    known = {s.name: staging.consumed(s.name) - {"reach", "action_values", "cost"} for s in SOURCES.values()}
    return quality.unconsumed_keys(snapshots.latest_batch(raw_records(spark, sf_dir), "source", "batch_id", "extracted_at"), "payload", "source", known)


_STG = {"plataforma": "string", "data": "date", **{f"{x}_{c}": "string" for x in LEVELS for c in ("external_id", "nome")}, **M}


@query(_STG, f"WITH {SILVER_SQL} SELECT * FROM silver WHERE source = 'meta_ads'")
def stg_meta_ads(spark, sf_dir):
    return staging.staged(raw_records(spark, sf_dir), SOURCES["meta"])


@query(_STG, f"WITH {SILVER_SQL} SELECT * FROM silver WHERE source = 'google_ads'")
def stg_google_ads(spark, sf_dir):
    return staging.staged(raw_records(spark, sf_dir), SOURCES["google"])


@query(_STG | {"plataforma_sk": "string", **{f"{x}_nk": "string" for x in LEVELS}}, f"WITH {SILVER_SQL} SELECT * FROM silver")
def stg_ads_unified(spark, sf_dir):
    return tables(spark, sf_dir)["stg_ads_unified"]


@query("plataforma_sk string, nome string", f"WITH {STAR_SQL} SELECT * FROM dim_plataforma")
def dim_plataforma(spark, sf_dir):
    return tables(spark, sf_dir)["dim_plataforma"]


def _dimension(level: str, parent: str) -> None:
    def dim(spark, sf_dir):
        return tables(spark, sf_dir)[f"dim_{level}"]

    dim.__name__ = f"dim_{level}"
    query(f"{level}_sk string, {level}_nk string, {parent} string, external_id string, nome string, versao bigint, valido_de date, valido_ate date, is_atual boolean", f"WITH {STAR_SQL} SELECT * FROM dim_{level}")(dim)


for _level, _parent in samples._PARENTS:
    _dimension(_level, _parent)


@query("tempo_sk string, data date, dia bigint, mes bigint, ano bigint, trimestre bigint, dia_semana bigint, ano_mes string", f"WITH {STAR_SQL} SELECT * FROM dim_tempo")
def dim_tempo(spark, sf_dir):
    return tables(spark, sf_dir)["dim_tempo"]


@query({"anuncio_sk": "string", "tempo_sk": "string", **M}, f"WITH {STAR_SQL} SELECT * FROM fato_metricas")
def fato_metricas(spark, sf_dir):
    return tables(spark, sf_dir)["fato_metricas"]


_VIEW = {"data": "date", **dict.fromkeys(["dia", "mes", "ano", "trimestre", "dia_semana"], "bigint"), "ano_mes": "string", "plataforma": "string", **{f"{x}_{c}": "bigint" if c == "versao" else "string" for x in LEVELS for c in ("nk", "external_id", "nome", "versao")}, **M}


@query(_VIEW, f"WITH {view_sql()} SELECT * FROM vw")
def vw_metricas_completas(spark, sf_dir):
    return _view(spark, sf_dir)


@query("joined_rows bigint, fact_rows bigint", f"WITH {view_sql(False)} SELECT * FROM (SELECT (SELECT count(*) FROM vw) joined_rows, (SELECT count(*) FROM fato_metricas) fact_rows) WHERE joined_rows <> fact_rows")
def traversal_without_validity(spark, sf_dir):
    """The wrong traversal, which the row-count check must find."""
    t = tables(spark, sf_dir)
    return quality.same_count(consumption(t, validity=False), t["fato_metricas"])


def _star_checks_sql() -> str:
    """Every declared check as a count of its own, and their outcomes."""
    labels = "(" + ", ".join(f"'{x.label}'" for x in SOURCES.values()) + ")"
    groups = lambda t, by: f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {by} HAVING count(*) > 1)"
    orphans = lambda t, k, u: f"SELECT count(*) FROM {t} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {u})"
    outside = lambda t, c, v: f"SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN {v}"
    counts = {f"silver.{c} not null": f"SELECT count(*) FROM silver WHERE {c} IS NULL" for c in ("data", "plataforma", *(f"{x}_nk" for x in LEVELS))}
    counts |= {"silver.plataforma accepted": outside("silver", "plataforma", labels), "silver grain": groups("silver", "anuncio_nk, data"), "silver metrics not negative": f"SELECT count(*) FROM silver WHERE {' OR '.join(f'{m} < 0' for m in METRICS)}"}
    above = "dim_plataforma"
    for level, parent in samples._PARENTS:
        t = f"dim_{level}"
        counts |= {
            f"{t} key unique": groups(t, f"{level}_sk"), f"{t} key not null": f"SELECT count(*) FROM {t} WHERE {level}_sk IS NULL", f"{t} parent exists": orphans(t, parent, above),
            f"{t} versions apart": f"SELECT count(*) FROM {t} a WHERE EXISTS (SELECT 1 FROM {t} b WHERE b.{level}_nk = a.{level}_nk AND b.versao < a.versao AND b.valido_ate >= a.valido_de)",
            f"{t} one current version": f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {level}_nk HAVING count(*) FILTER (WHERE is_atual) <> 1)",
        }
        above = t
    counts |= {
        "dim_plataforma unique": groups("dim_plataforma", "plataforma_sk"), "dim_plataforma accepted": outside("dim_plataforma", "nome", labels), "dim_tempo unique": groups("dim_tempo", "data"), "dim_tempo weekdays": outside("dim_tempo", "dia_semana", "(1, 2, 3, 4, 5, 6, 7)"), "fact grain": groups("fato_metricas", "anuncio_sk, tempo_sk"),
        "fact ad exists": orphans("fato_metricas", "anuncio_sk", "dim_anuncio"), "fact day exists": orphans("fato_metricas", "tempo_sk", "dim_tempo"), "traversal keeps rows": "SELECT CASE WHEN (SELECT count(*) FROM vw) = (SELECT count(*) FROM fato_metricas) THEN 0 ELSE 1 END",
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS \"check\", ({count}) violations" for name, count in counts.items())
    return f"WITH {view_sql()} SELECT \"check\", 'error' severity, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END outcome FROM ({rows})"


@query("check string, severity string, violations bigint, outcome string", _star_checks_sql())
def star_checks(spark, sf_dir):
    return quality.report(spark, checks(tables(spark, sf_dir)))


# Quality checks on the relational tables.


@query("l_orderkey bigint, l_linenumber bigint, occurrences bigint", "SELECT l_orderkey, l_linenumber, count(*) occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("c_custkey bigint, day date, occurrences bigint", "SELECT o_custkey c_custkey, CAST(o_orderdate AS DATE) AS day, count(*) occurrences FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def check_grain(spark, sf_dir):
    return quality.unique_grain(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day")), "c_custkey", "day")


@query("o_orderstatus string, occurrences bigint", "SELECT o_orderstatus, count(*) occurrences FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def check_accepted_values(spark, sf_dir):
    return quality.accepted_values(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query("o_orderkey bigint, o_custkey bigint", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')")
def check_relationships(spark, sf_dir):
    return quality.relationships(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey")


@query("c_custkey bigint", "SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def check_non_negative(spark, sf_dir):
    return quality.non_negative(table(spark, sf_dir, "customer"), ["c_acctbal"])


@query("o_custkey bigint", "SELECT o_custkey FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON c_custkey = o_custkey WHERE c_custkey IS NULL")
def check_not_null(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").where("c_acctbal >= 0"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return quality.not_null(joined, "c_custkey")


@query("l_partkey bigint, least_parent bigint, greatest_parent bigint", "SELECT l_partkey, min(l_suppkey) least_parent, max(l_suppkey) greatest_parent FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def check_one_parent(spark, sf_dir):
    return quality.one_parent(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


_SPANS_SQL = "SELECT o_custkey nk, CAST(o_orderdate AS DATE) valid_from, CAST(o_orderdate AS DATE) + 30 valid_to, o_orderstatus = 'O' is_current FROM orders"


def _spans(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("nk"), day.alias("valid_from"), F.date_add(day, 30).alias("valid_to"), (F.col("o_orderstatus") == "O").alias("is_current"))


@query("nk bigint, valid_from date, valid_to date, held_until date", f"SELECT * FROM (SELECT *, max(valid_to) OVER (PARTITION BY nk ORDER BY valid_from, valid_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) held_until FROM ({_SPANS_SQL})) WHERE valid_from <= held_until")
def check_overlaps(spark, sf_dir):
    return quality.overlaps(_spans(spark, sf_dir))


@query("nk bigint, n_current bigint", f"SELECT nk, count(*) FILTER (WHERE is_current) n_current FROM ({_SPANS_SQL}) GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1")
def check_one_current(spark, sf_dir):
    return quality.one_current(_spans(spark, sf_dir))


# The five access profiles, and top-k.


@query("plataforma_id bigint, linhas bigint, investimento money, impressoes bigint, cliques bigint, conversoes money", f"WITH {FLAT_SQL} SELECT plataforma_id, count(*) linhas, sum(spend) investimento, sum(impressions) impressoes, sum(link_clicks) cliques, sum(conversions) conversoes FROM fact GROUP BY 1")
def bench_q1_full_scan(spark, sf_dir):
    return reports.full_scan(flat_fact(spark, sf_dir))


@query("ano bigint, mes bigint, investimento money, ctr double, cpc double, cpa double", f"WITH {FLAT_SQL} SELECT year(data) ano, month(data) mes, sum(spend) investimento, round(CAST(sum(link_clicks) AS DOUBLE) / nullif(CAST(sum(impressions) AS DOUBLE), 0), 9) ctr, round(CAST(sum(spend) AS DOUBLE) / nullif(CAST(sum(link_clicks) AS DOUBLE), 0), 4) cpc, round(CAST(sum(spend) AS DOUBLE) / nullif(CAST(sum(conversions) AS DOUBLE), 0), 4) cpa FROM fact GROUP BY 1, 2")
def bench_q2_monthly(spark, sf_dir):
    out = reports.monthly_series(flat_fact(spark, sf_dir))
    return out.withColumns({"ctr": F.round(F.col("ctr").cast("double"), 9), "cpc": F.round(F.col("cpc").cast("double"), 4), "cpa": F.round(F.col("cpa").cast("double"), 4)})


@query("campanha_id bigint, investimento money, impressoes bigint, anuncios bigint", f"WITH {FLAT_SQL} SELECT campanha_id, sum(spend) investimento, sum(impressions) impressoes, count(DISTINCT anuncio_id) anuncios FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def bench_q3_top_campaigns(spark, sf_dir):
    return reports.top_by_spend(flat_fact(spark, sf_dir))


@query("plataforma_id bigint, investimento money, cliques bigint", f"WITH {FLAT_SQL} SELECT plataforma_id, sum(spend) investimento, sum(link_clicks) cliques FROM fact WHERE data BETWEEN (SELECT max(data) - 6 FROM fact) AND (SELECT max(data) FROM fact) GROUP BY 1")
def bench_q4_last_days(spark, sf_dir):
    return reports.last_days(flat_fact(spark, sf_dir))


@query("data date, spend money, impressions bigint, link_clicks bigint, conversions money", f"WITH {FLAT_SQL} SELECT data, spend, impressions, link_clicks, conversions FROM fact WHERE anuncio_id = 42")
def bench_q5_history(spark, sf_dir):
    return reports.history_of(flat_fact(spark, sf_dir), 42)


@query("o_custkey bigint, total money", "SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) total FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_customers(spark, sf_dir):
    return top_k(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("total")], 10, F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


# Parity and drift: the two newest snapshots against each other.


def _two(spark, sf_dir):
    keys = ["source", "reference_date"]
    amounts = snapshots.ranked_snapshots(raw_records(spark, sf_dir), keys, "extracted_at")
    pick = lambda n: _amounts(amounts.where(F.col("recency") == n).select("source", "reference_date", "extracted_at", "payload")).withColumn("spend", F.col("spend").cast(MONEY)).withColumn("clicks", F.pmod(F.crc32("ad"), F.lit(n + 1)).cast("bigint"))
    return pick(2), pick(1)


_TWO_SQL = f"{RAW_SQL}, r AS (SELECT source, reference_date, anuncio_external_id ad, spend, dense_rank() OVER (PARTITION BY source, reference_date ORDER BY extracted_day DESC) r FROM raw), b AS (SELECT * FROM r WHERE r = 2), a AS (SELECT * FROM r WHERE r = 1)"
_DIFF_SQL = f"""WITH {_TWO_SQL}, d AS (SELECT coalesce(b.source, a.source) source, coalesce(b.reference_date, a.reference_date) reference_date, coalesce(b.ad, a.ad) ad, b.spend before_spend, a.spend after_spend,
  CASE WHEN b.ad IS NULL THEN 'NEW' WHEN a.ad IS NULL THEN 'REMOVED' WHEN b.spend = a.spend THEN 'IDENTICAL' ELSE 'CHANGED' END status FROM b FULL JOIN a ON a.source = b.source AND a.reference_date = b.reference_date AND a.ad = b.ad)"""
_DIFF_KEYS = ["source", "reference_date", "ad"]


def _diff(spark, sf_dir):
    return parity.keyed_diff(*_two(spark, sf_dir), _DIFF_KEYS, ["spend"])


@query("source string, reference_date date, ad string, status string, before_spend money, after_spend money", f"{_DIFF_SQL} SELECT * FROM d")
def keyed_diff(spark, sf_dir):
    return _diff(spark, sf_dir)


@query("source string, reference_date date, ad string, field string, before money, after money, delta money", f"{_DIFF_SQL} SELECT source, reference_date, ad, 'spend' AS field, before_spend AS before, after_spend AS after, after_spend - before_spend AS delta FROM d WHERE status = 'CHANGED'")
def field_deltas(spark, sf_dir):
    return parity.field_deltas(_diff(spark, sf_dir), _DIFF_KEYS, ["spend"])


@query("status string, rows bigint", f"{_DIFF_SQL} SELECT status, count(*) AS rows FROM d GROUP BY 1")
def diff_report(spark, sf_dir):
    return parity.diff_report(_diff(spark, sf_dir))


@query("source string, reference_date date, ad string, side string", f"{_DIFF_SQL} SELECT source, reference_date, ad, status side FROM d WHERE status IN ('NEW', 'REMOVED')")
def key_difference(spark, sf_dir):
    return parity.key_difference(*_two(spark, sf_dir), _DIFF_KEYS)


@query("source string, date_group string, delta_spend money", f"""WITH {_TWO_SQL} SELECT source, CASE WHEN reference_date NOT IN (SELECT reference_date FROM b) THEN 'new' WHEN reference_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' THEN 'reextracted' ELSE 'control' END date_group,
  coalesce(sum(spend) FILTER (WHERE r = 1), 0) - coalesce(sum(spend) FILTER (WHERE r = 2), 0) delta_spend FROM r WHERE r <= 2 GROUP BY 1, 2""")
def drift_by_date_group(spark, sf_dir):
    before, after = _two(spark, sf_dir)
    return parity.drift_by_group(before, after, ["ad"], "reference_date", ["spend"], ("2024-01-10", "2024-01-16"), "source")


# Columns, merging, windows.


@query("id bigint, name string, origin string", """SELECT * FROM (SELECT coalesce(s_suppkey, c_custkey) id, coalesce(s_name, c_name) AS name, CASE WHEN s_suppkey IS NULL THEN 'customer' ELSE 'supplier' END origin, coalesce(s_acctbal, c_acctbal) bal
  FROM customer FULL JOIN supplier ON c_custkey = s_suppkey) WHERE bal > 0""")
def merged_accounts(spark, sf_dir):
    take = lambda n, p: table(spark, sf_dir, n).select(F.col(f"{p}key").alias("id"), F.col(f"{p[0]}_name").alias("name"), F.lit(n).alias("origin"), F.col(f"{p[0]}_acctbal").alias("bal"))
    return raw.merged([take("customer", "c_cust"), take("supplier", "s_supp")], "id", F.col("bal") > 0)


@query("event_id bigint, first_day date, last_day date", "SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) - 7 first_day, CAST(ts - INTERVAL 3 HOUR AS DATE) - 1 last_day FROM events")
def rolling_windows(spark, sf_dir):
    first, last = C.rolling_window(F.col("ts").cast("timestamp"), 7, "America/Sao_Paulo")
    return table(spark, sf_dir, "events").select("event_id", first.alias("first_day"), last.alias("last_day"))


@query("user_id bigint, day date", "SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT user_id, CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) a, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) b FROM events GROUP BY 1)")
def window_dates(spark, sf_dir):
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    return g.select("user_id", C.window_dates("a", "b").alias("day"))


@query("c_custkey bigint, masked string", "SELECT c_custkey, CASE WHEN length(coalesce(c_name, '')) <= 4 THEN '***' ELSE '***' || right(c_name, 4) END masked FROM customer")
def masked_names(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", C.mask("c_name").alias("masked"))


_NAMED = "(?i)\\b(" + "|".join(C.SECRET_PARAMETERS) + ")(\\s*[=:]\\s*[\"'']?)([^\\s\"''&,;})]+)"


@query("doc_id bigint, redacted string", "SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '" + _NAMED + "', '\\1\\2***REDACTED***', 'g'), 'EAA[A-Za-z0-9]{20,}', '***REDACTED***', 'g'), 'GOCSPX-[A-Za-z0-9_\\-]{10,}', '***REDACTED***', 'g'), '1//[A-Za-z0-9_\\-]{20,}', '***REDACTED***', 'g')) redacted FROM documents")
def redacted_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(C.redact_secrets("text")).alias("redacted"))


@query("l_orderkey bigint, l_linenumber bigint, price money", "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0001 AS DECIMAL(5,4)) price FROM lineitem")
def money_from_micros(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.micros(F.col("l_extendedprice").cast("decimal(18,2)") * 100).alias("price"))


@query("c_custkey bigint, region_nk string, nation_nk string, customer_nk string", "SELECT c_custkey, md5(r_name) region_nk, md5(r_name || '|' || n_name) nation_nk, md5(r_name || '|' || n_name || '|' || c_custkey) customer_nk FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def chained_keys(spark, sf_dir):
    df = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.select("c_custkey", C.natural_key("r_name").alias("region_nk"), C.natural_key("r_name", "n_name").alias("nation_nk"), C.natural_key("r_name", "n_name", "c_custkey").alias("customer_nk"))


# Exposure and audit.


def _exposed(spark, sf_dir, blocks: int = exposure.WIDE) -> tuple[DataFrame, DataFrame]:
    """The view, and its artifact, both stored, as their checks read them many times. Labels are wide, so that no two entities share one, however many there are."""
    view = _stored(_view(spark, sf_dir), "view")
    return view, _stored(exposure.exposed(view, exposure.checked_key(DEMO_KEY.decode()), blocks), "artifact")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = raw.scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _blob(b: bytes) -> str:
    return "'" + "".join(f"\\x{x:02X}" for x in b) + "'::BLOB"


_PADS = [bytes(x ^ p for x in DEMO_KEY.ljust(64, b"\0")) for p in (0x36, 0x5C)]


def _label(level: str, message: str) -> str:
    return f"'{exposure.PREFIXES[level]}-' || upper(substr(sha256({_blob(_PADS[1])} || unhex(sha256({_blob(_PADS[0])} || encode({message})))), 1, 8))"


_EXPOSED = {"data": "date", "plataforma": "string", **{f"{x}_{c}": "bigint" if c == "versao" else "string" for x in LEVELS for c in ("id", "versao")}, **M}


_IDS_SQL = ", ".join(_label(x, f"'{x}|' || {x}_nk") + f" {x}_id" for x in LEVELS)


@query(_EXPOSED, f"WITH {view_sql()} SELECT *, {_IDS_SQL} FROM vw")
def exposed_artifact(spark, sf_dir):
    return _exposed(spark, sf_dir, blocks=1)[1]


@query("problem string")
def exposure_post_checks(spark, sf_dir):
    return exposure.post_checks(*_exposed(spark, sf_dir))


def _lost_day_sql() -> str:
    """What differs between the view and itself without its last day."""
    sums = lambda t: f"SELECT count(*) AS rows, count(DISTINCT data) AS days, {', '.join(f'sum({m}) {m}' for m in METRICS)}, {', '.join(f'count(DISTINCT {x}_nk) n_{x}' for x in LEVELS)} FROM {t}"
    parts = [f"SELECT '{c} differs' problem FROM a, b WHERE a.{c} IS DISTINCT FROM b.{c}" for c in ("rows", "days", *METRICS)] + [f"SELECT 'two keys of {x} share a label' problem FROM a, b WHERE a.n_{x} <> b.n_{x}" for x in LEVELS]
    parts += [f"SELECT '{p}' problem WHERE EXISTS (SELECT data FROM vw EXCEPT SELECT data FROM less)" for p in ("sums by platform and day differ", "the set of days differs")]
    parts += [f"SELECT 'versions of {x} differ' problem WHERE EXISTS (SELECT {x}_versao, count(*) FROM vw GROUP BY 1 EXCEPT SELECT {x}_versao, count(*) FROM less GROUP BY 1)" for x in LEVELS]
    return f"WITH {view_sql()}, less AS (SELECT * FROM vw WHERE data < (SELECT max(data) FROM vw)), a AS ({sums('vw')}), b AS ({sums('less')}) {' UNION ALL '.join(parts)}"


@query("problem string", _lost_day_sql())
def post_checks_of_a_lost_day(spark, sf_dir):
    """The checks on an artifact that lacks its last day."""
    view, artifact = _exposed(spark, sf_dir)
    last = view.agg(F.max("data").alias("last_day"))
    return exposure.post_checks(view, artifact.join(F.broadcast(last), F.col("data") < F.col("last_day")).drop("last_day"))


@query({"rows": "bigint", "first_day": "date", "last_day": "date", **{f"n_{x}": "bigint" for x in LEVELS}}, f"WITH {view_sql()} SELECT count(*) AS rows, min(data) first_day, max(data) last_day, {', '.join(f'count(DISTINCT {x}_nk) n_{x}' for x in LEVELS)} FROM vw")
def export_manifest(spark, sf_dir):
    return exposure.export_manifest(_exposed(spark, sf_dir)[1])


@query("problem string, count bigint")
def audit_findings(spark, sf_dir):
    """An audit of the exported artifact as text against the view and the real names: a sound artifact gives no rows."""
    view = _stored(_view(spark, sf_dir), "view")
    return _audited(exposure.exposed(view, DEMO_KEY, exposure.WIDE), view)


def _audited(artifact: DataFrame, view: DataFrame) -> DataFrame:
    """The audit of an artifact, whose text is stored first: every check reads it, and none makes it anew."""
    real = view.select(F.explode(F.array(*(f"{x}_nome" for x in LEVELS), *(f"{x}_nk" for x in LEVELS))).alias("value"))
    return audit.audited(_stored(raw.as_text(artifact), "text"), view, real=real, blocks=exposure.WIDE)


def _tampered_sql() -> str:
    """Findings in an artifact whose accounts bear their real names on the last day."""
    counts = {
        "conta_id out of shape": "SELECT count(*) FROM t WHERE last_day",
        "a campanha has more than one conta": "SELECT count(*) FROM (SELECT campanha_nk FROM t GROUP BY 1 HAVING count(DISTINCT conta) > 1)",
        "the number of conta differs": "SELECT abs(count(DISTINCT conta) - count(DISTINCT conta_nk)) FROM t",
        "leak in conta_id": "SELECT count(DISTINCT conta_nome) FROM t WHERE last_day",
    }
    parts = " UNION ALL ".join(f"SELECT '{p}' problem, ({q}) AS count" for p, q in counts.items())
    return f"WITH {view_sql()}, d AS (SELECT *, data = (SELECT max(data) FROM vw) last_day FROM vw), t AS (SELECT *, CASE WHEN last_day THEN conta_nome ELSE conta_nk END conta FROM d) SELECT * FROM ({parts}) WHERE count > 0"


@query("problem string, count bigint", _tampered_sql())
def audit_of_a_tampered_artifact(spark, sf_dir):
    """The audit of an artifact whose accounts bear their real names on the last day."""
    view = _stored(_view(spark, sf_dir), "view")
    artifact = exposure.exposed(view, DEMO_KEY, exposure.WIDE)
    accounts = exposure.hmac_pads(view.select("conta_nk", "conta_nome").distinct(), DEMO_KEY).select(exposure.public_id("conta", "conta_nk", exposure.WIDE).alias("conta_id"), "conta_nome")
    rows = artifact.join(accounts, "conta_id").join(F.broadcast(view.agg(F.max("data").alias("last_day"))), F.lit(True))
    tampered = rows.withColumn("conta_id", F.when(F.col("data") == F.col("last_day"), F.col("conta_nome")).otherwise(F.col("conta_id"))).select(*artifact.columns)
    return _audited(tampered, view)


@query(_EXPOSED, f"WITH {view_sql()} SELECT *, {_IDS_SQL} FROM vw")
def exported_csv(spark, sf_dir):
    """The view through the export with its checks and manifest, as read back from the published CSV. Its labels are wide; here their first block is shown."""
    target = raw.scratch_path(spark, "export")
    export(_stored(_view(spark, sf_dir), "view"), DEMO_KEY.decode(), target, "/published", blocks=exposure.WIDE)
    return raw.read_text_csv(spark, f"{target}/{DATA_NAME}").withColumns({f"{x}_id": exposure.first_block(f"{x}_id") for x in LEVELS})


@query("account_id string, ad_id string, rows bigint, spend money", f"WITH {RAW_SQL} SELECT {_label('conta', "'bruto:v1|meta_ads|A' || (u % 4)")} account_id, {_label('anuncio', "'bruto:v1|meta_ads|U' || u")} ad_id, count(*) AS rows, sum(v) spend FROM g WHERE u % 2 = 0 GROUP BY 1, 2")
def anonymised_files(spark, sf_dir):
    """The anonymised records through the writer with its checks and manifest, as read back from the published files. Their labels are wide; here their first block is shown."""
    target = raw.scratch_path(spark, "anonymised")
    allowed = [*exposure.ALLOWED_LABELS, "onsite_conversion.ig_profile_view", "purchase", "omni_purchase"]
    records = _stored(raw_records(spark, sf_dir).where("source = 'meta_ads'"), "records")
    publish_anonymised(records, "meta_ads", "meta_ads", DEMO_KEY.decode(), target, allowed, blocks=exposure.WIDE)
    v = F.parse_json("value")
    rows = spark.read.text(f"{target}/records.json").select(*(exposure.first_block(F.variant_get(v, f"$.{c}", "string")).alias(c) for c in ("account_id", "ad_id")), F.variant_get(v, "$.spend", MONEY).alias("spend"))
    return rows.groupBy("account_id", "ad_id").agg(F.count("*").alias("rows"), F.sum("spend").alias("spend"))


_PATTERN_ROWS = " UNION ALL ".join("SELECT '{}' pattern, CAST(coalesce(sum(n), 0) AS BIGINT) matches, count(*) FILTER (WHERE n > 0) AS rows FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '{}')) n FROM documents)".format(name, p.replace("(?iU)", "(?i)").replace("(?U)", "").replace("'", "''")) for name, p in audit.FORBIDDEN_PATTERNS.items())


@query("pattern string, matches bigint, rows bigint", _PATTERN_ROWS)
def personal_data_in_documents(spark, sf_dir):
    return audit.pattern_counts(table(spark, sf_dir, "documents"), "text")


@query("problem string, rows bigint", f"WITH {RAW_SQL} SELECT 'missing field: video_trueview_views' problem, count(*) AS rows FROM raw WHERE source = 'google_ads' AND day(reference_date) <= 5 HAVING count(*) > 0")
def raw_contract(spark, sf_dir):
    parts = [exposure.contract_violations(raw_records(spark, sf_dir).where(F.col("source") == s), s) for s in exposure.CONTRACTS]
    return parts[0].unionByName(parts[1]).groupBy("problem").agg(F.count("*").alias("rows"))


@query("problem string, rows bigint", f"WITH {RAW_SQL} SELECT 'actions: label not allowed' problem, 2 * count(*) AS rows FROM raw JOIN g ON raw.reference_date = g.d AND raw.extracted_day = g.d + g.lag AND raw.anuncio_external_id = 'U' || g.u WHERE source = 'meta_ads' AND g.n > 1 HAVING count(*) > 0")
def nested_allowlist(spark, sf_dir):
    rows = raw_records(spark, sf_dir).where("source = 'meta_ads'")
    return exposure.nested_violations(rows, ["actions", "action_values"], ["lead", "video_view", "purchase", "post_engagement"]).groupBy("problem").agg(F.count("*").alias("rows"))


@query("row_id string, account_id string, ad_id string, ad_name string, spend money", f"WITH {RAW_SQL} SELECT d || '-' || lag || '-' || u row_id, {_label('conta', "'bruto:v1|meta_ads|A' || (u % 4)")} account_id, {_label('anuncio', "'bruto:v1|meta_ads|U' || u")} ad_id, {_label('anuncio', "'bruto:v1|meta_ads|U' || u")} ad_name, v AS spend FROM g WHERE u % 2 = 0")
def anonymised_records(spark, sf_dir):
    out = exposure.anonymised_raw(raw_records(spark, sf_dir).where("source = 'meta_ads'"), "meta_ads", "meta_ads", DEMO_KEY)
    v = F.parse_json("record")
    return out.select("row_id", *(F.variant_get(v, f"$.{c}", "string").alias(c) for c in ("account_id", "ad_id", "ad_name")), F.variant_get(v, "$.spend", MONEY).alias("spend"))


@query("level string, label string, identities bigint", f"SELECT 'customer' AS level, upper(substr(sha256({_blob(_PADS[1])} || unhex(sha256({_blob(_PADS[0])} || encode(CAST(c_custkey AS VARCHAR))))), 1, 2)) AS label, count(DISTINCT c_custkey) identities FROM customer GROUP BY 2 HAVING count(DISTINCT c_custkey) > 1")
def label_collisions(spark, sf_dir):
    """Labels of all customers cut to two digits, so that there are collisions to find."""
    from tidemark.functions.columns import hmac_pads, hmac_sha256

    rows = hmac_pads(table(spark, sf_dir, "customer"), DEMO_KEY).select(F.lit("customer").alias("level"), F.substring(hmac_sha256(F.col("c_custkey").cast("string")), 1, 2).alias("label"), "c_custkey")
    return exposure.label_collisions(rows, ["level"], "label", "c_custkey")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


from tidemark.plans import change_queries, source_queries  # noqa: E402, F401  (they register their queries)
