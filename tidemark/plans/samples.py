"""Raw records derived from the given tables, so that the whole warehouse runs on data that grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.staging import silver
from tidemark.plans.star import star
from tidemark.sources.raw import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as snapshots of ad records: even users are one source, odd ones the other; three loads of every day; names change over the month."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    g = e.groupBy(day.alias("d"), (1 + F.col("event_id") % 3).cast("int").alias("lag"), F.col("user_id").alias("u")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("v"), F.sum(k).alias("k"), F.min("event_type").alias("et"), F.count_if(F.col("event_type") == "purchase").alias("p")
    )
    text = lambda c: F.col(c).cast("string")
    mod = lambda letter, n: F.concat(F.lit(letter), (F.col("u") % n).cast("string"))
    names = [F.concat(F.lit("Account "), mod("", 4)), F.concat(F.lit("Campaign "), mod("", 20), F.lit(" "), F.floor(F.day("d") / 10).cast("string")), F.concat(F.lit("Set "), mod("", 60)), F.col("et")]
    ids = [mod("A", 4), mod("C", 20), mod("S", 60), F.concat(F.lit("U"), text("u"))]

    def levels(fields: list[str]) -> list:
        return [c for f, i, n in zip(fields, ids, names, strict=True) for c in (i.alias(f"{f}_id"), n.alias(f"{f}_name"))]

    action = lambda label, value: F.struct(F.lit(label).alias("action_type"), value.cast("string").alias("value"))
    actions = F.array(action("lead", F.col("n")), action("video_view", F.col("k")), action("onsite_conversion.ig_profile_view", F.col("p")), action("purchase", F.col("p")), action("omni_purchase", F.lit(1)), action("post_engagement", F.col("k")))
    meta = F.struct(text("d").alias("date_start"), text("d").alias("date_stop"), *levels(["account", "campaign", "adset", "ad"]), text("v").alias("spend"), (F.col("n") * 100 + F.col("k")).cast("string").alias("impressions"), text("n").alias("inline_link_clicks"), text("k").alias("reach"), F.when(F.col("n") > 1, actions).alias("actions"), F.array(action("lead", F.col("v"))).alias("action_values"))
    google = F.struct(text("d").alias("date"), *levels(["account", "campaign", "ad_group", "ad"]), (F.col("n") * 50 + F.col("k")).alias("impressions"), F.col("n").alias("clicks"), F.col("v").alias("cost"), (F.col("v") / 100).cast("decimal(18,4)").alias("conversions"), (F.col("v") / 10).cast("decimal(18,3)").alias("conversions_value"), F.when(F.day("d") > 5, F.col("k")).alias("video_trueview_views"))
    is_meta = F.col("u") % 2 == 0
    return g.select(
        F.when(is_meta, "meta_ads").otherwise("google_ads").alias("source"), F.col("d").alias("reference_date"), F.date_add("d", F.col("lag")).cast("timestamp").alias("extracted_at"),
        F.concat(F.when(is_meta, "m").otherwise("g"), F.date_add("d", F.col("lag")).cast("string")).alias("batch_id"), F.parse_json(F.when(is_meta, F.to_json(meta)).otherwise(F.to_json(google))).alias("payload"),
        F.concat_ws("-", text("d"), text("lag"), text("u")).alias("row_id"),
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star; its seven tables share the staging, which is therefore stored."""
    path = scratch_path(spark, "silver")
    rows = silver(raw_records(spark, sf_dir))
    rows.write.parquet(path)
    return star(spark.read.schema(rows.schema).parquet(path))


def flat_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` under the names of the flat benchmark fact."""
    money = lambda c: F.col(c).cast("decimal(18,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("anuncio_id"), F.col("l_suppkey").alias("campanha_id"), (F.col("l_suppkey") % 2 + 1).alias("plataforma_id"), F.to_date("l_shipdate").alias("data"), money("l_extendedprice").alias("spend"),
        F.col("l_orderkey").alias("impressions"), F.col("l_linenumber").cast("bigint").alias("link_clicks"), money("l_quantity").alias("conversions"),
    )


# The same in SQL, as common table expressions on the given tables.

RAW_SQL = """
g AS (SELECT CAST(ts AS DATE) d, CAST(1 + event_id % 3 AS INTEGER) lag, user_id u, count(*) n, sum(CAST(value AS DECIMAL(18,2))) v,
  CAST(sum(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS BIGINT) k, min(event_type) et, count(*) FILTER (WHERE event_type = 'purchase') p FROM events GROUP BY 1, 2, 3),
raw AS (SELECT CASE WHEN u % 2 = 0 THEN 'meta_ads' ELSE 'google_ads' END source, CASE WHEN u % 2 = 0 THEN 'Meta Ads' ELSE 'Google Ads' END plataforma, d AS reference_date, d + lag AS extracted_day,
  'A' || (u % 4) conta_external_id, 'Account ' || (u % 4) conta_nome, 'C' || (u % 20) campanha_external_id, 'Campaign ' || (u % 20) || ' ' || (day(d) // 10) campanha_nome,
  'S' || (u % 60) adset_external_id, 'Set ' || (u % 60) adset_nome, 'U' || u anuncio_external_id, et anuncio_nome,
  CAST(v AS DECIMAL(18,6)) spend, CASE WHEN u % 2 = 0 THEN n * 100 + k ELSE n * 50 + k END impressions, n AS link_clicks,
  CASE WHEN u % 2 = 0 THEN CAST(CASE WHEN n > 1 THEN n ELSE 0 END AS DECIMAL(18,6)) ELSE CAST(CAST(CAST(v AS DECIMAL(18,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS DECIMAL(18,6)) END conversions,
  CASE WHEN u % 2 = 0 THEN CAST(v AS DECIMAL(18,6)) ELSE CAST(CAST(v AS DECIMAL(18,4)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(18,6)) END conversion_value,
  CASE WHEN u % 2 = 0 THEN CASE WHEN n > 1 THEN k ELSE 0 END ELSE CASE WHEN day(d) > 5 THEN k ELSE 0 END END video_views,
  CASE WHEN u % 2 = 0 THEN k ELSE 0 END reach, CASE WHEN u % 2 = 0 AND n > 1 THEN p ELSE 0 END profile_views, CASE WHEN u % 2 = 0 AND n > 1 THEN p + 1 ELSE 0 END purchases
  FROM g)"""
SILVER_SQL = (
    RAW_SQL
    + """,
silver AS (SELECT *, reference_date AS data, md5(plataforma) plataforma_sk, md5(plataforma || '|' || conta_external_id) conta_nk,
  md5(plataforma || '|' || conta_external_id || '|' || campanha_external_id) campanha_nk,
  md5(plataforma || '|' || conta_external_id || '|' || campanha_external_id || '|' || adset_external_id) adset_nk,
  md5(plataforma || '|' || conta_external_id || '|' || campanha_external_id || '|' || adset_external_id || '|' || anuncio_external_id) anuncio_nk
  FROM raw r WHERE extracted_day = (SELECT max(extracted_day) FROM raw x WHERE x.source = r.source AND x.reference_date = r.reference_date))"""
)


def _dim_sql(level: str, parent: str) -> str:
    return f"""
{level}_days AS (SELECT {level}_nk nk, {parent} parent, {level}_external_id external_id, data, min({level}_nome) nome FROM silver GROUP BY ALL),
{level}_marks AS (SELECT *, CASE WHEN nome IS NOT DISTINCT FROM lag(nome) OVER w THEN 0 ELSE 1 END changed FROM {level}_days WINDOW w AS (PARTITION BY nk ORDER BY data)),
{level}_runs AS (SELECT *, CAST(sum(changed) OVER (PARTITION BY nk ORDER BY data ROWS UNBOUNDED PRECEDING) AS BIGINT) versao FROM {level}_marks),
{level}_versions AS (SELECT nk, versao, min(parent) parent, min(external_id) external_id, min(nome) nome, min(data) valido_de FROM {level}_runs GROUP BY nk, versao),
dim_{level} AS (SELECT md5(nk || '|v' || versao) {level}_sk, nk AS {level}_nk, parent AS {parent}, external_id, nome, versao, valido_de,
  coalesce(lead(valido_de) OVER (PARTITION BY nk ORDER BY versao) - 1, DATE '9999-12-31') valido_ate, lead(valido_de) OVER (PARTITION BY nk ORDER BY versao) IS NULL is_atual FROM {level}_versions)"""


_PARENTS = [("conta", "plataforma_sk"), ("campanha", "conta_nk"), ("adset", "campanha_nk"), ("anuncio", "adset_nk")]
STAR_SQL = (
    SILVER_SQL
    + ","
    + ",".join(_dim_sql(*x) for x in _PARENTS)
    + """,
dim_plataforma AS (SELECT DISTINCT plataforma_sk, plataforma AS nome FROM silver),
dim_tempo AS (SELECT DISTINCT md5(CAST(data AS VARCHAR)) tempo_sk, data, day(data) dia, month(data) mes, year(data) ano, quarter(data) trimestre, isodow(data) dia_semana, strftime(data, '%Y-%m') ano_mes FROM silver),
fato_metricas AS (SELECT a.anuncio_sk, md5(CAST(s.data AS VARCHAR)) tempo_sk, s.spend, s.impressions, s.link_clicks, s.conversions, s.conversion_value, s.video_views, s.reach, s.profile_views, s.purchases
  FROM silver s JOIN dim_anuncio a ON a.anuncio_nk = s.anuncio_nk AND s.data BETWEEN a.valido_de AND a.valido_ate)"""
)


def view_sql(validity: bool = True) -> str:
    at = lambda x: f" AND t.data BETWEEN {x}.valido_de AND {x}.valido_ate" if validity else ""
    return (
        STAR_SQL
        + f""",
vw AS (SELECT t.data, t.dia, t.mes, t.ano, t.trimestre, t.dia_semana, t.ano_mes, p.nome plataforma,
  ct.conta_nk, ct.external_id conta_external_id, ct.nome conta_nome, ct.versao conta_versao, c.campanha_nk, c.external_id campanha_external_id, c.nome campanha_nome, c.versao campanha_versao,
  s.adset_nk, s.external_id adset_external_id, s.nome adset_nome, s.versao adset_versao, a.anuncio_nk, a.external_id anuncio_external_id, a.nome anuncio_nome, a.versao anuncio_versao,
  f.spend, f.impressions, f.link_clicks, f.conversions, f.conversion_value, f.video_views, f.reach, f.profile_views, f.purchases
  FROM fato_metricas f JOIN dim_tempo t ON t.tempo_sk = f.tempo_sk JOIN dim_anuncio a ON a.anuncio_sk = f.anuncio_sk
  JOIN dim_adset s ON s.adset_nk = a.adset_nk{at("s")} JOIN dim_campanha c ON c.campanha_nk = s.campanha_nk{at("c")}
  JOIN dim_conta ct ON ct.conta_nk = c.conta_nk{at("ct")} JOIN dim_plataforma p ON p.plataforma_sk = ct.plataforma_sk)"""
    )


FLAT_SQL = """
fact AS (SELECT l_partkey anuncio_id, l_suppkey campanha_id, l_suppkey % 2 + 1 plataforma_id, CAST(l_shipdate AS DATE) AS data, CAST(l_extendedprice AS DECIMAL(18,2)) spend,
  l_orderkey impressions, CAST(l_linenumber AS BIGINT) link_clicks, CAST(l_quantity AS DECIMAL(18,2)) conversions FROM lineitem)"""
