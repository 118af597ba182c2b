"""Aggregates for parity and the analytic reports on the star's consumption view, and the five benchmark profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import METRIC, exact_text, ratio
from tidemark.operators.quality import labelled_counts, unique_grain
from tidemark.operators.snapshots import snapshot_drift
from tidemark.plans.star import consumption
from tidemark.sources.registry import LEVELS, METRICS


def collect_aggregates(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four blocks that a golden copy holds: sums by platform and day through a traversal of its own, fact totals, counts, traversal count."""
    sums = [exact_text(F.sum(m)).alias(m) for m in METRICS]
    day = tables["fato_metricas"].join(tables["dim_tempo"].select("tempo_sk", "data"), "tempo_sk").join(tables["dim_anuncio"].select("anuncio_sk", "adset_nk"), "anuncio_sk")
    for level in ("adset", "campanha", "conta"):
        dim = tables[f"dim_{level}"].drop(f"{level}_sk", "external_id", "nome", "versao", "is_atual").withColumnRenamed(f"{level}_nk", "_nk")
        day = day.join(dim, (F.col(f"{level}_nk") == F.col("_nk")) & F.col("data").between(F.col("valido_de"), F.col("valido_ate"))).drop("_nk", "valido_de", "valido_ate", f"{level}_nk")
    day = day.join(tables["dim_plataforma"].withColumnRenamed("nome", "plataforma"), "plataforma_sk")
    entities = [tables[f"dim_{level}"].agg(F.count("*").alias("linhas"), F.count_distinct(f"{level}_nk").alias("entidades")).select(F.lit(f"dim_{level}").alias("objeto"), "linhas", "entidades") for level in LEVELS]
    return {
        "por_plataforma_dia": day.groupBy("plataforma", "data").agg(*sums),
        "totais_fato": tables["fato_metricas"].agg(F.count("*").alias("linhas"), *sums),
        "contagens": reduce(DataFrame.unionByName, entities),
        "travessia": consumption(tables).agg(F.count("*").alias("linhas"), exact_text(F.sum("spend")).alias("spend")),
    }


def freeze_golden(blocks: dict[str, DataFrame], path: str) -> None:
    for name, df in blocks.items():
        df.coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def layer_volumetry(tables: dict[str, DataFrame]) -> DataFrame:
    return labelled_counts(tables)


def platform_comparison(view: DataFrame) -> DataFrame:
    clicks, shown, spend, conversions = F.sum("link_clicks"), F.sum("impressions"), F.sum("spend"), F.sum("conversions")
    return view.groupBy("plataforma").agg(F.count("*").alias("linhas"), F.round(spend, 2).alias("investimento"), shown.alias("impressoes"), clicks.alias("cliques"), F.round(conversions, 2).alias("conversoes"), ratio(clicks, shown, 2, 100).alias("ctr_pct"), ratio(spend, clicks, 2).alias("cpc"), ratio(spend, conversions, 2).alias("cpa")).orderBy(F.desc("investimento"), "plataforma")


def top_campaigns(view: DataFrame, k: int = 10) -> DataFrame:
    """By name: a renamed campaign has a row for each name."""
    keys = ["plataforma", "conta_nome", "campanha_nome"]
    sums = view.groupBy(*keys).agg(F.round(F.sum("spend"), 2).alias("investimento"), F.sum("impressions").alias("impressoes"), F.sum("link_clicks").alias("cliques"), ratio(F.sum("link_clicks"), F.sum("impressions"), 2, 100).alias("ctr_pct"))
    return sums.orderBy(F.desc("investimento"), *keys).limit(k)


def daily_series(tables: dict[str, DataFrame]) -> DataFrame:
    rows = tables["fato_metricas"].join(F.broadcast(tables["dim_tempo"].select("tempo_sk", "data", "dia_semana")), "tempo_sk")
    return rows.groupBy("data", "dia_semana").agg(F.round(F.sum("spend"), 2).alias("investimento"), F.sum("impressions").alias("impressoes"), F.count("*").alias("anuncios_com_entrega"))


def idempotency_proof(tables: dict[str, DataFrame]) -> DataFrame:
    return unique_grain(tables["fato_metricas"], "anuncio_sk", "tempo_sk")


def metric_coverage(view: DataFrame) -> DataFrame:
    having = {"reach": "com_reach", "video_views": "com_video_views", "conversions": "com_conversoes", "purchases": "com_compras"}
    return view.groupBy("plataforma").agg(F.count("*").alias("linhas"), *(F.count_if(F.col(m) > 0).alias(n) for m, n in having.items()))


def rename_history(tables: dict[str, DataFrame], view: DataFrame) -> DataFrame:
    """Fact rows and spend of each version of renamed campaigns."""
    dim = tables["dim_campanha"]
    renamed = dim.groupBy("campanha_nk").agg(F.count("*").alias("n")).where("n > 1").select("campanha_nk")
    versions = dim.join(renamed, "campanha_nk", "left_semi").select("campanha_nk", F.col("versao").alias("campanha_versao"), "external_id", "nome", "valido_de", "valido_ate")
    return view.join(versions, ["campanha_nk", "campanha_versao"]).groupBy("external_id", F.col("campanha_versao").alias("versao"), "valido_de", "valido_ate", "nome").agg(F.count("*").alias("linhas_do_fato"), F.round(F.sum("spend"), 2).alias("investimento"))


def version_distribution(view: DataFrame) -> DataFrame:
    """Rows of each level and version, in one scan."""
    pairs = ", ".join(f"'{level}', {level}_versao" for level in LEVELS)
    return view.select(F.expr(f"stack({len(LEVELS)}, {pairs}) AS (nivel, versao)")).groupBy("nivel", "versao").agg(F.count("*").alias("linhas"))


def spend_drift(raw: DataFrame) -> DataFrame:
    amount = F.coalesce(F.variant_get("payload", "$.spend", METRIC), F.variant_get("payload", "$.cost", METRIC), F.lit(0).cast(METRIC))
    return snapshot_drift(raw, ["source", "reference_date"], "extracted_at", amount)


# Benchmark profiles on a flat fact with the columns of sources.raw.generated_fact.


def full_scan(fact: DataFrame) -> DataFrame:
    return fact.groupBy("plataforma_id").agg(F.count("*").alias("linhas"), F.sum("spend").alias("investimento"), F.sum("impressions").alias("impressoes"), F.sum("link_clicks").alias("cliques"), F.sum("conversions").alias("conversoes"))


def monthly_series(fact: DataFrame) -> DataFrame:
    spend, clicks = F.sum("spend"), F.sum("link_clicks")
    over = lambda a, b: a / F.nullif(b, F.lit(0))
    return fact.groupBy(F.year("data").alias("ano"), F.month("data").alias("mes")).agg(spend.alias("investimento"), over(clicks * 1.0, F.sum("impressions")).alias("ctr"), over(spend, clicks).alias("cpc"), over(spend, F.sum("conversions")).alias("cpa")).orderBy("ano", "mes")


def top_by_spend(fact: DataFrame, k: int = 20) -> DataFrame:
    return fact.groupBy("campanha_id").agg(F.sum("spend").alias("investimento"), F.sum("impressions").alias("impressoes"), F.count_distinct("anuncio_id").alias("anuncios")).orderBy(F.desc("investimento"), "campanha_id").limit(k)


def last_days(fact: DataFrame, days: int = 7, last: Column | None = None) -> DataFrame:
    """The last days that the table holds; the newest day is found from the table's statistics unless it is given."""
    newest = fact.agg(F.max("data")).first()[0] if last is None else last
    end = F.lit(newest) if last is None else newest
    return platform_sums(fact.where(F.col("data").between(F.date_sub(end, days - 1), end)))


def platform_sums(fact: DataFrame) -> DataFrame:
    return fact.groupBy("plataforma_id").agg(F.sum("spend").alias("investimento"), F.sum("link_clicks").alias("cliques"))


def history_of(fact: DataFrame, ad: int) -> DataFrame:
    return fact.where(F.col("anuncio_id") == ad).select("data", "spend", "impressions", "link_clicks", "conversions").orderBy("data")
