"""The star schema over the unified staging: platform, four versioned levels, calendar, fact, and the consumption view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import date_key
from tidemark.operators import fused
from tidemark.operators.dimensional import calendar, point_in_time_join, scd2
from tidemark.operators.quality import Check, accepted_values, non_negative, not_null, one_current, overlaps, relationships, same_count, unique, unique_grain
from tidemark.sources.registry import LEVELS, METRICS, SOURCES

#: Each level's parent column.
PARENTS = dict(zip(LEVELS, ["plataforma_sk", *(f"{level}_nk" for level in LEVELS)], strict=False))


def dim_platform(silver: DataFrame) -> DataFrame:
    return silver.select("plataforma_sk", F.col("plataforma").alias("nome")).distinct()


def dim_level(silver: DataFrame, level: str) -> DataFrame:
    """The versioned dimension of a level; its parent is named by natural key, so a parent's new name makes no versions here."""
    out = scd2(silver, f"{level}_nk", PARENTS[level], f"{level}_external_id", f"{level}_nome", "data")
    return out.select(F.col("sk").alias(f"{level}_sk"), F.col("nk").alias(f"{level}_nk"), F.col("parent").alias(PARENTS[level]), "external_id", F.col("name").alias("nome"), F.col("version").alias("versao"), F.col("valid_from").alias("valido_de"), F.col("valid_to").alias("valido_ate"), F.col("is_current").alias("is_atual"))


def fact(silver: DataFrame, dim_ad: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """One row for each ad and day, on the version of the ad that held on it; `carried` columns of silver stay."""
    ad = dim_ad.select("anuncio_sk", F.col("anuncio_nk").alias("nk"), "valido_de", "valido_ate")
    return point_in_time_join(silver, ad, "anuncio_nk", "nk", "data", "valido_de", "valido_ate").select("anuncio_sk", date_key("data").alias("tempo_sk"), *METRICS, *(carried or []))


def star(silver: DataFrame) -> dict[str, DataFrame]:
    """All tables by name."""
    dims = {f"dim_{level}": dim_level(silver, level) for level in LEVELS}
    return {"stg_ads_unified": silver, "dim_plataforma": dim_platform(silver), **dims, "dim_tempo": calendar(silver, "data"), "fato_metricas": fact(silver, dims["dim_anuncio"])}


def materialise(silver: DataFrame, folder: str, counted: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """The star as Parquet tables below a folder, each built once from those stored before it; the fact lies in ranges of its ad.

    `counted` gets the violations of the row checks, found while the tables are written, and each table's rows.
    """
    out: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        out[name], found, rows = fused.stored(df, f"{folder}/{name}", [c for c in keyed_checks() if c.table == name])
        if counted is not None:
            counted.update(found | {f"rows of {name}": rows})
        return out[name]

    stored = store("stg_ads_unified", silver)
    store("dim_plataforma", dim_platform(stored))
    for level in LEVELS:
        store(f"dim_{level}", dim_level(stored, level))
    store("dim_tempo", calendar(stored, "data"))
    store("fato_metricas", fact(stored, out["dim_anuncio"]).repartitionByRange("anuncio_sk", "tempo_sk").sortWithinPartitions("anuncio_sk", "tempo_sk"))
    return out


def consumption(tables: dict[str, DataFrame], validity: bool = True) -> DataFrame:
    """The fact with every level's version of its day: 33 columns. Without validity it is the wrong join that checks must catch."""
    days = tables["dim_tempo"]
    rows = tables["fato_metricas"].join(days, "tempo_sk")
    out = rows
    for level, child in zip(reversed(LEVELS), [None, *reversed(LEVELS[1:])], strict=True):
        dim = tables[f"dim_{level}"].select(*([f"{level}_sk"] if child is None else []), F.col(f"{level}_nk"), F.col(PARENTS[level]), F.col("external_id").alias(f"{level}_external_id"), F.col("nome").alias(f"{level}_nome"), F.col("versao").alias(f"{level}_versao"), F.col("valido_de").alias("_from"), F.col("valido_ate").alias("_to"))
        if child is None:
            out = out.join(dim, f"{level}_sk").drop("_from", "_to")
        elif validity:
            out = out.join(dim.withColumnRenamed(f"{level}_nk", "_nk"), (F.col(f"{level}_nk") == F.col("_nk")) & F.col("data").between(F.col("_from"), F.col("_to"))).drop("_nk", "_from", "_to")
        else:
            out = out.join(dim, f"{level}_nk").drop("_from", "_to")
    out = out.join(tables["dim_plataforma"].withColumnRenamed("nome", "plataforma"), "plataforma_sk")
    levels = [f"{level}_{c}" for level in LEVELS for c in ("nk", "external_id", "nome", "versao")]
    return out.select("data", "dia", "mes", "ano", "trimestre", "dia_semana", "ano_mes", "plataforma", *levels, *METRICS)


def checks(tables: dict[str, DataFrame]) -> list[Check]:
    """The star's declared tests: keys, domains, references, versions, grain and the traversal's row count."""
    labels = [s.label for s in SOURCES.values()]
    silver, facts = tables["stg_ads_unified"], tables["fato_metricas"]
    out = [Check(f"silver.{c} not null", not_null(silver, c)) for c in ("data", "plataforma", *(f"{level}_nk" for level in LEVELS))]
    out += [Check("silver.plataforma accepted", accepted_values(silver, "plataforma", labels)), Check("silver grain", unique_grain(silver, "anuncio_nk", "data")), Check("silver metrics not negative", non_negative(silver, METRICS))]
    for level in LEVELS:
        dim, parent = tables[f"dim_{level}"], PARENTS[level]
        above = tables["dim_plataforma"] if parent == "plataforma_sk" else tables[f"dim_{LEVELS[LEVELS.index(level) - 1]}"]
        out += [
            Check(f"dim_{level} key unique", unique(dim, f"{level}_sk")), Check(f"dim_{level} key not null", not_null(dim, f"{level}_sk")), Check(f"dim_{level} parent exists", relationships(dim, parent, above, parent)),
            Check(f"dim_{level} versions apart", overlaps(dim, f"{level}_nk", "valido_de", "valido_ate")), Check(f"dim_{level} one current version", one_current(dim, f"{level}_nk", "is_atual")),
        ]
    out += [
        Check("dim_plataforma unique", unique(tables["dim_plataforma"], "plataforma_sk")), Check("dim_plataforma accepted", accepted_values(tables["dim_plataforma"], "nome", labels)), Check("dim_tempo unique", unique(tables["dim_tempo"], "data")),
        Check("dim_tempo weekdays", accepted_values(tables["dim_tempo"], "dia_semana", list(range(1, 8)))), Check("fact grain", unique_grain(facts, "anuncio_sk", "tempo_sk")),
        Check("fact ad exists", relationships(facts, "anuncio_sk", tables["dim_anuncio"], "anuncio_sk")), Check("fact day exists", relationships(facts, "tempo_sk", tables["dim_tempo"], "tempo_sk")),
        Check("traversal keeps rows", same_count(consumption(tables), facts)),
    ]
    return out


def keyed_checks() -> list[fused.Keyed]:
    """The same checks, but for the traversal, in the form that reads each table once."""
    labels, silver, facts = [s.label for s in SOURCES.values()], "stg_ads_unified", "fato_metricas"
    null = lambda name, table, column: fused.rows_where(name, table, F.col(column).isNull())
    out = [null(f"silver.{c} not null", silver, c) for c in ("data", "plataforma", *(f"{level}_nk" for level in LEVELS))]
    negative = reduce(lambda a, b: a | b, (F.col(m) < 0 for m in METRICS))
    out += [fused.accepted_values("silver.plataforma accepted", silver, "plataforma", labels), fused.unique("silver grain", silver, "anuncio_nk", "data", nulls=True), fused.rows_where("silver metrics not negative", silver, negative)]
    for level in LEVELS:
        dim, parent = f"dim_{level}", PARENTS[level]
        above = "dim_plataforma" if parent == "plataforma_sk" else f"dim_{LEVELS[LEVELS.index(level) - 1]}"
        out += [
            fused.unique(f"{dim} key unique", dim, f"{level}_sk"), null(f"{dim} key not null", dim, f"{level}_sk"), fused.relation(f"{dim} parent exists", dim, parent, above, parent),
            fused.apart(f"{dim} versions apart", dim, f"{level}_nk", "valido_de", "valido_ate"), fused.one_current(f"{dim} one current version", dim, f"{level}_nk", "is_atual"),
        ]
    out += [
        fused.unique("dim_plataforma unique", "dim_plataforma", "plataforma_sk"), fused.accepted_values("dim_plataforma accepted", "dim_plataforma", "nome", labels), fused.unique("dim_tempo unique", "dim_tempo", "data"),
        fused.accepted_values("dim_tempo weekdays", "dim_tempo", "dia_semana", list(range(1, 8))), fused.unique("fact grain", facts, "anuncio_sk", "tempo_sk", nulls=True),
        fused.relation("fact ad exists", facts, "anuncio_sk", "dim_anuncio", "anuncio_sk"), fused.relation("fact day exists", facts, "tempo_sk", "dim_tempo", "tempo_sk"),
    ]
    return out


def checked(silver: DataFrame, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The star and its consumption view, stored, and the report on all checks: row checks and the traversal's rows are counted on the way, keys in one scan of each table."""
    counted: dict[str, int] = {}
    tables = materialise(silver, folder, counted)
    view, _, rows = fused.stored(consumption(tables), f"{folder}/vw_metricas_completas", [])
    traversal = fused.rows_where("traversal keeps rows", "fato_metricas", F.lit(False))
    return tables | {"vw_metricas_completas": view}, fused.violations(tables, [*keyed_checks(), traversal], counted | {traversal.name: int(rows != counted["rows of fato_metricas"])})
