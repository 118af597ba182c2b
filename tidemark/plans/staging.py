"""From raw records to typed staging tables of one contract, and their union with chained natural keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import METRIC, json_metric, natural_key, sum_json_array, whole
from tidemark.operators.snapshots import latest_snapshot
from tidemark.sources.registry import LEVELS, METRICS, SOURCES, Source

#: The staging contract: names and their order.
STAGING = ["plataforma", "data", *(f"{level}_{c}" for level in LEVELS for c in ("external_id", "nome")), *METRICS, "extracted_at"]

#: Payload fields by source: identifiers and names of the levels, then plain metrics with their types; fixed values.
FIELDS = {
    "meta_ads": {"levels": ["account", "campaign", "adset", "ad"], "metrics": {"spend": ("spend", METRIC), "impressions": ("impressions", "bigint"), "link_clicks": ("inline_link_clicks", "int"), "reach": ("reach", "bigint")}},
    "google_ads": {"levels": ["account", "campaign", "ad_group", "ad"], "metrics": {"spend": ("cost", METRIC), "impressions": ("impressions", "bigint"), "link_clicks": ("clicks", "int"), "conversions": ("conversions", METRIC), "conversion_value": ("conversions_value", METRIC), "video_views": ("video_trueview_views", "bigint")}},
}
#: Metrics summed from arrays of actions: array, types, output type; fixed values.
ACTIONS = {
    "meta_ads": {"conversions": ("actions", ["lead"], METRIC), "conversion_value": ("action_values", ["lead"], METRIC), "video_views": ("actions", ["video_view"], "bigint"), "profile_views": ("actions", ["onsite_conversion.ig_profile_view"], "int"), "purchases": ("actions", ["purchase", "omni_purchase"], "int")},
}
#: Payload fields that staging leaves aside on purpose.
IGNORED = {"meta_ads": {"date_start", "date_stop"}, "google_ads": {"date"}}
_TYPES = {"spend": METRIC, "impressions": "bigint", "link_clicks": "int", "conversions": METRIC, "conversion_value": METRIC, "video_views": "bigint", "reach": "bigint", "profile_views": "int", "purchases": "int"}


def consumed(source: str) -> set[str]:
    """Payload fields that staging reads, with those it ignores."""
    spec = FIELDS[source]
    levels = {f"{level}_{c}" for level in spec["levels"] for c in ("id", "name")}
    return levels | {k for k, _ in spec["metrics"].values()} | {a for a, _, _ in ACTIONS.get(source, {}).values()} | IGNORED[source]


def _metric(source: str, metric: str) -> Column:
    if metric in FIELDS[source]["metrics"]:
        return json_metric("payload", *FIELDS[source]["metrics"][metric])
    if metric in ACTIONS.get(source, {}):
        array, types, kind = ACTIONS[source][metric]
        total = sum_json_array("payload", array, types)
        return total if kind == METRIC else whole(total, kind)
    return F.lit(0).cast(_TYPES[metric])


def staged(raw: DataFrame, source: Source) -> DataFrame:
    """The newest snapshot of each day of a source, typed. `raw` has source, reference_date, extracted_at and a VARIANT payload."""
    rows = latest_snapshot(raw.where(F.col("source") == source.name), ["reference_date"], "extracted_at")
    text = lambda field: F.variant_get("payload", f"$.{field}", "string")
    hierarchy = [text(f"{field}_{c}").alias(f"{level}_{out}") for level, field in zip(LEVELS, FIELDS[source.name]["levels"], strict=True) for c, out in (("id", "external_id"), ("name", "nome"))]
    return rows.select(F.lit(source.label).alias("plataforma"), F.col("reference_date").alias("data"), *hierarchy, *(_metric(source.name, m).alias(m) for m in METRICS), "extracted_at")


def unified(*stagings: DataFrame) -> DataFrame:
    """The stagings under each other by name, with the platform's key and a natural key of each level that holds its parents'."""
    rows = reduce(DataFrame.unionByName, (s.select(*STAGING) for s in stagings))
    parts, keys = ["plataforma"], {}
    for level in LEVELS:
        parts = [*parts, f"{level}_external_id"]
        keys[f"{level}_nk"] = natural_key(*parts)
    return rows.withColumns({"plataforma_sk": natural_key("plataforma"), **keys})


def silver(raw: DataFrame) -> DataFrame:
    return unified(*(staged(raw, s) for s in SOURCES.values()))
