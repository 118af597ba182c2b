"""The registry of sources and the layout of the layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Metrics in their order, and levels of the hierarchy from the top.
METRICS = ["spend", "impressions", "link_clicks", "conversions", "conversion_value", "video_views", "reach", "profile_views", "purchases"]
LEVELS = ["conta", "campanha", "adset", "anuncio"]


@dataclass(frozen=True)
class Source:
    key: str
    label: str
    name: str
    file: str
    date_field: str


#: Fixed values.
SOURCES = {s.key: s for s in (Source("meta", "Meta Ads", "meta_ads", "temp_meta_raw.json", "date_start"), Source("google", "Google Ads", "google_ads", "temp_google_raw.json", "date"))}


def by_name(name: str) -> Source:
    for s in SOURCES.values():
        if s.name == name:
            return s
    raise ValueError(f"unknown source {name!r}; known: {', '.join(s.name for s in SOURCES.values())}")


def unknown_sources(df: DataFrame, column: str = "source") -> DataFrame:
    """Rows of a source that isn't registered."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin([s.name for s in SOURCES.values()]))
