"""Privacy-preserving export: keyed pseudonyms, column contracts that fail closed, raw records rewritten field by field."""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hmac_pads, hmac_sha256, is_iso_date
from tidemark.operators.quality import one_parent
from tidemark.sources.registry import LEVELS, METRICS

#: The labels' prefixes.
PREFIXES = {"conta": "Cliente", "campanha": "Campanha", "adset": "AdSet", "anuncio": "Anuncio"}
DIGITS = 8
#: Blocks of eight digits that tell all entities apart: one block (32 bits) is shared by two of some 65,000 already, two are by none of millions.
WIDE = 2
#: Fixed value: what the key signs for its fingerprint.
FINGERPRINTED = b"fingerprint-da-chave-de-pseudonimizacao"
LEAST_KEY = 32
PLACEHOLDERS = {"changeme", "change-me", "your-key-here", "placeholder", "secret", "example"}

USED, FORBIDDEN, IGNORED = "USED", "FORBIDDEN", "IGNORED"
EXPORTED = ["data", "plataforma", *(f"{level}_{c}" for level in LEVELS for c in ("id", "versao")), *METRICS]
#: What each column of the consumption view may be used for.
CLASSES = {
    **dict.fromkeys(["data", "plataforma", *(f"{level}_{c}" for level in LEVELS for c in ("nk", "versao")), *METRICS], USED),
    **dict.fromkeys([f"{level}_{c}" for level in LEVELS for c in ("nome", "external_id")], FORBIDDEN),
    **dict.fromkeys(["dia", "mes", "ano", "trimestre", "dia_semana", "ano_mes"], IGNORED),
}


def checked_key(key: str | None) -> bytes:
    """The key's bytes; a missing, placeholder or short one is refused, and never shown."""
    if not key:
        raise ValueError("no pseudonym key")
    if key.strip().lower() in PLACEHOLDERS or len(set(key)) < 4:
        raise ValueError("the pseudonym key is a placeholder")
    if len(key) < LEAST_KEY:
        raise ValueError(f"the pseudonym key is shorter than {LEAST_KEY} characters")
    return key.encode()


def key_fingerprint(key: bytes) -> str:
    """16 digits that tell keys apart without showing them."""
    return hmac.new(key, FINGERPRINTED, hashlib.sha256).hexdigest()[:16].upper()


def _label(level: str, message: Column, blocks: int) -> Column:
    """Prefix and the first blocks of eight digits of a message's keyed hash; what divides blocks keeps digits from looking like a telephone's."""
    digest = hmac_sha256(message)
    return F.concat(F.lit(f"{PREFIXES[level]}-"), F.concat_ws("_", *(F.substring(digest, 1 + DIGITS * i, DIGITS) for i in range(blocks))))


def first_block(label: Column | str) -> Column:
    """A label cut to its first block, as it is with one block alone."""
    return F.substring_index(label, "_", 1)


def public_id(level: str, key: Column | str, blocks: int = 1) -> Column:
    """Prefix and first digits of the keyed hash of level and key, on a table with pads; a null or empty key raises."""
    if level not in PREFIXES:
        raise ValueError(f"unknown level {level!r}")
    k = F.col(key) if isinstance(key, str) else key
    known = F.when(F.length(k) > 0, k).otherwise(F.raise_error(F.lit(f"a {level} has no key")).cast("string"))
    return _label(level, F.concat(F.lit(f"{level}|"), known), blocks)


def contract_problems(columns: list[str], classes: dict[str, str] = CLASSES) -> list[str]:
    """Columns that nobody has classified, and used ones that are missing. Any problem stops an export."""
    return [f"not classified: {c}" for c in columns if c not in classes] + [f"missing: {c}" for c, use in classes.items() if use == USED and c not in columns]


def exposed(view: DataFrame, key: bytes, blocks: int = 1) -> DataFrame:
    """The 19 exported columns, natural keys replaced by pseudonyms of so many blocks of eight digits."""
    if problems := contract_problems(view.columns):
        raise ValueError("; ".join(problems))
    rows = hmac_pads(view, key)
    ids = {f"{level}_id": public_id(level, f"{level}_nk", blocks) for level in LEVELS}
    return rows.withColumns(ids).select(*EXPORTED)


def _differs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of two grouped tables of the same columns that only one has, or with other values."""
    values = [c for c in a.columns if c not in keys]
    both = a.join(b.select(*keys, *(F.col(c).alias(f"_{c}") for c in values)), keys, "full_outer")
    return both.where(reduce(lambda x, y: x | y, (~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in values)))


def post_checks(view: DataFrame, artifact: DataFrame) -> DataFrame:
    """Problems of an artifact against the view, one a row: columns, counts, sums by platform and day, the set of days, grain, collisions, hierarchy, versions, natural keys in any cell.

    Both sides are compared as they are; nothing relies on how the artifact was made. Another set of columns ends the checks.
    """
    spark = view.sparkSession
    if list(artifact.columns) != EXPORTED:
        leaked = sorted(c for c in artifact.columns if CLASSES.get(c) == FORBIDDEN)
        return spark.createDataFrame([(p,) for p in ["the columns differ", *(f"forbidden column: {c}" for c in leaked)]], "problem string")
    any_of = lambda rows, text: rows.limit(1).select(F.lit(text).alias("problem"))
    sums = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("rows"), *(F.sum(m).cast("decimal(38,6)").alias(m) for m in METRICS))
    totals = lambda df: sums(df, "data").agg(F.sum("rows").alias("rows"), F.count("*").alias("days"), *(F.sum(m).cast("decimal(38,6)").alias(m) for m in METRICS))
    a, b = totals(view), totals(artifact)
    joined = a.select(*(F.col(c).alias(f"a_{c}") for c in a.columns)).join(b, F.lit(True))
    parts = [joined.where(~F.col(f"a_{c}").eqNullSafe(F.col(c))).select(F.lit(f"{c} differs").alias("problem")) for c in a.columns]
    parts.append(any_of(_differs(sums(view, "plataforma", "data"), sums(artifact, "plataforma", "data"), ["plataforma", "data"]), "sums by platform and day differ"))
    days = lambda df: df.select(F.col("data").cast("string").alias("data")).distinct().withColumn("found", F.lit(True))
    parts.append(any_of(_differs(days(view), days(artifact), ["data"]), "the set of days differs"))
    cardinal = view.agg(*(F.count_distinct(f"{level}_nk").alias(f"a_{level}") for level in LEVELS)).join(artifact.agg(*(F.count_distinct(f"{level}_id").alias(level) for level in LEVELS)), F.lit(True))
    parts += [cardinal.where(F.col(f"a_{level}") != F.col(level)).select(F.lit(f"two keys of {level} share a label").alias("problem")) for level in LEVELS]
    parts += [any_of(one_parent(artifact, f"{child}_id", f"{parent}_id"), f"a {child} has two parents") for parent, child in zip(LEVELS, LEVELS[1:], strict=False)]
    parts.append(any_of(artifact.groupBy("anuncio_id", "data").agg(F.count("*").alias("n")).where("n > 1"), "the grain isn't unique"))
    versions = lambda df: df.select(F.explode(F.array(*(F.struct(F.lit(level).alias("level"), F.col(f"{level}_versao").cast("long").alias("version")) for level in LEVELS))).alias("x")).groupBy("x.level", "x.version").agg(F.count("*").alias("rows"))
    parts.append(_differs(versions(view), versions(artifact), ["level", "version"]).select(F.concat(F.lit("versions of "), "level", F.lit(" differ")).alias("problem")).distinct())
    cells = artifact.select(F.explode(F.array(*(F.col(c).cast("string") for c in artifact.columns))).alias("cell")).distinct()
    keys = view.select(F.explode(F.array(*(F.struct(F.lit(level).alias("level"), F.col(f"{level}_nk").alias("cell")) for level in LEVELS))).alias("x")).select("x.*").distinct()
    parts.append(keys.join(cells, "cell", "left_semi").select(F.concat(F.lit("a natural key of "), "level", F.lit(" survives")).alias("problem")).distinct())
    return reduce(DataFrame.unionByName, parts)


def export_manifest(artifact: DataFrame) -> DataFrame:
    """One row that describes an artifact: rows, days, entities, and an order-insensitive fingerprint."""
    return artifact.agg(F.count("*").alias("rows"), F.min("data").alias("first_day"), F.max("data").alias("last_day"), *(F.count_distinct(f"{level}_id").alias(f"n_{level}") for level in LEVELS), F.sum(F.xxhash64(*artifact.columns).cast("decimal(38,0)")).alias("fingerprint"))


def guard_target(path: str, published: str, allow: bool = False) -> str:
    """Refuses the publication folder unless it is asked for."""
    if not allow and (path.rstrip("/") + "/").startswith(published.rstrip("/") + "/"):
        raise ValueError("the target is the publication folder")
    return path


# Raw records.

#: The labels that may stay in nested arrays.
ALLOWED_LABELS = [
    "comment",
    "landing_page_view",
    "lead",
    "like",
    "link_click",
    "offsite_complete_registration_add_meta_leads",
    "offsite_content_view_add_20_s_calls",
    "offsite_content_view_add_meta_leads",
    "offsite_conversion.fb_pixel_custom",
    "offsite_conversion.fb_pixel_lead",
    "offsite_conversion.fb_pixel_view_content",
    "offsite_lead_add_20_s_calls",
    "offsite_search_add_meta_leads",
    "omni_landing_page_view",
    "omni_view_content",
    "onsite_conversion.lead",
    "onsite_conversion.lead_grouped",
    "onsite_conversion.messaging_block",
    "onsite_conversion.messaging_conversation_replied_7d",
    "onsite_conversion.messaging_conversation_started_7d",
    "onsite_conversion.messaging_first_reply",
    "onsite_conversion.messaging_user_depth_2_message_send",
    "onsite_conversion.messaging_user_depth_3_message_send",
    "onsite_conversion.messaging_user_depth_5_message_send",
    "onsite_conversion.post_net_comment",
    "onsite_conversion.post_net_like",
    "onsite_conversion.post_net_save",
    "onsite_conversion.post_save",
    "onsite_conversion.post_unlike",
    "onsite_conversion.post_unsave",
    "onsite_conversion.total_messaging_connection",
    "onsite_web_app_view_content",
    "onsite_web_lead",
    "onsite_web_view_content",
    "page_engagement",
    "photo_view",
    "post",
    "post_engagement",
    "post_interaction_gross",
    "post_interaction_net",
    "post_reaction",
    "video_view",
    "view_content",
]

ID, NAME, METRIC_FIELD, DAY, NESTED = "id", "name", "metric", "day", "nested"


@dataclass(frozen=True)
class Field:
    use: str
    kind: str
    level: str | None = None
    required: bool = True


def _contract(levels: list[str], days: list[str], metrics: dict[str, str], nested: list[str]) -> dict[str, Field]:
    out = {d: Field(DAY, "STRING") for d in days}
    for level, field in zip(LEVELS, levels, strict=True):
        out[f"{field}_id"], out[f"{field}_name"] = Field(ID, "STRING", level), Field(NAME, "STRING", level)
    return out | {m: Field(METRIC_FIELD, kind) for m, kind in metrics.items()} | {n: Field(NESTED, "ARRAY", required=False) for n in nested}


#: Field contracts by source: fixed values.
CONTRACTS = {
    "meta_ads": _contract(["account", "campaign", "adset", "ad"], ["date_start", "date_stop"], dict.fromkeys(["spend", "impressions", "inline_link_clicks", "reach"], "STRING"), ["actions", "action_values"]),
    "google_ads": _contract(["account", "campaign", "ad_group", "ad"], ["date"], {"impressions": "BIGINT", "clicks": "BIGINT", "cost": "DECIMAL", "conversions": "DECIMAL", "conversions_value": "DECIMAL", "video_trueview_views": "BIGINT"}, []),
}


def _kind_fits(kind: str, found: Column) -> Column:
    wanted = {"STRING": "^STRING$", "ARRAY": "^ARRAY<", "BIGINT": "^BIGINT$", "DECIMAL": "^(DECIMAL|DOUBLE|FLOAT|BIGINT)"}[kind]
    return found.rlike(wanted)


def contract_violations(raw: DataFrame, source: str) -> DataFrame:
    """row_id and problem: unknown or missing fields, wrong types, bad days, negative or non-numeric metrics, unequal days. `raw` has row_id and a VARIANT payload."""
    contract = CONTRACTS[source]
    keys = raw.select("row_id", F.explode(F.variant_get("payload", "$", "map<string,variant>"))).select("row_id", "key", F.schema_of_variant("value").alias("kind"), F.col("value").cast("string").alias("text"))
    known = F.col("key").isin(list(contract))
    wrong_kind = reduce(lambda c, f: F.when(F.col("key") == f[0], ~_kind_fits(f[1].kind, F.col("kind"))).otherwise(c), contract.items(), F.lit(False))
    days = [k for k, f in contract.items() if f.use == DAY]
    metrics = [k for k, f in contract.items() if f.use == METRIC_FIELD]
    number = F.expr("try_cast(text as decimal(28,12))")
    found = F.array_compact(F.array(
        F.when(~known, F.concat(F.lit("unknown field: "), "key")), F.when(known & wrong_kind, F.concat(F.lit("wrong type: "), "key")),
        F.when(F.col("key").isin(days) & ~F.coalesce(is_iso_date("text"), F.lit(False)), F.concat(F.lit("bad day: "), "key")),
        F.when(F.col("key").isin(metrics) & (number.isNull() | (number < 0)), F.concat(F.lit("bad number: "), "key")),
    ))
    by_field = keys.select("row_id", F.explode(found).alias("problem"))
    text = lambda k: F.variant_get("payload", f"$.{k}", "string")
    missing = F.array_compact(F.array(*(F.when(F.try_variant_get("payload", f"$.{k}", "variant").isNull(), F.lit(f"missing field: {k}")) for k, f in contract.items() if f.required)))
    by_row = raw.select("row_id", F.explode(missing).alias("problem"))
    if len(days) == 2:
        by_row = by_row.unionByName(raw.where(~text(days[0]).eqNullSafe(text(days[1]))).select("row_id", F.lit("first and last day differ").alias("problem")))
    return by_field.unionByName(by_row)


def nested_violations(raw: DataFrame, keys: list[str], allowed: list[str]) -> DataFrame:
    """row_id and problem: items of arrays that aren't exactly a label and a value, both text, with an allowed label."""
    parts = []
    for k in keys:
        items = raw.select("row_id", F.explode(F.try_variant_get("payload", f"$.{k}", "array<variant>")).alias("value")).select("row_id", F.schema_of_variant("value").alias("kind"), F.try_variant_get("value", "$.action_type", "string").alias("label"))
        shape = F.col("kind") != "OBJECT<action_type: STRING, value: STRING>"
        parts.append(items.select("row_id", F.explode(F.array_compact(F.array(F.when(shape, F.lit(f"{k}: wrong shape")), F.when(~F.coalesce(F.col("label").isin(allowed), F.lit(False)), F.lit(f"{k}: label not allowed"))))).alias("problem")))
    return reduce(DataFrame.unionByName, parts)


def anonymised_raw(raw: DataFrame, source: str, platform: str, key: bytes, blocks: int = 1, carried: list[str] | None = None) -> DataFrame:
    """row_id and the record as JSON: identifiers and names become one label each, days and metrics stay as they are. `carried` columns stay."""
    rows = hmac_pads(raw, key)
    text = lambda k: F.variant_get("payload", f"$.{k}", "string")
    fields = []
    for k, f in CONTRACTS[source].items():
        if f.use in (ID, NAME):
            own = text(k.rsplit("_", 1)[0] + "_id")
            fields.append(_label(f.level, F.concat(F.lit(f"bruto:v1|{platform}|"), own), blocks).alias(k))
        else:
            fields.append(F.variant_get("payload", f"$.{k}", "variant").alias(k))
    return rows.select("row_id", *(carried or []), F.to_json(F.struct(*fields)).alias("record"))


def label_collisions(labels: DataFrame, group: list[str], label: str, identity: str) -> DataFrame:
    """Labels that stand for more than one identity in a group."""
    return labels.groupBy(*group, label).agg(F.count_distinct(identity).alias("identities")).where("identities > 1")


def preservation_violations(before: DataFrame, after: DataFrame, kept: list[str], changed: list[str], key: str = "row_id", same: Mapping[str, str] | None = None) -> DataFrame:
    """Rows where a value that must stay differs, one that must change doesn't, or two columns of `same` have different labels afterwards. Rows that one side lacks differ. A null or empty value has nothing to change."""
    b = after.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in (*kept, *changed)))
    rows = before.join(b, key, "full_outer")
    return rows.select(key, F.explode(preservation_problems(kept, changed, same)).alias("problem"))


def preservation_problems(kept: list[str], changed: list[str], same: Mapping[str, str] | None = None) -> Column:
    """The same as an array of a row's problems, where the row has its columns before, and with a leading _ those after."""
    bad = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"changed: {c}")) for c in kept] + [F.when((F.length(c) > 0) & F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"kept: {c}")) for c in changed]
    bad += [F.when(~F.col(f"_{x}").eqNullSafe(F.col(f"_{y}")), F.lit(f"{x} isn't {y}")) for x, y in (same or {}).items()]
    return F.array_compact(F.array(*bad))
