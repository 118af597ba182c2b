"""Column helpers: keys, dates, ratios, semi-structured sums, masks and keyed hashes. All stay in the JVM."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC = "decimal(28,12)"
OPEN_END = "9999-12-31"
REDACTED = "***REDACTED***"
#: Parameter names whose values are secret, and shapes of secrets that stand alone.
SECRET_PARAMETERS = ["access_token", "refresh_token", "developer_token", "client_secret", "app_secret", "appsecret_proof", "password", "api_key"]
SECRET_SHAPES = ["EAA[A-Za-z0-9]{20,}", r"GOCSPX-[A-Za-z0-9_\-]{10,}", r"1//[A-Za-z0-9_\-]{20,}"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def natural_key(*parts: Column | str) -> Column:
    """md5 of the parts joined by a bar; null if any part is, so that a broken hierarchy is seen downstream."""
    out = _col(parts[0]).cast("string")
    for p in parts[1:]:
        out = F.concat(out, F.lit("|"), _col(p).cast("string"))
    return F.md5(out)


def version_key(key: Column | str, version: Column | str) -> Column:
    return F.md5(F.concat(_col(key), F.lit("|v"), _col(version).cast("string")))


def date_key(day: Column | str) -> Column:
    return F.md5(_col(day).cast("string"))


def iso_weekday(day: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(_col(day)) + 1).cast("smallint")


def parsed_date(text: Column | str) -> Column:
    """The date in the first ten characters, with or without leading zeros; null if there is none."""
    return F.try_to_date(F.substring(_col(text), 1, 10), "yyyy-M-d")


def is_iso_date(text: Column | str) -> Column:
    return _col(text).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(_col(text), "yyyy-MM-dd").isNotNull()


def business_day(instant: Column | str, zone: str) -> Column:
    """The civil day of a UTC instant in a time zone."""
    return F.to_date(F.from_utc_timestamp(_col(instant), zone))


def rolling_window(instant: Column | str, days: int, zone: str) -> tuple[Column, Column]:
    """First and last day of the `days` whole days before the instant's civil day."""
    if days < 1:
        raise ValueError("a window has at least one day")
    today = business_day(instant, zone)
    return F.date_sub(today, days), F.date_sub(today, 1)


def window_dates(first: Column | str, last: Column | str) -> Column:
    """One row for each day of a window."""
    return F.explode(F.sequence(_col(first), _col(last)))


def json_metric(payload: Column | str, key: str, kind: str = METRIC, default: int = 0) -> Column:
    """A typed field of a VARIANT; numbers may be quoted. Absent gives the default, garbage raises."""
    return F.coalesce(F.variant_get(_col(payload), f"$.{key}", kind), F.lit(default).cast(kind))


def whole(number: Column, kind: str) -> Column:
    """To an integer type with halves rounded away from zero."""
    return F.round(number, 0).cast(kind)


def sum_json_array(payload: Column | str, key: str, types: list[str], label: str = "action_type", value: str = "value") -> Column:
    """The sum of an array's values whose label is one of the types. No row is exploded; null values and a missing array count zero."""
    items = F.variant_get(_col(payload), f"$.{key}", f"array<struct<{label}:string,{value}:{METRIC}>>")
    zero = F.lit(0).cast(METRIC)
    total = F.aggregate(F.filter(items, lambda e: e[label].isin(types)), zero, lambda acc, e: (acc + F.coalesce(e[value], zero)).cast(METRIC))
    return F.coalesce(total, zero)


def ratio(top: Column | str, bottom: Column | str, digits: int | None = None, scale: int = 1) -> Column:
    """scale * top / bottom in exact decimals, null for a zero bottom."""
    out = _col(top).cast("decimal(20,6)") * F.lit(scale).cast("decimal(4,0)")
    out = out.cast("decimal(20,6)") / F.nullif(_col(bottom).cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))
    return out if digits is None else F.round(out, digits)


def micros(amount: Column | str) -> Column:
    """Money given in millionths."""
    return (_col(amount).cast("decimal(28,6)") / F.lit(1_000_000)).cast(METRIC)


def percent_change(before: Column | str, after: Column | str) -> Column:
    """Signed change in percent, halves rounded to even; null where there is no base."""
    b, a = _col(before).cast("decimal(20,6)"), _col(after).cast("decimal(20,6)")
    return F.bround((a - b) / F.nullif(F.abs(b), F.lit(0).cast("decimal(20,6)")) * 100, 2)


def exact_text(number: Column | str, digits: int = 6) -> Column:
    return F.round(_col(number), digits).cast(f"decimal(38,{digits})").cast("string")


def mask(text: Column | str, visible: int = 4) -> Column:
    """Stars and the last characters; stars alone for short, empty or null values."""
    t = F.coalesce(_col(text), F.lit(""))
    return F.when(F.char_length(t) <= visible, "***").otherwise(F.concat(F.lit("***"), F.right(t, F.lit(visible))))


def redact_secrets(text: Column | str, known: list[str] | None = None) -> Column:
    """Replaces known values, values of secret parameters and strings shaped like secrets."""
    out = _col(text)
    for value in sorted(known or [], key=len, reverse=True):
        out = F.replace(out, F.lit(value), F.lit(REDACTED))
    named = rf"""(?i)\b({"|".join(SECRET_PARAMETERS)})(\s*[=:]\s*["']?)([^\s"'&,;}})]+)"""
    out = F.regexp_replace(out, named, f"$1$2{REDACTED}")
    return reduce(lambda c, p: F.regexp_replace(c, p, REDACTED), SECRET_SHAPES, out)


def hmac_pads(df: DataFrame, key: bytes) -> DataFrame:
    """Adds the two padded key blocks of HMAC-SHA256 as columns _inner and _outer from a one-row table, so that the key is no literal of the plan."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    row = [(bytearray(b ^ 0x36 for b in key), bytearray(b ^ 0x5C for b in key))]
    spark = df.sparkSession
    one = spark.createDataFrame(spark.sparkContext.parallelize(row, 1), "_inner binary, _outer binary")
    return df.join(F.broadcast(one), F.lit(True))


def hmac_sha256(message: Column | str) -> Column:
    """Upper-case hexadecimal HMAC-SHA256 of a text on a table with pads."""
    inner = F.unhex(F.sha2(F.concat("_inner", F.encode(_col(message), "UTF-8")), 256))
    return F.upper(F.sha2(F.concat("_outer", inner), 256))
