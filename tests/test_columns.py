import datetime as dt
import hashlib
import hmac
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import audit, quality


def _one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())] if values else [(1,)], list(values) or ["_x"])
    return df.select(column.alias("v")).first()[0]


def test_keys_are_null_safe(spark):
    assert _one(spark, C.natural_key("a", "b"), a="x", b="y") == hashlib.md5(b"x|y").hexdigest()
    assert spark.createDataFrame([("x", None)], "a string, b string").select(C.natural_key("a", "b")).first()[0] is None


def test_hmac_is_the_standard_one(spark):
    for key in (b"k" * 10, b"k" * 64, b"long" * 40):
        df = C.hmac_pads(spark.createDataFrame([("nível|1",)], "m string"), key)
        assert df.select(C.hmac_sha256("m")).first()[0] == hmac.new(key, "nível|1".encode(), hashlib.sha256).hexdigest().upper()


def test_dates_and_windows(spark):
    assert _one(spark, C.parsed_date("t"), t="2026-1-5") == dt.date(2026, 1, 5)
    assert _one(spark, C.parsed_date("t"), t="05/01/2026") is None
    assert _one(spark, C.iso_weekday(F.to_date("t")), t="2026-01-04") == 7
    first, last = C.rolling_window(F.col("t").cast("timestamp"), 7, "America/Sao_Paulo")
    assert _one(spark, first, t="2026-08-17 09:00:00") == dt.date(2026, 8, 10) and _one(spark, last, t="2026-08-17 09:00:00") == dt.date(2026, 8, 16)
    assert _one(spark, last, t="2026-08-18 02:00:00") == dt.date(2026, 8, 16)
    assert spark.sql("select date'2028-02-27' a, date'2028-03-01' b").select(C.window_dates("a", "b").alias("d")).count() == 4


def test_numbers(spark):
    assert _one(spark, C.whole(F.lit(Decimal("2.5")), "bigint")) == 3
    assert _one(spark, C.ratio(F.lit(1), F.lit(0))) is None and _one(spark, C.ratio(F.lit(1), F.lit(3), 2, 100)) == Decimal("33.33")
    assert _one(spark, C.percent_change(F.lit(0), F.lit(3))) is None and _one(spark, C.percent_change(F.lit(8), F.lit(7))) == Decimal("-12.50")
    assert _one(spark, C.micros(F.lit(1_500_000))) == Decimal("1.5")


def test_mask_and_redaction(spark):
    assert [_one(spark, C.mask("t"), t=t) for t in ("", "abcd", "abcdef")] == ["***", "***", "***cdef"]
    text = 'url?access_token=abc123&x=1 client_secret: "s e" GOCSPX-abcdefghijkl EAA' + "b" * 25
    out = _one(spark, C.redact_secrets("t", ["x=1"]), t=text)
    assert "abc123" not in out and "GOCSPX" not in out and "EAAb" not in out and "access_token=" in out and "x=1" not in out


def test_patterns_count_unicode(spark):
    df = spark.createDataFrame([("mail a@é.com www.x.org 11 98765-4321",), (None,)], "t string")
    found = {r["pattern"]: r["matches"] for r in audit.pattern_counts(df, "t").collect()}
    assert found["email"] == 1 and found["www"] == 1 and found["telefone"] == 1 and found["arroba"] == 1 and found["cnpj"] == 0


def test_checks_find_one_bad_row(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", -1), (None, "z", 0)], "k int, c string, v int")
    assert quality.unique(df, "k").count() == 1 and quality.not_null(df, "k").count() == 1 and quality.non_negative(df, ["v"]).count() == 1
    assert [r["c"] for r in quality.accepted_values(df, "c", ["a"]).collect()] == ["z"]
    assert quality.relationships(df, "k", spark.createDataFrame([(2,)], "p int"), "p").count() == 2
    assert quality.same_contract(df, df.select("k", "v", "c")).count() == 2
