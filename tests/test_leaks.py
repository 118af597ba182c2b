"""Many values searched in many cells: brute force, and values that wait at rare grams."""

import random

from pyspark.sql import functions as F

from tidemark.operators import audit


def test_contained_equals_brute_force(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abé漢 ", k=n))
    cells = [word(rng.randrange(0, 30)) for _ in range(400)] + ["aaaaaaaaaa", None, ""]
    values = [word(rng.randrange(1, 8)) for _ in range(200)] + ["aaaa", "a.*b", None, "", "never seen at all"] + [cells[7]]
    df = lambda xs, c: spark.createDataFrame([(x, "clash") for x in xs], f"{c} string, gram string").repartition(3)
    got = sorted(map(tuple, audit.contained(df(cells * 2, "cell"), "cell", df(values * 2, "value"), "value").collect()))
    assert got == sorted((c, v) for c in {*cells} - {None} for v in {*values} - {None} if len(v) >= audit.LEAST_SEARCHED and v in c)
    assert audit.contained(df([], "cell"), "cell", df(values, "value"), "value").count() == 0


def test_values_wait_at_rare_grams(spark, capfd):
    """All cells and values share their beginning; each value is met by about one cell, not by all."""
    cells = spark.range(3000).select(F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 6, "x")).alias("cell"))
    values = spark.range(0, 3000, 3).select(F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 6, "x")).alias("value"))
    found = audit.contained(cells, "cell", values, "value")
    assert found.count() == 1000
    capfd.readouterr()
    found.explain()
    text = capfd.readouterr().out
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    grams = cells.select(F.explode(audit._grams("cell", 4)).alias("gram")).groupBy("gram").count()
    waiting = values.select("value", F.explode(audit._grams("value", 4)).alias("gram")).join(grams, "gram").groupBy("value").agg(F.min("count").alias("n"))
    assert waiting.agg(F.sum("n")).first()[0] < 40 * 1000  # pairs compared, of 3,000,000
