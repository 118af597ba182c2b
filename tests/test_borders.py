"""Matches over row borders against the joined text."""

import random
import re

from tidemark.operators import borders

PATTERNS = {"telephone": r"\(?\d{2}\)?\s?9?\d{4}-?\d{4}", "title": r"(?i)\b(dr|dra)\.?\s", "mail": r"[\w.+-]+@[\w-]+\.[\w.]+"}


def _count(texts):
    whole = "\n".join(t or "" for t in texts)
    return {n: len(re.findall(p, whole)) for n, p in PATTERNS.items()}


def _got(spark, texts, path, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts, 1)], "position long, text string").repartition(4)
    return {r["pattern"]: r["matches"] for r in borders.pattern_counts(df, PATTERNS, path, **how).collect()}


def test_counts_equal_those_of_the_joined_text(spark, tmp_path):
    rng = random.Random(5)
    parts = ["11", "(11)", "99999-1234", "1234", "5678", "12345678", "dr", "Dra.", " ", "x", "a@b.c", "", "-", "21987654321"]
    for n in range(3):
        texts = ["".join(rng.choices(parts, k=rng.randrange(4))) for _ in range(400)] + ["dr"]
        texts[7] = None
        assert _got(spark, texts, str(tmp_path / f"a{n}")) == _count(texts)
    assert _count(texts)["telephone"] != sum(len(re.findall(PATTERNS["telephone"], t or "")) for t in texts)


def test_chains_of_borders_and_nothing(spark, tmp_path):
    chain = ["tel (11", *["99999-1234 (11"] * 50, "99999-1234"]
    texts = ["plain text"] * 300 + chain + ["dr", "x"]
    want = _count(texts)
    assert want["title"] == 1 and want["telephone"] >= 51 and _got(spark, texts, str(tmp_path / "c")) == want
    assert _got(spark, [], str(tmp_path / "n")) == dict.fromkeys(PATTERNS, 0)
    assert _got(spark, ["only dr"], str(tmp_path / "o")) == _count(["only dr"])
