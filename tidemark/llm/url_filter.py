"""URL filters in DataFrame functions: rules first, then gradient-boosted trees on lexical features.

Features of a URL: lengths, depth, digit ratio, entropy of its characters, parameter counts, hyphens, and suffix
statistics: how often URLs with the same last label of the host, and with the same first part of the path, were bad among the
labelled ones. Trees are fitted by the DataFrame API of Spark's machine-learning library on a bounded sample of labelled
URLs, and scored as nested conditions, so scoring is one projection. A fifth of the sample, chosen by hash, is held out: it
sets the margin from which a URL is blocked.

Defined cases: a null URL or one without `://` has an empty host and path and is left to the trees; URLs with equal
text get equal verdicts, repeated rows too; without labelled URLs of both sorts everything has the one sort seen, or is
allowed; an empty table gives an empty result; very long URLs are judged whole; other columns pass through.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, replace

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import sampled, written

#: (verdict, host, path); fixed values of the contract.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digit_ratio", "f_entropy", "f_parameters", "f_query_length", "f_hyphens", "f_suffix", "f_section"]
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Trees:
    #: Bound of the sample of labelled URLs that the trees are fitted on.
    max_labelled: int = 20_000
    rounds: int = 12
    depth: int = 3
    #: Weight of the overall rate in a suffix's rate.
    suffix_prior: float = 20.0
    seed: int = 7
    #: Labelled URLs that each leaf needs, and each suffix or first part of a path that has a rate of its own.
    leaf: int = 25


@dataclass(frozen=True)
class Model:
    #: (weight, tree); a tree is a number or (feature, threshold, left, right).
    trees: list
    bias: float
    #: Column -> its values' shares of bad URLs.
    rates: dict[str, dict[str, float]]
    other: float
    #: Sums of trees above it block.
    margin: float = 0.0
    #: On held-out URLs: how many, share judged rightly, share of the larger sort.
    held_out: tuple[int, float, float] = (0, 0.0, 0.0)


def host_and_path(url: Column) -> tuple[Column, Column]:
    host, path = (F.coalesce(F.regexp_extract(url, _PARTS, i), F.lit("")) for i in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    size = F.char_length(text)
    share = lambda c: (size - F.char_length(F.replace(text, c, F.lit("")))) / size
    parts = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c == "", 0.0).otherwise(-share(c) * F.log2(share(c))))
    return F.when(size > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host, path, suffix and the features that need no labels."""
    u = F.coalesce(F.col(url), F.lit(""))
    out = df.withColumns(dict(zip(("host", "path"), host_and_path(u), strict=True))).withColumns({"suffix": F.substring_index("host", ".", -1), "section": F.regexp_extract("path", "^/([^/]*)/", 1)})
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    count = lambda c, s: F.regexp_count(c, F.lit(s)).cast("double")
    size = lambda c: F.char_length(c).cast("double")
    return out.withColumns({
        "f_length": size(u), "f_host_length": size("host"), "f_path_length": size("path"), "f_depth": count(F.col("path"), "/[^/]"),
        "f_labels": count(F.col("host"), r"[^.]+"), "f_digit_ratio": count(u, "[0-9]") / F.greatest(size(u), F.lit(1.0)), "f_entropy": _entropy(u),
        "f_parameters": count(query, "[^&]+"), "f_query_length": size(query), "f_hyphens": count(u, "-"),
    })


def _tree(node):
    """A fitted tree's node as plain values."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def boosted(rows: DataFrame, how: Trees = Trees()):
    """The fitted model of Spark's library on rows with the features and `bad`."""
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", F.col("bad").cast("double").alias("label")).repartition(4)
    return GBTClassifier(maxIter=how.rounds, maxDepth=how.depth, minInstancesPerNode=how.leaf, seed=how.seed).fit(ready)


def fit(labelled: DataFrame, how: Trees = Trees()) -> Model:
    """Fits on rows (url, bad); the sample is chosen by hash. Each URL counts once, as bad if half of its rows are."""
    rows = labelled.where("bad is not null").select(F.coalesce("url", F.lit("")).alias("url"), F.col("bad").cast("int").alias("bad"))
    some = sampled(rows, "url", how.max_labelled).groupBy("url").agg((2 * F.sum("bad") >= F.count("*")).cast("int").alias("bad"))
    sample = written(lexical(some).withColumn("held", F.pmod(F.xxhash64("url", F.lit(how.seed)), F.lit(5)) == 0), "labelled")
    bad, n = sample.where("not held").agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count("*")).first()
    if bad in (0, n):
        return Model([], 1.0 if bad else -1.0, {}, 0.0)
    rate = bad / n
    rates = {}
    for c in ("suffix", "section"):
        counted = sample.where("not held").groupBy(c).agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).where(F.col("n") >= how.leaf).collect()
        rates[c] = {r[c]: round((r["bad"] + how.suffix_prior * rate) / (r["n"] + how.suffix_prior), 6) for r in counted}
    model = Model([], 0.0, rates, round(rate, 6))
    rated = sample.withColumns(_rates(model))
    fitted = boosted(rated.where("not held"), how)
    model = replace(model, trees=[(float(w), _tree(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)])
    steps = [k / 10 for k in range(-15, 16)]
    wrong = lambda t: F.sum(((score(model) > t) != (F.col("bad") == 1)).cast("long"))
    found = rated.where("held").agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), *map(wrong, steps)).first()
    if not found[0]:
        return model
    k = min(range(len(steps)), key=lambda k: (found[2 + k], abs(steps[k])))
    return replace(model, margin=steps[k], held_out=(found[0], round(1 - found[2 + k] / found[0], 4), round(max(found[1], found[0] - found[1]) / found[0], 4)))


def _rates(model: Model) -> dict[str, Column]:
    """f_suffix and f_section; values with fewer than a leaf's URLs in the sample have the overall rate, so the maps are bounded."""

    def rate(c: str) -> Column:
        known = model.rates.get(c)
        if not known:
            return F.lit(model.other)
        return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in sorted(known.items()) for x in kv)), F.col(c)), F.lit(model.other))

    return {f"f_{c}": rate(c) for c in ("suffix", "section")}


def score(model: Model) -> Column:
    """The sum of the trees on rows with features."""
    out = F.lit(model.bias)
    for weight, tree in model.trees:
        out = out + weight * _value(tree)
    return out


def _value(tree) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, left, right = tree
    return F.when(F.col(FEATURES[feature]) <= threshold, _value(left)).otherwise(_value(right))


def judge(df: DataFrame, model: Model, url: str = "url", rules=RULES) -> DataFrame:
    """Adds host, path, rule and verdict; columns of df with those names are replaced."""
    names = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    rows = lexical(df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(url).alias("url"))).withColumns(_rates(model)).withColumn("ruled", ruled(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("ruled.verdict"), F.when(score(model) > model.margin, "block").otherwise("allow"))
    return rows.select("row.*", "host", "path", F.col("ruled.rule").alias("rule"), verdict.alias("verdict"))


def labelled_by_rules(df: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """(url, bad) of the URLs that a rule decides."""
    out = df.select(F.col(url).alias("url"), ruled(*host_and_path(F.col(url)), rules)["verdict"].alias("verdict"))
    return out.where("verdict is not null").select("url", F.when(F.col("verdict") == "block", 1).otherwise(0).alias("bad"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of pages whose path's number is a labelled document: bad if that is toxic or of low quality."""
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)', 1) as long)")
    marks = labels.groupBy("doc_id").agg(F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad"))
    return pages.select("url", number.alias("doc_id")).where("doc_id is not null").join(marks, "doc_id").select("url", "bad")
