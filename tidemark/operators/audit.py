"""Audit of an exported artifact, independent of the exporter: nothing is imported from it, and no value is ever reported, only counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the artifact's contract.
AUDITED_LEVELS = ["conta", "campanha", "adset", "anuncio"]
AUDITED_METRICS = ["spend", "impressions", "link_clicks", "conversions", "conversion_value", "video_views", "reach", "profile_views", "purchases"]
AUDITED_COLUMNS = ["data", "plataforma", *(f"{level}_{c}" for level in AUDITED_LEVELS for c in ("id", "versao")), *AUDITED_METRICS]
ID_SHAPES = {"conta_id": "^Cliente-[0-9A-F]{8}$", "campanha_id": "^Campanha-[0-9A-F]{8}$", "adset_id": "^AdSet-[0-9A-F]{8}$", "anuncio_id": "^Anuncio-[0-9A-F]{8}$"}
PLATFORMS = ["Meta Ads", "Google Ads"]
FORBIDDEN_SUFFIXES = ["_nk", "_sk", "_external_id", "_nome"]
#: Patterns of personal data.
FORBIDDEN_PATTERNS = {
    "url": r"(?i)https?://",
    "www": r"(?iU)\bwww\.",
    "dominio": r"(?iU)\b[\w-]+\.(com|com\.br|net|org|app|io|shop|store|med|adv|br)\b",
    "email": r"(?U)[\w.+-]+@[\w-]+\.[\w.]+",
    "telefone": r"(?U)\(?\d{2}\)?\s?9?\d{4}-?\d{4}",
    "cnpj": r"(?U)\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}",
    "tratamento_pessoal": r"(?iU)\b(dr|dra|drª)\.?\s",
    "arroba": r"(?U)@[\w.]+",
}
LEAST_SEARCHED = 4
#: How many hashes of grams there are: the bound of a table that every task holds.
_SIEVE = 1 << 18
#: What a manifest must hold.
MANIFEST_FIELDS = ["versao_contrato", "gerado_em", "artefato", "sha256", "linhas", "data_min", "data_max", "colunas", "tipos", "grao", "fingerprint_chave", "avisos"]


def schema_problems(columns: list[str]) -> list[str]:
    out = [] if columns == AUDITED_COLUMNS else ["the columns or their order differ"]
    return out + [f"forbidden suffix: {s}" for s in FORBIDDEN_SUFFIXES if any(c.endswith(s) for c in columns)]


def pattern_counts(df: DataFrame, text: Column | str) -> DataFrame:
    """Matches of each forbidden pattern and the rows that have any, in one scan."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    found = df.select(*(F.regexp_count(t, F.lit(p)).alias(n) for n, p in FORBIDDEN_PATTERNS.items()))
    sums = found.agg(*(F.struct(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("matches"), F.count_if(F.col(n) > 0).alias("rows")).alias(n) for n in FORBIDDEN_PATTERNS))
    return sums.select(F.expr("stack({}, {}) AS (pattern, x)".format(len(FORBIDDEN_PATTERNS), ", ".join(f"'{n}', {n}" for n in FORBIDDEN_PATTERNS)))).select("pattern", "x.matches", "x.rows")


def id_shapes(blocks: int = 1) -> dict[str, str]:
    """The identifiers' shapes with so many blocks of eight digits."""
    return {c: p.removesuffix("$") + "_[0-9A-F]{8}" * (blocks - 1) + "$" for c, p in ID_SHAPES.items()}


def content_problems(text: DataFrame, blocks: int = 1) -> DataFrame:
    """problem and count of an artifact whose cells are text: identifiers, domains, grain, hierarchy, versions, days, numbers. Rows are read three times: for cells, grain, and all levels' parents."""
    number = lambda c: F.expr(f"try_cast({c} as decimal(38,12))")
    single = {f"{c} out of shape": ~F.coalesce(F.col(c).rlike(p), F.lit(False)) for c, p in id_shapes(blocks).items()}
    single["platform out of domain"] = ~F.coalesce(F.col("plataforma").isin(PLATFORMS), F.lit(False))
    single |= {f"{level}_versao isn't a whole number of 1 or more": ~F.coalesce(F.col(f"{level}_versao").rlike("^0*[1-9][0-9]*$"), F.lit(False)) for level in AUDITED_LEVELS}
    single["bad day"] = ~F.coalesce(F.col("data").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date("data", "yyyy-MM-dd").isNotNull(), F.lit(False))
    single |= {f"{m} isn't a number": number(m).isNull() for m in AUDITED_METRICS}
    counts = text.agg(F.count("*").alias("n"), F.count_if(number("conversions") != F.floor(number("conversions"))).alias("f"), *(F.count_if(c).alias(f"c{i}") for i, c in enumerate(single.values())))
    found = {n: F.col(f"c{i}") for i, n in enumerate(single)}
    found["all conversions are whole"] = F.when((F.col("n") > 0) & (F.col("f") == 0), F.col("n")).otherwise(F.lit(0).cast("long"))
    found["no rows"] = F.when(F.col("n") == 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    parts = [counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("problem"), c.alias("count")) for n, c in found.items()))).alias("x")).select("x.*")]
    parts.append(text.groupBy("anuncio_id", "data").count().where("count > 1").agg(F.count("*").alias("count")).select(F.lit("the grain isn't unique").alias("problem"), "count"))
    above = F.array(*(F.struct(F.lit(f"a {child} has more than one {parent}").alias("problem"), F.col(f"{child}_id").alias("child"), F.col(f"{parent}_id").alias("parent")) for parent, child in zip(AUDITED_LEVELS, AUDITED_LEVELS[1:], strict=False)))
    parents = text.select(F.explode(above).alias("x")).groupBy("x.problem", "x.child").agg(F.min("x.parent").alias("a"), F.max("x.parent").alias("b"))
    parts.append(parents.where("a <> b").groupBy("problem").agg(F.count("*").alias("count")))
    return reduce(DataFrame.unionByName, parts).where("count > 0")


def _grams(text: Column | str, length: int) -> Column:
    """The distinct substrings of a length."""
    starts = F.sequence(F.lit(1), F.length(text) - (length - 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(length))))


def contained(cells: DataFrame, cell: str, values: DataFrame, value: str, length: int = LEAST_SEARCHED) -> DataFrame:
    """The pairs of distinct cells and distinct values, of `length` characters or more, where the cell holds the value as a part.

    Many patterns at once by an index of rarest grams: every gram of the cells is counted; a value waits at that of its grams which the
    fewest cells have, and not at all if some gram is in no cell. Cells meet the values that wait at their grams and are then compared.
    A gram that most cells have is therefore met only by values that have no rarer one; it spreads over tasks by cell.

    Cells are shuffled only under grams at which some value may wait: grams are counted in each task first, and a table of at most
    `_SIEVE` hashes of the grams waited at, which every task holds, keeps the others back.
    """
    texts = cells.select(F.col(cell).alias("cell")).where(F.length("cell") >= length).distinct()
    wanted = values.select(F.col(value).alias("value")).where(F.length("value") >= length).distinct()
    pieces = texts.select("cell", F.explode(_grams("cell", length)).alias("gram"))
    asked = wanted.select("value", F.explode(_grams("value", length)).alias("gram"))
    counted = pieces.groupBy("gram").agg(F.count("*").alias("n"))
    found = asked.join(counted, "gram", "left").groupBy("value").agg(F.min(F.struct("n", "gram")).alias("rarest"), F.count_if(F.col("n").isNull()).alias("absent")).where("absent = 0")
    waiting = found.select("value", F.col("rarest.gram").alias("gram"))
    sieve = F.pmod(F.xxhash64("gram"), F.lit(_SIEVE))
    met = pieces.withColumn("_hash", sieve).join(F.broadcast(waiting.select(sieve.alias("_hash")).distinct()), "_hash", "left_semi").drop("_hash")
    return met.join(waiting, "gram").where(F.contains("cell", "value")).select("cell", "value")


def leaks(text: DataFrame, real: DataFrame, value: str, blocks: int = 1) -> DataFrame:
    """cell column and number of cells that give away real values: by equality in cells of an identifier's shape, as a part of others.

    Equality is a hash join of distinct values. Only distinct cells without that shape are searched for parts, and such cells don't
    exist in a sound artifact.
    """
    cells = text.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("cell")) for c in text.columns))).alias("x")).select("x.*").where("cell is not null").distinct()
    values = real.select(F.col(value).alias("value")).where(F.length("value") > 0).distinct()
    equal = cells.join(values, F.col("cell") == F.col("value"), "left_semi")
    shaped = reduce(lambda a, b: a | b, (F.col("cell").rlike(p) for p in id_shapes(blocks).values())) | F.col("cell").rlike(r"^-?[0-9.]+$") | F.col("cell").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") | F.col("cell").isin(PLATFORMS)
    free = cells.where(~shaped)
    parts = free.join(contained(free, "cell", values, "value").select("cell").distinct(), "cell", "left_semi").select("column", "cell")
    return equal.unionByName(parts).distinct().groupBy("column").agg(F.count("*").alias("leaks"))


def invariant_problems(text: DataFrame, view: DataFrame) -> DataFrame:
    """problem and count against the warehouse: sums by platform and day, cardinalities, versions."""
    sums = lambda df: df.groupBy("plataforma", F.col("data").cast("string").alias("data")).agg(F.count("*").alias("rows"), *(F.sum(F.col(m).cast("decimal(28,12)")).cast("decimal(38,6)").alias(m) for m in AUDITED_METRICS))
    a, b = sums(text), sums(view)
    names = ["rows", *AUDITED_METRICS]
    both = a.join(b.select("plataforma", "data", *(F.col(c).alias(f"b_{c}") for c in names)), ["plataforma", "data"], "full_outer")
    differ = reduce(lambda x, y: x | y, (~F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in names))
    parts = [both.where(differ).agg(F.count("*").alias("count")).select(F.lit("sums by platform and day differ").alias("problem"), "count")]
    # each side's rows of every level, identifier and version are counted once, and give both the identifiers and the versions
    of = lambda df, key: df.select(F.explode(F.array(*(F.struct(F.lit(x).alias("level"), F.col(f"{x}_{key}").alias("id"), F.col(f"{x}_versao").cast("int").alias("v")) for x in AUDITED_LEVELS))).alias("x")).groupBy("x.level", "x.id", "x.v").agg(F.count("*").alias("n"))
    ids = lambda df, name: df.groupBy("level").agg(F.count_distinct("id").alias(name))
    versions = lambda df, *names: df.groupBy("level", "v").agg(F.sum("n").alias("n")).toDF(*names)
    x, y = of(text, "id"), of(view, "nk")
    n = ids(x, "a").join(ids(y, "b"), "level", "full_outer")
    parts.append(n.select(F.concat(F.lit("the number of "), "level", F.lit(" differs")).alias("problem"), F.abs(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("count")))
    both = versions(x, "level", "v", "n").join(versions(y, "l", "w", "m"), (F.col("level") == F.col("l")) & F.col("v").eqNullSafe(F.col("w")), "full_outer")
    parts.append(both.where(~F.col("n").eqNullSafe(F.col("m"))).groupBy(F.concat(F.lit("versions of "), F.coalesce("level", "l"), F.lit(" differ")).alias("problem")).agg(F.count("*").alias("count")))
    return reduce(DataFrame.unionByName, parts).where("count > 0")


def manifest_problems(text: DataFrame, manifest: DataFrame, sha256: DataFrame | None = None) -> DataFrame:
    """Fields of a manifest (one row) that are missing, or that the artifact doesn't bear out; `sha256` is the hash of its files."""
    spark = text.sparkSession
    if missing := [c for c in MANIFEST_FIELDS if c not in manifest.columns]:
        return spark.createDataFrame([(f"the manifest lacks {c}",) for c in missing], "problem string")
    now = text.agg(F.count("*").alias("now_linhas"), F.min("data").cast("string").alias("now_min"), F.max("data").cast("string").alias("now_max"))
    both = now.join(manifest, F.lit(True), "left")
    wrong = {
        "the number of rows differs": ~F.col("linhas").cast("long").eqNullSafe(F.col("now_linhas")), "the first day differs": ~F.col("data_min").cast("string").eqNullSafe(F.col("now_min")),
        "the last day differs": ~F.col("data_max").cast("string").eqNullSafe(F.col("now_max")), "the columns differ": ~F.array_join("colunas", ",").eqNullSafe(F.lit(",".join(AUDITED_COLUMNS))),
        "the warning about video_views is missing": ~F.coalesce(F.length(F.get_json_object(F.to_json("avisos"), "$.video_views")) > 0, F.lit(False)),
    }
    if sha256 is not None:
        both = both.join(sha256.select(F.col("sha256").alias("now_sha256")), F.lit(True), "left")
        wrong["the hash differs"] = ~F.col("sha256").eqNullSafe(F.col("now_sha256"))
    return both.select(F.explode(F.array_compact(F.array(*(F.when(c, F.lit(f"manifest: {n}")) for n, c in wrong.items())))).alias("problem"))


def audited(text: DataFrame, view: DataFrame | None = None, manifest: DataFrame | None = None, real: DataFrame | None = None, without_warehouse: bool = False, sha256: DataFrame | None = None, blocks: int = 1) -> DataFrame:
    """problem and count of everything. A wrong schema ends the audit; a missing warehouse is a failure unless it was waived. Text and view are read several times, so pass stored ones."""
    spark = text.sparkSession
    if found := schema_problems(text.columns):
        return spark.createDataFrame([(p, 1) for p in found], "problem string, count long")
    row = F.concat_ws(",", *text.columns)
    parts = [content_problems(text, blocks), pattern_counts(text, row).where("matches > 0").select(F.concat(F.lit("pattern: "), "pattern").alias("problem"), F.col("matches").alias("count"))]
    if manifest is not None:
        parts.append(manifest_problems(text, manifest, sha256).select("problem", F.lit(1).cast("long").alias("count")))
    if view is not None:
        parts.append(invariant_problems(text, view))
        if real is not None:
            parts.append(leaks(text, real, real.columns[0], blocks).select(F.concat(F.lit("leak in "), "column").alias("problem"), F.col("leaks").alias("count")))
    elif not without_warehouse:
        parts.append(spark.createDataFrame([("the warehouse wasn't compared", 1)], "problem string, count long"))
    return reduce(DataFrame.unionByName, parts)
