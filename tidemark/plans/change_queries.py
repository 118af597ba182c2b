"""Registered queries on changes between tables, on order, and on layers and loads that are kept up to date, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import audit, borders, fused, ordering, parity, sketches
from tidemark.plans import incremental, reports, samples, staging
from tidemark.plans.queries import _DIFF_KEYS, _DIFF_SQL, M, _diff, _star_checks_sql, query
from tidemark.plans.samples import FLAT_SQL, RAW_SQL, STAR_SQL, flat_fact, raw_records, table
from tidemark.sources import raw
from tidemark.sources.clustered import ClusteredFact
from tidemark.sources.commits import CommittedBatches
from tidemark.plans.star import checked
from tidemark.sources.registry import METRICS

# Two states of `lineitem` by order: keys have many rows and some are null; rows are dropped, repeated and changed.

_LINES_SQL = """l AS (SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END k, CAST(l_quantity AS DECIMAL(18,2)) q, CAST(l_extendedprice AS DECIMAL(18,2)) p, l_partkey, l_suppkey, l_linenumber FROM lineitem),
b AS (SELECT k, q, p FROM l WHERE l_partkey % 11 <> 0 UNION ALL SELECT k, q, p FROM l WHERE l_partkey % 17 = 0),
a AS (SELECT k, q, CASE WHEN l_suppkey % 7 = 0 THEN p + 1 ELSE p END p FROM l WHERE l_linenumber <> 5 UNION ALL SELECT k, q, p FROM l WHERE l_partkey % 13 = 0)"""
_LEFT_SQL = f"""{_LINES_SQL}, lb AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY q, p) i FROM (FROM b EXCEPT ALL FROM a)), la AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY q, p) i FROM (FROM a EXCEPT ALL FROM b)),
pairs AS (SELECT coalesce(lb.k, la.k) k, coalesce(lb.i, la.i) AS position, CASE WHEN lb.i IS NULL THEN 'NEW' WHEN la.i IS NULL THEN 'REMOVED' ELSE 'CHANGED' END status, lb.q before_q, la.q after_q, lb.p before_p, la.p after_p
  FROM lb FULL JOIN la ON lb.k IS NOT DISTINCT FROM la.k AND lb.i = la.i)"""


def _lines(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    money = lambda c: F.col(c).cast("decimal(18,2)")
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 50 != 0, F.col("l_orderkey")).alias("k"), money("l_quantity").alias("q"), money("l_extendedprice").alias("p"), "l_partkey", "l_suppkey", "l_linenumber")
    pick = lambda condition: rows.where(condition).select("k", "q", "p")
    raised = rows.withColumn("p", F.when(F.col("l_suppkey") % 7 == 0, F.col("p") + 1).otherwise(F.col("p")).cast("decimal(18,2)"))
    return pick("l_partkey % 11 <> 0").union(pick("l_partkey % 17 = 0")), raised.where("l_linenumber <> 5").select("k", "q", "p").union(pick("l_partkey % 13 = 0"))


def _pairs(spark, sf_dir) -> DataFrame:
    return parity.multiset_pairs(*_lines(spark, sf_dir), ["k"], ["q", "p"], raw.scratch_path(spark, "leftover"))


@query("k bigint, identical bigint, changed bigint, new bigint, removed bigint", f"""WITH {_LINES_SQL}, m AS (SELECT k, q, p, sum(x) x, sum(y) y FROM (SELECT k, q, p, 1 x, 0 y FROM b UNION ALL SELECT k, q, p, 0, 1 FROM a) GROUP BY ALL),
  s AS (SELECT k, sum(least(x, y)) i, sum(x - least(x, y)) b, sum(y - least(x, y)) a FROM m GROUP BY k) SELECT k, i AS identical, least(a, b) AS changed, a - least(a, b) AS new, b - least(a, b) AS removed FROM s""")
def multiset_diff(spark, sf_dir):
    """Lines of each order in two states, matched as multisets; all lines without an order are one key."""
    return parity.multiset_diff(*_lines(spark, sf_dir), ["k"], ["q", "p"])


@query("k bigint, position bigint, status string, before_q money, after_q money, before_p money, after_p money", f"WITH {_LEFT_SQL} SELECT * FROM pairs")
def multiset_pairs(spark, sf_dir):
    """What the matching leaves over, paired by rank within the key."""
    return _pairs(spark, sf_dir)


_TEXT = lambda c: f"coalesce(regexp_replace(CAST({c} AS VARCHAR), '\\.?0+$', ''), '(none)')"
_WHOLE = lambda c: f"coalesce(CAST({c} AS VARCHAR), '(none)')"


def _report_sql() -> str:
    """Lines of both comparisons, numbered by row_number over all of them."""
    key = f"{_WHOLE('source')} || ' | ' || {_WHOLE('reference_date')} || ' | ' || {_WHOLE('ad')}"
    of = [("lines", "pairs", _WHOLE("k"), ["q", "p"]), ("spend", "d", key, ["spend"])]
    parts = []
    for block, t, k, fields in of:
        parts.append(f"SELECT '{block}' AS block, 0 AS section, status, NULL AS key, NULL AS field, NULL AS before, CAST(count(*) AS VARCHAR) AS after, NULL AS delta FROM {t} GROUP BY status")
        parts.append(f"SELECT '{block}', CASE status WHEN 'NEW' THEN 1 ELSE 2 END, status, {k}, NULL, NULL, NULL, NULL FROM {t} WHERE status IN ('NEW', 'REMOVED')")
        parts += [f"SELECT '{block}', 3, status, {k}, '{f}', {_TEXT(f'before_{f}')}, {_TEXT(f'after_{f}')}, after_{f} - before_{f} FROM {t} WHERE status = 'CHANGED' AND before_{f} IS DISTINCT FROM after_{f}" for f in fields]
    order = ", ".join(f"{c} NULLS FIRST" for c in ("block", "section", "key", "field", "before", "after", "status", "delta"))
    return f"WITH {_LEFT_SQL}, {_DIFF_SQL.removeprefix('WITH ').replace(', b AS (SELECT * FROM r', ', rb AS (SELECT * FROM r').replace(', a AS (SELECT * FROM r', ', ra AS (SELECT * FROM r').replace('FROM b FULL JOIN a', 'FROM rb b FULL JOIN ra a')}, lines AS ({' UNION ALL '.join(parts)}) SELECT row_number() OVER (ORDER BY {order}) AS position, * FROM lines"


@query("position bigint, block string, section bigint, status string, key string, field string, before string, after string, delta money", _report_sql())
def ordered_diff_report(spark, sf_dir):
    """Two comparisons as one report of numbered lines."""
    blocks = {"lines": (_pairs(spark, sf_dir), ["k"], ["q", "p"]), "spend": (_diff(spark, sf_dir), _DIFF_KEYS, ["spend"])}
    return parity.ordered_report(blocks, raw.scratch_path(spark, "report"))


# Order of written files.


def _written_lines(spark, sf_dir, keys: list[str]) -> DataFrame:
    """`lineitem` as CSV parts in the order of some columns' text, read as text."""
    target = raw.scratch_path(spark, "lines")
    raw.write_sorted_csv(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), target, keys)
    return raw.read_text_csv(spark, target)


_LINE = ["l_orderkey", "l_linenumber", "l_partkey"]
_TEXTS_SQL = "t AS (SELECT CAST(l_orderkey AS VARCHAR) l_orderkey, CAST(l_linenumber AS VARCHAR) l_linenumber, CAST(l_partkey AS VARCHAR) l_partkey FROM lineitem), o AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS position FROM t)"


@query("position bigint, l_orderkey string, l_linenumber string, l_partkey string", f"WITH {_TEXTS_SQL} SELECT * FROM o")
def restored_order(spark, sf_dir):
    """The place of every row in the files of a sorted CSV."""
    return ordering.restored(_written_lines(spark, sf_dir, _LINE), raw.scratch_path(spark, "restored"))


@query("check string, falls bigint", f"WITH {_TEXTS_SQL}, f AS (SELECT l_partkey, lag(l_partkey) OVER (ORDER BY position) before FROM o) SELECT 'by order and line' AS \"check\", 0 AS falls UNION ALL SELECT 'by part', count(*) FILTER (WHERE before > l_partkey) FROM f")
def order_of_files(spark, sf_dir):
    """Rows that fall back behind the row before, in files sorted by order and line: none by that order, and some by parts."""
    files = _written_lines(spark, sf_dir, _LINE)
    count = lambda keys, name: ordering.order_problems(files, keys, raw.scratch_path(spark, "files")).agg(F.count("*").alias("falls")).select(F.lit(name).alias("check"), "falls")
    return count(_LINE, "by order and line").unionByName(count(["l_partkey"], "by part"))


# Layers that follow late snapshots.


def _caught_up(spark, sf_dir) -> dict[str, DataFrame]:
    """Layers built without the last load of three days of the month, and then refreshed with the days that it revises. Both read stored records."""
    records = incremental.aside(raw_records(spark, sf_dir), "records")
    revised = F.day("reference_date").isin(5, 12, 20)
    layers = incremental.Layers(spark, raw.scratch_path(spark, "layers"), buckets=8)
    layers.build(staging.silver(records.where(~revised | (F.datediff("extracted_at", "reference_date") < 3))))
    days = sorted(r[0] for r in records.where(revised).select("reference_date").distinct().collect())
    layers.refresh(staging.silver(records.where(F.col("reference_date").isin(days))), days)
    return layers.tables()


@query({"anuncio_sk": "string", "tempo_sk": "string", **M}, f"WITH {STAR_SQL} SELECT anuncio_sk, tempo_sk, {', '.join(METRICS)} FROM fato_metricas")
def refreshed_facts(spark, sf_dir):
    """The fact after a refresh of three days; the SQL rebuilds everything."""
    return _caught_up(spark, sf_dir)["fato_metricas"]


@query("level string, sk string, parent string, external_id string, nome string, versao bigint, valido_de date, valido_ate date, is_atual boolean", f"WITH {STAR_SQL} " + " UNION ALL ".join(f"SELECT '{x}' AS level, {x}_sk AS sk, {p} AS parent, external_id, nome, versao, valido_de, valido_ate, is_atual FROM dim_{x}" for x, p in samples._PARENTS))
def refreshed_dimensions(spark, sf_dir):
    """All versions after the same refresh."""
    return incremental.unioned_levels(_caught_up(spark, sf_dir))


# Checks in one scan of each table.


@query("check string, severity string, violations bigint, outcome string", _star_checks_sql())
def fused_star_checks(spark, sf_dir):
    """The star's declared checks on its stored tables: rows while they are written, keys in one scan of each."""
    return checked(staging.silver(raw_records(spark, sf_dir)), raw.scratch_path(spark, "checked"))[1]


_SOUND = {"lineitem grain": "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
  "lineitem order exists": "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0)",
  "lineitem flags accepted": "SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('N', 'X')",
  "lineitem quantity small": "SELECT count(*) FROM lineitem WHERE l_quantity > 45",
  "orders apart": "SELECT count(*) FROM (SELECT CAST(o_orderdate AS DATE) <= max(CAST(o_orderdate AS DATE) + 30) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o FROM orders WHERE o_orderkey % 3 > 0) WHERE o",
  "orders one large": "SELECT count(*) FROM (SELECT 1 FROM orders WHERE o_orderkey % 3 > 0 GROUP BY o_custkey HAVING count(*) FILTER (WHERE o_totalprice > 200000) <> 1)"}


@query("check string, violations bigint", " UNION ALL ".join(f"SELECT '{n}' AS \"check\", ({q}) AS violations" for n, q in _SOUND.items()))
def fused_checks_that_fail(spark, sf_dir):
    """Checks of every kind that relational tables violate, in one scan of each."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").withColumns({"day": F.to_date("o_orderdate"), "large": F.col("o_totalprice") > 200000})
    tables = {"lineitem": table(spark, sf_dir, "lineitem"), "orders": orders.withColumn("until", F.date_add("day", 30))}
    return fused.violations(tables, [
        fused.unique("lineitem grain", "lineitem", "l_orderkey", "l_linenumber", nulls=True), fused.relation("lineitem order exists", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        fused.accepted_values("lineitem flags accepted", "lineitem", "l_returnflag", ["N", "X"]), fused.rows_where("lineitem quantity small", "lineitem", F.col("l_quantity") > 45),
        fused.apart("orders apart", "orders", "o_custkey", "day", "until"), fused.one_current("orders one large", "orders", "o_custkey", "large")])


# Many values searched in many texts.

_PLANTED_SQL = """x AS (SELECT DISTINCT o_orderpriority || ' wrote ' || CASE WHEN o_orderkey % 4 = 0 THEN c_name WHEN o_orderkey % 4 = 1 THEN lower(c_name) WHEN o_orderkey % 4 = 2 THEN substr(c_name, 2, 12) ELSE c_mktsegment || '-' || c_custkey END || ', order ' || o_orderkey AS cell FROM orders JOIN customer ON c_custkey = o_custkey),
v AS (SELECT DISTINCT c_name AS value FROM customer WHERE c_custkey % 3 = 0 UNION SELECT DISTINCT c_mktsegment || '-' || c_custkey FROM customer WHERE c_custkey % 5 = 0)"""


@query("cell string, value string", f"WITH {_PLANTED_SQL} SELECT cell, value FROM x JOIN v ON contains(cell, value)")
def planted_values(spark, sf_dir):
    """Names and numbers planted whole, in part or in other letters in texts that share all of their common words."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    k, segment = F.col("o_orderkey") % 4, F.concat("c_mktsegment", F.lit("-"), F.col("c_custkey").cast("string"))
    planted = F.when(k == 0, F.col("c_name")).when(k == 1, F.lower("c_name")).when(k == 2, F.substring("c_name", 2, 12)).otherwise(segment)
    cells = o.join(c, F.col("c_custkey") == F.col("o_custkey")).select(F.concat("o_orderpriority", F.lit(" wrote "), planted, F.lit(", order "), F.col("o_orderkey").cast("string")).alias("cell"))
    values = c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("value")).union(c.where("c_custkey % 5 = 0").select(segment))
    return audit.contained(cells, "cell", values, "value")


# Loads that are repeated, compete or die.


@query("batch_id string, source string, start_date date, end_date date, row_count bigint", f"WITH {RAW_SQL} SELECT CASE extracted_day - reference_date WHEN 1 THEN 'first' ELSE 'second' END batch_id, source, min(reference_date) start_date, max(reference_date) end_date, count(*) row_count FROM raw WHERE extracted_day - reference_date < 3 GROUP BY 1, 2")
def committed_batches(spark, sf_dir):
    """The log of a raw table after two loads, a repetition of the second, and an attempt at a third that died before its commit."""
    records = raw_records(spark, sf_dir)
    of = lambda lag: records.where(F.datediff("extracted_at", "reference_date") == lag)
    batches = CommittedBatches(spark, raw.scratch_path(spark, "commits"))
    batches.load([of(1)], "first")
    batches.load([of(2)], "second")
    batches.load([of(2)], "second")
    batches.write_attempt(of(3), "third")
    return raw.ingestion_log(batches.rows())


# Distinct values of any range of days from stored sketches.


@query("flag string, exact bigint, rows bigint, close boolean", "SELECT l_returnflag AS flag, count(DISTINCT l_partkey) AS exact, count(*) AS rows, TRUE AS close FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1994-03-10' AND DATE '1996-11-20' GROUP BY 1")
def distinct_by_day_range(spark, sf_dir):
    """Parts shipped in a range of days: from sketches stored by day, within four standard errors of the exact number."""
    rows = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    path = raw.scratch_path(spark, "sketches")
    sketches.daily(rows, "day", ["l_returnflag"], "l_partkey").write.parquet(path)
    estimated = sketches.merged(spark.read.parquet(path), "day", "1994-03-10", "1996-11-20", ["l_returnflag"])
    exact = rows.where("day BETWEEN '1994-03-10' AND '1996-11-20'").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("exact"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= 4 * sketches.standard_error() * F.col("exact") + 1
    return exact.join(estimated, "l_returnflag").select(F.col("l_returnflag").alias("flag"), "exact", "rows", near.alias("close"))


# A stored fact that is asked through its statistics.


def _clustered(spark, sf_dir) -> ClusteredFact:
    stored = ClusteredFact(spark, raw.scratch_path(spark, "clustered"))
    stored.write(flat_fact(spark, sf_dir))
    return stored


@query("plataforma_id bigint, investimento money, cliques bigint", f"WITH {FLAT_SQL} SELECT plataforma_id, sum(spend) investimento, sum(link_clicks) cliques FROM fact WHERE data BETWEEN (SELECT max(data) FROM fact) - 6 AND (SELECT max(data) FROM fact) GROUP BY 1")
def clustered_last_days(spark, sf_dir):
    """Last seven days of a clustered fact, read from the files that hold them."""
    return reports.platform_sums(_clustered(spark, sf_dir).last_days(7))


@query("data date, spend money, impressions bigint, link_clicks bigint, conversions money", f"WITH {FLAT_SQL} SELECT data, spend, impressions, link_clicks, conversions FROM fact WHERE anuncio_id = 42")
def clustered_history(spark, sf_dir):
    """One key's rows of a clustered fact, read from the files that can hold them."""
    return reports.history_of(_clustered(spark, sf_dir).history(42), 42)


# Patterns over the borders of rows.

_SPOKEN_SQL = "s AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'call (11)' WHEN 1 THEN '9' || lpad(CAST(o_custkey AS VARCHAR), 4, '0') || '-1234' WHEN 2 THEN 'see the Dr' WHEN 3 THEN 'Silva 21' ELSE '12345678 x' END AS t FROM orders), j AS (SELECT string_agg(t, chr(10) ORDER BY o_orderkey) AS w FROM s)"


@query("pattern string, matches bigint", f"WITH {_SPOKEN_SQL} " + " UNION ALL ".join("SELECT '{}' AS pattern, len(regexp_extract_all(w, '{}')) AS matches FROM j".format(n, p.replace("(?iU)", "(?i)").replace("(?U)", "").replace("'", "''")) for n, p in audit.FORBIDDEN_PATTERNS.items()))
def personal_data_over_rows(spark, sf_dir):
    """Personal data in rows that form one text: numbers and titles whose halves stand in two rows count, each once."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 5
    number = F.concat(F.lit("9"), F.lpad(F.col("o_custkey").cast("string"), 4, "0"), F.lit("-1234"))
    spoken = o.select("o_orderkey", F.when(k == 0, "call (11)").when(k == 1, number).when(k == 2, "see the Dr").when(k == 3, "Silva 21").otherwise("12345678 x").alias("text"))
    rows = ordering.numbered(spoken, ["o_orderkey"], raw.scratch_path(spark, "spoken"))
    return borders.pattern_counts(rows, audit.FORBIDDEN_PATTERNS, raw.scratch_path(spark, "borders"))
