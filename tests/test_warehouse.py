"""The warehouse on the records of tests/fixtures, against plain arithmetic on them, with negative controls."""

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import records
from tidemark.operators import audit, exposure, parity, quality, snapshots
from tidemark.operators.dimensional import scd2
from tidemark.plans import publish, reports, staging
from tidemark.plans.star import checks, consumption, materialise, star
from tidemark.sources import raw
from tidemark.sources.registry import METRICS, SOURCES

FIXTURES = Path(__file__).parent / "fixtures"
KEY = b"a key of tests that is long enough for all"


def _day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def bronze(spark):
    at = dt.datetime(2026, 1, 4, tzinfo=dt.UTC)
    parts = [raw.dated(raw.read_json_array(spark, f"{FIXTURES}/{k}.json"), s, f"b-{k}", at)[0] for k, s in SOURCES.items()]
    return parts[0].unionByName(parts[1]).withColumn("row_id", F.monotonically_increasing_id()).persist()


@pytest.fixture(scope="module")
def tables(bronze):
    return star(staging.silver(bronze).persist())


@pytest.fixture(scope="module")
def view(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("view") / "v")
    consumption(tables).write.parquet(path)
    return spark.read.parquet(path)


def _expected():
    """(platform, day, campaign, metrics in their order) of every record, by plain arithmetic on the files."""
    out = []
    for r in json.loads((FIXTURES / "meta.json").read_text()):
        total = lambda field, *types, r=r: sum((Decimal(x["value"]) for x in r.get(field, []) if x["action_type"] in types), Decimal(0))
        views, visits = total("actions", "video_view"), total("actions", "onsite_conversion.ig_profile_view")
        out.append(("Meta Ads", r["date_start"], r["campaign_id"], (Decimal(r["spend"]), int(r["impressions"]), int(r["inline_link_clicks"]), total("actions", "lead"), total("action_values", "lead"), views, int(r["reach"]), visits, total("actions", "purchase", "omni_purchase"))))
    for r in json.loads((FIXTURES / "google.json").read_text(), parse_float=Decimal):
        out.append(("Google Ads", r["date"], r["campaign_id"], (r["cost"], r["impressions"], r["clicks"], r["conversions"], r["conversions_value"], r.get("video_trueview_views", 0), 0, 0, 0)))
    return out


def _sums(rows):
    return tuple(sum((Decimal(x[i]) for x in rows), Decimal(0)) for i in range(len(METRICS)))


def test_sums_by_platform_and_day(view):
    rows = {(r["plataforma"], str(r["data"])): r for r in view.groupBy("plataforma", "data").agg(F.count("*").alias("n"), *(F.sum(m).alias(m) for m in METRICS)).collect()}
    expected = _expected()
    assert rows.keys() == {x[:2] for x in expected} and len(rows) == 6
    for key, row in rows.items():
        mine = [x[3] for x in expected if x[:2] == key]
        assert row["n"] == len(mine) and tuple(Decimal(row[m]) for m in METRICS) == _sums(mine)


def test_records_of_the_fixtures_are_those_of_the_rule():
    assert [json.loads((FIXTURES / f"{n}.json").read_text()) for n in ("meta", "google")] == [records.meta(), records.google()]


def test_structure_and_versions(tables):
    counts = {r["object"]: r["rows"] for r in reports.layer_volumetry(tables).collect()}
    assert counts == {"stg_ads_unified": 64, "dim_plataforma": 2, "dim_conta": 4, "dim_campanha": 10, "dim_adset": 8, "dim_anuncio": 24, "dim_tempo": 3, "fato_metricas": 64}
    second = tables["dim_campanha"].where("versao = 2").select("valido_de", "valido_ate", "is_atual").distinct().collect()
    assert [tuple(r) for r in second] == [(_day("2026-01-03"), _day("9999-12-31"), True)]


def test_traversal_needs_validity(tables, view):
    assert view.count() == 64
    spend, renamed = (sum(x[3][0] for x in _expected() if pick(x)) for pick in (lambda x: True, lambda x: x[2] in ("7212", "7222")))
    assert view.agg(F.sum("spend")).first()[0] == spend
    wrong = consumption(tables, validity=False)
    assert wrong.count() == 80 and wrong.agg(F.sum("spend")).first()[0] == spend + renamed
    assert quality.same_count(wrong, tables["fato_metricas"]).count() == 1


def test_platform_comparison(view):
    rows = {r["plataforma"]: r for r in reports.platform_comparison(view).collect()}
    meta, google = (_sums([x[3] for x in _expected() if x[0] == p]) for p in ("Meta Ads", "Google Ads"))
    assert (rows["Meta Ads"]["linhas"], rows["Meta Ads"]["impressoes"], rows["Meta Ads"]["cliques"]) == (32, *meta[1:3])
    assert rows["Google Ads"]["conversoes"] == google[3] and rows["Google Ads"]["investimento"] == google[0].quantize(Decimal("0.01"))


def test_all_checks_pass_and_a_broken_star_fails(spark, tables):
    assert {r["outcome"] for r in quality.report(spark, checks(tables)).collect()} == {"pass"}
    broken = tables | {"fato_metricas": tables["fato_metricas"].union(tables["fato_metricas"].limit(1))}
    failed = {r["check"] for r in quality.report(spark, [c for c in checks(broken) if c.name == "fact grain"]).collect() if r["outcome"] == "fail"}
    assert failed == {"fact grain"}


def test_a_newer_snapshot_replaces_the_whole_day(bronze):
    later = bronze.where("source = 'meta_ads' AND reference_date = '2026-01-01'").limit(1).withColumn("extracted_at", F.lit("2026-01-09 00:00:00").cast("timestamp"))
    both = bronze.unionByName(later)
    assert staging.staged(both, SOURCES["meta"]).where("data = '2026-01-01'").count() == 1
    amount = F.coalesce(F.variant_get("payload", "$.spend", "decimal(28,12)"), F.lit(0).cast("decimal(28,12)"))
    lost = snapshots.lost_rows(both.withColumn("ad", F.variant_get("payload", "$.ad_id", "string")), ["source", "reference_date"], "extracted_at", "ad", amount)
    assert lost.count() == 11
    assert reports.spend_drift(both).count() == 1


def test_scd2_names_gaps_nulls_and_returns(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 5, "x"), ("a", 5, "z"), ("n", 1, None), ("n", 2, "p")]
    df = spark.createDataFrame([(k, "p", "e", n, _day(f"2026-01-0{d}")) for k, d, n in rows], "nk string, parent string, ext string, name string, day date")
    out = {(r["nk"], r["version"]): (r["name"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in scd2(df, "nk", "parent", "ext", "name", "day").collect()}
    assert out["a", 1] == ("x", "2026-01-01", "2026-01-01", False) and out["a", 2] == ("y", "2026-01-02", "2026-01-04", False) and out["a", 3] == ("x", "2026-01-05", "9999-12-31", True)
    assert out["n", 0][0] is None and out["n", 1][0] == "p"


def test_array_sums_skip_nulls_and_round_halves_up(spark):
    doc = '[{"date_start":"2026-1-5","spend":"1.10","actions":[{"action_type":"purchase","value":"1.5"},{"action_type":"omni_purchase","value":null},{"action_type":"purchase","value":"1"}]},{"date_start":"x"},{}]'
    records = spark.createDataFrame([(doc,)], "t string").select(F.explode(F.variant_get(F.parse_json("t"), "$", "array<variant>")).alias("payload"))
    good, bad = raw.dated(records, SOURCES["meta"])
    row = staging.staged(good, SOURCES["meta"]).first()
    assert row["purchases"] == 3 and row["spend"] == Decimal("1.10") and row["data"] == _day("2026-01-05") and bad.count() == 2


def test_load_log_and_manifest(spark, tmp_path):
    stamp = dt.datetime(2026, 1, 4, tzinfo=dt.UTC)
    parts = [raw.dated(raw.read_json_array(spark, f"{FIXTURES}/{k}.json"), s, f"c-{k}", stamp)[0] for k, s in SOURCES.items()]
    raw.load_sources(parts, f"{tmp_path}/bronze", f"{tmp_path}/log")
    assert {r["row_count"] for r in spark.read.parquet(f"{tmp_path}/log").collect()} == {32}
    assert raw.read_bronze(spark, f"{tmp_path}/bronze", f"{tmp_path}/log").count() == 64
    with pytest.raises(ValueError):
        raw.load_sources([parts[0].withColumn("source", F.lit("other"))], f"{tmp_path}/b2", f"{tmp_path}/l2")
    artifact = f"{FIXTURES}/meta.json"
    raw.write_manifest(spark, artifact, f"{tmp_path}/manifest", SOURCES["meta"], "r1", "2026-01-01", "2026-01-03", 32)
    manifests = spark.read.schema(raw.MANIFEST).json(f"{tmp_path}/manifest")
    hashes = raw.file_hashes(spark, artifact)
    assert raw.validate_artifacts(hashes, manifests, SOURCES["meta"], "r1", "2026-01-01", "2026-01-03").count() == 0
    assert {r["problem"] for r in raw.validate_artifacts(hashes, manifests, SOURCES["google"], "r2", "2026-01-01", "2026-01-04").collect()} == {"source", "run", "window"}
    assert {r["problem"] for r in raw.validate_artifacts(raw.file_hashes(spark, f"{FIXTURES}/google.json"), manifests, SOURCES["meta"], "r1", "2026-01-01", "2026-01-03").collect()} == {"no file of this content", "no manifest of this content"}


def test_unconsumed_fields(bronze):
    known = {s.name: staging.consumed(s.name) for s in SOURCES.values()}
    assert quality.unconsumed_keys(bronze, "payload", "source", known).count() == 0
    known["meta_ads"] -= {"reach"}
    assert [tuple(r) for r in quality.unconsumed_keys(bronze, "payload", "source", known).collect()] == [("meta_ads", "reach", 32)]


def test_export_and_audit(spark, view):
    artifact = exposure.exposed(view, KEY).persist()
    assert artifact.columns == exposure.EXPORTED and exposure.post_checks(view, artifact).count() == 0
    text = raw.as_text(artifact).persist()
    real = view.select(F.explode(F.array("conta_nome", "campanha_nome", "anuncio_nome", "conta_nk")).alias("value"))
    assert audit.audited(text, view, real=real).count() == 0
    tampered = text.withColumn("conta_id", F.when(F.col("data") == "2026-01-01", F.lit("Demo account 1")).otherwise(F.col("conta_id")))
    found = {r["problem"] for r in audit.audited(tampered, view, real=real).collect()}
    assert "conta_id out of shape" in found and "leak in conta_id" in found
    assert audit.schema_problems([*text.columns, "conta_nk"]) != []
    assert audit.audited(text).where("problem = 'the warehouse wasn''t compared'").count() == 1
    with pytest.raises(ValueError):
        exposure.exposed(view.withColumn("extra", F.lit(1)), KEY)
    for bad in (None, "", "changeme", "short"):
        with pytest.raises(ValueError):
            exposure.checked_key(bad)


def test_leaks_meet_by_substrings(spark, capfd):
    text = spark.createDataFrame([("x Loja Ação y", "Loja"), ("Ação", "abc"), ("Loja Açã", None), ("aaaaaa", "Cliente-0123ABCD"), ("abcabc", "z")], "a string, b string")
    real = spark.createDataFrame([("Loja Ação",), ("Ação",), ("aaaa",), ("abc",), ("Cliente-0123ABCD",), ("0123",), ("",), (None,)], "value string")
    found = audit.leaks(text, real, "value")
    assert {r["column"]: r["leaks"] for r in found.collect()} == {"a": 3, "b": 2}
    found.explain()
    assert "NestedLoop" not in capfd.readouterr().out


def test_raw_contract_and_anonymiser(spark, bronze):
    meta = bronze.where("source = 'meta_ads'")
    assert exposure.contract_violations(meta, "meta_ads").count() == 0
    bad = spark.createDataFrame([(1, '{"date_start":"2026-01-01","date_stop":"2026-01-02","spend":-1,"other":2}')], "row_id long, t string").select("row_id", F.parse_json("t").alias("payload"))
    found = {r["problem"] for r in exposure.contract_violations(bad, "meta_ads").collect()}
    assert {"unknown field: other", "wrong type: spend", "bad number: spend", "first and last day differ", "missing field: reach"} <= found
    out = exposure.anonymised_raw(meta, "meta_ads", "meta", KEY)
    before = meta.select("row_id", *(F.variant_get("payload", f"$.{c}", "string").alias(c) for c in ("spend", "ad_id")))
    after = out.select("row_id", *(F.variant_get(F.parse_json("record"), f"$.{c}", "string").alias(c) for c in ("spend", "ad_id")))
    assert exposure.preservation_violations(before, after, ["spend"], ["ad_id"]).count() == 0
    assert exposure.preservation_violations(before, before, ["spend"], ["ad_id"]).count() == 32


def test_keyed_diff(spark):
    a = spark.createDataFrame([("k1", 1), ("k2", 2), ("k3", 3), ("d", 1), ("d", 1)], "k string, v int")
    b = spark.createDataFrame([("k3", 4), ("k2", 2), ("k4", 1), ("d", 1)], "k string, v int")
    diff = parity.keyed_diff(a, b, ["k"], ["v"])
    assert {r["k"]: r["status"] for r in diff.collect()} == {"k1": "REMOVED", "k2": "IDENTICAL", "k3": "CHANGED", "k4": "NEW", "d": "DUPLICATE"}
    delta = parity.field_deltas(diff, ["k"], ["v"]).first()
    assert (delta["k"], delta["delta"], delta["percent"]) == ("k3", Decimal(1), Decimal("33.33"))


def test_csv_round_trip(spark, view, tmp_path):
    artifact = exposure.exposed(view, KEY)
    raw.write_sorted_csv(artifact, f"{tmp_path}/csv", ["data", "anuncio_id"], 2)
    back = raw.read_text_csv(spark, f"{tmp_path}/csv")
    assert back.columns == artifact.columns and raw.fingerprint(back).first() == raw.fingerprint(raw.as_text(artifact)).first()


def test_generated_fact(spark):
    fact = raw.generated_fact(spark, 20_000).persist()
    assert 19_000 <= fact.count() <= 20_000 and fact.where("spend <= 0 OR impressions < 1").count() == 0
    assert quality.unique_grain(fact, "anuncio_id", "data").count() == 0 and quality.one_parent(fact, "anuncio_id", "campanha_id").count() == 0
    assert reports.last_days(fact).count() == 2 and reports.history_of(fact, 42).count() == fact.select("data").distinct().count()


def test_flattened_and_merged(spark):
    df = spark.createDataFrame([('{"ad":{"id":7},"m":{"cost":1500000}}',)], "t string").select(F.parse_json("t").alias("p"))
    assert tuple(raw.flattened(df, "p", {"id": ("ad.id", "string"), "cost": ("m.cost", "bigint")}).first()) == ("7", 1500000)
    a, b = (spark.createDataFrame(r, "id int, who string, ok boolean") for r in ([(1, "a", True), (2, "a", True)], [(2, "b", False), (3, "b", True)]))
    assert sorted(r["who"] for r in raw.merged([a, b], "id", F.col("ok")).collect()) == ["a", "b"]


def test_export_publishes_all_or_nothing(spark, view, tmp_path):
    target, key = f"{tmp_path}/out", KEY.decode()
    manifest = publish.export(view, key, target, f"{tmp_path}/public", parts=2)
    text, files = raw.read_text_csv(spark, f"{target}/{publish.DATA_NAME}"), raw.folder_hash(spark, f"{target}/{publish.DATA_NAME}")
    row = manifest.first()
    assert (row["linhas"], row["data_min"], row["data_max"], row["cardinalidades"]["campanha"]) == (64, "2026-01-01", "2026-01-03", 8) and row["fingerprint_chave"] == exposure.key_fingerprint(KEY)
    assert audit.audited(text, view, manifest, sha256=files).count() == 0
    assert [r["problem"] for r in audit.manifest_problems(text, manifest.drop("grao"), files).collect()] == ["the manifest lacks grao"]
    changed = manifest.withColumns({"linhas": F.lit(1), "sha256": F.lit("0"), "data_max": F.lit("2026-01-09"), "avisos": F.struct(F.lit("x").alias("other"))})
    assert {r["problem"] for r in audit.manifest_problems(text, changed, files).collect()} == {"manifest: the number of rows differs", "manifest: the last day differs", "manifest: the hash differs", "manifest: the warning about video_views is missing"}
    before = files.first()
    twice = view.unionByName(view.limit(1))
    for rows, k, where in ((view.limit(0), key, target), (twice, key, target), (view, "short", target), (view.withColumn("x", F.lit(1)), key, target), (view, key, f"{tmp_path}/public/a")):
        with pytest.raises(ValueError):
            publish.export(rows, k, where, f"{tmp_path}/public")
    assert raw.folder_hash(spark, f"{target}/{publish.DATA_NAME}").first() == before and sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    publish.export(view, key, f"{tmp_path}/public/a", f"{tmp_path}/public", allow=True)
    rows = raw.fingerprint(text).first()
    publish.export(view, key, target, f"{tmp_path}/public", parts=3)
    assert raw.fingerprint(raw.read_text_csv(spark, f"{target}/{publish.DATA_NAME}")).first() == rows


def test_post_checks_find_each_fault(spark, view, tmp_path):
    exposure.exposed(view, KEY).write.parquet(f"{tmp_path}/a")
    artifact = spark.read.parquet(f"{tmp_path}/a")
    problems = lambda df: {r["problem"] for r in exposure.post_checks(view, df).collect()}
    first = F.col("data") == "2026-01-01"
    moved = artifact.withColumn("data", F.when(first, F.lit("2026-01-04").cast("date")).otherwise(F.col("data")))
    assert problems(moved) == {"sums by platform and day differ", "the set of days differs"}
    assert problems(artifact.withColumn("adset_versao", F.col("adset_versao") + 1)) == {"versions of adset differ"}
    assert "two keys of anuncio share a label" in problems(artifact.withColumn("anuncio_id", F.lit("Anuncio-00000000")))
    keyed = artifact.withColumn("plataforma", F.lit(view.first()["conta_nk"]))
    assert "a natural key of conta survives" in problems(keyed)
    assert "the grain isn't unique" in problems(artifact.unionByName(artifact.limit(1)))
    assert problems(artifact.withColumn("conta_nome", F.lit("x"))) == {"the columns differ", "forbidden column: conta_nome"}


def test_anonymised_files_are_published_whole_or_not_at_all(spark, bronze, tmp_path):
    meta, target = bronze.where("source = 'meta_ads'"), f"{tmp_path}/raw"
    labels = [*exposure.ALLOWED_LABELS, "onsite_conversion.ig_profile_view", "purchase", "omni_purchase"]
    row = publish.publish_anonymised(meta, "meta_ads", "meta", KEY.decode(), target, labels, 2).first()
    assert (row["linhas"], row["data_min"], row["data_max"], row["classificacao"]["ad_name"]) == (32, "2026-01-01", "2026-01-03", "name")
    back = spark.read.text(f"{target}/records.json").collect()
    assert len(back) == 32 and all("Demo" not in r["value"] for r in back)
    with pytest.raises(ValueError, match="label not allowed"):
        publish.publish_anonymised(meta, "meta_ads", "meta", KEY.decode(), target)
    assert len(spark.read.text(f"{target}/records.json").collect()) == 32


def test_names_and_ids_keep_one_label(spark):
    before = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)], "row_id int, id string, name string")
    after = spark.createDataFrame([(1, "L1", "L1"), (2, "L2", "L3"), (3, "L4", "L4")], "row_id int, id string, name string")
    assert [tuple(r) for r in exposure.preservation_violations(before, after, [], ["id", "name"], same={"name": "id"}).collect()] == [(2, "name isn't id")]


def test_a_load_takes_all_sources_or_none(spark, tmp_path):
    run, days = "r1", ("2026-01-01", "2026-01-03")
    artifacts = {}
    for k, s in SOURCES.items():
        raw.write_manifest(spark, f"{FIXTURES}/{k}.json", f"{tmp_path}/{k}", s, run, *days, 32)
        artifacts[s] = (f"{FIXTURES}/{k}.json", f"{tmp_path}/{k}")
    assert raw.load_verified(spark, artifacts, run, *days, f"{tmp_path}/bronze", f"{tmp_path}/log", "b").count() == 2
    google = SOURCES["google"]
    raw.write_manifest(spark, f"{FIXTURES}/google.json", f"{tmp_path}/short", google, run, *days, 31)
    (tmp_path / "unreadable").mkdir()
    (tmp_path / "unreadable" / "m.json").write_text("{not json")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "m.json").write_text("")
    for manifest, said in (("short", "google_ads: another number of records"), ("unreadable", "google_ads: version"), ("none", "google_ads: no manifest"), ("meta", "google_ads: no file of this content")):
        with pytest.raises(ValueError, match=said):
            raw.load_verified(spark, artifacts | {google: (artifacts[google][0], f"{tmp_path}/{manifest}")}, run, *days, f"{tmp_path}/b2", f"{tmp_path}/l2")
    assert not (tmp_path / "b2").exists()


def test_raw_constraints(spark):
    rows = spark.createDataFrame([("meta_ads", "b", "{}"), (None, "b", "{}"), ("x", None, None)], "source string, batch_id string, t string").select("source", F.current_date().alias("reference_date"), F.lit(None).cast("timestamp").alias("extracted_at"), "batch_id", F.parse_json("t").alias("payload"))
    found = {(r["source"], r["problem"]) for r in raw.constraint_violations(rows).collect()}
    assert found == {("meta_ads", "null extracted_at"), (None, "null extracted_at"), (None, "null source"), ("x", "null extracted_at"), ("x", "unknown source"), ("x", "null batch_id"), ("x", "null payload")}


def test_stored_star_equals_the_lazy_one(spark, bronze, tables, tmp_path):
    stored = materialise(staging.silver(bronze), str(tmp_path))
    assert set(stored) == set(tables)
    for name, df in tables.items():
        assert raw.fingerprint(stored[name].select(*df.columns)).first() == raw.fingerprint(df).first()
    raw.write_fact(stored["fato_metricas"], f"{tmp_path}/flat", "anuncio_sk", "tempo_sk")
    assert raw.fingerprint(spark.read.parquet(f"{tmp_path}/flat")).first() == raw.fingerprint(stored["fato_metricas"]).first()
