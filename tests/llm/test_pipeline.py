"""The pipeline's stages, one after the other, against brute force written here alone, with awkward rows and column names."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_documents import WORD_BPE, _all_spans, _base_measures, _near, _roots, _verdict
from tidemark.llm import ngram_join, quality_rules, secret_scan

COLUMNS = "doc_id long, text string, n_chars long, _spans string, row string, judged int, kept string, mark map<string,int>"


def _corpus():
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = []
    for _ in range(9):
        base = rng.choices(vocabulary, k=rng.randrange(60, 160))
        texts += [_near(rng, base, rng.choice([0, 0.004, 0.01])) for _ in range(rng.randrange(1, 9))]
    texts += [" ".join(rng.choices(vocabulary, k=80)) + f" token={rng.randrange(10**12):016x} end" for _ in range(6)]
    texts += [" ".join(["same", "again"] * 60), "too short", "", None]
    rows = [(i, t, len(t or ""), f"s{i % 3}", "r", i, "k", {"a": i % 2}) for i, t in enumerate(texts)]
    long = " ".join(rng.choices(vocabulary, k=90))
    rows += [(900, long, 1, x, x, 5, None, None) for x in ("x", "y", "z")]  # equal id and text, other columns differ
    rows += [(901, long + " tail", 2, "same", None, None, None, {"b": 1})] * 40  # a row that is repeated exactly
    rows += [(None, " ".join(rng.choices(vocabulary, k=70)), None, None, None, None, None, None)] * 7
    rng.shuffle(rows)
    return rows


def _key(r):
    return tuple(tuple(sorted(x.items())) if isinstance(x, dict) else x for x in r)


def test_each_stage_equals_brute_force(spark):
    rows = _corpus()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    good = corpus_pipeline.keep_good(spark, docs, "")
    limits = quality_rules.Limits()
    want = [r for r in rows if not _base_measures(r[1] or "")[-1] and _verdict(r[1] or "", limits)]
    assert good.columns == docs.columns and Counter(map(_key, good.collect())) == Counter(map(_key, want)) and len(want) < len(rows)

    one = corpus_pipeline.drop_near_copies(spark, good, "")
    roots = _roots([r[1] for r in want])[1]
    hashes = {(_key(r), r[1]): (h, m) for r, h, m in ((tuple(x)[:-2], x["_h"], x["_m"]) for x in good.select("*", F.xxhash64("text").alias("_h"), ngram_join._row_hash(good).alias("_m")).collect())}
    best = {}
    for r, root in zip(want, roots, strict=True):
        h, m = hashes[_key(r), r[1]]
        place = (r[0] is None, r[0] or 0, h, m)
        if root not in best or place < best[root][0]:
            best[root] = place, r
    kept = [r for _, r in best.values()]
    assert one.columns == docs.columns and Counter(map(_key, one.collect())) == Counter(map(_key, kept)) and len(kept) < len(want)
    assert sum(r[0] == 900 for r in kept) + sum(r[0] == 901 for r in kept) == 1

    clean = corpus_pipeline.redact_secrets(spark, one, "")
    model, options = secret_scan.train(one, "text"), secret_scan.Training()
    redacted = []
    for r in kept:
        out, at = "", 0
        for start, _, stop in _all_spans(r[1], model, options):
            if start >= at:
                out += r[1][at:start] + secret_scan.MARK
            at = max(at, stop)
        text = out + r[1][at:]
        redacted.append((r[0], text, len(text), *r[3:]))
    assert clean.columns == docs.columns and Counter(map(_key, clean.collect())) == Counter(map(_key, redacted))
    assert any(secret_scan.MARK in r[1] for r in redacted)

    packed = corpus_pipeline.pack(spark, clean, "").collect()
    t = Tokenizer.from_file(WORD_BPE)
    t.no_truncation()
    t.no_padding()
    ids = [np.array([*t.encode(r[1], add_special_tokens=False).ids, 2], "<u4") for r in redacted]
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == Counter(r[0] for r in redacted)
    assert sum(r["length"] for r in packed) == sum(map(len, ids))
    mine = {(r[0], len(x)): x for r, x in zip(redacted, ids, strict=True)}
    for r in packed:
        assert r["ids_crc32"] == zlib.crc32(mine[r["doc_id"], r["doc_tokens"]][r["start"] : r["start"] + r["length"]].tobytes())


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_repeated_rows_are_merged_before_they_meet(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, None)], "doc_id long, text string, other string").crossJoin(spark.range(500)).drop("id").union(spark.createDataFrame([(2, "other words are here for this", "o"), (3, None, None), (3, None, None)], "doc_id long, text string, other string")).repartition(4)
    out = ngram_join.deduplicated(df)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, text, None), (2, "other words are here for this", "o"), (3, None, None)], key=repr)
