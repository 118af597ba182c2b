"""SentencePiece coding against the library, hard negatives and tries against brute force, with the defined edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie, hard_negatives, piece_bpe
from tidemark.llm.shared import Scratch

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HOW = piece_bpe.Coding(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


# SentencePiece

_PARTS = [*"abcdethe  ▁\n\t\0éß漢字😀한​.,0123́", "  ", "   ", "▁▁", "the ", "ing", "\r\n", " \n ", "Ａ"]


def test_pieces_equal_the_library(library):
    rng, codec = random.Random(1), piece_bpe.Codec(MODEL, 2000)
    texts = ["".join(rng.choices(_PARTS, k=rng.randrange(40))) for _ in range(6000)]
    for at in range(0, len(texts), 300):
        part = texts[at : at + 300]
        coded, agreed = codec.encode(part, compare=True)
        assert all(agreed) and not codec.doubtful
        for text, raw, want in zip(part, coded, library.encode(part), strict=True):
            ids = np.frombuffer(raw, "<u4").tolist()
            assert ids == want, text
            assert codec.decode([*ids, 2]) == library.decode([*ids, 2])


def test_any_ids_decode_as_in_the_library(library):
    rng, codec = random.Random(2), piece_bpe.codec(HOW)
    for _ in range(6000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 0, 1, 2, 29871, 259, rng.randrange(259, 300)]) for _ in range(rng.randrange(8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_long_fragments_have_one_agenda(library):
    rng, codec = random.Random(3), piece_bpe.codec(HOW)
    for text in ("a" * 30000, " " * 20001, "ab" * 9000 + " x", "".join(rng.choices("etaoin", k=50000)), "漢😀" * 4000):
        assert np.frombuffer(codec.encode([text])[0][0], "<u4").tolist() == library.encode(text)


def test_equal_scores_merge_from_the_left():
    agenda = piece_bpe.Agenda({"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4}, {"a": 0.0, "b": 0.0, "ab": -1.0, "ba": -1.0, "aba": -2.0})
    symbols = np.array([1, 0, 1, 0, 0, 1, 0])  # b a b a | a b a
    raw, ends = agenda._side_by_side(symbols.copy(), np.array([4, 3]))
    assert np.frombuffer(raw, "<u4").tolist() == [3, 3, 4] and ends.tolist() == [8, 12]
    assert [np.frombuffer(agenda._alone(np.array(x)), "<u4").tolist() for x in ([1, 0, 1, 0], [0, 1, 0])] == [[3, 3], [4]]


def test_piece_tables(spark, library):
    texts = [None, "", " ", "same text", "same text", "two\nlines  of ▁ text", "é" * 5000 + " \0"]
    df = spark.createDataFrame([(i, t, 5, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens long, ids string").repartition(3)
    for r in piece_bpe.digest(df, HOW).collect():
        ids = [*library.encode(texts[r["doc_id"]] or ""), 2]
        assert r["n_tokens"] == len(ids) and r["library_agrees"]
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    coded = piece_bpe.decode(piece_bpe.encode(df, HOW), HOW, text="again")
    assert all(r["ids"][-1] == 2 and r["again"] == (r["text"] or "").replace("▁", " ") and r["n_tokens"] == 5 for r in coded.collect())
    assert piece_bpe.differences(df, HOW).count() == 0
    assert piece_bpe.digest(df.where("false"), HOW).count() == 0


def test_disagreement_is_told(spark):
    codec = piece_bpe.Codec(MODEL, 1000)
    right = codec.agenda.into.copy()
    codec.agenda.into[:] = right[::-1]
    assert codec.encode(["", "the thing"], compare=True)[1] == [True, False]


def test_other_vocabularies_are_refused(tmp_path):
    with open(MODEL, "rb") as f:
        raw = f.read()
    (tmp_path / "m").write_bytes(raw + bytes([0x12, 0x02, 0x18, 0x01]))  # the last trainer's part says that the type is another
    with pytest.raises(ValueError):
        piece_bpe.Model(str(tmp_path / "m"))


# Hard negatives


def _mined(rows, every=50, positives=5, negatives=3):
    """Brute force with Python's whole numbers, of (id, label, vector)."""
    kept = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(256 * x) for x in v]
            kept[i] = min(kept.get(i, (label, x)), (label, x))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for a, (label, x) in kept.items():
        if a % every:
            continue
        scored = sorted(((-dot(x, y), i, m) for i, (m, y) in kept.items() if i != a))
        for s, p, _ in [t for t in scored if t[2] == label][:positives]:
            window = [(-n, i) for n, i, m in scored if m != label and 50 * -s <= 100 * -n <= 95 * -s][:negatives]
            out += [(a, p, k, i, -s, n) for k, (n, i) in enumerate(window, 1)]
    return sorted(out)


def _vectors(rng, n, d, centres, copies):
    middle = rng.normal(size=(centres, d))
    rows = []
    for i in range(n):
        v = middle[rng.integers(centres)] * 0.1 + rng.normal(size=d) * rng.choice([0.01, 0.05, 0.2])
        rows.append((int(i), int(rng.integers(4)), v.astype(np.float32).tolist()))
    return rows + [(n + i, int(i % 3), rows[0][2]) for i in range(copies)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, label int, embedding array<float>, rank string, stripe int").repartition(3)


@pytest.mark.parametrize("how", [hard_negatives.Mining(), hard_negatives.Mining(block_rows=37, block_anchors=3, held_anchors=2)])
def test_hard_negatives_equal_brute_force(spark, how):
    rng = np.random.default_rng(4)
    rows = _vectors(rng, 400, 19, 6, 150)
    rows += [(None, 1, [0.5] * 19), (700, None, [0.5] * 19), (750, 2, None), (800, 2, [float("nan")] * 19), (850, 2, [float("inf")] + [0.0] * 18), (900, 2, [None, 0.1]), (950, 1, []), (1000, 1, [0.3, -0.2]), (1050, 0, [0.0] * 19), (1100, 1, [0.4] * 23), rows[0], (50, 3, rows[50][2])]
    got = sorted(map(tuple, hard_negatives.mine(_frame(spark, rows), F.col("vec_id") % 50 == 0, how).collect()))
    assert got == _mined(rows) and len(got) > 50


def test_hard_negatives_of_large_components_and_nothing(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (x * 10**6).tolist()) for i, x in enumerate(rng.normal(size=(120, 5)))]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % 50 == 0).collect()))
    assert got == _mined(rows) and got
    assert hard_negatives.mine(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.mine(frame.where("vec_id % 50 <> 0"), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(Exception, match="64-bit"):
        hard_negatives.mine(spark.createDataFrame([(0, 1, [1e300])], "vec_id long, label int, embedding array<double>"), F.col("vec_id") % 50 == 0).count()


def test_posting_lists_leave_out_what_norms_cover():
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(500, 40)) * np.linspace(60, 1, 40)).astype(np.int64).astype(np.float64)
    q = x[:9]
    index, rest = hard_negatives.Index(x), hard_negatives.Index(x[:9]).rest
    exact = q @ x.T
    for share in (0.9, 0.5, 0.2, 0.0):
        least = np.ceil(share * exact.max(axis=1))
        a, i, score = index.search(q, rest, least)
        assert {*zip(a.tolist(), i.tolist(), score.tolist(), strict=True)} == {(a, i, int(exact[a, i])) for a, i in zip(*np.nonzero(exact >= least[:, None]), strict=True)}
    assert ((index.rest[:, :40] >= 0.5 * exact.max() / rest[:, 0].max()).sum(axis=1) < 40).all()


# Conversation tries


def _nodes(rows, splice=False):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    built = own
    if splice:
        built = {}
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:]
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    below = {}
    for k in sorted(members, key=len, reverse=True):
        own_saved = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        below[k] = (sum(below[x][0] for x in children.get(k, [])) or 1, own_saved + sum(below[x][1] for x in children.get(k, [])))
    ends = lambda k: ",".join(map(str, sorted(c for c in members[k] if len(built[c]) == len(k))))
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), *below[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in members.items())


def _logs(rng):
    turn = lambda n: ("user" if n % 2 == 0 else None, rng.choice(["a", "bb", "ß漢", "", None]))
    rows, base = [], [turn(i) for i in range(12)]
    for c in range(-30, 330):
        shape = rng.randrange(4)
        turns = [turn(i) for i in range(rng.randrange(1, 7))] if shape == 0 else base[: rng.randrange(1, 12)] if shape == 1 else base if shape == 2 else base[:3] + [turn(i) for i in range(4)]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rows += [(c, i, "user", f"t{i}") for c in (1000, 1001) for i in range(900)] + [(1003, i, "user", f"u{i}") for i in range(700)]  # long: two copies, and one alone
    rows += [(2000, None, "z", "first"), (2000, 1, "b", "x"), (2000, 1, "a", "y"), (2000, 1, "a", "y"), (2000, -1, None, None), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [conversation_trie.Trie(), conversation_trie.Trie(container_turns=9, most_levels=2, ids_at_once=3, summed_turns=4)])
def test_tries_equal_brute_force(spark, how):
    rows = _logs(random.Random(7))
    if how.most_levels == 2:  # a round for every two levels
        rows = [r for r in rows if r[1] is None or r[1] < 9]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "conv_id long, turn long, role string, text string, depth int, n string").repartition(3)
    assert sorted(map(tuple, conversation_trie.trie(df, how).collect())) == _nodes(rows)
    assert sorted(map(tuple, conversation_trie.spliced_trie(df, how=how).collect())) == _nodes(rows, splice=True)
    assert conversation_trie.trie(df.where("false"), how).count() == 0


def test_turnless_conversations_end_in_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 13)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, conversation_trie.spliced_trie(df).collect()))
    assert got == _nodes(rows, splice=True)
    assert got[0][4] <= 1 and got[0][7] != hashlib.sha256(b"").hexdigest()


def test_a_long_conversation_is_dealt_to_several_tasks(spark):
    rows = [(5, i, "user", f"turn {i}") for i in range(4000)] + [(i, 0, "user", "x") for i in range(10, 400)]
    scratch = Scratch(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = conversation_trie.ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), scratch)
        parts = spark.read.parquet(scratch.paths["places"][0]).where("conv_id = 5").groupBy(F.shiftright("place", 33)).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 3000
    assert own.where("conv_id = 5").agg(F.min("position"), F.max("position"), F.countDistinct("position")).first() == (1, 4000, 4000)
