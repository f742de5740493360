"""Quality classifier, mixing, fingerprints and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tideline.llm.mixing import GOLDEN, mix, mixed_rows, schedule, targets
from tideline.llm.order_minhash import fingerprint, fingerprints, with_next
from tideline.llm.quality import Model, classify

DATA = "/root/testdata"
MIX = "doc_id long, text string, source string, n_chars long"


def test_quality_on_held_out_rows(spark):
    sf = f"{DATA}/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = classify(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got) / len(got)
    good = [r.predicted for r in got if r.quality == 1]
    assert right > 0.93 and sum(good) / len(good) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_edges(spark, frame):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = frame([(i, "GOOD!! WORDS!! HERE!!" if i % 2 == 0 else "calm words in a row.") for i in range(40)] + [(50, None), (51, ""), (52, "x" * 100_000), (50, None), (None, "calm words")])
    got = classify(docs, labels).collect()
    assert len(got) == 45 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.predicted for r in got if r.doc_id in (1, 3, 5)} == {1} and {r.predicted for r in got if r.doc_id in (0, 2, 4)} == {0}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.score for r in classify(docs, labels.limit(0)).collect()} == {0.5}
    assert classify(frame([]), labels).count() == 0


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(0)
    counts, labels = rng.integers(0, 9, (30, 2048)).astype(np.float32), rng.integers(0, 2, 30)
    model = Model.fit(counts, labels, (int((labels == 0).sum()), int((labels == 1).sum())), rank=8)
    probe = rng.integers(0, 9, (5, 2048)).astype(np.float32)
    weighed = np.log1p(probe) * model.idf
    vectors = weighed / np.linalg.norm(weighed, axis=1, keepdims=True) @ model.axes
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    for score, v in zip(model.scores(probe, neighbours=7), vectors, strict=True):
        cos = model.vectors @ v
        near = np.argsort(-cos)[:7]
        votes = np.maximum(cos[near], 0) ** 8 * model.weights[near]
        assert score == pytest.approx((votes * labels[near]).sum() / votes.sum(), abs=1e-4)


def water(sizes, weights, share, cap):
    """Targets by adding one source after the other to the full ones."""
    total, full = Fraction(share) * sum(sizes), set()
    while True:
        rest = total - sum(cap * sizes[i] for i in full)
        free = [i for i in range(len(sizes)) if i not in full]
        level = rest / sum(weights[i] for i in free) if free else 0
        over = {i for i in free if weights[i] * level > cap * sizes[i]}
        if not over:
            return [float(cap * sizes[i] if i in full else weights[i] * level) for i in range(len(sizes))]
        full |= over


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 3, 10, 100, 5000, rng.randrange(1, 900)]) for _ in range(9)]
    names = [f"s{i}" for i in range(8)] + [None]
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")).collect()}
    assert [got[n] for n in names] == pytest.approx(water(sizes, [(5, 2, 1)[i % 3] for i in range(9)], Fraction(3, 2), 2))


def documents(seed, n=400):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "c", "é", None]), 1) for i in range(n)]
    return [*rows, (n, None, "b", 0), (n + 1, "", "z", 0), (n + 2, "w " * 3000, "b", 6000)]


def test_mix(spark):
    docs = spark.createDataFrame(documents(1), MIX)
    got = mix(docs, block=64).collect()
    again = mix(docs.repartition(5), block=64).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert len(got) == 403 and all(0 <= r.taken <= 2 * r.size for r in got)
    taken, target, size = Counter(), {}, Counter()
    for r in got:
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        assert r.size == len((next(d[1] for d in documents(1) if d[0] == r.doc_id) or "").split())
    assert all(r.source_size == size[r.source] for r in got)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1
    rows = mixed_rows(docs, block=64)
    assert rows.columns == docs.columns
    words = Counter()
    for r in rows.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert dict(words) == {r.doc_id: r.taken for r in got if r.taken}
    assert mix(docs.limit(0)).count() == 0 and mixed_rows(docs.limit(0)).count() == 0


def test_schedule_spreads_evenly(spark):
    plan = targets(spark.createDataFrame([("a", 50_000), ("b", 100_000), ("c", 90_000)], "source string, source_size long"))
    slots = sorted((r.slot, r.key, r.rank) for r in schedule(plan, block=100).collect())
    shares = {"+" + r.source: r.target / 360_000 for r in plan.collect()}
    for end in (200, 1000, 2500):
        seen = Counter(k for _, k, _ in slots[:end])
        assert all(abs(seen[k] - s * end) < 8 for k, s in shares.items())
    by_source = {}
    for _, key, rank in slots:
        by_source.setdefault(key, []).append(rank)
    assert all(r == list(range(len(r))) for r in by_source.values()) and 0.6 < GOLDEN < 0.62


def order_minhash(text, bins, ell, k, spark):
    """The selected k-mers of each bin, in text order, by the same hashes as the operator's, without its array tricks."""
    words = text.split(" ") if text else []
    pairs = [(words[i], words[i + 1]) for i in range(len(words) - 1)]
    hashed = {p: h for p, h in spark.createDataFrame([(*p,) for p in set(pairs)], "a string, b string").select(F.struct("a", "b"), F.xxhash64("a", "b")).collect()} if pairs else {}
    hashed = {tuple(p): h for p, h in hashed.items()}
    seen, numbered = Counter(), []
    for i, p in enumerate(pairs):
        numbered.append((hashed[p], seen[p], i))
        seen[p] += 1
    rows = spark.createDataFrame(numbered, "h long, o int, i int").select("i", F.xxhash64("h", "o").alias("x")).collect() if numbered else []
    out = []
    for b in range(bins):
        own = sorted((r.x, r.i) for r in rows if (r.x % (1 << 64)) >> (64 - (bins - 1).bit_length()) == b)[:ell]
        out.append([x for x, _ in sorted(own, key=lambda p: p[1])])
    return out


def test_fingerprint_is_order_minhash(spark, frame):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcde") + str(rng.randrange(9)) for _ in range(n)) for n in (2, 30, 200)]
    got = {r.doc_id: r.p for r in frame(enumerate(texts)).select("doc_id", fingerprint(F.col("text"), 8, 2, 2).alias("p")).collect()}
    for i, text in enumerate(texts):
        want = order_minhash(text, 8, 2, 2, spark)
        tuples = [spark.createDataFrame([(w,)], "w array<long>").select(F.xxhash64("w").alias("h")).first().h if w else None for w in want]
        assert got[i] == tuples


def test_fingerprints(frame):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    rows = [(i * 3, text(rng.randrange(0, 300))) for i in range(40)] + [(500, None), (501, ""), (502, "same words again " * 20), (503, "same words again " * 20), (504, "☃" * 50_000)]
    got = {r.doc_id: r for r in fingerprints(frame(rows)).collect()}
    order = sorted(rows, reverse=True)
    for at, (i, t) in enumerate(order):
        here, behind = t or "", order[(at + 1) % len(order)][1] or ""
        third = len(here) // 3
        edited = here[: len(here) - third] + behind[:third]
        assert got[i].n_chars == len(here) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[502].fingerprint == got[503].fingerprint and got[503].near_next == 1.0
    long = [r for r in got.values() if r.n_chars > 600 and r.doc_id < 500]
    assert sum(r.near_edited > r.near_next for r in long) == len(long)
    assert fingerprints(frame([])).count() == 0 and fingerprints(frame([(1, "one row only")])).first().near_next == 1.0
    assert fingerprints(frame([(1, "a b"), (1, "a b"), (None, "c")])).count() == 3


def test_order_counts(spark, frame):
    rows = frame([(1, "a b c d e f g h i j k l"), (2, "g h i j k l a b c d e f"), (3, "l k j i h g f e d c b a")])
    p = {r.doc_id: r.p for r in rows.select("doc_id", fingerprint(F.col("text"), 4, 3, 1).alias("p")).collect()}
    assert p[1] != p[3]  # one set of words, another order


@pytest.mark.parametrize(("bucket", "n"), [(1, 90), (3, 90), (1000, 90), (1, 5000)])
def test_next_across_buckets(spark, monkeypatch, bucket, n):
    monkeypatch.setattr("tideline.llm.order_minhash.BUCKET", bucket)
    ids = random.Random(bucket).sample(range(-500, 10_000), n)
    rows = spark.createDataFrame([(i, f"t{i}", 1, 2, 3) for i in ids], "doc_id long, text string, bucket int, place int, next int")
    got = {r.doc_id: r.next.text for r in with_next(rows, ["text"]).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: f"t{order[(k + 1) % len(order)]}" for k, i in enumerate(order)}


def test_next_of_equal_and_null_ids(frame, monkeypatch):
    monkeypatch.setattr("tideline.llm.order_minhash.BUCKET", 5)
    rows = [(1, f"a{i}") for i in range(300)] + [(None, f"b{i}") for i in range(300)] + [(2, "c"), (2, "c"), (3, "d")]
    got = Counter((r.doc_id, r.text, r.next.text) for r in with_next(frame(rows), ["text"]).collect())
    assert sum(got.values()) == len(rows) and Counter(n for _, _, n in got.elements()) == Counter(t for _, t in rows)
    after = {(i, t): n for i, t, n in got}
    assert after[3, "d"] == "c" and sorted(n for (i, t, n), k in got.items() for _ in range(k) if i == 2) == sorted(["c", after[2, "c"] if after[2, "c"] != "c" else next(n for i, t, n in got if i == 2 and n != "c")])
    seen, at = set(), "d"
    links = {t: n for (i, t, n) in got if t != n}
    while at not in seen:  # one ring through all texts
        seen.add(at)
        at = links[at]
    assert len(seen) == 602


def test_mix_of_many_sources_and_clashing_columns(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 150}", 5, "key", 1) for i in range(900)] + [(5, "w w", "s5", 5, "key", 1)] * 3
    docs = spark.createDataFrame(rows, "id long, body string, origin string, size int, key string, block int")
    given = lambda: sorted(map(tuple, mix(docs, block=3, id_col="id", text_col="body", source_col="origin").drop("first_slot").collect()))
    few = given()
    monkeypatch.setattr("tideline.llm.mixing.FEW_SOURCES", 10)
    assert given() == few and len(few) == 903
    out = mixed_rows(docs, block=3, id_col="id", text_col="body", source_col="origin")
    words = Counter()
    for r in out.collect():
        words[r.id] += len(r.body.split())
    taken = Counter()
    for r in few:
        taken[r[0]] += r[5]
    assert out.columns == docs.columns and words == Counter({k: v for k, v in taken.items() if v})


def test_first_slots_follow_the_schedule(spark):
    docs = spark.createDataFrame(documents(3), MIX)
    got = [r for r in mix(docs, block=64).collect() if r.taken]
    assert all(r.first_slot is not None for r in got)
    early = Counter(r.source for r in got if r.first_slot < 40)
    assert len(early) >= 4  # every stretch has all of the larger sources


EDGES = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n", "en", None, 2), (None, "calm words in a row that go on for a while", "en", "b", 43), (None, "calm words in a row that go on for a while", "en", "b", 43), (None, "other words for a row without an id at all", "en", "b", 43), (5, "calm words of five, with the same id twice", "en", "b", 43), (5, "quite another text that has the id five too", "en", "b", 43), (6, "long word " * 40_000, "en", "c", 400_000)]


def test_pipeline_stages_on_edges(spark):
    import corpus_pipeline

    sf, stages = f"{DATA}/sf0.001", dict(corpus_pipeline.STAGES)
    source = spark.read.parquet(f"{sf}/documents.parquet")
    wide = StructType([*source.schema.fields, StructField("score", DoubleType()), StructField("row", StringType()), StructField("z", IntegerType())])
    docs = spark.createDataFrame([(*r, None, "x", 1) for r in EDGES], wide)
    cut = lambda rows: sorted(((r.doc_id, (r.text or "")[:30], r.z) for r in rows), key=repr)
    given = cut(docs.collect())
    kept = stages["quality_classifier"](spark, docs, sf)
    assert kept.columns == docs.columns and set(cut(kept.collect())) <= set(given)
    one = stages["near_duplicates"](spark, docs, sf)
    assert one.columns == docs.columns and cut(one.collect()) == cut(r for i, r in enumerate(docs.collect()) if i != 4)
    left = stages["suffix_array_dedup"](spark, docs, sf)
    assert left.columns == docs.columns and cut(left.collect()) == [(i, t if i != 6 else "", z) for i, t, z in given if i != 6]
    mixed = stages["source_mixing"](spark, docs, sf)
    assert mixed.columns == docs.columns and set(cut(mixed.collect())) <= set(given) and not mixed.where("text is null or trim(text) = ''").count()
    packed = stages["packing"](spark, docs, sf)
    assert packed.where("start = 0").count() == len(EDGES)
    for name, stage in stages.items():
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_pipeline(spark):
    import corpus_pipeline

    sf, seen = f"{DATA}/sf0.001", []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).persist()
        seen.append((name, docs.columns, docs.count()))
    assert [n for n, *_ in seen] == ["quality_classifier", "near_duplicates", "suffix_array_dedup", "source_mixing", "packing"]
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for _, c, _ in seen[:-1])
    assert 200 >= seen[0][2] > seen[1][2] > 0 and seen[-1][2] > 0


def test_pipeline_stages_against_brute_force(spark):
    import brute
    import corpus_pipeline
    from tokenizers import Tokenizer

    from tideline.llm import mixing, quality
    from tideline.llm.queries import tokenizer_path

    sf, stages = f"{DATA}/sf0.001", dict(corpus_pipeline.STAGES)
    source = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted(map(tuple, source.collect()))
    full = [r for r in rows if r[1] and len(r[1].split()) > 80]
    rows += [(10**6 + r[0], f"{r[1]} changed", *r[2:]) for r in full[::4]]
    rows += [(2 * 10**6 + r[0], f"{r[1]} {full[0][1][:300]} ☃", *r[2:]) for r in full[1::4]]
    rows += [(None, "one two three " * 30, "en", None, 420), (3 * 10**6, None, "en", full[0][3], 0)]
    given = lambda r: spark.createDataFrame(r, source.schema)
    run = lambda name, r: [tuple(x) for x in stages[name](spark, given(r), sf).collect()]
    order = lambda r: sorted(r, key=repr)

    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality in (0, 1) and not held(r.doc_id)}
    counts = quality.term_counts([(r[1] or "").encode() for r in rows])
    own = [k for k, r in enumerate(rows) if r[0] in known]
    labels, found = [known[rows[k][0]] for k in own], Counter(known.values())
    weighed = {k: found[k] / max(1, labels.count(k)) for k in (0, 1)}
    some = [k for k, r in enumerate(rows) if r[1]]  # texts without terms have the prior
    score = {rows[k]: v for k, v in zip(some, brute.votes(counts[some], weighed, counts[own], labels, quality.NEIGHBOURS, quality.RANK, quality.SHARPNESS), strict=True)}
    prior = found[1] / (found[0] + found[1])
    kept = run("quality_classifier", rows)
    sure = {r for r in rows if abs(score.get(r, prior) - 0.5) > 0.02}
    assert len(sure) > 0.9 * len(rows) and set(kept) <= set(rows) and len(kept) == len(set(kept))
    assert set(kept) & sure == {r for r in sure if score.get(r, prior) >= 0.5}

    groups = brute.components([r[:2] for r in kept if r[0] is not None], 5, 80, 100)
    near = run("near_duplicates", kept)
    assert order(near) == order(r for r in kept if r[0] is None or groups[r[0]][1] == r[0]) and len(near) < len(kept)

    texts = brute.without_repeats([(r[0], r[1]) for r in near], 200)
    cut = run("suffix_array_dedup", near)
    assert order(cut) == order((r[0], t := texts[r[0]], r[2], r[3], len(t)) for r in near if r[0] in texts) and sum(r[4] for r in cut) < sum(len(r[1] or "") for r in near)

    h = {r.doc_id: r.h for r in given(cut).select("doc_id", F.xxhash64("doc_id", F.lit("stream")).alias("h")).collect()}
    chunks = max(16, -(-len(cut) // mixing.CHUNK))
    stream = sorted(cut, key=lambda r: ((h[r[0]] >> 32) % chunks, h[r[0]]))
    rest = {r[0]: r[2:4] for r in cut}
    mixed = run("source_mixing", cut)
    assert order(mixed) == order((k, t, *rest[k], len(t)) for k, t in brute.mixed([(r[0], r[3], r[1]) for r in stream], mixing.WEIGHTS, mixing.SHARE, mixing.CAP))

    words = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = stages["packing"](spark, given(mixed).coalesce(1), sf).collect()
    assert order(map(tuple, got)) == order(brute.packed([(r[0], [*words.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in mixed], 2048))
