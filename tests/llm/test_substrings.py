"""Both substring operators against brute force, with and without large groups."""

from __future__ import annotations

import dataclasses
import random

import brute
import pytest

from tideline.llm import hashing, rlz_dedup, substrings, suffix_dedup
from tideline.llm.suffix_dedup import maximal_repeats


def corpus(seed, copies=6):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(400)}" for _ in range(90)] + ["é", "ß☃"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(80), text(14)
    rows = [(i, text(rng.randrange(1, 200))) for i in range(12)]
    rows += [(20 + i, f"{text(rng.randrange(30))} {passage} {text(rng.randrange(30))}") for i in range(copies)]
    rows += [(40 + i, f"{text(3)}\n" + f"{line}\n" * 4) for i in range(3)]
    rows += [(50, rows[3][1]), (51, rows[3][1]), (60, ""), (61, None), (62, " \n"), (None, rows[5][1]), (63, "a" * 700), (64, "ab" * 250), (65, "x " * 130)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cap", [256, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(frame, monkeypatch, cap, seed):
    rows = corpus(seed)
    given = substrings.Method
    monkeypatch.setattr(suffix_dedup, "Method", lambda **k: dataclasses.replace(given(**k), part=cap))
    monkeypatch.setattr(rlz_dedup, "Method", lambda **k: dataclasses.replace(given(**k), part=cap))
    got = suffix_dedup.remove_repeats(frame(rows)).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.suffix_dedup(rows, 200), key=repr)
    got = rlz_dedup.remove_duplicates(frame(rows)).select("rest.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.substring_dedup(rows, 50), key=repr)


@pytest.mark.parametrize("cap", [256, 1])
@pytest.mark.parametrize("seed", range(2))
def test_copies_within_one_document(frame, monkeypatch, cap, seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    p, x, y = text(60), text(100), text(100)
    block = f"{x} {p} {y}"
    rows = [(1, p), (2, f"{block} {text(5)} {block}"), (3, block), (4, f"{text(7)} {block} {text(7)}"), (4, f"{block} {text(9)} {block}")]
    q, z, v = text(70), text(90), text(90)
    rows += [(5, q), (None, f"{z} {q} {v}"), (None, f"{z} {q} {v} {text(3)} {z} {q} {v}"), (6, text(300))]
    rng.shuffle(rows)
    given = substrings.Method
    monkeypatch.setattr(rlz_dedup, "Method", lambda **k: dataclasses.replace(given(**k), part=cap))
    got = rlz_dedup.remove_duplicates(frame(rows)).select("rest.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.substring_dedup(rows, 50), key=repr)


def test_repeated_rows_and_clashing_columns(spark):
    text = "the quick brown fox " * 20
    rows = spark.createDataFrame([(1, text, 5, "k"), (1, text, 6, "k"), (2, "short", 7, "k")], "doc_id long, text string, row int, gram string")
    got = {(r.rest.doc_id, r.rest.row, r.rest.gram): r.n_removed for r in suffix_dedup.remove_repeats(rows).collect()}
    assert got == {(1, 5, "k"): len(text), (1, 6, "k"): len(text), (2, 7, "k"): 0}
    kept = suffix_dedup.without_repeats(rows)
    assert kept.columns == rows.columns and [tuple(r) for r in kept.collect()] == [(2, "short", 7, "k")]


def test_empty_tables(frame):
    assert suffix_dedup.remove_repeats(frame([])).count() == 0
    assert rlz_dedup.remove_duplicates(frame([])).count() == 0


def test_maximal_repeats():
    texts = [(b"xabcdey", 2), (b"zabcdew", 2), (b"qabcq", 2), (b"bcdev", 0)]
    got = list(maximal_repeats(texts, 3))
    assert {(a, b, tuple(sorted(m))) for a, b, m in got} == {(0, 4, (0, 1, 3)), (1, 2, (0, 1, 2)), (1, 4, (0, 1))}


@pytest.mark.parametrize("seed", range(5))
def test_maximal_repeats_are_all(seed):
    rng = random.Random(seed)
    texts = sorted({(bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))), bytes(rng.choice(b"ab") for _ in range(rng.randrange(6)))) for _ in range(14)})
    got = {(a, b, tuple(sorted(m))) for a, b, m in maximal_repeats([(x + b"|" + y, len(x)) for x, y in texts], 3)}
    expect = set()
    for left in range(6):
        for right in range(1, 7):
            if left + right < 3:
                continue
            for i, (x, y) in enumerate(texts):
                same = lambda j, a, b: len(texts[j][0]) >= a and len(texts[j][1]) + 1 >= b and x[len(x) - a :] == texts[j][0][len(texts[j][0]) - a :] and (b"|" + y)[:b] == (b"|" + texts[j][1])[:b]  # noqa: E731, B023
                if len(x) < left or len(y) + 1 < right:
                    continue
                found = [j for j in range(len(texts)) if same(j, left, right)]
                wider = [len(x) > left and all(same(j, left + 1, right) for j in found), len(y) + 1 > right and all(same(j, left, right + 1) for j in found)]
                if len(found) > 1 and not any(wider):
                    expect.add((left, right, tuple(found)))
    assert got == expect


def test_factors_check_their_boundaries():
    word = lambda i: str(i).encode()
    a, b = [word(i) for i in range(1, 7)], [word(i) for i in (5, 6, 7, 8)]
    reference = rlz_dedup.Reference(3)
    reference.add(1, a)
    reference.add(2, b)
    assert list(reference.factors(3, [word(i) for i in range(1, 9)])) == [(0, 6), (4, 4)]
    assert list(reference.factors(1, a)) == []


@pytest.mark.parametrize("part", [256, 3])
def test_long_texts_and_a_passage_in_a_third_of_all(frame, monkeypatch, part):
    rng = random.Random(part)
    words = [f"t{rng.randrange(10**6)}" for _ in range(5000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, long = text(70), text(9_000)
    rows = [(i, f"{text(rng.randrange(60))} {passage} {text(rng.randrange(60))}" if i % 3 == 0 else text(rng.randrange(90))) for i in range(120)]
    rows += [(200, long), (201, f"{text(900)} {long[20_000:40_000]} {text(900)}"), (202, f"{long[45_000:]} {text(9_000)}")]
    given = substrings.Method
    monkeypatch.setattr(suffix_dedup, "Method", lambda **k: dataclasses.replace(given(**k), part=part))
    monkeypatch.setattr(rlz_dedup, "Method", lambda **k: dataclasses.replace(given(**k), part=part))
    got = suffix_dedup.remove_repeats(frame(rows)).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.suffix_dedup(rows, 200), key=repr)
    got = rlz_dedup.remove_duplicates(frame(rows)).select("rest.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.substring_dedup(rows, 50), key=repr)


def test_long_inputs_are_read_in_pieces():
    rng = random.Random(3)
    raw = [" ".join(f"w{rng.randrange(99)}" for _ in range(n)).encode() for n in (500, 0, 3, 900)]
    whole, bounds = hashing.words(raw)
    parts, again = hashing.words(raw, most=50)
    assert (whole == parts).all() and (bounds == again).all()
    spread = lambda most: {(t, s + k, g, p - k) for t, s, n, p, g in zip(*(x.tolist() for x in hashing.anchors(whole, bounds, 50, 8, most)[:5])) for k in range(n)}  # noqa: B905, E731
    assert spread(1 << 19) == spread(77)


def test_columns_of_the_operators_own_names(spark):
    text = "word " * 60
    rows = spark.createDataFrame([(i, text, i, "z", "s") for i in (1, 2)], "doc_id long, text string, ord int, z string, spans string")
    got = rlz_dedup.remove_duplicates(rows).collect()
    assert {(r.rest.doc_id, r.rest.ord, r.rest.z, r.rest.spans, r.n_removed) for r in got} == {(1, 1, "z", "s", 0), (2, 2, "z", "s", 60)}
