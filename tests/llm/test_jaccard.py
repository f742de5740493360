from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from tideline.llm import jaccard_join
from tideline.llm.components import components
from tideline.llm.jaccard_join import Forest, bitmaps, ngram_jaccard_join


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(60)}"
    rows, number = [], 0
    for _ in range(10):
        base = [word() for _ in range(rng.randrange(20, 160))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((number, " ".join(copy)))
            number += 1
    rows += [(200, ""), (201, None), (202, " "), (203, "One two"), (204, "one  TWO"), (205, "one"), (206, rows[0][1]), (207, rows[0][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "num", "small"), [(3, 90, False), (5, 80, False), (3, 90, True), (5, 80, True)])
def test_against_brute_force(frame, monkeypatch, n, num, small):
    if small:  # groups fall into many parts
        monkeypatch.setattr(jaccard_join, "PARTS_CAP", 3)
        monkeypatch.setattr(jaccard_join, "BLOCK_CAP", 3)
        monkeypatch.setattr(jaccard_join, "LINK_CAP", 2)
    rows = corpus(num + small)
    found = ngram_jaccard_join(frame(rows), n, num, 100, links=True).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(rows, n, num, 100)
    assert {r.doc_id: r.n_links for r in found} == brute.n_links(rows, n, num, 100)


def test_nulls_repeats_and_empty(frame):
    text = "a b c d e f g h"
    got = ngram_jaccard_join(frame([(None, text), (4, text), (4, text), (9, text), (4, "other words in this one here")]), 3, 90, 100).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (4, 4), (4, 4), (4, 4), (9, 4)]
    assert ngram_jaccard_join(frame([]), 3, 90, 100).count() == 0
    rows = [(None, text), (4, text), (4, text), (9, text + " i j k l m n o p q r s t u v"), (10, text + " i j k l m n o p q r s t u w"), (4, "other words in this one here"), (11, None)]
    counted = ngram_jaccard_join(frame(rows), 3, 90, 100, links=True).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.n_links) for r in counted) == [(-1, 6, 0), (4, 4, 0), (4, 6, 1), (4, 6, 1), (9, 20, 1), (10, 20, 1), (11, 0, 0)]
    assert ngram_jaccard_join(frame([]), 3, 90, 100, links=True).count() == 0


def test_a_part_holds_few_shingles(frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LINK_SHINGLES", 1000)
    rows = near_copies(40)
    got = {r.doc_id: r.n_links for r in ngram_jaccard_join(frame(rows), 3, 90, 100, links=True).collect()}
    assert got == brute.n_links(rows, 3, 90, 100)


def test_trees_lose_no_pair():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, rng.integers(5, 60)).astype(np.uint64)) for _ in range(150)]
    sets += [np.unique(np.append(s[1:], np.uint64(900 + i))) for i, s in enumerate(sets[:60])]
    groups = np.arange(len(sets)) % 3
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sizes = np.diff(first)
    forest = Forest(groups, sizes, bitmaps(np.concatenate(sets), first, 512), sizes)
    found = {frozenset((int(x), int(y))) for a, b in forest.pairs(70, 100) for x, y in zip(a, b, strict=True)}
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if groups[i] == groups[j] and 100 * common >= 70 * (sizes[i] + sizes[j] - common):
                assert frozenset((i, j)) in found
    assert len(found) < len(sets) ** 2 / 40


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 90), (95, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(n, seed=5):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    return rows


def test_near_copies_cost_in_proportion(frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_CAP", 16)
    monkeypatch.setattr(jaccard_join, "PARTS_CAP", 16)
    moved = []
    given = jaccard_join._grouped
    monkeypatch.setattr(jaccard_join, "_grouped", lambda rows, *a: (moved.append(rows.count()), given(rows, *a))[1])
    for n in (100, 400):
        moved.append(0)
        got = {r.doc_id: r.component_id for r in ngram_jaccard_join(frame(near_copies(n)), 3, 90, 100).collect()}
        assert set(got.values()) == {0} and len(got) == n
    cut = len(moved) - 1 - moved[::-1].index(0)
    assert sum(moved[cut:]) < 5 * sum(moved[:cut])  # four times the rows


def test_a_block_of_many_components(frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "bands_for", lambda *_: 30)
    monkeypatch.setattr(jaccard_join, "BLOCK_CAP", 4)
    monkeypatch.setattr(jaccard_join, "PARTS_CAP", 4)
    rng = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(i, f"{shared} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(3 + i % 40))}") for i in range(120)]
    rows += [(200 + i, rows[i][1] + " tail") for i in range(0, 120, 5)]
    rows += [(400, "word " * 20_000), (401, " ".join(f"q{i}" for i in range(20_000))), (402, " ".join(f"q{i}" for i in range(19_500)))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(frame(rows), 3, 90, 100).collect()}
    assert got == brute.components(rows, 3, 90, 100)


def test_columns_of_the_operators_own_names(spark):
    rows = spark.createDataFrame([(1, "a b c d", 3, "x", 9), (2, "a b c d", 4, "y", 8)], "doc_id long, text string, cluster int, z string, component_id int")
    assert sorted(map(tuple, ngram_jaccard_join(rows, 3, 90, 100).collect())) == [(1, 2, 1), (2, 2, 1)]
