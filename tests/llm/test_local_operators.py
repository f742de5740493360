"""Operators that work row by row or within a task: URL filter, media columns, token counts, packing."""

from __future__ import annotations

import glob
import hashlib
import os
import random
import zlib
from itertools import accumulate

import duckdb
import public_tokenizers
import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideline.llm import matroska
from tideline.llm.packing import Words, best_fit, pack
from tideline.llm.queries import OP2_SQL, QUERIES, tokenizer_path
from tideline.llm.token_counts import Counter, Tree, count_tokens, default_edits, recount, trees
from tideline.llm.url_filter import Bloom, cascade, filter_urls, split_url

DATA = "/root/testdata"
WORDS = tokenizer_path("word_bpe_49k.json")
BYTES = tokenizer_path("byte_bpe_50k.tiktoken")
ODD = ["don't I'LL we've", "<|endoftext|> x y<|endoftext|>", "a\x1cb c\x00d \x85e　f", "Ǆ ß İstanbul ΟΔΥΣΣΕΥΣ", "日本語  です。", "é café ́x", "123 4,5%%% !_!", "", " ", "\ufeffx \u200b", "👩‍👩‍👧 😀", "½²³٣", "\xa0\xad x", None]


def test_urls_match_sql(spark):
    db = duckdb.connect()
    db.sql(f"create view pages as select * from '{DATA}/sf0.01/pages.parquet'")
    got = [tuple(r) for r in QUERIES["op2_url_filter"](spark, f"{DATA}/sf0.01").select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got) == sorted(db.sql(OP2_SQL).fetchall())


def test_url_edges(spark):
    urls = [None, "no scheme", "http://", "http://A.Example.ORG", "x://example.org/es/1#f", "x://notexample.org/es/", "x://b.com/fr/?q", "x://com/de/", "x://example.org/en/1", "x://example.org/en/21/"]
    rows = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(rows, rate=0.5).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("a.example.org", "", None, "allow"), 4: ("example.org", "/es/1", "example.org/es/", "block"),
        5: ("notexample.org", "/es/", "org/", "allow"), 6: ("b.com", "/fr/", "com/fr/", "allow"), 7: ("com", "/de/", "com/de/", "block"), 8: ("example.org", "/en/1", "example.org/en/1", "block"), 9: ("example.org", "/en/21/", "org/", "allow"),
    }
    assert filter_urls(rows.limit(0)).count() == 0
    assert split_url("a://b://c") == ("b:", "//c")


def test_cascade_is_exact_over_its_universe():
    rng = random.Random(3)
    keys = [f"k{i}" for i in range(4000)]
    listed = set(rng.sample(keys, 300))
    first = Bloom.of(listed, len(listed), 0, 0.3)
    made = cascade(listed, [k for k in keys if k in first and k not in listed], first)
    assert len(made.levels) > 2 and {k for k in keys if k in made} == listed


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=20_000))
def test_media_round_trip(raw):
    data = matroska.write(raw)
    media = matroska.parse(data)
    assert media.error is None and matroska.payload(data, media) == raw
    assert media.tracks == ([{matroska.TRACK_NUMBER: 1, matroska.TRACK_TYPE: 2, matroska.DEFAULT_DURATION: 64_000_000, matroska.CODEC_ID: "A_PCM/INT/LIT", matroska.SAMPLING: 8000.0, matroska.CHANNELS: 1, matroska.BIT_DEPTH: 8}])
    assert len(media.cues) == media.clusters == -(-len(raw) // (512 * 8 * 16))


def test_media_xiph_lace_unknown_size_and_damage():
    frames = [b"a" * 300, b"b" * 5, b"c" * 7]
    body = bytes([2, 255, 45, 5]) + b"".join(frames)
    block = matroska.element(matroska.SIMPLE_BLOCK, matroska.vint(2) + b"\0\x05\x02" + body)
    cluster = matroska.CLUSTER.to_bytes(4, "big") + b"\xff" + matroska.uint(matroska.CLUSTER_TIMESTAMP, 10) + block
    data = matroska.element(matroska.EBML, b"") + matroska.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster
    media = matroska.parse(data)
    assert [(p[0], p[1], data[p[2] : p[2] + p[3]], p[5]) for p in media.packets] == [(2, 15_000_000, f, matroska.XIPH) for f in frames]
    assert matroska.parse(data[:-4]).error and matroska.parse(b"").error == "no EBML header"
    for cut in range(0, len(data), 7):
        matroska.parse(data[:cut])


def test_packet_table(spark):
    rows = spark.createDataFrame([(1, bytearray(matroska.write(b"x" * 1500))), (None, None), (2, bytearray(b"junk"))], "id long, body binary")
    got = sorted(((r.id, r.track, r.n_bytes, r.lacing, r.error) for r in matroska.packet_table(rows, "id", "body").collect()), key=repr)
    assert got == sorted([(1, 1, 512, 3, None), (1, 1, 512, 3, None), (1, 1, 476, 3, None), (None, None, None, None, "no EBML header"), (2, None, None, None, "no EBML header")], key=repr)


def test_media_query(frame):
    text = "é" * 100
    got = {r.doc_id: r for r in matroska.read_features(matroska.store_texts(frame([(1, text), (2, text), (3, None), (4, ""), (None, "x" * 64)]))).collect()}
    assert got[1].n_bytes == 200 and got[1].payload_bytes == 256 and got[1].tail_crc32 == zlib.crc32((text.encode() + bytes(56))[-64:])
    assert got[1][3:] == got[2][3:] and got[3][1:] == got[4][1:] and got[3].payload_bytes == 64 and got[None].payload_bytes == 64


COUNTER = Counter(BYTES, public_tokenizers.PATTERN)
PIECES = st.text(st.sampled_from("ab'lrestvmd 1\n\t.é😀"), max_size=120)


@settings(max_examples=150, deadline=None)
@given(PIECES, st.lists(st.tuples(st.floats(0, 1), st.integers(0, 9), st.text(st.sampled_from("a'lre \n1."), max_size=12)), max_size=4))
def test_edits_count_as_whole_texts(text, edits):
    Tree.RUN = 2
    tree = Tree.of(text, COUNTER)
    for share, removed, added in edits:
        at = int(share * len(text))
        removed = min(removed, len(text) - at)
        tree.edit(at, removed, added, COUNTER)
        text = text[:at] + added + text[at + removed :]
        ends = list(accumulate(map(len, COUNTER.split(text))))
        assert tree.text == text and {*accumulate(len(run) for run, _, _ in tree.leaves())} <= {*ends} and tree.root.pieces == len(ends)
        assert tree.total == sum(COUNTER.counts(COUNTER.split(text)))
    Tree.RUN = 16


def test_edits_cost_a_path():
    costs = []
    for n in (1000, 100_000):
        tree, rng = Tree.of(" ".join(f"word{i % 977}" for i in range(n)), COUNTER), random.Random(n)
        tree.visited = 0
        anew = sum(tree.edit(rng.randrange(tree.length - 50), rng.randrange(9), "some new words " * rng.randrange(30), COUNTER) for _ in range(100))
        costs.append((tree.visited / 100, anew / 100))
        assert tree.total == sum(COUNTER.counts(COUNTER.split(tree.text)))
    assert costs[1][0] < costs[0][0] + 150 and costs[1][1] < 1.2 * costs[0][1]  # the logarithm of the length
    tree = Tree.of("start " * 50, COUNTER)
    for _ in range(300):
        tree.edit(17, 0, "grows here " * 9, COUNTER)
    assert tree._depth(tree._find(17)[0]) <= 2 * tree.root.pieces.bit_length() + 8 and tree.total == sum(COUNTER.counts(COUNTER.split(tree.text)))


def test_a_table_of_edits(spark, frame):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice(["don't", "  x", "12", "naïve", "\n"]) for _ in range(rng.randrange(200))) for i in range(20)} | {30: "", 31: None, 32: "no edits", 33: "long " * 30_000}
    kept = trees(frame([*texts.items(), (None, "no id")]), BYTES, public_tokenizers.PATTERN)
    edits, whole = [], {i: t or "" for i, t in texts.items()}
    for i in [*range(20), 30, 31, 33]:
        for turn in range(rng.randrange(1, 5)):
            at = rng.randrange(len(whole[i]) + 1)
            removed, added = min(rng.randrange(6), len(whole[i]) - at), rng.choice(["", " new", "\n\n"])
            whole[i] = whole[i][:at] + added + whole[i][at + removed :]
            edits.append((i, turn, at, removed, added))
    edits += [(32, 0, 99, 0, "outside"), (32, 1, None, 1, "x"), (None, 0, 0, 0, "x"), (77, 0, 0, 0, "no such row"), (30, 9, 0, None, None)]
    rng.shuffle(edits)
    got = {r.doc_id: r for r in recount(kept, spark.createDataFrame(edits, "doc_id long, turn int, at long, removed long, added string"), BYTES, public_tokenizers.PATTERN).collect()}
    assert {i: r.text for i, r in got.items()} == whole | {None: "no id"}
    assert all(r.n_tokens == sum(COUNTER.counts(COUNTER.split(r.text))) for r in got.values())
    assert got[32].n_refused == 2 and got[32].n_reencoded == 0 and 0 < got[33].n_reencoded < 300
    assert trees(frame([]), BYTES, public_tokenizers.PATTERN).count() == 0


def test_token_counts_query(spark, frame):
    rows = [(i, r.text) for i, r in enumerate(spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect())] + [(1000 + i, t) for i, t in enumerate(ODD)]
    got = {r.doc_id: r for r in count_tokens(frame(rows), BYTES, public_tokenizers.PATTERN).collect()}
    for i, text in rows:
        whole = text or ""
        assert got[i].n_tokens == sum(COUNTER.counts(COUNTER.split(whole)))
        for at, removed, added in default_edits(whole):
            whole = whole[:at] + added + whole[at + removed :]
        assert got[i].n_tokens_edited == sum(COUNTER.counts(COUNTER.split(whole)))
    assert got[0].n_reencoded < got[0].n_pretokens
    assert count_tokens(frame([]), BYTES, public_tokenizers.PATTERN).count() == 0


def test_words_give_the_tokenizers_ids():
    words, plain = Words(WORDS), Tokenizer.from_file(WORDS)
    for text in [t for t in ODD if t is not None] + [t for path in glob.glob(f"{DATA}/sf0.001/documents.parquet") for (t,) in duckdb.sql(f"select text from '{path}'").fetchall()]:
        assert words.ids(text) == b"".join(i.to_bytes(4, "little") for i in plain.encode(text, add_special_tokens=False).ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_fit_is_tightest(lengths):
    placed, used = best_fit(lengths, 64)
    rooms = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(64 - lengths[i])
    assert used == len(rooms)
    taken = {}
    for (window, offset), n in sorted(zip(placed, lengths, strict=True)):
        assert offset == taken.get(window, 0) and offset + n <= 64
        taken[window] = offset + n
    assert sorted(64 - t for t in taken.values()) == sorted(rooms)


def test_packing(spark, frame):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()] + [(5000 + i, t) for i, t in enumerate(ODD)] + [(None, "x"), (7000, "word " * 9000)]
    plain, pieces = Tokenizer.from_file(WORDS), {}
    found = pack(frame(rows).coalesce(2), WORDS).collect()
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    used = {}
    for r in found:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(n for p in used.values() for _, n in p) / (2048 * len(used)) > 0.97
    for i, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += r.length
        assert at == len(ids)
    assert pack(frame([]), WORDS).count() == 0


def test_packing_does_not_depend_on_partitions(frame):
    rng = random.Random(8)
    rows = [(i, "word " * rng.randrange(1, 3000)) for i in range(400)] + [(7, "again"), (7, "again"), (None, None), (None, "x")]
    given = lambda n: sorted(map(tuple, pack(frame(rows).repartition(n), WORDS, group=128).collect()), key=repr)
    one = given(1)
    assert one == given(50) and len({r[5] >> 32 for r in one}) > 3
    used = len({r[5] for r in one})
    assert sum(r[2] for r in one) / (2048 * used) > 0.98


def test_lace_times_and_key_frames():
    sizes = matroska.parse(matroska.write(bytes(range(256)) * 20)).packets
    assert [p[1] for p in sizes] == [i * 64_000_000 for i in range(10)] and all(p[4] for p in sizes)
    block = lambda n, track: matroska.element(matroska.BLOCK, matroska.vint(track) + b"\0\x01" + (b"\x04" + bytes([n - 1]) if n > 1 else b"\0") + b"ab" * n)
    group = lambda *parts: matroska.element(matroska.BLOCK_GROUP, b"".join(parts))
    refers, lasts = matroska.element(matroska.REFERENCE_BLOCK, b"\xff"), matroska.uint(matroska.BLOCK_DURATION, 90)
    track = matroska.element(matroska.TRACKS, matroska.element(matroska.TRACK_ENTRY, matroska.uint(matroska.TRACK_NUMBER, 2) + matroska.uint(matroska.DEFAULT_DURATION, 5_000_000)))
    cluster = matroska.element(matroska.CLUSTER, matroska.uint(matroska.CLUSTER_TIMESTAMP, 10) + group(block(3, 1), lasts) + group(refers, block(1, 1)) + group(block(1, 1), refers) + group(block(2, 2), lasts) + group(block(2, 1)))
    media = matroska.parse(matroska.element(matroska.EBML, b"") + matroska.element(matroska.SEGMENT, track + cluster))
    assert media.error is None
    assert [(p[0], p[1] // 1_000_000, p[4]) for p in media.packets] == [(1, 11, True), (1, 41, True), (1, 71, True), (1, 11, False), (1, 11, False), (2, 11, True), (2, 16, True), (1, 11, True), (1, 11, True)]


def test_media_digests(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()] + [(9000, None), (9001, ""), (9002, "é" * 70_000), (9002, "é" * 70_000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, media string, n_bytes int")
    got = sorted(map(tuple, matroska.read_features(matroska.store_texts(docs)).collect()))
    want = []
    for i, t in rows:
        raw = (t or "").encode()
        body = raw + bytes(64 if not raw else -len(raw) % 64)
        data = matroska.write(body)
        level = sum(body) / len(body)
        marks = [b >= 96 for b in body]
        crossings = sum(a != b for a, b in zip(marks, marks[1:], strict=False))
        packets = -(-len(body) // 512)
        laces = set()
        for at in range(0, len(body), 4096):
            frames = [len(body[k : min(k + 512, at + 4096)]) for k in range(at, min(at + 4096, len(body)), 512)]
            laces.add(0 if len(frames) == 1 else 2 if len(set(frames)) == 1 else 3)
        text = f"p{packets}c{-(-len(body) // 65536)}q{-(-len(body) // 65536)}l{''.join(map(str, sorted(laces)))}t{(packets - 1) * 64}m{level:.4f}x{crossings}h{max(body)}"
        want.append((i, len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(data), hashlib.sha256(data).hexdigest(), text))
    assert got == sorted(want)
    assert matroska.read_features(matroska.store_texts(docs.limit(0))).count() == 0


def test_url_repeats_and_long_urls(spark):
    urls = ["x://a.org/" + "p" * 50_000, "x://" + "s." * 2000 + "com/de/1"] * 2
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in filter_urls(rows).orderBy("page_id").collect()] == [("org/", "allow"), ("com/de/", "block")] * 2
    with pytest.raises(ValueError):
        filter_urls(spark.createDataFrame([(i, f"x://h{i}.org/fr/") for i in range(300)], "page_id long, url string"), rate=0.9, most_misses=5)


def test_other_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "some text here", "a", 2, 3)], "doc_id long, text string, start string, length int, n_tokens int")
    assert pack(docs, WORDS).count() == 1 and count_tokens(docs, BYTES, public_tokenizers.PATTERN).first().n_tokens == 3


@pytest.mark.parametrize("name", ["op2_url_filter"])
def test_registered(name):
    assert name in QUERIES and os.path.exists(WORDS)
