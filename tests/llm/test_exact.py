"""Pieces, mixing and search against exact versions, and the pipeline's stages."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripleframe.llm import mixing, pieces, search
from tripleframe.llm.queries import piece_model

ALPHABET = " \n\t▁aabcde<s>日本é\U0001f600\x00﻿ﬁ 　ＡK."


def random_texts(n=400):
    rnd = random.Random(1)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.choice([0, 1, 3, 10, 60, 200]))) for _ in range(n)]


def test_pieces_are_those_of_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = [None, "", "a" * 30000 + "bé" * 20000, *random_texts()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "'x' AS ids").repartition(3)
    for r in pieces.encode_documents(df, piece_model(), spans=True).collect():
        text = texts[r["doc_id"]] or ""
        ids = library.encode(text)
        assert r["ids"] == ids and r["decoded"] == library.decode(ids)
        assert [s["id"] for s in r["spans"]] == ids
        data, at = text.encode(), 0
        for n, s in enumerate(r["spans"]):
            source = data[s["start"] : s["end"]]
            if not s["piece"].startswith("<0x"):
                assert s["piece"] == source.decode().replace(" ", "▁") or n == 0
            assert s["start"] == at or s["piece"].startswith("<0x")
            at = s["end"]
        assert at == len(data)


def test_memo_and_heap_give_the_same(monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 5)
    small, plain = pieces.PieceModel(piece_model()), pieces.PieceModel(piece_model())
    for t in random_texts(100):
        assert small.encode(t) == plain.encode(t)
        assert small.decode(small.encode(t)) == small.both(t)[1]
        for w in plain.words.findall(plain.marked(t)):
            assert plain._merge_long(list(w)) == plain._merge_short(list(w))


def test_places_in_bulk_are_those_of_the_pieces(spark):
    texts = [None, "", " ", "a" * 30000 + "bé" * 20000, "\u3000 x\U0001f600y  ", *random_texts(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    model = pieces.PieceModel(piece_model())
    held = pieces.encode_documents(df, piece_model(), spans=True, bounds=True).collect()
    assert len(held) == len(texts)
    for r in held:
        plain = model.spans(texts[r["doc_id"]] or "")
        assert [tuple(s) for s in r["spans"]] == plain
        assert r["starts"] == [s[2] for s in plain] and r["ends"] == [s[3] for s in plain]


def test_places_through_squeezed_spaces_and_a_map():
    model = pieces.PieceModel(piece_model())

    class Upper:
        """Stands for a compiled map: two letters become three, a tab a space."""

        def longest(self, data, at):
            return (2, "cab") if data[at : at + 2] == b"xy" else (1, " ") if data[at] == 9 else None

    model.map, model.squeeze = Upper(), True
    for t in ["", "  ", "xy", "a  xy\té ", " xyxy\t\t\u4e2dxy", *random_texts(40)]:
        ids, surface, places = model.coded(t)
        plain = model.spans(t)
        assert ids.tolist() == [s[0] for s in plain] and surface == model.decode(ids.tolist())
        assert [tuple(p) for p in places.tolist()] == [s[2:] for s in plain]
        data = t.encode()
        assert all(data[a:b].decode() is not None for a, b in places.tolist())


def test_longest_prefix_of_a_compiled_map():
    # A double array over "ab" -> "X" and "abc" -> "YZ", laid out by hand.
    import struct

    units = [0] * 1024
    used = {0}

    def place(children, base_free=[256]):
        base = base_free[0]
        base_free[0] += 256
        return base

    def link(node, keys):
        base = place(keys)
        units[node] |= (base ^ node) << 10
        return base

    strings = b"X\0YZ\0"
    base = link(0, "a")
    a = base ^ ord("a")
    units[a] |= ord("a")
    base = link(a, "b")
    b = base ^ ord("b")
    units[b] |= ord("b")
    units += [0] * 1024
    base = link(b, "c")
    c = base ^ ord("c")
    units[b] |= 1 << 8
    units[base] = 0x80000000 | 0
    units[c] |= ord("c") | 1 << 8
    base = link(c, "")
    units[base] = 0x80000000 | 2
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + strings
    held = pieces.CharacterMap(blob)
    assert held.longest(b"abd", 0) == (2, "X") and held.longest(b"zabcd", 1) == (3, "YZ") and held.longest(b"ba", 0) is None
    model = pieces.PieceModel(piece_model())
    model.map = held
    assert model.normalise("éabc ab") == ("▁éYZ▁X", [0, 0, 2, 2, 5, 6, 8])
    assert used


def targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        level = rest / max(1, sum(w[s] for s in order if s not in full))
        over = {s for s in order if s not in full and level * w[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else level * w[s] for s in order}
        full |= over


@pytest.mark.parametrize("block", [7, 1024, None])
def test_mix(spark, block):
    rnd = random.Random(6)
    rows = [(i, " ".join(["w"] * rnd.randrange(60)), rnd.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "", "e"), (None, "x y", "b"), (7, "same text", "c"), (7, "same text", "c"), (2000, "z " * 3000, "Z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS target", "3 AS digest").repartition(4)
    placed, mixed = mixing.mix(df, block=block)
    got = mixing.taken_per_document(placed, mixed).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    assert sorted(r["size"] for r in got) == sorted(size) and len(got) == len(rows)
    sizes = defaultdict(int)
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] += n
    want, taken = targets(sizes), defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert math.isclose(r["target"], want[r["source"]], abs_tol=1e-6)
        taken[r["source"]] += r["taken"]
    total = sum(want.values())
    whole = sum({r["source"]: math.floor(r["target"] + 0.5) for r in got}.values())
    length = block or max(1, min(mixing.BLOCK, -(-whole // mixing.SLOTS)))
    n_slots = -(-whole // length)
    assert all(abs(taken[s] - want[s]) <= length * max(1, math.log2(n_slots)) for s in sizes)
    # What is taken is what the slots of the schedule hold, by a plain walk over points and documents.
    goal = {r["source"]: math.floor(r["target"] + 0.5) for r in got}
    order = sorted((s for s in goal if goal[s]), key=lambda s: (s is None, s or ""))
    ends = list(itertools.accumulate(goal[s] for s in order))
    points = [int(f"{n:048b}"[::-1], 2) / 2**48 * ends[-1] for n in range(n_slots)]
    given = Counter(order[bisect.bisect_right(ends, x)] for x in points)
    streams = defaultdict(list)
    for r in got:
        streams[r["source"]].append(r)
    for s, held in streams.items():
        at, limit = 0, given[s] * length
        plain = Counter()
        held.sort(key=lambda r: r["digest"])
        for _ in range(3):
            for k, r in enumerate(held):
                plain[k] += max(0, min(r["size"], limit - at))
                at += r["size"]
        alike = Counter((r["doc_id"], r["taken"]) for r in held)
        assert alike == Counter((r["doc_id"], plain[k]) for k, r in enumerate(held))
    assert all((r["taken"] == 0) == (r["first_slot"] is None) == (r["n_pieces"] == 0) for r in got)
    # Without slots nothing is taken.
    assert {r["taken"] for r in mixing.taken_per_document(placed, mixed.where("slot < 0")).collect()} == {0}
    # The schedule is even: at each point a source has had about its share of the slots.
    slots = [r["source"] for r in mixed.where("slot IS NOT NULL").select("slot", "source").distinct().orderBy("slot").collect()]
    seen = Counter()
    for n, s in enumerate(slots, 1):
        seen[s] += 1
        assert all(abs(seen[k] - n * want[k] / total) <= 2 + math.log2(n + 1) for k in sizes)
    again = mixing.taken_per_document(*mixing.mix(df, block=block)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    empty = mixing.mix(df.where("1 = 0"), block=block)
    assert mixing.taken_per_document(*empty).collect() == []


def bm25(docs, asked, k):
    bags = [(i, Counter(search.terms(t))) for i, t in docs]
    mean = (sum(sum(b.values()) for _, b in bags) / len(bags)) or 1
    held = Counter(t for _, b in bags for t in b)
    out = []
    for q, text in asked:
        scored = []
        for i, b in bags:
            n, s, hit = sum(b.values()), 0.0, False
            for t, c in Counter(search.terms(text)).items():
                if t in b:
                    hit = True
                    idf = math.log(1 + (len(bags) - held[t] + 0.5) / (held[t] + 0.5))
                    s += c * idf * b[t] * (search.K1 + 1) / (b[t] + search.K1 * (1 - search.B + search.B * n / mean))
            if hit:
                scored.append((-round(s, 9), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1] if x[1] is not None else search.NO_ID))[:k])]
    return out


@pytest.mark.parametrize(("block", "shard", "group"), [(64, 8 << 20, 256), (2, 900, 2)])
def test_search_is_exact(spark, monkeypatch, block, shard, group):
    for name, value in (("BLOCK", block), ("SHARD", shard), ("QUERIES", group)):
        monkeypatch.setattr(search, name, value)
    rnd = random.Random(8)
    words = [f"w{int(60 * rnd.random() ** 3)}" for _ in range(500)]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(40)))) for i in range(250)]
    docs += [(900, None), (901, ""), (902, docs[3][1]), (903, docs[3][1]), (None, docs[3][1]), (904, "Rare, rare! " * 3000)]
    asked = [(1, docs[3][1]), (2, "w1 w1 w40 rare"), (3, ""), (4, None), (5, "nowhere"), (6, "W0"), (None, "w1")]
    shards = search.index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = search.top_k(shards, spark.createDataFrame(asked, "item_id long, text string"), k=6).collect()
    want = bm25(docs, [a for a in asked if a[0] is not None], 6)
    assert [(r[0], r[1], r[2]) for r in sorted(got, key=lambda r: (r[0], r[1]))] == [w[:3] for w in want]
    assert all(math.isclose(r[3], w[3], abs_tol=1e-8) for r, w in zip(sorted(got, key=lambda r: (r[0], r[1])), want, strict=True))
    assert search.top_k(shards, spark.createDataFrame([], "item_id long, text string")).collect() == []
    none = search.index(spark.createDataFrame([], "doc_id long, text string"))
    assert search.top_k(none, spark.createDataFrame(asked, "item_id long, text string")).collect() == []


def test_rows_of_one_query_are_one_query(spark):
    docs = [(i, f"common w{i % 7} w{i}") for i in range(40)]
    shards = search.index(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = [(1, "w3"), (1, "w3"), (1, "w5 w12"), (2, "common")]
    got = sorted((r[0], r[1], r[2]) for r in search.top_k(shards, spark.createDataFrame(asked, "item_id long, text string"), k=10).collect())
    assert got == [w[:3] for w in bm25(docs, [(1, "w3 w5 w12"), (2, "common")], 10)]


def test_blocks_beyond_the_bound_are_not_scored():
    """Only one block holds documents that can enter; scores of the others are never computed."""
    n, block = 64 * 200, 64
    docs = np.arange(n)
    counts = np.where((docs >= 64 * 3) & (docs < 64 * 4), 9, 1)
    starts = np.arange(0, n, block)
    tops = np.maximum.reduceat(counts, starts).astype(float)
    lists = [search.Postings(docs, counts, starts, tops, lambda f, d: f.astype(float)) for _ in range(2)]
    found = search.search_shard(lists, 10)
    assert found == [(18.0, 64 * 3 + i) for i in range(10)]
    assert all(c.scored <= 4 for c in lists)


def test_shards_are_stored_and_read_one_by_one(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(search, "SHARD", 400)
    docs = [(k, " ".join(f"w{(k * j) % 17}" for j in range(1, 12))) for k in range(90)] + [(90, None), (None, "w1 w2")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    shards = search.stored_index(df)
    groups = [m.row_group(g).num_rows for f in shards.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(m.num_row_groups)]
    assert len(groups) > 4 and set(groups) == {1}
    asked = spark.createDataFrame([(k, f"w{k} w{k + 3}") for k in range(5)], "item_id long, text string")
    assert sorted(map(tuple, search.top_k(shards, asked).collect())) == sorted(map(tuple, search.top_k(search.index(df), asked).collect()))


def test_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline

    from tripleframe.session import cut

    long = "x " * 5000
    rows = [
        (1, "hello world moron", None, None, None), (1, "hello world moron", None, None, None), (None, None, "en", "s", 0), (None, "", "en", None, 0),
        (2, long, "en", "s", 10000), (None, long, "en", "s", 10000), (3, long, "en", "s", 10000), (7, "password = abcdef123 ok", "de", "t", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("component_id", "_row", "spans", "taken", "size", "fingerprint", "_copies", "digest", "score", "ids"):
        df = df.selectExpr("*", f"'z' AS {c}")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = {}
    docs = df
    for name, stage in corpus_pipeline.STAGES:
        docs = held[name] = cut(stage(spark, docs, str(tmp_path)))
        assert name == "pieces" or docs.columns == df.columns
    # No label says anything: nothing is toxic. One row of each group stays, null and empty texts are one group.
    assert held["toxicity"].count() == len(rows)
    left = sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in held["simhash"].collect()), key=repr)
    assert left == sorted([(1, "hello"), (2, "x x x"), (7, "passw"), (None, "")], key=repr)
    assert {r["text"] for r in held["secrets"].collect() if r["doc_id"] == 7} == {"[assign] ok"}
    assert {r["n_chars"] for r in held["secrets"].collect() if r["doc_id"] == 7} == {11}
    copies = Counter(r["doc_id"] for r in held["mixing"].collect())
    assert all(n <= 3 for n in copies.values()) and set(copies) <= {1, 2, 7, None}
    for r in held["pieces"].collect():
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    nothing = df.where("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        nothing = cut(stage(spark, nothing, str(tmp_path)))
    assert nothing.count() == 0
