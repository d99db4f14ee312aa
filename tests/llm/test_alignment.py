"""Alignment of two tokenizers against a plain walk over bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripleframe.llm import align
from tripleframe.llm.common import table
from tripleframe.llm.queries import BYTE_MODEL, piece_model

from .helpers import FOLDER


def by_sets(a, b):
    """Groups of two lists of ends: tokens between neighbouring common ends."""
    both = sorted(set(a) & set(b))
    return [sum(e < x for e in both) for x in a], [sum(e < x for e in both) for x in b]


@pytest.mark.parametrize("width", [1, 2, 3, 7, 64])
def test_pieces_of_any_width_give_the_same_groups(width):
    rnd = random.Random(width)
    for _ in range(60):
        size = rnd.randrange(1, 90)
        a, b = (sorted({size, *rnd.sample(range(1, size + 1), rnd.randrange(size))}) for _ in range(2))
        of_a, of_b, x, y = align.merge(np.array(a), np.array(b), width)
        assert (of_a.tolist(), of_b.tolist()) == by_sets(a, b)
        starts = [0, *a], [0, *b]
        touch = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
        assert sorted(zip(x.tolist(), y.tolist(), strict=True)) == touch
        assert len(touch) == len(a) + len(b) - of_a[-1] - 1
    assert [len(v) for v in align.merge(np.empty(0, np.int64), np.empty(0, np.int64), width)] == [0] * 4


def test_diagonals_are_places_of_the_merge():
    a, b = np.array([1, 3, 3, 8]), np.array([2, 3, 9])
    order = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
    steps = np.arange(len(order) + 1)
    assert align.diagonals(a, b, steps).tolist() == [sum(side == 0 for _, side in order[:n]) for n in steps]


def brute(rows):
    coders = align.Coders(piece_model(BYTE_MODEL), piece_model())
    docs, holders = [], Counter()
    for key, text in rows:
        data = (" " + (text or "")).encode()
        a = coders.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = coders.b.encode(text) if text else []
        if b"".join(coders.bytes_a[i] for i in a) != data or b"".join(coders.bytes_b[i] for i in b) != data or not text:
            docs.append((key, 0, 0, [], Counter()))
            continue
        groups, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if j == len(b) or (i < len(a) and at_a <= at_b):
                at_a += len(coders.bytes_a[a[i]])
                groups[-1][0].append(a[i])
                i += 1
            else:
                at_b += len(coders.bytes_b[b[j]])
                groups[-1][1].append(b[j])
                j += 1
            if at_a == at_b and (i < len(a) or j < len(b)):
                groups.append(([], []))
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        holders.update(links.keys())
        docs.append((key, len(a), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for key, n_a, n_b, groups, links in docs:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in links.items() if holders[p] == most[p[0]])
        total = sum(n * holders[p] for p, n in links.items())
        out.append((key, n_a, n_b, len(groups), sum(links.values()), best, total, hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return out


def compare(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = align.align(df, piece_model(BYTE_MODEL), piece_model())
    found = [tuple(r) for r in got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)
    return found


@pytest.mark.parametrize("large", [0, 3, 256])
def test_odd_texts(spark, monkeypatch, large):
    monkeypatch.setattr(align, "LARGE", large)
    monkeypatch.setattr(align, "CHUNK", 5)
    odd = [None, "", " ", "  two  spaces ", "a▁b", "<s> </s> <|endoftext|> <0x41>", "日本語のテキスト", "ä ö ü\n\ttab\r\n", "😀😀 é", "x" * 3000, "\0 nul", "aaaa " * 400]
    rows = [(k, t) for k, t in enumerate(odd)] + [(None, "ids may be null"), (5, "same id"), (5, "same id"), (6, "日本語のテキスト")]
    found = {r[0]: r for r in compare(spark, rows)}
    assert found[4][1:] == (0, 0, 0, 0, 0, 0, "") and found[6][1] > 0


def test_both_libraries_code_alike():
    fast, own = (align.Coders(piece_model(BYTE_MODEL), piece_model(), ranked) for ranked in (True, False))
    assert fast.ranked is not None
    rnd = random.Random(3)
    signs = [" ", "  ", "\t", "\r\n", "\x85", "\u2003", "'s", "'S", "’s", "a", "B", "é", "日本", "٣", "Ⅷ", "²", "😀", "\u200d", "!", "<|endoftext|>", "\0", "\u0301", "1"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 15))) for _ in range(3000)]
    assert fast.code(texts) == own.code(texts)


def test_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    assert all(r[1] > 0 for r in compare(spark, rows) if r[3])


def test_empty_table_and_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(none, piece_model(BYTE_MODEL), piece_model()).count() == 0
    odd = spark.createDataFrame([(1, "a b", 2, "x", 4, "y")], "doc_id long, text string, block int, _row string, n_a int, pairs string")
    got = align.align(odd, piece_model(BYTE_MODEL), piece_model())
    assert got.columns == ["doc_id", "block", "_row", "pairs", *align.RESULTS]
    assert got.first()[:4] == (1, 2, "x", "y")
    assert align.align(odd.select("text"), piece_model(BYTE_MODEL), piece_model()).columns == align.RESULTS
