"""Repeated byte strings against a brute-force cover."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tripleframe.llm import suffixes


def brute(rows, length):
    first = {}
    for i, t in rows:
        b, k = (t or "").encode(), suffixes.NO_ID if i is None else i
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, suffixes.NO_ID), k)
    out = []
    for i, t in rows:
        b, k = (t or "").encode(), suffixes.NO_ID if i is None else i
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < k:
                gone[s : s + length] = b"\1" * length
        spans = [(s, next((e for e in range(s, len(b)) if not gone[e]), len(b))) for s in range(len(b)) if gone[s] and (s == 0 or not gone[s - 1])]
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def corpus(seed=4):
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abcdé ") for _ in range(3000))
    rows = [(None, base[:300]), (None, base[:300]), (5, None), (6, ""), (7, "a" * 400), (3, "a" * 120 + "b" * 60), (9, base), (2, base[500:900]), (9, base[400:1000])]
    for _ in range(50):
        a = rnd.randrange(2900)
        t = base[a : a + rnd.randrange(400)]
        if rnd.random() < 0.5:
            j = rnd.randrange(len(t) + 1)
            t = t[:j] + "X" + t[j:]
        rows.append((100 + rnd.randrange(200), t + "".join(rnd.choice("xyz") for _ in range(rnd.randrange(80)))))
    return rows


@pytest.mark.parametrize(("length", "block", "piece"), [(50, 2 << 20, 1 << 15), (20, 700, 97)])
def test_cover(spark, monkeypatch, length, block, piece):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS kept", "2 AS spans").repartition(3)
    got = [(r[0], r[1], r[2], [tuple(s) for s in r[3]], bytes(r[4])) for r in suffixes.remove_repeats(df, length=length).collect()]
    assert sorted(got, key=repr) == brute(rows, length)
    assert suffixes.remove_repeats(df.where("1 = 0"), length=length).collect() == []


def test_intervals_are_the_repeated_strings():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 400).astype(np.uint8)
    starts = np.arange(0, 390)
    rows, interval = suffixes.intervals(text, starts, 6)
    groups = {}
    for r, i in zip(rows, interval, strict=True):
        groups.setdefault(i, set()).add(int(starts[r]))
    by_string = {}
    for s in starts.tolist():
        by_string.setdefault(text[s : s + 6].tobytes(), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in by_string.values() if len(v) > 1)
