"""SimHash, vectors and components against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tripleframe.llm import components, lists, simhash, vectors
from tripleframe.llm.common import table

from .helpers import SMALL, parts


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[j : j + 3]) for j in range(max(1, len(words) - 2))] if words else []
    count = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        count += [(h >> k) & 1 for k in range(64)]
    return sum(1 << k for k in range(64) if shingles and count[k] * 2 > len(shingles))


def test_any_five_positions_hold_a_list():
    import itertools

    chosen = simhash.combinations()
    assert all(any(set(c) <= set(s) for c in chosen) for s in itertools.combinations(range(8), 5))


def brute(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    edges = [(a, b) for n, (a, x) in enumerate(prints) for b, y in prints[:n] if (x ^ y).bit_count() <= 3]
    least = parts({i for i, _ in prints}, edges)
    return sorted((i, f"{x:016x}", least[i]) for i, x in prints)


def test_table(spark):
    docs = table(spark, SMALL, "documents").where("doc_id < 400").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_odd_rows_and_long_lists(spark, monkeypatch, chunk):
    monkeypatch.setattr(lists, "CHUNK", chunk)
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    base = [rnd.choice(words) for _ in range(300)]
    rows = [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "One two"), (1005, "x " * 30000), (1005, "x " * 30000), (1006, "x " * 29999)]
    for k in range(60):
        t = list(base)
        t[rnd.randrange(300)] = "new"
        rows.append((k, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert simhash.near_duplicates(df.where("1 = 0")).collect() == []


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (None, "d e f g")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (None, None)], key=repr)


def test_components_of_paths_and_hubs(spark):
    rnd = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200 + rnd.randrange(50), 200 + rnd.randrange(50)) for _ in range(40)] + [(7, 7)]
    rnd.shuffle(edges)
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == parts(nodes, [e for e in edges if e[0] != e[1]])


def _vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(300)]
    at = 300
    for k in range(0, 60):
        base = np.array(rows[k][1]) / np.linalg.norm(rows[k][1])
        other = rng.normal(size=16)
        other -= base * (other @ base)
        other /= np.linalg.norm(other)
        cosine = rng.uniform(0.88, 0.93)
        rows.append((at, (3.0 * (cosine * base + np.sqrt(1 - cosine**2) * other)).tolist()))
        at += 1
    rows += [(at + k, rows[5][1]) for k in range(7)] + [(at + 10, [2 * x for x in rows[5][1]])]
    return rows


def _brute(rows, threshold=0.9):
    x = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    ids = sorted(x)
    m = np.stack([x[i] for i in ids])
    hit = m @ m.T >= threshold
    return ids, hit


def test_vectors_recall_at_the_threshold(spark):
    rows = _vectors()
    got = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()}
    ids, hit = _brute(rows)
    links = hit.sum(1) - 1
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= links).all()
    assert found.sum() >= 0.9 * links.sum()


def test_vectors_that_link_with_nothing(spark):
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (10, [1e-200, 2e-200]), (11, [1e200, 2e200])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS n_links")
    got = {(r["vec_id"]): (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(df).collect()}
    assert got == {**{k: (0, k, True) for k in (1, 2, 3, 4, 5, 6, 9)}, 7: (4, 7, True), 8: (4, 7, False), None: (4, 7, False), 10: (4, 7, False), 11: (4, 7, False)}
    assert vectors.near_duplicates(df.where("1 = 0")).collect() == []


def test_rows_of_one_id_with_different_vectors_are_apart(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [1.0, 0.0]), (None, [0.0, 1.0]), (5, None)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = [(1, 0 + 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (5, 0, 5, True), (None, 1, 1, False)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
