"""Near copies of the pipeline's stage against all pairs."""

from __future__ import annotations

import itertools
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripleframe.llm import lists, shingles
from tripleframe.llm.common import table

from .helpers import SMALL, parts


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Smallest ids of the groups of rows with distinct ids."""
    sets = [(i, grams(t)) for i, t in rows]
    alike = lambda x, y: x == y or 5 * len(x & y) >= 4 * len(x | y)
    least = parts({i for i, _ in sets}, [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if alike(x, y)])
    return sorted(set(least.values()))


def edited(rnd, words, edits):
    out = list(words)
    for at in rnd.sample(range(len(out)), edits):
        out[at] = f"new{rnd.randrange(10**9)}"
    return " ".join(out)


@pytest.mark.parametrize("chunk, buckets", [(3, 1 << 10), (1024, 1 << 20)])
def test_near_copies_of_any_size_and_chains(spark, tmp_path, monkeypatch, chunk, buckets):
    monkeypatch.setattr(lists, "CHUNK", chunk)
    monkeypatch.setattr(shingles, "BUCKETS", buckets)
    monkeypatch.setattr(shingles, "CHUNK", buckets // 4)
    monkeypatch.setattr(shingles, "TOGETHER", 2)
    rnd = random.Random(4)
    rows = [(1, None), (2, ""), (3, "one"), (4, "One two"), (5, "x " * 3000), (6, "x " * 2999)]
    passage = [f"p{k}" for k in range(60)]
    for size, edits in [(50, 1), (100, 1), (200, 4), (400, 4), (1000, 4), (120, 5), (30, 1)] * 3:
        base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        rows += [(len(rows) + 1, " ".join(base)), (len(rows) + 2, edited(rnd, base, edits)), (len(rows) + 3, " ".join(passage + base[size // 2 :]))]
    base = [f"c{k}" for k in range(300)]  # a chain whose ends are apart, and copies of one text that are apart from each other
    for k in range(12):
        rows.append((len(rows) + 1, " ".join(base)))
        base = edited(rnd, base, 5).split()
    rows += [(len(rows) + 1 + k, edited(rnd, [f"d{j}" for j in range(200)], 4)) for k in range(25)]
    rows += [(len(rows) + 1, " ".join(f"d{j}" for j in range(200)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, str(tmp_path)).collect()]
    assert sorted(got) == brute(rows)
    assert len(got) < len(rows) - 40


def test_table(spark):
    docs = table(spark, SMALL, "documents").where("doc_id < 600").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()) == brute(rows)


def test_texts_of_one_id_are_judged_apart(spark, tmp_path):
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcd"]
    rows = [(2, texts[0]), (5, texts[0]), (5, texts[1]), (9, texts[1]), (7, texts[2]), (7, texts[2]), (7, texts[3]), (None, texts[3]), (8, None), (8, "")]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert sorted((r["doc_id"], r["text"] or "") for r in got.collect()) == [(2, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3]), (8, "")]


def listed_pairs(spark, monkeypatch, rows, tmp_path):
    """Kept ids, and the number of pairs that are listed one by one."""
    seen = []
    meet = shingles.meet
    monkeypatch.setattr(shingles, "meet", lambda *a: (lambda df: (seen.append(df.count()), df)[1])(meet(*a)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, str(tmp_path)).collect()), seen[0]


def test_groups_that_are_only_similar_list_no_pairs(spark, monkeypatch, tmp_path):
    rnd = random.Random(6)
    base = [f"b{k}" for k in range(200)]
    # Two such texts share 0.7 of their union at most; every text has words of its own.
    rows = [(k, edited(rnd, base, 8)) for k in range(200)]
    kept, pairs = listed_pairs(spark, monkeypatch, rows, tmp_path)
    assert kept == brute(rows) and len(kept) > 150
    assert pairs < 200


def test_large_groups_at_the_threshold(spark, monkeypatch, tmp_path):
    rnd = random.Random(7)
    base = [f"b{k}" for k in range(200)]
    rows = [(k, edited(rnd, base, 1 + k % 7)) for k in range(150)]
    kept, pairs = listed_pairs(spark, monkeypatch, rows, tmp_path)
    assert kept == brute(rows)
    assert pairs < 150 * 149 / 2


def test_links_of_a_large_group_are_not_listed_pair_by_pair(spark, monkeypatch, tmp_path):
    rnd = random.Random(10)
    base = [f"b{k}" for k in range(200)]
    # Some of the pairs are alike, and tie all texts but a few.
    rows = [(k, edited(rnd, base, 3)) for k in range(250)]
    seen = []
    meet = shingles.meet
    monkeypatch.setattr(shingles, "meet", lambda *a: (lambda df: (seen.append((a[0].count(), df.count())), df)[1])(meet(*a)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, str(tmp_path)).collect())
    assert kept == brute(rows) and len(kept) < 50
    assert all(listed <= entries for entries, listed in seen)
    assert seen[-1][1] < 1000


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(1)
    for n in (5, 300, 5000):
        a = np.unique(rng.integers(0, 1 << 62, n))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 62, n // 3)]))
        differ = int.from_bytes(shingles.parity(a), "big") ^ int.from_bytes(shingles.parity(b), "big")
        assert differ.bit_count() <= len(np.setxor1d(a, b))


def test_frequencies_count_documents(spark):
    rows = [(k, f"a b c d e f{k % 3}") for k in range(30)] + [(30, None)]
    counts = np.frombuffer(shingles.frequencies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), np.uint32)
    assert counts.sum() == 60 and sorted(counts[counts > 0].tolist()) == [10, 10, 10, 30]


def test_simhash_names_the_first_pairs(spark, monkeypatch, tmp_path):
    rnd = random.Random(8)
    base = [f"b{k}" for k in range(2000)]
    rows = [(k, edited(rnd, base, 1)) for k in range(12)] + [(50, " ".join(base)), (51, "b1 b2")]
    calls = []
    close = shingles.close
    monkeypatch.setattr(shingles, "close", lambda prints: (lambda df: (calls.append(df.count()), df)[1])(close(prints)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, str(tmp_path)).collect())
    assert got == brute(rows) == [0, 51]
    assert calls and calls[0] > 0


def test_pairs_behind_simhash_stars_are_held_against_each_other(spark):
    rnd = random.Random(12)
    texts = [[f"w{rnd.randrange(10**6)}" for _ in range(80)] for _ in range(3)]
    texts = [" ".join(texts[0]), " ".join(texts[1]), edited(rnd, texts[1], 1), " ".join(texts[2])]
    # The star ties 1 and 2 to 0, which is like neither; 1 and 2 differ in three bits, 0 and 2 in six.
    prints = [0, 0b111, 0b111111, -1]
    shingle = shingles.Shingles()
    rows = [(k, prints[k], len(shingle(t)), shingles.parity(shingle(t))) for k, t in enumerate(texts)]
    facts = spark.createDataFrame(rows, "node long, fingerprint long, size int, bits binary")
    links = shingles._close_links(facts, shingles._sets(spark.createDataFrame(list(enumerate(texts)), "node long, text string")))
    assert sorted(map(tuple, links.collect())) == [(1, 2)]


def test_the_stage_leaves_only_its_result_on_the_disk(spark, monkeypatch, tmp_path):
    rnd = random.Random(13)
    base = [[f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(20)]
    rows = [(3 * k + j, edited(rnd, base[k], j)) for k in range(20) for j in range(3)]
    written = []
    first = shingles.cut
    monkeypatch.setattr(shingles, "cut", lambda *a: (lambda df: (written.append((df.columns, df.inputFiles())), df)[1])(first(*a)))
    kept = shingles.kept_rows(spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.md5("text")).repartition(3))
    left = [columns for columns, files in written if any(os.path.exists(f.removeprefix("file://")) for f in files)]
    assert len(written) > len(left) and not {"text", "set", "head", "bits", "counts"} & {c for columns in left for c in columns}
    assert sorted(r["doc_id"] for r in kept.collect()) == brute(rows)


def test_a_worker_keeps_what_it_learnt():
    from tripleframe.llm.common import held

    made = []
    assert held(("test", 1), lambda: made.append(1) or made) is held(("test", 1), lambda: made.append(2) or [])
    assert made == [1]


@pytest.mark.parametrize("sent, join", [(shingles.SHINGLE, "SortMergeJoin"), (1 << 19, "BroadcastHashJoin")])
def test_only_the_sets_that_pairs_name_are_shuffled(spark, monkeypatch, sent, join):
    monkeypatch.setattr(shingles, "SENT", sent)
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(50)]
    texts[7], texts[9] = edited(rnd, texts[3].split(), 1), edited(rnd, texts[4].split(), 1)
    sets = shingles._sets(spark.createDataFrame(list(enumerate(texts)), "node long, text string")).cache()
    pairs = spark.createDataFrame([(3, 7), (9, 4), (1, 2), (5, 3)], "a long, b long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = shingles._named_sets(pairs, sets)
        assert sorted(r["node"] for r in named.collect()) == [1, 2, 3, 4, 5, 7, 9]
        assert any(join in line and "LeftSemi" in line for line in named._jdf.queryExecution().executedPlan().toString().splitlines())
        assert sorted(map(tuple, shingles._verified(pairs, sets).collect())) == [(3, 7), (9, 4)]
        assert shingles._verified(pairs.where("a < 0"), sets).collect() == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        sets.unpersist()


def test_tasks_that_need_the_memory_drop_what_others_left():
    from tripleframe.llm.common import forget, held

    made = []
    held(("test", 2), lambda: made.append(1) or made)
    forget()
    held(("test", 2), lambda: made.append(2) or made)
    assert made == [1, 2]
