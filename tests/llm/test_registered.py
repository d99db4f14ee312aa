"""The registered queries: contract columns, whole tables, and SQL where there is some."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from tripleframe.llm.queries import ORACLES, QUERIES

from .helpers import FOLDER

COLUMNS = {
    1: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    2: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    3: ["doc_id", "fingerprint", "component_id"],
    4: ["vec_id", "n_links", "component_id", "kept"],
    5: ["doc_id", "held_out", "lang_pred", "score"],
    6: ["page_id", "url", "text", "n_chars"],
    7: ["doc_id", "size", "source_size", "target", "taken"],
    8: ["doc_id", "held_out", "score", "predicted"],
    9: ["item_id", "rank", "doc_id", "score"],
    10: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    11: ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"],
    12: ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    13: ["page_id", "host", "path", "rule", "verdict"],
}


def number(name):
    return int(name[2:].split("_")[0])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES, key=number))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    assert df.columns == COLUMNS[number(name)]
    found = [tuple(r) for r in df.collect()]
    if number(name) not in (9, 12):
        whole = {4: "embeddings", 6: "pages", 13: "pages"}.get(number(name), "documents")
        assert len(found) == spark.read.parquet(f"{FOLDER}/{whole}.parquet").count()
    if name in ORACLES:
        # Values are compared as text: equal numbers of both engines print alike.
        want = duck.sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
        assert sorted(map(repr, want)) == sorted(map(repr, found))


def test_pipeline_is_its_stages_by_brute_force(spark):
    import corpus_pipeline

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "secrets", "mixing", "pieces"]
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    import sentencepiece

    from tripleframe.llm.queries import piece_model

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert rows and {r["doc_id"] for r in rows} <= set(texts)
    plain = 0
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "")
        if ids == r["ids"]:  # a document without secrets
            plain += 1
            assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert plain >= 0.9 * len(rows)
