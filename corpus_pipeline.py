"""A corpus pipeline of the text operators.

Toxic documents go, one document of each group of near copies stays, secrets are masked, sources are mixed to their target
weights, and what is left is coded into pieces. Each stage works on all rows that its predecessor kept. Extra columns are
carried to the last stage, whatever their names; null texts stay null until they are coded as empty texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleframe.llm import mixing, pieces, secrets, shingles, toxicity
from tripleframe.llm.common import packed, remainder, table
from tripleframe.llm.queries import digests, piece_model
from tripleframe.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut; learned from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    machine = toxicity.fit(docs, labels)
    scored = toxicity.score(packed(docs, "text"), machine)
    return scored.where(F.col("score") < toxicity.CUT).select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of rows whose texts have similar sets of five-word shingles, that of the smallest id; different texts of one id are judged apart.

    SimHash names the first pairs, an index over shingles those that it misses; all are verified on whole sets.
    """
    # Rows without an id get one behind all others, by their text; rows of one id are told apart by their texts' digests.
    behind = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    keyed = packed(docs, "doc_id", "text").withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), behind))
    told = keyed.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = told.select("doc_id", "digest", F.xxhash64("text").alias("_tie"), "_row")
    kept = rows.join(shingles.kept_rows(told.select("doc_id", "digest", "text")), ["doc_id", "digest"], "left_semi")
    return kept.groupBy("doc_id", "digest").agg(F.min_by("_row", "_tie").alias("_row")).select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``[kind]`` in the place of each secret and the length in ``n_chars`` that follows."""
    scanned = secrets.scan(packed(docs, "text"), keep_text=True)
    clean = secrets.mask(F.col("text"), F.col("spans"))
    row = F.col("_row").withField("text", clean).withField("n_chars", F.when(F.size("spans") > 0, F.length(clean).cast("long")).otherwise(F.col("_row.n_chars")))
    return scanned.select(row.alias("_row")).select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at least once if it takes part of it; documents without words stay once."""
    named = packed(docs, "doc_id", "source", "text").withColumn("_digest", mixing.digest())
    placed, mixed = mixing.mix(named)
    taken = mixing.taken_per_document(placed, mixed)
    # Rows of equal digest are equal in id and text and share what the mix takes of them.
    each = taken.groupBy(F.col("digest").alias("_digest")).agg((F.sum("taken") / F.count(F.lit(1))).alias("_taken"), F.max("size").alias("_size"))
    copies = F.when(F.col("_size") == 0, 1).when(F.col("_taken") == 0, 0).otherwise(F.greatest(F.lit(1), F.round(F.col("_taken") / F.col("_size"))))
    chosen = named.join(each.withColumn("_copies", copies.cast("int")).where("_copies > 0"), "_digest")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def code_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, piece ids and their digests for every row."""
    return digests(pieces.encode_documents(docs.select("doc_id", "text"), piece_model()), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("pieces", code_pieces),
]

#: SQL cannot express the trained scores; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
