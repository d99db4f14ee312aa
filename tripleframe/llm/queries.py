"""The registered queries of this subpackage, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleframe.llm import align, langid, mixing, negatives, pages, pieces, search, secrets, simhash, suffixes, toxicity, urls, vectors
from tripleframe.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The public tokenizer of the encoding query; the package that holds its file is installed on every machine.
PIECE_MODEL = "piece_bpe_32k.model"
#: The tokenizer that the alignment query holds against it.
BYTE_MODEL = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    """Register a query by name; ``sql`` gives the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def piece_model(name: str = PIECE_MODEL) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(coded: DataFrame, *more: str) -> DataFrame:
    """Number and hash of the ids of each document, and hash of the text decoded from them; ``more`` columns follow."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )


@query("op1_repeated_bytes")
def op1_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of each document, those removed as repeats of documents with smaller ids, and a hash of the rest."""
    cleaned = suffixes.remove_repeats(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Number of secrets of each base kind in each document, a hash of their places, and the places of all kinds."""
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.filter("spans", secrets.of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(secrets.told(base).cast("binary"), 256).alias("base_sha256"), secrets.told(F.col("spans")).alias("spans"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of each document and the smallest document that is reached from it over links."""
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")


@query("op4_vectors", """
WITH v AS (
  SELECT vec_id, CASE WHEN list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reached AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a)
  SELECT a, min(b) AS least FROM r GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = vec_id LEFT JOIN reached ON reached.a = vec_id
""")
def op4_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Number of links of each vector and the smallest vector that is reached from it over links."""
    return vectors.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each document; learned from documents whose id's CRC-32 does not leave 2 modulo 4."""
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    net = langid.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), net)


@query("op6_main_text")
def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of each page."""
    crawl = table(spark, folder, "pages").select("page_id", "url", "html")
    found = pages.extract(crawl, pages.fit(crawl))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op7_mix_sources", """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER ahead, 0) AS DOUBLE)
            / (sum(w) OVER () - coalesce(sum(w) OVER ahead, 0)) AS level
  FROM sources
  WINDOW ahead AS (ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * coalesce(first_value(
           CASE WHEN level <= 3 * source_size / w THEN level END IGNORE NULLS) OVER (
             ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0)) AS target
  FROM levels
), goals AS (
  SELECT source, CAST(round(target) AS BIGINT) AS goal FROM targets WHERE round(target) > 0
), ends AS (
  SELECT source, goal, CAST(sum(goal) OVER (ORDER BY source IS NULL, source ROWS UNBOUNDED PRECEDING) AS BIGINT) AS up_to FROM goals
), whole AS (
  SELECT CAST(coalesce(sum(goal), 0) AS BIGINT) AS total, greatest(1, least(1024, (total + 65535) // 65536)) AS block FROM goals
), points AS (
  SELECT slot, list_sum(list_transform(range(40), lambda i: CAST((slot >> CAST(i AS INT)) & 1 AS DOUBLE) / pow(2, i + 1))) * total AS x
  FROM (SELECT total, unnest(range((total + block - 1) // block)) AS slot FROM whole)
), slots AS (
  SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM points JOIN ends ON x >= up_to - goal AND x < up_to
), counts AS (SELECT source, count(*) AS n FROM slots GROUP BY source
), placed AS (
  SELECT row_number() OVER () AS r, doc_id, sized.source, size, source_size, target, coalesce(n, 0) AS n,
         CAST(coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
  LEFT JOIN counts ON sized.source IS NOT DISTINCT FROM counts.source
), laid AS (
  SELECT r, source, turn * source_size + start AS a, least(turn * source_size + start + size, n * block) AS b, block
  FROM placed, whole, (SELECT unnest(range(3)) AS turn)
), pieces AS (
  SELECT r, source, a, b, block, unnest(range(a // block, (b - 1) // block + 1)) AS rank FROM laid WHERE b > a
), taken AS (
  SELECT r, sum(least(b, (rank + 1) * block) - greatest(a, rank * block)) AS taken, min(slot) AS first_slot, count(*) AS n_pieces
  FROM pieces JOIN slots USING (rank) WHERE pieces.source IS NOT DISTINCT FROM slots.source GROUP BY r
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_slot, coalesce(n_pieces, 0) AS n_pieces
FROM placed LEFT JOIN taken USING (r)
""")
def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Size of each document, size and target of its source, the words that the scheduled blocks take of it, and where it comes first."""
    placed, mixed = mixing.mix(table(spark, folder, "documents"))
    return mixing.taken_per_document(placed, mixed).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_pieces")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of each document; learned from labels whose id's CRC-32 does not leave 1 modulo 3."""
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    machine = toxicity.fit(docs, table(spark, folder, "labels").where(~held_out))
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), machine)
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


@query("op9_search", """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')) AS term FROM documents
), bags AS (SELECT doc_id, term, count(*) AS f FROM words GROUP BY ALL
), lengths AS (SELECT doc_id, sum(f) AS n FROM bags GROUP BY doc_id
), stats AS (SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM words) / (SELECT count(*) FROM documents) AS mean
), held AS (SELECT term, count(*) AS n_t FROM bags GROUP BY term
), asked AS (
  SELECT item_id, term, count(*) AS q
  FROM (SELECT item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')) AS term FROM benchmark WHERE item_id % 20 = 0)
  GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, round(sum(q * ln(1 + (total - n_t + 0.5) / (n_t + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * n / mean))), 9) AS score
  FROM asked JOIN held USING (term) JOIN bags USING (term) JOIN lengths USING (doc_id), stats GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10
""")
def op9_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of all documents for each benchmark passage whose id is divisible by 20."""
    shards = search.stored_index(table(spark, folder, "documents"))
    asked = table(spark, folder, "benchmark").where("item_id % 20 = 0")
    found = search.top_k(shards, asked)
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", F.round("score", 6).alias("score"))


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Number of pieces of each document, hashes of its ids, of the text decoded from them, and of the byte spans of its pieces."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.encode_documents(docs, piece_model(), bounds=True)
    return digests(coded.withColumn("spans_xxh64", F.lower(F.hex(F.xxhash64("starts", "ends")))), "spans_xxh64")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of either tokenizer, groups and links of each document, how its links compare corpus-wide, and a hash of the groups."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("long"), "text")
    told = align.align(docs, piece_model(BYTE_MODEL), piece_model())
    return told.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


@query("op12_hard_negatives", """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r
), positives AS (
  SELECT a, anchor_id, b, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.a = s.a AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.a, p.b ORDER BY score DESC, id NULLS LAST)
QUALIFY row_number() OVER best <= 3
""")
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The three hardest rows of other labels for each anchor and each of its five best rows of its own label."""
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


#: The rules of the URL query.
URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]
_BY_LENGTH = sorted(URL_RULES, key=lambda r: -len(r.name))


def _first_rule(value: str) -> str:
    arms = [f"WHEN ends_with('.' || host, '.{r.host}') AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'" for r in _BY_LENGTH]
    return f"CASE {' '.join(arms)} END"


def _number_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _cut_sql(source: str, *more: str) -> str:
    host = "translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's')"
    return f"SELECT {', '.join(more)}, {host} AS host, {path} AS path FROM {source}"


def _terms_sql(source: str, key: str) -> str:
    return f"""
  SELECT DISTINCT {key}, {_number_sql("substr(s, CAST(i AS INT), CAST(n AS INT))")} % {urls.BUCKETS} AS b
  FROM (SELECT {key}, host || path AS s FROM {source}) CROSS JOIN (SELECT unnest({list(urls.SIZES)}) AS n), unnest(range(1, length(s) - n + 2)) AS u(i)
  UNION ALL SELECT {key}, {urls.BUCKETS} FROM {source}"""


@query("op13_url_filter", f"""
WITH RECURSIVE words AS (
  SELECT unnest({_listed(urls.BLOCKED)}) AS word, 1 AS blocked UNION ALL SELECT unnest({_listed(urls.ORDINARY)}), 0
), mates AS (SELECT unnest({_listed(urls.EITHER)}) AS e, TRUE AS free UNION ALL SELECT unnest({_listed(urls.ORDINARY)}), FALSE
), names AS (
  SELECT blocked, word AS name FROM words
  UNION ALL SELECT blocked, CASE WHEN {_number_sql("e || ' ' || word")} % 2 = 0 THEN word || '-' || e ELSE e || '-' || word END
  FROM words JOIN mates ON e <> word AND (free OR blocked = 0) AND {_number_sql("word || ' ' || e")} % 2 = 0
), labelled AS (
  SELECT row_number() OVER (ORDER BY name) AS r, blocked AS y,
         'https://' || {_listed(urls.FIRST)}[h % 4 + 1] || name || {_listed(urls.ENDS)}[h // 16 % 3 + 1] || {_listed(urls.PATHS)}[h // 256 % 5 + 1] AS url
  FROM (SELECT *, {_number_sql("name")} AS h FROM names)
), known AS ({_cut_sql("labelled", "r", "y")}
), held AS ({_terms_sql("known", "r")}
), sizes AS (SELECT r, 1 / sqrt(count(*)) AS v FROM held GROUP BY r
), w AS (
  SELECT 0 AS step, b, 0.0::DOUBLE AS weight FROM (SELECT DISTINCT b FROM held)
  UNION ALL
  SELECT w.step + 1, w.b, w.weight * (1 - {urls.RATE * urls.DECAY}) - {urls.RATE} / (SELECT count(*) FROM labelled) * g.gradient
  FROM w JOIN (
    SELECT held.b, sum(e.error) AS gradient
    FROM held JOIN (
      SELECT known.r, any_value(v) * (1 / (1 + exp(-any_value(v) * sum(w.weight))) - any_value(y)) AS error
      FROM w JOIN held USING (b) JOIN sizes USING (r) JOIN known USING (r) GROUP BY known.r
    ) e USING (r) GROUP BY held.b
  ) g USING (b) WHERE w.step < {urls.STEPS}
), crawl AS ({_cut_sql("pages", "page_id", "row_number() OVER () AS k")}
), seen AS ({_terms_sql("crawl", "k")}
), scored AS (
  SELECT k, sum(coalesce(weight, 0)) / sqrt(count(*)) AS logit
  FROM seen LEFT JOIN (SELECT b, weight FROM w WHERE step = {urls.STEPS}) USING (b) GROUP BY k
)
SELECT page_id, host, path, {_first_rule("name")} AS rule,
       coalesce({_first_rule("verdict")}, CASE WHEN logit > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM crawl JOIN scored USING (k)
""")
def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path and verdict of each page's URL: of the longest rule that fits, or of the regression."""
    weights = urls.fit(urls.labelled_urls(spark))
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), weights, URL_RULES).select("page_id", "host", "path", "rule", "verdict")
