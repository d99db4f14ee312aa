"""Exact top-k search by BM25 over an inverted index with block-max WAND pruning.

Texts become terms: runs of letters and digits in lower case. Documents are indexed in shards; a shard is a row that holds the
postings of all its terms, in blocks of ``BLOCK`` documents, and of each block the largest count of the term and the
smallest length of a document, which bound every score in it. Document frequencies of the query's terms, the number of
documents and their mean length are gathered over all shards, so every shard scores with the statistics of the whole
collection. In a shard the cursors of a query's terms move through the blocks: the sum of the terms' largest scores names
the first document that could enter the top k (the pivot), the largest scores of the blocks around it decide whether it is
scored or whole blocks are passed over; a block is decoded when a cursor stops in it and scored when a document of it is.
Shards are searched independently and their lists merged, which is exact.

Score of a document for a query: sum over distinct query terms t, times their count in the query, of
``log(1 + (N - n_t + 0.5) / (n_t + 0.5)) * f * (k1 + 1) / (f + k1 * (1 - b + b * length / mean length))``. Documents that hold no
term of a query are not returned for it. Ties go to the smaller id; a null id sorts last. Null and empty texts are empty
documents: they count in N and match nothing. Repeated rows are documents of their own. Rows of ``queries`` with one id are one
query that asks for the terms of all its different texts; a query without an id is left out. Other columns are not carried. An
empty table, or an empty set of queries, gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripleframe.llm.common import slices
from tripleframe.session import cut

K1 = 1.2
B = 0.75
TOP = 10
#: Documents of a block of postings.
BLOCK = 64
#: Bytes of text of a shard, unless one document is longer.
SHARD = 8 << 20
#: Queries that are searched for together; their number has no bound.
QUERIES = 256
NO_ID = np.iinfo(np.int64).max

_TERM = re.compile(r"[^\W_]+")


def terms(text: str | None) -> list[str]:
    """Terms of a text, in order."""
    return _TERM.findall((text or "").lower())


def _code(term: str) -> int:
    return xxhash.xxh64_intdigest(term)


SCHEMA = "shard long, ids array<long>, lengths array<int>, terms array<long>, ends array<int>, docs array<int>, counts array<int>, block int, most array<int>, least array<int>"


def index(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The shards. ``terms`` are sorted 64-bit names of terms, ``ends`` their posting lists' ends in ``docs`` and ``counts``.
    ``most`` (largest counts) and ``least`` (smallest lengths) hold the blocks of ``block`` postings of the terms that have several,
    in the order of the terms; a single block is its own bound.
    Documents are numbered in the order of their ids, so postings are in the order in which ties are decided.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[int, str]] = []
        size = 0
        for batch in slices(batches):
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((NO_ID if i is None else i, t or ""))
                size += len(t or "")
                if size >= SHARD:
                    yield _shard(part << 32 | number, held)
                    number, size = number + 1, 0
                    held.clear()
        if held:
            yield _shard(part << 32 | number, held)

    return df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def stored_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``index``, written to the shared folder with each shard in a row group of its own.

    Spark's reader decodes up to 4096 rows of a row group at once, and its writer holds a row group until it is full: without
    this both would hold all shards of a file.
    """
    return cut(index(df, doc_id, text), {"parquet.block.row.count.limit": "1"})


def _shard(name: int, held: list[tuple[int, str]]) -> pa.RecordBatch:
    held.sort(key=lambda x: x[0])
    known: dict[str, int] = {}
    flat, counts, lengths, sizes = array("i"), array("i"), array("i"), array("i")
    for _, text in held:
        bag = Counter(terms(text))
        flat.extend([known.setdefault(t, len(known)) for t in bag])
        counts.extend(bag.values())
        sizes.append(len(bag))
        lengths.append(sum(bag.values()))
    codes = np.array([_code(t) for t in known], np.uint64).view(np.int64)
    order = np.argsort(codes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    of = rank[np.array(flat)] if flat else np.empty(0, np.int64)
    docs = np.repeat(np.arange(len(held), dtype=np.int32), np.array(sizes))
    by_term = np.argsort(of, kind="stable")
    held_by = np.bincount(of, minlength=len(order))
    ends = np.cumsum(held_by)
    docs, tallies = docs[by_term], np.array(counts, np.int32)[by_term]
    blocks = -(-held_by // BLOCK)
    block_ends = np.cumsum(blocks)
    starts = np.repeat(ends - held_by, blocks) + BLOCK * (np.arange(int(blocks.sum())) - np.repeat(block_ends - blocks, blocks))
    spread = np.array(lengths, np.int32)
    most, least = (f.reduceat(v, starts) if len(starts) else np.empty(0, np.int32) for f, v in ((np.maximum, tallies), (np.minimum, spread[docs])))
    several = np.repeat(blocks > 1, blocks)

    def one(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    return pa.RecordBatch.from_arrays(
        [
            pa.array([name], pa.int64()), one(np.array([i for i, _ in held], np.int64), pa.int64()), one(np.array(lengths, np.int32), pa.int32()),
            one(codes[order], pa.int64()), one(ends.astype(np.int32), pa.int32()), one(docs, pa.int32()), one(tallies, pa.int32()),
            pa.array([BLOCK], pa.int32()), one(most[several], pa.int32()), one(least[several], pa.int32()),
        ],
        names=["shard", "ids", "lengths", "terms", "ends", "docs", "counts", "block", "most", "least"],
    )


class Postings:
    """Cursor over the documents of a term in a shard, with a bound of the scores of each block.

    ``docs`` and ``counts`` are the term's postings, ``starts`` the first one of each block, ``tops`` the blocks' bounds;
    ``score`` gives the scores of some counts and documents. Only blocks a cursor stops in are turned into lists, and only
    blocks of scored documents are scored; ``scored`` counts these.
    """

    __slots__ = ("docs", "counts", "starts", "score", "tops", "last", "best", "block", "held", "scores", "at", "doc", "scored")

    def __init__(self, docs: np.ndarray, counts: np.ndarray, starts: np.ndarray, tops: np.ndarray, score: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        self.docs, self.counts, self.score = docs, counts, score
        self.starts = [*starts.tolist(), len(docs)]
        self.last = docs[np.append(starts[1:], len(docs)) - 1].tolist()
        self.tops, self.best = tops.tolist(), float(tops.max())
        self.block, self.at, self.scored, self.doc = 0, 0, 0, int(docs[0])
        self.held: list[int] | None = None
        self.scores: list[float] | None = None

    def seek(self, doc: int) -> None:
        """Move to the first document not before ``doc``: over blocks first, then inside one."""
        block = self.block_of(doc)
        if block == len(self.last):
            self.doc = NO_ID
            return
        if block != self.block or self.held is None:
            if block != self.block:
                self.block, self.at, self.scores = block, 0, None
            self.held = self.docs[self.starts[block] : self.starts[block + 1]].tolist()
        self.at = bisect_left(self.held, doc, self.at)
        self.doc = self.held[self.at]

    def value(self) -> float:
        """Score of the document under the cursor."""
        if self.scores is None:
            own = slice(self.starts[self.block], self.starts[self.block + 1])
            self.scores = self.score(self.counts[own], self.docs[own]).tolist()
            self.scored += 1
        return self.scores[self.at]

    def block_of(self, doc: int) -> int:
        """The block that would hold ``doc``; the cursor stays."""
        return bisect_left(self.last, doc, self.block)


def search_shard(lists: list[Postings], k: int) -> list[tuple[float, int]]:
    """The k best (score, document number) of a shard; of equal scores the smaller numbers."""
    import heapq

    heap: list[tuple[float, int]] = []  # of (score, -document): its first is the one to beat
    margin = 1 - 1e-9  # upper bounds are sums in another order: never pass over by a rounding
    while lists := [c for c in lists if c.doc != NO_ID]:
        lists.sort(key=lambda c: c.doc)
        bar = heap[0][0] * margin if len(heap) == k else -1.0
        reach, pivot = 0.0, None
        for i, c in enumerate(lists):
            reach += c.best
            if reach >= bar:
                pivot = i
                break
        if pivot is None:
            break
        doc = lists[pivot].doc
        while pivot + 1 < len(lists) and lists[pivot + 1].doc == doc:
            pivot += 1
        blocks = [(c, c.block_of(doc)) for c in lists[: pivot + 1]]
        bound = sum(c.tops[b] for c, b in blocks if b < len(c.tops))
        if bound >= bar:
            for c in lists[: pivot + 1]:
                if c.doc < doc:
                    c.seek(doc)
            score = 0.0
            # Terms are added in a fixed order, so equal documents score equally.
            for c in sorted((c for c in lists if c.doc == doc), key=lambda c: c.best):
                score += c.value()
                c.seek(doc + 1)
            if len(heap) < k:
                heapq.heappush(heap, (score, -doc))
            elif (score, -doc) > heap[0]:
                heapq.heapreplace(heap, (score, -doc))
        else:
            # No document up to the end of the nearest block, or the next list, can enter.
            ends = [c.last[b] + 1 for c, b in blocks if b < len(c.last)]
            after = [c.doc for c in lists[pivot + 1 : pivot + 2]]
            target = max(doc + 1, min(ends + after))
            for c in lists[: pivot + 1]:
                c.seek(target)
    return sorted(((s, -d) for s, d in heap), key=lambda x: (-x[0], x[1]))


def _arrays(row: dict[str, pa.Scalar], *names: str) -> list[np.ndarray]:
    return [row[n].values.to_numpy(zero_copy_only=False) for n in names]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: c[i] for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def _search_group(shards: DataFrame, asked: list[tuple[int, dict[int, int]]], k: int) -> DataFrame:
    """Top k of each shard for some queries (id, count by term), scored with the statistics of all shards."""
    wanted = np.array(sorted({t for _, bag in asked for t in bag}), np.int64)

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            names, ends, lengths = _arrays(row, "terms", "ends", "lengths")
            at = np.searchsorted(names, wanted)
            known = np.flatnonzero(at < len(names))
            known = known[names[at[known]] == wanted[known]]
            held = np.diff(np.append(0, ends))[at[known]]
            # The number of documents and their lengths travel under a null term.
            columns = [pa.array([None, *wanted[known].tolist()], pa.int64()), pa.array([len(lengths), *held.tolist()], pa.int64()), pa.array([int(lengths.sum()), *[0] * len(known)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "docs", "length"])

    told = shards.select("terms", "ends", "lengths").mapInArrow(statistics, "term long, docs long, length long").groupBy("term").agg(F.sum("docs"), F.sum("length")).collect()
    held = {t: n for t, n, _ in told if t is not None}
    total, length = next(((n, s) for t, n, s in told if t is None), (0, 0))
    mean = length / total if total and length else 1.0
    idf = {t: float(np.log(1 + (total - n + 0.5) / (n + 0.5))) for t, n in held.items()}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, lengths, names, ends, docs, counts = _arrays(row, "ids", "lengths", "terms", "ends", "docs", "counts")
            block, (most, least) = row["block"].as_py(), _arrays(row, "most", "least")
            blocks = -(-np.diff(np.append(0, ends)) // block)
            block_ends = np.cumsum(np.where(blocks > 1, blocks, 0))
            norm = K1 * (1 - B + B * lengths / mean)
            place = {int(t): i for t, i in zip(wanted, np.searchsorted(names, wanted), strict=True) if i < len(names) and names[i] == t}

            def cursor(t: int, n: int, at: dict[int, int] = place, norm: np.ndarray = norm) -> Postings:
                i = at[t]
                first, last = int(ends[i - 1]) if i else 0, int(ends[i])
                f, d = counts[first:last], docs[first:last]
                own = slice(int(block_ends[i - 1]) if i else 0, int(block_ends[i]))
                high, low = (most[own], least[own]) if blocks[i] > 1 else (f.max(keepdims=True), lengths[d].min(keepdims=True))

                def score(f: np.ndarray, d: np.ndarray) -> np.ndarray:
                    return idf[t] * f * (K1 + 1) / (f + norm[d]) * n

                # The score grows with the count and falls with the length.
                tops = idf[t] * high * (K1 + 1) / (high + K1 * (1 - B + B * low / mean)) * n
                return Postings(d, f, np.arange(0, last - first, block), tops, score)

            out: list[tuple[int, int, float]] = []
            for query, bag in asked:
                lists = [cursor(t, n) for t, n in bag.items() if t in place]
                out.extend((query, int(ids[d]), s) for s, d in search_shard(lists, k))
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            kinds = pa.int64(), pa.int64(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "doc_id", "score"])

    return shards.mapInArrow(search, "query_id long, doc_id long, score double")


def top_k(shards: DataFrame, queries: DataFrame, k: int = TOP, query_id: str = "item_id", text: str = "text") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``doc_id`` and ``score`` of the k best documents of each query.

    Queries are read in groups of ``QUERIES`` and each group is searched over all shards, so what travels with the tasks is
    bounded. A shard returns at most k rows a query; they are merged in the order of score and id.
    """
    found: list[DataFrame] = []
    group: list[tuple[int, dict[int, int]]] = []

    def search() -> None:
        found.append(cut(_search_group(shards, list(group), k)))
        group.clear()

    signed = np.iinfo(np.int64)
    asked = queries.select(F.col(query_id).cast("long").alias("q"), F.col(text).alias("t")).where("q IS NOT NULL").distinct()
    for row in asked.orderBy("q", "t").toLocalIterator():
        bag = Counter(_code(t) for t in terms(row["t"]))
        signs = Counter({c - (1 << 64) if c > signed.max else c: n for c, n in bag.items()})
        if group and group[-1][0] == row["q"]:
            group[-1][1].update(signs)
            continue
        if len(group) == QUERIES:
            search()
        group.append((row["q"], signs))
    if group or not found:
        search()
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionAll(more)
    # Scores are rounded, so that the order of equal documents does not hang on the last bit.
    rounded = merged.withColumn("score", F.round("score", 9))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = rounded.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    real = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return ranked.select("query_id", "rank", real.alias("doc_id"), "score")
