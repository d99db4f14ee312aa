"""Near-duplicate documents by SimHash, found through an inverted index over byte positions.

A fingerprint is eight bytes at eight positions. Fingerprints that differ in ``RADIUS`` = 3 bits at most share at least five
positional bytes. Posting lists are kept for combinations of four positions, chosen so that any five positions contain one
combination: two fingerprints in reach of each other meet in a list for sure. Where two meet, their shared positional bytes
are tallied, pairs below the guaranteed five are dropped, and the rest is verified by counting the differing bits.

Equal fingerprints are one entry of the index, whatever the number of documents. Null and empty texts, and texts of white
space, have the fingerprint zero and are linked like any other; documents of a null id get a fingerprint, but no component
of theirs is named by it. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import map_text
from tripleframe.llm.components import components, forest
from tripleframe.llm.lists import meet
from tripleframe.session import cut

SEED = 42
SHINGLE = 3
RADIUS = 3
POSITIONS = 8
#: Positional bytes that two fingerprints in reach share at least.
SHARED = POSITIONS - RADIUS
#: Positions of a posting list.
WIDTH = 4

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str) -> int:
    """SimHash of the word shingles, as an unsigned number."""
    words = _WORDS.findall(text.encode().translate(_LOWER))
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    take = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends[take:], strict=False)], dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduce(bits, axis=0, dtype=np.uint32) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by ``fingerprint``, a signed 64-bit number."""

    def make():
        return lambda texts: {"fingerprint": pa.array(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))}

    return map_text(df, text, "fingerprint long", make)


def combinations(positions: int = POSITIONS, shared: int = SHARED, width: int = WIDTH) -> list[tuple[int, ...]]:
    """Combinations of ``width`` positions such that any ``shared`` positions contain one, chosen greedily."""
    open_sets = {frozenset(s) for s in itertools.combinations(range(positions), shared)}
    every = [frozenset(c) for c in itertools.combinations(range(positions), width)]
    chosen = []
    while open_sets:
        best = max(every, key=lambda c: sum(c <= s for s in open_sets))
        chosen.append(tuple(sorted(best)))
        open_sets = {s for s in open_sets if not best <= s}
    return chosen


def _postings(prints: DataFrame) -> DataFrame:
    """A row for each fingerprint and combination: the list is named by a hash of combination and bytes.

    Lists whose names collide only add pairs that the tally drops.
    """
    fp = F.col("fingerprint")
    lists = [F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(int(np.array(sum(255 << 8 * p for p in c), dtype=np.uint64).view(np.int64))))) for n, c in enumerate(combinations())]
    return prints.select(F.explode(F.array(*lists)).alias("list"), "fingerprint", "node")


def _near(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    fp = batch.column(batch.schema.get_field_index("fingerprint")).to_numpy().view(np.uint64)
    differing = fp[a] ^ fp[b]
    shared = (differing.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
    good = shared >= SHARED
    good[good] = np.bitwise_count(differing[good]) <= RADIUS
    return good


def _links(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray):
    node = batch.column(batch.schema.get_field_index("node")).to_numpy()
    x, y = forest(node[a], node[b])
    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of distinct fingerprints (``fingerprint``, ``node``), thinned to spanning stars.

    The links of all fingerprints in reach connect the same nodes as these; a star replaces the pairs of a group.
    """
    return meet(_postings(prints), "node", ["fingerprint"], _near, "a long, b long", _links)


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Replace the text by ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable over links."""
    printed = cut(fingerprints(df, text))
    classes = cut(printed.groupBy("fingerprint").agg(F.min(doc_id).cast("long").alias("node")))
    found = components(links(classes.where("node IS NOT NULL")))
    named = cut(classes.join(found, "node", "left").select(F.col("fingerprint").alias("_f"), F.coalesce("component", "node").alias("component_id")))
    joined = printed.join(named, F.col("fingerprint") == F.col("_f")).drop("_f")
    return joined.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
