"""Near copies by the similarity of their word shingles, found through an inverted index over prefixes and verified exactly.

A text is the set of its hashed shingles of ``SHINGLE`` = 5 words (a shorter text is one shingle); two texts are linked if
their sets share 4/5 of their union or more. Fingerprints cannot find such pairs: at 4/5 the expected distance of two 64-bit
SimHash values is ten bits, spread over all eight bytes. Here no pair is lost: all sets are ordered by one order of shingles,
and two sets in reach share one of their first ``n - ceil(4n/5) + 1`` shingles, so posting lists are kept for those only.

1. The order is by frequency over all documents, counted in a sketch of ``BUCKETS`` counters that tasks fill and that are summed
   in a tree. What texts have in common comes last, so a group that is only similar has no lists. Shingles that fall together
   in a counter move cost, not results.
2. SimHash comes first: sets whose fingerprints (``simhash``) are equal or differ in few bits, and which are alike, are linked
   and become one component. Its stars are verified first; the pairs that they stand for follow, as in step 4, until every pair
   in its radius is of one component or verified. What it cannot find is left to the lists.
3. Rounds: each list names one of its members, each set is held against the member that most of its lists name, and linked sets
   become one component. Rounds go on, with other members, while they settle a share of the list entries; a round costs a row
   per entry, and where it stops moves cost, not results.
4. Members of different components that are left in one list are compared. A parity bitmap of each set bounds the size of
   their difference. First each member of a list returns two of those in its bound only, the nearest one and the one of the
   smallest number, so a group of near copies becomes one component by a row per entry and not by one per pair. This goes on
   with the entries that have any in their bound, while a share of the pairs is alike.
5. All pairs that are still of different components are tallied: the number of lists that a pair shares bounds its overlap, and
   pairs within both bounds are verified on whole sets.

Equal sets are one member. Texts without words are equal to each other. The rows of a component are its members' rows, whatever
their ids; the row of the smallest id, then of the smallest digest of its text, stands for it. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import forget, slices, texts_of
from tripleframe.llm.components import components
from tripleframe.llm.lists import meet
from tripleframe.llm.simhash import _LOWER, _WORDS, _postings, fingerprint
from tripleframe.llm.simhash import _near as _in_radius
from tripleframe.llm.simhash import links as close
from tripleframe.session import cut, cut_counted, discard

SHINGLE = 5
#: Counters of the frequency sketch, how many travel in a row, and how many rows are summed together.
BUCKETS, CHUNK, TOGETHER = 1 << 20, 1 << 14, 64
#: A round that settles less than one entry in so many is the last one, and so is one that finds less than one in so many pairs alike.
WORTH = 10
#: Numbers of sets that are sent to every task; where pairs name more, the sets are shuffled to them.
SENT = 1 << 19
#: Words whose hashes a task remembers.
MEMO_WORDS = 300_000
#: Bits of a shingle's number, and of the parity bitmap of a set.
NUMBER, PARITY = (1 << 62) - 1, 1024


class Shingles:
    """Sorted distinct shingle numbers of texts."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}

    def _of(self, word: bytes) -> int:
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        return self.memo.setdefault(word, xxhash.xxh64_intdigest(word))

    def __call__(self, text: str) -> np.ndarray:
        words = _WORDS.findall(text.encode().translate(_LOWER))
        if not words:
            return np.empty(0, np.int64)
        known, of = self.memo.get, self._of
        hashed = np.array([known(w) or of(w) for w in words], dtype=np.uint64)
        width = min(SHINGLE, len(words))
        h = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            h = h * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + len(h)]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        return np.unique((h & np.uint64(NUMBER)).view(np.int64))


def prefix(n: int) -> int:
    """Shingles of a set of ``n`` of which one is shared with every set in reach."""
    return n - (4 * n + 4) // 5 + 1


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets share 4/5 of their union."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def parity(numbers: np.ndarray) -> bytes:
    """For each bit whether an odd number of shingles falls on it: bitmaps differ in no more bits than sets in shingles."""
    return np.packbits((np.bincount(numbers >> 40 & (PARITY - 1), minlength=PARITY) & 1).astype(np.uint8)).tobytes()


def frequencies(docs: DataFrame) -> bytes:
    """The sketch: for each counter the number of documents with a shingle that falls on it (32 bits, which may stay full)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingles, held = Shingles(), np.zeros(BUCKETS, np.uint32)
        for batch in slices(batches):
            for text in texts_of(batch, "text"):
                np.add.at(held, shingles(text) & (BUCKETS - 1), 1)
        part = TaskContext.get().partitionId()
        used = [k for k in range(BUCKETS // CHUNK) if held[k * CHUNK : (k + 1) * CHUNK].any()]
        rows = pa.array(used, pa.int32()), pa.array([part] * len(used), pa.int32()), pa.array([held[k * CHUNK : (k + 1) * CHUNK].tobytes() for k in used], pa.binary())
        yield pa.RecordBatch.from_arrays([*rows], names=["chunk", "part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.uint32).astype(np.uint64) for c in table.column("counts"))
        counts = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "part": table.column("part").slice(0, 1), "counts": pa.array([counts], pa.binary())})

    schema = "chunk int, part int, counts binary"
    held, seen = cut_counted(docs.select("text").mapInArrow(count, schema), most=F.max("part"))
    parts = (seen["most"] or 0) + 1
    while True:
        parts = -(-parts // TOGETHER)
        before, held = held, cut(held.withColumn("part", F.floor(F.col("part") / TOGETHER).cast("int")).groupBy("chunk", "part").applyInArrow(add, schema))
        discard(before)
        if parts == 1:
            break
    sketch = np.zeros(BUCKETS, np.uint32)
    # BUCKETS counters, whatever the number of documents.
    for row in held.collect():
        sketch[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.uint32)
    discard(held)
    return sketch.tobytes()


def _printed(df: DataFrame, sketch: bytes) -> DataFrame:
    """Each row's id and digest, the number ``node`` of its set, its size, and at the first row of a set in a task its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingles, counts, seen = Shingles(), np.frombuffer(sketch, np.uint32), set()
        for batch in slices(batches):
            nodes, sizes, heads, ranks, lasts, losts, bits, prints = [], [], [], [], [], [], [], []
            for text in texts_of(batch, "text"):
                found = shingles(text)
                node = xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63)
                head = rank = last = lost = bit = mark = None
                if node not in seen and len(found):
                    often = counts[found & (BUCKETS - 1)].astype(np.int64)
                    first = np.lexsort((found, often))[: prefix(len(found))]
                    # A list is 32 bits of a shingle's number; shingles of one set that fall together are counted as lost.
                    head = np.unique((found[first] >> 20).astype(np.int32))
                    rank, last, lost, bit = int(often[first[-1]]), int(found[first[-1]]), len(first) - len(head), parity(found)
                    mark = fingerprint(text) - (1 << 63)
                seen.add(node)
                for told, value in zip((nodes, sizes, heads, ranks, lasts, losts, bits, prints), (node, len(found), head, rank, last, lost, bit, mark), strict=True):
                    told.append(value)
            kinds = pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()
            made = [pa.array(v, k) for v, k in zip((nodes, sizes, heads, ranks, lasts, losts, bits, prints), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=["doc_id", "digest", "node", "size", "head", "rank", "last", "lost", "bits", "fingerprint"])

    return df.select("doc_id", "digest", "text").mapInArrow(run, "doc_id long, digest string, node long, size int, head array<int>, rank long, last long, lost int, bits binary, fingerprint long")


def _sets(df: DataFrame) -> DataFrame:
    """What whole sets are made of, by ``node``: a text is shorter than its shingles, which are numbered where pairs name it."""
    return df.select("node", "text")


def _possible(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose prefixes share ``shared`` shingles and whose sets can be in reach.

    All that the prefix which ends first has in common with the other set is in the other's prefix.
    """
    one, two = (facts.select(F.col("node").alias(n), F.col("size").alias(f"{n}_size"), F.struct("rank", "last").alias(f"{n}_last"), F.col("lost").alias(f"{n}_lost")) for n in "ab")
    rest = lambda n: F.ceil(F.lit(4) * F.col(f"{n}_size") / 5) - 1
    overlap = F.when(F.col("a_last") <= F.col("b_last"), rest("a")).otherwise(rest("b")) + F.col("shared") + F.col("a_lost") + F.col("b_lost")
    return pairs.join(one, "a").join(two, "b").where(9 * overlap >= 4 * (F.col("a_size") + F.col("b_size"))).select("a", "b", "shared")


def _differing(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits in which the bitmaps of each pair differ."""
    column = batch.column(batch.schema.get_field_index("bits"))
    bits = np.frombuffer(column.buffers()[2], np.uint64)[column.offset * PARITY // 64 : (column.offset + len(column)) * PARITY // 64].reshape(-1, PARITY // 64)
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 1 << 16):
        g = slice(at, at + (1 << 16))
        out[g] = np.bitwise_count(bits[a[g]] ^ bits[b[g]]).sum(axis=1, dtype=np.int64)
    return out


def _near(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of different parts, of sizes in reach, whose bitmaps differ in no more bits than sets in reach may."""
    size, part = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("size", "part"))
    low, high = np.minimum(size[a], size[b]).astype(np.int64), np.maximum(size[a], size[b]).astype(np.int64)
    good = np.flatnonzero((part[a] != part[b]) & (5 * low >= 4 * high))
    out = np.zeros(len(a), bool)
    out[good] = 9 * _differing(batch, a[good], b[good]) <= low[good] + high[good]
    return out


def _picked(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray):
    """For each entry that is in a pair: the node it differs least from, and the smallest node it is paired with."""
    lists, node = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("list", "node"))
    at, other, differing = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(_differing(batch, a, b), 2)
    if not len(at):
        return
    near, low = np.lexsort((node[other], differing, at)), np.lexsort((node[other], at))
    first = np.flatnonzero(np.append(True, at[near][1:] != at[near][:-1]))
    rows = at[near[first]]
    made = lists[rows], node[rows], node[other[near[first]]], node[other[low[first]]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["list", "node", "near", "low"])


def _tally(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray):
    """Pairs with the number of lists in which they met."""
    node = batch.column(batch.schema.get_field_index("node")).to_numpy()
    x, y = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    at = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) if len(x) else np.empty(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(x[at]), pa.array(y[at]), pa.array(np.diff(np.append(at, len(x))))], names=["a", "b", "shared"])


def _named_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets that the pairs (a, b) name; ``pairs`` is read twice.

    Up to ``SENT`` numbers go to where the sets lie, so that the other sets are not shuffled in each round.
    """
    names, seen = cut_counted(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), n=F.count(F.lit(1)))
    return sets.join(F.broadcast(names) if seen["n"] <= SENT else names, "node", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are alike."""
    pairs = cut(pairs)
    named = _named_sets(pairs, sets)
    left, right = (named.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches):
            # A text that many others are held against is numbered once a slice.
            made: dict[int, np.ndarray] = {}
            good = []
            for nodes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for node, text in zip(nodes[:2], nodes[2:], strict=True):
                    if node not in made:
                        made[node] = shingles(text or "")
                good.append(alike(made[nodes[0]], made[nodes[1]]))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _mixed(placed: DataFrame) -> DataFrame:
    """Rows of the lists that hold more than one part."""
    spread = placed.groupBy("list").agg(F.min("part").alias("_least"), F.max("part").alias("_most")).where("_least <> _most").select("list")
    return placed.join(spread, "list", "left_semi")


def _parted(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the lists that hold more than one part, with the ``part`` that the links give to each node."""
    # Links of one round are few beside the lists; components are made anew from all of them.
    parts = cut(components(links).select("node", F.col("component").alias("_part")))
    return _mixed(entries.drop("part").join(parts, "node", "left").withColumn("part", F.coalesce("_part", "node")).drop("_part"))


def _grown(links: DataFrame | None, pairs: DataFrame, sets: DataFrame) -> tuple[DataFrame | None, int]:
    """The links with those of the pairs that are alike, and the number of these."""
    found, seen = cut_counted(_verified(pairs, sets), n=F.count(F.lit(1)))
    if not seen["n"]:
        return links, 0
    return found if links is None else links.unionByName(found), seen["n"]


def _thinned(members: DataFrame, sets: DataFrame, links: DataFrame | None, payload: list[str], near) -> tuple[DataFrame, DataFrame | None]:
    """The entries of ``members`` with others in their bound, and the links with those among the pairs that the entries name.

    ``members`` has the parts that ``links`` give. What is left holds every pair in the bound whose parts still differ.
    """
    kind = members.schema["list"].dataType.simpleString()
    while True:
        picked = cut(meet(members, "node", payload, near, f"list {kind}, node long, near long, low long", _picked))
        pair = lambda n: F.struct(F.least("node", n).alias("a"), F.greatest("node", n).alias("b"))
        pairs, asked = cut_counted(picked.select(F.explode(F.array(pair("near"), pair("low"))).alias("p")).select("p.*").distinct(), n=F.count(F.lit(1)))
        links, n = _grown(links, pairs, sets)
        before, members = members, members.join(picked.select("list", "node").distinct(), ["list", "node"], "left_semi")
        if n:
            members = _parted(members, links)
        members = cut(members)
        for table in (before, picked, pairs):
            discard(table)
        if WORTH * n <= asked["n"]:
            return members, links


def _named(placed: DataFrame, facts: DataFrame, round_: int) -> DataFrame:
    """Candidate pairs (a, b) of a round: each set with the one other set that most of its lists name."""
    names = placed.groupBy("list").agg(F.min_by(F.struct("node", "part", "size"), F.xxhash64("node", F.lit(round_))).alias("n"))
    met = placed.join(names, "list").where("part <> n.part AND 5 * least(size, n.size) >= 4 * greatest(size, n.size)")
    counted = met.groupBy(F.col("node").alias("a"), F.col("n.node").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    return _possible(counted, facts).groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))


def _close(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints are equal, or tied by the links of ``simhash``."""
    first = cut(prints.groupBy("fingerprint").agg(F.min("node").alias("node")))
    same = prints.select(F.col("node").alias("a"), "fingerprint").join(first.withColumnRenamed("node", "b"), "fingerprint").where("a <> b").select("a", "b")
    return same.unionByName(close(first).where("a <> b")).distinct()


def _within(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that pass ``_near`` and whose fingerprints are in SimHash's radius."""
    good = _near(batch, a, b)
    good[good] = _in_radius(batch, a[good], b[good])
    return good


def _close_links(prints: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links that tie all pairs in SimHash's radius whose sets are alike; ``prints`` has ``node``, ``fingerprint``, ``size`` and ``bits``.

    ``_close`` gives stars in place of pairs. A star may not be alike where a pair that it stands for is, so the sets that it
    names are held against each other.
    """
    stars, seen = cut_counted(_close(prints.select("node", "fingerprint")), n=F.count(F.lit(1)))
    if not seen["n"]:
        return None
    links, _ = _grown(None, stars, sets)
    named = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members = _postings(prints.join(named, "node", "left_semi")).join(prints.select("node", "size", "bits"), "node")
    parted = _mixed(members.withColumn("part", F.col("node"))) if links is None else _parted(members, links)
    members, seen = cut_counted(parted, n=F.count(F.lit(1)))
    if not seen["n"]:
        return links
    payload = ["size", "part", "bits", "fingerprint"]
    members, links = _thinned(members, sets, links, payload, _within)
    pairs = meet(members, "node", payload, _within, "a long, b long, shared long", _tally).select("a", "b").distinct()
    links, _ = _grown(links, pairs, sets)
    discard(members)
    return links


def kept_rows(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``digest``) of the row that stands for each group of near copies; ``docs`` has these columns and ``text``.

    ``digest`` tells texts of one id apart.
    """
    facts = F.struct("size", "rank", "last", "lost", "bits", "head", "fingerprint")
    printed = _printed(docs, frequencies(docs)).groupBy("node").agg(
        F.min(F.struct("doc_id", "digest")).alias("least"), F.first(F.when(F.col("head").isNotNull(), facts), ignorenulls=True).alias("f")
    )
    # Sets are numbered: what travels with the lists is short. Sets without words have no facts and no lists.
    nodes = cut(printed.select(F.monotonically_increasing_id().alias("node"), "least", "f.*"))
    facts = nodes.where("head IS NOT NULL").drop("least", "head", "fingerprint")
    entries = nodes.where("head IS NOT NULL").select("node", "size", F.explode("head").alias("list"))
    several = entries.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("list")
    shared, seen = cut_counted(entries.join(several, "list", "left_semi"), n=F.count(F.lit(1)))
    asked = shared.select("node").distinct().join(nodes.select("node", "least.*"), "node")
    sets = cut(_sets(docs.join(asked, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])), {"compression": "zstd"})
    # SimHash names the first pairs, which are held against each other as whole sets; then the lists name pairs.
    links = _close_links(nodes.where("head IS NOT NULL").select("node", "fingerprint", "size", "bits"), sets)
    placed, left = shared.withColumn("part", F.col("node")), seen
    if links is not None:
        placed, left = cut_counted(_parted(shared, links), n=F.count(F.lit(1)))
    round_, written = 0, [placed] if links is not None else []
    while True:
        links, n = _grown(links, _named(placed, facts, round_), sets)
        entries_left, round_ = left["n"], round_ + 1
        if n:
            placed, left = cut_counted(_parted(shared, links), n=F.count(F.lit(1)))
            written.append(placed)
            for table in written[:-1]:
                discard(table)
            written = written[-1:]
        if not n or WORTH * left["n"] > (WORTH - 1) * entries_left:
            break
    members = cut(placed.select("list", "node", "size", "part").join(facts.select("node", "bits"), "node"))
    for table in (shared, *written):
        discard(table)
    members, links = _thinned(members, sets, links, ["size", "part", "bits"], _near)
    tallied = meet(members, "node", ["size", "part", "bits"], _near, "a long, b long, shared long", _tally).groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    second = _verified(_possible(tallied, facts).select("a", "b"), sets)
    links = cut(second if links is None else links.unionByName(second))
    found = components(links).select("node", F.col("component").alias("part"))
    whole = nodes.select("node", "least").join(found, "node", "left").groupBy(F.coalesce("part", "node").alias("part")).agg(F.min("least").alias("least"))
    kept = cut(whole.select("least.*"))
    # All that is left of the stage is its result; what it was made of would lie on the disk until the end of the application.
    for table in (nodes, sets, members, links):
        discard(table)
    return kept
