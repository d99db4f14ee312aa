"""Remove byte strings that already occur in an earlier document, by interval expansion on a Burrows-Wheeler transform.

Every string of ``length`` bytes that also starts in a document of a smaller id is covered. Strings of equal bytes are found
without comparing documents pairwise:

1. Texts are packed into blocks. In each string the gram of the smallest hash is its anchor; equal strings have equal anchors.
   Neighbouring strings of one anchor form a stretch, so a text has few anchors, and only their hashes are shuffled. An anchor
   of a single document cannot belong to a repeated string and is dropped; so are most bytes of a corpus.
2. The stretches of shared anchors go to a task by their anchor, so equal strings meet. Within a block equal stretches are
   one, with their smallest id, so an anchor that is everywhere is one row a block.
3. A task holds the string starts of its distinct stretches in the order of a Burrows-Wheeler transform of bounded context:
   rows are ordered by what follows, and the column of preceding bytes extends all intervals backward at once, breadth
   first, by the last-to-first mapping (a stable sort by that column). Each round sets the borders between strings whose
   common prefix has just that value; intervals of one row leave, and the rounds stop at ``length``. What is left are the
   intervals of strings that share ``length`` bytes. Their smallest id goes back to the blocks.
4. A block covers each string whose smallest id is below the id of its document.

Null texts are empty, texts below ``length`` keep everything, long texts are treated whole. A null id sorts behind all
others; rows of equal ids do not cover each other. Other columns are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import slices, texts_of
from tripleframe.session import cut

LENGTH = 50
#: Bytes of a block, unless one document is longer.
BLOCK = 2 << 20
#: Bytes of text for each bin of anchors, and the least number of bins.
BIN = 4 << 20
BINS = 64
#: String starts that are hashed in one go, so that intermediate results stay in the processor's cache.
PIECE = 1 << 15
#: Bits of an anchor's hash that are shuffled, beside its bin. A collision only sends a stretch on for nothing.
BITS = 40
NO_ID = np.iinfo(np.int64).max


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _numbers(values: np.ndarray) -> bytes:
    """Whole numbers, compressed by planes of their bytes."""
    wide = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return struct.pack("<q", len(values)) + _squeeze(np.ascontiguousarray(wide).tobytes())


def _unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _read_numbers(data: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<q", data)
    planes = np.frombuffer(_unsqueeze(data[8:]), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)


def anchors(data: np.ndarray, length: int) -> np.ndarray:
    """Smallest hash of the grams of each string of ``length`` bytes, by string start."""
    gram = max(1, length // 2)
    reach = length - gram + 1
    base = np.array([0x9E3779B97F4A7C15], np.uint64)  # arrays wrap around without a warning
    out = np.empty(max(0, len(data) - length + 1), np.uint64)
    for at in range(0, len(out), PIECE):
        one = data[at : at + PIECE + length - 1].astype(np.uint64)
        one += np.uint64(1)
        one *= np.uint64(0xBF58476D1CE4E5B9)
        h, size, power = one, 1, base
        for bit in bin(gram)[3:]:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
            if bit == "1":
                h = h[:-1] * base + one[size:]
                power, size = power * base, size + 1
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        width = 1
        while width * 2 <= reach:
            h = np.minimum(h[:-width], h[width:])
            width *= 2
        out[at : at + PIECE] = np.minimum(h[: len(h) - (reach - width)], h[reach - width :])
    return out


class Block:
    """Documents end to end, and their stretches: string starts ``first`` to ``last``, one behind, that share an anchor."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes, length: int, bins: int):
        self.ids, self.sizes, self.length = ids, sizes, length
        self.data = np.frombuffer(data, np.uint8)
        self.raw = data
        ends = np.cumsum(sizes)
        found = anchors(self.data, length)
        inside = np.ones(len(found) + 1, dtype=bool)
        inside[-1] = False
        for e in ends:
            inside[max(0, e - length + 1) : e] = False
        begins = inside[:-1].copy()
        begins[1:] &= ~inside[:-2] | (found[1:] != found[:-1])
        stops = inside[:-1] & ~inside[1:]
        stops[:-1] |= begins[1:] & inside[:-2]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.doc = np.searchsorted(ends, self.first, side="right")
        anchor = found[self.first]
        self.bin = (anchor % np.uint64(bins)).astype(np.int64)
        self.code = self.bin.astype(np.uint64) << np.uint64(BITS) | (anchor // np.uint64(bins) & np.uint64((1 << BITS) - 1))
        # Stretches by anchor, in document order; ``starts`` are the anchors' first ones.
        self.order = np.argsort(self.code, kind="stable")
        ordered = self.code[self.order]
        self.starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, np.int64)
        self.distinct = ordered[self.starts]

    def by_bin(self) -> Iterator[tuple[int, int, int]]:
        """(bin, from, to) over the distinct anchors."""
        which = (self.distinct >> np.uint64(BITS)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else np.empty(0, np.int64)
        yield from ((int(which[a]), int(a), int(b)) for a, b in pairwise([*cuts, len(which)]))

    def local(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[bytes, int], np.ndarray]:
        """Stretches of the shared anchors: (stretch, its number among distinct ones, the distinct ones, their anchors' bins)."""
        mark = np.zeros(len(self.starts) + 1, dtype=bool)
        mark[:-1] = shared
        taken = np.sort(self.order[np.repeat(mark[:-1], np.diff(np.append(self.starts, len(self.order))))])
        known: dict[bytes, int] = {}
        reach, raw = self.length - 1, self.raw
        number = np.array([known.setdefault(raw[a : b + reach], len(known)) for a, b in zip(self.first[taken].tolist(), self.last[taken].tolist(), strict=True)], dtype=np.int64)
        bins = np.zeros(len(known), np.int64)
        bins[number] = self.bin[taken]
        return taken, number, known, bins


def pack(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Blocks of documents: ``block``, ``ids``, ``sizes`` and the compressed texts ``data``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            sizes = [len(t) for t in texts]
            row = [part << 32 | count], [list(ids)], [sizes], [_squeeze(b"".join(texts))]
            kinds = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["block", "ids", "sizes", "data"])

        for batch in slices(batches):
            for i, t in zip(batch.column(0).to_pylist(), texts_of(batch, text), strict=True):
                ids.append(NO_ID if i is None else i)
                texts.append(t.encode())
                held += len(texts[-1])
                if held >= BLOCK:
                    yield out()
                    count, held = count + 1, 0
                    ids.clear()
                    texts.clear()
        if ids:
            yield out()

    return df.select(F.col(doc_id).cast("long").alias(doc_id), text).mapInArrow(run, "block long, ids array<long>, sizes array<long>, data binary")


def _blocks(batches: Iterator[pa.RecordBatch], length: int, bins: int) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            yield row, Block(np.array(row["ids"], np.int64), np.array(row["sizes"], np.int64), _unsqueeze(row["data"]), length, bins)


def _bits(mask: np.ndarray) -> bytes:
    return _squeeze(np.packbits(mask).tobytes())


def _read_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(_unsqueeze(data), np.uint8), count=n).astype(bool)


def _anchor_rows(blocks: DataFrame, length: int, bins: int) -> DataFrame:
    """A row for each block and bin: the block's distinct anchors there, and which of them several of its documents hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, b in _blocks(batches, length, bins):
            ends = np.append(b.starts[1:], len(b.order)) - 1
            several = b.doc[b.order[b.starts]] != b.doc[b.order[ends]] if len(b.starts) else np.empty(0, bool)
            out = [(k, row["block"], _numbers(np.diff(b.distinct[i:j], prepend=b.distinct[i])), struct.pack("<Q", int(b.distinct[i])), _bits(several[i:j])) for k, i, j in b.by_bin()]
            kinds = pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bin", "block", "steps", "least", "several"])

    return blocks.mapInArrow(run, "bin int, block long, steps binary, least binary, several binary")


def _shared(group: pa.Table) -> pa.Table:
    """Which anchors of each row of a bin are held by more than one document."""
    codes, several = [], []
    for steps, least, flags in zip(*(group.column(n).to_pylist() for n in ("steps", "least", "several")), strict=True):
        codes.append(np.cumsum(_read_numbers(steps), dtype=np.uint64) + np.uint64(struct.unpack("<Q", least)[0]))
        several.append(_read_bits(flags, len(codes[-1])))
    flat = np.concatenate(codes)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    alike = ordered[1:] == ordered[:-1]
    shared = np.empty(len(flat), dtype=bool)
    shared[order] = np.append(alike, False) | np.append(False, alike)
    # An anchor that one block alone holds is shared if several of its documents do.
    shared |= np.concatenate(several)
    cuts = np.cumsum([0, *map(len, codes)])
    masks = [_bits(shared[a:b]) for a, b in pairwise(cuts)]
    return pa.table({"bin": group.column("bin"), "block": group.column("block"), "mask": pa.array(masks, pa.binary())})


def _marked(row: dict, b: Block) -> np.ndarray:
    """Which of the block's distinct anchors are shared."""
    masks = {m["bin"]: m["mask"] for m in row["masks"] or ()}
    shared = np.zeros(len(b.distinct), dtype=bool)
    for k, i, j in b.by_bin():
        shared[i:j] = _read_bits(masks[k], j - i)
    return shared


def _stretch_rows(joined: DataFrame, length: int, bins: int) -> DataFrame:
    """A row for each block and bin: its distinct stretches of shared anchors with the smallest id that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, b in _blocks(batches, length, bins):
            taken, number, known, where = b.local(_marked(row, b))
            least = np.full(len(known), NO_ID, np.int64)
            np.minimum.at(least, number, b.ids[b.doc[taken]])
            texts = list(known)
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(where[order]) != 0)) if len(order) else []
            out = []
            for i, j in pairwise([*cuts, len(order)]):
                part = order[i:j]
                sizes = np.array([len(texts[p]) for p in part])
                out.append((int(where[part[0]]), row["block"], _numbers(sizes), _numbers(least[part].view(np.uint64)), _squeeze(b"".join([texts[p] for p in part]))))
            kinds = pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bin", "block", "sizes", "least", "data"])

    return joined.mapInArrow(run, "bin int, block long, sizes binary, least binary, data binary")


def intervals(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, interval of each) of the strings of ``length`` bytes at ``starts`` that occur more than once.

    Rows are kept in the order of what they are followed by. ``column`` holds the bytes before what is matched so far: the
    Burrows-Wheeler column of this order. Sorting by it, stably, is the last-to-first mapping of all rows at once, and cuts
    each interval by its preceding bytes. After round n the intervals hold rows with n common bytes.
    """
    rows = np.arange(len(starts))
    interval = np.zeros(len(starts), np.int64)
    for matched in range(length):
        if not len(rows):
            break
        column = text[starts[rows] + (length - 1 - matched)]
        mapped = np.argsort(column, kind="stable")
        rows, column, interval = rows[mapped], column[mapped], interval[mapped]
        border = np.ones(len(rows) + 1, dtype=bool)
        border[1:-1] = (column[1:] != column[:-1]) | (interval[1:] != interval[:-1])
        wide = ~(border[:-1] & border[1:])
        interval = np.cumsum(border[:-1])[wide]
        rows = rows[wide]
    return rows, interval


def _least_ids(group: pa.Table, length: int) -> pa.Table:
    """For each stretch of each row of a bin, the smallest id that holds each of its strings, as runs."""
    known: dict[bytes, int] = {}
    numbers, held, least_parts = [], [], []
    for sizes, least, data in zip(*(group.column(n).to_pylist() for n in ("sizes", "least", "data")), strict=True):
        raw = _unsqueeze(data)
        ends = np.cumsum(_read_numbers(sizes).astype(np.int64)).tolist()
        numbers.append([known.setdefault(raw[a:b], len(known)) for a, b in pairwise([0, *ends])])
        least_parts.append(_read_numbers(least).view(np.int64))
        held.append(len(ends))
    number = np.array([n for part in numbers for n in part], dtype=np.int64)
    least = np.full(len(known), NO_ID, np.int64)
    np.minimum.at(least, number, np.concatenate(least_parts))
    sizes = np.array([len(s) for s in known], dtype=np.int64)
    text = np.frombuffer(b"".join(known), np.uint8)
    counts = sizes - (length - 1)
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(known)), counts)
    starts = np.arange(counts.sum()) - first[owner] + (np.cumsum(sizes) - sizes)[owner]
    smallest = least[owner]
    rows, interval = intervals(text, starts, length)
    if len(rows):
        begin = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
        low = np.minimum.reduceat(smallest[rows], begin)
        smallest[rows] = np.repeat(low, np.diff(np.append(begin, len(rows))))
    turn = np.ones(len(owner), dtype=bool)
    turn[1:] = (owner[1:] != owner[:-1]) | (smallest[1:] != smallest[:-1])
    at = np.flatnonzero(turn)
    span, value, of = np.diff(np.append(at, len(owner))), smallest[at], owner[at]
    run_first = np.searchsorted(of, np.arange(len(known) + 1))
    out = []
    for a, b in pairwise(np.cumsum([0, *held])):
        mine = number[a:b]
        n = run_first[mine + 1] - run_first[mine]
        pick = np.repeat(run_first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(_numbers(np.concatenate([[len(n)], n, span[pick], value[pick].view(np.uint64)]).astype(np.uint64)))
    return pa.table({"bin": group.column("bin"), "block": group.column("block"), "runs": pa.array(out, pa.binary())})


def _cover(joined: DataFrame, length: int, bins: int, doc_id: str) -> DataFrame:
    """Covers the strings of each block that a smaller id holds as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, b in _blocks(batches, length, bins):
            taken, number, known, where = b.local(_marked(row, b))
            mine = np.argsort(where, kind="stable")
            answers = {r["bin"]: r["runs"] for r in row["runs"] or ()}
            spans, values, counts = [], [], []
            for k in np.unique(where).tolist():
                told = _read_numbers(answers[k])
                n = int(told[0])
                each = told[1 : n + 1].astype(np.int64)
                runs = int(each.sum())
                counts.append(each)
                spans.append(told[n + 1 : n + 1 + runs].astype(np.int64))
                values.append(told[n + 1 + runs :].view(np.int64))
            edge = np.zeros(len(b.data) + 1, np.int32)
            if len(taken):
                # String by string: the smallest id by distinct stretch, then by stretch of the block.
                place = np.empty(len(mine), np.int64)
                place[mine] = np.arange(len(mine))
                least = np.repeat(np.concatenate(values), np.concatenate(spans))
                sizes = np.array([len(s) for s in known], dtype=np.int64)[mine] - (length - 1)
                begin = (np.cumsum(sizes) - sizes)[place[number]]
                n = b.last[taken] - b.first[taken]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(b.first[taken], n) + within
                covered = start[least[np.repeat(begin, n) + within] < np.repeat(b.ids[b.doc[taken]], n)]
                edge[covered] += 1
                edge[covered + length] -= 1
            removed = np.cumsum(edge[:-1]) > 0
            yield _documents(b, removed, doc_id)

    kept = f"{doc_id} long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(run, kept)


def _documents(b: Block, removed: np.ndarray, doc_id: str) -> pa.RecordBatch:
    ends = np.cumsum(b.sizes)
    begins = ends - b.sizes
    step = np.diff(np.concatenate([[0], removed.view(np.int8), [0]]))
    up, down = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # A run that goes on over the end of a document is one in each.
    cuts = begins[(begins > 0) & (begins < len(removed))]
    cuts = np.unique(cuts[removed[cuts] & removed[cuts - 1]]) if len(cuts) else cuts
    up, down = np.sort(np.append(up, cuts)), np.sort(np.append(down, cuts))
    count = np.append(0, np.cumsum(removed))
    n_removed = count[ends] - count[begins]
    rest = b.data[~removed].tobytes()
    kept_end = np.cumsum(b.sizes - n_removed)
    lo, hi = np.searchsorted(up, begins), np.searchsorted(up, ends)
    spans = [[{"start": int(s - d), "end": int(e - d)} for s, e in zip(up[i:j], down[i:j], strict=True)] for i, j, d in zip(lo, hi, begins, strict=True)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([None if i == NO_ID else i for i in b.ids.tolist()], pa.int64()), pa.array(b.sizes), pa.array(n_removed.astype(np.int64)),
            pa.array(spans, kind), pa.array([rest[e - (s - r) : e] for e, s, r in zip(kept_end.tolist(), b.sizes.tolist(), n_removed.tolist(), strict=True)], pa.binary()),
        ],
        names=[doc_id, "n_bytes", "n_removed", "spans", "kept"],
    )


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_removed``, the removed ``spans`` (bytes) and the ``kept`` bytes."""
    blocks = cut(pack(df, doc_id, text))
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    bins = max(BINS, size // BIN)
    masks = _anchor_rows(blocks, length, bins).groupBy("bin").applyInArrow(_shared, "bin int, block long, mask binary")
    by_block = masks.groupBy("block").agg(F.collect_list(F.struct("bin", "mask")).alias("masks"))
    marked = cut(by_block)
    with_masks = blocks.join(marked, "block", "left")
    found = _stretch_rows(with_masks, length, bins).groupBy("bin").applyInArrow(lambda t: _least_ids(t, length), "bin int, block long, runs binary")
    runs = found.groupBy("block").agg(F.collect_list(F.struct("bin", "runs")).alias("runs"))
    return _cover(blocks.join(marked.join(runs, "block", "left"), "block", "left"), length, bins, doc_id)
