"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Each text has two ascending lists of token ends, A's and B's. Merging them takes one step a token; a diagonal of the merge
grid is all places after the same number of steps, and a binary search finds where the merge crosses it. Diagonals every
``WIDTH`` steps divide the merge of a whole block of texts into pieces of equal work that know nothing of each other and are
merged side by side, whatever the lengths of the texts. A piece emits the overlaps of an A and a B token and counts the places
where both end; running sums of the counts stitch a group that crosses borders of pieces. Such places cut the text into
groups, and every A and B token of a group are linked.

1. Blocks of texts are coded, merged and reduced to a dictionary of linked id pairs per block; each document keeps its pairs as
   places in the dictionary with their numbers of occurrence. Pairs of a large group come from its distinct ids, not from its
   occurrences.
2. The dictionaries give, for every id pair, the documents that hold it (partial sums per block, so a frequent pair is a row
   per block), and from these the highest count of every A id.
3. Counts go back to the dictionaries, and every block meets its documents again.

Null and empty texts, and texts whose joined A or B bytes differ from a space and the text, have no tokens: zeros and an empty
digest. Every row is a document, repeated rows and ids too. Other columns are carried, but give way to a result of their name.
Ties for the highest count all count. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripleframe.llm.common import slices
from tripleframe.session import cut

#: Steps of a piece of the merge.
WIDTH = 64
#: Texts and bytes of a block, at most; a longer text is a block of its own.
TEXTS, BYTES = 8192, 2 << 20
# Fixed value: how byte-level files cut a text into words before they merge.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Link occurrences of a group from which its pairs come from distinct ids.
LARGE = 256
#: Dictionary entries in a row.
CHUNK = 8192

RESULTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256"]
_CODED = "block long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, places array<int>, times array<long>, base int, pairs array<long>, holders array<int>"


def diagonals(a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Items of ``a`` among the first ``steps`` of the merge of two ascending arrays; equal ends of ``a`` come first."""
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        at = np.flatnonzero(open_)
        middle = (low[at] + high[at]) // 2
        before = a[middle] <= b[steps[at] - 1 - middle]
        low[at[before]] = middle[before] + 1
        high[at[~before]] = middle[~before]
    return low


def merge(a: np.ndarray, b: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of two ascending lists of ends that end alike: group of each A and each B token, and the overlaps (A, B)."""
    total = len(a) + len(b)
    begin = np.arange(0, max(total, 1), width)
    i = diagonals(a, b, begin)
    j = begin - i
    stop = np.minimum(begin + width, total)
    of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    closed = np.zeros(len(begin), np.int64)
    pieces_a, pieces_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    left, right = [], []
    # An end beyond all others stands behind each list.
    far = np.int64(np.iinfo(np.int64).max)
    a_far, b_far = np.append(a, far), np.append(b, far)
    rows = np.arange(len(begin)) if total else np.empty(0, np.int64)
    for step in range(width):
        rows = rows[begin[rows] + step < stop[rows]]
        if not len(rows):
            break
        x, y = i[rows], j[rows]
        is_a = a_far[x] <= b_far[y]
        # The B token that ends where the last A token ended closes the group; between the two nothing overlaps.
        closes = ~is_a & (x > 0) & (a_far[x - 1] == b_far[y])
        left.append(x[~closes])
        right.append(y[~closes])
        on_a, on_b = rows[is_a], rows[~is_a]
        of_a[x[is_a]], pieces_a[x[is_a]] = closed[on_a], on_a
        of_b[y[~is_a]], pieces_b[y[~is_a]] = closed[on_b], on_b
        i[on_a] += 1
        j[on_b] += 1
        closed[rows[closes]] += 1
    before = np.cumsum(closed) - closed
    if total:
        of_a += before[pieces_a]
        of_b += before[pieces_b]
    empty = [np.empty(0, np.int64)]
    return of_a, of_b, np.concatenate(left or empty), np.concatenate(right or empty)


def byte_level(token: str, bytes_of: dict[str, int]) -> bytes:
    """Bytes of an entry of a byte-level vocabulary."""
    return bytes(bytes_of[c] for c in token)


def byte_characters() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def ranked_coder(path: str, bytes_of: dict[str, int]):
    """A coder of the ``tiktoken`` library for a byte-level file, none where that library would not give the file's ids.

    It gives them if ids rank as merges do, words are cut by the usual expression, and the text is not changed before.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cutter = told["model"], told.get("pre_tokenizer") or {}
    vocabulary = {byte_level(t, bytes_of): i for t, i in model["vocab"].items() if t not in {a["content"] for a in told.get("added_tokens", [])}}
    merged = [m.split(" ", 1) if isinstance(m, str) else m for m in model.get("merges") or []]
    ranks = [model["vocab"].get(x + y) for x, y in merged]
    plain = told.get("normalizer") is None and (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex", True)) == ("ByteLevel", False, True)
    if not plain or None in ranks or ranks != sorted(ranks) or len(vocabulary) != len(merged) + 256 or model.get("dropout") or model.get("ignore_merges"):
        return None
    return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=vocabulary, special_tokens={})


class Coders:
    """Both tokenizers of a task, with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str, ranked: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocabulary, bytes_of = self.a.get_vocab(), byte_characters()
        self.ranked = ranked_coder(a_path, bytes_of) if ranked else None
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = byte_level(token, bytes_of)
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.bytes_b = [piece(i) for i in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        self.told_a, self.told_b = ([[f"{i}{end}".encode() for i in range(len(known))] for end in ends] for known, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")))

    def code(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """A's and B's ids of each text, none where the bytes do not fit."""
        out: list[tuple[list[int], list[int]] | None] = []
        # The library of the file keeps much about each token, so it gets few texts at a time.
        for at in range(0, len(texts), 32):
            some = texts[at : at + 32]
            spaced = [" " + t for t in some]
            found_a = [self.ranked.encode_ordinary(t) for t in spaced] if self.ranked else [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
            for text, whole, a, b in zip(some, spaced, found_a, self.b.encode(some, num_threads=1), strict=True):
                data = whole.encode()
                fits = text and b"".join(map(self.bytes_a.__getitem__, a)) == data and b"".join(map(self.bytes_b.__getitem__, b)) == data
                out.append((a, b) if fits else None)
        return out


def linked_pairs(a_ids: np.ndarray, b_ids: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair of ids as one number, occurrences) of all links; pairs of one group may come more than once."""
    groups = int(of_a[-1]) + 1 if len(of_a) else 0
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    number = n_a * n_b
    small = np.flatnonzero(number <= LARGE)
    group = np.repeat(small, number[small])
    ends = np.cumsum(number[small])
    at = np.arange(len(group)) - np.repeat(ends - number[small], number[small])
    pair = (a_ids[first_a[group] + at // n_b[group]] << 32) | b_ids[first_b[group] + at % n_b[group]]
    parts = [(group, pair, np.ones(len(group), np.int64))]
    for g in np.flatnonzero(number > LARGE):
        a, times_a = np.unique(a_ids[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(b_ids[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        pairs = (a[:, None] << 32 | b).ravel()
        parts.append((np.full(len(pairs), g), pairs, (times_a[:, None] * times_b).ravel()))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _block(coders: Coders, texts: list[str], block: int, rows: pa.Array) -> Iterator[pa.RecordBatch]:
    """The documents of a block, then its dictionary."""
    coded = coders.code(texts)
    counts = np.array([[len(c[0]), len(c[1])] if c else [0, 0] for c in coded], np.int64).reshape(-1, 2)
    a_ids, b_ids = (np.fromiter(itertools.chain.from_iterable(c[side] for c in coded if c), np.int64, int(counts[:, side].sum())) for side in (0, 1))
    # Texts laid end to end: both sides have the same bytes, so a group never crosses two texts.
    of_a, of_b, over_a, _ = merge(np.cumsum(coders.sizes_a[a_ids]), np.cumsum(coders.sizes_b[b_ids]))
    doc_a = np.repeat(np.arange(len(texts)), counts[:, 0])
    groups = int(of_a[-1]) + 1 if len(of_a) else 0
    doc_of = np.zeros(groups, np.int64)
    doc_of[of_a] = doc_a
    n_groups = np.bincount(doc_of, minlength=len(texts))
    n_overlaps = np.bincount(doc_a[over_a], minlength=len(texts))
    group, pair, times = linked_pairs(a_ids, b_ids, of_a, of_b)
    pairs, place = np.unique(pair, return_inverse=True)
    width = max(1, len(pairs))
    held, inverse = np.unique(doc_of[group] * width + place, return_inverse=True)
    number = np.zeros(len(held), np.int64)
    np.add.at(number, inverse, times)
    doc, place = held // width, held % width
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, doc, number)
    ends = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
    made = {
        "block": pa.array(np.full(len(texts), block)),
        **{n: pa.array(v.astype(np.int64)) for n, v in (("n_a", counts[:, 0]), ("n_b", counts[:, 1]), ("n_groups", n_groups), ("n_links", n_links), ("n_overlaps", n_overlaps))},
        "groups_sha256": pa.array(_told(coders, a_ids, b_ids, of_a, of_b, counts, groups)),
        "places": pa.ListArray.from_arrays(pa.array(ends), pa.array(place.astype(np.int32))),
        "times": pa.ListArray.from_arrays(pa.array(ends), pa.array(number)),
        "base": pa.nulls(len(texts), pa.int32()),
        "pairs": pa.nulls(len(texts), pa.list_(pa.int64())),
        "holders": pa.nulls(len(texts), pa.list_(pa.int32())),
    }
    yield pa.RecordBatch.from_arrays([rows, *made.values()], names=["_row", *made])
    holders = np.bincount(place, minlength=len(pairs)).astype(np.int32)
    starts = np.arange(0, len(pairs), CHUNK)
    if len(starts):
        edges = pa.array(np.append(starts, len(pairs)).astype(np.int32))
        told = {
            "block": pa.array(np.full(len(starts), block)),
            **{n: pa.nulls(len(starts), pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")},
            "groups_sha256": pa.nulls(len(starts), pa.string()),
            "places": pa.nulls(len(starts), pa.list_(pa.int32())),
            "times": pa.nulls(len(starts), pa.list_(pa.int64())),
            "base": pa.array(starts.astype(np.int32)),
            "pairs": pa.ListArray.from_arrays(edges, pa.array(pairs)),
            "holders": pa.ListArray.from_arrays(edges, pa.array(holders)),
        }
        yield pa.RecordBatch.from_arrays([pa.nulls(len(starts), rows.type), *told.values()], names=["_row", *told])


def _told(coders: Coders, a_ids: np.ndarray, b_ids: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, counts: np.ndarray, groups: int) -> list[str]:
    """Digest of each document's groups as ``a,a|b;a|b,b``; the empty text without tokens."""
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    # All of a group's A tokens come before its B tokens; the last of either side ends with its sign.
    at_a = np.arange(len(a_ids)) + (np.cumsum(n_b) - n_b)[of_a]
    at_b = np.arange(len(b_ids)) + np.cumsum(n_a)[of_b]
    size_a, size_b = len(coders.bytes_a), len(coders.bytes_b)
    last_a, last_b = (np.append(of[1:] != of[:-1], True) if len(of) else np.empty(0, bool) for of in (of_a, of_b))
    code = np.empty(len(a_ids) + len(b_ids), np.int64)
    code[at_a] = a_ids + size_a * last_a
    code[at_b] = 2 * size_a + b_ids + size_b * last_b
    table = coders.told_a[0] + coders.told_a[1] + coders.told_b[0] + coders.told_b[1]
    out, at = [], 0
    for n in counts.sum(axis=1).tolist():
        text = b"".join([table[c] for c in code[at : at + n].tolist()])
        out.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
        at += n
    return out


def _packed(kept: list[str]) -> Column:
    """The kept columns as one, so that none clashes with a name used here."""
    return F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("_")]).alias("_row")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """The given columns without the text, and ``RESULTS``: tokens of either side, groups, links, overlaps, links of the
    highest count, sum of counts over links, digest of the groups.

    The paths are of files that every machine has (part of an installed package, or shipped with ``addFile``).
    """
    kept = [c for c in docs.columns if c != text and c not in RESULTS]
    source = docs.select(_packed(kept), F.col(f"`{text}`").cast("string").alias("_text"), F.monotonically_increasing_id().alias("_at"))
    row = StructField("_row", source.schema["_row"].dataType)
    schema = StructType([row, *StructType.fromDDL(_CODED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = Coders(a_path, b_path)
        for batch in slices(batches, TEXTS, BYTES):
            # The number of a block's first row is no other block's.
            yield from _block(coders, [t or "" for t in batch.column(1).to_pylist()], batch.column(2)[0].as_py(), batch.column(0))

    coded = cut(source.mapInArrow(run, schema))
    entries = coded.where("pairs IS NOT NULL").select("block", "base", F.posexplode(F.arrays_zip("pairs", "holders")).alias("at", "e"))
    entries = entries.select("block", (F.col("base") + F.col("at")).alias("place"), F.col("e.pairs").alias("pair"), F.col("e.holders").alias("holders"))
    counted = cut(entries.groupBy("pair").agg(F.sum("holders").alias("count")))
    highest = counted.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))
    known = counted.join(highest, F.shiftright(counted["pair"], 32) == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    looked_up = entries.join(known, "pair").select(F.col("block").alias("owner"), "place", "count", "best")
    documents = coded.where("pairs IS NULL").select("_row", "block", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "places", "times")
    results = "n_a long, n_b long, n_groups long, n_links long, n_overlaps long, n_best long, count_sum long, groups_sha256 string"

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        order = np.argsort(right.column("place").to_numpy())
        count, best = (right.column(n).to_numpy()[order].astype(np.int64) for n in ("count", "best"))
        places, times = (left.column(n).combine_chunks() for n in ("places", "times"))
        doc = np.repeat(np.arange(left.num_rows), np.diff(places.offsets.to_numpy()))
        at, n = places.flatten().to_numpy(), times.flatten().to_numpy()
        sums = []
        for value in (best[at] * n, count[at] * n):
            total = np.zeros(left.num_rows, np.int64)
            np.add.at(total, doc, value)
            sums.append(pa.array(total))
        plain = ["_row", "n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
        return pa.table([*[left.column(n) for n in plain], *sums, left.column("groups_sha256")], names=["_row", *RESULTS])

    told = documents.groupBy("block").cogroup(looked_up.groupBy("owner")).applyInArrow(weigh, StructType([row, *StructType.fromDDL(results).fields]))
    return told.select(*[F.col(f"_row.`{c}`") for c in kept], *RESULTS)
