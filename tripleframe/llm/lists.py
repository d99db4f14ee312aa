"""Compare the members of posting lists with each other, whatever the lengths of the lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a list that are compared in one go; longer lists are cut into chunks that meet chunk by chunk.
CHUNK = 1024
#: Pairs that are held at once.
PAIRS = 1 << 20


def meet(postings: DataFrame, member: str, payload: list[str], compare: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray], schema: str, finish) -> DataFrame:
    """Compare all members of equal ``list``, and return what ``finish`` makes of the pairs that pass.

    ``postings`` has ``list`` (long), ``member`` and ``payload``. Lists of one member end in a join with the list lengths. A
    list of over ``CHUNK`` members is cut into chunks, and every two chunks meet in a task of their own, so neither rows nor
    pairs of a long list gather in one task. ``compare`` gets a batch and two arrays of row numbers and returns a mask;
    ``finish`` gets the batch and the pairs that passed, once for some lists at a time.
    """
    lengths = postings.groupBy("list").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    chunks = F.ceil(F.col("_n") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64(member), chunks).cast("int")
    dealt = postings.join(lengths, "list").withColumn("_c", mine).withColumn("_o", F.explode(F.sequence(F.lit(0), chunks - 1)))
    cells = dealt.select("list", member, *payload, "_c", F.least("_c", "_o").alias("_i"), F.greatest("_c", "_o").alias("_j"))
    sorted_cells = cells.repartition("list", "_i", "_j").sortWithinPartitions("list", "_i", "_j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            whole = table.combine_chunks().to_batches()[0]
            ends = _ends(whole)
            last = ends[-2] if len(ends) > 1 else 0
            held = pa.Table.from_batches([whole.slice(last)])
            if last:
                yield from _pairs(whole.slice(0, last), compare, finish)
        if held is not None and held.num_rows:
            yield from _pairs(held.combine_chunks().to_batches()[0], compare, finish)

    return sorted_cells.mapInArrow(run, schema)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _ends(batch: pa.RecordBatch) -> np.ndarray:
    """End of every run of rows of one cell."""
    cell = [_column(batch, n) for n in ("list", "_i", "_j")]
    differs = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
    for c in cell:
        differs |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(differs) + 1, batch.num_rows)


def _pairs(batch: pa.RecordBatch, compare, finish) -> Iterator[pa.RecordBatch]:
    ends = _ends(batch)
    stop = np.repeat(ends, np.diff(np.append(0, ends)))
    chunk, across = _column(batch, "_c"), _column(batch, "_i") != _column(batch, "_j")
    rows = np.arange(batch.num_rows)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    distance, held = 1, 0
    while len(rows := rows[rows + distance < stop[rows]]):
        for at in range(0, len(rows), PAIRS):
            a = rows[at : at + PAIRS]
            b = a + distance
            fits = ~across[a] | (chunk[a] != chunk[b])
            a, b = a[fits], b[fits]
            good = compare(batch, a, b)
            left.append(a[good])
            right.append(b[good])
            held += len(left[-1])
        if held > PAIRS:
            yield from finish(batch, np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
        distance += 1
    if held:
        yield from finish(batch, np.concatenate(left), np.concatenate(right))
