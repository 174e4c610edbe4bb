"""Keys that occur more than once, without shuffling those that occur once.

Every key has a slot of a table with two bits a slot: seen, and seen again.
Map tasks fill their own table, two packed bit planes of 64 MB at most; Spark
groups the tables by their runs, and a group adds them as they stream in (seen
again is what either side saw again, or both saw), so its memory depends on
neither rows nor tasks.  A key whose slot was seen only once is certainly
unique.  The rows of the other keys, the repeated ones
and a few that share a slot, are counted exactly.  The table's size is fixed
beforehand from the number of rows and bounded, so its second bit plane (32 MB
at most) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.plans.scale import staged

#: log2 of the slots of one run; a run is what tasks send and reducers merge.
RUN_BITS = 15
#: log2 of the fewest and most slots: 2 ** 28 slots are two planes of 32 MB.
MIN_BITS, MAX_BITS = 15, 28
#: Slots wanted for each row: with 16, about a sixteenth of the unique keys share a slot.
SLOTS_PER_ROW = 16

_WORDS = (1 << RUN_BITS) // 64
#: Runs (a power of two) that are sent in one batch and merged as one group.
_GROUP_RUNS = 32
_RUNS = "run long, once array<long>, again array<long>"


def table_bits(rows: int) -> int:
    """log2 of the slots for so many rows."""
    return min(max((max(rows, 1) * SLOTS_PER_ROW - 1).bit_length(), MIN_BITS), MAX_BITS)


def _slot(keys: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), 64 - bits)


def _planes(once: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    """The runs of a part of the bit planes (bytes) that hold anything, as rows."""
    a, b = (p.view("<i8").reshape(-1, _WORDS) for p in (once, again))
    used = np.flatnonzero(a.any(axis=1))
    offsets = pa.array(np.arange(len(used) + 1, dtype=np.int32) * _WORDS)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[used].ravel())) for x in (a, b)]
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), *lists], names=["run", "once", "again"])


def _filler(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # two bits a slot: a task holds 2 ** bits / 4 bytes, 64 MB at most
        once, again = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            slots, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            byte, bit = slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8)
            first = np.flatnonzero(np.diff(byte, prepend=-1))
            at, seen = byte[first], np.bitwise_or.reduceat(bit, first)
            again[at] |= np.bitwise_or.reduceat(np.where(n > 1, bit, np.uint8(0)), first) | (once[at] & seen)
            once[at] |= seen
        step = _GROUP_RUNS * _WORDS * 8
        for i in range(0, len(once), step):
            out = _planes(once[i : i + step], again[i : i + step])
            if out.num_rows:
                yield out.set_column(0, "run", pa.array(out.column(0).to_numpy() + i // (_WORDS * 8)))

    return fill


def _merged(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of one group that hold a slot seen again: the tables of all
    tasks are added row by row, a saturating addition on two bits a slot."""
    runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in tables:
        once, again = (batch.column(c).flatten().to_numpy().reshape(-1, _WORDS) for c in ("once", "again"))
        for run, x, y in zip(batch.column("run").to_pylist(), once, again):
            if run not in runs:
                runs[run] = (np.zeros(_WORDS, np.int64), np.zeros(_WORDS, np.int64))
            one, two = runs[run]
            two |= y | (one & x)
            one |= x
    found = [(run, two) for run, (_, two) in runs.items() if two.any()]
    if found:
        offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * _WORDS)
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([two for _, two in found])))
        yield pa.RecordBatch.from_arrays([pa.array([run for run, _ in found], pa.int64()), lists], names=["run", "again"])


def repeat_table(df: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(run, again: 512 words): the slots of 2 ** ``bits`` that more than one
    row of ``df`` falls into, in runs of 2 ** 15 slots."""
    filled = df.select(_slot(keys, bits).alias("s")).mapInArrow(_filler(bits), _RUNS)
    group = F.shiftright("run", _GROUP_RUNS.bit_length() - 1)
    return filled.groupBy(group).applyInArrow(_merged, "run long, again array<long>")


def suspects(df: DataFrame, keys: list[str], bits: int | None = None) -> DataFrame:
    """The rows of ``df`` whose key may occur more than once: all rows of
    every key that does, and some others.  Nulls are equal to each other."""
    if bits is None:
        bits = table_bits(df.count())
    table = staged(repeat_table(df, keys, bits))  # at most 2 ** bits / 8 bytes: 32 MB
    slot = _slot(keys, bits)
    run, place = F.shiftright("_slot", RUN_BITS), F.col("_slot").bitwiseAND((1 << RUN_BITS) - 1)
    word = F.get("_again", F.shiftright(place, 6).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    marked = df.withColumn("_slot", slot).withColumn("_run", run)
    hit = marked.join(F.broadcast(table.toDF("_run", "_again")), "_run").filter(word.bitwiseAND(bit) != 0)
    return hit.select(*df.columns)


def repeated_keys(df: DataFrame, keys: list[str], bits: int | None = None) -> DataFrame:
    """The keys of ``df`` that occur more than once, with ``occurrences``;
    exact, whatever shares a slot.  Only suspects are shuffled.  With more
    rows than the largest table has slots nearly every key would be a suspect:
    then the table is left out and all keys are counted."""
    rows, n = df.select(*keys), df.count() if bits is None else 0
    if n <= 1 << MAX_BITS:
        rows = suspects(rows, keys, bits or table_bits(n))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


