"""Corpus-wide counts of very many distinct keys, exchanged in packed blocks.

Documents are gathered in batches. A batch sends each of its distinct 64-bit keys once, with
its own count, to the block that owns the key's range; the block adds up the counts of all
batches and answers each batch about its keys. Keys travel sorted, as packed differences, so a
key that a third of all documents hold costs a batch a few bytes, and no task receives more
than a block of distinct keys of each batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import pack, pack_sorted, slabs, unpack, unpack_sorted

SUMMARY = -1
ANSWER_SCHEMA = "batch long, block int, rows binary, totals binary, keys binary"


def gathered(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Gather slabs until they hold about ``limit`` bytes of text; yields a batch number and row ranges.

    The numbers are unique within a job and depend only on the partition and the order of its rows.
    """
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for first, last, slab in slabs(batch.column(text), limit):
            if held and size + len(slab.data) > limit:
                yield number, held
                number, held, size = number + 1, [], 0
            held.append(batch.slice(first, last - first))
            size += len(slab.data)
    if held:
        yield number, held


def messages(batch: int, keys: np.ndarray, counts: np.ndarray, blocks: int, shift: int = 0) -> list[tuple]:
    """Messages of a batch: its ascending distinct keys and their counts, cut by block.

    Keys are known by their row, counted from ``shift``.
    """
    width = (1 << 64) // blocks + 1
    bounds = [min(b * width, (1 << 64) - 1) for b in range(blocks)]
    cuts = [*np.searchsorted(keys, np.array(bounds, dtype=np.uint64)).tolist(), len(keys)]
    cuts[0] = 0
    return [
        (batch, b, lo + shift, pack_sorted(keys[lo:hi]), pack(counts[lo:hi].astype(np.uint32)))
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
        if hi > lo
    ]


def answers(sent: DataFrame, partitions: int, *, with_keys: bool, skip_own: bool) -> DataFrame:
    """Totals of the keys of each message: the batch's rows with an answer, and their totals.

    ``skip_own``: leave out keys that no other batch holds (the batch knows their total);
    otherwise only keys with a total of one are left out. ``with_keys`` repeats the keys.
    One further row per block, of the batch ``SUMMARY``, holds its number of keys with a total
    above zero.
    """

    def settle(group: list[tuple]) -> Iterator[tuple]:
        keys = [unpack_sorted(m[3]) for m in group]
        counts = [unpack(m[4], np.uint32) for m in group]
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(which, np.concatenate(counts), len(distinct)).astype(np.uint64)
        at = 0
        for message, own_keys, own in zip(group, keys, counts):
            mine = totals[which[at : at + len(own_keys)]]
            at += len(own_keys)
            told = np.flatnonzero(mine != own if skip_own else mine > 1)
            if len(told):
                rows = (told + message[2]).astype(np.uint64)
                shown = pack_sorted(own_keys[told]) if with_keys else None
                yield message[0], message[1], pack_sorted(rows), pack(mine[told]), shown
        known = np.array([np.count_nonzero(totals)], dtype=np.uint64)
        yield SUMMARY, group[0][1], None, pack(known), None

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(frames, "block"):
            out = list(settle(group))
            if out:
                yield pd.DataFrame(out, columns=["batch", "block", "rows", "totals", "keys"])

    dealt = sent.repartition(partitions, "block").sortWithinPartitions("block")
    return dealt.mapInPandas(work, ANSWER_SCHEMA)


def grouped(frames: Iterator[pd.DataFrame], key: str) -> Iterator[list[tuple]]:
    """Runs of rows with equal key from frames that are sorted by it."""
    held: list[tuple] = []
    current = None
    for frame in frames:
        place = frame.columns.get_loc(key)
        for row in frame.itertuples(index=False, name=None):
            if held and row[place] != current:
                yield held
                held = []
            current = row[place]
            held.append(row)
    if held:
        yield held


def with_answers(
    own: DataFrame, told: DataFrame, partitions: int, work: Callable[[int, bytes, np.ndarray, np.ndarray, np.ndarray | None], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Hand every batch its own data together with the answers it got.

    ``own``: batch, payload. ``work`` gets the batch number, the payload, the rows with an
    answer, their totals and keys, and yields frames.
    """
    left = own.select("batch", F.lit(-1).alias("block"), F.col("payload").alias("rows"), F.lit(None).cast("binary").alias("totals"), F.lit(None).cast("binary").alias("keys"))
    both = left.unionByName(told.where(F.col("batch") != SUMMARY)).repartition(partitions, "batch").sortWithinPartitions("batch", "block")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(frames, "batch"):
            rest = group[1:]
            rows = np.concatenate([unpack_sorted(r[2]) for r in rest] or [np.zeros(0, np.uint64)]).astype(np.int64)
            totals = np.concatenate([unpack(r[3], np.uint64) for r in rest] or [np.zeros(0, np.uint64)])
            keys = np.concatenate([unpack_sorted(r[4]) for r in rest]) if rest and rest[0][4] is not None else None
            yield from work(group[0][0], group[0][2], rows, totals, keys)

    return both.mapInPandas(run, schema)


def bundle(*parts: bytes) -> bytes:
    """Several byte strings as one."""
    sizes = np.array([len(parts), *map(len, parts)], dtype="<i8")
    return b"".join([sizes.tobytes(), *parts])


def unbundle(data: bytes) -> list[bytes]:
    count = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", count, 8)
    ends = 8 * (count + 1) + np.cumsum(sizes)
    return [data[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist())]
