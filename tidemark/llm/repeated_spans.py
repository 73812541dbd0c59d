"""Removal of long byte strings that occur elsewhere, by sorted suffixes and induction.

A string of 400 bytes that occurs twice is found through a sample of the suffixes, which are
sorted; the order and the common prefixes of all others are induced from them:

1. *Sample.* In every window of 400 bytes the 64-byte string with the smallest hash is an
   anchor. Equal windows have equal anchors at equal places, so only windows around an anchor
   that occurs twice can repeat. Anchors are counted over all texts, and single ones leave.
2. *Equal surroundings.* Anchors whose surroundings (all windows they stand for) are equal to
   another's, told by 128 bits of hashes, are repeated as a whole; one of them stands for all in
   the next step.
3. *Sorted sample suffixes.* The remaining suffixes are dealt by anchor and sorted by Spark's
   external sort, which spills to disk: the queue of suffix tuples.
4. *Induction.* From the sorted suffixes at the anchors, with the common-prefix lengths of
   neighbours, the suffixes one byte further left follow by a stable distribution on that
   byte; a common prefix grows by one within an equal byte, or is the minimum over the suffixes
   between. It is repeated up to the first window that the anchor stands for. A window repeats
   if its suffix has a common prefix of 400 bytes with a neighbour.

Groups of one anchor with very many different surroundings are not sorted in one task: their
windows are counted by 128-bit hash, which gives the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import Slab, mix, slabs
from tidemark.llm.common import documents, shuffle_partitions, stored

LENGTH = 400
ANCHOR = 64
# Different surroundings of one anchor that are sorted in one task.
MOST_IN_GROUP = 20_000
# Suffixes held at once while inducing.
HELD_ROWS = 30_000
# Windows looked at together, and bits that tell their places apart.
_STEP = 1 << 16
_PLACE_BITS = 20

_PLACES = "doc_id long, text_hash long, anchor long, around long, around_b long, at long, near long, far long"


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 64 bytes from each position."""
    hashes = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    words = np.ascontiguousarray(hashes).view(np.uint64).ravel()
    width = 8
    while width < ANCHOR:
        words = words[: len(words) - width] * np.uint64(0x9E3779B97F4A7C15) + words[width:]
        words ^= words >> np.uint64(29)
        words *= np.uint64(0xBF58476D1CE4E5B9)
        width *= 2
    return words


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    done, minima = 1, values
    while done < width:
        step = min(done, width - done)
        minima = np.minimum(minima[: len(minima) - step], minima[step:])
        done += step
    return minima


def anchors(
    data: np.ndarray, offsets: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of some texts in a row: hash, position, first and last window start each stands for.

    The anchor of a window is the place of its smallest hash (the upper bits of it), of several
    the last one: windows of equal bytes have it at the same place.
    """
    spots = length - ANCHOR + 1
    low = np.uint64((1 << _PLACE_BITS) - 1)
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(data) - length + 1, _STEP):
        part = data[begin : begin + _STEP + length - 1]
        hashes = _anchor_hashes(part)
        ranked = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
        place = (low - (_window_minima(ranked, spots) & low)).astype(np.int64)
        start = np.arange(len(place)) + begin
        text_end = offsets[np.searchsorted(offsets, start, side="right")]
        inside = start + length <= text_end
        start, place, text_end = start[inside], place[inside], text_end[inside]
        if len(start):
            cut = np.flatnonzero((place[1:] != place[:-1]) | (text_end[1:] != text_end[:-1])) + 1
            first = np.concatenate([[0], cut])
            last = np.concatenate([cut, [len(start)]]) - 1
            found.append((hashes[place[first]], place[first] + begin, start[first], start[last]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    code, at, first, last = (np.concatenate(x) for x in zip(*found))
    # An anchor whose windows lie in two steps.
    new = np.concatenate([[True], (at[1:] != at[:-1])])
    return code[new], at[new], first[new], last[np.concatenate([np.flatnonzero(new)[1:], [len(at)]]) - 1]


def _places(docs: DataFrame, length: int) -> DataFrame:
    """Anchors of all texts, with a hash of the surroundings.

    ``near`` and ``far``: the least and largest distance from a window's start to the anchor.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first_row, _, slab in slabs(batch.column(2)):
                code, at, first, last = anchors(slab.data, slab.offsets, length)
                owner = np.searchsorted(slab.offsets, at, side="right") - 1
                around = slab.span_hashes(first, last + length)
                # Equal surroundings have the anchor at the same place.
                around = mix(around ^ (at - first).astype(np.uint64))
                # A second hash of its own: with other values for the bytes, A-Z as a-z.
                around_b = slab.span_hashes(first, last + length, fold=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[first_row + i] for i in owner.tolist()], pa.int64()),
                        pa.array([hashes[first_row + i] for i in owner.tolist()], pa.int64()),
                        pa.array(code.view(np.int64)),
                        pa.array(around.view(np.int64)),
                        pa.array(around_b.view(np.int64)),
                        pa.array(at - slab.offsets[owner]),
                        pa.array(at - last),
                        pa.array(at - first),
                    ],
                    names=["doc_id", "text_hash", "anchor", "around", "around_b", "at", "near", "far"],
                )

    return docs.select("doc_id", "text_hash", "text").mapInArrow(work, _PLACES)


def _cut_suffixes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes around the wanted places: rightwards from the anchor, and leftwards before it."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, code, text, places in zip(frame["doc_id"], frame["text_hash"], frame["text"], frame["places"]):
                data = text.encode()
                for p in places:
                    at, near, far = p["at"], p["near"], p["far"]
                    right = data[at : at - near + length]
                    left = data[at - far : at][::-1]
                    rows.append((p["anchor"], right, left, name, code, at, near, far, p["whole"], p["large"]))
            names = ["anchor", "right", "left", "doc_id", "text_hash", "at", "near", "far", "whole", "large"]
            yield pd.DataFrame(rows, columns=names)

    lists = wanted.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("anchor", "at", "near", "far", "whole", "large")).alias("places")
    )
    # Repeated rows of a document are the same text.
    both = docs.join(lists, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "places")
    return both.mapInPandas(
        work,
        "anchor long, right binary, left binary, doc_id long, text_hash long, at long, near long, far long,"
        " whole boolean, large boolean",
    )


def _range_minima(values: np.ndarray) -> list[np.ndarray]:
    """Tables of minima over 1, 2, 4, ... consecutive values."""
    tables = [values]
    width = 1
    while 2 * width <= len(values):
        tables.append(np.minimum(tables[-1][: len(tables[-1]) - width], tables[-1][width:]))
        width *= 2
    return tables


def _minimum_between(tables: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of the values from ``low`` to ``high``, both included."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), dtype=tables[0].dtype)
    for k in np.unique(level).tolist():
        mine = level == k
        out[mine] = np.minimum(tables[k][low[mine]], tables[k][high[mine] - (1 << k) + 1])
    return out


def induce(
    group: np.ndarray, right: list[bytes], left: list[bytes], near: np.ndarray, far: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray]:
    """Windows that repeat among suffixes sorted by group and right side.

    Returns (row, distance) of every window, of those each row stands for, that another row of
    its group holds as well.
    """
    size = len(group)
    # Common prefixes of neighbouring suffixes, at most ``length``.
    wide = np.zeros((size, length), dtype=np.int16)
    for k, value in enumerate(right):
        part = np.frombuffer(value, dtype=np.uint8)[:length]
        wide[k, : len(part)] = part
        wide[k, len(part) :] = -1 - (k & 1)
    common = np.zeros(size, dtype=np.int64)
    if size > 1:
        differ = wide[1:] != wide[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        common[1:][group[1:] != group[:-1]] = 0
    del wide
    tables = _range_minima(common)
    reach = max(map(len, left), default=0)
    before = np.full((size, reach + 1), -1, dtype=np.int16)
    for k, value in enumerate(left):
        before[k, : len(value)] = np.frombuffer(value, dtype=np.uint8)
    # Rows ordered by (class, rank): a class holds suffixes that agree left of the anchor.
    rows = np.arange(size)
    label = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if size else rows
    found_rows, found_distance = [], []
    for distance in range(int(far.max(initial=-1)) + 1):
        if distance:
            byte = before[rows, distance - 1]
            alive = (byte >= 0) & (far[rows] >= distance)
            rows, label, byte = rows[alive], label[alive], byte[alive].astype(np.int64)
            code = label * 256 + byte
            order = np.argsort(code, kind="stable")
            rows, code = rows[order], code[order]
            new = np.concatenate([[True], code[1:] != code[:-1]]) if len(code) else np.zeros(0, bool)
            alone = new & np.concatenate([new[1:], [True]]) if len(code) else new
            rows = rows[~alone]
            label = (np.cumsum(new) - 1)[~alone]
        if len(rows) < 2:
            break
        same = label[1:] == label[:-1]
        prefix = np.zeros(len(rows) - 1, dtype=np.int64)
        prefix[same] = _minimum_between(tables, rows[:-1][same] + 1, rows[1:][same]) + distance
        long_enough = same & (prefix >= length)
        hit = np.zeros(len(rows), dtype=bool)
        hit[1:] |= long_enough
        hit[:-1] |= long_enough
        hit &= near[rows] <= distance
        found_rows.append(rows[hit])
        found_distance.append(np.full(int(hit.sum()), distance))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_rows]), np.concatenate([none, *found_distance])


def _runs(rows: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with the bounds of their runs of consecutive distances."""
    order = np.lexsort((distance, rows))
    rows, distance = rows[order], distance[order]
    if not len(rows):
        return rows, distance, distance
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (distance[1:] != distance[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(rows)]]) - 1
    return rows[first], distance[first], distance[last]


_SPANS = "doc_id long, text_hash long, start long, stop long"


def _induced(suffixes: DataFrame, partitions: int, length: int) -> DataFrame:
    """Repeated spans among suffixes that are dealt by anchor and sorted."""

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        near, far = frame["near"].to_numpy(), frame["far"].to_numpy()
        rows, distance = induce(frame["anchor"].to_numpy(), list(frame["right"]), list(frame["left"]), near, far, length)
        mine = ~frame["whole"].to_numpy()[rows]
        rows, low, high = _runs(rows[mine], distance[mine])
        at = frame["at"].to_numpy()[rows]
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].array[rows],
                "text_hash": frame["text_hash"].to_numpy()[rows],
                "start": at - high,
                "stop": at - low + length,
            }
        )

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size >= HELD_ROWS:
                whole = pd.concat(held, ignore_index=True)
                code = whole["anchor"].to_numpy()
                cut = int(np.flatnonzero(code != code[-1])[-1]) + 1 if (code != code[-1]).any() else 0
                if cut:
                    yield settle(whole.iloc[:cut].reset_index(drop=True))
                held = [whole.iloc[cut:].reset_index(drop=True)]
                size = len(held[0])
        if size:
            yield settle(pd.concat(held, ignore_index=True))

    dealt = suffixes.repartition(partitions, "anchor").sortWithinPartitions("anchor", "right")
    return dealt.mapInPandas(work, _SPANS)


def _counted_windows(suffixes: DataFrame, length: int) -> DataFrame:
    """Repeated spans of anchors with very many surroundings: every window counted by its hash."""

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                data = r.left[::-1] + r.right
                for distance in range(r.near, r.far + 1):
                    begin = r.far - distance
                    code = hashlib.blake2b(data[begin : begin + length], digest_size=16).digest()
                    rows.append((code, r.doc_id, r.text_hash, r.at - distance, r.whole))
            yield pd.DataFrame(rows, columns=["code", "doc_id", "text_hash", "start", "whole"])

    windows = stored(suffixes.mapInPandas(explode, "code binary, doc_id long, text_hash long, start long, whole boolean"))
    counts = windows.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("code")
    spans = windows.where("not whole").join(counts, "code", "left_semi")
    return spans.select("doc_id", "text_hash", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, most_in_group: int = MOST_IN_GROUP) -> DataFrame:
    """Spans that are covered by strings of ``length`` bytes that start elsewhere as well.

    ``keyed``: doc_id and text (not null) and text_hash.
    """
    partitions = shuffle_partitions(keyed.sparkSession)
    places = stored(_places(keyed, length))
    counted = places.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("around", "around_b") for name, f in (("low", F.min), ("high", F.max))],
    )
    mixed = (F.col("low_around") != F.col("high_around")) | (F.col("low_around_b") != F.col("high_around_b"))
    often = stored(counted.where("n > 1").select("anchor", mixed.alias("mixed")))
    # Both sides are shuffled for this join alone, so Spark can split the places of a hot anchor.
    shared = stored(places.join(often.select("anchor", "mixed"), "anchor"))
    whole_span = ["doc_id", "text_hash", (F.col("at") - F.col("far")).alias("start"), (F.col("at") - F.col("near") + length).alias("stop")]
    alike = shared.where("not mixed").select(*whole_span)
    mixed = shared.where("mixed")
    row = F.struct("doc_id", "text_hash", "at", "near", "far")
    same = ["anchor", "around", "around_b"]
    kinds = stored(mixed.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("row")))
    copied = mixed.join(kinds.where("n > 1").select(*same), same, "left_semi").select(*whole_span)
    large = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > most_in_group)
    wanted = kinds.join(large.select("anchor", F.lit(True).alias("large")), "anchor", "left").select(
        "anchor", "row.*", (F.col("n") > 1).alias("whole"), F.coalesce("large", F.lit(False)).alias("large")
    )
    suffixes = _cut_suffixes(keyed, wanted, length)
    suffixes = stored(suffixes, "large")
    induced = _induced(suffixes.where("not large").drop("large"), partitions, length)
    counted = _counted_windows(suffixes.where("large").drop("large"), length)
    return alike.unionByName(copied).unionByName(induced).unionByName(counted)


def remove_repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    most_in_group: int = MOST_IN_GROUP,
    with_text: bool = True,
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts elsewhere.

    Columns: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256``, ``spans`` (their bounds) and, with ``with_text``, ``kept`` (the remaining
    bytes). Null text counts as empty and null ids stay. A repeated row is a document of its
    own: its whole text, if long enough, starts elsewhere. Other columns are ignored. An empty
    table gives none.
    """
    # Several rows with one id and one text can't be told apart: each is a copy of the others.
    base = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text", F.length("text")))
    # Places are known by id and text; a null id counts as 0 among them, which is no matter, since
    # equal texts have equal spans.
    base = base.withColumn("doc_key", F.coalesce("doc_id", F.lit(0)))
    keyed = base.where(F.octet_length("text") >= length).select(F.col("doc_key").alias("doc_id"), "text_hash", "text")
    spans = repeated_spans(keyed, length, most_in_group).withColumnRenamed("doc_id", "doc_key")
    lists = spans.groupBy("doc_key", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    joined = base.join(lists, ["doc_key", "text_hash"], "left")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, text, found in zip(frame["doc_id"], frame["text"], frame["found"]):
                data = text.encode()
                merged: list[list[int]] = []
                for start, stop in sorted((f["start"], f["stop"]) for f in (found if found is not None else ())):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(stop, merged[-1][1])
                    else:
                        merged.append([start, stop])
                kept, done = [], 0
                for start, stop in merged:
                    kept.append(data[done:start])
                    done = stop
                rest = b"".join([*kept, data[done:]])
                removed = len(data) - len(rest)
                digest = hashlib.sha256(rest).hexdigest()
                rows.append((name, len(data), removed, len(merged), digest, merged, rest if with_text else None))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = frame["doc_id"].array
            yield out

    return joined.select("doc_id", "text", "found").mapInPandas(
        cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " spans array<array<long>>, kept binary",
    )


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table; the last column tells documents that lose anything."""
    found = remove_repeats(documents(spark, sf_dir), with_text=False).drop("spans", "kept")
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


QUERIES = {"op1_suffix_array": op1_suffix_array}
ORACLES: dict[str, str] = {}
