"""Near duplicates by an exact Jaccard join of word n-grams.

The join is a sparse product of the document by n-gram matrix with itself, cut into blocks of
n-grams, of which only entries that can reach the threshold are ever formed:

1. *Size-derived prefix.* Each document's n-grams are ordered by hash. Two sets of similarity
   3/4 or more lack at most a quarter of each other, so their first quarters plus a margin
   share at least ``least_shared`` n-grams. Only these prefixes are exchanged, each batch of
   documents sending a distinct n-gram once to the block that owns it.
2. *Overlap bound.* A block answers in how many documents an n-gram occurs. A document with
   fewer shared prefix n-grams than its bound has no partner and leaves. The others keep
   their rarest shared n-grams, so many that one of them is shared with every partner.
3. *Equal sets* fall together into one representative.
4. *Product.* Each n-gram's column is first multiplied with one pivot row only. Overlaps of
   the pairs that come up are counted on whole sets. Columns whose documents are by then in
   one component need no more; the others are multiplied in tiles, and pairs from different
   components whose overlap can still reach the threshold are counted on whole sets.
5. Linked sets are joined into components.

Every link between different sets is found or joins two documents already in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import NOT_SPACE, Slab, combine, mix, pack, slabs, unpack
from tidemark.llm.common import documents, shuffle_partitions, stored
from tidemark.llm.exchange import answers, bundle, gathered, grouped, messages, unbundle, with_answers
from tidemark.llm.graph import components

WORDS = 5
BATCH_BYTES = 12 << 20
# Documents along a side of a tile of the product, and columns and pairs looked at at once.
TILE = 1024
SLICE = 4096
PAIRS = 4_000_000

_SENT = "kind string, batch long, block int, first long, keys binary, counts binary, payload binary"
_ARROW_SENT = pa.schema(
    [("kind", pa.string()), ("batch", pa.int64()), ("block", pa.int32()), ("first", pa.int64())]
    + [("keys", pa.binary()), ("counts", pa.binary()), ("payload", pa.binary())]
)
_KEPT = "doc_id long, n long, sign_a long, sign_b long, shared int, kept array<long>"


def _margin(size: np.ndarray) -> np.ndarray:
    return size // 16


def prefix_length(size: np.ndarray) -> np.ndarray:
    """N-grams of a set that are exchanged: one more than it may lack, and a margin."""
    return np.minimum(size, size // 4 + 1 + _margin(size))


def least_shared(size: np.ndarray) -> np.ndarray:
    """Prefix n-grams that a set shares with any partner at least.

    Up to the smaller of the two prefixes' ends both sets are known in full. The set whose
    prefix ends first lacks at most a quarter of its n-grams in the other, so it shares its
    margin and one more; a partner is no smaller than three quarters of the set.
    """
    return 1 + _margin(-(-3 * size // 4))


def shingle_sets(slab: Slab) -> Iterator[np.ndarray]:
    """Each text's set of word n-gram hashes, ascending; of a shorter text the whole sequence."""
    start, end, first = slab.words(NOT_SPACE)
    codes = slab.span_hashes(start, end, fold=True)
    chained = codes
    for j in range(1, WORDS):
        chained = combine(chained[: max(0, len(codes) - j)], codes[j:])
    for lo, hi in zip(first.tolist(), first[1:].tolist()):
        if hi - lo >= WORDS:
            yield np.unique(chained[lo : hi - WORDS + 1])
        elif hi > lo:
            code = codes[lo : lo + 1]
            for j in range(lo + 1, hi):
                code = combine(code, codes[j : j + 1])
            yield code
        else:
            yield codes[:0]


def _signs(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return int(mix(grams).sum().view(np.int64)), int(mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64))


def _prefix_pass(docs: DataFrame, blocks: int, batch_bytes: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, parts in gathered(batches, 1, batch_bytes):
            ids, sizes, signs, prefixes = [], [], [], [np.zeros(0, np.uint64)]
            for part in parts:
                ids += part.column(0).to_pylist()
                for _, _, slab in slabs(part.column(1)):
                    for grams in shingle_sets(slab):
                        sizes.append(len(grams))
                        signs.append(_signs(grams))
                        prefixes.append(grams[: int(prefix_length(np.int64(len(grams))))])
            keys, entries, counts = np.unique(np.concatenate(prefixes), return_inverse=True, return_counts=True)
            payload = bundle(
                pack(np.array([i or 0 for i in ids], dtype=np.int64)),
                pack(np.array([i is not None for i in ids], dtype=np.uint8)),
                pack(np.array(sizes, dtype=np.int64)),
                pack(np.array(signs, dtype=np.int64).reshape(-1)),
                pack(entries.astype(np.uint32)),
            )
            rows = [("sent", *m, None) for m in messages(number, keys, counts, blocks)]
            rows.append(("own", number, None, None, None, None, payload))
            frame = pd.DataFrame(rows, columns=["kind", "batch", "block", "first", "keys", "counts", "payload"])
            yield pa.RecordBatch.from_pandas(frame, schema=_ARROW_SENT, preserve_index=False)

    return docs.mapInArrow(work, _SENT)


def _keep_rarest(
    batch: int, payload: bytes, rows: np.ndarray, totals: np.ndarray, keys: np.ndarray | None
) -> Iterator[pd.DataFrame]:
    """Sizes of a batch's documents, and the rarest shared n-grams of those that may have partners."""
    ids, valid, sizes, signs, entries = unbundle(payload)
    ids, valid, sizes = unpack(ids, np.int64), unpack(valid, np.uint8), unpack(sizes, np.int64)
    signs, entries = unpack(signs, np.int64).reshape(-1, 2), unpack(entries, np.uint32)
    top = int(entries.max()) + 1 if len(entries) else 0
    seen = np.ones(top, dtype=np.int64)
    names = np.zeros(top, dtype=np.uint64)
    if keys is not None:
        seen[rows] = totals
        names[rows] = keys
    ends = np.cumsum(prefix_length(sizes))
    least = least_shared(sizes)
    shared, kept = [], []
    for lo, hi, bound in zip(ends - prefix_length(sizes), ends, least):
        own = entries[lo:hi]
        own = own[seen[own] > 1]
        shared.append(len(own))
        if len(own) >= bound:
            order = np.lexsort((names[own], seen[own]))[: len(own) - bound + 1]
            kept.append(names[own[order]].view(np.int64))
        else:
            kept.append(None)
    doc_ids = pd.array(ids, dtype="Int64")
    doc_ids[valid == 0] = pd.NA
    yield pd.DataFrame(
        {"doc_id": doc_ids, "n": sizes, "sign_a": signs[:, 0], "sign_b": signs[:, 1], "shared": shared, "kept": kept}
    )


def _whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Whole n-gram sets of the representatives (``node``, ``sign_a``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0)
            for first, last, slab in slabs(batch.column(1)):
                sets = list(shingle_sets(slab))
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(first, last - first),
                        pa.array([_signs(s)[0] for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["node", "sign_a", "grams"],
                )

    chosen = docs.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = chosen.select("doc_id", "text").mapInArrow(work, "node long, sign_a long, grams binary")
    same = nodes.select("node", "sign_a")
    return sets.join(same, ["node", "sign_a"], "left_semi").dropDuplicates(["node", "sign_a"]).drop("sign_a")


def _in_tiles(rows: DataFrame, partitions: int, work, schema: str) -> DataFrame:
    """Multiply the rows of each pivot with each other, in tiles of some hundred documents.

    A pivot of any size is spread over tasks of bounded size. ``work`` gets the rows of a tile
    as two lists, and whether they are the same.
    """
    columns = rows.columns
    chunks = rows.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("chunks"))
    dealt = rows.join(chunks, "pivot").withColumn("own", F.pmod(F.xxhash64("node"), "chunks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    tiles = dealt.select("*", other).select(
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *columns
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keyed = (f.assign(tile=list(zip(f["pivot"], f["i"], f["j"]))) for f in frames)
        for group in grouped(keyed, "tile"):
            i, j = group[0][:2]
            sides = [[dict(zip(columns, r[3:])) for r in group if r[2] == side] for side in (i, j)]
            if all(sides) and len({r["component"] for side in sides for r in side}) > 1:
                yield from work(*sides, i == j)

    key = ["pivot", "i", "j"]
    return tiles.repartition(partitions, *key).sortWithinPartitions(*key).mapInPandas(run, schema)


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets.

    The product of two sparse matrices: columns that many rows hold are multiplied as dense
    ones, of the others the pairs of rows are counted.
    """
    cells = len(left) * len(right)
    overlap = np.zeros(cells, dtype=np.int64)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(shared):
        return overlap.reshape(len(left), len(right))
    sides = []
    for side in (left, right):
        grams = np.concatenate(side)
        row = np.repeat(np.arange(len(side)), [len(x) for x in side])
        spot = np.minimum(np.searchsorted(shared, grams), len(shared) - 1)
        known = shared[spot] == grams
        spot, row = spot[known], row[known]
        order = np.argsort(spot, kind="stable")
        sides.append((spot[order], row[order], np.bincount(spot, minlength=len(shared))))
    (spot_a, row_a, count_a), (spot_b, row_b, count_b) = sides
    thick = count_a * count_b > max(64, cells // 100)
    first_b = np.cumsum(count_b) - count_b
    thin = np.flatnonzero(~thick[spot_a])
    ends = np.cumsum(count_b[spot_a[thin]])
    low = 0
    while low < len(thin):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, side="right")))
        part = thin[low:high]
        times = count_b[spot_a[part]]
        within = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        other = row_b[np.repeat(first_b[spot_a[part]], times) + within]
        overlap += np.bincount(np.repeat(row_a[part], times) * len(right) + other, minlength=cells)
        low = high
    overlap = overlap.reshape(len(left), len(right))
    names = np.flatnonzero(thick)
    for low in range(0, len(names), SLICE):
        part = names[low : low + SLICE]
        place = np.full(len(shared), -1)
        place[part] = np.arange(len(part))
        dense = []
        for spot, row, size in ((spot_a, row_a, len(left)), (spot_b, row_b, len(right))):
            matrix = np.zeros((size, len(part)), dtype=np.float32)
            inside = place[spot] >= 0
            matrix[row[inside], place[spot[inside]]] = 1
            dense.append(matrix)
        overlap += (dense[0] @ dense[1].T).astype(np.int64)
    return overlap


def _column(rows: list[dict], name: str) -> np.ndarray:
    return np.array([r[name] for r in rows], dtype=np.int64)


def _may_reach(rows: DataFrame, partitions: int, percent: int) -> DataFrame:
    """The rows with a partner in another component whose overlap can reach the threshold.

    ``rows``: a document's kept n-grams among the columns of one pivot. A pair is dropped if
    its overlap there and all that may lie in other pivots' columns stay below the bound.
    """

    def work(left: list[dict], right: list[dict], same: bool) -> Iterator[pd.DataFrame]:
        inside = _overlaps([r["grams"] for r in left], [r["grams"] for r in right])
        n_a, n_b = _column(left, "n")[:, None], _column(right, "n")[None, :]
        outside = np.minimum(
            (_column(left, "kept") - [len(r["grams"]) for r in left])[:, None],
            (_column(right, "kept") - [len(r["grams"]) for r in right])[None, :],
        )
        wanted = -(-percent * (n_a + n_b) // (100 + percent))
        # Of what two prefixes share, at most so much was not kept; the set whose prefix ends
        # first lacks no more n-grams of its prefix than of the whole.
        dropped = np.maximum(least_shared(n_a), least_shared(n_b)) - 1
        known = np.minimum(prefix_length(n_a) - n_a, prefix_length(n_b) - n_b)
        fits = (inside > 0) & (inside + outside + dropped >= wanted + known)
        fits &= 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
        fits &= _column(left, "component")[:, None] != _column(right, "component")[None, :]
        rows = [r for r, hit in zip(left, fits.any(axis=1)) if hit] + [r for r, hit in zip(right, fits.any(axis=0)) if hit]
        if rows:
            yield pd.DataFrame({k: _column(rows, k) for k in ("pivot", "node", "n", "component")}).drop_duplicates()

    found = _in_tiles(rows, partitions, work, "pivot long, node long, n long, component long")
    return found.distinct()


def _crossing_links(rows: DataFrame, partitions: int, percent: int) -> DataFrame:
    """Links between documents of different components, from products of whole sets.

    Of the links in a tile, those are returned that join components not yet joined there.
    """

    def work(left: list[dict], right: list[dict], same: bool) -> Iterator[pd.DataFrame]:
        sets = [[np.frombuffer(r["grams"], dtype=np.uint64) for r in side] for side in (left, right)]
        overlap = _overlaps(*sets)
        union = _column(left, "n")[:, None] + _column(right, "n")[None, :] - overlap
        linked = (overlap > 0) & (100 * overlap >= percent * union)
        linked &= _column(left, "component")[:, None] != _column(right, "component")[None, :]
        leader: dict[int, int] = {}

        def lead(x: int) -> int:
            while leader.setdefault(x, x) != x:
                leader[x] = leader[leader[x]]
                x = leader[x]
            return x

        kept = []
        for a, b in np.argwhere(linked).tolist():
            x, y = lead(left[a]["component"]), lead(right[b]["component"])
            if x != y:
                leader[max(x, y)] = min(x, y)
                kept.append((left[a]["node"], right[b]["node"]))
        if kept:
            yield pd.DataFrame(kept, columns=["a", "b"])

    return _in_tiles(rows, partitions, work, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold, by counting the overlap of whole sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                spot = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
                overlap = int(np.count_nonzero(b[spot] == a)) if len(a) else 0
                kept.append(100 * overlap >= percent * (len(a) + len(b) - overlap) > 0)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(count, "a long, b long")


def near_duplicate_classes(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 75,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Set size and component of every document: ``doc_id``, ``n_shingles``, ``component_id``.

    Null or wordless text has an empty set and no links. Rows that share an id count as one
    node; a null id has no component (null). Equal sets are linked. Other columns are ignored.
    """
    if percent < 75:
        raise ValueError("the prefixes are made for a similarity of 0.75 or more")
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sent = stored(_prefix_pass(source, 4 * partitions, batch_bytes), "kind")
    told = answers(
        sent.where("kind = 'sent'").select("batch", "block", "first", "keys", "counts"), partitions, with_keys=True, skip_own=False
    )
    own = sent.where("kind = 'own'").select("batch", "payload")
    found = stored(with_answers(own, told, partitions, _keep_rarest, _KEPT))

    linkable = found.where("kept is not null and doc_id is not null and n > 0")
    node = F.struct("doc_id", "shared", "kept")
    nodes = stored(
        linkable.groupBy("n", "sign_a", "sign_b").agg(F.min(node).alias("first"))
        .select(F.col("first.doc_id").alias("node"), "n", "sign_a", "sign_b", F.col("first.shared").alias("shared"), F.col("first.kept").alias("kept"))
    )
    columns = stored(nodes.select("node", "n", "shared", F.explode("kept").alias("gram")))
    sizes_fit = (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b"))

    # The pivot of a column is its document with most shared n-grams: the likeliest original.
    pivot = columns.groupBy("gram").agg(
        F.max(F.struct("shared", -F.col("node"), "n")).alias("p"), F.count(F.lit(1)).alias("rows")
    ).where("rows > 1").select("gram", (-F.col("p.col2")).alias("b"), F.col("p.n").alias("n_b"))
    met = columns.join(pivot, "gram").where((F.col("node") != F.col("b")) & sizes_fit)
    met = met.groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("overlap"))
    first_pairs = met.groupBy("a").agg(F.max(F.struct("overlap", -F.col("b"))).alias("best")).select("a", (-F.col("best.col2")).alias("b"))
    sets = stored(_whole_sets(source, columns.join(pivot.select("gram"), "gram", "left_semi").select("node").distinct().join(nodes.select("node", "sign_a"), "node")))
    links = stored(_linked(first_pairs, sets, percent))
    label = components(links)

    # Columns whose documents are still in different components.
    placed = columns.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    # Columns whose pivots are in one component form one matrix.
    of_pivot = label.select(F.col("node").alias("b"), F.col("component").alias("pivot"))
    columns_of = pivot.join(mixed, "gram").join(of_pivot, "b", "left").select("gram", F.coalesce("pivot", "b").alias("pivot"))
    placed = placed.join(columns_of, "gram").groupBy("pivot", "node").agg(
        F.first("n").alias("n"), F.first("component").alias("component"), F.collect_list("gram").alias("grams")
    ).join(nodes.select("node", F.size("kept").alias("kept")).groupBy("node").agg(F.max("kept").alias("kept")), "node")
    reaching = stored(_may_reach(stored(placed), partitions, percent))
    more = stored(_crossing_links(reaching.join(sets, "node"), partitions, percent))
    joined = components(links.unionByName(more))

    same = linkable.select("doc_id", "n", "sign_a", "sign_b")
    classes = nodes.join(joined, "node", "left").select("n", "sign_a", "sign_b", F.coalesce("component", "node").alias("component"))
    member = same.join(classes, ["n", "sign_a", "sign_b"]).groupBy("doc_id").agg(F.min("component").alias("component"))
    return found.join(member, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(documents(spark, sf_dir))


# Documents' distinct 5-word shingles, pairs that share enough, and the smallest id in reach.
_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as w
  from documents where text is not null
), sets as (
  select doc_id, list_distinct(case when len(w) >= 5
         then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
         when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from words
), grams as (
  select doc_id, unnest(s) as g from sets
), overlap as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from overlap o join sets x on x.doc_id = o.a join sets y on y.doc_id = o.b
  where 100 * n >= 75 * (len(x.s) + len(y.s) - n)
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
)
select d.doc_id, cast(coalesce(len(s.s), 0) as bigint) as n_shingles, min(reach.b) as component_id
from documents d left join sets s on s.doc_id = d.doc_id join reach on reach.a = d.doc_id
group by 1, 2
"""

QUERIES = {"op7_ngram_jaccard": op7_ngram_jaccard}
ORACLES = {"op7_ngram_jaccard": _SQL}
