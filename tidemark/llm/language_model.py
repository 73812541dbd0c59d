"""Language-model scores by deleted interpolation of bigrams and unigrams.

Counts of all training tokens and pairs are summed over the corpus in packed blocks. The
probability of a token mixes three estimates: the pair's share of its context, the token's
share of all tokens, and a uniform share. The weights depend on how often the context was
seen, and are learned by expectation-maximisation on deleted counts: each training token is
predicted from the counts of all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import NOT_SPACE, combine, mix, pack, pack_sorted, slabs, unpack, unpack_sorted
from tidemark.llm.common import documents, id_fold, shuffle_partitions, stored
from tidemark.llm.exchange import SUMMARY, answers, bundle, gathered, messages, unbundle, with_answers

BATCH_BYTES = 8 << 20
END = mix(np.array([1], dtype=np.uint64))[0]

# Contexts seen 0, 1, 2-3, 4-7, ... times have mixture weights of their own.
BUCKETS = 24
# Probabilities enter the expectation-maximisation by half powers of two.
LEVELS = 96
ITERATIONS = 60
# Pairs are told apart by 56 bits.
PAIR_BITS = np.uint64(0xFFFFFFFFFFFFFF00)

_SENT = "kind string, batch long, block int, first long, keys binary, counts binary, payload binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(count.astype(np.float64))[1], BUCKETS - 1)


def _level(share: np.ndarray) -> np.ndarray:
    """0 for nothing, else from 1 for a probability of one down to ``LEVELS - 1``."""
    with np.errstate(divide="ignore"):
        level = 1 + np.rint(-2 * np.log2(share))
    return np.where(share > 0, np.minimum(level, LEVELS - 1), 0).astype(np.int64)


def _of_level(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, 2.0 ** (-(level - 1) / 2), 0.0)


def _by_frequency(counts: np.ndarray) -> np.ndarray:
    """Keys from the most frequent one: tokens numbered in this order compress well."""
    return np.argsort(-counts.astype(np.int64), kind="stable").astype(np.uint32)


class _Batch:
    """A batch's documents with the corpus counts of all their tokens."""

    def __init__(self, payload: bytes):
        ids, valid, train, sizes, keys, counts, tokens = unbundle(payload)
        self.ids, self.valid, self.train = unpack(ids, np.int64), unpack(valid, np.uint8), unpack(train, np.uint8)
        self.sizes, self.keys = unpack(sizes, np.int64), unpack_sorted(keys)
        self.tokens = _by_frequency(unpack(counts, np.uint32))[unpack(tokens, np.uint32)]
        self.first = np.cumsum(self.sizes) - self.sizes
        # The context of a document's first token is an end.
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[self.first] = np.searchsorted(self.keys, END)
        self.trained = np.repeat(self.train.astype(bool), self.sizes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending distinct pairs and the pair of each token."""
        codes = combine(self.keys[self.context], self.keys[self.tokens])
        return np.unique(codes & PAIR_BITS, return_inverse=True)

    def single_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.trained], minlength=len(self.keys)).astype(np.uint64)


def _count_pass(docs: DataFrame, blocks: int, batch_bytes: int) -> DataFrame:
    """Every batch's token sequence and the messages with its counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, parts in gathered(batches, 2, batch_bytes):
            ids, train, sizes, codes = [], [], [], []
            for part in parts:
                ids += part.column(0).to_pylist()
                train += part.column(1).to_pylist()
                for _, _, slab in slabs(part.column(2)):
                    start, end, first = slab.words(NOT_SPACE)
                    count = np.diff(first)
                    sizes.append(count + 1)
                    codes.append(np.insert(slab.span_hashes(start, end, fold=True), first[1:], END))
            keys, tokens, counts = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
            counts = counts.astype(np.uint32)
            order = _by_frequency(counts)
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order))
            payload = bundle(
                pack(np.array([i or 0 for i in ids], dtype=np.int64)),
                pack(np.array([i is not None for i in ids], dtype=np.uint8)),
                pack(np.array(train, dtype=np.uint8)),
                pack(np.concatenate(sizes)),
                pack_sorted(keys),
                pack(counts),
                pack(rank[tokens]),
            )
            batch = _Batch(payload)
            pairs, which = batch.pairs()
            pair_counts = np.bincount(which[batch.trained], minlength=len(pairs))
            rows = [("one", *m, None) for m in messages(number, keys, batch.single_counts(), blocks)]
            rows += [("two", *m, None) for m in messages(number, pairs, pair_counts, blocks, PAIR_ROWS)]
            rows.append(("own", number, None, None, None, None, payload))
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(rows, columns=["kind", "batch", "block", "first", "keys", "counts", "payload"]),
                schema=_ARROW_SENT,
                preserve_index=False,
            )

    return docs.mapInArrow(work, _SENT)


_ARROW_SENT = pa.schema(
    [("kind", pa.string()), ("batch", pa.int64()), ("block", pa.int32()), ("first", pa.int64())]
    + [("keys", pa.binary()), ("counts", pa.binary()), ("payload", pa.binary())]
)


class _Counted:
    """Counts of each token, its context and its pair in a batch, from answers of both kinds.

    Rows of pairs are numbered after those of single tokens.
    """

    def __init__(self, payload: bytes, rows: np.ndarray, totals: np.ndarray):
        self.batch = batch = _Batch(payload)
        single = batch.single_counts()
        pairs, which = batch.pairs()
        double = np.bincount(which[batch.trained], minlength=len(pairs)).astype(np.uint64)
        ones = rows < PAIR_ROWS
        single[rows[ones]] = totals[ones]
        double[rows[~ones] - PAIR_ROWS] = totals[~ones]
        self.token = single[batch.tokens].astype(np.float64)
        self.context = single[batch.context].astype(np.float64)
        self.pair = double[which].astype(np.float64)


PAIR_ROWS = 1 << 40


def expectation_maximisation(cells: np.ndarray, weights: np.ndarray, uniform: float) -> np.ndarray:
    """Mixture weights (pair, token, uniform) of each context bucket."""
    mixture = np.zeros((BUCKETS, 3))
    mixture[:, 2] = 1.0
    bucket = cells // (LEVELS * LEVELS)
    shares = np.stack(
        [_of_level(cells // LEVELS % LEVELS), _of_level(cells % LEVELS), np.full(len(cells), uniform)], axis=1
    )
    learned = []
    for b in range(BUCKETS):
        inside = bucket == b
        if not inside.any():
            continue
        learned.append(b)
        own, mass = shares[inside], weights[inside].astype(np.float64)
        value = np.full(3, 1 / 3)
        for _ in range(ITERATIONS):
            part = own * value
            part /= part.sum(axis=1, keepdims=True)
            value = mass @ part / mass.sum()
        mixture[b] = value
    for b in range(BUCKETS):
        if learned and b not in learned:
            mixture[b] = mixture[min(learned, key=lambda k: (abs(k - b), k))]
    return mixture


def score_documents(
    docs: DataFrame,
    train,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Score every document with a model of those for which the column ``train`` holds.

    Columns: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (additively smoothed unigrams) and ``score``, both sums of log10.
    Null text is empty: one end. Repeated rows count and are scored each. Null ids stay null.
    With nothing to learn from, every token has probability one over the one unknown word.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    blocks = 4 * partitions
    source = docs.select(F.col(id_column).cast("long"), F.coalesce(train, F.lit(False)), F.col(text_column))
    sent = stored(_count_pass(source, blocks, batch_bytes), "kind")

    def told(kind: str) -> DataFrame:
        kept = sent.where(F.col("kind") == kind).select("batch", "block", "first", "keys", "counts")
        return answers(kept, partitions, with_keys=False, skip_own=True).withColumn("kind", F.lit(kind))

    both = stored(told("one").unionByName(told("two")), "kind")
    vocabulary = both.where((F.col("batch") == SUMMARY) & (F.col("kind") == "one")).select("totals")
    words = sum(int(unpack(bytes(r[0]), np.uint64)[0]) for r in vocabulary.toLocalIterator())
    # Blocks of pairs follow those of tokens.
    numbered = both.withColumn("block", F.when(F.col("kind") == "two", F.col("block") + blocks).otherwise(F.col("block")))
    own = sent.where(F.col("kind") == "own").select("batch", "payload")

    def pass_over(work, schema: str) -> DataFrame:
        def run(number, payload, rows, totals, keys):
            yield from work(_Counted(payload, rows, totals))

        return with_answers(own, numbered.drop("kind"), partitions, run, schema)

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [_Batch(bytes(p)) for p in frame["payload"]]
            yield pd.DataFrame({"n": [int(b.trained.sum()) for b in found]})

    tokens = own.select("payload").mapInPandas(sizes, "n long").agg(F.sum("n")).first()[0] or 0
    uniform = 1 / (words + 1)

    def deleted(counted: _Counted) -> Iterator[pd.DataFrame]:
        chosen = counted.batch.trained
        context = np.maximum(counted.context[chosen] - 1, 0)
        pair = np.maximum(counted.pair[chosen] - 1, 0) / np.maximum(context, 1)
        token = np.maximum(counted.token[chosen] - 1, 0) / max(tokens - 1, 1)
        cell = (_bucket(context) * LEVELS + _level(pair)) * LEVELS + _level(token)
        values, weights = np.unique(cell, return_counts=True)
        yield pd.DataFrame({"cell": values, "n": weights})

    cells = pass_over(deleted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = sorted((r["cell"], r["n"]) for r in cells)
    mixture = expectation_maximisation(
        np.array([c for c, _ in cells], dtype=np.int64), np.array([n for _, n in cells], dtype=np.int64), uniform
    )
    rest = tokens + 0.5 * (words + 1)

    def score(counted: _Counted) -> Iterator[pd.DataFrame]:
        batch = counted.batch
        weight = mixture[_bucket(counted.context)]
        chance = (
            weight[:, 0] * counted.pair / np.maximum(counted.context, 1)
            + weight[:, 1] * counted.token / max(tokens, 1)
            + weight[:, 2] * uniform
        )

        def per_document(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, batch.first)

        ids = pd.array(batch.ids, dtype="Int64")
        ids[batch.valid == 0] = pd.NA
        yield pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": batch.train == 0,
                "n_tokens": batch.sizes,
                "n_known": per_document((counted.token > 0).astype(np.int64)),
                "base_score": per_document(np.log10((counted.token + 0.5) / rest)),
                "score": per_document(np.log10(np.maximum(chance, 1e-300))),
            }
        )

    return pass_over(score, _SCORES).withColumn("train_tokens", F.lit(tokens).cast("long"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), id_fold("doc_id", 5) != 1)


QUERIES = {"op5_lm_scoring": op5_lm_scoring}
ORACLES: dict[str, str] = {}
