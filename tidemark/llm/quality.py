"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: a rule is a conjunction of thresholds, grown on two thirds of the labelled
documents by information gain and pruned on the rest. Rules are added as long as they are
precise; the list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import NOT_SPACE, combine, repeated, slabs
from tidemark.llm.common import documents, stored

# About so many labelled rows, drawn by a hash, are what rules are learned from.
LABELLED_ROWS = 20_000
# A rule has to be this precise on rows it wasn't grown on, and its hits there less likely by chance than this.
LEAST_PRECISION = 0.9
MOST_CHANCE = 0.01
MOST_RULES = 12
MOST_CONDITIONS = 4
CUTS = 48
_FINE = 1 << 30

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[ord(c) for c in ".,;:!?"]] = True

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_upper", "n_punctuation",
)

# Features of a document as SQL expressions over its counts.
FEATURES = {
    "words": "double(n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "punctuation_share": "n_punctuation / greatest(word_chars, 1)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
}


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def text_statistics(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts over each whole text (``COUNTS``); null text has none of anything.

    Repeated rows and rows without an id are counted each for itself; other columns, whatever
    their names, are ignored; an empty table gives none.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start_row, last_row, slab in slabs(batch.column(1)):
                data, offsets, texts = slab.data, slab.offsets, len(slab)
                start, end, first = slab.words(NOT_SPACE)
                n_words = np.diff(first)
                owner = np.repeat(np.arange(texts, dtype=np.uint64), n_words)
                codes = combine(slab.span_hashes(start, end), owner)
                again = np.zeros(len(codes), dtype=bool)
                if len(codes) > 2:
                    three = combine(combine(codes[:-2], codes[1:-1]), codes[2:])
                    spots = np.flatnonzero(owner[:-2] == owner[2:])
                    spots = spots[repeated(three[spots])]
                    for j in range(3):
                        again[spots + j] = True
                # Lines that hold a word: bounded by line feeds and text bounds.
                line_byte = np.ones(256, dtype=bool)
                line_byte[10] = False
                line_start, line_end = slab.runs(line_byte)
                with_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
                line_start, line_end = line_start[with_word], line_end[with_word]
                line_owner = np.searchsorted(offsets, line_start, side="right") - 1
                line_codes = combine(slab.span_hashes(line_start, line_end), line_owner.astype(np.uint64))
                _, at = np.unique(line_codes, return_index=True)
                n_lines = np.bincount(line_owner, minlength=texts)
                new_lines = np.bincount(line_owner[at], minlength=texts)
                values = [
                    n_words,
                    _per_text(NOT_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
                    _per_text(_SYMBOLS[data], offsets),
                    n_lines - new_lines,
                    _per_text(again, first),
                    n_lines,
                    _per_text(_DIGITS[data], offsets),
                    _per_text(_UPPER[data], offsets),
                    _per_text(_PUNCTUATION[data], offsets),
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start_row, last_row - start_row), *[pa.array(v, pa.int64()) for v in values]],
                    names=["doc_id", *COUNTS],
                )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Condition:
    """A threshold on one feature."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.above else value <= self.threshold

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    held = np.ones(size, dtype=bool)
    for condition in rule:
        held &= condition.holds(table[condition.feature])
    return held


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition of most information gain until only bad rows are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < MOST_CONDITIONS:
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for feature in FEATURES:
            values = table[feature][inside]
            marks = bad[inside]
            # Quantiles of all rows, and of the bad ones, which are few.
            steps = np.linspace(0, 1, CUTS)
            for cut in np.unique([np.quantile(values, steps), np.quantile(values[marks], steps, method="nearest")]):
                for above in (True, False):
                    held = values >= cut if above else values <= cut
                    p1 = int((marks & held).sum())
                    if p1 and p1 < p + n:
                        n1 = int(held.sum()) - p1
                        now = p1 * (log2(p1 / (p1 + n1)) - log2(p / (p + n)))
                        if now > gain:
                            best, gain = Condition(feature, above, float(cut)), now
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(table[best.feature])
    return tuple(rule)


def chance_of(hits: int, covered: int, bad: int, rows: int) -> float:
    """Probability that ``covered`` of ``rows`` rows, drawn blindly, hold ``hits`` bad ones or more."""
    ways = comb(rows, covered)
    return sum(comb(bad, k) * comb(rows - bad, covered - k) for k in range(hits, min(bad, covered) + 1)) / ways


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, float]:
    """The prefix of a rule that does best on rows it wasn't grown on, its precision there, and how
    likely its hits are by chance: an exact test, so few rows can do as well as many."""

    def counts(part: Rule) -> tuple[int, int]:
        held = _covered(part, table, len(bad))
        return int((bad & held).sum()), int((~bad & held).sum())

    def worth(part: Rule) -> float:
        p, n = counts(part)
        return (p - n) / (p + n) if p + n else -1.0

    parts = [rule[:k] for k in range(1, len(rule) + 1)]
    best = max(parts, key=lambda part: (worth(part), sum(counts(part)), -len(part)))
    p, n = counts(best)
    if not p:
        return best, 0.0, 1.0
    return best, p / (p + n), chance_of(p, p + n, int(bad.sum()), len(bad))


def learn_rules(
    table: dict[str, np.ndarray], bad: np.ndarray, *, precision: float = LEAST_PRECISION, seed: int = 5
) -> list[Rule]:
    """Rules for bad documents, in the order they were learned; equal inputs give equal rules."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    rng = np.random.default_rng(seed)
    while len(rules) < MOST_RULES and (bad & left).sum() >= 3:
        rows = np.flatnonzero(left)
        # Two thirds of the bad rows and of the others each.
        grown = np.zeros(len(rows), dtype=bool)
        for kind in (True, False):
            own = rng.permutation(np.flatnonzero(bad[rows] == kind))
            grown[own[: -(-2 * len(own) // 3)]] = True
        grow_rows, prune_rows = rows[grown], rows[~grown]
        rule = _grow({k: v[grow_rows] for k, v in table.items()}, bad[grow_rows])
        if not rule:
            break
        rule, precise, chance = _prune(rule, {k: v[prune_rows] for k, v in table.items()}, bad[prune_rows])
        held = _covered(rule, table, len(bad)) & left
        if precise < precision or chance > MOST_CHANCE or not (held & bad).sum():
            break
        rules.append(rule)
        left &= ~held
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    chain = F
    for number, rule in enumerate(rules, 1):
        both = rule[0].column()
        for condition in rule[1:]:
            both = both & condition.column()
        chain = chain.when(both, number)
    return chain.otherwise(0) if rules else F.lit(0)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_sample(
    statistics: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Features and labels of about ``rows`` labelled documents that pass the base rules.

    A document is drawn by a hash of its id against the share that is wanted of the counted ones; a
    repeated id counts by its smallest label, in each of its rows.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = statistics.where(~base_failed()).join(known, "doc_id")
    share = min(1.0, rows / max(1, joined.count()))
    drawn = joined.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(_FINE)) < int(_FINE * share))
    chosen = drawn.select("doc_id", "quality", *[F.expr(v).alias(k) for k, v in FEATURES.items()])
    found = sorted(chosen.collect())
    table = {k: np.array([r[k] for r in found], dtype=np.float64) for k in FEATURES}
    return table, np.array([r["quality"] == 0 for r in found], dtype=bool)


def judge(statistics: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Append ``base_failed``, ``rule`` (the first rule met, 0: none) and ``kept``."""
    return statistics.withColumns({"base_failed": base_failed(), "rule": verdict(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents, judge all.

    Null text has no words and fails; an unlabelled corpus gets no learned rules. Repeated rows
    are judged alike, each for itself, and extra columns of either table are ignored.
    """
    statistics = stored(text_statistics(documents(spark, sf_dir)))
    table, bad = labelled_sample(statistics, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = judge(statistics, learn_rules(table, bad))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLES: dict[str, str] = {}
