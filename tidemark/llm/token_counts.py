"""Token counts of whole texts: frequent pre-tokens from a broadcast table, the rest from a cache.

A pre-token is a run of spaces with the word after it. Where no piece of the vocabulary reaches
from a word over the space behind it, the tokens of a text are the tokens of its pre-tokens, so
their numbers add up. The first tier is a hash table of frequent pre-tokens of up to 16 bytes and
their lengths in tokens; it holds the bytes themselves, and whole slabs of text are looked up at
once. What it misses goes through a bounded cache of the Python worker, and from there to the
tokenizer. Nothing but the sample that the table is chosen from is shuffled; the table never
changes a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import Slab, mix, slabs
from tidemark.llm.common import documents

MAX_TOKENS = 4_096
# The table is chosen from about so many documents, dealt over so many tasks, each of which
# names at most so many pre-tokens; it holds as many of them.
SAMPLE_ROWS = 20_000
SAMPLE_TASKS = 16
FREQUENT = 65_536
# Pre-tokens that a worker remembers; longer ones than this aren't remembered.
CACHED = 400_000
CACHED_BYTES = 64
KEY_BYTES = 16

_MARK = "▁".encode()
_FINE = 1 << 30


class PieceTokenizer:
    """Lengths by the sentencepiece library, and whether texts may be cut at spaces."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.processor.serialized_model_proto())
        rules = model.normalizer_spec
        plain = rules.name == "identity" and rules.add_dummy_prefix and rules.escape_whitespaces
        plain = plain and not rules.remove_extra_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix
        own = any(p.type == p.USER_DEFINED for p in model.pieces)
        across = any(a != "▁" and b == "▁" for p in model.pieces for a, b in zip(p.piece, p.piece[1:]))
        self.cuts = bool(plain and not own and not across)
        # A space at the end of a text is a pre-token without a word.
        self.last_space = self.lengths(["a "])[0] - self.lengths(["a"])[0]

    def lengths(self, texts: list[str]) -> list[int]:
        return list(map(len, self.processor.encode(texts, num_threads=1))) if texts else []


class JsonTokenizer:
    """Lengths by the tokenizers library; texts stay whole."""

    cuts = False

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> PieceTokenizer | JsonTokenizer:
    """One per Python worker."""
    return PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)


def pre_tokens(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of a slab without their first space, and their texts.

    Spaces and the marks that stand for them in the vocabulary count alike.
    """
    data, offsets = slab.data, slab.offsets
    width = (data == 0x20).astype(np.int64)
    inside = width.astype(bool)
    lead = np.flatnonzero(data[:-2] == _MARK[0]) if len(data) > 2 else np.zeros(0, dtype=np.int64)
    lead = lead[(data[lead + 1] == _MARK[1]) & (data[lead + 2] == _MARK[2])]
    width[lead] = len(_MARK)
    for i in range(len(_MARK)):
        inside[lead + i] = True
    cut = width > 0
    cut[1:] &= ~inside[:-1]
    filled = np.flatnonzero(np.diff(offsets))
    cut[offsets[filled]] = False
    cuts = np.flatnonzero(cut)
    start = np.sort(np.concatenate([offsets[filled], cuts + width[cuts]]))
    end = np.sort(np.concatenate([offsets[filled + 1], cuts]))
    return start, end, np.searchsorted(offsets, end, side="left") - 1


def _keys(slab: Slab, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Up to 16 bytes of each span as two numbers, zeros behind the end."""
    padded = np.concatenate([slab.data, np.zeros(KEY_BYTES, dtype=np.uint8)])
    view = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    keys = []
    for at in (0, 8):
        spare = np.clip(8 - (size - at), 0, 8).astype(np.uint64) * np.uint64(8)
        word = view[start + at]
        keys.append(np.where(spare < 64, (word << (spare & np.uint64(63))) >> (spare & np.uint64(63)), np.uint64(0)))
    return keys[0], keys[1]


class FrequentLengths:
    """An open-addressing hash table: 16 bytes and a size to a number of tokens."""

    def __init__(self, words: list[bytes], lengths: list[int]):
        kept = [(w, n) for w, n in zip(words, lengths) if 0 < len(w) <= KEY_BYTES and n < 256]
        slots = 1 << max(4, (2 * len(kept)).bit_length())
        self.low, self.high = np.zeros(slots, dtype=np.uint64), np.zeros(slots, dtype=np.uint64)
        self.size, self.tokens = np.zeros(slots, dtype=np.uint8), np.zeros(slots, dtype=np.uint8)
        self.longest = 0
        if not kept:
            return
        data = np.frombuffer(b"".join(w for w, _ in kept), dtype=np.uint8)
        size = np.array([len(w) for w, _ in kept], dtype=np.int64)
        low, high = _keys(Slab(data, np.zeros(1)), np.cumsum(size) - size, size)
        for i, slot in enumerate(self._slots(low, high).tolist()):
            steps = 0
            while self.size[slot]:
                slot, steps = (slot + 1) % slots, steps + 1
            self.low[slot], self.high[slot], self.size[slot] = low[i], high[i], size[i]
            self.tokens[slot] = kept[i][1]
            self.longest = max(self.longest, steps)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low + mix(high + np.uint64(1))) & np.uint64(len(self.low) - 1)).astype(np.int64)

    def find(self, slab: Slab, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each span, -1 where the table doesn't hold it."""
        size = end - start
        found = np.full(len(start), -1, dtype=np.int64)
        open_ = np.flatnonzero((size > 0) & (size <= KEY_BYTES))
        low, high = _keys(slab, start[open_], size[open_])
        slot = self._slots(low, high)
        wanted = size[open_]
        for _ in range(self.longest + 1):
            same = (self.low[slot] == low) & (self.high[slot] == high) & (self.size[slot] == wanted)
            found[open_[same]] = self.tokens[slot[same]]
            go_on = ~same & (self.size[slot] > 0)
            if not go_on.any():
                break
            open_, low, high, wanted = open_[go_on], low[go_on], high[go_on], wanted[go_on]
            slot = (slot[go_on] + 1) % len(self.low)
        return found


class Counts:
    """Tokens of the texts of a slab, by both tiers."""

    def __init__(self, tokenizer: PieceTokenizer, table: FrequentLengths, cached: int = CACHED):
        self.tokenizer, self.table, self.cached = tokenizer, table, cached
        self.cache: dict[bytes, int] = {}

    def _missed(self, words: list[bytes]) -> list[int]:
        if len(self.cache) > self.cached:
            self.cache = {}
        counts = list(map(self.cache.get, words))
        new = list({words[i] for i, n in enumerate(counts) if n is None})
        lengths = dict(zip(new, self.tokenizer.lengths([w.decode("utf-8", "replace") for w in new])))
        self.cache.update((w, n) for w, n in lengths.items() if len(w) <= CACHED_BYTES)
        return [lengths[w] if n is None else n for w, n in zip(words, counts)]

    def __call__(self, slab: Slab) -> np.ndarray:
        start, end, text = pre_tokens(slab)
        found = self.table.find(slab, start, end)
        found[start == end] = self.tokenizer.last_space
        missed = np.flatnonzero(found < 0)
        if len(missed):
            raw = slab.data.tobytes()
            found[missed] = self._missed([raw[a:b] for a, b in zip(start[missed].tolist(), end[missed].tolist())])
        return np.bincount(text, found, len(slab)).astype(np.int64)


def frequent_pre_tokens(docs: DataFrame, text_column: str = "text", rows: int = SAMPLE_ROWS) -> list[bytes]:
    """Frequent short pre-tokens of a bounded sample: about ``rows`` texts drawn by a hash.

    The sampled texts, not their pre-tokens, are dealt over a fixed number of tasks, and each
    names at most ``FREQUENT`` of its own.
    """
    count = docs.count()
    if not count:
        return []
    text = F.col(text_column)
    drawn = docs.where(text.isNotNull() & (F.pmod(F.xxhash64(text), F.lit(_FINE)) < int(_FINE * min(1, rows / count))))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        for batch in batches:
            for _, _, slab in slabs(batch.column(0)):
                start, end, _ = pre_tokens(slab)
                short = (end > start) & (end - start <= KEY_BYTES)
                raw = slab.data.tobytes()
                words.update(raw[a:b] for a, b in zip(start[short].tolist(), end[short].tolist()))
        kept = words.most_common(FREQUENT)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
        )

    dealt = drawn.select(text_column).repartition(SAMPLE_TASKS)
    found = dealt.mapInArrow(count_words, "word binary, n long").toArrow()
    total: Counter[bytes] = Counter()
    for word, n in zip(found.column("word").to_pylist(), found.column("n").to_pylist()):
        total[word] += n
    return [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT]]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    text_column: str = "text",
    limit: int = MAX_TOKENS,
    sample_rows: int = SAMPLE_ROWS,
    cached: int = CACHED,
) -> DataFrame:
    """Append ``n_bytes``, ``n_tokens`` and ``over_limit`` to every row; the rows aren't shuffled.

    Tokens are those of the library that reads the file (``.model``: sentencepiece, ``.json``:
    tokenizers), without begin, end or other added tokens. Vocabularies that can't be cut at
    spaces get whole texts.

    Null text counts as empty: no bytes, no tokens. Repeated rows and rows without an id are
    counted each for itself. Other columns stay as they are, but those named like the new ones are
    replaced. An empty table gives an empty one.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in docs.columns if c not in added]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    position = kept.index(text_column)
    tokenizer: PieceTokenizer | JsonTokenizer = _tokenizer(tokenizer_path)
    words = frequent_pre_tokens(source, text_column, sample_rows) if tokenizer.cuts else []
    lengths = tokenizer.lengths([w.decode("utf-8", "replace") for w in words])
    table = docs.sparkSession.sparkContext.broadcast(FrequentLengths(words, lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(tokenizer_path)
        counts: Callable[[Slab], np.ndarray] | None = Counts(own, table.value, cached) if own.cuts else None
        for batch in batches:
            sizes, tokens = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for _, _, slab in slabs(batch.column(position)):
                sizes.append(np.diff(slab.offsets))
                if counts is not None:
                    tokens.append(counts(slab))
                else:
                    texts = [slab.text(i).decode("utf-8", "replace") for i in range(len(slab))]
                    tokens.append(np.array(own.lengths(texts), dtype=np.int64))
            found = np.concatenate(tokens)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(sizes)), pa.array(found), pa.array(found > limit)],
                names=[*kept, *added],
            )

    kinds = zip(added, (T.LongType(), T.LongType(), T.BooleanType()))
    return source.mapInArrow(count, T.StructType([*source.schema.fields, *[T.StructField(*x) for x in kinds]]))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document by the piece vocabulary."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return count_tokens(docs, piece_model()).select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {"op12_token_counts": op12_token_counts}
ORACLES: dict[str, str] = {}
