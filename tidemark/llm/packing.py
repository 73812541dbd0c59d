"""Packing by power-of-two decomposition: no sequence crosses documents, none needs padding.

A document's token ids are cut into pieces whose lengths are powers of two: as many of the
longest length as fit, then one piece for each set bit of what is left. Pieces of one length
form a bucket, and a batch is drawn from one bucket, so every sequence is full.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import NOT_SPACE, Slab, slabs
from tidemark.llm.common import documents

MAX_TOKENS = 1024
END_ID = 0
# Chunks that a worker remembers, and the longest one.
CACHED_CHUNKS = 600_000
CACHED_BYTES = 64

# A chunk is a word with the one white space before it. Its ids don't depend on its
# neighbours as long as no two white spaces meet; texts where some do, or which hold white
# space beyond ASCII, are encoded whole.

# First bytes of white space, marks and separators that the byte classes here don't know.
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int, ids array<int>"
)


def piece_lengths(tokens: int, longest: int = MAX_TOKENS) -> list[int]:
    """Powers of two, largest first, that add up to a number of tokens."""
    whole, rest = divmod(tokens, longest)
    bits = (1 << k for k in range(longest.bit_length() - 1, -1, -1))
    return [longest] * whole + [b for b in bits if rest & b]


class ChunkTokenizer:
    """Token ids of texts, with the ids of frequent chunks remembered.

    The memory is a bounded cache by the chunks' bytes; it never changes an id. The rank file holds what
    the JSON form of the same vocabulary holds as merges: the ids are equal (tested), and short chunks are
    encoded several times as fast. Texts that hold one of the JSON form's special strings are encoded
    by its own library, which gives these strings their special ids.
    """

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.encode = encoding.encode_ordinary
        whole = path.removesuffix(".tiktoken") + ".json"
        self.library = Tokenizer.from_file(whole)
        with open(whole, encoding="utf-8") as text:
            self.special = [token["content"].encode() for token in json.load(text)["added_tokens"]]
        self.cached = cached
        self.ids: dict[bytes, bytes] = {}

    def _irregular(self, slab: Slab) -> np.ndarray:
        """The texts that can't be cut into chunks."""
        data, offsets = slab.data, slab.offsets
        space = ~NOT_SPACE[data]
        bad = np.flatnonzero(space[:-1] & space[1:])
        last = offsets[1:][np.diff(offsets) > 0] - 1
        wide = np.flatnonzero(_SEPARATOR[data])
        wide = wide[(data[wide] != 0xC2) | np.isin(data[np.minimum(wide + 1, len(data) - 1)], (0x85, 0xA0))]
        return np.unique(np.searchsorted(offsets, np.concatenate([bad, last[space[last]], wide]), side="right") - 1)

    def _special(self, slab: Slab, raw: bytes) -> set[int]:
        """The texts that hold a special string."""
        found: set[int] = set()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(slab.offsets, at, side="right")) - 1
                if at + len(token) <= slab.offsets[text + 1]:
                    found.add(text)
                at = raw.find(token, at + 1)
        return found

    def _chunk_ids(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks in order, and each chunk's number of ids."""
        if len(self.ids) > self.cached:
            self.ids = {}
        chunks = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        found = list(map(self.ids.get, chunks))
        new: dict[bytes, bytes] = {}
        for i in [i for i, ids in enumerate(found) if ids is None]:
            chunk = chunks[i]
            if chunk not in new:
                new[chunk] = array("I", self.encode(chunk.decode("utf-8", "replace"))).tobytes()
            found[i] = new[chunk]
        self.ids.update((c, ids) for c, ids in new.items() if len(c) <= CACHED_BYTES)
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        return flat, np.fromiter(map(len, found), np.int64, len(found)) // 4

    def __call__(self, slab: Slab) -> list[np.ndarray]:
        """Ids of each text of a slab."""
        raw = slab.data.tobytes()
        start, end, first = slab.words(NOT_SPACE)
        inner = np.ones(len(start), dtype=bool)
        inner[first[:-1][np.diff(first) > 0]] = False
        leads = start > slab.offsets[np.searchsorted(slab.offsets, start, side="right") - 1]
        ids, count = self._chunk_ids(raw, start - (inner | leads), end)
        bounds = np.concatenate([[0], np.cumsum(count)])[first]
        found = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        special = self._special(slab, raw)
        for i in special:
            text = slab.text(i).decode("utf-8", "replace")
            found[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        for i in set(self._irregular(slab).tolist()) - special:
            found[i] = np.array(self.encode(slab.text(i).decode("utf-8", "replace")), dtype="<u4")
        return found


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> ChunkTokenizer:
    """One per Python worker, so that later tasks find its memory filled."""
    return ChunkTokenizer(path)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    longest: int = MAX_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """Cut every document into pieces of power-of-two length; one row per piece.

    Columns: ``doc_id``, ``start`` (the document's ids before it), ``length``, ``ids_crc32``,
    ``doc_tokens``, ``bucket`` (log2 of the length), ``ids`` (null unless ``with_ids``),
    ``sequence_id`` and ``offset`` (always 0: a piece is a sequence of its own).

    Null text counts as empty: one piece with the end id alone. Repeated rows are packed each
    for itself; the id may be null. Other columns are ignored. An empty table gives none. The
    documents aren't shuffled. Sequence ids are unique within one result and follow its rows.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, _, slab in slabs(batch.column(1)):
                rows: list[tuple] = []
                for name, ids in zip(names[first:], tokenizer(slab)):
                    own = ids.tobytes() + end
                    start, total = 0, len(own) // 4
                    for length in piece_lengths(total, longest):
                        piece = own[4 * start : 4 * (start + length)]
                        listed = np.frombuffer(piece, dtype="<i4") if with_ids else None
                        rows.append((name, start, length, zlib.crc32(piece), total, length.bit_length() - 1, listed))
                        start += length
                columns = list(zip(*rows))
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket", "ids"],
                )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    packed = source.mapInArrow(pieces, PIECE_SCHEMA)
    return packed.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write packed pieces with one folder per length, to draw batches of full sequences from."""
    pieces.write.partitionBy("bucket").parquet(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(documents(spark, sf_dir), default_tokenizer(), with_ids=False)
    return packed.drop("ids")


QUERIES = {"op8_packing": op8_packing}
ORACLES: dict[str, str] = {}
