"""Token counts against the libraries on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import token_counts
from tidemark.llm.arrays import slabs
from tidemark.llm.common import prepared

MODEL = token_counts.piece_model()
ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a  ", "\ta\nb c\x0bd", "▁", "a▁b", "▁▁ a ▁", "a▁", " ▁b", "<s> a </s>", "<unk> <0x0A>",
    "a\x00b\x00 \x00", "é é ﬁ ① 　x y", "日本語 テキスト", "😀 😀😀", "x" * 17, "y" * 16, "word" * 9_000, "a b " * 300_000,
]


def texts():
    rng = random.Random(7)
    marks = ["a", "b", "the", " ", "  ", "▁", "\n", "é", "\x00", "Zwölf", "▀", "antidisestablishmentarianism"]
    return ODD + ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(3_000)]


@pytest.fixture(scope="module")
def expected():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(library.encode(t or "")) for t in texts()]


def test_counts_equal_the_library(spark, expected):
    prepared(spark)
    rows = [(i if i % 9 else None, t, "x", "old") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows + rows[:20], "doc_id long, text string, slab string, n_tokens string").repartition(5)
    for settings in ({}, {"sample_rows": 1, "cached": 3}):
        found = token_counts.count_tokens(df, MODEL, limit=100, **settings)
        assert found.columns == ["doc_id", "text", "slab", "n_bytes", "n_tokens", "over_limit"]
        want = dict(zip(texts(), expected))
        result = found.collect()
        assert len(result) == len(rows) + 20
        for r in result:
            assert r["n_tokens"] == want[r["text"]], r["text"][:50]
            assert r["n_bytes"] == len((r["text"] or "").encode()) and r["over_limit"] == (want[r["text"]] > 100)


def test_the_table_holds_bytes_not_hashes():
    words = [b"the", b"a", b"x" * 16, b"\x00", b"a\x00", "é".encode()]
    table = token_counts.FrequentLengths(words, [1, 2, 3, 4, 5, 300])
    asked = [b"the", b"a", b"a\x00", b"a\x00\x00", b"\x00", b"x" * 16, b"x" * 17, b"", b"th", "é".encode()]
    ((_, _, slab),) = slabs(pa.array(asked, pa.binary()))
    assert table.find(slab, slab.offsets[:-1], slab.offsets[1:]).tolist() == [1, 2, 5, -1, 4, 3, -1, -1, -1, -1]
    nothing = token_counts.FrequentLengths([], [])
    assert set(nothing.find(slab, slab.offsets[:-1], slab.offsets[1:]).tolist()) == {-1}


def test_pre_tokens_cover_the_text():
    for text in [t for t in texts() if t]:
        ((_, _, slab),) = slabs(pa.array([text]))
        start, end, which = token_counts.pre_tokens(slab)
        raw = text.encode()
        gaps = [raw[a:b] for a, b in zip(end[:-1], start[1:])]
        assert set(gaps) <= {b" ", "▁".encode()} and start[0] == 0 and end[-1] == len(raw) and not which.any()


def test_vocabularies_that_cannot_be_cut_get_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    some = texts()[:200] + ["a <|endoftext|> b"]
    df = spark.createDataFrame([(t,) for t in some], "text string")
    for r in token_counts.count_tokens(df, path).collect():
        assert r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = token_counts.count_tokens(df, MODEL)
    assert found.collect() == [] and found.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]


def test_query_on_the_whole_table(spark):
    found = {r["doc_id"]: r for r in token_counts.op12_token_counts(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts = [len(library.encode(r["text"] or "")) for r in docs]
    assert [found[r["doc_id"]]["n_tokens"] for r in docs] == counts
    assert [found[r["doc_id"]]["over_limit"] for r in docs] == [n > 4_096 for n in counts]
    assert np.sum(counts) > 0 and len(found) == len(docs)
