"""Scores of the interpolated model against counts in dictionaries."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import language_model as lm
from tidemark.llm.common import id_fold, prepared

WORD = r"[^\x20\x09-\x0D]+"


def plain_scores(rows):
    """Leave-one-out counts, expectation-maximisation on them, and the mixture, token by token."""
    tokens = [(name, [w.lower() for w in re.findall(WORD, text or "")] + [None]) for name, text in rows]
    held = [name is not None and zlib.crc32(str(name).encode()) % 5 == 1 for name, _ in tokens]
    one, two = collections.Counter(), collections.Counter()
    for (_, words), out in zip(tokens, held):
        if not out:
            one.update(words)
            two.update(zip([None, *words], words))
    total, uniform = sum(one.values()), 1 / (len(one) + 1)
    cells = collections.Counter()
    for (_, words), out in zip(tokens, held):
        for before, word in zip([None, *words], words):
            if not out:
                context = max(one[before] - 1, 0)
                pair = max(two[before, word] - 1, 0) / max(context, 1)
                single = max(one[word] - 1, 0) / max(total - 1, 1)
                levels = [int(lm._level(np.array([x]))[0]) for x in (pair, single)]
                bucket = int(lm._bucket(np.array([context]))[0])
                cells[(bucket * lm.LEVELS + levels[0]) * lm.LEVELS + levels[1]] += 1
    keys = sorted(cells)
    mixture = lm.expectation_maximisation(np.array(keys), np.array([cells[k] for k in keys]), uniform)
    found = []
    for (name, words), out in zip(tokens, held):
        score = 0.0
        for before, word in zip([None, *words], words):
            weight = mixture[int(lm._bucket(np.array([one[before]]))[0])]
            chance = weight[0] * two[before, word] / max(one[before], 1) + weight[1] * one[word] / total + weight[2] * uniform
            score += math.log10(chance)
        found.append((name, out, score))
    return found


def test_scores_equal_the_plain_model(spark):
    prepared(spark)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        words = [rng.choice(vocabulary)]
        for _ in range(rng.randint(0, 30)):
            words.append(vocabulary[(vocabulary.index(words[-1]) + 1) % 40] if rng.random() < 0.6 else rng.choice(vocabulary))
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, "unseen words here"), (3, rows[3][1]), (None, "w1 w2 w3")]
    docs = spark.createDataFrame([(n, t, 0.5) for n, t in rows], "doc_id long, text string, score double").repartition(3)
    found = lm.score_documents(docs, id_fold("doc_id", 5) != 1, batch_bytes=2_000).collect()
    assert len(found) == len(rows)
    wanted = sorted((str(n), out, s) for n, out, s in plain_scores(rows))
    got = sorted((str(r["doc_id"]), r["held_out"], r["score"]) for r in found)
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in wanted], rel=1e-9)
