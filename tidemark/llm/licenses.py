"""License scan: phrases counted exactly, notices found by a set-similarity join.

Blocks of consecutive words are joined with a table of notices on the share of a notice's distinct
words that a block holds. The notices' words are ordered by their frequency in all documents, rarest
first. A block that meets the threshold holds a word of the notice's prefix (prefix filter). Every word of
a notice near a prefix word starts a block, so none that meets the threshold is missed, wherever in
the text it lies. A block leaves if it holds fewer of the notice's words than needed (length filter), or if
too few can follow the rarest one met in the notice's order (positional filter); the distinct words of
what is left are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import LETTER_OR_DIGIT, Slab, slabs
from tidemark.llm.common import documents

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of common licenses, lower case and without punctuation.
NOTICES = {
    "notice-mit": "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction including without"
    " limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
    " and to permit persons to whom the software is furnished to do so subject to the following conditions the above"
    " copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "notice-mit-opening": "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files",
    "notice-warranty": "the software is provided as is without warranty of any kind express or implied including but"
    " not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "notice-apache": "licensed under the apache license version 2 0",
    "notice-apache-header": "licensed under the apache license version 2 0 the license you may not use this file except"
    " in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"
    " unless required by applicable law or agreed to in writing software distributed under the license is distributed"
    " on an as is basis without warranties or conditions of any kind either express or implied see the license for the"
    " specific language governing permissions and limitations under the license",
    "notice-gpl": "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license",
    "notice-gpl-header": "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license as published by the free software foundation either version 3 of the license or at your"
    " option any later version this program is distributed in the hope that it will be useful but without any warranty"
    " without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general"
    " public license for more details",
    "notice-bsd": "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met",
    "notice-bsd-conditions": "redistributions of source code must retain the above copyright notice this list of"
    " conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice"
    " this list of conditions and the following disclaimer in the documentation and or other materials provided with"
    " the distribution",
    "notice-isc": "permission to use copy modify and or distribute this software for any purpose with or without"
    " fee is hereby granted",
    "notice-isc-full": "permission to use copy modify and or distribute this software for any purpose with or without"
    " fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "notice-mpl": "this source code form is subject to the terms of the mozilla public license",
    "notice-mpl-header": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of"
    " the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "notice-cc": "this work is licensed under a creative commons attribution",
    "notice-public-domain": "this is free and unencumbered software released into the public domain",
    "notice-public-domain-full": "this is free and unencumbered software released into the public domain anyone is free to"
    " copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"
    " for any purpose commercial or non commercial and by any means",
}

CONTAINMENT = Fraction(4, 5)
# Words of a block: so many at least, and a quarter more than the notice has.
BLOCK_WORDS = 64
# Blocks that are counted together.
BLOCKS_AT_ONCE = 20_000

MATCH = "array<struct<label: string, first_word: long, containment: double>>"


def block_words(notice_words: int) -> int:
    return max(BLOCK_WORDS, ceil(notice_words * 5 / 4))


def _hashes(words: Sequence[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    slab = Slab(np.frombuffer(b"".join(data), dtype=np.uint8), np.concatenate([[0], ends]))
    return slab.span_hashes(slab.offsets[:-1], slab.offsets[1:], fold=True)


def word_counts(docs: DataFrame, words: Sequence[str], text_column: str = "text") -> dict[str, int]:
    """Occurrences of some words in all documents; the result has one entry per word."""
    wanted = sorted(set(words))
    if not wanted:
        return {}
    codes = _hashes(wanted)
    order = np.argsort(codes)
    ordered = codes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for _, _, slab in slabs(batch.column(0)):
                start, end = slab.runs(LETTER_OR_DIGIT)
                found = slab.span_hashes(start, end, fold=True)
                at = np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)
                totals += np.bincount(order[at[ordered[at] == found]], minlength=len(wanted))
        yield pa.RecordBatch.from_pydict({"word": wanted, "n": totals})

    counted = docs.select(text_column).mapInArrow(count, "word string, n long")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class Notice:
    """A notice's distinct words in global order, rarest first."""

    def __init__(self, label: str, text: str, counts: Mapping[str, int], threshold: Fraction):
        words = sorted(set(text.split()), key=lambda w: (counts.get(w, 0), w))
        codes = _hashes(words)
        self.label, self.size = label, len(words)
        self.least = ceil(threshold * len(words))
        self.width = block_words(len(text.split()))
        # Ranks up to this one are the prefix.
        self.prefix = self.size - self.least
        self.rank = np.argsort(codes)
        self.codes = codes[self.rank]

    def blocks(self, codes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, float]]:
        """(text, first word, containment) of the blocks that qualify, overlapping ones as one: the best.

        ``codes``: word hashes of some texts; ``first``: index of each text's first word, and an end.
        """
        spot = np.minimum(np.searchsorted(self.codes, codes), self.size - 1)
        at = np.flatnonzero(self.codes[spot] == codes)
        rank = self.rank[spot[at]]
        rare = at[rank <= self.prefix]
        if not len(rare):
            return []
        text = np.searchsorted(first, at, side="right") - 1
        # A block from each word of the notice, up to its width or the text's end.
        stop = np.minimum(at + self.width, first[text + 1])
        follows = np.searchsorted(rare, at)
        led = (follows < len(rare)) & (rare[np.minimum(follows, len(rare) - 1)] < stop)
        last = np.searchsorted(at, stop)
        begin = np.flatnonzero(led & (last - np.arange(len(at)) >= self.least))
        share = np.zeros(len(begin))
        for cut in range(0, len(begin), BLOCKS_AT_ONCE):
            rows = begin[cut : cut + BLOCKS_AT_ONCE]
            # No block has more of the notice's words than it has words.
            wide = int((last[rows] - rows).max())
            index = rows[:, None] + np.arange(wide)
            inside = index < last[rows][:, None]
            held = np.where(inside, rank[np.minimum(index, len(rank) - 1)], self.size)
            # From the rarest word met on, the notice still has to hold as many as are needed.
            may = np.flatnonzero(self.size - held.min(axis=1) >= self.least)
            ordered = np.sort(held[may], axis=1)
            new = np.ones(ordered.shape, dtype=bool)
            new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            share[cut + may] = (new & (ordered < self.size)).sum(axis=1) / self.size
        good = np.flatnonzero(share >= self.least / self.size)
        found: list[tuple[int, int, float]] = []
        end = -1
        for i in good.tolist():
            place, owner = int(at[begin[i]]), int(text[begin[i]])
            entry = (owner, place - int(first[owner]), float(share[i]))
            if found and place < end and found[-1][0] == owner:
                if entry[2] > found[-1][2]:
                    found[-1] = entry
            else:
                found.append(entry)
            end = int(stop[begin[i]])
        return found


class NoticeIndex:
    """All notices."""

    def __init__(self, notices: Mapping[str, str], counts: Mapping[str, int], threshold: Fraction):
        self.notices = [Notice(label, text, counts, threshold) for label, text in sorted(notices.items())]

    def matches(self, codes: np.ndarray, first: np.ndarray) -> list[tuple[int, str, int, float]]:
        """(text, label, first word of the block, containment) of the blocks that qualify."""
        if not len(codes):
            return []
        return [(text, n.label, word, share) for n in self.notices for text, word, share in n.blocks(codes, first)]


def scan_licenses(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    notices: Mapping[str, str] = NOTICES,
    threshold: Fraction = CONTAINMENT,
) -> DataFrame:
    """Phrases and notices of each document.

    Columns: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` and ``matches`` (label, first word and containment of every block that meets
    the threshold; of overlapping ones the best). The score is 1 with a phrase, else the best containment,
    else 0. Null text counts as empty; repeated rows give repeated results; other columns are
    ignored. Two passes over the texts, no shuffle of documents.
    """
    if any(not text.split() for text in notices.values()):
        raise ValueError("a notice holds words")
    counts = word_counts(docs, [w for text in notices.values() for w in text.split()], text_column)
    index = NoticeIndex(notices, counts, threshold)
    phrases = [(_hashes(p.split()), label) for p, label in PHRASES.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start_row, last_row, slab in slabs(batch.column(1)):
                count = len(slab)
                start, end, first = slab.words(LETTER_OR_DIGIT)
                codes = slab.span_hashes(start, end, fold=True)
                places = [0] * count
                lowest: list[int | None] = [None] * count
                highest: list[int | None] = [None] * count
                base: list[set[str]] = [set() for _ in range(count)]
                matches: list[list[dict]] = [[] for _ in range(count)]
                for phrase, label in phrases:
                    spots = max(0, len(codes) - len(phrase) + 1)
                    hit = np.ones(spots, dtype=bool)
                    for j, code in enumerate(phrase):
                        hit &= codes[j : j + spots] == code
                    at = np.flatnonzero(hit)
                    text = np.searchsorted(first, at, side="right") - 1
                    whole = at + len(phrase) <= first[text + 1]
                    for t, word in zip(text[whole].tolist(), (at - first[text])[whole].tolist()):
                        places[t] += 1
                        base[t].add(label)
                        lowest[t] = word if lowest[t] is None else min(lowest[t], word)
                        highest[t] = word if highest[t] is None else max(highest[t], word)
                for t, label, word, share in index.matches(codes, first):
                    matches[t].append({"label": label, "first_word": word, "containment": share})
                labels = [",".join(sorted(b | {m["label"] for m in ms})) for b, ms in zip(base, matches)]
                scores = [1.0 if b else max((m["containment"] for m in ms), default=0.0) for b, ms in zip(base, matches)]
                match = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("containment", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start_row, last_row - start_row),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(places, pa.int64()),
                        pa.array(lowest, pa.int64()),
                        pa.array(highest, pa.int64()),
                        pa.array([",".join(sorted(b)) for b in base], pa.string()),
                        pa.array(labels, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(matches, match),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"],
                )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(
        scan,
        "doc_id long, n_words long, n_base long, first_word long, last_word long,"
        f" base_labels string, labels string, score double, matches {MATCH}",
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir)).drop("matches")


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES: dict[str, str] = {}
