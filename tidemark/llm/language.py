"""Language identification by a byte convolutional network, trained and applied in numpy.

Filters of several widths slide over fixed-length byte windows; max pooling and a softmax
layer follow. A text is cut into consecutive windows from its first to its last byte, and the
windows' scores are averaged by the bytes they hold.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import Slab, slabs
from tidemark.llm.common import documents, id_fold, shuffle_partitions, stored

UNKNOWN = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
# Bounds of the training sample: about so many texts a language, so many windows a text.
TEXTS_PER_LANGUAGE = 1_200
WINDOWS_PER_TEXT = 4
EPOCHS = 4
# Training on all windows: about so many by one copy of the network between two means of the copies,
# so many means, and so many windows to learn from in all if a small table has to be gone over again.
SHARD_WINDOWS = 1 << 15
ROUNDS = 4
LEAST_LEARNED = 80_000
BATCH = 64
_BLOCK_WINDOWS = 64
# Parts that an interval is cut into while a quantile is looked for.
QUANTILE_PARTS = 1_024
# Texts of fewer bytes are too short to tell whether their byte pairs are those of a language.
LEAST_BYTES = 64
# A text is foreign if its pairs are rarer than those of all but this share of held-out texts, and
# by more than this, in nats a byte.
FOREIGN_SHARE = 0.001
FOREIGN_MARGIN = 0.3
_FINE = 1 << 20
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32


def windows_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte windows from each start, zero beyond its end; A-Z count as a-z."""
    at = start[:, None] + np.arange(WINDOW)
    found = _FOLDED[data[np.minimum(at, max(len(data) - 1, 0))]]
    found[at >= end[:, None]] = 0
    return found


def all_windows(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of whole texts, one after the other: bytes, number of the text, bytes held (at least 1).
    An empty text has one window."""
    count = np.maximum(1, -(-np.diff(slab.offsets) // WINDOW))
    owner = np.repeat(np.arange(len(slab)), count)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = slab.offsets[owner] + rank * WINDOW
    end = slab.offsets[owner + 1]
    if len(slab.data):
        windows = windows_of(slab.data, start, end)
    else:
        windows = np.zeros((len(owner), WINDOW), dtype=np.uint8)
    return windows, owner, np.clip(end - start, 1, WINDOW)


@dataclass
class ByteNetwork:
    """Weights; ``languages`` names the classes."""

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    dense: np.ndarray
    offset: np.ndarray
    # Logarithms of the probabilities of a byte after another, by language.
    pairs: np.ndarray | None = None

    @staticmethod
    def fresh(languages: list[str], rng: np.random.Generator) -> ByteNetwork:
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return ByteNetwork(
            languages,
            normal(256, EMBEDDING, scale=0.5),
            {w: normal(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS},
            {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS},
            normal(FILTERS * len(WIDTHS), len(languages), scale=0.2),
            np.zeros(len(languages), dtype=np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), *self.biases.values(), self.dense, self.offset]

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> list[np.ndarray]:
        """Gradients of the mean cross entropy (weighed, if there are weights), in the order of ``parameters``."""
        count, rows = len(x), np.arange(len(x))
        vectors = self.embedding[x]
        pooled, kept = [], {}
        for w in WIDTHS:
            spots = WINDOW - w + 1
            patches = np.concatenate([vectors[:, j : j + spots] for j in range(w)], axis=2)
            response = patches @ self.filters[w]
            best = response.argmax(axis=1)
            top = np.take_along_axis(response, best[:, None], axis=1)[:, 0] + self.biases[w]
            kept[w] = (best, patches[rows[:, None], best], top > 0)
            pooled.append(np.maximum(top, 0))
        features = np.concatenate(pooled, axis=1)
        logits = features @ self.dense + self.offset
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[rows, y] -= 1
        if weight is None:
            chance /= count
        else:
            chance *= (weight / weight.sum()).astype(np.float32)[:, None]
        back = chance @ self.dense.T
        embedding = np.zeros_like(self.embedding)
        filters, biases = {}, {}
        for k, w in enumerate(WIDTHS):
            best, patches, alive = kept[w]
            own = back[:, k * FILTERS : (k + 1) * FILTERS] * alive
            filters[w] = np.einsum("bfp,bf->pf", patches, own)
            biases[w] = own.sum(axis=0)
            flow = (own[:, :, None] * self.filters[w].T[None]).reshape(count, FILTERS, w, EMBEDDING)
            used = x[rows[:, None, None], best[:, :, None] + np.arange(w)]
            np.add.at(embedding, used.ravel(), flow.reshape(-1, EMBEDDING))
        return [embedding, *filters.values(), *biases.values(), features.T @ chance, chance.sum(axis=0)]

    def tables(self) -> Tables:
        return Tables(self)


class Trainer:
    """Adam on one network, whose weights change in place."""

    def __init__(self, network: ByteNetwork, rng: np.random.Generator):
        self.network, self.rng, self.step = network, rng, 0
        self.values = network.parameters()
        self.first, self.second = [np.zeros_like(v) for v in self.values], [np.zeros_like(v) for v in self.values]

    def epoch(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> None:
        """Go over all windows once, in a drawn order."""
        order = self.rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            self.step += 1
            rate = 0.003 * (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step)
            slopes = self.network.gradients(windows[chosen], labels[chosen], None if weights is None else weights[chosen])
            for v, g, m, s in zip(self.values, slopes, self.first, self.second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * m / (np.sqrt(s) + 1e-8)


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7
) -> ByteNetwork:
    """Fit the network by Adam; equal inputs give equal weights."""
    rng = np.random.default_rng(seed)
    network = ByteNetwork.fresh(languages, rng)
    trainer = Trainer(network, rng)
    for _ in range(max(epochs, min(200, 20_000 // max(1, len(windows))))):
        trainer.epoch(windows, labels)
    return network


def pair_logs(windows: np.ndarray, labels: np.ndarray, languages: int) -> np.ndarray:
    """How likely each byte is after each other one, in the windows of each language."""
    first, second = windows[:, :-1].astype(np.int64), windows[:, 1:].astype(np.int64)
    code = (labels[:, None] * 256 + first) * 256 + second
    return _logs_of_counts(np.bincount(code[second > 0], minlength=languages << 16).reshape(languages, 256, 256))


def _logs_of_counts(counts: np.ndarray) -> np.ndarray:
    counts = counts + 0.02
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


class Tables:
    """The network's filters as sums of table rows for single bytes and byte pairs."""

    def __init__(self, network: ByteNetwork):
        self.dense, self.offset = network.dense, network.offset
        self.steps = []
        for w in WIDTHS:
            single = [
                network.embedding @ network.filters[w][j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(w)
            ]
            parts = []
            for j in range(0, w - 1, 2):
                both = single[j][:, None, :] + single[j + 1][None, :, :]
                parts.append((j, True, both.reshape(1 << 16, FILTERS)))
            if w % 2:
                parts.append((w - 1, False, single[w - 1]))
            self.steps.append((w, parts, network.biases[w]))

    def logits(self, windows: np.ndarray, chunk: int = 256) -> np.ndarray:
        out = np.empty((len(windows), len(self.offset)), dtype=np.float32)
        for at in range(0, len(windows), chunk):
            x = windows[at : at + chunk]
            pairs = (x[:, :-1].astype(np.uint16) << np.uint16(8)) | x[:, 1:]
            pooled = []
            for w, parts, bias in self.steps:
                spots, total = WINDOW - w + 1, None
                for j, pair, table in parts:
                    part = table[(pairs if pair else x)[:, j : j + spots]]
                    total = part if total is None else np.add(total, part, out=total)
                pooled.append(np.maximum(total.max(axis=1) + bias, 0))
            out[at : at + chunk] = np.concatenate(pooled, axis=1) @ self.dense + self.offset
        return out


def fit(
    docs: DataFrame,
    usable,
    *,
    text_column: str = "text",
    label_column: str = "lang",
    id_column: str = "doc_id",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
) -> ByteNetwork | None:
    """Train on a bounded sample of labelled texts; ``None`` if there are none.

    The sample holds about ``texts_per_language`` texts of each label, chosen by a hash of the
    id, and up to ``WINDOWS_PER_TEXT`` windows spread over each whole text.
    """
    labelled = docs.where(usable & F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(label_column).count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.create_map(
        *[F.lit(x) for k in languages for x in (k, int(_FINE * min(1, texts_per_language / counts[k])))]
    )
    drawn = F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(_FINE)) < share[F.col(label_column)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, _, slab in slabs(batch.column(1)):
                kinds, rows = [], []
                for i in range(len(slab)):
                    begin, end = slab.offsets[i], slab.offsets[i + 1]
                    room = max(0, end - begin - WINDOW)
                    spots = np.unique(np.linspace(0, room, WINDOWS_PER_TEXT).astype(np.int64))
                    found = windows_of(slab.data, begin + spots, np.full(len(spots), end))
                    rows += [x.tobytes() for x in found]
                    kinds += [names[first + i]] * len(found)
                yield pa.RecordBatch.from_pydict({"label": kinds, "window": pa.array(rows, type=pa.binary())})

    sample = labelled.where(drawn).select(label_column, text_column)
    rows = sorted(map(tuple, sample.mapInArrow(cut, "label string, window binary").collect()))
    if not rows:
        return None
    windows = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint8).reshape(-1, WINDOW)
    index = {k: i for i, k in enumerate(languages)}
    classes = np.array([index[r[0]] for r in rows])
    network = train(windows, classes, languages)
    network.pairs = pair_logs(windows, classes, len(languages))
    return network


def fit_all(
    docs: DataFrame,
    usable,
    *,
    text_column: str = "text",
    label_column: str = "lang",
    id_column: str = "doc_id",
    shard_windows: int = SHARD_WINDOWS,
) -> ByteNetwork | None:
    """Train on every window of every labelled text; ``None`` if there are none.

    Texts are dealt into rounds and their windows into shards, by a hash of id and text. In a round every shard
    trains a copy of the network on its windows, and the mean of the copies begins the next round. A window
    counts by the bytes it holds, and languages count alike. A small table is gone over several times. Equal tables
    get equal weights up to rounding however they are cut into files, unless ids are null: those rows are dealt by their places.
    """
    text = F.col(text_column)
    place = F.when(F.col(id_column).isNull(), F.monotonically_increasing_id())
    labelled = docs.where(usable & F.col(label_column).isNotNull() & text.isNotNull()).select(
        F.col(label_column).alias("label"),
        text.alias("text"),
        F.xxhash64(F.col(id_column).cast("string"), text, place).alias("key"),
    )
    size = F.octet_length("text").cast("long")
    counts = labelled.groupBy("label").agg(
        F.sum(F.greatest(F.lit(1), F.ceil(size / WINDOW))), F.sum(F.greatest(F.lit(1), size))
    ).collect()
    if not counts:
        return None
    languages = sorted(r[0] for r in counts)
    total = sum(r[1] for r in counts)
    weight = {r[0]: total / len(counts) / r[2] for r in counts}
    rounds = max(1, min(ROUNDS, total // shard_windows))
    shards = max(1, round(total / rounds / shard_windows))
    passes = max(1, min(200, LEAST_LEARNED // total))
    network = ByteNetwork.fresh(languages, np.random.default_rng(7))
    for number in range(rounds):
        part = labelled.where(F.pmod(F.shiftright("key", 32), F.lit(rounds)) == number)
        network = _mean_of_copies(part, network, number, shards, passes, shard_windows, weight)
    network.pairs = _logs_of_counts(_all_pairs(labelled, languages))
    return network


def _mean_of_copies(
    labelled: DataFrame,
    network: ByteNetwork,
    number: int,
    shards: int,
    passes: int,
    shard_windows: int,
    weight: dict[str, float],
) -> ByteNetwork:
    """The mean, by windows, of copies of the network that were trained on a shard each."""
    index = {k: i for i, k in enumerate(network.languages)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, keys = batch.column(0), batch.column(2)
            for first, _, slab in slabs(batch.column(1)):
                windows, owner, held = all_windows(slab)
                edges = np.searchsorted(owner, np.arange(len(slab) + 1))
                rows, begins, blocks, sizes = [], [], [], []
                for i in range(len(slab)):
                    for at in range(edges[i], edges[i + 1], _BLOCK_WINDOWS):
                        end = min(at + _BLOCK_WINDOWS, edges[i + 1])
                        rows.append(first + i)
                        begins.append(at - edges[i])
                        blocks.append(windows[at:end].tobytes())
                        sizes.append(int(held[at:end].sum()))
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [labels.take(taken), keys.take(taken), pa.array(begins, pa.int64()), pa.array(blocks, pa.binary()), pa.array(sizes, pa.int64())],
                    names=["label", "key", "begin", "block", "held"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trainer, seen, waiting, held = None, None, 0, [], 0

        def settle() -> None:
            nonlocal waiting, held
            windows = np.concatenate([w for w, _, _ in waiting])
            labels = np.concatenate([np.full(len(w), k) for w, k, _ in waiting])
            weights = np.concatenate([v for _, _, v in waiting])
            for _ in range(passes):
                trainer.epoch(windows, labels, weights)
            waiting, held = [], 0

        def finished() -> pa.RecordBatch:
            if waiting:
                settle()
            flat = np.concatenate([v.ravel() for v in trainer.values]).astype(np.float64) * seen
            values = np.concatenate([[seen], flat])
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["place", "value"])

        for batch in batches:
            for own, label, block, size in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if own != shard:
                    if trainer:
                        yield finished()
                    shard, seen = own, 0
                    trainer = Trainer(copy.deepcopy(network), np.random.default_rng((7, number, own)))
                windows = np.frombuffer(block, dtype=np.uint8).reshape(-1, WINDOW)
                weights = np.full(len(windows), WINDOW, dtype=np.float64)
                weights[-1] = size - WINDOW * (len(windows) - 1)
                waiting.append((windows, index[label], weights * weight[label]))
                seen += len(windows)
                held += len(windows)
                if held >= 2 * shard_windows:
                    settle()
        if trainer:
            yield finished()

    blocks = labelled.select("label", "text", "key").mapInArrow(cut, "label string, key long, begin long, block binary, held long")
    shard = F.pmod(F.xxhash64("key", "begin"), F.lit(shards))
    dealt = blocks.select(shard.alias("shard"), "label", "block", "held", "key", "begin")
    dealt = dealt.repartition(max(shards, shuffle_partitions(labelled.sparkSession)), "shard")
    dealt = dealt.sortWithinPartitions("shard", "key", "begin", "label").select("shard", "label", "block", "held")
    sums = dealt.mapInArrow(learn, "place long, value double").groupBy("place").agg(F.sum("value")).collect()
    if not sums:
        return network
    values = np.array([r[1] for r in sorted(sums)])
    mean, result, at = values[1:] / values[0], copy.deepcopy(network), 0
    for v in result.parameters():
        v[...] = mean[at : at + v.size].reshape(v.shape)
        at += v.size
    return result


def _all_pairs(labelled: DataFrame, languages: list[str]) -> np.ndarray:
    """How often each byte follows each other one in the windows of the texts, by label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, _, slab in slabs(batch.column(1)):
                windows, owner, _ = all_windows(slab)
                code = (windows[:, :-1].astype(np.int32) << 8) | windows[:, 1:]
                real, own = windows[:, 1:] > 0, names[first + owner]
                for name in set(own):
                    mine = own == name
                    counts = np.bincount(code[mine][real[mine]], minlength=1 << 16)
                    found[name] = found[name] + counts if name in found else counts
        for name, counts in found.items():
            codes = np.flatnonzero(counts)
            columns = [pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int32)), pa.array(counts[codes])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "code", "n"])

    pairs = labelled.select("label", "text").mapInArrow(count, "label string, code int, n long")
    index, counts = {k: i for i, k in enumerate(languages)}, np.zeros((len(languages), 1 << 16), dtype=np.int64)
    for label, code, n in pairs.groupBy("label", "code").agg(F.sum("n")).collect():
        counts[index[label], code] = n
    return counts.reshape(len(languages), 256, 256)


def identify(
    docs: DataFrame,
    network: ByteNetwork | None,
    *,
    text_column: str = "text",
    prediction: str = "lang_pred",
    familiarity: str | None = None,
) -> DataFrame:
    """Append the predicted language and its probability; all rows and columns stay.

    Null text, text without a letter and an untrained network give ``und`` with score 0. Equal
    texts get equal results. Existing columns named like the new ones are replaced. ``familiarity`` names a
    further column: how likely the text's byte pairs are in that language, as a mean
    logarithm a byte; null for texts that are too short to tell.
    """
    kept = [c for c in docs.columns if c not in (prediction, "score", familiarity)]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    position = kept.index(text_column)
    languages = network.languages if network else []
    weights = network

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = weights.tables() if weights else None
        for batch in batches:
            names: list[str | None] = []
            scores: list[float] = []
            likely: list[float | None] = []
            for _, _, slab in slabs(batch.column(position)):
                if tables is None:
                    names += [UNKNOWN] * len(slab)
                    scores += [0.0] * len(slab)
                    likely += [None] * len(slab)
                    continue
                size = np.diff(slab.offsets)
                windows, owner, held = all_windows(slab)
                if len(slab.data):
                    logits = tables.logits(windows).astype(np.float64)
                else:
                    logits = np.zeros((len(owner), len(languages)))
                weight = held.astype(np.float64)
                totals = np.zeros((len(slab), len(languages)))
                np.add.at(totals, owner, logits * weight[:, None])
                totals /= np.bincount(owner, weight, len(slab))[:, None]
                chance = np.exp(totals - totals.max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
                best = chance.argmax(axis=1)
                names += [languages[k] for k in best]
                scores += chance[np.arange(len(best)), best].tolist()
                if familiarity:
                    likely += _familiarity(weights.pairs, windows, best[owner], owner, size)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    *([pa.array(likely, pa.float64())] if familiarity else []),
                ],
                names=[*kept, prediction, "score", *([familiarity] if familiarity else [])],
            )

    fields = schema.add(prediction, "string").add("score", "double")
    if familiarity:
        fields = fields.add(familiarity, "double")
    found = docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(predict, fields)
    letters = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    return found.withColumns(
        {
            prediction: F.when(letters, F.col(prediction)).otherwise(UNKNOWN),
            "score": F.when(letters, F.col("score")).otherwise(0.0),
        }
    )


def _familiarity(
    pairs: np.ndarray, windows: np.ndarray, language: np.ndarray, owner: np.ndarray, size: np.ndarray
) -> list[float | None]:
    """Mean logarithm of the pairs of each text in its language; None for short texts."""
    code = (windows[:, :-1].astype(np.int32) << 8) | windows[:, 1:]
    real = windows[:, 1:] > 0
    values = pairs.reshape(len(pairs), -1)[language[:, None], code]
    sums = np.bincount(owner, np.where(real, values, 0).sum(axis=1), len(size))
    counts = np.bincount(owner, real.sum(axis=1), len(size))
    means = sums / np.maximum(counts, 1)
    return [float(m) if n >= LEAST_BYTES else None for m, n in zip(means, size.tolist())]


def exact_quantile(values: DataFrame, column: str, share: float, parts: int = QUANTILE_PARTS) -> float | None:
    """The quantile of all values (linear between two), None if there are none.

    The interval that holds it is cut into parts and only their counts and bounds are brought together, until
    one value is left.
    """
    value = F.col(column)
    low, high, count = values.agg(F.min(value), F.max(value), F.count(value)).first()
    if not count:
        return None
    place = share * (count - 1)
    rank, below, inside = int(place), 0, count
    while low < high:
        part = F.least(F.floor((value - low) / ((high - low) / parts)), F.lit(parts - 1))
        cells = values.where(value.between(low, high)).groupBy(part.alias("part"))
        for r in cells.agg(F.min(value), F.max(value), F.count(value)).orderBy("part").collect():
            _, low, high, inside = r
            if rank < below + inside:
                break
            below += inside
    after = low
    if rank + 1 >= below + inside and rank + 1 < count:
        after = values.where(value > low).agg(F.min(value)).first()[0]
    return low + (after - low) * (place - rank)


def least_familiarity(
    docs: DataFrame,
    network: ByteNetwork,
    held_out,
    *,
    text_column: str = "text",
    label_column: str = "lang",
) -> float | None:
    """The least familiarity of a text in one of the languages, from all rightly told held-out texts.

    None if there are none that are long enough.
    """
    known = docs.where(held_out & F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    found = identify(known.select(text_column, label_column), network, text_column=text_column, familiarity="_likely")
    right = found.where((F.col("lang_pred") == F.col(label_column)) & F.col("_likely").isNotNull())
    least = exact_quantile(stored(right.select("_likely")), "_likely", FOREIGN_SHARE)
    return None if least is None else least - FOREIGN_MARGIN


def trained(docs: DataFrame, *, on_all: bool = False) -> ByteNetwork | None:
    """The network learned from the documents outside the held-out fold: from all their windows, or a bounded sample."""
    return (fit_all if on_all else fit)(docs, id_fold("doc_id", 3) != 1)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = (id_fold("doc_id", 3) == 1).alias("held_out")
    found = identify(docs.select("doc_id", "text"), trained(docs))
    return found.select("doc_id", held_out, "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}
