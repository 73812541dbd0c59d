"""The byte network against plain convolutions, source targets against a loop, texts beyond a slab."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language, mixing, personal, quality
from tidemark.llm.common import id_fold, prepared

WORD = r"[^\x20\x09-\x0D]+"


def plain_logits(network, window):
    """Every filter at every place, one after the other."""
    vectors = network.embedding[window].astype(np.float64)
    pooled = []
    for width in language.WIDTHS:
        best = np.full(language.FILTERS, -np.inf)
        for spot in range(language.WINDOW - width + 1):
            patch = np.concatenate([vectors[spot + j] for j in range(width)])
            best = np.maximum(best, patch @ network.filters[width])
        pooled.append(np.maximum(best + network.biases[width], 0))
    return np.concatenate(pooled) @ network.dense + network.offset


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(3)
    made = language.ByteNetwork.fresh(["aa", "bb", "cc"], rng)
    for bias in made.biases.values():
        bias += rng.standard_normal(bias.shape).astype(np.float32) * 0.1
    return made


def test_tables_give_the_logits_of_the_plain_network(network):
    rng = np.random.default_rng(4)
    windows = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    windows[1, 20:] = 0
    windows[2] = 0
    found = network.tables().logits(windows, chunk=2)
    for window, logits in zip(windows, found):
        assert logits == pytest.approx(plain_logits(network, window), abs=1e-3)


def test_gradients_equal_differences(network):
    rng = np.random.default_rng(5)
    windows = rng.integers(97, 110, (4, language.WINDOW)).astype(np.uint8)
    labels = np.array([0, 1, 2, 1])

    def loss():
        total = 0.0
        for window, label in zip(windows, labels):
            logits = plain_logits(network, window)
            total += np.log(np.exp(logits - logits.max()).sum()) + logits.max() - logits[label]
        return total / len(windows)

    for value, gradient in zip(network.parameters(), network.gradients(windows, labels)):
        spots = np.argsort(-np.abs(gradient).ravel())[:3]
        for spot in spots.tolist():
            at = np.unravel_index(spot, value.shape)
            before, step = value[at].copy(), 1e-3
            value[at] = before + step
            up = loss()
            value[at] = before - step
            down = loss()
            value[at] = before
            assert gradient[at] == pytest.approx((up - down) / (2 * step), rel=0.1, abs=2e-3)


def test_pairs_are_counted_in_each_language():
    windows = np.zeros((2, language.WINDOW), dtype=np.uint8)
    windows[0, :4] = list(b"abab")
    windows[1, :3] = list(b"acc")
    logs = language.pair_logs(windows, np.array([0, 1]), 2).reshape(2, 256, 256)
    assert np.allclose(np.exp(logs).sum(axis=2), 1, atol=1e-4)
    assert logs[0, ord("a"), ord("b")] > logs[0, ord("a"), ord("c")] and logs[1, ord("a"), ord("c")] > logs[1, ord("a"), ord("b")]


def held_out_or_not(wanted, count):
    ids = (i for i in range(10**6) if (zlib.crc32(str(i).encode()) % 3 == 1) == wanted)
    return [next(ids) for _ in range(count)]


def words(rng, letters, size):
    """Words of three to seven letters, beginning and ending with a whole one."""
    found = []
    while sum(len(w) + 1 for w in found) < size:
        found.append("".join(rng.choice(list(letters), rng.integers(3, 8))))
    return " ".join(found)


def test_all_windows_of_all_labelled_texts_are_learned(spark, monkeypatch):
    """Letters that occur only between the windows of a sample are known, and pairs equal plain counts."""
    prepared(spark)
    monkeypatch.setattr(language, "LEAST_LEARNED", 20_000)
    rng = np.random.default_rng(6)
    plain, rare = "abcdefghij", "stuvwxyz"
    rows = []
    for i in held_out_or_not(False, 60) + held_out_or_not(True, 30):
        rows.append((i, words(rng, plain, 1_500) + " " + words(rng, rare, 500) + " " + words(rng, plain, 4_500), "aa"))
        rows.append((i, words(rng, "klmnopqr", 900), "bb"))
    docs = spark.createDataFrame([*rows, (None, None, "aa"), (None, "", "bb"), (4, "x", None)], "doc_id long, text string, lang string")
    docs = docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    network = language.trained(docs, on_all=True)
    counts = np.zeros((2, 256, 256))
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 3 != 1:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            for at in range(0, len(data), language.WINDOW):
                window = data[at : at + language.WINDOW]
                np.add.at(counts["ab".index(lang[0])], (window[:-1], window[1:]), 1)
    assert network.languages == ["aa", "bb"]
    assert np.allclose(network.pairs, np.log((counts + 0.02) / (counts + 0.02).sum(axis=2, keepdims=True)), atol=1e-4)
    new = spark.createDataFrame([(-1, words(rng, rare, 300), None, "s", 300), (-2, words(rng, "0123456789", 200) + " a", None, "s", 202)], docs.select(corpus_pipeline.COLUMNS[0], "text", "lang", "source", "n_chars").schema)
    kept = corpus_pipeline.known_language(spark, docs.select(*new.columns).unionByName(new), "").select("doc_id").collect()
    assert {r[0] for r in kept if r[0] is not None and r[0] < 0} == {-1}


def test_training_does_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    """Several rounds and shards; equal languages are told, and files don't matter."""
    prepared(spark)
    monkeypatch.setattr(language, "LEAST_LEARNED", 1)
    rng = np.random.default_rng(8)
    rows = [(i % 300, words(rng, ("abcdefg", "hijklmn")[i % 2], 700), ("aa", "bb")[i % 2]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, other = (language.fit_all(docs.repartition(n), F.lit(True), shard_windows=400) for n in (2, 7))
    for a, b in zip(one.parameters(), other.parameters()):
        assert np.allclose(a, b, atol=1e-5)
    assert (one.pairs == other.pairs).all()
    found = language.identify(docs, one).where("lang = lang_pred").count()
    assert found >= 0.95 * len(rows)


@pytest.mark.parametrize("share", [0, 0.001, 0.37, 0.5, 1])
def test_quantiles_are_those_of_all_values(spark, share):
    rng = np.random.default_rng(9)
    for values in (rng.standard_normal(5_000) * 3, np.round(rng.standard_normal(3_000), 1), np.full(40, -2.5), np.array([1.0]), 1e-12 * rng.random(700) - 2):
        table = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        assert language.exact_quantile(table, "v", share, parts=8) == pytest.approx(np.quantile(values, share), abs=1e-15)
    assert language.exact_quantile(table.where("v > 5"), "v", share) is None


def test_the_bound_comes_from_all_held_out_texts(spark, network, monkeypatch):
    """More texts than were drawn before."""
    prepared(spark)
    rng = np.random.default_rng(10)
    monkeypatch.setattr(network, "pairs", rng.standard_normal((3, 256, 256)).astype(np.float32) - 4)
    rows = [(i, "".join(rng.choice(list("abcdefgh"), 80)), None) for i in range(20_000)]
    told = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), network, familiarity="likely")
    docs = told.select("doc_id", "text", F.col("lang_pred").alias("lang"))
    likely = [r[0] for r in told.select("likely").collect()]
    least = language.least_familiarity(docs, network, F.lit(True))
    assert least == pytest.approx(np.quantile(likely, language.FOREIGN_SHARE) - language.FOREIGN_MARGIN, abs=1e-12)


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; whoever is above the cap stops there, and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = sum(sizes.values()), set(names), {}
    while open_:
        shared = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if shared[s] > most * sizes[s]]
        if not over:
            return found | shared
        for s in over:
            found[s] = most * sizes[s]
            left -= found[s]
            open_.discard(s)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_the_loop(spark, seed):
    prepared(spark)
    rng = np.random.default_rng(seed)
    names = [None, "b", "a", "É", "z", "Z", "aa"][: 3 + seed]
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 30) ** (1 + i % 2))), names[int(rng.integers(0, len(names)) ** 2 % len(names))]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(WORD, text))
    found = mixing.mix_sources(docs, block=16).collect()
    wanted = targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]


def test_quality_of_empty_tables(spark, tmp_path):
    for table, schema in (("documents", "doc_id long, text string, score double"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert quality.op4_quality_rules(spark, str(tmp_path)).collect() == []


def test_a_text_beyond_a_slab(spark):
    """Three megabytes with data near the ends of the slabs' usual size."""
    prepared(spark)
    filler = "wort " * 220_000
    text = "a.b@c.de " + filler + "x@y.org " + filler + "+49 30 1234567"
    docs = spark.createDataFrame([(1, text, "k"), (2, "kurz", "k")], "doc_id long, text string, spans string")
    found = {r["doc_id"]: r for r in personal.find_personal_data(docs).collect()}
    assert (found[1]["n_email"], found[1]["n_phone"], found[2]["n_email"]) == (2, 1, 0)
    counts = {r["doc_id"]: r for r in quality.text_statistics(docs).collect()}
    assert counts[1]["n_words"] == len(text.split()) and counts[2]["n_words"] == 1


def test_folds_by_checksum(spark):
    ids = [0, 1, -5, 12345678901, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", id_fold("doc_id", 7).alias("f"), F.lit(1)).collect()
    assert [r["f"] for r in rows] == [0 if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 7 for r in rows]
