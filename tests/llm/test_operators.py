"""Operators against brute force on small frames with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import arrays, language, language_model, licenses, mixing, near_duplicates, packing, personal, quality
from tidemark.llm import repeated_spans
from tidemark.llm.common import id_fold, prepared

WORD = r"[^\x20\x09-\x0D]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def sample_texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, long_text = prose(120), prose(6_000)
    texts = [None, "", " ", "\n\n", "A", "one two three", long_text, "x" * 5_000, "MIT license\nThe MIT License and mit\tlicense"]
    for _ in range(30):
        base = prose(rng.randint(40, 160))
        texts += [base, base, base.upper(), base + " tail", prose(20) + " " + passage + " " + prose(30)]
        words = base.split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts.append("a b.\x1cc d  e f\n<|endoftext|> it's")
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    rows = [(i, t, ("aa", "bb", None)[i % 3], ("s1", "s2", None)[i % 3], 0, "x") for i, t in enumerate(sample_texts())]
    rows.append((None, "a row without an id " * 30, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_spans_that_start_elsewhere_are_removed(docs, rows):
    count = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[s : s + 400] for s in range(len(data) - 399))
    for limit in (20_000, 1):
        found = by_id(repeated_spans.remove_repeats(docs, most_in_group=limit))
        assert len(found) == len(rows)
        for name, text in rows:
            data = (text or "").encode()
            covered = np.zeros(len(data) + 1, dtype=bool)
            for s in range(len(data) - 399):
                if count[data[s : s + 400]] > 1:
                    covered[s : s + 400] = True
            kept = bytes(b for b, c in zip(data, covered) if not c)
            runs = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
            r = found[name]
            assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), len(data) - len(kept), runs)
            assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest() and bytes(r["kept"]) == kept


def test_classes_are_the_components_of_all_links(docs, rows):
    sets = {}
    for name, text in rows:
        words = re.findall(WORD, (text or "").translate(FOLD))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        sets[name] = grams
    leader = {name: name for name in sets if name is not None}
    changed = True
    links = [
        (a, b) for a in leader for b in leader
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(leader[a], leader[b])
            if leader[a] != low or leader[b] != low:
                leader[a] = leader[b] = low
                changed = True
    found = by_id(near_duplicates.near_duplicate_classes(docs, batch_bytes=20_000))
    assert {n: r["n_shingles"] for n, r in found.items()} == {n: len(s) for n, s in sets.items()}
    assert {n: r["component_id"] for n, r in found.items() if n is not None} == leader
    assert found[None]["component_id"] is None


def test_base_scores_and_interpolation(docs, rows):
    tokens = {n: re.findall(WORD, (t or "").translate(FOLD)) + [None] for n, t in rows}
    held = {n: n is not None and zlib.crc32(str(n).encode()) % 5 == 1 for n in tokens}
    count = collections.Counter(w for n in tokens if not held[n] for w in tokens[n])
    total, distinct = sum(count.values()), len(count)
    results = [
        by_id(language_model.score_documents(docs, id_fold("doc_id", 5) != 1, batch_bytes=size)) for size in (10_000, 1 << 20)
    ]
    for n, words in tokens.items():
        r = results[0][n]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert r["base_score"] == pytest.approx(base) and r["held_out"] == held[n]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(count[w] > 0 for w in words), total)
        assert r["score"] <= 1e-9 and r["score"] == pytest.approx(results[1][n]["score"])


def test_mixture_weights_prefer_what_predicts():
    levels = language_model.LEVELS
    cells = np.array([(5 * levels + 2) * levels + 30, (2 * levels + 0) * levels + 5])
    mixture = language_model.expectation_maximisation(cells, np.array([100, 100]), 1e-6)
    assert mixture[5, 0] > 0.95 and mixture[2, 1] > 0.95
    assert np.allclose(mixture.sum(axis=1), 1)


def test_packing_covers_every_token_once(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = collections.defaultdict(list)
    packed = packing.pack_documents(docs, packing.default_tokenizer()).collect()
    assert len({p["sequence_id"] for p in packed}) == len(packed)
    for p in packed:
        pieces[p["doc_id"]].append(p)
    for name, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        joined = []
        for p in sorted(pieces[name], key=lambda p: p["start"]):
            assert p["start"] == len(joined) and p["length"] in {1 << k for k in range(11)}
            assert p["length"] == len(p["ids"]) and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], dtype="<u4").tobytes())
            joined += p["ids"]
        assert joined == ids


def test_special_strings_get_the_ids_of_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x  y", "<|endoftext", "plain <|end oftext|>", "é" * 3_000_000 + " <|endoftext|>", "w " * 900_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    packed = packing.pack_documents(df, packing.default_tokenizer())
    pieces = sorted(packed.collect(), key=lambda p: (p["doc_id"], p["start"]))
    for i, text in enumerate(texts):
        ids = [x for p in pieces if p["doc_id"] == i for x in p["ids"]]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_buckets_hold_pieces_of_one_length(spark, docs, tmp_path):
    packed = packing.pack_documents(docs, packing.default_tokenizer())
    packing.write_buckets(packed, str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    assert stored.count() == packed.count()
    assert stored.where("length <> shiftleft(1, bucket) or size(ids) <> length").isEmpty()


def _luhn(digits):
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


@pytest.mark.parametrize("seed", range(4))
def test_personal_data_against_patterns(seed):
    rng = random.Random(seed)
    parts = ["a.b@c.d", "@", "x@y", "x@y.z", ".", "+", "12", "1.2.3.4", "300.1.1.1", "+49 (0)30 123-456", "4111 1111 1111 1111",
             "4111-1111-1111-1112", " ", "-", "é", "7", "\n", "https://u:p@h.org/x", "IBAN DE89370400440532013000", "1.2.3.4.5.6.7.8"]
    digits = lambda t: re.sub(r"[^0-9]", "", t)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda t: 13 <= len(digits(t)) <= 19 and _luhn(digits(t))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
    }
    for _ in range(1_500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        spans = personal.find_spans(text)
        for kind, (pattern, valid) in kinds.items():
            assert spans[kind] == [m.span() for m in re.finditer(pattern, text) if valid(m[0])], (kind, text)


def test_personal_data_of_documents(docs, rows):
    found = by_id(personal.find_personal_data(docs))
    assert len(found) == len(rows) and found[0]["spans"] == ""
    assert found[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert personal.masked("mail a.b@c.de or +49 30 1234567 x") == "mail <EMAIL> or <PHONE> x"


def test_license_phrases_and_notices(spark, docs, rows):
    found = by_id(licenses.scan_licenses(docs))
    assert len(found) == len(rows)
    r = found[8]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (3, 0, 6, "mit")
    texts = [t or "" for _, t in rows]
    for name, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for n in [phrase.split()]
                  for i in range(len(words)) if words[i : i + len(n)] == n]
        r = found[name]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), ",".join(sorted({x for _, x in places})))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
    assert any(texts)


def _best_blocks(words, notices):
    """The best containment of each notice over every block of its width."""
    best = {}
    for label, text in notices.items():
        wanted, width = set(text.split()), licenses.block_words(len(text.split()))
        best[label] = max((len(set(words[i : i + width]) & wanted) / len(wanted) for i in range(max(1, len(words)))), default=0)
    return best


def test_notices_are_found_wherever_they_lie(spark):
    rng = random.Random(9)
    notices = {**licenses.NOTICES, "notice-long": " ".join(f"w{i}" for i in range(90))}
    bsd, mit = notices["notice-bsd"].split(), notices["notice-mit"].split()
    cases = [["x"] * offset + bsd for offset in range(0, 130, 7)]
    cases += [["x"] * offset + [w for k, w in enumerate(mit) for w in ([w, "line"] if k % 4 == 0 else [w])] for offset in (0, 16, 33)]
    cases += [[f"w{i}" for i in range(90)], [f"w{i}" for i in range(0, 90, 2)], bsd[::-1], bsd[:5], bsd * 3, [], ["the"] * 500]
    pool = sorted({w for t in notices.values() for w in t.split()}) + ["x"] * 30
    cases += [[rng.choice(pool) for _ in range(rng.randint(0, 300))] for _ in range(40)]
    for _ in range(40):
        base = rng.choice(list(notices.values())).split()
        cases.append(["y"] * rng.randint(0, 90) + [w for w in base for w in ([w] if rng.random() < 0.85 else ["z"])] + ["y"] * 5)
    df = spark.createDataFrame([(i, " ".join(c), "n") for i, c in enumerate(cases)], "doc_id long, text string, label string")
    scanned = by_id(licenses.scan_licenses(df, notices=notices))
    hits = 0
    for name, words in enumerate(cases):
        best = {k: v for k, v in _best_blocks(words, notices).items() if v >= 0.8}
        got = {}
        for m in scanned[name]["matches"]:
            got[m["label"]] = max(m["containment"], got.get(m["label"], 0))
        assert got == pytest.approx(best), (name, words[:80])
        hits += len(best)
    assert hits > 60
    with pytest.raises(ValueError):
        licenses.scan_licenses(df, notices={"none": " "})


def test_quality_statistics_and_rules(docs, rows):
    found = by_id(quality.text_statistics(docs))
    for name, text in rows:
        text = text or ""
        words = re.findall(WORD, text)
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeat = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        r = found[name]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat),
        )
    rng = np.random.default_rng(0)
    table = {k: rng.random(900) for k in quality.FEATURES}
    bad = (table["symbol_share"] > 0.8) | (table["digit_share"] < 0.1)
    rules = quality.learn_rules(table, bad)
    held = np.any([quality._covered(r, table, 900) for r in rules], axis=0)
    assert (held == bad).mean() > 0.97
    assert quality.learn_rules({k: v[:0] for k, v in table.items()}, bad[:0]) == []


def test_two_ordered_rules_from_few_labels():
    """Two kinds of bad rows among some hundred: a rule for each, and none from labels without a pattern."""
    rng = np.random.default_rng(1)
    table = {k: rng.random(360) for k in quality.FEATURES}
    bad = (table["symbol_share"] > 0.95) | (table["upper_share"] > 0.95)
    assert 20 < bad.sum() < 50
    rules = quality.learn_rules(table, bad)
    assert len(rules) >= 2 and {c.feature for r in rules for c in r} >= {"symbol_share", "upper_share"}
    held = np.any([quality._covered(r, table, 360) for r in rules], axis=0)
    assert (held & bad).sum() >= 0.9 * bad.sum() and (held & ~bad).sum() <= 3
    assert quality.learn_rules(table, rng.random(360) < 0.08) == []
    assert quality.chance_of(3, 3, 9, 118) == pytest.approx(9 * 8 * 7 / (118 * 117 * 116))


def test_verdicts_of_the_quality_query(spark):
    path = "/root/testdata/sf0.01"
    found = by_id(quality.op4_quality_rules(spark, path))
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        words = re.findall(WORD, r["text"] or "")
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeat = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        v = found[r["doc_id"]]
        assert v["base_failed"] == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert v["kept"] == (not v["base_failed"] and v["rule"] == 0)
    labels = spark.read.parquet(f"{path}/labels.parquet").collect()
    judged = [(r["quality"], found[r["doc_id"]]) for r in labels if r["doc_id"] in found and r["quality"] is not None]
    low = [v for q, v in judged if q == 0 and not v["base_failed"]]
    good = [v for q, v in judged if q == 1 and not v["base_failed"]]
    assert any(v["rule"] for v in found.values()) and sum(not v["kept"] for v in low) >= 0.8 * len(low)
    assert sum(v["kept"] for v in good) >= 0.97 * len(good)


def test_mixing_reaches_targets(docs, rows):
    found = mixing.mix_sources(docs, block=8).collect()
    assert len(found) == len(rows)
    taken, targets, largest = collections.Counter(), {}, collections.Counter()
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in found))
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1 for s in targets)
    again = sorted(map(str, mixing.mix_sources(docs, block=8).collect()))
    assert again == sorted(map(str, found))


def test_language_of_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prepared(spark)
    network = language.trained(table)
    found = language.identify(table, network).where(id_fold("doc_id", 3) == 1)
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !!"), (4, "THE AND OF " * 20)], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(odd, network).orderBy("doc_id").collect()] == ["und", "und", "und", "en"]
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    for result in (
        repeated_spans.remove_repeats(none), near_duplicates.near_duplicate_classes(none), mixing.mix_sources(none),
        language_model.score_documents(none, F.lit(True)), packing.pack_documents(none, packing.default_tokenizer()),
        personal.find_personal_data(none), licenses.scan_licenses(none), quality.text_statistics(none),
    ):
        assert result.count() == 0
    assert language.trained(none) is None


def test_packed_arrays_return():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 64, 1_000, dtype=np.uint64))
    assert (arrays.unpack_sorted(arrays.pack_sorted(values)) == values).all()
    assert len(arrays.unpack_sorted(arrays.pack_sorted(values[:0]))) == 0
