"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs, digits,
schemes and words that announce an identifier. A small parser for each kind of anchor expands
it to the left and right and validates what it found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account")

AT, PLUS, DIGIT, SCHEME, CUE = range(5)
CUES = ("iban", "account", "acct", "ssn", "passport", "konto", "compte", "cuenta")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[^\s/:@]+:[^\s/@]+@[A-Za-z0-9.-]*[A-Za-z0-9]")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9]*\Z")
_ACCOUNT = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?|#))?[ ]?[:=#]?[ ]?([A-Z]{0,2}[0-9](?:[ -]?[A-Z0-9]){4,32})(?![A-Za-z0-9])", re.A)


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    found.add_word("@", AT)
    found.add_word("+", PLUS)
    found.add_word("://", SCHEME)
    for digit in "0123456789":
        found.add_word(digit, DIGIT)
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            found.add_word(form, CUE)
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of every kind, in code points, end exclusive; each kind ascending without overlap."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    # Where the next match of a kind may begin.
    free = dict.fromkeys(KINDS, 0)

    def add(kind: str, start: int, end: int) -> None:
        spans[kind].append((start, end))

    for at, anchor in _anchors().iter(text):
        if anchor == DIGIT:
            if at >= free["card"]:
                if run := _CARD.match(text, at):
                    free["card"] = run.end()
                    digits = _digits(run[0])
                    if 13 <= len(digits) <= 19 and passes_luhn(digits):
                        add("card", at, run.end())
            if at >= free["ip"]:
                run = _NUMBERS.match(text, at)
                free["ip"] = run.end()
                parts = run[0].split(".")
                begin = at
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    size = sum(map(len, four)) + 3
                    if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in four):
                        add("ip", begin, begin + size)
                    begin += size + 1
        elif anchor == AT:
            begin = at
            while begin > free["email"] and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at and (domain := _DOMAIN.match(text, at + 1)):
                add("email", begin, domain.end())
                free["email"] = domain.end()
        elif anchor == PLUS:
            if at >= free["phone"] and (run := _PHONE.match(text, at)):
                free["phone"] = run.end()
                if 9 <= len(_digits(run[0])) <= 15:
                    add("phone", at, run.end())
        elif anchor == SCHEME:
            if (run := _LOGIN.match(text, at - 2)) and (name := _SCHEME.search(text[max(0, at - 18) : at - 2])):
                begin = at - 2 - len(name[0])
                if begin >= free["login"]:
                    add("login", begin, run.end())
                    free["login"] = run.end()
        elif run := _ACCOUNT.match(text, at + 1):
            begin, end = run.span(1)
            if begin >= free["account"] and 6 <= len(_digits(run[1])) <= 30:
                add("account", begin, end)
                free["account"] = end
    return spans


def _joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in spans[kind])


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    marks = sorted((start, -end, kind) for kind, found in find_spans(text).items() for start, end in found)
    pieces, done = [], 0
    for start, end, kind in marks:
        # A span that begins inside an earlier one only hides what that one left.
        if -end > done:
            if start >= done:
                pieces += [text[done:start], f"<{kind.upper()}>"]
            done = -end
    return "".join([*pieces, text[done:]])


def find_personal_data(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, digest and spans of personal data for each document.

    Null text counts as empty, null ids stay null, repeated rows give repeated results, other
    columns are ignored. Documents aren't shuffled.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list] = {kind: [] for kind in BASE_KINDS}
            digests, listed = [], []
            for text in batch.column(1).to_pylist():
                spans = find_spans(text or "")
                for kind in BASE_KINDS:
                    counts[kind].append(len(spans[kind]))
                digests.append(hashlib.sha256(_joined(spans, BASE_KINDS).encode()).hexdigest())
                listed.append(_joined(spans, KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS], pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"],
            )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(
        search, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def mask_personal_data(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """Replace personal data in the texts; rows, columns and null texts stay."""
    position = docs.columns.index(text_column)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else masked(t) for t in batch.column(position).to_pylist()]
            yield batch.set_column(position, text_column, pa.array(texts, batch.column(position).type))

    return docs.mapInArrow(replace, docs.schema)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))


QUERIES = {"op10_personal_data": op10_personal_data}
ORACLES: dict[str, str] = {}
