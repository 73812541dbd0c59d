"""Conversation repair against all edits tried out, and against SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from tidemark.llm import conversations
from tidemark.llm.common import prepared

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, key string, at string"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """All edits of a few rows, with up to two inserts in each gap."""
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None
    for letters in itertools.product("DKua", repeat=len(rows)):
        if any(x != "D" and f in ("blank", "duplicate") for x, f in zip(letters, found)):
            continue
        price = sum({"D": 4, "K": 0, "u": 3, "a": 3}[x] + (3 if x != "D" and f == "truncated" else 0) for x, f in zip(letters, found))
        if best is not None and price > best[0]:
            continue
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost = price + 3 * sum(map(len, gaps))
            if best is not None and cost > best[0]:
                continue
            audit, said = "", []
            for i, gap in enumerate(gaps):
                audit += "I" * len(gap)
                said += [(who, "") for who in gap]
                if i < len(rows):
                    audit += letters[i] if letters[i] in "DK" else "R"
                    if letters[i] != "D":
                        said.append(({"u": "user", "a": "assistant"}.get(letters[i], rows[i][0]), rows[i][1]))
            if re.fullmatch("(s?(ua)+)?", "".join((who[:1] or "?") for who, _ in said)):
                best = min(best or (cost, audit, said), (cost, audit, said))
    return best


def expected(rows):
    found = faults(rows)
    cost, audit, said = cheapest(rows, found)
    pairs = zip(rows, rows[1:])
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest()
    return (*[found.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def some_conversations(count):
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", "User", "", "uncle", None]
    texts = ["Yes.", "No!", "cut", "cut", "", " \t", None, "Ends.  ", "Zwölf?\n", "a.b"]
    for name in range(count):
        turns = sorted(rng.sample(range(-3, 9), rng.randint(1, 4)))
        yield name, [(t, rng.choice(roles), rng.choice(texts)) for t in turns]


@pytest.fixture(scope="module")
def table(spark):
    prepared(spark)
    rows = [(name, turn, role, text, "k", "x") for name, turns in some_conversations(120) for turn, role, text in turns]
    return rows


COLUMNS = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_edits_are_the_cheapest_and_the_least_of_those(spark, table):
    df = spark.createDataFrame(random.Random(1).sample(table, len(table)), SCHEMA).repartition(3)
    for bound in (conversations.IN_MEMORY, 1):
        found = {r["conv_id"]: r for r in conversations.audit_conversations(df, in_memory=bound).collect()}
        assert len(found) == 120
        for name, turns in some_conversations(120):
            rows = [(" " if role is None else role, " " if text is None else text) for _, role, text in turns]
            assert tuple(found[name][c] for c in COLUMNS) == expected(rows), rows
            at = [t for t, *_ in turns]
            assert found[name]["gaps"] == at[-1] - at[0] + 1 - len(at)


def test_repaired_rows_give_the_digest(spark, table):
    df = spark.createDataFrame(table, SCHEMA)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in conversations.audit_conversations(df).collect()}
    lines = {}
    for r in conversations.repair_conversations(df).orderBy("conv_id", "position").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["position"] == len(lines[r["conv_id"]]) - 1 and (r["edit"] != "I" or r["text"] == "")
    for name, digest in digests.items():
        assert hashlib.sha256("\n".join(lines.get(name, [])).encode()).hexdigest() == digest


def test_a_giant_conversation_spills_and_agrees(spark):
    # Many rows in many batches: 30,000 turns, with a long text among them.
    rng = random.Random(5)
    rows = [(7, t, ("user", "assistant")[(t + (rng.random() < 0.2)) % 2], f"Line {t}." if rng.random() < 0.9 else f"cut {t}", "", "") for t in range(30_000)]
    rows[15_000] = (7, 15_000, "user", "long " * 400_000 + ".", "", "")
    df = spark.createDataFrame(rows + [(8, 0, "user", "Hi.", "", "")], SCHEMA).repartition(6)
    whole = {r["conv_id"]: r for r in conversations.audit_conversations(df).collect()}
    spilled = {r["conv_id"]: r for r in conversations.audit_conversations(df, in_memory=1).collect()}
    assert whole == spilled and whole[8]["audit"] == "KI"
    audit = whole[7]["audit"]
    assert len(audit.replace("I", "")) == 30_000
    # A plain table of costs from the end gives the same cost and the least audit.
    after = {0: 0, 1: 6, 2: 3, 3: 0}
    best = []
    for _, _, role, text, _, _ in reversed(rows):
        kind = (role[0], False, text.rstrip(WHITE)[-1] not in ".!?")
        ways = {s: sorted((p + after[t], said, t) for t, p, said in conversations.moves(s, *kind)) for s in range(4)}
        best.append(ways)
        after = {s: ways[s][0][0] for s in ways}
    assert after[0] == whole[7]["cost"]
    state, said = 0, ""
    for ways in reversed(best):
        _, letters, state = min((w for w in ways[state] if w[0] == ways[state][0][0]), key=lambda w: w[1])
        said += letters
    assert audit == said + conversations.ENDS[state][1]


def test_nulls_ties_repeats_and_dropped_rows(spark):
    rows = [
        (None, 1, "user", "Hi.", "", ""), (None, None, "system", "Be good.", "", ""),
        (1, 2, "user", "b.", "", ""), (1, 2, "user", "a.", "", ""), (1, 2, "user", "a.", "", ""),
        (2, None, "user", "x.", "", ""), (2, None, None, None, "", ""), (3, 1, "user", "gone", "drop", ""),
        (4, -(1 << 63), "user", "a.", "", ""), (4, (1 << 63) - 1, "assistant", "b.", "", ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r["conv_id"]: r for r in conversations.audit_conversations(df, there=df["key"] != "drop").collect()}
    assert len(found) == 5 and found[None]["audit"] == "KKI" and found[None]["gaps"] == 0
    assert (found[1]["duplicate"], found[1]["illegal"], found[1]["audit"], found[1]["cost"]) == (1, 2, "KDR", 7)
    assert (found[2]["gaps"], found[2]["blank"], found[2]["audit"]) == (0, 1, "DKI")
    assert tuple(found[3])[1:] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert found[4]["gaps"] == (1 << 63) - 1 and found[4]["cost"] == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.audit_conversations(empty).count() == conversations.repair_conversations(empty).count() == 0


def test_other_types_of_ids(spark):
    df = spark.createDataFrame([("", 1, "user", "a."), (None, 1, "user", "a."), ("=", 1, "user", "a.")], "conv_id string, turn int, role string, text string")
    assert sorted(str(r["conv_id"]) for r in conversations.audit_conversations(df).collect()) == ["", "=", "None"]


def test_query_equals_sql_and_plain_damage(spark, table, tmp_path):
    rows = [r[:4] for r in table] + [(None, None, None, None), (None, 3, "user", "x."), (500, None, "user", "y"), (500, 1, "system", "Hm")]
    rows += [(1_000 + i, t, ("user", "assistant")[t % 2], f"No. {i} ends.") for i in range(100) for t in range(5)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    for folder in (str(tmp_path), "/root/testdata/sf0.001"):
        found = sorted(conversations.op13_conversation_repair(spark, folder).collect(), key=str)
        db = duckdb.connect()
        path = f"{folder}/conversations.parquet" + ("/*.parquet" if folder == str(tmp_path) else "")
        db.execute(f"create view conversations as select * from '{path}'")
        wanted = sorted(db.execute(conversations.ORACLES["op13_conversation_repair"]).fetchall(), key=str)
        assert sorted(map(tuple, found), key=str) == wanted and wanted
    kept = {}
    for r in conversations.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        kept.setdefault((r["conv_id"], r["turn"]), []).append(r)
    for name, turn, role, text in rows:
        key = f"{' ' if name is None else name}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        want = ("user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text, fate != 0)
        assert [tuple(r)[2:] for r in kept[name, turn]] == [want] * (2 if fate == 3 else 1)
