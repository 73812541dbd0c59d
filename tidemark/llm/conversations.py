"""Cheapest repair of conversations: secondary-sorted streaming with a dynamic program.

Rows are dealt by conversation and sorted by turn. A task reads them as a stream: the dynamic
program holds, for each state of the role pattern, the least cost and the rank of its audit among
the others, which Arrow batches hand on to the next. Rows and backpointers (two bytes a row) go to
memory first and to a file of the executor's local folder beyond a bound, so a conversation may be
larger than a task's memory. The file has no name and goes with the task; a lost task writes it anew.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepared

DELETE, REROLE, INSERT, LATE = 4, 3, 3, 3
WHITE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
# Bytes of rows, and of backpointers, that a task keeps in memory for one conversation.
IN_MEMORY = 4 << 20
ROWS_AT_ONCE = 500
BYTES_AT_ONCE = 1 << 20
LARGEST = (1 << 63) - 1

# States: nothing said yet, a system row, a user row, an assistant row. The pattern is
# (s?(ua)+)?, so each state but the first has one role that may follow, and the first two.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}
# A state that costs more than this over the best can't win: from any state the best edits of
# any other can be followed for 7 more at most (delete a system row, insert one row).
HOPELESS = 8


def moves(state: int, initial: str, doomed: bool, late: bool) -> list[tuple[int, int, str]]:
    """Next state, cost and audit of every way to treat a row: an insert may stand before it.

    An insert before a deletion costs the same behind it, where the audit is smaller, so
    it isn't listed.
    """
    found = [(state, DELETE, "D")]
    if not doomed:
        extra = LATE if late else 0
        for at, paid, said in ((state, extra, ""), (FOLLOWS[state], extra + INSERT, "I")):
            if (at, initial) in KEEPS:
                found.append((KEEPS[at, initial], paid, said + "K"))
            found.append((FOLLOWS[at], paid + REROLE, said + "R"))
    return found


class Program:
    """The steps of the dynamic program, each worked out once.

    A vector holds for each state its cost over the least one and the rank of its audit, or
    None. Audits of one row's states have equally many letters for rows and end with one, so
    none begins another: their order stays whatever follows, and ranks are enough.
    """

    FIRST = ((0, 0), None, None, None)

    def __init__(self) -> None:
        self.known: dict[tuple, tuple[int, tuple, int]] = {}
        self.choices: list[tuple] = []
        self.numbers: dict[tuple, int] = {}

    def step(self, vector: tuple, kind: tuple[str, bool, bool]) -> tuple[int, tuple, int]:
        """Rise of the least cost, next vector and number of the choices made."""
        known = self.known.get((vector, kind))
        if known is None:
            known = self.known[vector, kind] = self._step(vector, kind)
        return known

    def _step(self, vector: tuple, kind: tuple[str, bool, bool]) -> tuple[int, tuple, int]:
        best: dict[int, tuple[int, int, str, int]] = {}
        for state, held in enumerate(vector):
            if held is not None:
                for target, paid, said in moves(state, *kind):
                    way = (held[0] + paid, held[1], said, state)
                    best[target] = min(best.get(target, way), way)
        least = min(cost for cost, *_ in best.values())
        live = {s: way for s, way in best.items() if way[0] - least <= HOPELESS}
        order = sorted(live, key=lambda s: live[s][1:3])
        rank = {s: i for i, s in enumerate(order)}
        after = tuple((live[s][0] - least, rank[s]) if s in live else None for s in range(4))
        choice = tuple((live[s][3], live[s][2]) if s in live else None for s in range(4))
        number = self.numbers.setdefault(choice, len(self.numbers))
        if number == len(self.choices):
            self.choices.append(choice)
        return least, after, number


def _spill_folder() -> str | None:
    """Where Spark itself spills on this executor."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return folder if folder and os.path.isdir(folder) else None


class Spool:
    """Pickled blocks in order, in memory up to a bound and in an unnamed file beyond it."""

    def __init__(self, in_memory: int):
        self.file = tempfile.SpooledTemporaryFile(max_size=in_memory, dir=_spill_folder())
        self.places = array("q")

    def add(self, block: object) -> None:
        self.places.append(self.file.tell())
        pickle.dump(block, self.file, protocol=pickle.HIGHEST_PROTOCOL)

    def read(self, reverse: bool = False) -> Iterator:
        for place in reversed(self.places) if reverse else self.places:
            self.file.seek(place)
            yield pickle.load(self.file)

    def close(self) -> None:
        self.file.close()


class Conversation:
    """One conversation while its rows stream past, and its edits at the end."""

    def __init__(self, key: str, program: Program, in_memory: int):
        self.key, self.program = key, program
        self.vector, self.least = Program.FIRST, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.turns = 0
        self.before: str | None = None
        self.rows, self.back = Spool(in_memory), Spool(in_memory)
        self.block: list[tuple[str, str]] = []
        self.numbers = array("H")
        self.size = 0

    def add(self, turn: str, role: str, text: str, repeated: bool) -> None:
        if turn:
            number = int(turn)
            if self.last_turn != number:
                self.turns += 1
            if self.first_turn is None:
                self.first_turn = number
            self.last_turn = number
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        told = text.rstrip(WHITE)
        blank = not told
        late = not blank and not repeated and told[-1] not in STOPS
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += late
        kind = (initial if initial in ("s", "u", "a") else "", blank or repeated, late)
        rise, self.vector, number = self.program.step(self.vector, kind)
        self.least += rise
        self.numbers.append(number)
        self.block.append((role, text))
        self.size += len(role) + len(text) + 16
        if self.size > BYTES_AT_ONCE or len(self.block) >= 1 << 15:
            self._flush()

    def _flush(self) -> None:
        self.rows.add(self.block)
        self.back.add(self.numbers.tobytes())
        self.block, self.numbers, self.size = [], array("H"), 0

    def finish(self) -> tuple[int, list[bytes], str]:
        """Cost, the audit of every row by blocks in order, and the inserts at the end."""
        self._flush()
        ends = [(held[0] + ENDS[s][0], held[1], ENDS[s][1], s) for s, held in enumerate(self.vector) if held is not None]
        cost, _, last, state = min(ends)
        audits: list[bytes] = []
        for packed in self.back.read(reverse=True):
            numbers = array("H")
            numbers.frombytes(packed)
            said = []
            for number in reversed(numbers):
                state, letters = self.program.choices[number][state]
                said.append(letters)
            audits.append(" ".join(reversed(said)).encode())
        return self.least + cost, audits[::-1], last

    def repaired(self, audits: list[bytes], last: str) -> Iterator[tuple[str, str, str]]:
        """Letter, role and text of every row that stays or comes new."""
        state = START
        for rows, audit in zip(self.rows.read(), audits):
            for (role, text), letters in zip(rows, audit.decode().split()):
                for letter in letters:
                    if letter == "D":
                        continue
                    if letter == "K":
                        state = KEEPS[state, role[:1]]
                        yield "K", role, text
                    else:
                        state = FOLLOWS[state]
                        yield letter, NAMES[state], "" if letter == "I" else text
        for _ in last:
            state = FOLLOWS[state]
            yield "I", NAMES[state], ""

    def gaps(self) -> int:
        if self.first_turn is None or self.last_turn is None:
            return 0
        return min(self.last_turn - self.first_turn + 1 - self.turns, LARGEST)

    def close(self) -> None:
        self.rows.close()
        self.back.close()


def _streamed(batches: Iterator[pd.DataFrame], in_memory: int) -> Iterator[Conversation]:
    """The conversations of a sorted partition, whole, one after the other."""
    program, now = Program(), None
    for batch in batches:
        for key, turn, role, text, there, repeated in zip(*(batch[c].tolist() for c in _STREAM)):
            if now is None or now.key != key:
                if now is not None:
                    yield now
                    now.close()
                now = Conversation(key, program, in_memory)
            if there:
                now.add(turn, role, text, repeated)
    if now is not None:
        yield now
        now.close()


_STREAM = ("key", "turn", "role", "text", "there", "repeated")


def _sorted_rows(df: DataFrame, conversation: str, turn: str, role: str, text: str, there: Column | None) -> DataFrame:
    """Rows without nulls, dealt by conversation and sorted by turn, repeats marked."""
    name = F.col(f"`{conversation}`").cast("string")
    rows = df.select(
        F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("key"),
        F.col(f"`{turn}`").cast("long").alias("at"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.lit(True) if there is None else F.coalesce(there, F.lit(True))).alias("there"),
    )
    same = Window.partitionBy("key", "role", "text", "there").orderBy(F.col("at").asc_nulls_first())
    numbered = rows.withColumn("nth", F.row_number().over(same))
    dealt = numbered.repartition("key").sortWithinPartitions("key", F.col("at").asc_nulls_first(), "role", "text", "nth")
    return dealt.select(
        "key", F.coalesce(F.col("at").cast("string"), F.lit("")).alias("turn"), "role", "text", "there", (F.col("nth") > 1).alias("repeated")
    )


def _named(df: DataFrame, found: DataFrame, conversation: str) -> DataFrame:
    kind = df.schema[conversation].dataType
    name = F.when(F.col("key") != "", F.col("key").substr(F.lit(2), F.length("key"))).cast(kind)
    return found.select(name.alias(conversation), *[c for c in found.columns if c != "key"])


def audit_conversations(
    df: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    there: Column | None = None,
    in_memory: int = IN_MEMORY,
) -> DataFrame:
    """Faults and cheapest repair of every conversation; one row each.

    Columns: the conversation's id, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` and ``repaired_sha256`` (of the repaired ``role:text`` lines).

    Rows for which ``there`` is false don't count, but their conversation is listed. A null role or
    text counts as one space, a null turn comes first, and a null id is a conversation of its own.
    Rows of one turn are ordered by role and text; equal rows are repeats. Other columns, whatever
    their names, are ignored. An empty table gives none. Gaps beyond a long are its largest value.
    """

    def audit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        size = 0
        for c in _streamed(batches, in_memory):
            cost, audits, last = c.finish()
            digest, lines = hashlib.sha256(), 0
            for _, who, what in c.repaired(audits, last):
                digest.update(f"{chr(10) if lines else ''}{who}:{what}".encode("utf-8", "replace"))
                lines += 1
            said = "".join(a.decode().replace(" ", "") for a in audits) + last
            counts = (c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost)
            found.append((c.key, *counts, said, digest.hexdigest()))
            size += len(said)
            if len(found) >= ROWS_AT_ONCE or size > BYTES_AT_ONCE:
                yield pd.DataFrame(found, columns=_AUDIT)
                found, size = [], 0
        yield pd.DataFrame(found, columns=_AUDIT)

    schema = "key string, " + ", ".join(f"{c} long" for c in _AUDIT[1:7]) + ", audit string, repaired_sha256 string"
    return _named(df, _sorted_rows(df, conversation, turn, role, text, there).mapInPandas(audit, schema), conversation)


_AUDIT = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair_conversations(
    df: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    there: Column | None = None,
    in_memory: int = IN_MEMORY,
) -> DataFrame:
    """The repaired rows: id, ``position`` (from 0), ``edit`` (K, R or I), ``role`` and ``text``.

    Nulls, ties, repeats, other columns and empty tables as in ``audit_conversations``;
    a conversation of which nothing stays has no rows.
    """

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "position", "edit", "role", "text"]
        found: list[tuple] = []
        size = 0
        for c in _streamed(batches, in_memory):
            _, audits, last = c.finish()
            for position, (letter, who, what) in enumerate(c.repaired(audits, last)):
                found.append((c.key, position, letter, who, what))
                size += len(what)
                if len(found) >= ROWS_AT_ONCE or size > BYTES_AT_ONCE:
                    yield pd.DataFrame(found, columns=names)
                    found, size = [], 0
        yield pd.DataFrame(found, columns=names)

    schema = "key string, position long, edit string, role string, text string"
    return _named(df, _sorted_rows(df, conversation, turn, role, text, there).mapInPandas(repair, schema), conversation)


def damage(df: DataFrame) -> DataFrame:
    """Conversations with known faults, drawn by a checksum of id and turn; ``there`` is false for rows that are dropped."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fate = F.col("fate")
    rows = df.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), space).alias(c) for c in ("role", "text")],
        F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("fate"),
    )
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (fate != 0).alias("there"),
        F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return changed.drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage, then audit, every conversation of the table."""
    prepared(spark)
    return audit_conversations(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), there=F.col("there"))


# The checksum byte by byte, then the cheapest edits by a recursion over rows and states.
_SQL = r"""
with recursive bits(i, v, k) as (
  select i, i, 0 from (select cast(range as bigint) as i from range(256))
  union all
  select i, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8
), tab as (
  select list(v order by i) as tab from bits where k = 8
), named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
), fated as (
  select conv_id, turn, role, text, xor(list_reduce(
         list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: cast(ascii(x) as bigint))),
         lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])), 4294967295) % 20 as fate
  from named, tab
), damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
         case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when fate = 3 then [1, 2] else [1] end) as copy
  from fated where fate <> 0
), numbered as (
  select *, row_number() over (partition by conv_id, role, text order by n) as nth from (
    select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from damaged)
), faults as (
  select conv_id, turn, role, text, n, substr(role, 1, 1) as initial,
         lead(substr(role, 1, 1)) over (partition by conv_id order by n) as following,
         case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when nth > 1 then 'duplicate'
              when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault
  from numbered
), keep(state, initial, target) as (
  values ('start', 's', 'system'), ('start', 'u', 'user'), ('system', 'u', 'user'), ('user', 'a', 'assistant'), ('assistant', 'u', 'user')
), follow(state, target) as (
  values ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')
), treat(state, initial, target, cost, letter) as (
  select state, initial, target, 0, 'K' from keep union all select state, cast(null as varchar), target, 3, 'R' from follow
), ways(state, initial, target, cost, letters, inserted) as (
  select state, cast(null as varchar), state, 4, 'D', cast(null as varchar) from follow
  union all select state, initial, target, cost, letter, null from treat
  union all select f.state, t.initial, t.target, t.cost + 3, 'I' || t.letter, f.target
  from follow f join treat t on t.state = f.target
), reach(conv_id, n, state, best) as (
  select distinct conv_id, cast(0 as bigint), 'start', {'cost': 0, 'audit': '', 'said': cast([] as varchar[])} from conversations
  union all
  select r.conv_id, r.n + 1, w.target, min({
         'cost': r.best.cost + w.cost + case when w.letters <> 'D' and f.fault = 'truncated' then 3 else 0 end,
         'audit': r.best.audit || w.letters,
         'said': r.best.said || case when w.inserted is null then cast([] as varchar[]) else [w.inserted || ':'] end
                 || case when w.letters = 'D' then cast([] as varchar[])
                         when w.letters in ('K', 'IK') then [f.role || ':' || f.text] else [w.target || ':' || f.text] end})
  from reach r join faults f on f.conv_id is not distinct from r.conv_id and f.n = r.n + 1
  join ways w on w.state = r.state and (w.initial is null or w.initial = f.initial)
       and (w.letters = 'D' or f.fault not in ('blank', 'duplicate'))
  group by r.conv_id, r.n, w.target
), rows_of as (
  select conv_id, count(*) as n, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (following is not null and initial || following not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id
), ended as (
  select r.conv_id, r.n, min({
         'cost': r.best.cost + case r.state when 'user' then 3 when 'system' then 6 else 0 end,
         'audit': r.best.audit || case r.state when 'user' then 'I' when 'system' then 'II' else '' end,
         'said': r.best.said || case r.state when 'user' then ['assistant:'] when 'system' then ['user:', 'assistant:']
                 else cast([] as varchar[]) end}) as best
  from reach r group by r.conv_id, r.n
)
select e.conv_id, cast(coalesce(o.gaps, 0) as bigint) as gaps, cast(coalesce(o.blank, 0) as bigint) as blank,
       cast(coalesce(o.duplicate, 0) as bigint) as duplicate, cast(coalesce(o.truncated, 0) as bigint) as truncated,
       cast(coalesce(o.illegal, 0) as bigint) as illegal, cast(e.best.cost as bigint) as cost, e.best.audit as audit,
       sha256(array_to_string(e.best.said, chr(10))) as repaired_sha256
from ended e left join rows_of o on o.conv_id is not distinct from e.conv_id
where e.n = coalesce(o.n, 0)
"""

QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLES = {"op13_conversation_repair": _SQL}
