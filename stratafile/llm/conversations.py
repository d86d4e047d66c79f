"""Conversation structure repair: the cheapest edits that turn a conversation's rows into a proper one.

A proper conversation is empty, or an optional system row and then pairs of user and assistant rows. Rows are taken by
their role's first letter. Edits: Keep (cost 0), Rerole to user or assistant (1), Delete (2; blank rows and repeated ones
must go), Insert an empty user or assistant row (5, anywhere); a truncated row that stays costs 5 more. Of the cheapest
edit sequences the one whose letters (D, I, K, R) come first in ASCII order is taken.

Method: dynamic programming over four states (nothing yet, after system, after user, after assistant), with vectors of the
cost from a place to the end. They are made backward and stored at checkpoints only, every square root of the rows;
walking forward, the rows of a block are gone through once more from its checkpoint, and at each place the first letter
whose edit is tight (its cost and that of its end add up to the place's own) is taken.

A conversation of any length, as Spark jobs:

1. Equal rows of a turn are one row with a number. The first turn of each text goes along as a row of its own.
2. All rows are sorted by range of (conversation, turn, role, digest of the text), so a long conversation lies in many
   partitions. Each task cuts its rows into segments of bounded size: rows, faults, counts, and, where an earlier segment
   may need it, a 4 x 4 matrix of what it costs to go through the segment from each state into each.
3. Segments' ends are the outer checkpoints. Backward over the matrices alone (no texts), a conversation's segments get
   their vectors.
4. Forward over segments in order, each is walked from its vector, with checkpoints of its own. A conversation's repaired
   text is one stream here, a segment at a time, as its digest asks for.

Order of rows: turn (null first), role, SHA-256 of the text. Defined results: null roles and texts are one space; a null
conv_id is a conversation, null turns are no turns for gaps; equal rows of a turn are repeats of each other; empty texts
are blank; a conversation without rows has zeros and an empty audit; an empty table gives none. Other columns are not
read. Memory: one segment (at most SEGMENT_ROWS rows or SEGMENT_BYTES, or one longer row) and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.llm.tables import stored
from stratafile.llm.words import rounds

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT_ROWS, SEGMENT_BYTES = 1024, 1 << 20
SPACES, STOPS = " \t\n\v\f\r", ".!?"
LEGAL = {"su", "ua", "au"}

START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a row that begins so leads to, and the state that an inserted or re-roled row leads to.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ADDED = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: From the end of all rows: a proper conversation is complete at the start and after an assistant.
LAST = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60

Vector = tuple[int, ...]
#: What the walk needs of a row: first letter of the role, fault (b, d, t or f), how often it is there.
Item = tuple[str, str, int]


def before(item: Item, after: Vector) -> Vector:
    """The costs from before a row (inserts included), given those from behind it."""
    letter, fault, times = item
    after = tuple(x + DELETE * (times - 1) for x in after)
    costs = []
    for state in range(4):
        best = after[state] + DELETE
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            if (state, letter) in KEPT:
                best = min(best, after[KEPT[state, letter]] + KEEP + extra)
            best = min(best, after[ADDED[state]] + REROLE + extra)
        costs.append(best)
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, min(costs[ASSISTANT], INSERT + costs[USER])


def through(items: list[Item]) -> list[int]:
    """Costs of going through the rows from each state (major) into each state, by rows."""
    columns = []
    for to in range(4):
        vector: Vector = tuple(0 if s == to else NEVER for s in range(4))
        for item in reversed(items):
            vector = before(item, vector)
        columns.append(vector)
    return [min(NEVER, columns[to][state]) for state in range(4) for to in range(4)]


def walk(items: list[Item], end: Vector, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, index of the row it concerns or -1, state behind) of the edits, given the vector behind the rows."""
    step = isqrt(len(items)) + 1
    checkpoints, vector = {}, end
    for i in range(len(items) - 1, -1, -1):
        if (i + 1) % step == 0:
            checkpoints[i + 1] = vector
        vector = before(items[i], vector)
    for start in range(0, len(items), step):
        stop = min(len(items), start + step)
        vectors = [checkpoints.get(stop, end)]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(before(items[i], vectors[-1]))
        for i in range(start, stop):
            letter, fault, times = items[i]
            here, after = vectors[stop - i], tuple(x + DELETE * (times - 1) for x in vectors[stop - i - 1])
            extra = TRUNCATED if fault == "t" else 0
            while True:
                if here[state] == after[state] + DELETE:
                    yield "D", i, state
                elif here[state] == here[ADDED[state]] + INSERT:
                    state = ADDED[state]
                    yield "I", -1, state
                    continue
                elif (state, letter) in KEPT and here[state] == after[KEPT[state, letter]] + KEEP + extra:
                    state = KEPT[state, letter]
                    yield "K", i, state
                else:
                    state = ADDED[state]
                    yield "R", i, state
                break


def tail(state: int) -> Iterator[tuple[str, int, int]]:
    """The inserts behind the last row."""
    while LAST[state]:
        state = ADDED[state]
        yield "I", -1, state


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the crc32 of 'conv_id:turn' asks for."""
    given = conversations.select(
        F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
        F.expr("crc32(cast(concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' ')) as binary)) % 20").alias("kind"),
    )
    kind = F.col("kind")
    return given.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _sorted_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows by range of their place, with markers (times 0: the text's first turn; -1: the conversation)."""
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    firsts = firsts.select("conv_id", "first.turn", "role", "digest", F.lit(None).cast("string").alias("text"), F.lit(0).cast("bigint").alias("times"))
    each = ids.select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"),
        F.lit(None).cast("string").alias("text"), F.lit(-1).cast("bigint").alias("times"),
    )
    place = ["conv_id", "turn", "role", "digest"]
    return rows.unionByName(firsts).unionByName(each).repartitionByRange(*place).sortWithinPartitions(*place, "times")


def fault_of(text: str, first: bool) -> str:
    words = text.strip(SPACES)
    return "b" if not words else "d" if not first else "f" if words[-1] in STOPS else "t"


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Segment:
    """Consecutive rows of one conversation within one partition."""

    def __init__(self, conv_id, number: int, continues: bool):
        self.conv_id, self.number, self.continues = conv_id, number, continues
        self.items: list[Item] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.bytes = 0

    def add(self, turn, role: str, text: str, times: int, first: bool) -> None:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "-"
        self.items.append((letter, fault_of(text, first), times))
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.bytes += len(text) + len(role)

    def full(self) -> bool:
        return len(self.items) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def row(self, part: int) -> dict:
        count = dict.fromkeys("bdtf", 0)
        illegal, letters = 0, [letter for letter, _, _ in self.items]
        for letter, fault, times in self.items:
            count[fault] += 1
            count["b" if fault == "b" else "d"] += times - 1
            illegal += (times - 1) * (letter + letter not in LEGAL)
        illegal += sum(a + b not in LEGAL for a, b in zip(letters, letters[1:], strict=False))
        known = [t for t in self.turns if t is not None]
        return {
            "conv_id": self.conv_id, "part": part, "number": self.number, "letters": "".join(letters), "faults": "".join(f for _, f, _ in self.items),
            "times": [n for _, _, n in self.items], "roles": self.roles, "texts": self.texts, "blank": count["b"], "duplicate": count["d"],
            "truncated": count["t"], "illegal": illegal, "turns": len(set(known)), "first_turn": known[0] if known else None,
            "last_turn": known[-1] if known else None, "costs": through(self.items) if self.continues else None,
        }


def _segment_fields(id_type: str) -> str:
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return f"conv_id {id_type}, part int, number bigint, letters string, faults string, times array<bigint>, roles array<string>, texts array<string>, {counts}, first_turn bigint, last_turn bigint, costs array<bigint>"


_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())
_SEGMENT_TYPES = {
    "part": pa.int32(), "number": pa.int64(), "letters": pa.string(), "faults": pa.string(), "times": _LONGS, "roles": _STRINGS, "texts": _STRINGS,
    **dict.fromkeys((*COUNTS, "first_turn", "last_turn"), pa.int64()), "costs": _LONGS,
}


def _batch(rows: list[dict], id_type: pa.DataType, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", id_type), *types.items()]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, done, size, now, marked, kind = TaskContext.get().partitionId(), [], 0, None, None, None
    for batch in rounds(batches):
        kind = batch.schema.field("conv_id").type
        for conv_id, turn, role, digest, text, times in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "text", "times")), strict=True):
            if now is None or now.conv_id != conv_id or now.full():
                same = now is not None and now.conv_id == conv_id
                if now is not None:
                    done.append(now.row(part))
                    size += now.bytes + 100 * len(now.items)
                # what comes first in a partition may go on from the one before it
                now = _Segment(conv_id, now.number + 1 if same else 0, same or now is None)
            if times > 0:
                now.add(turn, role, text, times, marked == (conv_id, turn, role, digest))
            else:
                marked = (conv_id, turn, role, digest) if times == 0 else None
            if size >= SEGMENT_BYTES or len(done) >= 1000:
                yield _batch(done, kind, _SEGMENT_TYPES)
                done, size = [], 0
    if now is not None:
        yield _batch([*done, now.row(part)], kind, _SEGMENT_TYPES)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment's vector; segments of a conversation come last first."""
    at, vector = None, LAST
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if at != (row["conv_id"],):
                at, vector = (row["conv_id"],), LAST
            out.append({"conv_id": row["conv_id"], "part": row["part"], "number": row["number"], "ends": list(vector)})
            if row["costs"] is not None:
                vector = tuple(min(a + b for a, b in zip(row["costs"][4 * s : 4 * s + 4], vector, strict=True)) for s in range(4))
        yield _batch(out, batch.schema.field("conv_id").type, {"part": pa.int32(), "number": pa.int64(), "ends": _LONGS})


def _walkable(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """Segments in the order of their conversations, each with the vector behind it in the row before."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    fields = _segment_fields(id_type)
    segments = stored(_sorted_rows(conversations, ids).mapInArrow(_cut, fields), "segments")
    light = segments.select("conv_id", "part", "number", "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("number"))
    ends = light.mapInArrow(_ends, f"conv_id {id_type}, part int, number bigint, ends array<bigint>")
    both = segments.drop("costs").unionByName(ends, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number", F.col("ends").isNull())


def _segments_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.DataType]]:
    """Segment rows, each with its vector, and the type of the ids."""
    ends = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if row["ends"] is not None:
                ends = row["ends"]
            else:
                yield {**row, "ends": tuple(ends)}, kind


def _edits(row: dict, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letters of one kind, index of the row or -1, state behind, how many) of a segment; copies of a row go at once."""
    items = list(zip(row["letters"], row["faults"], row["times"], strict=True))
    for letter, i, state in walk(items, row["ends"], state):
        yield letter, i, state, 1
        if i >= 0 and items[i][2] > 1:
            yield "D", i, state, items[i][2] - 1


class _Report:
    """One conversation's result, segment after segment."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost = conv_id, START, 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.audit: list[str] = []  # of each segment
        self.digest, self.any = hashlib.sha256(), False
        self.low = self.high = None
        self.letter = None  # of the row before

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def take(self, row: dict) -> None:
        for c in COUNTS:
            self.counts[c] += row[c]
        if row["first_turn"] is not None:
            self.counts["turns"] -= row["first_turn"] == self.high
            self.low, self.high = row["first_turn"] if self.low is None else self.low, row["last_turn"]
        if row["letters"]:
            self.counts["illegal"] += self.letter is not None and self.letter + row["letters"][0] not in LEGAL
            self.letter = row["letters"][-1]
        audit = []
        for letter, i, self.state, times in _edits(row, self.state):
            audit.append(letter * times)
            if letter == "D":
                self.cost += DELETE * times
            elif letter == "I":
                self.cost += INSERT
                self.put(ROLE[self.state], "")
            else:
                self.cost += (KEEP if letter == "K" else REROLE) + (TRUNCATED if row["faults"][i] == "t" else 0)
                self.put(row["roles"][i] if letter == "K" else ROLE[self.state], row["texts"][i])
        self.audit.append("".join(audit))

    def row(self) -> dict:
        for letter, _, self.state in tail(self.state):
            self.audit.append(letter)
            self.cost += INSERT
            self.put(ROLE[self.state], "")
        c = self.counts
        return {
            "conv_id": self.conv_id, "gaps": 0 if self.low is None else self.high - self.low + 1 - c["turns"], "blank": c["blank"],
            "duplicate": c["duplicate"], "truncated": c["truncated"], "illegal": c["illegal"], "cost": self.cost,
            "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }


_REPORT_TYPES = {**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string()}


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done, kind = None, [], None
    for row, kind in _segments_in_order(batches):
        if now is None or now.conv_id != row["conv_id"]:
            if now is not None:
                done.append(now.row())
            now = _Report(row["conv_id"])
        now.take(row)
        if len(done) >= 1000:
            yield _batch(done, kind, _REPORT_TYPES)
            done = []
    if now is not None:
        yield _batch([*done, now.row()], kind, _REPORT_TYPES)


_TURN_TYPES = {"place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}


def _turns(rows: Iterator[tuple[dict, pa.DataType]]) -> Iterator[tuple[dict, pa.DataType]]:
    """Every edit as a row."""
    at, state, place = None, START, 0

    def rest():
        for k, (_, _, behind) in enumerate(tail(state) if at else ()):
            yield {"conv_id": at[0], "place": place + k, "edit": "I", "role": ROLE[behind], "text": ""}, kind

    kind = None
    for row, kind in rows:
        if at != (row["conv_id"],):
            yield from rest()
            at, state, place = (row["conv_id"],), START, 0
        for letter, i, state, times in _edits(row, state):
            role, text = (row["roles"][i], row["texts"][i]) if i >= 0 else (None, "")
            for _ in range(times):
                yield {"conv_id": at[0], "place": place, "edit": letter, "role": ROLE[state] if letter in "IR" else role, "text": text}, kind
                place += 1
    yield from rest()


def _turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, size, kind = [], 0, None
    for row, kind in _turns(_segments_in_order(batches)):
        done.append(row)
        size += len(row["text"])
        if size >= SEGMENT_BYTES or len(done) >= 1000:
            yield _batch(done, kind, _TURN_TYPES)
            done, size = [], 0
    if done:
        yield _batch(done, kind, _TURN_TYPES)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): every edit of every conversation in order. Rows whose edit isn't D are the
    repaired conversation."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    return _walkable(conversations, conversations).mapInArrow(_turned, f"conv_id {id_type}, place bigint, edit string, role string, text string")


def repair_report(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each conv_id of ``ids``: faults of its rows in ``conversations``, cost and letters of the edits, digest of
    the repaired text."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    fields = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return _walkable(conversations, ids).mapInArrow(_reported, f"conv_id {id_type}, {fields}")


def damage_report(conversations: DataFrame) -> DataFrame:
    """The query's columns: the conversations damaged, and what it takes to repair them."""
    return repair_report(damaged(conversations), conversations)
