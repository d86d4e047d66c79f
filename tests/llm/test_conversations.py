"""Conversation repair against a plain dynamic program over whole strings."""

import hashlib
import random
import zlib
from collections import Counter
from functools import lru_cache

import helpers as H
import pytest
from pyspark.sql import functions as F

from stratafile.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def solve(rows):
    """(faults, cost, audit, repaired rows) of one conversation's rows in order, by comparing whole strings."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        words = text.strip(SPACES)
        faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "f")
        seen.add((role, text))
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def best(i, state, inserts=3):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        new = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[new]
        if inserts:
            cost, audit, out = best(i, new, inserts - 1)
            options.append((cost + 5, "I" + audit, ((name, ""), *out)))
        if i < len(rows):
            cost, audit, out = best(i + 1, state)
            options.append((cost + 2, "D" + audit, out))
            if faults[i] not in "bd":
                extra = 5 if faults[i] == "t" else 0
                cost, audit, out = best(i + 1, new)
                options.append((cost + 1 + extra, "R" + audit, ((name, rows[i][3]), *out)))
                to = moves.get((state, rows[i][2][:1]))
                if to:
                    cost, audit, out = best(i + 1, to)
                    options.append((cost + extra, "K" + audit, ((rows[i][2], rows[i][3]), *out)))
        return min(options, default=(10**9, "", ()))

    return faults, *best(0, "")


def brute(given, rows):
    out = []
    for conv_id in {r[0] for r in given}:
        own = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        faults, cost, audit, fixed = solve(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv_id, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest))
    return Counter(out)


def chats(rng, n=60, most=14):
    rows = []
    for i in range(n):
        for turn in range(rng.randrange(most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "uncle", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", "cut off too", " ", "", None, f"Number {rng.randrange(9)}.", "Ends. \n", "été\u0085."])
            rows.append((i, rng.choice([turn, turn, turn, None, turn * 3]), role, text))
    return rows


def items_of(rng, n):
    return [(rng.choice("suuaa-"), rng.choice("bdttffffff"), rng.choice([1, 1, 1, 2, 5])) for _ in range(n)]


def test_report_equals_brute_force(spark):
    rows = chats(random.Random(1))
    rows += rows[5:9] * 3 + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (None, None, None, None), (900, None, "user", "x")]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert H.counted(C.damage_report(df).collect()) == brute(rows, damage(rows))
    assert H.counted(C.repair_report(df, df).collect()) == brute(rows, [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows])


@pytest.mark.parametrize("size", [1, 2, 5])
def test_segments_and_partitions_change_nothing(spark, monkeypatch, size):
    """Conversations cut into segments of a few rows, over many partitions, give the result of whole ones."""
    rng = random.Random(size)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "cut", f"Text {rng.randrange(30)}."])) for t in range(120)]
    rows += [(8, 1, "user", "Same.")] * 40 + chats(rng, 12)
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    want = brute(rows, [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows])
    cut = C._cut
    limit = size

    def small(batches):
        C.SEGMENT_ROWS = limit  # set in the worker
        yield from cut(batches)

    monkeypatch.setattr(C, "_cut", small)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = C._walkable(df, df).where("ends is null")
        assert segments.where("conv_id = 7").count() > 12
        assert segments.where("conv_id = 7").select("part").distinct().count() > 1
        assert H.counted(C.repair_report(df, df).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_walk_is_tight_and_least_for_any_start_and_end():
    rng = random.Random(11)
    for n in (0, 1, 2, 3, 7, 30, 90):
        for _ in range(25):
            items = items_of(rng, n)
            vectors = [C.LAST]
            for item in reversed(items):
                vectors.append(C.before(item, vectors[-1]))
            rows = [(0, i, {"s": "system", "u": "user", "a": "assistant", "-": "x"}[a], {"b": " ", "d": "dup.", "t": f"t{i}", "f": f"f{i}."}[f]) for i, (a, f, _) in enumerate(items)]
            letters, state = [], C.START
            for letter, i, state in C.walk(items, C.LAST, C.START):
                letters.append(letter + "D" * (items[i][2] - 1 if i >= 0 else 0))
            letters += [x for x, _, _ in C.tail(state)]
            if n <= 30 and all(t == 1 and f != "d" for _, f, t in items):
                _, cost, audit, _ = solve(rows)
                assert ("".join(letters), vectors[-1][C.START]) == (audit, cost)
            costs = C.through(items)
            assert [min(costs[4 * s + t] + C.LAST[t] for t in range(4)) for s in range(4)] == list(vectors[-1])


def test_checkpoints_are_few(monkeypatch):
    """A walk holds about two square roots of vectors, and makes each twice."""
    made = 0
    plain = C.before

    def counting(item, after):
        nonlocal made
        made += 1
        return plain(item, after)

    monkeypatch.setattr(C, "before", counting)
    items = items_of(random.Random(2), 10_000)
    assert sum(1 for _ in C.walk(items, C.LAST, C.START)) >= 10_000
    assert made == 2 * len(items)


def test_turns_are_the_edits(spark):
    rows = chats(random.Random(6), 30) + [(50, 1, "assistant", "Cut.")] * 3
    df = spark.createDataFrame(rows, ROWS)
    report = {r.conv_id: r for r in C.repair_report(df, df).collect()}
    turns: dict = {}
    for r in sorted(C.repaired_turns(df).collect(), key=lambda r: (r.conv_id, r.place)):
        turns.setdefault(r.conv_id, []).append(r)
    for conv_id, r in report.items():
        own = turns.get(conv_id, [])
        assert "".join(t.edit for t in own) == r.audit
        fixed = [t for t in own if t.edit != "D"]
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in fixed).encode()).hexdigest() == r.repaired_sha256
        roles = "".join(t.role[0] for t in fixed).removeprefix("s")
        assert roles == "ua" * (len(roles) // 2) and (roles or not fixed)


def test_empty_and_clashing_tables(spark):
    none = spark.createDataFrame([], ROWS)
    assert C.damage_report(none).collect() == [] and C.repaired_turns(none).collect() == []
    rows = chats(random.Random(9), 9)
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit(1) for c in ("digest", "times", "part", "number", "kind", "copy", "ends")})
    assert H.counted(C.damage_report(df).collect()) == brute(rows, damage(rows))
