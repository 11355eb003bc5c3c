"""Repairs of conversations against all edits, and against a recursion over whole suffixes."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tidegauge.llm import conversation_repair as repair
from tidegauge.llm import entry

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def faults(rows):
    """(first letter, fault) of turns in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def best_edits(turns):
    """Least (cost, audit) by recursion over whole suffixes."""
    wants = {"": "u", "s": "u", "a": "u", "u": "a"}
    end = len(turns)

    @functools.cache
    def best(i, last, inserted):
        options = []
        if i == end and last in ("", "a"):
            options.append((0, ""))
        if inserted < 3:
            c, audit = best(i, wants[last], inserted + 1)
            options.append((2 + c, "I" + audit))
        if i < end:
            letter, fault = turns[i]
            c, audit = best(i + 1, last, 0)
            options.append((3 + c, "D" + audit))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if letter == wants[last] or (letter == "s" and last == ""):
                    c, audit = best(i + 1, letter, 0)
                    options.append((more + c, "K" + audit))
                c, audit = best(i + 1, wants[last], 0)
                options.append((2 + more + c, "R" + audit))
        return min(options, default=(10**9, ""))

    sys.setrecursionlimit(20_000)
    return best(0, "", 0)


def every_edit(turns):
    """Least (cost, audit) of all edits with at most two inserts in a gap."""
    found = []
    gaps = range(3)
    for edits in itertools.product("DKR", repeat=len(turns)):
        for inserts in itertools.product(gaps, repeat=len(turns) + 1):
            roles, cost, audit, ok = "", 0, "", True
            for i, n in enumerate(inserts):
                for _ in range(n):
                    roles, cost, audit = roles + ("a" if roles[-1:] == "u" else "u"), cost + 2, audit + "I"
                if i == len(turns):
                    break
                (letter, fault), e = turns[i], edits[i]
                ok &= e == "D" or fault not in ("blank", "duplicate")
                audit += e
                if e == "D":
                    cost += 3
                    continue
                cost += fault == "truncated"
                if e == "K":
                    roles += letter or "?"
                else:
                    roles, cost = roles + ("a" if roles[-1:] == "u" else "u"), cost + 2
            if ok and re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit))
    return min(found)


def replayed(rows, audit):
    out, i = [], 0
    for e in audit:
        wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if e == "I":
            out.append((wanted, ""))
            continue
        role, text = rows[i]
        i += 1
        if e != "D":
            out.append((role if e == "K" else wanted, text))
    assert i == len(rows)
    return out


def brute(rows, originals):
    out = {}
    for conv in {r[0] for r in originals}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", hashlib.md5((" " if r[3] is None else r[3]).encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        texts = [(" " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in own]
        found = faults(texts)
        cost, audit = best_edits(tuple(found))
        count = lambda f: sum(x == f for _, x in found)  # noqa: B023, E731
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(found))
        text = "\n".join(f"{r}:{t}" for r, t in replayed(texts, audit))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def result(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    whole = [tuple(r) for r in spark.read.parquet(f"{oracle.SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(entry.op12_conversation_repair(spark, oracle.SF)) == brute(plain_damage(whole), whole)


def conversations(seed, sizes, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    draw, rows = random.Random(seed), []
    for conv, n in enumerate(sizes):
        for turn in range(n):
            role = draw.choice(roles) if draw.random() < 0.6 else ("user", "assistant")[turn % 2]
            text = draw.choice([f"t{turn}.", f"t{turn}", "same.", "", " \n", None, f"x{turn}! "])
            rows.append((conv, None if draw.random() < 0.05 else turn * draw.choice([1, 1, 2]), role, text))
    return rows


@pytest.mark.parametrize("parts", ["1", "13"])
def test_repair_equals_brute_force(spark, parts):
    """Many small conversations and two that lie in several tasks."""
    rows = conversations(3, [*[k % 7 for k in range(60)], 150, 90]) + [(None, 1, "user", "a."), (None, None, "assistant", "b")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"c": F.lit(1), "kind": F.lit("k"), "part": F.lit(0)})
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert result(repair.repair(frame)) == brute(rows, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


@pytest.mark.parametrize("roles", [("tool",), ("user",), ("assistant",), ("system",), ("user", "assistant")])
def test_one_conversation_in_every_task(spark, roles):
    """Turns that carry a difference from chunk to chunk, up to the front."""
    rows = [(1, t, roles[t % len(roles)], f"{t}.") for t in range(61)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert result(repair.repair(spark.createDataFrame(rows, SCHEMA))) == brute(rows, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_third_of_all_rows_is_one_turn(spark):
    rows = [(7, 3, "user", "again.")] * 400 + conversations(9, [5] * 30)
    assert result(repair.repair(spark.createDataFrame(rows, SCHEMA))) == brute(rows, rows)


def test_audits_are_the_least_of_all_edits():
    kinds = [(letter, fault) for letter in ("s", "u", "a", "t") for fault in ("", "truncated")] + [("u", "blank")]
    bytes_of = {k: repair.GONE if k[1] == "blank" else "suat".index(k[0]) + repair.TRUNCATED * (k[1] == "truncated") for k in kinds}
    for n in range(4):
        for turns in itertools.product(kinds, repeat=n):
            if n == 3 and hash(turns) % 7:
                continue
            codes = bytes(bytes_of[t] for t in turns)
            audit, _, state, cost = repair.trace(codes, repair.costs_to_go(codes, repair.END), repair.START)
            audit += repair.ending(state)
            assert (cost + 2 * len(repair.ending(state)), audit) == best_edits(turns)
            if n < 3:
                assert (cost + 2 * len(repair.ending(state)), audit) == every_edit(turns)


def test_vectors_are_few():
    draw = random.Random(1)
    for _ in range(300):
        repair.costs_to_go(bytes(draw.randrange(9) for _ in range(200)), repair.END)
    assert len({k[0] for k in repair._STEPS}) < 100


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "q."), (1, 2, "user", "q2."), (1, 3, "assistant", " "), (2, 0, "tool", " ")]
    got = [tuple(r) for r in repair.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "place").collect()]
    assert got == [("1", 0, "system", "s."), ("1", 1, "user", "q."), ("1", 2, "assistant", "q2.")]


def test_empty_tables_and_conversations_without_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    assert result(repair.repair(empty, spark.createDataFrame([(4, 1, None, None)], SCHEMA))) == {4: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert result(repair.repair(spark.createDataFrame([(None, None, None, None)], SCHEMA))) == {None: (0, 1, 0, 0, 0, 3, "D", nothing)}
