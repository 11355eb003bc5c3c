"""Cheapest repair of the structure of conversations: which turns to keep, rerole, delete or insert.

A conversation is right if the first letters of its roles are an optional ``s`` followed by pairs ``ua``. The cheapest
edits are a shortest path through four states (nothing yet, after a system turn, after a user's, after an assistant's),
found from the back: a vector of four costs to go is carried over the turns. What matters of a vector are only its
differences, so vectors are kept with their least cost at zero, and there are but a few of them.

Turns are dealt by range of (conversation, turn), so a task holds runs of whole conversations, and a conversation of any
size is a chunk in each of several tasks, one byte a turn. Whole ones are solved where they are. The chunks of the
others start at the same time from a speculative vector, that of a conversation that ends there. Then fix-up passes give
each chunk the vector that its right neighbour has found and run those again for which it differs by more than a
constant, until none does: over most turns two vectors soon differ by a constant only, after which nothing to the left
changes. (Turns that only ever move costs between states, such as thousands of turns of unknown roles, carry a
difference on, one chunk a pass, as the method has it.) At last each chunk tells where it leads from each state, the few
states at the joints follow, and each chunk traces its edits forward by the costs to go: of the cheapest ones the least
letter at every step, which gives the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import SPACES, materialize

#: The costs of edits, and the share of turns that ``damage`` changes in each way.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
DAMAGES = 20
#: States, and the state after a turn of the role that each expects.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
#: A turn's byte: the first letter of its role (system, user, assistant, other), 4 more if it is truncated, or GONE.
OTHER, TRUNCATED, GONE = 3, 4, 8
LEGAL = frozenset({(0, 1), (1, 2), (2, 1)})
_FAR = 1 << 40

Vector = tuple[int, int, int, int]


def closed(costs: list[int]) -> Vector:
    """Costs to go where turns may be inserted first; no more than two in a row are ever of use."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[FOLLOWS[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


#: Costs to go at a conversation's end.
END: Vector = closed([0, _FAR, _FAR, 0])


def kept_as(code: int, state: int) -> int | None:
    """The state after a turn is kept, or None where it can't be."""
    kind = code & 3
    if code == GONE or kind == OTHER:
        return None
    if kind == 0:
        return SYSTEM if state == START else None
    to = USER if kind == 1 else ASSISTANT
    return to if FOLLOWS[state] == to else None


def _choices(code: int, state: int, after: Vector) -> Iterator[tuple[str, int, int]]:
    """Letter, new state and costs to go of each edit of a turn."""
    yield "D", state, DELETE + after[state]
    if code != GONE:
        extra = CUT if code & TRUNCATED else 0
        kept = kept_as(code, state)
        if kept is not None:
            yield "K", kept, KEEP + extra + after[kept]
        yield "R", FOLLOWS[state], REROLE + extra + after[FOLLOWS[state]]


class _Steps(dict):
    """Normalised costs to go before a turn, by (costs to go after it, its byte)."""

    def __missing__(self, key: tuple[Vector, int]) -> Vector:
        after, code = key
        costs = closed([min(c for _, _, c in _choices(code, s, after)) for s in range(4)])
        self[key] = tuple(c - min(costs) for c in costs)
        return self[key]


class _Moves(dict):
    """Letters, new state and cost of a turn's edits, by (costs to go after it, its byte, state)."""

    def __missing__(self, key: tuple[Vector, int, int]) -> tuple[str, int, int]:
        after, code, state = key
        costs = closed([min(c for _, _, c in _choices(code, s, after)) for s in range(4)])
        letters, cost = "", 0
        while True:
            options = [(letter, to, c) for letter, to, c in _choices(code, state, after) if c == costs[state]]
            options += [("I", FOLLOWS[state], INSERT + costs[FOLLOWS[state]])] if INSERT + costs[FOLLOWS[state]] == costs[state] else []
            letter, to, c = min(options)
            letters += letter
            if letter != "I":
                self[key] = letters, to, cost + c - after[to]
                return self[key]
            state, cost = to, cost + INSERT


_STEPS, _MOVES = _Steps(), _Moves()


def costs_to_go(codes: bytes, end: Vector) -> list[Vector]:
    """Normalised costs to go before each turn and after the last."""
    out = [end]
    for code in reversed(codes):
        end = _STEPS[end, code]
        out.append(end)
    return out[::-1]


def trace(codes: bytes, costs: list[Vector], state: int) -> tuple[str, str, int, int]:
    """The least audit from a state, the part of it that isn't the deletion of GONE turns, the state it ends in, its cost."""
    audit, live, total = [], [], 0
    for i, code in enumerate(codes):
        letters, state, cost = _MOVES[costs[i + 1], code, state]
        audit.append(letters)
        live.append(letters[:-1] if code == GONE else letters)
        total += cost
    return "".join(audit), "".join(live), state, total


def ending(state: int) -> str:
    """The turns that are inserted at a conversation's end."""
    letters = ""
    while END[state]:
        letters, state = letters + "I", FOLLOWS[state]
    return letters


@dataclass
class Facts:
    """What is counted of a run of consecutive turns of a conversation; ``first`` and ``last`` are role letters."""

    codes: bytes
    low: int | None
    high: int | None
    turns: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: int
    last: int

    def joint(self, right: Facts) -> tuple[int, int]:
        """Illegal neighbours at the joint with the run on the right, and turns that both have."""
        return int((self.last, right.first) not in LEGAL), int(self.high is not None and self.high == right.low)

    def __add__(self, right: Facts) -> Facts:
        illegal, shared = self.joint(right)
        low, high = right.low if self.low is None else self.low, self.high if right.high is None else right.high
        sums = {f: getattr(self, f) + getattr(right, f) for f in ("codes", "turns", "blank", "duplicate", "truncated", "illegal")}
        return Facts(**sums | {"turns": sums["turns"] - shared, "illegal": sums["illegal"] + illegal, "low": low, "high": high, "first": self.first, "last": right.last})


_FACTS = "codes binary, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first int, last int"


def _facts(kind: np.ndarray, fault: np.ndarray, first: np.ndarray, times: np.ndarray, turn: np.ndarray, known: np.ndarray) -> Facts:
    """Facts of rows that stand for ``times`` equal turns each; fault is 0, 1 (blank) or 2 (truncated)."""
    sound = first & (fault != 1)
    codes = np.full(times.sum(), GONE, np.uint8)
    codes[np.cumsum(times) - times] = np.where(sound, kind + TRUNCATED * (fault == 2), GONE)
    pairs = sum((a, b) not in LEGAL for a, b in zip(kind[:-1].tolist(), kind[1:].tolist(), strict=True))
    there = turn[known]
    return Facts(
        codes.tobytes(), int(there[0]) if len(there) else None, int(there[-1]) if len(there) else None, int(len(there) > 0) + int((there[1:] != there[:-1]).sum()),
        int(times[fault == 1].sum()), int(times[fault != 1].sum() - sound.sum()), int((sound & (fault == 2)).sum()), pairs + int(times.sum()) - len(times), int(kind[0]), int(kind[-1]),
    )


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each conversation of a task; ``edge`` marks those that others may share, its first and last."""
    part, key, held, earlier = TaskContext.get().partitionId(), None, [], False

    def row(edge: bool) -> dict:
        # parts of a conversation of many batches are joined once
        total = held[0] if len(held) == 1 else _joined(held)
        return {"c": key, "part": part, "edge": edge} | {f.name: getattr(total, f.name) for f in fields(Facts)}

    def frame(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows).astype({"low": "Int64", "high": "Int64"})

    for batch in batches:
        if not len(batch):
            continue
        names = batch["c"].to_numpy()
        kind, fault, first, times = (batch[x].to_numpy() for x in ("kind", "fault", "first", "times"))
        known = batch["turn"].notna().to_numpy()
        turn = batch["turn"].fillna(0).to_numpy().astype(np.int64)
        cuts = np.concatenate([[0], np.nonzero(names[1:] != names[:-1])[0] + 1, [len(names)]])
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and names[a] != key:
                out.append(row(not earlier))
                held, earlier = [], True
            key = names[a]
            held.append(_facts(kind[a:b], fault[a:b], first[a:b], times[a:b], turn[a:b], known[a:b]))
        if out:
            yield frame(out)
    if held:
        yield frame([row(True)])


def _joined(parts: list[Facts]) -> Facts:
    codes, total = b"".join(p.codes for p in parts), None
    for p in parts:
        p.codes = b""
        total = p if total is None else total + p
    total.codes = codes
    return total


_SOLVED = "c string, part int, audit string, live string, cost long"


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits of chunks whose first state and costs to go at their end are known."""
    for batch in batches:
        rows = []
        for c, part, codes, end, state, last in zip(batch["c"], batch["part"], batch["codes"], batch["end"], batch["state"], batch["last"], strict=True):
            audit, live, state, cost = trace(codes, costs_to_go(codes, tuple(map(int, end))), state)
            tail = ending(state) if last else ""
            rows.append((c, part, audit + tail, live + tail, cost + INSERT * len(tail)))
        yield pd.DataFrame(rows, columns=["c", "part", "audit", "live", "cost"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _begins(codes: pd.Series, end: pd.Series) -> pd.Series:
    return pd.Series([list(costs_to_go(c, tuple(map(int, e)))[0]) for c, e in zip(codes, end, strict=True)])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _leads(codes: pd.Series, end: pd.Series) -> pd.Series:
    """The state at a chunk's end from each state at its start."""
    out = []
    for c, e in zip(codes, end, strict=True):
        costs = costs_to_go(c, tuple(map(int, e)))
        out.append([trace(c, costs, s)[2] for s in range(4)])
    return pd.Series(out)


def _joints(rows: pd.DataFrame) -> pd.DataFrame:
    """First state of each chunk of a conversation, and what is counted at its joint with the chunk before."""
    rows = rows.sort_values("part").reset_index(drop=True)
    state, before, out = START, None, []
    for i, r in enumerate(rows.itertuples()):
        whole = lambda x: None if pd.isna(x) else int(x)
        own = Facts(b"", whole(r.low), whole(r.high), 0, 0, 0, 0, 0, r.first, r.last)
        illegal, shared = before.joint(own) if before else (0, 0)
        out.append((r.c, r.part, state, i == len(rows) - 1, illegal, shared))
        state = int(r.leads[state])
        # a run of turns without number doesn't hide the last number, as those come first
        before = own if before is None or own.high is not None else Facts(b"", before.low, before.high, 0, 0, 0, 0, 0, before.first, own.last)
    return pd.DataFrame(out, columns=["c", "part", "state", "last", "more_illegal", "shared"])


def _end() -> Column:
    return F.array(*(F.lit(c).cast("long") for c in END))


def fixed_up(chunks: DataFrame) -> DataFrame:
    """c, part and ``end`` (the costs to go at a chunk's end, less a constant) of chunks c, part, codes.

    Every pass reruns the chunks whose right neighbour has found other differences than they had started from.
    """
    found = materialize(chunks.select("c", "part", _end().alias("end"), _begins("codes", _end()).alias("begin")), "pass")
    right = F.lead("begin").over(Window.partitionBy("c").orderBy("part"))
    while True:
        told = materialize(found.select("c", "part", "end", "begin", F.coalesce(right, _end()).alias("told")), "told")
        stale = told.where("told <> end")
        if stale.isEmpty():
            return told.select("c", "part", "end")
        rerun = stale.join(chunks.select("c", "part", "codes"), ["c", "part"]).select("c", "part", F.col("told").alias("end"), _begins("codes", "told").alias("begin"))
        found = materialize(told.where("told = end").select("c", "part", "end", "begin").unionByName(rerun), "pass")


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _clean(conversations: DataFrame) -> DataFrame:
    """c, turn, role, text, kind, fault and the text's digest of every turn."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(_key(F.col("conv_id")).alias("c"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"))
    kind = F.instr(F.lit("sua"), F.left("role", F.lit(1)))
    body = F.rtrim("text", F.lit(SPACES))
    fault = F.when(body == "", 1).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(2)
    return rows.withColumns({"kind": F.when((F.col("role") == "") | (kind == 0), OTHER).otherwise(kind - 1), "fault": fault, "d": F.unhex(F.md5("text"))})


#: Nulls come first.
_ORDER = ("c", "turn", "role", "d")


def repairs(conversations: DataFrame) -> DataFrame:
    """c and part of a piece of a conversation, its audit, ``live`` (the same without the deletions of blank and repeated turns) and cost.

    A conversation has one piece, unless it lies in several tasks. Turns are taken in the order of ``turn`` (nulls
    first), then of role and of the text's MD5, by which texts are compared.
    """
    return _repairs(conversations)[0]


def _repairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = _clean(conversations)
    # equal turns are counted first, so that no task gets all copies of one
    turns = rows.groupBy("c", "turn", "role", "d", "kind", "fault").agg(F.count("*").alias("times"))
    turns = materialize(turns, "turns")
    earliest = turns.groupBy("c", "role", "d").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("t"))
    earliest = earliest.select(F.col("c").alias("_c"), F.col("role").alias("_role"), F.col("d").alias("_d"), F.col("t.turn").alias("_turn"), F.lit(True).alias("first"))
    same = (F.col("c") == F.col("_c")) & (F.col("role") == F.col("_role")) & (F.col("d") == F.col("_d")) & F.col("turn").eqNullSafe(F.col("_turn"))
    marked = materialize(turns.join(earliest, same, "left").select("c", "turn", "role", "d", "kind", "fault", "times", F.coalesce("first", F.lit(False)).alias("first")), "marked")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = marked.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
    chunks = materialize(dealt.select("c", "turn", "kind", "fault", "times", "first").mapInPandas(_chunks, f"c string, part int, edge boolean, {_FACTS}"), "chunks")
    # a task shares its first and its last conversation at most with others
    shared = materialize(chunks.where("edge").groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c"), "shared")
    whole = chunks.join(F.broadcast(shared), "c", "left_anti")
    start = (_end().alias("end"), F.lit(START).alias("state"), F.lit(True).alias("last"))
    edits = whole.select("c", "part", "codes", *start).mapInPandas(_solved, _SOLVED)
    facts = whole.select("c", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
    if not shared.isEmpty():
        long = materialize(chunks.join(F.broadcast(shared), "c"), "long")
        ends = fixed_up(long)
        told = long.join(ends, ["c", "part"]).select("c", "part", "low", "high", "first", "last", _leads("codes", "end").alias("leads"))
        joints = told.groupBy("c").applyInPandas(_joints, "c string, part int, state int, last boolean, more_illegal long, shared long")
        joints = materialize(joints, "joints")
        pieces = long.drop("last").join(ends, ["c", "part"]).join(joints, ["c", "part"])
        edits = edits.unionByName(pieces.select("c", "part", "codes", "end", "state", "last").mapInPandas(_solved, _SOLVED))
        sums = [F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")]
        sums = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.col("turns") - F.col("shared")).alias("turns"), *sums, F.sum(F.col("illegal") + F.col("more_illegal")).alias("illegal")]
        facts = facts.unionByName(pieces.groupBy("c").agg(*sums))
    return materialize(edits, "edits"), facts


_LINE = "c string, place long, role string, text string"


def _replayed(batches: Iterator[pd.DataFrame], done: Callable[[str], object], line: Callable[[str, str], object]) -> Iterator[object]:
    """Carries out the edits of each conversation, whose live letters come before its live turns; yields what ``done`` returns."""
    key, letters, at, last = None, [], 0, ""

    def next_role() -> str:
        return "assistant" if last == "u" else "user"

    def say(role: str, text: str) -> None:
        nonlocal last
        line(role, text)
        last = role[:1]

    def inserted() -> None:
        nonlocal at
        while at < len(letters) and letters[at] == "I":
            say(next_role(), "")
            at += 1

    for batch in batches:
        for c, live, role, text in zip(batch["c"], batch["live"], batch["role"], batch["text"], strict=True):
            if c != key:
                if key is not None:
                    letters = "".join(letters)
                    inserted()
                    yield done(key)
                key, letters, at, last = c, [], 0, ""
            if live is not None:
                letters.append(live)
                continue
            if isinstance(letters, list):
                letters = "".join(letters)
            inserted()
            if letters[at] != "D":
                say(role if letters[at] == "K" else next_role(), text)
            at += 1
    if key is not None:
        letters = "".join(letters)
        inserted()
        yield done(key)


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state, empty = hashlib.sha256(), True

    def line(role: str, text: str) -> None:
        nonlocal empty
        state.update(("" if empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "replace"))
        empty = False

    def done(c: str) -> tuple[str, str]:
        nonlocal state, empty
        out, state, empty = (c, state.hexdigest()), hashlib.sha256(), True
        return out

    rows = []
    for row in _replayed(batches, done, line):
        rows.append(row)
        if len(rows) == 4096:
            yield pd.DataFrame(rows, columns=["c", "repaired_sha256"])
            rows = []
    yield pd.DataFrame(rows, columns=["c", "repaired_sha256"])


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own, out, place = [], [], 0

    def line(role: str, text: str) -> None:
        nonlocal place
        own.append((place, role, text))
        place += 1

    def flush(c: str) -> None:
        nonlocal own
        out.extend((c, *x) for x in own)
        own = []

    def done(c: str) -> None:
        nonlocal place
        flush(c)
        place = 0

    for _ in _replayed(batches, done, line):
        if len(out) >= 4096:
            yield pd.DataFrame(out, columns=["c", "place", "role", "text"])
            out.clear()
    yield pd.DataFrame(out, columns=["c", "place", "role", "text"])


def _replay(conversations: DataFrame, edits: DataFrame) -> DataFrame:
    """Each conversation's letters and then its live turns, in order, in one task; what is read of it goes by as a stream."""
    live = _clean(conversations).where("fault <> 1").groupBy("c", "role", "d").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("t"), F.first("text").alias("text"))
    live = live.select("c", F.lit(-1).alias("part"), F.col("t.turn").alias("turn"), "role", "d", F.lit(None).cast("string").alias("live"), "text")
    nothing = {x: F.lit(None).cast(kind) for x, kind in (("turn", "long"), ("role", "string"), ("d", "binary"), ("text", "string"))}
    letters = edits.select("c", "part", "live").withColumns(nothing)
    both = live.unionByName(letters).repartition("c")
    return both.sortWithinPartitions("c", F.col("live").isNull(), "part", *_ORDER[1:]).select("c", "live", "role", "text")


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id (as text, null for null), place (from 0), role and text of the turns of the repaired conversations."""
    edits, _ = _repairs(conversations)
    lines = _replay(conversations, edits).mapInPandas(_lines, _LINE)
    return lines.select(F.when(F.col("c") != "", F.substring("c", 2, 2**31 - 1)).alias("conv_id"), "place", "role", "text")


def repair(conversations: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``originals`` (conversations, if not given) lists the conv_ids that get a row; those without turns get zeros, an
    empty audit and the hash of nothing. Null roles and texts are one space, a null conv_id is a conversation, turns are
    taken by ``turn`` (nulls first; ties by role and then by the text's MD5). A turn's first fault counts: blank (white
    space only), duplicate (role and text seen earlier), truncated (the last other character isn't one of ``.!?``).
    gaps is the highest less the lowest turn plus one less the distinct turns, without nulls. illegal counts neighbours
    whose first letters of the role aren't su, ua or au. cost and audit are those of the cheapest edits (Keep, Rerole,
    Delete, Insert); of equal cost the least audit. Other columns are ignored; an empty table gives no rows.
    """
    edits, facts = _repairs(conversations)
    whole = edits.groupBy("c").agg(F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("part", "audit"))).alias("a"))
    audits = whole.select("c", "cost", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
    digests = _replay(conversations, edits).mapInPandas(_digested, "c string, repaired_sha256 string")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    named = (conversations if originals is None else originals).select("conv_id").distinct().withColumn("c", _key(F.col("conv_id")))
    out = named.join(facts, "c", "left").join(audits, "c", "left").join(digests, "c", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    nothing = F.lit(hashlib.sha256().hexdigest())
    counts = [zero(x) for x in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", gaps.alias("gaps"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults that follow from crc32(``conv_id:turn``): see the query's contract. Nulls are one space in it."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), (F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % DAMAGES).alias("_k"))
    k = F.col("_k")
    text = F.when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(k != 0).select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("_n")).drop("_n")
