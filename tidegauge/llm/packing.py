"""Best-fit packing of token sequences by a grouping genetic algorithm.

Texts are tokenised once into pieces of at most ``capacity`` tokens. Full pieces are sequences of their own. The others
are dealt evenly into shards; each shard is searched by several islands, each with a population of packings. A child
takes whole well-filled bins of one parent, keeps the other parent's bins that share no document with them, and puts
the documents that lost their bin by best fit. Between epochs the best packing of each island migrates to the next
island. After the last epoch the well-filled bins of a shard's best packing are final, and the documents of the others
of all shards are dealt into fewer shards and searched again, so that little is left unfilled at any size.
"""

from __future__ import annotations

import bisect
import json
import os
import random
import zlib
from collections.abc import Iterator
from functools import cached_property, partial
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import claim, materialize, settle

CAPACITY = 2048
END_ID = 0
#: Documents in a shard, islands of a shard, packings of an island, children an island makes in an epoch.
SHARD, ISLANDS, POPULATION, CHILDREN, EPOCHS = 2000, 2, 4, 10, 2
#: Bins with fewer free tokens are final after a round.
WELL_FILLED = 8
ROUNDS = 3
#: Stretches that are remembered, characters of the longest of them, and characters of text that are encoded together.
REMEMBERED, LONGEST, TOGETHER = 150_000, 64, 1_000_000
#: Stretches that are encoded in one text.
STRETCHES = 4_096
#: Fixed value: the pattern by which a byte-level pre-tokenizer cuts texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A white-space character beside a space.
PAIRS = tuple(x for c in map(chr, range(0x3001)) if c.isspace() for x in (c + " ", " " + c))
#: Tasks that search shards at most, for each core of the cluster.
TASKS_A_CORE = 8


def ranks_of(path: str) -> tuple[dict[bytes, int], list[str]]:
    """The tokens of a byte-level BPE tokenizer file as bytes, by id, and its added tokens. Ids have to follow the order of
    the merges, so that merging by least id is merging by the file's list, and texts have to be cut by the byte-level
    pattern as they are; else ValueError."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, cut_by = data["model"], data["pre_tokenizer"] or {}
    if data["normalizer"] is not None or cut_by.get("type") != "ByteLevel" or cut_by["add_prefix_space"] or not cut_by.get("use_regex", True):
        raise ValueError("not a plain byte-level tokenizer; texts can't be cut at spaces")
    added = [x["content"] for x in data["added_tokens"]]
    if any(" " in x for x in added):
        raise ValueError("an added token has a space inside; texts can't be cut at spaces")
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    order = [model["vocab"][a + b] for a, b in pairs]
    if model["type"] != "BPE" or order != list(range(256, 256 + len(order))) or len(model["vocab"]) != 256 + len(order):
        raise ValueError("ids don't follow the merges")
    # the byte-level form writes visible bytes as themselves and the others from 256 on, in order
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in visible]
    byte_of = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(hidden)}
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}, added


class Tokens:
    """The ids that the tokenizer library gives whole texts with a tokenizer file, remembered by the stretches between single
    spaces.

    The file's pre-tokenizer has to be byte-level without a normaliser: it cuts the text by its pattern first, and a single
    space between visible characters always starts a new cut, so the stretches can be encoded one by one. Stretches are
    encoded by a faster library from the file's own tokens and merges; texts with other white space at a space or with
    one of the file's added tokens, and long stretches, by the library itself. The tests compare all of it with the
    library on every document.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        ranks, self.added = ranks_of(path)
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced_id = np.zeros(len(ranks), bool)
        self.spaced_id[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.first: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    @cached_property
    def library(self):
        """The library's tokenizer, read when a text needs it."""
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        return Tokenizer.from_file(self.path)

    def _by_library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _odd(self, parts: set[str]) -> set[str]:
        """Parts that don't start and end in visible characters or that have an added token: their texts are encoded whole."""
        together = f" {' '.join(parts)} "
        odd = {x for x in parts if not x or x.strip() != x} if any(x in together for x in PAIRS) else set()
        for token in self.added:
            if token in together:
                odd |= {x for x in parts if token in x}
        return odd

    def _learn_first(self, parts: set[str]) -> list[str]:
        """Encode the texts' beginnings that aren't known, each by itself; the long ones are given back, to be forgotten."""
        new = parts - self.first.keys()
        long = [x for x in new if len(x) > LONGEST]
        self.first.update({x: np.array(self.fast.encode_ordinary(x), "<u4").tobytes() for x in new if len(x) <= LONGEST})
        self.first.update(zip(long, self._by_library(long), strict=True))
        return long

    def _learn_spaced(self, parts: set[str]) -> list[str]:
        """Encode the stretches that aren't known, each after a space, many in one text: a token that starts with a space is
        the first of the next stretch."""
        new, long = [], []
        for part in parts - self.spaced.keys():
            (long if len(part) > LONGEST else new).append(part)
        for at in range(0, len(new), STRETCHES):
            group = new[at : at + STRETCHES]
            ids = self.fast.encode_to_numpy(f" {' '.join(group)}", disallowed_special=()).astype("<u4")
            raw, cuts = ids.tobytes(), [*(4 * np.flatnonzero(self.spaced_id[ids])).tolist(), 4 * len(ids)]
            self.spaced.update(zip(group, (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)), strict=True))
        self.spaced.update(zip(long, self._by_library([f" {x}" for x in long]), strict=True))
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.first) + len(self.spaced) > REMEMBERED:
            self.forget()
        split = [t.split(" ") for t in texts]
        firsts, rest = {x[0] for x in split}, set(chain.from_iterable(x[1:] for x in split))
        odd_first, odd_rest = self._odd(firsts - self.first.keys()), self._odd(rest - self.spaced.keys())
        whole = {i for i, x in enumerate(split) if x[0] in odd_first or not odd_rest.isdisjoint(x[1:])} if odd_first or odd_rest else set()
        long = self._learn_first(firsts - odd_first)
        more = self._learn_spaced(rest - odd_rest)
        ids = iter(self._by_library([texts[i] for i in sorted(whole)]))
        out = [next(ids) if i in whole else self.first[x[0]] + b"".join(map(self.spaced.__getitem__, x[1:])) for i, x in enumerate(split)]
        for x in long:
            del self.first[x]
        for x in more:
            del self.spaced[x]
        return out

    def forget(self) -> None:
        self.first.clear()
        self.spaced.clear()


_TOKENS: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def _together(texts: pd.Series) -> Iterator[list[str]]:
    """The texts in order, some TOGETHER characters at a time."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= TOGETHER:
            yield part
            part, size = [], 0
    if part:
        yield part


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""

    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def cut_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        claim("tokens", _TOKENS.clear)
        own, end = tokens(tokenizer), np.array([end_id], "<u4").tobytes()
        for texts in batches:
            rows = []
            for part in _together(texts):
                for ids in own.encode(part):
                    ids += end
                    rows.append([
                        {"piece": k, "start": start, "length": n, "ids_crc32": zlib.crc32(ids[4 * start : 4 * (start + n)])}
                        for k, (start, n) in enumerate(cut(len(ids) // 4, capacity))
                    ])
            yield pd.Series(rows)
        del own
        _TOKENS.clear()
        settle()

    return docs.select("doc_id", F.explode(cut_up(F.col("text").cast("string"))).alias("_p")).select("doc_id", "_p.*")


class Packing:
    """Bins of document numbers with their free tokens."""

    def __init__(self, bins: list[list[int]], free: list[int]):
        self.bins, self.free = bins, free

    def fitness(self) -> tuple[int, float]:
        """Fewer bins, then more unequal fills."""
        return (-len(self.bins), sum(f * f for f in self.free))


def best_fit(items: list[int], size: list[int], capacity: int, bins: list[list[int]] | None = None, free: list[int] | None = None) -> Packing:
    """Put the items, in order, into the fullest bin that has room."""
    bins, free = bins or [], free or []
    order = sorted((f, k) for k, f in enumerate(free) if f)
    for item in items:
        need = size[item]
        at = bisect.bisect_left(order, (need, -1))
        if at == len(order):
            bins.append([item])
            k, left = len(free), capacity - need
            free.append(left)
        else:
            f, k = order.pop(at)
            bins[k].append(item)
            left = f - need
            free[k] = left
        if left:
            bisect.insort(order, (left, k))
    return Packing(bins, free)


def cross(a: Packing, b: Packing, size: list[int], capacity: int, draw: random.Random) -> Packing:
    """A child: some of a's best-filled bins whole, b's bins free of their documents, the rest by best fit."""
    ranked = sorted(range(len(a.bins)), key=a.free.__getitem__)
    well = ranked[: max(1, len(ranked) // 2)]
    lo = draw.randrange(len(well))
    injected = well[lo : lo + max(1, len(well) // 2)]
    taken = {x for k in injected for x in a.bins[k]}
    bins, free, displaced = [a.bins[k][:] for k in injected], [a.free[k] for k in injected], []
    # the least filled bins are dissolved too: their documents are what can still improve
    worst = set(sorted(range(len(b.bins)), key=b.free.__getitem__, reverse=True)[: max(1, len(b.bins) // 20)])
    for k, items in enumerate(b.bins):
        if k in worst or not taken.isdisjoint(items):
            displaced += [x for x in items if x not in taken]
        else:
            bins.append(items[:])
            free.append(b.free[k])
    draw.shuffle(displaced)
    displaced.sort(key=size.__getitem__, reverse=True)
    return best_fit(displaced, size, capacity, bins, free)


def evolve(size: list[int], capacity: int, starts: list[Packing], draw: random.Random) -> Packing:
    """The best packing after one epoch."""
    n = len(size)
    descending = sorted(range(n), key=size.__getitem__, reverse=True)
    people = starts[:]
    if not people:
        people.append(best_fit(descending, size, capacity))
    bound = -(-sum(size) // capacity)
    while len(people) < POPULATION:
        mixed = sorted(range(n), key=lambda i: size[i] * draw.uniform(0.8, 1.0), reverse=True)
        people.append(best_fit(mixed, size, capacity))
    people.sort(key=Packing.fitness, reverse=True)
    for _ in range(CHILDREN):
        if len(people[0].bins) == bound:
            break
        a, b = draw.sample(people, 2)
        child = cross(a, b, size, capacity, draw)
        if child.fitness() > people[-1].fitness():
            people[-1] = child
            people.sort(key=Packing.fitness, reverse=True)
    return people[0]


def _island(frame: pd.DataFrame, *, capacity: int, seed: int) -> pd.DataFrame:
    """One island's epoch. Rows: item, length and, for each packing it starts from (0: its own, 1: the migrant), the bin."""
    frame = frame.sort_values("item", kind="stable").reset_index(drop=True)
    size = frame["length"].tolist()
    starts = []
    for column in ("own", "migrant"):
        codes = frame[column]
        if codes.isna().any():
            continue
        numbers, _ = pd.factorize(codes)
        bins: list[list[int]] = [[] for _ in range(numbers.max() + 1)]
        for i, k in enumerate(numbers.tolist()):
            bins[k].append(i)
        starts.append(Packing(bins, [capacity - sum(size[i] for i in x) for x in bins]))
    shard, island = int(frame["shard"][0]), int(frame["island"][0])
    best = evolve(size, capacity, starts, random.Random(f"{seed}/{shard}/{island}"))
    bin_of, free_of = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
    for k, items in enumerate(best.bins):
        bin_of[items], free_of[items] = k, best.free[k]
    return pd.DataFrame({
        "shard": shard, "island": island, "item": frame["item"], "length": frame["length"], "bin": bin_of, "free": free_of, "n_bins": len(best.bins),
    })


OUT = "shard long, island int, item long, length long, bin long, free long, n_bins long"


def _round(items: DataFrame, n: int, capacity: int, seed: int) -> DataFrame:
    """shard, item, length, bin, free: each shard's best packing after all epochs."""
    shards = max(1, -(-n // SHARD))
    # hashing deals evenly whatever the lengths are; every item is a row of its own
    dealt = items.select(F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(shards)).alias("shard"), "item", "length")
    tasks = min(shards * ISLANDS, TASKS_A_CORE * max(8, items.sparkSession.sparkContext.defaultParallelism))
    here = dealt.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(ISLANDS)))))
    state = here.withColumn("own", F.lit(None).cast("long")).withColumn("migrant", F.lit(None).cast("long"))
    for epoch in range(EPOCHS):
        run = partial(_island, capacity=capacity, seed=seed * 100 + epoch)
        found = materialize(state.repartition(tasks, "shard", "island").groupBy("shard", "island").applyInPandas(lambda frame: run(frame), OUT), "islands")
        own = found.select("shard", "island", "item", "length", F.col("bin").alias("own"))
        moved = found.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), "item", F.col("bin").alias("migrant"))
        state = own.join(moved, ["shard", "island", "item"])
    best = found.groupBy("shard").agg(F.min_by("island", F.struct("n_bins", "island")).alias("island"))
    return found.join(best, ["shard", "island"], "left_semi").select("shard", "item", "length", "bin", "free")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A row's ids are those that the tokenizer library gives its whole text (null: empty) with the file ``tokenizer``, without
    special tokens at its ends, and then ``end_id``; rows of more than ``capacity`` ids are cut so that only the first
    piece may be shorter. Pieces of a sequence lie one after the other from offset 0. Repeated rows and ids are packed one
    by one; other columns are ignored; an empty table gives no rows.
    """
    cut_up = materialize(pieces(docs, tokenizer, capacity, end_id).withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = cut_up.where(F.col("length") == capacity).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left, base = cut_up.where(F.col("length") < capacity).select("item", "length"), 0
    for step in range(ROUNDS):
        n = left.count()
        if not n:
            break
        final = step == ROUNDS - 1 or n <= SHARD
        packed = materialize(_round(left, n, capacity, step), "packed")
        done = packed if final else packed.where(F.col("free") < WELL_FILLED)
        before = Window.partitionBy("shard", "bin").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
        # a shard has fewer than 2**20 bins, a bin at most as many rows as tokens
        rows = done.select(
            "item", (F.lit(base) + F.col("shard") * (1 << 20) + F.col("bin")).alias("sequence_id"), F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")
        )
        placed = placed.unionByName(rows)
        base += (1 << 20) * max(1, -(-n // SHARD))
        if final:
            break
        left = packed.where(F.col("free") >= WELL_FILLED).select("item", "length")
    return cut_up.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
