"""Fingerprints and their groups against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests import oracle
from tests.llm.test_text_operators import docs, odd, sf_docs
from tidegauge.llm import simhash


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for run in runs:
        h = xxhash.xxh64(run.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def plain_groups(codes, distance=2):
    """The smallest place that links within the distance reach, by all pairs."""
    x = np.array(codes, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= distance
    root = np.arange(len(x))
    while True:
        new = np.array([root[row].min() for row in near])
        if (new == root).all():
            return root
        root = new


def check(spark, rows, got):
    ids, codes = zip(*rows, strict=True)
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    roots = plain_groups([codes[i] for i in order])
    expected = {ids[i]: (f"{codes[i]:016x}", ids[order[root]]) for i, root in zip(order, roots, strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == expected


def test_query_equals_brute_force(spark):
    texts = [(r["doc_id"], plain_fingerprint(r["text"])) for r in sf_docs(spark).collect()]
    from tidegauge.llm import entry

    got = entry.op13_simhash(spark, oracle.SF).collect()
    assert len(got) == len(texts)
    check(spark, texts, got)


def test_shingle_hashes_are_those_of_the_built_in_function(spark):
    runs = ["a b c", "ä ö ü", "x"]
    built_in = [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "i int, r string").orderBy("i").select(F.xxhash64("r")).collect()]
    assert [simhash.fingerprint(r, 3) for r in runs] == [x % 2**64 for x in built_in]


def test_repeats_ties_and_long_texts():
    long = " ".join(f"w{i % 4999}" for i in range(70_000))
    for text in ("", " \n ", "One", "a b", "a B c", "a b c d", "x y z x y z x y z", " a b c", long):
        assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def clustered(seed, n):
    """Codes in groups: chains of flips of one to three bits, dense balls, lone ones, zero and all ones."""
    draw = random.Random(seed)
    found = {0, 2**64 - 1, 1 << 63}
    while len(found) < n:
        code = draw.getrandbits(64) if draw.random() < 0.7 else 0
        for _ in range(draw.choice([1, 3, 40])):
            found.add(code)
            for _ in range(draw.choice([1, 2, 2, 3])):
                code ^= 1 << draw.randrange(draw.choice([64, 8]))
    return sorted(found)


@pytest.mark.parametrize(("leaf", "group"), [(256, 16), (8, 4), (1, 1)])
def test_links_equal_all_pairs(spark, monkeypatch, leaf, group):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "GROUP", group)
    codes = clustered(leaf, 60 * leaf if leaf < 9 else 3000)
    frame = spark.createDataFrame([(c - 2**64 if c >> 63 else c,) for c in codes], "code long")
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(frame, 2).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in found)
    root = {c: c for c in codes}

    def top(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in found:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    expected = plain_groups(codes)
    assert [top(c) for c in codes] == [codes[i] for i in expected]
    assert len(found) < 40 * len(codes)


def test_a_dense_ball_gives_few_links(spark):
    """3000 codes within a few bits of each other have a million links; those that leave the tasks are few."""
    draw = random.Random(5)
    codes = {0}
    while len(codes) < 3000:
        codes.add(sum(1 << draw.randrange(40) for _ in range(3)))
    frame = spark.createDataFrame([(c,) for c in codes], "code long")
    assert simhash.links(frame, 2).count() < 60 * len(codes)


def test_gray_rank_is_the_inverse_of_the_gray_code(spark):
    ranks = [0, 1, 2, 3, 2**63 - 1, 2**63, 2**64 - 1, 123456789012345678]
    codes = [r ^ r >> 1 for r in ranks]
    frame = spark.createDataFrame([(i, c - 2**64 if c >> 63 else c) for i, c in enumerate(codes)], "i int, c long")
    got = [r[0] for r in frame.orderBy("i").select(simhash.gray_rank(F.col("c"))).collect()]
    assert got == [r - 2**63 for r in ranks]


def test_odd_and_empty_tables(spark):
    out = simhash.simhash_groups(odd(spark)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (6, 6), (7, 7)]
    assert {r["fingerprint"] for r in out if r["doc_id"] < 4} == {"0" * 16}
    assert simhash.simhash_groups(docs(spark, [])).collect() == []
    missing = spark.createDataFrame([(None, "a b c"), (None, None), (4, "a b c")], "doc_id long, text string")
    assert sorted(((r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(missing).collect()), key=str) == [(4, 4), (None, None), (None, None)]


def test_rows_of_one_id_are_one_document(spark):
    rows = spark.createDataFrame([("b", "one two three"), ("c", "four five six"), ("b", "four five six"), ("a", "one two three"), ("d", "else")], "doc_id string, text string")
    assert {(r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(rows).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")}
