"""Text operators against brute force, libraries and SQL, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tests import oracle
from tidegauge.llm import entry, exact_dedup, html_text, knn_quality, line_dedup, minhash, oracles, packing, piece_codec, quality_rules, substring_dedup, url_filter
from tidegauge.llm.common import Bloom
from tidegauge.llm.components import components

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def sf_docs(spark):
    return spark.read.parquet(f"{oracle.SF}/documents.parquet")


def odd(spark):
    """Nulls, empty and long texts, repeated rows, extra columns with clashing names."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, long, "en", "a"), (5, long, None, "a"), (6, "same text here. again and again.", "en", "b"), (6, "same text here. again and again.", "en", "b"), (7, "x", "en", None)]
    schema = "doc_id long, text string, lang string, source string"
    return spark.createDataFrame(rows, schema).withColumns({"kept": F.lit("k"), "n": F.lit(1), "component_id": F.lit(2), "_t": F.lit(0), "n_removed": F.lit("z"), "piece": F.lit(9), "_id": F.lit("i"), "_runs": F.lit(1), "_c": F.lit("c"), "_gone": F.lit(0), "_row": F.lit("r"), "a.b": F.lit(3)})


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, name):
    oracle.same(spark, entry.queries()[name], oracles.SQL[name], oracle.connection())


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize(
    "run",
    [
        lambda d, s: substring_dedup.substring_dedup(d),
        lambda d, s: knn_quality.knn_quality(d, s.createDataFrame([(3, 0, 0), (4, 1, 0), (6, None, 0)], LABELS)),
        lambda d, s: piece_codec.piece_codec(d, PIECES),
        lambda d, s: minhash.near_duplicates(d, 3, 85),
        lambda d, s: quality_rules.quality_rules(d, s.createDataFrame([(3, 0, 0), (4, 1, 0)], LABELS)),
        lambda d, s: exact_dedup.exact_dedup(d),
        lambda d, s: line_dedup.line_dedup(d),
        lambda d, s: packing.pack(d, BYTES),
    ],
    ids=["substring", "knn", "codec", "minhash", "rules", "exact", "lines", "packing"],
)
def test_odd_and_empty_tables(spark, run):
    table = odd(spark)
    got = run(table, spark)
    assert got.select("doc_id").distinct().count() == 7
    assert run(table.limit(0), spark).count() == 0


# ---- exact deduplication -------------------------------------------------------------------------------------------------


def test_columns_of_any_name_keep_their_values(spark):
    frame = odd(spark)
    for out in (substring_dedup.substring_dedup(frame), exact_dedup.drop_copies(frame), minhash.drop_near_duplicates(frame)):
        rows = out.select("_id", "_runs", "_c", "_gone", "_row", "`a.b`").distinct().collect()
        assert [tuple(r) for r in rows] == [("i", 1, "c", 0, "r", 3)]


def test_fingerprints_combine(spark):
    draw = random.Random(1)
    text = "".join(draw.choice("abc ") for _ in range(300_000)).strip()
    table = docs(spark, [text, " ".join(text)])
    whole = exact_dedup.fingerprints(table, huge=1 << 30).collect()
    spread = exact_dedup.fingerprints(table, huge=1).collect()
    key = lambda rows: sorted((r["doc_id"], r["fp0"], r["fp1"], r["norm_chars"], r["text_sha256"]) for r in rows)
    assert key(whole) == key(spread) and len({(r["fp0"], r["fp1"]) for r in whole}) == 1


def test_exact_groups_survive_colliding_fingerprints(spark):
    texts = ["aa", "ab", "ba", "a b", "bb", "", " ", None, "b\na "]
    expected = {}
    for i, t in enumerate(texts):
        expected.setdefault("".join((t or "").split()), []).append(i)
    for moduli, huge in ((exact_dedup.MODULI, exact_dedup.HUGE), ((2, 3), exact_dedup.HUGE), (exact_dedup.MODULI, 0), ((2, 3), 0)):
        got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs(spark, texts), moduli, huge).collect()}
        for norm, ids in expected.items():
            keep = min(ids, key=lambda i: (-len(texts[i] or ""), i))
            for i in ids:
                assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (keep, len(ids), i == keep)
                assert got[i]["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest()


def test_drop_copies_judges_rows_not_ids(spark):
    rows = [(None, "first"), (None, "second"), (None, "second "), (None, None), (1, "third"), (1, "fourth"), (1, "fi rst"), (2, "third"), (3, "fourth "), (4, "fifth"), (4, "fif  th"), (5, ""), (None, "only")]
    table = spark.createDataFrame([(i, t, "en", f"s{k}", len(t or "")) for k, (i, t) in enumerate(rows)], SCHEMA).withColumns({"_t": F.lit(1), "kept": F.lit("k")})
    best = {}
    for i, t in rows:
        rank = (-len(t or ""), i is None, i or 0)
        norm = "".join((t or "").split())
        if norm not in best or rank < best[norm][0]:
            best[norm] = (rank, i, t)
    got = exact_dedup.drop_copies(table)
    assert got.columns == table.columns
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted(((i, t) for _, i, t in best.values()), key=key)


def test_one_row_of_each_group_is_kept(spark):
    rows = [(1, "a b"), (1, "ab"), (1, "a b"), (None, "ab"), (None, "c"), (None, "c"), (2, "d"), (2, "e")] + [(10 + i, "h") for i in range(3000)]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = exact_dedup.exact_dedup(table).collect()
    assert len(got) == len(rows)
    kept = sorted((r["text_sha256"], r["doc_id"], r["group_size"]) for r in got if r["kept"])
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert kept == sorted([(digest("ab"), 1, 4), (digest("c"), None, 2), (digest("d"), 2, 1), (digest("e"), 2, 1), (digest("h"), 10, 3000)])
    assert exact_dedup.drop_copies(table).count() == 5


def test_bloom_filter_misses_nothing(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("a"), (-F.col("id")).alias("b"))
    held = Bloom.of(keys, "a", "b")
    rows = keys.toPandas()
    assert held.has(rows["a"].to_numpy(), rows["b"].to_numpy()).all()
    assert held.has(rows["a"].to_numpy() + 1, rows["b"].to_numpy()).mean() < 0.1
    assert not Bloom.of(keys.limit(0), "a", "b").has(np.arange(9), np.arange(9)).any()


# ---- near duplicates -----------------------------------------------------------------------------------------------------


def plain_set(text, k):
    """A text's set by the contract: words between the six white spaces, A-Z lower-cased, tuples of k words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(texts, k, percent):
    """Set sizes, the smallest place that links reach, and the number of links, over all pairs."""
    sets = [plain_set(t, k) for t in texts]
    root, places, links = list(range(len(texts))), {}, 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        met = {}
        for x in a:
            for j in places.setdefault(x, []):
                met[j] = met.get(j, 0) + 1
            places[x].append(i)
        for j, n in met.items():
            if 100 * n >= percent * (len(a) + len(sets[j]) - n):
                links += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(texts))], links


def near_texts(seed, n):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(4000)}"
    bases = [[word() for _ in range(draw.randint(1, 160))] for _ in range(6)]
    out = []
    for _ in range(n):
        own = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 2, 3, 5, 9])):
            own[draw.randrange(len(own))] = word()
        out.append(" ".join(own).upper() if draw.random() < 0.2 else "  ".join(own))
    return [*out, "", None, "  ", "one", "One", "two words", "ÉTÉ à midi", "été à midi", "été\x0bÀ midi", "a\u00a0b c d", "a b c d", "A\x1cb c d"]


@pytest.mark.parametrize("block, most", [(250_000, 1024), (300, 1024), (250_000, 5)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block, most):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SETS", most)
    texts = near_texts(5, 120)
    sizes, roots, _ = brute_components(texts, 3, 85)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs(spark, texts), 3, 85).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == roots
    assert all(got[i]["kept"] == (roots[i] == i) for i in range(len(texts)))


def test_near_duplicates_equal_brute_force_on_the_table(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in sf_docs(spark).select("doc_id", "text").collect())
    sizes, roots, links = brute_components([t for _, t in rows], 3, 85)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(sf_docs(spark), 3, 85).collect()}
    assert links > 10
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i, _ in rows] == [(n, rows[r][0]) for n, r in zip(sizes, roots, strict=True)]


def test_near_duplicates_of_shared_and_missing_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a.upper()), (5, b), (7, b + " z"), (9, c), (None, c), (None, a), (11, None), (11, ""), (12, "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == sorted(
        [(1, 1, True), (5, 1, False), (5, 1, False), (7, 1, False), (9, 9, True), (0, 0, True), (0, 0, True), (11, 11, True), (11, 11, True), (12, 12, True)]
    )


def test_near_misses_give_no_links_and_bounded_cells():
    import pandas as pd

    # pairs of nine shingles with eight in common have similarity 0.8
    base = np.arange(1, 9, dtype=np.uint64)
    sets = [np.sort(np.append(base, np.uint64(1000 + i))).tobytes() for i in range(minhash.SETS)]
    cell = pd.DataFrame({"cls": range(len(sets)), "comp": range(len(sets)), "side": 2, "set": sets})
    assert minhash.cross_links(cell, 85) == []
    assert len(minhash.cross_links(cell, 80)) == len(sets) - 1  # every component is joined, by no more links than needed


def test_a_bucket_of_many_near_misses(spark):
    words = "a b c d e f g h i j".split()
    texts = [" ".join([*words, f"own{i}"]) for i in range(5000)]
    got = minhash.near_duplicates(docs(spark, texts), 3, 85)
    assert got.where("kept").count() == 5000
    assert minhash.near_duplicates(docs(spark, texts), 3, 80).select("component_id").distinct().count() == 1


def test_cross_links_find_every_component_pair():
    import pandas as pd

    texts = [t for t in near_texts(9, 60) if t and t.strip()]
    sets = [minhash.shingles(t, 3) for t in texts]
    cell = pd.DataFrame({"cls": range(len(texts)), "comp": range(len(texts)), "side": 2, "set": [s.tobytes() for s in sets]})
    links = minhash.cross_links(cell, 85)
    _, roots, _ = brute_components(texts, 3, 85)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        if minhash.linked(sets[u].tobytes(), sets[v].tobytes(), 85):
            x, y = sorted((find(u), find(v)))
            root[y] = x
    assert [find(i) for i in range(len(texts))] == roots


def test_min_max_signature_estimates():
    draw = np.random.default_rng(3)
    a = draw.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], draw.integers(0, 2**63, 200).astype(np.uint64)])
    estimate = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(estimate - 800 / 1200) < 0.12


def test_components_of_a_chain(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100


# ---- repeated passages -----------------------------------------------------------------------------------------------------


def passage(draw, n):
    out = []
    for i in range(n):
        out.append(f"v{draw.randrange(10**6)}" + (draw.choice([".", ",", ""]) if i % 4 == 3 else ""))
    return " ".join(out)


def plain_sentences(text):
    """Sentences by their definition, as lists of (word, the white space after it)."""
    tokens = re.findall(r"\s*\S+\s*", text) or ([text] if text else [])
    clauses, now = [], []
    for k, token in enumerate(tokens):
        now.append(token)
        body = token.rstrip()
        space = token[len(body) :]
        if "\n" in space or (space and body[-1:] in tuple(".!?,;:")) or k == len(tokens) - 1:
            clauses.append(now)
            now = []
    out = []
    for clause in clauses:
        rank = [xxhash.xxh3_64_intdigest(t.strip()) | 1 for t in clause]
        chosen = set()
        if len(clause) > substring_dedup.LONG:
            n = substring_dedup.WINDOW
            for at in range(len(clause) - n + 1):
                least = min(rank[at : at + n])
                chosen |= {k for k in range(at, at + n) if rank[k] == least}
        start = 0
        for k in range(len(clause)):
            if k in chosen or k == len(clause) - 1:
                out.append(clause[start : k + 1])
                start = k + 1
    return out


def brute_substring(rows, span, least):
    """(text, removed) of each (doc_id, text) by dictionaries of word tuples."""
    held, owner = [], {}
    for doc, text in rows:
        own = plain_sentences(text or "")
        words = [tuple(w.strip() for w in s) for s in own]
        runs = []
        for a in range(len(own)):
            b, n = a + span, None
            while b <= len(own) and sum(map(len, words[a:b])) < least:
                b += 1
            if b <= len(own):
                runs.append((a, b, tuple(words[a:b])))
        held.append((own, runs))
        for *_, run in runs:
            if doc is not None:
                owner[run] = min(doc, owner.get(run, doc))
    out = []
    for (doc, _), (own, runs) in zip(rows, held, strict=True):
        gone, mine = set(), set()
        for a, b, run in runs:
            if run in mine or (doc is not None and owner[run] < doc):
                gone |= set(range(a, b))
            mine.add(run)
        out.append(("".join("".join(s) for k, s in enumerate(own) if k not in gone), len(gone)))
    return out


def test_substring_equals_brute_force_and_spares_clean(spark):
    draw = random.Random(4)
    shared = passage(draw, 60)
    texts = [passage(draw, 80) for _ in range(6)]
    texts += [f"{passage(draw, 30)} {shared} {passage(draw, 30)}" for _ in range(4)] + [f"{shared}\n{shared}", None, ""]
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(docs(spark, texts)).collect()}
    expected = brute_substring(list(enumerate(texts)), substring_dedup.SPAN, substring_dedup.MIN_WORDS)
    assert [(got[i]["text"], got[i]["n_removed"]) for i in range(len(texts))] == expected
    assert all(got[i]["text"] == texts[i] for i in range(7))  # clean ones and the first copy
    for i in range(7, 10):
        left = len(got[i]["text"].split())
        assert 60 <= left <= 80  # most of the 60 shared words are gone, the 60 own ones stay


def test_substring_equals_brute_force_on_the_table(spark):
    table = sf_docs(spark)
    rows = sorted((r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect())
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in substring_dedup.substring_dedup(table).collect()}
    expected = dict(zip([r[0] for r in rows], brute_substring(rows, substring_dedup.SPAN, substring_dedup.MIN_WORDS), strict=True))
    assert got == expected and any(n for _, n in got.values())


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_that_share_an_id_lose_their_own_repeats_only(spark, kind):
    draw = random.Random(31)
    shared, a, b, c = (passage(draw, 60) for _ in range(4))
    rows = [(1, f"{shared} {a}"), (2, f"{shared} {b}"), (2, c), (2, None), (None, f"{shared} {shared}"), (3, f"{a}\n{c}")]
    table = spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = sorted(((r["doc_id"], r["text"]) for r in substring_dedup.substring_dedup(table).collect()), key=str)
    expected = brute_substring(rows, substring_dedup.SPAN, substring_dedup.MIN_WORDS)
    as_id = lambda i: None if i is None else i if kind == "long" else str(i)
    assert got == sorted(((as_id(i), t) for (i, _), (t, _) in zip(rows, expected, strict=True)), key=str)
    assert (as_id(2), c) in got


def test_sentences_are_the_whole_text():
    draw = random.Random(8)
    for _ in range(300):
        t = "".join(draw.choice("ab,. \n!?;:\t") for _ in range(draw.randint(0, 80)))
        assert "".join(substring_dedup.sentences(t)) == t


def repeated_words(a, b, n):
    """Word-level brute force: the places in b's words of the runs of n words that a has too."""
    have = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    return {k for i in range(len(b) - n + 1) if tuple(b[i : i + n]) in have for k in range(i, i + n)}


SCRIPTS = {
    "en": ("the of and to in said which would time people other", "abcdefghilmnoprstuwy"),
    "es": ("el la de que y en los se por una como", "abcdeilmnorsáéíóñ"),
    "fr": ("le la de et les des que une dans pour qui", "abceilmnoprsuéèàç"),
    "de": ("der die und in den von zu das mit sich auf", "abdeghiklmnrstuäöüß"),
    "greek": ("και το να του η της με που την", "αβγδεικλμνοπρστ"),
    "cyrillic": ("и в не на я что тот быть с", "абвгдеиклмнорст"),
    "arabic": ("في من على إلى أن هذا التي", "ابتجدرسعلمنهوي"),
    "devanagari": ("के है में की से को और", "कखगतदनपमयरलसह"),
}


@pytest.mark.parametrize("script", sorted(SCRIPTS))
@pytest.mark.parametrize("marks", [0, 0.04, 0.1, 0.3])
def test_planted_passages_are_found_in_every_script(script, marks):
    draw = random.Random(f"{script}/{marks}")
    common, letters = SCRIPTS[script]
    common = common.split()
    word = lambda: draw.choice(common) if draw.random() < 0.4 else "".join(draw.choice(letters) for _ in range(draw.randint(2, 9)))
    words = lambda n: [word() + (draw.choice(".,;") if draw.random() < marks else "") for _ in range(n)]
    for _ in range(200):
        shared = words(51)
        a, b = (words(draw.randint(5, 40)) + shared + words(draw.randint(5, 40)) for _ in range(2))
        second = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", "\u00a0"]) for w in b)
        own = substring_dedup.Runs([" ".join(a), second], substring_dedup.SPAN, substring_dedup.MIN_WORDS)
        h = own.hashes.tolist()
        first = {tuple(x) for x, t in zip(h, own.text, strict=True) if t == 0}
        runs = np.array([x[0] for x, t in zip(h, own.text, strict=True) if t == 1 and tuple(x) in first], np.int64)
        left = substring_dedup.remove_repeats([" ".join(a), second], [substring_dedup.NONE, runs], substring_dedup.SPAN, substring_dedup.MIN_WORDS)[1][0].split()
        expected = repeated_words(a, b, 51)
        assert expected
        # at least MIN_WORDS words of the passage go and none outside of it, but for what the brute force finds in shorter runs
        assert len(b) - len(left) >= substring_dedup.MIN_WORDS
        wider = repeated_words(a, b, substring_dedup.MIN_WORDS)
        assert len(b) - len(left) <= len(wider)


# ---- codec, packing ----------------------------------------------------------------------------------------------------------


def hard_texts(n):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    draw = random.Random(6)
    fixed = ["", " ", "  a", "a  b ", "\n\ta\x00b", "▁x", "​", "<s>hi</s>", "😀é﻿", "ﬁ①", "a" * 500, " " * 90 + "x", "▁▁ ▁", "日本語テスト", "\r\n\r\n  x", "the" * 200, "ééé①①é"]
    mixed = ["".join(draw.choice(" ▁abceth\n .①é日th") for _ in range(draw.randint(1, 50))) for _ in range(n)]
    pieces = ["".join(sp.id_to_piece(draw.randrange(300, 31_000)).replace("▁", " ") for _ in range(20)) for _ in range(n)]
    return fixed + mixed + pieces


def test_codec_equals_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = piece_codec.PieceCodec(PIECES)
    texts = hard_texts(400) + [r["text"] for r in sf_docs(spark).select("text").limit(60).collect()]
    for t in texts:
        expected = sp.encode(t, add_bos=True, add_eos=True)
        ids = np.frombuffer(own.encode(t), "<u4")
        assert ids.tolist() == expected, t[:80]
        assert own.decode(ids) == sp.decode(expected), t[:80]
    got = piece_codec.piece_codec(docs(spark, texts), PIECES).collect()
    for r in got:
        ids = sp.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_runs_of_spaces_go_through_the_table():
    """The pieces of space marks share one score, so their merges are told apart by place alone."""
    import sentencepiece

    sp, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), piece_codec.PieceCodec(PIECES)
    for n in [*range(1, 70), 127, 128, 129, 500]:
        for word in ("", "x", "the", "}", "日", "ပ", "\n"):
            t = " " * n + word
            assert np.frombuffer(own.encode(t), "<u4").tolist() == sp.encode(t, add_bos=True, add_eos=True), (n, word)


def test_long_merges_equal_short_ones():
    own = piece_codec.PieceCodec(PIECES)
    for t in hard_texts(200):
        if t:
            assert own._merge_long(t) == (own.merge(t) if len(t) <= 64 else own._merge_long(t))


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    table = sf_docs(spark).unionByName(docs(spark, [None, "", "a  b\n", " x", "<|endoftext|> y", "<|endoftext|>", "z" * 200_000, "é日" * 40_000, "a\x1c b\x85 c", "\u3000 a\u00a0 b"], 10**6))
    got = packing.pack(table, BYTES).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in table.select("doc_id", "text").collect()}
    found, bins = {}, {}
    for r in got:
        found.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    assert set(found) == set(texts)
    total = 0
    for doc_id, rows in found.items():
        ids = [*library.encode(texts[doc_id], add_special_tokens=False).ids, 0]
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows))) and sum(r["length"] for r in rows) == len(ids)
        assert all(r["length"] == 2048 for r in rows[1:])
        for r in rows:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
        total += len(ids)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) * 1.02 + 1


def test_packed_ids_have_the_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    draw = random.Random(14)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "a<|endoftext|>  ", "<|endoftext|", " <|endoftext|>\n<|endoftext|>y  z", "no"]
    texts += ["".join(draw.choice(["a", " ", "b ", "\n", "<|endoftext|>", "<|", "|>", "é", "\u3000", "\x1c", "'s"]) for _ in range(draw.randint(1, 30))) for _ in range(400)]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.Tokens(BYTES).encode(texts)] == ids
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    expected = [zlib.crc32(np.array([*x, 0], "<u4").tobytes()) for x in ids]
    stage = corpus_pipeline.STAGES[-1][1](spark, docs(spark, texts), str(tmp_path))
    for got in (entry.op9_packing(spark, str(tmp_path)), stage):
        assert [r["ids_crc32"] for r in got.orderBy("doc_id").collect()] == expected


def test_ranks_come_from_the_tokenizer_file(tmp_path):
    import base64
    import json

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        expected = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    assert packing.ranks_of(BYTES) == (expected, ["<|endoftext|>"]) and packing.PATTERN == P.PATTERN
    with open(BYTES, encoding="utf-8") as file:
        data = json.load(file)
    data["model"]["merges"][:2] = data["model"]["merges"][1::-1]
    (tmp_path / "swapped.json").write_text(json.dumps(data))
    with pytest.raises(ValueError):
        packing.ranks_of(str(tmp_path / "swapped.json"))


def test_packing_ids_equal_the_library_on_every_document(spark):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(BYTES), packing.Tokens(BYTES)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{oracle.SF.replace('0.001', '0.01')}/documents.parquet").select("text").collect()]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        expected = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(part, add_special_tokens=False)]
        assert own.encode(part) == expected


def test_evolution_is_never_worse_and_whole():
    draw = random.Random(2)
    size = [draw.randint(1, 2047) for _ in range(300)]
    plain = packing.best_fit(sorted(range(300), key=size.__getitem__, reverse=True), size, 2048)
    best = packing.evolve(size, 2048, [], random.Random(1))
    assert len(best.bins) <= len(plain.bins)
    assert sorted(x for b in best.bins for x in b) == list(range(300))
    assert all(sum(size[i] for i in b) == 2048 - f >= 0 for b, f in zip(best.bins, best.free, strict=True))
    a, b = plain, packing.best_fit(list(range(300)), size, 2048)
    child = packing.cross(a, b, size, 2048, random.Random(3))
    assert sorted(x for items in child.bins for x in items) == list(range(300))


# ---- quality, pages, urls, lines -----------------------------------------------------------------------------------------------


def test_classifier_held_out_accuracy(spark):
    sf = oracle.SF.replace("0.001", "0.01")
    table, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = knn_quality.knn_quality(table, labels).join(labels.groupBy("doc_id").agg(F.max("quality").alias("y")), "doc_id").where("held_out").collect()
    assert len(got) > 100
    assert np.mean([r["predicted"] == r["y"] for r in got]) >= 0.95
    for r in got[:50]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1


def test_classifier_reads_no_labels_of_held_out_rows(spark):
    table = docs(spark, ["good words all over this text"] * 30)
    labels = [(i, 1, 0) for i in range(30)]
    flipped = [(i, 0 if zlib.crc32(str(i).encode()) % 3 == 1 else 1, 0) for i in range(30)]
    a, b = (sorted(tuple(r) for r in knn_quality.knn_quality(table, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, flipped))
    assert a == b


def test_classifier_equals_a_brute_force_vote(spark):
    """Scores by cosines one pair at a time, and a sort of all of them."""
    table, labels = (spark.read.parquet(f"{oracle.SF}/{t}.parquet") for t in ("documents", "labels"))
    fitted = knn_quality.model(table, labels)
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    got = {r["doc_id"]: r["score"] for r in knn_quality.knn_quality(table, labels).collect()}
    for doc_id in sorted(texts)[:60]:
        x = knn_quality.count_vector(texts[doc_id] or "").astype(np.float64) * fitted.weight
        x = x / np.sqrt((x * x).sum())
        v = np.array([(x * fitted.projection[:, d]).sum() for d in range(fitted.projection.shape[1])])
        near = sorted(((float((v * w).sum() / np.sqrt((v * v).sum())), y) for w, y in zip(fitted.vectors.astype(np.float64), fitted.labels, strict=True)), reverse=True)
        at = near[: knn_quality.NEIGHBOURS]
        tied = [s for s, _ in near[knn_quality.NEIGHBOURS :][:1] if s > at[-1][0] - 1e-5]
        if not tied:  # equal neighbours at the border may be chosen either way
            votes = [(max(s, 1e-6) ** 4, y) for s, y in at]
            assert got[doc_id] == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=2e-3)


def test_html_field_on_unseen_layouts():
    field = html_text.trained()
    right = total = 0
    for found, labels in html_text.training_pages(150, 77):
        got = field.decode(found)
        right, total = right + sum(x == y for x, y in zip(got, labels, strict=True)), total + len(labels)
    assert right / total >= 0.98


def test_html_labels_follow_the_article_on_the_table(spark):
    """Every block of every page of the table: its label is whether an article or main is around it and nothing of
    another kind inside of that."""
    field, n, main = html_text.trained(), 0, 0
    for r in spark.read.parquet(f"{oracle.SF}/pages.parquet").collect():
        found = html_text.blocks(r["html"] or "")
        for block, label in zip(found, field.decode(found), strict=True):
            inside = bool(block.tags & {"article", "main"}) and not block.tags & {"nav", "aside", "footer", "form"} and not block.kinds & {"advert", "menu", "notice", "side", "comment"}
            assert label == inside, (r["page_id"], block.text[:80])
            n, main = n + 1, main + label
    assert n > 500 and 0.2 < main / n < 0.95


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "x" + "</div>" * 100_000,
        "<div>a" * 100_000,
        "<b>" * 50_000 + "</i>" * 50_000 + "x",
        "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000 + "x",
        "<ul>" + "<li><span>x" * 50_000,
        "".join(f"<x{i}>a</y{i}>" for i in range(50_000)),
        "<p>" + "".join(f"<q id='n{i}'>" for i in range(50_000)) + "<p>x" * 1000,
    ],
    ids=["deep", "open", "unmatched", "walled", "items", "names", "attributes"],
)
def test_deep_pages_take_linear_time(page):
    began = time.perf_counter()
    text = html_text.extract(page, html_text.trained())
    assert isinstance(text, str) and time.perf_counter() - began < 20
    assert html_text._kinds.cache_info().currsize <= 20_000


def test_html_pages(spark):
    page = (
        "<html><head><title>no</title><script>if (a<b) x('</p>')</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        "<article><h1>A  title &amp; more</h1><p>First para&shy;graph <b>bold</b>ly.<br>Second\n line.<p>Third &copy text.</article>"
        '<div class="comments"><p>I like it.</p></div><footer>&copy; us</footer>'
    )
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p"), (1, "u", page)]
    got = html_text.html_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    assert got[0]["text"] == "A title & more First para\xadgraph boldly. Second line. Third © text."
    assert got[0]["n_chars"] == len(got[0]["text"]) and [r["text"] for r in got[1:4]] == ["", "", ""] and got[4] == got[0]


def test_empty_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.html_text(none).count() == 0 and url_filter.url_filter(none, entry.URL_RULES).count() == 0


def test_viterbi_equals_enumeration():
    from itertools import product

    field = html_text.trained()
    for found, _ in html_text.training_pages(10, 5):
        found = found[:9]
        emitted = field.scores(found)
        score = lambda y: sum(emitted[i][k] for i, k in enumerate(y)) + sum(field.transition[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        best = max(product((0, 1), repeat=len(found)), key=score)
        assert score(tuple(field.decode(found))) == pytest.approx(score(best))


def test_urls_with_colliding_digests(spark):
    urls = ["http://a.b.example.org/es/x?q", "https://EXAMPLE.org/en/12", "x", None, "https://org", "https://a.com/de/", "ftp://notexample.org/es/", "https://com/fr/#x", "http://example.net/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("verdict", F.lit("?"))
    expected = ["example.org/es/", "example.org/en/1", None, None, None, "com/de/", "org/", "com/fr/", None]
    for hashed in (url_filter.digest, lambda text: len(text) % 2):
        got = {r["page_id"]: r for r in url_filter.url_filter(pages, entry.URL_RULES, hashed).collect()}
        assert [got[i]["rule"] for i in range(len(urls))] == expected
        assert [got[i]["verdict"] for i in range(3)] == ["block", "block", "allow"] and got[5]["verdict"] == "block"
    with pytest.raises(ValueError):
        url_filter.publish(spark, [("deny", "a/")])
    assert url_filter.publish(spark, entry.URL_RULES) == url_filter.publish(spark, entry.URL_RULES)
    assert len({x for x in spark.sparkContext.listFiles if "rules-" in x}) <= 2


def test_line_shares_are_relative_to_the_host(spark):
    rows = [(i, f"menu\nown {i}\n  menu ", "en", "a", 0) for i in range(10)] + [(100 + i, "menu\nother" if i == 0 else f"text {i}", "en", "b", 0) for i in range(200)]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3]["text"] == "own 3" and got[3]["n_dropped"] == 2
    assert got[100]["text"] == "menu\nother"  # 1 page in 200


def test_lines_are_joined_where_the_boilerplate_is_too_large_to_send(spark, monkeypatch):
    draw = random.Random(9)
    rows = [(i if i % 7 else None, "\n".join(draw.choice(["menu", " menu ", f"own {i}", "", "foot", f"x{draw.randrange(6)}"]) for _ in range(6)), "en", draw.choice(["a", "b", None]), 0) for i in range(300)]
    table = spark.createDataFrame([*rows, rows[0], (5, None, "en", "a", 0), (5, "menu", "en", "b", 0)], SCHEMA).withColumns({"_bad": F.lit(1), "a": F.lit(2)})
    by_broadcast = sorted(line_dedup.line_dedup(table).collect(), key=str)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    assert sorted(line_dedup.line_dedup(table).collect(), key=str) == by_broadcast
    assert 0 < sum(r["n_dropped"] for r in by_broadcast) < sum(r["n_lines"] for r in by_broadcast)


def test_allowed_failures(spark):
    from math import comb

    cases = [(n, 0.02) for n in (5, 100, 1000, 5000)]
    df = spark.createDataFrame([(n,) for n, _ in cases], "n long")
    got = {r["n"]: r["k"] for r in df.select("n", quality_rules.allowed_failures(F.col("n"), 0.02, F.lit(0.01)).alias("k")).collect()}
    for n, p in cases:
        below, k = 0.0, -1
        for i in range(n + 1):
            below += comb(n, i) * p**i * (1 - p) ** (n - i) if n <= 1000 else float(np.exp(sum(np.log(range(n - i + 1, n + 1))) - sum(np.log(range(1, i + 1))) + i * np.log(p) + (n - i) * np.log1p(-p)))
            if below > 0.01:
                break
            k = i
        assert got[n] == k, n


def test_rules_reject_rarely_and_find_junk(spark):
    draw = random.Random(3)
    good = [" ".join(f"w{draw.randrange(5000)}" for _ in range(80)) for _ in range(1500)]
    junk = [" ".join(f"w{draw.randrange(5000)}###" for _ in range(80)) for _ in range(100)]
    labels = spark.createDataFrame([(i, int(i < 1500), 0) for i in range(1600)], LABELS)
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs(spark, good + junk), labels).collect()}
    assert sum(got[i] for i in range(1500)) >= 0.98 * 1500 and not any(got[i] for i in range(1500, 1600))


# ---- pipeline ------------------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    columns = sf_docs(spark).columns
    draw = random.Random(12)
    words = [f"word{i}" for i in range(3000)]
    clean = [" ".join(draw.choice(words) + ("." if i % 9 == 8 else "") for i in range(120)) for _ in range(5)]
    near = clean[0].split()
    near[60] = "changed"
    extra = docs(spark, [*clean, clean[1] + "\n", " ".join(near)], 10**6)
    table = sf_docs(spark).unionByName(extra)
    frames = [table]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frames[-1], oracle.SF)
        assert out.columns == columns, name
        frames.append(spark.createDataFrame(out.collect(), T.StructType(frames[0].schema.fields)))
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    assert {10**6 + i for i in range(7)} <= ids[1]  # clean documents pass the classifier
    assert len({10**6 + 1, 10**6 + 5} & ids[2]) == 1
    assert len({10**6, 10**6 + 6} & ids[3]) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, frames[-1], oracle.SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids[-1]
    assert corpus_pipeline.run(spark, oracle.SF).count() > 0


def test_pipeline_equals_brute_force(spark):
    """Every stage against plain Python over what the brute force kept before it, on the whole table and some planted rows."""
    from tokenizers import Tokenizer

    draw = random.Random(21)
    words = [f"word{i}" for i in range(900)]
    clean = [" ".join(draw.choice(words) + ("." if i % 9 == 8 else "") for i in range(150)) for _ in range(6)]
    near = clean[0].split()
    near[70] = "changed"
    planted = [*clean, clean[1] + "  ", " ".join(near), f"{clean[2]} {' '.join(clean[3].split()[20:90])} {clean[4][:200]}", "", None]
    table = sf_docs(spark).unionByName(docs(spark, planted, 10**6))
    now = [(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]
    frame = table

    def run(name, frame):
        out = dict(corpus_pipeline.STAGES)[name](spark, frame, oracle.SF)
        return spark.createDataFrame(out.collect(), out.schema)

    labels = spark.read.parquet(f"{oracle.SF}/labels.parquet")
    fitted = knn_quality.model(sf_docs(spark), labels)
    scores = fitted.score(np.stack([knn_quality.count_vector(t) for _, t in now]))
    now = [x for x, s in zip(now, scores, strict=True) if s >= 0.5]
    frame = run("quality", frame)
    assert sorted((r["doc_id"], r["text"] or "") for r in frame.collect()) == sorted(now)

    best = {}
    for i, t in now:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t)
        if norm not in best or (-len(t), i) < (-len(best[norm][1]), best[norm][0]):
            best[norm] = (i, t)
    now = sorted(best.values())
    frame = run("exact_dedup", frame)
    assert sorted((r["doc_id"], r["text"] or "") for r in frame.collect()) == now

    _, roots, _ = brute_components([t for _, t in now], 5, 80)
    now = [x for k, x in enumerate(now) if roots[k] == k]
    frame = run("minhash_dedup", frame)
    assert sorted((r["doc_id"], r["text"] or "") for r in frame.collect()) == now
    ids = {i - 10**6 for i, _ in now}
    assert ids & {0, 7} == {0} and ids & {1, 6} == {6} and {2, 3, 4, 5} <= ids  # of equal texts the longer original stays

    left = brute_substring(now, substring_dedup.SPAN, substring_dedup.MIN_WORDS)
    now = [(i, t) for (i, _), (t, _) in zip(now, left, strict=True)]
    frame = run("substring_dedup", frame)
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in frame.collect()) == [(i, t, len(t)) for i, t in now]

    library = Tokenizer.from_file(BYTES)
    packed = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, frame, oracle.SF).collect():
        packed.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, t in now:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert sorted(packed[i]) == [(k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(packing.cut(len(ids), 2048))]
    assert set(packed) == {i for i, _ in now}
