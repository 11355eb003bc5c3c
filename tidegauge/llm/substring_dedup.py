"""Substring deduplication by sliding sentence spans.

Texts are read as sentences: stretches up to a mark that ends a sentence or clause, or a newline; long stretches are cut
further after the word of least hash in every WINDOW words in a row, so that a passage is cut alike wherever it stands and
no piece is long in any language. Every run of ``span``
consecutive sentences is hashed. The runs of all documents meet by hash; a run that an earlier document has, or the same
document at an earlier place, is repeated, and sentences that a repeated run covers are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import Bloom, Remembered, claim, materialize, settle

SPAN = 4
#: Runs of fewer words are no evidence of copying; they take in further sentences.
MIN_WORDS = 20
#: A sentence of more words is cut after chosen words: the one of least hash in each WINDOW words in a row. Any passage of
#: 51 words then has SPAN whole pieces that are cut alike in all its copies, however its words and marks fall.
LONG, WINDOW = 10, 6
#: Characters of text whose runs are computed together.
TOGETHER = 1_000_000
#: One word and the white space after it; the first has the white space before it too.
WORD = re.compile(r"\s*\S+\s*")
NONE = np.zeros(0, np.int64)
MARKS = frozenset(".!?,;:")
REMEMBERED = 150_000


def _word(word: str) -> int:
    """The hash of the word without its white space; its last bit says whether a sentence or clause ends after it."""
    body = word.rstrip()
    space = word[len(body) :]
    ends = "\n" in space or (space != "" and body[-1:] in MARKS)
    return xxhash.xxh3_64_intdigest(body.lstrip()) & ~1 | ends


_WORDS = Remembered(_word, REMEMBERED)


def _rolling(f: np.ufunc, x: np.ndarray, n: int) -> np.ndarray:
    """f over each n values in a row."""
    out = x[: len(x) - n + 1].copy()
    for k in range(1, n):
        f(out, x[k : k + len(out)], out=out)
    return out


def _ends(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a sentence ends after each word of texts of so many words."""
    clause = (codes & np.uint64(1)).astype(bool)
    clause[np.cumsum(sizes)[sizes > 0] - 1] = True
    if len(codes) <= LONG:
        return clause
    length = np.diff(np.flatnonzero(clause), prepend=-1)
    of = np.repeat(np.arange(len(length)), length)
    order = codes | np.uint64(1)
    least = _rolling(np.minimum, order, WINDOW)
    least[of[WINDOW - 1 :] != of[: len(least)]] = 0  # no window reaches over the end of a clause
    chosen = _rolling(np.maximum, np.pad(least, WINDOW - 1), WINDOW) == order
    return clause | chosen & (length > LONG)[of]


_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_BACK = np.array([pow(int(b), -1, 1 << 64) for b in _BASE], np.uint64)
_TWIST = np.array([0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.ndarray, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, remembered."""
    if name not in _POWERS or len(_POWERS[name]) <= n:
        steps = np.broadcast_to(base, (2 * n + 64, 2))
        _POWERS[name] = np.cumprod(np.concatenate([np.ones((1, 2), np.uint64), steps]), axis=0, dtype=np.uint64)
    return _POWERS[name]


def _release() -> None:
    _POWERS.clear()
    _WORDS.clear()


class Pieces:
    """The sentences of several texts. Of all sentences: a hash of the words, whatever white space is between them, and
    the number of words; of each text: the number of its sentences."""

    def __init__(self, texts: list[str]):
        self.words = [WORD.findall(t) or ([t] if t else []) for t in texts]
        of_text = np.fromiter(map(len, self.words), np.int64, len(texts))
        codes = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(self.words)), np.uint64, int(of_text.sum()))
        after = np.flatnonzero(_ends(codes, of_text)) + 1
        begin = after - np.diff(after, prepend=0)
        self.n_words = after - begin
        self.base = np.concatenate([[0], np.cumsum(of_text)])
        self.stop = np.searchsorted(after, self.base[1:], "right")
        self.sizes = np.diff(self.stop, prepend=0)
        self.after = after
        # the place in the sentence twists each word's hash, so that the order counts
        place = np.arange(len(codes)) - np.repeat(begin, self.n_words)
        mixed = (codes >> np.uint64(1)) * _powers("on", _BASE, int(self.n_words.max(initial=0)))[place, 0] * _TWIST[0]
        mixed ^= mixed >> np.uint64(31)
        self.hashes = np.add.reduceat(mixed * _TWIST[1], begin) if len(begin) else mixed

    def of(self, i: int) -> list[str]:
        """The sentences of text i in order, each with the white space after it; together they are the whole text."""
        own = self.after[self.stop[i] - self.sizes[i] : self.stop[i]] - self.base[i]
        return ["".join(self.words[i][a:b]) for a, b in zip([0, *own[:-1].tolist()], own.tolist(), strict=True)] if len(own) else []


def sentences(text: str) -> list[str]:
    """The sentences in order, each with the white space after it; together they are the whole text."""
    return Pieces([text]).of(0)


class Runs:
    """Sentences of several texts and their runs. A run has ``span`` sentences, and more where those have fewer than
    ``min_words`` words; it ends within its text. Of each run: the number of its text, the places of its first and
    after its last sentence in the text, a 128-bit hash, and whether it is the first of its hash in its text.
    Sentences are compared word by word; white space alone is part of the sentence before."""

    def __init__(self, texts: list[str], span: int, min_words: int):
        self.pieces = Pieces(texts)
        hashes, words, sizes, stop = self.pieces.hashes, self.pieces.n_words, self.pieces.sizes, self.pieces.stop
        n = len(hashes)
        text = np.repeat(np.arange(len(texts)), sizes)
        before = np.concatenate([[0], np.cumsum(words)])
        start = np.arange(n)
        end = np.maximum(start + span, np.searchsorted(before, before[start] + min_words))
        fits = end <= stop[text] if n else np.zeros(0, bool)
        start, end, text = start[fits], end[fits], text[fits]
        # polynomial of the sentences' hashes over each prefix; a run's is a difference of two, moved back to power 0
        one = hashes[:, None] * _TWIST
        one ^= one >> np.uint64(31)
        power, back = _powers("on", _BASE, n), _powers("back", _BACK, n)
        total = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(one * power[:n], axis=0, dtype=np.uint64)])
        found = (total[end] - total[start]) * back[start] + (end - start).astype(np.uint64)[:, None]
        found ^= found >> np.uint64(32)
        self.hashes = (found * _TWIST).view(np.int64)
        begin = (stop - sizes)[text]
        self.text, self.start, self.end = text, start - begin, end - begin
        self.first = np.zeros(len(text), bool)
        if len(text):
            order = np.lexsort((start, self.hashes[:, 0], text))
            h, t = self.hashes[order, 0], text[order]
            self.first[order] = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])

    @property
    def sentences(self) -> list[list[str]]:
        return [self.pieces.of(i) for i in range(len(self.pieces.words))]


def _together(texts: pd.Series) -> Iterator[slice]:
    """Slices of the texts of some TOGETHER characters each."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= TOGETHER:
            yield slice(at, i + 1)
            at, size = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def spans(docs: DataFrame, span: int, min_words: int, among: Bloom | None = None) -> DataFrame:
    """doc_id, a, b: the runs of every text, once for each hash (of which 96 bits are kept) and text; only those whose ``a``
    may be ``among`` a set, if given, which is tested where the text is read."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType())])
    held = docs.sparkSession.sparkContext.broadcast(among)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("runs", _release)
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for part in _together(batch["text"]):
                own = Runs([t or "" for t in batch["text"].iloc[part]], span, min_words)
                f = own.first if held.value is None else own.first & held.value.has(own.hashes[:, 0])
                yield pd.DataFrame({"doc_id": ids[part][own.text[f]], "a": own.hashes[f, 0], "b": (own.hashes[f, 1] >> 32).astype(np.int32)})
                own = f = None
        settle()

    return docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text")).mapInPandas(emit, schema)


def remove_repeats(texts: list[str], repeated: list[np.ndarray], span: int, min_words: int) -> list[tuple[str, int, int]]:
    """Each text without the sentences of its runs whose hash is among ``repeated`` and of those that it repeats itself,
    the number of its sentences and of those removed."""
    own = Runs(texts, span, min_words)
    chosen, of = ~own.first, np.searchsorted(own.text, np.arange(len(texts) + 1))
    for i, hashes in enumerate(repeated):
        if len(hashes):
            mine = slice(of[i], of[i + 1])
            chosen[mine] |= np.isin(own.hashes[mine, 0], hashes)
    gone: dict[int, set[int]] = {}
    for text, start, end in zip(*(x[chosen].tolist() for x in (own.text, own.start, own.end)), strict=True):
        gone.setdefault(text, set()).update(range(start, end))
    out = []
    for i, text in enumerate(texts):
        removed = gone.get(i)
        if removed:
            text = "".join(x for k, x in enumerate(own.pieces.of(i)) if k not in removed)
        out.append((text, int(own.pieces.sizes[i]), len(removed or ())))
    return out


def substring_dedup(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of docs with the text without its repeated sentences, and n_sentences, n_removed.

    The first of equal runs is that of the smallest doc_id, in it the first by place. What stays keeps its white space
    and order. Null texts become empty; a text all of whose sentences are repeated becomes empty and stays as a row.
    Rows that share a doc_id count as one document: none is the other's repeat, and each loses only runs that it has
    itself. Rows without a doc_id lose only what they repeat themselves. Columns of docs named like the two counts are replaced. An empty table gives no rows.
    """
    often = spans(docs, span, min_words).groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    often = materialize(often.where("first < last").select("a", "b", "first"), "often")
    # runs without repeats aren't moved: a filter of bounded size is tested where the text is read
    found = spans(docs, span, min_words, Bloom.of(often, "a"))
    hits = found.join(often, ["a", "b"]).where("doc_id <> first").groupBy("doc_id").agg(F.collect_set("a").alias("_runs"))
    hits = materialize(hits.withColumnRenamed("doc_id", "_id"), "repeats")

    @F.pandas_udf("text string, n_sentences long, n_removed long")
    def cleaned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        claim("runs", _release)
        for texts, hashes in batches:
            rows = []
            for part in _together(texts):
                repeated = [NONE if h is None else np.asarray(h, np.int64) for h in hashes.iloc[part]]
                rows += remove_repeats([t or "" for t in texts.iloc[part]], repeated, span, min_words)
            yield pd.DataFrame(rows, columns=["text", "n_sentences", "n_removed"])
        settle()

    # columns travel by their place, so that no name of docs meets one of the operator's
    columns = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    place = {c: f"c{i}" for i, c in enumerate(columns)}
    rows = docs.select(*(F.col(f"`{c}`").alias(at) for c, at in place.items()))
    joined = rows.join(hits, F.col(place["doc_id"]) == F.col("_id"), "left")
    out = joined.withColumn("_c", cleaned(F.col(place["text"]).cast("string"), F.col("_runs")))
    kept = [F.col("_c.text").alias(c) if c == "text" else F.col(at).alias(c) for c, at in place.items()]
    return out.select(*kept, F.col("_c.n_sentences").alias("n_sentences"), F.col("_c.n_removed").alias("n_removed"))
