"""SentencePiece encoding and decoding through a table of prefixes.

A merge-type (BPE) encoding has the property that every prefix of a text has one encoding, and that the last token of
each prefix determines the whole: if ``t`` is the last token of a prefix, the encoding of that prefix without ``t`` is
the encoding of the shorter prefix. So one pass stores the last token of every prefix: an automaton gives the pieces
that end at a position, and a piece fits just when it is compatible with the last token of the prefix before it, that
is when merging the two texts from their characters gives back the same two pieces. The ids are then recovered from the
end backwards. Pieces never contain a space mark after another character, so the texts between such borders are encoded
one by one and their ids are remembered in a table of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Remembered, claim

MARK = "▁"
#: Segments and pairs of pieces remembered by each Python worker.
REMEMBERED = 400_000


class PieceCodec:
    """Encodes and decodes as the library does with the same model (identity normalisation, byte fallback)."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "  \ufb01\u2460 \uff21\u00a0x \u3000e\u0301 "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model changes texts before it encodes them")
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.bytes_at = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        pieces = {i: sp.id_to_piece(i) for i in range(n) if not special[i] and not sp.is_byte(i)}
        self.ids = {p: i for i, p in pieces.items()}
        self.packed = {p: struct.pack("<I", i) for p, i in self.ids.items()}
        self.costs = {p: -sp.get_score(i) for p, i in self.ids.items()}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a space mark inside; texts can't be cut at spaces")
        if len(self.bytes_at) != 256:
            raise ValueError("the model has no byte fallback")
        self.longest = max(map(len, self.ids))
        self.single = {p for p in self.ids if len(p) == 1}
        self.side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.raw = [b"" if special[i] else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.starts_with_mark = [sp.id_to_piece(i).startswith(MARK) for i in range(n)]
        self.automaton = self._automaton()
        self.known = Remembered(self.segment, REMEMBERED)
        self.worded = Remembered(lambda word: self.segment(MARK + word), REMEMBERED)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.border = re.compile(f"(?<=[^{MARK}])(?={MARK})")

    def _automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for piece in self.ids:
            found.add_word(piece, (len(piece), piece))
        found.make_automaton()
        return found

    def merge(self, text: str) -> list[str]:
        """The encoding by definition: merge the neighbours with the best score, the leftmost of equals, until none is
        left. Used for pairs of pieces."""
        if len(text) > 64:
            return self._merge_long(text)
        cost, none = self.costs.get, math.inf
        part = list(text)
        costs = [cost(a + b, none) for a, b in zip(part, part[1:])]
        while costs and (best := min(costs)) < none:
            i = costs.index(best)
            part[i] += part.pop(i + 1)
            costs.pop(i)
            if i < len(costs):
                costs[i] = cost(part[i] + part[i + 1], none)
            if i:
                costs[i - 1] = cost(part[i - 1] + part[i], none)
        return part

    def _merge_long(self, text: str) -> list[str]:
        n = len(text)
        part, right, left, alive = list(text), [*range(1, n), -1], list(range(-1, n - 1)), [True] * n
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and (both := part[i] + part[j]) in self.costs:
                heapq.heappush(heap, (self.costs[both], i, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i] if alive[i] else -1
            if j < 0 or part[i] + part[j] != both:
                continue
            part[i], alive[j], right[i] = both, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p, a in zip(part, alive, strict=True) if a]

    def compatible(self, a: str, b: str) -> bool:
        """Whether the pieces a and b stay as they are side by side; a may be empty."""
        key = (a, b)
        if (held := self.pairs.get(key)) is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            held = self.pairs[key] = self.merge(a + b) == ([a, b] if a else [b])
        return held

    def table(self, text: str) -> list[str]:
        """Pieces of a text of known characters, by the last token of each prefix."""
        n, pairs, compatible = len(text), self.pairs, self.compatible
        last: list[str | None] = [""] + [None] * n
        for at, (length, piece) in self.automaton.iter(text):  # by end, the longest first
            if last[at + 1] is None and (before := last[at + 1 - length]) is not None:
                if (fits := pairs.get((before, piece))) is None:
                    fits = compatible(before, piece)
                if fits:
                    last[at + 1] = piece
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def segment(self, text: str) -> bytes:
        """Ids, little-endian, of a text that has space marks only at its start.

        Where no piece has the two characters at a place side by side nothing merges across it, so the text is cut there.
        """
        side = self.side_by_side
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in side]
        if cuts:
            return b"".join([self.known[text[i:j]] for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True)])
        if text not in self.single and len(text) == 1:
            return b"".join([struct.pack("<I", self.bytes_at[b]) for b in text.encode()])
        return b"".join([self.packed[p] for p in self.table(text)])

    def encode(self, text: str) -> bytes:
        """Ids of the text with begin and end ids, as little-endian unsigned 32-bit integers."""
        if not text:
            body = b""
        elif "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            marked = MARK + text.replace(" ", MARK)
            body = b"".join(map(self.known.__getitem__, self.border.split(marked)))
        else:
            body = b"".join(map(self.worded.__getitem__, text.split(" ")))
        return struct.pack("<I", self.begin) + body + struct.pack("<I", self.end)

    def forget(self) -> None:
        for held in (self.known, self.worded, self.pairs):
            held.clear()

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: pieces and bytes joined, space marks as spaces, without the space added in front."""
        listed = ids.tolist()
        raw = b"".join(map(self.raw.__getitem__, listed))
        first = next((i for i in listed if self.raw[i]), None)
        if first is not None and self.starts_with_mark[first]:
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec per worker and model."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def piece_codec(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: its whole text encoded with begin and end ids, and the
    ids decoded again.

    Null and empty texts have the begin and end ids alone and decode to the empty text. Characters without a piece
    become their bytes. Repeated rows are encoded one by one; other columns are ignored. The model's file has to be
    readable at the same place on all machines, as installed packages are.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        claim("codec", _CODECS.clear)
        own = codec(model)
        for texts in batches:
            rows = []
            for text in texts:
                ids = own.encode(text or "")
                decoded = own.decode(np.frombuffer(ids, "<u4"))
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        own.forget()

    return docs.select("doc_id", coded(F.col("text").cast("string")).alias("_c")).select("doc_id", "_c.*")
