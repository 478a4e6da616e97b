"""Splitting oversized texts at natural boundaries.

The token offsets of a text are the prefix sums of its tokens' byte lengths. Boundaries of four kinds
(paragraph, line or sentence, word, none) are sorted arrays of token indices; a piece ends at the
last boundary under the limit, found by binary search, and the next begins the overlap before that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.tokens import VOCABULARY, encoder, token_lengths

SCHEMA = "doc_id long, piece int, start_char long, end_char long, n_tokens int, overlap int, cut string, text string"

#: How full a piece must be before a boundary of the kind may end it; a word boundary always may.
FILL = (("paragraph", 0.5), ("sentence", 0.25), ("word", 0.0))

_STOP, _CLOSE = np.isin(np.arange(256), list(b".!?")), np.isin(np.arange(256), list(b"\"')]"))


def boundaries(raw: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Token indices k such that a piece may begin with token k, by kind, each sorted.

    ``raw``: the bytes of the text; ``ends``: offsets[k] is the byte at which token k begins.
    A word boundary is one that pre-tokenisation also keeps, so that the pieces' own tokens are
    those of the whole text: the token begins with a space, or follows a line end.
    """
    inner = ends[1:-1]
    if not len(inner):
        return {k: np.zeros(0, np.int64) for k, _ in FILL}
    index = np.arange(1, len(inner) + 1)
    here, before = raw[inner], raw[inner - 1]
    two = raw[np.maximum(inner - 2, 0)]
    three = raw[np.maximum(inner - 3, 0)]
    after = raw[np.minimum(inner + 1, len(raw) - 1)]
    # White space of more than one sign may be one token, so only its last sign, a space, begins a piece.
    line = (before == 10) & (here != 10) & (here != 13) & ((here != 32) | ((after != 10) & (after != 13) & (after != 32) & (after != 9)))
    paragraph = line & ((two == 10) | ((two == 13) & (three == 10)))
    space = (here == 32) & (before != 32)
    sentence = line | (space & (_STOP[before] | (_CLOSE[before] & _STOP[two])))
    return {"paragraph": index[paragraph], "sentence": index[sentence], "word": index[space | line]}


def _last_in(points: np.ndarray, low: int, high: int) -> int:
    """The last point p with low < p <= high, or -1."""
    at = np.searchsorted(points, high, "right") - 1
    return int(points[at]) if at >= 0 and points[at] > low else -1


def pieces(text: str, limit: int, overlap: int, path: str = VOCABULARY) -> list[tuple[int, int, int, int, str]]:
    """(start byte, end byte, own tokens, tokens shared with the piece before, kind of end).

    [] for a text within the limit. Every piece has at most ``limit`` tokens when it is encoded by
    itself, and begins ``overlap`` tokens before the end of the piece before it, or up to three
    more where that would fall inside a character.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than the limit")
    e = encoder(path)
    tokens = np.fromiter(e.encode_ordinary(text), np.int64)
    n = len(tokens)
    if n <= limit:
        return []
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(token_lengths(path)[tokens], out=ends[1:])
    by_kind = boundaries(raw, ends)
    whole = np.ones(n + 1, bool)
    whole[1:-1] = (raw[ends[1:-1]] & 0xC0) != 0x80
    safe = np.zeros(n + 1, bool)
    safe[by_kind["word"]] = True
    safe[[0, n]] = True
    safe_at = np.flatnonzero(safe)

    def own(a: int, b: int) -> int:
        """Tokens of the piece a..b encoded by itself; what lies between safe points stays as it is."""
        after_line = raw[ends[b] - 1] in (10, 13, 32)  # white space at an end is grouped anew
        # White space at an end is grouped anew, so a stretch ends behind a word.
        after_line = raw[ends[b] - 1] in (10, 13, 32)
        i = np.searchsorted(safe_at, a)
        while safe_at[i] > a and safe_at[i] < n and raw[ends[safe_at[i]] - 1] in (10, 13, 32):
            i += 1
        p, q = int(safe_at[i]), int(safe_at[np.searchsorted(safe_at, b, "left" if after_line else "right") - 1])
        enc = lambda x, y: len(e.encode_ordinary(raw[ends[x] : ends[y]].tobytes().decode("utf-8", "replace")))
        if p >= q:
            return b - a if safe[a] and safe[b] and not after_line else enc(a, b)
        return (enc(a, p) if a < p else 0) + (q - p) + (enc(q, b) if q < b else 0)

    out, start, shared = [], 0, 0
    while True:
        room = start + limit
        while True:
            end, kind = (n, "end") if room >= n else (-1, "")
            if end < 0:
                for kind, least in FILL:
                    if (end := _last_in(by_kind[kind], max(start + shared, start + int(limit * least)), room)) > 0:
                        break
                else:
                    end, kind = room, "hard"
                    while not whole[end] and end > start + shared + 1:
                        end -= 1
                    while not whole[end]:
                        end += 1
            size = own(start, end)
            if size <= limit or room <= start + shared + 1:
                break
            room = min(end, room) - (size - limit)
            room = max(room, start + shared + 1)
        out.append((int(ends[start]), int(ends[end]), size, shared, kind))
        if end >= n:
            return out
        begin = max(end - overlap, start + 1)
        while not whole[begin]:
            begin -= 1
        start, shared = begin, end - begin


def split(documents: DataFrame, limit: int, overlap: int, path: str = VOCABULARY) -> DataFrame:
    """The pieces of every text over ``limit`` tokens, in order: SCHEMA.

    start_char and end_char are code points from 0, the end outside; overlap counts the tokens
    shared with the piece before; cut is the kind of the piece's end: paragraph, sentence (also a
    line), word, hard or end. Texts within the limit, NULL and empty ones have no pieces. Repeated
    doc_ids each give their pieces. Narrow: no shuffle.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                # A token is a byte at least, so a text of no more bytes is within the limit.
                if not text or (len(text) <= limit and len(text.encode("utf-8", "replace")) <= limit):
                    continue
                raw = text.encode("utf-8", "replace")
                text = raw.decode("utf-8")
                char = None
                for k, (a, b, size, shared, kind) in enumerate(pieces(text, limit, overlap, path)):
                    if char is None:
                        starts = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
                        char = np.concatenate(([0], np.cumsum(starts)))
                    rows.append((doc, k, int(char[a]), int(char[b]), size, shared, kind, raw[a:b].decode("utf-8")))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start_char", "end_char", "n_tokens", "overlap", "cut", "text"])

    return documents.select("doc_id", F.col("text")).mapInPandas(run, SCHEMA)
