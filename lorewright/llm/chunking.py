"""Cutting long texts into balanced, overlapping pieces at natural boundaries.

For a text of n characters the least piece count k is computed, k-1 cuts are
placed so that the pieces are equally long, and each is moved to the strongest
boundary near it: a blank line, then a line end, a sentence end, a blank. A
piece that cannot be ended at any blank is cut where it was aimed. If the limit
fails, a piece is added and the targets are placed anew.

Defined results: outer white space is not part of the text; null, blank and
short texts give no row (they need no cut); a text without any white space is
cut at even places; positions count characters, not bytes; repeated rows give
their pieces each time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BOUNDARIES = (
    (4, re.compile(r"\n[^\S\n]*\n\s*")),
    (3, re.compile(r"\n\s*")),
    (2, re.compile(r"[.!?]['\")\]]*\s+")),
    (1, re.compile(r"\s+")),
)


def _boundary_start(text: str, at: int) -> int:
    """Where a boundary that reaches ``at`` may have begun: before all its blanks, closing marks and stop."""
    while at > 0 and text[at - 1].isspace():
        at -= 1
    while at > 0 and text[at - 1] in "'\")]":
        at -= 1
    return max(0, at - 1)


def _snap(text: str, aim: int, low: int, high: int, reach: int) -> tuple[int, int]:
    """The strongest boundary within ``reach`` of ``aim`` inside [low, high], else any in [low, high]; (place, strength)."""
    for a, b in ((max(low, aim - reach), min(high, aim + reach)), (low, high)):
        begin = _boundary_start(text, a)
        for strength, pattern in _BOUNDARIES:
            ends = [m.end() for m in pattern.finditer(text, begin, b) if a <= m.end() <= b]
            if ends:
                return min(ends, key=lambda e: (abs(e - aim), e)), strength
    return aim, 0


def _attempt(text: str, limit: int, overlap: int, count: int) -> list[tuple[int, int, int]] | None:
    n, pieces, start = len(text), [], 0
    for k in range(count, 0, -1):
        if k == 1:
            return [*pieces, (start, n, 5)] if n - start <= limit else None
        aim = start + -(-(n - start + (k - 1) * overlap) // k)
        low = max(start + overlap + 1, n - (k - 1) * (limit - overlap) - overlap)
        high = min(start + limit, n - 1)
        if low > high:
            return None
        end, strength = _snap(text, min(max(aim, low), high), low, high, (limit - overlap) // 10)
        pieces.append((start, end, strength))
        start = end - overlap
    return None


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """Pieces (start, end, strength of the boundary at its end; 5 at the end of the text)."""
    n = len(text)
    if n <= limit:
        return [(0, n, 5)]
    count = -(-(n - overlap) // (limit - overlap))
    while not (pieces := _attempt(text, limit, overlap, count)):
        count += 1
    forced = lambda p: sum(x[2] == 0 for x in p)
    if forced(pieces) and (wider := _attempt(text, limit, overlap, count + 1)) and forced(wider) < forced(pieces):
        return wider  # a further piece gave the cuts room
    return pieces


def chunk(papers: DataFrame, id_col: str, text_col: str, limit: int = 12000, overlap: int = 1000) -> DataFrame:
    """Pieces of the texts above the limit.

    Result: ``<id_col>, piece, start, end, strength, longest_run, text``;
    ``strength`` is 0 for a cut inside a word, and ``longest_run`` the longest
    stretch of the whole text without white space.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    schema = f"`{id_col}` string, piece int, start int, end int, strength int, longest_run int, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["k"], batch["t"], strict=True):
                text = text.strip()
                if len(text) <= limit:
                    continue
                longest = max(map(len, text.split()))
                for i, (a, b, s) in enumerate(split_text(text, limit, overlap)):
                    rows.append((key, i, a, b, s, longest, text[a:b]))
            yield pd.DataFrame(rows, columns=[id_col, "piece", "start", "end", "strength", "longest_run", "text"])

    long = papers.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.length("t") > limit)
    return long.mapInPandas(run, schema)
