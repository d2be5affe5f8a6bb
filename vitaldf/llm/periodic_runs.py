"""Periodic runs of words: online square catching over dyadic blocks.

Words are appended one by one.  Each completed block of a power-of-two length
``2**k`` that starts at a multiple of its length is a catcher: it waits for
itself to come again ``p`` words later, with ``2 * 2**k - 1 <= p < 4 * 2**k - 1``.
The first half of any square of period ``p`` holds such a block, so no square
escapes.  When a catcher's first word comes again, a comparison of the two
suffixes at distance ``p`` begins; each further word advances it or ends it.
After the whole block it is carried backwards to the first difference, and
when it has gone on for ``p`` words it is a new square.  Squares of one
distance merge into a run, reported when a word ends it.

A document's catchers live in the task that reads its text: nothing is
shuffled, and memory is that of one text.  A word meets at most two catchers
of each length, so the time is that of ``n log n`` comparisons at most; words
within a run that a shorter period explains start no comparison.

Nulls and edge cases: a null or empty text has no words and no runs, and
collapses to an empty text.  Repeated rows and ids behave alike, since a row
needs no other.  Other columns pass through.  An empty table stays empty.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import text_or_empty

WORD = re.compile("[^\x20\x09-\x0D]+")
#: a run is reported if it has at least so many words, and so many periods
MIN_LENGTH = 6
MIN_EXPONENT = 4
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SquareCatcher:
    """The runs of a growing sequence of words."""

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
        if min_exponent < 2:
            raise ValueError("a run has two periods at least")
        self.min_length, self.min_exponent = min_length, min_exponent
        self.words: list[str] = []
        #: word -> starts of catchers whose block begins with it
        self._heads: dict[str, list[int]] = {}
        #: running comparisons: [distance, first word, last word of the block, start of the stretch or -1]
        self._live: list[list[int]] = []
        self._ended: dict[tuple[int, int], int] = {}

    def append(self, words: Iterable[str]) -> None:
        text, heads = self.words, self._heads
        i = len(text)
        for w in words:
            text.append(w)
            if self._live:
                self._advance(i, w)
            starts = heads.get(w)
            if starts is None:
                heads[w] = [i]
            else:
                # a block that starts at s is at most as long as the lowest bit of s
                kept = [s for s in starts if i - s < 4 * (s & -s) - 1 or not s]
                for s in kept:
                    size = 1 << (i - s + 1).bit_length() - 2
                    if not s & (size - 1):
                        self._compare(s, i, size)
                kept.append(i)
                heads[w] = kept
            i += 1

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of the runs so far, by start, then period."""
        found = dict(self._ended)
        for p, _, _, start in self._live:
            self._report(found, p, start, len(self.words))
        return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))

    def _compare(self, s: int, i: int, size: int) -> None:
        p = i - s
        for q, _, _, start in self._live:
            # the same comparison, or one that a run of a period dividing this distance explains
            if q == p or (start >= 0 and start <= s and p % q == 0):
                return
        new = [p, i, i + size - 1, -1]
        if size == 1:
            self._carry_back(new)
        self._live.append(new)

    def _advance(self, i: int, w: str) -> None:
        text, on = self.words, []
        for c in self._live:
            if text[i - c[0]] == w:
                if i == c[2]:
                    self._carry_back(c)
                on.append(c)
            else:
                self._report(self._ended, c[0], c[3], i)
        self._live = on

    def _carry_back(self, c: list[int]) -> None:
        text, p, x = self.words, c[0], c[1]
        while x > p and text[x - 1] == text[x - 1 - p]:
            x -= 1
        c[3] = x - p

    def _report(self, found: dict, p: int, start: int, end: int) -> None:
        n = end - start
        if start >= 0 and n >= max(self.min_length, self.min_exponent * p):
            found[start, n] = min(p, found.get((start, n), p))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """``words`` without those that a run holds after its first period."""
    kept, at = [], 0
    for a, b in sorted((s + p, s + n) for s, n, p in runs):
        if a > at:
            kept.extend(words[at:a])
        at = max(at, b)
    return kept + words[at:]


def planted(doc_id: str | None, words: list[str]) -> list[str]:
    """``words``, from some word on made periodic in a tenth of the documents, chosen by their id."""
    n = len(words)
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[:n - a]


def with_runs(docs: DataFrame, out: str, text_col: str = "text", id_col: str | None = None,
              rewrite: Callable[[str | None, list[str]], list[str]] | None = None,
              min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with a struct column ``out``: number of words, runs, and the text collapsed.

    ``rewrite`` changes a document's words, given its id as text, before the
    search.  Words of the collapsed text are joined by one space.
    """
    @F.pandas_udf(RESULT)
    def find(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for i, text in zip(ids, texts):
            words = WORD.findall(text)
            if rewrite is not None:
                words = rewrite(i, words)
            catcher = SquareCatcher(min_length, min_exponent)
            catcher.append(words)
            runs = catcher.runs()
            rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs],
                         " ".join(collapse(words, runs))))
        return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    ids = F.col(f"`{id_col}`").cast("string") if id_col else F.lit(None).cast("string")
    return docs.withColumn(out, find(ids, text_or_empty(text_col)))


def summary(runs: str = "runs") -> list[Column]:
    """Columns that sum up a document's ``runs``: their number, the longest, a hash of all.

    The longest has the smallest start, then period, of equals; without a run its columns are null.
    """
    r = F.col(runs)
    best = F.array_max(F.transform(r, lambda x: F.struct(
        x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    line = F.transform(r, lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    length, start, period = best["length"], -best["start"], -best["period"]
    return [F.size(r).cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
            period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
            F.sha2(F.concat_ws("", line), 256).alias("runs_sha256")]
