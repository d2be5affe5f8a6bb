"""License scan: normalised text compared with licence templates by Dice over word bigrams.

A text is normalised to its words of a-z and 0-9 (other characters, line
breaks and comment marks among them, only part words), so that a notice is
found wherever it stands, however it is wrapped.  Windows of the words are
compared with each template by 2 * |A and B| / (|A| + |B|) over the sets of
word bigrams; those of at least the threshold match.

A window consists of whole runs of the template's bigrams and of what lies
between them: any other window can be trimmed or widened to such a one with a
Dice as high.  A window of several runs has at most (2 - t) / t times the
template's bigrams, t being the threshold.  Sizes alone bound the search:
|B| * t / (2 - t) <= |A| <= |B| * (2 - t) / t.  A template is a candidate
only if as many of its bigrams as the lower bound asks for occur in the text,
and a window only if they occur within its reach.

Matching windows may overlap, for a licence and its siblings share most of
their words.  A stretch of words names one licence: the window that shares
most bigrams with its template stays (ties: larger Dice, smaller start,
smaller end, earlier template), and those that share a bigram of the text with it go.

A document is compared in the task that reads it, without a shuffle; the
templates are a fixed list.  Nulls and edge cases: a null or empty text, or
one without two words in a row, has no notice, no licence (null) and Dice 0.
Repeated rows and ids behave alike, each row by itself; extra columns are not
read.  Very long texts are held as four bytes a word.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import text_or_empty
from vitaldf.llm.license_texts import TEMPLATES

THRESHOLD = 0.8
#: for rounding in the size bounds
ROOM = 1e-6
#: bytes of a text whose words are listed at a time
CHUNK = 1 << 20

_WORDS = re.compile(b"[a-z0-9]+")
_BREAK = re.compile(b"[^a-z0-9]")
NOTICES = "array<struct<license: string, dice: double, start: bigint, end: bigint>>"


class Notice(NamedTuple):
    """A match: its words are those from ``start`` to before ``end``."""

    license: str
    dice: float
    start: int
    end: int


def words_of(text: str):
    """Lists of the normalised words of ``text``, in order."""
    data, at = text.encode("utf-8", "replace").lower(), 0
    while at < len(data):
        cut = _BREAK.search(data, min(at + CHUNK, len(data)))
        end = cut.start() if cut else len(data)
        yield _WORDS.findall(data, at, end)
        at = end


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    """Sizes of the other set that allow a Dice coefficient of ``threshold``."""
    return size * threshold / (2 - threshold) - ROOM, size * (2 - threshold) / threshold + ROOM


class Matcher:
    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        words = [[w for part in words_of(text) for w in part] for _, text in templates]
        #: words of the templates, from 1; 0 stands for any other word
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in words for w in t}), 1)}
        pairs = [[(self.vocabulary[a], self.vocabulary[b]) for a, b in zip(t, t[1:], strict=False)] for t in words]
        known = {p: i for i, p in enumerate(sorted({p for t in pairs for p in t}), 1)}
        #: the number of a bigram of the templates by its two words; 0 for any other
        self.bigram = np.zeros((len(self.vocabulary) + 1,) * 2, np.int32)
        for (a, b), i in known.items():
            self.bigram[a, b] = i
        #: by template and bigram, whether it holds it
        self.member = np.zeros((len(templates), len(known) + 1), bool)
        for i, t in enumerate(pairs):
            self.member[i, [known[p] for p in t]] = True
        self.sizes = self.member.sum(axis=1)
        bounds = [size_bounds(int(n), threshold) for n in self.sizes]
        self.least = np.array([low for low, _ in bounds])
        self.most = [high for _, high in bounds]
        self.reach = [int(size_bounds(len(t), threshold)[1]) for t in pairs]

    def notices(self, text: str) -> list[Notice]:
        """The notices of a text, in order of their start."""
        parts = [np.fromiter(map(self.vocabulary.get, p, repeat(0)), np.int32, len(p)) for p in words_of(text)]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        if len(ids) < 2:
            return []
        found = self.bigram[ids[:-1], ids[1:]]
        present = np.zeros(self.member.shape[1], bool)
        present[found] = True
        present[0] = False
        candidates = np.flatnonzero((self.member[:, present].sum(axis=1) >= self.least) & (self.sizes > 0))
        if not len(candidates):
            return []
        codes = self._codes(text, len(ids))
        matched = sorted(w for t in candidates for w in self._windows(int(t), found, codes))
        starts: list[int] = []
        taken: list[Notice] = []
        for _, _, start, end, t, dice in matched:
            # those taken don't overlap, so the last that starts up to ``end`` is the one to look at
            i = bisect_right(starts, end)
            if i == 0 or taken[i - 1].end - 2 < start:
                starts.insert(i, start)
                taken.insert(i, Notice(self.names[t], dice, start, end + 2))
        return taken

    @staticmethod
    def _codes(text: str, n: int) -> np.ndarray:
        """A number for each bigram of the text, equal for equal bigrams alone."""
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for p in words_of(text) for w in p), np.int64, n)
        return ids[:-1] << 32 | ids[1:]

    def _windows(self, t: int, found: np.ndarray, codes: np.ndarray):
        """(-shared, -dice, first bigram, last bigram, template, dice) of each window that matches."""
        member, size, least, most, reach = self.member[t], int(self.sizes[t]), self.least[t], self.most[t], self.reach[t]
        hits = np.flatnonzero(member[found])
        edges = np.flatnonzero(np.diff(hits) > 1)
        firsts = hits[np.concatenate(([0], edges + 1))]
        lasts = hits[np.concatenate((edges, [len(hits) - 1]))]
        # hits that a window from each run on may hold: those in reach, or the run's own
        ends = np.maximum(firsts + reach, lasts + 1)
        enough = np.searchsorted(hits, ends) - np.searchsorted(hits, firsts) >= least
        for i in np.flatnonzero(enough):
            start, at, seen, shared = int(firsts[i]), int(firsts[i]), set(), 0
            for j in range(i, len(firsts)):
                end = int(lasts[j])
                if j > i and end - start >= reach:
                    break
                for code, bigram in zip(codes[at:end + 1].tolist(), found[at:end + 1].tolist(), strict=True):
                    if code not in seen:
                        seen.add(code)
                        shared += bool(member[bigram])
                at = end + 1
                if len(seen) > most:
                    break
                dice = 2.0 * shared / (len(seen) + size)
                if dice >= self.threshold:
                    yield -shared, -dice, start, end, t, dice


@lru_cache(maxsize=4)
def _matcher(templates: tuple, threshold: float) -> Matcher:
    return Matcher(templates, threshold)


def notices(text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """The notices in a text column, in order: an array of (license, dice, start, end), in words."""
    templates = tuple((name, text) for name, text in templates)

    @F.pandas_udf(NOTICES)
    def found(texts: pd.Series) -> pd.Series:
        matcher = _matcher(templates, threshold)
        return pd.Series([[n._asdict() for n in matcher.notices(t)] for t in texts], dtype=object)

    return found(text_or_empty(text_col))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per document: the id and what was found in its text.

    ``license`` and ``dice`` are those of the notice with the largest Dice
    (ties: by name), ``licenses`` all names in order, each once, and
    ``notices`` each notice as name:start:end, in words, by start.
    """
    found = docs.select(F.col(f"`{id_col}`").alias(id_col), notices(text_col, templates, threshold).alias("found"))
    best = F.array_sort("found", lambda a, b: F.when(a["dice"] != b["dice"], F.signum(b["dice"] - a["dice"]))
                        .when(a["license"] < b["license"], F.lit(-1.0))
                        .when(a["license"] > b["license"], F.lit(1.0)).otherwise(F.lit(0.0)).cast("int"))
    spans = F.transform("found", lambda n: F.concat_ws(":", n["license"], n["start"], n["end"]))
    return found.withColumn("best", F.get(best, F.lit(0))).select(
        id_col, F.col("best.license").alias("license"),
        F.coalesce("best.dice", F.lit(0.0)).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct("found.license")), ",").alias("licenses"),
        F.array_join(spans, ",").alias("notices"))
