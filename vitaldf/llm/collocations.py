"""Phrase collocations: frequent n-grams found by mergeable Misra-Gries summaries.

Two passes over the texts, everything per language.

1. Every n-gram occurrence is hashed, and hashes are dealt into ranges of
   about equal mass.  A task sums up its texts per range, and the summaries
   of a range are merged one after the other: whenever more than ``capacity``
   counters are held, the next largest count is taken off all of them and
   those at zero are dropped.  The range's mass is sent ahead of its
   summaries, and the capacity exceeds mass / ``min_count``.  What is taken
   off any counter is then less than ``min_count``, so every n-gram that is
   frequent enough survives.
2. The survivors' hashes become a bit filter of at most ``2**MAX_FILTER_BITS``
   bits, which bounds the broadcast; a fuller filter lets more n-grams pass
   and changes no result.  Occurrences that pass are counted exactly, by their
   words, with all single words beside them.

Candidates are scored against the counts of their parts by joins.  The best of
each language are ranked among the best of slices first, so that no task
sorts all candidates of a language.

A hash is of (language, words), so a language or an n-gram that holds a third
of all occurrences is one counter of a summary and one row of a count.

Nulls and edge cases: a null text counts as empty and a null language as
``und``.  Repeated rows count each time.  Ties go by count, then phrase.  An
empty table, or one without a frequent phrase, gives no rows.  Other columns
take no part.  Counts above 10**15 would overflow the exact products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaldf.llm.common import n_blocks, saved, text_or_empty

MIN_COUNT = 10
TOP = 2000
#: a part in hundred of a phrase's occurrences that, within one longer candidate, make it a mere part
MAX_INSIDE = 50
SCALE = 1_000_000
_PIECE_ENDS, _GAPS = "[.,;:!?\n-\r]", "[ \t]+"
#: bits of an n-gram's hash; equal hashes only let a rare n-gram survive the first pass
_KEY_BITS = 48
#: bytes of text whose n-grams one range gets, on average
_RANGE_BYTES = 16 << 20
#: counters that a task holds before it sends them on, 16 bytes each and as much again while they are sorted
_TASK_COUNTERS = 5 << 19
#: bytes of text whose words a task holds at once (more, if one text is longer)
_BATCH_BYTES = 4 << 20
#: the filter has this many bits for a survivor, up to its bound of 32 MB
_BITS_EACH, MAX_FILTER_BITS = 32, 28
#: candidates ranked together in the first step
_SLICE = 1 << 19


# --- words and n-grams of a batch --------------------------------------------

@dataclass
class Tokens:
    """The words of a batch of texts, in order: codes, and the piece and language of each."""

    words: pa.Array
    code: np.ndarray
    piece: np.ndarray
    langs: pa.Array
    lang: np.ndarray

    @classmethod
    def of(cls, langs: pa.Array, texts: pa.Array) -> Tokens:
        pieces = pc.split_pattern_regex(pc.ascii_lower(texts), _PIECE_ENDS)
        text_of = pc.list_parent_indices(pieces).to_numpy()
        lists = pc.split_pattern_regex(pieces.flatten(), _GAPS)
        piece, words = pc.list_parent_indices(lists), lists.flatten()
        some = pc.not_equal(words, "")
        coded = words.filter(some).dictionary_encode()
        piece = piece.filter(some).to_numpy()
        by_lang = langs.dictionary_encode()
        return cls(coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece,
                   by_lang.dictionary, by_lang.indices.to_numpy()[text_of[piece]])

    def starts(self, n: int) -> np.ndarray:
        """Where an n-gram begins, within one piece."""
        if len(self.code) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:len(self.code) - n + 1] == self.piece[n - 1:])

    def keys(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For n = 2 and 3: n, starts, and hashes of the n-grams there."""
        hashed = _hashes(self.words)[self.code]
        key = _mixed(_hashes(self.langs)[self.lang] ^ hashed)
        for n in (2, 3):
            after = hashed[n - 1:]
            key = _mixed(key[:len(after)] * np.uint64(5) + after)
            at = self.starts(n)
            yield n, at, key[at] >> np.uint64(64 - _KEY_BITS)

    def counted(self, n: int, at: np.ndarray) -> pa.RecordBatch:
        """(lang, phrase, words, a) of the n-grams that begin at ``at``, told apart by their words."""
        group = self.lang[at].astype(np.int64)
        for k in range(n):
            _, group = np.unique(group * len(self.words) + self.code[at + k], return_inverse=True)
        size = int(group.max()) + 1 if len(group) else 0
        one = np.zeros(size, np.int64)
        one[group] = at
        phrase = pc.binary_join_element_wise(
            *[self.words.take(pa.array(self.code[one + k])) for k in range(n)], " ")
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang[one])), phrase, pa.array(np.full(size, n, np.int32)),
             pa.array(np.bincount(group, minlength=size).astype(np.int64))], ["lang", "phrase", "words", "a"])


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


# --- Misra-Gries summaries ---------------------------------------------------

class Summary:
    """Counters of the most frequent keys; what is taken off each is in ``off``."""

    def __init__(self, capacity: int):
        self.capacity, self.off = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = summed([self.keys, keys], [self.counts, counts])
        if len(self.keys) > self.capacity:
            # so that the capacity's successor in size reaches zero
            by = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            self.off += by
            left = self.counts > by
            self.keys, self.counts = self.keys[left], self.counts[left] - by

    def frequent(self, least: int) -> np.ndarray:
        """Every key whose true count is ``least`` or more, if the capacity exceeds mass / least."""
        return self.keys[self.counts + self.off >= least]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, and the sums of their counts.  Empties both lists, to hold no key twice."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(key, kind="stable")
    key = key[order]
    count = count[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, the lowest of all first: the upper ones compress to nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def pack_counters(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(_planes(steps) + _planes(counts), 1)


def unpack_counters(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    both = np.ascontiguousarray(raw.reshape(2, 8, len(raw) // 16).transpose(0, 2, 1))
    return np.cumsum(both[0].view(np.uint64).ravel(), dtype=np.uint64), both[1].view(np.int64).ravel()


_SENT = pa.schema([("part", pa.int64()), ("mass", pa.int64()), ("counters", pa.binary())])


def _sent(keys: np.ndarray, counts: np.ndarray, part_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, mass, null) and (part, null, counters)."""
    part = (keys >> np.uint64(_KEY_BITS - part_bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    mass = np.add.reduceat(counts, first) if len(first) else counts
    yield pa.RecordBatch.from_arrays(
        [pa.array(part[first]), pa.array(mass), pa.nulls(len(first), pa.binary())], schema=_SENT)
    for p, a, b in zip(part[first].tolist(), first, [*first[1:], len(keys)]):
        yield pa.RecordBatch.from_arrays(
            [pa.array([p]), pa.nulls(1, pa.int64()), pa.array([pack_counters(keys[a:b], counts[a:b])], pa.binary())],
            schema=_SENT)


def _slices(batches: Iterator[pa.RecordBatch], most: int = _BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of (lang, text) cut at about ``most`` bytes of text."""
    for b in batches:
        part = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64) // most
        first = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        for a, z in zip(first, [*first[1:], len(part)]):
            yield b.slice(a, z - a)


def _summarised(batches: Iterator[pa.RecordBatch], part_bits: int) -> Iterator[pa.RecordBatch]:
    keys, counts, held = [], [], 0
    for b in _slices(batches):
        for _, _, k in Tokens.of(b.column(0), b.column(1)).keys():
            k, c = np.unique(k, return_counts=True)
            keys.append(k)
            counts.append(c.astype(np.int64))
            held += len(k)
        if held >= _TASK_COUNTERS:
            k, c = summed(keys, counts)
            keys, counts, held = [k], [c], len(k)
            if held >= _TASK_COUNTERS // 2:
                keys, counts, held = [], [], 0
                yield from _sent(k, c, part_bits)
            del k, c
            pa.default_memory_pool().release_unused()
    if held:
        yield from _sent(*summed(keys, counts), part_bits)


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, n, keys) of the frequent keys.  Rows come by part, masses first."""
    at, mass, summary = None, 0, None

    def survivors():
        if summary is not None and len(keys := summary.frequent(least)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([len(keys)]), pa.array([keys.tobytes()], pa.binary())],
                ["part", "n", "keys"])

    for b in batches:
        for part, more, counters in zip(*(c.to_pylist() for c in b.columns)):
            if part != at:
                yield from survivors()
                at, mass, summary = part, 0, None
            if counters is None:
                mass += more
            else:
                if summary is None:
                    summary = Summary(mass // least + 1)
                summary.merge(*unpack_counters(counters))
    yield from survivors()


def survivors(texts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(part, n, keys): hashes of all n-grams of (lang, text) that may occur ``min_count`` times."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = max(0, n_blocks(size, _RANGE_BYTES) - 1).bit_length()
    sent = texts.mapInArrow(partial(_summarised, part_bits=part_bits),
                            "part long, mass long, counters binary")
    dealt = sent.repartition(1 << part_bits, "part").sortWithinPartitions("part", F.col("mass").desc_nulls_last())
    return saved(dealt.mapInArrow(partial(_merged, least=min_count), "part long, n long, keys binary"),
                 "frequent_ngrams")


# --- second pass -------------------------------------------------------------

def _bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the filter that each row's keys (a range) touch, and where they begin."""
    for b in batches:
        for raw in b.column("keys").to_pylist():
            at = np.frombuffer(raw, np.uint64) >> np.uint64(_KEY_BITS - bits)
            first = int(at[0]) // 8 * 8
            mask = np.zeros(int(at[-1]) - first + 1, np.uint8)
            mask[(at - np.uint64(first)).astype(np.int64)] = 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([first // 8]), pa.array([np.packbits(mask, bitorder="little").tobytes()], pa.binary())],
                ["at", "bytes"])


def bit_filter(found: DataFrame) -> np.ndarray:
    """A filter that every key of ``found`` passes; its size is a power of two, at most 32 MB."""
    n = found.agg(F.sum("n")).first()[0] or 0
    bits = min(MAX_FILTER_BITS, max(16, (n * _BITS_EACH).bit_length()))
    out = np.zeros(1 << bits - 3, np.uint8)
    for r in found.select("keys").mapInArrow(partial(_bits, bits=bits), "at long, bytes binary").toLocalIterator():
        part = np.frombuffer(bytes(r["bytes"]), np.uint8)
        out[r["at"]:r["at"] + len(part)] |= part
    return out


def _counted(batches: Iterator[pa.RecordBatch], passing) -> Iterator[pa.RecordBatch]:
    table = np.frombuffer(passing.value, np.uint8)
    shift = np.uint64(_KEY_BITS - (len(table) * 8 - 1).bit_length())
    for b in _slices(batches):
        tokens = Tokens.of(b.column(0), b.column(1))
        yield tokens.counted(1, np.arange(len(tokens.code)))
        for n, at, key in tokens.keys():
            bit = (key >> shift).astype(np.int64)
            yield tokens.counted(n, at[(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)])


def count_phrases(texts: DataFrame, found: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, words, a): all words, and the phrases of 2 and 3 words with ``a >= min_count``."""
    passing = texts.sparkSession.sparkContext.broadcast(bit_filter(found).tobytes())
    rows = texts.mapInArrow(partial(_counted, passing=passing), "lang string, phrase string, words int, a long")
    counts = rows.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a"))
    return saved(counts.where((F.col("words") == 1) | (F.col("a") >= min_count)), "phrase_counts")


# --- scores ------------------------------------------------------------------

def _exact(*factors: Column) -> Column:
    """A product without rounding, up to 38 digits."""
    out = factors[0].cast("decimal(38,0)")
    for f in factors[1:]:
        out = (out * f.cast("decimal(20,0)")).cast("decimal(38,0)")
    return out


def with_scores(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrases`` with l, r and score of the lowest-scoring cut (of equals, the first)."""
    word = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(word, F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(word, k + 1, F.col("words") - k), " ").alias("right")))
    cut = phrases.select("lang", "phrase", "words", "a", F.inline(cuts))
    part = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cut = cut.join(part.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
    cut = cut.join(part.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    score = F.call_function("div", _exact(F.lit(SCALE), F.col("a"), F.col("a")), _exact(F.col("l"), F.col("r")))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return (cut.groupBy("lang", "phrase", "words", "a").agg(best)
            .select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score"))


def _inside(phrases: DataFrame, max_inside: int) -> DataFrame:
    """(lang, phrase) of the phrases that are mostly a part of a longer one."""
    word = F.split("phrase", " ")
    parts = F.array(F.array_join(F.slice(word, 1, 2), " "), F.array_join(F.slice(word, 2, 2), " "))
    longest = (phrases.where("words = 3").select("lang", F.explode(F.array_distinct(parts)).alias("phrase"),
                                                 F.col("a").alias("longer"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (phrases.where("words = 2").join(longest, ["lang", "phrase"])
            .where(100 * F.col("longer") >= max_inside * F.col("a")).select("lang", "phrase"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 top: int = TOP, max_inside: int = MAX_INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        text_or_empty(text_col).alias("text"))
    counts = count_phrases(texts, survivors(texts, min_count), min_count)
    phrases = counts.where("words > 1")
    totals = counts.where("words = 1").groupBy("lang").agg(F.sum("a").alias("n"))
    kept = saved(with_scores(phrases, counts.where(F.col("a") >= min_count))
                 .join(_inside(phrases, max_inside), ["lang", "phrase"], "left_anti"), "scored_phrases")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    slices = n_blocks(kept.count(), _SLICE)
    part = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    part = (part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
            .where(F.col("rank") <= top))
    ranked = (part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .where(F.col("rank") <= top))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
