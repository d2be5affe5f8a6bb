"""Language-model scores from a Brown class bigram model.

A token's probability is that of its class after the class before it, times
that of the word within its class: ``P(k | j) * c(w) / c(k)``.  A document is
its words and an end, which is a class of its own and also what stands before
the first word.

Classes come from exchange clustering in rounds.  Words that make up more
than 1 / ``FREQUENT`` of the training tokens (fewer than ``FREQUENT``, by that
definition) are exchanged: each task counts the classes to the left and right
of each, the counts are summed, and a word moves to the class where the
likelihood of all class bigrams gains most.  The most frequent words seed the
classes; after the first round every other word may move in turn, until the
likelihood falls (that round is taken back) or ROUNDS are done.  Then every
rarer word of the corpus, however many there are, is moved from the class of
rare words by the same gain (to first order), from all of its occurrences.
Transitions are then counted anew over all tokens.

Smoothing: transitions are mixed with the classes' own shares, and a word not
seen in training gets, after each class, the share of words there that were
seen once.  Probabilities after a class sum to one over the training words,
the end, and one unknown word, which is what the base score assumes as well.

The texts are read once: a task codes them in blocks of tokens, each with its
own word list.  Only (word, contexts) and (block, word) rows are shuffled by
word, once each, and the blocks once.  What reaches the driver is bounded:
the frequent words, their classes and matrices of classes.

Nulls and edge cases: a null or empty text is an end alone.  A null id is
trained on.  Repeated rows count and are scored each time.  Ties go to the
smaller class; equally frequent words are ordered by their bytes.  Without
training rows all words are unknown and the classes are equally likely.
Other columns take no part, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import discard, saved, text_or_empty

CLASSES = 64
FREQUENT = 1 << 14
#: rounds of exchanges at most; they end before if one lowers the likelihood
ROUNDS = 3
#: tokens that a task codes with one word list
BLOCK_TOKENS = 1 << 21
#: weight of the classes' own shares, in tokens, in the transitions after a class
MIXED = 20.0
#: words of one matrix of contexts
_RANGE = 512
_GAPS = "[ \t-\r]+"
_ONCE = 0x80
END = ""  # as a word; the first of every word list


# --- blocks of coded texts ---------------------------------------------------

def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 3)


def _numbers(packed: bytes, kind=np.int32) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def _ends_and_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the codes of all (-1: an end), and where each text ends."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), _GAPS)
    words, text = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.not_equal(words, "")
    coded = words.filter(some).dictionary_encode()
    per_text = np.bincount(text.filter(some).to_numpy(), minlength=len(texts))
    del lists, words, text, some
    codes = np.insert(coded.indices.to_numpy(), np.cumsum(per_text), -1)
    return coded.dictionary, codes, np.cumsum(per_text + 1)


def _one(values) -> pa.ListArray:
    """A column of one row: the list of ``values``."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class _Block:
    """Texts of a task, coded by one word list."""

    def __init__(self):
        self.words, self.ids, self.train, self.lengths, self.codes, self.tokens = {END: 0}, [], [], [], [], 0

    def add(self, ids: pa.Array, texts: pa.Array, train: np.ndarray) -> None:
        distinct, codes, ends = _ends_and_codes(texts)
        known = self.words
        own = np.fromiter((known.setdefault(w, len(known)) for w in distinct.to_pylist()), np.int64, len(distinct))
        self.codes.append(np.append(own, 0).astype(np.int32)[codes])
        self.lengths.append(np.diff(ends, prepend=0))
        self.ids.append(ids)
        self.train.append(train)
        self.tokens += len(codes)

    def row(self, block: int) -> pa.RecordBatch:
        codes, lengths = np.concatenate(self.codes), np.concatenate(self.lengths)
        train = np.concatenate(self.train)
        # the most frequent words first, so that most codes are small
        order = np.argsort(-np.bincount(codes, minlength=len(self.words))[1:], kind="stable") + 1
        order = np.insert(order, 0, 0)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        codes = place[codes]
        counts = np.bincount(codes[np.repeat(train, lengths)], minlength=len(order))
        words = pa.array(list(self.words)).take(pa.array(order))
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), _one(pa.concat_arrays(self.ids)), _one(train), _one(lengths.astype(np.int32)),
             pa.array([_planes(codes)], pa.binary()), _one(words), _one(counts)],
            ["block", "ids", "train", "lengths", "codes", "words", "counts"])


def _coded(batches: Iterator[pa.RecordBatch], block_tokens: int) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    block, n = _Block(), 0
    for b in batches:
        if not b.num_rows:
            continue
        block.add(b.column(0), b.column(1), b.column(2).to_numpy(zero_copy_only=False).astype(bool))
        pa.default_memory_pool().release_unused()
        if block.tokens >= block_tokens:
            yield block.row(first + n)
            block, n = _Block(), n + 1
    if block.tokens:
        yield block.row(first + n)


def code(docs: DataFrame, train: Column, id_col: str, text_col: str,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row for each block: ids, training marks and lengths of its texts, their codes, and the word list."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"),
                        F.coalesce(train, F.lit(True)).alias("train"))
    kind = texts.schema["id"].dataType.simpleString()
    return saved(texts.mapInArrow(
        partial(_coded, block_tokens=block_tokens),
        f"block long, ids array<{kind}>, train array<boolean>, lengths array<int>, codes binary, "
        "words array<string>, counts array<long>"), "coded")


# --- exchange clustering -----------------------------------------------------

class Model:
    """The frequent words with their counts and classes; numbers of the other classes."""

    def __init__(self, words: list[str], counts: list[int], classes: int):
        self.words = pa.array(words, pa.string())
        self.counts = np.array(counts, np.int64)
        self.classes = classes
        #: of words that have no class yet (later: of unknown words), and of the end
        self.rare, self.end = classes, classes + 1
        self.all = classes + 2
        self.of = np.where(np.arange(len(words)) < classes, np.arange(len(words)), self.rare).astype(np.int64)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The frequent word's number for each of a word list, or -1."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """A block's columns: lists as arrays, other values as they are."""
    for b in batches:
        for i in range(b.num_rows):
            row = {}
            for name, column in zip(b.schema.names, b.columns):
                value = column[i]
                row[name] = value.values if isinstance(value, pa.ListScalar) else value.as_py()
            if "train" in row:
                row["train"] = row["train"].to_numpy(zero_copy_only=False).astype(bool)
                row["lengths"] = row["lengths"].to_numpy().astype(np.int64)
            yield row


def _training(row: dict, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a block's training tokens after an end, frequent words' numbers, classes."""
    codes = np.insert(_numbers(row["codes"])[np.repeat(row["train"], row["lengths"])], 0, 0)
    number = model.numbers(row["words"])
    own = np.where(number < 0, model.rare, model.of[number] if len(model.of) else model.rare)
    own[0] = model.end
    return codes, number[codes], own[codes]


def _contexts(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Rows (part, counts): how often each class stands left and right of the words of a range.

    Part -1 counts the bigrams of classes.
    """
    model = shared.value
    m, n = model.all, -(-len(model.of) // _RANGE) * _RANGE
    around, pairs = np.zeros(n * 2 * m, np.int64), np.zeros(m * m, np.int64)
    for row in _blocks(batches):
        _, number, own = _training(row, model)
        pairs += np.bincount(own[:-1] * m + own[1:], minlength=m * m)
        at = np.flatnonzero(number >= 0)
        place = number[at] * 2 * m
        around += np.bincount(place + own[at - 1], minlength=len(around))
        around += np.bincount(place + m + own[at + 1], minlength=len(around))
    yield _part(-1, pairs)
    for i, counts in enumerate(around.reshape(-1, _RANGE * 2 * m)):
        if counts.any():
            yield _part(i, counts)


def _part(i: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i]), pa.array([_planes(counts)], pa.binary())], ["part", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = {}
    for b in batches:
        for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            more = _numbers(counts, np.int64)
            sums[part] = sums[part] + more if part in sums else more
    for part, counts in sums.items():
        yield _part(part, counts)


def summed(parts: DataFrame, ranges: int, name: str) -> DataFrame:
    """(part, counts) with the counts of each part added up, as they come."""
    return saved(parts.repartition(ranges, "part").mapInArrow(_summed, "part long, counts binary"), name)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_class(left: np.ndarray, right: np.ndarray, pairs: np.ndarray, size: np.ndarray, own: int,
               classes: int) -> int:
    """The class where a word, with these counts of classes around it, adds most to the likelihood.

    The word is taken out of its class first; its neighbours keep theirs.
    """
    n = left.sum()
    pairs = pairs.copy()
    pairs[:, own] -= left
    pairs[own] -= right
    np.maximum(pairs, 0, out=pairs)
    size = size.copy()
    size[own] -= n
    x, y = np.flatnonzero(left), np.flatnonzero(right)
    to, out_of = pairs[x, :classes], pairs[:classes, y]
    gain = (_xlogx(to + left[x, None]) - _xlogx(to)).sum(0) + (_xlogx(out_of + right[y]) - _xlogx(out_of)).sum(1)
    gain -= 2 * (_xlogx(size[:classes] + n) - _xlogx(size[:classes]))
    return int(gain.argmax())


def _moves(batches: Iterator[pa.RecordBatch], shared, pairs: np.ndarray, turn: int | None) -> Iterator[pa.RecordBatch]:
    model = shared.value
    m, size = model.all, pairs.sum(1)
    for b in batches:
        for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            moved = []
            for i, (left, right) in enumerate(_numbers(counts, np.int64).reshape(-1, 2, m), part * _RANGE):
                if i >= len(model.of) or not left.any() or (model.of[i] < model.classes if turn is None
                                                            else i % 2 != turn):
                    continue
                k = best_class(left, right, pairs, size, int(model.of[i]), model.classes)
                if k != model.of[i]:
                    moved.append((i, k))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in moved], pa.int64()),
                                              pa.array([k for _, k in moved], pa.int64())], ["word", "class"])


def exchange(coded: DataFrame, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Set the frequent words' classes in ``model``; the counts of class bigrams under them."""
    context = coded.sparkSession.sparkContext
    rows = coded.select("train", "lengths", "codes", "words")
    ranges = -(-len(model.of) // _RANGE)
    pairs = np.zeros((model.all, model.all), np.int64)
    best = None
    for i in range(rounds + 1):
        shared = context.broadcast(model)  # fewer than FREQUENT words
        sums = summed(rows.mapInArrow(partial(_contexts, shared=shared), "part long, counts binary"),
                      ranges + 1, "contexts")
        for r in sums.where("part = -1").collect():
            pairs = _numbers(bytes(r["counts"]), np.int64).reshape(model.all, model.all)
        gained = _xlogx(pairs).sum() - 2 * _xlogx(pairs.sum(1)).sum()
        if best is not None and gained < best[0]:  # words that moved at once met others that moved
            _, model.of, pairs = best
            break
        best = gained, model.of.copy(), pairs
        if i < rounds:
            moves = sums.where("part >= 0").mapInArrow(
                partial(_moves, shared=shared, pairs=pairs, turn=i % 2 if i else None), "word long, class long")
            for r in moves.collect():  # fewer than FREQUENT
                model.of[r["word"]] = r["class"]
        discard(sums)
    return pairs


# --- rarer words -------------------------------------------------------------

def _rare_contexts(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(word, around): a byte for the class on each side of each training occurrence in a block."""
    model = shared.value
    for row in _blocks(batches):
        codes, number, own = _training(row, model)
        at = np.flatnonzero((number < 0) & (codes > 0))
        at = at[np.argsort(codes[at], kind="stable")]
        around = np.column_stack([own[at - 1], own[at + 1] + model.all]).astype(np.uint8)
        first = np.flatnonzero(np.diff(codes[at], prepend=-1))
        words = row["words"].take(pa.array(codes[at[first]]))
        ends = np.append(first, len(at)).astype(np.int32) * 2
        values = pa.BinaryArray.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(around.tobytes())])
        yield pa.RecordBatch.from_arrays([words, values], ["word", "around"])


def _rare_classes(batches: Iterator[pa.RecordBatch], classes: int, after: np.ndarray,
                  before: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, class, c) of each word.  Rows come in order of their words."""
    m = classes + 2
    last, held = None, None

    def done(words, counts):
        gain = counts[:, :m] @ after + counts[:, m:] @ before - 2 * counts[:, :m].sum(1, keepdims=True) * size
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(gain.argmax(1).astype(np.int32)),
             pa.array(counts[:, :m].sum(1).astype(np.int64))], ["word", "class", "c"])

    for b in batches:
        if not b.num_rows:
            continue
        coded = b.column(0).dictionary_encode()
        words, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        sizes = pc.binary_length(b.column(1)).to_numpy()
        around = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8)
        counts = np.bincount(np.repeat(which.astype(np.int64), sizes) * 2 * m + around,
                             minlength=len(words) * 2 * m).reshape(-1, 2 * m).astype(float)
        if last is not None:
            if words[0] == last:
                counts[0] += held
            else:
                yield done([last], held[None])
        last, held = words[-1], counts[-1].copy()
        yield done(words[:-1], counts[:-1])
    if last is not None:
        yield done([last], held[None])


def place_rare(coded: DataFrame, model: Model, pairs: np.ndarray) -> DataFrame:
    """(word, class, c) of every training word that is not frequent."""
    rows = coded.select("train", "lengths", "codes", "words")
    shared = coded.sparkSession.sparkContext.broadcast(model)
    k = model.classes
    cells, size = np.log(pairs + 0.5), np.log(pairs.sum(1)[:k] + 0.5 * model.all)
    contexts = rows.mapInArrow(partial(_rare_contexts, shared=shared), "word string, around binary")
    return saved(contexts.repartition("word").sortWithinPartitions("word").mapInArrow(
        partial(_rare_classes, classes=k, after=cells[:, :k], before=cells[:k].T, size=size),
        "word string, class int, c long"), "rare_words")


# --- scores ------------------------------------------------------------------

def _rare_entries(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(block, code, word) of the words that are not frequent."""
    model = shared.value
    for row in _blocks(batches):
        rare = model.numbers(row["words"]) < 0
        rare[0] = False
        at = np.flatnonzero(rare)
        for i in range(0, len(at), 1 << 15):
            part = pa.array(at[i:i + (1 << 15)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), row["block"], np.int64)), part, row["words"].take(part)],
                ["block", "code", "word"])


def _classed(batches: Iterator[pa.RecordBatch], shared, ends: int, tokens: int, distinct: int,
             sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per block: ids, classes of all tokens, and sums of each text."""
    model = shared.value
    for row in _blocks(batches):
        codes, lengths, number = _numbers(row["codes"]), row["lengths"], model.numbers(row["words"])
        kind = np.full(len(number), model.rare, np.int64)
        count = np.zeros(len(number), np.int64)
        some = number >= 0
        kind[some], count[some] = model.of[number[some]], model.counts[number[some]]
        if row["entries"] is not None:
            at = row["entries"].field("code").to_numpy()
            kind[at], count[at] = row["entries"].field("class").to_numpy(), row["entries"].field("c").to_numpy()
        kind[0], count[0] = model.end, ends
        base = np.log10((count + 0.5) / (tokens + 0.5 * (distinct + 1)))
        within = np.where(count > 0, np.log10(np.maximum(count, 1) / np.maximum(sizes[kind], 1)), 0.0)
        starts = np.cumsum(lengths) - lengths
        own = (kind | np.where(count == 1, _ONCE, 0)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [_one(row["ids"]), _one(row["train"]), _one(lengths.astype(np.int32)),
             _one(np.add.reduceat((count > 0).astype(np.int64)[codes], starts)),
             _one(np.add.reduceat(base[codes], starts)), _one(np.add.reduceat(within[codes], starts)),
             pa.array([zstandard.compress(own[codes].tobytes(), 3)], pa.binary())],
            ["ids", "train", "lengths", "known", "base", "within", "own"])


def _transitions(batches: Iterator[pa.RecordBatch], m: int) -> Iterator[pa.RecordBatch]:
    """Bigrams of classes in training texts; of those, with a word seen once before or after."""
    sums = np.zeros(3 * m * m, np.int64)
    for row in _blocks(batches):
        own = np.frombuffer(zstandard.decompress(row["own"]), np.uint8)
        own = np.insert(own[np.repeat(row["train"], row["lengths"])], 0, m - 1)
        kind, once = (own & ~np.uint8(_ONCE)).astype(np.int64), (own & _ONCE) > 0
        once &= kind < m - 2
        cell = kind[:-1] * m + kind[1:]
        for i, some in enumerate((slice(None), once[:-1], once[1:])):
            sums[i * m * m:(i + 1) * m * m] += np.bincount(cell[some], minlength=m * m)
    yield _part(0, sums)


def log_transitions(pairs: np.ndarray, first_once: np.ndarray, second_once: np.ndarray) -> np.ndarray:
    """log10 of (probability of a class, known or unknown) after each class.

    The last but one is of unknown words: what follows words seen once, and
    their share after each class.
    """
    m = len(pairs)
    rare = m - 2
    pairs = pairs.astype(float)
    known = np.arange(m) != rare
    share = np.where(known, pairs.sum(0), 0.0)
    share = share / share.sum() if share.any() else known / known.sum()
    total, once = pairs.sum(1), second_once.sum(1)
    rate = (once.sum() + 0.5) / (total.sum() + 1.0)
    unknown = np.minimum((once + MIXED * rate) / (total + MIXED), 0.9)
    pairs[rare] = first_once.sum(0)
    to = (pairs + MIXED * share) / (pairs.sum(1) + MIXED)[:, None] * (1 - unknown)[:, None]
    to[:, rare] = unknown
    return np.log10(np.maximum(to, 1e-300))


def _scored(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    end = len(table) - 1
    for row in _blocks(batches):
        own = np.frombuffer(zstandard.decompress(row["own"]), np.uint8) & ~np.uint8(_ONCE)
        before = np.insert(own[:-1], 0, end)
        lengths = row["lengths"]
        score = np.add.reduceat(table[before, own], np.cumsum(lengths) - lengths)
        yield pa.RecordBatch.from_arrays(
            [row["ids"], pa.array(~row["train"]), pa.array(lengths), row["known"], row["base"],
             pa.array(score + row["within"].to_numpy())],
            ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def lm_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
              classes: int = CLASSES, frequent: int = FREQUENT, rounds: int = ROUNDS,
              block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document: the id, ``held_out`` (not ``train``), n_tokens, n_known, train_tokens, base_score,
    score (log10 of the text's probability) and perplexity."""
    if not 0 < classes <= 125:
        raise ValueError("1 to 125 classes")
    spark = docs.sparkSession
    coded = code(docs, train, id_col, text_col, block_tokens)
    entries = coded.select(F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("c"))))
    vocabulary = saved(entries.where("c > 0").groupBy("word").agg(F.sum("c").alias("c")), "vocabulary")
    tokens, distinct, ends = vocabulary.agg(F.sum("c"), F.count(F.lit(1)),
                                            F.sum(F.when(F.col("word") == END, F.col("c")))).first()
    tokens, ends = tokens or 0, ends or 0
    often = (vocabulary.where((F.col("c") * frequent > tokens) & (F.col("word") != END))
             .orderBy(F.col("c").desc(), "word").collect())  # fewer than ``frequent``
    discard(vocabulary)
    model = Model([r["word"] for r in often], [r["c"] for r in often], classes)
    pairs = exchange(coded, model, rounds)
    rare = place_rare(coded, model, pairs)
    sizes = np.zeros(model.all, np.int64)
    np.add.at(sizes, model.of, model.counts)
    for r in rare.groupBy("class").agg(F.sum("c").alias("c")).collect():
        sizes[r["class"]] += r["c"]
    sizes[model.end] = ends
    shared = spark.sparkContext.broadcast(model)
    found = (coded.select("block", "words").mapInArrow(partial(_rare_entries, shared=shared),
                                                        "block long, code int, word string")
             .join(rare, "word").groupBy("block").agg(F.collect_list(F.struct("code", "class", "c")).alias("entries")))
    kind = coded.schema["ids"].dataType.simpleString()
    per_block = coded.drop("counts").join(found, "block", "left").drop("block")
    classed = saved(per_block.mapInArrow(
        partial(_classed, shared=shared, ends=ends, tokens=tokens, distinct=distinct, sizes=sizes),
        f"ids {kind}, train array<boolean>, lengths array<int>, known array<long>, base array<double>, "
        "within array<double>, own binary"), "classed")
    m = model.all
    discard(coded, rare)
    parts = summed(classed.select("own", "train", "lengths").mapInArrow(
        partial(_transitions, m=m), "part long, counts binary"), 1, "transitions")
    counts = np.zeros((3, m, m), np.int64)
    for r in parts.collect():
        counts = _numbers(bytes(r["counts"]), np.int64).reshape(3, m, m)
    out = classed.mapInArrow(partial(_scored, table=log_transitions(*counts)),
                             f"id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens long, "
                             "n_known long, base_score double, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
