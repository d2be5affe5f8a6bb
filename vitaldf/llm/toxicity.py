"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased runs of word characters.  A bounded sample of labelled
training rows gives the examples; every term of theirs is indexed.  Document
frequencies are counted over all documents, of the examples' terms and of
all others, and a text's norm is over all its terms.  No term is dropped:
each has the weight (1 + ln count) * idf * trust, where trust grows from a
small floor to 1 with how surely the term's presence tells the labels apart
(G squared), so that noise stays small.  Each document's K nearest examples
are found with a block-max inverted index: long posting lists in blocks of
examples, with the largest weight of each (term, block), so that blocks whose
bound can't reach the K-th cosine are skipped; the result is exact.  Terms
that no example has are told apart by 64-bit hashes.

Votes are weighted by squared cosine and by how many training rows an example
stands for.  Isotonic regression on the examples' own leave-one-out votes
turns a vote into a probability.  The neighbours are returned as evidence.

The index is bounded by MAX_EXAMPLES texts and goes to every task; documents
are scored where they are read, and the other terms' share of the norm is
joined to the scored rows.  Nulls and edge cases: a null or empty text, or
one without a term of the examples, gets the rate of
label 1 among such training examples.  Without training rows of both labels
every score is the rate of label 1 (0 without any).  Labels of one id are
averaged, 0.5 counting as 1; null labels and null ids are left out.  Only
texts and training labels enter a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm import simhash
from vitaldf.llm.common import saved, text_or_empty

#: bound of the fitted model: training rows of each label
MAX_EXAMPLES = 2048
#: a term is half trusted if its likelihood ratio for the labels (G squared) exceeds by this
#: what the best of as many unrelated terms reaches; an unrelated term's is 1 on average
MARGIN, CHANCE = 8.0, 1.0
K = 15
#: squared cosine by which the rate of all examples counts in a vote
PRIOR = 0.05
BLOCK = 64
#: terms whose lists are laid out as rows, at most
ROWS = 512
#: queries that are searched together, at most
QUERIES = 64
#: blocks that are searched first, for a bound of the K-th cosine
FIRST_BLOCKS = 4
FOLDS = 5
#: documents whose terms a Python task holds at once
ROWS_AT_ONCE = 1024
_TERM = re.compile(r"\w+")


def held_out(id_col: str) -> Column:
    """True for the rows whose labels are not learned from."""
    fold = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def text_terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class BlockMaxIndex:
    """Exact cosine search over unit vectors, given as {term: weight}.

    The lists of terms that few examples hold are read whole.  Those of the
    terms that many hold, most of all postings that a query meets, stand by
    blocks of examples as rows of weights, with the largest weight of each
    (term, block); a block is read only if its bound reaches the K-th product.
    The rows are laid out where the index is used, and not sent.
    """

    def __init__(self, vectors: list[dict[int, float]], terms: int, block: int = BLOCK, rows: int = ROWS):
        # alike examples side by side give tight block bounds
        self.order = sorted(range(len(vectors)), key=lambda i: (sorted(
            vectors[i], key=lambda t: (-vectors[i][t], t)), i))
        self.order = np.array(self.order, np.int64)
        self.block, self.blocks = block, -(-len(vectors) // block)
        at = np.repeat(np.arange(len(vectors)), [len(vectors[i]) for i in self.order.tolist()])
        term = np.array([t for i in self.order.tolist() for t in vectors[i]], np.int64)
        weight = np.array([w for i in self.order.tolist() for w in vectors[i].values()], float)
        by = np.lexsort((at, term))
        small = np.int16 if len(self.order) < 1 << 15 else np.int32  # the index is sent to every task
        self.at, self.weights = at[by].astype(small), weight[by]
        self.starts = np.searchsorted(term[by], np.arange(terms + 1)).astype(np.int32)
        length = np.diff(self.starts)
        longest = np.argsort(-length, kind="stable")[:rows]
        self.long = np.sort(longest[length[longest] > len(vectors) // 16])
        self._table = None

    def __getstate__(self):
        return {**self.__dict__, "_table": None}

    @staticmethod
    def _ranges(first: np.ndarray, until: np.ndarray) -> np.ndarray:
        """The numbers of all ranges, one after the other."""
        n = until - first
        return np.arange(n.sum(), dtype=np.int32) + np.repeat(first - np.cumsum(n, dtype=np.int32) + n, n)

    def _rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each term's row or -1, the weights by block, example and row, and their maxima by block and row."""
        if self._table is None:
            row = np.full(len(self.starts) - 1, -1, np.int32)
            row[self.long] = np.arange(len(self.long))
            first, until = self.starts[self.long], self.starts[self.long + 1]
            i = self._ranges(first, until)
            table = np.zeros((self.blocks * self.block, len(self.long)))
            table[self.at[i], np.repeat(np.arange(len(self.long)), until - first)] = self.weights[i]
            table = table.reshape(self.blocks, self.block, len(self.long))
            self._table = row, table, table.max(axis=1)
        return self._table

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int,
               without: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """(example, product) of the k nearest with a common term; ties to the smaller example.

        Queries are pairs of terms and weights.  They are searched together, so
        that a block is read once for all that need it; QUERIES bounds how many.
        """
        if not self.blocks or not queries:
            return [[] for _ in queries]
        row, table, peaks = self._rows()
        read = np.zeros((len(queries), self.blocks * self.block))
        w = np.zeros((len(queries), len(self.long)))
        for q, (terms, weights) in enumerate(queries):
            rows = row[terms]
            short = rows < 0
            w[q, rows[~short]] = weights[~short]
            first, until = self.starts[terms[short]], self.starts[terms[short] + 1]
            i = self._ranges(first, until)
            read[q] = np.bincount(self.at[i], np.repeat(weights[short], until - first) * self.weights[i],
                                  read.shape[1])
        scores = read.copy()
        by_block = scores.reshape(len(queries), self.blocks, self.block)
        bounds = by_block.max(axis=2) + w @ peaks.T

        def add(wanted):  # by query and block
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                some = np.flatnonzero(wanted[:, b])
                by_block[some, b] += w[some] @ table[b].T

        def least():  # one more than k, as an example may be left out
            if k >= scores.shape[1]:
                return np.zeros((len(queries), 1))
            return np.partition(scores, -k - 1, axis=1)[:, [-k - 1]] * (1 - 1e-9)

        early = np.zeros(bounds.shape, bool)
        np.put_along_axis(early, np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST_BLOCKS], True, axis=1)
        add(early)
        add(~early & (bounds * (1 + 1e-9) >= least()))
        near = (scores > 0) & (scores >= least())
        found = []
        for q in range(len(queries)):
            hits = np.flatnonzero(near[q])
            # added up alike for each example, so that equal ones tie
            exact = read[q, hits] + (table.reshape(-1, len(self.long))[hits] * w[q]).sum(axis=1)
            best = sorted(zip((-exact).tolist(), self.order[hits].tolist(), strict=True))
            found.append([(i, -s) for s, i in best if without is None or i != without[q]][:k])
        return found

    def nearest(self, queries: list[dict[int, float]], k: int,
                without: list[int] | None = None) -> list[list[tuple[int, float]]]:
        pairs = [(np.array(sorted(q), np.int64), np.array([q[t] for t in sorted(q)], float)) for q in queries]
        return [near for at in range(0, len(pairs), QUERIES)
                for near in self.search(pairs[at:at + QUERIES], k, without and without[at:at + QUERIES])]


class Votes:
    """Labels of the examples, and the calibration of their votes."""

    def __init__(self, labels: list[tuple[int, int]], stands_for: dict[int, float]):
        self.ids = [i for i, _ in labels]
        self.labels = np.array([x for _, x in labels], float)
        self.mass = np.array([stands_for.get(x, 1.0) for _, x in labels])
        self.prior = float((self.labels * self.mass).sum() / self.mass.sum()) if len(labels) else 0.0
        self.rate, self.steps = self.prior, []

    def share(self, chosen: np.ndarray, prior: float) -> float:
        """Rate of label 1 among the chosen examples, with one more row at the prior."""
        m = self.mass * chosen
        return float(((self.labels * m).sum() + prior) / (m.sum() + 1))

    def calibrate(self, near: list[list[tuple[int, float]]]) -> None:
        """Steps from each example's neighbours among the others."""
        found = [(self.vote(x), i) for i, x in enumerate(near)]
        self.steps = self._isotonic([(x, self.labels[i], self.mass[i]) for x, i in found if x is not None])

    def _isotonic(self, points: list[tuple[float, float, float]]) -> list[tuple[float, float]]:
        """(vote, probability) at both ends of each pool of adjacent violators, with one row at the prior."""
        pools: list[list[float]] = []
        for x, y, m in sorted(points):
            if pools and pools[-1][1] == x:
                pools[-1][2] += y * m
                pools[-1][3] += m
            else:
                pools.append([x, x, y * m, m])
            while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
                _, x, y, m = pools.pop()
                pools[-1][1:] = [x, pools[-1][2] + y, pools[-1][3] + m]
        return [(x, float(y + self.prior) / float(m + 1)) for low, high, y, m in pools for x in (low, high)]

    def vote(self, near: list[tuple[int, float]]) -> float | None:
        """Share of label 1, each neighbour weighted by its mass and squared cosine.

        The rate of all examples weighs like one with PRIOR, so that far neighbours say little.
        """
        if not near:
            return None
        i = [e for e, _ in near]
        w = self.mass[i] * np.array([c for _, c in near]) ** 2
        prior = PRIOR * self.mass.mean()
        return float(((w * self.labels[i]).sum() + prior * self.prior) / (w.sum() + prior))

    def probability(self, near: list[tuple[int, float]]) -> float:
        vote = self.vote(near)
        if vote is None:
            return self.rate
        return float(np.interp(vote, [x for x, _ in self.steps], [p for _, p in self.steps]))  # between pools


class Model:
    """Weights, examples and calibration."""

    def __init__(self, factors: np.ndarray, examples: list[tuple[int, int, dict[int, int]]],
                 stands_for: dict[int, float], documents: int = 0, floor: float = 1.0, k: int = K):
        self.factors, self.documents, self.floor, self.k = factors, documents, floor, k
        self.votes = votes = Votes([e[:2] for e in examples], stands_for)
        vectors = [self.unit(e[2]) for e in examples]
        self.index = BlockMaxIndex(vectors, max(1, len(factors)))
        bare = np.array([not v for v in vectors], bool) if vectors else np.zeros(0, bool)
        both = len(set(votes.labels.tolist())) == 2
        if both:
            votes.rate = votes.share(bare, votes.prior)
            votes.calibrate(self.index.nearest(vectors, k, list(range(len(vectors)))))

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (1 + np.log(counts)) * self.factors[terms]

    def unit(self, counts: dict[int, int]) -> dict[int, float]:
        terms = sorted(counts)
        w = self.weigh(np.array(terms, np.int64), np.array([counts[t] for t in terms], float))
        norm = float(w @ w) ** 0.5
        return dict(zip(terms, (w / norm).tolist(), strict=True)) if norm else {}

    def products(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[list, float]]:
        """For terms and counts, the nearest examples with their products, and the share of the squared norm."""
        for at in range(0, len(queries), QUERIES):
            some = [(t, self.weigh(t, n)) for t, n in queries[at:at + QUERIES]]
            if not self.votes.steps:
                yield from (([], 0.0) for _ in some)
                continue
            found = self.index.search(some, self.k)
            yield from ((near, float(w @ w)) for near, (_, w) in zip(found, some, strict=True))


def idf(n, documents: int):
    return np.log((documents + 1) / (n + 1)) + 1


def _counted(docs: DataFrame, id_col: str, text_col: str, terms: list[str]) -> DataFrame:
    """(id, terms, counts, others, other_counts): each document's terms, those known by number, others by hash."""
    known = {t: i for i, t in enumerate(terms)}

    @F.pandas_udf("terms array<int>, counts array<int>, others array<string>, other_counts array<int>")
    def count(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            c = Counter(text_terms(text))
            number = np.fromiter(map(known.get, c, repeat(-1)), np.int32, len(c))
            n = np.fromiter(c.values(), np.int32, len(c))
            by = np.argsort(number, kind="stable")
            by = by[np.searchsorted(number[by], 0):]
            rows.append((number[by], n[by], list(compress(c, number < 0)), n[number < 0]))
        return pd.DataFrame(rows, columns=["terms", "counts", "others", "other_counts"])

    return (docs.select(F.col(f"`{id_col}`").alias("id"), count(text_or_empty(text_col)).alias("c"))
            .select("id", "c.terms", "c.counts", F.transform("c.others", lambda t: F.xxhash64(t)).alias("others"),
                    "c.other_counts"))


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many of a task's documents each term is."""
    n = np.zeros(0, np.int64)
    for b in batches:
        found = np.bincount(np.concatenate([np.zeros(0, np.int64), *b["terms"]]).astype(np.int64), minlength=len(n))
        found[:len(n)] += n
        n = found
    yield pd.DataFrame({"t": np.arange(len(n), dtype=np.int32), "n": n}).loc[n > 0]


def _examples(docs: DataFrame, train: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """Distinct terms and label of at most ``most`` training documents of each label.

    Near copies count once, with their mean label, lest a passage that was
    copied often pass for a sign of its label.
    """
    spark = docs.sparkSession
    h = F.xxhash64("id")
    chosen = train.where("label = 1").orderBy(h, "id").limit(most).unionByName(
        train.where("label = 0").orderBy(h, "id").limit(most))
    chosen = saved(chosen, "chosen_labels")  # at most 2 * most rows
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    @F.pandas_udf("array<string>")
    def distinct(column: pd.Series) -> pd.Series:
        return column.map(lambda t: sorted(set(text_terms(t))))

    found = saved(simhash.with_fingerprint(
        texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"]), "fp"), "labelled_texts")
    groups = simhash.fingerprint_groups(found.select("id", "fp"), "id").select("fp", "component_id")
    means = found.join(groups, "fp").groupBy("component_id").agg(
        (F.avg("label") >= 0.5).cast("int").alias("label"))
    one = found.select("id", "text").join(means.withColumnRenamed("component_id", "id"), "id")
    return saved(one.select("id", "label", "text", distinct("text").alias("terms")), "examples")


def _trust(a: np.ndarray, b: np.ndarray, pos: float, neg: float) -> tuple[np.ndarray, float]:
    """How far terms in ``a`` examples of label 1 and ``b`` of label 0 are trusted, and an unseen term."""
    total, both = pos + neg, a + b

    def part(seen, of):  # one cell of the terms' contingency tables
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((seen > 0) & (of > 0), seen * np.log(seen * total / of), 0.0)

    g2 = 2 * (part(a, both * pos) + part(b, both * neg)
              + part(pos - a, (total - both) * pos) + part(neg - b, (total - both) * neg))
    half = 2 * np.log(max(1, len(a))) + MARGIN
    sure = np.maximum(0, g2) + CHANCE
    return sure / (sure + half), CHANCE / (CHANCE + half)


def small_batches(spark) -> None:
    """Rows go to Python tasks ROWS_AT_ONCE at a time, so that their terms need little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> tuple[Model, DataFrame]:
    """The model, and the term counts (row, id, terms, counts, others, other_counts) of all documents."""
    small_batches(docs.sparkSession)
    train = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("id"))
             .agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))
    train = saved(train, "training_labels")
    rows = dict(train.groupBy("label").count().collect())  # one row for each label
    examples = _examples(docs, train, id_col, text_col, max_examples)
    held = dict(examples.groupBy("label").count().collect())
    pos, neg = float(held.get(1, 0)), float(held.get(0, 0))
    seen = (examples.select("label", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
            .orderBy("term").toArrow())  # the terms of at most 2 * max_examples texts
    terms = seen["term"].to_pylist()
    trust, floor = _trust(np.array(seen["a"], float), np.array(seen["b"], float), pos, neg)
    counted = saved(_counted(docs, id_col, text_col, terms)
                    .withColumn("row", F.monotonically_increasing_id()), "term_counts")
    found = counted.select("terms").mapInPandas(_document_counts, "t int, n long").groupBy("t").agg(
        F.sum("n").alias("n")).toArrow()  # a row for each known term
    df, n = np.zeros(len(terms)), counted.count()
    df[np.array(found["t"], np.int64)] = np.array(found["n"], float)
    sample = [(r["id"], r["label"], dict(zip(r["terms"], r["counts"], strict=True)))
              for r in _counted(examples, "id", "text", terms)
              .join(examples.select("id", "label"), "id").orderBy("id").collect()]
    mass = {x: rows.get(x, 0) / held[x] for x in held}
    return Model(idf(df, n) * trust, sample, mass, n, floor), counted


def _other_squares(model: Model, counted: DataFrame) -> DataFrame:
    """(row, square): the share of terms that no example has in a text's squared norm."""
    pairs = counted.select("row", F.inline(F.arrays_zip(
        F.col("others").alias("term"), F.col("other_counts").alias("count"))))
    df = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    weight = ((1 + F.ln("count")) * (F.ln((model.documents + 1) / (F.col("n") + 1)) + 1) * F.lit(model.floor))
    # added up in order, so that a repeated run gives the same sum
    return (pairs.join(df, "term").groupBy("row")
            .agg(F.array_sort(F.collect_list(weight * weight)).alias("squares"))
            .select("row", F.aggregate("squares", F.lit(0.0), lambda a, x: a + x).alias("square")))


def score(model: Model, counted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: the id, ``score``, ``predicted``, and the nearest examples with their cosines."""
    id_type = counted.schema["id"].dataType.simpleString()

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = list(model.products([(t.astype(np.int64), n.astype(float))
                                       for t, n in zip(b["terms"], b["counts"], strict=True)]))
            yield pd.DataFrame({
                "row": b["row"], "id": b["id"], "near": [[i for i, _ in near] for near, _ in out],
                "products": [[x for _, x in near] for near, _ in out], "known": [x for _, x in out]})

    votes = model.votes  # without the index

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            norm = np.sqrt(b["known"] + b["square"])
            out = [[(i, min(1.0, x / z)) for i, x in zip(near.tolist(), xs.tolist(), strict=True)]
                   for near, xs, z in zip(b["near"], b["products"], norm, strict=True)]
            scores = [votes.probability(near) for near in out]
            yield pd.DataFrame({
                "id": b["id"], "score": scores, "predicted": [int(s >= 0.5) for s in scores],
                "neighbours": [[votes.ids[i] for i, _ in near] for near in out],
                "cosines": [[c for _, c in near] for near in out]})

    near = counted.select("row", "id", "terms", "counts").mapInPandas(
        searched, f"row long, id {id_type}, near array<int>, products array<double>, known double")
    return (near.join(_other_squares(model, counted), "row", "left").na.fill(0.0, ["square"])
            .mapInPandas(scored, f"id {id_type}, score double, predicted int, "
                                 "neighbours array<long>, cosines array<double>")
            .withColumnRenamed("id", id_col))
