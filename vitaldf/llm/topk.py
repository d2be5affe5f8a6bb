"""Exact top-k search with a pivot-distance index.

The score is the integer inner product of quantized vectors.  With one more
coordinate, sqrt(M - |v|^2) where M is the largest squared norm (0 for a
query), a larger inner product is a smaller Euclidean distance, so the
triangle inequality holds.  Each vector is keyed by its nearest pivot and its
distance to it; each pivot's vectors, sorted by distance, are cut into annuli
of at most ``annulus_rows``.  |d(query, pivot) - d(vector, pivot)| bounds a
distance from below.

A query first searches the annuli nearest to it by that bound, until they
hold k candidates or more; its k-th distance is then a limit.  It expands to
just those annuli whose bound is within the limit and stops there.  The search of an annulus
computes exact integer products in blocks of queries.

A pivot that is nearest to a third of the vectors has many annuli, each a
task's row group of its own.  Pivots come from a bounded sample; all vectors
are indexed and the results exact for any pivots.

Nulls and edge cases: vectors that are null, or hold a null or non-finite
component, take no part, nor do rows with a null id.  Nor do vectors whose
squared norm, quantized, is 2**62 or more (a component of 1e300): their
scores need not fit a long, and all others' do.  Shorter vectors count
as padded with zeros.  A repeated id is a candidate row each time; a query's
own id never is its candidate, and a repeated query id is searched once for
its smallest vector.  Fewer candidates than k are all returned, and an empty
table gives none.  Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import n_blocks, saved

SCALE = 1024
K = 10
PIVOTS = 32
#: vectors from which the pivots are chosen
PIVOT_SAMPLE = 2048
ANNULUS_ROWS = 2048
#: queries that one task searches in one annulus
QUERY_BLOCK = 2048
#: annuli of one pivot; a fuller one is dealt over parts
RINGS = 64
#: squared norms below this keep inner products within a long
NORM_LIMIT = 2.0 ** 62
#: room for rounding in bounds, as a share of the largest norm
_ROOM = 1e-6


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """Components as floor(scale * x) with x as double; null if the vector takes no part."""
    x = vector.cast("array<double>")
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0 ** 31 / scale))
    v = F.when(good, F.transform(x, lambda c: F.floor(c * float(scale))))
    return F.when(_square(v) < NORM_LIMIT, v)


def _square(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def choose_pivots(vectors: DataFrame, dim: int, pivots: int = PIVOTS) -> np.ndarray:
    """Farthest-first pivots among the PIVOT_SAMPLE vectors with the smallest hashes."""
    rows = vectors.orderBy(F.xxhash64("id", "v")).limit(PIVOT_SAMPLE).select("v").collect()
    sample = _matrix([r["v"] for r in rows], dim).astype(float)
    if not len(sample):
        return sample
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < pivots and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _lifted(m: np.ndarray, top: int) -> np.ndarray:
    x = m.astype(float)
    rest = np.maximum(top - (x * x).sum(1), 0)
    return np.column_stack([x, np.sqrt(rest)])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in pivots], axis=1))


def _keyed(batches: Iterator[pd.DataFrame], pivots: np.ndarray, top: int) -> Iterator[pd.DataFrame]:
    dim = pivots.shape[1] - 1
    for b in batches:
        d = _distances(_lifted(_matrix(b["v"].tolist(), dim), top), pivots)
        near = d.argmin(1)
        yield b.assign(pivot=near.astype(np.int32), dist=d[np.arange(len(b)), near])


def build_index(vectors: DataFrame, pivots: np.ndarray, top: int,
                annulus_rows: int = ANNULUS_ROWS) -> tuple[DataFrame, pd.DataFrame]:
    """The vectors with their (pivot, ring, part), and the rings: at most PIVOTS * RINGS rows.

    Rings are cut at approximate quantiles of a pivot's distances, so no task
    sorts all of its vectors.  A ring that holds more than ``annulus_rows``
    (equal distances, or very many vectors) is dealt over parts by hash.
    """
    keyed = saved(vectors.mapInPandas(partial(_keyed, pivots=_lifted(pivots, top), top=top),
                                      "id long, v array<bigint>, pivot int, dist double"), "keyed_vectors")
    quantiles = F.array(*[F.lit(i / RINGS) for i in range(1, RINGS)])
    sizes = keyed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"),
                                       F.percentile_approx("dist", quantiles, 20 * RINGS).alias("cuts"))
    rings = F.least(F.ceil(F.col("n") / annulus_rows), F.lit(RINGS))
    at = F.size(F.filter("cuts", lambda c: c < F.col("dist")))
    # one row for each pivot, so the broadcast is bounded
    placed = saved(keyed.join(F.broadcast(sizes), "pivot").select(
        "id", "v", "pivot", "dist", F.floor(at * rings / RINGS).cast("int").alias("ring")), "rings")
    meta = placed.groupBy("pivot", "ring").agg(
        F.min("dist").alias("low"), F.max("dist").alias("high"), F.count(F.lit(1)).alias("n"))
    table = pd.DataFrame([r.asDict() for r in meta.collect()], columns=["pivot", "ring", "low", "high", "n"])
    table["parts"] = -(-table["n"] // annulus_rows)
    return placed, table


def _bounds(queries: np.ndarray, rings: pd.DataFrame, pivots: np.ndarray, top: int) -> np.ndarray:
    """Lower bounds of the distance from each query to each ring (queries have no lift)."""
    lifted = np.column_stack([queries.astype(float), np.zeros(len(queries))])
    d = _distances(lifted, pivots)[:, rings["pivot"].to_numpy()]
    gap = np.maximum(rings["low"].to_numpy() - d, d - rings["high"].to_numpy())
    return np.maximum(gap - _ROOM * np.sqrt(top + 1), 0)


def _routed(batches: Iterator[pd.DataFrame], rings: pd.DataFrame, pivots: np.ndarray, top: int,
            least: int) -> Iterator[pd.DataFrame]:
    """Rows (id, v, pivot, ring, part) for the rings that each query visits now.

    With a ``limit`` column: the rings that the first visit left out and whose
    bound is within the limit; a null limit sets none.
    """
    lifted, n = _lifted(pivots, top), rings["n"].to_numpy()
    for b in batches:
        if b.empty:
            continue
        bounds = _bounds(_matrix(b["v"].tolist(), pivots.shape[1]), rings, lifted, top)
        order = np.argsort(bounds, axis=1, kind="stable")
        before = np.cumsum(n[order], axis=1) - n[order]
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, order, before < least, axis=1)
        if "limit" in b:
            limit = b["limit"].astype(float).fillna(np.inf).to_numpy()[:, None]
            first = ~first & (bounds <= limit)
        q, r = np.nonzero(first)
        parts = rings["parts"].to_numpy()[r]
        q, r = np.repeat(q, parts), np.repeat(r, parts)
        part = np.arange(len(r)) - np.repeat(np.cumsum(parts) - parts, parts)
        yield pd.DataFrame({"id": b["id"].to_numpy()[q], "v": b["v"].to_numpy()[q],
                            "pivot": rings["pivot"].to_numpy()[r].astype(np.int32),
                            "ring": rings["ring"].to_numpy()[r].astype(np.int32),
                            "part": part.astype(np.int32)})


def _searched(key, queries: pd.DataFrame, rows: pd.DataFrame, dim: int, k: int,
              exact: bool) -> pd.DataFrame:
    """The k best rows of one annulus for each of a block of queries."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(queries) and len(rows):
        ids = rows["id"].to_numpy()
        # sums of products stay below 2 ** 53, which doubles hold exactly
        kind = np.float64 if exact else np.int64
        scores = (_matrix(queries["v"].tolist(), dim).astype(kind)
                  @ _matrix(rows["v"].tolist(), dim).astype(kind).T).astype(np.int64)
        for q, s in zip(queries["id"].tolist(), scores, strict=True):
            mine = np.flatnonzero(ids != q)
            if len(mine) > k:
                kth = np.partition(s[mine], len(mine) - k)[len(mine) - k]
                mine = mine[s[mine] >= kth]
            best = mine[np.lexsort((ids[mine], -s[mine]))][:k]
            out["query_id"] += [q] * len(best)
            out["vec_id"] += ids[best].tolist()
            out["score"] += s[best].tolist()
    return pd.DataFrame(out, dtype="int64")


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query, in a struct array: at most k of each annulus come in."""
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id"))), 1, k)
    return hits.groupBy("query_id").agg(best.alias("best"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS,
          annulus_rows: int = ANNULUS_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for each of ``queries`` against all ``vectors``."""
    spark = vectors.sparkSession

    def taken(df):
        q = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      quantized(F.col(f"`{vector_col}`"), scale).alias("v"))
        return q.where(F.col("id").isNotNull() & F.col("v").isNotNull())

    rows = saved(taken(vectors), "vectors")
    dim, norm, n = rows.agg(F.max(F.size("v")), F.max(_square(F.col("v"))), F.count(F.lit(1))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = saved(taken(queries).groupBy("id").agg(F.min("v").alias("v")), "queries")
    blocks = n_blocks(asked.count(), QUERY_BLOCK)
    top = int(norm)
    points = choose_pivots(rows, dim, pivots)
    index, rings = build_index(rows, points, top, annulus_rows)
    parts = F.create_map(*[F.lit(x) for p, r, m in zip(rings["pivot"], rings["ring"], rings["parts"],
                                                       strict=True) if m > 1
                           for x in (f"{p}-{r}", int(m))] or [F.lit(""), F.lit(1)])
    where = F.concat_ws("-", "pivot", "ring")
    index = index.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.coalesce(
        F.try_element_at(parts, where), F.lit(1))).cast("int"))

    def search(df, schema="id long, v array<bigint>, pivot int, ring int, part int"):
        pairs = saved(df.mapInPandas(partial(_routed, rings=rings, pivots=points, top=top,
                                             least=max(k + 1, annulus_rows)), schema)
                      .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "routes")
        at = ["pivot", "ring", "part", "block"]
        needed = index.join(pairs.select(*at).distinct(), at[:3])
        needed = needed.toDF(*needed.columns)  # as a frame of its own beside the pairs
        return (pairs.groupBy(*at).cogroup(needed.groupBy(*at))
                .applyInPandas(lambda key, q, x: _searched(key, q, x, dim, k, norm < 2.0 ** 53),
                               "query_id long, vec_id long, score long"))

    first = saved(_top(search(asked), k), "first_visits")
    own = _square(F.col("v"))
    kth = F.when(F.size("best") >= k, -F.try_element_at("best", F.lit(k))["low"])
    # the distance of the k-th so far, with room for rounding
    limit = F.sqrt(F.greatest(F.lit(0.0), own + float(top) - 2.0 * kth)) + _ROOM * (top + 1) ** 0.5
    rest = asked.join(first.withColumnRenamed("query_id", "id"), "id", "left").select(
        "id", "v", limit.alias("limit"))
    found = first.select("query_id", F.inline("best")).select("query_id", "vec_id", (-F.col("low")).alias("score"))
    return (_top(found.unionByName(search(rest)), k).select("query_id", F.posexplode("best").alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.low")).alias("score")))
