"""SimHash near-duplicate groups, found with sharded BK-trees.

A fingerprint has 64 bits; two fingerprints link when at most ``radius`` bits
differ.  Cut into ``radius + k`` blocks of bits, linked fingerprints agree on
``k`` whole blocks at least (pigeonhole), so each fingerprint is dealt to one
shard for every choice of ``k`` blocks, and no link is lost.  Each shard is a
BK-tree: children keyed by their integer Hamming distance to the parent, and
a search follows only the edges within the radius.  ``k`` follows from the
number of fingerprints, so that a shard stays small as the corpus grows.

A shard with more than ``tree_rows`` fingerprints is cut into several trees,
and its fingerprints are sent to each tree before their own.  A tree emits
the links that join its fingerprints into groups, never all pairs.

Nulls and edge cases: a null text counts as empty, and an empty one has
fingerprint zero.  Rows with equal fingerprints are linked, repeated rows
included.  A null ``doc_id`` takes part in links but names no group unless
no member has an id (the group's id is then null).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import free_name, saved, text_or_empty

FINGERPRINT_BITS = 64
HASH_SEED = 42
SHINGLE_WORDS = 4
RADIUS = 4
#: fingerprints of one tree; a larger shard is cut into several trees
TREE_ROWS = 2048
#: mean fingerprints in a shard, above which another block joins the key
SHARD_MEAN = 64
_HASHES_AT_ONCE = 1 << 16


def _shingles(text: str, words: int) -> list[bytes]:
    """Lower-cased (A-Z) ASCII-space-separated words, ``words`` at a time."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    joined = b" ".join(found)
    lens = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: len(found) - words + 1].tolist()
    return [joined[a:b] for a, b in zip(starts, ends[words - 1:].tolist(), strict=True)]


def text_fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bit i is 1 if set in over half the shingle hashes; no shingle: 0."""
    shingles = _shingles(text or "", words)
    if not shingles:
        return 0
    digest = partial(xxhash.xxh64_digest, seed=HASH_SEED)
    ones = np.zeros(FINGERPRINT_BITS, np.int64)
    for at in range(0, len(shingles), _HASHES_AT_ONCE):
        part = shingles[at:at + _HASHES_AT_ONCE]
        raw = np.frombuffer(b"".join(map(digest, part)), np.uint8).reshape(len(part), 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(shingles))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, out: str, text_col: str = "text",
                     words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with a signed 64-bit SimHash column ``out``."""
    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, words) for t in texts], dtype="int64")

    return docs.withColumn(out, fingerprint(text_or_empty(text_col)))


def fingerprint_hex(col: str):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def block_masks(rows: int, radius: int = RADIUS) -> list[int]:
    """Signed bit masks, one for each choice of blocks that linked fingerprints may share."""
    agree = 1
    while agree < radius and rows >> (FINGERPRINT_BITS * agree // (radius + agree)) > SHARD_MEAN:
        agree += 1
    blocks = radius + agree
    cuts = [FINGERPRINT_BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class BKTree:
    """BK-tree over 64-bit integers that also keeps the groups of linked nodes."""

    def __init__(self, radius: int):
        self.radius = radius
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []
        self.groups = 0

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def linked(self, value: int) -> list[int]:
        """One node of each group that holds a node within the radius."""
        found: list[int] = []
        if not self.nodes:
            return found
        radius, nodes, children = self.radius, self.nodes, self.children
        roots: set[int] = set()
        stack = [0]
        while stack:
            i = stack.pop()
            d = (value ^ nodes[i]).bit_count()
            if d <= radius and (root := self.find(i)) not in roots:
                roots.add(root)
                found.append(i)
                if len(roots) == self.groups:
                    break
            for step, child in children[i].items():
                if -radius <= step - d <= radius:
                    stack.append(child)
        return found

    def join(self, members: list[int]) -> None:
        roots = sorted({self.find(i) for i in members})
        for r in roots[1:]:
            self.parent[r] = roots[0]
        self.groups -= len(roots) - 1

    def insert(self, value: int) -> int:
        new = len(self.nodes)
        if new:
            i = 0
            while True:
                step = (value ^ self.nodes[i]).bit_count()
                if (child := self.children[i].get(step)) is None:
                    self.children[i][step] = new
                    break
                i = child
        self.nodes.append(value)
        self.children.append({})
        self.parent.append(new)
        self.groups += 1
        return new


def _tree_links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links within each run of rows with one shard and tree (tree rows come first)."""
    at, tree = None, BKTree(radius)
    for batch in batches:
        src: list[int] = []
        dst: list[int] = []
        for shard, key, sub, asks, fp in zip(*(batch[c].tolist() for c in (
                "shard", "key", "sub", "asks", "fp")), strict=True):
            if (shard, key, sub) != at:
                at, tree = (shard, key, sub), BKTree(radius)
            near = tree.linked(fp & 0xFFFFFFFFFFFFFFFF)
            for i in near:
                dst.append(tree.nodes[i])
            src.extend([fp] * len(near))
            if asks:
                tree.join(near)
            else:
                tree.join([*near, tree.insert(fp & 0xFFFFFFFFFFFFFFFF)])
        signed = np.array(dst, np.uint64).astype(np.int64)
        yield pd.DataFrame({"src": np.array(src, np.int64), "dst": signed})


def near_links(fps: DataFrame, rows: int, radius: int = RADIUS,
               tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links (src, dst) that join all distinct ``fp`` within ``radius`` bits into their groups."""
    masks = block_masks(rows, radius)
    keys = F.array(*[F.struct(F.lit(i).alias("shard"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks)])
    dealt = fps.select("fp", F.inline(keys))
    large = (dealt.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > tree_rows)
             .select("shard", "key", F.ceil(F.col("n") / tree_rows).cast("int").alias("trees")))
    dealt = dealt.join(large, ["shard", "key"], "left").withColumn(
        "sub", F.pmod(F.xxhash64("fp"), F.coalesce("trees", F.lit(1))).cast("int"))
    own = dealt.select("shard", "key", "sub", F.lit(0).alias("asks"), "fp")
    asks = dealt.where(F.col("sub") > 0).select(
        "shard", "key", F.explode(F.sequence(F.lit(0), F.col("sub") - 1)).alias("sub"),
        F.lit(1).alias("asks"), "fp")
    where = ["shard", "key", "sub"]
    rows_by_tree = own.unionByName(asks).repartition(*where).sortWithinPartitions(*where, "asks", "fp")
    return rows_by_tree.mapInPandas(partial(_tree_links, radius=radius),
                                    "src bigint, dst bigint").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of a link.

    Alternates large-star and small-star steps until the links are stars
    around each group's smallest node; each round is written to the shared
    folder.  A step joins links with the smallest neighbour of each node, so
    a node with very many links is never gathered in one row.
    """
    def state(df):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        return r[0], r[1]

    now = saved(links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                .where(F.col("u") != F.col("v")).distinct(), name)
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
            .where(F.col("u") != F.col("v")).distinct())
        now = saved(small, name)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_groups(prints: DataFrame, id_col: str, radius: int = RADIUS,
                       tree_rows: int = TREE_ROWS) -> DataFrame:
    """(fp, root, component_id) for every distinct ``fp`` of ``prints``.

    ``root`` names the group by its smallest fingerprint, ``component_id`` by
    the smallest id of its documents.
    """
    fps = saved(prints.groupBy("fp").agg(F.min(id_col).alias("low_id")), "fingerprints")
    labels = components(near_links(fps.select("fp"), fps.count(), radius, tree_rows))
    rooted = (fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    names = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    return rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (hex), ``component_id``."""
    prints = saved(with_fingerprint(docs.select(id_col, text_col), "fp", text_col, words)
                   .select(id_col, "fp"), "prints")
    groups = fingerprint_groups(prints, id_col, radius, tree_rows).select("fp", "component_id")
    return prints.join(groups, "fp").select(
        id_col, fingerprint_hex("fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = SHINGLE_WORDS, radius: int = RADIUS,
                         tree_rows: int = TREE_ROWS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id.

    Among rows with that id (or with none) the first read stays.  Other
    columns, whatever their names, pass through.
    """
    fp, row = free_name(docs, "fp"), free_name(docs, "row")
    kept = saved(with_fingerprint(docs, fp, text_col, words)
                 .withColumn(row, F.monotonically_increasing_id()), "hashed")
    prints = kept.select(F.col(f"`{id_col}`").alias("id"), F.col(fp).alias("fp"),
                         F.col(row).alias("row"))
    groups = fingerprint_groups(prints, "id", radius, tree_rows).select("fp", "root")
    first = (prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
             .join(groups, "fp").groupBy("root").agg(F.min("first").alias("first"))
             .select(F.col("first.row").alias(row)))
    return kept.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
