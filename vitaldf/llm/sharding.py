"""Sharding: minimax contiguous partition of ordered atomic groups.

Documents with equal texts form an atomic group, and groups are ordered by a
hash of the text.  The smallest capacity with which filling shards greedily
in that order needs no more than the given number of shards is found by
binary search, and the shards are cut there.

The group sizes stay distributed.  The search sees block sums over ranges of
the hash; where the position of a cut inside a block decides, those blocks
alone are summed up again, FINER ranges at a time, until single groups show.
Every capacity is checked greedily with lower and upper bounds of the cuts,
so the answer is exact, and the driver holds a bounded number of sums
however many groups there are.

All of it is DataFrame functions.  Nulls and edge cases: a null text has no
bytes and groups with empty texts; each document counts ``OVERHEAD`` bytes
more, so no group is empty.  Ids may be null or repeated: slots number rows.
An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitaldf.llm.common import n_blocks, saved, text_or_empty

SHARDS = 24
OVERHEAD = 8
#: log2 of the hash ranges that a block is cut into
FIRST, FINER = 12, 8
#: rows of a block that is numbered in one go, if one shard held all
SLOT_ROWS = 1024
_BITS = 64


def _prefix(h: Column, bits: int) -> Column:
    """The first ``bits`` bits of a signed 64-bit hash, in the hash's order."""
    return F.shiftright(h, _BITS - bits)


class _Ruler:
    """Sums over ordered ranges of the hash, some of them single groups.

    ``marks`` holds (bits, prefix, sum, groups, smallest hash), in order.
    """

    def __init__(self, marks: list[tuple[int, int, int, int, int]]):
        self.marks = marks
        self.ends, total = [0], 0
        for m in marks:
            total += m[2]
            self.ends.append(total)
        self.total = total

    def reach(self, at: int, capacity: int) -> tuple[int, int]:
        """Bounds of the end of a shard that starts at ``at``."""
        to = at + capacity
        i = bisect_right(self.ends, to) - 1
        if i >= len(self.marks):
            return self.total, self.total
        return self.ends[i], (self.ends[i] if self.marks[i][3] == 1 else to)

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of where each shard ends when filled greedily."""
        low = high = 0
        found = []
        for _ in range(shards):
            low, high = self.reach(low, capacity)[0], self.reach(high, capacity)[1]
            found.append((low, high))
        return found

    def smallest(self, least: int, most: int, ok) -> int:
        while least < most:
            mid = (least + most) // 2
            least, most = (least, mid) if ok(mid) else (mid + 1, most)
        return least


def capacity_and_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """Smallest greedy capacity, and the first hash of each shard but the first.

    ``groups`` has the hash ``h`` (long) and ``size``, one row a group.  A shard
    that stays empty has no entry.
    """
    def sums(df: DataFrame, bits: int, width: int) -> list[tuple]:
        rows = (df.groupBy(_prefix(F.col("h"), bits).alias("p"))
                .agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), F.min("h").alias("first"))
                .collect())  # at most 2 ** width rows for each range that is cut
        return [(bits, r["p"], int(r["s"]), int(r["n"]), r["first"]) for r in rows]

    marks = sorted(sums(groups, FIRST, FIRST), key=lambda m: m[4])
    if not marks:
        return 0, []
    while True:
        ruler = _Ruler(marks)
        floor = -(-ruler.total // shards)
        surely = ruler.smallest(floor, ruler.total, lambda c: ruler.cuts(c, shards)[-1][0] >= ruler.total)
        perhaps = ruler.smallest(floor, surely, lambda c: ruler.cuts(c, shards)[-1][1] >= ruler.total)
        # where a cut may fall for a capacity that is still possible
        spans = list(zip((x for x, _ in ruler.cuts(perhaps, shards)),
                         (y for _, y in ruler.cuts(surely, shards)), strict=True))
        coarse = [m for i, m in enumerate(marks) if m[3] > 1
                  and any(a < ruler.ends[i + 1] and ruler.ends[i] < b for a, b in spans if a < b)]
        if not coarse:
            break
        finer: list[tuple] = []
        for bits in sorted({m[0] for m in coarse}):
            inside = _prefix(F.col("h"), bits).isin([m[1] for m in coarse if m[0] == bits])
            finer += sums(groups.where(inside), min(bits + FINER, _BITS), FINER)
        gone = {m[:2] for m in coarse}
        marks = sorted([m for m in marks if m[:2] not in gone] + finer, key=lambda m: m[4])
    starts, at = [], 0
    for _ in range(shards - 1):
        at = ruler.reach(at, surely)[0]
        if at < ruler.total:
            starts.append(marks[bisect_right(ruler.ends, at) - 1][4])
    return surely, starts


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: the id, ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0, gapless).

    Copies of one text share a shard however many they are.  Slots number
    the rows of a shard block by block of hashed ids; a block's first slot is
    a running sum of block counts.
    """
    text = text_or_empty(text_col)
    light = saved(docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")), "sizes")
    groups = saved(light.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    _, starts = capacity_and_cuts(groups, shards)
    number = sum([(F.col("h") >= F.lit(s)).cast("int") for s in starts], F.lit(0))
    blocks = n_blocks(light.count(), SLOT_ROWS)
    placed = light.withColumn("shard", number).withColumn(
        "block", F.pmod(F.xxhash64(id_col, "h", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    placed = saved(placed, "placed")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy(id_col, "h", "size"))
    return (placed.withColumn("rank", rank).join(firsts, ["shard", "block"])
            .select(id_col, "size", "text_crc32", "shard",
                    (F.col("first") + F.col("rank") - 1).cast("bigint").alias("slot")))
