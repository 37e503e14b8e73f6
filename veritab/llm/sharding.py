"""Sharding by minimax contiguous partition (operator 3), with DataFrame operations only.

Equal texts form one atomic group; groups stand in the order of a 64-bit hash of their text.  The smallest capacity at
which the ordered groups still fit into the wished number of contiguous shards is found by binary search with a greedy
check.  The driver never sees the groups: it holds sums over at most some ten thousand ranges of the hash, and asks for
finer sums only where a cut may fall.  Cuts where the greedy check ends its shards would leave the last shards short or
empty, all the more where one group is large; so within that capacity, which no shard exceeds, the cuts are spread as
evenly as the groups allow.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.frames import written

#: Ranges of the hash that are summed first: 2 ** FIRST_BITS.  A range is split into FINER when a cut may fall in it.
FIRST_BITS = 14
FINER = 256
#: monotonically_increasing_id() holds the partition above this bit, the row below.
ROW_BITS = 33


class OrderedGroups:
    """Sums of group sizes over ranges of the group key, finer where asked for.

    A range is (lowest key, highest key, sum); with one key it is an atomic group.
    """

    def __init__(self, rows: DataFrame, key: str, size: str):
        self.rows, self.key, self.size = rows, key, size
        first = F.shiftright(F.col(key), 64 - FIRST_BITS)
        self._take(self._sums(rows, [first.alias("part")]))

    def _sums(self, rows: DataFrame, parts: list[Column]) -> list[tuple[int, int, int]]:
        found = rows.groupBy(*parts).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.sum(self.size).alias("total")).collect()
        return [(r["low"], r["high"], r["total"]) for r in found]

    def _take(self, ranges: Iterable[tuple[int, int, int]]) -> None:
        self.ranges = sorted(ranges)
        self.start = [0]
        for _, _, total in self.ranges:
            self.start.append(self.start[-1] + total)
        self.total = self.start[-1]

    def largest_atom(self) -> int:
        return max((t for low, high, t in self.ranges if low == high), default=0)

    def atomic(self, i: int) -> bool:
        return self.ranges[i][0] == self.ranges[i][1]

    def at(self, position: float) -> int:
        """The range that holds a position of the cumulated sizes; one that starts there, if any."""
        return min(bisect_right(self.start, position) - 1, len(self.ranges) - 1)

    def refine(self, wanted: Iterable[int]) -> None:
        """Split these ranges, by one pass over the rows of them all."""
        wanted = sorted(set(wanted))
        split = [self.ranges[i] for i in wanted]
        key = F.col(self.key)
        inside, part, width = F.lit(False), F.lit(0), F.lit(1)
        for n, (low, high, _) in enumerate(split):
            here = key.between(low, high)
            inside = inside | here
            part = F.when(here, n * FINER + F.floor((key - low) / max(1, (high - low) // FINER + 1))).otherwise(part)
        finer = self._sums(self.rows.filter(inside), [part.alias("part")])
        gone = set(wanted)
        self._take([r for i, r in enumerate(self.ranges) if i not in gone] + finer)

    def fits(self, capacity: int, shards: int) -> bool:
        """Whether greedy filling needs no more than so many shards."""
        while True:
            hopeful, touched = self._fill(capacity, shards, True)
            if not hopeful:
                return False
            careful, more = self._fill(capacity, shards, False)
            if careful:
                return True
            if not touched | more:
                return hopeful
            self.refine(touched | more)

    def _fill(self, capacity: int, shards: int, hopeful: bool) -> tuple[bool, set[int]]:
        """Greedy filling, taking each cut inside a range that isn't atomic at its best or at its worst place."""
        position, touched = 0, set()
        for _ in range(shards):
            if position + capacity >= self.total:
                return True, touched
            i = self.at(position + capacity)
            if self.start[i] == position + capacity or self.atomic(i):
                cut = self.start[i]
            else:
                touched.add(i)
                cut = position + capacity if hopeful else self.start[i]
            if cut <= position:
                return False, touched
            position = cut
        return position >= self.total, touched

    def smallest_capacity(self, shards: int) -> int:
        low, high = max(self.largest_atom(), -(-self.total // shards)), self.total
        while low < high:
            middle = (low + high) // 2
            if self.fits(middle, shards):
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Positions where shards 1, 2, ... begin: near equal shares of what is left, and none over the capacity."""
        while True:
            touched: set[int] = set()
            earliest = [0] * shards + [self.total]
            for s in range(shards - 1, 0, -1):
                position = max(0, earliest[s + 1] - capacity)
                i = self.at(position)
                if self.start[i] != position:
                    if not self.atomic(i):
                        touched.add(i)
                    position = self.start[i + 1]
                earliest[s] = position
            cuts, begin = [], 0
            for s in range(1, shards):
                wish = begin + (self.total - begin) / (shards - s + 1)
                i = self.at(wish)
                if not self.atomic(i) and self.start[i] != wish:
                    touched.add(i)
                near = min((self.start[i], self.start[i + 1]), key=lambda p: abs(p - wish))
                choices = [p for p in (near, self.start[i], self.start[i + 1]) if earliest[s] <= p <= begin + capacity and p >= begin]
                begin = choices[0] if choices else max(begin, earliest[s])
                cuts.append(begin)
            if not touched:
                return cuts
            self.refine(touched)

    def key_at(self, position: int) -> int | None:
        """The lowest key of the groups from a position on; none at the end."""
        return self.ranges[self.at(position)][0] if position < self.total else None


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, group_key, shard and slot of every row, by law `bytes`.

    A size is the text's bytes in UTF-8 plus 8; a null text counts as an empty one.  Rows with equal texts share a
    shard.  Slots run from 0 without gaps in each shard, in the order of (group_key, key, text_crc32), nulls first;
    rows equal in these are interchangeable.  An empty table gives no rows; with fewer groups than shards some shards
    stay empty.
    """
    blank = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(blank) + 8).cast("long").alias("size"),
            F.crc32(blank.cast("binary")).alias("text_crc32"),
            F.xxhash64(blank).alias("group_key"),
        )
        .repartitionByRange("group_key", "doc_id", "text_crc32")
        .sortWithinPartitions("group_key", "doc_id", "text_crc32")
        .withColumn("place", F.monotonically_increasing_id()),
        "shard-rows",
    )
    groups = OrderedGroups(rows.select("group_key", "size"), "group_key", "size")
    shard = F.lit(0)
    if groups.ranges:
        capacity = groups.smallest_capacity(shards)
        for position in groups.even_cuts(capacity, shards):
            first = groups.key_at(position)
            if first is not None:
                shard = shard + (F.col("group_key") >= first).cast("int")
            # an empty shard at the end begins nowhere
    placed = rows.select("*", shard.alias("shard"), F.shiftright("place", ROW_BITS).alias("part"), F.col("place").bitwiseAND((1 << ROW_BITS) - 1).alias("row"))
    runs = placed.groupBy("part", "shard").agg(F.min("row").alias("first_row"), F.count("*").alias("n"))
    # one row for each partition and each cut: no more than partitions plus shards
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("part", "shard", "first_row", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("earlier"))
    return placed.join(before, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", "group_key", "shard", (F.col("row") - F.col("first_row") + F.col("earlier")).alias("slot")
    )
