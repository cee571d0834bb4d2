"""Minimax contiguous partition into shards, in DataFrame functions only.

Documents of equal text form one group, which no cut divides. Groups stand in the order of their SHA-256, and the
smallest capacity for which cutting greedily gives at most the wanted number of shards is found by search: each pass
tries ``TRIES`` capacities at once (that many halvings' worth) and follows all their cuts side by side. A cut is one
look-up of the last group end not beyond a target. Digests spread evenly over ``BLOCKS`` blocks, so a look-up reads the
groups of one block, and the driver holds one number per block, never the groups.

Defined cases: null text is its own group, of size 1 per row and crc32 0; an empty text has size 1; a group larger than
an even share is a shard by itself; repeated rows are counted and placed one by one; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resalelake.llm.common import free_name, written

SHARDS = 16
#: Leading hex digits of a digest that name its block, and so the number of blocks the driver keeps a total of.
BLOCK_DIGITS = 3
BLOCKS = 16**BLOCK_DIGITS
TRIES = 255
#: Parts of a shard that are numbered apart, and whose counts (SHARDS x SLOT_PARTS rows) are broadcast.
SLOT_PARTS = 256


def digest() -> Column:
    return F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.repeat(F.lit("0"), 64))


def size() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1


class Groups:
    """Group sizes in digest order with the end of each group, and the totals of the blocks."""

    def __init__(self, sized: DataFrame):
        in_block = Window.partitionBy("block").orderBy("digest")
        self.table = written(
            sized.groupBy("digest")
            .agg(F.sum("size").alias("bytes"))
            .withColumn("block", F.conv(F.substring("digest", 1, BLOCK_DIGITS), 16, 10).cast("int"))
            .withColumn("end", F.sum("bytes").over(in_block))
            .select("block", "digest", "bytes", "end"),
            "shard-groups",
        )
        totals = self.table.groupBy("block").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).collect()  # BLOCKS rows at most
        by_block = {r.block: r for r in totals}
        self.starts = [0]
        for block in range(BLOCKS):
            self.starts.append(self.starts[-1] + (by_block[block].bytes if block in by_block else 0))
        self.total = self.starts.pop()
        self.largest = max((r.most for r in totals), default=0)

    def _points(self, targets: list[int]) -> DataFrame:
        """(number, block, place within the block) of targets; TRIES rows at most."""
        rows = []
        for n, target in enumerate(targets):
            block = bisect_right(self.starts, target) - 1
            rows.append(f"({n}, {block}, {target - self.starts[block]}L)")
        spark: SparkSession = self.table.sparkSession
        return spark.sql("SELECT * FROM VALUES " + ", ".join(rows) + " AS t(n, block, place)")

    def ends_within(self, targets: list[int]) -> list[int]:
        """For each target below the total, the last group end not beyond it."""
        points = self._points(targets)
        found = (
            self.table.where(F.col("block").isin([r.block for r in points.select("block").distinct().collect()]))
            .join(F.broadcast(points), "block")
            .where("end <= place")
            .groupBy("n")
            .agg(F.max("end").alias("end"))
            .collect()
        )
        best = {r.n: r.end for r in found}
        out = []
        for n, target in enumerate(targets):
            start = self.starts[bisect_right(self.starts, target) - 1]
            out.append(start + best.get(n, 0))
        return out

    def cuts(self, capacities: list[int], shards: int) -> list[list[int] | None]:
        """Greedy cut places for each capacity; None where ``shards`` do not hold everything."""
        places: list[list[int]] = [[] for _ in capacities]
        at = [0] * len(capacities)
        done: set[int] = set()
        for _ in range(shards - 1):
            live = [i for i, c in enumerate(capacities) if i not in done and at[i] + c < self.total]
            done |= set(range(len(capacities))) - set(live)
            if not live:
                break
            targets = sorted({at[i] + capacities[i] for i in live})
            ends = dict(zip(targets, self.ends_within(targets)))
            for i in live:
                at[i] = ends[at[i] + capacities[i]]
                places[i].append(at[i])
        return [places[i] if at[i] + c >= self.total else None for i, c in enumerate(capacities)]

    def minimax(self, shards: int) -> tuple[int, list[int]]:
        """The smallest feasible capacity and its cuts."""
        low = max(self.largest, -(-self.total // shards))
        high = low + self.largest  # always feasible: a shard is closed only beyond an even share
        best = None
        while best is None or low < high:
            step = max(1, -(-(high - low) // TRIES))
            tried = list(range(low, high, step))[:TRIES] + [high]
            found = self.cuts(tried, shards)
            first = next(i for i, c in enumerate(found) if c is not None)
            high, best = tried[first], found[first]
            low = tried[first - 1] + 1 if first else high
        return high, best

    def last_digests(self, places: list[int]) -> list[str]:
        """The digest of the group that ends at each cut."""
        if not places:
            return []
        points = self._points([p - 1 for p in places]).withColumn("place", F.col("place") + 1)
        rows = self.table.join(F.broadcast(points), "block").where("end = place").select("n", "digest").collect()
        return [d for _, d in sorted((r.n, r.digest) for r in rows)]


def shard_of(digest_column: str, last: list[str]) -> Column:
    """How many shards end before a digest."""
    return sum(((F.col(digest_column) > d).cast("int") for d in last), F.lit(0))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, digest, shard and slot of every document."""
    sized = written(
        docs.select("doc_id", size().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), digest().alias("digest")),
        "shard-sizes",
    )
    groups = Groups(sized)
    _, places = groups.minimax(shards)
    placed = sized.withColumn("shard", shard_of("digest", groups.last_digests(places))).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.col("doc_id").isNull()), F.lit(SLOT_PARTS)).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "digest"))
    return placed.withColumn("nth", nth).join(F.broadcast(bases), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "digest", "shard", (F.col("base") + F.col("nth") - 1).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> list[str]:
    """Write whole documents to ``path``, one folder ``__shard=...`` per shard (underscores are added where ``docs`` has such a column);
    gives the digests that end each shard but the last."""
    groups = Groups(docs.select(digest().alias("digest"), size().alias("size")))
    last = groups.last_digests(groups.minimax(shards)[1])
    own, shard = free_name("__digest", docs.columns), free_name("__shard", docs.columns)
    docs.withColumn(own, digest()).withColumn(shard, shard_of(own, last)).drop(own).write.partitionBy(shard).parquet(path)
    return last
