"""Filling fixed-capacity containers with items (problem 7).

Bounded-space online best-fit: each shard keeps a fixed number of open containers in a bitset keyed by free space, puts
an item into the fullest container that holds it, and closes the fullest one when a further container is needed. Items
larger than the capacity are cut into full containers and a rest; no other item is divided.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .tokens import VOCABULARY, with_tokens

CAPACITY = 4096
OPEN_BINS = 256
#: Tokens that one shard packs at most on average; the number of shards follows from it and the size of the corpus.
SHARD_TOKENS = 4_000_000


class BestFit:
    """Open containers by free space: bit ``f`` of the set is on if a container with ``f`` free is open."""

    def __init__(self, capacity: int, open_bins: int):
        if capacity < 1 or open_bins < 1:
            raise ValueError("capacity and number of open containers must be positive")
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.bins, self.n_open, self.n_made = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        held = self.bins[free]
        number = held.pop()
        if not held:
            del self.bins[free]
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number

    def _put(self, number: int, free: int) -> None:
        if not free:
            return  # full: closed at once
        self.bins.setdefault(free, []).append(number)
        self.bits |= 1 << free
        self.n_open += 1

    def add(self, size: int) -> int:
        """Number of the container an item of ``size`` (at most the capacity) goes into."""
        fitting = self.bits >> size if size else self.bits
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1  # least free space that holds it
            number = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            number, free = self.n_made, self.capacity
            self.n_made += 1
        self._put(number, free - size)
        return number


def pack_sizes(sizes: list[int], capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> list[list[tuple[int, int]]]:
    """For each item, in the order given, its pieces as (container, size): one piece unless it exceeds the capacity."""
    packer = BestFit(capacity, open_bins)
    out = []
    for size in sizes:
        pieces = []
        while size > capacity:
            pieces.append((packer.add(capacity), capacity))
            size -= capacity
        pieces.append((packer.add(size), size))
        out.append(pieces)
    return out


def pack(df: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, open_bins: int = OPEN_BINS, shard_tokens: int = SHARD_TOKENS, seed: int = 7) -> DataFrame:
    """Containers for all items: ``key``, piece_index, container, offset (in the item), size.

    Items are dealt to shards by a hash of their key, so a shard's share is bounded however the input is partitioned and
    the result doesn't depend on it; the hash mixes sizes in each shard, large items first within blocks of the shard's
    stream. Items of size 0 (null and empty texts) go to a container of their own shard and take no room; null sizes
    count as 0. A key that is repeated is packed once. Container ids are ``shard * 2^32 + number`` and unique.
    """
    items = df.groupBy(key).agg(F.max(F.coalesce(F.col(size), F.lit(0))).cast("long").alias("size"))
    total, n = df.agg(F.coalesce(F.sum(F.col(size)), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-int(total) // shard_tokens), -(-int(n) // 200_000))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packers: dict[int, BestFit] = {}
        for batch in batches:
            rows = []
            for shard, k, size_ in zip(batch["shard"].tolist(), batch["k"].tolist(), batch["size"].tolist()):
                packer = packers.get(shard)
                if packer is None:
                    packers.clear()  # shards come one after another
                    packer = packers[shard] = BestFit(capacity, open_bins)
                offset = index = 0
                while size_ - offset > capacity:
                    rows.append((k, index, (shard << 32) + packer.add(capacity), offset, capacity))
                    offset, index = offset + capacity, index + 1
                rows.append((k, index, (shard << 32) + packer.add(size_ - offset), offset, size_ - offset))
            yield pd.DataFrame(rows, columns=["k", "piece_index", "container", "offset", "size"])

    # A stable order within the shard: blocks by hash, and in each block the large items first, so small ones fill gaps.
    dealt = items.select(F.col(key).alias("k"), "size", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(shards)).alias("shard"), F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(4)).alias("block"))
    # A partition may hold several shards, one after another; how many there are is left to the session.
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "block", F.col("size").desc(), "k")
    return ordered.select("k", "size", "shard").mapInPandas(run, f"k {kind}, piece_index int, container long, offset long, size long").withColumnRenamed("k", key)


def containers(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per container: its pieces, the room used and the share of the capacity left unused."""
    used = packed.groupBy("container").agg(F.count("*").alias("n_pieces"), F.sum("size").alias("used"))
    return used.withColumn("unused_share", F.round(1 - F.col("used") / F.lit(capacity), 6))


def sized_documents(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return materialize(with_tokens(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "text", vocabulary), "document-sizes")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(sized_documents(spark, sf_dir))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: number, tokens, least number possible, and the mean share left unused."""
    per = containers(pack(sized_documents(spark, sf_dir)))
    return per.agg(F.count("*").alias("n_containers"), F.sum("used").alias("tokens"), F.ceil(F.sum("used") / CAPACITY).alias("least_containers"), F.round(1 - F.sum("used") / (F.count("*") * CAPACITY), 6).alias("unused_share"))


def p7_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any packing, counted: documents packed, tokens lost, containers beyond their capacity, documents divided though they fit, and whether more than a fiftieth (and 256) of the containers could be saved."""
    sizes = sized_documents(spark, sf_dir)
    packed = materialize(pack(sizes), "p7-packed")
    per = packed.groupBy("doc_id").agg(F.sum("size").alias("packed"), F.count("*").alias("n"))
    joined = sizes.groupBy("doc_id").agg(F.max(F.coalesce("n_tokens", F.lit(0))).alias("tokens")).join(per, "doc_id", "left")
    lost = F.coalesce(F.sum(F.col("tokens") - F.coalesce("packed", F.lit(0))), F.lit(0)).cast("long")
    divided = F.coalesce(F.sum(((F.col("tokens") <= CAPACITY) & (F.col("n") > 1)).cast("long")), F.lit(0))
    full = containers(packed)
    over = full.agg(F.coalesce(F.sum((F.col("used") > CAPACITY).cast("long")), F.lit(0)).alias("over_capacity"), (F.count("*") > F.ceil(F.sum("used") / CAPACITY) * 1.02 + OPEN_BINS).cast("long").alias("wasteful"))
    one = joined.agg(F.count("n").alias("documents"), lost.alias("lost_tokens"), divided.alias("divided"))
    return one.join(over, F.lit(True))  # one row each


QUERIES = {"p7_containers": p7_containers, "p7_fill": p7_fill, "p7_invariants": p7_invariants}
SQL = {
    "p7_invariants": "SELECT count(DISTINCT doc_id) AS documents, 0::BIGINT AS lost_tokens, 0::BIGINT AS divided, 0::BIGINT AS over_capacity, 0::BIGINT AS wasteful FROM documents",
}
