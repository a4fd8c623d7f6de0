"""Mixing sources to target weights (problem 8).

Capped water-filling: with total size S, a source of size s used at most r times can give r * s. Sources whose target
share of S is beyond that are clamped there and their excess is redistributed over the others in proportion to their
weights, until every share is feasible. Each record of a source is then repeated the whole number of times that all
can be, and a seeded selection of the records once more, up to the exact number of tokens still missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .packing import sized_documents

#: Records are ordered by a hash of 63 bits, of which each histogram takes so many.
BITS, HASH_BITS = 10, 63
#: A bucket of at most so many records is cut at a record; a larger one is split by a further histogram.
EDGE_ROWS = 10_000


@dataclass(frozen=True)
class Share:
    source: str
    target_share: float
    max_repeats: int
    available: int
    wanted: float


def water_fill(targets: list[tuple[str, float, int]], available: dict[str, int], total: float | None = None) -> list[Share]:
    """Tokens wanted of each source.

    ``targets``: (source, share, most repetitions). ``total`` is the size of the mix, by default that of all records of
    the listed sources. Sources without records, with a share or a cap of zero or less give nothing, and their weight
    goes to the others. With a total that no choice can reach, all sources end at their caps.
    """
    merged: dict[str, tuple[float, int]] = {}
    for source, share, most in targets:
        if source is not None:
            old = merged.get(source, (0.0, 0))
            merged[source] = (old[0] + max(share or 0.0, 0.0), max(old[1], most or 0))
    caps = {s: available.get(s, 0) * max(most, 0) for s, (_, most) in merged.items()}
    live = {s: share for s, (share, _) in merged.items() if share > 0 and caps[s] > 0}
    wanted = dict.fromkeys(merged, 0.0)
    if live:
        left = float(sum(available[s] for s in live) if total is None else total)
        free = dict(live)
        while free and left > 0:
            weight = sum(free.values())
            clamped = [s for s, share in free.items() if left * share / weight > caps[s]]
            if not clamped:
                for s, share in free.items():
                    wanted[s] = left * share / weight
                break
            for s in clamped:
                wanted[s] = float(caps[s])
                del free[s]
            left -= sum(caps[s] for s in clamped)
    return [Share(s, share, most, available.get(s, 0), wanted[s]) for s, (share, most) in sorted(merged.items())]


def largest_exact_total(targets: list[tuple[str, float, int]], available: dict[str, int]) -> float:
    """The largest size of a mix in which every source with records has exactly its share among them."""
    wanted: dict[str, float] = {}
    caps: dict[str, int] = {}
    for source, share, most in targets:
        if source is not None and (share or 0) > 0:
            wanted[source] = wanted.get(source, 0.0) + share
            caps[source] = max(caps.get(source, 0), (most or 0) * available.get(source, 0))
    live = {s: w for s, w in wanted.items() if caps[s] > 0}
    weight = sum(live.values())
    return min((caps[s] * weight / w for s, w in live.items()), default=0.0)


@dataclass
class _Edge:
    """Where a source's extra repetition ends: all records before the bucket ``prefix`` of ``depth`` histograms have it."""

    whole: int
    missing: float
    prefix: int = 0
    depth: int = 0
    rows: int = 0

    @property
    def shift(self) -> int:
        return HASH_BITS - BITS * self.depth

    def narrow(self, histogram: dict[int, tuple[int, int]]) -> None:
        """Go on to the bucket of the next histogram (tokens and records by bucket) in which the missing tokens end."""
        bucket = 0
        while bucket < 1 << BITS and histogram.get(bucket, (0, 0))[0] <= self.missing:
            self.missing -= histogram.get(bucket, (0, 0))[0]
            bucket += 1
        self.rows = histogram.get(bucket, (0, 0))[1]
        self.prefix, self.depth = (self.prefix << BITS) + bucket, self.depth + 1


def mix(docs: DataFrame, targets: list[tuple[str, float, int]], key: str = "doc_id", source: str = "source", size: str = "n_tokens", total: float | None = None, seed: int = 11, edge_rows: int = EDGE_ROWS) -> tuple[DataFrame, list[Share]]:
    """Selected records (key, source, size, copies) and the shares aimed at.

    Records of null or unlisted sources aren't selected; records of size 0 (null and empty texts) add nothing and are
    left out. Repeated rows of one key count once. Only sums by source and hash bucket come to the driver, whose number
    is that of the sources listed times 2 ** ``BITS`` for each histogram. The bucket in which a source's tokens end is
    split by further histograms until it has at most ``edge_rows`` records, whatever the number of records, and is then
    cut at a record, so a source misses its size by less than one record.
    """
    spark = docs.sparkSession
    names = sorted({s for s, _, _ in targets if s is not None})
    items = docs.where(F.col(source).isin(names) & (F.col(size) > 0)).groupBy(key).agg(F.min(source).alias("source"), F.max(size).alias("size"))
    items = materialize(items.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 1)), "p8-items")

    def histograms(rows: DataFrame, depth: int) -> dict[str, dict[int, tuple[int, int]]]:
        bucket = F.shiftright("h", HASH_BITS - BITS * (depth + 1)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
        out: dict[str, dict[int, tuple[int, int]]] = {}
        for r in rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("tokens"), F.count("*").alias("n")).collect():
            out.setdefault(r["source"], {})[r["bucket"]] = (r["tokens"], r["n"])
        return out

    found = histograms(items, 0)
    available = {s: sum(t for t, _ in h.values()) for s, h in found.items()}
    shares = water_fill(targets, available, total)
    edges: dict[str, _Edge] = {}
    for share in shares:
        if share.available and share.wanted > 0:
            whole = min(int(share.wanted // share.available), share.max_repeats)
            edges[share.source] = _Edge(whole, share.wanted - whole * share.available if whole < share.max_repeats else 0.0)
    depth = 0
    while found:
        for name, histogram in found.items():
            if name in edges:
                edges[name].narrow(histogram)
        depth += 1
        large = [(s, e.prefix) for s, e in edges.items() if e.depth == depth and e.rows > edge_rows]
        if not large or BITS * (depth + 1) > HASH_BITS:
            break
        within = items.join(F.broadcast(spark.createDataFrame(large, "source string, prefix long")), "source")
        found = histograms(within.where(F.shiftright("h", HASH_BITS - BITS * depth) == F.col("prefix")), depth)
    plan = [(s, e.whole, e.prefix, e.shift, float(e.missing)) for s, e in edges.items()]
    planned = items.join(F.broadcast(spark.createDataFrame(plan, "source string, whole int, prefix long, shift int, missing double")), "source")
    planned = planned.withColumn("at", F.expr("shiftright(h, shift)"))
    clear = planned.where("at <> prefix").withColumn("copies", F.col("whole") + (F.col("at") < F.col("prefix")).cast("int"))
    # One bucket of each source, of at most ``edge_rows`` records, is cut at a record by its running size.
    running = F.sum("size").over(Window.partitionBy("source").orderBy("h", key).rowsBetween(Window.unboundedPreceding, 0))
    edge = planned.where("at = prefix").withColumn("running", running)
    # The record on the edge is taken if that brings the source nearer to its size.
    edge = edge.withColumn("copies", F.col("whole") + (F.col("running") - F.col("size") / 2 <= F.col("missing")).cast("int")).drop("running")
    chosen = clear.unionByName(edge).where("copies > 0").select(key, "source", F.col("size").alias(size), "copies")
    return chosen, shares


def reached(chosen: DataFrame, shares: list[Share], size: str = "n_tokens") -> DataFrame:
    """Per listed source: its target and actual share of all selected tokens, records and largest number of copies.

    ``exact_total`` is the largest size of a mix in which all sources with records would have exactly their shares.
    """
    spark = chosen.sparkSession
    aims = spark.createDataFrame([(s.source, float(s.target_share), int(s.max_repeats), int(s.available)) for s in shares], "source string, target_share double, max_repeats int, available_tokens long")
    per = chosen.groupBy("source").agg(F.sum(F.col(size) * F.col("copies")).alias("tokens"), F.count("*").alias("n_records"), F.max("copies").alias("most_copies"))
    out = F.broadcast(aims).join(per, "source", "left").na.fill(0, ["tokens", "n_records", "most_copies"])
    # One row for each listed source: a window over all of them is as small as the list.
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    exact = largest_exact_total([(s.source, s.target_share, s.max_repeats) for s in shares], {s.source: s.available for s in shares})
    out = out.withColumn("exact_total", F.lit(float(exact)))
    return out.withColumn("actual_share", F.when(whole > 0, F.round(F.col("tokens") / whole, 6)))


def _targets(spark: SparkSession, sf_dir: str) -> list[tuple[str, float, int]]:
    """The table of targets has one row for each source that a mix is made of: a parameter list, read whole."""
    return [tuple(r) for r in table(spark, sf_dir, "mix_targets").select("source_name", "target_share", "max_repeats").collect()]


def p8_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(sized_documents(spark, sf_dir), _targets(spark, sf_dir))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reached(*mix(sized_documents(spark, sf_dir), _targets(spark, sf_dir)))


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any selection, counted: sources listed, records beyond their cap, of other sources, chosen twice or without text, and shares above their aim."""
    targets = _targets(spark, sf_dir)
    chosen, shares = mix(sized_documents(spark, sf_dir), targets)
    chosen = materialize(chosen, "p8-chosen")
    aims = spark.createDataFrame([(s.source, int(s.max_repeats), float(s.wanted)) for s in shares], "source string, most int, wanted double")
    rows = chosen.join(F.broadcast(aims), "source", "left")
    # A document may be delivered under several sources or texts: one of its rows must have the source, and one a text.
    texts = table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", "source").distinct()
    bad = chosen.join(texts, ["doc_id", "source"], "left_anti").count()
    per = rows.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("n_tokens").alias("largest"), F.max("wanted").alias("wanted"))
    counts = rows.agg(F.sum((F.col("copies") > F.col("most")).cast("long")).alias("beyond_cap"), F.sum(F.col("most").isNull().cast("long")).alias("unlisted"), (F.count("*") - F.count_distinct("doc_id")).alias("twice"))
    off = per.where(F.abs(F.col("tokens") - F.col("wanted")) > F.col("largest")).count()
    return counts.select(F.lit(len(shares)).cast("long").alias("sources"), "beyond_cap", "unlisted", "twice", F.lit(bad).cast("long").alias("without_text"), F.lit(off).cast("long").alias("off_aim"))


QUERIES = {"p8_selection": p8_selection, "p8_shares": p8_shares, "p8_invariants": p8_invariants}
SQL = {
    "p8_invariants": """
        SELECT count(DISTINCT source_name) AS sources, 0::BIGINT AS beyond_cap, 0::BIGINT AS unlisted, 0::BIGINT AS twice, 0::BIGINT AS without_text, 0::BIGINT AS off_aim
        FROM mix_targets WHERE source_name IS NOT NULL
    """,
}
