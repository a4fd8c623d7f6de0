"""Near-duplicate records with small edits (problem 3).

Two word sets A and B share at least ``t`` of their union exactly when their indicator vectors are within the Hamming
distance ``h = (1 - t) / (1 + t) * (|A| + |B|)``, rounded down. All vectors are laid out in one order of words (rarest
first, as far as a frequency table of fixed size tells) and split into blocks of one word. By the pigeonhole principle
``h`` errors can't fill more than ``h`` blocks, so a close pair agrees in a block before its errors are used up: if that
word stands at place ``p`` in A and ``q`` in B, then ``p + q <= h``. One of the two is *near* (``2 * p <= h``), and one is
*large* (at least half as large as two sets of budget ``h`` are together). Every set therefore gives a key for each of
its first ``h + 1`` words, and under each key the near sets or the large ones, whichever are fewer, are joined with all.

A key that too many sets share is not joined but refined: a close pair that agrees in one block agrees in a further one,
again before the errors are used up (the end of the set counts as a last block). The keys of both blocks together are
joined, and refined again where they are still shared by too many. So the work stays in proportion to the pairs even if
every word is common, no size decides which pairs are found, and nothing is sampled or capped.

Candidates are verified by the Hamming distance of 128-bit fingerprints, which never exceeds that of the sets, and then
by the sets themselves: the result is exact. Identical sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

THRESHOLD = (4, 5)  # 0.8, as a fraction: integer arithmetic decides ties
#: Keys under which more sets than this would be compared with all others of the key are refined by a further block, so a
#: set is compared with so many others of a key at most.
LEADS_A_KEY = 64
#: Size of the frequency table that words are ordered by; words of one slot only share an estimate, results don't depend on it.
FREQUENCY_SLOTS = 1 << 16
_END = np.uint64(0x9E3779B97F4A7C15)


def word_set(text: Column) -> Column:
    """Distinct words, sorted: unbroken runs of letters or digits in lower case."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))))


def word_classes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Members (id, cid) and classes (cid, words, n) of equal word sets; texts without a word belong to none."""
    members = (
        df.select(F.col(key).alias("id"), word_set(F.col(text)).alias("words"))
        .where(F.col("id").isNotNull() & (F.size("words") > 0))
        .withColumn("cid", F.unhex(F.md5(F.concat_ws(" ", "words"))))
    )
    classes = members.groupBy("cid").agg(F.first("words").alias("words")).withColumn("n", F.size("words"))
    return members.select("id", "cid").distinct(), classes


def _enough(shared: Column, a: Column, b: Column, threshold: tuple[int, int]) -> Column:
    num, den = threshold
    return shared * den >= (a + b - shared) * num


def _budget(total: Column, threshold: tuple[int, int]) -> Column:
    """Largest Hamming distance of a close pair whose sizes add up to ``total``."""
    num, den = threshold
    return F.floor(total * (den - num) / F.lit(den + num)).cast("int")


def error_grid(h: int) -> int:
    """The budget that stands for ``h``: itself up to 8, then the next of a grid in steps of a quarter at most.

    A set has pairs of several budgets; with the grid it gives keys for two or three of them, however long it is.
    """
    if h <= 8:
        return h
    step = 1 << (h.bit_length() - 3)
    return -(-h // step) * step


def budgets_by_size(sizes: list[int], threshold: tuple[int, int] = THRESHOLD) -> dict[int, list[int]]:
    """For each size the budgets, on the grid, of its pairs with sizes that exist."""
    num, den = threshold
    there = np.unique(np.array(sizes, np.int64))
    out = {}
    for n in there.tolist():
        low, high = np.searchsorted(there, [-(-n * num // den), n * den // num + 1])
        out[n] = sorted({error_grid(h) for h in np.unique((n + there[low:high]) * (den - num) // (den + num)).tolist()})
    return out


def least_sizes(budgets: dict[int, list[int]], threshold: tuple[int, int] = THRESHOLD) -> dict[int, int]:
    """For each budget the size that the larger set of its pairs has at least."""
    num, den = threshold
    out = {}
    for budget in {h for hs in budgets.values() for h in hs}:
        h = budget
        while h and error_grid(h - 1) == budget:
            h -= 1
        out[budget] = -(-h * (den + num) // (2 * (den - num)))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the stretches of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def block_keys(flat: np.ndarray, sizes: np.ndarray, row: np.ndarray, base: np.ndarray, budget: np.ndarray, last: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """Keys of the next block of each state: a set (``row`` of those in ``flat``, ordered), its budget, and the blocks agreed in.

    ``base`` is the key of the ``depth`` blocks agreed in so far, the last of them at place ``last`` (-1 before the first).
    """
    starts = np.cumsum(sizes) - sizes
    most = np.minimum(budget + depth, sizes[row])  # the place past the last word is the end of the set
    count = np.maximum(most - last, 0)
    state = np.repeat(np.arange(len(row)), count)
    place = last[state] + 1 + _runs(count)
    of = row[state]
    ended = place == sizes[of]
    word = np.where(ended, _END, flat[np.minimum(starts[of] + place, max(len(flat) - 1, 0))] if len(flat) else _END)
    with np.errstate(over="ignore"):
        key = _mixed(_mixed(base.view(np.uint64)[state] + np.uint64(depth + 1)) ^ word + budget[state].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return {"state": state, "key": key.view(np.int64), "place": place, "errors": place - depth, "ended": ended}


def _ordered(hashes: pa.ListArray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all sets, each set in the order of the frequency table, and the sizes of the sets."""
    flat = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    offsets = hashes.offsets.to_numpy()
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((flat, frequency[(flat & np.uint64(FREQUENCY_SLOTS - 1)).astype(np.int64)], owner))
    return flat[order], sizes


def _fingerprints(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits for each set, in two lanes: each word sets the bit that its hash names."""
    bit = np.uint64(1) << (flat >> np.uint64(20) & np.uint64(63))
    second = (flat >> np.uint64(26) & np.uint64(1)).astype(bool)
    starts = np.cumsum(sizes) - sizes
    lanes = [np.bitwise_or.reduceat(np.where(mine, bit, np.uint64(0)), starts).view(np.int64) if len(flat) else np.zeros(0, np.int64) for mine in (~second, second)]
    return np.stack(lanes)


_KEY_SCHEMA = "key long, handle long, n int, budget int, place int, errors int, near boolean, large boolean, ended boolean, s0 long, s1 long"


def _keyed(states: DataFrame, frequency: np.ndarray, budgets: dict[int, list[int]], least: dict[int, int], depth: int) -> DataFrame:
    """Rows of ``_KEY_SCHEMA``. Input: handle, hashes and, beyond the first block, base, budget and place."""
    spark = states.sparkSession
    bounds = np.zeros(max(least, default=0) + 1, np.int64)
    bounds[list(least)] = list(least.values())
    shared = spark.sparkContext.broadcast((frequency, budgets, bounds))  # a table of fixed size, and a few numbers for each size of a set

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, by_size, bounds = shared.value
        for whole in batches:
            for batch in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                flat, sizes = _ordered(batch.column(1), slots)
                handle = batch.column(0).to_numpy()
                if depth:
                    row = np.arange(len(sizes))
                    base, budget, last = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
                else:
                    mine = [by_size[n] for n in sizes.tolist()]
                    row = np.repeat(np.arange(len(sizes)), [len(x) for x in mine])
                    budget = np.array([h for x in mine for h in x], np.int64)
                    base, last = np.zeros(len(row), np.int64), np.full(len(row), -1, np.int64)
                found = block_keys(flat, sizes, row, base, budget, last, depth)
                of, h = row[found["state"]], budget[found["state"]]
                lanes = _fingerprints(flat, sizes)
                columns = [found["key"], handle[of], sizes[of].astype(np.int32), h.astype(np.int32), found["place"].astype(np.int32), found["errors"].astype(np.int32), 2 * found["errors"] <= h, sizes[of] >= bounds[h], found["ended"], lanes[0][of], lanes[1][of]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "handle", "n", "budget", "place", "errors", "near", "large", "ended", "s0", "s1"])

    return states.mapInArrow(run, _KEY_SCHEMA)


def close_classes(classes: DataFrame, threshold: tuple[int, int] = THRESHOLD, leads_a_key: int = LEADS_A_KEY, report: list[dict] | None = None) -> DataFrame:
    """Pairs (a, b) of classes whose word sets are close, a < b.

    With a list as ``report``, the number of keys, refined keys' rows and candidates of each level is appended to it.
    """
    num, den = threshold
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    classes = materialize(classes.select("cid", "words", "n", hashes.alias("hashes")).withColumn("handle", F.xxhash64("cid")), "p3-classes")
    slot = F.col("w").bitwiseAND(F.lit(FREQUENCY_SLOTS - 1)).cast("int")
    counts = classes.select(F.explode("hashes").alias("w")).groupBy(slot.alias("slot")).count().toArrow()  # FREQUENCY_SLOTS rows at most
    frequency = np.zeros(FREQUENCY_SLOTS, np.int64)
    frequency[counts["slot"].to_numpy()] = counts["count"].to_numpy()
    budgets = budgets_by_size([r["n"] for r in classes.select("n").distinct().collect()], threshold)
    least = least_sizes(budgets, threshold)

    states = classes.select("handle", "hashes")
    found: list[DataFrame] = []
    depth = 0
    while True:
        keyed = _keyed(states, frequency, budgets, least, depth)
        # Exchanged once by key: counts, joins and refinement all read the same partitions.
        keyed = keyed.repartition("key")
        stats = keyed.groupBy("key").agg(
            F.count("*").alias("n_all"),
            F.sum(F.col("near").cast("long")).alias("n_near"),
            F.sum(F.col("large").cast("long")).alias("n_large"),
            F.min("errors").alias("least_errors"),
        )
        stats = stats.where("n_near > 0 and n_large > 0 and n_all > 1").select("key", "least_errors", (F.col("n_large") < F.col("n_near")).alias("by_size"))
        useful = keyed.join(stats, "key").where("errors + least_errors <= budget")  # no other set of the key has fewer errors
        useful = useful.withColumn("lead", F.when(F.col("by_size"), F.col("large")).otherwise(F.col("near"))).drop("near", "large", "by_size", "least_errors")
        rows = materialize(useful, f"p3-blocks-{depth}")
        counts = rows.groupBy("key").agg(F.sum(F.col("lead").cast("long")).alias("n_lead"), F.bool_or("ended").alias("last"))
        often = materialize(counts.where((F.col("n_lead") > leads_a_key) & ~F.col("last")).select("key"), f"p3-often-{depth}")
        refined = not often.isEmpty()
        cold, hot = (rows.join(often, "key", "left_anti"), rows.join(often, "key", "left_semi")) if refined else (rows, rows.limit(0))
        x, y = cold.where("lead").alias("x"), cold.alias("y")
        total = F.col("x.n") + F.col("y.n")
        h = _budget(total, threshold)
        apart = F.bit_count(F.col("x.s0").bitwiseXOR(F.col("y.s0"))) + F.bit_count(F.col("x.s1").bitwiseXOR(F.col("y.s1")))
        fits = (F.col("x.n") * den >= F.col("y.n") * num) & (F.col("y.n") * den >= F.col("x.n") * num)
        once = (F.col("x.handle") < F.col("y.handle")) | (~F.col("y.lead") & (F.col("x.handle") != F.col("y.handle")))
        pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & once & fits & (F.col("x.errors") + F.col("y.errors") <= h) & (apart <= h))
        pairs = pairs.select(F.least("x.handle", "y.handle").alias("a"), F.greatest("x.handle", "y.handle").alias("b"))
        found.append(pairs)
        if report is not None:
            report.append({"depth": depth, "keys": rows.count(), "refined": hot.count(), "candidates": pairs.count()})
        if not refined:
            break
        depth += 1
        states = hot.select("handle", "key", "budget", "place").distinct().join(classes.select("handle", "hashes"), "handle").select("handle", "hashes", "key", "budget", "place")
    near = found[0]
    for more in found[1:]:
        near = near.unionByName(more)
    words = classes.select("handle", "cid", "words")
    with_a = near.distinct().join(words.select(F.col("handle").alias("a"), F.col("cid").alias("ca"), F.col("words").alias("wa")), "a")
    both = with_a.join(words.select(F.col("handle").alias("b"), F.col("cid").alias("cb"), F.col("words").alias("wb")), "b")
    close = both.where(_enough(F.size(F.array_intersect("wa", "wb")), F.size("wa"), F.size("wb"), threshold))
    return close.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))


def near_duplicate_pairs(df: DataFrame, key: str, text: str, threshold: tuple[int, int] = THRESHOLD, leads_a_key: int = LEADS_A_KEY) -> DataFrame:
    """All pairs (id_a, id_b), smaller first, of records whose word sets are close; equal sets are, too.

    Null texts and texts without a word are in no pair; repeated rows of one id count once; other columns are ignored.
    """
    members, classes = word_classes(df, key, text)
    members = materialize(members, "p3-members")
    links = materialize(close_classes(classes, threshold, leads_a_key), "p3-links")
    across = links.join(members.select(F.col("cid").alias("a"), F.col("id").alias("id_1")), "a").join(members.select(F.col("cid").alias("b"), F.col("id").alias("id_2")), "b").select(F.least("id_1", "id_2").alias("id_a"), F.greatest("id_1", "id_2").alias("id_b"))
    shared = members.groupBy("cid").count().where("count > 1").select("cid")
    several = members.join(shared, "cid", "left_semi")
    within = several.alias("x").join(several.alias("y"), (F.col("x.cid") == F.col("y.cid")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
    return across.unionByName(within).where("id_a <> id_b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node is connected to, by alternating large-star and small-star steps.

    Steps are repeated until nothing changes, which takes about as many as the logarithm of the number of nodes. Edges are written to the shared folder after each round; only their number and sum come to the driver.
    """
    edges = links.select("a", "b").where("a <> b")
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").unionByName(least.select("u", F.col("least").alias("v"))).distinct()
        edges = materialize(small, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicate_groups(df: DataFrame, key: str, text: str, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per record with a word: its class, the number of close other classes and its group (smallest class linked)."""
    members, classes = word_classes(df, key, text)
    links = materialize(close_classes(classes, threshold), "p3-links")
    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("cid")).agg(F.count("*").alias("n_links"))
    roots = components(links).select(F.col("node").alias("cid"), "root")
    return members.join(degree, "cid", "left").join(roots, "cid", "left").select("id", F.lower(F.hex("cid")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.lower(F.hex(F.coalesce("root", "cid"))).alias("group_id"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_pairs(table(spark, sf_dir, "generated_qa"), "id", "question")


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "generated_qa"), "id", "question")


QUERIES = {"p3_found": p3_found, "p3_groups": p3_groups}
_CLOSE_SETS = """
        WITH RECURSIVE q AS (
            SELECT DISTINCT id, list_sort(list_distinct(regexp_extract_all(lower(question), '[\\p{L}\\p{N}]+'))) AS words
            FROM generated_qa WHERE question IS NOT NULL
        ), k AS (SELECT DISTINCT words, md5(array_to_string(words, ' ')) AS cid, len(words) AS n FROM q WHERE len(words) > 0),
        e AS (SELECT cid, n, unnest(words) AS w FROM k),
        f AS (SELECT w, count(*) AS c FROM e GROUP BY w),
        ranked AS (SELECT cid, n, e.w, row_number() OVER (PARTITION BY cid ORDER BY c, e.w) AS r FROM e JOIN f ON f.w = e.w),
        prefixes AS (SELECT * FROM ranked WHERE r <= n - (n * 4 + 4) // 5 + 1),
        candidates AS (
            SELECT DISTINCT a.cid AS a, b.cid AS b FROM prefixes a JOIN prefixes b
            ON a.w = b.w AND a.cid < b.cid AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4
        ), sized AS (
            SELECT a, b, len(list_intersect(x.words, y.words)) AS s, x.n AS na, y.n AS nb
            FROM candidates JOIN k x ON x.cid = a JOIN k y ON y.cid = b
        ), close AS (SELECT a, b FROM sized WHERE s * 5 >= (na + nb - s) * 4)
"""
SQL = {
    "p3_found": _CLOSE_SETS
    + """, same AS (SELECT a, b FROM close UNION ALL SELECT cid, cid FROM k)
        SELECT DISTINCT least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b
        FROM same JOIN (SELECT id, md5(array_to_string(words, ' ')) AS cid FROM q WHERE len(words) > 0) x ON x.cid = a
        JOIN (SELECT id, md5(array_to_string(words, ' ')) AS cid FROM q WHERE len(words) > 0) y ON y.cid = b WHERE x.id <> y.id
    """,
    "p3_groups": _CLOSE_SETS
    + """, links AS (SELECT a, b FROM close UNION ALL SELECT b, a FROM close),
        walk AS (SELECT cid, cid AS there FROM k UNION SELECT w.cid, l.b FROM walk w JOIN links l ON l.a = w.there),
        roots AS (SELECT cid, min(there) AS group_id FROM walk GROUP BY cid),
        degrees AS (SELECT a AS cid, count(*) AS n_links FROM links GROUP BY a)
        SELECT q.id, k.cid AS class_id, coalesce(n_links, 0) AS n_links, group_id
        FROM q JOIN k ON k.words = q.words JOIN roots ON roots.cid = k.cid LEFT JOIN degrees ON degrees.cid = k.cid
    """,
}
