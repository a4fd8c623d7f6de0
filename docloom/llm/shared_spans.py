"""Long exact spans shared between records (problem 5).

A gear rolling hash over the last ``GEAR_WORDS`` words runs through each text. A cut is made wherever the hash is the
least of any ``WINDOW`` consecutive positions, so cuts depend on content alone, survive insertions, and are never more
than ``WINDOW`` words apart. A chunk reaches from a cut to the next, together with the words the first cut depends on.
Chunks are deduplicated by digest: a digest that stands in two owners (filings) is shared.

With 2 * WINDOW + GEAR_WORDS <= run + 1, any common run of ``run`` words holds two adjacent cuts and the words between,
hence a whole chunk: no shared span is lost. Shared chunks are then the only places where runs of exactly ``run`` words
are hashed and compared, which makes the result exact up to a 64-bit digest of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, slices, table

RUN = 30
GEAR_WORDS = 12
_MIX = np.uint64(0x9E3779B97F4A7C15)


def window_for(run: int, gear_words: int = GEAR_WORDS) -> int:
    window = (run + 1 - gear_words) // 2
    if window < 1:
        raise ValueError("the run is too short for the gear hash")
    return window


class _WordHashes(dict):
    """64-bit hash of each word; emptied when full, so memory stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _WordHashes()


def _word_hashes(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts of at least ``least`` words in a row, where each begins, and which text it is."""
    parts, starts, which, at = [], [0], [], 0
    get = _hashes.__getitem__
    for i, text in enumerate(texts):
        words = text.split()
        if len(words) < least:
            continue
        parts.append(np.fromiter(map(get, words), np.uint64, len(words)))
        at += len(words)
        starts.append(at)
        which.append(i)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.array(starts, np.int64), np.array(which, np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _polynomial_prefix(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of word hash times base^position, and the inverse powers: digests of any stretch in constant time."""
    n = len(flat)
    base, inverse = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64)))).astype(np.uint64)
        inverses = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, inverse, np.uint64)))).astype(np.uint64)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(flat * powers[:n], dtype=np.uint64)))
    return sums, inverses


def _digest(sums: np.ndarray, inverses: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        value = (sums[end] - sums[start]) * inverses[start]
        return _mixed(value ^ ((end - start).astype(np.uint64) * _MIX))


def gear(flat: np.ndarray, gear_words: int = GEAR_WORDS) -> np.ndarray:
    """Gear rolling hash at each word; only the last ``gear_words`` words reach it, older ones are shifted out."""
    shift = 64 // gear_words
    with np.errstate(over="ignore"):
        table_value = _mixed(flat)
        out = table_value.copy()
        for k in range(1, gear_words):
            out[k:] += table_value[:-k] << np.uint64(shift * k)
        return _mixed(out)


def cut_points(values: np.ndarray, starts: np.ndarray, window: int, gear_words: int = GEAR_WORDS) -> np.ndarray:
    """Positions at which the gear hash is the least (the last of equals) of some window inside its text."""
    n = len(values)
    if n < window:
        return np.zeros(0, np.int64)
    # Ties go to the last position: compare (value, -position) through an index of the running minimum.
    best = np.arange(n, dtype=np.int64)
    width = 1
    while width < window:  # minimum of the `width` positions from i on, doubled each time
        step = min(width, window - width)
        other = best[step:]
        mine = best[: n - step]
        best = best.copy()
        best[: n - step] = np.where(values[other] <= values[mine], other, mine)
        width += step
    owner = np.zeros(n, np.int64)
    owner[starts[1:-1]] = 1
    owner = np.cumsum(owner)
    at = np.arange(n - window + 1)
    first = starts[owner[at]] + gear_words - 1  # earlier hashes lack words
    inside = (at >= first) & (at + window <= starts[owner[at] + 1])
    return np.unique(best[at[inside]])


def chunk_bounds(flat: np.ndarray, starts: np.ndarray, run: int = RUN, gear_words: int = GEAR_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last word of each content-defined chunk."""
    window = window_for(run, gear_words)
    cuts = cut_points(gear(flat, gear_words), starts, window, gear_words)
    if len(cuts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.searchsorted(starts, cuts, side="right")
    same = owner[1:] == owner[:-1]
    return cuts[:-1][same] - gear_words + 1, cuts[1:][same] + 1


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "chunks").select(F.lit("chunk").alias("record_kind"), F.col("chunk_id").alias("record_id"), "filing_id", "text")
    passages = table(spark, sf_dir, "generated_qa").select(F.lit("passage").alias("record_kind"), F.col("id").alias("record_id"), "filing_id", F.col("source_passage").alias("text"))
    return chunks.unionByName(passages)


def _chunk_digests(df: DataFrame, run: int) -> DataFrame:
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            owners, rids = (batch.column(i).to_numpy() for i in (0, 1))
            flat, starts, which = _word_hashes(batch.column(2).to_pylist(), run)
            a, b = chunk_bounds(flat, starts, run)
            sums, inverses = _polynomial_prefix(flat)
            text = np.searchsorted(starts, a, side="right") - 1
            columns = [_digest(sums, inverses, a, b).view(np.int64), owners[which[text]] if len(a) else np.zeros(0, np.int64), rids[which[text]] if len(a) else np.zeros(0, np.int64), (a - starts[text]).astype(np.int32), (b - a).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["digest", "owner", "rid", "at", "n"])

    return df.select("owner", "rid", "text").mapInArrow(digests, "digest long, owner long, rid long, at int, n int")


def _run_digests(df: DataFrame, run: int) -> DataFrame:
    """Digest of each run of ``run`` words that holds a whole shared chunk (``places``) of its text."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 3)):
            kinds, ids, owners, texts, places = (batch.column(i) for i in range(5))
            flat, starts, which = _word_hashes(texts.to_pylist(), run)
            sums, inverses = _polynomial_prefix(flat)
            owners, places = owners.to_numpy(), places.to_pylist()
            begin, text = [], []
            for k, i in enumerate(which):
                size = int(starts[k + 1] - starts[k])
                marks = np.zeros(size + 1, np.int64)
                for p in places[i]:
                    low, high = max(0, p["at"] + p["n"] - run), min(p["at"], size - run)
                    if low <= high:
                        marks[low] += 1
                        marks[high + 1] -= 1
                at = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                begin.append(at + starts[k])
                text.append(np.full(len(at), k, np.int64))
            a = np.concatenate(begin) if begin else np.zeros(0, np.int64)
            t = np.concatenate(text) if text else np.zeros(0, np.int64)
            row = pa.array(which[t] if len(t) else t)
            sizes = starts[1:] - starts[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_digest(sums, inverses, a, a + run).view(np.int64)), kinds.take(row), ids.take(row), pa.array(owners[which[t]] if len(t) else t), pa.array((a - starts[t]).astype(np.int32)), pa.array((sizes[t] if len(t) else t).astype(np.int32))],
                ["digest", "record_kind", "record_id", "owner", "at", "words"],
            )

    return df.select("record_kind", "record_id", "owner", "text", "places").mapInArrow(digests, "digest long, record_kind string, record_id string, owner long, at int, words int")


def _in_several_owners(df: DataFrame) -> DataFrame:
    """Digests that stand in two owners or more; summed up before the shuffle, so a digest of all rows is no hot group."""
    return df.groupBy("digest").agg(F.min("owner").alias("a"), F.max("owner").alias("b")).where("a <> b").select("digest")


def shared_runs(df: DataFrame, run: int = RUN) -> DataFrame:
    """Every run of ``run`` words of a record that stands, spelled exactly alike, in a record of another owner.

    Input: record_kind, record_id, filing_id (the owner), text; other columns are ignored. Null texts, and texts of
    fewer than ``run`` words, have no runs; a null owner counts as one owner of its own. Second deliveries of a record
    have its owner and so share nothing with it. Result: record_kind, record_id, at (first word), words (of the record).
    """
    df = df.select(
        "record_kind",
        "record_id",
        F.coalesce(F.col("filing_id").cast("long"), F.lit(-(2**63) + 1)).alias("owner"),
        F.xxhash64("record_kind", "record_id").alias("rid"),
        "text",
    ).where(F.length("text") >= 2 * run - 1)
    # Digests and runs are used twice and therefore written once; sums over them are made before they are shuffled.
    digests = materialize(_chunk_digests(df, run), "p5-digests")
    found = digests.select("digest", "rid", "at", "n").join(_in_several_owners(digests), "digest", "left_semi")
    places = found.groupBy("rid").agg(F.collect_set(F.struct("at", "n")).alias("places"))
    # Two records of one rid share their places: those that don't fit only cost a comparison.
    runs = materialize(_run_digests(df.join(places, "rid"), run), "p5-runs")
    return runs.join(_in_several_owners(runs), "digest", "left_semi").select("record_kind", "record_id", "at", "words").distinct()


def shared_spans(df: DataFrame, run: int = RUN) -> DataFrame:
    """Per record: the maximal spans shared with other owners, their number of words and their share of the record."""
    record = ["record_kind", "record_id", "words"]
    in_order = Window.partitionBy(*record).orderBy("at")
    runs = shared_runs(df, run)
    # Runs that overlap or touch make one span. A record's places number at most its words.
    begins = (F.col("at") > F.lag("at").over(in_order) + run).cast("int")
    islands = runs.withColumn("begins", F.coalesce(begins, F.lit(1))).withColumn("span", F.sum("begins").over(in_order))
    spans = islands.groupBy(*record, "span").agg(F.min("at").alias("first"), (F.max("at") + run).alias("past"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "past"))), lambda x: F.concat_ws("-", x["first"], x["past"])), ",")
    return (
        spans.groupBy(*record)
        .agg(F.count("*").cast("int").alias("n_spans"), F.sum(F.col("past") - F.col("first")).cast("int").alias("shared_words"), joined.alias("spans"))
        .select(*record, "n_spans", "shared_words", F.round(F.col("shared_words") / F.col("words"), 6).alias("shared_share"), "spans")
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_runs(records(spark, sf_dir)).select("record_kind", "record_id").distinct()


def p5_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(records(spark, sf_dir))


QUERIES = {"p5_found": p5_found, "p5_spans": p5_spans}
_RUNS = r"""
        WITH r AS (
            SELECT DISTINCT 'chunk' AS record_kind, chunk_id AS record_id, filing_id, text FROM chunks WHERE text IS NOT NULL
            UNION ALL SELECT DISTINCT 'passage', id, filing_id, source_passage FROM generated_qa WHERE source_passage IS NOT NULL
        ), w AS (
            SELECT record_kind, record_id, filing_id, list_filter(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> '') AS ws FROM r
        ), g AS (
            SELECT record_kind, record_id, filing_id, len(ws) AS words, unnest(range(0, len(ws) - 29)) AS pos,
                unnest(list_transform(range(1, len(ws) - 28), lambda i: array_to_string(ws[i:i + 29], ' '))) AS run FROM w WHERE len(ws) >= 30
        ), s AS (SELECT run FROM g GROUP BY run HAVING min(filing_id) <> max(filing_id))
"""
SQL = {
    "p5_found": _RUNS + "SELECT DISTINCT record_kind, record_id FROM g JOIN s USING (run)",
    "p5_spans": _RUNS
    + """, f AS (SELECT DISTINCT record_kind, record_id, words, pos FROM g JOIN s USING (run)),
        b AS (SELECT *, CASE WHEN pos > lag(pos) OVER p + 30 THEN 1 WHEN lag(pos) OVER p IS NULL THEN 1 ELSE 0 END AS begins FROM f WINDOW p AS (PARTITION BY record_kind, record_id, words ORDER BY pos)),
        i AS (SELECT *, sum(begins) OVER (PARTITION BY record_kind, record_id, words ORDER BY pos) AS span FROM b),
        e AS (SELECT record_kind, record_id, words, span, min(pos) AS f, max(pos) + 30 AS p FROM i GROUP BY ALL)
        SELECT record_kind, record_id, words::INT AS words, count(*)::INT AS n_spans, sum(p - f)::INT AS shared_words,
            round(sum(p - f) / words, 6) AS shared_share, string_agg(f || '-' || p, ',' ORDER BY f) AS spans
        FROM e GROUP BY record_kind, record_id, words
    """,
}
