"""How much of a quotation stands in a text: best partial match by longest common subsequence."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number_set, strip


def _bits(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def lcs_length(masks: dict[str, int], size: int, text: str) -> int:
    """Length of the longest common subsequence, one addition of long integers for each character."""
    full = (1 << size) - 1
    state = full
    for c in text:
        matched = state & masks.get(c, 0)
        state = ((state + matched) | (state - matched)) & full
    return size - state.bit_count()


def _prefix_ratios(masks: dict[str, int], size: int, text: str) -> float:
    """Best similarity to a beginning of ``text`` that ends in a character of the pattern, in one pass."""
    full = (1 << size) - 1
    state, best = full, 0.0
    for length, c in enumerate(text, 1):
        if mask := masks.get(c):
            matched = state & mask
            state = ((state + matched) | (state - matched)) & full
            best = max(best, 2.0 * (size - state.bit_count()) / (size + length))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best similarity, from 0 to 1, of the shorter text to any stretch of the longer of at most its length.

    A stretch counts if it begins at the start and ends in a character of the shorter text, ends at the end and begins
    with one, or has full length and ends in one. Beginnings and ends take one pass each. Of the full stretches those
    that a common phrase points to come first; as the subsequence of the next stretch is longer by one at most, the rest
    is crossed in leaps as long as what a stretch falls short of the best.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 1.0 if not b else 0.0
    if a in b:
        return 1.0
    n, m = len(a), len(b)
    masks = _bits(a)
    best = max(_prefix_ratios(masks, n, b[: n - 1]), _prefix_ratios(_bits(a[::-1]), n, b[::-1][: n - 1]))
    seen: dict[int, int] = {}

    def common(start: int) -> int:
        if start not in seen:
            seen[start] = lcs_length(masks, n, b[start : start + n])
        return seen[start]

    phrase = min(8, n)
    for i in range(0, n - phrase + 1, max(phrase, n // 12)):
        if (j := b.find(a[i : i + phrase])) >= 0:
            start = min(max(0, j - i), m - n)
            if b[start + n - 1] in masks:
                best = max(best, common(start) / n)
    start = 0
    while start <= m - n:
        if b[start + n - 1] not in masks:
            start += 1
            continue
        length = common(start)
        best = max(best, length / n)
        start += max(1, int(best * n + 1e-9) + 1 - length)
    if m == n:  # of equal lengths either may be the pattern
        other = _bits(b)
        best = max(best, _prefix_ratios(other, n, a[: n - 1]), _prefix_ratios(_bits(b[::-1]), n, a[::-1][: n - 1]))
    return best


def with_verbatim_score(df: DataFrame, passage: str = "source_passage", text: str = "passage_text", name: str = "verbatim_match_score") -> DataFrame:
    """Adds the share of ``passage`` that stands in ``text``: 0 for blank passages, 1 where it is contained.

    Only the other rows reach the Python stage; all columns are kept.
    """
    blank = F.length(strip(F.coalesce(F.col(passage), F.lit("")))) == 0
    exact = F.when(blank | F.col(text).isNull(), 0.0).when(F.contains(F.col(text), F.col(passage)), 1.0)
    marked = df.withColumn(name, exact)
    fuzzy = marked.where(F.col(name).isNull())
    schema = marked.schema
    at = schema.fieldNames().index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [partial_ratio(p, t) for p, t in zip(batch.column(at(passage)).to_pylist(), batch.column(at(text)).to_pylist())]
            columns = list(batch.columns)
            columns[at(name)] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return marked.where(F.col(name).isNotNull()).unionByName(fuzzy.mapInArrow(run, schema))


def number_overlap(passage: Column, text: Column) -> Column:
    """Share of the figures of a passage that the text has, too; null for a passage without figures."""
    claimed = number_set(passage)
    return F.when(F.size(claimed) > 0, F.size(F.array_intersect(claimed, number_set(text))) / F.size(claimed))


def with_table_aware_score(df: DataFrame, passage: str = "source_passage", text: str = "passage_text", is_table: str = "is_table", name: str = "verbatim_match_score") -> DataFrame:
    """As ``with_verbatim_score``, but passages from tables are judged by their figures if they have any."""
    by_figures = F.when(F.col(is_table), number_overlap(F.col(passage), F.col(text)))
    blank = F.length(strip(F.coalesce(F.col(passage), F.lit("")))) == 0
    marked = df.withColumn("_figures", F.when(~blank, by_figures))
    scored = with_verbatim_score(marked.where("_figures is null").drop("_figures"), passage, text, name)
    return scored.unionByName(marked.where("_figures is not null").withColumn(name, F.col("_figures")).drop("_figures"))
