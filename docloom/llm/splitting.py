"""Splitting oversized texts at natural boundaries (problem 4).

Balanced targets: the smallest number of pieces that can hold the text gives equal-length cut targets, each target
snaps to the strongest boundary nearby, and a piece is added whenever a limit can't be met.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import words
from .common import table

PARAGRAPH, LINE, ENTRY, SENTENCE, WORD = 4, 3, 2, 1, 0
KIND = {PARAGRAPH: "paragraph", LINE: "line", ENTRY: "entry", SENTENCE: "sentence", WORD: "word"}

_WORD = re.compile(r"\S+")
_SENTENCE_END = re.compile(r"[.!?…。]+[\"'”’»)\]]*$")
_ENTRY_START = re.compile(r"^(?:[•▪‣◦·*]|[-–—](?=$)|\(?(?:\d{1,2}|[a-z]|[ivx]{1,4})[.)]$)")
# Words whose full stop doesn't end a sentence.
_ABBREVIATIONS = frozenset("i.e. e.g. no. nos. mr. mrs. ms. dr. st. vs. cf. approx. fig. sec. art. ca. bzw. z.b. d.h. nr. sr. sra. u.s. jan. feb. mar. apr. jun. jul. aug. sep. sept. oct. nov. dec.".split())


@dataclass(frozen=True)
class Piece:
    start_word: int
    end_word: int
    start_char: int
    end_char: int
    boundary: str


def words_within(limit: int, ratio: float) -> int:
    """Largest number of words whose estimate, ``int(ratio * words)``, is within ``limit``."""
    n = int((limit + 1) / ratio) + 2
    while n > 0 and int(n * ratio) > limit:
        n -= 1
    return n


def boundary_strengths(text: str, spans: list[tuple[int, int]]) -> bytearray:
    """Strength of the boundary after each word: ``strengths[i]`` holds for a cut between word ``i`` and ``i + 1``."""
    out = bytearray(len(spans))
    for i in range(len(spans) - 1):
        start, end = spans[i]
        nxt, nxt_end = spans[i + 1]
        gap = text[end:nxt]
        if "\n" in gap or "\r" in gap or "\u2028" in gap or "\u2029" in gap:
            breaks = gap.count("\n") or gap.count("\r") + gap.count("\u2028") + 2 * gap.count("\u2029")
            out[i] = PARAGRAPH if breaks > 1 else LINE
            continue
        last = text[end - 1]
        if last == ";":
            out[i] = WORD if text[nxt].islower() else ENTRY
        elif last in ".!?…。\"'”’»)]":
            word = text[start:end]
            if _SENTENCE_END.search(word) and word.lower() not in _ABBREVIATIONS and not (len(word) == 2 and word[0].isalpha()):
                out[i] = SENTENCE if not text[nxt].islower() else WORD
        if out[i] < ENTRY and _ENTRY_START.match(text[nxt:nxt_end]) and (out[i] == SENTENCE or text[nxt] in "•▪‣◦"):
            out[i] = ENTRY
    return out


def _place(strengths: bytearray, n_words: int, pieces: int, most: int, overlap: int, naturals: list[int]) -> list[int] | None:
    """Cut positions (words before the cut) for ``pieces`` pieces, or None when a target finds no allowed boundary."""
    import bisect

    step = (n_words - overlap) / pieces
    room = most - overlap
    cuts: list[int] = []
    prev = overlap
    for k in range(1, pieces):
        target = overlap + round(k * step)
        low = max(prev + 1, n_words - (pieces - k) * room)
        high = min(prev + room, n_words - 1)
        if low > high:
            return None
        near = max(1, int(step / 4))
        best = None
        for a, b in ((max(low, target - near), min(high, target + near)), (low, high)):
            i, j = bisect.bisect_left(naturals, a), bisect.bisect_right(naturals, b)
            if i < j:
                best = max(naturals[i:j], key=lambda c: (strengths[c - 1], -abs(c - target), -c))
                break
        if best is None:
            # Nothing natural can be reached with so many pieces: a word cut only where no piece could do better.
            i = bisect.bisect_right(naturals, prev)
            if i < len(naturals) and naturals[i] <= prev + room:
                return None
            best = min(max(target, low), high)
        cuts.append(best)
        prev = best
    return cuts


def _greedy(strengths: bytearray, n_words: int, most: int, overlap: int, naturals: list[int]) -> list[int]:
    """Always possible: the furthest natural boundary in reach, else a full piece."""
    import bisect

    room, prev, cuts = most - overlap, overlap, []
    while n_words - prev > room:
        i = bisect.bisect_right(naturals, prev + room)
        cut = naturals[i - 1] if i and naturals[i - 1] > prev else prev + room
        cuts.append(cut)
        prev = cut
    return cuts


def split_text(text: str | None, limit: int = 600, overlap_tokens: int = 0, ratio: float = 1.3) -> list[Piece]:
    """Ordered pieces of ``text``, each of at most ``limit`` estimated tokens.

    A text within the limit is one piece; null and blank texts have none. Consecutive pieces share exactly
    ``int(overlap_tokens / ratio)`` words. A cut falls at a paragraph, line, entry or sentence end if one lies within a
    piece's reach, else between two words; a single word is never divided.
    """
    if not text:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    n = len(spans)
    if not n:
        return []
    most, overlap = words_within(limit, ratio), int(overlap_tokens / ratio)
    if most < 1 or overlap >= most:
        raise ValueError("the overlap must be smaller than the limit, and the limit must hold a word")
    if n <= most:
        return [Piece(0, n, spans[0][0], spans[-1][1], "end")]
    strengths = boundary_strengths(text, spans)
    naturals = [i + 1 for i, s in enumerate(strengths) if s]
    least = -(-(n - overlap) // (most - overlap))
    cuts = None
    for pieces in range(least, 2 * least + 2):
        if (cuts := _place(strengths, n, pieces, most, overlap, naturals)) is not None:
            break
    if cuts is None:
        cuts = _greedy(strengths, n, most, overlap, naturals)
    out, start = [], 0
    for cut in [*cuts, n]:
        kind = "end" if cut == n else KIND[strengths[cut - 1]]
        out.append(Piece(start, cut, spans[start][0], spans[cut - 1][1], kind))
        start = cut - overlap
    return out


def split_oversized(df: DataFrame, key: str = "chunk_id", text: str = "text", limit: int = 600, overlap_tokens: int = 0, ratio: float = 1.3, with_text: bool = True) -> DataFrame:
    """Pieces of every record whose text is over ``limit`` estimated tokens; shorter records give no rows.

    Result: ``key``, piece_index, n_pieces, start_word, n_words, tokens, boundary and, if asked for, piece_text. Null
    and blank texts give no rows, further columns of the input are ignored, and repeated rows are split repeatedly;
    callers that know their key to be repeated drop duplicates after. Nothing is shuffled.
    """
    least_chars = 2 * words_within(limit, ratio) + 1  # so many words and blanks at least

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            for k, value in zip(keys, batch.column(1).to_pylist()):
                found = split_text(value, limit, overlap_tokens, ratio)
                if len(found) < 2:
                    continue
                for i, p in enumerate(found):
                    words = p.end_word - p.start_word
                    rows.append((k, i, len(found), p.start_word, words, int(words * ratio), p.boundary, value[p.start_char : p.end_char] if with_text else None))
            cols = list(zip(*rows)) if rows else [[]] * 8
            types = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            names = ["k", "piece_index", "n_pieces", "start_word", "n_words", "tokens", "boundary", "piece_text"]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)][: 8 if with_text else 7]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    kind = df.schema[key].dataType.simpleString()
    schema = f"k {kind}, piece_index int, n_pieces int, start_word int, n_words int, tokens int, boundary string" + ", piece_text string" * with_text
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("v")).where(F.length("v") >= least_chars)
    return rows.mapInArrow(pieces, schema).withColumnRenamed("k", key)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = split_oversized(table(spark, sf_dir, "chunks"), with_text=False)
    return pieces.where("piece_index = 0").select("chunk_id").distinct()


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "chunks"), overlap_tokens=60).dropDuplicates(["chunk_id", "piece_index"])


def p4_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the pieces of ``p4_pieces``, counted: chunks split, pieces beyond the limit, and chunks whose pieces don't cover it, overlap otherwise than asked for or hold other words than the chunk."""
    overlap = int(60 / 1.3)
    pieces = p4_pieces(spark, sf_dir)
    along = Window.partitionBy("chunk_id").orderBy("piece_index")
    end = F.col("start_word") + F.col("n_words")
    pieces = pieces.withColumn("expected", F.coalesce(F.lag(end - overlap).over(along), F.lit(0))).withColumn("own", words(F.col("piece_text")))
    fresh = F.when(F.col("piece_index") == 0, F.col("own")).otherwise(F.slice("own", F.lit(overlap + 1), F.greatest(F.size("own") - overlap, F.lit(0))))
    per = pieces.groupBy("chunk_id").agg(
        F.sum((F.col("tokens") > 600).cast("long")).alias("over"),
        F.bool_or(F.col("start_word") != F.col("expected")).alias("moved"),
        F.max(end).alias("covered"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece_index", fresh.alias("w")))), lambda x: x["w"])).alias("joined"),
    )
    texts = table(spark, sf_dir, "chunks").select("chunk_id", words(F.col("text")).alias("words")).dropDuplicates(["chunk_id"])
    joined = per.join(texts, "chunk_id")
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    return joined.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("over"), F.lit(0)).cast("long").alias("over_limit"), count(F.col("moved")).alias("wrong_overlap"), count(F.col("covered") != F.size("words")).alias("not_covered"), count(F.col("joined") != F.col("words")).alias("other_words"))


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces, "p4_invariants": p4_invariants}
_OVER = r"""
        SELECT DISTINCT chunk_id FROM chunks
        WHERE len(list_filter(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> '')) * 13 // 10 > 600
    """
SQL = {
    "p4_found": _OVER,
    "p4_invariants": f"SELECT count(*) AS chunks, 0::BIGINT AS over_limit, 0::BIGINT AS wrong_overlap, 0::BIGINT AS not_covered, 0::BIGINT AS other_words FROM ({_OVER})",
}
