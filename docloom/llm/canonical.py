"""Visually identical text with different characters (problem 2).

A transducer reads grapheme clusters and writes one form: full and half width and joined forms become plain letters,
every kind of blank a space, invisible characters nothing, base letter and marks one letter where there is one,
look-alikes of other scripts the Latin letter they look like. It is compiled once, from the Unicode character database
and one short list of look-alikes, into two tables: what each character is read as, and which letter follows from a
letter and the sign after it (accents, voicing marks of kana, marks of Arabic and Indic letters, parts of Hangul
syllables). In a cluster the longest chain of such steps is taken; marks that lead nowhere are kept in canonical order.

The tables are checked for conflicts when they are compiled: rules must not disagree, every result must be read as
itself, and signs that look different must not be touched.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

# Letters of other scripts, each with the Latin letter it looks like.
LOOK_ALIKES = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y", "Ӏ": "I",
    # Greek
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian, and further Latin forms
    "օ": "o", "հ": "h", "ո": "n", "ս": "u", "ց": "g", "զ": "q", "ԛ": "q", "Օ": "O", "Տ": "S", "Ս": "U", "Լ": "L", "ɡ": "g", "ɑ": "a", "ⲟ": "o",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # The micro sign and the Greek letter
    "µ": "μ",
    # Hyphens of one shape
    "‐": "-", "‑": "-", "﹣": "-",
}
# Signs that differ to the eye and so must never be mapped.
KEPT_APART = "¹²³⁰⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉ªºıȷ‘’‚‛“”„‟'\"–—―−«»‹›…•·"
_INVISIBLE_EXTRA = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u3164\uffa0"


class MappingConflict(ValueError):
    """Two rules disagree, or a result would be mapped again."""


def _by_rule(ch: str) -> str | None:
    """What the Unicode data say of one character, or None for no change."""
    kind, code = unicodedata.category(ch), ord(ch)
    if ch in "\n\r" or ch == " ":
        return None
    if kind == "Zs" or ch == "\t":
        return " "
    if kind in ("Zl", "Zp") or ch in "\x85\x0b\x0c":
        return "\n"
    if kind == "Cf" or ch in _INVISIBLE_EXTRA or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
        return ""
    if kind == "Lo" and (0x1100 <= code <= 0x11FF):
        return None  # parts of Hangul syllables, which steps put together
    form = unicodedata.decomposition(ch)
    if form.startswith(("<wide>", "<narrow>")):
        return "".join(chr(int(x, 16)) for x in form.split()[1:])
    if form.startswith("<compat>") and (0xFB00 <= code <= 0xFB06 or 0xFB13 <= code <= 0xFB17 or 0x2160 <= code <= 0x217F or 0x0132 <= code <= 0x0133 or 0x01C4 <= code <= 0x01CC or 0x01F1 <= code <= 0x01F3):
        return "".join(chr(int(x, 16)) for x in form.split()[1:])
    if form and not form.startswith("<") and unicodedata.normalize("NFC", ch) != ch:
        return unicodedata.normalize("NFC", ch)
    return None


@cache
def mapping() -> dict[str, str]:
    """Single characters that change, each with its final form; raises MappingConflict if the rules don't agree."""
    out: dict[str, str] = {}
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3 or 0x3400 <= code <= 0x9FFF or 0x20000 <= code < 0x2F800 or 0x2FA20 <= code < 0xE0000 or code >= 0xE0FFF:
            continue
        ch = chr(code)
        ruled, listed = _by_rule(ch), LOOK_ALIKES.get(ch)
        if ruled is not None and listed is not None and ruled != listed:
            raise MappingConflict(f"{ch!r}: {ruled!r} by rule, {listed!r} by list")
        if (result := listed if ruled is None else ruled) is not None and result != ch:
            out[ch] = result
    for ch in KEPT_APART:
        if ch in out:
            raise MappingConflict(f"{ch!r} must stay as it is")
    while chained := [k for k, v in out.items() if any(c in out for c in v)]:  # the parts of a result may need mapping once more
        for k in chained:
            again = "".join(out.get(c, c) for c in out[k])
            if again == out[k] or k in again:
                raise MappingConflict(f"{k!r} leads back to itself")
            out[k] = again
    return out


@dataclass(frozen=True)
class Transducer:
    """The compiled tables, and the pattern of clusters in which anything may change."""

    reads: dict[str, str]  # a character, as letters and marks of the final script and width
    steps: dict[tuple[str, str], str]  # a letter and the sign after it, as one letter
    order: dict[str, int]  # canonical class of each mark
    clusters: re.Pattern[str]
    plane_clusters: re.Pattern[str]  # the same for texts within the basic plane, whose classes are looked up at once

    def write(self, cluster: str) -> str:
        """The one form of a cluster."""
        if cluster[:1] == "\r":
            return "\n" + self.write(cluster.lstrip("\r\n")) if cluster.lstrip("\r\n") else "\n"
        signs = [c for x in cluster for c in self.reads.get(x, x)]
        order, steps = self.order, self.steps
        at = 0
        while at < len(signs):  # marks into canonical order, those of one class as they stand
            end = at
            while end < len(signs) and signs[end] in order:
                end += 1
            if end - at > 1:
                signs[at:end] = sorted(signs[at:end], key=order.__getitem__)
            at = max(end, at + 1)
        out: list[str] = []
        letter, last = -1, 0  # place of the letter that marks may join, and the class of the last mark that stays
        for c in signs:
            rank = order.get(c, 0)
            if letter >= 0 and (last < rank or (last == 0 and letter == len(out) - 1)) and (joined := steps.get((out[letter], c))):
                out[letter] = joined
                continue
            if rank == 0:
                letter, last = len(out), 0
            else:
                last = rank
            out.append(c)
        return "".join(out)


def _ranges(chars: set[str]) -> str:
    """The characters as the inside of a class of a regular expression."""
    codes, parts = sorted(map(ord, chars)), []
    for code in codes:
        if parts and parts[-1][1] == code - 1:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "".join(f"\\U{a:08x}" + (f"-\\U{b:08x}" if b > a else "") for a, b in parts)


@cache
def transducer() -> Transducer:
    """Compile the tables; raises MappingConflict if they don't agree."""
    singles = mapping()
    reads: dict[str, str] = dict(singles)
    steps: dict[tuple[str, str], str] = {}
    order: dict[str, int] = {}
    marks: set[str] = set()
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3 or 0xE000 <= code <= 0xF8FF or 0x3400 <= code <= 0x9FFF or 0x20000 <= code < 0x2F800 or code >= 0xF0000:
            continue
        ch = chr(code)
        if (rank := unicodedata.combining(ch)) and ch not in singles:
            order[ch] = rank
        if unicodedata.category(ch)[0] == "M":
            marks.add(ch)
        form = unicodedata.decomposition(ch)
        if form and form[0] != "<":
            parts = [chr(int(x, 16)) for x in form.split()]
            if len(parts) == 2 and unicodedata.normalize("NFC", ch) == ch:
                steps[parts[0], parts[1]] = ch
        whole = unicodedata.normalize("NFD", singles.get(ch, ch))
        final = "".join(singles.get(c, c) for c in whole)
        if final != ch and (len(whole) > 1 or ch in singles):
            reads[ch] = final
    # By rule: a Hangul syllable is read as it is, and made of two parts, or of one of two parts and a third.
    for lead in range(19):
        for vowel in range(21):
            two = 0xAC00 + (lead * 21 + vowel) * 28
            steps[chr(0x1100 + lead), chr(0x1161 + vowel)] = chr(two)
            for tail in range(1, 28):
                steps[chr(two), chr(0x11A7 + tail)] = chr(two + tail)
    followers = marks | {b for _, b in steps} | {c for c, r in reads.items() if r == ""} | {c for c, r in reads.items() if r and (r[0] in marks)}
    # A letter that its own parts lead back to needs no reading where it stands alone.
    alone = Transducer(reads, steps, order, re.compile(""), re.compile(""))
    keys = {c for c in reads if alone.write(c) != c}

    def pattern(last: str) -> re.Pattern[str]:
        after, changed = (_ranges({c for c in chars if c <= last}) for chars in (followers, keys))
        return re.compile(f"[^{after}\n\r]?[{after}]+|[{changed}]|\r\n?")

    out = Transducer(reads, steps, order, pattern("\U0010ffff"), pattern("\uffff"))
    for c in reads:
        once = out.write(c)
        if out.write(once) != once and "".join(map(out.write, once)) != once:
            raise MappingConflict(f"{c!r} leads to {once!r}, which is read otherwise")
    for c in KEPT_APART:
        if out.write(c) != c:
            raise MappingConflict(f"{c!r} must stay as it is")
    return out


class _Memo(dict):
    """Output of each cluster met so far; emptied when full."""

    LIMIT = 100_000

    def __missing__(self, cluster: str) -> str:
        if len(self) >= self.LIMIT:
            self.clear()
        result = self[cluster] = transducer().write(cluster)
        return result


_outputs = _Memo()


_CONTROLS = re.compile("[\r\t\x0b\x0c]")


def canonical_text(text: str | None) -> str | None:
    """The one form of ``text``; null stays null. Applying it again changes nothing."""
    if text is None:
        return None
    if text.isascii() and not _CONTROLS.search(text):
        return text
    compiled = transducer()
    plane = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return (compiled.plane_clusters if plane else compiled.clusters).sub(lambda m: _outputs[m.group()], text)


def canonical_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_kind, record_id, parts: the text of a chunk as one part, or all cells of a table, row by row."""
    chunks = table(spark, sf_dir, "chunks").select(F.lit("chunk").alias("record_kind"), F.col("chunk_id").alias("record_id"), F.array("text").alias("parts"), F.lit(None).cast("array<int>").alias("row_sizes"))
    tables = table(spark, sf_dir, "extracted_tables")
    cells = tables.select(
        F.lit("table").alias("record_kind"),
        F.col("table_id").alias("record_id"),
        F.flatten(F.transform("cell_rows", lambda r: F.coalesce(r, F.expr("cast(array() as array<string>)")))).alias("parts"),
        F.transform("cell_rows", lambda r: F.coalesce(F.size(r), F.lit(0))).alias("row_sizes"),
    )
    return chunks.unionByName(cells).where("parts is not null and (record_kind = 'table' or parts[0] is not null)")


def _joined(parts: list[str | None], rows: list[int] | None) -> str:
    """All parts as one string, with marks between cells and rows that no text holds."""
    if rows is None:
        return parts[0] or ""
    out, at = [], 0
    for n in rows:
        out.append("\x1f".join(p or "" for p in parts[at : at + n]))
        at += n
    return "\x1e".join(out)


def canonicalize(df: DataFrame, with_text: bool = True) -> DataFrame:
    """Adds the canonical form of each record: two records look the same exactly if their ``form`` digests are equal.

    Input: record_kind, record_id, parts, row_sizes. Result: record_kind, record_id, form and stored (128-bit digests of
    the canonical and of the stored characters) and, if asked for, canonical_text, with unit and record separators
    between cells and rows of a table. A null cell counts as empty. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, stored, texts = [], [], []
            for parts, rows in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                raw = _joined(parts, rows)
                form = canonical_text(raw)
                stored.append(xxhash.xxh3_128_digest(raw.encode("utf-8", "surrogatepass")))
                forms.append(stored[-1] if form is raw else xxhash.xxh3_128_digest(form.encode("utf-8", "surrogatepass")))
                texts.append(form)
            arrays = [batch.column(0), batch.column(1), pa.array(forms, pa.binary()), pa.array(stored, pa.binary())] + [pa.array(texts, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(arrays, ["record_kind", "record_id", "form", "stored", "canonical_text"][: len(arrays)])

    schema = "record_kind string, record_id string, form binary, stored binary" + ", canonical_text string" * with_text
    return df.select("record_kind", "record_id", "parts", "row_sizes").mapInArrow(run, schema)


def look_alike_pairs(df: DataFrame) -> DataFrame:
    """Pairs of records of one kind with the same form and other stored characters, each pair once, smaller id first.

    Forms met in one way only are left out before any join, so copies stored alike cost nothing.
    """
    forms = materialize(canonicalize(df, with_text=False), "p2-forms")
    varied = forms.groupBy("record_kind", "form").agg(F.min("stored").alias("a"), F.max("stored").alias("b")).where("a <> b").select("record_kind", "form")
    several = forms.join(varied, ["record_kind", "form"], "left_semi").distinct()
    x, y = several.alias("x"), several.alias("y")
    same = (F.col("x.record_kind") == F.col("y.record_kind")) & (F.col("x.form") == F.col("y.form"))
    pairs = x.join(y, same & (F.col("x.record_id") < F.col("y.record_id")) & (F.col("x.stored") != F.col("y.stored")))
    return pairs.select("x.record_kind", F.col("x.record_id").alias("id_a"), F.col("y.record_id").alias("id_b")).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_pairs(canonical_records(spark, sf_dir))


def p2_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's one form, and the digest that is equal for records that look the same: its class."""
    forms = canonicalize(canonical_records(spark, sf_dir)).dropDuplicates(["record_kind", "record_id"])
    return forms.select("record_kind", "record_id", F.md5("canonical_text").alias("form"), "canonical_text")


QUERIES = {"p2_found": p2_found, "p2_canonical": p2_canonical}


def _sql_form(text: str) -> str:
    """The one form as an SQL expression: the same readings, with the database's own composition of letters and marks."""
    reads = transducer().reads
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    hangul = {c for c in reads if 0x1100 <= ord(c) <= 0x11FF}
    one = {k: unicodedata.normalize("NFC", v) for k, v in reads.items() if v and k not in hangul}
    single = {k: v for k, v in one.items() if len(v) == 1 and k != v}
    several = {k: v for k, v in one.items() if len(v) > 1 and unicodedata.normalize("NFC", k) != v}
    gone = "".join(f"\\x{{{ord(k):x}}}" for k, v in reads.items() if v == "")
    text = f"regexp_replace(regexp_replace({text}, '\\r\\n?', chr(10), 'g'), '[{gone}]', '', 'g')"
    for k, v in several.items():
        if ord(k) < 0x2200 or 0xFB00 <= ord(k) <= 0xFB17:
            text = f"replace({text}, {quoted(k)}, {quoted(v)})"
    return f"nfc_normalize(translate({text}, {quoted(''.join(single))}, {quoted(''.join(single.values()))}))"


_RECORDS = """
        WITH r AS (
            SELECT 'chunk' AS record_kind, chunk_id AS record_id, text AS raw FROM chunks WHERE text IS NOT NULL
            UNION ALL SELECT 'table', table_id, array_to_string(list_transform(cell_rows, lambda r: array_to_string(list_transform(coalesce(r, []), lambda c: coalesce(c, '')), chr(31))), chr(30))
            FROM extracted_tables WHERE cell_rows IS NOT NULL
        ), f AS (SELECT DISTINCT record_kind, record_id, raw, {form} AS canonical_text FROM r)
"""
_SQL = {
    "p2_found": _RECORDS
    + """
        SELECT DISTINCT x.record_kind, x.record_id AS id_a, y.record_id AS id_b FROM f x JOIN f y
        ON x.record_kind = y.record_kind AND x.canonical_text = y.canonical_text AND x.record_id < y.record_id AND x.raw <> y.raw
    """,
    "p2_canonical": _RECORDS + "SELECT DISTINCT record_kind, record_id, md5(canonical_text) AS form, canonical_text FROM f",
}


def sql() -> dict[str, str]:
    """The SQL twins; made on demand, since they hold the compiled readings."""
    form = _sql_form("raw")
    return {name: text.replace("{form}", form) for name, text in _SQL.items()}
