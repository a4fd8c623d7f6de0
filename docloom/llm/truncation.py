"""Text cut off by field limits (problem 1).

A value lost its end if its last unit (sentence, list entry or table row) is a strict prefix of a longer copy elsewhere.
Two kinds of copies are searched, one by sorting values and one by hashing prefixes:

* *literal* copies, for passages quoted from chunks and tables: the distinct units of all sources and the last units of
  all passages are sorted. The longer copies of a unit are its direct successors, so each unit is compared with those
  that follow until one no longer begins with it, and nothing is compared pairwise. What begins near the end of a sorted
  range is carried on into the next. A unit that also stands whole in a source is whole.
* copies of *form*, for answers, which have no original: every prefix of every answer sentence is hashed with numbers,
  names and codes masked by their shape (opening words and last words of the prefix). The counts tell whether texts of
  that form end there or go on.

Debris of a transfer, continuation marks and broken figures show without any copy; so do, where no copy exists, ends on
open brackets or separators and on words that, by their counts over all texts, nothing ends with.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .canonical import canonical_text
from .common import materialize, table

OPENING_WORDS, LAST_WORDS = 2, 3
#: Where fewer than this share of the texts of one form end, and at least ``LEAST_LONGER`` go on, an end there is a loss.
END_SHARE, LEAST_LONGER = 0.2, 3
FRAGMENT_SHARE = 0.01  # a word that follows its context less often than that, and ends there, is a fragment
STOP_SHARE = 0.02  # the same for ends with a stop, which may be a decimal point
#: Words that open this share of all answers are kept as they are, other first words are masked like the rest. The share
#: also bounds their number.
OPENER_SHARE = 0.0007
#: A word that can't end a text is met this often (and makes up a share of all words, which bounds the list), stands
#: before hardly any stop, and is hardly ever the last word.
OPEN_LEAST, OPEN_LEAST_SHARE, OPEN_STOPS, OPEN_ENDS = 40, 0.0001, 0.001, 0.01

# Whole answers without content, in lower case.
PLACEHOLDERS = frozenset(["n/a", "na", "tbd", "tba", "null", "nil", "nan", "none given", '""', "''", "<blank>", "<empty>", "<none>", "<null>", "[answer]", "[blank]", "[empty]", "[no answer]", "<answer>", "{answer}", "answer:", "answer", "antwort:", "respuesta:", "réponse:", "a:", "todo", "xxx", "???", "placeholder", "lorem ipsum", "(blank)", "(empty)", "#n/a", "undefined"])
_INVISIBLE = re.compile("[\u00ad\u034f\u200b-\u200f\u2060\ufeff]")
_DEBRIS = re.compile(r"(?:\ufffd+|&(?:#?[A-Za-z0-9]{1,8};?)?|[^\W\d_]%[0-9A-Fa-f]{0,2}|(?:%[0-9A-Fa-f]{2})+%?|</?[A-Za-z][^<>]*|</?|\\(?:u[0-9A-Fa-f]{0,4}|x[0-9A-Fa-f]{0,2}|n)?|=[0-9A-F]{2}|=\r?)$")
_DEBRIS_SIGN = re.compile(r"[\ufffd&%<\\=]")  # any debris has one of these
_MARK = re.compile(r"(?:\.\.\.+|…|\. \. \.|\[(?:\.{3}|…|cont[^\]]*|more|truncated)\]|\((?:\.{3}|…|cont[^)]*|more|truncated)\)|(?:to be )?continued|>>+|-->|→|[ \n]cont(?:inued|['’]d|\.)?)\s*$", re.IGNORECASE)
_TERMINAL = re.compile(r"[.!?。][\"'”’»)\]]*$")
_CLOSERS = "\"'”’»)]"
_SENTENCE = re.compile(r"(?<=[.!?…;])(?<!\bi\.e\.)(?<!\be\.g\.)(?<!\bNo\.)(?<!\bNr\.)(?<!\bvs\.)(?<!\bapprox\.)[\"'”’»)\]]*\s+(?=[^\s\Wa-zß-öø-ÿ]|[^\s\w])")
_NUMBER = re.compile(r"\d+(?:[.,]\d*)*")
_ABBREVIATION = re.compile(r"(?:^|\s)(?:No|Nr|Nos|i\.e|e\.g|vs|approx|cf|Fig|z\.B|d\.h|bzw)\.$")
# A sum of less than a million in figures whose decimal point is the last sign: its decimals and unit are missing.
_BARE_SUM = re.compile(r"[$€£]\s?\(?\d{1,3}(?:,\d{3})?\.$")
_CELL = re.compile(r"^(?:|[—–\-*]|n/?[am]\.?|nan|[$€£]?\s?\(?-?[$€£]?\s?\d{1,3}(?:,\d{3})*(?:\.\d+)?\)?\s?%?(?: (?:million|thousand|billion|percent))?|[$€£]?\s?\(?\d+(?:\.\d+)?\)?\s?%?(?: (?:million|thousand|billion|percent))?)$", re.IGNORECASE)
_FIGURE = re.compile(r"^[$€£]?\s?\(?-?[$€£]?\d{1,3}(?:,\d{3})*(?:\.\d+)?\)?\s?%?(?: (?:million|thousand|billion|percent))?$")
_BROKEN_NUMBER = re.compile(r"(?:\d[,.]|,\d{1,2}|[$€£(=+/*]|\(\d[\d,.]*)$")

LOST, WHOLE = 1, 0
FIRST, LAST = 2, 3  # the units at the ends of a sorted range


def content(value: str | None) -> str:
    """The visible text without blanks around it; empty for placeholders and texts without a letter, digit or currency."""
    if not value:
        return ""
    text = _INVISIBLE.sub("", value).strip()
    if text.lower() in PLACEHOLDERS or not any(c.isalnum() or c in "$€£\ufffd" for c in text):
        return ""
    return text


def units(text: str) -> list[str]:
    """Lines, and in them sentences and entries ended by a semicolon."""
    return [u for line in text.split("\n") for u in (_SENTENCE.split(line) if " | " not in line or _TERMINAL.search(line.rstrip()) else [line]) if u.strip()]


def damaged(text: str) -> bool:
    """True if the end is debris or a mere continuation mark, which needs no copy to be seen."""
    if _DEBRIS_SIGN.search(text) and _DEBRIS.search(text):
        return True
    end = text.rstrip()[-2:]  # a mark ends in one of few signs
    return (end[-1:] in "…])dDtT>→" or (end[-1] == "." and end[0] in ". tT")) and bool(_MARK.search(text))


def _mask(token: str) -> str:
    """Shape of a token: figures keep grouping and decimals, names and codes only what they are."""
    if any(c.isdigit() for c in token):
        if any(c.isalpha() for c in token):
            return "#id" + token[-1] * (not token[-1].isalnum())

        def shape(m: re.Match[str]) -> str:
            head, *rest = re.split(r"([.,])", m.group())
            lead = "n" if rest and rest[0] == "," else ("y" if len(head) == 4 else f"d{min(len(head), 3)}" if not rest else "d")
            return lead + "".join(x if x in ".," else str(len(x)) * bool(x) for x in rest)

        return _NUMBER.sub(shape, token)
    if (token[:1].isupper() or token[:2].strip("(\"'“").isupper()) and not token.startswith(("I'", "I ")) and token != "I":
        return "X" + token[-1] * (not token[-1].isalnum())
    return token


class _Masks(dict):
    """Shape of each token met so far; emptied when full, so memory stays bounded."""

    LIMIT = 200_000

    def __missing__(self, token: str) -> str:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[token] = _mask(token)
        return value


_masks = _Masks()


def _tokens(unit: str, openers: frozenset[str]) -> list[str]:
    words = unit.split()
    out = [_masks[w] for w in words]
    if words and (first := words[0].lower()) in openers:
        out[0] = first
    return out


def _first_sum(tokens: list[str]) -> int:
    """Place of the first sum of a text, or past its end."""
    return next((i for i, t in enumerate(tokens) if "$" in t), len(tokens))


def _style(tokens: list[str], n: int, at: int) -> str:
    """How the first sum (at place ``at``) of the first ``n`` words is written: its unit, or that it has none; later sums are written alike."""
    if at + 1 >= n:
        return ""
    return tokens[at + 1].strip(",.;") if tokens[at + 1][:4] in ("mill", "thou", "bill") else "plain"


class _TokenHashes(dict):
    """64-bit hash of each token; emptied when full, so memory stays bounded."""

    LIMIT = 200_000

    def __missing__(self, token: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[token] = xxhash.xxh3_64_intdigest(token) >> 2
        return value


_hashes = _TokenHashes()


def _keys(tokens: list[str], at: int, sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Keys of the first words of a text, for each of the ``sizes``, with and without the opening words.

    Each takes the same time however long the text is. Hashes of tuples of numbers are the same in every process.
    """
    numbers = [_hashes[t] for t in tokens]
    plain, later = _hashes[""], _hashes[_style(tokens, len(tokens), at)]
    padded = [0] * LAST_WORDS + numbers
    opening = numbers[:OPENING_WORDS] + [0] * OPENING_WORDS
    for n in sizes:
        end = (later if at + 1 < n else plain, *padded[n : n + LAST_WORDS])
        yield hash((*opening[: min(n, OPENING_WORDS)], end)), hash((0, end))


def _ended(unit: str) -> tuple[str, bool]:
    """The unit without its final stop, and whether it had one."""
    text = unit.rstrip()
    bare = text.rstrip(_CLOSERS)
    if bare.endswith((".", "!", "?", "。")):
        return bare.rstrip(".!?。") + text[len(bare) :], True
    return text, False


def _last_unit(text: str) -> str:
    found = units(text)
    return found[-1] if found else text


def _row_verdict(text: str) -> int | None:
    """Verdict on a passage that ends in a table row, by the form of its rows alone."""
    lines = [x for x in text.split("\n") if x.strip()]
    last = lines[-1]
    cells = [c.strip() for c in last.split("|")]
    widths = [x.count("|") for x in lines[:-1]]
    if widths and last.count("|") < min(widths):
        return LOST
    if len(cells) > 1 and not _CELL.match(cells[-1]):
        return LOST if any(c.isdigit() for c in cells[-1]) or cells[-1][-1:] in "$(" else None
    return None


def passage_form(text: str, open_words: frozenset[str] = frozenset()) -> int:
    """Verdict on a passage of which no copy is found."""
    if "|" in text.split("\n")[-1] or ("|" in text and not _TERMINAL.search(text)):
        verdict = _row_verdict(text)
        return WHOLE if verdict is None else verdict
    if _ABBREVIATION.search(text) or _BARE_SUM.search(text):
        return LOST
    if _TERMINAL.search(text) or text.endswith(";"):
        return WHOLE
    if text == text.lower() and not re.search(r"[.;!?]", text):
        return LOST if text.rsplit(None, 1)[-1] in open_words else WHOLE  # a layout without stops
    if _FIGURE.match(text):
        return WHOLE
    return LOST


def _can_be_fragment(token: str) -> bool:
    """True for words in lower case, a lone capital and figures of few digits: what a cut leaves of a longer word."""
    return token in ("I", "d1", "d2", "d3") or (token.islower() and token.replace("-", "").isalpha())


def open_end(text: str, open_words: frozenset[str] = frozenset()) -> bool:
    """True if the last word or sign of several words can't end anything."""
    words = _last_unit(text).split()
    return len(words) > 1 and (text[-1] in "$€£(=,:–—&+" or (text[-1] == "-" and text[-2].isalnum()) or words[-1].strip("(\"'“«") in open_words)


def answer_form(text: str, open_words: frozenset[str] = frozenset()) -> int:
    """Verdict on an answer of a form that no other answer has."""
    last = _last_unit(text)
    if _ABBREVIATION.search(last) or _BARE_SUM.search(last) and len(last.split()) > 1:
        return LOST
    if _TERMINAL.search(text) or text.endswith(";"):
        return WHOLE
    if _FIGURE.match(text):
        return WHOLE
    words = last.split()
    if open_end(text, open_words) or text[-1] in "-/" or _BROKEN_NUMBER.search(text) or text.count("(") > text.count(")"):
        return LOST
    return WHOLE


def _visible(text: Column) -> Column:
    """As ``content``, without what it takes off."""
    return F.regexp_replace(F.regexp_replace(text, _INVISIBLE.pattern, ""), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def _has_content(text: Column) -> Column:
    """True where ``content`` gives a text."""
    return _visible(text).rlike("[\\p{L}\\p{N}$€£\ufffd]") & ~F.lower(_visible(text)).isin(*sorted(PLACEHOLDERS))


def _distinct_texts(answers: DataFrame) -> DataFrame:
    """Every answer text once, without what ``content`` takes off, so that copies and second deliveries count as one."""
    return answers.select(_visible(F.col("text")).alias("text")).where("text != ''").distinct()


def _openers(texts: DataFrame) -> frozenset[str]:
    """The first words of at least ``OPENER_SHARE`` of all texts, counted over all of them; at most 1 / ``OPENER_SHARE`` words."""
    first = F.lower(F.regexp_extract("text", r"^\s*(\S+)", 1))
    counts = texts.select(first.alias("w")).where((F.col("w") != "") & ~F.col("w").rlike(r"\d")).groupBy("w").count()
    least = max(3, OPENER_SHARE * texts.count())
    return frozenset(r["w"] for r in counts.where(F.col("count") >= least).collect())


def open_words(texts: DataFrame) -> frozenset[str]:
    """Words that can't be the last of a text, by their counts over all distinct texts: an article, a preposition and the like.

    Words count as they are written, and only those in lower case, since names may end anything.

    Only words of at least ``OPEN_LEAST_SHARE`` of all words come to the driver, so at most 1 / ``OPEN_LEAST_SHARE``.
    """
    tokens = texts.select(F.split("text", r"\s+").alias("t")).select(F.size("t").alias("n"), F.posexplode("t").alias("i", "t"))
    # Summed up as they are written first, so that each form is taken apart once for every task only.
    written = tokens.groupBy("t").agg(F.count("*").alias("n"), F.sum((F.col("i") == F.col("n") - 1).cast("long")).alias("ends"))
    quotes = "\"'“«”»"
    word = F.regexp_extract("t", rf"^[({quotes}]*(\p{{Ll}}+)[.!?;:,){quotes}]*$", 1)
    stop = F.col("t").rlike(rf"[.!?;][){quotes}]*$")
    words = written.select(word.alias("w"), "n", F.when(stop, F.col("n")).otherwise(0).alias("stops"), F.when(stop, 0).otherwise(F.col("ends")).alias("ends")).where("w != ''")
    counts = words.groupBy("w").agg(F.sum("n").alias("n"), F.sum("stops").alias("stops"), F.sum("ends").alias("ends"))
    counts = materialize(counts, "p1-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("n") >= max(OPEN_LEAST, OPEN_LEAST_SHARE * total))
    return frozenset(r["w"] for r in frequent.where((F.col("stops") <= OPEN_STOPS * F.col("n")) & (F.col("ends") <= OPEN_ENDS * F.col("n"))).collect())


def form_counts(answers: DataFrame, openers: frozenset[str]) -> DataFrame:
    """(form, ends, longer): how often texts end at a prefix of that form, and how often they go on. One row for a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: Counter[int] = Counter()
        longer: Counter[int] = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(ends.keys() | longer.keys())
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([ends[k] for k in keys], pa.int64()), pa.array([longer[k] for k in keys], pa.int64())], ["form", "ends", "longer"])
            ends.clear()
            longer.clear()
            return out

        for batch in batches:
            for value in batch.column(0).to_pylist():
                for unit in units(content(value)):
                    bare, _ = _ended(unit)
                    tokens = _tokens(bare, openers)
                    at = _first_sum(tokens)
                    longer.update(chain.from_iterable(_keys(tokens, at, range(1, len(tokens)))))
                    for key in _keys(tokens, at, [len(tokens)] if tokens else []):
                        ends.update(key)
                if len(ends) + len(longer) > 200_000:
                    yield flush()
        yield flush()

    return answers.select("text").mapInArrow(count, "form long, ends long, longer long").groupBy("form").agg(F.sum("ends").alias("ends"), F.sum("longer").alias("longer"))


def answer_verdicts(answers: DataFrame) -> DataFrame:
    """ids of answers that lost their end, from the forms of all distinct answer texts. Input: id, text."""
    texts = materialize(_distinct_texts(answers), "p1-texts")
    openers, last_never = _openers(texts), open_words(texts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = content(value)
                if not text:
                    continue
                if damaged(text) or open_end(text, last_never):
                    rows.append((k, True, None, None, None, 0, False, False))
                    continue
                bare, stop = _ended(_last_unit(text))
                tokens = _tokens(bare, openers)
                first, n = _first_sum(tokens), len(tokens)
                if tokens and re.fullmatch(r"\$\(?d\d?", tokens[-1]) and _style(tokens, n, first)[:4] in ("mill", "thou", "bill"):
                    rows.append((k, True, None, None, None, 0, False, False))  # a sum without the unit the others have
                    continue
                if stop and not (tokens and (tokens[-1][-1:].isdigit() or _ABBREVIATION.search(text))):
                    continue  # ends in a stop after a word
                if len(tokens) < 2 or all(t.startswith("X") for t in tokens):
                    tokens = []  # a single word or a mere name has no form of its own
                form, tail = next(_keys(tokens, first, [n])) if tokens else (None, None)
                before = next(_keys(tokens, first, [n - 1]))[0] if len(tokens) > 1 else None
                rows.append((k, None, form, tail, before, answer_form(text, last_never), stop, bool(tokens) and _can_be_fragment(tokens[-1])))
            cols = list(zip(*rows)) if rows else [[]] * 8
            types = [batch.schema.field(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", "sure", "form", "tail", "before", "shape", "stop", "plain"])

    kind = answers.schema["id"].dataType.simpleString()
    open_ends = answers.select("id", "text").mapInArrow(judge, f"id {kind}, sure boolean, form long, tail long, before long, shape int, stop boolean, plain boolean")
    counts = materialize(form_counts(texts, openers), "p1-forms")
    tails = counts.select(F.col("form").alias("tail"), F.col("ends").alias("tail_ends"), F.col("longer").alias("tail_longer"))
    there = counts.select(F.col("form").alias("before"), F.col("longer").alias("before_longer"))
    joined = open_ends.join(counts, "form", "left").join(tails, "tail", "left").join(there, "before", "left")
    share = F.when(F.col("stop"), STOP_SHARE).otherwise(END_SHARE)

    def judged(ends: str, longer: str, otherwise: Column) -> Column:
        """Verdict by the counts of one form, without this text itself, if it has been seen often enough."""
        others, on = F.greatest(F.coalesce(ends, F.lit(0)) - 1, F.lit(0)), F.coalesce(longer, F.lit(0))
        return F.when(others + on >= LEAST_LONGER, (on >= LEAST_LONGER) & (others < share * (others + on))).otherwise(otherwise)

    # Texts go on after the words before the last one, but hardly ever with this word, and never beyond it: a fragment.
    before = F.coalesce("before_longer", F.lit(0))
    rare = F.greatest(F.lit(1), before * FRAGMENT_SHARE)
    fragment = ~F.col("stop") & F.col("plain") & (F.coalesce("longer", F.lit(0)) == 0) & (F.coalesce("ends", F.lit(0)) <= rare) & (before >= LEAST_LONGER + 1)
    lost = F.coalesce("sure", F.when(fragment, True).otherwise(judged("ends", "longer", judged("tail_ends", "tail_longer", F.col("shape") == LOST))))
    return joined.where(lost).select("id").distinct()


def _compared_units(text: str) -> Iterator[str]:
    """Units as they are compared. A table row comes with the row before it, which tells tables with like rows apart."""
    before = None
    for line in text.split("\n"):
        if "|" in line:
            row = _normal(line)
            yield row
            if before is not None:
                yield f"{before}\n{row}"
            before = row
        else:
            before = None
            for unit in units(line):
                yield _normal(unit)


def _asked_unit(text: str) -> str:
    """The last unit of a passage, as it is compared."""
    lines = [x for x in text.split("\n") if x.strip()]
    if "|" in lines[-1] and len(lines) > 1 and "|" in lines[-2]:
        return f"{_normal(lines[-2])}\n{_normal(lines[-1])}"
    return _normal(_last_unit(text))


def _source_units(chunks: DataFrame, tables: DataFrame) -> DataFrame:
    """Units of all sources, whole."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {u for text in batch.column(0).to_pylist() if text for u in _compared_units(text)}
            yield pa.RecordBatch.from_arrays([pa.array([u for u in found if u], pa.string())], ["unit"])

    rows = F.transform("cell_rows", lambda r: F.array_join(r, " | ", ""))
    header = F.array(F.array_join("col_names", " | ", "")) if "col_names" in tables.columns else F.expr("cast(array() as array<string>)")
    grids = tables.select(F.array_join(F.concat(F.coalesce(header, F.array(F.lit(""))), rows), "\n").alias("text"))
    return chunks.select("text").unionByName(grids).mapInArrow(split, "unit string")


def _normal(unit: str) -> str:
    return " ".join(canonical_text(unit).split())


def _longer_copies(marked: DataFrame) -> DataFrame:
    """(unit, verdict) for asked units that stand whole in a source (WHOLE) or begin a longer unit of one (LOST).

    Input: unit, asked. Units are made distinct first, so no copy is a hot group, and then sorted over all partitions by
    ranges, so no beginning shared by many is one. All units that a unit begins follow it directly; they are scanned
    until one decides. Asked units still open at the end of a range are compared with the first unit of the next one
    that has any; where that begins with the unit and doesn't decide either, all units are looked through for them
    once more. The verdicts don't depend on the number of partitions.
    """
    spark = marked.sparkSession
    marked = materialize(marked.groupBy("unit").agg(F.bool_or("asked").alias("asked"), F.bool_or(~F.col("asked")).alias("there")), "p1-units")

    def rows(out: list[tuple[str, int, int | None]]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int32(), pa.int32()])], ["unit", "verdict", "part"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        open_units: list[str] = []  # asked units without a verdict, each of which begins the next
        begun = False
        for batch in batches:
            out: list[tuple[str, int, int | None]] = []
            for unit, asked, there in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not begun:
                    out.append((unit, FIRST, part))
                    begun = True
                while open_units and not unit.startswith(open_units[-1]):
                    open_units.pop()
                if open_units:
                    decided = [_goes_on(u, unit) for u in open_units]
                    out += [(u, LOST, None) for u, d in zip(open_units, decided) if d]
                    open_units = [u for u, d in zip(open_units, decided) if not d]
                if asked and there:
                    out.append((unit, WHOLE, None))
                elif asked:
                    open_units.append(unit)
            yield rows(out)
        yield rows([(u, LAST, part) for u in open_units])

    found = materialize(marked.repartitionByRange("unit").sortWithinPartitions("unit").mapInArrow(scan, "unit string, verdict int, part int"), "p1-copies")
    # From each partition its first unit, and those begun before its end, each of which begins the next: a few.
    edges = found.where("part is not null").collect()
    firsts = sorted((r["part"], r["unit"]) for r in edges if r["verdict"] == FIRST)
    lost, unsure = [], set()
    for r in edges:
        if r["verdict"] == LAST:
            at = bisect_right(firsts, (r["part"], "\U0010ffff"))
            if at < len(firsts) and firsts[at][1].startswith(r["unit"]):
                if _goes_on(r["unit"], firsts[at][1]):
                    lost.append(r["unit"])
                else:
                    unsure.add(r["unit"])
    decided = found.where("part is null").select("unit", "verdict")
    if unsure:
        sizes = sorted({len(u) for u in unsure})

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            left = set(unsure)
            for batch in batches:
                for unit in batch.column(0).to_pylist():
                    hits = {u for n in sizes if n < len(unit) and (u := unit[:n]) in left and _goes_on(u, unit)}
                    if hits:
                        left -= hits
                        yield rows([(u, LOST, None) for u in hits])

        decided = decided.unionByName(marked.select("unit").mapInArrow(look, "unit string, verdict int, part int").select("unit", "verdict").distinct())
    return decided.unionByName(spark.createDataFrame([(u, LOST) for u in lost], "unit string, verdict int"))


def _goes_on(unit: str, longer: str) -> bool:
    """True if ``longer``, which may begin with ``unit``, shows that the unit lost its end."""
    if len(longer) <= len(unit) or not longer.startswith(unit):
        return False
    rest = longer[len(unit) :]
    if rest[0] == "%" and unit[-1].isdigit() or rest[0] == ")" and unit.rsplit("|", 1)[-1].count("(") > unit.rsplit("|", 1)[-1].count(")"):
        return True  # a figure without its last sign
    # After a stop only a copy that goes on without a blank is longer: the stop is then a decimal point or the like.
    return any(c.isalnum() or c in "$|" for c in rest) and not (_TERMINAL.search(unit) and rest[0].isspace())


def passage_verdicts(passages: DataFrame, chunks: DataFrame, tables: DataFrame) -> DataFrame:
    """ids of passages that lost their end. Input: id, text; chunks: text; tables: cell_rows and, if there, col_names."""
    last_never = open_words(_distinct_texts(passages))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = content(value)
                if not text:
                    continue
                if damaged(text):
                    rows.append((k, True, None, LOST))
                    continue
                unit = _asked_unit(text)
                rows.append((k, None, unit or None, passage_form(text, last_never)))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [batch.schema.field(0).type, pa.bool_(), pa.string(), pa.int32()])], ["id", "sure", "unit", "shape"])

    kind = passages.schema["id"].dataType.simpleString()
    ends = materialize(passages.select("id", "text").mapInArrow(read, f"id {kind}, sure boolean, unit string, shape int").distinct(), "p1-ends")
    asked = ends.where("unit is not null").select("unit").withColumn("asked", F.lit(True))
    judged = _longer_copies(_source_units(chunks, tables).select("unit", F.lit(False).alias("asked")).unionByName(asked))
    joined = ends.join(judged, "unit", "left")
    return joined.where(F.coalesce("sure", F.coalesce("verdict", "shape") == LOST)).select("id").distinct()


def lost_ends(qa: DataFrame, chunks: DataFrame, tables: DataFrame) -> DataFrame:
    """(id, field_name) of values that lost their end.

    Null and blank values, placeholders and values without any content don't count. Repeated rows of an id are judged
    as one, further columns are ignored, and empty inputs give no rows.
    """
    passages = passage_verdicts(qa.select("id", F.col("source_passage").alias("text")).where("text is not null"), chunks, tables)
    answers = answer_verdicts(qa.select("id", F.col("answer").alias("text")).where("text is not null"))
    return passages.select("id", F.lit("source_passage").alias("field_name")).unionByName(answers.select("id", F.lit("answer").alias("field_name")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lost_ends(table(spark, sf_dir, "generated_qa"), table(spark, sf_dir, "chunks"), table(spark, sf_dir, "extracted_tables"))


def p1_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feed (null as its own): values with content, lost ends, and their share."""
    qa = table(spark, sf_dir, "generated_qa")
    lost = p1_found(spark, sf_dir)
    values = qa.select("id", "feed", F.explode(F.array(F.struct(F.lit("source_passage").alias("field_name"), F.col("source_passage").alias("v")), F.struct(F.lit("answer").alias("field_name"), F.col("answer").alias("v")))).alias("e")).select("id", "feed", "e.field_name", "e.v")
    values = values.where(_has_content(F.col("v"))).select("id", "field_name", "feed").groupBy("id", "field_name").agg(F.min("feed").alias("feed"))
    flagged = values.join(lost.withColumn("lost", F.lit(1)), ["id", "field_name"], "left")
    return flagged.groupBy("feed").agg(F.count("*").alias("n_values"), F.coalesce(F.sum("lost"), F.lit(0)).alias("n_lost")).withColumn("lost_share", F.round(F.col("n_lost") / F.col("n_values"), 6))


QUERIES = {"p1_found": p1_found, "p1_sources": p1_sources}
SQL: dict[str, str] = {}
