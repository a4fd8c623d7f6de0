"""Column builders on text: tokens, number tokens, truncation, fences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a blank; Java's own class of blanks lacks the no-break space and its kin.
BLANK = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


BLANKS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(text: Column) -> Column:
    """Without blanks of any kind at either end."""
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Words between blanks; none for blank and null texts."""
    stripped = strip(text)
    return F.when(F.length(stripped) > 0, F.split(stripped, f"{BLANK}+")).otherwise(F.expr("cast(array() as array<string>)"))


def token_estimate(text: Column, per_word: float = 1.3) -> Column:
    """Words times ``per_word``, rounded down; 0 for blank and null texts."""
    return F.floor(F.size(words(text)) * F.lit(float(per_word))).cast("int")


def truncate_to_budget(text: Column, limit: int = 3000) -> Column:
    """At most ``limit`` characters, cut at the last line end unless that is in the first half, then a marker."""
    head = F.substring(text, 1, limit)
    last = F.length(head) - F.instr(F.reverse(head), "\n")  # characters before the last line end
    cut = F.when((F.instr(head, "\n") > 0) & (last >= limit * 0.5), last).otherwise(F.lit(limit)).cast("int")
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(head.substr(F.lit(1), cut), F.lit("\n[... truncated for length ...]")))


def pair_text(first: Column, second: Column) -> Column:
    """The text of one passage, or of two with a marker between them."""
    return F.when(second.isNull(), first).otherwise(F.concat_ws("\n--- NEXT PASSAGE ---\n", first, second))


def strip_fences(text: Column) -> Column:
    """Without a Markdown fence around it."""
    opened = F.regexp_replace(strip(text), f"^```(?:json)?{BLANK}*", "")
    return strip(F.regexp_replace(opened, f"{BLANK}*```$", ""))


def number_set(text: Column) -> Column:
    """Distinct figures as written, without thousands separators; a stop after the last digit is kept."""
    found = F.regexp_extract_all(text, F.lit(r"-?[0-9][0-9,]*\.?[0-9]*"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(""))))


def json_text(raw: Column, brackets: str = "[]") -> Column:
    """The JSON text in a model's reply: the whole if it parses, else the part from the first opening to the last closing bracket."""
    clean = strip_fences(raw)
    inner = F.regexp_extract(clean, rf"(?s)\{brackets[0]}.*\{brackets[1]}", 0)
    return F.when(F.try_parse_json(clean).isNotNull(), clean).when(F.try_parse_json(inner).isNotNull(), inner)
