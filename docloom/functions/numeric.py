"""Deterministic arithmetic check of answers, as column expressions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a figure with optional bracket, sign, currency and percent sign.
NUMBER = r"\(?-?\$?[0-9][0-9,]*\.?[0-9]*\)?%?"
# Fixed value: order in which relations between two figures are tried.
RELATIONS = ("difference", "abs_difference", "sum", "percent_change", "ratio", "product")


def number_value(token: Column) -> Column:
    """Value of one figure as written; null if it can't be read as a number.

    Brackets around the whole, or a leading minus, make it negative; ``(1,234)%`` is positive and ``-$5`` is unreadable.
    """
    negative = (F.startswith(token, F.lit("(")) & F.endswith(token, F.lit(")"))) | F.startswith(token, F.lit("-"))
    bare = F.ltrim(F.replace(F.btrim(token, F.lit("()%$")), F.lit(","), F.lit("")), F.lit("-"))
    value = F.when(bare.rlike(r"^[0-9]+\.?[0-9]*$"), bare.try_cast("double"))
    return F.when(negative, -value).otherwise(value)


def numbers(text: Column) -> Column:
    """All readable figures in order, repeats kept; none for a null text."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(0))
    return F.filter(F.transform(tokens, number_value), lambda x: x.isNotNull())


def claimed_value(answer: Column) -> Column:
    """First figure after the last equals sign, or else the first of all; null without any."""
    first = lambda a: F.try_element_at(numbers(a), F.lit(1))
    after = F.when(F.contains(answer, F.lit("=")), F.element_at(F.split(answer, "=", -1), -1))
    return F.coalesce(first(after), first(answer))


def within_tolerance(a: Column, b: Column, pct: float) -> Column:
    """Is ``a`` within ``pct`` percent of ``b``; within a millionth if ``b`` is 0."""
    return F.when(b == 0, F.abs(a - b) < 1e-6).otherwise(F.try_divide(F.abs(a - b), F.abs(b)) * 100.0 <= pct)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used: a lambda over an array of one."""
    return F.transform(F.array(value), use)[0]


def _relations(a: Column, b: Column) -> Column:
    """Results of all relations, in their order; null where one isn't defined."""
    return F.array(a - b, F.abs(a - b), a + b, F.try_divide(a - b, F.abs(b)) * 100.0, F.try_divide(a, b), a * b)


def matched_relationship(values: Column, claimed: Column, pct: float) -> Column:
    """First relation, over ordered pairs of figures, whose result the claimed value is within tolerance of.

    Only the first match is kept while folding, so memory stays that of one pair however many figures there are.
    """
    spots = F.sequence(F.lit(1), F.size(values))
    names = F.array(*[F.lit(name) for name in RELATIONS])

    def pair(a: Column, b: Column) -> Column:
        hits = F.transform(_relations(a, b), lambda y: F.coalesce(within_tolerance(claimed, y, pct), F.lit(False)))
        return F.get(names, F.array_position(hits, True).cast("int") - 1)

    def inner(i: Column):
        return lambda found, j: F.when(found.isNotNull() | (i == j), found).otherwise(pair(F.element_at(values, i), F.element_at(values, j)))

    def outer(found: Column, i: Column) -> Column:
        return F.when(found.isNotNull(), found).otherwise(F.aggregate(spots, F.lit(None).cast("string"), inner(i)))

    return F.when(F.size(values) >= 2, F.aggregate(spots, F.lit(None).cast("string"), outer))


def numeric_check(passage: Column, answer: Column, pct: float = 1.0) -> Column:
    """Struct of pass, numbers, claimed, relationship and reason.

    A claimed value must be found; one figure can only be restated; of several, some pair must be related to it. Null
    passages have no figures, and null answers no claimed value.
    """

    def related(x: Column) -> Column:
        values, claimed = x["numbers"], x["claimed"]
        direct = (F.size(values) == 1) & within_tolerance(claimed, F.try_element_at(values, F.lit(1)), pct)
        relation = F.when(claimed.isNull(), None).when(F.size(values) < 2, F.when(direct, F.lit("direct_match"))).otherwise(matched_relationship(values, claimed, pct))
        return F.struct(values.alias("numbers"), claimed.alias("claimed"), relation.alias("relationship"))

    def judged(x: Column) -> Column:
        values, claimed, relation = x["numbers"], x["claimed"], x["relationship"]
        reason = (
            F.when(claimed.isNull(), F.lit("no figure in the answer"))
            .when(relation == "direct_match", F.lit("restates the only figure"))
            .when(F.size(values) < 2, F.concat(F.lit("figures in the passage: "), F.size(values).cast("string")))
            .when(relation.isNotNull(), F.concat(F.lit("matches "), relation))
            .otherwise(F.lit("no relation of two figures fits"))
        )
        return F.struct(relation.isNotNull().alias("pass"), values.alias("numbers"), claimed.alias("claimed"), relation.alias("relationship"), reason.alias("reason"))

    read = F.struct(numbers(passage).alias("numbers"), claimed_value(answer).alias("claimed"))
    return _bound(_bound(read, related), judged)
