"""Choice of passages for generation: question types, pairing within sections, even-stride sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config


def draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone, the same in every engine: 13 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / float(16**13)


def pair_chunks(chunks: DataFrame, question_type: str, by: str = "doc_id", config: Config = DEFAULT) -> DataFrame:
    """Groups of one or two chunks: chunk_id, second_id (null for one), position.

    For types that may take two, a seeded share of the chunks draws a sibling of the same part and item (nulls are equal)
    by its rank in the section; a sibling already drawn by an earlier chunk stays with that one. Ranks and sizes come
    from windows over sections, so no chunk meets all its siblings.
    """
    base = chunks.select(by, "chunk_id", "part", "item", "order_index")
    position = F.row_number().over(Window.partitionBy(by).orderBy("order_index", "chunk_id")) - 1
    if question_type not in config.multi_chunk_types:
        return base.select(by, "chunk_id", F.lit(None).cast("string").alias("second_id"), position.alias("position"))
    section = Window.partitionBy(by, "part", "item")
    ranked = base.withColumn("position", position).withColumn("rank", F.row_number().over(section.orderBy("order_index", "chunk_id")) - 1).withColumn("size", F.count("*").over(section))
    seed = F.lit(str(config.seed))
    wants = (F.col("size") > 1) & (draw(seed, F.lit(question_type), F.lit("pair"), F.col(by).cast("string"), F.col("chunk_id")) < config.pair_probability)
    pick = F.floor(draw(seed, F.lit(question_type), F.lit("partner"), F.col(by).cast("string"), F.col("chunk_id")) * (F.col("size") - 1))
    ranked = ranked.withColumn("wanted", F.when(wants, F.when(pick >= F.col("rank"), pick + 1).otherwise(pick)))
    partners = ranked.select(by, F.col("part").alias("p"), F.col("item").alias("i"), F.col("rank").alias("r"), F.col("chunk_id").alias("second_id"))
    left = ranked.alias("a").join(partners.alias("b"), (F.col(f"a.{by}") == F.col(f"b.{by}")) & F.col("part").eqNullSafe(F.col("p")) & F.col("item").eqNullSafe(F.col("i")) & (F.col("wanted") == F.col("r")), "left")
    first = F.row_number().over(Window.partitionBy(F.col(f"a.{by}"), "second_id").orderBy("position"))
    return left.withColumn("n", first).select(F.col(f"a.{by}").alias(by), "chunk_id", F.when((F.col("n") == 1), F.col("second_id")).alias("second_id"), "position")


def stride_sample(groups: DataFrame, cap: int, by: str = "doc_id", order: str = "position") -> DataFrame:
    """At most ``cap`` groups of each document, spread evenly over its order; all of them if there are no more.

    The positions taken are the whole parts of i * (n / cap) in floating point, found by inverting the step at each row
    instead of joining a list of positions.
    """
    ranked = groups.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1).withColumn("_n", F.count("*").over(Window.partitionBy(by)))
    step = F.col("_n") / F.lit(float(cap))
    near = F.floor(F.col("_k") / step)
    hit = lambda i: (i >= 0) & (i < cap) & (F.floor(i * step) == F.col("_k"))
    return ranked.where((F.col("_n") <= cap) | hit(near) | hit(near + 1) | hit(near - 1)).drop("_k", "_n")
