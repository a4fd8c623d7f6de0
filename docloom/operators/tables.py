"""Tables: those of scanned pages with the headings above them, clean-up, rendering, and their turn into passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.text import words
from .chunking import heading_level, with_heading_state

TABLE_ORDER_BASE = 1_000_000


def extract_tables(scanned: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Usable tables of scanned pages with the nearest headings before them (an as-of join by windows)."""
    level = F.when(F.col("kind") == "block", heading_level(F.col("text"), F.col("bold_ul"), F.col("italic"), config))
    state = with_heading_state(scanned.withColumn("level", level)).where("kind = 'table'")
    numbered = state.withColumn("order_index", (F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) - 1).cast("int"))
    return numbered.select("doc_id", F.format_string("table_%04d", "order_index").alias("table_id"), "heading_path", "part", "item", "order_index", F.size("rows").alias("n_rows"), F.size("columns").alias("n_cols"), "columns", "rows", "raw_html")


def drop_empty(columns: Column, rows: Column) -> tuple[Column, Column]:
    """Column names and rows without the rows, and then the columns, that hold no value at all."""
    blank = lambda c: c.isNull() | (c == "") | (F.lower(c) == "nan")
    kept = F.filter(rows, lambda r: F.exists(r, lambda c: ~blank(c)))
    used = F.transform(columns, lambda _, i: F.exists(kept, lambda r: ~blank(F.get(r, i))))
    return F.filter(columns, lambda _, i: F.get(used, i)), F.transform(kept, lambda r: F.filter(r, lambda _, i: F.get(used, i)))


def pipe_text(columns: Column, rows: Column) -> Column:
    """Header and rows as lines of cells with bars between them; nulls and "nan" are empty."""
    cell = lambda c: F.when(c.isNull() | (F.lower(c) == "nan"), "").otherwise(c)
    line = lambda r: F.array_join(F.transform(r, cell), " | ")
    return F.array_join(F.concat(F.array(line(columns)), F.transform(rows, line)), "\n")


def table_passages(tables: DataFrame, by: str = "doc_id", columns: str = "columns", rows: str = "rows") -> DataFrame:
    """Tables as chunks, ordered after all others; their size is their number of words."""
    text = pipe_text(F.col(columns), F.col(rows))
    order = F.row_number().over(Window.partitionBy(by).orderBy("order_index", "table_id")) - 1 + TABLE_ORDER_BASE
    return tables.select(by, F.col("table_id").alias("chunk_id"), "heading_path", "part", "item", text.alias("text"), F.size(words(text)).alias("token_estimate"), order.cast("int").alias("order_index"))
