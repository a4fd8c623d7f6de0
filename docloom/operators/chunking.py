"""From blocks to chunks: heading state, islands between headings, packing of long texts, merging of small ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.text import BLANK, strip, token_estimate, words

# Headings by their words. The blanks include the no-break space.
PART = rf"(?i)^{BLANK}*PART{BLANK}+[IVXLC]+(?![\p{{L}}\p{{N}}_])"
ITEM = rf"(?i)^{BLANK}*ITEM{BLANK}+\p{{Nd}}+[A-Z]?(?:\.|:|{BLANK}+-|(?![\p{{L}}\p{{N}}_]))"


def heading_level(text: Column, bold_ul: Column, italic: Column, config: Config = DEFAULT) -> Column:
    """0 part, 1 item, 2 bold or underlined capitals, 3 other styled heading, null for body text.

    A styled heading has fewer words than the limit and doesn't end in a stop, comma or semicolon.
    """
    plain = strip(text)
    # Cheap conditions first: words are only counted where the style and the end are those of a heading.
    short = (bold_ul | italic) & (F.length(plain) > 0) & ~F.substring(plain, -1, 1).isin(*".!?;,") & (F.size(words(text)) < config.heading_words_below)
    capitals = plain.rlike(r"\p{L}") & ~plain.rlike(r"[\p{L}&&[^\p{Lu}]]")
    return F.when(text.rlike(PART), 0).when(text.rlike(ITEM), 1).when(bold_ul & short & capitals, 2).when(short, 3)


def with_heading_state(blocks: DataFrame, by: str = "doc_id", order: str = "pos") -> DataFrame:
    """Adds part, item, h2, h3 and heading_path as they stand at each row, the row's own heading included.

    Input: ``by``, ``order``, text, level. Each level resets those below it. One sort by document serves all windows.
    """
    upto = lambda *keys: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = strip(F.col("text"))
    out = blocks
    scopes = [by]
    for level, name in enumerate(("part", "item", "h2", "h3")):
        at = F.col("level") == level
        out = out.withColumn(name, F.last(F.when(at, mark), ignorenulls=True).over(upto(*scopes)))
        if level < 3:
            out = out.withColumn(f"_{name}", F.sum(F.when(at, 1).otherwise(0)).over(upto(*scopes)))
            scopes.append(f"_{name}")
    path = F.coalesce(F.nullif(F.concat_ws(" > ", "part", "item", "h2", "h3"), F.lit("")), F.lit("Untitled"))
    return out.drop("_part", "_item", "_h2").withColumn("heading_path", path)


def sections(blocks: DataFrame, by: str = "doc_id", order: str = "pos") -> DataFrame:
    """Body texts between two headings, joined by line ends, with the headings above them. Empty ones give no row."""
    state = with_heading_state(blocks, by, order)
    running = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = state.withColumn("section", F.sum(F.when(F.col("level").isNotNull(), 1).otherwise(0)).over(running))
    body = state.where("level is null")
    grouped = body.groupBy(by, "section").agg(
        *[F.first(c).alias(c) for c in ("heading_path", "part", "item")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), "\n").alias("text"),
    )
    return grouped.withColumn("text", strip(F.col("text"))).where(F.length("text") > 0)


def pack_paragraphs(text: Column, config: Config = DEFAULT) -> Column:
    """Pieces of a text: the whole up to the maximum, else its lines packed greedily up to the target.

    A piece's size is the sum of its lines' own (rounded) estimates; a line over the target is kept whole.
    """
    size_of = lambda t: token_estimate(t, config.tokens_per_word)
    lines = F.transform(F.filter(F.transform(F.split(text, "\n", -1), strip), lambda p: F.length(p) > 0), lambda p: F.struct(p.alias("line"), size_of(p).alias("size")))
    start = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("current"), F.lit(0).alias("size"))

    def add(acc: Column, item: Column) -> Column:
        empty = F.length(acc["current"]) == 0
        flush = ~empty & (acc["size"] + item["size"] > config.target_tokens)
        return F.struct(
            F.when(flush, F.array_append(acc["done"], acc["current"])).otherwise(acc["done"]).alias("done"),
            F.when(flush | empty, item["line"]).otherwise(F.concat_ws("\n", acc["current"], item["line"])).alias("current"),
            F.when(flush, item["size"]).otherwise(acc["size"] + item["size"]).alias("size"),
        )

    packed = F.aggregate(lines, start, add, lambda acc: F.when(F.length(acc["current"]) > 0, F.array_append(acc["done"], acc["current"])).otherwise(F.array(text)))
    return F.when(size_of(text) <= config.max_tokens, F.array(text)).otherwise(packed)


def split_long(parts: DataFrame, by: str = "doc_id", order: str = "section", config: Config = DEFAULT) -> DataFrame:
    """Chunks of all sections, numbered through each document in order."""
    pieces = parts.select(by, order, "heading_path", "part", "item", F.posexplode(pack_paragraphs(F.col("text"), config)).alias("piece", "text"))
    numbered = pieces.withColumn("order_index", (F.row_number().over(Window.partitionBy(by).orderBy(order, "piece")) - 1).cast("int"))
    return numbered.select(by, F.format_string("chunk_%05d", "order_index").alias("chunk_id"), "heading_path", "part", "item", "text", token_estimate(F.col("text"), config.tokens_per_word).alias("token_estimate"), "order_index")


_CHUNK = "struct<order_index:int,chunk_id:string,heading_path:string,part:string,item:string,text:string,token_estimate:int>"


def merge_small(chunks: DataFrame, by: str = "doc_id", config: Config = DEFAULT) -> DataFrame:
    """Chunks under the minimum go into the next one, the last into the one before.

    The receiver keeps its id and headings; a chunk merged forward hands on its position. One fold over each document's
    chunks in order, all in the JVM: a document is the unit that must be seen in order, and its chunks are bounded by it.
    """
    fields = ["order_index", "chunk_id", "heading_path", "part", "item", "text", "token_estimate"]
    ordered = chunks.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("all"))
    small = lambda c: c["token_estimate"] < config.min_tokens

    def joined(first: Column, second: Column, keep: Column, position: Column) -> Column:
        text = F.concat_ws("\n", first["text"], second["text"])
        return F.struct(position.cast("int").alias("order_index"), *[keep[c].alias(c) for c in fields[1:5]], text.alias("text"), token_estimate(text, config.tokens_per_word).alias("token_estimate"))

    # held: the chunk not yet emitted, which may still take the next one in front of it.
    start = F.struct(F.expr(f"cast(array() as array<{_CHUNK}>)").alias("done"), F.expr(f"cast(null as {_CHUNK})").alias("held"))

    def add(acc: Column, chunk: Column) -> Column:
        held = acc["held"]
        merge = held.isNotNull() & small(held)
        done = F.when(held.isNotNull() & ~small(held), F.array_append(acc["done"], held)).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.when(merge, joined(held, chunk, chunk, held["order_index"])).otherwise(chunk).cast(_CHUNK).alias("held"))

    def finish(acc: Column) -> Column:
        held, done, n = acc["held"], acc["done"], F.size(acc["done"])
        last = F.element_at(done, -1)
        backward = F.array_append(F.slice(done, 1, n - 1), joined(last, held, last, last["order_index"]).cast(_CHUNK))
        return F.when(held.isNull(), done).when(small(held) & (n > 0), backward).otherwise(F.array_append(done, held))

    return ordered.select(by, F.explode(F.aggregate("all", start, add, finish)).alias("c")).select(by, *[f"c.{c}" for c in ("chunk_id", "heading_path", "part", "item", "text", "token_estimate", "order_index")])


def blocks_with_levels(scanned: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Blocks of scanned pages with their heading level; repeats of an inner block are left out."""
    blocks = scanned.where("kind = 'block' and not is_repeat").select("doc_id", "pos", "text", "bold_ul", "italic")
    return blocks.withColumn("level", heading_level(F.col("text"), F.col("bold_ul"), F.col("italic"), config))


def chunk_pages(scanned: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Chunks of scanned pages."""
    return merge_small(split_long(sections(blocks_with_levels(scanned, config)), config=config), config=config)
