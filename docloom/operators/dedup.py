"""Removal of questions that say the same: similarity self-join and greedy keep-first."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..sources.providers import Embedder
from ..storage import materialize
from .verification import embed

#: Vectors that one task compares with as many others.
BLOCK_ROWS = 4000


def similar_pairs(vectors: DataFrame, above: float, group: str | None = None, key: str = "id", order: str = "ord", vector: str = "vector", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs (group, a, b, cosine) of one group, a before b in ``order``, whose cosine is strictly above the threshold.

    Rows are dealt to blocks by hash; a task gets two blocks of a group and multiplies them as matrices, so a group of
    any size is spread over (n / block_rows)^2 / 2 tasks of bounded memory. Vectors of length 0 are like nothing, rows
    with a null vector or key are left out, and a key that is repeated counts once.
    """
    base = vectors.select(F.col(group).cast("string").alias("g") if group else F.lit("").alias("g"), F.col(key).alias("k"), F.col(order).alias("o"), F.col(vector).alias("v")).where("k is not null and v is not null").dropDuplicates(["g", "k"])
    sizes = base.groupBy("g").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    dealt = base.join(sizes, "g").withColumn("mine", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = spread.select("g", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "k", "o", "v")
    types = vectors.select(key, order).schema
    schema = f"g string, a {types[0].dataType.simpleString()}, b {types[0].dataType.simpleString()}, a_ord {types[1].dataType.simpleString()}, b_ord {types[1].dataType.simpleString()}, cosine double"
    names = ["g", "a", "b", "a_ord", "b_ord", "cosine"]

    def compare(place: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        g, x, y = place
        frame = frame.sort_values(["o", "k"], kind="stable", ignore_index=True)
        mine = frame["mine"].to_numpy()
        one, two = np.flatnonzero(mine == x), np.flatnonzero(mine == y)
        if not len(one) or not len(two):
            return pd.DataFrame(columns=names)
        vectors_ = np.stack(frame["v"].to_list()).astype(np.float64)
        length = np.linalg.norm(vectors_, axis=1, keepdims=True)
        unit = np.divide(vectors_, length, out=np.zeros_like(vectors_), where=length > 0)
        found = []
        step = 1024
        for i in range(0, len(one), step):
            c = unit[one[i : i + step]] @ unit[two].T
            r, s = np.nonzero(c > above)
            left, right = one[r + i], two[s]
            fresh = left < right if x == y else np.ones(len(left), bool)
            found.append((np.minimum(left, right)[fresh], np.maximum(left, right)[fresh], c[r, s][fresh]))
        first, second, cosines = (np.concatenate(p) for p in zip(*found))
        a, b = frame.iloc[first], frame.iloc[second]
        return pd.DataFrame({"g": g, "a": a["k"].to_numpy(), "b": b["k"].to_numpy(), "a_ord": a["o"].to_numpy(), "b_ord": b["o"].to_numpy(), "cosine": cosines})

    return placed.groupBy("g", "x", "y").applyInPandas(compare, schema)


#: Undecided edges from which on the rest is decided in one task; it holds three numbers and two keys for each.
FINISH_EDGES = 200_000


def _finish(edges: DataFrame) -> DataFrame:
    """Decisions (n, kept) on all ends ``b`` of the edges, one after another in order; ``kept`` is what is known of ``a``."""
    kind = edges.schema["b"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kept = {a: k for a, k in zip(frame["a"], frame["kept"]) if k is not None and k == k}
        before: dict = {}
        for a, b, order in zip(frame["a"], frame["b"], frame["b_ord"]):
            before.setdefault((order, b), []).append(a)
        out = []
        for (_, b), earlier in sorted(before.items(), key=lambda x: x[0]):
            kept[b] = not any(kept[a] for a in earlier)
            out.append((b, kept[b]))
        return pd.DataFrame(out, columns=["n", "kept"])

    return edges.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(run, f"n {kind}, kept boolean")


def keep_first(nodes: DataFrame, pairs: DataFrame, key: str = "id", finish_edges: int = FINISH_EDGES) -> DataFrame:
    """(key, is_kept, dup_of, cosine): a node is dropped if an earlier kept one is similar to it.

    Dropped nodes drop no others. The sequential rule is reached by rounds: a node all of whose earlier neighbours are
    dropped is kept, and one with a kept earlier neighbour is dropped. Each round writes its new decisions and the edges
    still open to the shared folder. Once at most ``finish_edges`` edges are open, which is soon unless nodes form long
    chains, the rest is decided in one task; there is no limit to the rounds. dup_of is the first kept neighbour in order.
    """
    edges = materialize(pairs.select("a", "b", "a_ord", "b_ord", "cosine"), "dedup-edges")
    later = edges.select(F.col("b").alias("n")).distinct()
    fresh = materialize(edges.select(F.col("a").alias("n")).distinct().join(later, "n", "left_anti").select("n", F.lit(True).alias("kept")), "dedup-decided")
    state, left = fresh, edges.select("a", "b", "a_ord", "b_ord")
    while True:
        known = left.join(fresh.select(F.col("n").alias("a"), "kept"), "a", "left")
        verdict = known.groupBy(F.col("b").alias("n")).agg(F.bool_or(F.coalesce("kept", F.lit(False))).alias("hit"), F.count_if(F.col("kept").isNull()).alias("open"))
        fresh = materialize(verdict.where("hit or open = 0").select("n", (~F.col("hit")).alias("kept")), "dedup-decided")
        left = known.where("kept is null").drop("kept").join(fresh.select(F.col("n").alias("b")), "b", "left_anti")
        left = materialize(left.select("a", "b", "a_ord", "b_ord"), "dedup-open")
        state = state.unionByName(fresh)
        n_left = left.count()
        if not n_left:
            break
        if n_left <= finish_edges:
            known = left.join(fresh.select(F.col("n").alias("a"), "kept"), "a", "left")
            state = state.unionByName(materialize(_finish(known), "dedup-decided"))
            break
    kept = state.where("kept").select(F.col("n").alias("a"))
    reason = edges.join(kept, "a").groupBy(F.col("b").alias("n")).agg(F.min(F.struct("a_ord", "a", "cosine")).alias("by"))
    joined = nodes.join(state.withColumnRenamed("n", key), key, "left").join(reason.withColumnRenamed("n", key), key, "left")
    dropped = ~F.coalesce("kept", F.lit(True))
    return joined.select(*nodes.columns, (~dropped).alias("is_kept"), F.when(dropped, F.col("by.a")).alias("dup_of"), F.when(dropped, F.col("by.cosine")).alias("cosine"))


def deduplicate(qa: DataFrame, embedder: Embedder, by: str = "doc_id", config: Config = DEFAULT) -> DataFrame:
    """Candidates with is_kept, dup_of, cosine and dropped_reason; only questions are compared, within each document."""
    place = F.row_number().over(Window.partitionBy(by).orderBy("generation_order", "id"))
    vectors = embed(qa.select(by, "id", place.alias("ord"), "question"), embedder, "question", "vector", config.embed_batch)
    vectors = materialize(vectors.select(by, "id", "ord", "vector"), "dedup-vectors")
    pairs = similar_pairs(vectors, config.dedup_above, by)
    marked = keep_first(qa, pairs.drop("g"))
    first = qa.select(F.col("id").alias("dup_of"), F.col("question").alias("_q"))
    reason = F.concat(F.lit("duplicate of id="), "dup_of", F.lit(" (cosine_sim="), F.format_number("cosine", 3), F.lit("): "), "_q")
    return marked.join(first, "dup_of", "left").select(*marked.columns, F.when(~F.col("is_kept"), reason).alias("dropped_reason"))


def drop_rate(marked: DataFrame) -> DataFrame:
    """Rows, dropped rows and their percentage."""
    return marked.agg(F.count("*").alias("n_rows"), F.sum(F.when(F.col("is_kept"), 0).otherwise(1)).alias("n_dropped"), F.round(100 * F.avg(F.when(F.col("is_kept"), 0.0).otherwise(1.0)), 6).alias("drop_pct"))
