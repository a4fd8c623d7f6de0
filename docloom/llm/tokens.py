"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rank file of a byte-level BPE, as ``tiktoken`` reads it; a parameter of every operator that counts tokens.
VOCABULARY = os.environ.get("DOCLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the published pre-tokenization pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, name: str = "n_tokens") -> DataFrame:
    """The columns of ``df`` except ``text``, and ``name``: the size of ``text`` in tokens; null and empty texts have 0."""
    others = [c for c in df.columns if c not in (text, name)]
    schema = T.StructType([*df.select(*[F.col(f"`{c}`") for c in others]).schema.fields, T.StructField(name, T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            sizes = [len(encode(value)) if value else 0 for value in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], [*others, name])

    return df.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`")).mapInArrow(count, schema)
