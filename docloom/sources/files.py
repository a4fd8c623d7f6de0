"""Reading and writing: pages, intermediate JSON, CSV and JSON lines, and a cached page fetcher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config, logger

CHUNK_SCHEMA = "doc_id bigint, chunk_id string, heading_path string, part string, item string, text string, token_estimate int, order_index int"
TABLE_SCHEMA = "doc_id bigint, table_id string, heading_path string, part string, item string, order_index int, n_rows int, n_cols int, columns array<string>, rows array<array<string>>, raw_html string"


class FetchError(RuntimeError):
    """A page couldn't be fetched after all attempts."""


def cache_name(ticker: str, accession: str) -> str:
    return f"{ticker.lower()}_{accession}.htm"


def fetch_page(url: str, folder: Path, ticker: str, accession: str, agent: str, force: bool = False, config: Config = DEFAULT, opener: Callable = urlopen, sleep: Callable[[float], None] = time.sleep) -> Path:
    """Path of the page in the cache folder, fetched if it isn't there or ``force`` is set.

    Failures of the connection are retried with a wait that grows with each attempt.
    """
    if not agent or "example" in agent.lower():
        logger(__name__).warning("set a user agent that names you; servers may refuse the placeholder")
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / cache_name(ticker, accession)
    if path.exists() and not force:
        return path
    last: Exception | None = None
    for attempt in range(1, config.http_retries + 1):
        try:
            with opener(Request(url, headers={"User-Agent": agent}), timeout=config.http_timeout_s) as reply:
                path.write_bytes(reply.read())
            return path
        except OSError as error:
            last = error
            sleep(config.http_backoff_s * attempt)
    raise FetchError(f"{url}: {last}") from last


def fetch_pages(urls: DataFrame, agent: str, config: Config = DEFAULT, opener: Callable | None = None) -> DataFrame:
    """Pages of a table of addresses (doc_id, url): doc_id, url, html, and the error where all attempts failed.

    Pages are fetched by the executors, with the same retries as a single one; write the result before using it twice.
    A null address gives an error.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pages, errors = [], []
            for url in frame["url"]:
                page, error = None, "no address" if not url else None
                for attempt in range(1, config.http_retries + 1 if url else 1):
                    try:
                        with (opener or urlopen)(Request(url, headers={"User-Agent": agent}), timeout=config.http_timeout_s) as reply:
                            page, error = reply.read().decode("utf-8", "replace"), None
                        break
                    except OSError as failure:
                        error = str(failure)
                        time.sleep(config.http_backoff_s * attempt)
                pages.append(page)
                errors.append(error)
            yield frame.assign(html=pages, error=errors)

    return urls.selectExpr("cast(doc_id as bigint) as doc_id", "url").mapInPandas(run, "doc_id bigint, url string, html string, error string")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a folder of HTML files: doc_id (a hash of the path), url (the path), html."""
    files = spark.read.format("text").option("wholetext", True).load(path)
    return files.select(F.xxhash64(F.col("_metadata.file_path")).alias("doc_id"), F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines with nulls written out, so that strict readers find every field."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of exactly this schema; records that don't fit it fail the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_csv(rows: DataFrame, path: str, single: bool = True) -> None:
    """CSV with a header and doubled quotes; truth values as Python writes them. ``single`` gives one file."""
    flags = [f.name for f in rows.schema if f.dataType.typeName() == "boolean"]
    written = rows.withColumns({c: F.initcap(F.col(c).cast("string")) for c in flags}) if flags else rows
    (written.coalesce(1) if single else written).write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def write_output(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """The finished rows as JSON lines if asked for, else as CSV."""
    (write_json if kind == "jsonl" else write_csv)(rows, path)
