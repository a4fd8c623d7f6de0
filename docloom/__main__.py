"""Command line: ``python -m docloom PAGES OUT``.

Without addresses of models in the settings (``--config``), offline stand-ins are used. ``--url`` fetches a page into
PAGES first; with ``--url-table``, PAGES is a Parquet table of addresses (doc_id, url) that the executors fetch.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from .config import DEFAULT, Config, set_up_logging
from .plans.pipeline import run
from .sources.files import fetch_page, fetch_pages, read_pages
from .storage import materialize


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="docloom", description="Turn HTML filings into verified questions and answers.")
    add = parser.add_argument
    add("pages", help="folder of HTML files, or the table of addresses")
    add("out", help="folder for the output")
    add("--config", help="JSON file of settings")
    add("--prompts", help="folder of prompt templates, one for each question type")
    add("--stages", help="folder for chunks and tables; they are reused if they are there")
    add("--skip-verification", action="store_true", help="keep all candidates unchecked")
    add("--format", choices=["csv", "jsonl"], help="format of the output")
    add("--url", help="page to fetch into the folder, unless it is there")
    add("--url-table", action="store_true", help="PAGES is a table of addresses")
    add("--ticker", default="page")
    add("--accession", default="0")
    add("--agent", default="", help="user agent that names you")
    add("--force-refetch", action="store_true", help="fetch even if the page is there")
    given = parser.parse_args(argv)
    config = Config.load(given.config) if given.config else DEFAULT
    changes = {"output_format": given.format, "prompts_folder": given.prompts}
    config = config.with_(**{k: v for k, v in changes.items() if v})
    set_up_logging(config)
    if given.url:
        fetch_page(given.url, Path(given.pages), given.ticker, given.accession, given.agent, given.force_refetch, config)
    spark = SparkSession.builder.appName("docloom").getOrCreate()
    pages = materialize(fetch_pages(spark.read.parquet(given.pages), given.agent, config), "pages") if given.url_table else read_pages(spark, given.pages)
    run(pages, skip_verify=given.skip_verification, out_path=given.out, config=config, stage_path=given.stages)


if __name__ == "__main__":
    main()
