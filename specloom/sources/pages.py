"""Stored pages: keys, scans and triage."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def file_key(url: Column) -> Column:
    """File name of a stored page, without its extension."""
    return F.translate(url, "/:", "__")


def with_page_keys(pages: DataFrame) -> DataFrame:
    """The three keys under which a page may be stored."""
    url = F.col("url")
    return pages.withColumns({"file_key": file_key(url), "cache_key": F.sha2(url, 256), "short_key": F.substring(F.md5(url), 1, 12)})


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """A directory of HTML files, one row per file. The name gives the key to join with ``file_key``."""
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.html").load(path)
    return files.select(F.regexp_replace("_metadata.file_name", r"\.html$", "").alias("file_key"),
                        F.col("value").alias("html"), F.col("_metadata.file_modification_time").alias("fetched_at"))


def pages_for(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Stored files with the url of the catalog entries that refer to them."""
    urls = catalog.where("product_url IS NOT NULL").select(F.col("product_url").alias("url")).distinct()
    return urls.withColumn("file_key", file_key(F.col("url"))).join(files, "file_key")


def _files(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs
    local = re.sub(r"\Afile:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


def write_page_files(pages: DataFrame, path: str) -> None:
    """``pages(url, html)`` as files ``<file_key>.html`` of one directory, written by the tasks that hold the pages.

    Rows without a url or HTML, or with an empty one, are left out (readers don't list empty files); of several copies of a url the caller chooses one before. A file is written under another
    name first, so a task that is tried again never leaves half a page.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, folder = _files(path)
        target.create_dir(folder, recursive=True)
        for batch in batches:
            for key, html in zip(batch["file_key"], batch["html"]):
                name = os.path.join(folder, f"{key}.html")
                with target.open_output_stream(f"{name}.{os.getpid()}") as out:
                    out.write(html.encode("utf-8"))
                target.move(f"{name}.{os.getpid()}", name)
            yield pd.DataFrame({"n": [len(batch)]})

    rows = pages.where("url IS NOT NULL AND html <> ''").select(file_key(F.col("url")).alias("file_key"), "html")
    rows.mapInPandas(write, "n long").agg(F.sum("n")).collect()


def read_wanted_files(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The files of a directory whose name is in ``keys(file_key)``, as ``file_key, html, fetched_at``.

    The directory is listed without its contents (the binary source reads them only where that column is asked for), the names meet the
    keys, and only what is left is opened. The names are dealt out before that, so that wanted files are read by all tasks alike. A file that goes
    in between is left out, as if it had not been listed.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path).select(
        "path", F.regexp_extract("path", r"([^/]*)\.html$", 1).alias("file_key"), F.col("modificationTime").alias("fetched_at"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 64):
                part, html = batch.iloc[start:start + 64], []
                for name in part["path"]:
                    source, file = _files(name)
                    try:
                        with source.open_input_stream(file) as page:
                            html.append(page.read().decode("utf-8", "replace"))
                    except FileNotFoundError:
                        html.append(None)
                out = part[["file_key"]].assign(html=html, fetched_at=part["fetched_at"])
                yield out[out["html"].notna()]

    wanted = listed.join(keys.select("file_key").distinct(), "file_key", "left_semi")
    return wanted.repartition("path").mapInPandas(read, "file_key string, html string, fetched_at timestamp")


def pages_of_run(spark: SparkSession, path: str, catalog: DataFrame) -> DataFrame:
    """``url, html, fetched_at`` of the stored files that catalog entries refer to; no other file is opened."""
    urls = catalog.where("product_url IS NOT NULL").select(F.col("product_url").alias("url")).distinct().withColumn("file_key", file_key(F.col("url")))
    return urls.join(read_wanted_files(spark, path, urls), "file_key").select("url", "html", "fetched_at")


def triage(pages: DataFrame, as_of: Column | None = None, ttl_seconds: int = 86400) -> DataFrame:
    """Stale, needs rendering (tiny or without a body) and too short, as flags.

    Only lengths and flags leave the scan, not the HTML.
    """
    html = F.col("html")
    size = F.length(html)
    needs_render = (size < 1000) | ~html.rlike("(?i)<body")
    stale = F.lit(False) if as_of is None else (
        F.unix_timestamp(as_of) - F.unix_timestamp("fetched_at") >= ttl_seconds)
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, size.alias("size"), stale.alias("stale"), needs_render.alias("needs_render"),
                        (size < 2000).alias("too_short"))

