"""Receipts of downloads against the files that lie in the output root.

A receipt is a JSON document under ``_state``, named by the hash of its media url. It counts if it is complete and of
that url, if its file is under the root and of the size that it says, and if the file begins as audio does. Files are
listed by Spark (``binaryFile``); only of files that a receipt names is the beginning read, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.media import SCAN, audio_extension
from siltstone.functions.text import state_paths
from siltstone.operators.classify import receipt_valid
from siltstone.sources.files import RECEIPT, path_exists

LISTING = "path string, file string, length long"


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """path, file (relative to the root) and length of what lies in the root; empty files, receipts and checkpoints aside; contents are not read."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], LISTING)
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString().rstrip("/") + "/"
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    start = len(base.replace("file:///", "file:/"))
    return rows.select("path", F.substr(plain, F.lit(start + 1)).alias("file"), "length").where("file not like '\\_state/%'")


def read_receipts(spark: SparkSession, root: str) -> DataFrame:
    """name (of the document) and the receipt's columns; documents that are no receipts have no row."""
    schema = "name string, " + RECEIPT
    if not path_exists(spark, f"{root}/_state"):
        return spark.createDataFrame([], schema)
    texts = spark.read.option("pathGlobFilter", "*.json").text(f"{root}/_state", wholetext=True)
    rows = texts.select(F.concat(F.lit("_state/"), F.col("_metadata.file_name")).alias("name"), F.from_json("value", RECEIPT).alias("d"))
    return rows.where("name not like '%.partial.json'").select("name", "d.*").where("audio_url is not null")


def _head(path: str, most: int) -> bytes | None:
    from pyarrow import fs

    try:
        if path.startswith("file:"):
            store, at = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        else:
            scheme, _, rest = path.partition("://")
            host, _, at = rest.partition("/")
            store, at = fs.FileSystem.from_uri(f"{scheme}://{host}/{quote(at)}")
        with store.open_input_stream(at) as f:
            return f.read(most)
    except OSError:
        return None


def with_heads(rows: DataFrame, most: int = SCAN + 3) -> DataFrame:
    """Adds head, the first bytes of the file at path (null where it cannot be opened): read in tasks, no more than that many bytes of each."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(head=[_head(path, most) for path in batch["path"]])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", head binary"
    return rows.mapInPandas(read, schema)


def valid_receipts(media: DataFrame, receipts: DataFrame, listing: DataFrame) -> DataFrame:
    """Of media (audio_url): those whose receipt stands for a whole audio file of the listing."""
    named = media.select("audio_url", state_paths(F.col("audio_url"))[1].alias("name")).distinct()
    said = receipts.select("name", F.col("audio_url").alias("of"), "file", F.col("size_bytes").alias("said"), "complete")
    rows = named.join(said, "name").where("of = audio_url and complete").join(listing, "file").where("length = said")
    heads = with_heads(rows.select("audio_url", "of", "file", "said", "complete", "length", "path"))
    ok = receipt_valid(F.col("of") == F.col("audio_url"), F.col("complete"), F.col("file"), F.col("length"), F.col("said"), audio_extension(F.col("head")))
    return heads.where(ok).select("audio_url").distinct()
