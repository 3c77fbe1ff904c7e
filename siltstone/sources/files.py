"""Tables from files, with columns added where old files lack them, and JSON documents."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tables' columns in DDL.
SCHEMAS = {
    "visited": "id long, url string",
    "queue": "id long, url string, type_ string",
    "audios": "id long, url string, audio_url string, file_name string, title string, desc_ string, lang string, cite string, license string, lieu string, doi string",
    "retry_schedule": "kind string, url string, attempts int, next_attempt double, error string",
    "crawl_state": "key string, value double",
    "audio_sizes": "audio_url string, size_bytes long, final_url string, status string, method string, detail string, checked_at double, attempts int, next_attempt double",
    "page_outcomes": "url string, status string, detail string, checked_at double",
    "downloads": "output_root string, audio_url string, status string, file_path string, size_bytes long, attempts int, next_attempt double, detail string, updated_at double",
}
RECEIPT = "audio_url string, file string, size_bytes long, final_url string, complete boolean, title string, languages array<string>, pages array<string>"
CHECKPOINT = "audio_url string, etag string, final_url string, total long"


#: Rows and bytes of an Arrow batch at most, but for one larger row.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what an Arrow batch of whole texts holds. Spark reads the bounds when a result is used, so they stay set in the session; larger ones only are lowered."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(f"spark.sql.execution.arrow.{name}"))
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, by the session's setting; a local one of our own only where all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='siltstone-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: worked out once, and lost executors cost no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of the schema, those that df lacks as nulls: old files get new columns."""
    fields = T.StructType.fromDDL(schema)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def read_state(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A state table, empty if it is not there yet."""
    if not path_exists(spark, f"{folder}/{name}"):
        return spark.createDataFrame([], SCHEMAS[name])
    return conform(spark.read.option("mergeSchema", "true").parquet(f"{folder}/{name}"), SCHEMAS[name])


def read_json(spark: SparkSession, path: str, schema: str, required: str) -> DataFrame:
    """JSON documents, one a file; those that cannot be read have no row."""
    texts = spark.read.text(path, wholetext=True).select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("d"))
    return texts.select("d.*").where(F.col(required).isNotNull())


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines; Spark's commit makes the folder whole or leaves it out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_documents(df: DataFrame, folder: str, name_col: str = "name") -> int:
    """Each row as a JSON document of its own, named by a column and without it; returns how many.

    Documents are written by tasks under a name that no reader looks at and renamed one by one, so that each is whole or not there, and
    a task that runs again writes the same documents again. Of rows of one name the last one to be written stays.
    """
    spark, others = df.sparkSession, [c for c in df.columns if c != name_col]
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    base = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString().rstrip("/")
    texts = df.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias("name"), F.to_json(F.struct(*others), {"ignoreNullFields": "false"}).alias("text"))

    def write(batches):
        import pandas as pd
        from pyarrow import fs

        local = base.startswith("file:")
        store, at = (fs.LocalFileSystem(), "/" + base.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(base)
        for batch in batches:
            for name, text in zip(batch["name"], batch["text"], strict=True):
                place = f"{at}/{name}"
                store.create_dir(place.rpartition("/")[0], recursive=True)
                draft = f"{place.rpartition('/')[0]}/.{uuid.uuid4().hex}.draft"
                with store.open_output_stream(draft) as out:
                    out.write(text.encode())
                store.move(draft, place)
            yield pd.DataFrame({"n": [len(batch)]})

    return texts.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """pos, url of a text file's lines, stripped, without blank ones, each url once at its first place."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("pos", "line"))
    urls = lines.select("pos", F.regexp_replace("line", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "").alias("url")).where("url <> ''")
    return urls.groupBy("url").agg(F.min("pos").alias("pos")).select("pos", "url")


def snapshot_path(url: Column) -> Column:
    """Where a page's snapshot lies: a folder by the first letters of its name, and the name, which the url's hash makes."""
    from siltstone.functions.text import snapshot_name

    name = snapshot_name(url)
    return F.concat(F.lit("prefix="), F.substring(name, 1, 2), F.lit("/"), name)


def write_snapshots(pages: DataFrame, folder: str) -> int:
    """Pages (url, html) by the names that their urls have, one of each; what is there already is not written again. Returns how many were new."""
    spark = pages.sparkSession
    where = F.split(snapshot_path(F.col("url")), "/")
    rows = pages.dropDuplicates(["url"]).select(F.substring(F.get(where, 0), 8, 2).alias("prefix"), F.get(where, 1).alias("name"), "url", "html")
    if rows.isEmpty():
        return 0
    there = read_snapshots(spark, folder).select("prefix", "name")  # names only, of the folders that occur
    fresh = stored(rows.join(there, ["prefix", "name"], "left_anti"), "snapshots")
    fresh.repartition("prefix").write.mode("append").partitionBy("prefix").parquet(folder)
    return fresh.count()


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """name, url, html, prefix of the snapshots."""
    schema = "name string, url string, html string, prefix string"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
