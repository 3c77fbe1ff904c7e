"""What the operators of this subpackage share: tables, scratch tables and Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.files import bound_batches, shared_folder

#: The white space that the operators split words at, as a Java regex class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Writes df to the shared folder, by the writer's options if any, and reads it back: lineage ends, lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes materialized tables on which nothing that is still to run depends."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of queries that are over and no longer referred to."""
    gc.collect()
    spark._jvm.System.gc()


_shipped: set[str] = set()


def prepare(spark: SparkSession, rows: int = 500) -> None:
    """For operators that run Python on executors: sends them the package, and bounds what an Arrow batch of whole texts holds."""
    bound_batches(spark, rows)
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId not in _shipped and package.is_dir():
        _shipped.add(context.applicationId)
        to = f"{tempfile.mkdtemp(prefix='siltstone-')}/{package.name}.zip"
        with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(to)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with signs after it as long as a column has it."""
    while name in df.columns:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z only, whatever the locale or script."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
