"""Shared folder, stored intermediates and small column helpers."""

from __future__ import annotations

import atexit
import functools
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

# Word separators of every word-based contract: space and U+0009..U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only a local session that names none gets a folder of its own, because
    there the driver's disk is every executor's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="ledgerstar-llm-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, removed when the driver exits."""
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_made)
    _made.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
    if path in _made:
        _made.remove(path)


def _remove_made() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for path in list(_made):
        remove_folder(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is
    cut, a lost executor costs only running tasks, later passes reuse it."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Named columns of a given table; naming them here keeps extra columns
    (whatever their names) out of the plan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns that clash (in any case) with names an operator adds."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


ARROW_BATCH_BYTES = 8 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, which may have no
    copy of it, and set the session's Arrow batch size; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    # texts are long: smaller batches than the usual 64 MB keep a worker's memory low
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerstar-code-"), "ledgerstar_llm.zip")
    with zipfile.ZipFile(archive, "w") as z:
        z.write(os.path.join(package, "__init__.py"), "ledgerstar/__init__.py")
        for name in sorted(os.listdir(os.path.join(package, "llm"))):
            if name.endswith(".py"):
                z.write(os.path.join(package, "llm", name), f"ledgerstar/llm/{name}")
    spark.sparkContext.addPyFile(archive)


def shipped(query):
    """The query, with the package sent to the executors before it runs."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)

    return run
