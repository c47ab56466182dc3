"""What the training-data operators share: table access, the shared folder, written stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: U+0020 and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


#: Bytes of the batches that go to Python workers, whatever the number of their rows.
ARROW_BYTES = 4 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """spark, with the batches that go to its Python workers bounded in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_CACHES: dict[str, object] = {}


def worker_cache(name: str, make):
    """A Python worker's cache of this name. A worker serves one operator after another; it holds one cache at a time."""
    if name not in _CACHES:
        _CACHES.clear()
        _CACHES[name] = make()
    return _CACHES[name]


def release_caches() -> None:
    """For operators that hold none."""
    _CACHES.clear()


#: The temporary folder of a local session whose setting names none: it cannot be set once a session runs.
_OWN_ROOT: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a
    local[...] session without one (tests) gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _OWN_ROOT.append("file://" + tempfile.mkdtemp(prefix="evidar-")) if not _OWN_ROOT else None
        root = _OWN_ROOT[0]
    return f"{root.rstrip('/')}/evidar-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(found)] = (found, path)
    return found


#: The tables that written() has made and discard() has not deleted, by identity of their frames.
_WRITTEN: dict[int, tuple[DataFrame, str]] = {}


def discard(*tables: DataFrame) -> None:
    """Deletes what written() has made, once nothing that is still to run reads it."""
    for df in tables:
        found = _WRITTEN.pop(id(df), None)
        if found:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(found[1])
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def as_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: extra columns, whatever their names, play no part."""
    return df.select(*[df[c] for c in columns])


def free_names(docs: DataFrame, *names: str) -> dict[str, str]:
    """For each name one that no column of docs has, whatever its case."""
    prefix = "evidar_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return {n: prefix + n for n in names}
