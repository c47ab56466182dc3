"""Exact dedup by stateful streaming deduplication, in DataFrame and SQL functions only.

A digest log (digest, stable identifier, content locator) is streamed into a keyed
aggregation whose state lives in RocksDB, without watermark or expiry: for each digest
it retains the first holder and the number of hits. The state is then read as a table.
Texts whose digest was hit are compared in full, byte for byte, before the result counts.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import SPACE_CLASS, free_names, fresh_path, table, written

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "8",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """Every run of white space is one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")


def digest_log(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: uid (of the row), id, digest of the normalised text, locator (its file)."""
    return docs.select(
        F.monotonically_increasing_id().alias("uid"),
        docs[id_col].alias("id"),
        F.unhex(F.sha2(normalised(docs[text_col]).cast("binary"), 256)).alias("digest"),
        F.input_file_name().alias("locator"),
    )


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def keyed_state(stream: DataFrame) -> DataFrame:
    """The stateful operator: for each digest its first holder (least id, null last; then least uid)
    and the count of its rows. Works on any stream of digest_log rows, also one without rows, where ids and
    digests are null or repeat; its state never expires."""
    return stream.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "uid", "locator")).alias("first"),
        F.count(F.lit(1)).alias("hits"),
    )


def run_stream(spark: SparkSession, log_path: str, schema, checkpoint: str, max_bytes: int = 256 << 30) -> DataFrame:
    """Feeds the digest log to the state, in micro-batches; a rerun with the same checkpoint goes on
    where it stopped, and files added to the log meet the digests retained before. Returns the state."""
    with _conf(spark, _STATE_CONF):
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes).parquet(log_path)
        query = (
            keyed_state(stream).writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        # read while the bounds of the state's memory hold
        state = spark.read.format("statestore").load(checkpoint).select(F.col("key.digest").alias("digest"), F.col("value.*")).toDF("digest", "first", "hits")
        return written(state, "dedup-digests")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", checkpoint: str | None = None) -> DataFrame:
    """Returns a row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space runs became one space; null counts as
    empty. Of equal texts the row with the least id stays; a null id comes after all others.
    Where rows repeat with text and id, exactly one of them is kept. An empty table gives no
    rows. Other columns of docs play no part. With a checkpoint (a folder of the caller's) a run that
    was stopped goes on with the same digest log and state; it is for one table and serves one run.
    """
    spark = docs.sparkSession
    resumed, root = checkpoint is not None, checkpoint or fresh_path(spark, "dedup-state")
    log_path, checkpoint = f"{root}/log", f"{root}/state"
    log = digest_log(docs, id_col, text_col)
    if not (resumed and _complete(spark, log_path)):
        log.write.mode("overwrite").parquet(log_path)
    log = spark.read.schema(log.schema).parquet(log_path)
    state = run_stream(spark, log_path, log.schema, checkpoint)
    members = written(
        log.select("uid", "id", "digest").join(
            state.select("digest", F.col("first.id").alias("keep_id"), F.col("first.uid").alias("keep_uid"), "hits"), "digest"
        ),
        "dedup-members",
    )
    return _result(_checked(docs, members, id_col, text_col))


def _checked(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Compares the full bytes of all texts that share a digest. Should two texts differ, their
    rows are grouped by the text itself."""
    hits = members.where("hits > 1").select("id", "digest").distinct()
    texts = (
        docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
        .join(hits.select("id").distinct().withColumnRenamed("id", "hit_id"), F.col("id").eqNullSafe(F.col("hit_id")), "left_semi")
        .select("id", normalised(F.col("text")).alias("text"))
        .withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    )
    clashes = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high")
    clashes = written(clashes.select("digest"), "dedup-clashes")
    if clashes.isEmpty():
        return members
    parted = (
        texts.join(clashes, "digest").select("id", "digest", F.sha2(F.concat(F.lit("clash"), "text"), 512).alias("part")).distinct()
        .join(members.select("uid", "id", "digest").withColumnRenamed("id", "member_id").withColumnRenamed("digest", "member_digest"),
              F.col("id").eqNullSafe(F.col("member_id")) & (F.col("digest") == F.col("member_digest")))
    )
    first = parted.groupBy("digest", "part").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "uid")).alias("first"), F.count(F.lit(1)).alias("hits"))
    mended = parted.select("uid", "id", "digest", "part").join(first, ["digest", "part"]).select(
        "digest", "uid", "id", F.col("first.id").alias("keep_id"), F.col("first.uid").alias("keep_uid"), "hits")
    return members.join(clashes, "digest", "left_anti").unionByName(mended)


def _result(members: DataFrame) -> DataFrame:
    return members.select(
        F.col("id"),
        "keep_id",
        F.col("hits").alias("group_size"),
        (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "uid",
    )


def dedup_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names; of rows that repeat id and
    text, one. Nulls, long texts and an empty table as in exact_dedup()."""
    name = free_names(docs, "digest", "stays", "stays_digest", "again", "again_digest")
    stays = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("id").alias(name["stays"]), F.unhex("text_sha256").alias(name["stays_digest"]))
    keyed = docs.withColumn(name["digest"], F.unhex(F.sha2(normalised(docs[text_col]).cast("binary"), 256)))
    digest = F.col(name["digest"])
    rows = keyed.join(stays, keyed[id_col].eqNullSafe(F.col(name["stays"])) & (digest == F.col(name["stays_digest"])), "left_semi")
    repeated = keyed.groupBy(keyed[id_col].alias(name["again"]), digest.alias(name["again_digest"])).agg(F.count(F.lit(1)).alias("count"))
    repeated = written(repeated.where("count > 1").drop("count"), "dedup-repeated")
    if not repeated.isEmpty():
        same = rows[id_col].eqNullSafe(F.col(name["again"])) & (digest == F.col(name["again_digest"]))
        rows = rows.join(repeated, same, "left_anti").unionByName(
            rows.join(repeated, same, "left_semi").dropDuplicates([id_col, name["digest"]]))
    return rows.drop(name["digest"])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, text_sha256
FROM t
"""
