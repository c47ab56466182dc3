"""Digests of tables of any size, and a manifest that freezes a published table: rows, parts and one root.

Leaves are sorted by range and paired level by level; each level is half the one below, is written, and only its number goes to the
driver. A frozen table is re-derived and compared by its digests; what differs is named, row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.sources.stages import staged

#: Leaves that one task pairs up by itself.
LOT = 1 << 16


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """leaves in this order with their place from 0 on. Only the number of leaves of each range goes to the driver."""
    dealt = staged(leaves.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("at", 33).cast("int")
    counts = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, total = [], 0
    for row in counts:
        before.append((row.part, total))
        total += row.n
    starts = leaves.sparkSession.createDataFrame(before, "part int, before long")
    return dealt.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "before", "at")  # a row a range


def parents(level: DataFrame) -> DataFrame:
    """place, digest of the next level: a node is the SHA-256 of its two children, the last one standing alone being both."""
    pair = level.groupBy(F.shiftright("place", 1).alias("place")).agg(F.min_by("digest", "place").alias("a"), F.max_by("digest", "place").alias("b"))
    return pair.select("place", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("digest"))


def merkle_levels(leaves: DataFrame, digest: str) -> list[DataFrame]:
    """The levels of the tree over the sorted digests (hex), leaves first, the root last, each place and digest (bytes). Of no leaves
    the root is the empty string."""
    level = placed(leaves.select(F.unhex(digest).alias("digest")), ["digest"]).select("place", "digest")
    level = staged(level, "merkle")
    n, out = level.count(), [level]
    if n == 0:
        return [leaves.sparkSession.createDataFrame([(0, b"")], "place long, digest binary")]
    while n > 1:
        level = staged(parents(level), "merkle")
        out.append(level)
        n = (n + 1) // 2
    return out


def merkle_root(leaves: DataFrame, digest: str) -> DataFrame:
    """One row: root, in upper-case hex."""
    return merkle_levels(leaves, digest)[-1].select(F.upper(F.hex("digest")).alias("root"))


def row_digests(rows: DataFrame, key: str, part: str) -> DataFrame:
    """key, part and digest (SHA-256, hex) of the row's canonical JSON: members by name, nulls and all."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    return rows.select(F.col(key).cast("string").alias("key"), F.col(part).cast("string").alias("part"), F.sha2(body.cast("binary"), 256).alias("digest"))


def part_digests(digests: DataFrame) -> DataFrame:
    """part, n and digest of each part: the sum of its rows' digests as numbers below 2**256, by limbs that add up in each task in any
    order, digested with their number. No task holds a part."""
    limbs = [F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)") for k in range(8)]
    sums = digests.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{k}") for k, x in enumerate(limbs)])
    return sums.select("part", "n", F.sha2(F.concat_ws("|", "n", *[F.col(f"s{k}") for k in range(8)]).cast("binary"), 256).alias("digest"))


def freeze(rows: DataFrame, key: str, part: str) -> tuple[DataFrame, DataFrame]:
    """manifest (level, part, key, n, digest) with a line for each row, each part and the whole, and the row digests. Keys that repeat
    are an error of the caller's: verify() names them."""
    digests = staged(row_digests(rows, key, part), "frozen-rows")
    parts = staged(part_digests(digests), "frozen-parts")
    none = F.lit(None).cast("string")
    root = merkle_root(parts.select("digest"), "digest").crossJoin(digests.agg(F.count(F.lit(1)).alias("n")))  # both are one row
    line = lambda level, part, key, n, digest: [F.lit(level).alias("level"), part.alias("part"), key.alias("key"), n.alias("n"), digest.alias("digest")]
    manifest = (
        digests.select(*line("row", F.col("part"), F.col("key"), F.lit(1).cast("long"), F.col("digest")))
        .unionByName(parts.select(*line("part", F.col("part"), none, F.col("n"), F.col("digest")))).unionByName(root.select(*line("root", none, none, F.col("n"), F.lower("root")))))
    return manifest, digests


def verify(rows: DataFrame, key: str, part: str, manifest: DataFrame) -> DataFrame:
    """What differs from the manifest, a line each: part, key and code (row_changed, row_added, row_missing, key_repeated,
    part_moved). None where the table is the frozen one. Only rows of parts whose digest differs are compared."""
    digests = staged(row_digests(rows, key, part), "verified-rows")
    now = part_digests(digests).select(F.col("part").alias("now_part"), F.col("digest").alias("now"))
    then = manifest.where("level = 'part'").select(F.col("part").alias("then_part"), F.col("digest").alias("then"))
    moved = now.join(then, F.col("now_part").eqNullSafe(F.col("then_part")), "full").where(~F.col("now").eqNullSafe(F.col("then")))
    moved = staged(moved.select(F.coalesce("now_part", "then_part").alias("suspect")).distinct(), "verified-parts")
    of = lambda frame: frame.join(moved, F.col("part").eqNullSafe(F.col("suspect")), "left_semi")
    a = of(digests).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("part"), F.min("digest").alias("digest"))
    b = of(manifest.where("level = 'row'")).groupBy("key").agg(F.min("part").alias("was_part"), F.min("digest").alias("was"), F.count(F.lit(1)).alias("was_n")).withColumnRenamed("key", "was_key")
    both = a.join(b, F.col("key").eqNullSafe(F.col("was_key")), "full")
    code = (
        F.when(F.col("was_n").isNull(), "row_added").when(F.col("n").isNull(), "row_missing").when(F.col("n") > F.col("was_n"), "key_repeated")
        .when(~F.col("part").eqNullSafe(F.col("was_part")), "part_moved").when(F.col("digest") != F.col("was"), "row_changed"))
    return both.select(F.coalesce("part", "was_part").alias("part"), F.coalesce("key", "was_key").alias("key"), code.alias("code")).where("code is not null")


def append_manifest(spark: SparkSession, path: str, manifest: DataFrame) -> str:
    """Writes the manifest under its own root's name and returns that path. A path holds one content for ever: where the root is
    there already nothing is written, and no manifest ever replaces another."""
    manifest = staged(manifest, "manifest")
    root = manifest.where("level = 'root'").first().digest
    into = f"{path.rstrip('/')}/{root}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{into}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        manifest.write.mode("overwrite").parquet(into)
    return into
