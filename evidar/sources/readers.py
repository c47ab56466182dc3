"""Sources: JSON lines, archives, wikitext, pinned files. Schemas are given, never inferred."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PNG_MAGIC = bytes([0x89, 0x50, 0x4E, 0x47, 0x0D, 0x0A, 0x1A, 0x0A])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or pattern) has a file, in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False) -> DataFrame:
    """One JSON object a line; blank lines are skipped, a byte order mark too, anything else fails. A missing
    file fails unless missing_ok: then it has no rows."""
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\uFEFF", "").alias("line")).where(F.trim("line") != "")
    parsed = lines.select("line", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("row"))
    whole = F.trim("line").startswith("{")
    return parsed.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit("a line is no JSON object")))).select("row.*")


def read_batch(spark: SparkSession, pattern: str, schema: T.StructType, files: int, rows: int) -> DataFrame:
    """Files of a batch under an exact contract: so many files and so many rows, else it fails."""
    found = read_jsonl(spark, pattern, schema)
    names = spark.read.text(pattern).select(F.input_file_name().alias("f")).distinct().count()
    n = found.count()
    if (names, n) != (files, rows):
        raise ValueError(f"{names} files and {n} rows; {files} and {rows} are asked for")
    return found


def safe_relative(path: str) -> PurePosixPath:
    """A path that stays within its root: relative, without .., drive or backslash."""
    parts = PurePosixPath(path)
    if not path or "\\" in path or ":" in path or parts.is_absolute() or ".." in parts.parts:
        raise ValueError(f"unsafe path {path!r}")
    return parts


def resolve(root: str | Path, path: str) -> Path:
    """The place of a relative path under root, links followed."""
    base = Path(root).resolve()
    place = (base / safe_relative(path)).resolve()
    if not place.is_relative_to(base):
        raise ValueError(f"{path!r} leaves its root")
    return place


def pinned_bytes(path: str | Path, digest: str, outside: str | Path | None = None) -> bytes:
    """Bytes of a file whose SHA-256 must be the given one, and which must lie outside a root if one is named."""
    place = Path(path).resolve()
    if outside is not None and place.is_relative_to(Path(outside).resolve()):
        raise ValueError("an external file lies inside the root")
    data = place.read_bytes()
    if hashlib.sha256(data).hexdigest().lower() != digest.lower():
        raise ValueError("digest differs")
    return data


def tar_members(data: bytes, names: list[str], sha1: str) -> dict[str, object]:
    """Parsed JSON of named members of a tarball whose SHA-1 is pinned; members that repeat must be equal."""
    if hashlib.sha1(data).hexdigest().lower() != sha1.lower():
        raise ValueError("digest differs")
    out: dict[str, object] = {}
    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
        for member in tar.getmembers():
            safe_relative(member.name)
            if member.isfile() and member.name in names:
                value = json.loads(tar.extractfile(member).read())
                if member.name in out and out[member.name] != value:
                    raise ValueError(f"members {member.name} differ")
                out[member.name] = value
    if missing := set(names) - out.keys():
        raise ValueError(f"members are missing: {sorted(missing)}")
    return out


def wikitext_records(pages: DataFrame, page_id: str, text: str, template: str) -> DataFrame:
    """page_id, section, ordinal in the section and body of each {{template|...}} under ==headers==.

    The header of a record is the last one before it on its page, found in one expression over the page.
    """
    token = r"(?m)(^==+\s*[^=\n]+?\s*==+\s*$|\{\{" + template + r"\|[^{}]*\}\})"
    parts = pages.select(page_id, F.posexplode(F.regexp_extract_all(text, F.lit(token), 1)).alias("at", "part"))
    header = F.when(F.col("part").startswith("=="), F.regexp_extract("part", r"^==+\s*(.+?)\s*==+\s*$", 1))
    from pyspark.sql import Window

    by_page = Window.partitionBy(page_id).orderBy("at")
    found = parts.withColumn("section", F.last(header, True).over(by_page)).withColumn("run", F.sum(header.isNotNull().cast("int")).over(by_page)).where(~F.col("part").startswith("=="))
    ordinal = F.row_number().over(Window.partitionBy(page_id, "run").orderBy("at"))
    return found.select(page_id, "section", ordinal.alias("ordinal"), F.regexp_extract("part", r"^\{\{[^|]*\|(?s:(.*))\}\}$", 1).alias("body"))


def png_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, sha256, is_png (by signature and header chunk) of files."""
    c = F.col("content")
    header = (F.substring(c, 1, 8) == F.lit(PNG_MAGIC)) & (F.substring(c, 13, 4) == F.lit(b"IHDR"))
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"), F.coalesce(header, F.lit(False)).alias("is_png"))
