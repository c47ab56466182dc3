"""Extensions for streams: the reference computes batches only. Gates over a stream, and the latest row of
each cluster kept as state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidar.functions.gates import Gate, ledger_codes, reason_codes


def gated_stream(stream: DataFrame, gates: list[Gate]) -> DataFrame:
    """A stream with reason_codes: stateless, so kept and ledger are two filters of one stream."""
    return stream.withColumn("reason_codes", ledger_codes(reason_codes(gates)))


def latest_by_cluster(stream: DataFrame, cluster: list[str], order: list[str], late: tuple[str, str] | None = None) -> DataFrame:
    """The latest row of each cluster, as an aggregate whose state is one row a cluster; late is the
    watermark (column, delay) after which a cluster's day is closed."""
    rows = stream.withWatermark(*late) if late else stream
    whole = F.struct(*order, *[c for c in stream.columns if c not in order])
    return rows.groupBy(*cluster).agg(F.max(whole).alias("latest"), F.count(F.lit(1)).alias("seen"))


def line_counts(stream: DataFrame, time: str, window: str, key: str, delay: str) -> DataFrame:
    """Counts by key in tumbling windows, rows later than delay left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window), key).agg(F.count(F.lit(1)).alias("n"))
