"""Audio and video: sizes, durations, bitrates, processing, accessibility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import gigabytes, megabytes, minutes, row_count
from ..functions.names import col
from ..operators import distribution, frequency

LONG_MINUTES = 150
LARGE_GIGABYTES = 1.5
CENTRAL = 0.99
LOW_TAIL, HIGH_TAIL = 0.01, 0.99
UNDER_ENCODED_MINUTES = 10
BITRATE_BINS = 50


def by_type(media: DataFrame) -> DataFrame:
    """``type, n, mean_minutes, mean_mb``: durations over timed items only, sizes
    over all; one aggregate."""
    timed = F.when(F.col("duration") > 0, F.col("duration"))
    return (
        media.where(F.col("type").isNotNull())
        .groupBy("type")
        .agg(
            row_count().alias("n"),
            minutes(F.avg(timed)).alias("mean_minutes"),
            megabytes(F.avg("revision_size")).alias("mean_mb"),
        )
    )


def extremes(
    media: DataFrame,
    *,
    long_minutes: float = LONG_MINUTES,
    large_gb: float = LARGE_GIGABYTES,
) -> DataFrame:
    """One row: long items and the longest, large items and the largest; maxima
    are 0 without any item."""
    timed = F.when(F.col("duration") > 0, minutes(F.col("duration")))
    size = gigabytes(F.col("revision_size"))
    return media.agg(
        F.count_if(timed > long_minutes).alias("n_long"),
        F.coalesce(F.max(timed), F.lit(0.0)).alias("max_minutes"),
        F.count_if(size > large_gb).alias("n_large"),
        F.coalesce(F.max(size), F.lit(0.0)).alias("max_gb"),
    )


def processing(media: DataFrame) -> DataFrame:
    return frequency.status_long(
        media,
        {
            "Transcoding": col("required_transcoding"),
            "Transcription": col("required_transcribing"),
        },
    )


def transcription_need(media: DataFrame) -> DataFrame:
    return frequency.need_by_group(media, "type", col("required_transcribing"))


def timed(media: DataFrame) -> DataFrame:
    return distribution.timed_media(media, "duration", "revision_size")


def size_duration_regions(media: DataFrame, *, prob: float = CENTRAL) -> DataFrame:
    """``type, region, n``: items within both global percentiles, and the rest."""
    labelled = distribution.central_or_outlier(
        timed(media), ["duration_min", "revision_size"], prob
    )
    return frequency.value_counts(labelled, "type", "region")


def bitrate_tails(media: DataFrame) -> DataFrame:
    return distribution.bitrate_tails(
        timed(media),
        low=LOW_TAIL,
        high=HIGH_TAIL,
        long_minutes=UNDER_ENCODED_MINUTES,
    )


def bitrate_histogram(media: DataFrame, *, bins: int = BITRATE_BINS) -> DataFrame:
    """Histogram of the bitrates between the two tail percentiles."""
    items = timed(media).select("bitrate_mbps")
    limits = distribution.percentile_values(items, {"bitrate_mbps": [LOW_TAIL, HIGH_TAIL]})
    low, high = (F.lit(x).cast("double") for x in limits["bitrate_mbps"])
    central = items.where(F.col("bitrate_mbps").between(low, high))
    return distribution.histogram(central, "bitrate_mbps", bins)


def bitrate_by_source(media: DataFrame) -> DataFrame:
    """Box-plot figures by source, without the high tail."""
    items = timed(media).select("source", "bitrate_mbps")
    limit = distribution.percentile_value(items, "bitrate_mbps", HIGH_TAIL)
    return distribution.box_plot(
        items.where(F.col("bitrate_mbps") <= limit), "bitrate_mbps", "source"
    )
