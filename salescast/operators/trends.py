"""Interest scores from events and the popularity refresh."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.operators.slices import drop_if_present, latest_date_slice
from salescast.sources.versions import current_version, publish, read_published
from salescast.staging import materialize


def interest_scores(events: DataFrame, days: int = S.WINDOW_DAYS, hits: str | None = None) -> DataFrame:
    """One score per brand with events in the trailing ``days``: (brand, score).

    The score is the last day's event count as a percentage of the brand's busiest day,
    0 for a brand that is silent on the last day. A row is one event, or as many as its column ``hits`` says.
    """
    newest = events.agg(F.max("ts").alias("ts")).select(
        (F.col("ts") - F.expr(f"INTERVAL {int(days)} DAYS")).alias("since"),
        F.to_date("ts").alias("last_day"))
    # Both bounds are scalar subqueries, so the events are filtered before they are grouped.
    daily = (
        events.where(F.col("ts") > newest.select("since").scalar())
        .groupBy("brand", F.to_date("ts").alias("day")).agg((F.sum(hits) if hits else F.count("*")).alias("hits"))
    )
    on_last_day = F.when(F.col("day") == newest.select("last_day").scalar(), F.col("hits"))
    return daily.groupBy("brand").agg(
        (100 * F.coalesce(F.max(on_last_day), F.lit(0)) / F.max("hits")).alias("score"))


def scores_for(brands: DataFrame, scores: DataFrame,
               fallback: float | None = S.FALLBACK_SCORE) -> DataFrame:
    """(brand, online_popularity) for each brand asked for; ``fallback`` where there is no score.

    With ``fallback=None`` a missing score stays null, to be filled with the others by the median.
    """
    score = F.col("score") if fallback is None else F.coalesce("score", F.lit(float(fallback)))
    return (brands.select("brand").where("brand IS NOT NULL").distinct()
            .join(scores, "brand", "left")
            .select("brand", score.alias("online_popularity")))


def popularity_refresh(sales: DataFrame, scores: DataFrame,
                       fallback: float | None = S.FALLBACK_SCORE) -> DataFrame:
    """Write the current score of each brand to all its rows.

    Only brands that sold on the latest date have a current score. The others get null for
    their whole history, which the median fill handles later.
    """
    # Stored, so that Spark sees its bytes and broadcasts it where it is small.
    current = materialize(scores_for(latest_date_slice(sales), scores, fallback), "current-scores")
    return drop_if_present(sales, "online_popularity").join(current, "brand", "left")


def keep_events(events: DataFrame, root: str, days: int = S.WINDOW_DAYS) -> None:
    """Merge a batch of events into the state ``root``: hits by brand and moment of the trailing ``days``.

    What is older than that can never count again, as the last moment only moves on, so the state stays as short as the
    window and earlier batches are not read again. A batch that another writer merges at the same time raises ``Conflict``.
    """
    spark = events.sparkSession
    version = current_version(spark, root)
    counted = events.where("brand IS NOT NULL AND ts IS NOT NULL").select("brand", "ts", F.lit(1).cast("long").alias("hits"))
    if version:
        counted = counted.unionByName(read_published(spark, root, version))
    merged = materialize(counted.groupBy("brand", "ts").agg(F.sum("hits").alias("hits")), "events")
    since = merged.agg((F.max("ts") - F.expr(f"INTERVAL {int(days)} DAYS")).alias("since"))
    publish(merged.where(F.col("ts") > since.scalar()), root, expected=version)


def kept_scores(spark: SparkSession, root: str, days: int = S.WINDOW_DAYS) -> DataFrame:
    """The interest scores of all events that :func:`keep_events` has merged."""
    return interest_scores(read_published(spark, root), days, hits="hits")


def store_scores(spark: SparkSession, events_root: str, root: str, brands: DataFrame, day: Date) -> DataFrame:
    """The scores of ``brands`` on ``day``: those stored under ``root``, and for the others new ones, which are stored too.

    A brand has one score a day, however often and by however many runs it is asked for.
    """
    version = current_version(spark, root)
    stored = read_published(spark, root, version) if version else spark.createDataFrame([], "brand string, day date, online_popularity double")
    asked = brands.select("brand").where("brand IS NOT NULL").distinct()
    today = stored.where(F.col("day") == day)
    missing = materialize(asked.join(today, "brand", "left_anti"), "unscored")
    if not missing.isEmpty():
        new = scores_for(missing, kept_scores(spark, events_root)).select("brand", F.lit(day).alias("day"), "online_popularity")
        publish(stored.unionByName(new), root, expected=version)
        today = read_published(spark, root).where(F.col("day") == day)
    return asked.join(today, "brand").select("brand", "online_popularity")
