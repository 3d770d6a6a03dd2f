"""Join sides: which may be broadcast, and which keys have to be spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of all rows on, so there are at most HOT_SHARE of them.
HOT_SHARE = 200


def may_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of ``df``, made from the sizes of its files, is below the session's broadcast limit.

    No job runs. The estimate of a join is the product of its sides and says nothing, so ask for single tables.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(plan.stats().sizeInBytes()) <= limit


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> Column:
    """The keys that hold at least one row in ``share``, as an array of at most ``share`` values.

    A scalar subquery: it runs as part of the query that uses it. Rows are counted per key on the map side
    first, so a hot key costs one row per task. Counts are exact, hence the same wherever the value is used.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    limit = counts.agg(F.sum("_n") / share).scalar()
    return F.coalesce(counts.where(F.col("_n") >= limit).agg(F.sort_array(F.collect_list(key))).scalar(), F.array())
