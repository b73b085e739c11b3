"""Queries straight on raw Parquet records; each reads only the columns it names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.metrics import exact_ratio, n_where, pct
from haulmark.sources.lake import quoted


def delay_by_weather(spark: SparkSession, table: str = "raw") -> DataFrame:
    return spark.sql(
        f"""
        SELECT weather_condition,
               count(*) AS shipments,
               CAST(round(CAST(100 * count_if(is_delayed) AS DECIMAL(20, 0)) / count(*), 2)
                    AS DOUBLE) AS delay_rate_pct
        FROM {quoted(table)}
        GROUP BY weather_condition
        ORDER BY delay_rate_pct DESC, weather_condition
        """
    )


def delay_by_traffic(records: DataFrame) -> DataFrame:
    c = F.col
    return (
        records.groupBy("traffic_condition")
        .agg(
            F.count("*").alias("shipments"),
            n_where(c("is_delayed")).alias("late"),
            F.sum("cost_usd").alias("cost"),
            F.count("cost_usd").alias("priced"),
        )
        .select(
            "traffic_condition",
            "shipments",
            pct(c("late"), c("shipments")).alias("delay_rate_pct"),
            exact_ratio(c("cost"), c("priced"), 2).alias("avg_cost_usd"),
        )
        .orderBy(F.desc("delay_rate_pct"), "traffic_condition")
    )


def row_count(records: DataFrame) -> DataFrame:
    """Answered from file footers: no column is read."""
    return records.agg(F.count("*").alias("shipments"))


def delay_rate(records: DataFrame) -> DataFrame:
    """Share of late shipments in each run."""
    late = n_where(F.col("is_delayed"))
    rate = pct(late, F.count("is_delayed"), 1).alias("delay_rate_pct")
    return records.groupBy("raw_file").agg(rate).orderBy("raw_file")
