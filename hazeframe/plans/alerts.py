"""Alert rules as one small rule table joined to current metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions.predicates import present

RULE_SCHEMA = "rule string, metric string, comparison string, threshold double"


def province_metrics(status: DataFrame, as_of) -> DataFrame:
    """Per-province maxima that the rules look at, one row per metric."""
    def recent(hours):
        return F.col("latest_hour") >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    wide = status.filter(present("province") & recent(3)).groupBy("province").agg(
        F.max(F.when(recent(2), F.col("current_aqi_vn"))).alias("aqi_2h"),
        F.max("pm25").alias("pm25_3h"), F.max("pm10").alias("pm10_3h"))
    return wide.unpivot(["province"], ["aqi_2h", "pm25_3h", "pm10_3h"], "metric", "observed").withColumnRenamed("province", "subject")


def platform_metrics(summary: DataFrame) -> DataFrame:
    names = ["latest_ingest_lag_hours", "latest_lag_hours", "reliable_pct", "attention_count"]
    wide = summary.select(F.lit("platform").alias("subject"), *[F.col(n).cast("double").alias(n) for n in names])
    return wide.unpivot(["subject"], names, "metric", "observed")


def fired(metrics: DataFrame, rules=fv.ALERT_RULES) -> DataFrame:
    """Metrics that break a rule.  Works on a batch or inside ``foreachBatch``."""
    table = metrics.sparkSession.createDataFrame(list(rules), RULE_SCHEMA)  # a handful of literal rows
    value, bound = F.col("observed"), F.col("threshold")
    broken = ((F.col("comparison") == ">") & (value > bound)) | ((F.col("comparison") == "<") & (value < bound))
    return (metrics.join(F.broadcast(table), "metric").filter(broken)
            .select("rule", "subject", "metric", "observed", "threshold"))


def alerts(status: DataFrame, summary: DataFrame, as_of) -> DataFrame:
    return fired(province_metrics(status, as_of).unionByName(platform_metrics(summary)))
