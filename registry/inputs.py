"""Log-like inputs derived from the given tables, for the registered queries and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k():
    """The number inside the event's JSON properties."""
    return F.get_json_object("props", "$.k").cast("int")


def win(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw device events."""
    host = F.concat(F.lit("host"), F.col("user_id").cast("string"))
    address = (
        F.when(F.col("user_id") % 29 == 0, "")
        .when(F.col("user_id") % 31 == 0, host)  # a name that is both a user and an entity
        .otherwise(F.concat(F.lit("10.0.0."), (F.col("user_id") % 40).cast("string")))
    )
    kinds = {"signup": "4624", "error": "4625", "click": "4688", "view": "4656"}
    event_id = F.lit("4672")
    for kind, number in kinds.items():
        event_id = F.when(F.col("event_type") == kind, number).otherwise(event_id)
    process = F.when(k() % 5 == 0, "powershell.exe").when(k() % 5 == 1, "job.ps1.bak").otherwise("cmd.exe")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        host.alias("devicehostname"),
        address.alias("deviceaddress"),
        event_id.alias("windowseventid"),
        process.alias("windowsprocessname"),
        F.when(k() % 2 == 0, "File").otherwise("Network").alias("windowslogontype"),
        (F.col("value") > 60).alias("is_alert"),
        F.when(k() % 3 == 0, "is_nu").when(k() % 3 == 1, "").alias("alerts_nu"),
        F.when(k() % 4 == 0, "is_ne").alias("alerts_ne"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        F.day("ts").alias("d"),
    )


def frozen_scores(activity: DataFrame) -> DataFrame:
    """Component scores by formula, some of them missing, in place of trained models."""
    return activity.withColumns(
        {
            "time_window": F.lit("day"),
            "zscore": F.concat(F.lit("logins="), F.col("logins_count").cast("string")),
            "pas_kmeans": F.when(
                F.col("d") % 7 != 0, ((F.col("logins_count") * 17 + F.col("total_events") * 3) % 101).cast("double")
            ),
            "pas_isolation": ((F.col("failedlogin_count") * 31 + F.col("total_events") * 5) % 101).cast("double"),
            "pas_svm": F.when(
                F.col("total_events") != 1,
                ((F.col("other_scripts_count") * 13 + F.col("total_events") * 7) % 101).cast("double"),
            ),
        }
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic events: ports as text, byte counts inside text."""
    received = F.concat(F.lit("rcvd_bytes="), F.col("l_quantity").cast("bigint").cast("string"), F.lit("; app_id=0"))
    sent = F.concat(F.lit("sent_bytes="), F.col("l_partkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_suppkey") % 7).cast("string").alias("dst_port"),
        (F.col("l_linenumber") + 1024).cast("string").alias("src_port"),
        F.when(F.col("l_linenumber") == 1, "").otherwise(received).alias("info_1"),
        F.when(F.col("l_linenumber") == 2, "").otherwise(sent).alias("info_2"),
    )


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail records: a comma list of sizes per record, some lists broken, some empty."""
    size = F.col("n_chars").cast("string")
    pair = F.concat(size, F.lit(", "), (F.col("n_chars") + 1).cast("string"))
    turn = F.col("doc_id") % 4
    sizes = F.when(turn == 0, F.concat(F.lit(","), size)).when(turn == 1, pair).when(turn == 2, "  ").otherwise(size)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("mail_id"), sizes.alias("mail_size"), (F.col("doc_id") % 3).cast("string").alias("ext_sndrs")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages: JSON text of every event, fields missing here and there."""
    fields = F.struct(
        F.when(F.col("event_type").isin("click", "view"), "demo_traffic").otherwise("demo_other").alias("source.type"),
        F.col("event_id").cast("string").alias("guid"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_name"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 40).cast("string")).alias("src_ip"),
        F.when(k() % 10 != 0, F.col("value")).alias("num1"),
        k().alias("num2"),
        F.when(k() % 7 != 0, F.col("event_type")).alias("cat1"),
        F.when(
            F.col("value") > 60,
            F.concat(
                F.lit("is_nu="),
                (k() % 2 == 0).cast("string"),
                F.lit(",is_ne="),
                (k() % 3 == 0).cast("string"),
                F.lit(",is_nwpu="),
                (k() % 5 == 0).cast("string"),
            ),
        ).alias("alerts"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        F.day("ts").alias("d"),
    )
    return table(spark, sf_dir, "events").select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("event_ts"),
        F.to_json(fields).alias("value"),
    )
