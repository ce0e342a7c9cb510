"""Hot groups: one key, operation, gstin or batch holding a large share of
the rows. Results must stay exact on the skew-handling paths."""

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from rawline.operators import external as ext
from rawline.operators import responses as rsp
from rawline.operators.dedupe import latest_in_delta
from rawline.operators.publish import retention_candidates

N = 6000


def test_hot_key_top1(spark):
    df = spark.range(N).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"),
        F.format_string("2024-01-01 %05d", F.col("id")).alias("kafka_ts"),
        F.col("id").cast("string").alias("trail_file_pos"),
    )
    out = latest_in_delta(df, ["k"])
    hot = out.filter("k = -1").collect()
    assert len(hot) == 1 and hot[0]["trail_file_pos"] == str(max(i for i in range(N) if i % 3 == 0))
    assert out.count() == 101


def test_hot_operation_numbering_spans_partitions(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 10 == 0, "block").otherwise("allow").alias("op"), ((F.col("id") * 7) % 100003).alias("cid")
    )
    got = ext.number_within(df, "op", "cid", num_partitions=8)
    ref = df.withColumn("_rn", F.row_number().over(Window.partitionBy("op").orderBy("cid")))
    assert rows(got) == rows(ref)
    # the hot operation is numbered by several tasks, not one
    parts = got.filter("op = 'allow'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_hot_gstin_status_join(spark):
    api = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("gstin"), "id"
    )
    st = spark.createDataFrame([("HOT", "VALID"), ("HOT", "ACTIVE"), ("5", "VALID"), ("7", "CANCELLED")], "gstin string, status string")
    out = rsp.valid_records(api, st)
    assert out.filter("gstin = 'HOT'").count() == 2 * (N // 3) and out.filter("gstin != 'HOT'").count() == 1


def test_hot_batch_retention(spark):
    log = spark.range(N).select(
        F.lit("a").alias("app_name"), F.lit("t").alias("table_name"),
        F.when(F.col("id") % 3 == 0, F.lit("100")).otherwise((F.col("id") % 50 + 200).cast("string")).alias("batch_no"),
        F.when(F.col("id") % 7 == 0, "batch_deleted").otherwise("file_sync").alias("activity_type"),
    )
    got = {r["batch_no"]: r["file_sync"] for r in retention_candidates(log, "a", "t").collect()}
    ref = {
        r["batch_no"]: r["fs"]
        for r in log.groupBy("batch_no").agg(
            F.sum((F.col("activity_type") == "file_sync").cast("int")).alias("fs"),
            F.sum((F.col("activity_type") == "batch_deleted").cast("int")).alias("bd"),
        ).filter("fs > 0 and bd = 0").collect()
    }
    assert got == ref


def test_hot_partition_value_is_written_by_several_tasks(spark):
    """A partition value holding half of the rows: the rebalance hint lets
    AQE split it over several writers (several files), and every row is
    written once."""
    import os

    from rawline.runtime import scratch_path
    from rawline.sinks.files import write_partitioned

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(0, 60000, 1, 8).select(
            F.col("id"),
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("part_1"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        out = scratch_path(spark, "hotwrite")
        write_partitioned(df, out, ["part_1"], fmt="parquet", mode="overwrite")
    finally:
        spark.conf.set(key, old)
    local = out[len("file:"):] if out.startswith("file:") else out
    hot_files = [f for f in os.listdir(os.path.join(local, "part_1=hot")) if f.endswith(".parquet")]
    assert len(hot_files) > 1
    back = spark.read.parquet(out)
    assert back.count() == 60000 and back.select("id").distinct().count() == 60000
    assert back.filter("part_1 = 'hot'").count() == 30000
