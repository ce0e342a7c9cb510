import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from rawline.operators import external as ext
from rawline.runtime import ship_package


def test_flag_split(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 2)], "CUST_ID bigint, COD_ALLOWED int")
    assert rows(ext.flag_split(df), "CUST_ID", "operation") == [(1, "allow"), (2, "block")]


@pytest.mark.parametrize("n", [0, 1, 699, 700, 701, 1400])
def test_request_batches_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("CUST_ID"), F.lit("allow").alias("operation"))
    out = ext.request_batches(df, size=700, num_partitions=3)
    got = rows(out, "batch_index", "n_ids")
    expect = [(i, min(700, n - i * 700)) for i in range(-(-n // 700))]
    assert got == expect
    if n:
        ids = ",".join(r["id_list"] for r in out.orderBy("batch_index").collect()).split(",")
        assert ids == [str(i) for i in range(n)]


def test_number_within_equals_row_number(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "block").otherwise("allow").alias("op"),
        ((F.col("id") * 7919) % 100003).alias("cid"),
    )
    got = ext.number_within(df, "op", "cid", num_partitions=7)
    ref = df.withColumn("_rn", F.row_number().over(Window.partitionBy("op").orderBy("cid")))
    assert rows(got) == rows(ref)


def test_push_and_route(spark):
    ship_package(spark)
    df = spark.range(1, 121).select(F.col("id").alias("CUST_ID"), F.when(F.col("id") <= 100, "allow").otherwise("block").alias("operation"))
    payload = ext.number_requests(ext.request_batches(df, size=50))
    assert rows(payload, "operation", "batch_index", "request_seq", "op_total") == [
        ("allow", 0, 1, 100),
        ("allow", 1, 2, 100),
        ("block", 0, 3, 20),
    ]

    def client(params):
        ids = params["param1"].split(",")
        if ids[0] == "51":
            raise ConnectionError("reset")
        if params["param2"] == "block":
            return 500, "not json"
        return 200, "{}"

    resp = ext.push_requests(payload, client)
    status = ext.route_status(resp, "app", "PRD", "2024-01-01", "20240101000000")
    assert rows(status, "status", "record_count", "batch_record_count", "request_key") == [
        ("env:PRD & op:allow", 100, 50, "20240101000000000001" + "11")
    ]
    errors = ext.route_errors(resp, "2024-01-01", "20240101000000", "error string")
    assert rows(errors, "request_seq", "outcome", "error") == [(2, "exception", None), (3, "server_error", None)]
    assert rows(errors.filter("request_seq = 2"), "body")[0][0].startswith("ConnectionError")
