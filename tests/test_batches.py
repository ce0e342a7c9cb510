import pytest
from conftest import rows
from pyspark.sql import functions as F

from rawline.functions.batch_ids import is_valid_batch_id
from rawline.operators.batches import (
    batch_predicate,
    extract_mark,
    high_water_mark,
    incremental_filter,
    select_batches,
    substitute_mark,
    valid_batch_text,
)

CASES = {
    "20240115103000": True,
    "20240230000000": False,  # no such day
    "2024011510300": False,  # 13 digits
    "2024O115103000": False,  # letter
    "20241315103000": False,
    "": False,
}


def test_valid_batch_text():
    for text, ok in CASES.items():
        assert valid_batch_text(text) is ok, text
    assert valid_batch_text(None) is False


def test_valid_batch_column_matches_driver_check(spark):
    df = spark.createDataFrame([(k,) for k in CASES] + [(None,)], "b string")
    got = dict(df.select("b", is_valid_batch_id("b").alias("v")).collect())
    assert got[None] is False
    for text, ok in CASES.items():
        assert got[text] is ok, text


@pytest.fixture
def listing(spark):
    names = ["20240101000000", "20240102000000", "20240103000000", "20240230000000", "junk"]
    return spark.createDataFrame([(n,) for n in names], "batchno string")


def test_closed_open_and_mark(spark, listing):
    assert rows(select_batches(listing, start="20240102000000", end="20240103000000")) == [
        ("20240102000000",),
        ("20240103000000",),
    ]
    # start only: open range; invalid names are never taken (they sort above digits)
    assert rows(select_batches(listing, start="20240102000000")) == [("20240102000000",), ("20240103000000",)]
    # no start: after the mark, end ignored
    assert rows(select_batches(listing, end="20240101000000", mark="20240101000000")) == [
        ("20240102000000",),
        ("20240103000000",),
    ]


def test_bad_settings_raise(listing):
    with pytest.raises(ValueError):
        batch_predicate(start="2024010200000")
    with pytest.raises(ValueError):
        batch_predicate(start="20240102000000", end="x")
    with pytest.raises(ValueError):
        batch_predicate()  # no start and no mark


def test_empty_listing(spark):
    empty = spark.createDataFrame([], "batchno string")
    assert select_batches(empty, start="20240101000000").count() == 0


def test_high_water_mark_and_extract_mark(spark):
    status = spark.createDataFrame(
        [("a", "t", "20240101000000"), ("a", "t", "20240105000000"), ("b", "t", "20250101000000")],
        "app_name string, table_name string, batch_no string",
    )
    assert high_water_mark(status, "a", "t").first()["mark"] == "20240105000000"
    assert high_water_mark(status, "z", "t").first()["mark"] is None
    assert extract_mark(None, status, "a", "t") == "20240105000000"
    assert extract_mark("20230101000000", status, "a", "t") == "20230101000000"
    with pytest.raises(ValueError):
        extract_mark(None, status, "z", "t")
    with pytest.raises(ValueError):
        extract_mark("20240230000000", status, "a", "t")


def test_template_and_incremental_filter(spark):
    q = "select * from t where updated > to_date('dummy_date')"
    assert substitute_mark(q, "20240101000000").endswith("to_date('20240101000000')")
    with pytest.raises(ValueError):
        substitute_mark(q, "1; drop table t")
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts")
    )
    assert incremental_filter(df, "ts", "20240101120000").count() == 1


def test_merged_schema_widens_else_text(spark):
    from rawline.runtime import scratch_path
    from rawline.sources.landing import merged_schema

    root = scratch_path(spark, "drift")
    for batch, lines in {
        "20240101000000": ['{"a":1,"b":1,"c":true}', '{"broken":'],
        "20240102000000": ['{"a":2.25,"b":"x","d":{"e":1}}'],
        "20240103000000": ['{"a":3,"b":{"z":1},"c":1}'],
    }.items():
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{root}/batchno={batch}")
    found = {f.name: f.dataType.simpleString() for f in merged_schema(spark, root, ["20240101000000", "20240102000000", "20240103000000"])}
    assert found.keys() == {"a", "b", "c", "d"}
    assert found["a"].startswith("decimal") and found["b"] == "string" and found["c"] == "string" and found["d"] == "struct<e:bigint>"
    assert {f.name for f in merged_schema(spark, root, ["20240102000000"])} == {"a", "b", "d"}
