from conftest import rows

from rawline.functions.columns import ColumnRule, cast_all, derive_columns, partition_columns


def test_cast_all_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 2.5, None), (None, None, "x")], "a int, b double, c string")
    out = cast_all(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string"] * 3
    assert rows(out) == [("1", "2.5", None), (None, None, "x")]


def test_rules_keys_prefix_and_skips(spark):
    df = spark.createDataFrame(
        [("012345", "2024-01-20 10:11:12.5", "a/b"), (None, None, None)], "code string, ts string, other string"
    )
    rules = [
        ColumnRule("row_key", "row_key", "code,ts"),
        ColumnRule(None, "ignored", "code"),  # null columnkey
        ColumnRule("part_1", None, "code"),  # null columnname
        ColumnRule("mystery", "m", "code"),  # unknown key
        ColumnRule("part_1", "p1", "code"),
        ColumnRule("f_key", "f_key", "p1,other"),  # uses a column derived earlier
    ]
    out = derive_columns(df, rules)
    assert "ignored" not in out.columns and "m" not in out.columns
    got = rows(out, "row_key", "p1", "f_key")
    assert got == [("", None, ""), ("012345202401201011125", "012", "012ab")]
    assert partition_columns(rules) == ["p1"]


def test_date_partition_rules(spark):
    df = spark.createDataFrame([("2024-02-29 23:59:59",), ("not a date",)], "ts string")
    rules = [ColumnRule("part_1", "y", "ts"), ColumnRule("part_2", "m", "ts"), ColumnRule("part_3", "d", "ts")]
    out = derive_columns(df, rules, date_partitioned=True)
    import datetime as dt

    assert rows(out, "y", "m", "d") == [(2024, 2, dt.date(2024, 2, 29)), (None, None, None)]
    assert partition_columns(rules) == ["y", "m", "d"]
