import json
import os

import pytest
from conftest import rows

from rawline.config import RawPipelineConfig, rule_table
from rawline.functions.columns import ColumnRule
from rawline.operators.checks import missing_columns, non_empty, validate_sessions
from rawline.sources.files import read_json_doc
from rawline.sources.jdbc import derived_table, jdbc_options, source_for_env

CONFIG = {
    "rawpipeline": {
        "appname": "app",
        "tablename": "T1",
        "sourcepath": "/landing",
        "stagingpath": "/staging",
        "targetpath": "/raw",
        "startbatchno": "20240101000000",
        "endbatchno": None,
        "scd1column": "id,sub",
        "selectcols": "id,sub,amount,current_ts,pos",
        "schemafile": "/schema.json",
        "additional_columns": [
            {"columnkey": "row_key", "columnname": "row_key", "columnformula": "id,sub"},
            {"columnkey": None, "columnname": "x", "columnformula": "id"},
            {"columnkey": "part_1", "columnname": None, "columnformula": "id"},
            {"columnkey": "part_1", "columnname": "part_1", "columnformula": "sub"},
        ],
    }
}


def test_config_and_rule_table(spark, tmp_path):
    p = tmp_path / "default_config.json"
    p.write_text(json.dumps(CONFIG, indent=2))  # multi-line document
    cfg = RawPipelineConfig.from_json(spark, str(p))
    assert cfg.keys == ["id", "sub"] and cfg.selectcols[-1] == "pos"
    assert cfg.startbatchno == "20240101000000" and cfg.endbatchno is None
    assert cfg.rules == [ColumnRule("row_key", "row_key", "id,sub"), ColumnRule("part_1", "part_1", "sub")]
    doc = read_json_doc(spark, str(p))
    assert rows(rule_table(doc), "columnkey") == [("part_1",), ("row_key",)]


def test_rule_table_empty_list(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"rawpipeline": {"appname": "a", "additional_columns": []}}))
    from rawline.config import RAW_PIPELINE_SCHEMA

    assert rule_table(read_json_doc(spark, str(p), RAW_PIPELINE_SCHEMA)).count() == 0


def test_schema_checks(spark):
    ok = spark.createDataFrame([("c", "g", "u")], "COMPANY1 string, GSTIN1 string, USER1 string")
    bad = spark.createDataFrame([("g",)], "GSTIN1 string")
    empty = spark.createDataFrame([], "COMPANY1 string, GSTIN1 string, USER1 string")
    assert non_empty(ok) and not non_empty(empty) and not non_empty(None)
    assert missing_columns(bad) == ["COMPANY1", "USER1"]
    validate_sessions(ok)
    with pytest.raises(ValueError, match="COMPANY1, USER1"):
        validate_sessions(bad)
    with pytest.raises(ValueError, match="empty"):
        validate_sessions(empty)


def test_jdbc_options():
    assert source_for_env("DEV") == "HDV" and source_for_env("PRD") == "HANA" and source_for_env("QA") is None
    t = derived_table("select * from cod where upd > 'dummy_date'", "20240101000000")
    assert t == "(select * from cod where upd > '20240101000000') temp_alias"
    o = jdbc_options("jdbc:x", t, user="u", partition_column="CUST_ID", lower_bound=0, upper_bound=10, num_partitions=4)
    assert o["numPartitions"] == "4" and o["partitionColumn"] == "CUST_ID" and "password" not in o
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", t, partition_column="CUST_ID")


def test_shuffle_partitions_follow_input_size(spark, tmp_path):
    from rawline.runtime import input_bytes, size_shuffle_partitions, wanted_shuffle_partitions

    mb = 1024 * 1024
    assert wanted_shuffle_partitions(0, 200) == 200  # never below the current value
    assert wanted_shuffle_partitions(10 * 128 * mb, 8) == 10
    assert wanted_shuffle_partitions(100 * 1024**4, 200) == 100 * 8192  # 100 TB: 128 MB each
    assert wanted_shuffle_partitions(100 * 1024**4, 900_000) == 900_000
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_bytes(b"y" * 24)
    assert input_bytes(spark, [str(tmp_path), str(tmp_path / "missing")]) == 1024
    # the test session sets the value at launch: it is kept as given
    assert size_shuffle_partitions(spark, 100 * 1024**4) == 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_external_config_from_json(spark, tmp_path):
    import json

    import pytest

    from rawline.config import ExternalConfig

    p = tmp_path / "ext.json"
    p.write_text(json.dumps({"externalpipeline": {"app_name": "a", "table_name": "t", "statuspath": "/s",
                                                  "errorpath": "/e", "fromdate": "20240101000000"}}))
    cfg = ExternalConfig.from_json(spark, str(p))
    assert (cfg.app_name, cfg.param1, cfg.param2, cfg.fromdate) == ("a", "param1", "param2", "20240101000000")
    p.write_text(json.dumps({"externalpipeline": {"app_name": "a", "table_name": "t"}}))
    with pytest.raises(ValueError, match="statuspath"):
        ExternalConfig.from_json(spark, str(p))


def test_shuffle_partitions_raised_when_launcher_left_them_unset():
    """In a session whose launcher did not set the value, a big input
    raises it (never lowers it); runs in its own process."""
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from rawline.runtime import size_shuffle_partitions\n"
        "mb = 1024 * 1024\n"
        "a = size_shuffle_partitions(s, 10 * 128 * mb)\n"
        "b = size_shuffle_partitions(s, 1000 * 128 * mb)\n"
        "print('RESULT', a, b, s.conf.get('spark.sql.shuffle.partitions'))\n"
    ) % repo
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    line = [x for x in proc.stdout.splitlines() if x.startswith("RESULT")]
    assert line, proc.stderr[-2000:]
    assert line[-1].split()[1:] == ["200", "1000", "1000"]
