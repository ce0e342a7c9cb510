import datetime as dt
import hashlib

from conftest import rows

from rawline.operators import flat as flt
from rawline.runtime import scratch_path
from rawline.sinks.files import export_by_type
from rawline.sources.files import read_csv, read_query_text, read_sessions

LINES = "gstin string, gst_type string, status string, transaction_date string"


def test_flat_transform_edges(spark):
    df = spark.createDataFrame(
        [
            ("g1", "b2b", "VALID", "2024-01-05"),
            ("g1", "b2b", "VALID", "2024-01-05"),  # exact duplicate
            ("g2", "b2b", "valid", "2024-01-05"),  # other case: dropped
            ("g3", None, "ACTIVE", "2024-13-45"),  # bad date, null type
            ("g4", "b2c", "REJECTED", "2024-01-05"),
        ],
        LINES,
    )
    out = flt.flat_transform(df, "2024-02-01")
    got = rows(out, "gstin", "gst_type", "process_date", "month", "year")
    assert got == [("g1", "b2b", dt.date(2024, 1, 5), 1, 2024), ("g3", None, None, None, None)]
    assert out.filter("gstin = 'g1'").first()["gstin_hash"] == hashlib.md5(b"g1").hexdigest()
    s = flt.flat_summary(out, "gstr1", "2024-02-01").first()
    assert (s["record_count"], s["file_count"], s["status"]) == (2, 2, "COMPLETED")


def test_export_roundtrip_with_null_type(spark):
    df = spark.createDataFrame([("g1", "b2b", "VALID", "2024-01-05"), ("g3", None, "ACTIVE", "2024-01-06")], LINES)
    out = scratch_path(spark, "flat")
    export_by_type(flt.flat_transform(df, "2024-02-01"), out)
    back = read_csv(
        spark,
        out,
        "gstin string, status string, transaction_date string, load_timestamp string, process_date date, "
        "month int, year int, gstin_hash string, gst_type string",
    )
    assert rows(back, "gstin", "gst_type") == [("g1", "b2b"), ("g3", None)]


def test_text_and_sessions(spark, tmp_path):
    q = tmp_path / "q.sql"
    q.write_text("select *\nfrom t\nwhere x > 'dummy_date'\n")
    assert read_query_text(spark, str(q)).count("\n") == 3
    csv = tmp_path / "s.csv"
    csv.write_text("c,b,g1,fp,sec,u,a,s,t,x\n")
    s = read_sessions(spark, str(csv))
    assert s.columns[:3] == ["COMPANY1", "BUSSINESSPALCE1", "GSTIN1"] and s.first()["GSTIN1"] == "g1"
