"""Run in its own process on ``local[4,3]`` (tasks are retried up to three
times), with a failure injected into the first attempt of every task of
chosen stages. Prints one JSON line of results for tests/test_retries.py.

    python retry_run.py <calls_dir> <scratch_dir>
"""

from __future__ import annotations

import json
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def flaky(batches):
    """Identity, except that the first attempt of every task fails."""
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


def main(calls_dir: str, scratch: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from rawline.operators import external as ext
    from rawline.operators import responses as rsp
    from rawline.runtime import cut_lineage, ship_package

    ship_package(spark)
    out = {}

    # 1) exact request numbering while the input and the output stages retry
    ids = spark.range(0, 5000, 1, 4).select(
        ((F.col("id") * 7919) % 100003).alias("CUST_ID"),
        F.when(F.col("id") % 3 == 0, "block").otherwise("allow").alias("operation"),
    )
    got = ext.request_batches(ids.mapInPandas(flaky, ids.schema), size=50)
    got = got.mapInPandas(flaky, got.schema)
    rn = F.row_number().over(Window.partitionBy("operation").orderBy("CUST_ID"))
    want = (
        ids.withColumn("batch_index", F.floor((rn - 1) / 50).cast("bigint"))
        .groupBy("operation", "batch_index")
        .agg(
            F.count(F.lit(1)).alias("n_ids"),
            F.min("CUST_ID").alias("first_id"),
            F.max("CUST_ID").alias("last_id"),
            F.concat_ws(",", F.sort_array(F.collect_list("CUST_ID")).cast("array<string>")).alias("id_list"),
        )
    )
    out["batches_equal"] = sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    out["n_batches"] = got.count()

    # 2) API calls: a retried downstream task must not call the API again
    reqs = spark.range(0, 40, 1, 4).select(F.col("id").cast("string").alias("gstin"))
    for label, cut in (("checkpointed", True), ("plain", False)):
        os.makedirs(os.path.join(calls_dir, label))
        d = os.path.join(calls_dir, label)

        def logged(request, attempt, d=d):
            with open(os.path.join(d, f"{request['gstin']}-{uuid.uuid4().hex}"), "w"):
                pass
            return 200, "{}"

        fetched = rsp.fetch_table(reqs, logged, backoff=False)
        if cut:
            fetched = cut_lineage(fetched)
        downstream = fetched.mapInPandas(flaky, fetched.schema)
        downstream.collect()
        downstream.collect()
        names = os.listdir(d)
        out[f"{label}_calls"] = len(names)
        out[f"{label}_requests"] = len({n.split("-")[0] for n in names})
    # 3) the SCD1 merge with every task of its landing input retried once
    from rawline.operators.scd import prepare_delta, scd1_merge
    from rawline.plans import feeds as fd

    sf = "/root/testdata/sf0.001"

    def merged(retry: bool):
        def delta(first, last, run_ts):
            feed = fd.landing_feed(spark, sf, first, last)
            if retry:
                feed = feed.mapInPandas(flaky, feed.schema)
            return prepare_delta(feed, fd.FEED_KEYS, fd.FEED_SELECT, fd.FEED_RULES, run_ts)

        base = delta("20240101000000", "20240119000000", fd.BASE_RUN_TS)
        return scd1_merge(delta("20240120000000", "20240121000000", fd.DELTA_RUN_TS), base, fd.FEED_KEYS, ["part_1"])

    plain = sorted(map(tuple, merged(False).collect()))
    out["merge_rows"] = len(plain)
    out["merge_equal"] = sorted(map(tuple, merged(True).collect())) == plain
    print("RESULT " + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
