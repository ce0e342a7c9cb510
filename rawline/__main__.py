"""Run a job by name (for ``spark-submit``):

    spark-submit --py-files rawline.zip -m rawline landing_to_raw \\
        --config /conf/default_config.json --audit /warehouse/audit \\
        --run-ts "2024-01-22 00:00:00" --run-epoch 1705881600

    python -m rawline generate_flat --input /landing/gst_data --schema "<ddl>" \\
        --out /gst --section gstr1 --run-date 2024-01-22

    python -m rawline cod_push --config /conf/cod.json --audit /warehouse/audit \\
        --query /conf/cod.sql --jdbc /conf/jdbc.json --client mypkg.api:push \\
        --env PRD --run-ts "2024-01-22 00:00:00" --run-batch 20240122000000 --record-date 2024-01-22

    python -m rawline gst_fetch --config /conf/gst.json --schedule-id daily \\
        --sessions /gst/sessions --status /gst/status --client mypkg.api:fetch \\
        --base-url https://api.example --data-schema "<ddl>" --out /gst/data --run-ts 2024-01-22
"""

from __future__ import annotations

import argparse
import json
import sys


def _session():
    """The launcher's session; the web UI stays off unless the launcher
    (``spark-submit --conf``) asked for it."""
    from pyspark import SparkConf
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("rawline")
    if not SparkConf().contains("spark.ui.enabled"):
        builder = builder.config("spark.ui.enabled", "false")
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="rawline")
    sub = ap.add_subparsers(dest="job", required=True)

    raw = sub.add_parser("landing_to_raw", help="landing JSON -> SCD1 version -> publish -> retention")
    raw.add_argument("--config", required=True, help="JSON document with a rawpipeline section")
    raw.add_argument("--audit", required=True, help="folder holding the app_status and sync_status tables")
    raw.add_argument("--schema", help="landing schema as DDL (default: the config's schemafile sample)")
    raw.add_argument("--run-ts", required=True, help="run start, yyyy-MM-dd HH:mm:ss")
    raw.add_argument("--run-epoch", required=True, type=int, help="version id of this run (epoch seconds)")
    raw.add_argument("--strict-publish", action="store_true", help="publish only when exactly one version is pending")
    raw.add_argument("--table", help="keep the snapshot as this catalog table, bucketed by the keys (no versions)")
    raw.add_argument("--table-path", help="location of --table's files (in shared storage)")
    raw.add_argument("--buckets", type=int, help="buckets when --table is created (default: shuffle partitions)")

    flat = sub.add_parser("generate_flat", help="tax lines CSV -> flat CSV per type + summary")
    flat.add_argument("--input", required=True)
    flat.add_argument("--schema", required=True, help="CSV schema as DDL (header row expected)")
    flat.add_argument("--out", required=True)
    flat.add_argument("--section", required=True)
    flat.add_argument("--run-date", required=True)

    cod = sub.add_parser("cod_push", help="COD list -> allow/block requests of 700 ids -> push -> status/error tables")
    cod.add_argument("--config", required=True, help="JSON document with an externalpipeline section")
    cod.add_argument("--audit", required=True, help="folder holding the app_status and sync_status tables")
    cod.add_argument("--client", required=True, help="module:function, called as client(params) -> (code, body)")
    src = cod.add_mutually_exclusive_group(required=True)
    src.add_argument("--source", help="folder with CUST_ID, COD_ALLOWED (see --source-format)")
    src.add_argument("--query", help="file with the JDBC source query (read whole)")
    cod.add_argument("--jdbc", help="JSON file of JDBC options (url, user, password, driver, ...)")
    cod.add_argument("--source-format", default="parquet", help="format of --source (parquet, orc, ...)")
    cod.add_argument("--env", required=True)
    cod.add_argument("--run-ts", required=True)
    cod.add_argument("--run-batch", required=True, help="yyyyMMddHHmmss of this run")
    cod.add_argument("--record-date", required=True, help="yyyy-MM-dd")
    cod.add_argument("--key-param", help="send a deterministic request key under this parameter name")
    cod.add_argument("--error-schema", default="error string, message string")

    gst = sub.add_parser("gst_fetch", help="sessions x schedules -> fetch with retry -> valid records by type/year")
    gst.add_argument("--config", required=True, help="JSON document with a config.schedule list")
    gst.add_argument("--schedule-id", required=True)
    gst.add_argument("--sessions", required=True, help="headerless 10-column session CSV")
    gst.add_argument("--status", required=True, help="status CSV with header (gstin, status, ...)")
    gst.add_argument("--status-schema", default="gstin string, status string")
    gst.add_argument("--client", required=True, help="module:function, called as fetch(request, attempt) -> (code, body)")
    gst.add_argument("--base-url", required=True)
    gst.add_argument("--data-schema", required=True, help="DDL of the data payload")
    gst.add_argument("--out", required=True)
    gst.add_argument("--run-ts", required=True)
    gst.add_argument("--summary", help="append the per-type summary CSV here")
    gst.add_argument("--no-backoff", action="store_true", help="retry without waiting (tests)")
    for api in (cod, gst):
        api.add_argument("--num-partitions", type=int, help="tasks that the requests are spread over")
        api.add_argument("--concurrency", type=int, default=1, help="calls at a time in a task")

    args = ap.parse_args(argv)
    spark = _session()
    from .plans import jobs

    if args.job == "landing_to_raw":
        from .config import RawPipelineConfig

        cfg = RawPipelineConfig.from_json(spark, args.config)
        schema = spark.createDataFrame([], args.schema).schema if args.schema else None
        audit = jobs.AuditStore(f"{args.audit}/app_status", f"{args.audit}/sync_status")
        if args.table:
            if not args.table_path:
                raise SystemExit("--table needs --table-path")
            if schema is None:
                if not cfg.schemafile:
                    raise ValueError("no landing schema: pass --schema or set schemafile in the config")
                from .sources.landing import sample_schema

                schema = sample_schema(spark, cfg.schemafile)
            res = jobs.landing_to_table(
                spark, cfg, schema, audit, args.run_ts, args.run_epoch, args.table, args.table_path, args.buckets
            )
        else:
            res = jobs.landing_to_raw(spark, cfg, schema, audit, args.run_ts, args.run_epoch, args.strict_publish)
        print(json.dumps(res.__dict__, default=str))
    elif args.job == "generate_flat":
        from .sources.files import read_csv

        from .runtime import input_bytes, size_shuffle_partitions

        size_shuffle_partitions(spark, input_bytes(spark, [args.input]))
        lines = read_csv(spark, args.input, args.schema, header=True)
        res = jobs.generate_flat(lines, args.out, args.section, args.run_date, f"{args.out}/reports/flatfile_summary")
        print(json.dumps(res, default=str))
    elif args.job == "cod_push":
        from .config import ExternalConfig
        from .runtime import ship_package

        cfg = ExternalConfig.from_json(spark, args.config)
        audit = jobs.AuditStore(f"{args.audit}/app_status", f"{args.audit}/sync_status")
        if args.source:
            source = spark.read.format(args.source_format).load(args.source)
        else:
            from .sources.files import read_query_text

            if not args.jdbc:
                raise SystemExit("--query needs --jdbc")
            with open(args.jdbc) as f:
                options = json.load(f)
            source = jobs.incremental_extract(spark, cfg, audit, read_query_text(spark, args.query), options)
        ship_package(spark)
        try:
            res = jobs.trusted_to_external(
                source, cfg, _load(args.client), audit, args.env, args.run_ts, args.run_batch, args.record_date,
                args.error_schema, key_param=args.key_param,
                num_partitions=args.num_partitions, concurrency=args.concurrency,
            )
        except jobs.PushFailed as e:
            print(json.dumps({"failed": str(e)}))
            return 2
        print(json.dumps(res, default=str))
    elif args.job == "gst_fetch":
        from .operators.responses import expand_schedule
        from .runtime import ship_package
        from .sources.files import read_csv, read_json_doc, read_sessions

        ship_package(spark)
        schedules = expand_schedule(read_json_doc(spark, args.config), args.schedule_id)
        res = jobs.fetch_gst(
            read_sessions(spark, args.sessions), schedules, read_csv(spark, args.status, args.status_schema),
            _load(args.client), args.base_url, args.data_schema, args.out, args.run_ts,
            backoff=not args.no_backoff, summary_path=args.summary,
            num_partitions=args.num_partitions, concurrency=args.concurrency,
        )
        print(json.dumps({"metrics": res["metrics"], "failures": res["failures"].count()}, default=str))
    return 0


def _load(ref: str):
    """``module:function`` -> the function (an injected HTTP client)."""
    import importlib

    mod, _, name = ref.partition(":")
    if not mod or not name:
        raise SystemExit(f"--client must be module:function, got {ref!r}")
    return getattr(importlib.import_module(mod), name)


if __name__ == "__main__":
    sys.exit(main())
