"""Command line for the reference's two workflows.

    python -m gridlake load-bucket ROOT [--database raw_data] [--prefix P]
    python -m gridlake convert SRC_ROOT TGT_ROOT [--format parquet] [--target-dir inputs/] [--by-folder]
    python -m gridlake warehouse [--raw-db raw_data] [--derived-db derived_data]
    python -m gridlake export OUT_DIR [--format parquet] [--databases a,b]
    python -m gridlake import IN_DIR
    python -m gridlake sql "SELECT ..." [--rows N]

The session is built with ``build_session``, so it keeps whatever the
cluster's submit configuration sets; ``--master local[N]`` (before the command)
runs locally. ``warehouse`` builds the derived database from raw tables that are
in the catalog already, and leaves those as they are.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gridlake")
    p.add_argument("--master", help="e.g. local[8] for a local run; leave unset under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("load-bucket")
    s.add_argument("root")
    s.add_argument("--database", default="raw_data")
    s.add_argument("--prefix")

    s = sub.add_parser("convert")
    s.add_argument("src_root")
    s.add_argument("tgt_root")
    s.add_argument("--format", default="parquet")
    s.add_argument("--target-dir", default="inputs/")
    s.add_argument("--by-folder", action="store_true")

    s = sub.add_parser("warehouse")
    s.add_argument("--raw-db", default="raw_data")
    s.add_argument("--derived-db", default="derived_data")

    s = sub.add_parser("export")
    s.add_argument("out_dir")
    s.add_argument("--format", default="parquet")
    s.add_argument("--databases")

    s = sub.add_parser("import")
    s.add_argument("in_dir")

    s = sub.add_parser("sql")
    s.add_argument("query")
    s.add_argument("--rows", type=int, default=20)

    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from gridlake.session import build_session

    owned = SparkSession.getActiveSession() is None
    spark = build_session(master=a.master, app_name=f"gridlake-{a.cmd}")
    if a.cmd == "load-bucket":
        from gridlake.sources.files import bucket_to_tables

        print("\n".join(bucket_to_tables(spark, a.root, database=a.database, prefix=a.prefix)))
    elif a.cmd == "convert":
        from gridlake.sources.files import bulk_convert

        bulk_convert(spark, a.src_root, a.tgt_root, target_dir=a.target_dir, target_format=a.format, by_folder=a.by_folder).show(
            truncate=False
        )
    elif a.cmd == "warehouse":
        from gridlake.plans import catalog

        print("\n".join(catalog.build_derived(spark, a.raw_db, a.derived_db)))
    elif a.cmd == "export":
        from gridlake.sources.export import export_database

        dbs = a.databases.split(",") if a.databases else None
        export_database(spark, a.out_dir, dbs, a.format).show(truncate=False)
    elif a.cmd == "import":
        from gridlake.sources.export import import_database

        print("\n".join(import_database(spark, a.in_dir)))
    elif a.cmd == "sql":
        spark.sql(a.query).show(a.rows, truncate=False)
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
