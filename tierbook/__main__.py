"""Command line for the layer jobs (one spark-submit per job).

  python -m tierbook bronze --parquet SRC | --jdbc-url URL --table T ...  --subject products --lake ROOT --ref 20240930 --ts 20240930120000
  python -m tierbook silver --subject products --lake ROOT --ts-proc 20241001080000
  python -m tierbook stream --subject products --lake ROOT --ts-proc 20241001080000
  python -m tierbook gold   --lake ROOT --as-of 2024-09-30 --ts-proc 20241001090000 [--literal] [--lookback]
  python -m tierbook ready  --lake ROOT
  python -m tierbook commit --subject products --lake ROOT --path ROOT/0000_bronze/products/products_20240930_20240930120000.csv
  python -m tierbook gate   --lake ROOT --as-of 2024-09-30 --ts-proc 20241001090000
  python -m tierbook books  --lake ROOT --dates 2024-06-30,2024-07-31 --ts-proc 20241001090000 --out DIR
  python -m tierbook profile --subject sales --lake ROOT
  python -m tierbook vacuum --lake ROOT --hours 48

``ROOT`` holds 0000_bronze/, 0001_silver/, 0002_gold/, 0003_control/ and
checkpoints/. Stamps are always passed in: reruns with the same stamps
replace their own partitions.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from tierbook.schemas import SUBJECTS


def _paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    return {
        "bronze": f"{root}/0000_bronze",
        "silver": f"{root}/0001_silver",
        "gold": f"{root}/0002_gold/book",
        "control": f"{root}/0003_control",
        "checkpoints": f"{root}/checkpoints",
    }


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tierbook")
    sub = parser.add_subparsers(dest="job", required=True)

    b = sub.add_parser("bronze", help="snapshot a source table to bronze CSV")
    b.add_argument("--subject", required=True, choices=sorted(SUBJECTS))
    b.add_argument("--lake", required=True)
    b.add_argument("--ref", required=True)
    b.add_argument("--ts", required=True, help="file generation stamp yyyyMMddHHmmss")
    b.add_argument("--parquet", help="read the source table from parquet")
    b.add_argument("--jdbc-url")
    b.add_argument("--table")
    b.add_argument("--partition-column")
    b.add_argument("--lower-bound", help="number, date or timestamp")
    b.add_argument("--upper-bound", help="number, date or timestamp")
    b.add_argument("--num-partitions", type=int)
    b.add_argument("--predicate", action="append", help="one read per predicate (repeatable)")
    b.add_argument("--single-task", action="store_true", help="read the table through one connection")
    b.add_argument("--property", action="append", default=[], metavar="KEY=VALUE", help="driver property, e.g. driver=..., user=...")
    b.add_argument("--password-env", help="name of the environment variable that holds the password")

    for name in ("silver", "stream"):
        p = sub.add_parser(name, help=f"{name} load of one subject")
        p.add_argument("--subject", required=True, choices=sorted(SUBJECTS))
        p.add_argument("--lake", required=True)
        p.add_argument("--ts-proc", required=True)
        p.add_argument("--keep-misfits", action="store_true", help="keep rows with values that don't fit, as NULL, instead of rejecting them")
        p.add_argument("--max-rejected", type=float, help="share of rejected rows from which the load fails")

    g = sub.add_parser("gold", help="build the feature book from the latest silver batches")
    g.add_argument("--lake", required=True)
    g.add_argument("--as-of", required=True)
    g.add_argument("--ts-proc", required=True)
    g.add_argument("--literal", action="store_true", help="reproduce the published 12-month text")
    g.add_argument("--lookback", action="store_true", help="leave out refs that no window reaches: the whole-history columns then cover the rest only")
    g.add_argument("--lookback-days", type=int, help="leave out refs older than the month so many days back (365 also cuts the 12-month columns at their edge)")
    g.add_argument("--totals", action="store_true", help="also columns over all categories and payment methods")
    g.add_argument("--date-col", default="ref", help="column that ages are taken from, e.g. dat_creation")
    g.add_argument("--when-ready", action="store_true", help="only if every subject arrived since the last book")

    r = sub.add_parser("ready", help="print the readiness gate")
    r.add_argument("--lake", required=True)

    c = sub.add_parser("commit", help="add a snapshot that was delivered from outside to the manifest")
    c.add_argument("--subject", required=True, choices=sorted(SUBJECTS))
    c.add_argument("--lake", required=True)
    c.add_argument("--path", required=True)

    t = sub.add_parser("gate", help="take in new arrivals; build a book for every complete set")
    t.add_argument("--lake", required=True)
    t.add_argument("--as-of", required=True)
    t.add_argument("--ts-proc", help="stamp of the book (by default the newest stamp of its arrivals)")

    k = sub.add_parser("books", help="books of several dates from the latest batches, in one scan")
    k.add_argument("--lake", required=True)
    k.add_argument("--dates", required=True, help="comma-separated")
    k.add_argument("--ts-proc", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--date-col", default="ref")
    k.add_argument("--all-rows", action="store_true", help="count sales after a book's date too, as the single book does")

    f = sub.add_parser("profile", help="profile the newest load of a subject and compare it with the one before")
    f.add_argument("--subject", required=True, choices=sorted(SUBJECTS))
    f.add_argument("--lake", required=True)

    v = sub.add_parser("vacuum", help="remove files that no commit names")
    v.add_argument("--lake", required=True)
    v.add_argument("--hours", type=float, default=48, help="leave alone what changed since then")

    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from tierbook.session import build_session

    owned = SparkSession.getActiveSession() is None
    spark = build_session(app_name=f"tierbook-{args.job}")
    paths = _paths(args.lake)

    if args.job == "bronze":
        from tierbook.plans.bronze import snapshot_to_bronze

        if args.parquet:
            source = spark.read.parquet(args.parquet)
        else:
            from tierbook.sources.jdbc import extract_table

            properties = dict(p.split("=", 1) for p in args.property)
            if args.password_env:
                properties["password"] = os.environ[args.password_env]
            source = extract_table(
                spark, args.jdbc_url, args.table, properties, args.partition_column,
                args.lower_bound, args.upper_bound, args.num_partitions,
                predicates=args.predicate, single_task=args.single_task,
            )
        print(snapshot_to_bronze(source, paths["bronze"], args.subject, args.ref, args.ts))
    elif args.job == "silver":
        from tierbook.plans.silver import load_subject

        spec = SUBJECTS[args.subject]
        res = load_subject(
            spark, spec, paths["bronze"], f"{paths['silver']}/{spec.name}", f"{paths['control']}/{spec.name}", args.ts_proc,
            keep_misfits=args.keep_misfits, max_rejected=args.max_rejected,
        )
        print(json.dumps(res.__dict__))
    elif args.job == "stream":
        from tierbook.streaming.silver_stream import run_silver_stream

        spec = SUBJECTS[args.subject]
        run_silver_stream(
            spark, spec, paths["bronze"], f"{paths['silver']}/{spec.name}", f"{paths['control']}/{spec.name}",
            f"{paths['checkpoints']}/silver_{spec.name}", args.ts_proc,
            keep_misfits=args.keep_misfits, max_rejected=args.max_rejected,
        )
    elif args.job == "gold":
        from dataclasses import replace

        from tierbook.functions.dates import lookback_start, window_start
        from tierbook.operators.book import REFERENCE_SPEC, literal_spec
        from tierbook.plans.gold import gold_job, gold_when_ready

        spec = literal_spec(REFERENCE_SPEC) if args.literal else REFERENCE_SPEC
        options = {"date_col": args.date_col}
        spec = replace(spec, totals=args.totals)
        if args.lookback:
            options["lookback_start"] = window_start(args.as_of, max(spec.boundaries()))
        if args.lookback_days:
            options["lookback_start"] = lookback_start(args.as_of, args.lookback_days)
        if args.when_ready:
            ran = gold_when_ready(
                spark, paths["silver"], paths["control"], paths["gold"], spec, args.as_of, args.ts_proc, **options
            )
            print(json.dumps({"ran": ran}))
        else:
            gold_job(
                spark, f"{paths['silver']}/sales", f"{paths['silver']}/products",
                paths["gold"], spec, args.as_of, args.ts_proc,
                sales_control=f"{paths['control']}/sales", products_control=f"{paths['control']}/products", **options,
            )
    elif args.job == "ready":
        from tierbook.operators.control import readiness
        from tierbook.plans.gold import last_book_stamp
        from tierbook.sources.lake import read_control

        subjects = ("users", "products", "sales")
        control = read_control(spark, *(f"{paths['control']}/{s}" for s in subjects), missing_ok=True)
        for row in readiness(spark, control, subjects, last_book_stamp(spark, paths["gold"])).collect():
            print(json.dumps(row.asDict()))
    elif args.job == "commit":
        from tierbook.sinks.writers import commit_snapshot

        commit_snapshot(spark, paths["bronze"], args.subject, args.path)
    elif args.job == "gate":
        from tierbook.operators.book import REFERENCE_SPEC
        from tierbook.plans.gold import gold_job
        from tierbook.streaming.arrivals import run_gate

        def build(number: int, rows: list) -> None:
            ts_proc = args.ts_proc or max(r["ts_proc"] for r in rows)
            gold_job(spark, f"{paths['silver']}/sales", f"{paths['silver']}/products", paths["gold"], REFERENCE_SPEC, args.as_of, ts_proc)
            print(json.dumps({"firing": number, "ts_proc": ts_proc}))

        dirs = {s: f"{paths['control']}/{s}" for s in ("users", "products", "sales")}
        run_gate(spark, dirs, f"{paths['checkpoints']}/gate", f"{paths['control']}/_firings", build)
    elif args.job == "books":
        from tierbook.operators.book import REFERENCE_SPEC
        from tierbook.operators.books import feature_books
        from tierbook.operators.enrich import category_enrichment
        from tierbook.operators.latest import FILE_FIRST
        from tierbook.schemas import PRODUCTS, SALES
        from tierbook.sources.lake import read_latest_load

        sales = read_latest_load(spark, f"{paths['silver']}/sales", SALES)
        products = read_latest_load(spark, f"{paths['silver']}/products", PRODUCTS, FILE_FIRST)
        books = feature_books(
            category_enrichment(sales, products), REFERENCE_SPEC, args.dates.split(","), args.ts_proc, date_col=args.date_col, past_only=not args.all_rows
        )
        books.write.partitionBy("ref").parquet(args.out)
    elif args.job == "profile":
        from tierbook.plans.profile import profile_newest

        for row in profile_newest(spark, SUBJECTS[args.subject], f"{paths['silver']}/{args.subject}", f"{paths['control']}/_profiles/{args.subject}").collect():
            print(json.dumps(row.asDict()))
    elif args.job == "vacuum":
        import time

        from tierbook.sinks.commits import vacuum

        before = int((time.time() - 3600 * args.hours) * 1000)
        for table in (*(f"{paths['silver']}/{s}" for s in SUBJECTS), paths["gold"]):
            for folder in vacuum(spark, table, before):
                print(f"{table}/{folder}")
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
