"""Command line for cluster runs (``spark-submit -m strata`` style).

    python -m strata tasks --landing L --silver S --checkpoints C [--trigger "1 minute"]
    python -m strata sql   --landing L --silver S --checkpoints C "SELECT ..."

``tasks`` starts the silver tasks (POS, ERP orders, sensor JSON, inventory)
and waits; ``--trigger availableNow`` makes it a catch-up run that stops.
The ERP and inventory file schemas are read from the Parquet footers of
files already landed.  ``sql`` registers the silver tables and gold views by
name and shows the result of one statement.
"""

from __future__ import annotations

import argparse
import sys

from strata.session import build_session
from strata.streaming.tasks import Layout, register_tables, start_silver_tasks

TASKS = ("pos", "erp", "iot", "inventory")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m strata")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("tasks", "sql"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--silver", required=True)
        s.add_argument("--checkpoints", required=True)
    t = sub.choices["tasks"]
    t.add_argument("--trigger", default="1 minute")
    t.add_argument("--only", default=",".join(TASKS))
    sub.choices["sql"].add_argument("statement")
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = build_session(app=f"strata-{args.command}")
    lay = Layout(landing=args.landing, silver=args.silver, checkpoints=args.checkpoints)
    if args.command == "tasks":
        which = tuple(w for w in args.only.split(",") if w)
        erp = spark.read.parquet(lay.land("erp")).schema if "erp" in which else None
        inv = spark.read.parquet(lay.land("inventory")).schema if "inventory" in which else None
        queries = start_silver_tasks(spark, lay, erp, inv, trigger=args.trigger, which=which)
        for q in queries.values():
            q.awaitTermination()
    else:
        register_tables(spark, lay)
        spark.sql(args.statement).show(truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
