"""Write PLANS.md: physical plans of the headline queries.

usage: python tools/plans.py [sf_dir]
Silver tables are materialised as Parquet first (as the pipeline stores
them), so the gold plans show the real scans: pruned ``ReadSchema``,
pushed filters, partial aggregates, exchanges.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans import catalog, gold, mapping, silver  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402


def tree_and_scans(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    head, _, details = buf.getvalue().partition("\n\n\n")
    keep = [ln for ln in details.splitlines()
            if re.match(r"^\(\d+\) Scan", ln) or ln.startswith(("ReadSchema", "PushedFilters",
                                                                 "PartitionFilters"))]
    return head.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    base = scratch_path(spark, "plans")
    for name, fn in (("pos", catalog.silver_pos), ("erp", catalog.silver_erp),
                     ("iot", catalog.silver_iot)):
        fn(spark, sf).write.parquet(f"{base}/{name}")
    pos, erp, iot = (spark.read.parquet(f"{base}/{n}") for n in ("pos", "erp", "iot"))
    raw = mapping.pos_raw(spark, sf)
    items = [
        ("daily_sales (P5)", gold.daily_sales(pos)),
        ("running_total (P6)", gold.running_total(pos)),
        ("pos_iot_sensor_data (P7, aggregate-then-join)", gold.pos_iot_sensor_data(iot, pos)),
        ("rolling_30d_revenue (P8)", gold.rolling_30d_revenue(pos)),
        ("gross_margin (P9)", gold.gross_margin(pos, erp)),
        ("sensor_affect_revenue (P10)", gold.sensor_affect_revenue(pos, iot)),
        ("dedup_pos (E1)", silver.dedup_pos(raw)),
        ("merge_pos (I1, two batches)", catalog.merged_pos(spark, sf)),
    ]
    out = ["# PLANS", "",
           "Physical plans (`explain(\"formatted\")`, initial adaptive plan) of the headline",
           f"queries at `{os.path.basename(sf)}`; gold views read the silver tables from Parquet.",
           "Regenerate with `python tools/plans.py`.", ""]
    for title, df in items:
        out += [f"## {title}", "", "```", tree_and_scans(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
