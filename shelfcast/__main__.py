"""Command line: build features, fit, blend and write the submission.

    python -m shelfcast --raw-dir data/raw --out submissions/run1      (CSV layout)
    python -m shelfcast --tables /root/testdata/sf0.01 --out /tmp/sub  (star tables)
"""

from __future__ import annotations

import argparse
import time


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="shelfcast")
    src_arg = ap.add_mutually_exclusive_group(required=True)
    src_arg.add_argument("--raw-dir", help="directory of train/test/stores/oil/holidays_events/transactions CSVs")
    src_arg.add_argument("--tables", help="directory of the star-schema parquet tables")
    ap.add_argument("--out", required=True, help="output folder of the (id, sales) submission")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    args = ap.parse_args(argv)

    from shelfcast.plans.forecast_job import run_forecast
    from shelfcast.session import get_spark
    from shelfcast.sources.panel import PanelSources
    from shelfcast.sources.retail import RetailSources

    spark = get_spark(args.master)
    t0 = time.time()
    src = RetailSources(spark, args.raw_dir) if args.raw_dir else PanelSources(spark, args.tables)
    rows = run_forecast(src, out_path=args.out)
    w = rows.select("w_glm", "w_gbt").first()
    print(f"submission written to {args.out}; blend weights glm={w.w_glm:.2f} gbt={w.w_gbt:.2f}; "
          f"{time.time() - t0:.1f}s")


if __name__ == "__main__":
    main()
