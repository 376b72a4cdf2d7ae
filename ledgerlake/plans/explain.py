"""Print the formatted physical plan of registered queries.

    python -m ledgerlake.plans.explain fact_transactions kpi_rapid_distribution
    python -m ledgerlake.plans.explain --sf-dir /root/testdata/sf0.01 --all

Plans are printed as Spark would run them (AQE shows the initial plan;
``--run`` executes first so the final adaptive plan is shown).
"""

from __future__ import annotations

import argparse

from ..config import get_session
from .queries import QUERIES


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.001")
    ap.add_argument("--all", action="store_true")
    ap.add_argument("--run", action="store_true", help="execute first (noop sink) to show the final adaptive plan")
    args = ap.parse_args(argv)
    spark = get_session()
    for name in sorted(QUERIES) if args.all else args.names:
        df = QUERIES[name](spark, args.sf_dir)
        if args.run:
            df.write.format("noop").mode("overwrite").save()
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
