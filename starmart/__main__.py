"""Command line: build and publish the warehouse from raw feed files.

    spark-submit -m starmart --case s3a://lake/case --county s3a://lake/county \\
        --daily s3a://lake/states_daily --hospitals s3a://lake/beds --out s3a://lake/out
"""

from __future__ import annotations

import argparse
import json

from starmart.plans import warehouse
from starmart.session import build_session


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run the job; ``spark`` reuses an existing session (which is then left running)."""
    p = argparse.ArgumentParser(prog="starmart", description=__doc__.splitlines()[0])
    p.add_argument("--case", required=True, help="per-place case feed (CSV, gzip or plain)")
    p.add_argument("--county", required=True, help="per-county daily feed (CSV)")
    p.add_argument("--daily", required=True, help="daily state testing feed (CSV)")
    p.add_argument("--hospitals", required=True, help="hospital locations (GeoJSON)")
    p.add_argument("--hospitals-multiline", action="store_true",
                   help="hospitals file is one FeatureCollection document")
    p.add_argument("--out", required=True, help="output folder (tables and extracts)")
    p.add_argument("--state-abbreviations", default=None,
                   help="state-abbreviation lookup (CSV), registered as the view state_abv")
    p.add_argument("--db", default="warehouse", help="database of the published tables and views")
    p.add_argument("--partitions", type=int, default=None,
                   help="spread unsplittable (gzip) inputs over this many partitions")
    p.add_argument("--keep-versions", type=int, default=None,
                   help="delete all but this many of the newest published versions")
    args = p.parse_args(argv)
    own_session = spark is None
    if own_session:
        spark = build_session(app_name="starmart-warehouse")
    paths = warehouse.FeedPaths(args.case, args.county, args.daily, args.hospitals,
                                state_abbreviations=args.state_abbreviations,
                                hospitals_multiline=args.hospitals_multiline)
    extracts = warehouse.run(spark, paths, args.out, db=args.db, partitions=args.partitions,
                             keep_versions=args.keep_versions)
    report = warehouse.constraint_report(spark, args.db).where("n_violations > 0")
    print(json.dumps({"extracts": extracts,
                      "violations": [r.asDict() for r in report.collect()]}))  # few rows: one per column
    if own_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
