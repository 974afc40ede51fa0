"""Command line for a joint publication: ``python -m spendlens.plans.publication_cli --help``.

Lists its commits, shows an earlier version again in both tables at once, or deletes old versions.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..operators.publication import job_publication


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spendlens-publication", description=__doc__)
    p.add_argument("--publish-dir", required=True, help="folder of the publication")
    p.add_argument("--campaign-table", required=True, help="its campaign view")
    p.add_argument("--channel-table", required=True, help="its channel view")
    what = p.add_mutually_exclusive_group(required=True)
    what.add_argument("--history", action="store_true", help="list the commits, the last one first")
    what.add_argument("--rollback", type=int, metavar="VERSION", help="show this version again")
    what.add_argument("--expire", type=int, metavar="KEEP", help="delete all but this many versions")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    joint = job_publication(spark, args.publish_dir, args.campaign_table, args.channel_table)
    if args.history:
        for c in joint.history().orderBy("commit", ascending=False).toLocalIterator():
            print(f"commit {c.commit}: version {c.version} of {c.run_date}, " + ", ".join(f"{k} {n} rows" for k, n in sorted(c.rows.items())))
    elif args.rollback is not None:
        made = joint.rollback(args.rollback)
        print(f"commit {made.commit}: version {made.version} of {made.run_date}")
    else:
        gone = joint.expire(args.expire)
        print(f"deleted versions: {', '.join(map(str, gone)) or 'none'}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
