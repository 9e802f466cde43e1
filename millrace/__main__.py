"""``python -m millrace --source FILE --target DIR [--dry-run] [--validate]``"""

from __future__ import annotations

import argparse

from millrace.plans.migration import Migration
from millrace.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millrace", description="Migrate power-plant text files to tables")
    parser.add_argument("--source", "-s", required=True, help="text file or folder")
    parser.add_argument("--target", "-t", required=True, help="folder of the tables")
    parser.add_argument("--dry-run", action="store_true", help="transform and count, write nothing")
    parser.add_argument("--validate", action="store_true", help="print checks after the load")
    args = parser.parse_args(argv)

    spark = build_session()
    job = Migration(spark, args.source, args.target)
    for name, value in job.run(dry_run=args.dry_run).items():
        print(f"{name}: {value:,}")
    if args.validate and not args.dry_run:
        for name, frame in job.validate().items():
            print(f"\n{name}")
            frame.show(50, truncate=False)


if __name__ == "__main__":
    main()
