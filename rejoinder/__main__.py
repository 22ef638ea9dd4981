"""spark-submit entry: one batch.

    spark-submit job.py --JOB_NAME nightly \\
        --orders_s3_key 20230801_101500_orders.csv \\
        --returns_s3_key 20230801_101502_returns.csv \\
        --base_orders s3a://orders --base_returns s3a://returns \\
        --output s3a://results/final --jdbc_url jdbc:... --jdbc_table results
"""

from __future__ import annotations

import argparse
import logging
import sys

from rejoinder.functions.fixed import DATE_FORMAT, JOB_ARGUMENTS
from rejoinder.plans.batch import run_batch
from rejoinder.session import build_session, forget_scratch
from rejoinder.sources.csv import MODES
from rejoinder.sources.paths import input_path


JDBC_TEXTS = ("url", "table", "user", "password", "driver")
JDBC_NUMBERS = ("num_partitions", "batch_size")


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rejoinder")
    for name in (*JOB_ARGUMENTS, "base_orders", "base_returns", "output"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--mode", choices=MODES, default="declared")
    parser.add_argument("--multi_line", action="store_true")
    parser.add_argument("--trim_keys", action="store_true")
    parser.add_argument("--snapshots", action="store_true", help="replace the dataset in one step")
    parser.add_argument("--rejects", help="folder for rows with values that do not fit")
    for name in ("order", "return"):
        parser.add_argument(
            f"--{name}_type", action="append", type=_typed, default=[], metavar="COLUMN=TYPE"
        )
    parser.add_argument("--date_format", default=DATE_FORMAT)
    for name in JDBC_TEXTS:
        parser.add_argument(f"--jdbc_{name}")
    for name in JDBC_NUMBERS:
        parser.add_argument(f"--jdbc_{name}", type=int)
    return parser.parse_args(argv)


def _typed(text: str) -> tuple[str, str]:
    name, found, kind = text.rpartition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not COLUMN=TYPE")
    return name, kind


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    given = parse_arguments(argv)
    jdbc = {
        name: getattr(given, f"jdbc_{name}")
        for name in (*JDBC_TEXTS, *JDBC_NUMBERS)
        if getattr(given, f"jdbc_{name}")
    }
    spark = build_session(given.JOB_NAME)
    try:
        result = run_batch(
            spark,
            input_path(given.base_orders, given.orders_s3_key),
            input_path(given.base_returns, given.returns_s3_key),
            given.output,
            jdbc=jdbc or None,
            mode=given.mode,
            order_types=dict(given.order_type),
            return_types=dict(given.return_type),
            date_format=given.date_format,
            multi_line=given.multi_line,
            trim_keys=given.trim_keys,
            rejects_path=given.rejects,
            snapshots=given.snapshots,
        )
    except Exception as error:
        logging.getLogger(__name__).error("%s", error)
        return 1
    finally:
        forget_scratch(spark)
    return 0 if result.succeeded else 1


if __name__ == "__main__":
    sys.exit(main())
