"""``spark-submit`` entry: one month, one job."""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession

from cartorio.fixed import Rules
from cartorio.plans.monthly import JOBS, run

LIMITS = [field for field in fields(Rules) if isinstance(field.default, (int, float))]


def main() -> None:
    parser = argparse.ArgumentParser(prog="cartorio", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--month", required=True, help="YYYY-MM")
    parser.add_argument("--root", required=True, help="folder or object-store URI of the layers")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--paths", nargs="+", help="delimited files or folders of them")
    source.add_argument("--landing", help="folder with one folder of archives per month")
    parser.add_argument("--previous", help="snapshot to compare the month with")
    parser.add_argument("--city-name", help="filter by name through the landed city lookup")
    parser.add_argument("--skip-ingest", action="store_true", help="use the bronze month as it is")
    parser.add_argument("--force", action="store_true", help="rebuild layers that hold the month")
    parser.add_argument("--no-check-input", dest="check_input", action="store_false",
                        help="publish bronze without judging rows, nulls and ids")
    parser.add_argument("--no-check-stability", dest="check_stability", action="store_false",
                        help="don't look for a previous month to compare with")
    parser.add_argument("--multiline", action="store_true", help="quoted fields may hold line breaks")
    parser.add_argument("--show-plan", action="store_true", help="print the plan of the filter")
    limits = parser.add_argument_group("limits of the checks")
    for limit in LIMITS:
        limits.add_argument(f"--{limit.name.replace('_', '-')}", type=type(limit.default), metavar="N",
                            help=f"default {limit.default}")
    options = vars(parser.parse_args())
    given = {limit.name: options.pop(limit.name) for limit in LIMITS}
    rules = Rules(**{name: value for name, value in given.items() if value is not None})
    run(SparkSession.builder.appName("cartorio").getOrCreate(), rules=rules, **options)


if __name__ == "__main__":
    main()
