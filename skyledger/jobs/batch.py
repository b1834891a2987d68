"""Answer all questions over a set of flights and store the result tables.

CSV input is typed and stored once as parquet by year; its lines that are no flights go to
``rejects`` beside the results, from the same scan. All results of a run are published together. The five questions on
counts and means share one summary; the two-leg question reads one year. Both
staged copies are deleted at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from skyledger.jobs.options import add_store, parser, store_of
from skyledger.plans import two_leg_all
from skyledger.plans.summary import answers_from_summary, flight_summary
from skyledger.session import build_session, new_dir, scratch_dir
from skyledger.sinks import Store, publish, read_table, write_table, write_to_store
from skyledger.sources import read_flights, read_scan, scan_flights_csv, write_scan

# Fixed value: the year of the two-leg question.
TWO_LEG_YEAR = 2008


def stage_flights(spark: SparkSession, paths: Sequence[str], path: str) -> tuple[DataFrame, DataFrame]:
    """Flights, and lines that are none, stored at ``path`` by one scan of the CSV files."""
    return read_scan(spark, write_scan(scan_flights_csv(spark, paths), path))


def stage_summary(spark: SparkSession, flights: DataFrame, path: str | None = None) -> DataFrame:
    path = path or new_dir(spark, "summary")
    flight_summary(flights).write.parquet(path)
    return spark.read.parquet(path)


def all_answers(
    spark: SparkSession, flights: DataFrame, path: str, year: int = TWO_LEG_YEAR
) -> dict[str, DataFrame]:
    """Result table name to its rows, for the six questions; they read the summary staged at ``path``."""
    answers = answers_from_summary(stage_summary(spark, flights, path))
    answers["results32"] = two_leg_all(flights, year)
    return answers


def run_batch(
    spark: SparkSession,
    flights: DataFrame,
    root: str,
    year: int = TWO_LEG_YEAR,
    fmt: str = "parquet",
    store: Store | None = None,
    rejects: DataFrame | None = None,
) -> dict[str, str]:
    """Write the six result tables, and ``rejects``, and publish them under ``root`` together; return their paths.

    The ``store``, if any, gets them after that, from there.
    """

    def write(run: str) -> dict[str, str]:
        with scratch_dir(spark, "summary") as summary:
            answers = all_answers(spark, flights, summary, year)
            paths = {table: write_table(answer, table, run, fmt) for table, answer in answers.items()}
        if rejects is not None:
            rejects.write.text(f"{run}/rejects")
        return paths

    paths = publish(spark, root, write)
    if store:
        for table in paths:
            write_to_store(read_table(spark, table, root, fmt), table, store)
    return paths


def main(argv: Sequence[str] | None = None) -> None:
    args = parser(__doc__)
    args.add_argument("--input", action="append", required=True, help="path or glob; may be repeated")
    args.add_argument("--input-format", choices=["csv", "parquet"], default="csv")
    args.add_argument("--output", required=True)
    args.add_argument("--output-format", default="parquet")
    args.add_argument("--year", type=int, default=TWO_LEG_YEAR)
    add_store(args)
    args.add_argument("--show", action="store_true", help="print the first rows of every result")
    given = args.parse_args(argv)
    spark = build_session("skyledger-batch", given.master)
    rejects = None
    with ExitStack() as staged:
        if given.input_format == "csv":
            flights, rejects = stage_flights(spark, given.input, staged.enter_context(scratch_dir(spark, "flights")))
        else:
            flights = read_flights(spark, given.input)
        written = run_batch(
            spark, flights, given.output, given.year, given.output_format, store_of(given), rejects)
    for table, path in written.items():
        print(table, path)
        if given.show:
            read_table(spark, table, given.output, given.output_format).show(10, truncate=False)


if __name__ == "__main__":
    main()
