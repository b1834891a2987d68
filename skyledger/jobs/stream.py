"""Answer all questions continuously over a message stream, which one query decodes to a log that the others follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.jobs.options import add_format, add_store, key_values, parser, store_of
from skyledger.operators import TwoLegBounds
from skyledger.session import build_session
from skyledger.sinks import Store
from skyledger.sources import read_messages
from skyledger.streaming import AVAILABLE_NOW, EVERY_TEN_SECONDS, start_from_log

POLL_SECONDS = 1

# The airports, first days and year of the continuous two-leg question.
TWO_LEG_BOUNDS = TwoLegBounds(
    xs=["BOS", "PHX", "DFW", "LAX", "CMH"],
    ys=["ATL", "JFK", "STL", "MIA"],
    zs=["LAX", "MSP", "ORD", "SNA"],
    dates=["03/04/2008", "07/09/2008", "24/01/2008", "16/05/2008", "01/07/1990"],
    year=2008,
)


# How much one micro-batch takes in at most, so that a first start does not take a
# whole backlog at once. Everything is taken in, batch by batch; --option replaces the limit.
FILE_INTAKE = {"maxBytesPerTrigger": str(1 << 30)}
BROKER_INTAKE = {"maxOffsetsPerTrigger": "10000000"}


def with_intake(fmt: str, options: dict[str, str]) -> dict[str, str]:
    """``options`` with the limit of the format, unless they carry one (Spark takes a single one)."""
    if any(name.lower().startswith("max") and name.lower().endswith("pertrigger") for name in options):
        return options
    return {**(BROKER_INTAKE if fmt == "kafka" else FILE_INTAKE), **options}


def run_stream(
    messages: DataFrame,
    root: str,
    bounds: TwoLegBounds = TWO_LEG_BOUNDS,
    trigger: dict | None = None,
    show: int = 0,
    store: Store | None = None,
    **intake: str,
) -> list[StreamingQuery]:
    """Start the log of flights and rejected lines, and every question on it, under ``root``."""
    return start_from_log(messages, root, bounds, trigger, show, store, **intake)


def wait_for(queries: Sequence[StreamingQuery]) -> None:
    """Wait until every query has ended; a failed one ends the wait with its error."""
    while any(query.isActive for query in queries):
        for query in queries:
            query.awaitTermination(POLL_SECONDS)
    for query in queries:
        query.awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    args = parser(__doc__)
    args.add_argument("--input", help="folder of the message files; not for a broker")
    args.add_argument("--output", required=True)
    args.add_argument("--once", action="store_true", help="take in what is there and stop")
    args.add_argument("--show", action="store_true", help="print the first rows of every micro-batch's results")
    add_format(args, "text")
    add_store(args)
    given = args.parse_args(argv)
    spark = build_session("skyledger-stream", given.master)
    trigger = AVAILABLE_NOW if given.once else EVERY_TEN_SECONDS
    messages = read_messages(spark, given.input, given.format, **with_intake(given.format, key_values(given.option)))
    wait_for(run_stream(
        messages, given.output, trigger=trigger, show=10 if given.show else 0, store=store_of(given)))


if __name__ == "__main__":
    main()
