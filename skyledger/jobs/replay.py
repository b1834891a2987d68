"""Replay headed CSV flights as messages, to text files or to a broker topic."""

from __future__ import annotations

from collections.abc import Sequence

from skyledger.jobs.options import add_format, key_values, parser
from skyledger.session import build_session
from skyledger.sources import read_flights_csv, replay_lines
from skyledger.sources.messages import TOPIC


def main(argv: Sequence[str] | None = None) -> None:
    args = parser(__doc__)
    args.add_argument("--input", action="append", required=True, help="path or glob; may be repeated")
    args.add_argument("--output", help="folder of the message files; not for a broker")
    add_format(args, "text")
    given = args.parse_args(argv)
    options = key_values(given.option)
    if given.format == "kafka":
        options.setdefault("topic", TOPIC)
    spark = build_session("skyledger-replay", given.master)
    replay_lines(read_flights_csv(spark, given.input), given.output, given.format, **options)


if __name__ == "__main__":
    main()
