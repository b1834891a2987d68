"""Arguments the jobs share."""

from __future__ import annotations

import argparse

from skyledger.sinks import Store


def key_values(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def parser(description: str) -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=description)
    args.add_argument("--master", help="Spark master; left to spark-submit by default")
    return args


def add_format(args: argparse.ArgumentParser, default: str) -> None:
    args.add_argument("--format", default=default, help="source or sink format")
    args.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE",
        help="option of that format; may be repeated")


def add_store(args: argparse.ArgumentParser) -> None:
    args.add_argument("--store-format", help="connector of a keyed store that also gets the results")
    args.add_argument(
        "--store-option", action="append", default=[], metavar="KEY=VALUE",
        help="option of that connector; {table} stands for the result table")


def store_of(given: argparse.Namespace) -> Store | None:
    return Store(given.store_format, key_values(given.store_option)) if given.store_format else None
