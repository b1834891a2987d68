from skyledger.functions.columns import (
    as_day,
    day_text,
    flat_text,
    in_parts,
    list_text,
    mean_of,
    parse_int,
    round2,
    tuple_text,
    unit_of,
)

__all__ = [
    "as_day", "day_text", "flat_text", "in_parts", "list_text", "mean_of", "parse_int", "round2", "tuple_text", "unit_of",
]
