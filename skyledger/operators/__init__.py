from skyledger.operators.aggregates import (
    airport_visits,
    best_per_group,
    count_by,
    endpoint_counts,
    mean_by,
    mean_state,
    merge_exact_state,
    merge_mean_state,
    popularity,
)
from skyledger.operators.filters import complete_rows, in_set, with_value
from skyledger.operators.legs import (
    TwoLegBounds,
    TwoLegSets,
    all_legs,
    best_legs,
    best_of_each_leg,
    bounded_legs,
    bounded_legs_by_tables,
    day_range,
    morning_flights,
    afternoon_flights,
    pair_legs,
    split_legs,
    with_keys,
)
from skyledger.operators.packing import pack_top
from skyledger.operators.ranking import rank_top, rank_top_per_group

__all__ = [
    "TwoLegBounds", "TwoLegSets", "afternoon_flights", "airport_visits", "all_legs", "best_legs", "best_of_each_leg",
    "best_per_group", "bounded_legs", "bounded_legs_by_tables", "complete_rows", "count_by", "day_range", "endpoint_counts", "in_set", "mean_by",
    "mean_state", "merge_exact_state", "merge_mean_state", "morning_flights", "pack_top", "pair_legs", "popularity",
    "rank_top", "rank_top_per_group", "split_legs", "with_keys", "with_value",
]
