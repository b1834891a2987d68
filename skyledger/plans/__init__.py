from skyledger.plans.questions import (
    airport_popularity,
    carrier_punctuality,
    first_legs,
    origin_packed,
    origin_top,
    route_mean_arr_delay,
    second_legs,
    two_leg_all,
    two_leg_bounded,
    two_leg_by_tables,
)

__all__ = [
    "airport_popularity", "carrier_punctuality", "first_legs", "origin_packed", "origin_top",
    "route_mean_arr_delay", "second_legs", "two_leg_all", "two_leg_bounded", "two_leg_by_tables",
]
