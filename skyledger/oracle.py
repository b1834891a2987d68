"""The same answers in plain SQL, for checking the registered queries with another engine."""

from __future__ import annotations

FLIGHTS = """
SELECT CAST(year(l.l_shipdate) AS INT) AS "Year",
       CAST(isodow(l.l_shipdate) AS INT) AS DayOfWeek,
       CAST(l.l_shipdate AS DATE) AS FlightDate,
       p.p_brand AS UniqueCarrier,
       CAST(l.l_partkey AS VARCHAR) AS FlightNum,
       so.n_name AS Origin,
       cd.n_name AS Dest,
       CAST(floor(((l.l_orderkey*7 + l.l_partkey*13 + l.l_linenumber*61) % 1440) / 60) * 100
            + ((l.l_orderkey*7 + l.l_partkey*13 + l.l_linenumber*61) % 1440) % 60 AS INT) AS CRSDepTime,
       CASE WHEN l.l_partkey % 53 = 0 THEN NULL
            ELSE CAST(l.l_quantity - 20 AS FLOAT) END AS DepDelay,
       CASE WHEN l.l_partkey % 53 = 0 OR l.l_partkey % 47 = 0 THEN NULL
            ELSE CAST(l.l_quantity - 24 + (l.l_orderkey % 9) AS FLOAT) END AS ArrDelay
FROM lineitem l
JOIN orders   o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey  = c.c_custkey
JOIN supplier s ON l.l_suppkey  = s.s_suppkey
JOIN part     p ON l.l_partkey  = p.p_partkey
JOIN nation  so ON s.s_nationkey = so.n_nationkey
JOIN nation  cd ON c.c_nationkey = cd.n_nationkey
"""

ALL_PRESENT = (
    '"Year" IS NOT NULL AND DayOfWeek IS NOT NULL AND FlightDate IS NOT NULL'
    " AND UniqueCarrier IS NOT NULL AND FlightNum IS NOT NULL AND Origin IS NOT NULL"
    " AND Dest IS NOT NULL AND CRSDepTime IS NOT NULL AND DepDelay IS NOT NULL"
    " AND ArrDelay IS NOT NULL"
)


def _round2(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,12)), 2) AS DOUBLE)"


def _with_flights(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([f"flights AS ({FLIGHTS})", *ctes]) + "\n" + body


ENDPOINTS = """
SELECT Origin AS airport, count(*) AS n FROM flights GROUP BY Origin
UNION ALL
SELECT Dest AS airport, count(*) AS n FROM flights GROUP BY Dest
"""

POPULARITY = f"SELECT airport, CAST(sum(n) AS BIGINT) AS popularity FROM ({ENDPOINTS}) GROUP BY airport"

POPULARITY_TOP10 = f"""
SELECT CAST(row_number() OVER (ORDER BY popularity DESC, airport) AS INT) AS rank, airport, popularity
FROM ({POPULARITY}) QUALIFY rank <= 10
"""


def _carriers(order: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY {order}, airline) AS INT) AS rank, airline, avgarrdelay
FROM (SELECT UniqueCarrier AS airline, avg(ArrDelay) AS m, {_round2('avg(ArrDelay)')} AS avgarrdelay
      FROM flights GROUP BY UniqueCarrier HAVING avg(ArrDelay) IS NOT NULL)
QUALIFY rank <= 10
"""


def _origin_top(key: str) -> str:
    return f"""
SELECT Origin AS airport, CAST(rk AS INT) AS rank, {key}, {_round2('m')} AS avgdepdelay
FROM (SELECT Origin, {key}, m, row_number() OVER (PARTITION BY Origin ORDER BY m, {key}) AS rk
      FROM (SELECT Origin, {key}, avg(DepDelay) AS m FROM flights GROUP BY Origin, {key})
      WHERE Origin IS NOT NULL AND {key} IS NOT NULL AND m IS NOT NULL)
WHERE rk <= 10
"""


def _packed(key: str, column: str, item: str) -> str:
    return f"""
SELECT airport, '[' || string_agg({item}, ', ' ORDER BY rank) || ']' AS {column}
FROM ({_origin_top(key)}) GROUP BY airport
"""


def _flat(key: str) -> str:
    return f"{key} || ', ' || CAST(avgdepdelay AS VARCHAR)"


def _tuple(key: str) -> str:
    return f"'(' || {key} || ',' || CAST(avgdepdelay AS VARCHAR) || ')'"


ROUTES = f"""
SELECT Origin AS origin, Dest AS dest, {_round2('avg(ArrDelay)')} AS arrdelay
FROM flights GROUP BY Origin, Dest
HAVING Origin IS NOT NULL AND Dest IS NOT NULL AND avg(ArrDelay) IS NOT NULL
"""


def _best(where: str) -> str:
    return f"""
SELECT Origin, Dest, FlightDate, ArrDelay, UniqueCarrier, FlightNum, CRSDepTime
FROM (SELECT *, row_number() OVER (PARTITION BY Origin, Dest, FlightDate
                                   ORDER BY ArrDelay, UniqueCarrier, FlightNum, CRSDepTime) AS rk
      FROM flights WHERE {where})
WHERE rk = 1
"""


LEG1 = f'"Year" = 1998 AND CRSDepTime < 1200 AND {ALL_PRESENT}'
LEG2 = f'"Year" = 1998 AND CRSDepTime > 1200 AND {ALL_PRESENT}'


def _names(first: int, last: int) -> str:
    return ", ".join(f"'NATION_{i}'" for i in range(first, last + 1))


BOUNDED_LEG1 = (
    '"Year" = 1998 AND CRSDepTime < 1200 AND ArrDelay IS NOT NULL'
    f" AND Origin IN ({_names(0, 9)}) AND Dest IN ({_names(5, 14)})"
    " AND FlightDate BETWEEN DATE '1998-01-01' AND DATE '1998-04-10'"
)
BOUNDED_LEG2 = (
    '"Year" = 1998 AND CRSDepTime > 1200 AND ArrDelay IS NOT NULL'
    f" AND Origin IN ({_names(5, 14)}) AND Dest IN ({_names(10, 19)})"
    " AND FlightDate BETWEEN DATE '1998-01-03' AND DATE '1998-04-12'"
)

PAIRS = """
SELECT p.Origin AS airportx, p.Dest AS airporty, q.Dest AS airportz,
       strftime(p.FlightDate, '%d/%m/%Y') AS flightdate1,
       p.UniqueCarrier AS uniquecarrier1, p.FlightNum AS flightnum1,
       p.CRSDepTime AS crsdeptime1, p.ArrDelay AS arrdelay1,
       strftime(q.FlightDate, '%d/%m/%Y') AS flightdate2,
       q.UniqueCarrier AS uniquecarrier2, q.FlightNum AS flightnum2,
       q.CRSDepTime AS crsdeptime2, q.ArrDelay AS arrdelay2,
       CAST(p.ArrDelay + q.ArrDelay AS FLOAT) AS totaldelay
FROM leg1 p JOIN leg2 q ON p.Dest = q.Origin AND p.FlightDate = q.FlightDate - 2
"""


def _two_leg(leg1: str, leg2: str) -> str:
    return _with_flights(PAIRS, f"leg1 AS ({_best(leg1)})", f"leg2 AS ({_best(leg2)})")


def all_sql() -> dict[str, str]:
    every_flight = FLIGHTS
    routes = _with_flights(ROUTES)
    popularity_top10 = _with_flights(POPULARITY_TOP10)
    single = {
        "b_csv_scan_typed": every_flight,
        "b_csv_two_layouts": every_flight,
        "b_csv_scan_kept": every_flight,
        "b_csv_scan_rejects": _with_flights(
            "SELECT 'no flight: ' || FlightNum AS line FROM flights WHERE CAST(FlightNum AS BIGINT) % 11 = 0"),
        "b_table_roundtrip": routes,
        "b_complete_rows": _with_flights(f"SELECT * FROM flights WHERE {ALL_PRESENT}"),
        "b_endpoint_counts": _with_flights(ENDPOINTS),
        "b_airport_popularity_top10": popularity_top10,
        "b_carrier_ontime_top10": _with_flights(_carriers("avgarrdelay")),
        "b_origin_carrier_top10": _with_flights(_origin_top("UniqueCarrier")),
        "b_origin_dest_top10": _with_flights(_origin_top("Dest")),
        "b_origin_carrier_packed": _with_flights(
            _packed("UniqueCarrier", "topcarrier", _flat("UniqueCarrier"))),
        "b_origin_dest_packed": _with_flights(_packed("Dest", "topdest", _flat("Dest"))),
        "b_route_mean_arr_delay": routes,
        "b_leg1_best": _with_flights(_best(LEG1)),
        "b_leg2_best": _with_flights(_best(LEG2)),
        "b_two_leg_all": _two_leg(LEG1, LEG2),
        "b_two_leg_bounded": _two_leg(BOUNDED_LEG1, BOUNDED_LEG2),
        "b_two_leg_by_tables": _two_leg(BOUNDED_LEG1, BOUNDED_LEG2),
        "b_published_routes": routes,
        "b_two_leg_text_days": _two_leg(BOUNDED_LEG1, BOUNDED_LEG2),
        "s_replay_lines": every_flight,
        "s_wire_decode": every_flight,
        "s_state_sum": _with_flights(POPULARITY),
        "s_state_avg": _with_flights(
            "SELECT UniqueCarrier, sum(CAST(ArrDelay AS DOUBLE)) AS total,"
            " count(ArrDelay) AS n, avg(ArrDelay) AS mean"
            " FROM flights WHERE ArrDelay IS NOT NULL GROUP BY UniqueCarrier"),
        "s_state_argmin": _with_flights(_best("ArrDelay IS NOT NULL")),
        "s_stored_argmin": _with_flights(_best("ArrDelay IS NOT NULL")),
        "s_airport_popularity_top10": popularity_top10,
        "s_carrier_ontime_top10": _with_flights(_carriers("m")),
        "s_origin_carrier_packed": _with_flights(
            _packed("UniqueCarrier", "topcarrier", _tuple("UniqueCarrier"))),
        "s_origin_dest_packed": _with_flights(_packed("Dest", "topdest", _tuple("Dest"))),
        "s_route_mean_arr_delay": routes,
        "s_two_leg_bounded": _two_leg(BOUNDED_LEG1, BOUNDED_LEG2),
        "s_restart_resume": popularity_top10,
        "s_two_leg_resume": _two_leg(BOUNDED_LEG1, BOUNDED_LEG2),
        "s_route_mean_resume": routes,
        "s_all_two_leg_bounded": _two_leg(BOUNDED_LEG1, BOUNDED_LEG2),
    }
    single |= {
        "s_stored_avg": single["s_state_avg"],
        "s_log_flights": every_flight,
        "s_log_rejects": single["b_csv_scan_rejects"],
        "s_log_origin_carrier_packed": single["s_origin_carrier_packed"],
        "s_log_two_leg_bounded": single["s_two_leg_bounded"],
    }
    # The same answers from one summary of all flights.
    return single | {f"{kind}_summary_{name}": single[f"{kind}_{name}"] for kind in ("b", "s") for name in (
        "airport_popularity_top10", "carrier_ontime_top10", "origin_carrier_packed", "origin_dest_packed",
        "route_mean_arr_delay")}
