"""SQL building blocks for the comparison queries."""

from __future__ import annotations

from monthfusion.contracts import attribute_order, fused_columns
from monthfusion.plans.analogs import CONTRACT

SLOTS = tuple(s.name for s in CONTRACT.sources)

# DuckDB has no initcap.
TITLE = (
    "array_to_string(list_transform(string_split(trim({c}), ' '), "
    "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)

FACTS = {
    "bird": """
        SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
               n_nationkey AS n, n_name, 1 AS weight, o_orderkey % 3 AS file_no, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "horse": """
        SELECT CAST(year(l_shipdate) AS INT) AS y, CAST(month(l_shipdate) AS INT) AS m,
               n_nationkey AS n, n_name, 1 AS weight, l_linenumber % 3 AS file_no
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey""",
    "mosquito": """
        SELECT CAST(year(l_shipdate) AS INT) AS y, CAST(month(l_shipdate) AS INT) AS m,
               n_nationkey AS n, n_name, CAST(l_linestatus = 'F' AS INT) AS weight,
               l_linenumber % 3 AS file_no
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey""",
}


def raw(slot: str, outcome: str = "sum(weight) OVER (PARTITION BY y, m, n)", kept: str = "") -> str:
    """Raw rows of a slot."""
    rain = "m * 0.0009765625e0"
    if slot == "mosquito":
        rain = f"CASE WHEN n % 7 <> 3 THEN {rain} END"
    name = CONTRACT.source(slot).outcome
    return f"""
        SELECT y AS Year, m AS Month, n,
               ' ' || lower(replace(n_name, '_', ' ')) || ' ' AS County,
               CAST({outcome} AS BIGINT) AS {name},
               make_date(y, m, 1) AS Date,
               CAST(17001 + 2 * n AS DOUBLE) AS FIPS,
               37.0e0 + n * 0.125e0 AS County_Seat_Latitude,
               -91.5e0 + n * 0.25e0 AS County_Seat_Longitude,
               100.0e0 * (n + 1) AS Land_Area_2010,
               CAST(n % 5 AS DOUBLE) AS Avian_Phylodiversity,
               (m - 6) * 0.25e0 AS u10_1m_shift,
               n * 0.125e0 AS v10_1m_shift,
               270.0e0 + m + n * 0.5e0 AS t2m_1m_shift,
               {rain} AS tp_1m_shift,
               CASE WHEN m IN (12, 1, 2) THEN 0.5e0 ELSE 0.0e0 END AS sf_1m_shift,
               m * 0.0625e0 AS sro_1m_shift,
               2.0e0 + m * 0.125e0 AS lai_hv_1m_shift,
               1.0e0 + m * 0.125e0 AS lai_lv_1m_shift,
               0.25e0 AS src_1m_shift,
               'file:///landing/{slot}/' || file_no || '.csv' AS source_file,
               make_timestamp(2024, 1, 1 + (n + {SLOTS.index(slot)}) % 3, m, 0, 0) AS ingested_at
               {kept}
        FROM ({FACTS[slot]})"""


RAW_OUTCOMES = raw("bird", "o_orderkey % 4", ", o_orderkey")


def shifted(base: str, changes: dict[str, str]) -> str:
    """The same rows with some columns replaced."""
    replaced = ", ".join(f"{expr} AS {name}" for name, expr in changes.items())
    return f"SELECT * REPLACE ({replaced}) FROM ({base})"


DISTURBED = {
    "bird": shifted(
        raw("bird"),
        {
            "County_Seat_Latitude": "County_Seat_Latitude + CASE n WHEN 1 THEN pow(2e0, -20) WHEN 2 THEN pow(2e0, -30) ELSE 0e0 END",
            "County_Seat_Longitude": "CASE WHEN n <> 7 THEN County_Seat_Longitude + CASE n WHEN 6 THEN pow(2e0, -20) WHEN 8 THEN 1e0 ELSE 0e0 END END",
            "t2m_1m_shift": "t2m_1m_shift + CASE n WHEN 4 THEN pow(2e0, -20) WHEN 9 THEN pow(2e0, -30) ELSE 0e0 END",
        },
    ),
    "horse": shifted(
        raw("horse"),
        {
            "tp_1m_shift": "CASE WHEN n <> 10 THEN tp_1m_shift + CASE n WHEN 5 THEN pow(2e0, -20) ELSE 0e0 END END",
            "County_Seat_Latitude": "CASE WHEN n <> 8 THEN County_Seat_Latitude END",
        },
    ),
    "mosquito": shifted(
        raw("mosquito"),
        {
            "FIPS": "FIPS + CASE n WHEN 3 THEN 2e0 ELSE 0e0 END",
            "County_Seat_Latitude": "CASE WHEN n <> 8 THEN County_Seat_Latitude END",
        },
    ),
}


def silver(slot: str, rows: str | None = None) -> str:
    """One row per key of a slot, counting distinct values exactly."""
    s = CONTRACT.source(slot)
    compared = [s.outcome, *(a.raw for a in s.attributes)]
    columns = [
        f"CAST(max({a.raw}) AS {a.cast}) AS {a.name}" if a.cast else f"max({a.raw}) AS {a.name}"
        for a in s.attributes
    ]
    distinct = ", ".join(f"count(DISTINCT {c})" for c in compared)
    return f"""
        SELECT *, sqrt(pow(wind_u_1m_shift, 2) + pow(wind_v_1m_shift, 2)) AS wind_speed_1m_shift,
               temperature_k_1m_shift - 273.15e0 AS temperature_c_1m_shift,
               precipitation_m_1m_shift * 1000e0 AS precipitation_mm_1m_shift
        FROM (
            SELECT Year AS year, Month AS month, make_date(Year, Month, 1) AS observation_month,
                   {TITLE.format(c="County")} AS county,
                   max({s.outcome}) AS {s.count_column},
                   {", ".join(columns)},
                   count(*) AS source_row_count,
                   greatest({distinct}) AS distinct_value_max,
                   max(source_file) AS source_file, max(ingested_at) AS latest_ingested_at
            FROM ({rows or raw(slot)}) GROUP BY ALL)"""


def sources(rows: dict[str, str] | None = None) -> str:
    """WITH clause: one relation per slot, and the keys of all."""
    rows = rows or {}
    ctes = [f"{s} AS ({silver(s, rows.get(s))})" for s in SLOTS]
    keys = " UNION ".join(f"SELECT year, month, county FROM {s}" for s in SLOTS)
    return f"WITH {', '.join(ctes)}, keys AS ({keys})"


JOINED = "keys " + " ".join(f"LEFT JOIN {s} USING (year, month, county)" for s in SLOTS)


def picked(name: str) -> str:
    return "coalesce(" + ", ".join(f"{s}.{name}" for s in CONTRACT.precedence) + ")"


def _agreement_relation() -> str:
    """Per key: do all pairs of sources agree?  Compared pair by pair."""
    names = ("county_fips", "latitude", "longitude", "temperature_k_1m_shift", "precipitation_m_1m_shift")
    sides = " UNION ALL ".join(
        f"SELECT {i} AS slot, year, month, county, {', '.join(names)} FROM {s}" for i, s in enumerate(SLOTS)
    )
    tests = []
    for a in CONTRACT.agreements:
        apart = []
        for c in a.columns:
            gate = f"a.{a.gate} IS NOT NULL AND b.{a.gate} IS NOT NULL AND " if a.gate else ""
            differ = f"a.{c} <> b.{c}" if a.tolerance is None else f"abs(a.{c} - b.{c}) > {a.tolerance:e}"
            apart.append(f"({gate}{differ})")
        tests.append(f"NOT bool_or(coalesce({' OR '.join(apart)}, false)) AS {a.name}")
    return f"""
        SELECT a.year, a.month, a.county, {", ".join(tests)}
        FROM ({sides}) a JOIN ({sides}) b
          ON a.year = b.year AND a.month = b.month AND a.county = b.county AND a.slot < b.slot
        GROUP BY ALL"""


def gold(rows: dict[str, str] | None = None) -> str:
    """The fused table, ready to be selected from."""
    order = attribute_order(CONTRACT.sources[0])
    derived = {
        "wind_speed_1m_shift": f"sqrt(pow({picked('wind_u_1m_shift')}, 2) + pow({picked('wind_v_1m_shift')}, 2))",
        "temperature_c_1m_shift": f"{picked('temperature_k_1m_shift')} - 273.15e0",
        "precipitation_mm_1m_shift": f"{picked('precipitation_m_1m_shift')} * 1000e0",
    }
    columns = [
        "make_date(year, month, 1) AS observation_month",
        *(f"{s}_count" for s in SLOTS),
        *(f"{s}_count IS NOT NULL AS {s}_reported" for s in SLOTS),
        " + ".join(f"CAST({s}_count IS NOT NULL AS INT)" for s in SLOTS) + " AS reported_activity_types",
        " + ".join(f"coalesce({s}_count, 0)" for s in SLOTS) + f" AS {CONTRACT.total_column}",
        *(f"{derived.get(c, picked(c))} AS {c}" for c in order),
        *(f"coalesce(agreement.{a.name}, true) AS {a.name}" for a in CONTRACT.agreements),
        *(f"{s}.source_file AS {s}_source_file" for s in SLOTS),
        "greatest(" + ", ".join(f"{s}.latest_ingested_at" for s in SLOTS) + ") AS latest_ingested_at",
    ]
    return f"""
        {sources(rows)}, agreement AS ({_agreement_relation()}),
        gold AS (
            SELECT year, month, county, {", ".join(columns)}
            FROM {JOINED} LEFT JOIN agreement USING (year, month, county))"""


GOLD_COLUMNS = fused_columns(CONTRACT)
