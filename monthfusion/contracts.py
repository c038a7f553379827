"""Data contracts: what a source delivers and how sources are fused.

Nothing here touches Spark.  A contract is plain data, so the same operators
serve one, three or any number of sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

KEY = ("year", "month", "county")


@dataclass(frozen=True)
class Attribute:
    """One enrichment column: its name on arrival and its name once cleaned."""

    raw: str
    name: str
    type: str = "double"
    cast: str | None = None


@dataclass(frozen=True)
class Derived:
    """A unit computed from cleaned attributes, placed after the last of them."""

    name: str
    unit: str
    inputs: tuple[str, ...]


@dataclass(frozen=True)
class Agreement:
    """Sources reporting the same key must agree on these columns.

    Values are compared where both sources have ``gate`` (by default: the
    compared column itself) and may differ by at most ``tolerance``.
    """

    name: str
    columns: tuple[str, ...]
    tolerance: float | None = None
    gate: str | None = None


@dataclass(frozen=True)
class FileContract:
    """What raw files must satisfy before they are loaded."""

    required_columns: tuple[str, ...]
    numeric_columns: tuple[str, ...]
    year_bounds: tuple[int, int]
    month_bounds: tuple[int, int] = (1, 12)


@dataclass(frozen=True)
class SourceContract:
    """One reporting source."""

    name: str
    outcome: str
    attributes: tuple[Attribute, ...]
    derived: tuple[Derived, ...]
    files: FileContract
    file_name: str | None = None
    other_columns: tuple[tuple[str, str], ...] = ()
    renames: tuple[tuple[str, str], ...] = ()
    year_bounds: tuple[int, int] = (2002, 2100)
    month_bounds: tuple[int, int] = (1, 12)

    @property
    def count_column(self) -> str:
        return f"{self.name}_count"

    @property
    def pinned_types(self) -> dict[str, str]:
        """Column types fixed by contract, under the names used in the files."""
        arrival = {new: old for old, new in self.renames}
        pinned = {"Year": "int", "Month": "int", "County": "string"}
        pinned[self.outcome] = "bigint"
        pinned.update(self.other_columns)
        for a in self.attributes:
            pinned[arrival.get(a.raw, a.raw)] = a.type
        return pinned


@dataclass(frozen=True)
class FusionContract:
    """How cleaned sources become one table."""

    sources: tuple[SourceContract, ...]
    precedence: tuple[str, ...]
    agreements: tuple[Agreement, ...]
    total_column: str
    gold_name: str = "gold_county_month"
    year_bounds: tuple[int, int] = (2002, 2100)
    month_bounds: tuple[int, int] = (1, 12)

    @property
    def attributes(self) -> tuple[Attribute, ...]:
        """Attributes of all sources, each once, in order of appearance."""
        return self._united("attributes")

    @property
    def derived(self) -> tuple[Derived, ...]:
        return self._united("derived")

    def _united(self, part: str) -> tuple:
        first: dict = {}
        for s in self.sources:
            for x in getattr(s, part):
                first.setdefault(x.name, x)
        return tuple(first.values())

    def reporting(self, *names: str) -> list[str]:
        """Sources whose cleaned tables have all of these columns."""
        return [s.name for s in self.sources if set(names) <= {s.count_column, *(x.name for x in (*s.attributes, *s.derived))}]

    def source(self, name: str) -> SourceContract:
        return next(s for s in self.sources if s.name == name)

    def with_years(self, first: int, last: int) -> "FusionContract":
        """The same contract for data of other years."""
        sources = tuple(replace(s, year_bounds=(first, last)) for s in self.sources)
        return replace(self, sources=sources, year_bounds=(first, last))


@dataclass(frozen=True)
class TableExpectation:
    """Known facts a consumer expects of the fused table; None is unchecked."""

    columns: tuple[str, ...]
    flags: tuple[str, ...]
    row_count: int | None = None
    first_year: int | None = None
    last_year: int | None = None
    county_count: int | None = None
    key: tuple[str, ...] = field(default=KEY)


# Column names, types, bounds and tolerances of the three-source
# county-month data set.
ATTRIBUTES = (
    Attribute("FIPS", "county_fips", cast="int"),
    Attribute("County_Seat_Latitude", "latitude"),
    Attribute("County_Seat_Longitude", "longitude"),
    Attribute("Land_Area_2010", "land_area_2010"),
    Attribute("Avian_Phylodiversity", "avian_phylodiversity"),
    Attribute("u10_1m_shift", "wind_u_1m_shift"),
    Attribute("v10_1m_shift", "wind_v_1m_shift"),
    Attribute("t2m_1m_shift", "temperature_k_1m_shift"),
    Attribute("tp_1m_shift", "precipitation_m_1m_shift"),
    Attribute("sf_1m_shift", "snowfall_1m_shift"),
    Attribute("sro_1m_shift", "surface_runoff_1m_shift"),
    Attribute("lai_hv_1m_shift", "high_vegetation_index_1m_shift"),
    Attribute("lai_lv_1m_shift", "low_vegetation_index_1m_shift"),
)

DERIVED = (
    Derived("wind_speed_1m_shift", "speed", ("wind_u_1m_shift", "wind_v_1m_shift")),
    Derived("temperature_c_1m_shift", "celsius", ("temperature_k_1m_shift",)),
    Derived("precipitation_mm_1m_shift", "millimetre", ("precipitation_m_1m_shift",)),
)

AGREEMENTS = (
    Agreement("fips_consistent", ("county_fips",)),
    Agreement("coordinates_consistent", ("latitude", "longitude"), 1e-7, "latitude"),
    Agreement(
        "weather_consistent",
        ("temperature_k_1m_shift", "precipitation_m_1m_shift"),
        1e-7,
    ),
)

# Columns that files must have, and those that must hold numbers.
FILE_COLUMNS = (
    "Year",
    "Month",
    "County",
    "FIPS",
    "County_Seat_Longitude",
    "County_Seat_Latitude",
    "Date",
    "u10_1m_shift",
    "v10_1m_shift",
    "t2m_1m_shift",
    "tp_1m_shift",
)

FILE_NUMBERS = (
    "FIPS",
    "County_Seat_Longitude",
    "County_Seat_Latitude",
    "u10_1m_shift",
    "v10_1m_shift",
    "t2m_1m_shift",
    "lai_hv_1m_shift",
    "lai_lv_1m_shift",
    "src_1m_shift",
    "sf_1m_shift",
    "sro_1m_shift",
    "tp_1m_shift",
)


def county_source(name: str, outcome: str, file_name: str | None = None) -> SourceContract:
    """A source of the county-month data set."""
    return SourceContract(
        name=name,
        outcome=outcome,
        attributes=ATTRIBUTES,
        derived=DERIVED,
        files=FileContract(
            required_columns=(*FILE_COLUMNS, outcome),
            numeric_columns=FILE_NUMBERS,
            year_bounds=(1900, 2100),
        ),
        file_name=file_name,
        other_columns=(("Date", "date"), ("src_1m_shift", "double")),
        renames=(("Avian Phylodiversity", "Avian_Phylodiversity"),),
    )


COUNTY_MONTH = FusionContract(
    sources=(
        county_source("bird", "Bird", "bird_illinois_county_02_to_22.csv"),
        county_source("horse", "Horse", "horse_illinois_county_02_to_22.csv"),
        county_source("mosquito", "Mosquito", "mos_illinois_county_02_to_22.csv"),
    ),
    precedence=("mosquito", "bird", "horse"),
    agreements=AGREEMENTS,
    total_column="total_reported_non_human_activity",
)


def fused_columns(contract: FusionContract) -> tuple[str, ...]:
    """Column names of the fused table, in order."""
    names = [s.name for s in contract.sources]
    return (
        "year",
        "month",
        "observation_month",
        "county",
        "county_fips",
        *(f"{n}_count" for n in names),
        *(f"{n}_reported" for n in names),
        "reported_activity_types",
        contract.total_column,
        *(c for c in attribute_order(contract) if c != "county_fips"),
        *(a.name for a in contract.agreements),
        *(f"{n}_source_file" for n in names),
        "latest_ingested_at",
    )


def column_comments(contract: FusionContract) -> dict[str, str]:
    """What the columns of the fused table hold, for those that a contract says it of."""
    said = {a.name: f"{a.raw} of the first source in the order of trust that has it" for a in contract.attributes}
    for d in contract.derived:
        said[d.name] = f"{d.unit} of {' and '.join(d.inputs)}"
    for s in contract.sources:
        said[s.count_column] = f"{s.outcome} as reported; NULL where {s.name} has no report"
        said[f"{s.name}_reported"] = f"whether {s.name} has a report, zero included"
        said[f"{s.name}_source_file"] = f"last file with the report of {s.name}"
    for a in contract.agreements:
        said[a.name] = f"whether sources agree on {' and '.join(a.columns)}"
    return said


def attribute_order(source: SourceContract | FusionContract) -> tuple[str, ...]:
    """Cleaned attributes with every derived unit right after its last input."""
    after = {d.inputs[-1]: d.name for d in source.derived}
    order: list[str] = []
    for a in source.attributes:
        order.append(a.name)
        if a.name in after:
            order.append(after[a.name])
    return tuple(order)


# Size and range of the complete published data set.
COUNTY_MONTH_TABLE = TableExpectation(
    columns=fused_columns(COUNTY_MONTH),
    flags=tuple(a.name for a in AGREEMENTS),
    row_count=2261,
    first_year=2002,
    last_year=2022,
    county_count=101,
)
