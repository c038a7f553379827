"""Fuse cleaned sources into one table, keeping "missing" apart from "zero"."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from monthfusion.contracts import KEY, Agreement, FusionContract, fused_columns
from monthfusion.functions.keys import month_start
from monthfusion.functions.units import UNITS

Silver = dict[str, DataFrame]


def of(source: str, name: str) -> str:
    """Name of a source's column once sources are side by side."""
    return f"{source}__{name}"


def side(silver: DataFrame, source: str) -> DataFrame:
    """One source with every column but the key marked as its own."""
    return silver.selectExpr(
        *KEY, *(f"{c} AS {of(source, c)}" for c in silver.columns if c not in KEY)
    )


def key_universe(silver: Silver) -> DataFrame:
    """Every key that any source has."""
    return reduce(DataFrame.unionByName, [df.select(*KEY) for df in silver.values()]).distinct()


def align_left(silver: Silver) -> DataFrame:
    """All keys left-joined with each source in turn.

    A key with a NULL part meets no source and keeps NULL in every column.
    """
    wide = key_universe(silver)
    for name, df in silver.items():
        wide = wide.join(side(df, name), list(KEY), "left")
    return wide


def align_full(silver: Silver) -> DataFrame:
    """The same rows as :func:`align_left` for keys without NULL parts.

    Each source is read once, where the key union reads each a second time, and
    no key set is built.  Key rules refuse NULL parts before this.
    """
    sides = [side(df, name) for name, df in silver.items()]
    return reduce(lambda left, right: left.join(right, list(KEY), "full"), sides)


ALIGN = {"left": align_left, "full": align_full}


def first_reported(contract: FusionContract, name: str) -> str:
    """Value of the most trusted source that has one."""
    having = contract.reporting(name)
    return f"coalesce({', '.join(of(s, name) for s in contract.precedence if s in having)})"


def agree(contract: FusionContract, rule: Agreement) -> str:
    """True unless two sources that both report differ.

    Two of several values differ by more than the tolerance exactly when the
    largest and the smallest do, so one comparison replaces all pairs.
    """
    differs = []
    for c in rule.columns:
        gate = rule.gate or c
        names = contract.reporting(c, gate)
        if len(names) < 2:
            continue
        values = [f"CASE WHEN {of(n, gate)} IS NOT NULL THEN {of(n, c)} END" for n in names]
        present = " + ".join(f"CAST(({v}) IS NOT NULL AS INT)" for v in values)
        high, low = (f"{f}({', '.join(values)})" for f in ("greatest", "least"))
        if rule.tolerance is None:
            apart = f"{high} <> {low}"
        else:
            apart = f"{high} - {low} > {rule.tolerance!r}D"
        differs.append(f"({present} >= 2 AND {apart})")
    return f"NOT coalesce({' OR '.join(differs)}, false)" if differs else "true"


def fuse(silver: Silver, contract: FusionContract, align: str = "left") -> DataFrame:
    """One row per key reported by any source.

    ``silver`` maps source names to tables with one row per key.  Use
    ``align="full"`` when the keys are known to be complete (published tables
    are); it is the faster plan.
    """
    names = [s.name for s in contract.sources]
    wide = ALIGN[align]({n: silver[n] for n in names})

    count = {n: of(n, f"{n}_count") for n in names}
    latest = ", ".join(of(n, "latest_ingested_at") for n in names)
    # A count was reported when it is there; zero is a count, NULL is none.
    value = {
        "observation_month": month_start("year", "month"),
        **{f"{n}_count": c for n, c in count.items()},
        **{f"{n}_reported": f"{c} IS NOT NULL" for n, c in count.items()},
        "reported_activity_types": " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in count.values()),
        contract.total_column: " + ".join(f"coalesce({c}, 0L)" for c in count.values()),
        **{a.name: first_reported(contract, a.name) for a in contract.attributes},
        **{a.name: agree(contract, a) for a in contract.agreements},
        **{f"{n}_source_file": of(n, "source_file") for n in names},
        "latest_ingested_at": f"greatest({latest})" if len(names) > 1 else latest,
    }
    # Units come from the chosen components, which may stem from two sources.
    for d in contract.derived:
        value[d.name] = UNITS[d.unit](*(value[c] for c in d.inputs))
    return wide.selectExpr(*(f"{value.get(c, c)} AS {c}" for c in fused_columns(contract)))
