"""Unit conversions."""

from __future__ import annotations

from collections.abc import Callable


def speed(u: str, v: str) -> str:
    """Length of a vector given by its two components."""
    return f"sqrt(pow({u}, 2D) + pow({v}, 2D))"


def celsius(kelvin: str) -> str:
    return f"({kelvin}) - 273.15D"


def millimetre(metre: str) -> str:
    return f"({metre}) * 1000D"


UNITS: dict[str, Callable[..., str]] = {
    "speed": speed,
    "celsius": celsius,
    "millimetre": millimetre,
}
