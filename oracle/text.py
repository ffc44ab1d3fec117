"""Small builders of SQL text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def quote(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def listing(values: Sequence) -> str:
    return "[" + ", ".join(map(quote, values)) + "]"


def below(value: str, cuts: Sequence, labels: Sequence[str]) -> str:
    """Label by how many cuts the value has reached; the last label for NULL."""
    reached = " + ".join(f"({value} >= {cut})::INT" for cut in cuts)
    return f"coalesce({listing(labels)}[1 + {reached}], {quote(labels[-1])})"


def mapped(value: str, pairs: Mapping[str, str], other: str | None) -> str:
    found = "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in pairs.items()) + "}"
    if other is None:
        return f"{found}[{value}]"
    return f"coalesce({found}[{value}], {quote(other)})"


def scaled(whole: str, places: int, dtype: str) -> str:
    """An integer count of 10^-places units as a decimal."""
    unit = "0." + "0" * (places - 1) + "1"
    return f"(({whole})::DECIMAL(18,0) * {unit})::{dtype}"


def half_up(top: str, bottom: str) -> str:
    """Integer top / bottom rounded half away from zero (bottom > 0)."""
    return (
        f"(CASE WHEN ({top}) < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs({top})::HUGEINT + ({bottom})) // (2 * ({bottom}))))"
    )


def cents(money: str) -> str:
    return f"({money} * 100)::HUGEINT"


def average(money: str, n: str) -> str:
    """Average of a sum of decimal(10,2) over n, as decimal(14,6)."""
    return scaled(half_up(f"{cents(money)} * 10000", n), 6, "DECIMAL(14,6)")
