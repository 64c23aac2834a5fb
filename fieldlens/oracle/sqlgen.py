"""Helpers that emit DuckDB SQL text for the oracle.

The oracle re-states every table as SQL over the driver's pre-registered
views. It is an independent formulation (window functions where the Spark
side aggregates with ``max_by``, ``COUNT(DISTINCT ...)`` where Spark uses
plain counts over a unique key, integer HALF_UP arithmetic for rounding), so
agreement between the two is evidence rather than a tautology.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

AS_OF = "DATE '2024-01-31'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values: Sequence) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def pick(values: Sequence, idx: str) -> str:
    """values[idx] for a 0-based integer expression (DuckDB lists are 1-based)."""
    return f"{lst(values)}[CAST(({idx}) AS BIGINT) + 1]"


def rhu(num: str, den: str, scale: int) -> str:
    """HALF_UP round of num/den (non-negative integers) to ``scale`` decimals, as DECIMAL.

    DuckDB divides DECIMALs in DOUBLE, so the quotient is formed on integers:
    floor((2 * 10^scale * num + den) / (2 * den)) * 10^-scale.
    """
    p = 10 ** scale
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return (f"(CAST((2 * {p} * CAST(({num}) AS HUGEINT) + CAST(({den}) AS HUGEINT)) "
            f"// (2 * CAST(NULLIF(({den}), 0) AS HUGEINT)) AS DECIMAL(38,0)) * {unit})")


def days_since(col: str) -> str:
    return f"CAST(date_diff('day', {col}, {AS_OF}) AS INTEGER)"


def first_upper(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || substr({x}, 2))"


def with_ctes(ctes: dict[str, tuple[str, list[str]]], final: str, deps: list[str]) -> str:
    """``WITH`` clause holding ``deps`` and their transitive dependencies, then ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in ctes[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{ctes[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def as_before(ctes: dict[str, tuple[str, list[str]]], name: str, replaced: dict[str, str]) -> str:
    """Adds a second chain of CTEs (names ending in ``_before``) in which some tables are replaced; returns ``name``'s name in it."""
    hit: dict[str, bool] = {}

    def uses(n: str) -> bool:
        if n not in hit:
            hit[n] = n in replaced or any([uses(d) for d in ctes[n][1]])
        return hit[n]

    uses(name)
    changed = [n for n, h in hit.items() if h]
    for n in changed:
        if n in replaced:
            ctes[f"{n}_before"] = (replaced[n], [n])
        else:
            body, deps = ctes[n]
            mine = [d for d in deps if hit[d]]
            if mine:
                body = re.sub(r"\b(FROM|JOIN)(\s+)(" + "|".join(map(re.escape, mine)) + r")\b", r"\1\2\3_before", body)
            ctes[f"{n}_before"] = (body, [f"{d}_before" if hit[d] else d for d in deps])
    return f"{name}_before"
