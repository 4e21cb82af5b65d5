"""Contract violations, and the guard that finds them with one action."""

from __future__ import annotations

from pyspark.sql import DataFrame


class ContractError(ValueError):
    """An input breaks an explicit rule of the data set."""


def fail_if_any(rows: DataFrame, message: str, limit: int = 5) -> None:
    """Raise with the first few offending rows, if there are any; at most ``limit`` rows reach the driver."""
    found = rows.limit(limit).collect()
    if found:
        shown = "; ".join(", ".join(str(v) for v in row) for row in found)
        raise ContractError(f"{message}: {shown}")
