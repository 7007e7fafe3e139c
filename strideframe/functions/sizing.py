"""Size-checked broadcasts.

A side is broadcast only when its row count is proven small: either bounded by
construction (a parameter such as the window size) or counted here.  Above the
bound the frame is returned as is and the planner (with AQE's runtime sizes)
picks a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_rows`` rows (one counting job), else ``df``."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def check_rows(n: int, max_rows: int = MAX_BROADCAST_ROWS, what: str = "table") -> None:
    """Raise when a parameter-sized table would exceed the broadcast bound."""
    if n > max_rows:
        raise ValueError(f"{what} has {n} rows, above the broadcast bound {max_rows}")


def local_if_small(df: DataFrame, max_rows: int = 50_000) -> tuple[DataFrame, bool]:
    """A small table evaluated once: ``df`` as a broadcast local table if it has at most ``max_rows`` rows.

    Unlike ``broadcast_if_small`` the plan that uses the table does not compute
    it again.  Above the bound ``df`` itself is returned.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df, False
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), True
