"""Side-by-side comparison of a query with its oracle."""

from __future__ import annotations

import duckdb
import pandas as pd

from workload.tables import DRIVER_TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in DRIVER_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as text, rows sorted."""
    frame = frame[sorted(frame.columns)].astype(object)
    text = frame.map(lambda v: "" if pd.isna(v) else repr_value(v))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def repr_value(value: object) -> str:
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int | float):
        number = float(value)
        return repr(number if number != 0 else 0.0)
    if hasattr(value, "item"):
        return repr_value(value.item())
    return str(value)


def differences(ours: pd.DataFrame, oracle: pd.DataFrame) -> str | None:
    """None when equal, else a short description."""
    if sorted(ours.columns) != sorted(oracle.columns):
        return f"columns {sorted(set(ours.columns) ^ set(oracle.columns))}"
    if len(ours) != len(oracle):
        return f"rows {len(ours)} vs {len(oracle)}"
    left, right = normal(ours), normal(oracle)
    unequal = (left != right).any()
    if unequal.any():
        name = unequal[unequal].index[0]
        at = (left[name] != right[name]).to_numpy().nonzero()[0]
        return (
            f"columns {list(unequal[unequal].index)}; {len(at)} rows in {name}, first "
            f"{left[name].iloc[at[0]]} vs {right[name].iloc[at[0]]}"
        )
    return None
