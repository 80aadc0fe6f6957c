"""A window function as a caller writes it: the range of fares, the last drop-off, the flagged trips."""

from __future__ import annotations

import numpy as np
import pandas as pd

from meterline.operators.window_apply import Arrays, WindowFunction
from meterline.session import ship_by_value

ship_by_value(__name__)


def _range_start(rows: pd.DataFrame, group: np.ndarray, groups: int) -> Arrays:
    refund = rows["fare_amount"].where(rows["fare_amount"] < 0)
    parts = rows.assign(refund=refund, flagged=rows["store_and_fwd_flag"].eq("Y")).groupby(group)
    return {
        "low": parts["fare_amount"].min().to_numpy(),
        "high": parts["fare_amount"].max().to_numpy(),
        "last": parts["dropoff_datetime"].max().to_numpy(),
        "flagged": parts["flagged"].sum().to_numpy(),
        # Empty in groups without a refund.
        "flag": parts["refund"].count().map(lambda count: "refunds" if count else None).to_numpy(),
    }


def _range_merge(states: pd.DataFrame, group: np.ndarray, groups: int) -> Arrays:
    parts = states.groupby(group)
    return {
        "low": parts["low"].min().to_numpy(),
        "high": parts["high"].max().to_numpy(),
        "last": parts["last"].max().to_numpy(),
        "flagged": parts["flagged"].sum().to_numpy(),
        "flag": parts["flag"].first().to_numpy(),
    }


def _range_finish(states: pd.DataFrame) -> Arrays:
    return {
        "fare_range": (states["high"] - states["low"]).to_numpy(),
        "last_dropoff": states["last"].to_numpy(),
        "flagged_trips": states["flagged"].to_numpy(),
        "refunds": states["flag"].to_numpy(),
    }


FARE_RANGE = WindowFunction(
    columns=("fare_amount", "dropoff_datetime", "store_and_fwd_flag"),
    state="low DOUBLE, high DOUBLE, last TIMESTAMP_NTZ, flagged BIGINT, flag STRING",
    result="fare_range DOUBLE, last_dropoff TIMESTAMP_NTZ, flagged_trips BIGINT, refunds STRING",
    start=_range_start,
    merge=_range_merge,
    finish=_range_finish,
)
