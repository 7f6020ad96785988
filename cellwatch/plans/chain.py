"""The hourly -> session -> daily -> labelled chain as one lazy plan.

Input is T3 hourly readings: the fleet extract (E1) directly, or its CSV
hand-over read by ``sources.csv``. One exchange, on (bloqs_id, battery_name),
serves every window and the daily rollup (see ``operators.sessions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import clean as CL
from ..operators import features as FE
from ..operators import labels as LB
from ..operators import sessions as SE


def sessions(hourly: DataFrame, censor_tolerance: str | None = None, keyed_only: bool = False,
             data_end=None) -> DataFrame:
    """C1 -> C2: T5 battery sessions. ``data_end``: the newest cleaned time, where it is known."""
    kw = {"censor_tolerance": censor_tolerance} if censor_tolerance else {}
    return SE.add_sessions(CL.clean(hourly), keyed_only=keyed_only, data_end=data_end, **kw)


def daily_features(hourly: DataFrame, data_end=None) -> DataFrame:
    """C1 -> C2 -> C3: T6 daily features (of rows whose battery is known)."""
    return FE.build_features(sessions(hourly, keyed_only=True, data_end=data_end))


def labelled(hourly: DataFrame, lookahead: bool = False, data_end=None) -> DataFrame:
    """C1 -> C4: T7 labelled daily features."""
    return LB.add_label(daily_features(hourly, data_end), lookahead=lookahead)
