"""Order-insensitive comparison of two result frames."""

import math

import pandas as pd


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    return v if isinstance(v, (int, str, bool)) else str(v)


def rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
