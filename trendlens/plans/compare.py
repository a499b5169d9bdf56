"""Order-insensitive comparison of two pandas frames (used by tests and the oracle check)."""

from __future__ import annotations

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, repr(type(x)), x if x is not None else 0) for x in r))


def compare_frames(got: pd.DataFrame, want: pd.DataFrame) -> tuple[bool, str]:
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    a, b = _rows(got), _rows(want)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first difference: {x} != {y}"
    return True, ""
