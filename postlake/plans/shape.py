"""Results as JSON."""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import math
from typing import Any

from pyspark.sql import DataFrame, Row


def value(v: Any) -> Any:
    """A value as JSON: numbers as numbers (integers beyond 64 bits as text), times as YYYY-MM-DD HH:MM:SS,
    bytes by their length, nested values as nested JSON, NaN and infinities as text."""
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, int):
        return v if -(2**63) <= v < 2**63 else str(v)
    if isinstance(v, float):
        return v if math.isfinite(v) else str(v)
    if isinstance(v, decimal.Decimal):
        whole = v == v.to_integral_value()
        return value(int(v)) if whole and v.as_tuple().exponent >= 0 else str(v)
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, (dt.date, dt.time, dt.timedelta)):
        return str(v)
    if isinstance(v, (bytes, bytearray)):
        return f"<{len(v)} bytes>"
    if isinstance(v, Row):
        return {k: value(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {str(k): value(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [value(x) for x in v]
    return str(v)


def reply(df: DataFrame, limit: int) -> dict[str, Any]:
    """columns, row_count, truncated and rows; one row more than the limit is fetched to know whether there is more."""
    got = df.limit(limit + 1).collect()
    rows = [{c: value(v) for c, v in zip(df.columns, r)} for r in got[:limit]]
    return {"columns": df.columns, "row_count": len(rows), "truncated": len(got) > limit, "rows": rows}


def payload(data: bytes, most: int) -> dict[str, Any]:
    """total_bytes, returned_bytes, truncated and either text (UTF-8 without NUL) or base64."""
    part = data[:most]
    out: dict[str, Any] = {"total_bytes": len(data), "returned_bytes": len(part), "truncated": len(data) > most}
    try:
        text = part.decode("utf-8")
        if "\0" in text:
            raise UnicodeDecodeError("utf-8", b"\0", 0, 1, "NUL")
        out["text"] = text
    except UnicodeDecodeError:
        out["base64"] = base64.b64encode(part).decode("ascii")
    return out
