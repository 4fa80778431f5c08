"""Log line renderings as string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(col) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def rfc3164_line(time_text: Column) -> Column:
    """``<fac*8+sev>time host prog[pid]: msg``"""
    pri = (F.col("facility") * 8 + F.col("severity")).cast("string")
    return F.concat(
        F.lit("<"), pri, F.lit(">"), time_text, F.lit(" "), _text("hostname"), F.lit(" "),
        _text("program"), F.lit("["), _text("pid"), F.lit("]: "), _text("message"),
    )


def rfc5424_line(time_text: Column) -> Column:
    """``<pri>1 time host prog pid - - msg``"""
    pri = (F.col("facility") * 8 + F.col("severity")).cast("string")
    return F.concat(
        F.lit("<"), pri, F.lit(">1 "), time_text, F.lit(" "), _text("hostname"), F.lit(" "),
        _text("program"), F.lit(" "), _text("pid"), F.lit(" - - "), _text("message"),
    )


def normalized_line() -> Column:
    """RFC 5424 shape with a meta block for device, category and risk."""
    return F.concat(
        F.lit("<"), _text("priority"), F.lit(">1 "), _text("normalized_time"), F.lit(" "),
        _text("hostname"), F.lit(" "), _text("program"), F.lit(" "), _text("pid"),
        F.lit(' - [meta device_type="'), _text("device_type"),
        F.lit('" event_category="'), _text("event_category"),
        F.lit('" risk_score="'), _text("risk_score"), F.lit('"] '), _text("message"),
    )
