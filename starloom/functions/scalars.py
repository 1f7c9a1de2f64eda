"""Scalar column functions shared by curation, loads and telemetry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

END_OF_TIME = datetime(9999, 12, 31)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_timestamp(c) -> Column:
    return F.timestamp_millis(_col(c))


def millis_to_seconds_timestamp(c) -> Column:
    """Epoch milliseconds as a timestamp cut to whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(_col(c)))


def timestamp_to_millis(c) -> Column:
    return F.unix_millis(_col(c).cast("timestamp"))


def date_key(c) -> Column:
    """yyyymmdd of epoch milliseconds, in UTC; a null instant counts as 0."""
    day = F.timestamp_millis(F.coalesce(_col(c), F.lit(0).cast("long")))
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_key_to_date(c) -> Column:
    key = _col(c)
    return F.make_date((key / 10000).cast("int"), ((key / 100).cast("int") % 100).cast("int"), (key % 100).cast("int"))


def money(c, scale: int = 2) -> Column:
    """Decimal text as DECIMAL(18, scale); empty, blank or unreadable text counts as 0."""
    typed = f"decimal(18,{scale})"
    return F.coalesce(_col(c).try_cast(typed), F.lit(0).cast(typed))


def text(c) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def flag(c) -> Column:
    """Boolean as 0 or 1."""
    return F.coalesce(_col(c).cast("int"), F.lit(0))


def line_total(quantity, unit_price, discount) -> Column:
    """quantity * unit price - discount, half-even to cents."""
    return F.bround(_col(quantity) * _col(unit_price) - _col(discount), 2).cast("decimal(18,2)")


def lag_seconds(observed_at, source_ts_ms) -> Column:
    """Seconds between the source commit and the observation; null when the commit time is unknown."""
    source = _col(source_ts_ms)
    return F.when(source > 0, (timestamp_to_millis(observed_at) - source) / F.lit(1000.0))


def run_uuid(c) -> Column:
    """A 32-digit hex id in dashed UUID form; anything else unchanged."""
    value = _col(c)
    bare = r"^([0-9a-fA-F]{8})([0-9a-fA-F]{4})([0-9a-fA-F]{4})([0-9a-fA-F]{4})([0-9a-fA-F]{12})$"
    return F.when(value.rlike(bare), F.lower(F.regexp_replace(value, bare, "$1-$2-$3-$4-$5"))).otherwise(value)


def entity_of_topic(c, curated_prefix: str) -> Column:
    """The entity name inside a curated topic; other topics unchanged."""
    topic = _col(c)
    inner = F.replace(F.substr(topic, F.lit(len(curated_prefix) + 1)), F.lit(".changed.v1"), F.lit(""))
    return F.when(topic.startswith(curated_prefix), inner).otherwise(topic)


def operation_name(c) -> Column:
    """Envelope operation codes; an unknown code stays, a missing one becomes "?"."""
    code = _col(c)
    return (F.when(code == "r", "snapshot").when(code == "c", "insert").when(code == "u", "update")
            .when(code == "d", "delete").otherwise(F.coalesce(code, F.lit("?"))))


def change_table_operation(c) -> Column:
    """Numeric operation codes of a database change table."""
    code = _col(c)
    return (F.when(code == 1, "delete").when(code == 2, "insert").when(code == 3, "update(before)")
            .when(code == 4, "update(after)").otherwise("unknown"))


def operation_letter(c) -> Column:
    """I, U or D for a curated operation name."""
    name = _col(c)
    return F.when(name.isin("insert", "snapshot"), "I").when(name == "update", "U").when(name == "delete", "D")


def calendar_columns(day) -> dict[str, Column]:
    """Calendar parts of a date; weeks and weekdays are ISO (Monday = 1)."""
    d = _col(day)
    weekday = F.weekday(d) + 1
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": weekday.cast("int"),
        "is_weekend": (weekday >= 6).cast("int"),
        "iso_week": F.weekofyear(d),
    }
