"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: modelled price of one GiB processed.
COST_PER_GIB = 0.023

ISO_TIME = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.]\d{1,9})?)?(?:Z|[+-]\d{2}:\d{2})?)?$"


def with_event_ts(events: DataFrame, ts: str = "ts", out: str = "event_ts") -> DataFrame:
    """Add the event time. Text that is no ISO date or time with a date becomes null, not an error."""
    if out in events.columns:
        return events
    if isinstance(events.schema[ts].dataType, T.StringType):
        # A cast alone would read a bare time as one of today.
        return events.withColumn(out, F.when(F.col(ts).rlike(ISO_TIME), F.col(ts).try_cast("timestamp")))
    return events.withColumn(out, F.col(ts))


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def any_null(columns) -> Column:
    """True when at least one of the columns is null."""
    flag = F.lit(False)
    for c in columns:
        flag = flag | F.col(c).isNull()
    return flag


def pair_key(left: Column, right: Column) -> Column:
    """`left#right`, the key form of the cost and alert ledgers."""
    return F.concat(left.cast("string"), F.lit("#"), right.cast("string"))


def cost_usd(n_bytes: Column, rate: float = COST_PER_GIB) -> Column:
    return F.round(n_bytes / F.lit(float(1 << 30)) * F.lit(rate), 6)


def whole_seconds(start: Column, end: Column) -> Column:
    """Difference of the two times after each is cut to its whole second."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
