"""Typed projections: decimals-as-strings, four timestamp forms, zipped arrays,
comma lists, key tagging (P10, P11, P17-P20, P22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,18)"
# Fixed timestamp patterns seen in the feeds: ISO-8601 with 3 or 6 fraction digits
# and a zone, and "2023-12-07 19:16:45.979+00" (short zone).
ISO_PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X",
                "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]X"]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_decimal(col: Column | str, dtype: str = MONEY) -> Column:
    """Decimal text -> DECIMAL(38,18); unparseable -> null."""
    return _c(col).cast("string").try_cast(dtype)


def to_long(col: Column | str) -> Column:
    return _c(col).cast("string").try_cast("bigint")


def parse_time(col: Column | str) -> Column:
    """ISO-8601 (3/6 fraction digits) or short-zone text -> TIMESTAMP; else null."""
    s = _c(col).cast("string")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in ISO_PATTERNS])


def epoch_millis_text(col: Column | str) -> Column:
    """Epoch milliseconds held as text -> TIMESTAMP."""
    return F.timestamp_millis(to_long(col))


def epoch_seconds_int(col: Column | str) -> Column:
    return F.timestamp_seconds(to_long(col))


def normalise_times(df: DataFrame, stream: str) -> DataFrame:
    """Time fields of a stream's table as TIMESTAMP, each read in the form its stream sends.

    Text that is no time becomes null; a table without one of the fields keeps its columns.
    """
    from quaylake.specs import spec_for
    forms = {"iso": parse_time, "millis": epoch_millis_text, "seconds": epoch_seconds_int}
    times = {c: forms[form](c) for c, form in spec_for(stream).times.items() if c in df.columns}
    return df.withColumns(times) if times else df


def split_csv(col: Column | str) -> Column:
    """'1, 2,3' -> ['1','2','3'] (empty items dropped)."""
    parts = F.transform(F.split(_c(col), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def zip_outcomes(outcomes: Column | str, prices: Column | str, tokens: Column | str) -> Column:
    """Three JSON-list strings aligned by position -> array<struct>."""
    def arr(c):
        return F.from_json(_c(c), "array<string>")
    return F.arrays_zip(arr(outcomes).alias("outcome"), arr(prices).alias("price"),
                        arr(tokens).alias("token_id"))
