"""Row predicates (F1, F2, F7, F10) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_open(active: Column | str, closed: Column | str) -> Column:
    """Truthy ``active`` and falsy ``closed``; a null/absent ``closed`` counts as open."""
    return truthy(active) & ~truthy(closed)


def has_id(id_col: Column | str) -> Column:
    """Drop null and empty ids."""
    c = _c(id_col).cast("string")
    return c.isNotNull() & (c != "")


def fetched_after(fetched_at: Column | str, ts_seconds: float,
                  dt_col: str | None = "dt") -> Column:
    """``_fetched_at > ts``; with a ``dt`` column also a date predicate so partitions prune."""
    import datetime as _dt
    cond = _c(fetched_at) > F.lit(float(ts_seconds))
    if dt_col:
        day = _dt.datetime.fromtimestamp(ts_seconds, _dt.timezone.utc).strftime("%Y-%m-%d")
        cond = (F.col(dt_col) >= F.lit(day)) & cond
    return cond


def truthy(col: Column | str) -> Column:
    """False for null, false, zero and the empty text; everything else is true."""
    text = _c(col).cast("string")
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return F.coalesce((text != "") & (text != "false") & ~zero, F.lit(False))


def truthy_json(value: Column | str) -> Column:
    """The same for a VARIANT: empty lists and objects are false, and a text is true unless empty."""
    v = _c(value)
    kind, text = F.schema_of_variant(v), F.to_json(v)
    plain = truthy(F.try_variant_get(v, "$", "string"))
    return F.coalesce(F.when(kind == "STRING", text != '""')
                      .when(kind.rlike("^(OBJECT|ARRAY)"), ~text.isin("[]", "{}"))
                      .when(kind == "VOID", F.lit(False)).otherwise(plain), F.lit(False))
