"""JSON decoding, message-shape detection and routing as Column expressions.

No Python UDFs: key presence comes from ``json_object_keys`` (it lists keys whose
value is null), strictness from one parse that a closing mark has to end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaylake.specs import CHANNELS, DEFAULT_ROUTE

# ---- fixed values (must equal the reference's behaviour) -------------------
# Key checks in order: event_type value; price_changes; last_trade_price;
# bids or asks -> book; type value; else unknown.
UNKNOWN_TYPE = "unknown"
# Page envelopes: first present key wins.
ENVELOPE_KEYS = ["data", "results", "items"]
# RTDS: this channel value goes to crypto prices, everything else to activity.
CRYPTO_CHANNEL = "crypto_prices"
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def stripped(raw: Column | str) -> Column:
    """Leading/trailing whitespace removed (spaces, tabs, CR, LF, FF, VT)."""
    return F.regexp_replace(_c(raw), r"^\s+|\s+$", "")


def from_first(raw: Column | str) -> Column:
    """The text from its first character that ``stripped`` keeps; no pattern runs over the rest."""
    return F.ltrim(_c(raw), F.lit(" \t\n\x0b\f\r"))


def json_shape(raw: Column | str, trimmed: Column | None = None) -> Column:
    """'object' | 'array' | 'scalar' | 'empty' from the first non-space character."""
    first = F.substring(from_first(raw) if trimmed is None else trimmed, 1, 1)
    return (F.when(first == "{", "object").when(first == "[", "array")
            .when(first == "", "empty").otherwise("scalar"))


# closes the one-element list that a text is parsed in; no feed sends it
END_MARK = "\u241e end of text"


def parse_one(raw: Column | str) -> Column:
    """The text as a VARIANT when it is exactly one JSON value, else null.

    The parser stops at the end of the first value, so the text is parsed as the
    first element of a list that a mark has to close: trailing text, a second
    value or an unclosed one leave the mark out of its place.
    """
    return _first_of_list(_wrapped(raw))


def parse_once(raw: Column | str) -> Column:
    """``parse_one`` for a filter, or a column that one may be pushed through: the parsed list is a
    lambda's variable, so the text is parsed once there too."""
    return F.transform(F.array(_wrapped(raw)), _first_of_list)[0]


def _wrapped(raw: Column | str) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), _c(raw), F.lit(f',"{END_MARK}"]')))


def _first_of_list(wrapped: Column) -> Column:
    whole = (F.try_variant_get(wrapped, "$[1]", "string") == END_MARK) & \
        F.variant_get(wrapped, "$[2]", "variant").isNull()
    return F.when(whole, F.variant_get(wrapped, "$[0]", "variant"))


def strict_json(raw: Column | str, parsed: Column | None = None) -> Column:
    """True when ``raw`` is one complete JSON value.

    Pass ``parsed`` (= ``parse_one(raw)`` from an earlier projection) to avoid a re-parse.
    """
    return (parse_once(raw) if parsed is None else parsed).isNotNull()


def object_keys(raw: Column | str) -> Column:
    """Top-level keys of a JSON object (null-valued keys included); [] otherwise."""
    return F.coalesce(F.json_object_keys(_c(raw)), F.array().cast("array<string>"))


def has_key(raw: Column | str, key: str) -> Column:
    return F.array_contains(object_keys(raw), key)


def key_text(raw: Column | str, key: str) -> Column:
    """Value of a top-level key as text (strings unquoted, others as JSON; JSON
    null -> null). Read from the parsed value, so a repeated key gives its last
    value, as a dict-based decoder does."""
    return F.variant_get(F.try_parse_json(_c(raw)), f"$['{key}']", "string")


def has_field(parsed: Column, key: str) -> Column:
    """True when a parsed object has the key, also with a JSON null; false for anything else."""
    return F.try_variant_get(parsed, f"$['{key}']", "variant").isNotNull()


def field_text(parsed: Column, key: str) -> Column:
    """``key_text`` of a value that is parsed already."""
    return F.try_variant_get(parsed, f"$['{key}']", "string")


def array_entries(raw: Column | str) -> Column:
    """JSON array -> array of (text, v): each element as sent and parsed (null when not an array).

    Objects and lists keep the very text they were sent in, so long numbers are
    not rewritten; scalars are written anew (a string needs its quotes).
    """
    return F.zip_with(F.from_json(_c(raw), "array<string>"), F.from_json(_c(raw), "array<variant>"),
                      lambda text, v: F.struct(F.when(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), text)
                                               .otherwise(F.to_json(v)).alias("text"), v.alias("v")))


def array_elements(raw: Column | str) -> Column:
    """JSON array -> array of element JSON texts (null when not an array)."""
    return F.transform(array_entries(raw), lambda e: e["text"])


def detect_event_type(raw: Column | str, parsed: Column | None = None) -> Column:
    """Message type by key presence; pass ``parsed`` (the message as a VARIANT from an
    earlier projection) so the text is not parsed again."""
    v = F.try_parse_json(_c(raw)) if parsed is None else parsed

    def has(name):
        return has_field(v, name)
    return (F.when(has("event_type"), field_text(v, "event_type"))
            .when(has("price_changes"), F.lit("price_change"))
            .when(has("last_trade_price"), F.lit("last_trade_price"))
            .when(has("bids") | has("asks"), F.lit("book"))
            .when(has("type"), field_text(v, "type"))
            .otherwise(F.lit(UNKNOWN_TYPE)))


def route_event(event_type: Column | str, channel: str = "ws_market") -> Column:
    routes = F.create_map(*[F.lit(x) for kv in CHANNELS[channel].event_routes.items() for x in kv])
    return F.coalesce(F.try_element_at(routes, _c(event_type)), F.lit(DEFAULT_ROUTE))


def route_channel(raw: Column | str, parsed: Column | None = None) -> Column:
    """RTDS split: 'crypto_prices' or 'activity' (missing channel -> activity)."""
    value = key_text(raw, "channel") if parsed is None else field_text(parsed, "channel")
    return F.when(value.eqNullSafe(F.lit(CRYPTO_CHANNEL)),
                  F.lit("crypto_prices")).otherwise(F.lit("activity"))


def is_control_frame(channel: Column | str, raw: Column | str) -> Column:
    """True for the text control frames of the channel; false for a frame without text."""
    s = stripped(raw)
    cond = F.lit(False)
    for spec in CHANNELS.values():
        if spec.control:
            cond = cond | ((_c(channel) == spec.name) & s.isin(*spec.control))
    return F.coalesce(cond, F.lit(False))


def parse_id_list(text: Column | str) -> Column:
    """A JSON list held in a string -> its elements; bad JSON or non-list -> [].

    Elements keep their JSON text for numbers; strings are unquoted.
    """
    t = _c(text)
    elems = F.from_json(t, "array<string>")
    ok = strict_json(t) & (json_shape(t) == "array")
    return F.when(ok, F.coalesce(elems, F.array().cast("array<string>"))) \
        .otherwise(F.array().cast("array<string>"))


def id_list(value: Column) -> Column:
    """Ids of a VARIANT field that is a list or a string holding a list; anything else -> []."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "STRING", parse_id_list(F.try_variant_get(value, "$", "string")))
            .when(kind.startswith("ARRAY"), F.from_json(F.to_json(value), "array<string>"))
            .otherwise(F.array().cast("array<string>")))


def preview(raw: Column | str, n: int = 200) -> Column:
    return F.substring(_c(raw), 1, n)
