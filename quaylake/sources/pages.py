"""Landed API response pages.

``pages(crawl_id, page_no, body)``: one row per fetched page. Unwrapping works on
page rows; where a paginated crawl ended is a per-crawl *aggregate* joined back,
so a crawl holding a third of all pages is pre-aggregated map-side instead of
being sorted in one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.functions import jsonfn as J


def page_items(pages: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``items`` (array of item JSON texts, or null for a scalar/invalid
    body, which ends the crawl) and ``n_items``.

    Shapes: a list is the items; an object takes the first present key of
    data/results/items — a list value is the items, any other value (null
    included) makes the whole object one item; no envelope key -> no items.
    """
    b = F.col(body)
    v = F.try_parse_json(b)
    shape = J.json_shape(b)
    ok = J.strict_json(b)
    env = None
    for k in J.ENVELOPE_KEYS:
        sub = F.to_json(F.variant_get(v, f"$.{k}", "variant"))
        sub_items = F.when(F.schema_of_variant(F.variant_get(v, f"$.{k}", "variant")).startswith("ARRAY"),
                           J.array_elements(sub)).otherwise(F.array(b))
        env = F.when(J.has_key(b, k), sub_items) if env is None else env.when(J.has_key(b, k), sub_items)
    env = env.otherwise(F.array().cast("array<string>"))
    items = (F.when(~ok, F.lit(None).cast("array<string>"))
             .when(shape == "array", J.array_elements(b))
             .when(shape == "object", env))
    return pages.withColumn("items", items).withColumn("n_items", F.size("items")) \
        .withColumn("n_items", F.when(F.col("items").isNull(), F.lit(None)).otherwise(F.col("n_items")))


def unwrap_pages(pages: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """One row per item with its page position."""
    return page_items(pages, body).select(*keep, F.posexplode("items").alias("item_no", "item"))


def rejected_pages(pages: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """Pages that give no item although they hold something, with the reason and the whole body."""
    b = F.col(body)
    shape = J.json_shape(b)
    reason = (F.when(~J.strict_json(b), "bad_json").when(~shape.isin("array", "object"), "not_a_page")
              .when((shape == "object") & ~F.arrays_overlap(J.object_keys(b), F.array(*[F.lit(k) for k in J.ENVELOPE_KEYS])),
                    "no_envelope_key"))
    return pages.select(*keep, reason.alias("reason"), b.alias("raw")).where(F.col("reason").isNotNull())


def crawl_items(pages: DataFrame, crawl: str = "crawl_id", page_no: str = "page_no", body: str = "body",
                limit: int = 100) -> DataFrame:
    """Items of every landed page, with how far their crawl had come.

    A crawl ends with its first page of fewer than ``limit`` items or without a
    list or object. No page is left out: ``after_end`` marks pages behind that
    one (landed by a later, longer crawl of the same id) and ``truncated`` crawls
    that never came to an end.
    """
    p = page_items(pages, body)
    stop_at = F.when(F.col("items").isNull() | (F.col("n_items") < limit), F.col(page_no))
    stops = p.groupBy(crawl).agg(F.min(stop_at).alias("_stop"))
    return (p.where(F.col("items").isNotNull()).join(stops, crawl)
            .select(crawl, page_no, F.coalesce(F.col(page_no) > F.col("_stop"), F.lit(False)).alias("after_end"),
                    F.col("_stop").isNull().alias("truncated"), F.posexplode("items").alias("item_no", "item")))


def resumable_ingest(items: DataFrame, cursor: int, offset_col: str = "item_offset",
                     limit: int | None = None, page_size: int = 100) -> DataFrame:
    """Items from ``cursor`` on, at most ``limit`` of them, with their page.

    Each item keeps its global ``item_offset``, so reruns and resumed runs are
    idempotent (a rerun selects the same offsets). The position inside the run
    comes from a distributed global index, taken over the ``limit`` first items
    only when there is a limit; the page is ``position // page_size``.
    """
    from quaylake.operators.discovery import global_index
    rest = items.where(F.col(offset_col) >= F.lit(cursor))
    if limit is not None:
        rest = rest.orderBy(offset_col).limit(limit)
    df = global_index(rest, [offset_col], col="_run_pos")
    return df.withColumn("page", F.floor(F.col("_run_pos") / F.lit(page_size)).cast("bigint")).drop("_run_pos")


def next_cursor(done: DataFrame, cursor: int, offset_col: str = "item_offset") -> DataFrame:
    """Cursor after a run = max offset + 1 (or the old cursor when nothing ran)."""
    return done.agg(F.coalesce(F.max(offset_col) + 1, F.lit(cursor)).alias("cursor"))


def ingest_run(spark, state_root: str, items: DataFrame, name: str = "backfill", offset_col: str = "item_offset",
               limit: int | None = None, page_size: int = 100, reset: bool = False) -> DataFrame:
    """One run of a resumable ingest whose cursor lives in the saved state.

    Starts at the saved cursor (0 with ``reset`` or without one); a completed
    ingest gives nothing until it is reset. The run is written to the shared
    folder, then its cursor is saved, ``completed`` when nothing lies beyond it.
    """
    from quaylake.operators import state as ST
    from quaylake.session import write_shared
    cursors = ST.load_state(spark, state_root)["cursor"]
    saved = None if reset else cursors.where(F.col("name") == name).first()
    if saved is not None and saved["completed"]:
        return resumable_ingest(items.limit(0), 0, offset_col, None, page_size)
    cursor = saved["item_offset"] if saved is not None else 0
    run = write_shared(resumable_ingest(items, cursor, offset_col, limit, page_size), f"ingest-{name}")
    reached = next_cursor(run, cursor, offset_col).first()["cursor"]
    completed = items.where(F.col(offset_col) >= reached).isEmpty()
    mine = spark.createDataFrame([(name, reached, completed)], ST.CURSOR_SCHEMA)
    ST.save_state(spark, state_root, {"cursor": cursors.where(F.col("name") != name).unionByName(mine)})
    return run


def reference_items(responses: DataFrame, kind: str, keep: list[str], body: str = "body") -> DataFrame:
    """Reference lists (S12) from landed responses of one kind.

    tags: a list gives its items, a non-empty object is one record;
    series and sports: only a list gives items (anything else: none);
    series items lose their nested ``events`` field before landing (P9).
    """
    b = F.col(body)
    ok = J.strict_json(b)
    shape = J.json_shape(b)
    items = F.when(ok & (shape == "array"), J.array_elements(b))
    if kind == "tags":
        non_empty_obj = ok & (shape == "object") & (F.size(J.object_keys(b)) > 0)
        items = items.when(non_empty_obj, F.array(b))
    items = items.otherwise(F.array().cast("array<string>"))
    out = responses.select(*keep, F.posexplode(items).alias("item_no", "item"))
    if kind == "series":
        stripped = F.to_json(F.map_filter(F.from_json("item", "map<string,variant>"), lambda k, v: k != "events"))
        out = out.withColumn("item", F.when(J.json_shape("item") == "object", stripped).otherwise(F.col("item")))
    return out
