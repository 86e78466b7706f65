"""Landed provider responses (JSON text, one page per row) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelot.functions.flights import scheduled_local
from tidelot.functions.passengers import (
    TOTAL_FIELDS, forecast_hour, is_one_hour, is_summary_row, reading_time, whole_count,
)
from tidelot.functions.time import kst_date

# Fixed value: the flight and holiday provider's limit on the pages of a request.
CONTEXT_PAGES = 50


def _field(variant: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(variant, path, kind)


def envelope(pages: DataFrame) -> DataFrame:
    """Add ``result_code``, ``total_count`` and the page's ``items`` array.

    The body may sit under ``response``; items may be a list, an object holding a
    list or one object under ``item``, one bare object, or an empty string.
    """
    whole = F.try_parse_json("payload")
    data = F.coalesce(_field(F.col("_v"), "$.response", "variant"), F.col("_v"))
    items = _field(F.col("_d"), "$.body.items", "variant")
    inner = _field(F.col("_i"), "$.item", "variant")

    def is_kind(variant: Column, kind: str) -> Column:
        return F.schema_of_variant(variant).startswith(kind)

    def listed(variant: Column) -> Column:
        return F.when(is_kind(variant, "ARRAY"), variant.cast("array<variant>")).when(
            is_kind(variant, "OBJECT"), F.array(variant)
        )

    empty = F.array().cast("array<variant>")
    return (
        pages.withColumn("_v", whole).withColumn("_d", data).withColumn("_i", items)
        .withColumn("_n", F.coalesce(F.when(is_kind(F.col("_i"), "OBJECT"), inner), F.col("_i")))
        .select(
            *pages.columns,
            _field(F.col("_d"), "$.header.resultCode").alias("result_code"),
            _field(F.col("_d"), "$.body.totalCount").try_cast("int").alias("total_count"),
            F.coalesce(listed(F.col("_n")), empty).alias("items"),
        )
    )


def page_violations(pages: DataFrame, *, allow_empty: bool, most_pages: int | None = None) -> DataFrame:
    """Requests whose pages failed, changed their total, or do not add up to it.

    ``pages`` is the output of ``envelope`` with ``request_id`` and ``page``.
    ``most_pages`` is the provider's limit on the pages of a request, where it has
    one (``CONTEXT_PAGES`` for flights and holidays).
    """
    per_request = pages.groupBy("request_id").agg(
        F.count_if(~F.coalesce(F.col("result_code") == "00", F.lit(False))).alias("failed"),
        F.count_if(F.col("total_count").isNull() | (F.col("total_count") < 0)).alias("no_total"),
        F.min("total_count").alias("least"), F.max("total_count").alias("most"),
        F.sum(F.size("items")).alias("items"), F.count("*").alias("pages"),
    )
    rules = {
        "request failed": F.col("failed") > 0,
        "total count missing": F.col("no_total") > 0,
        "total count changed between pages": F.col("least") != F.col("most"),
        "items differ from the total count": F.col("items") != F.col("most"),
    }
    if most_pages is not None:
        rules["too many pages"] = F.col("pages") > most_pages
    if not allow_empty:
        rules["no items"] = F.col("items") == 0
    hits = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return (
        per_request.select(F.explode(hits).alias("rule"), F.col("request_id").cast("string").alias("key"))
        .groupBy("rule").agg(F.count("*").alias("n"), F.min("key").alias("key"))
    )


def explode_items(pages: DataFrame) -> DataFrame:
    """One row per item, with its position inside the page."""
    keep = [c for c in pages.columns if c != "items"]
    return pages.select(*keep, F.posexplode("items").alias("pos", "item"))


def parse_parking_payload(pages: DataFrame) -> DataFrame:
    """Raw parking items of landed pages; fields stay text until normalised."""
    fields = ("floor", "parking", "parkingarea", "datetm")
    items = explode_items(envelope(pages))
    return items.select("request_id", "page", "pos", *[_field(F.col("item"), f"$.{f}").alias(f) for f in fields])


def normalize_parking(items: DataFrame) -> DataFrame:
    """Typed readings; ``is_valid`` is false where a field is unusable.

    Occupancy above capacity is kept as it is.
    """
    typed = items.select(
        "*",
        F.trim("floor").alias("lot_name"),
        F.trim("parking").try_cast("int").alias("occupied_spaces"),
        F.trim("parkingarea").try_cast("int").alias("total_spaces"),
        reading_time(F.col("datetm")).alias("observed_at"),
    ).drop("floor", "parking", "parkingarea", "datetm")
    valid = (
        (F.col("lot_name") != "") & (F.col("occupied_spaces") >= 0) & (F.col("total_spaces") >= 0)
        & F.col("observed_at").isNotNull()
    )
    return typed.withColumn("is_valid", F.coalesce(valid, F.lit(False)))


def parse_passenger_payload(pages: DataFrame) -> DataFrame:
    """Raw forecast items of landed responses."""
    fields = ("adate", "atime", *TOTAL_FIELDS.values())
    items = explode_items(envelope(pages))
    keep = [c for c in ("request_id", "fetched_at", "day_offset") if c in items.columns]
    return items.select(*keep, "pos", *[_field(F.col("item"), f"$.{f}").alias(f) for f in fields])


def passenger_date_violations(items: DataFrame) -> DataFrame:
    """Items dated other than the requested local day."""
    expected = F.date_format(F.date_add(kst_date(F.col("fetched_at")), F.col("day_offset")), "yyyyMMdd")
    wrong = items.where(F.col("adate").rlike(r"^\d+$") & (F.col("adate") != expected))
    return (
        wrong.agg(F.count("*").alias("n"), F.min(F.col("request_id").cast("string")).alias("key")).where("n > 0")
        .select(F.lit("response is dated differently from its request").alias("rule"), "n", "key")
    )


def normalize_passenger(items: DataFrame) -> DataFrame:
    """Four terminal and direction totals per hourly item, the daily total dropped.

    ``is_valid`` is false where the hour or the count is unusable.
    """
    hourly = items.where(~is_summary_row(F.col("adate"), F.col("atime")))
    totals = F.array(*[
        F.struct(F.lit(t).alias("terminal"), F.lit(d).alias("direction"), whole_count(F.col(f)).alias("value"))
        for (t, d), f in TOTAL_FIELDS.items()
    ])
    keep = [c for c in items.columns if c not in ("adate", "atime", *TOTAL_FIELDS.values())]
    rows = hourly.select(
        *keep, forecast_hour(F.col("adate"), F.col("atime")).alias("target_hour"),
        is_one_hour(F.col("atime")).alias("_one_hour"), F.explode(totals).alias("_t"),
    )
    valid = F.col("_one_hour") & F.col("target_hour").isNotNull() & F.col("_t.value").isNotNull()
    return rows.select(
        *keep, "target_hour", "_t.terminal", "_t.direction", F.col("_t.value").alias("expected_passengers"),
        valid.alias("is_valid"),
    )


def _rule_counts(groups: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """``broken`` maps a rule to how many identities of a row of ``groups`` break it."""
    hits = F.array(*[F.struct(F.lit(name).alias("rule"), n.alias("n")) for name, n in broken.items()])
    return (
        groups.select(F.explode(hits).alias("h"), F.col("snapshot_id").cast("string").alias("key")).where("h.n > 0")
        .groupBy("h.rule").agg(F.sum("h.n").alias("n"), F.min("key").alias("key"))
    )


def flight_snapshot_violations(flights: DataFrame, headers: DataFrame) -> DataFrame:
    """Flight records unfit for storing: no or repeated identity, wrong or bad time.

    Records are counted by identity, then by snapshot and day, before a header is looked up: dealt by snapshot alone, all
    records of one would be one task's.
    """
    local = F.to_date(scheduled_local(F.col("scheduled_text")))
    per_identity = flights.groupBy("snapshot_id", "fid", "flight_id").agg(
        F.count("*").alias("copies"), F.min(local).alias("first"), F.max(local).alias("last"),
        F.bool_or(local.isNull()).alias("undated"),
    )
    per_day = per_identity.groupBy("snapshot_id", "first", "last", "undated").agg(
        F.count("*").alias("identities"), F.count_if(F.col("copies") > 1).alias("repeated"),
        F.count_if(F.coalesce(F.col("fid"), F.lit("")) == "").alias("unnamed"),
    )
    # A header listed twice repeats its records, and each of its days is asked for.
    days = headers.groupBy(F.col("id").alias("snapshot_id")).agg(
        F.count("*").alias("listed"), F.min("target_date").alias("from_date"), F.max("target_date").alias("to_date"),
        F.bool_or(F.col("target_date").isNull()).alias("dateless"),
    )
    dated = ~F.col("undated") & ~F.col("dateless") & (F.col("first") == F.col("from_date")) & (
        F.col("last") == F.col("from_date")) & (F.col("from_date") == F.col("to_date"))
    return _rule_counts(per_day.join(days, "snapshot_id"), {
        "flight has no identity": F.col("unnamed"),
        "flight listed twice": F.when(F.col("listed") > 1, F.col("identities")).otherwise(F.col("repeated")),
        "scheduled on another day than its snapshot":
            F.when(F.coalesce(dated, F.lit(False)), F.lit(0)).otherwise(F.col("identities")),
    })


def holiday_snapshot_violations(holidays: DataFrame, headers: DataFrame) -> DataFrame:
    """Holiday records outside their month, with a bad flag, or repeated; counted as flights are."""
    per_identity = holidays.groupBy("snapshot_id", "locdate", "seq", "date_name").agg(
        F.count("*").alias("copies"),
        F.count_if(~F.coalesce(F.col("is_holiday").isin("Y", "N"), F.lit(False))).alias("unflagged"),
    )
    per_day = per_identity.groupBy("snapshot_id", "locdate").agg(
        F.count("*").alias("identities"), F.count_if(F.col("copies") > 1).alias("repeated"),
        F.count_if(F.col("unflagged") > 0).alias("unflagged"),
    )
    months = headers.groupBy(F.col("id").alias("snapshot_id"), "year", "month").agg(F.count("*").alias("listed"))
    in_month = (F.year("locdate") == F.col("year")) & (F.month("locdate") == F.col("month"))
    return _rule_counts(per_day.join(months, "snapshot_id"), {
        "holiday outside its month": F.when(F.coalesce(in_month, F.lit(False)), F.lit(0)).otherwise(F.col("identities")),
        "holiday without a Y or N flag": F.col("unflagged"),
        "repeated holiday": F.when(F.col("listed") > 1, F.col("identities")).otherwise(F.col("repeated")),
    })
