"""From raw JSON text to typed order events, and the checks on what is posted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.jsontext import kind, scalar_text, to_json_result, user_key
from orderpulse.functions.money import price_or_total_price
from orderpulse.functions.times import iso_utc, parse_iso
from orderpulse.schemas import PRICE, RAW_PRICE

# Variant fields keep what a plain string would lose: number or text, missing or null.
_EVENT_FIELDS = ("order_id variant, user_id variant, product_id variant, "
                 "quantity variant, price variant, timestamp string, status string")
_BROKEN = "_broken"


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _parsed(value: Column) -> Column:
    return F.from_json(value, f"{_EVENT_FIELDS}, {_BROKEN} string",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})


def _blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """The JSON text as struct ``event``, next to the raw columns.

    ``malformed`` is true where the text is not a JSON object.
    """
    text = F.col(value)
    return (raw.withColumn("event", _parsed(text))
            .withColumn("malformed", _blank(text) | F.col(f"event.{_BROKEN}").isNotNull()))


def _well_formed(raw: DataFrame, value: str) -> DataFrame:
    """Only the messages that are JSON objects, as ``event``.

    A filter on the parsed struct would be pushed below the projection and parse
    every message a second time; unfolding a list of one or no struct does not.
    """
    text = F.col(value)
    valid = F.filter(F.array(_parsed(text)), lambda event: event[_BROKEN].isNull())
    carried = [c for c in raw.columns if c not in (value, "timestamp")]
    sent = F.col("timestamp") if "timestamp" in raw.columns else F.lit(None).cast("timestamp")
    return raw.filter(~_blank(text)).select(F.explode(valid).alias("event"),
                                            sent.alias("_sent"), *carried)


def order_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Declared order events: a field that does not fit is null, bad JSON is skipped."""
    event = F.col("event")
    parsed = _well_formed(raw, value)
    return parsed.select(
        _text(event["order_id"]).alias("order_id"),
        _text(event["user_id"]).alias("user_id"),
        _text(event["product_id"]).alias("product_id"),
        F.try_variant_get(event["quantity"], "$", "int").alias("quantity"),
        F.try_variant_get(event["price"], "$", PRICE.simpleString()).alias("price"),
        parse_iso(event["timestamp"]).alias("timestamp"),
        event["status"].alias("status"),
        *parsed.columns[2:])


def rejects(raw: DataFrame, value: str = "value", timed: bool = False) -> DataFrame:
    """The messages that are no JSON object, with the reason; goes to a side table.

    With ``timed`` also those without a readable event time, which belong to no
    window of event time.
    """
    event = F.col("event")
    reason = F.when(_blank(F.col(value)) | event[_BROKEN].isNotNull(), "malformed json")
    if timed:
        reason = reason.when(parse_iso(event["timestamp"]).isNull(), "no event time")
    return (raw.withColumn("event", _parsed(F.col(value)))
            .select(*raw.columns, F.explode(F.array_compact(F.array(reason))).alias("reason")))


def parse_user_key(raw: DataFrame, value: str = "value") -> DataFrame:
    """(user_id, 1) per message; whatever fails counts for the user ``'unknown'``."""
    parsed = F.from_json(F.col(value), "user_id variant")
    carried = [c for c in raw.columns if c != value]
    return raw.select(user_key(parsed["user_id"]).alias("user_id"),
                      F.lit(1).alias("count"), *carried)


def cast_with_defaults(raw: DataFrame, value: str = "value", *,
                       missing_user: str | None = None,
                       null_is_bad: bool = False) -> DataFrame:
    """Events as the running processors read them.

    Price 0, quantity 1 and the time of the message stand in for a missing field, and
    also for a null; price and quantity not if ``null_is_bad``. A time that can't be read
    is null, and ``rejects(timed=True)`` has its message. A numeric quantity is cut to whole,
    a text one must be whole. ``price``/``quantity`` are null where unusable;
    ``missing_user`` names the user of a message without one.
    """
    event = F.col("event")

    def field(name: str, cast: str, default: Column) -> Column:
        raw_field = event[name]
        absent = raw_field.isNull()
        if not null_is_bad:
            absent = absent | F.is_variant_null(raw_field)
        return F.when(absent, default).otherwise(F.try_variant_get(raw_field, "$", cast))

    user = _text(event["user_id"])
    if missing_user is not None:
        user = F.coalesce(user, F.lit(missing_user))
    parsed = _well_formed(raw, value)
    return parsed.select(
        user.alias("user_id"),
        field("price", RAW_PRICE.simpleString(), F.lit(0).cast(RAW_PRICE)).alias("price"),
        field("quantity", "int", F.lit(1)).alias("quantity"),
        F.when(event["timestamp"].isNull(), F.coalesce("_sent", F.current_timestamp()))
        .otherwise(parse_iso(event["timestamp"])).alias("timestamp"),
        *parsed.columns[2:])


def build_order_event(orders: DataFrame) -> DataFrame:
    """The event of a stored order: text ids, the stored total as ``price``, UTC time."""
    return orders.select(
        F.col("id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("quantity"),
        F.col("total_price").cast("double").alias("price"),
        iso_utc(F.col("created_at")).alias("timestamp"),
        F.col("status"))


def event_json(events: DataFrame) -> DataFrame:
    """Events as the JSON text that goes on the topic."""
    return events.select(to_json_result(*events.columns).alias("value"))


def _truthy(column: Column, is_text: bool) -> Column:
    empty = (column == "") if is_text else (column == 0)
    return column.isNotNull() & ~F.coalesce(empty, F.lit(True))


def _present(df: DataFrame, name: str) -> Column:
    is_text = df.schema[name].dataType.simpleString() == "string"
    return _truthy(F.col(name), is_text)


def parse_order_posts(raw: DataFrame, value: str = "value") -> DataFrame:
    """Order posts from JSON text, under their position on the topic as ``id``.

    A post that is no JSON object has no user and is refused for that. A field that
    is left out is null here and gets its default later; one that is there but is
    no number sets ``bad_number``.
    """
    post = F.from_json(F.col(value), "user_id variant, product_id variant, "
                       "quantity variant, price variant, total_price variant")
    number = "position" if "position" in raw.columns else "arrival"
    fields = raw.select(F.col(number).cast("bigint").alias("id"), F.col("timestamp").alias("created_at"),
                        post.alias("post"))
    price = F.try_variant_get("post.price", "$", PRICE.simpleString())
    total = F.try_variant_get("post.total_price", "$", PRICE.simpleString())
    quantity = F.try_variant_get("post.quantity", "$", "int")

    def bad(name: str, number: Column) -> Column:
        return F.col(f"post.{name}").isNotNull() & number.isNull()

    # A product 0 or false is none, a text "0" is one.
    product = scalar_text(F.col("post.product_id"))
    none = (F.coalesce(product.try_cast("double") == 0, F.lit(False)) | (product == "false")) \
        & (kind(F.col("post.product_id")) != "STRING")
    bad_total = F.col("post.price").isNull() & bad("total_price", total)
    return fields.select(
        "id", F.try_variant_get("post.user_id", "$", "bigint").alias("user_id"),
        F.when(~none, product).alias("product_id"),
        quantity.alias("quantity"), price.alias("price"), total.alias("total_price"),
        "created_at",
        (bad("price", price) | bad_total | bad("quantity", quantity)).alias("bad_number"))


def validate_order(posts: DataFrame) -> DataFrame:
    """Posts with ``error``: user and product must be given; 0 and '' do not count.

    A post with a price or quantity that is no number (``bad_number``), null
    included, would be stored without an event or not at all, so it is refused too.
    """
    ok = _present(posts, "user_id") & _present(posts, "product_id")
    error = F.when(~ok, "User ID and Product ID required")
    if "bad_number" in posts.columns:
        error = error.when(F.col("bad_number"), "Price and quantity must be numbers")
    return posts.withColumn("error", error)


def validate_user(posts: DataFrame) -> DataFrame:
    ok = _present(posts, "name") & _present(posts, "email")
    return posts.withColumn("error", F.when(~ok, "Name and email required"))


def validate_product(posts: DataFrame) -> DataFrame:
    """A price of 0 is allowed, a missing one is not."""
    ok = _present(posts, "name") & F.col("price").isNotNull()
    return posts.withColumn("error", F.when(~ok, "Name and price required"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error").isNull()).drop("error")


def refused(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error").isNotNull())


def status_default(posts: DataFrame, **defaults) -> DataFrame:
    """Fill fields a post may leave out, e.g. ``status='pending'``; adds absent columns."""
    for name, value in defaults.items():
        given = F.col(name) if name in posts.columns else F.lit(None)
        posts = posts.withColumn(name, F.coalesce(given, F.lit(value)))
    return posts


def new_orders(posts: DataFrame) -> DataFrame:
    """Accepted order posts as rows of the orders table (without key and time)."""
    return status_default(posts, quantity=1).select(
        *[c for c in ("id", "created_at") if c in posts.columns],
        "user_id", "product_id", "quantity",
        price_or_total_price(F.col("price"), F.col("total_price")).cast(PRICE)
        .alias("total_price"),
        F.lit("pending").alias("status"))


def reject_duplicate_email(new: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """New users with ``error`` where the e-mail is taken.

    ``order`` is a unique column; the lowest one of equal new e-mails wins. The
    stored e-mails are cut down to the new ones first, so a small batch is sent to
    them and they are not shuffled. A flood of copies of one e-mail spreads over the
    tasks, because its rows are matched on the e-mail and ``order``.
    """
    first = new.groupBy("email").agg(F.min(order).alias(order))
    taken = (existing.select("email").join(first.select("email"), "email", "left_semi")
             .distinct().withColumn("_taken", F.lit(True)))
    # An anti join would be moved below the aggregate, to where all copies still are.
    winners = first.join(taken, "email", "left").filter("_taken IS NULL").drop("_taken")
    return (new.join(winners.withColumn("_won", F.lit(True)), ["email", order], "left")
            .withColumn("error", F.when(F.col("_won").isNull(), "Email already exists"))
            .drop("_won"))
