"""Drafts, outbox rows, delivery log and cursor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.functions.keys import long_id, short_id
from linewatch.functions.texts import add_draft
from linewatch.operators.clean import dedupe
from linewatch.operators.riders import match_riders

# The call that carries drafts and the layout of its arguments.
RECORD_CALL = "record_notifications"
TRACE_LAYOUT = "struct<output:array<struct<name:string,arguments:string>>>"
ARGUMENTS_LAYOUT = (
    "struct<event_id:string,"
    "drafts:array<struct<user_id:string,email:string,subject:string,message:string>>>"
)


def notification_id(event: str = "event_id", user: str = "user_id") -> Column:
    """Depends on event and rider only, so a repeated run gives the same id."""
    return F.sha2(F.concat_ws("_", F.col(event), F.col(user)), 256)


def draft_notifications(
    alerts: DataFrame, prefs: DataFrame, recent: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """``event_id, user_id, email, subject, message`` for every matched rider, and the alert columns to ``carry``.

    The text depends on the alert alone: it is written once per alert and rides
    along to the riders, so the many matched rows are not joined again.
    """
    if recent is None:
        told = alerts.withColumn("recent_alerts", F.lit(0).cast("bigint"))
    else:
        told = alerts.join(recent, "event_id", "left")
    return match_riders(add_draft(told), prefs, carry=["subject", "message", *carry]).select(
        "event_id", "user_id", "email", "subject", "message", *carry
    )


def _day(df: DataFrame) -> list[str]:
    """The day that a row belongs to, where it is known: logs are laid out by it."""
    return ["event_date"] if "event_date" in df.columns else []


def outbox_rows(drafts: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows for the dispatch outbox, with their ``event_date`` if the drafts have it."""
    return drafts.select(
        notification_id().alias("notification_id"),
        "event_id",
        "user_id",
        "email",
        "subject",
        "message",
        (F.current_timestamp() if at is None else at).alias("recorded_at"),
        *_day(drafts),
    )


def cursor_rows(processed: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows for the cursor: every processed alert, with or without riders."""
    return processed.select(
        "event_id", (F.current_timestamp() if at is None else at).alias("dispatched_at")
    ).dropDuplicates(["event_id"])


def cursor_days(processed: DataFrame, at: Column | None = None) -> DataFrame:
    """:func:`cursor_rows` with the alerts' ``event_date``."""
    return processed.groupBy("event_id").agg(
        F.max(F.current_timestamp() if at is None else at).alias("dispatched_at"), F.max("event_date").alias("event_date")
    )


def outcomes(attempts: DataFrame) -> DataFrame:
    """``notification_id, delivered, attempts, attempted_at`` from every try to deliver.

    A notification is delivered once any try was, so tries may come in any order and
    split over calls, and a repeated one changes nothing but ``attempts``. A try without a result failed.

    Most notifications are tried a few times only, so tries are brought together before they are folded: a map of
    all ids that one task meets would outgrow its memory.
    """
    tries = attempts.select(short_id(F.col("notification_id")).alias("_id"), "delivered", "attempted_at").repartition("_id")
    folded = tries.groupBy("_id").agg(
        F.max(F.coalesce("delivered", F.lit(False))).alias("delivered"),
        F.count(F.lit(1)).alias("attempts"),
        F.max("attempted_at").alias("attempted_at"),
    )
    return folded.select(long_id(F.col("_id")).alias("notification_id"), "delivered", "attempts", "attempted_at")


def extract_drafts(traces: DataFrame) -> DataFrame:
    """Drafts per event from recorded responses (``trace_ts``, ``response`` JSON).

    For each event the newest trace that recorded it counts, and in it the first
    such call. An event whose newest call carries no drafts yields no rows.
    """
    calls = (
        traces.select("trace_ts", F.posexplode(F.from_json("response", TRACE_LAYOUT)["output"]).alias("_pos", "call"))
        .where(F.col("call.name") == RECORD_CALL)
        .select("trace_ts", "_pos", F.from_json("call.arguments", ARGUMENTS_LAYOUT).alias("args"))
        .where(F.col("args.event_id").isNotNull())
        .select("trace_ts", "_pos", F.col("args.event_id").alias("event_id"), F.col("args.drafts").alias("drafts"))
    )
    latest = dedupe(calls, ["event_id"], [F.col("trace_ts").desc_nulls_last(), F.col("_pos").asc()])
    return latest.select("event_id", F.explode("drafts").alias("draft")).select(
        "event_id",
        *[F.coalesce(F.col(f"draft.{c}"), F.lit("")).alias(c) for c in ("user_id", "email", "subject", "message")],
    )


def delivery_log(
    outbox: DataFrame, results: DataFrame, at: Column | None = None, missing_fails: bool = True
) -> DataFrame:
    """Outbox rows with ``SENT`` or ``FAILED``; ``results`` has ``notification_id, delivered``.

    A notification without a result counts as failed, or is left out where its result
    may still come (``missing_fails=False``). Route and station are not part of a
    draft and stay NULL.
    """
    # where a missing result fails, those that failed change nothing
    told = results.where("delivered") if missing_fails else results
    told = told.select(short_id(F.col("notification_id")).alias("_id"), "delivered").repartition("_id")
    outcome = told.groupBy("_id").agg(F.max("delivered").alias("_delivered"))
    due = outbox.withColumn("_id", short_id(F.col("notification_id"))).drop("notification_id")
    return due.join(outcome, "_id", "left" if missing_fails else "inner").select(
        long_id(F.col("_id")).alias("notification_id"),
        "event_id",
        "user_id",
        "email",
        F.lit(None).cast("string").alias("route"),
        F.lit(None).cast("string").alias("station"),
        "subject",
        "message",
        F.when(F.col("_delivered"), "SENT").otherwise("FAILED").alias("delivery_status"),
        (F.current_timestamp() if at is None else at).alias("created_at"),
        *_day(outbox),
    )


def delivery_summary(log: DataFrame) -> DataFrame:
    """Sent and failed notifications per event."""
    return log.groupBy("event_id").agg(
        F.count_if(F.col("delivery_status") == "SENT").alias("sent_count"),
        F.count_if(F.col("delivery_status") == "FAILED").alias("failed_count"),
    )


class DispatchFailed(RuntimeError):
    """Some notifications were not delivered."""


def raise_on_failure(log: DataFrame, examples: int = 20) -> None:
    """Raise :class:`DispatchFailed` with the number of affected events.

    The count is of all; the message names the first ``examples`` events only, and
    :func:`delivery_summary` lists every one.
    """
    failed = delivery_summary(log).where("failed_count > 0").select("event_id")
    total = failed.count()
    if total:
        some = [r.event_id for r in failed.orderBy("event_id").limit(examples).collect()]
        raise DispatchFailed(f"{total} alert(s) failed to dispatch, among them: {some}")
