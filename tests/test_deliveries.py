"""Ids as bytes, tries folded after they meet, riders with further columns."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from linewatch.functions import keys
from linewatch.operators.delivery import delivery_log, outcomes
from linewatch.operators.riders import match_riders


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_ids_come_back_from_their_bytes(table):
    digest = hashlib.sha256(b"x").hexdigest()
    ids = [digest, digest.upper(), digest + "\n", digest[:-1], digest + digest, digest[:-2], "", "e1_u1", "\0", "\0" * 32, "ä" * 16, None]
    got = table("i string", *[(i,) for i in ids]).select("i", keys.short_id(F.col("i")).alias("b"), keys.long_id(keys.short_id(F.col("i"))).alias("back")).collect()
    assert [r.back for r in got] == ids
    assert len({None if r.b is None else bytes(r.b) for r in got}) == len(ids) and len(got[0].b) == 32


def test_ids_are_shuffled_as_bytes_and_folded_after(table, rows):
    digest = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(3)]
    tries = table("notification_id string, delivered boolean, attempted_at timestamp", *[(d, v, datetime(2024, 1, 1)) for d, v in [(digest[0], True), (digest[0], None), (digest[1], False), ("plain", True), (None, True), (None, False)]])
    folded = outcomes(tries)
    assert rows(folded, "notification_id", "delivered", "attempts") == sorted([(digest[0], True, 2), (digest[1], False, 1), ("plain", True, 1), (None, True, 2)], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert [line for line in exchanges(folded) if "_id#" in line and "REPARTITION_BY_COL" in line] and len(exchanges(folded)) == 1
    outbox = table("notification_id string, event_id string, user_id string, email string, subject string, message string", *[(i, "e", "u", "m", "s", "t") for i in (*digest, "plain", None, digest[0])])
    some = rows(delivery_log(outbox, tries, missing_fails=False), "notification_id", "delivery_status")
    assert some == sorted([(digest[0], "SENT"), (digest[0], "SENT"), (digest[1], "FAILED"), ("plain", "SENT")])
    every = rows(delivery_log(outbox, tries), "notification_id", "delivery_status")
    assert every == [*sorted([*some, (digest[2], "FAILED")]), (None, "FAILED")]
    assert all("notification_id#" not in line for line in exchanges(delivery_log(outbox, tries)))


def test_riders_bring_further_columns(table):
    alerts = table("event_id string, route string, current_station string, delay_minutes int, is_delayed boolean, is_cancelled boolean", ("e", "A", "B", 9, True, False))
    prefs = table(
        "user_id string, email string, route string, station string, delay_threshold_minute int, notify_delay boolean, notify_cancellation boolean, is_active boolean, kind string",
        ("u", "m", "a", None, 5, True, True, True, "x"), ("v", "m", None, "b", 5, True, True, True, None), ("w", "m", "a", "b", 5, True, True, True, "z"),
    )
    got = match_riders(alerts, prefs, carry=["delay_minutes"], of_rider=["kind"])
    assert sorted((r.user_id, r.delay_minutes, r.kind) for r in got.collect()) == [("u", 9, "x"), ("v", 9, None), ("w", 9, "z")]
