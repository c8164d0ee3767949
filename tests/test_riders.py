import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linewatch.functions.sql import create_alert_history, create_matching_preferences
from linewatch.operators.delivery import (
    DispatchFailed, cursor_rows, delivery_log, delivery_summary, extract_drafts, outbox_rows, raise_on_failure,
)
from linewatch.sources.lookups import read_riders_jdbc, rider_query
from linewatch.operators.riders import alert_history, match_riders, pending, recent_alert_counts
from linewatch.plans.dispatch import dispatch

ALERT = (
    "event_id string, route string, current_station string, next_station string, event_type string, event_date date, "
    "delay_minutes int, is_delayed boolean, is_major_delay boolean, is_cancelled boolean, "
    "notification_status string, notified_at timestamp, current_weather_description string, "
    "forecast_weather_description string"
)
PREF = (
    "user_id string, email string, route string, station string, delay_threshold_minute int, "
    "notify_delay boolean, notify_cancellation boolean, is_active boolean"
)
D = date(2024, 6, 10)


def alert(event, route="Kent", station="Dover", day=D, delay=10, late=True, major=False, cancelled=False, status=None):
    return (event, route, station, None, "ARRIVAL", day, delay, late, major, cancelled, status, None, "rain", "fog")


def pref(user, route="Kent", station="Dover", threshold=10, delay=True, cancel=True, active=True):
    return (user, f"{user}@example.com", route, station, threshold, delay, cancel, active)


def pairs(df):
    return sorted((r.event_id, r.user_id) for r in df.collect())


def test_matching_rules(table):
    prefs = table(
        PREF,
        pref("both"), pref("route", station=None), pref("station", route="Other"), pref("case", "  kENT ", None),
        pref("space", None, " DOVER"), pref("elsewhere", "X", "Y"), pref("inactive", active=False),
        pref("patient", threshold=11), pref("no_delay", delay=False), pref("no_cancel", cancel=False),
        pref("unsure", threshold=None), pref("unknown", None, None),
    )
    late = table(ALERT, alert("e"))
    everyone = {"both", "route", "station", "case", "space"}
    assert pairs(match_riders(late, prefs)) == sorted(("e", u) for u in everyone | {"no_cancel"})
    gone = table(ALERT, alert("e", delay=None, late=False, cancelled=True))
    assert pairs(match_riders(gone, prefs)) == sorted(
        ("e", u) for u in everyone | {"patient", "no_delay", "unsure"}
    )
    unplaced = table(ALERT, alert("e", route=None))
    assert pairs(match_riders(unplaced, prefs)) == sorted(
        ("e", u) for u in {"both", "station", "space", "no_cancel"}
    )


def random_alerts(rng, n, statuses=(None,)):
    return [
        alert(
            f"e{i:03d}", rng.choice(["Kent", "Kent", "kent ", "Wessex", None]), rng.choice(["Dover", "Deal", None]),
            D - timedelta(days=rng.randint(0, 12)), rng.choice([None, 5, 10, 20]), rng.random() < 0.6, False,
            rng.random() < 0.4, rng.choice(statuses),
        )
        for i in range(n)
    ]


def test_matching_equals_brute_force(spark, table):
    rng = random.Random(1)
    alerts = table(ALERT, *random_alerts(rng, 60))
    prefs = table(
        PREF,
        *[
            pref(
                f"u{i}", rng.choice(["KENT", "wessex", None]), rng.choice(["dover ", "Deal", None]),
                rng.choice([5, 10, 15]), rng.random() < 0.7, rng.random() < 0.5, rng.random() < 0.8,
            )
            for i in range(40)
        ],
    )
    alerts.createOrReplaceTempView("t_alerts")
    prefs.createOrReplaceTempView("t_prefs")
    expected = spark.sql("""
        SELECT a.event_id, p.user_id FROM t_alerts a JOIN t_prefs p
        ON is_active AND (lower(trim(a.route)) = lower(trim(p.route))
                          OR lower(trim(a.current_station)) = lower(trim(p.station)))
        AND ((is_delayed AND notify_delay AND delay_threshold_minute <= delay_minutes)
             OR (is_cancelled AND notify_cancellation))""")
    got = match_riders(alerts, prefs)
    assert pairs(got) == pairs(expected)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_history_equals_brute_force(table):
    rng = random.Random(2)
    log = random_alerts(rng, 150, ("SENT", "SENT", None))
    probes = random_alerts(rng, 30)
    for limit in (3, 20):
        got = {}
        for r in alert_history(table(ALERT, *probes), table(ALERT, *log), 7, limit).collect():
            got.setdefault(r.alert_id, []).append((r.event_date, r.event_id))
        counts = {
            r.event_id: r.recent_alerts
            for r in recent_alert_counts(table(ALERT, *probes), table(ALERT, *log), 7, limit).collect()
        }
        for a in probes:
            near = [
                (h[5], h[0]) for h in log
                if h[10] == "SENT" and ((a[1] and h[1] == a[1]) or (a[2] and h[2] == a[2]))
                and a[5] - timedelta(days=7) <= h[5] <= a[5]
            ]
            near = sorted(near, reverse=True)[:limit]
            assert sorted(got.get(a[0], []), reverse=True) == near
            assert counts[a[0]] == len(near)


def test_sql_functions(spark, table, rows):
    table(PREF, pref("a"), pref("b", threshold=11), pref("c", "x", " DOVER "), pref("d", active=False)).createOrReplaceTempView("f_prefs")
    create_matching_preferences(spark, "f_prefs", "f_match", temporary=True)
    create_matching_preferences(spark, "f_prefs", "f_match", temporary=True)
    found = spark.sql("SELECT * FROM f_match('kent', 'Dover', 10, true, false)")
    assert found.columns == ["user_id", "email", "route", "station", "delay_threshold_minute"]
    assert rows(found, "user_id") == [("a",), ("c",)]
    assert rows(spark.sql("SELECT user_id FROM f_match('kent', 'q', NULL, false, true)")) == [("a",), ("b",)]
    log = [alert(f"s{i:02d}", day=D - timedelta(days=i % 3), status="SENT") for i in range(25)]
    log += [alert("early", day=D - timedelta(days=8), status="SENT"), alert("later", day=D + timedelta(days=1), status="SENT")]
    log += [alert("edge", station="Q", day=D - timedelta(days=7), status="SENT"), alert("open")]
    log += [alert("case", route="KENT", station="DOVER", status="SENT")]
    table(ALERT, *log).createOrReplaceTempView("f_alerts")
    create_alert_history(spark, "f_alerts", "f_history", temporary=True)
    found = spark.sql("SELECT * FROM f_history('Kent', 'Dover', DATE'2024-06-10', 7)")
    ids = [r.event_id for r in found.collect()]
    newest = sorted(((a[5], a[0]) for a in log[:25]), reverse=True)[:20]
    assert sorted(ids) == sorted(i for _, i in newest) and "case" not in ids
    assert [r.event_id for r in spark.sql("SELECT * FROM f_history('Kent', 'Z', DATE'2024-06-03', 0)").collect()] == ["edge"]


def test_pending(table):
    alerts = table(
        ALERT, alert("new"), alert("edge", day=D - timedelta(days=1)), alert("old", day=D - timedelta(days=2)),
        alert("done"), alert("calm", late=False), alert("unknown", late=None, cancelled=None, major=None),
        alert("gone", late=None, cancelled=True),
    )
    cursor = table("event_id string, dispatched_at timestamp", ("done", None), ("done", None))
    got = pending(alerts, cursor, F.lit(D))
    assert got.columns == alerts.columns
    assert sorted(r.event_id for r in got.collect()) == ["edge", "gone", "new"]


def test_dispatch_is_repeatable_and_moves_the_cursor(table):
    alerts = table(ALERT, alert("e1"), alert("e2", "Nowhere", "Nowhere"), alert("h1", status="SENT"), alert("h2", status="SENT"))
    prefs = table(PREF, pref("a"), pref("b"))
    cursor = table("event_id string", ("h1",), ("h2",))
    outbox, moved = dispatch(alerts, prefs, cursor, F.lit(D))
    first = {(r.event_id, r.user_id): r for r in outbox.collect()}
    assert set(first) == {("e1", "a"), ("e1", "b")}
    assert "several disruptions" in first[("e1", "a")].message and first[("e1", "a")].subject == "Delay at Dover: 10 min"
    assert sorted(r.event_id for r in moved.collect()) == ["e1", "e2"]
    again, _ = dispatch(alerts, prefs, cursor, F.lit(D))
    assert {r.notification_id for r in again.collect()} == {r.notification_id for r in first.values()}
    done, _ = dispatch(alerts, prefs, moved.select("event_id").unionByName(cursor), F.lit(D))
    assert done.count() == 0


def test_extract_drafts(table):
    def trace(second, *calls):
        import json

        output = [{"name": n, "arguments": json.dumps(a) if isinstance(a, dict) else a} for n, a in calls]
        return (datetime(2024, 1, 1, 0, 0, second), json.dumps({"output": output}))

    def record(event, *users):
        return ("record_notifications", {"event_id": event, "drafts": [{"user_id": u, "subject": "s"} for u in users]})

    traces = table(
        "trace_ts timestamp, response string",
        trace(1, record("e", "old")), trace(3, ("other", {"event_id": "e"}), record("f", "x"), record("e", "a", "b"), record("e", "c")),
        trace(2, record("g")), trace(4, ("record_notifications", "not json")), (datetime(2024, 1, 2), "broken"),
    )
    got = sorted((r.event_id, r.user_id, r.email, r.subject) for r in extract_drafts(traces).collect())
    assert got == [("e", "a", "", "s"), ("e", "b", "", "s"), ("f", "x", "", "s")]


def test_delivery_log_and_failures(table):
    drafts = table(
        "event_id string, user_id string, email string, subject string, message string",
        ("e", "a", "m", "s", "t"), ("e", "b", "m", "s", "t"), ("f", "a", "m", "s", "t"),
    )
    outbox = outbox_rows(drafts)
    ids = {(r.event_id, r.user_id): r.notification_id for r in outbox.collect()}
    assert len(set(ids.values())) == 3
    results = table("notification_id string, delivered boolean", (ids["e", "a"], True), (ids["e", "b"], False))
    log = delivery_log(outbox, results)
    assert sorted((r.event_id, r.user_id, r.delivery_status, r.route) for r in log.collect()) == [
        ("e", "a", "SENT", None), ("e", "b", "FAILED", None), ("f", "a", "FAILED", None),
    ]
    assert sorted(tuple(r) for r in delivery_summary(log).collect()) == [("e", 1, 1), ("f", 0, 1)]
    with pytest.raises(DispatchFailed, match="2 alert"):
        raise_on_failure(log)
    raise_on_failure(log.where("delivery_status = 'SENT'"))
    assert cursor_rows(drafts).count() == 2


class Database:
    """Stands for a session's reader: notes what is asked, answers bounds and rows."""

    def __init__(self, bounds, rows):
        self.bounds, self.rows, self.asked, self.read = bounds, rows, [], self

    def format(self, name):
        assert name == "jdbc"
        self.now = {}
        self.asked.append(self.now)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def options(self, **more):
        reader = Database(self.bounds, self.rows)
        reader.now, reader.asked = self.now, self.asked
        self.now.update(more)
        return reader

    def load(self):
        return self if "min(" in self.now["dbtable"] else self.rows

    def first(self):
        return self.bounds


def test_riders_are_read_in_parts(table):
    rows = table("user_id int, email string, route string, station string, delay_threshold_minute int, notify_delay boolean, notify_cancellation boolean, is_active boolean", (7, "e", "r", "s", 5, True, True, True))
    parts = {"partitionColumn": "user_id", "numPartitions": "8"}

    def asked(bounds, **options):
        source = Database(bounds, rows)
        assert read_riders_jdbc(source, "jdbc:x", "riders", **options).first().user_id == "7"
        return [a for a in source.asked if a.get("dbtable")]

    bounds, read = sorted(asked((1, 90), user="u", **parts), key=lambda a: "min(" not in a["dbtable"])
    assert bounds == {"url": "jdbc:x", "dbtable": "(SELECT min(user_id) AS low, max(user_id) AS high FROM riders) b", "user": "u"}
    assert read == {"url": "jdbc:x", "dbtable": f"({rider_query('riders')}) p", "user": "u", **parts, "lowerBound": "1", "upperBound": "90"}
    assert asked((1, 90), **parts, lowerBound="3", upperBound="4") == [{"url": "jdbc:x", "dbtable": f"({rider_query('riders')}) p", **parts, "lowerBound": "3", "upperBound": "4"}]
    assert "partitionColumn" not in asked((None, None), **parts)[-1]
    assert len(asked(None)) == 1
