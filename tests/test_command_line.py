from datetime import date

import pytest

from linewatch import __main__ as cli
from linewatch.plans import jobs
from linewatch.session import ensure_checkpoint_dir, staged


@pytest.fixture
def calls(monkeypatch):
    seen = []
    for name in ("create_tables", "run_bronze", "run_silver", "stream_silver", "run_gold", "run_riders", "run_dispatch"):
        monkeypatch.setattr(jobs, name, lambda *a, _n=name, **k: seen.append((_n, a[1:], k)))
    monkeypatch.setattr(cli, "read_topic", lambda spark, options: options)
    monkeypatch.setattr(cli, "read_riders_jdbc", lambda spark, url, table: (url, table))
    return seen


def call(calls, *argv):
    cli.run(None, cli.arguments(["--database", "d", "--lookups", "l", *argv]))
    assert calls[0][0] == "create_tables" and calls[0][1][0] == jobs.Layout("d", "l")
    return calls[1]


def test_silver_gold_and_dispatch(calls):
    assert call(calls, "silver")[0] == "stream_silver"
    calls.clear()
    assert call(calls, "silver", "--everything")[0] == "run_silver"
    calls.clear()
    assert call(calls, "gold", "--since", "2024-01-10")[1][1] == date(2024, 1, 10)
    calls.clear()
    assert call(calls, "gold")[1][1] is None
    calls.clear()
    assert call(calls, "dispatch", "--lookback-days", "3")[2] == {"lookback_days": 3}
    calls.clear()
    assert call(calls, "riders", "--url", "jdbc:x")[1][1] == ("jdbc:x", "user_preferences")


def test_bronze(calls):
    name, (_, topics), _ = call(
        calls, "bronze", "--bootstrap", "b", "--rail-topic", "r", "--forecast-topic", "f", "--key", "k", "--secret", "s",
        "--max-offsets", "0",
    )
    assert name == "run_bronze" and set(topics) == {"rail_bronze", "forecast_bronze"}
    assert topics["rail_bronze"]["subscribe"] == "r" and topics["rail_bronze"]["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in topics["rail_bronze"]
    with pytest.raises(ValueError):
        cli.run(None, cli.arguments(["--database", "d", "bronze", "--bootstrap", "b", "--rail-topic", "r"]))


def test_staged_frames_live_in_the_named_folder(spark, table):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark).removeprefix("file:").startswith(folder)
    one, two = staged(table("a int", (1,)), table("b string, t timestamp_ntz"))
    assert one.collect()[0].a == 1 and two.dtypes == [("b", "string"), ("t", "timestamp_ntz")]
    assert all("checkpoints" in f for f in one.inputFiles())
