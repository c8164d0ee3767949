"""Places by address range, and rows in curve order."""

from __future__ import annotations

import random
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from linewatch.operators.ranges import ipv4_number, locate, prefix_blocks
from linewatch.sinks.layout import cluster_days, curve_key
from linewatch.sinks.tables import append_table, create_table, ensure_database


def test_addresses_in_text(table):
    texts = {"1.2.3.4": 16909060, "255.255.255.255": 2**32 - 1, "0.0.0.0": 0, " 10.0.0.1 ": 167772161, "1.2.3": None, "1.2.3.256": None, "a.b.c.d": None, "": None, None: None, "1.2.3.4.5": None}
    df = table("t string", *[(t,) for t in texts])
    assert [r[0] for r in df.select(ipv4_number(F.col("t"))).collect()] == list(texts.values())


def test_blocks_cover_their_range_and_nothing_else(table):
    rng = random.Random(1)
    edges = [(0, 0), (0, 255), (1, 254), (7, 8), (5, 5), (3, 2), (0, 2**32 - 1), (1, 2**32 - 2)] + [tuple(sorted((rng.randrange(256), rng.randrange(256)))) for _ in range(150)]
    rows = table("a bigint, b bigint", *edges).select("a", "b", prefix_blocks(F.col("a"), F.col("b")).alias("found")).collect()
    for r in rows:
        blocks = sorted((x.prefix << x.level, (x.prefix + 1 << x.level) - 1, x.level) for x in r.found)
        assert len(blocks) <= 62
        at = r.a
        for low, high, level in blocks:
            assert low == at
            at = high + 1
        assert at == max(r.a, r.b + 1) if r.a <= r.b else blocks == []


def test_the_narrowest_range_wins(table, rows):
    rng = random.Random(2)
    ranges = [(a, a + rng.randrange(1 << rng.randrange(1, 9)), f"p{i}", rng.choice("xy")) for i, a in enumerate(rng.randrange(400) for _ in range(60))]
    ranges += [(0, 1000, "all", None), (50, 40, "swapped", "z"), (None, 9, "open", "z"), (5, None, "open", "z"), (-5, 10, "negative", "z"), (0, 1000, "all", "a")]
    asked = [(i, rng.choice([None, -1, rng.randrange(1100)])) for i in range(300)] + [(900, 7), (901, 7)]

    def plain(x):
        fit = [(b - a, -a, (p, q is not None, q or "")) for a, b, p, q in ranges if x is not None and a is not None and b is not None and 0 <= a <= x <= b]
        return min(fit)[2][::2] if fit else (None, None)

    want = sorted(((i, x, plain(x)[0], plain(x)[1] or None) for i, x in asked), key=str)
    df, known = table("id int, address bigint", *asked), table("range_start bigint, range_end bigint, place string, kind string", *ranges)
    got = sorted((tuple(r) for r in locate(df, known, "address", ["place", "kind"]).collect()), key=str)
    assert got == want
    assert rows(locate(df, known.limit(0), "address", ["place"]), "place") == [(None,)] * len(asked)
    plan = locate(df, known, "address", ["place"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


SCHEMA = {"city": "string", "station": "string", "hour": "int", "v": "int", "day": "date"}
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def clustered(spark):
    ensure_database(spark, "layout")
    create_table(spark, "layout.t", SCHEMA, ["day"])
    rng = random.Random(3)
    rows = [(f"city {rng.randrange(20):02d}", f"station {rng.randrange(200):03d}" if i % 50 else None, rng.randrange(24), i, [D1, D2, None][i % 3]) for i in range(6000)]
    append_table(spark.createDataFrame(rows, "city string, station string, hour int, v int, day date").repartition(16), "layout.t")
    yield "layout.t", sorted(rows, key=str)
    spark.sql("DROP TABLE layout.t")


def groups_read(spark, table, day, column, value):
    """Row groups whose statistics do not rule a value out, and all."""
    met = total = 0
    for path in spark.table(table).where(F.col("day") == F.lit(day)).inputFiles():
        file = pq.ParquetFile(path.removeprefix("file://").removeprefix("file:"))
        at = file.schema_arrow.get_field_index(column)
        for g in range(file.metadata.num_row_groups):
            stats = file.metadata.row_group(g).column(at).statistics
            met, total = met + (stats is None or stats.min <= value <= stats.max), total + 1
    return met, total


def test_fewer_row_groups_are_read_by_any_of_the_columns(spark, clustered):
    table, rows = clustered
    before = {c: groups_read(spark, table, D1, c, v) for c, v in (("city", "city 07"), ("station", "station 070"), ("hour", 7))}
    assert all(met == total for met, total in before.values())
    untouched = set(spark.table(table).where("day IS NULL").inputFiles())
    cluster_days(spark, table, ["city", "station", "hour"], [D1, D2], files=96)
    assert sorted((tuple(r) for r in spark.table(table).select(*SCHEMA).collect()), key=str) == rows
    for column, value in (("city", "city 07"), ("station", "station 070"), ("hour", 7)):
        met, total = groups_read(spark, table, D1, column, value)
        assert total >= 12 and met <= total * 0.65, (column, met, total)
    assert groups_read(spark, table, D1, "city", "city 07")[0] <= 16
    assert set(spark.table(table).where("day IS NULL").inputFiles()) == untouched
    cluster_days(spark, table, ["city"])
    assert sorted((tuple(r) for r in spark.table(table).select(*SCHEMA).collect()), key=str) == rows
    assert len(spark.table(table).inputFiles()) <= 6  # small files became large ones


def test_tables_without_a_day_are_refused(spark, clustered):
    create_table(spark, "layout.plain", {"a": "int"})
    with pytest.raises(ValueError, match="one partition column"):
        cluster_days(spark, "layout.plain", ["a"])


def test_the_curve_interleaves_bits(table):
    df = table("x int, y int", *[(x, y) for x in range(4) for y in range(4)])
    keys = {(r.x, r.y): r.k for r in df.select("x", "y", curve_key(df, ["x", "y"], 2).alias("k")).collect()}
    assert keys == {(x, y): (x >> 1) << 3 | (y >> 1) << 2 | (x & 1) << 1 | (y & 1) for x in range(4) for y in range(4)}
