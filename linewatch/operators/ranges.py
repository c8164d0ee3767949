"""Places of addresses that are known by ranges, such as blocks of IP addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32


def ipv4_number(text: Column) -> Column:
    """A dotted IPv4 address as a number; anything else is NULL."""
    parts = F.split(F.trim(text), r"\.")
    numbers = F.transform(parts, lambda p: F.when(p.rlike(r"^\d{1,3}$"), p.try_cast("bigint")))
    fine = (F.size(parts) == 4) & F.forall(numbers, lambda n: F.coalesce(n.between(0, 255), F.lit(False)))
    return F.when(fine, F.aggregate(numbers, F.lit(0).cast("bigint"), lambda sum_, n: sum_ * 256 + n))


def prefix_blocks(start: Column, end: Column, bits: int = BITS) -> Column:
    """The range ``start`` to ``end``, both within, as an array of the fewest blocks.

    A block of ``level`` k holds the 2**k addresses whose number without the last k bits is ``prefix``.
    At each level that is not wider than the range, an odd block at either edge is one of them: at most two a level.
    What is left there begins at the start's prefix, rounded up, and ends before that of the address after the end.
    """
    low, after = start.cast("bigint"), end.cast("bigint") + 1
    block = "array<struct<level:int,prefix:bigint>>"

    def at(level: Column) -> Column:
        first = F.call_function("shiftright", low + F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1, level)
        last = F.call_function("shiftright", after, level)
        one = lambda when, prefix: F.when(when & (first < last), F.struct(level.alias("level"), prefix.alias("prefix")))
        return F.array(one(first % 2 == 1, first), one(last % 2 == 1, last - 1))

    levels = F.sequence(F.lit(0), F.least(F.lit(bits), F.length(F.bin(after - low)) - 1))
    found = F.array_compact(F.flatten(F.transform(levels, at)))
    return F.when(low < after, found).otherwise(F.array()).cast(block)


def locate(
    df: DataFrame,
    ranges: DataFrame,
    address: str,
    take: Sequence[str],
    start: str = "range_start",
    end: str = "range_end",
    bits: int = BITS,
) -> DataFrame:
    """``df`` with the columns ``take`` of the narrowest of ``ranges`` that holds ``address``.

    Ranges may nest and overlap; of equally wide ones that with the greater start counts, then the first by content. Addresses
    in no range, unknown or negative ones stay, with NULLs; a range without an edge or with its edges swapped holds nothing.

    Ranges become blocks of addresses with a common prefix, and an address meets them by its own prefixes of
    those lengths: equi joins, so no range, however wide, is paired with what it does not hold. Each different address is
    looked up once, and candidates combine before they are shuffled.
    """
    known = ranges.select(F.col(start).cast("bigint").alias("_start"), F.col(end).cast("bigint").alias("_end"), *take)
    # a file's ranges are few bytes, but many blocks: all tasks cut them
    known = known.where(f"_start >= 0 AND _start <= _end AND _end < {1 << bits}").repartition("_start", "_end")
    place = F.struct((F.col("_end") - F.col("_start")).alias("width"), (-F.col("_start")).alias("start"), *take)
    blocks = known.select(place.alias("_place"), F.explode(prefix_blocks(F.col("_start"), F.col("_end"), bits)).alias("b"))
    levels = sorted(r[0] for r in blocks.select("b.level").distinct().collect())  # at most one for each bit
    blocks = blocks.groupBy(F.col("b.level").alias("_level"), F.col("b.prefix").alias("_prefix")).agg(F.min("_place").alias("_place"))
    asked = df.select(F.col(address).cast("bigint").alias("_address")).where(f"_address >= 0 AND _address < {1 << bits}").distinct()
    by_prefix = asked.select(
        "_address",
        F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_address", k).alias("prefix")) for k in levels]).cast("array<struct<level:int,prefix:bigint>>")).alias("p"),
    )
    met = by_prefix.join(blocks, (F.col("p.level") == F.col("_level")) & (F.col("p.prefix") == F.col("_prefix")))
    best = met.groupBy("_address").agg(F.min("_place").alias("_place"))
    found = df.join(best, df[address].cast("bigint") == best["_address"], "left")
    return found.select(*[df[c] for c in df.columns], *[F.col(f"_place.{c}").alias(c) for c in take])
