"""Surrogate keys and normalised codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def add_key(df: DataFrame, name: str, cols: Sequence[str], time_format: str = KEY_TIME_FORMAT) -> DataFrame:
    """Add ``name``: the given columns joined by ``_``, NULL parts left out."""
    types = dict(df.dtypes)
    parts = [
        F.date_format(c, time_format) if types[c].startswith("timestamp") else F.col(c).cast("string")
        for c in cols
    ]
    return df.withColumn(name, F.concat_ws("_", *parts))


def unique_key(cols: Sequence[str], types: dict[str, str]) -> Column:
    """The text of several columns in which no two different keys look the same.

    Ordinary parts read as with :func:`add_key`. A separator or backslash inside of a part gets a
    backslash before it, an unknown part is ``\\N``, and instants show a fraction of a second where they have one.
    """

    def part(c: str) -> Column:
        if types[c].startswith("timestamp"):
            whole = F.date_format(c, KEY_TIME_FORMAT)
            fraction = F.rtrim(F.date_format(c, "SSSSSS"), F.lit("0"))
            return F.when(F.date_trunc("second", c) == F.col(c), whole).otherwise(F.concat(whole, F.lit("."), fraction))
        text = F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.replace(text, F.lit("_"), F.lit("\\_"))

    return F.concat_ws("_", *[F.coalesce(part(c), F.lit(r"\N")) for c in cols])


# Before ids that are not digests, so that their bytes are never as many as a digest's.
_NO_DIGEST = bytearray(33)


def short_id(c: Column) -> Column:
    """An id as bytes, 32 where it is a digest of 64 hex digits, which no codec shortens; :func:`long_id` gives it back."""
    digest = c.rlike(r"\A[0-9a-f]{64}\z")
    return F.when(digest, F.unhex(c)).otherwise(F.concat(F.lit(_NO_DIGEST), c.cast("binary")))


def long_id(c: Column) -> Column:
    """The id of :func:`short_id`'s bytes."""
    other = F.substring(c, len(_NO_DIGEST) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(c) == 32, F.lower(F.hex(c))).otherwise(other)


def plain_code(c: Column) -> Column:
    """A location code without blanks and leading zeros (``' 00123'`` = ``'123'``)."""
    return F.regexp_replace(F.trim(c.cast("string")), r"^0+(?=.)", "")


def same_text(c: Column) -> Column:
    """The form in which two names count as equal: no outer blanks, lower case."""
    return F.lower(F.trim(c))
