"""Weather wording: how severe, whether it disrupts trains, where it is heading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity grows down the list; the first pattern that is found,
# read from the most severe up, gives the rank.
SEVERITY = [
    (0, r"clear|sunny"),
    (1, r"few clouds|scattered clouds"),
    (2, r"broken clouds|overcast"),
    (3, r"mist|fog|haze"),
    (4, r"light .*(rain|snow)|drizzle"),
    (5, r"rain|snow|sleet"),
    (6, r"heavy .*(rain|snow)|extreme rain"),
    (7, r"thunder|storm|severe|tornado|squall"),
]

# Weather that can plausibly disrupt trains. Wind counts when high,
# heat and cold when extreme; mild weather never does.
DISRUPTIVE = (
    r"\brain|drizzle|\bsnow|\bsleet|\bhail|storm|thunder|\bfog|\bic[ey]\b|freezing|\bgale|squall|tornado|hurricane|blizzard"
    r"|\b(high|strong|severe|extreme|violent) winds?\b|\b(extreme|severe|intense) (heat|cold|temperatures?)\b"
    r"|\bextremely (hot|cold)\b|\bheat ?waves?\b"
)
# What is said to be absent disrupts nothing: "no rain", "without snow or fog".
ABSENT = r"\b(?:no|without)(?: (?:more|further|heavy|any))? \w+(?: (?:or|nor) \w+)*"


def severity(description: Column) -> Column:
    """Rank 0 (clear) to 7 (thunderstorm); NULL for wording outside the scale."""
    text = F.lower(description)
    by_rank = dict(SEVERITY)
    # "light" and "heavy" refine plain rain and snow, so they are tried first.
    order = [7, 6, 4, 5, 3, 2, 1, 0]
    rank = F.when(text.rlike(by_rank[order[0]]), order[0])
    for level in order[1:]:
        rank = rank.when(text.rlike(by_rank[level]), level)
    return rank


def is_disruptive(description: Column) -> Column:
    present = F.regexp_replace(F.lower(description), ABSENT, "")
    return F.coalesce(present.rlike(DISRUPTIVE), F.lit(False))


def trend(current: Column, forecast: Column) -> Column:
    """``EASE``, ``WORSEN`` or ``PERSIST``; NULL when a rank is unknown."""
    now, later = severity(current), severity(forecast)
    return F.when(later < now, "EASE").when(later > now, "WORSEN").when(later == now, "PERSIST")
