"""Chat records of different layouts as one format with a loss mask.

A record is a JSON object. Hashes of its nested field paths, each chained from its
parent's hash, are cut down to the paths that some layout names, and the hash of
those is the record's fingerprint. A table of fingerprints, made from the declared
layouts, selects the mapping that turns the record into turns of role and text. Turns
are written between marks; a mark inside a text is broken by a backslash that
reading takes out again. Everything is a Spark expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EACH = 0  # a step of a path: any element of an array
DEEP = 4  # steps of the longest path that is looked at
TURNS = "array<struct<place:bigint,role:string,text:string>>"

OPEN, COLON, CLOSE = "### ", ":\n", "</turn>\n"
# A backslash before each backslash, each # after two, and the > of an end mark: no mark is left whole in a text.
IN_TEXT = r"(\\|(?<=##)#|(?<=</turn)>)"
IN_ROLE = r"(\\|(?<=##)#|(?<=</turn)>|\n)"

Path = tuple[str | int, ...]


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


@dataclass(frozen=True)
class Part:
    """A turn made of the texts at top-level fields, joined by empty lines where they are not empty.

    Without ``role_at`` its role is ``role``; ``place_at`` names a field that tells the turn's
    place among those of other records of the conversation. A part whose fields are
    all missing gives no turn.
    """

    fields: tuple[str, ...]
    role: str = ""
    role_at: str | None = None
    place_at: str | None = None

    def turns(self, record: Column, place: int, roles: dict[str, str]) -> Column:
        texts = [_get(record, f"$.{f}") for f in self.fields]
        there = [F.variant_get(record, f"$.{f}", "variant").isNotNull() for f in self.fields]
        given = there[0]
        for t in there[1:]:
            given |= t
        role = _named(_get(record, f"$.{self.role_at}"), roles) if self.role_at else F.lit(self.role)
        text = F.array_join(F.filter(F.array(*texts), lambda t: t != ""), "\n\n")
        where = _get(record, f"$.{self.place_at}", "bigint") if self.place_at else F.lit(place).cast("long")
        turn = F.struct(where.alias("place"), role.alias("role"), text.alias("text"))
        return F.when(given, F.array(turn)).otherwise(F.array().cast(TURNS))


@dataclass(frozen=True)
class Messages:
    """A turn for each object in the array at a top-level field."""

    at: str
    role: str
    text: str

    def turns(self, record: Column, place: int, roles: dict[str, str]) -> Column:
        def turn(message: Column, i: Column) -> Column:
            return F.struct(
                (F.lit(place) + i).cast("long").alias("place"),
                _named(_get(message, f"$.{self.role}"), roles).alias("role"),
                F.coalesce(_get(message, f"$.{self.text}"), F.lit("")).alias("text"),
            )

        return F.coalesce(F.transform(_get(record, f"$.{self.at}", "array<variant>"), turn), F.array().cast(TURNS))


def _named(role: Column, roles: dict[str, str]) -> Column:
    role = F.coalesce(role, F.lit(""))
    named = role
    for given, ours in roles.items():
        named = F.when(role == given, ours).otherwise(named)
    return named


@dataclass(frozen=True)
class Layout:
    """The paths that a record of this kind has or may have, and what its turns are made of."""

    name: str
    required: tuple[Path, ...]
    parts: tuple[Part | Messages, ...]
    optional: tuple[Path, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def turns(self, record: Column) -> Column:
        found = [p.turns(record, i, self.roles) for i, p in enumerate(self.parts)]
        return F.concat(*found) if len(found) > 1 else found[0]


_SYSTEM = Part(("system",), "system")
_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("turn", (("turn",), ("role",), ("text",)), (Part(("text",), role_at="role", place_at="turn"),)),
    Layout("messages", (("messages",),), (Messages("messages", "role", "content"),), (("messages", EACH, "role"), ("messages", EACH, "content"))),
    Layout("conversations", (("conversations",),), (_SYSTEM, Messages("conversations", "from", "value")), (("system",), ("conversations", EACH, "from"), ("conversations", EACH, "value")), _NAMES),
    Layout("instruction", (("instruction",), ("output",)), (_SYSTEM, Part(("instruction", "input"), "user"), Part(("output",), "assistant")), (("input",), ("system",))),
    Layout("completion", (("prompt",), ("completion",)), (_SYSTEM, Part(("prompt",), "user"), Part(("completion",), "assistant")), (("system",),)),
    Layout("response", (("prompt",), ("response",)), (_SYSTEM, Part(("prompt",), "user"), Part(("response",), "assistant")), (("system",),)),
    Layout("answer", (("question",), ("answer",)), (_SYSTEM, Part(("context", "question"), "user"), Part(("answer",), "assistant")), (("context",), ("system",))),
)


def path_hash(path: Path) -> Column:
    found = F.lit(0).cast("long")
    for step in path:
        found = F.xxhash64(found, F.lit(step))
    return found


def path_hashes(value: Column, parent: Column, steps: int = DEEP) -> Column:
    """Hashes of all field paths of a variant down to ``steps`` steps, repeats included."""
    none = F.array().cast("array<bigint>")
    if not steps:
        return none

    def below(entry: Column) -> Column:
        own = F.xxhash64(parent, entry["key"])
        return F.concat(F.array(own), path_hashes(entry["value"], own, steps - 1))

    fields = F.flatten(F.transform(F.map_entries(_get(value, "$", "map<string,variant>")), below))
    elements = F.flatten(F.transform(_get(value, "$", "array<variant>"), lambda x: path_hashes(x, F.xxhash64(parent, F.lit(EACH)), steps - 1)))
    return F.coalesce(fields, elements, none)


def _fingerprint(hashes: Column) -> Column:
    return F.xxhash64(F.sort_array(F.array_distinct(hashes)))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The hash of those of a record's field paths that ``layouts`` name."""
    known = F.array(*[path_hash(p) for p in sorted({p for x in layouts for p in x.required + x.optional}, key=str)])
    return _fingerprint(F.array_intersect(path_hashes(record, F.lit(0).cast("long")), known))


def layout_of(print_: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The number of the layout with a fingerprint, null for an unknown one."""
    table = []
    for i, layout in enumerate(layouts):
        for n in range(len(layout.optional) + 1):
            for more in combinations(layout.optional, n):
                table += [_fingerprint(F.array(*map(path_hash, layout.required + more))), F.lit(i)]
    return F.element_at(F.create_map(*table), print_)


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, record: str = "record", conversation: str = "conv_id") -> DataFrame:
    """conv_id, own, layout, place, role and text of every turn of ``records``.

    ``record`` is a variant, or JSON as text. Records with one ``conversation`` belong
    together; one without is a conversation of its own, told by ``own``. A record of no known layout, one that is null or
    no JSON object, and one without turns give one row without turn; its layout is null if unknown.
    A null role or text is empty.
    """
    value = F.col(record)
    if records.schema[record].dataType.typeName() != "variant":
        value = F.try_parse_json(value.cast("string"))
    rows = records.select(F.col(conversation).cast("long").alias("conv_id"), value.alias("record"))
    rows = rows.withColumn("own", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())).withColumn("number", layout_of(fingerprint(F.col("record"), layouts), layouts))
    number, record_ = F.col("number"), F.col("record")
    turns, name = F.array().cast(TURNS), F.lit(None).cast("string")
    for i, layout in enumerate(layouts):
        turns, name = F.when(number == i, layout.turns(record_)).otherwise(turns), F.when(number == i, layout.name).otherwise(name)
    rows = rows.select("conv_id", "own", name.alias("layout"), F.explode_outer(turns).alias("turn"))
    return rows.select("conv_id", "own", "layout", F.col("turn.place").alias("place"), F.col("turn.role").alias("role"), F.col("turn.text").alias("text"))


def _escaped(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, r"\\$1")


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, record: str = "record", conversation: str = "conv_id", learned: str = "assistant") -> DataFrame:
    """conv_id, layouts, formatted and loss of every conversation in ``records``; see :func:`canonical_turns`.

    ``formatted`` holds each turn as ``### role:``, its text from the next line on, and
    ``</turn>``; :func:`read_chats` gives the turns back. ``loss`` are the spans of texts by the role
    ``learned``: the turn's number, the span's place ``at`` in that turn, its ``start`` in
    the formatted text and its length, all in code points. Turns stand by place, then role and text, so equal
    places and repeated rows keep a fixed order; a null place comes first. A conversation is one row, of any length that
    a row may have; one without turns has an empty text. An empty table gives no row. Other columns may have any name.
    """
    # dealt out before the texts are written with their marks, so that each text is shuffled once
    turns = canonical_turns(records, layouts, record, conversation).repartition("conv_id", "own")
    role, text = _escaped(F.col("role"), IN_ROLE), _escaped(F.col("text"), IN_TEXT)
    head = F.concat(F.lit(OPEN), role, F.lit(COLON))
    turns = turns.select("conv_id", "own", "layout", "place", "role", "text", head.alias("head"), text.alias("body"))
    turns = turns.withColumn("whole", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id", "own").orderBy("place", "role", "text")
    before = F.sum(F.char_length("whole")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.select(
        "conv_id",
        "own",
        "layout",
        F.when(
            F.col("whole").isNotNull(),
            F.struct(
                F.row_number().over(order).alias("n"),
                F.coalesce(before, F.lit(0)).cast("long").alias("start"),
                "whole",
                (F.col("role") == learned).alias("counts"),
                F.char_length("head").cast("long").alias("at"),
                F.char_length("body").cast("long").alias("length"),
            ),
        ).alias("turn"),
    )
    chats = turns.groupBy("conv_id", "own").agg(F.sort_array(F.collect_set("layout")).alias("layouts"), F.sort_array(F.collect_list("turn")).alias("turns"))
    # rows without turn come first by their null place, so a turn's number counts from the first row that has one
    first = F.get("turns", F.lit(0))["n"]
    spans = F.transform(
        F.filter("turns", lambda t: t["counts"]),
        lambda t: F.struct((t["n"] - first).alias("turn"), t["at"].alias("at"), (t["start"] + t["at"]).alias("start"), t["length"].alias("length")),
    )
    return chats.select("conv_id", "layouts", F.array_join(F.transform("turns", lambda t: t["whole"]), "").alias("formatted"), spans.alias("loss"))


def read_chats(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, the turns read back from it, and the texts under the loss mask, from :func:`format_chats`."""
    pieces = F.split("formatted", CLOSE, -1)
    chats = chats.select("conv_id", "formatted", "loss", F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("pieces"))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, COLON, 1)
        text = F.substr(piece, F.char_length(head) + len(COLON) + 1)
        return F.struct(_plain(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"), _plain(text).alias("text"))

    def under(span: Column) -> Column:
        return _plain(F.substr(F.get("pieces", span["turn"]), (span["at"] + 1).cast("int"), span["length"].cast("int")))

    each: Callable[[Column], Column] = turn
    return chats.select("conv_id", "formatted", F.transform("pieces", each).alias("turns"), F.transform("loss", under).alias("learned"))
