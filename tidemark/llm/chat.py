"""Chat formatting: heterogeneous records to canonical turns, turns to one training text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "### ", ": ", "\n</turn>\n"
LOSS_ROLES = ("assistant",)
TURNS = "array<struct<role:string,text:string>>"


class Field(NamedTuple):
    """One turn of a fixed role; several fields are joined by an empty line."""
    role: str
    names: tuple[str, ...]


class Items(NamedTuple):
    """A turn for each element of a list; without a list the record itself is a turn."""
    list_name: str | None
    role: str
    text: str
    roles: Mapping[str, str] = {}


class Layout(NamedTuple):
    """A declarative mapping: the paths that a record has, and where its turns are."""
    name: str
    paths: tuple[str, ...]
    turns: tuple[Field | Items, ...]


_SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("turn", ("role", "text"), (Items(None, "role", "text"),)),
    Layout("messages", ("messages[].role", "messages[].content"),
           (Items("messages", "role", "content", _SPOKEN),)),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           (Items("conversations", "from", "value", _SPOKEN),)),
    Layout("prompt-response", ("prompt", "response"),
           (Field("user", ("prompt",)), Field("assistant", ("response",)))),
    Layout("prompt-completion", ("prompt", "completion"),
           (Field("user", ("prompt",)), Field("assistant", ("completion",)))),
    Layout("system-prompt-response", ("system", "prompt", "response"),
           (Field("system", ("system",)), Field("user", ("prompt",)), Field("assistant", ("response",)))),
    Layout("question-answer", ("question", "answer"),
           (Field("user", ("question",)), Field("assistant", ("answer",)))),
    Layout("instruction", ("instruction", "output"),
           (Field("user", ("instruction",)), Field("assistant", ("output",)))),
    Layout("instruction-input", ("instruction", "input", "output"),
           (Field("user", ("instruction", "input")), Field("assistant", ("output",)))),
)


def path_fingerprint(paths: Sequence[str]) -> str:
    """Of a record with these field paths; ``[]`` after a name means a list of records."""
    tree: dict = {}
    for path in paths:
        at = tree
        for name in path.split("."):
            at = at.setdefault(name, {})

    def shape(node: dict) -> str:
        if not node:
            return "_"
        inside = [
            f"{n.removesuffix('[]')}: " + (f"ARRAY<{shape(c)}>" if n.endswith("[]") else shape(c))
            for n, c in sorted(node.items(), key=lambda x: x[0].removesuffix("[]"))
        ]
        return f"OBJECT<{', '.join(inside)}>"

    return hashlib.sha256(shape(tree).encode()).hexdigest()


def record_fingerprint(record: Column) -> Column:
    """The same, of a record (a variant): its nested fields without the types of their values."""
    shape = F.schema_of_variant(record)
    return F.sha2(F.regexp_replace(shape, r"\b(?!OBJECT<|ARRAY<)[A-Z]+(\(\d+,\s*\d+\))?(?=[,>]|$)", "_"), 256)


def canonical_turns(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """``layout`` and ``turns`` of a variant; both null where no mapping suits it.

    The mapping with the record's fingerprint does. A record of no known fingerprint is
    read by the mapping with most paths among those whose paths it all has, of scalar values: more
    fields than a mapping names, such as an id, do no harm. ``unread_records`` counts the rest.
    """
    found = F.lit(None).cast(f"struct<layout:string,turns:{TURNS}>")

    def read(layout: Layout) -> Column:
        turns = F.concat(*[_turns(record, part) for part in layout.turns])
        return F.struct(F.lit(layout.name).alias("layout"), turns.alias("turns"))

    for layout in sorted(layouts, key=lambda one: len(one.paths)):
        found = F.when(_has_paths(record, layout), read(layout)).otherwise(found)
    fingerprint = record_fingerprint(record)
    for layout in layouts:
        found = F.when(fingerprint == path_fingerprint(layout.paths), read(layout)).otherwise(found)
    return found


def unread_records(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS, record_column: str = "record") -> DataFrame:
    """The records that no mapping suits: ``fingerprint``, ``shape``, ``n_records``.

    One row per fingerprint of nested paths, empty lists being a shape of their own. ``shape`` is the
    least of the records' nested types, ``n_records`` their number; null records have null for
    both others. Records are counted before the shuffle, so one shape may be that of most.
    """
    record = F.col(record_column)
    return records.where(canonical_turns(record, layouts).isNull()).groupBy(
        record_fingerprint(record).alias("fingerprint")
    ).agg(F.min(F.schema_of_variant(record)).alias("shape"), F.count(F.lit(1)).alias("n_records"))


def _has_paths(record: Column, layout: Layout) -> Column:
    """Whether a record has all paths of a layout, each ending in a scalar; never null."""
    def scalar(value: Column) -> Column:
        return value.isNotNull() & ~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")

    def has(path: str) -> Column:
        before, listed, after = path.partition("[].")
        if not listed:
            return scalar(F.try_variant_get(record, f"$.{before}", "variant"))
        items = F.try_variant_get(record, f"$.{before}", "array<variant>")
        return (F.size(items) > 0) & F.forall(
            items, lambda item: scalar(F.try_variant_get(item, f"$.{after}", "variant")))

    found = reduce(and_, map(has, layout.paths))
    return F.coalesce(found, F.lit(False))


def escape(text: Column, more: str = "") -> Column:
    r"""Control strings cannot occur in the result: a backslash becomes ``\b``, a ``#`` before two
    more ``\h``, the ``<`` of an end mark ``\l``; in roles also a colon ``\c``."""
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.regexp_replace(out, "#(?=##)", r"\\h")
    out = F.replace(out, F.lit("</turn>"), F.lit("\\l/turn>"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if ":" in more else out


_CODES = {r"\b": "\\", r"\h": "#", r"\l": "<", r"\c": ":"}


def unescape(text: str) -> str:
    return re.sub(r"\\[bhlc]", lambda m: _CODES[m[0]], text)


def chat_format(turns: DataFrame, loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss``: one row per conversation, null ids being one.

    ``turns`` holds conv_id, turn, role, text. Turns stand in order of turn (null first), then
    role and text, so ties and repeated rows have one result; null roles and texts count as
    empty. ``loss`` lists start and length, in code points, of the escaped texts that are
    trained on. A conversation is one value and must fit into one; nothing else is gathered.
    """
    whole = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    pieces = whole.withColumns({
        "head": F.concat(F.lit(HEAD), escape(F.col("role"), ":"), F.lit(MIDDLE)),
        "body": escape(F.col("text")),
    }).withColumns({
        "size": F.length("head") + F.length("body") + len(TAIL),
        "trained": F.col("role").isin(list(loss_roles)),
    })
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = pieces.withColumn("start", F.sum("size").over(order) - F.col("size"))
    turn = F.struct("start", "head", "body", "trained")
    spans = F.transform(F.filter("turns", lambda x: x["trained"]), lambda x: F.struct(
        (x["start"] + F.length(x["head"])).alias("start"),
        F.length(x["body"]).cast("long").alias("length")))
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(TAIL))), "")
        .alias("formatted"),
        spans.alias("loss"),
    )


def read_back(formatted: Column, loss: Column) -> Column:
    """``turns`` and the ``loss`` text of formatted conversations, unescaped."""
    def read(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, marks in zip(texts, spans):
            turns = []
            for piece in text.split(TAIL)[:-1]:
                role, _, body = piece.removeprefix(HEAD).partition(MIDDLE)
                turns.append({"role": unescape(role), "text": unescape(body)})
            trained = [text[m["start"] : m["start"] + m["length"]] for m in marks]
            rows.append((turns, "".join(map(unescape, trained))))
        return pd.DataFrame(rows, columns=["turns", "loss"])

    return F.pandas_udf(read, f"turns {TURNS}, loss string")(formatted, loss)


def _turns(record: Column, part: Field | Items) -> Column:
    get = lambda path, kind: F.variant_get(record, path, kind)
    if isinstance(part, Field):
        said = F.concat_ws("\n\n", *[
            F.when(value != "", value) for value in (get(f"$.{n}", "string") for n in part.names)])
        return F.array(F.struct(F.lit(part.role).alias("role"), said.alias("text")))
    if part.list_name is None:
        return F.array(F.struct(
            get(f"$.{part.role}", "string").alias("role"),
            get(f"$.{part.text}", "string").alias("text")))
    items = get(f"$.{part.list_name}", f"array<struct<`{part.role}`:string,`{part.text}`:string>>")

    def turn(item: Column) -> Column:
        role = item.getField(part.role)
        named = role
        for told, meant in part.roles.items():
            named = F.when(role == told, F.lit(meant)).otherwise(named)
        return F.struct(named.alias("role"), item.getField(part.text).alias("text"))

    return F.transform(items, turn)
