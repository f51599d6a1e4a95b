r"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record is a struct, or a JSON text read with :data:`RECORD`, in one of many
layouts: lists of messages, prompt and response, instruction, input and output,
and so on. A path of a known field is held if it has a value, one of a list if any of
its items has one. For each declarative mapping the held ones of the paths that it needs are hashed, and the
first mapping, in the order of :data:`MAPPINGS`, whose own fingerprint that is tells where the turns
are. So lists of messages go before pairs of fields that a record holds besides, and fields that no
mapping knows change nothing.

Turns are then written with a template whose control strings cannot occur inside
texts or roles: wherever a control string (``<|name|>``, ``<s>``, ``</s>``,
``[INST]``, ``[/INST]``) stands there, also with backslashes after its first
character, one more backslash goes after that character. Taking one away gives
back what was written. Each turn has its runs of characters: those before the text,
the text itself, and those after it, and whether the text counts for the loss,
which is so for assistants. Runs make the loss mask without a position per turn.

Null texts and roles are empty, also those of the first or of all items of a list; an item that is null
or has neither is no turn. Records of an unknown layout, null or malformed
ones have no turns, a null layout, and an empty format. Of turns with equal numbers
the one with the smaller role, then text, is first. A conversation becomes one
text, so all its turns meet in one row. An empty table gives no rows; extra columns
are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"

RECORD = (
    "messages array<struct<role string, content string>>, conversations array<struct<`from` string, value string>>, "
    "turns array<struct<speaker string, text string>>, system string, prompt string, response string, completion string, "
    "chosen string, instruction string, input string, output string, question string, context string, answer string"
)
# Names of roles in the layouts that differ from the canonical ones.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


class Each(NamedTuple):
    """A turn for every item of a list; ``rename`` puts canonical names for other roles."""

    list: str
    role: str
    text: str
    rename: bool = True


class One(NamedTuple):
    """A turn from fields that are joined by blank lines; none if they are all missing."""

    role: str
    fields: tuple[str, ...]


class Mapping(NamedTuple):
    """Turns of a layout; the paths ``needs`` must hold values, a list in any field of any item."""

    name: str
    needs: tuple[str, ...]
    turns: tuple[Each | One, ...]


MAPPINGS = (
    Mapping("messages", ("messages",), (One("system", ("system",)), Each("messages", "role", "content", rename=False))),
    Mapping("conversations", ("conversations",), (One("system", ("system",)), Each("conversations", "from", "value"))),
    Mapping("turns", ("turns",), (One("system", ("system",)), Each("turns", "speaker", "text"))),
    Mapping("prompt_response", ("prompt", "response"), (One("system", ("system",)), One("user", ("prompt",)), One("assistant", ("response",)))),
    Mapping("prompt_completion", ("prompt", "completion"), (One("system", ("system",)), One("user", ("prompt",)), One("assistant", ("completion",)))),
    Mapping("prompt_chosen", ("prompt", "chosen"), (One("system", ("system",)), One("user", ("prompt",)), One("assistant", ("chosen",)))),
    Mapping("instruction", ("instruction", "output"), (One("system", ("system",)), One("user", ("instruction", "input")), One("assistant", ("output",)))),
    Mapping("question", ("question", "answer"), (One("system", ("system",)), One("user", ("context", "question")), One("assistant", ("answer",)))),
)

_CONTROL = r"(\|[a-z_]+\|>|/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """One more backslash after the first character of each control string."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """What :func:`escape` was given."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def _kinds(df: DataFrame, record: str) -> dict[str, list[str]]:
    """Fields of the record, with those of the items if a field is a list of structs."""
    kind = df.schema[record].dataType
    return {
        f.name: [x.name for x in f.dataType.elementType.fields] if hasattr(f.dataType, "elementType") and hasattr(f.dataType.elementType, "fields") else []
        for f in kind.fields
    }


def _told(source: Each, item: Column) -> Column:
    """Whether an item of a list tells a turn."""
    return item[source.role].isNotNull() | item[source.text].isNotNull()


def _held(df: DataFrame, record: str, mapping: Mapping, path: str) -> Column:
    """Whether the record holds a value at the path."""
    value = F.col(record)[path]
    for source in mapping.turns:
        if isinstance(source, Each) and source.list == path:
            return F.exists(value, partial(_told, source))
    return value.isNotNull()


def fingerprint(df: DataFrame, record: str, mapping: Mapping) -> Column:
    """Hash of those of the paths that the mapping needs that hold a value in the record."""
    held = [F.when(F.coalesce(_held(df, record, mapping, p), F.lit(False)), F.lit(p)) for p in sorted(mapping.needs)]
    return F.xxhash64(F.array_compact(F.array(*held)))


def _role(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.element_at(known, F.coalesce(name, F.lit(""))), name, F.lit(""))


def canonical_turns(df: DataFrame, record: str, keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, layout, turns): the turns, (role, text), of each record, whatever its layout."""
    if df.schema[record].dataType.typeName() == "string":
        df = df.withColumn(record, F.from_json(record, RECORD))
    kinds = _kinds(df, record)

    def turn_of(source: Each):
        def turn(item: Column) -> Column:
            role = _role(item[source.role]) if source.rename else F.coalesce(item[source.role], F.lit(""))
            return F.struct(role.alias("role"), F.coalesce(item[source.text], F.lit("")).alias("text"))

        return turn

    def turns_of(m: Mapping) -> Column:
        parts = []
        for source in m.turns:
            if isinstance(source, Each):
                parts.append(F.transform(F.filter(F.col(record)[source.list], partial(_told, source)), turn_of(source)))
                continue
            fields = [F.col(record)[f] for f in source.fields if f in kinds]
            if fields:
                turn = F.struct(F.lit(source.role).alias("role"), F.concat_ws("\n\n", *fields).alias("text"))
                parts.append(F.array_compact(F.array(F.when(F.coalesce(*fields).isNotNull(), turn))))
        return F.concat(*parts)

    def known(m: Mapping) -> bool:
        inner = {source.list: {source.role, source.text} for source in m.turns if isinstance(source, Each)}
        return all(p in kinds and inner.get(p, set()) <= set(kinds[p]) for p in m.needs)

    found = F.lit(None).cast("int")
    for number, m in reversed(list(enumerate(MAPPINGS))):
        if known(m):
            own = F.xxhash64(F.array(*[F.lit(p) for p in sorted(m.needs)]))
            found = F.when(fingerprint(df, record, m) == own, F.lit(number)).otherwise(found)
    marked = df.withColumn("_layout", found)
    none = F.array().cast("array<struct<role string, text string>>")
    turns, name = none, F.lit(None).cast("string")
    for number, m in enumerate(MAPPINGS):
        if known(m):
            here = F.col("_layout") == number
            turns, name = F.when(here, turns_of(m)).otherwise(turns), F.when(here, F.lit(m.name)).otherwise(name)
    return marked.select(*keep, name.alias("layout"), turns.alias("turns"))


def formatted(df: DataFrame) -> DataFrame:
    """Add ``formatted`` and its loss mask ``runs`` (head, body, tail, loss of each turn) for ``turns``."""
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"), escape(t["text"]).alias("body"), F.lit(f"{END}\n").alias("tail"), (t["role"] == LOSS_ROLE).alias("loss")
        ),
    )
    return (
        df.withColumn("_parts", parts)
        .withColumn("formatted", F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], p["tail"])), ""))
        .withColumn(
            "runs",
            F.transform(
                "_parts",
                lambda p: F.struct(*[F.length(p[c]).alias(c) for c in ("head", "body", "tail")], p["loss"].alias("loss")),
            ),
        )
        .drop("_parts")
    )


def read_back(df: DataFrame) -> DataFrame:
    """Add ``turns_read``, parsed from ``formatted`` alone, and ``loss_texts``, what the mask covers."""
    pieces = F.filter(F.split("formatted", F.lit(r"<\|turn\|>")), lambda p: p != "")
    parse = lambda p: F.struct(
        unescape(F.substring_index(p, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, END, 1), TEXT, -1)).alias("text"),
    )
    covered = F.zip_with(
        "_pieces",
        "runs",
        lambda p, r: F.when(r["loss"], unescape(F.substring(p, r["head"] - len(TURN) + 1, r["body"]))),
    )
    return (
        df.withColumn("_pieces", pieces)
        .withColumn("turns_read", F.transform("_pieces", parse))
        .withColumn("loss_texts", F.array_compact(covered))
        .drop("_pieces")
    )


def records_of_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, record) in the layout of messages, from one row per turn (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    messages = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return rows.groupBy("conv_id").agg(messages.alias("messages")).select("conv_id", F.struct("messages").alias("record"))


def format_records(df: DataFrame, record: str, keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, layout, turns, formatted, runs) of records in any layout."""
    return formatted(canonical_turns(df, record, keep))
