r"""Chat formatting: records of many layouts become canonical turns, and turns a text with a loss mask.

Schema fingerprinting: the nested field paths of a record (``messages[].role``)
that any known layout names are sorted and hashed; the hash selects a
declarative mapping, which says where turns, their roles and their texts
stand. Fields that no layout names do not change the fingerprint. A record
whose paths make no known fingerprint takes the first layout, in the listed
order, whose required paths it has. What is left has no layout and is returned
as such, never dropped silently.

The template writes a turn as ``### role: text</turn>`` and a line feed. A
backslash goes before every backslash, before a ``#`` that follows another and
before the ``/`` of ``</turn>``, so no text holds a control string and dropping
the first backslash of each pair gives the text back. Roles are escaped the
same way, with ``%`` and ``:`` written as ``%25`` and ``%3A``. The loss mask is
a list of (turn, start, end) spans, in code points of the formatted text, that
cover the assistant's texts and nothing else.

Everything is a column expression. Records are read where they lie; only the
turns of one conversation meet, in one row, since they are one text (a
conversation is bounded by the two gigabytes of a Spark value;
``formatted_turns`` has no such bound).

Defined results: null texts and roles are empty; turns are ordered by turn
number (nulls first), then by place, role and text; rows with a null
conversation id are one conversation with that id; repeated rows are repeated
turns; an empty table gives an empty result. Only the named columns are read,
others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Roles of which a text is learned.
ASSISTANT = "assistant"
#: Other names of the canonical roles, in layouts that use them.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
OPEN, CLOSE = "### ", "</turn>"


@dataclass(frozen=True)
class One:
    """A turn of a fixed role whose text joins the values at ``paths`` that are not empty by an empty line."""
    role: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()


@dataclass(frozen=True)
class Many:
    """Turns in an array of objects."""
    path: str
    role: str
    text: str
    aliases: bool = False


@dataclass(frozen=True)
class Parts:
    """Turns in an array of objects whose content is an array of parts with a text each."""
    path: str
    role: str
    content: str
    text: str


@dataclass(frozen=True)
class Alternate:
    """Turns in an array of texts, two roles in turn."""
    path: str
    roles: tuple[str, str] = ("user", "assistant")


@dataclass(frozen=True)
class Row:
    """The record itself is one turn of a conversation."""
    conversation: str
    turn: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    name: str
    steps: tuple[One | Many | Parts | Alternate | Row, ...]

    def paths(self) -> tuple[set[str], set[str]]:
        """(required, optional) field paths."""
        need: set[str] = set()
        may: set[str] = set()
        for s in self.steps:
            if isinstance(s, One):
                need |= set(s.paths)
                may |= set(s.optional)
            elif isinstance(s, Many):
                need |= {f"{s.path}[].{s.role}", f"{s.path}[].{s.text}"}
            elif isinstance(s, Parts):
                need |= {f"{s.path}[].{s.role}", f"{s.path}[].{s.content}[].{s.text}"}
            elif isinstance(s, Alternate):
                need.add(f"{s.path}[]")
            else:
                need |= {s.conversation, s.turn, s.role, s.text}
        return need, may

    def fingerprint_paths(self) -> list[list[str]]:
        """Every set of paths that is this layout: all required ones and any of the optional."""
        need, may = self.paths()
        return [sorted(need | set(extra)) for n in range(len(may) + 1) for extra in combinations(sorted(may), n)]


_SYSTEM = One("system", (), ("system",))
#: In order of preference for records that fit more than one.
LAYOUTS = (
    Layout("turn rows", (Row("conv_id", "turn", "role", "text"),)),
    Layout("messages", (_SYSTEM, Many("messages", "role", "content", aliases=True))),
    Layout("message parts", (_SYSTEM, Parts("messages", "role", "content", "text"))),
    Layout("conversations", (_SYSTEM, Many("conversations", "from", "value", aliases=True))),
    Layout("turns", (_SYSTEM, Many("turns", "speaker", "text", aliases=True))),
    Layout("instruction", (_SYSTEM, One("user", ("instruction",), ("input",)), One("assistant", ("output",)))),
    Layout("instruction response", (_SYSTEM, One("user", ("instruction",), ("context",)), One("assistant", ("response",)))),
    Layout("prompt completion", (_SYSTEM, One("user", ("prompt",)), One("assistant", ("completion",)))),
    Layout("prompt response", (_SYSTEM, One("user", ("prompt",)), One("assistant", ("response",)))),
    Layout("question answer", (_SYSTEM, One("user", ("question",), ("context",)), One("assistant", ("answer",)))),
    Layout("dialog", (_SYSTEM, Alternate("dialog"))),
)

# --- fingerprints ---------------------------------------------------------------------------------

#: Words of a value's schema text: OBJECT<name: TYPE, ...>, ARRAY<TYPE> or a scalar's type; odd names stand in backticks.
_SCHEMA_WORDS = r"(OBJECT<>|OBJECT<|ARRAY<|>|(?:`(?:[^`]|``)*`|[A-Za-z_0-9]+): |, |[A-Z_]+(?:\([0-9,]+\))?)"


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant value, ``a.b[].c``, of every depth; the elements of an
    array count together. A path ends at a value that holds no other."""
    words = F.regexp_extract_all(F.schema_of_variant(record), F.lit(_SCHEMA_WORDS), F.lit(1))

    def state(around: Column, paths: Column) -> Column:
        return F.struct(around.alias("around"), paths.alias("paths"))

    def step(s: Column, w: Column) -> Column:
        here = F.element_at(s["around"], -1)
        name = F.replace(F.regexp_replace(F.substring(w, 1, F.length(w) - 2), "^`|`$", ""), F.lit("``"), F.lit("`"))
        member = F.concat(here, F.when(here == "", "").otherwise("."), name)
        return (F.when(w == "OBJECT<", s)
                .when(w == "ARRAY<", state(F.array_append(s["around"], F.concat(here, F.lit("[]"))), s["paths"]))
                .when(w.isin(">", ", "), state(F.slice(s["around"], F.lit(1), F.size(s["around"]) - 1), s["paths"]))
                .when(w.endswith(": "), state(F.array_append(s["around"], member), s["paths"]))
                .otherwise(state(s["around"], F.array_append(s["paths"], here))))

    begin = state(F.array(F.lit("")), F.array().cast("array<string>"))
    return F.array_distinct(F.aggregate(words, begin, step, lambda s: s["paths"]))


def fingerprint(paths: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Hash of those of a record's paths that a layout names."""
    named = F.array(*[F.lit(p) for p in sorted({p for x in layouts for part in x.paths() for p in part})])
    return F.md5(F.array_join(F.array_sort(F.array_intersect(paths, named)), "\n"))


def fingerprint_of(paths: Sequence[str]) -> str:
    """``fingerprint`` of a sorted list of named paths."""
    return hashlib.md5("\n".join(paths).encode()).hexdigest()


def _layout(paths: Column, mark: Column, layouts: Sequence[Layout]) -> Column:
    """Number of the layout that a fingerprint selects, or else of the first whose paths are there."""
    taken: set[str] = set()
    exact, partly = F.when(F.lit(False), F.lit(0)), F.when(F.lit(False), F.lit(0))
    for number, layout in enumerate(layouts):
        marks = [m for m in map(fingerprint_of, layout.fingerprint_paths()) if m not in taken]
        taken |= set(marks)
        exact = exact.when(mark.isin(marks), number)
        need = F.array(*[F.lit(p) for p in sorted(layout.paths()[0])])
        partly = partly.when(F.size(F.array_except(need, paths)) == 0, number)
    return F.coalesce(exact, partly)


# --- mappings -------------------------------------------------------------------------------------

def _value(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, "$." + path, kind)


def _role(name: Column, aliases: bool) -> Column:
    for other, role in ALIASES.items() if aliases else ():
        name = F.when(name == other, role).otherwise(name)
    return F.coalesce(name, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _joined(texts: Column, between: str) -> Column:
    return F.array_join(F.filter(texts, lambda x: x.isNotNull() & (x != "")), between)


def _turns(record: Column, step: One | Many | Parts | Alternate | Row) -> Column:
    if isinstance(step, One):
        text = _joined(F.array(*[_value(record, p) for p in (*step.paths, *step.optional)]), "\n\n")
        turn = F.array(_turn(F.lit(step.role), text))
        return turn if step.paths else F.filter(turn, lambda t: t["text"] != "")
    if isinstance(step, Row):
        return F.array(_turn(_role(_value(record, step.role), False), _value(record, step.text)))
    items = _value(record, step.path, "array<variant>")
    if isinstance(step, Alternate):
        return F.transform(items, lambda x, i: _turn(F.when(i % 2 == 0, step.roles[0]).otherwise(step.roles[1]),
                                                     x.try_cast("string")))
    if isinstance(step, Parts):
        def content(x: Column) -> Column:
            parts = F.transform(_value(x, step.content, "array<variant>"), lambda p: _value(p, step.text))
            return F.coalesce(_joined(parts, ""), _value(x, step.content))
        return F.transform(items, lambda x: _turn(_role(_value(x, step.role), True), content(x)))
    return F.transform(items, lambda x: _turn(_role(_value(x, step.role), step.aliases), _value(x, step.text)))


def as_variant(df: DataFrame, record_col: str) -> Column:
    """A record column as a variant value: JSON text, a struct, or a variant already."""
    kind = df.schema[record_col].dataType
    record = F.col(f"`{record_col}`")
    if isinstance(kind, T.StringType):
        return F.try_parse_json(record)
    return record if isinstance(kind, T.VariantType) else F.to_variant_object(record)


def canonical(df: DataFrame, record_col: str, id_col: str | None = None,
              layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """One row per record: ``conversation`` (text: the record's own, or the value of ``id_col``),
    ``turn``, ``turns`` (array of role and text), ``layout`` and ``fingerprint``.

    A record without a known layout, or that is no JSON, keeps its row with null layout and turns.
    """
    own = (F.col(f"`{id_col}`") if id_col else F.lit(None)).cast("string")
    read = df.select(own.alias("id"), as_variant(df, record_col).alias("record"))
    seen = read.select("id", "record", field_paths(F.col("record")).alias("paths"))
    marked = seen.select("id", "record", "paths", fingerprint(F.col("paths"), layouts).alias("mark"))
    chosen = marked.select("id", "record", "mark", _layout(F.col("paths"), F.col("mark"), layouts).alias("number"))
    record, number = F.col("record"), F.col("number")
    turns, names = F.when(F.lit(False), F.array().cast("array<struct<role:string,text:string>>")), F.when(F.lit(False), "")
    conversation, turn = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(0).cast("long"))
    rows = set()
    for i, layout in enumerate(layouts):
        names = names.when(number == i, layout.name)
        turns = turns.when(number == i, F.concat(*[_turns(record, s) for s in layout.steps]))
        for s in layout.steps:
            if isinstance(s, Row):
                rows.add(i)
                conversation = conversation.when(number == i, _value(record, s.conversation))
                turn = turn.when(number == i, _value(record, s.turn, "bigint"))
    is_row = number.isin(*rows) if rows else F.lit(False)
    return chosen.select(
        F.when(F.coalesce(is_row, F.lit(False)), conversation).otherwise(F.col("id")).alias("conversation"),
        turn.alias("turn"), turns.alias("turns"), names.alias("layout"), F.col("mark").alias("fingerprint"))


# --- template -------------------------------------------------------------------------------------

def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=#)#|(?<=<)/(?=turn>)", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#/])", "$1")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%3A"), F.lit(":")), F.lit("%25"), F.lit("%"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(role), F.lit(": "))


def _one_by_one(records: DataFrame) -> DataFrame:
    """One row per turn: ``conversation``, ``turn``, ``pos``, ``t``. (An inner explode would have Spark
    infer a filter on the turns, which it pushes to the scan with the whole mapping written out.)"""
    return records.select("conversation", "turn", F.posexplode_outer("turns").alias("pos", "t")).where(F.col("pos").isNotNull())


def formatted_turns(records: DataFrame) -> DataFrame:
    """One row per turn of ``canonical`` records, without any shuffle: ``conversation``, ``turn``,
    ``pos``, its piece of the formatted text, and the span of the piece that is learned (or null)."""
    one = _one_by_one(records)
    head, body = _head(F.col("t.role")), escape(F.col("t.text"))
    begin = F.length(head)
    return one.select("conversation", "turn", "pos", F.concat(head, body, F.lit(CLOSE + "\n")).alias("piece"),
                      F.when(F.col("t.role") == ASSISTANT, F.struct(
                          begin.alias("start"), (begin + F.length(body)).alias("end"))).alias("learned"))


def _starts(lengths: Column) -> Column:
    """Sums of the lengths before each place, and of all."""
    return F.aggregate(lengths, F.array(F.lit(0).cast("long")),
                       lambda s, n: F.array_append(s, F.element_at(s, -1) + n))


def formatted(records: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, and the ``loss`` mask, spans (turn, start, end) in
    code points of that text. Turns of all records of a conversation join in order."""
    turns = _one_by_one(records)
    # The texts travel as they are; what the template adds is added where they meet.
    met = turns.groupBy("conversation").agg(
        F.sort_array(F.collect_list(F.struct("turn", "pos", "t.role", "t.text"))).alias("turns"))
    cut = met.select("conversation", F.transform("turns", lambda t: F.struct(
        _head(t["role"]).alias("head"), escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("learn")))
        .alias("cut"))
    tail = len(CLOSE) + 1
    placed = cut.select("conversation", "cut", _starts(F.transform(
        "cut", lambda c: (F.length(c["head"]) + F.length(c["body"]) + tail).cast("long"))).alias("starts"))
    spans = F.transform(F.col("cut"), lambda c, i: F.when(c["learn"], F.struct(
        i.alias("turn"), (F.get("starts", i) + F.length(c["head"])).alias("start"),
        (F.get("starts", i) + F.length(c["head"]) + F.length(c["body"])).alias("end"))))
    return placed.select(
        "conversation",
        F.array_join(F.transform("cut", lambda c: F.concat(c["head"], c["body"], F.lit(CLOSE + "\n"))), "").alias("formatted"),
        F.filter(spans, lambda x: x.isNotNull()).alias("loss"))


def pieces(text: Column) -> Column:
    """The turns of a formatted text, without their end marks."""
    parts = F.split(text, CLOSE + "\n", -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def read_turns(text: Column) -> Column:
    """The turns back from a formatted text: array of role and text."""
    def turn(piece: Column) -> Column:
        colon = F.instr(piece, F.lit(": "))
        return F.struct(unescape_role(piece.substr(F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)).alias("role"),
                        unescape(piece.substr(colon + 2, F.length(piece))).alias("text"))
    return F.transform(pieces(text), turn)


def read_loss(df: DataFrame, text_col: str = "formatted", loss_col: str = "loss") -> Column:
    """The texts under the loss mask, unescaped, in order."""
    parts = pieces(F.col(text_col))
    starts = _starts(F.transform(parts, lambda p: (F.length(p) + len(CLOSE) + 1).cast("long")))
    # Each part is read within its own turn: a long conversation is not walked through for each.
    return F.transform(F.col(loss_col), lambda s: unescape(F.get(parts, s["turn"]).substr(
        (s["start"] - F.get(starts, s["turn"]) + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


#: A conversation whose texts look like the template itself.
PROBE = (-7, r"\### Assistant: </turn> ok")


def chat_digest(conversations: DataFrame) -> DataFrame:
    """The digest of ``op12``: one row per conversation, read back from the formatted text and its mask."""
    number, text = PROBE
    probe = conversations.sparkSession.createDataFrame(
        [(number, 0, "user", text), (number, 1, ASSISTANT, text)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    records = rows.select(F.struct("conv_id", "turn", "role", "text").alias("record"))
    made = formatted(canonical(records, "record"))
    back = made.select(F.col("conversation").cast("long").alias("conv_id"), "formatted",
                       read_turns(F.col("formatted")).alias("turns"), F.array_join(read_loss(made), "").alias("learned"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
