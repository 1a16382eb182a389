"""Chat formatting by schema fingerprints (operator 2), in DataFrame functions only.

Conversations come in many layouts: message lists, prompt and response,
instruction with input and output, dialogues of strings. A record's fingerprint
hashes its nested field paths, those that hold anything. A declarative mapping
lists a layout's paths, required and optional, and says how its turns come from
them; a record gets the mapping whose fingerprint it has. Records of no known
layout keep their fingerprint and have no turns.

The template gives each turn as `<|im_start|>ROLE\nTEXT<|im_end|>\n`. Inside roles and
texts, `~` becomes `~0` and a control string loses its first character to `~1` (for
`<`) or `~2` (for `[`); a line break in a role becomes `~3`. So no control string is
left inside a text, and unescaping restores every text exactly.

Defined results: null text and null role are empty. Turns with the same number go
by role, then text; a null turn number comes first. Repeated rows are turns of their
own. Rows with a null conversation id are one conversation. A conversation is one
output string, so it must fit one row, as it does in the output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that steer some chat model; none may be left inside a text.
CONTROLS = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: The role whose texts are trained on.
TRAINED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def _pattern(first: str) -> str:
    own = [c[1:] for c in CONTROLS if c[0] == first]
    plain = [c.replace("|", "\\|").replace("[", "\\[").replace("]", "\\]") for c in own]
    return ("\\[" if first == "[" else first) + "(?=" + "|".join(plain) + ")"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("~"), F.lit("~0"))
    return F.regexp_replace(F.regexp_replace(out, _pattern("<"), "~1"), _pattern("["), "~2")


def unescape(text: Column) -> Column:
    for code, plain in (("~1", "<"), ("~2", "["), ("~3", "\n"), ("~0", "~")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


@dataclass(frozen=True)
class Mapping:
    """How the turns of one layout come from its fields."""

    name: str
    required: tuple[str, ...]
    turns: Callable[[DataFrame], Column]
    optional: tuple[str, ...] = ()

    def paths(self) -> list[tuple[str, ...]]:
        some = chain.from_iterable(combinations(self.optional, k) for k in range(len(self.optional) + 1))
        return [tuple(sorted(self.required + x)) for x in some]


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"))


def _messages(column: str, role: str, text: str) -> Callable[[DataFrame], Column]:
    names = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

    def turns(df: DataFrame) -> Column:
        def one(m: Column) -> Column:
            own = m[role].cast("string")
            kind = F.coalesce(*[F.when(F.lower(own) == k, F.lit(v)) for k, v in names.items()], own) if (role, text) != ("role", "text") else own
            return F.struct(kind.alias("role"), m[text].cast("string").alias("text"))

        return F.transform(F.col(column), one)

    return turns


def _pair(prompt: str, answer: str, system: str | None = None) -> Callable[[DataFrame], Column]:
    def turns(df: DataFrame) -> Column:
        first = [F.when(F.col(system).isNotNull(), _turn("system", F.col(system)))] if system and system in df.columns else []
        return F.array_compact(F.array(*first, _turn("user", F.col(prompt)), _turn("assistant", F.col(answer))))

    return turns


def _instruction(df: DataFrame) -> Column:
    more = F.when(F.length("input") > 0, F.concat(F.lit("\n\n"), F.col("input"))) if "input" in df.columns else F.lit(None)
    return F.array(_turn("user", F.concat(F.col("instruction"), F.coalesce(more, F.lit("")))), _turn("assistant", F.col("output")))


def _dialogue(df: DataFrame) -> Column:
    return F.transform("dialog", lambda x, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), x.cast("string").alias("text")))


#: Known layouts.
MAPPINGS = [
    Mapping("turns", ("turns", "turns[].role"), _messages("turns", "role", "text"), ("turns[].text",)),
    Mapping("messages", ("messages", "messages[].role"), _messages("messages", "role", "content"), ("messages[].content",)),
    Mapping("conversations", ("conversations", "conversations[].from"), _messages("conversations", "from", "value"), ("conversations[].value",)),
    Mapping("prompt", ("prompt",), _pair("prompt", "response", "system"), ("response", "system")),
    Mapping("question", ("question",), _pair("question", "answer", "system"), ("answer", "system")),
    Mapping("instruction", ("instruction",), _instruction, ("input", "output")),
    Mapping("dialog", ("dialog",), _dialogue),
]


def _field(name: str, has: Callable[[Column], Column] = F.isnotnull) -> Callable[[Column], Column]:
    return lambda value: has(value[name])


def _any(has: Callable[[Column], Column], values: Callable[[Column], Column] = lambda v: v) -> Callable[[Column], Column]:
    return lambda value: F.exists(values(value), lambda x: has(x))


def _below(kind: T.DataType) -> list[tuple[str, Callable[[Column], Column]]]:
    """Every path below a value of this type, and whether a value holds it: of arrays and maps, in any element or value."""
    if isinstance(kind, T.StructType):
        own = [(f".{f.name}", _field(f.name)) for f in kind.fields]
        return own + [(f".{f.name}{path}", _field(f.name, has)) for f in kind.fields for path, has in _below(f.dataType)]
    if isinstance(kind, T.ArrayType):
        return [(f"[]{path}", _any(has)) for path, has in _below(kind.elementType)]
    if isinstance(kind, T.MapType):
        return [(f"{{}}{path}", _any(has, F.map_values)) for path, has in _below(kind.valueType)]
    return []


def _leaves(schema: T.StructType) -> list[tuple[str, Column]]:
    """Every nested field path of a schema, with whether a record holds it."""
    out: list[tuple[str, Column]] = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        out.append((f.name, value.isNotNull()))
        out += [(f.name + path, has(value)) for path, has in _below(f.dataType)]
    return out


def fingerprint(df: DataFrame, known: set[str] | None = None) -> Column:
    """The hash of the sorted paths that a record holds. known: only these paths count (ids, sources and the like say nothing about a layout)."""
    held = [F.when(has, F.lit(path)) for path, has in sorted(_leaves(df.schema), key=lambda x: x[0]) if known is None or path in known]
    return F.xxhash64(F.array_join(F.array_compact(F.array(*held)), "\n")) if held else F.xxhash64(F.lit(""))


def canonical_turns(df: DataFrame, mappings: list[Mapping] | None = None) -> DataFrame:
    """df with three more columns: fingerprint, layout and turns_ (array of role and text) of each record, renamed if df has these names; layout and turns are null for no known layout."""
    mappings = MAPPINGS if mappings is None else mappings
    paths = {p for m in mappings for p in (*m.required, *m.optional)}
    have = {p for p, _ in _leaves(df.schema)}
    print_, layout, turns, own_print = fingerprint(df, paths), None, None, fresh(df, "fingerprint")
    for m in mappings:
        if not set(m.required) <= have or not _usable(m, have):
            continue
        same = None
        for own in m.paths():
            if set(own) <= have:
                one = F.col(own_print) == F.xxhash64(F.lit("\n".join(own)))
                same = one if same is None else same | one
        layout = (layout if layout is not None else F).when(same, F.lit(m.name))
        turns = (turns if turns is not None else F).when(same, m.turns(df).cast(TURNS))
    none = F.lit(None)
    named = df.withColumn(own_print, print_)
    return named.select("*", (layout if layout is not None else none).cast("string").alias(fresh(df, "layout")), (turns if turns is not None else none).cast(TURNS).alias(fresh(df, "turns_")))


def _usable(m: Mapping, have: set[str]) -> bool:
    """The mapping's fields are in the schema as far as its turns need them."""
    return not any(p.count("[]") and p not in have for p in m.optional) and all(p in have for p in m.optional if p in ("response", "answer", "output"))


def render(turns: Column) -> Column:
    """The formatted conversation."""

    def one(t: Column) -> Column:
        role = F.replace(escape(t["role"]), F.lit("\n"), F.lit("~3"))
        return F.concat(F.lit(START), role, F.lit("\n"), escape(t["text"]), F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def loss_spans(formatted: Column) -> Column:
    """(start, length) in code points of what is trained on: the escaped text of each assistant turn."""
    head = len(START)
    pieces = F.slice(F.split(formatted, START.replace("|", "\\|")), 2, F.size(F.split(formatted, START.replace("|", "\\|"))))

    def step(acc: Column, p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        start = acc["at"] + head + F.length(role) + 1
        span = F.struct(start.cast("long").alias("start"), (F.length(p) - F.length(role) - 1 - len(END) - 1).cast("long").alias("length"))
        return F.struct((acc["at"] + head + F.length(p)).cast("long").alias("at"), F.when(role == TRAINED, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return F.aggregate(pieces, zero, step, lambda acc: acc["spans"])


def parse(formatted: Column) -> Column:
    """The turns that a formatted conversation holds, unescaped."""
    pieces = F.split(formatted, START.replace("|", "\\|"))

    def one(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - len(END) - 1)
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), one)


def gather_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_col, turns) from rows by turn."""
    row = F.struct(F.col(turn_col).alias("n"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = F.transform(F.array_sort(F.collect_list(row), _in_order), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return rows.groupBy(conv_col).agg(ordered.alias("turns"))


def _in_order(x: Column, y: Column) -> Column:
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def format_chat(records: DataFrame, mappings: list[Mapping] | None = None) -> DataFrame:
    """records with four more columns: fingerprint, layout, formatted and loss_spans, renamed if records has these names; formatted is null for no known layout."""
    named = canonical_turns(records, mappings)
    text, spans = fresh(records, "formatted"), fresh(records, "loss_spans")
    shown = named.withColumn(text, render(F.col(f"`{named.columns[-1]}`"))).drop(named.columns[-1])
    return shown.withColumn(spans, loss_spans(F.col(text)))


def format_report(rows: DataFrame) -> DataFrame:
    """A row for each conversation, read back from its formatted text and loss mask: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    shown = format_chat(gather_turns(rows))
    back = shown.withColumn("back", parse(F.col("formatted"))).withColumn("masked", F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))))
    loss = F.array_join("masked", "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
