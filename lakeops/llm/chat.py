"""Chat formatting by schema fingerprint.

Records come in many layouts: one row a turn, a list of messages, a prompt with a
response, an instruction with an input. The paths of a record's nested fields are
hashed; the hash selects a declarative mapping, and the mapping names the paths that
hold the turns. Canonical turns are written by one template, whose control strings
are escaped where a text contains them, and can be read back from the result.

Everything here is built from Spark's own functions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.frames import named

# the template's control strings; a text's own are escaped
BEGIN, USER, USER_END, END = "<s>", "[INST]", "[/INST]", "</s>"
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
MARKED = r"([<\[])(/?INST\]|/?ROLE\]|/?s>|</?SYS>>)"

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``paths`` are the dotted paths of its fields, lists as ``[]``. ``messages`` is the
    path of a list whose items have a ``role`` and a ``text`` field; without it, each of
    ``turns`` is a role and the path of its text. ``turn`` orders rows that are one turn
    each, gathered by ``conversation``.
    """

    name: str
    paths: tuple[str, ...]
    messages: str | None = None
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, str], ...] = ()
    conversation: str | None = None
    turn: str | None = None


#: the layouts known, and the names their roles go by
MAPPINGS = (
    Mapping("turn rows", ("conv_id", "role", "text", "turn"), role="role", text="text", conversation="conv_id", turn="turn"),
    Mapping("messages", ("messages[].content", "messages[].role"), "messages", "role", "content"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    Mapping("prompt and response", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt and completion", ("completion", "prompt"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system, prompt and response", ("prompt", "response", "system"),
            turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", ("input", "instruction", "output"),
            turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction without input", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    """The hash of a set of nested field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The dotted paths of the leaf fields of a type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def mapping_for(schema: T.StructType, mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping:
    """The mapping whose fingerprint a frame has; columns that no mapping names are extra.

    All columns are tried first, and then the largest set of paths that is contained in
    the frame's: its fingerprint is that of the frame without its extra columns.
    """
    known = {fingerprint(m.paths): m for m in mappings}
    paths = set(schema_paths(schema))
    if found := known.get(fingerprint(paths)):
        return found
    inside = [m for m in mappings if paths.issuperset(m.paths)]
    if not inside:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")
    return known[fingerprint(max(inside, key=lambda m: len(m.paths)).paths)]


def _role(role: Column) -> Column:
    low = F.lower(F.coalesce(role, F.lit("")))
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.element_at(known, low), F.coalesce(role, F.lit("")))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _messages(items: Column, m: Mapping) -> Column:
    return F.transform(items, lambda x: _turn(_role(x[m.role]), x[m.text]))


def canonical(df: DataFrame, keys: list[str] | None = None, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``keys`` and ``turns``, a list of role and text, of every conversation.

    The layout's fingerprint selects the mapping. Rows of one turn each are gathered by
    the mapping's conversation column, which then is the key, in the order of turn, role
    and text; rows with a null conversation are one conversation with a null key, and a
    null turn comes first. A conversation's turns are one value, so they meet in one
    task. Null texts and roles are empty; a record's null or empty optional turns (all
    but user and assistant, and an empty second user turn) are left out.
    """
    m = mapping_for(df.schema, mappings)
    if m.conversation:
        entry = F.struct(
            named(m.turn).alias("turn"), F.coalesce(named(m.role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(named(m.text).cast("string"), F.lit("")).alias("text"),
        )
        gathered = df.groupBy(named(m.conversation).alias(m.conversation)).agg(F.sort_array(F.collect_list(entry)).alias("turns"))
        return gathered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"], t["text"])))
    keys = keys or []
    if m.messages:
        items = F.coalesce(F.col(m.messages), F.array().cast(df.schema[m.messages].dataType))
        turns = _messages(items, m)
    else:
        entries = []
        for i, (role, path) in enumerate(m.turns):
            turn = _turn(F.lit(role), F.col(path))
            optional = role == "system" or i and m.turns[i - 1][0] == role
            entries.append(F.when(F.length(F.col(path)) > 0, F.array(turn)).otherwise(F.array().cast(T.ArrayType(TURN))) if optional else F.array(turn))
        turns = F.concat(*entries)
    return df.select(*[named(k) for k in keys], turns.alias("turns"))


def json_paths(column: Column) -> Column:
    """The leaf paths of a JSON text as one string, one per line; null where it is no JSON object.

    Spark names the schema of each value; its leaf types are taken out, so two records
    of one layout agree although their values' types differ.
    """
    schema = F.schema_of_variant(F.try_parse_json(column))
    return F.regexp_replace(schema, r"\b(STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\(\d+,\d+\)|DATE|TIMESTAMP|TIMESTAMP_NTZ|FLOAT|BINARY|UUID)\b", "_")


def _variant_form(paths: tuple[str, ...]) -> str:
    """The string that ``json_paths`` gives for a layout of top-level fields and lists of records."""
    top: dict[str, list[str]] = {}
    for p in sorted(paths):
        head, _, inner = p.partition("[].")
        top.setdefault(head, [])
        if inner:
            top[head].append(inner)
    inner = lambda names: "ARRAY<OBJECT<" + ", ".join(f"{n}: _" for n in sorted(names)) + ">>"
    return "OBJECT<" + ", ".join(f"{k}: {inner(v) if v else '_'}" for k, v in sorted(top.items())) + ">"


def canonical_json(df: DataFrame, column: str, keys: list[str], mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``keys``, ``layout`` and ``turns`` of rows that each hold one JSON record of any layout.

    Each row's field paths are hashed and the hash selects the mapping for the row. A
    record that is null, no JSON or of no known layout has a null layout and no turns.
    """
    one_row = [m for m in mappings if not m.conversation]
    value = F.try_parse_json(named(column))
    hashed = F.xxhash64(json_paths(named(column)))
    layout, turns = F.lit(None).cast("string"), F.array().cast(T.ArrayType(TURN))
    for m in one_row:
        if m.messages:
            items = F.try_variant_get(value, f"$.{m.messages}", f"array<struct<{m.role}:string,{m.text}:string>>")
            found = _messages(F.coalesce(items, F.array().cast(f"array<struct<{m.role}:string,{m.text}:string>>")), m)
        else:
            entries = []
            for i, (role, path) in enumerate(m.turns):
                text = F.try_variant_get(value, f"$.{path}", "string")
                optional = role == "system" or i and m.turns[i - 1][0] == role
                turn = F.array(_turn(F.lit(role), text))
                entries.append(F.when(F.length(text) > 0, turn).otherwise(F.array().cast(T.ArrayType(TURN))) if optional else turn)
            found = F.concat(*entries)
        same = hashed == F.xxhash64(F.lit(_variant_form(m.paths)))
        layout, turns = F.when(same, F.lit(m.name)).otherwise(layout), F.when(same, found).otherwise(turns)
    return df.select(*[named(k) for k in keys], layout.alias("layout"), turns.alias("turns"))


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put behind the first character of each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), MARKED, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(df: DataFrame, turns: str = "turns") -> DataFrame:
    """``df`` with ``formatted``, the conversation by the template, and its loss ``mask``.

    A user's text stands between ``[INST] `` and `` [/INST]``, an assistant's before
    `` </s>``, a system's in ``<<SYS>>``, any other role's name and text in ``[ROLE]``.
    ``mask`` has a list for the beginning and for each turn: how many code points are
    alike, in order, and whether the loss counts them. It counts the assistants' texts
    alone. Null turns are none. Columns of these names give way.
    """
    run = lambda s, loss=False: F.struct(s.alias("text"), F.lit(loss).alias("loss"))

    def parts(t: Column) -> Column:
        text = escaped(t["text"])
        return F.when(t["role"] == "user", F.array(run(F.concat(F.lit(f"{USER} "), text, F.lit(f" {USER_END}"))))).when(
            t["role"] == "assistant", F.array(run(F.lit(" ")), run(text, True), run(F.lit(f" {END}")))
        ).when(
            t["role"] == "system", F.array(run(F.concat(F.lit(f"{SYSTEM} "), text, F.lit(f" {SYSTEM_END}"))))
        ).otherwise(F.array(run(F.concat(
            F.lit(f"{ROLE} "), escaped(t["role"]), F.lit(f" {ROLE} "), text, F.lit(f" {ROLE_END}")
        ))))

    listed = F.coalesce(named(turns), F.array().cast(T.ArrayType(TURN)))
    runs = F.concat(F.array(F.array(run(F.lit(BEGIN)))), F.transform(listed, parts))
    made = df.withColumn("mask", runs)
    whole = F.array_join(F.transform(F.flatten("mask"), lambda r: r["text"]), "")
    lengths = F.transform("mask", lambda x: F.transform(x, lambda r: F.struct(F.length(r["text"]).alias("chars"), r["loss"].alias("loss"))))
    return made.withColumn("formatted", whole).withColumn("mask", lengths)


#: one turn of a formatted conversation; a control string cannot stand inside a text
_READ = (
    r"(?s)\[INST\] .*? \[/INST\]|<<SYS>> .*? <</SYS>>|\[ROLE\] .*? \[ROLE\] .*? \[/ROLE\]| .*? </s>"
)


def _written_turns(written: Column) -> Column:
    return F.regexp_extract_all(F.substring(written, F.lit(len(BEGIN) + 1), F.length(written)), F.lit(_READ), F.lit(0))


def read_back(written: Column) -> Column:
    """The turns, a list of role and text, of a formatted conversation."""
    between = f" {ROLE} "

    def turn(s: Column) -> Column:
        def inner(begin: str, end: str) -> Column:
            return F.substring(s, F.lit(len(begin) + 1), F.length(s) - len(begin) - len(end))
        other = inner(f"{ROLE} ", f" {ROLE_END}")
        role = F.when(s.startswith(f"{USER} "), "user").when(s.startswith(f"{SYSTEM} "), "system").when(
            s.startswith(f"{ROLE} "), unescaped(F.substring_index(other, between, 1))
        ).otherwise("assistant")
        text = F.when(s.startswith(f"{USER} "), inner(f"{USER} ", f" {USER_END}")).when(
            s.startswith(f"{SYSTEM} "), inner(f"{SYSTEM} ", f" {SYSTEM_END}")
        ).when(
            s.startswith(f"{ROLE} "), F.substring(other, F.locate(between, other) + len(between), F.length(other))
        ).otherwise(inner(" ", f" {END}"))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(_written_turns(written), turn)


def under_mask(written: Column, mask: Column) -> Column:
    """All text of a formatted conversation that the loss counts, unescaped, nothing between."""
    def counted(s: Column, runs: Column) -> Column:
        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))
        def step(state, r):
            here = F.when(r["loss"], F.substring(s, state["at"], r["chars"])).otherwise("")
            return F.struct((state["at"] + r["chars"]).alias("at"), F.concat(state["text"], here).alias("text"))
        return F.aggregate(runs, start, step, lambda state: state["text"])

    pieces = F.concat(F.array(F.lit(BEGIN)), _written_turns(written))
    return unescaped(F.array_join(F.zip_with(pieces, mask, counted), ""))
