"""Chat formatting: records of any known layout become canonical turns and one string per conversation.

A record is a VARIANT. The set of its nested field paths, taken from its schema
without the leaf types, is hashed to a fingerprint; the fingerprint selects a
declarative mapping (``Layout``), which names the paths of conversation id,
order, role and text. Everything is DataFrame functions.

The template marks turns with control strings::

    <|turn|>role\\ntext<|end|>\\n

and escapes control strings inside texts reversibly: every control string gets
one more backslash after its first character, and so does a control string that
already carries backslashes there. Reading back takes one away.

Defined results: a null text counts as empty, a null role as empty; line breaks
in a role are escaped; turns of one conversation go by order, then role, then
text, nulls first; repeated rows are repeated turns; a null id is one
conversation; records whose layout is unknown are left out of the turns and
come back from ``unmapped``; an empty table gives no rows; columns of the source
take part only as far as they are in the record.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TURN, BREAK, END = "<|turn|>", "\n", "<|end|>\n"
#: Control strings of common chat templates, each as (first character, rest as a regular expression).
CONTROL = r"(<|\[)(\\*)(/?s>|<SYS>>|</SYS>>|\|[A-Za-z_]+\|>|/?INST\])"
ESCAPED = r"(<|\[)\\(\\*)(/?s>|<SYS>>|</SYS>>|\|[A-Za-z_]+\|>|/?INST\])"


@dataclass(frozen=True)
class Turn:
    """One turn of a record: a fixed ``role`` or a path to it, and the path of the text."""

    text: str
    role: str | None = None
    role_path: str | None = None


@dataclass(frozen=True)
class Layout:
    """A record layout. ``each`` is the path of an array whose elements the turns' paths start from."""

    name: str
    paths: Sequence[str]
    id: str
    turns: Sequence[Turn]
    order: str | None = None
    each: str | None = None
    roles: Sequence[tuple[str, str]] = ()


#: Field names of the usual layouts.
LAYOUTS = (
    Layout("turn_rows", ("conv_id", "role", "text", "turn"), "$.conv_id", (Turn("$.text", role_path="$.role"),), order="$.turn"),
    Layout("prompt_response", ("conv_id", "prompt", "response"), "$.conv_id", (Turn("$.prompt", "user"), Turn("$.response", "assistant"))),
    Layout("prompt_completion", ("completion", "conv_id", "prompt"), "$.conv_id", (Turn("$.prompt", "user"), Turn("$.completion", "assistant"))),
    Layout("system_prompt", ("conv_id", "prompt", "response", "system"), "$.conv_id",
           (Turn("$.system", "system"), Turn("$.prompt", "user"), Turn("$.response", "assistant"))),
    Layout("instruction", ("conv_id", "instruction", "output"), "$.conv_id", (Turn("$.instruction", "user"), Turn("$.output", "assistant"))),
    Layout("instruction_input", ("conv_id", "input", "instruction", "output"), "$.conv_id",
           (Turn("$.instruction", "system"), Turn("$.input", "user"), Turn("$.output", "assistant"))),
    Layout("messages", ("conv_id", "messages[].content", "messages[].role"), "$.conv_id", (Turn("$.content", role_path="$.role"),), each="$.messages"),
    Layout("from_value", ("conv_id", "conversations[].from", "conversations[].value"), "$.conv_id",
           (Turn("$.value", role_path="$.from"),), each="$.conversations", roles=(("human", "user"), ("gpt", "assistant"))),
)


def paths_text(paths: Sequence[str]) -> str:
    """The nested field paths as the schema of a record spells them, leaf types left out."""
    tree: dict = {}
    for path in sorted(paths):
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def spell(node: dict) -> str:
        if not node:
            return ""
        parts = []
        for name in sorted(node):
            inner = spell(node[name])
            parts.append(f"{name.removesuffix('[]')}:" + (f"ARRAY<{inner}>" if name.endswith("[]") else inner))
        return f"OBJECT<{','.join(parts)}>"

    return spell(tree)


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a VARIANT."""
    schema = F.regexp_replace(F.schema_of_variant(record), r"(?<=[:<] ?)[A-Z]+(\(\d+,\s*\d+\)| NOT NULL)?(?=[,>])", "")
    return F.xxhash64(F.regexp_replace(schema, r"([:,]) ", "$1"))


def with_layout(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` plus ``layout``: the name of the mapping its fingerprint selects, null if none."""
    rows = records.withColumn("__print", fingerprint(F.col(record)))
    names = [F.when(F.col("__print") == F.xxhash64(F.lit(paths_text(a.paths))), F.lit(a.name)) for a in layouts]
    return rows.withColumn("layout", F.coalesce(*names, F.lit(None).cast("string"))).drop("__print")


def _text(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, path, "string"), F.lit(""))


def turns(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Canonical turns ``conv_id, turn, role, text`` of all records whose layout is known."""
    named = with_layout(records.select(F.col(record).alias("record")), layouts=layouts)
    mapped = []
    for a in layouts:
        if a.each:
            listed = F.transform(F.try_variant_get("record", a.each, "array<variant>"), _turn_of(a.turns[0], a))
        else:
            listed = F.array(*[_turn_of(t, a)(F.col("record")) for t in a.turns])
        order = F.try_variant_get("record", a.order, "bigint") if a.order else F.lit(None).cast("bigint")
        row = F.struct(F.try_variant_get("record", a.id, "bigint").alias("conv_id"), order.alias("turn"), listed.alias("items"))
        mapped.append(F.when(F.col("layout") == a.name, row))
    rows = named.where("layout is not null").select(F.coalesce(*mapped).alias("m"))
    rows = rows.select("m.conv_id", "m.turn", F.posexplode("m.items").alias("pos", "item"))
    return rows.select("conv_id", F.coalesce("turn", F.col("pos").cast("bigint")).alias("turn"), "item.role", "item.text")


def _turn_of(turn: Turn, layout: Layout):
    """Function from a VARIANT to its (role, text)."""

    def made(value: Column) -> Column:
        if turn.role is not None:
            role = F.lit(turn.role)
        else:
            role = named = _text(value, turn.role_path)
            for old, new in layout.roles:
                role = F.when(named == old, F.lit(new)).otherwise(role)
        return F.struct(role.alias("role"), _text(value, turn.text).alias("text"))

    return made


def unmapped(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Records without a mapping."""
    return with_layout(records, record, layouts).where("layout is null").drop("layout")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # Between escaped backslashes, the rest of a pair is a line break.
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def formatted(canonical: DataFrame, *, trained: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``: one string per conversation and where its trained texts are.

    A span is (turn number, start, length), start and length in code points of
    the string; the spans together are the loss mask.
    """
    rows = canonical.select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit(BREAK)).alias("head"), escape(F.col("text")).alias("body"),
    )
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    ahead = F.sum(F.length("piece").cast("bigint")).over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumns({"no": F.row_number().over(order) - 1, "at": F.coalesce(ahead, F.lit(0).cast("bigint"))})
    span = F.struct("no", (F.col("at") + F.length("head")).alias("start"), F.length("body").alias("length"))
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("no", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == trained, span))).alias("loss_spans"),
    )
    return grouped.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "loss_spans")


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` plus ``turns`` (role, text of each turn) and ``loss_text``, both taken from the formatted string.

    ``loss_text`` is the unescaped text under the loss mask, nothing between.
    """

    def turn(part: Column) -> Column:
        head = F.substring_index(part, BREAK, 1)
        role = F.substring(head, F.lit(len(TURN) + 1), F.length(head))
        body = F.substring(part, F.length(head) + F.lit(2), F.length(part))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    def under(span: Column) -> Column:
        # A trained text ends where its turn ends; cutting it out of its turn keeps the work linear.
        part = F.get("__parts", span["no"])
        return unescape(F.substring(part, F.length(part) - span["length"] + F.lit(1), span["length"]))

    rows = chats.withColumn("__parts", F.filter(F.split("formatted", r"<\|end\|>\n"), lambda p: p != ""))
    rows = rows.withColumns({"turns": F.transform("__parts", turn), "loss_text": F.array_join(F.transform("loss_spans", under), "")})
    return rows.drop("__parts")
