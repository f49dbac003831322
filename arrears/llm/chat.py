r"""Chat formatting by schema fingerprints; DataFrame functions only.

A record's nested field paths, without the types of the values, are hashed: the
fingerprint. It selects a declarative mapping, which says where roles and texts
are, and turns the record's layout into canonical turns (role, text). A record
whose fingerprint is not known, or that cannot be parsed, has no layout and no
turns; it stays in the result.

Template: ``<|im_start|>role``, a line end, the text, ``<|im_end|>``, a line end.
In roles and texts a backslash is doubled, and one is put after the first
character of every control string (``<|name|>``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``, ``<<SYS>>``, ``<</SYS>>``), in a role also before a line end, so no
control string is left in them; a backslash always stands for the character
after it, so they read back exactly.

The formatted text comes as pieces with a loss flag; their texts joined are the
formatted text, and only the assistant's escaped texts count for the loss.

A table with a row for each turn is nested first: each conversation becomes a
record of one of the layouts that hold lists, and goes through its fingerprint like
any other. Very long conversations stay as they are, as do those with a role that a
mapping would rename. An empty table gives no rows.

Null texts and roles count as empty. Turns of one conversation are ordered by
turn (null first), then role and text, so equal turns stay, side by side. A
conversation is one row of the result and so is gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.tables import column

START, STOP = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"\\|<(?=\|\w{1,40}\|>|/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\])"


#: Bytes of a conversation that become a nested record: a variant holds 16 MB, and escapes lengthen a text.
MOST_RECORD = 2_000_000


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns: fields in order, each a turn of a role, or a list of objects."""

    name: str
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()  # role, fields whose texts are joined by an empty line
    optional: tuple[str, ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""

    def shapes(self) -> list[str]:
        """All forms of the field paths that this layout has, with and without optional fields."""
        out = []
        for mask in range(1 << len(self.optional)):
            absent = {f for i, f in enumerate(self.optional) if mask >> i & 1}
            names = {f for _, own in self.fields for f in own} | set(self.optional)
            paths = {f: f for f in names - absent}
            if self.items:
                inner = ", ".join(sorted((self.role, self.text)))
                paths[self.items] = f"{self.items}: ARRAY<OBJECT<{inner}>>"
            out.append("OBJECT<" + ", ".join(paths[f] for f in sorted(paths)) + ">")
        return out

    def turns(self, record: Column) -> Column:
        if self.items:
            kind = f"array<struct<`{self.role}`:string,`{self.text}`:string>>"
            return F.transform(
                F.try_variant_get(record, f"$.{self.items}", kind),
                lambda t: _turn(_canonical(t[self.role]), t[self.text]),
            )
        own = [
            _turn(F.lit(role), F.concat_ws("\n\n", *(F.nullif(_field(record, f), F.lit("")) for f in fields)))
            for role, fields in self.fields
        ]
        present = [
            F.lit(True) if not set(fields) <= set(self.optional)
            else F.coalesce(*(_field(record, f) for f in fields)).isNotNull()
            for _, fields in self.fields
        ]
        turns = F.array(*(F.when(there, turn) for there, turn in zip(present, own, strict=True)))
        return F.filter(turns, lambda t: t.isNotNull())


LAYOUTS = (
    Layout("prompt", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), ("system",)),
    Layout("completion", (("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("question", (("user", ("context", "question")), ("assistant", ("answer",))), ("context",)),
    Layout(
        "instruction",
        (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        ("system", "input"),
    ),
    Layout("messages", items="messages", role="role", text="content", optional=("id",)),
    Layout("conversations", items="conversations", role="from", text="value", optional=("id",)),
    Layout("dialogue", items="turns", role="speaker", text="text", optional=("id",)),
)
#: Layouts of tables with a row for each turn: the fields of role and text.
ROW_LAYOUTS = {"role_text": ("role", "text"), "role_content": ("role", "content"), "from_value": ("from", "value")}

# Other names of the canonical roles.
_ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _canonical(role: Column) -> Column:
    out = role
    for name, canonical in _ROLES.items():
        out = F.when(role == name, F.lit(canonical)).otherwise(out)
    return out


def _field(record: Column, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "string")


def shape(record: Column) -> Column:
    """Nested field paths of a variant, without the types of its values."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z]+(\(\d+,\s*\d+\))?(?=[,>])", "")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` (as a struct ``source``) with fingerprint, layout and turns; ``record_col`` holds JSON."""
    rows = records.select(
        F.struct(*(column(records, c) for c in records.columns)).alias("source"),
        F.try_parse_json(column(records, record_col)).alias("record"),
    ).withColumn("fingerprint", fingerprint(shape(F.col("record"))))
    name = F.lit(None).cast("string")
    turns = F.array().cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        fits = F.col("fingerprint").isin([fingerprint(F.lit(s)) for s in layout.shapes()])
        name = F.when(fits, F.lit(layout.name)).otherwise(name)
        turns = F.when(fits, layout.turns(F.col("record"))).otherwise(turns)
    fits = F.col("record").isNotNull()
    return rows.select("source", F.when(fits, F.col("fingerprint")).alias("fingerprint"), name.alias("layout"), turns.alias("turns"))


def turns_of_rows(
    rows: DataFrame, conversation_col: str = "conv_id", turn_col: str = "turn", layouts: dict[str, tuple[str, str]] = ROW_LAYOUTS
) -> DataFrame:
    """(conv_id, turn, role, text) of a table with a row for each turn, by the fingerprint of its other fields.

    Values are cut to a character for the fingerprint only: their names count.
    """
    fields = sorted(c for c in rows.columns if any(c in pair for pair in layouts.values()))
    sample = F.to_variant_object(F.struct(*(F.substring(column(rows, c).cast("string"), 1, 1).alias(c) for c in fields)))
    role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_role, own_text in layouts.values():
        if own_role in fields and own_text in fields:
            own = "OBJECT<" + ", ".join(sorted((own_role, own_text))) + ">"
            fits = F.col("fingerprint") == fingerprint(F.lit(own))
            role = F.when(fits, column(rows, own_role).cast("string")).otherwise(role)
            text = F.when(fits, column(rows, own_text).cast("string")).otherwise(text)
    found = rows.select(
        column(rows, conversation_col).alias("conv_id"), column(rows, turn_col).alias("turn_no"),
        *(column(rows, c) for c in fields), fingerprint(shape(sample)).alias("fingerprint"),
    )
    return found.select(
        "conv_id", F.col("turn_no").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )


def records_of_turns(turns: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One nested JSON record per conversation of (conv_id, turn, role, text): conv_id, given, record.

    Layouts with a list of turns take the conversations in turns, by a hash of the
    id. ``given`` has the turns in order. A conversation whose record would be too
    long for a variant, or that has a role with another canonical name, has none.
    """
    own = [layout for layout in layouts if layout.items]
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("given"))

    def record(layout: Layout) -> Column:
        items = F.transform("given", lambda t: F.struct(t["role"].alias(layout.role), t["text"].alias(layout.text)))
        return F.to_json(F.struct(items.alias(layout.items)))

    number = F.pmod(F.xxhash64("conv_id"), F.lit(len(own)))
    chosen = F.lit(None).cast("string")
    for i, layout in enumerate(own):
        chosen = F.when(number == i, record(layout)).otherwise(chosen)
    size = F.aggregate("given", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t["role"]) + F.octet_length(t["text"]) + 64)
    renamed = F.exists("given", lambda t: t["role"].isin(list(_ROLES)))
    return whole.withColumn("record", F.when((size <= MOST_RECORD) & ~renamed, chosen))


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): conv_id, layout, pieces, formatted.

    Conversations go through nested records and the mapping that their
    fingerprint selects; those without a record keep their turns as given.
    """
    found = canonical_turns(records_of_turns(turns))
    plain = F.transform("source.given", lambda t: _turn(t["role"], t["text"]))
    own = F.when(F.col("layout").isNotNull(), F.col("turns")).otherwise(plain)
    ready = found.select(F.col("source.conv_id").alias("conv_id"), "layout", own.alias("turns"))
    pieces = F.flatten(F.transform("turns", lambda t: _pieces(t["role"], t["text"])))
    return ready.select("conv_id", "layout", pieces.alias("pieces")).withColumn(
        "formatted", F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit("$0\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _pieces(role: Column, text: Column) -> Column:
    head = F.concat(F.lit(START), F.regexp_replace(escape(role), "\n", "\\\\\\\n"), F.lit("\n"))
    return F.array(
        _piece(head, F.lit(False)), _piece(escape(text), role == "assistant"), _piece(F.lit(STOP), F.lit(False))
    )


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): conv_id, pieces, formatted."""
    ready = turns.select(
        "conv_id", F.struct("turn", "role", "text", _pieces(F.col("role"), F.col("text")).alias("pieces")).alias("turn")
    )
    whole = ready.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    pieces = F.flatten(F.transform("turns", lambda t: t["pieces"]))
    return whole.select("conv_id", pieces.alias("pieces")).withColumn(
        "formatted", F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    )


def format_records(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``canonical_turns`` with pieces and formatted text; records without turns have the empty text."""
    found = canonical_turns(records, record_col)
    pieces = F.flatten(F.transform("turns", lambda t: _pieces(t["role"], t["text"])))
    return found.withColumn("pieces", pieces).withColumn(
        "formatted", F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    )


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")
    role_of = r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n.*$"
    body_of = r"(?s)^<\|im_start\|>(?:[^\\\n]++|\\.)*+\n"
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, role_of, 1)).alias("role"),
            unescape(F.regexp_replace(p, F.lit(body_of), F.lit(""))).alias("text"),
        ),
    )


def read_loss(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
