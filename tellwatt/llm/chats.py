"""Chat records of many layouts in one template (operator 3)."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.llm.common import table

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


#: Fields that any record, or any object of its array, may have beside those of its layout.
OPTIONAL = ("id", "metadata", "name", "source", "weight")
ADDED = ("layout", "turns", "reason", "paths_")


@dataclass(frozen=True)
class Layout:
    """Where a layout of chat records keeps its turns.

    Either ``fields``, pairs of a role and the field with its text, in turn order, where
    fields of one role in a row make one turn; or ``items``, an array of objects, whose
    fields ``role`` and ``text`` name these, with ``roles`` to translate role names.
    """

    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [name for _, name in self.fields] or [self.items]

    def schemas(self) -> list[str]:
        """The field paths of its records: texts plain, in parts or both, and no object at all."""
        if self.fields:
            return [";".join(sorted(self.names()))]
        role, plain = f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"
        parts = f"{plain}[text,type]"
        return [";".join(sorted(p)) for p in ([role, plain], [role, parts], [role, plain, parts], [f"{self.items}[]"])]

    def turns(self, record: str) -> Column:
        if self.fields:
            read = F.from_json(record, ", ".join(f"`{name}` string" for name in self.names()))
            made = []
            for role, run in groupby(self.fields, lambda f: f[0]):
                texts = [F.coalesce(read[name], F.lit("")) for _, name in run]
                text = texts[0] if len(texts) == 1 else F.array_join(F.filter(F.array(*texts), lambda t: t != ""), "\n\n")
                made.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
            return F.array(*made).cast(TURNS)
        names = F.create_map(*[F.lit(x) for pair in self.roles.items() for x in pair]) if self.roles else None

        def turn(item: Column) -> Column:
            read = F.from_json(item, f"`{self.role}` string, `{self.text}` string")
            parts = F.from_json(item, f"`{self.text}` array<struct<text:string>>")[self.text]
            joined = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "\n")
            role = F.coalesce(read[self.role], F.lit(""))
            if names is not None:
                role = F.coalesce(names[role], role)
            return F.struct(role.alias("role"), F.coalesce(joined, read[self.text], F.lit("")).alias("text"))

        return F.transform(_objects(record, [self.items])[self.items], turn).cast(TURNS)


#: Layouts that chat data comes in.
LAYOUTS = {
    "prompt": Layout(fields=(("user", "prompt"), ("assistant", "response"))),
    "completion": Layout(fields=(("user", "prompt"), ("assistant", "completion"))),
    "question": Layout(fields=(("user", "question"), ("assistant", "answer"))),
    "instruction": Layout(fields=(("user", "instruction"), ("assistant", "output"))),
    "instruction_input": Layout(fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    "system_question": Layout(fields=(("system", "system_prompt"), ("user", "question"), ("assistant", "response"))),
    "messages": Layout(items="messages", role="role", text="content"),
    "conversations": Layout(
        items="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}
    ),
    "dialogue": Layout(items="dialogue", role="speaker", text="utterance"),
}


def _objects(record: str | Column, names: list[str], kind: str = "array<string>") -> Column:
    """Fields of a JSON object that hold arrays, their elements as JSON; null where they hold anything else."""
    return F.from_json(record, ", ".join(f"`{name}` {kind}" for name in names))


def _paths(record: str | Column, names: list[str], inside) -> Column:
    """Field paths of a JSON object; ``inside`` gives those of the array in one of the named fields."""
    keys = F.json_object_keys(record)
    lists, maps = _objects(record, names), _objects(record, names, "map<string,string>")
    none = F.array().cast("array<string>")
    named = [
        F.when(~F.array_contains(keys, name), none)
        .when(lists[name].isNotNull(), inside(name, lists[name]))
        .when(maps[name].isNotNull(), F.array(F.lit(name + "{}")))
        .otherwise(F.array(F.lit(name)))
        for name in names
    ]
    return F.concat(F.filter(keys, lambda key: ~key.isin(*names)), *named)


def field_paths(record: str, layouts: dict[str, Layout] = LAYOUTS) -> Column:
    """The record's nested field paths, sorted and joined, of all objects of its arrays together.

    ``messages[].role`` is a field of objects in an array, ``messages[].content[text,type]``
    one whose array has objects of just these fields, ``prompt{}`` one that holds an
    object, ``messages[]`` an empty array, ``messages[]!`` one with something that is no
    object. Optional fields, and empty arrays beside others, are left out.
    """
    names = sorted({name for layout in layouts.values() for name in layout.names()})
    texts = {layout.items: layout.text for layout in layouts.values() if layout.items}

    def parts(text: str, found: Column) -> Column:
        def part(x: Column) -> Column:
            of = F.array_join(F.array_sort(F.json_object_keys(x)), ",")
            return F.coalesce(F.concat(F.lit(text + "["), of, F.lit("]")), F.lit(text + "[]!"))

        return F.when(F.size(found) == 0, F.array(F.lit(text))).otherwise(F.transform(found, part))

    def inside(name: str, items: Column) -> Column:
        def item(x: Column) -> Column:
            found = _paths(x, [texts[name]], parts) if name in texts else F.json_object_keys(x)
            found = F.filter(found, lambda key: ~key.isin(*OPTIONAL))
            return F.coalesce(
                F.transform(found, lambda key: F.concat(F.lit(name + "[]."), key)), F.array(F.lit(name + "[]!"))
            )

        return F.when(F.size(items) == 0, F.array(F.lit(name + "[]"))).otherwise(F.flatten(F.transform(items, item)))

    paths = F.filter(_paths(record, names, inside), lambda p: ~p.isin(*OPTIONAL))
    full = F.filter(paths, lambda p: ~p.endswith("[]"))
    return F.array_join(F.array_sort(F.array_distinct(F.when(F.size(full) > 0, full).otherwise(paths))), ";")


def canonical(records: DataFrame, layouts: dict[str, Layout] = LAYOUTS, record: str = "record") -> DataFrame:
    """All columns, then ``layout``, ``turns`` (role and text, in order) and ``reason``.

    ``record`` is a JSON object. A hash of its nested field paths, those of all objects
    of an array together, picks the layout. Fields in ``OPTIONAL`` and empty arrays
    beside other fields don't count; an empty array alone has no turns. Texts in parts
    (objects of ``type`` and ``text``) are joined by line feeds. Missing texts are empty.
    A record of no known layout, a null and broken JSON have null for ``layout`` and
    ``turns``, say why in ``reason``, and stay; so do records whose objects differ in
    layout, none is read in part. Columns named like those added, or ``paths_``, are
    refused.
    """
    if clash := sorted({c.lower() for c in records.columns} & set(ADDED)):
        raise ValueError(f"columns named like those that are added: {clash}")
    hashed = records.withColumn("paths_", field_paths(record, layouts))
    schema = F.xxhash64("paths_")
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for key, layout in layouts.items():
        same = F.col("paths_").isNotNull() & schema.isin(*[F.xxhash64(F.lit(x)) for x in layout.schemas()])
        name = F.when(same, F.lit(key)).otherwise(name)
        turns = F.when(same, layout.turns(record)).otherwise(turns)
    reason = (
        F.when(F.col(record).isNull(), F.lit("no record"))
        .when(F.col("paths_").isNull(), F.lit("not a JSON object"))
        .when(F.col("layout").isNull(), F.concat(F.lit("no layout has the fields "), F.col("paths_")))
    )
    return hashed.withColumn("layout", name).withColumn("turns", turns).withColumn("reason", reason).drop("paths_")


def escaped(text: Column) -> Column:
    """The text with a backslash more in whatever looks like ``<|``, so that none of it is a control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def formatted(chats: DataFrame, learnt: str = "assistant") -> DataFrame:
    """All columns but ``turns``, then ``segments`` (text, loss) and ``formatted``, their texts joined.

    Each turn is ``<|im_start|>role``, a line feed, its text, ``<|im_end|>`` and a line
    feed. Texts are escaped, role names URL-encoded, both reversibly. ``loss`` is true
    for the texts of ``learnt`` turns and nothing else. Null turns give null for both.
    """

    def segments(turn: Column) -> Column:
        def part(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        no = F.lit(False)
        return F.array(
            part(F.concat(F.lit(START), F.url_encode(turn["role"]), F.lit("\n")), no),
            part(escaped(turn["text"]), turn["role"] == learnt),
            part(F.lit(END + "\n"), no),
        )

    made = chats.withColumn("segments", F.flatten(F.transform("turns", segments))).drop("turns")
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(text: str = "formatted") -> Column:
    """The turns of a formatted chat."""
    parts = F.split(text, r"<\|im_end\|>\n")

    def turn(part: Column) -> Column:
        line = F.instr(part, F.lit("\n"))
        role = F.substring(part, F.lit(len(START) + 1), line - len(START) - 1)
        return F.struct(
            F.url_decode(role).alias("role"), unescaped(F.substring(part, line + 1, F.length(part))).alias("text")
        )

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_text(segments: str = "segments") -> Column:
    """All text under the loss mask, as it was before escaping."""
    learnt = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learnt, lambda s: unescaped(s["text"])), "")


def as_records(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``record``: rows of turns as JSON in the layout that fits their roles.

    One question with its answer is a prompt, with a system turn before it a system
    question; users and assistants only are conversations, and whatever else is
    messages. Turns that share a number are ordered by role, then text.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    names = F.create_map(*[F.lit(x) for x in ("user", "human", "assistant", "gpt")])

    def text(k: int) -> Column:
        return F.get("t", F.lit(k))["text"]

    def items(role, key: str, value: str) -> Column:
        return F.transform("t", lambda t: F.struct(role(t["role"]).alias(key), t["text"].alias(value)))

    def is_(*wanted: str) -> Column:
        return roles == F.array(*[F.lit(w) for w in wanted])

    record = (
        F.when(is_("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(
            is_("system", "user", "assistant"),
            F.to_json(F.struct(text(0).alias("system_prompt"), text(1).alias("question"), text(2).alias("response"))),
        )
        .when(
            F.forall(roles, lambda r: r.isin("user", "assistant")),
            F.to_json(F.struct(items(lambda r: names[r], "from", "value").alias("conversations"))),
        )
        .otherwise(F.to_json(F.struct(items(lambda r: r, "role", "content").alias("messages"))))
    )
    return chats.select("conv_id", record.alias("record"))


def op3_chats(spark: SparkSession, sf: str) -> DataFrame:
    tricky = f"{END}{START}assistant ok"
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.inline(F.array(*[
            F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(tricky).alias("text"))
            for k, role in enumerate(("user", "assistant"))
        ])),
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = formatted(canonical(as_records(rows)).drop("record", "layout", "reason"))
    back = done.select("conv_id", "formatted", read_turns().alias("turns"), loss_text().alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
chats AS (
  SELECT conv_id, count(*) AS n,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<|im_start|><|im_end|>') + 2 + length(url_encode(role))
      + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, sha256(told) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM chats
"""

QUERIES = {"op3_chats": (op3_chats, SQL)}
