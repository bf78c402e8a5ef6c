"""Chat formatting: a declarative template and a finite-state machine over roles.

DataFrame functions only. The template names the roles, their headers and which of them are trained on, the end mark of a turn
and the allowed order of roles. Control strings inside texts are escaped by a backslash, reversibly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, table


@dataclass(frozen=True)
class Template:
    """Headers per role (never holding ': ' but at the end), roles under the loss mask, end mark, allowed turn order."""

    headers: dict = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    #: Header of any other role, whose name follows in hexadecimal digits of its UTF-8 bytes.
    other: str = "### Other "
    trained: tuple = ("assistant",)
    end: str = " </turn>\n"
    #: State -> role -> next state; a role without an entry is out of order.
    order: dict = field(default_factory=lambda: {
        "start": {"system": "asked", "user": "said"}, "asked": {"user": "said"},
        "said": {"assistant": "answered"}, "answered": {"user": "said"}})
    accepted: tuple = ("answered",)

    def controls(self) -> list[str]:
        return [*(h.strip() for h in self.headers.values()), self.other.strip(), self.end.strip()]


TEMPLATE = Template()


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """Backslashes are doubled, and one is put after the first character of each control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls():
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    """A backslash goes and the character after it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def final_state(roles: Column, template: Template = TEMPLATE) -> Column:
    """State of the machine after a sequence of roles; "rejected" once a role is out of order."""
    moves = F.create_map(*[F.lit(x) for state, to in template.order.items() for role, after in to.items()
                           for x in (f"{state} {role}", after)])
    return F.aggregate(roles, F.lit("start"), lambda state, role: F.coalesce(
        F.try_element_at(moves, F.concat_ws(" ", state, role)), F.lit("rejected")))


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, valid, segments) per conversation of ``turns`` (conv_id, turn, role, text).

    segments: array of (text, loss); joined, the texts are the formatted conversation, and loss marks what is trained on.
    valid: whether the roles come in an allowed order; others are formatted all the same. Null roles and texts are empty; rows
    of equal turn are ordered by role and text, null turns come first; repeated rows are repeated turns; rows without
    conv_id form one conversation without id; other columns are not read; an empty table gives none. A conversation is one
    output row, so a task must hold the longest one.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"),
                                            text.alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    headers = F.create_map(*[F.lit(x) for kv in template.headers.items() for x in kv])

    def segments(t: Column) -> Column:
        header = F.coalesce(F.try_element_at(headers, t["role"]), F.concat(
            F.lit(template.other), F.hex(F.encode(t["role"], "UTF-8")), F.lit(": ")))
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(piece(header, F.lit(False)), piece(escape(t["text"], template), t["role"].isin(*template.trained)),
                       piece(F.lit(template.end), F.lit(False)))

    return grouped.select(
        "conv_id", final_state(F.transform("turns", lambda t: t["role"]), template).isin(*template.accepted).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"))


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Turns (role, text) of a formatted conversation."""
    roles = F.create_map(*[F.lit(x) for r, h in template.headers.items() for x in (h.removesuffix(": "), r)])
    pieces = F.split(formatted, r"\Q" + template.end + r"\E")

    def turn(piece: Column) -> Column:
        header = F.substring_index(piece, ": ", 1)
        name = F.decode(F.unhex(F.replace(header, F.lit(template.other), F.lit(""))), "UTF-8")
        body = F.substr(piece, F.char_length(header) + 3)
        return F.struct(F.coalesce(F.try_element_at(roles, header), name).alias("role"), unescape(body).alias("text"))

    return F.transform(F.filter(pieces, lambda p: p != ""), turn)


def op5_chat(spark, sf_dir):
    """Registered query: all ``conversations`` and conversation -7 formatted, written and read back."""
    said = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    written = settle(format_conversations(rows), "chat")
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    back = written.select("conv_id", "valid", whole.alias("whole"), loss.alias("loss")).withColumn(
        "turns", read_turns(F.col("whole")))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       F.char_length("whole").cast("long").alias("formatted_chars"), "valid")


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(replace(replace(replace(text, '\', '\\'), '### System:', '#\## System:'),
                '### User:', '#\## User:'), '### Assistant:', '#\## Assistant:'), '### Other', '#\## Other'),
                '</turn>', '<\/turn>') AS body,
             CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: '
                       WHEN 'assistant' THEN '### Assistant: ' ELSE '### Other ' || hex(role) || ': ' END AS header,
             CASE role WHEN 'system' THEN 'S' WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' ELSE 'X' END AS code FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(length(header) + length(body) + 9) AS BIGINT) AS formatted_chars,
       regexp_full_match(string_agg(code, '' ORDER BY turn NULLS FIRST, role, text), 'S?(UA)+') AS valid
FROM e GROUP BY conv_id
"""
