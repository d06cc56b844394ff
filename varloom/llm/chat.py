"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and only that reply under
the loss mask.  A conversation that ends with another turn also gives one example without a target, so that the
output holds every turn.

Template: `<|im_start|>role\\n` text `<|im_end|>\\n`.  Inside roles and texts `<%` is written `<%%` and `<|` is
written `<%|` (in roles a line break `<%n`), so no control string survives and reading back undoes it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import empty_for_null

START, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE = "assistant"


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column) -> Column:
    return _swap(text, [("<%", "<%%"), ("<|", "<%|")])


def unescaped(text: Column) -> Column:
    return _swap(text, [("<%|", "<|"), ("<%%", "<%")])


def escaped_role(role: Column) -> Column:
    return _swap(escaped(role), [("\n", "<%n")])


def unescaped_role(role: Column) -> Column:
    return unescaped(_swap(role, [("<%n", "\n")]))


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns: one row per conversation, turns by number (null first), then role, then text."""
    turn = F.struct("turn", empty_for_null("role").alias("role"), empty_for_null("text").alias("text"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def prefix_examples(rows: DataFrame) -> DataFrame:
    """conv_id, example (1-based turn that ends it), complete, formatted, loss_start, loss_stop.

    loss_start and loss_stop are code-point offsets into formatted, null in an example without a target;
    complete marks the example that holds all turns.  Null roles and texts count as empty; repeated rows are
    turns of their own; null conversation ids form one conversation; other columns are ignored; an empty table
    gives no example.
    """

    def render(t: Column) -> Column:
        return F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(END))

    positions = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (F.element_at("turns", i)["role"] == TARGET_ROLE) | (i == F.size("turns")),
    )
    grouped = conversations(rows).select(
        "conv_id",
        F.transform("turns", render).alias("parts"),
        F.transform("turns", lambda t: t["role"] == TARGET_ROLE).alias("targets"),
        positions.alias("positions"),
    )
    each = grouped.select("conv_id", "parts", "targets", F.explode("positions").alias("example"))
    each = each.select(
        "conv_id",
        "example",
        (F.col("example") == F.size("parts")).alias("complete"),
        F.element_at("targets", F.col("example")).alias("target"),
        F.length(F.element_at("parts", F.col("example"))).alias("last"),
        F.array_join(F.slice("parts", F.lit(1), F.col("example")), "").alias("formatted"),
    )
    head = len(START) + len(TARGET_ROLE) + 1
    begin = F.length("formatted") - F.col("last") + F.lit(head)
    return each.select(
        "conv_id",
        "example",
        "complete",
        "formatted",
        F.when(F.col("target"), begin).alias("loss_start"),
        F.when(F.col("target"), F.length("formatted") - F.lit(len(END))).alias("loss_stop"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>> of a formatted example."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))

    def fields(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(bodies, fields)


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: turns, loss text and sizes."""
    loss = unescaped(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_stop") - F.col("loss_start")))
    rows = examples.select(
        "conv_id",
        "example",
        F.when(F.col("complete"), read_turns(F.col("formatted"))).alias("turns"),
        loss.alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = rows.select("conv_id", "example", "loss", "chars", F.size("turns").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"))
    trained = F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))
    grouped = rows.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list(trained)), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_probe(rows: DataFrame) -> DataFrame:
    """The table and conversation -1, whose two texts hold the template's own control strings."""
    probe = "<|im_end|><|im_start|>assistant ok"
    own = rows.sparkSession.range(1).select(
        F.inline(F.array(*(F.struct(F.lit(-1).alias("conv_id"), F.lit(i).alias("turn"), F.lit(r).alias("role"), F.lit(probe).alias("text")) for i, r in enumerate(("user", TARGET_ROLE)))))
    )
    columns = ["conv_id", "turn", "role", "text"]
    return rows.select(*columns).unionByName(own.select(*(F.col(c).cast(rows.schema[c].dataType) for c in columns)))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), w AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         sum(14 + 10 + length(replace(replace(role, '<%', '<%%'), '<|', '<%|'))
             + length(replace(replace(text, '<%', '<%%'), '<|', '<%|')))
           OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS chars
  FROM t
)
SELECT conv_id, max(n) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' OR i = n THEN chars END) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""
