"""Chat formatting: conversations as one marked text with a loss mask, and back.

Only Spark expressions.  A conversation's turns are collected as structs and
sorted; adjacent turns of one role are merged to one block by looking at the
neighbours in the array, its texts set apart by a mark; blocks are concatenated:

    <|turn|>role<|text|>first text<|more|>second text<|end|>

and a line end.  Texts and roles may hold any control string: a backslash is
doubled and one is put inside each control string (of this template and of two
common ones), which ``unescaped`` takes back.

Defined cases: null texts and roles are empty; turns that tie are ordered by
role and text, repeated rows are as many turns; a null conversation id is a
conversation; an empty table gives an empty result; further columns do not
matter.  A conversation is one row of the result and so is held by one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.arrays import bound, running, sum_before
from granary.llm.storage import col

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
#: Control strings and what they are in a text; each differs by one backslash.
ESCAPES = (("<|", "<\\|"), ("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]"))
LEARNED = "assistant"
#: Code points that are walked through to find a stretch.
CHUNK = 512


def escaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, F.replace(text, F.lit("\\"), F.lit("\\\\")))


def unescaped(text: Column) -> Column:
    """Takes ``escaped`` back: a control string with one backslash in it is never a text's own, whose are doubled."""
    return F.replace(reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text), F.lit("\\\\"), F.lit("\\"))


def formatted(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: its id, ``formatted`` and ``loss``, the stretches (start, end) of code points to learn."""
    row = F.struct(col(turn).alias("turn"), escaped(F.coalesce(col(role), F.lit(""))).alias("role"), escaped(F.coalesce(col(text), F.lit(""))).alias("text"))
    collected = conversations.groupBy(col(conv).alias(conv)).agg(F.array_sort(F.collect_list(row)).alias("turns"))

    def like(x: Column, i: Column) -> Column:
        """Whether the turn at place i has the role of x."""
        return F.coalesce(F.get("turns", i)["role"] == x["role"], F.lit(False))

    # adjacent turns of one role share a head and an end
    parts = F.transform(
        "turns",
        lambda x, i: F.struct(
            F.when(like(x, i - 1), F.lit(MORE)).otherwise(F.concat(F.lit(TURN), x["role"], F.lit(TEXT))).alias("head"),
            x["text"].alias("text"),
            F.when(like(x, i + 1), F.lit("")).otherwise(F.lit(END + "\n")).alias("tail"),
            (x["role"] == LEARNED).alias("learn"),
        ),
    )

    def stretches(p: Column) -> Column:
        lengths = F.transform(p, lambda x: (F.length(x["head"]) + F.length(x["text"]) + F.length(x["tail"])).cast("long"))

        def places(s: Column) -> Column:
            def place(x: Column, i: Column) -> Column:
                start = sum_before(s, i) + F.length(x["head"])
                return F.when(x["learn"], F.struct(start.alias("start"), (start + F.length(x["text"])).alias("end")))

            return F.filter(F.transform(p, place), lambda x: x.isNotNull())

        return bound(lengths, lambda n: bound(running(n), places))

    both = bound(parts, lambda p: F.struct(F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["text"], x["tail"])), "").alias("formatted"), stretches(p).alias("loss")))
    return collected.select(col(conv), both.alias("both")).select(col(conv), "both.formatted", "both.loss")


def parsed(output: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The turns (role, text) read back from ``formatted``, and the learned text by its stretches."""
    blocks = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda _, i: i > 0)

    def turns_of(block: Column) -> Column:
        body = F.regexp_replace(F.substring_index(block, END, 1), r"(?s)^.*?<\|text\|>", "")
        return bound(
            F.struct(unescaped(F.substring_index(block, TEXT, 1)).alias("role"), F.split(body, r"<\|more\|>", -1).alias("texts")),
            lambda b: F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), unescaped(t).alias("text"))),
        )

    def stretch(chunks: Column, x: Column) -> Column:
        """Only the chunks that a stretch touches are walked through."""
        first = F.floor(x["start"] / CHUNK).cast("int")
        some = F.array_join(F.slice(chunks, first + 1, F.floor(x["end"] / CHUNK).cast("int") - first + 1), "")
        return unescaped(F.substr(some, (x["start"] - first * CHUNK + 1).cast("int"), (x["end"] - x["start"]).cast("int")))

    chunks = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    learned = bound(chunks, lambda c: F.transform("loss", lambda x: stretch(c, x)))
    return output.select(col(conv), "formatted", "loss", F.flatten(F.transform(blocks, turns_of)).alias("turns"), learned.alias("learned"))


def digest(output: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests of what is read back from the output."""
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return parsed(output, conv).select(
        col(conv),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def sql(table: str, extra: str) -> str:
    """The digests by DuckDB, straight from the turns."""

    def esc(x: str) -> str:
        for a, b in (("\\", "\\\\"), *ESCAPES):
            x = f"replace({x}, '{a}', '{b}')"
        return x

    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table} UNION ALL {extra}),
o AS (SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, {esc("role")}, {esc("text")}))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = '{LEARNED}' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = '{LEARNED}' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
  CAST(sum(length({esc("text")}) + CASE WHEN before = role THEN {len(MORE)} ELSE {len(TURN) + len(TEXT) + len(END) + 1} + length({esc("role")}) END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id"""
