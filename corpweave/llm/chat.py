"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example is the text of all turns up to and including one assistant turn, with the half-open code-point range
``[loss_start, loss_end)`` of that reply's text as the only trainable part. Turns after the last assistant turn, and
conversations without one, give one more example without a trainable part, so that the output holds every turn.

Template: a turn is ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Control strings inside roles and texts
are escaped reversibly: a backslash goes in after their first character, and strings that already look escaped get one
more. Line feeds in a role are written as ``\\n``.

Everything is built-in expressions. One shuffle brings a conversation's turns together; its examples are then made
one at a time while they stream out, so no row holds more than one example and the conversation itself.

Cases: null text and null role count as empty; null conversation ids form one conversation; ties of ``turn`` are
ordered by role, then text, and null turns come first; repeated rows are repeated turns; an empty table gives no
examples; columns besides the four named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Everything after the first character of the strings that texts must not hold: the template's own and common others.
TAILS = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>>"
ESCAPABLE = rf"([<\[])(\\*)({TAILS})"
ESCAPED = rf"([<\[])\\(\\*)({TAILS})"


def escaped(text: Column) -> Column:
    """Control strings broken by a backslash after their first character; undone exactly by ``unescaped``."""
    return F.regexp_replace(text, ESCAPABLE, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escaped_role(role: Column) -> Column:
    """A role on one line: backslash and line feed are written as two characters, control strings broken."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    parts = F.split(unescaped(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped(text), F.lit(END + "\n"))


def expand_examples(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Examples: ``key``, example (from 0), text, loss_start, loss_end (null without trainable part), is_last."""
    clean = turns.select(
        turns[key].alias("conv_id"),
        "turn",
        F.coalesce(turns["role"], F.lit("")).alias("role"),
        F.coalesce(turns["text"], F.lit("")).alias("text"),
    )
    rows = clean.select(
        "conv_id",
        F.struct("turn", "role", F.col("text").alias("raw"), turn_text(F.col("role"), F.col("text")).alias("formatted"))
        .alias("row"),
    )
    talks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("rows")),
        lambda i: (F.element_at("rows", i)["role"] == "assistant") | (i == F.size("rows")),
    )
    one = talks.select("conv_id", "rows", F.posexplode(ends).alias("example", "upto"))
    target = F.element_at("rows", F.col("upto"))
    context = F.array_join(F.slice("rows.formatted", F.lit(1), F.col("upto") - 1), "")
    parts = one.select(
        "conv_id",
        "example",
        context.alias("context"),
        target["role"].alias("role"),
        target["formatted"].alias("formatted"),
        escaped(target["raw"]).alias("reply"),
        (F.col("upto") == F.size("rows")).alias("is_last"),
    )
    trained = F.col("role") == "assistant"
    start = F.length("context") + F.length(F.lit(START + "assistant\n"))
    return parts.select(
        F.col("conv_id").alias(key),
        F.col("example").cast("bigint").alias("example"),
        F.concat("context", "formatted").alias("text"),
        F.when(trained, start).cast("bigint").alias("loss_start"),
        F.when(trained, start + F.length("reply")).cast("bigint").alias("loss_end"),
        "is_last",
    )


def parsed_turns(text: Column) -> Column:
    """Turns read back from an example's text, as an array of (role, text)."""
    pieces = F.split(text, r"<\|im_end\|>\n", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescaped_role(F.substring_index(F.substr(b, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescaped(F.regexp_replace(b, r"\A[^\n]*\n", "")).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped; empty without one."""
    return F.coalesce(unescaped(F.substr(text, start.cast("int") + 1, (end - start).cast("int"))), F.lit(""))


def digests(examples: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation, all of it read back from the examples."""
    last = F.max(F.when(F.col("is_last"), F.col("text")))
    read = examples.select(
        key,
        "text",
        "is_last",
        F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss")).alias("part"),
        F.length("text").cast("bigint").alias("chars"),
    )
    per = read.groupBy(key).agg(
        last.alias("whole"), F.array_join(F.array_sort(F.collect_list("part"))["loss"], "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    per = per.withColumn("turns", parsed_turns(F.col("whole")))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select(
        key,
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(joined, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
