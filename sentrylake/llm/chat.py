"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes an example of its own: all preceding turns are its context and that
reply alone is trainable. Turns behind the last assistant turn go out as one more row with nothing
to train, so that no turn is lost.

The template writes a turn as an opening mark, the role, a newline, the text and a closing mark;
assistant turns are marked <s> and </s>, all others [INST] and [/INST]. In roles and texts a
backslash is doubled, one is put behind the first character of each control string, and one
before a newline of a role. So no control string of a text survives as such, and dropping the
escapes gives back the text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
REPLY_OPEN, REPLY_CLOSE, OTHER_OPEN, OTHER_CLOSE = "<s>", "</s>", "[INST]", "[/INST]"


def escape(text: Column) -> Column:
    """Doubles backslashes, then breaks each control string with one."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(?=/?(?:s>|INST\]))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turn(role: Column, text: Column) -> Column:
    reply = role == ASSISTANT
    named = F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))
    return F.concat(F.when(reply, REPLY_OPEN).otherwise(OTHER_OPEN), named, F.lit("\n"), escape(text), F.when(reply, REPLY_CLOSE).otherwise(OTHER_CLOSE))


def expand_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: the conversation's id, ``example`` (from 0), ``context``, ``reply_open``, ``reply`` and ``reply_close``.

    The formatted example is the four strings in a row; only ``reply`` (escaped) is trainable, and it
    is null on the row that carries the turns behind the last reply. Null roles and texts count as
    empty; a null turn number sorts first; equal turn numbers are taken in order of role and text;
    rows with a null conversation id form one conversation. Texts are formatted whole, whatever their length; every example repeats the turns
    before it, and a conversation (that of the null ids too) is one row while it is formatted, so its turns together must fit into a task's memory. Other columns are dropped,
    whatever their names. No rows in, no rows out.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = turns.groupBy(F.col(conv)).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    marked = F.transform("turns", lambda t: F.struct((t["role"] == ASSISTANT).alias("trains"), _turn(t["role"], t["text"]).alias("line"), escape(t["text"]).alias("body")))
    whole = whole.select(conv, marked.alias("turns"))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["trains"] | (i == F.size("turns")))
    each = whole.select(conv, "turns", F.posexplode(ends).alias("example", "upto"))
    trains = F.element_at("turns", F.col("upto"))["trains"]
    last = F.element_at("turns", F.col("upto"))
    lead = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("upto") - 1), lambda t: t["line"]), "")
    return each.select(
        conv,
        "example",
        F.when(trains, lead).otherwise(F.concat(lead, last["line"])).alias("context"),
        F.when(trains, F.lit(f"{REPLY_OPEN}{ASSISTANT}\n")).otherwise("").alias("reply_open"),
        F.when(trains, last["body"]).alias("reply"),
        F.when(trains, F.lit(REPLY_CLOSE)).otherwise("").alias("reply_close"),
    )


def formatted(example: str = "") -> Column:
    return F.concat(F.col("context"), F.col("reply_open"), F.coalesce(F.col("reply"), F.lit("")), F.col("reply_close"))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted string as array<struct<role, text>>."""
    bodies = F.regexp_extract_all(text, F.lit(r"(?s)(?:<s>|\[INST\])(.*?)(?:</s>|\[/INST\])"), F.lit(1))
    head = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n"

    def split(body: Column) -> Column:
        role = F.regexp_extract(body, head, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(bodies, split)


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The digest of each conversation, read from its examples alone: the last holds all turns, each trains one reply."""
    whole = examples.withColumn("formatted", formatted())
    trained = F.transform(F.array_sort(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))), lambda x: unescape(x["reply"]))
    each = whole.groupBy(conv).agg(F.max_by("formatted", "example").alias("longest"), F.array_join(trained, "").alias("loss"), F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
    each = each.select(conv, parse_turns(F.col("longest")).alias("turns"), "loss", "formatted_chars")
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return each.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
