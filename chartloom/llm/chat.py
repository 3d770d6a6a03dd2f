"""Chat formatting from an event log, in DataFrame functions only.

A log row says what happened to one message of a conversation. Events are folded per
message, messages are put in turn order per conversation, and the result is rendered
with a template whose control strings cannot occur inside a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
CONTROL = (OPEN, CLOSE, "[INST]", "[/INST]")
LOSS_ROLE = "assistant"
# The role ends at the first line end that no backslash escapes; the text is the rest.
_PART = r"(?s)\A<s>((?:[^\\\n]++|\\.)*+)\n(.*)\z"


def escape(text: Column) -> Column:
    r"""Break every control string with a backslash after its first character; ``\`` becomes ``\\``."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for word in CONTROL:
        out = F.replace(out, F.lit(word), F.lit(f"{word[0]}\\{word[1:]}"))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(\\?)", "$1")


def rows_as_events(rows: DataFrame) -> DataFrame:
    """One ``message`` event per row of (conv_id, turn, role, text); repeated rows stay apart."""
    return rows.select(
        "conv_id",
        F.monotonically_increasing_id().alias("message"),
        "turn",
        F.lit(0).cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of a log.

    ``events`` has conv_id, message (the message's key in its conversation), turn, seq,
    kind, role, text. In order of seq a ``delta`` appends its text; ``message``,
    ``edit``, ``regenerate`` and any other kind (null too) discard what the message held
    and start from their own text. Null texts are empty. Events with equal seq go by
    kind, then text. Role and turn are those of the first event that has one. A message
    is its own group, so a conversation with most of the log is spread over tasks.
    """
    step = F.struct(
        "seq",
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    first = F.struct("seq", "turn", "role")
    grouped = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(step)).alias("steps"),
        F.min(F.when(F.col("turn").isNotNull() | F.col("role").isNotNull(), first)).alias("first"),
    )
    start = F.array_max(
        F.transform("steps", lambda s, i: F.when(s["kind"] == "delta", F.lit(0)).otherwise(i))
    )
    text = F.array_join(
        F.transform(F.slice("steps", start + 1, F.size("steps")), lambda s: s["text"]), ""
    )
    return grouped.select("conv_id", F.col("first.turn").alias("turn"), F.col("first.role").alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Per conversation: ``formatted`` and ``loss_mask``.

    Turns go by turn (null first), role, text. Each is ``<s>role\\ntext</s>`` with role
    and text escaped. The mask has one run per turn: ``skip`` code points outside the
    loss, then ``take`` inside it (an assistant's escaped text, else 0), then ``rest``.
    The formatted conversation is one value, so it must fit in one row.
    """
    grouped = messages.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    coded = grouped.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                escape_role(t["role"]).alias("role"),
                escape(t["text"]).alias("text"),
                (t["role"] == LOSS_ROLE).alias("loss"),
            ),
        ).alias("turns"),
    )
    return coded.select(
        "conv_id",
        F.array_join(
            F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))),
            "",
        ).alias("formatted"),
        F.transform(
            "turns",
            lambda t: F.struct(
                (F.length(t["role"]) + len(OPEN) + 1).alias("skip"),
                F.when(t["loss"], F.length(t["text"])).otherwise(0).alias("take"),
                (F.when(t["loss"], 0).otherwise(F.length(t["text"])) + len(CLOSE)).alias("rest"),
            ),
        ).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts, unescaped, read from the formatted text and its mask alone."""
    # What follows the last CLOSE is empty; texts hold no CLOSE of their own.
    parts = formatted.select("*", F.split("formatted", CLOSE).alias("_parts")).withColumn(
        "_parts", F.slice("_parts", 1, F.size("_parts") - 1)
    )
    return parts.select(
        *formatted.columns,
        F.transform(
            "_parts",
            lambda p: F.struct(
                unescape(F.regexp_extract(p, _PART, 1)).alias("role"),
                unescape(F.regexp_extract(p, _PART, 2)).alias("text"),
            ),
        ).alias("turns"),
        F.array_join(
            F.zip_with(
                "_parts",
                "loss_mask",
                lambda p, m: unescape(F.substring(p, m["skip"] + 1, m["take"])),
            ),
            "",
        ).alias("loss_text"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Fold an event log and render every conversation."""
    return render(fold_events(events))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation says when read back, as digests."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
