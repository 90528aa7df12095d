"""Chat formatting: turns of a conversation to one marked-up text with a loss mask, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_next|>"
# Every backslash of escaped text begins one of these pairs, and no escaped text holds "<|".
ESCAPES = (("\\", "\\b"), ("<|", "<\\p"), ("\n", "\\n"))


def _swap(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def escape(col: Column, lines: bool = False) -> Column:
    """Control strings spelt with a backslash; ``lines`` also spells line ends, for role names."""
    for old, new in ESCAPES[: 3 if lines else 2]:
        col = _swap(col, old, new)
    return col


def unescape(col: Column, lines: bool = False) -> Column:
    for old, new in reversed(ESCAPES[: 3 if lines else 2]):
        col = _swap(col, new, old)
    return col


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: ``conv``, ``n_turns``, ``n_blocks``, ``formatted`` and ``loss_spans``.

    Turn structs are collected and sorted by turn, role and text (nulls first; ties and repeated rows all stay).
    Adjacent turns of one role share one block, their texts parted by a marker, so the turns can be told apart again.
    ``loss_spans`` holds start and length, in code points of ``formatted``, of every text of role ``trained``. Null roles
    and texts count as empty, rows with a null ``conv`` are one conversation, other columns are ignored. An empty table
    gives no rows.
    """
    own = turns.select(
        F.col(conv).alias("_tg_conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("_tg_turn"),
    )
    sorted_turns = own.groupBy("_tg_conv").agg(F.array_sort(F.collect_list("_tg_turn")).alias("turns"))
    starts = sorted_turns.withColumn(
        "firsts",
        F.expr("filter(sequence(1, size(turns)), i -> i = 1 OR element_at(turns, i).role != element_at(turns, i - 1).role)"),
    )
    blocks = starts.withColumn(
        "blocks",
        F.expr(
            "transform(firsts, (at, k) -> struct(element_at(turns, at).role AS role, "
            "transform(slice(turns, at, coalesce(get(firsts, k + 1), size(turns) + 1) - at), t -> t.text) AS texts))"
        ),
    )
    parts = blocks.withColumn(
        "parts",
        F.transform(
            "blocks",
            lambda b: F.struct(
                F.concat(F.lit(START), escape(b["role"], lines=True), F.lit("\n")).alias("head"),
                F.transform(b["texts"], lambda t: escape(t)).alias("texts"),
                (b["role"] == trained).alias("loss"),
            ),
        ),
    )
    # Positions run over blocks and texts; each loss span is added as it is passed.
    empty = F.expr("struct(0L AS at, CAST(array() AS array<struct<start: bigint, length: bigint>>) AS spans)")
    length = lambda c: F.char_length(c).cast("bigint")

    def over_text(acc: Column, text_: Column, loss: Column) -> Column:
        span = F.struct(acc["at"].alias("start"), length(text_).alias("length"))
        return F.struct(
            (acc["at"] + length(text_) + len(NEXT)).alias("at"),
            F.when(loss, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    def over_block(acc: Column, part: Column) -> Column:
        into = F.struct((acc["at"] + length(part["head"])).alias("at"), acc["spans"].alias("spans"))
        out = F.aggregate(part["texts"], into, lambda a, t: over_text(a, t, part["loss"]))
        return F.struct((out["at"] - len(NEXT) + len(END)).alias("at"), out["spans"].alias("spans"))

    joined = F.transform("parts", lambda p: F.concat(p["head"], F.array_join(p["texts"], NEXT), F.lit(END)))
    return parts.select(
        F.col("_tg_conv").alias(conv),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size("blocks").cast("bigint").alias("n_blocks"),
        F.array_join(joined, "").alias("formatted"),
        F.aggregate("parts", empty, over_block)["spans"].alias("loss_spans"),
    )


def parse_chats(formatted: DataFrame) -> DataFrame:
    """``turns`` (role and text, as they were) and ``loss_texts`` beside the row, read from the text and mask alone."""
    literal = lambda s: "\\Q" + s + "\\E"
    blocks = F.slice(F.split("formatted", literal(END)), 1, F.size(F.split("formatted", literal(END))) - 1)
    turns = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(_body(b), literal(NEXT)),
                lambda t: F.struct(unescape(_role(b), lines=True).alias("role"), unescape(t).alias("text")),
            ),
        )
    )
    loss = F.transform(
        "loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return formatted.withColumns({"turns": turns, "loss_texts": loss})


def _role(block: Column) -> Column:
    head = F.substring_index(block, "\n", 1)
    return F.substr(head, F.lit(len(START) + 1), F.char_length(head))


def _body(block: Column) -> Column:
    head = F.substring_index(block, "\n", 1)
    return F.substr(block, F.char_length(head) + 2, F.char_length(block))
