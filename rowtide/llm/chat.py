"""Chat formatting: turns to marked text with a loss mask, and back.

A conversation's turns are collected as structs and sorted. Adjacent turns of
the same role form one block; a block is

    <|im_start|>role NEWLINE text [<|im_sep|> text ...] <|im_end|> NEWLINE

and the blocks are concatenated. Control strings inside a text or a role are
escaped: a backslash is doubled, and `<|` becomes `<`, backslash, `|`. So
`<|` occurs only in marks, and reading back gives every turn unchanged. A line
break in a role becomes `<`, backslash, `n`.

The loss mask is an array of (start, length, in code points) for the assistant's
texts, without the marks around them. Everything is a Spark expression.

Turns sort by (turn, role, text), null first; a null role or text is empty;
repeated rows stay. Rows without `conv_id` form one conversation. An empty
table gives no rows; other columns are left out. A conversation becomes one
value, so it must fit in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.arrays import cut, let, running, text_blocks

SPAN = "struct<start:bigint,length:bigint>"
# The marks.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def format_conversations(turns: DataFrame, learned: str = LEARNED) -> DataFrame:
    """`conv_id`, `formatted` text and `loss_mask` of each conversation."""
    sorted_turns = turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("turn").cast("bigint").alias("turn"),
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    blocks = sorted_turns.select("conv_id", merged_turns(F.col("turns")).alias("blocks"))
    pieces = blocks.select("conv_id", F.transform("blocks", lambda b: _piece(b, learned)).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        loss_mask(F.col("pieces")).alias("loss_mask"),
    )


def merged_turns(turns: Column) -> Column:
    """Adjacent turns of one role as one struct of the role and the array of texts."""
    n = F.size(turns)
    begins = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    ends = F.concat(F.slice(begins, 2, F.size(begins)), F.array(n))
    return F.zip_with(
        begins,
        ends,
        lambda a, b: F.struct(
            F.get(turns, a)["role"].alias("role"),
            F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts"),
        ),
    )


def _piece(block: Column, learned: str) -> Column:
    """A block's text, and the lengths of its turns' escaped texts if they are learned."""
    texts = F.transform(block["texts"], escaped)
    head = F.concat(F.lit(START), escaped_role(block["role"]), F.lit("\n"))
    return F.struct(
        F.concat(head, F.array_join(texts, SEPARATOR), F.lit(END)).alias("text"),
        F.length(head).alias("head"),
        (block["role"] == learned).alias("learned"),
        F.transform(texts, F.length).alias("lengths"),
    )


def loss_mask(pieces: Column) -> Column:
    """Spans of the learned texts, from the lengths of what stands before them."""

    def texts(piece: Column, at: Column) -> Column:
        steps = F.transform(piece["lengths"], lambda n: (n + len(SEPARATOR)).cast("bigint"))
        spans = F.zip_with(
            piece["lengths"],
            running(steps),
            lambda n, before: F.struct(
                (at + piece["head"] + before).alias("start"), n.cast("bigint").alias("length")
            ),
        )
        return F.when(piece["learned"], spans).otherwise(F.array().cast(f"array<{SPAN}>"))

    def spans(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda p: F.length(p["text"]).cast("bigint"))
        return F.flatten(F.zip_with(pieces, running(lengths), texts))

    return let(pieces, spans)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    blocks = F.split(formatted, r"<\|im_end\|>\n", -1)
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))

    def turns(block: Column) -> Column:
        inner = F.substring(block, len(START) + 1, F.length(block))
        cut = F.position(F.lit("\n"), inner)
        role = unescaped_role(F.substring(inner, F.lit(1), cut - 1))
        texts = F.split(F.substring(inner, cut + 1, F.length(inner)), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, mask: Column) -> Column:
    """The text under the mask, unescaped, nothing between its spans."""

    def learned(blocks: Column) -> Column:
        texts = F.transform(mask, lambda s: unescaped(cut(blocks, s["start"], s["start"] + s["length"])))
        return F.array_join(texts, "")

    return let(text_blocks(formatted), learned)


def digest(formatted: DataFrame) -> DataFrame:
    """Sizes and hashes of what is read back from the formatted texts."""
    read = formatted.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    listed = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
