"""Chat formatting by prefix-target expansion, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Text without control strings: a backslash becomes ``\\0`` and ``<|`` becomes ``<\\1|``; see :func:`unescape`."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1|"))


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`: after it every backslash of the text is followed by 0, so ``\\1`` can only be a mark."""
    return F.replace(F.replace(text, F.lit("<\\1|"), F.lit("<|")), F.lit("\\0"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\2"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\2"), F.lit("\n")))


def prefix_targets(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One example for each assistant turn: all turns before it as context, and that reply alone trainable.

    Returns conv_col, example int (from 1 in each conversation), text string, loss_start and loss_length bigint (in code
    points, from 0): the trainable stretch of the text. A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n`` with
    control strings in roles and texts escaped reversibly. If turns follow the last reply, or there is no reply, one more
    example holds the whole conversation with nothing trainable (loss_length 0 and loss_start null), so that no turn is
    lost. Null texts and roles count as empty; turns without a number come first, those with equal numbers are ordered by role
    and text; repeated rows are kept; rows with a null conversation id form one conversation; an empty table gives no rows. Other columns are left out.

    One shuffle by conversation. A conversation's turns are held in one row, so one must stay below Spark's 2 GB of a row;
    its examples are made one by one from it.
    """
    row = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    convs = turns.select(F.col(conv_col).alias("conv"), row.alias("row")).groupBy("conv").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    head = lambda x: F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"))
    convs = convs.select(
        "conv",
        F.transform("rows", lambda x: x["role"] == "assistant").alias("reply"),
        F.transform("rows", head).alias("heads"),
        F.transform("rows", lambda x: escape(x["text"])).alias("bodies"),
    )
    convs = convs.withColumns(
        {
            "ends": F.filter(F.transform("reply", lambda x, k: F.when(x, k + 1)), lambda x: x.isNotNull()),
            "pieces": F.zip_with("heads", "bodies", lambda a, b: F.concat(a, b, F.lit(END + "\n"))),
        }
    )
    turns_in = F.size("reply")
    ends = F.when(F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)) == turns_in, F.col("ends")).otherwise(F.concat("ends", F.array(turns_in)))
    rows = convs.select("conv", "reply", "heads", "bodies", "pieces", F.posexplode(ends).alias("k", "end"))
    trains = F.element_at("reply", F.col("end"))
    rows = rows.select(
        "conv",
        (F.col("k") + 1).alias("example"),
        F.array_join(F.slice("pieces", 1, F.col("end") - 1), "").alias("context"),
        F.element_at("pieces", F.col("end")).alias("last"),
        F.when(trains, F.element_at("heads", F.col("end"))).alias("head"),
        F.when(trains, F.element_at("bodies", F.col("end"))).alias("body"),
    )
    return rows.select(
        F.col("conv").alias(conv_col),
        "example",
        F.concat("context", "last").alias("text"),
        (F.length("context") + F.length("head")).cast("long").alias("loss_start"),
        F.coalesce(F.length("body"), F.lit(0)).cast("long").alias("loss_length"),
    )


def read_back(examples: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """What formatted examples hold, parsed from their text and loss mask alone.

    conv_col, n_turns, turns_sha256 (over role, line feed, text, line feed of each turn of the last example), loss_chars and
    loss_sha256 (all trainable text, unescaped, in order, nothing between), formatted_chars (of all the examples).
    """
    loss = F.when(F.col("loss_length") > 0, F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int"))).otherwise("")
    convs = examples.groupBy(F.col(conv_col).alias("conv")).agg(
        F.max_by("text", "example").alias("text"),
        F.array_sort(F.collect_list(F.struct("example", unescape(loss).alias("loss")))).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    parts = F.filter(F.split(F.col("text"), r"<\|im_end\|>\n"), lambda x: x != "")
    convs = convs.withColumn("turns", F.transform(parts, lambda x: F.substring(x, len(START) + 1, 1 << 30)))
    role = lambda x: unescape_role(F.substring_index(x, "\n", 1))
    body = lambda x: unescape(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(role(x), F.lit("\n"), body(x), F.lit("\n"))), "")
    trained = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return convs.select(
        F.col("conv").alias(conv_col),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )
