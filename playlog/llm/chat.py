"""Chat formatting: conversations as windows of text for training, with a mask of what the model is to learn.

A turn is written ``<turn>role<text>text</turn>``. Marks inside roles and texts get a backslash behind their ``<``, and
marks so escaped get one more, so that nothing within a turn can be taken for a mark and all is read back as it was.

A conversation that fits the budget is one window. A longer one is cut between turns: prefix sums of the turns' tokens
deal them to strides, so that a window holds what starts within one stride; a turn that would carry its window over
the budget stands by itself. Every window but the first repeats the opening system turn, and the last few turns before
its own if they are short. The loss mask has the texts of assistant turns; repeated ones are context and are masked, so
each assistant text is learned once. A single turn longer than the budget is kept whole in a window of its own.

Only DataFrame functions are used: a conversation's turns pass one task in order, where Spark spills what doesn't fit;
what is gathered into one row is a window, which the budget bounds. Turns go by turn number, nulls first; equal ones by
role and text. Defined results: a null text or role is an empty one; a null conversation is one of its own; equal rows
are turns of their own; an empty text is in the mask with length 0; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The template's marks.
TURN, TEXT, END = "<turn>", "<text>", "</turn>"
ROLES = {"system": "system", "learned": "assistant"}
#: Tokens of a window, and of the turns that it repeats; how many these are at most.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 1024, 256, 2


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)(turn>|text>|/turn>)", r"<\\$1$2")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)(turn>|text>|/turn>)", "<$1$2")


def tokens_of(text: Column) -> Column:
    """An upper estimate without a tokenizer: one for every four bytes begun, and four for the marks."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + 4


def _numbered(conversations: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """Turns as they are written, numbered, with the tokens and characters before them."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    body = escaped(F.col("text"))
    written = rows.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"), tokens(F.col("text")).alias("tokens"))
    written = written.withColumns({"piece": F.concat("head", "body", F.lit(END)), "text_at": F.char_length("head").cast("long"), "text_chars": F.char_length("body").cast("long")}).drop("head", "body")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = {
        "n": F.row_number().over(order).cast("long"),
        "tokens_before": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
        "chars_before": F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)).cast("long"),
        "longest": F.max("tokens").over(Window.partitionBy("conv_id")),
        "opens": F.first(F.struct((F.col("role") == ROLES["system"]).alias("is_system"), "piece", "tokens")).over(order),
    }
    backs = {f"back{k}": F.lag(F.struct("n", "piece", "tokens"), k).over(order) for k in range(1, HISTORY_TURNS + 1)}
    return written.withColumns(sums).withColumns(backs)


def windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, tokens: Callable[[Column], Column] = tokens_of) -> DataFrame:
    """(conv_id, window, repeated, tokens, formatted, loss): the texts to train on.

    ``window`` counts from 0 within a conversation; ``repeated`` turns at the head come from earlier windows; ``loss``
    is an array of struct(start, length), code points of ``formatted``.
    """
    opens = F.when(F.col("opens.is_system"), F.col("opens.tokens")).otherwise(F.lit(0))
    rows = _numbered(conversations, tokens).withColumn("room", F.greatest(F.lit(budget) - opens - history_tokens, F.lit(1)))
    whole = F.sum("tokens").over(Window.partitionBy("conv_id")) <= budget
    stride = F.greatest(F.col("room") - F.col("longest"), F.floor((F.col("room") + 1) / 2))
    rows = rows.withColumn("stride", F.when(whole, F.lit(None)).otherwise(stride))
    rows = rows.withColumn("cut", F.coalesce(F.floor(F.col("tokens_before") / F.col("stride")), F.lit(0)))
    alone = F.coalesce(F.col("tokens_before") + F.col("tokens") - F.col("cut") * F.col("stride") > F.col("room"), F.lit(False))
    rows = rows.withColumn("alone", alone)

    # what a window repeats is known at its first turn: the opening system turn, and turns before it within their tokens
    backs, held, fits = [], F.lit(0).cast("long"), F.lit(True)
    for k in range(1, HISTORY_TURNS + 1):
        back = F.col(f"back{k}")
        held = held + back["tokens"]
        fits = fits & back.isNotNull() & (held <= history_tokens) & ~((back["n"] == 1) & F.col("opens.is_system"))
        backs.insert(0, F.when(F.coalesce(fits, F.lit(False)), F.struct(back["piece"].alias("piece"), back["tokens"].alias("tokens"))))
    system = F.when(F.col("opens.is_system") & (F.col("n") > 1), F.struct(F.col("opens.piece").alias("piece"), F.col("opens.tokens").alias("tokens")))
    context = F.filter(F.array(system, *backs), lambda t: t.isNotNull())
    own = F.struct("n", "piece", "tokens", "chars_before", "text_at", "text_chars", (F.col("role") == ROLES["learned"]).alias("learned"))
    first = F.lag("n").over(Window.partitionBy("conv_id", "cut", "alone").orderBy("n")).isNull()
    rows = rows.select("conv_id", "cut", "alone", own.alias("own"), F.when(first, F.struct("n", context.alias("turns"))).alias("context"))
    found = rows.groupBy("conv_id", "cut", "alone").agg(F.sort_array(F.collect_list("own")).alias("own"), F.min("context")["turns"].alias("context"))  # a budget's turns at most
    text = lambda turns: F.array_join(F.transform(turns, lambda t: t["piece"]), "")
    sums = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    found = found.withColumn("head", text(F.col("context")))
    at = lambda t: F.char_length("head") + t["chars_before"] - F.col("own")[0]["chars_before"] + t["text_at"]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("cut", "alone")) - 1
    return found.select(
        "conv_id",
        place.cast("long").alias("window"),
        F.size("context").cast("long").alias("repeated"),
        (sums(F.col("context")) + sums(F.col("own"))).alias("tokens"),
        F.concat("head", text(F.col("own"))).alias("formatted"),
        F.transform(F.filter("own", lambda t: t["learned"]), lambda t: F.struct(at(t).cast("long").alias("start"), t["text_chars"].alias("length"))).alias("loss"),
    )


def turns_of(formatted: Column, repeated: Column) -> Column:
    """Turns as array of struct(role, text), read from a window's text, without those it repeats."""
    pieces = F.split(formatted, END)
    own = F.slice(pieces, repeated.cast("int") + 1, F.greatest(F.size(pieces) - 1 - repeated.cast("int"), F.lit(0)))
    parts = F.transform(own, lambda p: F.split(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 2))
    return F.transform(parts, lambda p: F.struct(unescaped(p[0]).alias("role"), unescaped(p[1]).alias("text")))


def learned_of(formatted: Column, loss: Column) -> Column:
    """The texts under the mask, as array of string."""
    return F.transform(loss, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def read_back(found: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of windows' texts and masks alone; a digest takes a conversation's texts together."""
    turns = turns_of(F.col("formatted"), F.col("repeated"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = found.select("conv_id", F.struct("window", lines.alias("lines"), F.array_join(learned_of(F.col("formatted"), F.col("loss")), "").alias("learned")).alias("part"), F.size(turns).alias("n"), F.char_length("formatted").alias("chars"))
    own = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    joined = lambda field: F.array_join(F.transform("parts", lambda p: p[field]), "")
    return own.select("conv_id", "n_turns", F.sha2(joined("lines").cast("binary"), 256).alias("turns_sha256"), F.char_length(joined("learned")).cast("long").alias("loss_chars"), F.sha2(joined("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``conversations`` and one more, numbered -7, whose texts look like other templates' marks."""
    text = r"\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).unionByName(probe)
