"""Preference pairs: the shared turns once as prompt, then two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablesync.llm.words import written


def rendered(turn: Column) -> Column:
    """One turn as text. The role and end markers are fixed."""
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _common(a: Column, b: Column) -> Column:
    """Leading turns that two conversations share, role and text alike."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y)
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs.cast("int") - 1).otherwise(n)


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _mask(turns: Column) -> Column:
    """Character spans (start, end) of the rendered turns that train: what the assistant says and its end marker."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a: Column, turn: Column) -> Column:
        length = F.length(rendered(turn))
        body = a["at"] + F.length(turn["role"]) + 5
        span = F.struct(body.alias("start"), (a["at"] + length - 1).alias("end"))
        spans = F.when(turn["role"] == "assistant", F.concat(a["spans"], F.array(span))).otherwise(a["spans"])
        return F.struct((a["at"] + length).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, step, lambda a: a["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``chosen`` and ``rejected`` (arrays of struct<role, text>) to prompt and completions; other columns stay.

    The longest common prefix of turns is rendered once, as ``prompt``. The remaining turns of each side
    are its completion, with the spans that train. All are expressions over the row: no shuffle.
    A null side is a conversation without turns: the prompt is empty and the other side whole.
    If one side begins with all turns of the other, the shorter one's completion is empty.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = {c: F.coalesce(c, empty) for c in ("chosen", "rejected")}
    others = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    common = pairs.withColumns(sides).withColumn("prompt_turns", _common(F.col("chosen"), F.col("rejected")))
    rest = {c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c) - F.col("prompt_turns"), F.lit(0))) for c in sides}
    return common.select(
        *[c for c in others if c != "prompt_turns"],
        "prompt_turns",
        _text(F.slice("chosen", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        *[x for c, r in rest.items() for x in (_text(r).alias(f"{c}_completion"), _mask(r).alias(f"{c}_mask"))],
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id and ``turns``, ordered by turn, then role and text, so that repeated turns have a fixed order.

    Null roles and texts count as empty. Turns of a null conv_id form one conversation.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sorted_turns = F.array_sort(F.collect_list(turn))
    return turns.groupBy("conv_id").agg(
        F.transform(sorted_turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def numbered(rows: DataFrame, *group: str) -> DataFrame:
    """``rows`` with ``number``, from 0 within a group of the whole table in the order of ``key``.

    Keys lie in ranges (``key`` >> 33). Counts per group and range, their prefix sums and a
    numbering inside each range make the number, so a group that holds most rows is numbered by many tasks.
    """
    ranged = rows.withColumn("range", F.shiftright("key", 33))
    counts = ranged.groupBy(*group, "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*group, "range").orderBy("key")
    placed = ranged.withColumn("inside", F.row_number().over(inside) - 1).join(starts, [*group, "range"])
    return placed.withColumn("number", F.col("inside") + F.col("base")).drop("range", "inside", "base")


def _last_answer(turns: Column) -> Column:
    """The place of the last assistant turn, from 1; 0 without one."""
    at = F.array_position(F.reverse(F.transform(turns, lambda t: t["role"])), "assistant")
    return F.when(at > 0, F.size(turns) + 1 - at).otherwise(0).cast("int")


def other_answers(talks: DataFrame, lone: DataFrame) -> DataFrame:
    """``key`` and ``donor``: to each of ``lone`` (key) with an assistant turn a conversation whose last one says something else.

    ``talks`` has key, turns and last. Answers are alike in class if their lengths have as many binary digits.
    The different answers of a class stand in a ring, in the order of the first conversation
    with each. A conversation takes the answer after its own; of several with one answer each further one takes the
    next but one, and so on, so that no answer is taken much more often than others. If a
    class has a single answer, those of the next class are taken. Only keys, hashes and counts are shuffled.
    """
    text = F.get("turns", F.col("last") - 1)["text"]
    answered = talks.where("last > 0").select("key", F.length(F.bin(F.length(text).cast("long"))).alias("class"), F.xxhash64(text).alias("answer"))
    answered = written(talks.sparkSession, answered, "answers")
    ring = numbered(answered.groupBy("class", "answer").agg(F.min("key").alias("key")), "class")
    ring = written(talks.sparkSession, ring.select("class", "answer", F.col("key").alias("donor"), "number"), "answer-rings")
    around = Window.partitionBy(F.lit(0)).orderBy("class")  # one row per class: as many as an int has digits
    sizes = ring.groupBy("class").agg(F.count("*").alias("size"))
    after = lambda c: F.coalesce(F.lead(c).over(around), F.first(c).over(around))
    sizes = sizes.select("class", "size", after("class").alias("next"), after("size").alias("next_size"))
    own = numbered(answered.join(lone, "key", "left_semi"), "class", "answer").withColumnRenamed("number", "turn")
    own = own.join(ring.drop("donor"), ["class", "answer"]).join(sizes, "class")
    several = F.col("size") > 1
    place = F.when(several, F.expr("(number + 1 + turn % (size - 1)) % size")).otherwise(F.expr("turn % next_size"))
    wanted = own.where(several | (F.col("next") != F.col("class"))).select(
        "key", F.when(several, F.col("class")).otherwise(F.col("next")).alias("class"), place.alias("number")
    )
    return wanted.join(ring.drop("answer"), ["class", "number"]).select("key", "donor")


def op4_preference_format(turns: DataFrame) -> DataFrame:
    """Preference pairs from a table of conversations (conv_id, turn, role, text).

    Conversations that open with the same turn are answers to one prompt. In the order of conv_id over the
    whole table, each odd one is chosen and the next one rejected: at most one of an opening has no partner.
    The rejected side of such a one is derived: its own turns, but the last one of the assistant is replaced by
    the last one of another conversation, named by the rejected id (see ``other_answers``). Without an assistant turn, or if all
    last answers of the table are the same, it is a chosen side alone, whose rejected id is null. So each
    conversation is in one row, and in further ones only as the source of an answer. An empty table gives no rows; other
    columns are not looked at.
    """
    # ranges of conv_id, one after the other; a key numbers the rows in that order, null first
    talks = conversations_of(turns.repartitionByRange("conv_id")).sortWithinPartitions("conv_id")
    talks = talks.withColumns({"key": F.monotonically_increasing_id(), "last": _last_answer(F.col("turns"))})
    talks = written(turns.sparkSession, talks, "conversations")
    openings = numbered(talks.select("key", F.xxhash64(F.get("turns", F.lit(0))).alias("opening")), "opening")
    side = lambda odd: F.max(F.when(F.col("number") % 2 == odd, F.col("key")))
    pair = F.floor(F.col("number") / 2).alias("pair")
    pairs = openings.groupBy("opening", pair).agg(side(0).alias("key"), side(1).alias("other"))
    pairs = written(turns.sparkSession, pairs.select("key", "other"), "pairs")
    pairs = pairs.join(other_answers(talks, pairs.where("other IS NULL").select("key")), "key", "left")
    pairs = pairs.select("key", F.coalesce("other", "donor").alias("other"), F.col("donor").isNotNull().alias("derived"))
    chosen = talks.select("key", F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"), "last")
    others = talks.select(
        F.col("key").alias("other"), F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"), F.get("turns", F.col("last") - 1).alias("answer")
    )
    before = F.slice("chosen", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0)))
    after = F.slice("chosen", F.col("last") + 1, F.size("chosen"))
    replaced = F.concat(before, F.array("answer"), after)
    pairs = pairs.join(chosen, "key").join(others, "other", "left")
    pairs = pairs.withColumn("rejected", F.when(F.col("derived"), replaced).otherwise(F.col("rejected")))
    return format_pairs(pairs).select(
        "chosen_id", "rejected_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), "prompt",
        "chosen_completion", "chosen_mask", "rejected_completion", "rejected_mask",
    )
