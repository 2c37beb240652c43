"""Chat formatting by quotation linking, in DataFrame operations only.

Leading ``>`` signs give a line its quote level. Runs of lines of one level are passages.
Unquoted passages and their lines belong to the first message of the conversation that holds
them; quoted ones are looked up there by the hash of their normalised text, which says whom a
message answers. Messages that answer one another form a thread, and a conversation lists its
threads in the order of their first messages, each reply after its original, without quotes.

No step needs a whole conversation in one task: lookups are many-to-one, threads come from
joins, and positions are counted in ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinmart.llm.components import components
from kinmart.workspace import stage

MARKS = r"^[ \t]*(?:>[ \t]*)+"


def level(line: Column) -> Column:
    """Number of ``>`` in the marks a line begins with."""
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def lines_of(messages: DataFrame) -> DataFrame:
    """(uid, conv_id, turn, run, level, place, line): every line without its marks."""
    split = F.posexplode(F.split("text", "\n", -1)).alias("place", "whole")
    lines = messages.select("uid", "conv_id", "turn", split)
    lines = lines.withColumn("level", level(F.col("whole")))
    lines = lines.withColumn("line", F.regexp_replace("whole", MARKS, ""))
    order = Window.partitionBy("uid").orderBy("place")
    new = F.coalesce((F.col("level") != F.lag("level").over(order)).cast("int"), F.lit(0))
    return lines.withColumn("new", new).withColumn("run", F.sum("new").over(order))


def units_of(lines: DataFrame) -> DataFrame:
    """(uid, conv_id, turn, level, key, weight): hashes of the passages and of their lines.

    A passage found whole outweighs any choice of its lines.
    """
    owner = ["uid", "conv_id", "turn", "level"]
    held = lines.groupBy(*owner, "run").agg(
        F.sort_array(F.collect_list(F.struct("place", "line"))).alias("held"),
    )
    whole = held.select(
        *owner,
        normalised(F.concat_ws(" ", "held.line")).alias("unit"),
        (F.size("held") + 1).cast("long").alias("weight"),
    )
    single = lines.select(
        *owner, normalised(F.col("line")).alias("unit"), F.lit(1).cast("long").alias("weight")
    )
    units = whole.unionByName(single).where("unit <> ''")
    return units.select(*owner, F.md5("unit").alias("key"), "weight")


def replies(units: DataFrame) -> DataFrame:
    """(uid, reply_uid, reply_to): the message each quoting message answers.

    Quotes of the least level decide, then the weight of what was found, then the later message.
    """
    first = (
        units.where("level = 0")
        .groupBy("conv_id", "key")
        .agg(F.min(F.struct("turn", "uid")).alias("first"))
    )
    quoted = units.where("level > 0")
    hits = quoted.join(stage(first, "quote-originals"), ["conv_id", "key"]).where("first.turn < turn")
    votes = hits.groupBy("uid", "level", "first").agg(F.sum("weight").alias("weight"))
    rank = F.struct(-F.col("level"), F.col("weight"), F.col("first.turn"), F.col("first.uid"))
    best = votes.groupBy("uid").agg(F.max_by("first", rank).alias("first"))
    return best.select(
        "uid", F.col("first.uid").alias("reply_uid"), F.col("first.turn").alias("reply_to")
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their position in the conversation, counted from 0.

    Range-partitioned by conversation and order, so a conversation that fills a third of the
    table lies in many tasks; each counts its own part and adds the sizes of earlier ones.
    """
    ranged = rows.repartitionByRange("conv_id", *order)
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "quote-ranges")
    known = ranged.withColumn("group", F.struct("conv_id"))
    sizes = known.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "group", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    own = Window.partitionBy("group", "part").orderBy(*order)
    placed = known.withColumn("own", F.row_number().over(own))
    joined = placed.join(before, ["group", "part"])
    position = (F.col("own") - 1 + F.col("before")).cast("long")
    return joined.withColumn("position", position).drop("group", "part", "own", "before")


def link_quotes(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, position, turn, role, content, reply_to, thread) of every message.

    ``content`` is the text without quoted lines and, where any were taken out, without blank
    lines at its ends; a null text is empty. ``reply_to`` is the turn of the answered message of
    the same conversation, an earlier one, or null; ``thread`` the first turn of its thread. In
    a conversation threads follow each other by first turn and messages of a thread by turn,
    nulls first. Messages without conversation or turn answer nothing. Repeated rows are
    messages each; of equal turns that hold a passage one is the original.
    """
    messages = conversations.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    messages = stage(messages.withColumn("quotes", F.col("text").rlike("(?m)^[ \\t]*>")), "quote-messages")
    busy = stage(messages.where("quotes").select("conv_id").distinct(), "quote-busy")
    lines = stage(lines_of(messages.join(busy, "conv_id", "left_semi")), "quote-lines")
    reply = stage(replies(units_of(lines)), "quote-replies")
    threads = stage(components(reply, "uid", "reply_uid"), "quote-threads")
    member = messages.select(F.col("uid").alias("node"), "turn").join(threads, "node")
    starts = member.groupBy("root").agg(F.min("turn").alias("thread"))
    named = threads.join(stage(starts, "quote-starts"), "root")
    named = named.select(F.col("node").alias("uid"), "root", "thread")
    own = lines.where("level = 0").groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("place", "line"))).alias("held")
    )
    own = own.select("uid", F.btrim(F.concat_ws("\n", "held.line"), F.lit("\n")).alias("own"))
    kept = messages.where("quotes").select("uid").join(own, "uid", "left")
    kept = kept.select("uid", F.coalesce("own", F.lit("")).alias("own"))
    rows = (
        messages.join(stage(kept, "quote-kept"), "uid", "left")
        .join(reply, "uid", "left")
        .join(stage(named, "quote-named"), "uid", "left")
    )
    rows = rows.select(
        "uid",
        "conv_id",
        "turn",
        "role",
        F.coalesce("own", "text").alias("content"),
        "reply_to",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("root", "uid").alias("root"),
    )
    placed = numbered(rows, ["thread", "root", "turn", "uid"])
    return placed.select("conv_id", "position", "turn", "role", "content", "reply_to", "thread")
