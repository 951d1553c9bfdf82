"""Chat formatting with budgeted windows.

A conversation becomes training windows of at most ``budget`` tokens cut at
turn borders.  Every turn is new in exactly one window.  A later window first
repeats the system turn and up to ``history`` tokens of the turns before it,
less if the new turns leave less; repeats are masked, so each assistant text
is a target once.  The system turn is never left out: a window exceeds the
budget only if that and its one new turn do so together.

Template: a turn is ``<|role|>text<//>``.  Inside texts ``\\`` is written
``\\b`` and ``<`` is ``\\l`` (in roles also ``|`` as ``\\p``), so no text can
hold a marker, and :func:`read_back` undoes it exactly.

Plan: turns fall into blocks of 1024 turn numbers of a conversation, and
blocks with more rows (null or repeated numbers) into pieces of 1024 rows in
order, so a conversation of any length is many bounded groups.  Prefix sums of
the turn tokens in a piece choose the spans greedily.  What crosses blocks is small:
the system turn and the last ``history`` tokens of the block before, found by
a window over one narrow row per block and joined back to the blocks.  A
window is built in one expression; only SQL functions are used.

Tokens are runs of letters, digits and underscores, or single other visible
characters; a turn costs two more for its markers.

Defined cases: a null text is empty and a null role is ''; a null
conversation id is one conversation; null turns come first; turns of equal
number (and repeated rows) are ordered by role, then text, and all kept; a
turn above the budget is kept whole, alone with the system turn in its window; a conversation of
a system turn alone gives one window; no rows give no windows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.scratch import Scratch

BUDGET = 1024
HISTORY = 128
BLOCK = 1024
CLOSE = "<//>"
TURN = "struct<turn:bigint,role:string,text:string,cost:int>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _opening(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.replace(escape(role), F.lit("|"), F.lit("\\p")), F.lit("|>"))


def _trailing(turns: Column, limit: int | Column) -> Column:
    """The last turns whose costs sum to at most ``limit``, in order."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast(f"array<{TURN}>").alias("kept"))
    got = F.aggregate(
        F.reverse(turns), start,
        lambda s, t: F.when(s["sum"] + t["cost"] <= limit,
                            F.struct((s["sum"] + t["cost"]).alias("sum"), F.concat(s["kept"], F.array(t)).alias("kept")))
        .otherwise(F.struct(F.lit(1 << 30).alias("sum"), s["kept"].alias("kept"))),
        lambda s: s["kept"])
    return F.reverse(got)


def _span_starts(turns: Column, room: Column) -> Column:
    """0-based first turns of the spans: a turn starts a new one when the
    prefix sum since the span's start would pass ``room``."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("starts"))

    def step(s, t):
        new = (s["i"] == 0) | (s["sum"] + t["cost"] > room)
        return F.struct(F.when(new, t["cost"]).otherwise(s["sum"] + t["cost"]).alias("sum"), (s["i"] + 1).alias("i"),
                        F.when(new, F.concat(s["starts"], F.array(s["i"]))).otherwise(s["starts"]).alias("starts"))

    return F.aggregate(turns, start, step, lambda s: s["starts"])


def _blocks(turns: DataFrame, conv: str, turn: str, role: str, text: str, history: int, scratch: Scratch) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(
        F.col(conv).alias("__conv"), F.floor(F.col(turn) / BLOCK).alias("__numbers"),
        F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), body.alias("text"),
                 (F.regexp_count(body, F.lit(r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]")) + 2).alias("cost")).alias("__t"))
    nth = F.row_number().over(Window.partitionBy("__conv", "__numbers").orderBy("__t")) - 1
    block = F.struct(F.col("__numbers").alias("numbers"), F.floor(nth / BLOCK).alias("piece"))
    rows = rows.withColumn("__block", block)  # the same partitioning serves both
    blocks = scratch.put(rows.groupBy("__conv", "__numbers", "__block").agg(F.sort_array(F.collect_list("__t")).alias("__turns")).drop("__numbers"), "blocks")
    order = Window.partitionBy("__conv").orderBy("__block")
    first = F.get("__turns", F.lit(0))
    narrow = blocks.select("__conv", "__block", F.when(first["role"] == "system", first).alias("__first"),
                           _trailing(F.col("__turns"), history).alias("__tail"))
    narrow = narrow.select(
        F.col("__conv").alias("__c"), F.col("__block").alias("__b"),
        F.first("__first").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__system"),
        F.lag("__tail").over(order).alias("__before"), (F.row_number().over(order) == 1).alias("__opens"))
    return blocks.join(narrow, F.col("__conv").eqNullSafe(F.col("__c")) & F.col("__block").eqNullSafe(F.col("__b")))


def _piece(t: Column, fresh) -> Column:
    opening = _opening(t["role"])
    return F.struct(F.concat(opening, escape(t["text"]), F.lit(CLOSE)).alias("piece"),
                    (fresh & (t["role"] == "assistant")).alias("target"),
                    F.length(opening).alias("skip"), F.length(escape(t["text"])).alias("size"))


def _loss(pieces: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s, p):
        span = F.struct((s["at"] + p["skip"]).alias("start"), p["size"].alias("length"))
        return F.struct((s["at"] + F.length(p["piece"])).alias("at"),
                        F.when(p["target"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(pieces, start, step, lambda s: s["spans"])


def format_windows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id``, ``block`` and ``window`` (its order),
    ``formatted``, ``loss`` (start and length of each target in it, in code
    points), ``n_repeated`` (turns at its head that earlier windows hold),
    ``n_turns`` (all its turns) and ``n_tokens``."""
    scratch = Scratch(turns.sparkSession, "chat")
    none = F.array().cast(f"array<{TURN}>")
    blocks = _blocks(turns, conv, turn, role, text, history, scratch)
    own = F.col("__opens") & F.col("__system").isNotNull()
    system_cost = F.coalesce(F.col("__system.cost"), F.lit(0))
    blocks = (
        blocks.withColumn("__body", F.when(own, F.slice("__turns", 2, F.greatest(F.size("__turns") - 1, F.lit(0)))).otherwise(F.col("__turns")))
        .withColumn("__before", F.filter(F.coalesce("__before", none), lambda t: ~t.eqNullSafe(F.col("__system"))))
        .withColumn("__starts", _span_starts(F.col("__body"), F.lit(budget - history) - system_cost))
        .withColumn("__starts", F.when(F.size("__starts") == 0, F.array(F.lit(0))).otherwise(F.col("__starts")))
    )
    system = F.when(F.col("__system").isNotNull(), F.array("__system")).otherwise(none)

    def tokens(ts: Column) -> Column:
        return F.aggregate(ts, F.lit(0), lambda s, t: s + t["cost"])

    def window(start, i):
        end = F.coalesce(F.get("__starts", i + 1), F.size("__body"))
        fresh = F.slice("__body", start + 1, end - start)
        # A turn costs two or more, so no more than half as many can be repeated.
        most = history // 2
        near = F.slice("__body", F.greatest(start - most, F.lit(0)) + 1, F.least(start, F.lit(most)))
        past = _trailing(F.concat(F.col("__before"), near), F.least(F.lit(history), F.lit(budget) - tokens(system) - tokens(fresh)))
        head_is_new = F.col("__opens") & (i == 0)
        pieces = F.concat(F.transform(system, lambda t: _piece(t, head_is_new)), F.transform(past, lambda t: _piece(t, F.lit(False))),
                          F.transform(fresh, lambda t: _piece(t, F.lit(True))))
        return F.struct(i.alias("window"), pieces.alias("pieces"),
                        (F.size(past) + F.when(head_is_new, F.lit(0)).otherwise(F.size(system))).alias("n_repeated"),
                        (tokens(system) + tokens(past) + tokens(fresh)).alias("n_tokens"))

    windows = blocks.select(F.col("__conv").alias("conv_id"), F.col("__block").alias("block"), F.explode(F.transform("__starts", window)).alias("__w"))
    return windows.select(
        "conv_id", "block", F.col("__w.window").alias("window"),
        F.array_join(F.transform("__w.pieces", lambda p: p["piece"]), "").alias("formatted"), _loss(F.col("__w.pieces")).alias("loss"),
        F.col("__w.n_repeated").alias("n_repeated"), F.size("__w.pieces").alias("n_turns"), F.col("__w.n_tokens").alias("n_tokens"))


def read_back(windows: DataFrame) -> DataFrame:
    """The windows with ``turns`` (role, text of their new turns) and
    ``targets`` (the texts under the loss mask), parsed from ``formatted``."""
    pieces = F.split("formatted", CLOSE, -1)
    fresh = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    role = lambda p: F.substring_index(p, "|>", 1)
    turns = F.transform(fresh, lambda p: F.struct(
        unescape(F.replace(F.substring(role(p), F.lit(3), F.length(p)), F.lit("\\p"), F.lit("|"))).alias("role"),
        unescape(F.substring(p, F.length(role(p)) + 3, F.length(p))).alias("text")))
    targets = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return windows.withColumn("turns", turns).withColumn("targets", targets)


def op3_chat_windows(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    back = read_back(format_windows(turns.unionByName(extra)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    by_conv = back.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("block", "window", told.alias("told"), F.array_join("targets", "").alias("loss")))).alias("w"),
        F.sum(F.size("turns")).alias("n_turns"), F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"), F.max("n_tokens").cast("long").alias("most_tokens"))
    joined = lambda part: F.array_join(F.transform("w", lambda x: x[part]), "")
    return by_conv.select("conv_id", "n_turns", F.sha2(joined("told"), 256).alias("turns_sha256"),
                          F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"),
                          "formatted_chars", "n_windows", "most_tokens")
