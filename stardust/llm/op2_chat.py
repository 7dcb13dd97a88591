"""Chat formatting in budgeted windows, with DataFrame functions only.

Every turn is written as ``<s>[INST]role[/INST]text</s>``. A control string
inside a role or a text gets a backslash after its first character (one more, if
it has some), and ``unescape`` takes one away, so texts come back as they were.

Prefix sums of the turns' tokens choose the windows. A window that begins at a turn
has the system turn, the earlier turns that fit ``HISTORY`` tokens, and then as many
turns as the budget holds: the prefix sums tell, for every turn, the first that a
window beginning there has no room for. A conversation's windows begin at its first
turn and wherever these pointers lead from there, which pointer doubling marks in as
many rounds as the windows' number has bits. So windows are as full as whole turns
allow, and none is over the budget unless a single turn is. A conversation's leading
system turn is repeated in every window. Repeated turns bear no loss: each assistant
text bears it once.

Defined results: null roles and texts are empty; a null conversation id is a
conversation of its own; turns with the same number go by role, then text;
repeated rows are turns of their own; a turn over the budget stays whole; a
conversation of a system turn alone has one window; an empty table gives an empty
result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"
BUDGET, HISTORY = 1024, 256
TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]"  # a turn's tokens: letter runs, digits, other signs
FRAME = 4                                 # tokens of a turn's marks


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*/?(?:s>|INST\]))", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*/?(?:s>|INST\]))", "$1$2")


def windows(df: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``df(conv_id, turn, role, text)`` as rows ``conv_id, window, formatted,
    repeated`` (turns at its head that earlier windows have), ``tokens`` and
    ``loss`` (spans of code points: ``start``, ``length``)."""
    t = df.select(F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("tok", (F.regexp_count("role", F.lit(TOKEN)) + F.regexp_count("text", F.lit(TOKEN)) + FRAME).cast("long"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("nth", F.row_number().over(order)).withColumn("head", F.first("role").over(order) == "system").withColumn("head_tok", F.first("tok").over(order))
    t = t.withColumn("sys", F.when(F.col("head"), F.col("head_tok")).otherwise(0))
    t = t.withColumn("is_sys", F.col("head") & (F.col("nth") == 1)).withColumn("r", F.col("nth") - F.when(F.col("head"), 1).otherwise(0))
    t = t.withColumn("at", F.when(F.col("is_sys"), 0).otherwise(F.coalesce(F.sum("tok").over(ahead), F.lit(0)) - F.col("sys")))
    t = t.withColumn("piece", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID), escape(F.col("text")), F.lit(CLOSE)))
    t = t.withColumn("skip", F.length(F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID)))).withColumn("target", F.col("role") == "assistant")
    t = materialize(t.select("conv", "r", "at", "tok", "sys", "is_sys", "piece", "skip", "target"), "chat-turns")

    begins = starts(t.where("not is_sys").select("conv", "r", "at", "tok", "sys"), budget, history)
    begins = materialize(begins.select(F.col("conv").alias("b_conv"), F.col("r").alias("b_r")), "chat-begins")
    marked = t.join(begins, F.col("conv").eqNullSafe(F.col("b_conv")) & (F.col("r") == F.col("b_r")), "left")
    window = F.sum((F.col("b_r") > 1).cast("int")).over(Window.partitionBy("conv").orderBy("r").rowsBetween(Window.unboundedPreceding, 0))
    t = materialize(marked.withColumn("window", F.coalesce(window, F.lit(0))).drop("b_conv", "b_r").withColumnRenamed("r", "nth"), "chat-windowed")

    own = t.where("not is_sys").groupBy("conv", "window").agg(
        F.min("at").alias("begin"), F.min("nth").alias("first"), F.max("sys").alias("w_sys"), F.sum("tok").alias("w_tok"))
    own = own.select(F.col("conv").alias("w_conv"), F.col("window").alias("w"), "begin", "first",
                     F.greatest(F.lit(0), F.least(F.lit(history), budget - F.col("w_sys") - F.col("w_tok"))).alias("room"))
    # a turn has FRAME tokens at least, so no more than this many fit a history
    back = own.where("w > 0").withColumn("of", F.explode(F.sequence(F.greatest(F.lit(1), F.col("first") - F.floor(F.col("room") / FRAME)), F.col("first") - 1)))
    turns = t.where("not is_sys")
    past = turns.join(back, F.col("conv").eqNullSafe(F.col("w_conv")) & (F.col("nth") == F.col("of"))).where(F.col("begin") - F.col("at") <= F.col("room"))
    head = t.where("is_sys").select("conv", "piece", "tok", "skip").join(own.where("w > 0"), F.col("conv").eqNullSafe(F.col("w_conv")))
    no = F.lit(False)
    parts = (t.select("conv", "window", F.lit(2).alias("kind"), "nth", "piece", "tok", "skip", "target")
             .unionByName(past.select("conv", F.col("w").alias("window"), F.lit(1).alias("kind"), "nth", "piece", "tok", "skip", no.alias("target")))
             .unionByName(head.select("conv", F.col("w").alias("window"), F.lit(0).alias("kind"), F.lit(1).alias("nth"), "piece", "tok", "skip", no.alias("target"))))
    got = parts.groupBy("conv", "window").agg(F.array_sort(F.collect_list(F.struct("kind", "nth", "piece", "skip", "target"))).alias("p"), F.sum("tok").alias("tokens"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate("p", start, lambda a, x: F.struct(
        (a["at"] + F.length(x["piece"])).alias("at"),
        F.when(x["target"], F.concat(a["spans"], F.array(F.struct((a["at"] + x["skip"]).alias("start"), (F.length(x["piece"]) - x["skip"] - len(CLOSE)).alias("length"))))).otherwise(a["spans"]).alias("spans")))
    return got.select(F.col("conv").alias("conv_id"), F.col("window").cast("int"), F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
                      F.size(F.filter("p", lambda x: x["kind"] < 2)).alias("repeated"), "tokens", spans["spans"].alias("loss"))


def starts(t: DataFrame, budget: int, history: int) -> DataFrame:
    """``conv, r`` of the turns that windows begin at. ``t(conv, r, at, tok, sys)``: the
    turns (numbered from 1), the tokens before and of each, and of the system turn."""
    order = Window.partitionBy("conv").orderBy("at")
    t = t.withColumn("hist", F.col("at") - F.min("at").over(order.rangeBetween(-history, 0)))
    # ends of turns and of windows' room in one order: so many turns end within the room
    room = F.col("at") + budget - F.col("sys") - F.col("hist")
    marks = t.select("conv", "r", F.explode(F.array(F.struct((F.col("at") + F.col("tok")).alias("v"), F.lit(0).alias("ask")), F.struct(room.alias("v"), F.lit(1).alias("ask")))).alias("m"))
    marks = marks.select("conv", "r", "m.*")
    fits = F.sum(1 - F.col("ask")).over(Window.partitionBy("conv").orderBy("v", "ask").rowsBetween(Window.unboundedPreceding, 0))
    jump = marks.withColumn("fits", fits).where("ask = 1").select("conv", F.col("r").cast("long").alias("a"), F.greatest(F.col("r") + 1, F.col("fits") + 1).cast("long").alias("b"))
    last = t.groupBy(F.col("conv").alias("of")).agg(F.max("r").alias("last"))
    jump = materialize(jump.join(last, F.col("conv").eqNullSafe(F.col("of"))).where("b <= last").select("conv", "a", "b"), "chat-jumps")
    begin = jump.where("a = 1").select("conv", F.lit(1).cast("long").alias("r"))
    while not jump.isEmpty():  # after k rounds: the first 2 ** k windows, and pointers 2 ** k windows on
        to = jump.select(F.col("conv").alias("of"), "a", "b")
        on = begin.join(to, F.col("conv").eqNullSafe(F.col("of")) & (F.col("r") == F.col("a"))).select("conv", F.col("b").alias("r"))
        begin = materialize(begin.unionByName(on), "chat-starts")
        far = to.select("of", F.col("a").alias("a2"), F.col("b").alias("b2"))
        jump = materialize(jump.join(far, F.col("conv").eqNullSafe(F.col("of")) & (F.col("b") == F.col("a2"))).select("conv", "a", F.col("b2").alias("b")), "chat-jumps")
    return begin


def read_back(w: DataFrame) -> DataFrame:
    """Per window the turns it adds (``role``, ``text``, in order) and the
    unescaped text under its loss mask, from its formatted text alone."""
    def turn(x: Column) -> Column:
        halves = F.split(F.substr(x, F.lit(len(OPEN) + 1)), r"\[/INST\]", 2)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    marked = F.split("formatted", CLOSE)
    turns = F.slice(F.transform(marked, turn_or_none(turn)), F.col("repeated") + 1, F.size(marked) - 1 - F.col("repeated"))
    loss = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return w.select("conv_id", "window", F.length("formatted").alias("chars"), turns.alias("turns"), F.array_join(loss, "").alias("loss_text"))


def turn_or_none(turn):
    return lambda x: F.when(x != "", turn(x))  # what follows the last mark is empty


def digests(w: DataFrame) -> DataFrame:
    """Per conversation what ``read_back`` finds in its windows. A conversation's
    whole text meets in one row here, as its digest asks for."""
    r = read_back(w).select("conv_id", "window", "chars", "loss_text", F.size("turns").alias("n"), F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said"))
    g = r.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"),
                                 F.array_sort(F.collect_list(F.struct("window", "said", "loss_text"))).alias("p"))
    said, loss = F.array_join(F.transform("p", lambda x: x["said"]), ""), F.array_join(F.transform("p", lambda x: x["loss_text"]), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return g.select("conv_id", F.col("n_turns").cast("long"), sha(said).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                    sha(loss).alias("loss_sha256"), F.col("formatted_chars").cast("long"), "n_windows")


def op2_chat(spark, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    return digests(materialize(windows(c.unionByName(probe)), "chat-windows"))
