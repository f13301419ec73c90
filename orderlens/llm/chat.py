"""Chat formatting into budgeted windows, in DataFrame functions only.

Template: each turn is ``[role]text</s>``. In texts and roles ``&``, ``<``, ``[`` and ``]`` are written as
``&amp;``, ``&lt;``, ``&#91;`` and ``&#93;``, so no text can hold a mark and every window can be read back.

Windows follow from prefix sums of the turns' tokens. With a stride of half of what history and system turn leave
of the budget, a turn belongs to window ``floor((end - 1) / stride)``: at most one turn that began before it and
one stride of others. A turn longer than the stride has a window of its own, the only kind that may pass the
budget. Each window begins with the conversation's system turn (its first turn, where that has role ``system``)
and repeats the turns that fit ``history`` tokens before it. The loss mask covers the texts of assistant turns in
the window they belong to; where they are repeated as history they are masked.

Sums are taken per run of 256 turn numbers first, so a conversation of any length is spread over tasks. Turns
are ordered by (turn, role, text), null turns first. Null text and role count as empty, a null ``conv_id`` is a
conversation of its own, repeated rows are turns of their own, further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</s>"
#: Written form of the characters that marks are made of; the order matters when escaping.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;")]
RUN = 256


def escaped(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def estimated_tokens(rendered: Column) -> Column:
    """A token for each four bytes, rounded up; callers may pass a better estimate."""
    return F.ceil(F.octet_length(rendered) / 4).cast("bigint")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"])


def format_chats(turns: DataFrame, max_tokens: int = 1024, history: int = 256, tokens=estimated_tokens) -> DataFrame:
    """One row per window: conv_id, window, formatted, own (per turn in it), loss (start and length in characters)."""
    if not 0 < history < max_tokens:
        raise ValueError("history must be positive and smaller than the budget")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit("["), escaped(role), F.lit("]"))
    seg = F.concat(head, escaped(text), F.lit(END))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), F.length(head).alias("head"), seg.alias("seg"), tokens(seg).alias("n"),
    )
    run = F.floor(F.col("turn") / RUN)
    inside = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("run", run).withColumn("upto", F.sum("n").over(inside))
    runs = rows.groupBy("conv_id", run.alias("run")).agg(F.sum("n").alias("total"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    base = runs.select(
        F.col("conv_id").alias("c"), F.col("run").alias("r"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")
    )
    placed = local.join(base, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("run").eqNullSafe(F.col("r"))).select(
        "conv_id", "role", "head", "seg", "n", (F.col("base") + F.col("upto")).alias("end")
    )
    is_system = (F.col("role") == "system") & (F.col("end") == F.col("n"))
    system = placed.where(is_system).select("conv_id", F.col("seg").alias("sys_seg"), F.col("n").alias("sys_n"))
    rest = placed.where(~is_system)
    sys_n = F.coalesce("sys_n", F.lit(0))
    stride = F.greatest(F.lit(1), F.floor((max_tokens - history - sys_n) / 2))
    end = F.col("end") - sys_n
    own = (
        rest.join(system.select(F.col("conv_id").alias("c"), "sys_n"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
        .select(
            "conv_id", "role", "head", "seg", "n", end.alias("end"), (end - F.col("n")).alias("start"),
            (F.floor((end - 1) / stride) * 2 + F.when(F.col("n") > stride, 0).otherwise(1)).alias("window"),
        )
    )
    windows = own.groupBy("conv_id", "window").agg(F.min("start").alias("begin"))
    near = own.select(
        F.col("conv_id").alias("c"), "role", "head", "seg", "end", "start",
        F.explode(F.array(F.floor(F.col("start") / history), F.floor(F.col("start") / history) + 1)).alias("bucket"),
    )
    past = windows.withColumn("b", F.floor(F.col("begin") / history)).join(
        near,
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("b") == F.col("bucket"))
        & (F.col("end") <= F.col("begin")) & (F.col("begin") - F.col("start") <= history),
    )
    lead = system.join(
        windows.select(F.col("conv_id").alias("c"), "window", "begin"), F.col("conv_id").eqNullSafe(F.col("c")), "left"
    )
    loss = (F.col("role") == "assistant").alias("loss")
    parts = (
        own.select("conv_id", "window", F.col("start").alias("pos"), "seg", "head", F.lit(True).alias("own"), loss)
        .unionAll(past.select("conv_id", "window", "start", "seg", "head", F.lit(False), F.lit(False)))
        .unionAll(
            lead.select(
                "conv_id", F.coalesce("window", F.lit(-1)), F.lit(-1), F.col("sys_seg"), F.lit(0),
                F.coalesce(F.col("begin") == 0, F.lit(True)), F.lit(False),
            )
        )
    )
    entry = F.struct("pos", "seg", "head", "own", "loss")
    grouped = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(entry)).alias("p"))
    span = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(a: Column, x: Column) -> Column:
        here = F.struct(
            (a["at"] + x["head"]).alias("start"), (F.length(x["seg"]) - x["head"] - len(END)).alias("length")
        )
        spans = F.when(x["loss"], F.array_append(a["spans"], here)).otherwise(a["spans"])
        return F.struct((a["at"] + F.length(x["seg"])).alias("at"), spans.alias("spans"))

    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("p", lambda x: x["seg"]), "").alias("formatted"),
        F.transform("p", lambda x: x["own"]).alias("own"),
        F.aggregate("p", span, step, lambda a: a["spans"]).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per window: the turns it holds as (role, text), those that are its own, and the texts under the mask."""
    segs = F.split("formatted", END)
    cut = windows.select("*", F.slice(segs, 1, F.size(segs) - 1).alias("segs"))

    def turn(s: Column) -> Column:
        close = F.instr(s, "]")
        return F.struct(
            unescaped(F.substring(s, F.lit(2), close - 2)).alias("role"),
            unescaped(F.substring(s, close + 1, F.length(s))).alias("text"),
        )

    mine = F.filter(F.arrays_zip("turns", "own"), lambda x: x["own"])
    masked = F.transform("loss", lambda x: unescaped(F.substring("formatted", x["start"] + 1, x["length"])))
    return cut.withColumn("turns", F.transform("segs", turn)).select(
        "conv_id", "window", "formatted", "turns", F.transform(mine, lambda x: x["turns"]).alias("own_turns"),
        masked.alias("targets"),
    )
