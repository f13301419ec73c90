"""Ordered per-key operators (shift, fill, as-of) that never need one key in one task.

A panel is a frame with a key and an order. Ordinary keys are handled by a plain
window. A heavy key is cut into consecutive blocks of its order; each block is a
window group of its own, and what a block needs from its neighbours (last known
value, last n values) travels in one small edge row per block. Edges share the
partitioning of the blocks, so the rows themselves are shuffled once.

A row whose key is null belongs to no series: its shifted and filled values are null.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.dates import micros
from orderlens.operators.skew import DETECT, LIMITS, SkewLimits, find_heavy, heavy_rows, mark_heavy

BLOCK = "_block"
# Blocks per piece: time is not evenly filled, so cut finer than the row limit asks for.
OVERSPLIT = 4
INSTANTS = "array<struct<_t:bigint,_n0:double,_n1:double,_pieces:bigint>>"
# Sorts before every instant, and after every part of one.
BEFORE, AFTER = -(2**62), 2**62


@dataclass(frozen=True)
class Panel:
    """Rows with key and order; with heavy keys also a ``_block`` column.

    The block is null for ordinary keys and ascends with the order for heavy ones.
    """

    rows: DataFrame
    keys: list[str]
    ts: str
    tie: str
    heavy: DataFrame | None

    def with_rows(self, rows: DataFrame) -> "Panel":
        return Panel(rows, self.keys, self.ts, self.tie, self.heavy)

    def result(self) -> DataFrame:
        return self.rows.drop(BLOCK)

    def groups(self) -> list[str]:
        return [*self.keys, BLOCK] if self.heavy is not None else list(self.keys)

    def window(self, descending: bool = False) -> WindowSpec:
        order = [F.col(self.ts), F.col(self.tie)]
        return Window.partitionBy(*self.groups()).orderBy(
            *[c.desc() if descending else c.asc() for c in order]
        )

    def heavy_part(self) -> DataFrame:
        return heavy_rows(self.rows, self.keys, self.heavy)

    def with_edges(self, edges: DataFrame) -> DataFrame:
        """Left join of block edges; keys and block are also the window's partitioning."""
        return self.rows.join(edges, [*self.keys, BLOCK], "left")

    def in_series(self, value: Column) -> Column:
        """The value where the key is known, else null."""
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        return F.when(known, value)


def find_heavy_spans(
    df: DataFrame, keys: list[str], ts: str, tie: str, limits: SkewLimits = LIMITS
) -> DataFrame | None:
    """Heavy keys with their first and last instant, and the instants that are heavy themselves.

    A heavy instant holds more rows of its key than the limit allows; as with keys,
    there are at most ``1 / share`` of them. The search runs only when a key is heavy.
    """
    rows = df.select(*keys, micros(ts).alias("_t"), F.col(tie).cast("double").alias("_n"))
    heavy = find_heavy(
        rows, keys, limits, [F.min("_t").alias("_t0"), F.max("_t").alias("_t1")]
    )
    if heavy is None:
        return None
    instants = find_heavy(
        heavy_rows(rows, keys, heavy.select(*keys)).filter(F.col("_t").isNotNull()),
        [*keys, "_t"],
        limits,
        [F.min("_n").alias("_n0"), F.max("_n").alias("_n1")],
    )
    if instants is None:
        return heavy.withColumn("_instants", F.array().cast(INSTANTS))
    per_key = instants.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_t", "_n0", "_n1", "_pieces"))).alias("_instants")
    )
    side = per_key.withColumnsRenamed({k: f"_instant_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [heavy[k].eqNullSafe(side[f"_instant_{k}"]) for k in keys])
    joined = heavy.join(side, same, "left").drop(*[f"_instant_{k}" for k in keys])
    return joined.withColumn("_instants", F.coalesce("_instants", F.array().cast(INSTANTS)))


def with_span(heavy: DataFrame | None, times: DataFrame, ts: str) -> DataFrame | None:
    """Give heavy keys one common span, for keys counted on a table that has no time of its own."""
    if heavy is None:
        return None
    span = times.agg(F.min(micros(ts)).alias("a"), F.max(micros(ts)).alias("z")).first()
    return heavy.withColumns(
        {
            "_t0": F.lit(span["a"]),
            "_t1": F.lit(span["z"]),
            "_instants": F.array().cast(INSTANTS),
        }
    )


def make_panel(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tie: str,
    heavy: DataFrame | None | str = DETECT,
    limits: SkewLimits = LIMITS,
) -> Panel:
    """Cut heavy keys into blocks along ``(ts, tie)``; ``tie`` must be a number.

    The block of a row is its place between the first and the last instant of its
    key. A heavy instant starts blocks of its own, cut along the tie-break; rows
    after it in the same stretch of time follow in one more block. Blocks are
    structs that sort like the rows, so they never run against the order. Rows of
    a heavy key without a time come first, in a block of their own.
    """
    if isinstance(heavy, str):
        heavy = find_heavy_spans(df, keys, ts, tie, limits)
    if heavy is None:
        return Panel(df, keys, ts, tie, None)
    t, n = micros(ts), F.col(tie).cast("double")
    place = (t - F.col("_t0")) / (F.col("_t1") - F.col("_t0") + 1)
    stretch = F.floor(place * F.col("_pieces") * F.lit(OVERSPLIT)).cast("long")
    reached = F.filter("_instants", lambda x: x.getField("_t") <= t)
    last = F.try_element_at(reached, F.lit(-1))
    within = (n - last["_n0"]) / (last["_n1"] - last["_n0"] + 1)
    part = F.when(last["_t"] == t, F.floor(within * last["_pieces"] * F.lit(OVERSPLIT)).cast("long"))
    after = F.when(last["_t"].isNotNull(), F.lit(AFTER)).otherwise(F.lit(0))
    block = F.struct(
        F.coalesce(stretch, F.lit(-1).cast("long")).alias("stretch"),
        F.coalesce(last["_t"], F.lit(BEFORE)).alias("instant"),
        F.coalesce(part, after.cast("long")).alias("part"),
    )
    rows = (
        mark_heavy(df, keys, heavy)
        .withColumn(BLOCK, F.when(F.col("_pieces").isNotNull(), block))
        .drop("_pieces", "_t0", "_t1", "_instants")
    )
    return Panel(rows, keys, ts, tie, heavy.select(*keys))


def fill(panel: Panel, value: str, out: str, backward: bool = False) -> Panel:
    """Last known value per key; with ``backward`` leading gaps take the first known one.

    Both directions use frames that Spark evaluates in one sweep: running for the
    forward part, whole-group for the first value (a gap before the first known
    value can only be filled by exactly that value).
    """
    w = panel.window()
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    forward = F.last(value, ignorenulls=True).over(running)
    first = F.first(value, ignorenulls=True).over(whole)
    if panel.heavy is None:
        found = F.coalesce(forward, first) if backward else forward
        return panel.with_rows(panel.rows.withColumn(out, panel.in_series(found)))

    at = F.when(F.col(value).isNotNull(), F.struct(panel.ts, panel.tie))
    edges = panel.heavy_part().groupBy(*panel.groups()).agg(
        F.min_by(value, at).alias("_first"), F.max_by(value, at).alias("_last")
    )
    blocks = Window.partitionBy(*panel.keys).orderBy(BLOCK)
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    every = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select(
        *panel.groups(),
        F.last("_last", ignorenulls=True).over(before).alias("_carried"),
        F.first("_first", ignorenulls=True).over(every).alias("_earliest"),
    )
    found = [forward, F.col("_carried")]
    if backward:
        found += [F.col("_earliest"), first]
    rows = panel.with_edges(edges).withColumn(out, panel.in_series(F.coalesce(*found)))
    return panel.with_rows(rows.drop("_carried", "_earliest"))


def shift(
    panel: Panel, value: str, steps: list[int], names: list[str], ahead: bool = False
) -> Panel:
    """Value ``k`` rows earlier in the same key (later with ``ahead``), one column per step."""
    reach = max(steps)
    # One direction of sorting serves both: a lead is a lag with the sign turned.
    w = panel.window()
    local = F.lead if ahead else F.lag
    if panel.heavy is None:
        columns = {n: panel.in_series(local(value, k).over(w)) for k, n in zip(steps, names)}
        return panel.with_rows(panel.rows.withColumns(columns))

    away = panel.window(descending=ahead)
    # Up to `reach` values at the end of each block, oldest first as seen by the next block.
    tail = (
        panel.heavy_part()
        .withColumn("_back", F.row_number().over(panel.window(descending=not ahead)))
        .filter(F.col("_back") <= reach)
        .groupBy(*panel.groups())
        .agg(
            F.sort_array(
                F.collect_list(F.struct((-F.col("_back")).alias("p"), F.col(value).alias("v")))
            ).alias("_tail")
        )
    )
    blocks = Window.partitionBy(*panel.keys).orderBy(
        F.col(BLOCK).desc() if ahead else F.col(BLOCK).asc()
    )
    # Every block has at least one row, so `reach` neighbours are always enough.
    near = blocks.rowsBetween(-reach, -1)
    edges = tail.select(
        *panel.groups(), F.flatten(F.collect_list("_tail").over(near)).alias("_carried")
    )
    rows = panel.with_edges(edges).withColumn("_ordinal", F.row_number().over(away))
    for k, name in zip(steps, names):
        missing = F.lit(k) - F.col("_ordinal") + 1
        rows = rows.withColumn(
            name,
            panel.in_series(
                F.when(F.col("_ordinal") > k, local(value, k).over(w)).when(
                    F.col("_carried").isNotNull(),
                    F.try_element_at("_carried", -missing).getField("v"),
                )
            ),
        )
    return panel.with_rows(rows.drop("_carried", "_ordinal"))


def group_sums(panel: Panel, sums: dict[str, Column]) -> Panel:
    """Sums over the whole key on every row, on the partitioning the panel already has."""
    if panel.heavy is None:
        whole = Window.partitionBy(*panel.keys)
        columns = {n: panel.in_series(F.sum(c).over(whole)) for n, c in sums.items()}
        return panel.with_rows(panel.rows.withColumns(columns))
    per_block = panel.heavy_part().groupBy(*panel.groups()).agg(
        *[F.sum(c).alias(f"_heavy_{n}") for n, c in sums.items()]
    )
    every = Window.partitionBy(*panel.keys)
    edges = per_block.select(
        *panel.groups(), *[F.sum(f"_heavy_{n}").over(every).alias(f"_heavy_{n}") for n in sums]
    )
    own = Window.partitionBy(*panel.groups())
    rows = panel.with_edges(edges).withColumns(
        {
            n: panel.in_series(
                F.when(F.col(BLOCK).isNull(), F.sum(c).over(own)).otherwise(F.col(f"_heavy_{n}"))
            )
            for n, c in sums.items()
        }
    )
    return panel.with_rows(rows.drop(*[f"_heavy_{n}" for n in sums]))


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    valid_to: str,
    take: dict[str, str],
    heavy: DataFrame | None | str = DETECT,
    limits: SkewLimits = LIMITS,
) -> DataFrame:
    """Left point-in-time join: each fact gets the version valid at its time.

    Both sides are merged into one time line per key and the last version seen is
    carried forward: work grows with the rows of a key, not with facts times
    versions. Validity intervals of one key must not overlap; gaps are respected.
    ``take`` maps version columns to output names. ``heavy`` may come from
    ``find_heavy_spans`` or ``with_span`` over any cheaper frame with this key.
    """
    # What the time line holds anyway does not travel twice; the rest are plain columns, so that unused ones are dropped.
    held = {key: "_k"} if facts.schema[key].dataType == versions.schema[key].dataType else {}
    if facts.schema[at].dataType == T.TimestampType():
        held[at] = "_at"
    carried = {c: held.get(c, f"_fact_{c}") for c in facts.columns}
    right = versions.filter(F.col(valid_from).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_k"),
        F.col(valid_from).cast("timestamp").alias("_at"),
        F.lit(0.0).alias("_kind"),
        F.struct(
            F.col(valid_to).cast("timestamp").alias("_until"),
            *[F.col(c).alias(name) for c, name in take.items()],
        ).alias("_version"),
    )

    def merged(kind: Column) -> DataFrame:
        left = facts.select(
            F.col(key).alias("_k"),
            F.col(at).cast("timestamp").alias("_at"),
            kind.alias("_kind"),
            *[F.col(c).alias(name) for c, name in carried.items() if c not in held],
        )
        return right.unionByName(left, allowMissingColumns=True)

    # Facts of one instant may stand in any order behind the versions that start there;
    # a hash gives them one where a heavy instant may have to be cut.
    spread = F.lit(1.0) + F.pmod(F.xxhash64(*facts.columns), F.lit(1 << 20)) / F.lit(float(1 << 20))
    if isinstance(heavy, str):
        heavy = find_heavy_spans(merged(spread), ["_k"], "_at", "_kind", limits)
    elif heavy is not None:
        heavy = heavy.withColumnRenamed(key, "_k")
    line = merged(F.lit(1.0) if heavy is None else spread)
    panel = make_panel(line, ["_k"], "_at", "_kind", heavy, limits)
    filled = fill(panel, "_version", "_seen").rows.filter("_kind >= 1")
    valid = F.col("_seen._until").isNull() | (F.col("_at") < F.col("_seen._until"))
    return filled.select(
        *[F.col(name).alias(c) for c, name in carried.items()],
        *[F.when(valid, F.col(f"_seen.{name}")).alias(name) for name in take.values()],
    )


def lag_columns(steps: int) -> tuple[list[int], list[str]]:
    """Steps 1..n with the column names used by every model (``tip_t-1`` ...)."""
    ks = list(range(1, steps + 1))
    return ks, [f"tip_t-{k}" for k in ks]
