"""SimHash fingerprints, in DataFrame functions only.

The terms of a text are its pairs of neighbouring words (lower case), the last word alone closing the row. Each
occurrence votes with a weight of 1 to 4 that grows with the term's length: for every bit of the term's hash, up
where it is set, down where not. The fingerprint keeps the sign of each sum.

Votes are counted in packed form: 16 sums of four 16-bit lanes hold the weights of the 64 bits of one hash, so a
term costs 16 additions for 64 bits. A run of 8,192 terms cannot overflow a lane; runs are unpacked and added. A
text of any length is thus folded on the map side, and one small row per run is shuffled.

Near fingerprints: with radius r the bits are cut into blocks, and in a pair within r bits all but r blocks agree.
``near_pairs`` keys each fingerprint by every choice of blocks that may be the agreeing ones (the permuted
tables), joins on the keys, and checks the distance; no pair within the radius is missed.

Null text counts as empty; a text without words has the fingerprint of zeros. Equal texts have equal ones.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.quality import words

RUN = 8192
LANES = 0x0001000100010001


def fingerprints(texts: DataFrame, key: list[str], text: str = "text", hashes: int = 2) -> DataFrame:
    """``key`` columns (unique together, not null) and ``bits``, an array of 64-bit integers, one per hash."""
    w = words(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    own = texts.select(*key, w.alias("w"))
    pairs = F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("b"))
    terms = own.select(*key, F.posexplode_outer(pairs).alias("i", "p")).select(
        *key, F.floor(F.coalesce("i", F.lit(0)) / RUN).alias("run"), F.col("p.a").alias("a"), F.col("p.b").alias("b")
    )
    length = F.length("a") + F.coalesce(F.length("b"), F.lit(0))
    weight = F.when(F.col("a").isNull(), 0).otherwise(F.least(F.lit(4), 1 + F.floor(length / 6))).cast("bigint")
    voted = terms.select(
        *key, "run", weight.alias("v"),
        *[F.xxhash64(F.lit(seed), "a", "b").alias(f"h{seed}") for seed in range(hashes)],
    )
    sums = [
        F.sum(F.shiftrightunsigned(f"h{s}", j).bitwiseAND(F.lit(LANES)) * F.col("v")).alias(f"s{s}_{j}")
        for s in range(hashes)
        for j in range(16)
    ]
    packed = voted.groupBy(*key, "run").agg(F.sum("v").alias("v"), *sums)

    def lane(s: int, bit: int) -> Column:
        return F.shiftrightunsigned(f"s{s}_{bit % 16}", bit // 16 * 16).bitwiseAND(F.lit(0xFFFF))

    # One row per run; nearly every text has one, so the second sum costs little.
    counts = packed.select(
        *key, "v", *[F.array(*[lane(s, b) for b in range(64)]).alias(f"c{s}") for s in range(hashes)]
    )
    one = counts.groupBy(*key).agg(F.collect_list(F.struct("v", *[f"c{s}" for s in range(hashes)])).alias("r"))
    total = F.aggregate("r", F.lit(0).cast("bigint"), lambda a, x: a + x["v"])

    def votes(s: int) -> Column:
        first = F.get("r", F.lit(0))[f"c{s}"]
        return F.aggregate(
            F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))),
            first,
            lambda a, x: F.zip_with(a, x[f"c{s}"], lambda p, q: p + q),
        )

    summed = one.select(*key, total.alias("v"), *[votes(s).alias(f"c{s}") for s in range(hashes)])
    bits = [
        F.aggregate(
            F.transform(f"c{s}", lambda c, i: F.when(c * 2 > F.col("v"), F.expr("1L")).otherwise(F.expr("0L"))),
            F.lit(0).cast("bigint"),
            lambda a, x: F.shiftleft(a, 1).bitwiseOR(x),
        )
        for s in range(hashes)
    ]
    return summed.select(*key, F.array(*bits).alias("bits"))


def text_form(bits: Column) -> Column:
    return F.array_join(F.transform(bits, lambda b: F.lpad(F.lower(F.hex(b)), 16, "0")), "")


def distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def likeness(a: Column, b: Column, hashes: int = 2) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - distance(a, b) / F.lit(64.0 * hashes)


def block_keys(bits: Column, radius: int, hashes: int = 2, width: int = 8, per_key: int = 2) -> Column:
    """Keys of the permuted tables: bytes of the fingerprint, ``per_key`` of every group of them together.

    The bytes are dealt over radius + per_key groups; r differing bits touch at most r groups, so at least
    ``per_key`` groups agree, and the key of that choice is shared.
    """
    n, groups = hashes * 64 // width, radius + per_key
    if groups > n:
        raise ValueError("the radius is too large for this number of blocks")
    cells = [
        F.shiftrightunsigned(F.get(bits, F.lit(i * width // 64)), i * width % 64).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(n)
    ]
    keys = []
    for number, chosen in enumerate(combinations(range(groups), per_key)):
        mine = [cells[i] for i in range(n) if i % groups in chosen]
        keys.append(F.xxhash64(F.lit(number), *mine))
    return F.array(*keys)


def near_pairs(prints: DataFrame, queries: DataFrame, radius: int = 3, hashes: int = 2) -> DataFrame:
    """All (query fingerprint, fingerprint) pairs of different values within the radius; both frames: ``bits``.

    Equal fingerprints are one row first, so a group of copies takes part once.
    """
    key = block_keys(F.col("bits"), radius, hashes)
    left = queries.select("bits").distinct().select(F.col("bits").alias("q_bits"), F.explode(key).alias("k"))
    right = prints.select("bits").distinct().select("bits", F.explode(key).alias("k"))
    far = distance(F.col("q_bits"), F.col("bits"))
    met = left.join(right, "k").where((F.col("q_bits") != F.col("bits")) & (far <= radius))
    return met.select("q_bits", "bits", far.alias("distance")).distinct()


def neighbours(keys: DataFrame, key: str, carried: str) -> DataFrame:
    """For each distinct ``key``: the previous one and the previous row's ``carried``, in ascending order, cyclic.

    Keys are dealt into ranges and written with the number of their range, so windows run within ranges; the
    first and last row of each range (one row per range) settle the seams.
    """
    from pyspark.sql import Window

    from orderlens.llm.store import written

    ranged = keys.groupBy(key).agg(F.max(carried).alias(carried)).repartitionByRange(F.col(key).asc_nulls_first())
    dealt = written(ranged.withColumn("part", F.spark_partition_id()), "neighbours")
    order = Window.partitionBy("part").orderBy(F.col(key).asc_nulls_first())
    row = F.struct(F.col(key).alias("key"), F.col(carried).alias("carried"))
    inside = dealt.withColumn("before", F.lag(row).over(order))
    ends = dealt.groupBy("part").agg(F.max_by(row, F.struct(F.col(key).isNotNull(), F.col(key))).alias("last"))
    seam = Window.orderBy("part")
    last = F.max_by("last", "part").over(seam.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("part", F.coalesce(F.lag("last").over(seam), last).alias("seam"))
    found = inside.join(ends, "part").withColumn("before", F.coalesce("before", "seam"))
    return found.select(key, F.col("before.key").alias("before_key"), F.col("before.carried").alias("before_carried"))
