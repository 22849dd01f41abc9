"""Sums of amounts that depend on nothing but the amounts.

A double stands for the shortest decimal number that reads back as it (0.1 is a
tenth). Every amount is a whole number of units of 10^(6 b) for some bin b; bins
of one exponent are added as whole numbers, so no order, partitioning or size of
the values changes a digit. The bins of a group (one for amounts of up to six
decimals, a few else, 106 at most) are put together at the end and rounded once.

This takes two group-bys, by key and bin and then by key. The first one is
combined map-side like any sum; the second sees the groups only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.semantics import col_, nan_to_null, safe_div

#: Decimal digits of a bin, and the bin of amounts with up to six decimals.
WIDTH, PLAIN = 6, -1
#: Bins that a sum of 38 digits can reach above its own.
HEADROOM = 7

#: What else a group is asked for: the aggregate of rows, and that of its parts.
Partial = tuple[Column, Callable[[str], Column]]


def _binned(x: Column) -> tuple[Column, Column]:
    """(bin, units): x is units * 10^(WIDTH * bin); NULL units for a missing or infinite x."""
    held = x.try_cast("decimal(21,6)")
    plain = F.coalesce(held.cast("double") == x, x.isNull() | (F.abs(x) == float("inf")))
    whole = (held * F.lit(10**WIDTH).cast("decimal(7,0)")).cast("decimal(28,0)")
    # digits and exponent of any other number, from its shortest text: 9.0E31, 1.0E-7, 333.3333333
    text = F.abs(x).cast("string")
    shape = r"^([0-9]+)\.([0-9]+)(?:E(-?[0-9]+))?$"
    digits = F.concat(F.regexp_extract(text, shape, 1), F.regexp_extract(text, shape, 2)).try_cast("decimal(20,0)")
    exponent = F.coalesce(F.regexp_extract(text, shape, 3).try_cast("int"), F.lit(0)) - F.length(F.regexp_extract(text, shape, 2))
    at = F.floor(exponent / WIDTH).cast("int")
    scale = F.element_at(F.array(*[F.lit(10**k).cast("decimal(6,0)") for k in range(WIDTH)]), (exponent - at * WIDTH + 1).cast("int"))
    units = (digits * scale * F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")).cast("decimal(28,0)")
    return F.when(plain, F.lit(PLAIN)).otherwise(at), F.when(plain, whole).otherwise(units)


def _rounded(bins: Column) -> Column:
    """The double nearest to the sum of (bin, units) pairs, each bin once."""
    def text(digits: Column, at: Column) -> Column:
        return F.concat(digits, F.lit("E"), (at * WIDTH).cast("string")).cast("double")

    held = F.map_from_entries(bins)
    low = F.array_min(F.transform(bins, lambda b: b["bin"]))
    high = F.array_max(F.transform(bins, lambda b: b["bin"])) + HEADROOM
    wide, base = "decimal(38,0)", F.lit(10**WIDTH).cast("decimal(7,0)")

    def folded(sign: int) -> Column:
        """Carries from the lowest bin up: what is left above the highest, and the digits below."""
        def step(acc: Column, b: Column) -> Column:
            t = (F.coalesce(F.element_at(held, b) * F.lit(sign).cast("decimal(1,0)"), F.lit(0)).cast(wide) + acc["carry"]).cast(wide)
            limb = F.pmod(t, base).cast("decimal(7,0)")
            return F.struct(((t - limb) / base).cast(wide).alias("carry"),
                            F.concat(F.lpad(limb.cast("string"), WIDTH, "0"), acc["digits"]).alias("digits"))

        start = F.struct(F.lit(0).cast(wide).alias("carry"), F.lit("").alias("digits"))
        return F.aggregate(F.sequence(low, high), start, step)

    up, down = folded(1), folded(-1)
    return (F.when(F.size(bins) == 0, F.lit(None).cast("double"))
            .when(F.size(bins) == 1, text(bins[0]["units"].cast("string"), bins[0]["bin"]))
            .when(up["carry"] < 0, text(F.concat(F.lit("-"), down["digits"]), low))
            .otherwise(text(up["digits"], low)))


def exact_sums(df: DataFrame, keys: Sequence[str], amounts: dict[str, str | Column],
               others: dict[str, Partial] | None = None) -> DataFrame:
    """``df`` grouped by ``keys`` (none: one row), with for each amount its sum ``name`` and its number of values ``name__n``.

    NaN is missing. A sum of nothing is NULL; infinities sum to infinity, both
    signs to NaN; a sum beyond the range of doubles is infinite. ``others`` are
    further aggregates, each with the aggregate that puts its parts together.
    DECIMAL amounts are summed as they are.
    """
    others = others or {}
    if len(amounts) != 1:
        return _several(df, keys, amounts, others)
    (name, amount), = amounts.items()
    x = nan_to_null(col_(amount).cast("double"))
    at, units = _binned(F.col("_x"))
    binned = df.withColumn("_x", x).withColumn("_bin", at).withColumn("_units", units)
    infinite = float("inf")
    first = binned.groupBy(*keys, "_bin").agg(
        F.sum("_units").alias("_sum"), F.count("_x").alias("_n"), F.count_if(F.col("_x") == infinite).alias("_up"),
        F.count_if(F.col("_x") == -infinite).alias("_down"), *[one.alias(k) for k, (one, _) in others.items()])
    pairs = F.collect_list(F.when(F.col("_sum").isNotNull(), F.struct(F.col("_bin").alias("bin"), F.col("_sum").alias("units"))))
    second = first.groupBy(*keys).agg(
        pairs.alias("_bins"), F.coalesce(F.sum("_n"), F.lit(0)).alias(f"{name}__n"), F.sum("_up").alias("_up"), F.sum("_down").alias("_down"),
        *[then(k).alias(k) for k, (_, then) in others.items()])
    total = (F.when((F.col("_up") > 0) & (F.col("_down") > 0), F.lit(float("nan")))
             .when(F.col("_up") > 0, F.lit(infinite)).when(F.col("_down") > 0, F.lit(-infinite)).otherwise(_rounded(F.col("_bins"))))
    return second.select(*keys, total.alias(name), f"{name}__n", *others)


def _several(df: DataFrame, keys: Sequence[str], amounts: dict[str, str | Column], others: dict[str, Partial]) -> DataFrame:
    """Several amounts in one pass: a row for each, grouped by the amount's name too. Other aggregates ride on the first one's rows."""
    names = list(amounts)
    held = df.select("*", F.posexplode(F.array(*[nan_to_null(col_(a).cast("double")) for a in amounts.values()])).alias("_of", "_value"))
    lead = F.col("_of") == 0
    guarded = {k: (one, then) for k, (one, then) in others.items()}
    one = exact_sums(held, [*keys, "_of"], {"_total": "_value"}, guarded)
    pick = [F.max(F.when(F.col("_of") == k, F.col(c))).alias(n + end) for k, n in enumerate(names) for c, end in (("_total", ""), ("_total__n", "__n"))]
    rest = [F.max(F.when(lead, F.col(k))).alias(k) for k in others]
    found = one.groupBy(*keys).agg(*pick, *rest)
    return found.select(*keys, *[c for n in names for c in (n, F.coalesce(f"{n}__n", F.lit(0)).alias(f"{n}__n"))], *others)


def exact_mean(total: str) -> Column:
    """Mean of an amount of ``exact_sums``; NULL without values."""
    return safe_div(F.col(total), F.col(f"{total}__n"))


def is_decimal(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.DecimalType)
