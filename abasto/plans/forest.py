"""A random forest on one number, with trees that are grown until nothing is left to part.

A tree on one number parts its rows between neighbouring values, half way, until a leaf holds one value or one price. So
what such a tree says about a quantity is the mean price of its drawn rows with the nearest value on the side of the half
way that the quantity falls on, whatever the order of the splits. That is computed: no split is searched, none is limited
by bins, and only rows near the quantity are drawn.

Every tree draws each row a number of times that is Poisson with mean one, from a hash of the row's number, the tree and
the seed. A tree looks at the 1,000 nearest values on each side: it would miss all of them once in e**1000 trees.
"""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAREST = 1000
# Chances that a row is drawn at most 0, 1, 2 ... times, as far as doubles tell them from one.
CHANCES = [sum(exp(-1) / factorial(k) for k in range(count + 1)) for count in range(18)]


def _times(tree: Column, seed: int) -> Column:
    """How often a tree draws the row numbered ``_id``."""
    even = F.shiftrightunsigned(F.xxhash64("_id", tree, F.lit(seed)), 11) / F.lit(float(1 << 53))
    return F.size(F.filter(F.array(*map(F.lit, CHANCES)), lambda chance: chance <= even))


def near(training: DataFrame, quantity: float, nearest: int = NEAREST) -> DataFrame:
    """Numbered rows (x, y) whose value is among the nearest on either side of the quantity."""
    rows = training.select(
        F.col("solcan").cast("double").alias("x"), F.col("solpre").cast("double").alias("y"), F.monotonically_increasing_id().alias("_id")
    ).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    values = rows.select("x").distinct()
    low = values.filter(F.col("x") <= quantity).orderBy(F.desc("x")).limit(nearest).agg(F.min("x")).scalar()
    high = values.filter(F.col("x") > quantity).orderBy("x").limit(nearest).agg(F.max("x")).scalar()
    return rows.filter((F.col("x") >= F.coalesce(low, F.lit(quantity))) & (F.col("x") <= F.coalesce(high, F.lit(quantity))))


def drawn(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """(tree, x): how many rows the tree drew with that value, and the sum of their prices."""
    counts = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: _times(tree, seed))
    each = rows.select("x", "y", F.posexplode(counts).alias("tree", "times")).filter("times > 0")
    return each.groupBy("tree", "x").agg(F.sum("times").alias("n"), F.sum(F.col("times") * F.col("y")).alias("total"))


def price_forest(
    training: DataFrame, quantity: float = 100.0, trees: int = 100, seed: int = 42, nearest: int = NEAREST
) -> DataFrame:
    """The price that the trees expect for a quantity, on average. Rows without quantity or price are left out; without any row
    there is no answer."""
    quantity = float(quantity)
    found = drawn(near(training, quantity, nearest), trees, seed)
    leaf = F.struct("x", (F.col("total") / F.col("n")).alias("price"))
    sides = found.groupBy("tree").agg(
        F.max(F.when(F.col("x") <= quantity, leaf)).alias("below"), F.min(F.when(F.col("x") > quantity, leaf)).alias("above")
    )
    half = F.col("below.x") / 2 + F.col("above.x") / 2
    left = F.col("above").isNull() | (F.col("below").isNotNull() & (F.lit(quantity) <= half))
    price = F.when(left, F.col("below.price")).otherwise(F.col("above.price"))
    return (
        sides.select(price.alias("price"))
        .agg(F.avg("price").alias("precio_estimado"))
        .filter("precio_estimado IS NOT NULL")
        .select(F.lit(quantity).alias("solcan"), "precio_estimado")
    )
