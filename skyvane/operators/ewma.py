"""STA1 as column expressions: the EWMA of any sequence without a sequential fold.

``mean = a*v + (1-a)*mean`` composes affine maps, so with r = 1-a the mean at the n-th value is a weighted sum of
all values so far, weights falling by r a step. A prefix sum of ``v * r**-i`` gives it,
but ``r**-i`` leaves the range of doubles on a long sequence. So values are numbered in one scan and cut into
blocks of B values with ``r**B`` about 1e-30; a block also gets the one before it, and
everything older weighs less than 1e-30 of the newest value, far below a double's own rounding.
Blocks are independent: a hot key is as many groups as it has blocks, and nothing is speculated or
carried from task to task.

NULL and NaN values leave the mean unchanged (NULL before the first value). Against the step-by-step fold the
result differs in the last digits only: by about (2B)*2**-53 of the largest value of the two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordered as W

#: What is left of the weight of a value that is a whole block old.
LEFT = 1e-30


def ewma(df: DataFrame, x: str, alpha: float = 0.2, name: str = "ewma", keys: Sequence[str] = W.KEYS,
         order: Sequence[str] = W.ORDER) -> DataFrame:
    """``df`` with the EWMA of ``x`` seeded by the first value. ``df`` may carry a bucket (:func:`ordered.with_bucket`)."""
    v = F.col(x).cast("double")
    d = df.withColumn("_v", F.when(~F.isnan(v), v))
    if alpha >= 1:
        return W.scan(d, lasts={name: F.col("_v")}, keys=keys, order=order).select(*df.columns, name)
    r = 1 - alpha
    size = max(1, math.ceil(math.log(LEFT) / math.log(r)))
    d = W.scan(d, sums={"_n": F.col("_v").isNotNull().cast("long")}, keys=keys, order=order)
    at = F.greatest(F.col("_n") - 1, F.lit(0))
    d = d.withColumn("_block", F.floor(at / size)).withColumn("_pos", at % size)
    # a value also stands, as halo, before the block that follows its own
    seats = F.when(F.col("_v").isNotNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = d.withColumn("_ahead", F.explode(seats))
    d = d.withColumn("_block", F.col("_block") + F.col("_ahead")).withColumn(
        "_pos", F.col("_pos") + F.when(F.col("_ahead") == 0, F.lit(size)).otherwise(F.lit(0)))
    gain = F.when(F.col("_n") == 1, F.lit(1.0)).otherwise(F.lit(alpha))
    term = gain * F.col("_v") * F.pow(F.lit(r), -F.col("_pos").cast("double"))
    run = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn(name, F.sum(term).over(run) * F.pow(F.lit(r), F.col("_pos").cast("double")))
    return d.filter(F.col("_ahead") == 0).select(*df.columns, name)
