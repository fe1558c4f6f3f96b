"""Running aggregates whose window partitions stay bounded.

A plain ``sum() over (partition by key order by pos)`` sends a whole key to one task.  Here each key is
cut into chunks of its position; a partial aggregate per (key, chunk) is combined over the chunks (one
row per chunk), and only the rows of one chunk meet in a task.  A key with a third of all rows is
therefore spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16


def running(df: DataFrame, keys: list[str], pos: str, value: Column, kind: str, out: str, *, inclusive: bool, order: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Adds ``out``: the running max or sum of ``value`` over earlier rows of the key (this row too if inclusive).

    pos is a non-negative integer column that orders the rows; ``order`` refines ties.
    """
    agg = {"max": F.max, "sum": F.sum}[kind]
    df = df.withColumn("__v", value).withColumn("__c", F.expr(f"{pos} div {chunk}"))
    before = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    carry = df.groupBy(*keys, "__c").agg(agg("__v").alias("__m")).select(*keys, "__c", agg("__m").over(before).alias("__p"))
    inside = Window.partitionBy(*keys, "__c").orderBy(*(order or [pos])).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    own = df.withColumn("__o", agg("__v").over(inside)).join(carry, [*keys, "__c"])
    joined = F.greatest("__o", "__p") if kind == "max" else F.when(F.col("__o").isNull() & F.col("__p").isNull(), None).otherwise(F.coalesce("__o", F.lit(0)) + F.coalesce("__p", F.lit(0)))
    return own.withColumn(out, joined).drop("__v", "__c", "__m", "__p", "__o")
