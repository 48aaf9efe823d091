"""Top-k, in total and per key."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_rows(df, order, n):
    """First ``n`` rows of a total order; give ``order`` a unique tiebreak."""
    return df.orderBy(*order).limit(n)


def top_per_key(df, keys, order, n, rank="rank"):
    """First ``n`` rows per key.

    Spark limits each key to ``n`` rows in every map task before the shuffle
    (WindowGroupLimit), so a hot key sends at most ``n`` rows per map task.
    """
    numbered = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n)
