"""Column expressions shared by the operators."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def rate(numerator, denominator, digits=4):
    """Rounded ratio; null where the denominator is 0."""
    return F.round(
        F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double")), digits
    )


def share_pct(part, whole, digits=2):
    """Rounded percentage of two columns; null where the whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def key_hash(column):
    """Uniform value in [0, 1) from an integer key, the same in any SQL engine.

    The key is reduced to 31 bits first so that the product stays inside a BIGINT.
    """
    key = F.col(column) if isinstance(column, str) else column
    mixed = F.pmod(F.pmod(key.cast("bigint"), F.lit(2147483648)) * F.lit(2654435761),
                   F.lit(4294967296))
    return mixed / F.lit(4294967296.0)


def pair_hash(first, second):
    """Uniform value in [0, 1) from two integer keys, the same in any SQL engine.

    The first key is mixed and reduced modulo a prime before the second is added and mixed again,
    so that pairs on a diagonal do not collide. Products stay inside a BIGINT.
    """
    prime, small = F.lit(2147483647), F.lit(2147483648)
    once = F.pmod(F.pmod(F.col(first).cast("bigint"), small) * F.lit(1103515245) + F.lit(12345),
                  prime)
    both = F.pmod((once + F.pmod(F.col(second).cast("bigint"), small)) * F.lit(1566083941), prime)
    return F.pmod(both * F.lit(48271) + F.lit(11), prime) / F.lit(2147483647.0)


def labels(code, mapping, default=None):
    """Code to label by a fixed map; ``default`` where the code is unknown."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), F.col(code))
    return F.coalesce(found, F.lit(default)) if default is not None else found


def first_match(rules, otherwise):
    """Label of the first true condition in ``[(condition, label), ...]``."""
    chain = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, label in rules[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def exact(column, digits=4):
    """A rounded measure as an exact decimal, so that later rounding has no binary ties."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast(f"decimal(12,{digits})")


def spread(df, *keys, partitions=8):
    """Rows hashed over a given number of partitions.

    Adaptive execution merges small shuffles into one partition, which would leave the many
    passes of a model fit on one core. Learners that draw per partition give the same result on
    every cluster as long as the number does not follow its cores.
    """
    return df.repartition(partitions, *keys)


def dealt(df, tasks, *keys):
    """Rows hashed by ``keys`` over ``tasks`` partitions; as Spark plans it where ``tasks`` is None.

    Adaptive execution merges shuffles into few tasks while these stay under its target, so that a
    task's sorts and hash tables grow with the data. A number that follows the source keeps them level.
    """
    return df.repartition(tasks, *keys) if tasks else df


def plain_types(df):
    """Integers as BIGINT, other numbers as DOUBLE and dates as text, for result tables."""
    def widen(field):
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(kind, (T.FloatType, T.DecimalType)):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)
    return df.select(*[widen(f) for f in df.schema.fields])
