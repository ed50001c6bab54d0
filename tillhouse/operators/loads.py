"""What a second load of a table adds and drops, copies counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Nested values as text, with all that they hold.
_WHOLE = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def load_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every distinct row that the loads hold a different number of times, with ``added`` and ``dropped`` copies.

    Rows are equal if all columns are, nulls too; columns are matched by name, in the order of ``old``. ``added``
    rows are those of ``new`` except all of ``old``, ``dropped`` the other way round.

    Both directions come from one sum of signs by row hash, pre-aggregated, so that of rows that did not change only
    a few numbers move. The rows of all hashes whose signs do not cancel, or that a second hash says are of
    different rows, are read again and counted column by column: what is returned is exact, and a difference can
    hide only where both 64-bit hashes agree on different rows.
    """
    columns = old.columns
    if set(columns) != set(new.columns) or {"added", "dropped"} & set(columns):
        raise ValueError("loads have the same columns, none of them named added or dropped")
    names = [F.col(f"`{c}`") for c in columns]
    # The hashes pass over nulls, so what is null is hashed as well, and nested values also as text.
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in names])
    nested = [f.name for f in old.schema if isinstance(f.dataType, T.ArrayType | T.StructType)]
    nulls = F.concat(nulls, F.to_json(F.struct(*[F.col(f"`{c}`") for c in nested]), _WHOLE)) if nested else nulls
    row = F.struct(*names).alias("row")

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            F.xxhash64(nulls, *names).alias("hash"), F.xxhash64(F.lit("again"), nulls, *names).alias("second"), F.lit(sign).alias("sign"), row
        )

    both = hashed(old, -1).unionByName(hashed(new, 1))
    sums = both.groupBy("hash").agg(F.sum("sign").alias("net"), F.min("second").alias("least"), F.max("second").alias("most"))
    open_hashes = sums.where("net != 0 or least != most").select("hash")
    # Each hash is there once. A semi join would be pushed to rows of constants, and have no key left there.
    again = both.join(open_hashes, "hash").select("row.*", F.col("sign").alias("_sign"))
    net = again.groupBy(*names).agg(F.sum("_sign").alias("_net")).where("_net != 0")
    return net.select(*names, F.greatest("_net", F.lit(0).cast("bigint")).alias("added"), F.greatest(-F.col("_net"), F.lit(0).cast("bigint")).alias("dropped"))
