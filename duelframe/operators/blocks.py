"""Ordered windows per key without a task per key: rows are numbered, cut into blocks, and what a block needs of the
one before is handed over. A key that holds a third of all rows is spread over as many tasks as it has blocks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from duelframe.operators.ordering import dense_index
from duelframe.session import stage

BLOCK = 1 << 16


def framed(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, columns: Mapping[str, Callable[[WindowSpec], Column]], block: int = BLOCK) -> DataFrame:
    """Columns over a row frame of each key, of which no row reaches farther back than ``n`` rows.

    A column is a function of the ordered window. The last ``n`` rows of a block stand in the next one as well, and are
    dropped there after the frames have seen them. Missing keys are a key.
    """
    size = max(block, n)
    numbered = dense_index(df, [*keys, *order], "_i")
    own = F.floor((F.col("_i") - 1) / size)
    here = F.struct(own.alias("b"), F.lit(False).alias("copy"))
    handed = F.when(F.col("_i") > (own + 1) * size - n, F.array(here, F.struct((own + 1).alias("b"), F.lit(True).alias("copy"))))
    spread = numbered.withColumn("_at", F.explode(F.coalesce(handed, F.array(here)))).withColumn("_b", F.col("_at.b"))
    w = Window.partitionBy("_b", *keys).orderBy("_i")
    return spread.withColumns({name: column(w) for name, column in columns.items()}).filter(~F.col("_at.copy")).drop("_at", "_b", "_i")


def last_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Each value replaced by the last one of its key that is not null in the rows before.

    Inside a block that is a window. Only the key of a block's last row goes on in the next, so one row a block says
    what is carried, and a window over those rows, one for each block of a key, carries it on.
    """
    rows = stage(dense_index(df, [*keys, *order], "_i").withColumn("_b", F.floor((F.col("_i") - 1) / block)), "as-of-rows")
    inside = Window.partitionBy("_b", *keys).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.select(*(c for c in rows.columns if c not in values), *(F.last(v, ignorenulls=True).over(inside).alias(v) for v in values))
    at_end = F.max("_i") == (F.col("_b") + 1) * block
    ends = rows.groupBy("_b", *keys).agg(at_end.alias("_open"), *(F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_i"))).alias(v) for v in values))
    ends = ends.filter("_open").select("_b", *keys, F.lit(1).alias("_kind"), *values)
    starts = rows.filter(F.col("_i") == F.col("_b") * block + 1).select("_b", *keys, F.lit(0).alias("_kind"), *(F.lit(None).cast(dict(rows.dtypes)[v]).alias(v) for v in values))
    earlier = Window.partitionBy(*keys).orderBy("_b", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.unionByName(ends).select("_b", *keys, "_kind", *(F.last(v, ignorenulls=True).over(earlier).alias(f"_c_{v}") for v in values)).filter("_kind = 0").drop("_kind")
    carried = carried.withColumnsRenamed({k: f"_k_{k}" for k in ("_b", *keys)})
    same = found["_b"] == carried["_k__b"]
    for k in keys:
        same = same & found[k].eqNullSafe(carried[f"_k_{k}"])
    out = found.join(carried, same, "left").withColumns({v: F.coalesce(v, f"_c_{v}") for v in values})
    return out.select(*df.columns)
