"""Quality of a stream so far, without reading it again.

Each micro-batch leaves one row: counts that add up (rows, nulls, empty texts,
values out of range), the extent of its times, and two kinds of mergeable
sketches, HyperLogLog for distinct values (a few per cent off) and KLL for
quantiles (ranks about one per cent off). Any set of micro-batches is
summed up from their rows alone; one that is run again replaces its own row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.exprs import resolve
from stratus.profile import READINGS, Profile
from stratus.sinks import paths

#: log2 of the registers of a distinct sketch (relative error about 0.8 %), and k of a quantile sketch.
HLL_BITS, KLL_K = 14, 400


class LiveQuality:
    """Rows per micro-batch under ``path``, by the profile's ranges and date column."""

    def __init__(self, spark: SparkSession, path: str, profile: Profile = READINGS):
        self.spark, self.path, self.profile = spark, path.rstrip("/"), profile

    def _ranges(self, df: DataFrame) -> list[tuple[str, float, float]]:
        known = [(resolve(df, r.field), r.lower, r.upper) for r in self.profile.range_rules]
        return [r for r in known if r[0] is not None]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: one scan, one row."""
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        for f in batch.schema.fields:
            c, value = f.name, F.col(f"`{f.name}`")
            aggs.append(F.count_if(value.isNull()).alias(f"nulls:{c}"))
            if isinstance(f.dataType, T.StringType):
                aggs.append(F.count_if(value == "").alias(f"empty:{c}"))
            aggs.append(F.hll_sketch_agg(value.cast("string"), HLL_BITS).alias(f"distinct:{c}"))
        for c, low, high in self._ranges(batch):
            value = F.col(f"`{c}`").cast("double")
            aggs += [F.count_if(value < low).alias(f"below:{c}"), F.count_if(value > high).alias(f"above:{c}"),
                     F.min(value).alias(f"min:{c}"), F.max(value).alias(f"max:{c}"),
                     F.kll_sketch_agg_double(value, KLL_K).alias(f"quantiles:{c}")]
        date = resolve(batch, self.profile.date_column)
        if date is not None:
            aggs += [F.min(date).alias("first_time"), F.max(date).alias("last_time")]
        batch.agg(*aggs).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def summary(self, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
        """One row per column: field, n_rows, nulls, empty, below, above, min, max, distinct
        (estimated) and quantiles (estimated; columns with a range only)."""
        if not paths.exists(self.spark, self.path):
            raise FileNotFoundError(f"no micro-batch has been processed at {self.path}")
        parts = self.spark.read.parquet(self.path)
        merged, have = [], set(parts.columns)
        for name in parts.columns:
            kind, value = name.partition(":")[0], F.col(f"`{name}`")
            if kind in ("n_rows", "nulls", "empty", "below", "above"):
                merged.append(F.sum(value).alias(name))
            elif kind in ("min", "first_time"):
                merged.append(F.min(value).alias(name))
            elif kind in ("max", "last_time"):
                merged.append(F.max(value).alias(name))
            elif kind == "distinct":
                merged.append(F.hll_sketch_estimate(F.hll_union_agg(value)).alias(name))
            elif kind == "quantiles":
                merged.append(F.kll_merge_agg_double(value).alias(name))
        row = parts.agg(*merged)
        fields = [n.partition(":")[2] for n in parts.columns if n.startswith("nulls:")]

        def of(kind: str, field: str, dtype: str):
            return (F.col(f"`{kind}:{field}`") if f"{kind}:{field}" in have else F.lit(None)).cast(dtype).alias(kind)

        def ranks(field: str):
            if f"quantiles:{field}" not in have:
                return F.lit(None).cast("array<double>").alias("quantiles")
            sketch = F.col(f"`quantiles:{field}`")
            return F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in quantiles]).alias("quantiles")
        rows = [F.struct(F.lit(c).alias("field"), F.col("n_rows"), *[of(k, c, "long") for k in ("nulls", "empty", "below", "above")],
                         of("min", c, "double"), of("max", c, "double"), of("distinct", c, "long"), ranks(c)) for c in fields]
        return row.select(F.inline(F.array(*rows)))
