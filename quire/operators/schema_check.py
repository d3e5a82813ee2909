"""Expected vs actual review-mirror fields: missing / mismatch / extra.

The actual fields are the mirror's own columns (its metadata), so a field
without a single filled cell is still there. How many cells are filled is
counted for all fields in one pass: one row of counts per partition is
shuffled, however large the mirror is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MIRROR_FIELDS, TYPE_NAMES


def expected_fields(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MIRROR_FIELDS), "name string, type_id int")


def listed_fields(snapshot: DataFrame, types: dict[str, int]) -> DataFrame:
    """(name, type_id, rows) for every column of ``snapshot`` listed in
    ``types``; ``rows`` counts its non-null cells (zero for a blank field)."""
    names = [n for n in types if n in snapshot.columns]
    counts = snapshot.agg(*[F.count(F.col(n)).alias(n) for n in names])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(types[n]).alias("type_id"), F.col(n).alias("rows"))
        for n in names])))


def type_label(c) -> F.Column:
    m = F.create_map(*[x for k, v in TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], F.concat(F.lit("type_"), c.cast("string")))


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    e = expected.select("name", F.col("type_id").alias("exp"))
    a = actual.select("name", F.col("type_id").alias("act"), "rows")
    # both sides hold one row per field name (bounded by the schema width)
    j = e.join(a, "name", "full_outer")
    kind = (F.when(F.col("act").isNull(), F.lit("missing"))
            .when(F.col("exp").isNull(), F.lit("extra"))
            .when(F.col("exp") != F.col("act"), F.lit("mismatch")))
    return (j.withColumn("kind", kind).where(F.col("kind").isNotNull())
            .select("kind", "name",
                    F.when(F.col("exp").isNotNull(), type_label(F.col("exp"))).alias("expected"),
                    F.when(F.col("act").isNotNull(), type_label(F.col("act"))).alias("actual"),
                    F.coalesce(F.col("rows"), F.lit(0).cast("bigint")).alias("rows"))
            .orderBy("kind", "name"))
