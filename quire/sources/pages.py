"""Review-table pages as files: one JSON answer of the table's listing call each.

Each page is a task of its own and is read whole. A page that is no JSON, holds
no list of items, or names an error code can't be used; it ends the scan in
``mirror.decode_pull``, which keeps what earlier pages hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_ROWS = 100  #: records of a page


def read_mirror_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page, page_ok, pos, unique_id_cell, status_cell`` of ``<path>/page=<n>/`` files.

    Cells are JSON text, null where a record lacks them. A record's position is
    its own ``pos``, else its place in the pull. A page that can't be used is one
    row without cells, a page without items no row. Empty files aren't listed, so
    a number that is missing between others is a page that can't be used.
    """
    raw = spark.read.schema("value string, page bigint").text(path, wholetext=True)
    body = raw.select("page", F.try_parse_json("value").alias("v")).select(
        "page", F.try_variant_get("v", "$.items", "array<variant>").alias("items"),
        F.coalesce(F.try_variant_get("v", "$.code", "int"), F.lit(0)).alias("code"))
    ok = F.col("items").isNotNull() & (F.col("code") == 0)
    rows = body.select("page", ok.alias("page_ok"), F.posexplode_outer(F.when(ok, F.col("items"))).alias("at", "x"))

    def cell(name: str):
        return F.to_json(F.try_variant_get("x", f"$.fields.{name}", "variant"))

    pos = F.coalesce(F.try_variant_get("x", "$.pos", "bigint"), F.col("page") * PAGE_ROWS + F.coalesce("at", F.lit(0)))
    pull = rows.where(~F.col("page_ok") | F.col("at").isNotNull()).select(
        "page", "page_ok", pos.alias("pos"), cell("unique_id").alias("unique_id_cell"), cell("status").alias("status_cell"))
    numbers = raw.select("page").distinct()
    last, none = numbers.agg(F.max("page")).scalar(), F.lit(None).cast("string")
    gaps = numbers.select((F.col("page") + 1).alias("page")).join(numbers, "page", "left_anti").where(F.col("page") < last)
    return pull.unionByName(gaps.select("page", F.lit(False).alias("page_ok"), (F.col("page") * PAGE_ROWS).alias("pos"),
                                        none.alias("unique_id_cell"), none.alias("status_cell")))


def write_mirror_pages(pull: DataFrame, path: str) -> None:
    """``page, page_ok, pos, unique_id_cell, status_cell`` rows as such files; a failed page is cut short."""
    def inner(name: str):
        """The cell as JSON: text that is none becomes a string."""
        quoted = F.regexp_extract(F.to_json(F.struct(F.col(name).alias("c"))), r'^\{"c":(.*)\}$', 1)
        return F.when(F.try_parse_json(name).isNull(), quoted).otherwise(F.col(name))

    item = F.concat(F.lit('{"pos":'), F.col("pos").cast("string"), F.lit(',"fields":{"unique_id":'), inner("unique_id_cell"),
                    F.lit(',"status":'), inner("status_cell"), F.lit("}}"))
    pages = pull.groupBy("page").agg(F.min("page_ok").alias("ok"), F.sort_array(F.collect_list(F.struct("pos", item.alias("item")))).alias("rows"))
    body = F.concat(F.lit('{"code":0,"items":['), F.array_join(F.col("rows.item"), ","), F.lit("]}"))
    whole = F.when(F.col("ok"), body).otherwise(F.expr("left(body, length(body) div 2)"))
    pages.withColumn("body", body).select("page", whole.alias("value")).repartition("page").write.partitionBy("page").text(path)
