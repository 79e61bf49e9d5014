"""Drift of nested names and types in JSON payloads, against what earlier batches held.

A reader with a schema hides what it does not expect. Here payloads are read as variants, and a batch is
described by its paths: for each the types it takes and the number of payloads in which it does. Payloads of the
same shape have the same paths and types, so shapes are counted first, combined before the shuffle, and one
payload of each is taken apart, level by level. The cost of the second step goes by the number of shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fixed
from ..sources.workspace import checkpointed, read_or_empty
from .rules import FrameRule, issue, leading

#: Types of a path; what lies below the depth that is looked at counts as DEEP, what does not parse as BROKEN.
OBJECT, ARRAY, STRING, INTEGER, NUMBER, BOOLEAN, NULL, DEEP, BROKEN = (
    "object", "array", "string", "integer", "number", "boolean", "null", "deep", "broken")
ROOT = "$"
PROFILE_DDL = "path string, type string, records bigint"
#: Statuses of a path and type against the history.
EXPECTED, ADDED, RETYPED, MISSING = "expected", "added", "retyped", "missing"


def type_of(variant: Column) -> Column:
    """The type at the top of a variant."""
    name = F.regexp_extract(F.schema_of_variant(variant), "^([A-Z]+)", 1)
    number = name.isin("DECIMAL", "DOUBLE", "FLOAT")
    return (
        F.when(name == "OBJECT", OBJECT).when(name == "ARRAY", ARRAY).when(name == "STRING", STRING).when(name == "BIGINT", INTEGER)
        .when(number, NUMBER).when(name == "BOOLEAN", BOOLEAN).when(name == "VOID", NULL)
    )


def shapes(df: DataFrame, json_column: str) -> DataFrame:
    """(shape, n, text): the distinct shapes of the payloads, how many have each, and one of them.

    A shape names all paths and types; decimals of any width are one. Where elements of a list disagree the
    shape does not tell in what, so such payloads are their own shape. The shape of what does not parse is null.
    """
    text = F.col(json_column)
    schema = F.regexp_replace(F.schema_of_variant(F.try_parse_json(text)), r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    shape = F.when(schema.contains("VARIANT"), text).otherwise(schema)
    held = df.filter(text.isNotNull()).select(shape.alias("shape"), text.alias("text"))
    return held.groupBy("shape").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("text"))


def profile(df: DataFrame, json_column: str, most_depth: int = 64) -> DataFrame:
    """(path, type, records): every path of the payloads, its types, and in how many payloads it takes each.

    ``$.a.b`` is a name within an object, ``$.a[]`` the elements of a list; names of other signs than letters, digits and
    underscores are quoted. A path that takes several types in one payload, which only list elements can, counts for
    each; whole numbers beside others count as numbers, and nulls beside values not at all. Null payloads are left out.
    """
    spark = df.sparkSession
    counted = checkpointed(shapes(df, json_column))
    level = counted.filter("shape is not null").select("shape", "n", F.lit(ROOT).alias("path"), F.parse_json("text").alias("v"))
    found = None
    for depth in range(most_depth + 1):
        level = checkpointed(level.withColumn("type", type_of(F.col("v")) if depth < most_depth else F.lit(DEEP)))
        typed = level.select("shape", "n", "path", "type")
        found = typed if found is None else found.union(typed)
        level = level.filter(F.col("type").isin(OBJECT, ARRAY))
        if level.isEmpty():
            break
        below = spark.sql(
            "SELECT shape, n, path, e.key AS name, e.value AS v FROM {level}, LATERAL variant_explode(v) AS e(pos, key, value)",
            level=level.select("shape", "n", "path", "v"),
        )
        plain = F.when(F.col("name").rlike(r"^\w+$"), F.concat(F.lit("."), "name")).otherwise(F.concat(F.lit("['"), "name", F.lit("']")))
        step = F.when(F.col("name").isNull(), F.lit("[]")).otherwise(plain)
        level = below.select("shape", "n", F.concat("path", step).alias("path"), "v")
    kinds = found.groupBy("shape", "path").agg(F.max("n").alias("n"), F.collect_set("type").alias("types"))  # a handful of types
    has = lambda kind: F.array_contains("types", kind)
    own = F.filter("types", lambda t: ~((t == NULL) & (F.size("types") > 1)) & ~((t == INTEGER) & has(NUMBER)))
    rows = kinds.select("path", F.explode(own).alias("type"), "n")
    broken = counted.filter("shape is null").select(F.lit(ROOT).alias("path"), F.lit(BROKEN).alias("type"), "n")
    return rows.union(broken).groupBy("path", "type").agg(F.sum("n").alias("records"))


def drift(found: DataFrame, history: DataFrame) -> DataFrame:
    """(path, type, status, records) of a profile against the profiles of earlier batches.

    A path is ``added`` if no batch held it, ``retyped`` where it takes a type it never took, ``missing`` if it was held and is
    not; null is a type of every path. Nothing drifts from an empty history.
    """
    before = history.filter(F.col("type") != BROKEN).groupBy("path").agg(F.collect_set("type").alias("types"))
    any_before = before.agg(F.count(F.lit(1)).alias("c")).scalar()
    known = before.filter(F.col("path") != ROOT)
    present = found.join(before, "path", "left").select(
        "path", "type",
        F.when((any_before == 0) & (F.col("type") != BROKEN), EXPECTED).when(F.col("type") == BROKEN, BROKEN).when(F.col("types").isNull(), ADDED)
        .when((F.col("type") == NULL) | F.array_contains("types", F.col("type")) | (F.col("types") == F.array(F.lit(NULL))), EXPECTED)
        .otherwise(RETYPED).alias("status"),
        "records",
    )
    gone = known.join(found.select("path").distinct(), "path", "left_anti").select(
        "path", F.lit(None).cast("string").alias("type"), F.lit(MISSING).alias("status"), F.lit(0).cast("bigint").alias("records"))
    return present.union(gone)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The profiles of all batches, with the ``batch`` of each."""
    return read_or_empty(spark, path, f"{PROFILE_DDL}, batch string")


def keep(found: DataFrame, path: str, batch: str) -> None:
    """Add the profile of a batch to the history; repeating it replaces its own."""
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def variant_drift(json_column: str, history: DataFrame) -> FrameRule:
    """Nested names and types against earlier batches: missing and retyped paths, and payloads that do not parse, are
    critical, added paths a warning; one issue for each, with the first paths."""

    def issues(df: DataFrame) -> DataFrame:
        changed = drift(profile(df, json_column), history).filter(F.col("status") != EXPECTED)
        shown = F.concat_ws(" ", "path", "type")
        counted = leading(changed.withColumn("_shown", shown).repartition("status"), ["status", "path", "type"], 1_000).groupBy("status").agg(
            F.count(F.lit(1)).alias("n"), F.sum("records").alias("records"), F.sort_array(F.collect_list(F.when(F.col("_leads"), F.col("_shown")))).alias("_held"))
        first = F.array_join(F.slice("_held", 1, fixed.SAMPLE_SIZE), ", ")
        severity = F.when(F.col("status") == ADDED, "warning").otherwise("critical")
        text = F.concat(F.format_string("%d ", F.col("n")), F.col("status"), F.lit(" path(s): "), first)
        return counted.select(issue("variant_drift", severity, text, F.col("records"), {"status": F.col("status"), "paths": first}).alias("i")).select("i.*")

    return FrameRule("variant_drift", issues, {"columns": json_column})
