"""Reading delivered files and writing tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: A record that could not be read, as text, and the file that it came from.
RECORD, FILE = "_malformed_record", "_file"
#: Reader options by format under which a malformed record is kept as text, with the columns that could be read.
PERMISSIVE = {
    "csv": {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD},
    "json": {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD},
}
#: In JSON text without its strings, something other than the rest of a value behind a closed array: a second value.
_STRINGS, _SECOND_VALUE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"\]\s*[^\s,\]}]"


def delivered_schema(schema: StructType) -> StructType:
    return StructType([*schema, StructField(RECORD, StringType())])


def read_delivered(spark: SparkSession, path: str, schema: StructType, file_format: str, array: bool = False, **options) -> DataFrame:
    """Delivered files with the columns of ``schema``, ``FILE`` and, for text formats, ``RECORD`` (null for what is well formed).

    ``options`` are those of Spark's reader. JSON has one record per line, or with ``array`` one array per file, which is then read by one task; of an array,
    single elements can be malformed. A file that is not one array is one malformed record.
    """
    file = F.col("_metadata.file_path").alias(FILE)
    if not array:
        reader = spark.read.schema(delivered_schema(schema)) if file_format in PERMISSIVE else spark.read.schema(schema)
        rows = reader.format(file_format).options(**{**PERMISSIVE.get(file_format, {}), **options}).load(path)
        return rows.select("*", file)
    whole = spark.read.text(path, wholetext=True).select("value", file)
    text = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    plain = F.regexp_replace(text, _STRINGS, '""')
    single = text.startswith("[") & text.endswith("]") & ~plain.rlike(_SECOND_VALUE)
    elements = F.from_json(F.when(single, text), "array<string>", {"mode": "PERMISSIVE"})
    each = whole.select(FILE, "value", elements.alias("elements")).select(
        FILE, F.explode(F.coalesce("elements", F.array("value"))).alias("element"), F.col("elements").isNotNull().alias("listed")
    )
    parsed = F.from_json("element", delivered_schema(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD})
    # What stands in an array must be a record; an empty one would pass for a record of nulls.
    record = F.when(~F.col("listed") | ~F.ltrim("element").startswith("{"), F.col("element")).otherwise(F.col(f"r.{RECORD}"))
    return each.select("element", "listed", FILE, parsed.alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in schema.names], record.alias(RECORD), FILE)


def write_json(df: DataFrame, path: str, snapshot_time: Column) -> None:
    """Stamp a snapshot and write it as JSON records, one per line, nulls and non-ASCII kept."""
    df.withColumn("snapshot_time", snapshot_time).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def path_exists(spark: SparkSession, path: str, schema: StructType) -> bool:
    """Whether something has been written at ``path``."""
    try:
        read_parquet(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the session catalog has a table or view of that name."""
    return spark.catalog.tableExists(name)


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name, in the order and with the types of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def append(df: DataFrame, path: str, schema: StructType, partition_by: list[str] = ()) -> None:
    """Append by column name, creating the table if it is absent."""
    extra = [F.col(c) for c in partition_by if c not in schema.names]
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], *extra)
    if partition_by:
        # Small partitions are put together and large ones split to the advisory size at run time.
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def export(df: DataFrame, directory: str, name: str, cluster_by: list[str] = ()) -> str:
    """Write one table as ``directory/name.parquet``.

    ``cluster_by`` range-partitions and sorts by some columns, so that readers with a filter on
    them skip most files and row groups. A value that many rows share is cut by the columns after it.
    """
    path = f"{directory}/{name}.parquet"
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)
    return path


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a DataFrame as a view: computed where it is used."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, directory: str, name: str, cluster_by: list[str] = ()) -> DataFrame:
    """Store a DataFrame and hand back the stored form: computed once."""
    return df.sparkSession.read.schema(df.schema).parquet(export(df, directory, name, cluster_by))
