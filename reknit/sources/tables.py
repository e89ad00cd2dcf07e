"""Tables from extracts, delimited files, remote databases and literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from reknit.session import materialize

Schema = StructType | str

# Holds the text of a record that does not fit, while it is read.
RECORD = "__record"


def read_tables(spark: SparkSession, folder: str, names: Iterable[str], format: str = "parquet",
                schemas: Mapping[str, Schema] | None = None) -> dict[str, DataFrame]:
    """The named tables of an extract, one folder or file each, with a stated schema if given."""
    tables = {}
    for name in names:
        reader = spark.read.format(format)
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        path = f"{folder.rstrip('/')}/{name}.{format}"
        if format == "csv" and schemas and name in schemas:
            tables[name] = read_delimited(spark, path, schemas[name])
            continue
        if format == "csv":
            reader = reader.option("header", True)
        tables[name] = reader.load(path)
    return tables


def read_remote(spark: SparkSession, url: str, tables: Iterable[str],
                properties: Mapping[str, str] | None = None,
                split: Mapping[str, tuple[str, int]] | None = None) -> dict[str, DataFrame]:
    """Tables of a remote database over JDBC; filters and columns are pushed to it.

    ``split`` names, per table, a numeric column and the number of parallel reads over its
    range. The range is asked from the database.
    """
    found = {}
    for name in tables:
        reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
        if split and name in split:
            column, reads = split[name]
            bounds = reader.option("query", f"SELECT min({column}) AS lo, max({column}) AS hi "
                                            f"FROM {name}").load().first()
            reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
            if bounds.lo is not None:
                reader = reader.options(partitionColumn=column, lowerBound=bounds.lo,
                                        upperBound=bounds.hi, numPartitions=reads)
        found[name] = reader.option("dbtable", name).load()
    return found


def read_delimited(spark: SparkSession, path: str, schema: Schema, sep: str = ",") -> DataFrame:
    """A UTF-8 file with a header, whose columns are found by name in whatever order.

    Columns outside the schema are left out, absent ones are an error, and so are files of
    one folder with different headers and rows that don't fit.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.csv(path, sep=sep, header=True, encoding="UTF-8").columns
    absent = [name for name in schema.names if name not in header]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    ordered = StructType([schema[name] if name in schema.names else StructField(name, StringType())
                          for name in header])
    return spark.read.csv(path, sep=sep, header=True, schema=ordered, encoding="UTF-8",
                          mode="FAILFAST", enforceSchema=False).select(
        *[F.col(f"`{name}`") for name in schema.names])


def read_with_rejects(spark: SparkSession, path: str, schema: Schema, sep: str = ","
                      ) -> tuple[DataFrame, DataFrame]:
    """The rows of a delimited file that fit, and the others as (file, record).

    As ``read_delimited``, but a record that does not fit is set aside as it stands in its file:
    one with too few or too many fields or with a value of another type. Together they are all
    records; what has been parsed is written to the scratch folder, and both read that.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.csv(path, sep=sep, header=True, encoding="UTF-8").columns
    absent = [name for name in schema.names if name not in header]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    ordered = StructType([
        *(schema[name] if name in schema.names else StructField(name, StringType())
          for name in header), StructField(RECORD, StringType())])
    found = spark.read.csv(path, sep=sep, header=True, schema=ordered, encoding="UTF-8",
                           mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD,
                           enforceSchema=False)
    # Read once, with all its columns: a record of which only some are looked at may fit.
    parsed = materialize(found.select(
        *(F.col(f"`{name}`") for name in dict.fromkeys([*schema.names, *header])), RECORD,
        F.col("_metadata.file_path").alias(f"{RECORD}_file")), "parsed")
    fits = F.col(RECORD).isNull()
    return (parsed.filter(fits).select(*(F.col(f"`{name}`") for name in schema.names)),
            parsed.filter(~fits).select(F.col(f"{RECORD}_file").alias("file"),
                                        F.col(RECORD).alias("record")))


def diff_schema(left: str, right: str) -> str:
    """The columns of a difference list between two named databases."""
    return (f"{left}_id_zp long, {right}_id_zp long, {left}_cd_nom long, {right}_cd_nom long, "
            "nom_obs string")


def read_diff_csv(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """A semicolon-separated UTF-8 file with a quoted header."""
    return read_delimited(spark, path, schema, ";")


def read_import_batch(spark: SparkSession, root: str, name: str, schema: Schema, number: str,
                      imported: date, rename: Mapping[str, str] | None = None,
                      sep: str = ",") -> DataFrame:
    """One file of a numbered import, ``root/NN/name.csv``, stamped with number and date.

    ``rename`` maps the source columns to the expected ones (site code, site description).
    """
    batch = read_delimited(spark, f"{root.rstrip('/')}/{number}/{name}.csv", schema, sep)
    return batch.withColumnsRenamed(dict(rename or {})).withColumns(
        {"import_number": F.lit(number), "import_date": F.lit(imported)})


def write_import_batch(batch: DataFrame, path: str) -> None:
    """Add a batch to an import table; a batch that was there before is replaced."""
    (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("import_number").parquet(path))


def values(spark: SparkSession, rows: Sequence[tuple], schema: Schema) -> DataFrame:
    """Literal rows, as a local relation whose size the optimizer knows."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    named = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, to_arrow_schema(schema)), schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Name a table for the session."""
    df.createOrReplaceTempView(name)
    return df
