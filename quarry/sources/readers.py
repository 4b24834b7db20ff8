"""Sources: record files, entity files, line lists, catalogues, and unions of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.text import keyword_cell


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records as a JSON array or as JSON lines, with an explicit schema. A missing path raises.

    Malformed records become rows whose _corrupt column holds the text, if the schema has such a column.
    """
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    first = spark.read.option("wholetext", False).text(path).filter(F.trim("value") != "").limit(1).collect()
    if not first:
        raise ValueError(f"{path} holds no records")
    whole = first[0]["value"].lstrip().startswith("[")
    return reader.option("multiLine", whole).json(path)


def read_entities(spark: SparkSession, path: str | None, schema: StructType | str) -> DataFrame:
    """An entity file, or no rows where there is none; any other fault is raised."""
    if not path:
        return spark.createDataFrame([], schema)
    try:
        return read_records(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    except ValueError:  # an empty file
        pass
    return spark.createDataFrame([], schema)


def read_lines(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    """One id a line; blank lines and lines with # in front are left out."""
    lines = spark.read.text(path).select(F.trim("value").alias(column))
    return lines.filter((F.col(column) != "") & ~F.startswith(column, F.lit("#")))


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, definition, aliases): a curated table whose aliases are a JSON list; a malformed list is empty."""
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema("keyword string, definition string, aliases string").csv(path)
    return rows.withColumn("aliases", F.coalesce(F.from_json("aliases", "array<string>"), F.array().cast("array<string>")))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(task, category) of a task catalogue, each task once."""
    return spark.read.option("header", True).schema("task string, category string").csv(path).dropDuplicates(["task"])


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """A table of questions or templates separated by semicolons."""
    return spark.read.option("header", True).option("sep", ";").csv(path)


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def tables_with_suffix(spark: SparkSession, suffix: str) -> DataFrame:
    """The union of all catalogue tables whose names end with a suffix."""
    names = sorted(t.name for t in spark.catalog.listTables() if t.name.endswith(suffix))
    if not names:
        raise ValueError(f"no table ends with {suffix}")
    return union_tables([spark.table(n) for n in names])


def keyword_rows(df: DataFrame, id_col: str, column: str) -> DataFrame:
    """(id, keyword) from cells that hold JSON lists or names between commas."""
    return df.select(id_col, F.explode(keyword_cell(F.col(column))).alias("keyword"))
