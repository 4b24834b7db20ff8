"""Fixed schemas of the catalogue's records; IRIs of the fields are kept in column metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType, StructField, StructType, TimestampType

_S, _L, _T = StringType(), ArrayType(StringType()), TimestampType()

#: Field, IRI and type of a normalised model record.
MODEL_FIELDS = (
    ("identifier", "https://schema.org/identifier", _L), ("name", "https://schema.org/name", _S), ("url", "https://schema.org/url", _L),
    ("author", "https://schema.org/author", _S), ("sharedBy", "https://w3id.org/fair4ml/sharedBy", _S), ("source", "https://schema.org/source", _S),
    ("dateCreated", "https://schema.org/dateCreated", _T), ("dateModified", "https://schema.org/dateModified", _T),
    ("datePublished", "https://schema.org/datePublished", _T), ("description", "https://schema.org/description", _S),
    ("abstract", "https://schema.org/abstract", _S), ("keywords", "https://schema.org/keywords", _L), ("inLanguage", "https://schema.org/inLanguage", _L),
    ("license", "https://schema.org/license", _S), ("mlTask", "https://w3id.org/fair4ml/mlTask", _L),
    ("modelCategory", "https://w3id.org/fair4ml/modelCategory", _L), ("domain", "https://w3id.org/fair4ml/domain", _S),
    ("baseModel", "https://w3id.org/fair4ml/baseModel", _L), ("intendedUse", "https://w3id.org/fair4ml/intendedUse", _S),
    ("trainedOn", "https://w3id.org/fair4ml/trainedOn", _L), ("discussionUrl", "https://schema.org/discussionUrl", _S),
    ("archivedAt", "https://schema.org/archivedAt", _S), ("readme", "https://w3id.org/codemeta/readme", _S),
    ("issueTracker", "https://w3id.org/codemeta/issueTracker", _S), ("parameterCount", "https://w3id.org/fair4ml/parameterCount", _S),
)

METADATA = MapType(
    StringType(),
    StructType([StructField("extraction_method", _S), StructField("confidence", DoubleType()), StructField("source_field", _S), StructField("notes", _S)]),
)
MODEL = StructType([StructField(n, t, True, {"iri": i}) for n, i, t in MODEL_FIELDS] + [StructField("extraction_metadata", METADATA)])

RAW_HUB = (
    "modelId string, author string, last_modified timestamp, downloads long, likes long, library_name string, "
    "safetensors struct<parameters: map<string, long>, total: long>, tags array<string>, pipeline_tag string, createdAt timestamp, card string"
)
RAW_IMAGE = (
    "modelId string, name string, url string, author string, sharedBy string, dateCreated string, dateModified string, datePublished string, "
    "intendedUse string, description string, documentation string, readme_file string, archivedAt string, discussionUrl string, issueTracker string, "
    "licence string, license string, keywords string, trainedOn string, citation string, referencePublication string"
)


def field_table(spark: SparkSession, schema: StructType = MODEL) -> DataFrame:
    """(property, iri, type): what a schema's columns mean."""
    rows = [(f.name, f.metadata.get("iri"), f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame(rows, "property string, iri string, type string")
