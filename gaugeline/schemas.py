"""Explicit schemas of the tables that cross a boundary."""

from pyspark.sql import types as T

OBSERVATIONS = T.StructType(
    [
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("indicator_code", T.StringType()),
        T.StructField("indicator_name", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_source", T.StringType()),
    ]
)

DOCUMENT_TEXT_COLUMNS = [
    "doc_id",
    "title",
    "abstract",
    "display_date",
    "doc_type",
    "pdf_url",
    "countries",
    "topics",
    "language",
]

DOCUMENTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in DOCUMENT_TEXT_COLUMNS]
    + [
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_source", T.StringType()),
    ]
)

CHUNKS = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("chunk_index", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("display_date", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("countries", T.StringType()),
        T.StructField("topics", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_source", T.StringType()),
    ]
)

SEED_COUNTRIES = T.StructType(
    [
        T.StructField("country_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("income_group", T.StringType()),
        T.StructField("is_asean", T.StringType()),
        T.StructField("is_primary", T.StringType()),
    ]
)

SEED_INDICATORS = T.StructType(
    [
        T.StructField("indicator_code", T.StringType()),
        T.StructField("indicator_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("frequency", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

# One entry of an observation API response.
OBSERVATION_ENTRY = T.StructType(
    [
        T.StructField("economy", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# One page of a document-search API response. ``count`` is a list or a scalar,
# so it stays raw JSON text until the normaliser looks at it.
DOCUMENT_RECORD = T.StructType(
    [
        T.StructField("display_title", T.StringType()),
        T.StructField("abstracts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("display_date", T.StringType()),
        T.StructField("docdt", T.StringType()),
        T.StructField("docty", T.StringType()),
        T.StructField("pdfurl", T.StringType()),
        T.StructField("count", T.StringType()),
        T.StructField("topicv3", T.StringType()),
        T.StructField("lang", T.StringType()),
    ]
)
DOCUMENT_PAGE = T.StructType(
    [
        T.StructField("total", T.LongType()),
        T.StructField("documents", T.MapType(T.StringType(), DOCUMENT_RECORD)),
    ]
)

EMBEDDINGS = T.StructType(
    [
        T.StructField("source_type", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("metadata", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
