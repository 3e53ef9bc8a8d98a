"""The document and chunk model, and the result row of a search."""

from pyspark.sql import types as T

SCHEMA_VERSION = 1


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


DOCUMENTS = _struct(
    ("document_id", T.StringType(), False),
    ("corpus", T.StringType(), False),
    ("title", T.StringType(), False),
    ("source_url", T.StringType(), True),
    ("source_version", T.StringType(), True),
    ("source_timestamp", T.StringType(), True),
    ("license", T.StringType(), True),
    ("content_hash", T.StringType(), True),
    ("attributes", T.StringType(), False),
    ("schema_version", T.IntegerType(), False),
)

CHUNKS = _struct(
    ("chunk_instance_id", T.StringType(), False),
    ("content_id", T.StringType(), False),
    ("document_id", T.StringType(), False),
    ("parent_chunk_id", T.StringType(), True),
    ("ordinal", T.IntegerType(), False),
    ("heading_path", T.ArrayType(T.StringType()), False),
    ("text", T.StringType(), False),
    ("character_count", T.IntegerType(), False),
    ("token_count", T.IntegerType(), True),
    ("previous_chunk_id", T.StringType(), True),
    ("next_chunk_id", T.StringType(), True),
    ("attributes", T.StringType(), False),
    ("schema_version", T.IntegerType(), False),
)

#: A parser's block: where it stands, its text, what it is, and what else is known of it.
BLOCK = T.StructType(
    [
        T.StructField("heading_path", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)
