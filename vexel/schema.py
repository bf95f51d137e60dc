"""Fixed table layouts."""

from pyspark.sql import types as T

# Vector length, padding and truncation of the sentence model, and
# the number of hits a search returns unless told otherwise.
DEFAULT_DIM = 384
DEFAULT_PAD_TO = 128
DEFAULT_MAX_TOKENS = 384
DEFAULT_K = 10

FLOAT_BYTES = 4

VECTOR = T.ArrayType(T.FloatType())

STORE = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk_pos", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("embedding", VECTOR),
        T.StructField("ingest_id", T.StringType()),
    ]
)

#: Columns in the files of a store; the others follow from its commit log.
STORED = T.StructType([f for f in STORE if f.name not in ("pos", "offset", "ingest_id")])

PAIR = T.StructType([f for f in STORE if f.name in ("pos", "offset", "text", "embedding")])

JOURNAL = T.StructType(
    [
        T.StructField("Offset", T.LongType()),
        T.StructField("Text", T.StringType()),
    ]
)

PACKED = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("embedding", VECTOR),
    ]
)


def record_bytes(dim: int) -> int:
    """Size of one packed vector."""
    if dim <= 0:
        raise ValueError("dim must be positive")
    return dim * FLOAT_BYTES
