"""Declared schemas. One superset manifest schema serves every manifest variant."""

from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("audio_filepath", T.StringType()),
        T.StructField("start_time", T.DoubleType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)
MANIFEST_COLUMNS = [f.name for f in MANIFEST]

TSV = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("sentence", T.StringType())]
)

SUBTITLE = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("start", T.DoubleType()),
        T.StructField("duration", T.DoubleType()),
    ]
)

OP = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("hyp", T.StringType()),
        T.StructField("ref_pos", T.IntegerType()),
        T.StructField("hyp_pos", T.IntegerType()),
    ]
)

COUNTS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("cor", "sub", "ins", "del")])
