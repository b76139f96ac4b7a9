"""Record types of the data model. Rows that lack a required field are dropped by the readers, not fatal."""

from pyspark.sql import types as T

_S, _A = T.StringType(), T.ArrayType(T.StringType())

FLASHPOINT = T.StructType([
    T.StructField("id", _S, False), T.StructField("title", _S), T.StructField("description", _S),
    T.StructField("entities", _A), T.StructField("domains", _A), T.StructField("run_id", _S),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])
FEED = T.StructType(
    [T.StructField(n, _S) for n in ("id", "flashpoint_id", "url", "title", "seendate", "domain", "language", "sourcecountry", "description", "image", "raw_text", "raw_text_en", "compressed_text", "processed_text", "summary")]
    + [T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType())]
)
CLUSTER = T.StructType([
    T.StructField("flashpoint_id", _S), T.StructField("cluster_id", T.IntegerType()), T.StructField("summary", _S), T.StructField("article_count", T.IntegerType()),
    T.StructField("top_domains", _A), T.StructField("all_domains", _A), T.StructField("languages", _A), T.StructField("urls", _A), T.StructField("images", _A),
])
API_ARTICLE = T.StructType([T.StructField(n, _S) for n in ("url", "url_mobile", "title", "seendate", "socialimage", "domain", "language", "sourcecountry")])
VECTOR = T.StructType([
    T.StructField("flashpoint_id", _S), T.StructField("id", _S), T.StructField("document", _S),
    T.StructField("metadata", T.StructType([T.StructField(n, _S) for n in ("url", "image", "domain", "sourcecountry", "language")])),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])
REQUIRED = {"feed": ("id", "flashpoint_id", "url", "title"), "flashpoint": ("id", "title")}
