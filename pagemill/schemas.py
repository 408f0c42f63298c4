"""Record types that travel between operators. Schemas are declared, never inferred."""

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
])

PAIR = T.StructType([
    T.StructField("prompt", T.StringType()),
    T.StructField("completion", T.StringType()),
])

# Everything one pass over a page's HTML yields.
PARSED = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("hrefs", T.ArrayType(T.StringType())),
])

VISITED = T.StructType([T.StructField("url", T.StringType())])

# (depth, src_ord, pos) sorted ascending is the queue order: level first, then the
# rank of the page that held the link, then the link's place on that page.
FRONTIER = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("src_ord", T.LongType()),
    T.StructField("pos", T.IntegerType()),
])
