"""Fixed, explicit schemas of every table the library reads or returns."""

from pyspark.sql import types as T

_AUTHOR_REF = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("display_name", T.StringType()),
])

_INSTITUTION = T.StructType([
    T.StructField("lineage", T.ArrayType(T.StringType())),
])

#: A work as the catalogue publishes it (only the fields that are used).
RAW_WORK = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("publication_year", T.IntegerType()),
    T.StructField("primary_location", T.StructType([
        T.StructField("source", T.StructType([
            T.StructField("display_name", T.StringType()),
        ])),
    ])),
    T.StructField("authorships", T.ArrayType(T.StructType([
        T.StructField("author", _AUTHOR_REF),
        T.StructField("institutions", T.ArrayType(_INSTITUTION)),
    ]))),
    T.StructField("referenced_works", T.ArrayType(T.StringType())),
    T.StructField("cited_by_count", T.IntegerType()),
])

AUTHORS = T.ArrayType(T.StructType([
    T.StructField("authorId", T.StringType()),
    T.StructField("name", T.StringType()),
]))

#: A normalised paper.
PAPER = T.StructType([
    T.StructField("paperId", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("authors", AUTHORS),
    T.StructField("referenced_works", T.ArrayType(T.StringType())),
    T.StructField("cited_by_count", T.IntegerType()),
])

#: A graph vertex: a paper whose key is called ``id``.
VERTEX = T.StructType(
    [T.StructField("id", T.StringType())] + [f for f in PAPER.fields if f.name != "paperId"]
)

EDGE = T.StructType([
    T.StructField("src", T.StringType()),
    T.StructField("dst", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("edge_type", T.StringType()),
])

#: Members of groups in which every two papers are linked.
CLIQUE = T.StructType(
    [T.StructField("clique", T.StringType()), T.StructField("id", T.StringType()), T.StructField("weight", T.DoubleType())]
)

#: A line that was not read in full, as ``ingest_papers`` keeps it.
REJECT = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("place", T.LongType()),
    T.StructField("line", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("kept", T.BooleanType()),
])

#: An archive of raw works in the manifest of its folder.
ARCHIVE = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("saved_at", T.TimestampType()),
    T.StructField("path", T.StringType()),
    T.StructField("n_works", T.LongType()),
    T.StructField("parameters", T.StringType()),
])
