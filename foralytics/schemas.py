"""Column layouts of the forum tables."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The 22 columns of a Posts CSV dump, in file order.
POSTS = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("AcceptedAnswerId", T.LongType()),
        T.StructField("AnswerCount", T.LongType()),
        T.StructField("Body", T.StringType()),
        T.StructField("ClosedDate", T.TimestampNTZType()),
        T.StructField("CommentCount", T.LongType()),
        T.StructField("CommunityOwnedDate", T.TimestampNTZType()),
        T.StructField("ContentLicense", T.StringType()),
        T.StructField("CreationDate", T.TimestampNTZType()),
        T.StructField("FavoriteCount", T.LongType()),
        T.StructField("LastActivityDate", T.TimestampNTZType()),
        T.StructField("LastEditDate", T.TimestampNTZType()),
        T.StructField("LastEditorDisplayName", T.StringType()),
        T.StructField("LastEditorUserId", T.LongType()),
        T.StructField("OwnerDisplayName", T.StringType()),
        T.StructField("OwnerUserId", T.LongType()),
        T.StructField("ParentId", T.LongType()),
        T.StructField("PostTypeId", T.IntegerType()),
        T.StructField("Score", T.LongType()),
        T.StructField("Tags", T.StringType()),
        T.StructField("Title", T.StringType()),
        T.StructField("ViewCount", T.LongType()),
    ]
)

# The user columns the analyses need.
USERS = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("DisplayName", T.StringType()),
        T.StructField("Reputation", T.LongType()),
    ]
)

# The two tables handed over between the extraction job and the reports.
RESPUESTAS = T.StructType(
    [
        T.StructField("QuestionId", T.LongType()),
        T.StructField("NRespuestas", T.LongType()),
        T.StructField("ScoreTotal", T.LongType()),
    ]
)
PREGUNTAS = T.StructType(
    [
        T.StructField("QuestionId", T.LongType()),
        T.StructField("UserId", T.LongType()),
        T.StructField("Año", T.IntegerType()),
    ]
)

# What the jobs read of the tables that come as Parquet.
POST_COLUMNS = T.StructType(
    [POSTS[name] for name in ("Id", "PostTypeId", "ParentId", "OwnerUserId", "CreationDate", "Score")]
)
USER_COLUMNS = T.StructType([USERS["Id"], USERS["DisplayName"]])
COMMENTS = T.StructType([T.StructField("PostId", T.LongType())])
TAGS = T.StructType([T.StructField("Id", T.LongType()), T.StructField("TagName", T.StringType())])

QUESTION = 1
ANSWER = 2

# Types of one family hold the same values to the analyses.
FAMILIES = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.DateType, T.TimestampType, T.TimestampNTZType),
)


def check_layout(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail before any job runs when a column is missing or of another family of types."""

    def fits(actual: T.DataType | None, wanted: T.DataType) -> bool:
        return any(isinstance(actual, f) and isinstance(wanted, f) for f in FAMILIES) or actual == wanted

    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"found {actual[f.name].simpleString() if f.name in actual else 'nothing'}"
        for f in expected.fields
        if not fits(actual.get(f.name), f.dataType)
    ]
    if wrong:
        raise ValueError("unexpected schema: " + "; ".join(wrong))
    return df


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail before any job runs when a column is missing or has another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"found {actual[f.name].simpleString() if f.name in actual else 'nothing'}"
        for f in expected.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("unexpected schema: " + "; ".join(wrong))
    return df
