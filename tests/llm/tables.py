"""Small tables of documents with every awkward case."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names clash with those that operators work out.
CLASHING = "score double, size long, start long, shard int, component_id long, copies long, label long, text_key long, spots string"


def prose(seed, n):
    random.seed(seed)
    return " ".join(random.choice("the of and lorem ipsum dolor sit amet vita nova brevis longa terra".split()) + str(random.randint(0, 40)) * random.randint(0, 1) for _ in range(n))


def awkward_rows():
    base = prose(1, 120)
    near = base.replace("lorem", "l0rem", 1)
    return [
        (1, base, "en", "a"),
        (2, near, "en", "a"),
        (3, base, "en", "b"),
        (3, base, "en", "b"),  # a repeated row
        (4, None, None, None),
        (5, "", "en", None),
        (6, " \t\n ", "de", "b"),
        (7, "one", "en", "c"),
        (8, "one two", "en", "c"),
        (9, "ONE two", "en", "c"),
        (10, "!!! ??? 123", "en", "a"),
        (11, prose(2, 30_000), "en", "a"),
        (12, prose(3, 80) + " " + base, "fr", "b"),
        (13, prose(4, 90), "fr", "a"),
        (14, "漢字 かな été 🙂🙂 naïve", None, "c"),
        (15, near, "en", "c"),
        (-2, prose(5, 70), "en", "a"),
    ]


def documents(spark, rows=None, extra=False):
    rows = awkward_rows() if rows is None else rows
    rows = [(*r, len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for column in CLASHING.split(", "):
            name, kind = column.split()
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def save(df, folder, name="documents"):
    """The folder as a table directory with ``name`` in it."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
