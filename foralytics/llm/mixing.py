"""Mixing sources to target weights by systematic sampling.

Every source gets a target, in words. A document of the source is expected in the
mix target / source size times, at most ``CAP`` times. The expected copies of the
documents are summed up in a fixed order within the source, one random offset is
added, and a document is emitted once per whole number that its step crosses.
All of it is DataFrame code on whole numbers, so reruns agree to the row.

A source may hold a third of all rows, so nothing sorts a source as one group:
documents are dealt into cells by (size class, hash of the id), the cells' sums
are added up within a source, and rows are ordered only within a cell. Size
classes come first in the order, so copies are spread evenly over short and long
documents and the words taken stay near the target.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foralytics.llm.common import row_key, table, word_count
from foralytics.scratch import discard, scratch_path, stage

WEIGHTS = (5, 2, 1)
CAP = 2
# A copy is so many units; expected copies are whole numbers of units.
UNITS = 1 << 24
SALTS = 256


def _fraction(key: Column, parts: int) -> Column:
    """0 to parts - 1 from the md5 of a string."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % parts


def size_class(size: Column) -> Column:
    """Binary length and leading five bits: classes an eighth wide or less, in order of size."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.rpad(F.substring(bits, 1, 5), 5, "0"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], times_2: int) -> DataFrame:
    """(source, source_size) with ``target``: ``times_2`` / 2 of all words shared by weight.

    Weights go round in the code point order of the sources, null last. No target
    exceeds ``CAP`` times its source; what is cut goes to the others by weight.
    With the sources ordered by cap over weight, the cut ones come first. Cutting
    one more raises the level of the rest while it has to be cut and lowers it
    after that, so the highest level is the share.
    One row a source, so the windows below see a table of sources, not of rows.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place % len(weights) + 1).cast("int"))
    weighted = sizes.select("source", "source_size", weight.alias("weight"))
    by_need = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none = F.lit(0).cast("long")
    steps = weighted.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("source_size").over(before), none).alias("cut_size"),
        F.coalesce(F.sum("weight").over(before), none).alias("cut_weight"),
    ).select(
        "source", "source_size", "weight",
        ((times_2 * F.col("all_size") - 2 * CAP * F.col("cut_size")) / (2 * (F.col("all_weight") - F.col("cut_weight")))).alias("level"),
    )
    share = F.max("level").over(everything)
    return steps.select(
        "source", "source_size",
        F.least(CAP * F.col("source_size").cast("double"), share * F.col("weight")).alias("target"),
    )


def systematic_copies(rows: DataFrame, group: str, key: str, size: str, expected: Column, salts: int = SALTS) -> DataFrame:
    """``rows`` with ``copies``, from the ``expected`` copies of each row (a double, one value a group or not).

    ``key`` orders rows within a cell and gives the cell; rows equal in key and
    size are interchangeable. A null group is a group like any other.
    """
    units = F.floor(expected * UNITS).cast("long")
    cells = rows.select(
        "*", units.alias("_units"), size_class(F.col(size)).alias("_class"),
        _fraction(F.coalesce(F.col(key).cast("string"), F.lit("")), salts).alias("_salt"),
    )
    sums = cells.groupBy(group, "_class", "_salt").agg(F.sum("_units").alias("n")).withColumnsRenamed(
        {group: "_g", "_class": "_c", "_salt": "_s"}
    )
    up_to = Window.partitionBy("_g").orderBy("_c", "_s").rowsBetween(Window.unboundedPreceding, -1)
    offset = _fraction(F.concat(F.lit("offset "), F.coalesce("_g", F.lit("null"))), UNITS)
    starts = sums.select("_g", "_c", "_s", (F.coalesce(F.sum("n").over(up_to), F.lit(0)) + offset).alias("_start"))
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_class") == F.col("_c")) & (F.col("_salt") == F.col("_s"))
    within = Window.partitionBy(group, "_class", "_salt").orderBy(F.col(size), F.col(key)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    run = cells.withColumn("_run", F.sum("_units").over(within)).join(starts, same)
    copies = F.expr(f"(_start + _run) div {UNITS} - (_start + _run - _units) div {UNITS}")
    return run.select(*rows.columns, copies.cast("long").alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, times_2: int = 3, key: str = "doc_id") -> DataFrame:
    """``docs`` (``key``, source, size) with ``source_size``, ``target`` and ``copies``.

    Null or empty texts have size 0 and are drawn like others; null sources form
    one source, ordered last. A source without words has the target 0 and no
    copies. An empty table gives an empty one.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, times_2).withColumnRenamed("source", "_source")
    joined = docs.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return systematic_copies(joined, "source", key, "size", expected)


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, times_2: int = 3) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is drawn; all columns stay.

    Rows equal in id, source and text are taken for copies of one row, any of which stands for
    all where other columns differ. ``docs`` must have no column ``__row``, ``__copies`` or ``__copy``.
    """
    spark = docs.sparkSession
    at = {name: scratch_path(spark, name) for name in ("mix", "drawn")}
    key = row_key(F.col("doc_id"), F.col("source"), F.xxhash64("text"))
    slim = stage(docs.select(key.alias("__row"), "source", word_count(F.col("text")).alias("size")), "", at["mix"])
    drawn = mixed(slim, weights, times_2, "__row").groupBy("__row").agg(F.sum("copies").alias("__copies")).where("__copies > 0")
    drawn = stage(drawn, "", at["drawn"])
    discard(spark, at["mix"])
    # One key joins the rows and tells repeated ones, so texts are shuffled once.
    once = docs.withColumn("__row", key).join(drawn, "__row").dropDuplicates(["__row"])
    return once.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = stage(
        table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix"
    )
    return mixed(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )
