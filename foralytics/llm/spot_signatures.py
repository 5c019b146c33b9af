"""Document fingerprints of spot signatures, in DataFrame code only.

A spot is a common word (an anchor) with the next two content words after it, the
anchors between them left out. The set of a text's spots, hashed, is its
fingerprint: ordinary prose has many, while menus and junk have few. Two sets are
alike by their Jaccard similarity, which is at most the smaller length over the
larger; so pairs of sets whose lengths are too far apart are not compared at all.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foralytics.llm.common import shuffle_partitions, table

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine ist mit nicht sich und von zu "
    "au avec dans de des du elle est et la le les par pour que qui sur un une "
    "con del el en las los no para por se su una y"
).split()
ANY = "(?:" + "|".join(sorted(set(ANCHORS), key=lambda w: (-len(w), w))) + ")"
# At an anchor: the anchor, then two words that are none, each after any number of anchors.
SPOT = f"(?<= )(?=({ANY} (?:{ANY} )*+[^ ]+ (?:{ANY} )*+[^ ]+ ))"


def with_spots(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with sorted distinct 32-bit hashes of the spots of the column ``text``.

    A text without spots has one signature, of all of its words, or of its marks if
    it has no words; null and empty texts have none. The steps are columns of their
    own, so that each is worked out once a text.
    """
    whole, words, chains = F.coalesce(F.col(text), F.lit("")), F.col("__words"), F.col("__chains")
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(whole), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    # The anchor that opens a chain follows no space, so it stays.
    signatures = F.split(F.regexp_replace(chains, f"(?<= ){ANY} ", ""), "\n")
    hashes = F.sort_array(F.array_distinct(F.transform(signatures, lambda x: F.hash(x))))
    alone = F.when(F.length(F.trim(words)) > 0, F.hash(words)).otherwise(F.hash(whole))
    found = (
        F.when(F.length(whole) == 0, F.array().cast("array<int>"))
        .when(F.length(chains) == 0, F.array(alone))
        .otherwise(hashes)
    )
    return (
        df.withColumn("__words", plain)
        .withColumn("__chains", F.array_join(F.regexp_extract_all(words, F.lit(SPOT), F.lit(1)), "\n"))
        .withColumn(name, found)
        .drop("__words", "__chains")
    )


def fingerprint(of_spots: Column) -> Column:
    return F.array_join(of_spots.cast("array<string>"), " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity; 0 without a comparison where the lengths alone rule ``least`` out. Two empty sets are alike by 1."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < least * large), F.lit(0.0))
        .otherwise(common / (small + large - common))
    )


def length_class(length: Column, least: float) -> Column:
    """Partition of a set by its length: sets alike by ``least`` are in one or in neighbouring classes."""
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / F.lit(-math.log(least))).cast("int")


def near_duplicates(docs: DataFrame, queries: DataFrame, least: float = 0.8) -> DataFrame:
    """(query_id, doc_id, likeness) of every document alike to a query by ``least``.

    Both tables have (doc_id, text). Sets are partitioned by length class, and a
    query looks into its own class and the two beside it. Within a class, alike sets share
    one of the first ``n - ceil(least n) + 1`` signatures in the order of their
    hashes; these are joined, so a signature of many documents meets only the
    stated queries, and a pair is compared once. A document is not its own pair.
    """
    def indexed(df: DataFrame, name: str) -> DataFrame:
        found = with_spots(df.select(F.col("doc_id").alias(name), "text"), "text", f"{name}_spots").drop("text")
        n = F.size(f"{name}_spots")
        first = F.slice(f"{name}_spots", F.lit(1), (n - F.ceil(n * least) + 1).cast("int"))
        return found.where(n > 0).withColumns({"first": first, "class": length_class(n, least)})

    left = indexed(queries, "query_id")
    left = left.select("query_id", "query_id_spots", "first", F.explode(F.array(*[F.col("class") + k for k in (-1, 0, 1)])).alias("class"))
    right = indexed(docs, "doc_id")
    pairs = (
        left.select("query_id", "class", F.explode("first").alias("spot"))
        .join(right.select("doc_id", "class", F.explode("first").alias("spot")), ["class", "spot"])
        .where("query_id <> doc_id")
        .select("query_id", "doc_id")
        .distinct()
    )
    sets = pairs.join(left.select("query_id", "query_id_spots").distinct(), "query_id").join(right.select("doc_id", "doc_id_spots"), "doc_id")
    alike = sets.select("query_id", "doc_id", likeness(F.col("query_id_spots"), F.col("doc_id_spots"), least).alias("likeness"))
    return alike.where(F.col("likeness") >= least).distinct()


def _part(cuts: list[int], first: int = 0) -> Column:
    """Number of the cuts that are at most ``doc_id``, by halving."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    below, above = _part(cuts[:middle], first), _part(cuts[middle + 1 :], first + middle + 1)
    return F.when(F.col("doc_id") >= cuts[middle], above).otherwise(below)


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) with ``spots``, and ``next_text`` and ``next_spots`` of the next document.

    The next document is the one with the next smaller id, after the last one the
    first; rows of one id stand in the order of their hashes, a null id comes last. A
    single row is its own next. Documents are dealt into ranges of ids by measured
    quantiles, so whole texts are shuffled once. The first document of each
    range, which follows the last one of the range above, is added to that range as a row
    that is dropped again: one row a range.
    """
    parts = parts or shuffle_partitions(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    quantiles = [i / parts for i in range(1, parts)]
    cuts = docs.select(F.percentile_approx("doc_id", quantiles or [0.5], 100 * parts)).first()[0] or []
    part = _part(sorted(set(cuts))).cast("int")
    # One row a range.
    tops = {
        r["part"]: r["top"]
        for r in docs.where("doc_id is not null").groupBy(part.alias("part")).agg(F.max("doc_id").alias("top")).collect()
    }
    filled = sorted(tops)
    ranged = docs.select(part.alias("part"), "doc_id", "text", F.lit(False).alias("added"))
    if filled:
        follows = [(p, tops[filled[i - 1]]) for i, p in enumerate(filled)]
        if 0 not in tops:
            follows.append((0, tops[filled[-1]]))
        heads = docs.where(F.col("doc_id").isin([top for _, top in follows])).groupBy("doc_id").agg(
            F.max_by("text", F.xxhash64("text")).alias("text")
        )
        after = docs.sparkSession.createDataFrame(follows, "part int, doc_id long")
        ranged = ranged.unionByName(after.join(heads, "doc_id").select("part", "doc_id", "text", F.lit(True).alias("added")))
    order = Window.partitionBy("part").orderBy("added", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    # The part is the number of the partition; a hash would put several in one.
    placed = with_spots(ranged.repartitionById(parts, F.col("part")), "text", "spots")
    led = placed.select(
        "*", F.lead("text").over(order).alias("next_text"), F.lead("spots").over(order).alias("next_spots"),
        F.lead("added").over(order).isNotNull().alias("led"),
    )
    itself = F.when(F.col("led"), F.col("next_text")).otherwise(F.col("text"))
    return led.where(~F.col("added")).select(
        "doc_id", "text", "spots", itself.alias("next_text"),
        F.when(F.col("led"), F.col("next_spots")).otherwise(F.col("spots")).alias("next_spots"),
    )


def edited_and_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are to it and to the next one's."""
    whole = F.coalesce("text", F.lit(""))
    moved = F.expr("length(coalesce(text, '')) div 3").cast("int")
    edited = F.concat(
        F.substring(whole, F.lit(1), F.length(whole) - moved), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), moved)
    )
    texts = with_next(docs).select("doc_id", F.length(whole).cast("long").alias("n_chars"), edited.alias("edited"), "spots", "next_spots")
    sets = with_spots(texts, "edited", "edited_spots")
    return sets.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"), fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts and their likeness."""
    return edited_and_next(table(spark, sf_dir, "documents"))
