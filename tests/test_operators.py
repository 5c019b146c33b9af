import bisect
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foralytics.operators.mapping import map_reduce, map_rows
from foralytics.operators.quantiles import summary
from foralytics.operators.selection import lower_half, row_at
from helpers import plan, unordered


@pytest.mark.parametrize("n", [0, 1, 2, 5, 100])
def test_half_of_consecutive_keys(spark, n):
    df = spark.range(n).repartition(3)
    assert sorted(r.id for r in lower_half(df, ["id"]).collect()) == list(range(n // 2, n))


@pytest.mark.parametrize("size", [9, 60, 4096])
def test_half_equals_a_sort(spark, size):
    draw = random.Random(3)
    data = [(draw.choice([5, 5, 5, -(2**62), 2**62, draw.randrange(-99, 99)]), i) for i in range(501)]
    draw.shuffle(data)
    df = spark.createDataFrame(data, "a bigint, b bigint")
    got = lower_half(df, ["a", "b"], size)
    assert unordered(got) == sorted(sorted(data)[250:], key=repr)
    first = set(unordered(df.exceptAll(got)))
    assert len(first) == 250 and not first & set(unordered(got))


def test_half_needs_a_key_without_nulls(spark):
    with pytest.raises(ValueError, match="identify"):
        lower_half(spark.createDataFrame([(1,), (1,), (1,)], "a bigint"), ["a"])
    with pytest.raises(ValueError, match="NULL"):
        lower_half(spark.createDataFrame([(1,), (None,)], "a bigint"), ["a"])


def test_half_is_a_filter_on_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    text = plan(lower_half(spark.read.parquet(path), ["id"]))
    assert "Exchange" not in text and "Window" not in text
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,50)]" in text


def test_half_by_date_and_time(spark):
    draw = random.Random(5)
    days = [(datetime(1950 + i % 90, 1 + i % 12, 1 + i % 28, i % 24, i % 60, i % 60, draw.randrange(10**6)), i) for i in range(301)]
    for kind in ("timestamp", "timestamp_ntz", "date"):
        df = spark.createDataFrame(days, "t timestamp_ntz, i int").select(F.col("t").cast(kind).alias("t"), "i").repartition(4)
        every = sorted((tuple(r) for r in df.collect()))
        assert sorted(tuple(r) for r in lower_half(df, ["t", "i"]).collect()) == every[150:]


def test_half_refuses_other_types_before_any_job(spark):
    df = spark.createDataFrame([(1.5, [1]), (2.5, [9])], "d double, s array<int>")
    for name in ("d", "s"):
        with pytest.raises(ValueError, match="cannot order a half"):
            lower_half(df, [name])


def test_half_by_texts_and_decimals(spark):
    draw = random.Random(7)
    data = [("".join(draw.choice("aZé漢🙂 \n'") for _ in range(draw.randint(0, 6))), Decimal(draw.randrange(-(10**20), 10**20)) / 100, i) for i in range(700)]
    df = spark.createDataFrame(data, "t string, d decimal(38,2), i int").repartition(5)
    for order, key in ((["t", "i"], lambda r: (r[0].encode(), r[2])), (["d"], lambda r: r[1]), (["d", "t"], lambda r: r[1])):
        wanted = sorted((tuple(r) for r in df.collect()), key=key)[350:]
        for size in (8, 100):
            assert unordered(lower_half(df, order, size)) == sorted(wanted, key=repr)


def test_half_with_a_third_of_the_rows_in_one_value(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("k"), "id").repartition(6)
    want = sorted((tuple(r) for r in df.collect()))[4500:]
    assert sorted(tuple(r) for r in lower_half(df, ["k", "id"], 40).collect()) == want
    # The equal rows are no obstacle unless the cut is among them.
    assert row_at(df.select("k"), 4500, None, 40) == ((want[0][0],), 1)
    assert row_at(df.select("k"), 1000, None, 40) == ((77,), 3001)
    with pytest.raises(ValueError, match="identify"):
        lower_half(df.select(F.col("k") % 2), ["(k % 2)"], 40)


@pytest.mark.parametrize("size", [16, 300])
def test_ranks_of_a_summary_are_within_its_slack(spark, size):
    draw = random.Random(size)
    values = [draw.choice([draw.randrange(50), draw.randrange(10**9)]) for _ in range(20_000)]
    found = summary(spark.createDataFrame([(v,) for v in values], "v bigint").repartition(9), size)
    assert found.count == len(values) and 0 < found.slack < len(values)
    assert len(found.rows) <= 4 * size and found.rows == sorted(found.rows)
    values.sort()
    seen = 0
    for (value,), weight in zip(found.rows, found.weights):
        assert bisect.bisect_left(values, value) - found.slack <= seen + weight
        seen += weight
        assert seen <= bisect.bisect_right(values, value) + found.slack
    for position in range(0, len(values), 777):
        low, high = found.bracket(position)
        assert (low is None or low[0] <= values[position]) and (high is None or values[position] <= high[0])


def test_half_scans_the_table_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(60_000).select((F.col("id") * F.col("id") * F.col("id")).alias("k")).repartition(4).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def watched(batches):
        reads.add(1)
        yield from batches

    # Every scan starts a task for each of the partitions.
    table = spark.read.parquet(path).coalesce(1)
    counted = table.mapInArrow(watched, table.schema)
    half = lower_half(counted, ["k"], 64)
    assert reads.value == 2
    assert half.count() == 30_000


def test_a_mapper_yields_none_or_many_rows(spark):
    def digits(key, text):
        for part in text.split():
            yield key, int(part)

    df = spark.createDataFrame([(1, "1 2 3"), (2, ""), (3, "4 x 5"), (4, None), (1, "7")], "k int, t string")
    with pytest.raises(Exception, match="AttributeError"):
        map_rows(df, digits, "k int, n long", skip=(ValueError,)).collect()
    made = map_rows(df, digits, "k int, n long", skip=(ValueError, AttributeError))
    assert unordered(made) == [(1, 1), (1, 2), (1, 3), (1, 7), (3, 4)]
    sums = map_reduce(df, digits, "k int, n long", ["k"], F.sum("n").alias("n"), F.count("n").alias("c"), skip=(ValueError, AttributeError))
    assert unordered(sums) == [(1, 13, 4), (3, 4, 1)]
    assert map_rows(df.limit(0), digits, "k int, n long").count() == 0
    # Steps are chained, and a row may make more than a batch holds.
    many = map_rows(sums, lambda k, n, c: ((k, i) for i in range(30_000)), "k int, i long").groupBy("k").count()
    assert unordered(many) == [(1, 30_000), (3, 30_000)]
    # The sums are partial before the shuffle.
    text = plan(sums)
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning(k")
