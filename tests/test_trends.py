from foralytics.plans import trends as t
from helpers import answer, posts, question, rows, unordered


def monthly(tag, months, start=0):
    """One question per unit of activity of each month of 2010 and later."""
    out, id = [], 1000 * (start + 1)
    for i, n in enumerate(months):
        created = f"{2010 + i // 12}-{i % 12 + 1:02d}-15"
        for _ in range(n):
            out.append(question(id, created=created, tags=f"<{tag}>"))
            id += 1
    return out


def test_activity_weights_and_months(spark):
    table = posts(
        spark,
        question(1, created="2010-01-31", tags="<a><b>"),
        question(2, created="2010-02-01", tags="<a>"),
        question(3, created="2010-02-01"),
        answer(1, created="2010-01-31"), answer(1, created="2010-02-28"), answer(1, created="2010-02-01"),
        answer(3, created="2010-02-01"), answer(77, created="2010-02-01"), answer(2, created=None),
    )
    assert unordered(t.tag_activity(table)) == [
        ("a", "2010-01", 1.5), ("a", "2010-02", 2.0), ("b", "2010-01", 1.5), ("b", "2010-02", 1.0),
    ]
    assert unordered(t.tag_delta(table)) == [("a", "2010-02", 0.5), ("b", "2010-02", -0.5)]
    assert unordered(t.tag_activity(table, as_of="2010-01")) == [("a", "2010-01", 1.5), ("b", "2010-01", 1.5)]


def test_trend_of_one_month_and_of_constant_activity(spark):
    table = posts(spark, *monthly("once", [3], 0), *monthly("flat", [2, 2, 2, 2], 1))
    assert rows(t.tag_trend(table)) == [("flat", "ESTABLE", 0.0, 3)]


def test_only_the_last_six_deltas_count(spark):
    table = posts(spark, *monthly("x", [9, 1, 1, 1, 1, 2, 3, 4, 5, 6], 0))
    assert rows(t.tag_trend(table)) == [("x", "CRECIMIENTO", 0.8, 6)]
    assert rows(t.tag_trend(table, periods=20)) == [("x", "DECLIVE", -0.3, 9)]


def test_small_negative_mean_declines_but_prints_zero(spark):
    months = [2] * 13
    table = posts(spark, *monthly("x", months, 0), answer(1000, created="2010-01-15"))
    assert rows(t.trend_lines(t.tag_trend(table, periods=13))) == [("x\tDECLIVE\t0.0\t12",)]


def test_lines(spark):
    table = posts(spark, *monthly("b", [1, 3], 0), *monthly("a", [5, 1], 1))
    assert rows(t.trend_lines(t.tag_trend(table))) == [("a\tDECLIVE\t-4.0\t1",), ("b\tCRECIMIENTO\t2.0\t1",)]
