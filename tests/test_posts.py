from foralytics.plans import posts as p
from helpers import answer, plan, posts, question, rows, unordered


def forum(spark):
    return posts(
        spark,
        question(1), question(2), question(3),
        answer(1, 4), answer(1, None), answer(99, 7), answer(None, 7), answer(2, None),
    )


def test_answers_score_counts_only_existing_questions(spark):
    assert unordered(p.answers_score(forum(spark))) == [(1, 2, 4), (2, 1, None)]


def test_answers_score_with_unanswered(spark):
    got = unordered(p.answers_score(forum(spark), include_unanswered=True))
    assert got == [(1, 2, 4), (2, 1, None), (3, 0, 0)]


def test_answer_counts_keep_orphans_and_drop_null_parents(spark):
    assert unordered(p.answer_counts(forum(spark))) == [(1, 2), (2, 1), (99, 1)]


def test_answered_questions(spark):
    assert sorted(r.Id for r in p.answered_questions(forum(spark)).collect()) == [1, 2]


def test_answers_score_is_one_shuffle(spark):
    text = plan(p.answers_score(forum(spark)))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_ordered_counts_and_ties(spark):
    table = posts(spark, *[answer(q) for q in (5, 5, 3, 3, 9, 9, 9, 1)])
    full = [(9, 3), (3, 2), (5, 2), (1, 1)]
    assert rows(p.answer_counts_ordered(table)) == full
    for k in (1, 2, 3, 10):
        assert rows(p.answer_counts_topk(table, k)) == full[:k]
        for buckets in (1, 3, 100):
            assert rows(p.answer_counts_topk_buckets(table, k, buckets)) == full[:k]


def test_question_year_keeps_ownerless_questions(spark):
    table = posts(spark, question(1, None, "2010-01-01"), question(2, 7, "2011-12-31T23:59:59"), answer(1))
    df = p.question_year(table)
    assert df.columns == ["QuestionId", "UserId", "Año"]
    assert unordered(df) == [(1, None, 2010), (2, 7, 2011)]


def test_audit(spark):
    table = posts(
        spark,
        question(1, declared=3), question(2, declared=None), question(3, declared=0), question(4, declared=1),
        answer(1), answer(1), answer(2), answer(4),
    )
    assert unordered(p.answer_audit(table)) == [(1, 3, 2), (2, 0, 1)]


def test_top_k_plan_has_no_full_sort(spark):
    top = plan(p.answer_counts_topk(forum(spark), 2))
    assert "TakeOrderedAndProject" in top
    assert "rangepartitioning" not in top
    lists = plan(p.answer_counts_topk_buckets(forum(spark), 2, 10))
    assert "WindowGroupLimit" in lists


def test_total_order_is_a_range_sort(spark):
    text = plan(p.answer_counts_ordered(forum(spark)))
    assert "rangepartitioning" in text
    assert "SinglePartition" not in text
