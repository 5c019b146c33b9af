"""DuckDB statements with the results the queries must have."""

from foralytics.queries import AS_OF, TABLES, WANTED_TAGS

# The forum tables as common table expressions over the star schema.
FORUM = """
WITH questions AS (
  SELECT o_orderkey AS id, o_custkey AS owner, o_orderdate AS created FROM orders
), answers AS (
  SELECT l_orderkey AS parent, CAST(trunc(l_quantity) AS BIGINT) AS score, l_shipdate AS created
  FROM lineitem WHERE l_returnflag = 'N'
), comments AS (
  SELECT l_orderkey AS post FROM lineitem WHERE l_returnflag = 'R'
), bridge AS (
  SELECT DISTINCT l_orderkey AS id, p_brand AS tag
  FROM lineitem JOIN part ON l_partkey = p_partkey
), tag_strings AS (
  SELECT id, string_agg('<' || tag || '>', '' ORDER BY tag) AS tags FROM bridge GROUP BY id
), counts AS (
  SELECT parent AS id, count(*) AS n, CAST(sum(score) AS BIGINT) AS score FROM answers GROUP BY parent
)"""

WORDS = r"""
WITH runs AS (
  SELECT unnest(regexp_extract_all(text, '[\p{L}\p{Nd}_]+')) AS run FROM documents
), counted AS (
  SELECT lower(run) AS word, count(*) AS n FROM runs
  WHERE regexp_full_match(run, '[a-zA-Z\x{00C0}-\x{FFFF}]+') GROUP BY lower(run)
)"""

ACTIVITY = FORUM + """, events AS (
  SELECT b.tag, date_trunc('month', q.created) AS month, 2 AS half
  FROM questions q JOIN bridge b ON q.id = b.id
  UNION ALL
  SELECT b.tag, date_trunc('month', a.created), 1 FROM answers a
  JOIN questions q ON a.parent = q.id JOIN bridge b ON b.id = a.parent
), activity AS (
  SELECT tag, month, CAST(sum(half) AS BIGINT) AS half FROM events WHERE {until} GROUP BY tag, month
), deltas AS (
  SELECT tag, month, half - lag(half) OVER (PARTITION BY tag ORDER BY month) AS half FROM activity
), recent AS (
  SELECT tag, month, half, row_number() OVER (PARTITION BY tag ORDER BY month DESC) AS place
  FROM deltas WHERE half IS NOT NULL
), means AS (
  SELECT tag, CAST(sum(half) AS BIGINT) / (2.0::DOUBLE * count(*)) AS mean, count(*) AS months
  FROM recent WHERE place <= 6 GROUP BY tag
)"""
ACTIVITY_ALL = ACTIVITY.format(until="true")
ACTIVITY_AS_OF = ACTIVITY.format(until=f"month <= DATE '{AS_OF}-01'")
TREND = """CASE WHEN mean > 0 THEN 'CRECIMIENTO' WHEN mean < 0 THEN 'DECLIVE' ELSE 'ESTABLE' END"""

USER_STATS = FORUM + """, stats AS (
  SELECT q.owner, CAST(year(q.created) AS INTEGER) AS y, count(*) AS num, CAST(sum(c.n) AS BIGINT) AS answers,
    CAST(sum(coalesce(k.n, 0)) AS BIGINT) AS comments, max(c.n) AS most
  FROM questions q JOIN counts c ON q.id = c.id
  LEFT JOIN (SELECT post, count(*) AS n FROM comments GROUP BY post) k ON k.post = q.id
  GROUP BY q.owner, year(q.created)
)
SELECT c_name AS "Usuario", y AS "Año", num AS "NumPreguntas", answers AS "TotalRespuestas",
  comments AS "TotalComentarios", round(answers / CAST(num AS DOUBLE), 2) AS "MediaRespuestas",
  most AS "MaxRespuestas"
FROM stats JOIN customer ON owner = c_custkey"""

RANKED = FORUM + """
SELECT b.tag AS "Tag", CAST(year(q.created) AS INTEGER) AS "Año", q.id AS "QuestionId",
  c.n AS "NRespuestas", {rank} AS "Rango"
FROM bridge b JOIN questions q ON b.id = q.id JOIN counts c ON c.id = q.id
WHERE b.tag IN ({wanted})
WINDOW w AS (PARTITION BY b.tag, year(q.created) ORDER BY c.n DESC{ties})"""

USER_TAGS = FORUM + """, per_year AS (
  SELECT q.owner, b.tag, CAST(year(q.created) AS INTEGER) AS y, count(*) AS n
  FROM questions q JOIN bridge b ON q.id = b.id GROUP BY q.owner, b.tag, year(q.created)
), diffs AS (
  SELECT owner, tag, y, n, lag(n) OVER w AS before, lag(y) OVER w AS y_before FROM per_year
  WINDOW w AS (PARTITION BY owner, tag ORDER BY y)
)
SELECT c_name AS "Usuario", tag AS "Tag", y AS "Año", n AS "NPreguntas", {diff} AS "Dif"
FROM diffs JOIN customer ON owner = c_custkey {where}"""
LAG_DIFF = "CAST(coalesce(n - before, 0) AS BIGINT)"
CALENDAR_DIFF = """CAST(CASE WHEN y_before IS NULL THEN 0 WHEN y_before = y - 1 THEN n - before
  ELSE n END AS BIGINT)"""
ACTIVE = """WHERE owner IN (SELECT owner FROM questions GROUP BY owner HAVING count(*) >= 10)"""

COUNTS = FORUM + ' SELECT id AS "QuestionId", n AS "AnswerCount" FROM counts'
TOP = COUNTS + " ORDER BY n DESC, id LIMIT 20"
WORD_COUNT = WORDS + ' SELECT word, n AS "count" FROM counted'
OWNER = FORUM + """ SELECT id AS "QuestionId", c_acctbal AS "Reputation", c_name AS "DisplayName"
  FROM questions JOIN customer ON owner = c_custkey"""
PAIRS = FORUM + """ SELECT a.tag AS tag1, b.tag AS tag2, count(*) AS "count"
  FROM bridge a JOIN bridge b ON a.id = b.id AND a.tag < b.tag GROUP BY a.tag, b.tag"""

_ranked = dict(wanted=", ".join(f"'{t}'" for t in WANTED_TAGS.split(",")))

ORACLE: dict[str, str] = {
    "answers_score": FORUM + """ SELECT c.id AS "QuestionId", n AS "NRespuestas", score AS "ScoreTotal"
        FROM counts c WHERE c.id IN (SELECT id FROM questions)""",
    "answers_score_all": FORUM + """ SELECT q.id AS "QuestionId", coalesce(n, 0) AS "NRespuestas",
        CASE WHEN n IS NULL THEN 0 ELSE score END AS "ScoreTotal"
        FROM questions q LEFT JOIN counts c ON q.id = c.id""",
    "answered_questions": FORUM + """ SELECT id AS "Id", owner AS "OwnerUserId", created AS "CreationDate"
        FROM questions WHERE id IN (SELECT parent FROM answers)""",
    "question_year": FORUM + """ SELECT id AS "QuestionId", owner AS "UserId",
        CAST(year(created) AS INTEGER) AS "Año" FROM questions""",
    "answer_counts": COUNTS,
    "answer_counts_ordered": COUNTS + " ORDER BY n DESC, id",
    "answer_counts_topk": TOP,
    "answer_counts_topk_buckets": TOP,
    "answer_counts_mapper": COUNTS,
    "answer_count_lines": FORUM + " SELECT id || chr(9) || n AS value FROM counts",
    "answer_audit": FORUM + """, declared AS (
          SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY l_orderkey
        ) SELECT q.id AS "QuestionId", coalesce(d.n, 0) AS declared, c.n AS actual
        FROM questions q JOIN counts c ON c.id = q.id LEFT JOIN declared d ON d.id = q.id
        WHERE coalesce(d.n, 0) <> c.n""",
    "word_count": WORD_COUNT,
    "word_count_udf": WORD_COUNT,
    "word_count_files": WORD_COUNT,
    "word_count_by_key": WORDS + " SELECT word || chr(9) || n AS line FROM counted",
    "text_scan": """WITH lines AS (
          SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents
        ) SELECT lang, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
        FROM lines GROUP BY lang""",
    "question_owner": OWNER,
    "question_owner_tagged": OWNER,
    "question_owner_lines": FORUM + """ SELECT id || chr(9) || '(' || c_acctbal || ',' || c_name || ')' AS value
        FROM questions JOIN customer ON owner = c_custkey""",
    "question_tags": FORUM + ' SELECT q.id AS "Id", tag AS "TagName" FROM questions q JOIN bridge b ON q.id = b.id',
    "questions_by_year_tag": FORUM + """ SELECT CAST(year(created) AS INTEGER) AS year, tag, count(*) AS "count"
        FROM questions q JOIN bridge b ON q.id = b.id GROUP BY year(created), tag""",
    "tag_cooccurrence": PAIRS,
    "tag_cooccurrence_frequent": PAIRS + " HAVING count(*) >= 350",
    "year_tag_lines": FORUM + """ SELECT '(' || year(created) || ',' || tag || ')' || chr(9) || count(*) AS value
        FROM questions q JOIN bridge b ON q.id = b.id GROUP BY year(created), tag""",
    "tag_pair_lines": FORUM + """ SELECT a.tag || ',' || b.tag || chr(9) || count(*) AS value
        FROM bridge a JOIN bridge b ON a.id = b.id AND a.tag < b.tag GROUP BY a.tag, b.tag""",
    "tag_activity": ACTIVITY_ALL + """ SELECT tag, strftime(month, '%Y-%m') AS month,
        half / CAST(2 AS DOUBLE) AS activity FROM activity""",
    "tag_delta": ACTIVITY_ALL + """ SELECT tag, strftime(month, '%Y-%m') AS month,
        half / CAST(2 AS DOUBLE) AS delta FROM recent""",
    "tag_recent_deltas": ACTIVITY_ALL + """ SELECT tag, strftime(month, '%Y-%m') AS month,
        half / CAST(2 AS DOUBLE) AS delta FROM recent WHERE place <= 6""",
    "tag_trend": ACTIVITY_ALL + f""" SELECT tag, {TREND} AS trend, round(mean, 1) AS mean_delta, months
        FROM means""",
    "tag_trend_as_of": ACTIVITY_AS_OF + f""" SELECT tag, {TREND} AS trend, round(mean, 1) AS mean_delta, months
        FROM means""",
    "tag_trend_lines": ACTIVITY_ALL + f""" SELECT concat_ws(chr(9), tag, {TREND},
        printf('%.1f', round(mean, 1) + 0.0), months) AS value FROM means""",
    "comment_counts": FORUM + """ SELECT post AS "QuestionId", count(*) AS "NComentarios"
        FROM comments GROUP BY post""",
    "user_year_stats": USER_STATS,
    "user_year_stats_extracted": USER_STATS,
    "tag_year_rank": RANKED.format(rank="rank() OVER w", ties="", **_ranked),
    "tag_year_rank_dense": RANKED.format(rank="dense_rank() OVER w", ties="", **_ranked),
    "tag_year_rank_rows": RANKED.format(rank="row_number() OVER w", ties=", q.id", **_ranked),
    "user_tag_year_diff": USER_TAGS.format(diff=LAG_DIFF, where=""),
    "user_tag_year_diff_calendar": USER_TAGS.format(diff=CALENDAR_DIFF, where=""),
    "user_tag_year_diff_min10": USER_TAGS.format(diff=LAG_DIFF, where=ACTIVE),
    "ordered_half": """SELECT * FROM orders ORDER BY o_orderkey
        OFFSET (SELECT count(*) // 2 FROM orders)""",
    "ordered_half_tied": """SELECT * FROM orders ORDER BY o_custkey, o_orderkey
        OFFSET (SELECT count(*) // 2 FROM orders)""",
    "ordered_half_dates": """SELECT * FROM orders ORDER BY o_orderdate, o_orderkey
        OFFSET (SELECT count(*) // 2 FROM orders)""",
    "ordered_half_texts": """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
        ORDER BY o_orderpriority, CAST(o_totalprice AS DECIMAL(15, 2)), o_orderkey
        OFFSET (SELECT count(*) // 2 FROM orders)""",
    "posts_csv_bodies": FORUM + """ SELECT q.id AS "Id", 1 AS "PostTypeId", CAST(NULL AS BIGINT) AS "ParentId",
          CAST(NULL AS BIGINT) AS "Score", d.text AS "Body"
        FROM questions q LEFT JOIN documents d ON q.id = d.doc_id
        UNION ALL SELECT NULL, 2, parent, score, NULL FROM answers""",
    "answer_counts_bodies": COUNTS,
    "posts_csv": FORUM + """ SELECT q.id AS "Id", 1 AS "PostTypeId", CAST(NULL AS BIGINT) AS "ParentId",
          owner AS "OwnerUserId", created AS "CreationDate", CAST(NULL AS BIGINT) AS "Score", tags AS "Tags"
        FROM questions q LEFT JOIN tag_strings t ON q.id = t.id
        UNION ALL SELECT NULL, 2, parent, NULL, created, score, NULL FROM answers""",
    "users_csv": 'SELECT c_custkey AS "Id", c_name AS "DisplayName", c_acctbal AS "Reputation" FROM customer',
    "documents_csv": "SELECT * FROM documents",
    "extract_parquet": FORUM + """ SELECT q.id AS "QuestionId", owner AS "UserId",
        CAST(year(created) AS INTEGER) AS "Año", n AS "NRespuestas", score AS "ScoreTotal"
        FROM questions q JOIN counts c ON q.id = c.id""",
    "file_report": """SELECT true AS one_file_per_partition, true AS no_more_files,
        count(*) AS rows_in_files FROM orders""",
    "report_csv": USER_STATS,
    "report_csv_parts": USER_STATS,
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in TABLES
    ),
    "first_posts": FORUM + """ SELECT created AS "CreationDate", kind AS "PostTypeId", id AS "Id",
          parent AS "ParentId", score AS "Score" FROM (
            SELECT created, 1 AS kind, id, CAST(NULL AS BIGINT) AS parent, CAST(NULL AS BIGINT) AS score FROM questions
            UNION ALL SELECT created, 2, NULL, parent, score FROM answers)
        ORDER BY created, kind, id NULLS FIRST, parent NULLS FIRST, score NULLS FIRST LIMIT 10""",
    "post_sample": FORUM + f""", posts AS (
          SELECT id, 1 AS kind, CAST(NULL AS BIGINT) AS parent, owner, created, CAST(NULL AS BIGINT) AS score FROM questions
          UNION ALL SELECT NULL, 2, parent, NULL, created, score FROM answers
        ) SELECT id AS "Id", kind AS "PostTypeId", parent AS "ParentId", owner AS "OwnerUserId",
          created AS "CreationDate", score AS "Score" FROM posts
        WHERE CAST('0x' || substr(md5('42:' || strftime(created, '%Y-%m-%d %H:%M:%S') || ',' || coalesce(id::VARCHAR, '') || ','
          || coalesce(owner::VARCHAR, '') || ',' || coalesce(parent::VARCHAR, '') || ',' || kind || ','
          || coalesce(score::VARCHAR, '')), 1, 8) AS BIGINT) < {int(0.1 * 2**32)}""",
    "post_sample_by_question": FORUM + f""", both_kinds AS (
          SELECT id, 1 AS kind, CAST(NULL AS BIGINT) AS score FROM questions
          UNION ALL SELECT parent, 2, score FROM answers
        ) SELECT id AS "QuestionId", kind AS "PostTypeId", score AS "Score" FROM both_kinds
        WHERE CAST('0x' || substr(md5('42:' || id), 1, 8) AS BIGINT) < {int(0.1 * 2**32)}""",
    "orders_sample_by_block": f"""SELECT * FROM orders
        WHERE CAST('0x' || substr(md5('42:' || concat_ws(',', o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderkey,
          o_orderpriority, o_orderstatus, o_totalprice)), 1, 8) AS BIGINT) < {int(0.1 * 2**32)}""",
}
ORACLE["posts_csv_strict"] = ORACLE["posts_csv"]
