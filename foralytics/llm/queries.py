"""The queries of the training-data operators and, where SQL can tell them, their DuckDB statements."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foralytics.llm import decontamination, html_wrappers, jaccard_join, language_id, merkle_manifest, mixing, periodic_runs, quality_classifier, scoring, sharding, spot_signatures, substrings, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        token_files.op1_token_files,
        jaccard_join.op2_jaccard_join,
        sharding.op3_sharding,
        substrings.op4_substrings,
        spot_signatures.op5_fingerprints,
        decontamination.op6_decontamination,
        scoring.op7_scoring,
        mixing.op8_mixing,
        html_wrappers.op9_html_extraction,
        language_id.op10_language_id,
        merkle_manifest.op11_merkle_manifest,
        quality_classifier.op12_quality,
        periodic_runs.op13_periodic_runs,
    )
}



def _tagged(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _crc32(text: str) -> str:
    """Of an ASCII text, bit by bit; NULL for NULL."""
    return f"""xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""


# Every word of every text, counted from 0, with the number of words of its row.
_WORDS = """
        WITH RECURSIVE docs AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+'), []) AS w
            FROM documents
        ), words AS (
            SELECT row, doc_id, unnest(range(len(w))) AS i, unnest(w) AS word, len(w) AS n FROM docs
        )"""

ORACLE: dict[str, str] = {
    "op2_jaccard_join": _WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """
        , runs AS (
            SELECT row, i, n, word || coalesce(' ' || lead(word, 1) OVER w, '') || coalesce(' ' || lead(word, 2) OVER w, '') AS shingle
            FROM words WINDOW w AS (PARTITION BY row ORDER BY i)
        ), shingles AS (
            SELECT DISTINCT row, shingle FROM runs WHERE i + 3 <= n OR (n < 3 AND i = 0)
        ), sizes AS (
            SELECT row, count(*) AS size FROM shingles GROUP BY row
        ), common AS (
            SELECT a.row AS a, b.row AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row < b.row
            GROUP BY a.row, b.row
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b
            WHERE 100 * common >= 90 * (x.size + y.size - common)
        ), both_ways AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT row AS a, row AS b FROM docs
            UNION
            SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b
        )
        SELECT d.doc_id, coalesce(any_value(s.size), 0) AS n_shingles, min(e.doc_id) AS component_id
        FROM docs d JOIN reached r ON r.a = d.row JOIN docs e ON e.row = r.b LEFT JOIN sizes s ON s.row = d.row
        GROUP BY d.row, d.doc_id
    """,
    "op4_substrings": _WORDS.format(text="text") + """
        , windows AS (
            SELECT row, doc_id, i, md5(array_to_string(w[i + 1 : i + 50], ' ')) AS key
            FROM (SELECT row, doc_id, w, unnest(range(len(w) - 49)) AS i FROM docs WHERE len(w) >= 50)
        ), least AS (
            SELECT key, min(doc_id) AS doc_id FROM windows GROUP BY key
        ), covered AS (
            SELECT w.row, w.i FROM windows w JOIN least l ON l.key = w.key WHERE l.doc_id < w.doc_id
        ), marked AS (
            SELECT x.row, x.i, x.word, coalesce(x.i - max(c.i) OVER (PARTITION BY x.row ORDER BY x.i) < 50, false) AS removed
            FROM words x LEFT JOIN covered c ON c.row = x.row AND c.i = x.i
        ), kept AS (
            SELECT row, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
            FROM marked GROUP BY row
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (row)
    """,
    "op8_mixing": f"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
            FROM sized GROUP BY source
        ), steps AS (
            SELECT *, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
                   coalesce(sum(source_size) OVER cut, 0) AS cut_size,
                   coalesce(sum(weight) OVER cut, 0) AS cut_weight
            FROM sources
            WINDOW cut AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), levels AS (
            SELECT *, (3 * all_size - 4 * cut_size)::DOUBLE / (2 * (all_weight - cut_weight)) AS level FROM steps
        ), targets AS (
            SELECT source, source_size, least(2 * source_size::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target
            FROM levels
        ), drawn AS (
            SELECT s.*, t.source_size, t.target,
                   floor(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END * {mixing.UNITS})::HUGEINT AS units,
                   (('0x' || substr(md5('offset ' || coalesce(s.source, 'null')), 1, 8))::BIGINT % {mixing.UNITS}) AS u,
                   length(bin(size)) AS bits, rpad(substr(bin(size), 1, 5), 5, '0') AS lead,
                   ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % {mixing.SALTS} AS salt
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), run AS (
            SELECT *, u + sum(units) OVER (PARTITION BY source ORDER BY bits, lead, salt, size, doc_id
                                           ROWS UNBOUNDED PRECEDING) AS upto
            FROM drawn
        )
        SELECT doc_id, size, source_size, target,
               ((upto // {mixing.UNITS} - (upto - units) // {mixing.UNITS}) * size)::BIGINT AS taken,
               source, (upto // {mixing.UNITS} - (upto - units) // {mixing.UNITS})::BIGINT AS copies
        FROM run
    """,
    "op11_merkle_manifest": f"""
        WITH RECURSIVE heads AS (
            SELECT doc_id, text, coalesce('=' || source, '') AS tree, {' || '.join(_tagged(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} AS head,
                   doc_id IS NULL OR {_crc32('doc_id::VARCHAR')} % 2 = 0 AS cut
            FROM documents
        ), leaves AS (
            SELECT doc_id, tree, sha256(head || {_tagged('text')}) AS leaf,
                   CASE WHEN cut THEN sha256(head || {_tagged("replace(text, chr(10), '')")}) ELSE sha256(head || {_tagged('text')}) END AS changed
            FROM heads
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot,
                   count(*) OVER (PARTITION BY tree) AS n
            FROM leaves
        ), nodes AS (
            SELECT tree, 0 AS level, slot, leaf AS digest, n FROM numbered
            UNION ALL
            SELECT tree, level + 1, slot // 3, sha256(string_agg(digest, '' ORDER BY slot)), any_value((n + 2) // 3)
            FROM nodes WHERE n > 1 GROUP BY tree, level, slot // 3
        ), subroots AS (
            SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS slot, count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), tops AS (
            SELECT 0 AS level, slot, subroot AS digest, n FROM subroots
            UNION ALL
            SELECT level + 1, slot // 3, sha256(string_agg(digest, '' ORDER BY slot)), any_value((n + 2) // 3)
            FROM tops WHERE n > 1 GROUP BY level, slot // 3
        ), steps AS (
            SELECT l.tree, l.slot, t.level,
                   coalesce(string_agg(t.digest, '' ORDER BY t.slot) FILTER (t.slot < l.slot // pow(3, t.level)::BIGINT), '')
                   || '|' || coalesce(string_agg(t.digest, '' ORDER BY t.slot) FILTER (t.slot > l.slot // pow(3, t.level)::BIGINT), '') AS step
            FROM numbered l JOIN nodes t ON t.tree = l.tree AND t.n > 1 AND t.slot // 3 = l.slot // pow(3, t.level + 1)::BIGINT
            GROUP BY l.tree, l.slot, t.level
        ), ways AS (
            SELECT tree, slot, list(step ORDER BY level) AS way FROM steps GROUP BY tree, slot
        ), top_steps AS (
            SELECT s.tree, t.level,
                   coalesce(string_agg(t.digest, '' ORDER BY t.slot) FILTER (t.slot < s.slot // pow(3, t.level)::BIGINT), '')
                   || '|' || coalesce(string_agg(t.digest, '' ORDER BY t.slot) FILTER (t.slot > s.slot // pow(3, t.level)::BIGINT), '') AS step
            FROM subroots s JOIN tops t ON t.n > 1 AND t.slot // 3 = s.slot // pow(3, t.level + 1)::BIGINT
            GROUP BY s.tree, t.level
        ), top_ways AS (
            SELECT tree, list(step ORDER BY level) AS way FROM top_steps GROUP BY tree
        ), whole AS (
            SELECT l.*, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
                   list_concat(coalesce(w.way, []::VARCHAR[]), coalesce(u.way, []::VARCHAR[])) AS way
            FROM numbered l JOIN subroots s ON s.tree = l.tree
            LEFT JOIN ways w ON w.tree = l.tree AND w.slot = l.slot LEFT JOIN top_ways u ON u.tree = l.tree
        ), folded AS (
            SELECT doc_id, leaf, subroot, root, sha256(replace(list_aggregate(list_prepend('', way), 'string_agg', ''), '|', '')) AS proof_sha256,
                   list_reduce(list_prepend(changed, way), lambda digest, step: sha256(split_part(step, '|', 1) || digest || split_part(step, '|', 2))) AS folded_root
            FROM whole
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
    """,
    "op13_periodic_runs": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce({_crc32('doc_id::VARCHAR')}, 0) AS h,
                   coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w
            FROM documents
        ), marked AS (
            SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM docs
        ), edited AS (
            SELECT row, doc_id, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1])
                ELSE w END AS w
            FROM marked
        ), words AS (
            SELECT row, unnest(range(len(w))) AS i, unnest(w) AS word, len(w) AS n FROM edited
        ), same AS (
            SELECT x.row, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
        ), islands AS (
            SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM same
        ), stretches AS (
            SELECT row, min(i) AS start, count(*) + q AS length, q AS period FROM islands
            GROUP BY row, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS (
            SELECT * FROM stretches s WHERE NOT EXISTS (
                SELECT 1 FROM stretches r WHERE r.row = s.row AND r.period < s.period
                AND r.start <= s.start AND r.start + r.length >= s.start + s.length)
        ), told AS (
            SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
                   first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS best
            FROM runs GROUP BY row
        ), kept AS (
            SELECT row, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words w WHERE NOT EXISTS (
                SELECT 1 FROM runs r WHERE r.row = w.row AND w.i >= r.start + r.period AND w.i < r.start + r.length)
            GROUP BY row
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
               1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM edited LEFT JOIN told USING (row) LEFT JOIN kept USING (row)
    """,
}
