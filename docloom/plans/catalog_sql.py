"""SQL twins of the queries, in the dialect the tests run them with."""

from __future__ import annotations

_B = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NUMBER = r"\(?-?\$?[0-9][0-9,]*\.?[0-9]*\)?%?"
_CHUNKS = "c AS (SELECT DISTINCT filing_id, chunk_id, heading_path, part, item, text, order_index FROM chunks)"
_QA = "qa AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS n FROM generated_qa) WHERE n = 1)"
_TABLES = "t AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY loaded_at) AS n FROM extracted_tables) WHERE n = 1)"
_LATEST = "latest AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY qa_id ORDER BY verified_at DESC NULLS LAST, context_recall_score DESC NULLS LAST) AS n FROM verification_results) WHERE n = 1)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


def _n_words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '{_B}+'), lambda w: w <> ''))"


def _tokens(x: str) -> str:
    return f"CAST({_n_words(x)} * 13 // 10 AS INTEGER)"


def _value(t: str) -> str:
    bare = f"ltrim(replace(trim({t}, '()%$'), ',', ''), '-')"
    number = f"CASE WHEN regexp_matches({bare}, '^[0-9]+\\.?[0-9]*$') THEN TRY_CAST({bare} AS DOUBLE) END"
    return f"(CASE WHEN (starts_with({t}, '(') AND ends_with({t}, ')')) OR starts_with({t}, '-') THEN -({number}) ELSE {number} END)"


def _numbers(x: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all(coalesce({x}, ''), '{_NUMBER}'), lambda k: {_value('k')}), lambda v: v IS NOT NULL)"


def _claimed(x: str) -> str:
    return f"CASE WHEN contains({x}, '=') THEN coalesce(({_numbers(f"string_split({x}, '=')[-1]")})[1], ({_numbers(x)})[1]) ELSE ({_numbers(x)})[1] END"


def _number_set(x: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({x}, '-?[0-9][0-9,]*\\.?[0-9]*'), lambda k: replace(k, ',', '')))"


def _cell(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR lower({c}) = 'nan' THEN '' ELSE {c} END"


def _pipe(columns: str, rows: str) -> str:
    line = lambda r, k: f"array_to_string(list_transform({r}, lambda {k}: {_cell(k)}), ' | ')"
    return f"array_to_string(list_concat([{line(columns, 'h')}], list_transform({rows}, lambda r: {line('r', 'd')})), chr(10))"


def _draw(*parts: str) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13) AS BIGINT) / {float(16**13)!r})"


_LINES = f"""lines AS (
    SELECT doc_id, pos, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL)
    WHERE length({_strip('text')}) > 0)"""
_MARKED = f"{_LINES}, marked AS (SELECT doc_id, pos, text, CASE WHEN length(text) < 40 AND length(text) % 5 < 4 THEN length(text) % 5 END AS level, {_strip('text')} AS mark FROM lines)"
_UPTO = "ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_STATE = f"""{_MARKED}, s0 AS (
    SELECT *, last_value(CASE WHEN level = 0 THEN mark END IGNORE NULLS) OVER (PARTITION BY doc_id {_UPTO}) AS part, count(CASE WHEN level = 0 THEN 1 END) OVER (PARTITION BY doc_id {_UPTO}) AS k0, count(level) OVER (PARTITION BY doc_id {_UPTO}) AS section FROM marked
), s1 AS (
    SELECT *, last_value(CASE WHEN level = 1 THEN mark END IGNORE NULLS) OVER (PARTITION BY doc_id, k0 {_UPTO}) AS item, count(CASE WHEN level = 1 THEN 1 END) OVER (PARTITION BY doc_id, k0 {_UPTO}) AS k1 FROM s0
), s2 AS (
    SELECT *, last_value(CASE WHEN level = 2 THEN mark END IGNORE NULLS) OVER (PARTITION BY doc_id, k0, k1 {_UPTO}) AS h2, count(CASE WHEN level = 2 THEN 1 END) OVER (PARTITION BY doc_id, k0, k1 {_UPTO}) AS k2 FROM s1
), state AS (
    SELECT *, last_value(CASE WHEN level = 3 THEN mark END IGNORE NULLS) OVER (PARTITION BY doc_id, k0, k1, k2 {_UPTO}) AS h3 FROM s2
)"""
_PATH = "coalesce(nullif(concat_ws(' > ', part, item, h2, h3), ''), 'Untitled')"
_PAIRED = f"""{_CHUNKS}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY order_index, chunk_id) - 1 AS position, row_number() OVER (PARTITION BY filing_id, part, item ORDER BY order_index, chunk_id) - 1 AS rank, count(*) OVER (PARTITION BY filing_id, part, item) AS size FROM c
)"""
_SIMILAR = "vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id AND list_cosine_similarity(a.v, b.v) > 0.3)"
_GREEDY = f"""WITH RECURSIVE {_SIMILAR}, near AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS k, coalesce((SELECT list(a) FROM pairs WHERE b = vec_id), []) AS earlier FROM vectors
), greedy AS (
    SELECT 0::BIGINT AS k, []::BIGINT[] AS kept, NULL::BIGINT AS vec_id, NULL::BIGINT AS dup_of
    UNION ALL
    SELECT n.k, CASE WHEN list_has_any(g.kept, n.earlier) THEN g.kept ELSE list_append(g.kept, n.vec_id) END, n.vec_id, list_min(list_intersect(g.kept, n.earlier)) FROM greedy g JOIN near n ON n.k = g.k + 1
), decided AS (SELECT vec_id, dup_of IS NULL AS is_kept, dup_of FROM greedy WHERE vec_id IS NOT NULL)"""
_DIFFICULTY = "CASE WHEN coalesce(len(source_chunk_ids), 0) >= 2 OR question_type IN ('multi_step_reasoning', 'comparison') THEN 'hard' WHEN question_type = 'numeric_calculation' THEN 'medium' WHEN question_type = 'fact_extraction' THEN 'easy' ELSE 'medium' END"
_CLEAN = f"regexp_replace(regexp_replace({_strip('raw')}, '^```(?:json)?{_B}*', ''), '{_B}*```$', '')"
_BODY = "CAST(to_json({'question': question, 'answer': answer, 'source_passage': source_passage}) AS VARCHAR)"
_ASKED = "length(coalesce(question, ''))"
_BLANK_CELL = "x IS NULL OR x = '' OR lower(x) = 'nan'"

SQL = {
    "q_numeric_check": f"""
        WITH {_QA}, n AS (SELECT id, {_numbers('source_passage')} AS v, {_claimed('answer')} AS claimed FROM qa WHERE question_type = 'numeric_calculation'),
        e AS (SELECT id, claimed, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM n),
        r AS (
            SELECT a.id, a.i, b.i AS j, a.claimed, unnest(['difference', 'abs_difference', 'sum', 'percent_change', 'ratio', 'product']) AS rel, unnest([1, 2, 3, 4, 5, 6]) AS k,
                unnest([a.x - b.x, abs(a.x - b.x), a.x + b.x, CASE WHEN b.x <> 0 THEN (a.x - b.x) / abs(b.x) * 100 END, CASE WHEN b.x <> 0 THEN a.x / b.x END, a.x * b.x]) AS y
            FROM e a JOIN e b ON a.id = b.id AND a.i <> b.i
        ), hits AS (SELECT id, rel, row_number() OVER (PARTITION BY id ORDER BY i, j, k) AS first FROM r WHERE CASE WHEN y = 0 THEN abs(claimed - y) < 1e-6 ELSE abs(claimed - y) / abs(y) * 100 <= 1.0 END),
        found AS (
            SELECT n.id, n.claimed, len(n.v) AS n_numbers,
                CASE WHEN n.claimed IS NULL THEN NULL WHEN len(n.v) = 1 THEN CASE WHEN (CASE WHEN n.v[1] = 0 THEN abs(n.claimed) < 1e-6 ELSE abs(n.claimed - n.v[1]) / abs(n.v[1]) * 100 <= 1.0 END) THEN 'direct_match' END ELSE h.rel END AS relationship
            FROM n LEFT JOIN hits h ON h.id = n.id AND h.first = 1
        )
        SELECT id, relationship IS NOT NULL AS passed, round(claimed, 6) AS claimed, relationship, CAST(n_numbers AS INTEGER) AS n_numbers FROM found
    """,
    "q_numbers": f"WITH {_QA}, n AS (SELECT id, {_numbers('source_passage')} AS v FROM qa) SELECT id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, unnest(v) AS value FROM n",
    "q_claimed_value": f"WITH {_QA}, n AS (SELECT id, {_claimed('answer')} AS claimed FROM qa) SELECT * FROM n WHERE claimed IS NOT NULL",
    "q_tokens": f"WITH {_CHUNKS} SELECT chunk_id, {_tokens("coalesce(text, '')")} AS tokens FROM c",
    "q_heading_level": f"""
        WITH {_LINES}, x AS (SELECT *, {_strip('text')} AS plain FROM lines), y AS (SELECT *, {_n_words('text')} < 12 AND right(plain, 1) NOT IN ('.', '!', '?', ';', ',') AS short FROM x)
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(CASE WHEN regexp_matches(text, '(?i)^{_B}*PART{_B}+[IVXLC]+(?:[^\\p{{L}}\\p{{N}}_]|$)') THEN 0
            WHEN regexp_matches(text, '(?i)^{_B}*ITEM{_B}+\\p{{Nd}}+[A-Z]?(?:\\.|:|{_B}+-|[^\\p{{L}}\\p{{N}}_]|$)') THEN 1
            WHEN short AND length(text) < 60 AND regexp_matches(plain, '\\p{{L}}') AND NOT regexp_matches(plain, '[^\\P{{L}}\\p{{Lu}}]') THEN 2
            WHEN short AND length(text) < 60 THEN 3 END AS INTEGER) AS level FROM y
    """,
    "q_heading_path": f"WITH {_STATE} SELECT doc_id, CAST(pos AS INTEGER) AS pos, part, item, {_PATH} AS heading_path FROM state",
    "q_sections": f"""
        WITH {_STATE}, g AS (SELECT doc_id, section, first({_PATH}) AS heading_path, {_strip("string_agg(text, chr(10) ORDER BY pos)")} AS text FROM state WHERE level IS NULL GROUP BY doc_id, section)
        SELECT doc_id, CAST(section AS BIGINT) AS section, heading_path, text FROM g WHERE length(text) > 0
    """,
    "q_pack_paragraphs": f"""
        WITH RECURSIVE {_CHUNKS}, whole AS (SELECT chunk_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda p: {_strip('p')}), lambda p: length(p) > 0) AS ps, {_tokens('text')} > 600 AS long FROM c WHERE text IS NOT NULL),
        lines AS (SELECT chunk_id, unnest(ps) AS line, generate_subscripts(ps, 1) AS i FROM whole WHERE long AND len(ps) > 0), sized AS (SELECT *, {_tokens('line')} AS size FROM lines),
        packed AS (
            SELECT chunk_id, i, line, size AS held, 0 AS piece FROM sized WHERE i = 1
            UNION ALL
            SELECT s.chunk_id, s.i, s.line, CASE WHEN p.held + s.size > 500 THEN s.size ELSE p.held + s.size END, CASE WHEN p.held + s.size > 500 THEN p.piece + 1 ELSE p.piece END FROM packed p JOIN sized s ON s.chunk_id = p.chunk_id AND s.i = p.i + 1
        )
        SELECT chunk_id, CAST(piece AS INTEGER) AS piece, string_agg(line, chr(10) ORDER BY i) AS piece_text FROM packed GROUP BY chunk_id, piece
        UNION ALL SELECT chunk_id, 0, text FROM whole WHERE NOT (long AND len(ps) > 0)
    """,
    "q_merge_small": f"""
        WITH RECURSIVE {_CHUNKS}, o AS (SELECT *, {_tokens('text')} AS tokens, row_number() OVER (PARTITION BY filing_id ORDER BY order_index, chunk_id) AS k, count(*) OVER (PARTITION BY filing_id) AS n FROM c WHERE text IS NOT NULL),
        held AS (
            SELECT filing_id, k, n, chunk_id, heading_path, text, tokens, order_index FROM o WHERE k = 1
            UNION ALL
            SELECT o.filing_id, o.k, o.n, o.chunk_id, o.heading_path, CASE WHEN h.tokens < 30 THEN h.text || chr(10) || o.text ELSE o.text END, CASE WHEN h.tokens < 30 THEN {_tokens('(h.text || chr(10) || o.text)')} ELSE o.tokens END, CASE WHEN h.tokens < 30 THEN h.order_index ELSE o.order_index END
            FROM held h JOIN o ON o.filing_id = h.filing_id AND o.k = h.k + 1
        ), emitted AS (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY k DESC) AS back FROM held WHERE k < n AND tokens >= 30),
        tail AS (SELECT h.* FROM held h WHERE k = n), joined AS (
            SELECT e.filing_id, e.chunk_id, e.heading_path, CASE WHEN e.back = 1 AND t.tokens < 30 THEN e.text || chr(10) || t.text ELSE e.text END AS text, e.order_index FROM emitted e JOIN tail t USING (filing_id)
            UNION ALL SELECT filing_id, chunk_id, heading_path, text, order_index FROM tail t WHERE tokens >= 30 OR NOT EXISTS (SELECT 1 FROM emitted e WHERE e.filing_id = t.filing_id)
        )
        SELECT filing_id, chunk_id, heading_path, text, {_tokens('text')} AS token_estimate, order_index FROM joined
    """,
    "q_pipe_text": f"WITH {_TABLES} SELECT table_id, {_pipe('col_names', 'cell_rows')} AS passage FROM t",
    "q_drop_empty": f"""
        WITH {_TABLES}, k AS (SELECT table_id, col_names, list_filter(cell_rows, lambda r: len(list_filter(r, lambda x: NOT ({_BLANK_CELL}))) > 0) AS rows FROM t)
        SELECT table_id, CAST(len(list_filter(range(1, len(col_names) + 1), lambda i: len(list_filter(list_transform(rows, lambda r: r[i]), lambda x: NOT ({_BLANK_CELL}))) > 0)) AS INTEGER) AS n_cols, CAST(len(rows) AS INTEGER) AS n_rows FROM k
    """,
    "q_passages": f"""
        WITH {_CHUNKS}, {_TABLES}
        SELECT filing_id, chunk_id, {_tokens("coalesce(text, '')")} AS token_estimate, order_index FROM c
        UNION ALL SELECT filing_id, table_id, CAST({_n_words(_pipe('col_names', 'cell_rows'))} AS INTEGER), CAST(row_number() OVER (PARTITION BY filing_id ORDER BY order_index, table_id) - 1 + 1000000 AS INTEGER) FROM t
    """,
    "q_pairs": f"""
        WITH {_PAIRED}, wanting AS (
            SELECT *, CASE WHEN size > 1 AND {_draw("'42'", "'comparison'", "'pair'", 'CAST(filing_id AS VARCHAR)', 'chunk_id')} < 0.4 THEN CAST(floor({_draw("'42'", "'comparison'", "'partner'", 'CAST(filing_id AS VARCHAR)', 'chunk_id')} * (size - 1)) AS BIGINT) END AS pick FROM ranked
        ), chosen AS (
            SELECT a.filing_id, a.chunk_id, a.position, b.chunk_id AS partner FROM wanting a LEFT JOIN ranked b ON b.filing_id = a.filing_id AND b.part IS NOT DISTINCT FROM a.part AND b.item IS NOT DISTINCT FROM a.item AND b.rank = CASE WHEN a.pick >= a.rank THEN a.pick + 1 ELSE a.pick END
        )
        SELECT filing_id, chunk_id, CASE WHEN row_number() OVER (PARTITION BY filing_id, partner ORDER BY position) = 1 THEN partner END AS second_id, position FROM chosen
    """,
    "q_stride_sample": f"""
        WITH {_PAIRED}, n AS (SELECT filing_id, count(*) AS n FROM ranked GROUP BY filing_id),
        wanted AS (SELECT DISTINCT filing_id, CASE WHEN n <= 7 THEN k ELSE CAST(floor(k * (CAST(n AS DOUBLE) / 7)) AS BIGINT) END AS position FROM n, range(0, 7) AS r(k))
        SELECT filing_id, question_type, chunk_id, position FROM ranked JOIN wanted USING (filing_id, position), (VALUES ('fact_extraction'), ('numeric_calculation'), ('comparison'), ('multi_step_reasoning')) AS q(question_type)
    """,
    "q_truncate": f"""
        WITH {_CHUNKS}, h AS (SELECT chunk_id, text, substr(text, 1, 3000) AS head FROM c WHERE text IS NOT NULL), k AS (SELECT *, length(head) - instr(reverse(head), chr(10)) AS last FROM h)
        SELECT chunk_id, CASE WHEN length(text) <= 3000 THEN text ELSE substr(head, 1, CASE WHEN contains(head, chr(10)) AND last >= 1500 THEN last ELSE 3000 END) || chr(10) || '[... truncated for length ...]' END AS passage FROM k
    """,
    "q_json_recovery": f"""
        WITH {_QA}, replies AS (SELECT id, CASE WHEN (length(id) + {_ASKED}) % 4 = 0 THEN '```json' || chr(10) || '[' || {_BODY} || ']' || chr(10) || '```' WHEN {_ASKED} % 3 = 0 THEN 'Here you are: [' || {_BODY} || '] as asked.' ELSE {_BODY} END AS raw FROM qa),
        cleaned AS (SELECT id, {_CLEAN} AS clean FROM replies), texts AS (SELECT id, CASE WHEN json_valid(clean) THEN clean ELSE regexp_extract(clean, '(?s)\\[.*\\]') END AS j FROM cleaned),
        lists AS (SELECT id, unnest(json_extract(CASE WHEN starts_with(j, '[') THEN j ELSE '[' || j || ']' END, '$[*]')) AS o FROM texts WHERE json_valid(j))
        SELECT id, o ->> 'answer' AS answer FROM lists
    """,
    "q_number_overlap": f"""
        WITH {_CHUNKS}, {_TABLES}, {_QA}, source AS (SELECT chunk_id AS src, text FROM c UNION ALL SELECT table_id, {_pipe('col_names', 'cell_rows')} FROM t),
        k AS (SELECT id, {_number_set('source_passage')} AS p, {_number_set('text')} AS x FROM qa JOIN source ON src = source_chunk_ids[1])
        SELECT id, round(len(list_intersect(p, x)) / len(p), 6) AS overlap FROM k WHERE len(p) > 0 AND x IS NOT NULL
    """,
    "q_verbatim_exact": f"""
        WITH {_CHUNKS}, {_TABLES}, {_QA}, source AS (SELECT chunk_id AS src, text FROM c UNION ALL SELECT table_id, {_pipe('col_names', 'cell_rows')} FROM t)
        SELECT id, length({_strip('source_passage')}) > 0 AND contains(text, source_passage) AS is_exact
        FROM qa JOIN source ON src = source_chunk_ids[1] WHERE source_passage IS NOT NULL AND text IS NOT NULL
    """,
    "q_faithfulness": f"WITH {_LATEST} SELECT qa_id, coalesce(coalesce(numeric_check_pass, faithfulness_pass) AND context_recall_score >= 0.6, false) AS keep FROM latest",
    "q_cosine": """
        WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), f AS (SELECT label, arg_min(v, vec_id) AS f FROM v GROUP BY label)
        SELECT vec_id, round(list_cosine_similarity(v, f), 6) AS cosine FROM v JOIN f USING (label)
    """,
    "q_similar_pairs": f"WITH {_SIMILAR} SELECT a, b FROM pairs",
    "q_dedup_greedy": f"{_GREEDY} SELECT vec_id, is_kept, dup_of FROM decided",
    "q_drop_rate": f"{_GREEDY} SELECT count(*) AS n_rows, count(*) FILTER (NOT is_kept) AS n_dropped, round(100.0 * count(*) FILTER (NOT is_kept) / count(*), 6) AS drop_pct FROM decided",
    "q_difficulty": f"WITH {_QA} SELECT id, {_DIFFICULTY} AS difficulty FROM qa",
    "q_difficulty_distribution": f"WITH {_QA}, d AS (SELECT {_DIFFICULTY} AS difficulty FROM qa) SELECT l.difficulty, count(d.difficulty) AS n_rows FROM (VALUES ('easy'), ('medium'), ('hard')) AS l(difficulty) LEFT JOIN d USING (difficulty) GROUP BY l.difficulty",
    "q_output_rows": f"""
        WITH {_LATEST}, {_QA}
        SELECT id, question, answer, source_passage, coalesce(item, '') AS source_item, heading_path AS source_section, '' AS source_page, question_type, {_DIFFICULTY} AS difficulty, round(context_recall_score, 4) AS context_recall_score,
            faithfulness_pass, numeric_check_pass, round(verbatim_match_score, 4) AS verbatim_match_score, coalesce(verifier_confidence, '') AS verifier_confidence, verifier_reason, array_to_string(source_chunk_ids, ';') AS source_chunk_ids
        FROM qa JOIN latest ON qa_id = id WHERE keep
    """,
}
_JOINED = "CASE WHEN partner IS NULL THEN a.text ELSE a.text || chr(10) || '--- NEXT PASSAGE ---' || chr(10) || b.text END"
SQL |= {
    "q_pair_text": f"""
        WITH {_CHUNKS}, p AS ({SQL["q_pairs"]}), j AS (
            SELECT p.filing_id, p.chunk_id, {_JOINED.replace("partner", "p.second_id")} AS text FROM p JOIN c a ON a.chunk_id = p.chunk_id LEFT JOIN c b ON b.chunk_id = p.second_id
        ), h AS (SELECT *, substr(text, 1, 3000) AS head FROM j WHERE text IS NOT NULL), k AS (SELECT *, length(head) - instr(reverse(head), chr(10)) AS last FROM h)
        SELECT filing_id, chunk_id, CASE WHEN length(text) <= 3000 THEN text ELSE substr(head, 1, CASE WHEN contains(head, chr(10)) AND last >= 1500 THEN last ELSE 3000 END) || chr(10) || '[... truncated for length ...]' END AS passage FROM k
    """,
    "q_required_fields": f"""
        WITH {_QA} SELECT id, 0 AS number, {_strip('question')} AS question, {_strip('answer')} AS answer, {_strip('source_passage')} AS source_passage
        FROM qa WHERE length({_strip('question')}) > 0 AND length({_strip('answer')}) > 0 AND length({_strip('source_passage')}) > 0
    """,
    "q_verify_numeric": f"SELECT id, NULL::BOOLEAN AS faithfulness_pass, passed AS numeric_check_pass FROM ({SQL['q_numeric_check']})",
    "q_skip_verification": f"WITH {_QA} SELECT id, 1.0::DOUBLE AS context_recall_score, NULL::BOOLEAN AS faithfulness_pass, NULL::BOOLEAN AS numeric_check_pass, 'SKIPPED' AS verifier_reason, true AS keep FROM qa",
    "q_jsonl_round_trip": SQL["q_output_rows"],
    "q_stage_round_trip": f"WITH {_TABLES} SELECT filing_id AS doc_id, table_id, heading_path, part, item, order_index, n_rows, n_cols, raw_html FROM t",
    "q_page_blocks": f"""
        WITH {_CHUNKS}, b AS (SELECT filing_id AS doc_id, unnest([{{'t': part, 'b': true}}, {{'t': item, 'b': true}}, {{'t': text, 'b': false}}]) AS x FROM c),
        s AS (SELECT doc_id, {_strip("x['t']")} AS t, x['b'] AS b FROM b)
        SELECT doc_id, count(*) AS n, sum(length(t)) AS chars, count(*) FILTER (b) AS n_bold FROM s WHERE length(t) > 0 GROUP BY doc_id
    """,
}
