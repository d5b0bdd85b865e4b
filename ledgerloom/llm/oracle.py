"""SQL for DuckDB that gives the rows of the queries in ``queries.py``, where SQL can."""

from __future__ import annotations

from ledgerloom.llm.columns import WORD

MIX = f"""
WITH sized AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN 'b' ELSE 'a' || source END AS source_key,
        coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, text, '')) AS scatter
    FROM documents
), sources AS (
    SELECT source_key, sum(size)::BIGINT AS source_size FROM sized GROUP BY source_key
), weighted AS (
    SELECT *, row_number() OVER (ORDER BY source_key) AS rank,
        [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source_key) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
        2.0::DOUBLE * source_size AS max_target
    FROM sources
), filled AS (
    SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(max_target) OVER (ORDER BY max_target / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY max_target / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_rest
    FROM weighted
), opened AS (
    SELECT first(rest ORDER BY max_target / weight, rank) AS rest, first(weight_rest ORDER BY max_target / weight, rank) AS weight_rest
    FROM filled WHERE NOT max_target * weight_rest <= rest * weight
), targets AS (
    SELECT f.source_key, f.source_size,
        CASE WHEN f.max_target * f.weight_rest <= f.rest * f.weight THEN f.max_target ELSE f.weight * o.rest / o.weight_rest END AS target,
        ('0x' || substr(md5('mix:' || f.source_key), 1, 5))::INT / 1048576.0::DOUBLE AS start
    FROM filled f LEFT JOIN opened o ON true
), placed AS (
    SELECT s.*, t.source_size, t.target, t.start, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        row_number() OVER (PARTITION BY s.source_key ORDER BY s.size, s.scatter, s.doc_id) - 1 AS place
    FROM sized s JOIN targets t USING (source_key)
)
SELECT doc_id, size, source_size, target,
    (least(floor(start + rate * (place + 1)) - floor(start + rate * place), 2) * size)::BIGINT AS taken
FROM placed
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

SUBSTRING_DEDUP = f"""
WITH split AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents
), runs AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM split
), hashed AS (
    SELECT doc_id, start, md5(array_to_string(words[start:start + 19], ' ')) AS run FROM runs
), ranked AS (
    SELECT doc_id, start, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) AS occurrence FROM hashed
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM ranked WHERE occurrence > 1
), lists AS (
    SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
), kept AS (
    SELECT s.doc_id, s.words,
        [s.words[i] FOR i IN range(1, len(s.words) + 1) IF NOT list_contains(coalesce(l.places, []), i)] AS kept
    FROM split s LEFT JOIN lists l USING (doc_id)
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - len(kept))::BIGINT AS n_removed,
    sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM kept
"""

NGRAM_JOIN = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[start:start + 2], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, least(len(words), 1) + 1))) AS start FROM split)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT o.one, o.two FROM shared o JOIN sizes a ON a.doc_id = o.one JOIN sizes b ON b.doc_id = o.two
    WHERE 100 * o.n >= 90 * (a.n + b.n - o.n)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.two FROM reached r JOIN links l ON l.one = r.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, coalesce(l.n, 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
LEFT JOIN (SELECT one AS doc_id, count(*) AS n FROM links GROUP BY one) l USING (doc_id)
"""

QUALITY_RULES = f"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '{WORD}')) AS lines
    FROM documents
), runs AS (
    SELECT r, words, unnest(range(1, len(words) - 3)) AS start FROM split
), counted AS (
    SELECT r, start, count(*) OVER (PARTITION BY r, words[start], words[start + 1], words[start + 2], words[start + 3], words[start + 4]) AS n FROM runs
), repeated AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(start, start + 5)) AS place FROM counted WHERE n > 1) GROUP BY r
), measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: len(w))), 0)::BIGINT AS word_chars,
        len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals, len(lines) AS n_lines,
        len(list_filter(words, lambda w: NOT regexp_matches(w, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_letterless
    FROM split LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 100 * n_symbols > 5 * word_chars OR 100 * n_capitals > 30 * word_chars OR 100 * n_dup_lines > 50 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * n_letterless > 40 * n_words) AS kept
FROM judged
"""

CHAT_FORMAT = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), measured AS (
    SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS text_chars,
        length(role) + length(regexp_replace(role, '[^\\#<:\n]', '', 'g')) AS role_chars
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('### ' || ':' || chr(10)) + role_chars + text_chars + length('</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
"""


def _jump(shards: int) -> str:
    """Jump consistent hashing as a fold over as many steps as there are shards; the generator is exact in 128 bits."""
    return f"""list_reduce(
        list_transform(range({shards + 1}), lambda i: {{'bucket': -1::BIGINT, 'next': 0::BIGINT, 'state': key}}),
        lambda s, i: CASE WHEN s.next >= {shards} THEN s ELSE {{
            'bucket': s.next,
            'next': floor((s.next + 1) * (2147483648.0::DOUBLE
                / (((s.state * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1)::DOUBLE))::BIGINT,
            'state': (s.state * 2862933555777941757 + 1) % 18446744073709551616}} END).bucket::INT"""


SHARD = f"""
WITH steps AS (
    SELECT list(list_reduce(
        list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS step
    FROM range(256) t(b)
), keyed AS (
    SELECT doc_id, coalesce(text, '') AS text, ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616)::HUGEINT AS key
    FROM documents
), summed AS (
    SELECT *, hex(encode(text)) AS digits FROM keyed
), hashed AS (
    SELECT doc_id, text, (strlen(text) + 16)::BIGINT AS size, {_jump(40)} AS shard, {_jump(41)} AS grown_shard,
        xor(list_reduce(
            list_prepend(4294967295, list_transform(range(strlen(text)), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(c // 256, step[xor(c % 256, b) + 1])), 4294967295)::BIGINT AS text_crc32
    FROM summed, steps
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(coalesce(doc_id::VARCHAR, text)), doc_id, text_crc32) - 1 AS slot, grown_shard
FROM hashed
"""

ORACLE_SQL = {
    "op1_mix_sources": MIX,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op4_exact_dedup": EXACT_DEDUP,
    "op5_chat_format": CHAT_FORMAT,
    "op7_shard": SHARD,
    "op8_ngram_join": NGRAM_JOIN,
    "op12_quality_rules": QUALITY_RULES,
}
