"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

_TERMS = r"""regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

RANKED_SEARCH = f"""
WITH d AS (
    SELECT doc_id, {_TERMS} AS words
    FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_words FROM d WHERE len(words) > 0),
q AS (
    SELECT item_id, unnest({_TERMS}) AS term
    FROM benchmark),
held AS (
    SELECT doc_id, 25 + (75 * len(words) * n_docs) // n_words AS m, term, count(*) AS tf
    FROM (SELECT doc_id, words, unnest(words) AS term FROM d), totals
    WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln(
        (2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
    FROM held, totals GROUP BY term),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN held USING (term) JOIN weights USING (term) GROUP BY ALL HAVING score > 0)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
FROM scores WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 10"""

SUBSTRING_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
each_word AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d),
seqs AS (
    SELECT doc_id, place, string_agg(word, ' ') OVER twenty AS seq, count(*) OVER twenty AS n
    FROM each_word WINDOW twenty AS (
        PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
w AS (
    SELECT doc_id, place AS s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, place) AS nth
    FROM seqs WHERE n = 20),
gone AS (
    SELECT DISTINCT doc_id, s + k.k AS place FROM w, unnest(range(20)) AS k(k) WHERE nth > 1),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM each_word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256, coalesce(text, '') AS text
FROM d LEFT JOIN kept USING (doc_id)"""

PREFIX_TRIE = r"""
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         ORDER BY turn NULLS FIRST, sha256(concat(
                             strlen(coalesce(role, '')), ':', role, text))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
counted AS (
    SELECT conv_id, turns, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''),
                                                         lambda b: ascii(b)::BIGINT)),
        lambda c, b: list_reduce(
            list_concat([xor(c, b)], list_transform(range(8), lambda k: 0::BIGINT)),
            lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS c
    FROM own),
rebuilt AS (
    SELECT o.conv_id AS member, list_concat(
        coalesce(l.turns, [])[1 : xor(o.c, 4294967295) % 4],
        o.turns[xor(o.c, 4294967295) % 4 + 1 :]) AS turns
    FROM counted o LEFT JOIN own l ON l.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (
    SELECT member, len(turns) AS n, d.d AS depth, turns[1 : d.d] AS prefix
    FROM rebuilt, unnest(range(len(turns) + 1)) AS d(d)),
nodes AS (
    SELECT depth, prefix, min(member) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(member::VARCHAR, ',' ORDER BY member)
                           FILTER (n = depth), '')) AS ends_sha256,
           CASE WHEN depth = 0 THEN 0
                ELSE len(regexp_extract_all(prefix[-1]['text'], '[^\x20\x09-\x0D]+')) END AS words
    FROM prefixes GROUP BY depth, prefix),
up AS (
    SELECT depth - 1 AS depth, prefix[1 : depth - 1] AS prefix, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY ALL),
own_sums AS (
    SELECT n.*, coalesce(u.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN up u ON u.depth = n.depth AND u.prefix = n.prefix),
subtree AS (
    SELECT a.d AS depth, prefix[1 : a.d] AS prefix, sum((n_convs - 1) * words) AS saved_tokens,
           count(*) FILTER (n_children = 0) AS n_leaves
    FROM own_sums, unnest(range(depth + 1)) AS a(d) GROUP BY a.d, prefix[1 : a.d])
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM own_sums n JOIN subtree s ON s.depth = n.depth AND s.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1 : n.depth - 1]"""
