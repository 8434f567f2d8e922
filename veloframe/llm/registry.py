"""The queries of this subpackage by name, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from veloframe.llm import decontamination, jaccard, languages, licences, packing, pii, ring, substrings, token_files, vectors

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_packing": packing.op2_packing,
    "op3_sharding": ring.op3_sharding,
    "op4_substring_dedup": substrings.op4_substring_dedup,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_language_id": languages.op6_language_id,
    "op7_personal_data": pii.op7_personal_data,
    "op8_licence_scan": licences.op8_licence_scan,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_vector_neardup": vectors.op10_vector_neardup,
}

_PLAIN = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_GROUPS = """r AS (SELECT id, id AS root FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id), g AS (SELECT id, min(root) AS root FROM r GROUP BY 1)"""

#: Written for tables of some thousand documents, as the comparison uses them.
ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY 1),
x AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM s JOIN f USING (g) WHERE first < doc_id)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN x USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op5_decontamination": f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents), b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_PLAIN} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (g, n)),
hw AS (SELECT doc_id, count(*) AS c FROM (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h)) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS k, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c, 0)::BIGINT AS n_hit, coalesce(k, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(c, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op9_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWER} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id AS id, count(x) AS k FROM d LEFT JOIN s USING (doc_id) GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n u ON u.id = a JOIN n v ON v.id = b WHERE 100 * m >= 75 * (u.k + v.k - m)), {_GROUPS}
SELECT n.id AS doc_id, n.k::BIGINT AS n_shingles, g.root AS component_id, (SELECT count(*) FROM l WHERE l.a = n.id)::BIGINT AS n_links FROM n JOIN g ON g.id = n.id""",
    "op10_vector_neardup": f"""
WITH RECURSIVE n AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
f AS (SELECT * FROM n WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0),
l AS (SELECT a.id AS a, b.id AS b FROM f a JOIN f b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95), {_GROUPS}
SELECT n.id AS vec_id, (SELECT count(*) FROM l WHERE l.a = n.id)::BIGINT AS n_links, g.root::BIGINT AS component_id, g.root = n.id AS kept FROM n JOIN g ON g.id = n.id""",
}
