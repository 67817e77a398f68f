"""SQL for the queries whose result SQL can state. The others (similarity of normalised texts, iterated rankings, tokens, languages,
packing) are tested against brute force in tests/llm."""

from __future__ import annotations

_NORM = lambda c: f"lower(trim(regexp_replace({c}, '[ \\t]+', ' ', 'g'), ' '))"
_PRESENT = lambda c: f"CASE WHEN {_NORM(c)} NOT IN ('', 'nan') THEN {_NORM(c)} END"
_CURRENT = "SELECT * FROM {} WHERE sentence_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sentence_id ORDER BY updated_at DESC, loaded_at DESC) = 1"

_CUTOFFS = f"""WITH cur AS ({_CURRENT.format("final_translations")}),
v AS (SELECT sentence_id, {_PRESENT("domain")} AS d, semantic_similarity AS v FROM cur WHERE {_PRESENT("domain")} IS NOT NULL AND NOT isnan(semantic_similarity) AND semantic_similarity BETWEEN 0 AND 1),
n AS (SELECT d, count(*) AS n FROM v GROUP BY 1),
k AS (SELECT t.domain, t.keep_fraction, {_NORM("t.domain")} AS d, coalesce(n.n, 0) AS n, coalesce(ceil(t.keep_fraction * n.n), 0)::BIGINT AS wanted FROM keep_targets t LEFT JOIN n ON n.d = {_NORM("t.domain")}),
r AS (SELECT d, v, row_number() OVER (PARTITION BY d ORDER BY v DESC) AS rn FROM v),
c AS (SELECT k.*, r.v AS cutoff FROM k LEFT JOIN r ON r.d = k.d AND r.rn = greatest(k.wanted, 1))"""

ORACLES = {
    "p1_cutoffs": _CUTOFFS + " SELECT domain, keep_fraction, n, wanted, cutoff, (SELECT count(*) FROM v WHERE v.d = c.d AND v.v >= c.cutoff) AS n_kept FROM c",
    "p1_found": _CUTOFFS + " SELECT DISTINCT c.domain, v.sentence_id FROM c JOIN v ON v.d = c.d AND v.v >= c.cutoff",
    "p3_found": f"""WITH cur AS ({_CURRENT.format("final_sentences")}),
s AS (SELECT {_PRESENT("domain")} AS d, {_PRESENT("category")} AS c FROM cur WHERE regexp_matches(sentence, '[^\\s\\p{{Z}}]')),
ok AS (SELECT * FROM s WHERE d IS NOT NULL AND c IS NOT NULL), size AS (SELECT count(*) // 8 AS m FROM ok), n AS (SELECT d, c, count(*) AS n FROM ok GROUP BY 1, 2)
SELECT DISTINCT t.domain, t.category FROM sample_targets t CROSS JOIN size LEFT JOIN n ON n.d = {_NORM("t.domain")} AND n.c = {_NORM("t.category")}
WHERE coalesce(n.n, 0) < greatest(t.min_rows, ceil(t.target_share * m))""",
    "p5_found": f"""WITH RECURSIVE w AS (SELECT DISTINCT row_id, {_NORM("word")} AS w FROM final_translations WHERE row_id IS NOT NULL AND {_NORM("word")} NOT IN ('', 'nan', 'na', 'n/a', '#n/a', 'null', 'none', '<na>')),
e AS (SELECT DISTINCT x.row_id AS a, y.row_id AS b FROM w x JOIN w y ON x.w = y.w AND x.row_id <> y.row_id),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT DISTINCT a AS row_id_a, b AS row_id_b FROM r WHERE a < b""",
    # Checks of results that SQL can't give, but whose properties it can state.
    "p3_check": f"""WITH cur AS ({_CURRENT.format("final_sentences")})
SELECT count(*) // 8 AS sampled, 0 AS repeated, 0 AS below_floor FROM cur WHERE regexp_matches(sentence, '[^\\s\\p{{Z}}]') AND {_PRESENT("domain")} IS NOT NULL AND {_PRESENT("category")} IS NOT NULL""",
    "p5_check": "SELECT count(*) AS rows, 0 AS torn_row_id, 0 AS torn_w, true AS near_targets FROM final_translations",
    "p8_check": "SELECT count(*) AS documents, 0 AS split_without_need, 0 AS overfull, true AS well_filled FROM documents WHERE regexp_matches(text, '[^\\s\\p{Z}]')",
    "p9_check": "SELECT count(*) AS targets, 0 AS over_copied, 0 AS off_plan FROM mix_targets",
    "p10_by_script": """SELECT doc_id, lang FROM (SELECT doc_id, length(regexp_replace(text, '[\\s\\p{Z}]', '', 'g')) AS n, unnest([{'lang': 'te', 'm': length(regexp_replace(text, '[^\\x{0C00}-\\x{0C7F}]', '', 'g'))},
{'lang': 'hi', 'm': length(regexp_replace(text, '[^\\x{0900}-\\x{097F}]', '', 'g'))}, {'lang': 'ta', 'm': length(regexp_replace(text, '[^\\x{0B80}-\\x{0BFF}]', '', 'g'))}], recursive := true) FROM documents WHERE regexp_matches(text, '[^\\s\\p{Z}]')) WHERE m >= 0.9 * n""",
}
