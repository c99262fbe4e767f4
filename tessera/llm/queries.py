"""The queries of the training-data operators."""

from __future__ import annotations

from tessera.llm.decontamination import op10_winnowing
from tessera.llm.gif import op1_gif
from tessera.llm.html_text import op4_block_rules
from tessera.llm.jaccard import op5_signature_tree
from tessera.llm.kneser_ney import op9_kneser_ney
from tessera.llm.language import op3_viterbi_language
from tessera.llm.packing import op7_karmarkar_karp
from tessera.llm.quality import op2_pu_quality
from tessera.llm.sharding import op6_virtual_slots
from tessera.llm.toxicity import op8_crf_toxicity

QUERIES = {
    f.__name__: f
    for f in (op1_gif, op2_pu_quality, op3_viterbi_language, op4_block_rules, op5_signature_tree, op6_virtual_slots, op7_karmarkar_karp, op8_crf_toxicity, op9_kneser_ney, op10_winnowing)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.root = e.a)
SELECT r.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(root) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY 1"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WINNOWING = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[j + 1:j + k], ' ') AS win FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS j FROM i)),
dw AS (SELECT doc_id, k, j, array_to_string(w[j + 1:j + k], ' ') AS win FROM (SELECT d.*, x.k, unnest(range(0, len(w) - x.k + 1)) AS j FROM d, (SELECT DISTINCT k FROM iw) x)),
h AS (SELECT doc_id, k, j, item_id FROM dw JOIN iw USING (k, win)), hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS p FROM h) GROUP BY 1),
hi AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""

#: SQL for results that SQL can express; tests/llm has brute-force versions of the rest.
ORACLE_SQL: dict[str, str] = {"op5_signature_tree": _JACCARD, "op10_winnowing": _WINNOWING}
