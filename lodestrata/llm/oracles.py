"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: Sets of distinct shingles, joined on equal shingles; links are followed by recursion.
NGRAM_JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
    p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
    r AS (SELECT doc_id, n, pos, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS g FROM p),
    s AS (SELECT DISTINCT doc_id, g FROM r WHERE pos <= greatest(n - 2, 1)),
    z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT x, y FROM i JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * i.n >= 90 * (a.n + b.n - i.n)),
    e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
    reach(node, root) AS (SELECT x, x FROM e UNION SELECT e.y, reach.root FROM reach JOIN e ON e.x = reach.node),
    c AS (SELECT node, min(root) AS root FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id FROM d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN c ON c.node = d.doc_id"""

#: Every window as text, the smallest id that holds it, and the words that later copies cover.
REPEATED_WINDOWS = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
    p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
    r AS (SELECT doc_id, pos, CASE WHEN pos <= n - 49 THEN sha256(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS h, word FROM p),
    f AS (SELECT h, min(doc_id) AS first FROM r WHERE h IS NOT NULL GROUP BY 1),
    m AS (SELECT doc_id, pos, word, coalesce(first < doc_id, false) AS hit FROM r LEFT JOIN f USING (h)),
    k AS (SELECT doc_id, pos, word, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM m),
    g AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM k GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""
