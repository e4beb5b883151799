"""SQL of the registered queries of this subpackage, where SQL can state their whole result, written for DuckDB.

The other queries return what a trained model, a sketch or a tokenizer decides, or places that SQL cannot find.
"""

_BLANK = r"'[^\x20\x09-\x0D]+'"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_FOLDED}, {_PLAIN}) AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLDED}, {_PLAIN}) AS words FROM benchmark),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT item, words, least(10, len(words)) AS n,
               unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i
        FROM b WHERE len(words) > 0)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)),
found AS MATERIALIZED (SELECT doc_id, i, n, item FROM doc_windows JOIN item_windows USING (n, win)),
hit AS (SELECT doc_id, count(*) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_REPEATS = f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK}) AS words FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
earliest AS (SELECT win, min(doc_id) AS first_doc FROM windows GROUP BY win),
gone AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN earliest USING (win)
  WHERE doc_id > first_doc),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
         FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_NEAR = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_FOLDED}, {_BLANK}) AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS sh
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 3) + 1)) AS i FROM d WHERE len(words) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
held AS (SELECT sh, count(*) AS docs FROM s GROUP BY sh),
-- Linked sets share one of their rarest shingles: more of them than may be missing are looked at.
ranked AS (SELECT doc_id, sh, n, row_number() OVER (PARTITION BY doc_id ORDER BY docs, sh) AS r
           FROM s JOIN held USING (sh) JOIN sizes USING (doc_id)),
rare AS MATERIALIZED (SELECT doc_id, sh, n FROM ranked WHERE r <= n - (85 * n + 99) // 100 + 1),
pairs AS MATERIALIZED (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total
  FROM rare a JOIN rare b ON a.sh = b.sh AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN s sx ON sx.doc_id = x JOIN s sy ON sy.doc_id = y AND sy.sh = sx.sh
  GROUP BY x, y, total HAVING 185 * count(*) >= 85 * total),
arcs AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT doc_id, y FROM reach JOIN arcs ON x = other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# CRC-32 of the decimal conv_id: each byte, then eight steps marked by -1.
_CRC = """
xor(list_reduce(
  list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: list_concat([CAST(ascii(c) AS BIGINT)], list_transform(range(8), lambda k: -1::BIGINT))))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END
), 4294967295::BIGINT)"""

_TRIE = f"""
WITH turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS h,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, length(coalesce(text, '')), role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (
  SELECT conv_id, list(h ORDER BY i) AS hs, list(chars ORDER BY i) AS cs, {_CRC.strip()} % 6 AS n
  FROM turns GROUP BY conv_id),
conv AS MATERIALIZED (
  SELECT o.conv_id, list_concat(coalesce(f.hs, [])[1:o.n], o.hs[o.n + 1:]) AS path,
         list_concat(coalesce(f.cs, [])[1:o.n], o.cs[o.n + 1:]) AS chars
  FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, path[1:d] AS p, len(path) = d AS ends, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM conv)),
nodes AS MATERIALIZED (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids
  FROM prefixes GROUP BY p, d),
kids AS MATERIALIZED (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
up AS (
  SELECT p[1:a] AS p, CAST(sum((n - 1) * chars) AS BIGINT) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves
  FROM (SELECT nodes.*, kids.p IS NULL AS leaf, unnest(range(0, d + 1)) AS a FROM nodes LEFT JOIN kids ON kids.p = nodes.p)
  GROUP BY 1)
SELECT x.conv_id, x.d AS depth, above.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, sha256(coalesce(x.ids, '')) AS ends_sha256
FROM nodes x JOIN up ON up.p = x.p LEFT JOIN kids ON kids.p = x.p
LEFT JOIN nodes above ON x.d > 0 AND above.d = x.d - 1 AND above.p = x.p[1:x.d - 1]
"""

_SEARCH = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all({_FOLDED}, {_PLAIN}) AS words FROM documents),
q AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED}, {_PLAIN})) AS term FROM benchmark),
totals AS MATERIALIZED (SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM d WHERE len(words) > 0),
postings AS MATERIALIZED (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY row_id, term),
weights AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
lengths AS MATERIALIZED (SELECT row_id, doc_id, 50 + (50 * len(words) * n_docs) // n_terms AS m FROM d, totals),
scored AS (
  SELECT item_id, row_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (row_id)
  GROUP BY item_id, row_id, doc_id)
SELECT * FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
         doc_id, score
  FROM scored WHERE score > 0)
WHERE rank <= 50
"""

ORACLE: dict[str, str] = {
    "op2_decontamination": _DECONTAMINATION.strip(),
    "op3_substring_dedup": _REPEATS.strip(),
    "op9_ngram_jaccard": _NEAR.strip(),
    "op12_prefix_trie": _TRIE.strip(),
    "op13_lexical_search": _SEARCH.strip(),
}
