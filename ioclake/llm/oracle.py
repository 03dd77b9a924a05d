"""DuckDB SQL for the queries that SQL can express at the checked size."""

_WORDS = r"""regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format('text')} AS w FROM documents),
it AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format('text')} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
              array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM it, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM d, lens, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS r(i) WHERE len(w) >= n),
hit AS (SELECT rid, n, i, item_id FROM dw JOIN iw USING (n, win)),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(p) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM q WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM q LEFT JOIN f USING (payload_digest)
"""

# the template's control strings, longest first
_CONTROLS = r"(### Assistant:|### System:|### Role <|### User:|</turn>|>:|\\)"

CHAT_FORMAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
f AS (
  SELECT *, CASE role WHEN 'user' THEN '### User: ' WHEN 'system' THEN '### System: ' WHEN 'assistant' THEN '### Assistant: '
    ELSE '### Role <' || regexp_replace(role, '{_CONTROLS}', '\\\\\\1', 'g') || '>: ' END
    || regexp_replace(text, '{_CONTROLS}', '\\\\\\1', 'g') || ' </turn>' || chr(10) AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars,
  regexp_matches(string_agg(role || ',', '' ORDER BY turn, role, text), '^(system,)?(user,assistant,)*user,(assistant,)?$') AS valid
FROM f GROUP BY conv_id
"""



def _clustering(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """Lloyd's rounds written out, distances by plain sums of squares."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
far{r} AS (SELECT rid, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
           FROM kept, c{r}),
own{r} AS (SELECT rid, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS b FROM far{r} GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (SELECT b.cluster AS cluster, p, sum(v[p])::HUGEINT AS s, count(*) AS n FROM own{r}, unnest(range(1, {dims + 1})) AS t(p) GROUP BY 1, 2),
new{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS c FROM sums{r} GROUP BY 1),
c{r + 1} AS (SELECT cluster, coalesce(new{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN new{r} USING (cluster))""")
    return f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND list_count(embedding) = {dims}
    AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))),
seeds AS (SELECT v, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept ORDER BY h, v LIMIT {k}),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c FROM seeds),{",".join(steps)}
SELECT vec_id, b.cluster AS cluster, b.d AS distance, CAST(sum(b.d) OVER (PARTITION BY b.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM own{rounds} JOIN kept USING (rid) JOIN c{rounds} ON c{rounds}.cluster = b.cluster
"""


SQL: dict[str, str] = {
    "op4_decontaminate": DECONTAMINATE,
    "op5_chat_format": CHAT_FORMAT,
    "op8_warc": WARC,
    "op13_centroids": _clustering(),
}
