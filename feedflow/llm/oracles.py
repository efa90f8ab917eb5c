"""DuckDB SQL for the registered queries that SQL can express."""

# Every one of these characters in a text or role gets a backslash before it.
ESCAPED_CHARS = "length({t}) - length(replace(replace(replace(replace(replace({t}, '\\', ''), '<', ''), '[', ''), ']', ''), '', ''))"


def added(text: str) -> str:
    return ESCAPED_CHARS.format(t=text)


OP10 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, coalesce(lag(role) OVER w, 'start') AS before, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(length(text) + {added("text")} + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'tool' THEN 15
        ELSE 16 + length(role) + {added("role")} END))::BIGINT AS formatted_chars,
    bool_and(role IN (SELECT unnest(CASE before WHEN 'start' THEN ['system', 'user'] WHEN 'system' THEN ['user'] WHEN 'user' THEN ['assistant']
        WHEN 'assistant' THEN ['user', 'tool'] WHEN 'tool' THEN ['tool', 'assistant'] ELSE [] END)))
        AND bool_or(is_last AND role = 'assistant') AS valid
FROM placed GROUP BY conv_id
"""

OP6 = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, lengths WHERE len(w) >= n)
), hits AS (
    SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, gram)
), covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM split LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP8 = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""

OP9 = """
WITH cut AS (
    SELECT rowid AS id, doc_id, source, text, string_split(text, chr(10)) AS lines FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
), places AS (
    SELECT id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM cut
), pages AS (
    SELECT source, count(*) AS pages FROM documents GROUP BY source
), counted AS (
    SELECT source, trim(line, ' ') AS line, count(DISTINCT id) AS n FROM places WHERE trim(line, ' ') <> '' GROUP BY ALL
), frequent AS (
    SELECT counted.source, line, true AS dropped FROM counted JOIN pages ON counted.source IS NOT DISTINCT FROM pages.source
    WHERE n >= 3 AND n > pages * 0.1
), kept AS (
    SELECT id, string_agg(places.line, chr(10) ORDER BY i) FILTER (dropped IS NULL) AS text, count(*) AS n_lines, count(dropped) AS n_dropped
    FROM places LEFT JOIN frequent ON places.source IS NOT DISTINCT FROM frequent.source AND trim(places.line, ' ') = frequent.line
    GROUP BY id
)
SELECT doc_id, n_lines, n_dropped, length(coalesce(kept.text, '')) AS n_chars, sha256(coalesce(kept.text, '')) AS text_sha256
FROM cut LEFT JOIN kept USING (id)
"""

OP4 = """
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP7 = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * inter >= 90 * (x.n + y.n - inter)
    UNION SELECT b, a FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * inter >= 90 * (x.n + y.n - inter)
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)
"""

OP11 = """
WITH turns AS MATERIALIZED (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
    SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, step: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
        4294967295::BIGINT) % 6 AS h
    FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
    SELECT convs.c, 0 AS part, i, role, text FROM convs JOIN turns ON turns.c = convs.c - convs.c % 100 WHERE i <= h
    UNION ALL SELECT turns.c, 1, i, role, text FROM convs JOIN turns USING (c) WHERE i > h
), numbered AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, length(text) AS chars, md5(length(role) || ':' || role || text) AS turn FROM rebuilt
), steps AS MATERIALIZED (
    SELECT c, d, chars, md5(string_agg(turn, ',') OVER (PARTITION BY c ORDER BY d)) AS node FROM numbered
    UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS MATERIALIZED (
    SELECT node, d, min(c) AS c, count(*) AS n_convs, any_value(chars) AS chars FROM steps GROUP BY node, d
), parents AS MATERIALIZED (
    SELECT n.*, p.node AS parent, o.c AS parent_c FROM nodes n LEFT JOIN steps p ON p.c = n.c AND p.d = n.d - 1 LEFT JOIN nodes o ON o.node = p.node AND o.d = p.d
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM parents WHERE parent IS NOT NULL GROUP BY parent
), own AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes LEFT JOIN children USING (node)
), sums AS (
    SELECT a.node, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens FROM own JOIN steps a ON a.c = own.c AND a.d <= own.d GROUP BY a.node
), lasts AS (
    SELECT c, arg_max(node, d) AS node FROM steps GROUP BY c
), ended AS (
    SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM lasts GROUP BY node
)
SELECT own.c AS conv_id, own.d::BIGINT AS depth, parent_c AS parent_conv_id, own.n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN parents USING (node) JOIN sums USING (node) LEFT JOIN ended USING (node)
"""

# Each round of op12: distances of all vectors and centroids, the nearest one, and the floors of the means.
OP12_NEAREST = """near{r} AS MATERIALIZED (
    SELECT row, v, cluster, distance FROM (
        SELECT row, v, cluster, list_sum([(v[i] - m[i]) * (v[i] - m[i]) FOR i IN range(1, 65)])::BIGINT AS distance FROM vectors, means{r}
    ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)"""
OP12_MEANS = """means{r} AS MATERIALIZED (
    SELECT cluster, coalesce(moved.m, means{b}.m) AS m FROM means{b} LEFT JOIN (
        SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM (
            SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{b}) GROUP BY cluster, i
        ) GROUP BY cluster
    ) moved USING (cluster)
)"""
OP12 = (
    """
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), means0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS cluster, v AS m FROM vectors ORDER BY cluster LIMIT 40
), """
    + ", ".join(f"{OP12_NEAREST.format(r=r)}, {OP12_MEANS.format(r=r + 1, b=r)}" for r in range(5)) + ", " + OP12_NEAREST.format(r=5)
    + """
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(m, ',')) AS centroid_sha256
FROM near5 JOIN vectors USING (row) JOIN means5 USING (cluster)
"""
)

OP13 = """
WITH RECURSIVE usable AS (
    SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), unit AS MATERIALIZED (
    SELECT row, vec_id, v, sqrt(list_sum([x * x FOR x IN v])) AS norm FROM usable
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.row < b.row AND list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)]) / (a.norm * b.norm) >= 0.95
), ways AS MATERIALIZED (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
    SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
), least AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
), counted AS (
    SELECT a, count(*) AS n FROM ways GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id, vec_id <= coalesce(least.b, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

ORACLES = {
    "op7_jaccard_join": OP7,
    "op4_top_k": OP4,
    "op6_decontaminate": OP6,
    "op8_warc": OP8,
    "op9_line_dedup": OP9,
    "op10_chat_format": OP10,
    "op11_prefix_trie": OP11,
    "op12_centroid_clustering": OP12,
    "op13_embedding_near_dedup": OP13,
}
