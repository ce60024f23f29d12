"""The registered queries in DuckDB SQL, written from their definitions."""

from wellspring.backends import QuotingGenerator
from wellspring.functions.prompts import (
    ANSWER_CUE,
    CONTEXT_CLOSE,
    CONTEXT_OPEN,
    QUESTION_CUE,
    SYSTEM_RULE,
)

# Fixed value: the whitespace class in RE2 notation.
SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{SPACE}+'), lambda w: w <> '')"


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def _settled(distance: str) -> str:
    return f"floor({distance} * 1e9 + 0.5) / 1e9"


CHUNKS = f"""
article_words AS (SELECT doc_id, source AS title, {_words('text')} AS w FROM documents),
starts AS (SELECT doc_id, title, w, unnest(range(0, len(w), 448)) AS s FROM article_words),
chunks AS (
  SELECT doc_id, CAST(s // 448 AS INTEGER) AS chunk_no, doc_id || ':' || (s // 448) AS chunk_id,
         title, array_to_string(w[s + 1 : s + 512], ' ') AS chunk_text
  FROM starts)"""


def _encoded(name: str, source: str, key: str, text: str, tokens: str = "") -> str:
    """CTEs with the non-zero entries of a text's vector, and its squared length."""
    return f"""
{name}_tokens AS (SELECT {key} AS key, {_words(f'lower({text})')}{tokens} AS t FROM {source}),
{name}_hashes AS (
  SELECT key, len(t) AS n, CAST('0x' || substr(md5(unnest(t)), 1, 8) AS BIGINT) AS h FROM {name}_tokens),
{name}_cells AS (
  SELECT key, h % 384 AS bucket,
         CAST(CAST(sum(CASE WHEN (h // 384) % 2 = 0 THEN 1.0::DOUBLE ELSE -1 END) / n AS FLOAT) AS DOUBLE)
           AS value
  FROM {name}_hashes GROUP BY key, h % 384, n),
{name}_norms AS (
  SELECT k.key, coalesce(sum(value * value), 0) AS norm
  FROM {name}_tokens k LEFT JOIN {name}_cells c ON c.key = k.key GROUP BY k.key)"""


def _retrieved(source: str, key: str, text: str) -> str:
    """CTE ``hits``: query_id, rank, pos, chunk_id, chunk_text, distance by brute force."""
    return f"""
WITH {CHUNKS},
{_encoded('chunk', 'chunks', 'chunk_id', 'chunk_text')},
{_encoded('question', source, key, text)},
positions AS (
  SELECT chunk_id, chunk_text, row_number() OVER (ORDER BY doc_id, chunk_no) - 1 AS pos FROM chunks),
products AS (
  SELECT q.key AS query_id, c.key AS chunk_id, sum(q.value * c.value) AS product
  FROM question_cells q JOIN chunk_cells c USING (bucket) GROUP BY ALL),
measured AS (
  SELECT q.key AS query_id, p.pos, p.chunk_id, p.chunk_text,
         {_settled('(q.norm + c.norm - 2 * coalesce(product, 0))')} AS distance
  FROM question_norms q CROSS JOIN chunk_norms c JOIN positions p ON p.chunk_id = c.key
  LEFT JOIN products x ON x.query_id = q.key AND x.chunk_id = c.key),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, pos) AS rank
  FROM measured QUALIFY rank <= 6)"""


ASKED = "(SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query_text FROM benchmark)"
MARKED = f"""(SELECT CAST(item_id AS VARCHAR) AS query_id,
  CASE WHEN item_id % 6 = 0 THEN {quoted(QuotingGenerator.MARK)} ELSE '' END || text AS query_text FROM benchmark)"""
TEXT_HITS = _retrieved(ASKED, "query_id", "query_text")

TURNS = "(SELECT 'query_' || conv_id || '_' || turn AS query_id, * FROM conversations)"
USER_TURNS = f"(SELECT * FROM {TURNS} WHERE role = 'user')"

def _vector_hits(source: str = "SELECT vec_id, embedding FROM embeddings") -> str:
    return f"""
WITH sized AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM ({source})),
measured AS (
  SELECT CAST(q.vec_id AS VARCHAR) AS query_id, x.vec_id,
         {_settled('list_sum(list_transform(list_zip(q.v, x.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))')} AS distance
  FROM sized q JOIN sized x ON len(q.v) = len(x.v)),
hits AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance
  FROM measured QUALIFY rank <= 6)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, distance FROM hits"""


VECTOR_HITS = _vector_hits()

FOLDED = f"""{TEXT_HITS},
folded AS (
  SELECT query_id, list(chunk_text ORDER BY rank) AS contexts,
         string_agg(CAST(pos AS VARCHAR), '|' ORDER BY rank) AS indices,
         string_agg(printf('%.4f', distance), '|' ORDER BY rank) AS distances
  FROM hits GROUP BY query_id),
first_seen AS (SELECT query_id, chunk_text AS context, min(rank) AS rank FROM hits GROUP BY ALL)"""

REQUEST_LOG = f"""
WITH turns AS (SELECT * FROM {TURNS}),
log AS (
  SELECT a.query_id, a.text AS query, b.text AS reply,
         CASE WHEN b.text IS NOT NULL THEN 'completed' WHEN a.turn < 3 THEN 'queued'
              WHEN a.turn < 6 THEN 'processing' ELSE 'failed' END AS status
  FROM turns a LEFT JOIN turns b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant'
  WHERE a.role = 'user')"""

NUMBERED = "(SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 250 AS batch_id FROM documents)"

ORACLE = {
    "article_scan": "SELECT doc_id, source AS title, text FROM documents",
    "row_peek": "SELECT doc_id, source AS title, text FROM documents ORDER BY doc_id LIMIT 1 OFFSET 20",
    "row_range_batches": f"""
SELECT batch_id, count(*) AS n_articles, min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM {NUMBERED} GROUP BY batch_id""",
    "chunk_overlap": f"WITH {CHUNKS} SELECT chunk_id, doc_id, chunk_no, title, chunk_text FROM chunks",
    "chunk_roundtrip": f"""
WITH {CHUNKS}
SELECT doc_id, chunk_no, chunk_id, title, chunk_text, batch_id
FROM chunks JOIN (SELECT doc_id, batch_id FROM {NUMBERED}) USING (doc_id)""",
    "batch_ledger": f"""
WITH {CHUNKS}
SELECT batch_id, count(*) AS n_chunks, CAST(0 AS BIGINT) AS n_failed, CAST(NULL AS VARCHAR) AS error
FROM chunks JOIN (SELECT doc_id, batch_id FROM {NUMBERED}) USING (doc_id) GROUP BY 1""",
    "hash_encode": f"""
WITH {CHUNKS}, {_encoded('chunk', 'chunks', 'chunk_id', 'chunk_text', '[1:128]')}
SELECT key AS chunk_id, CAST(bucket AS INTEGER) AS bucket, round(value, 6) AS value
FROM chunk_cells WHERE value <> 0""",
    "mean_pool": """
WITH cells AS (
  SELECT label, unnest(embedding) AS value, unnest(range(0, len(embedding))) AS element FROM embeddings)
SELECT label, CAST(element AS INTEGER) AS element, round(avg(CAST(value AS DOUBLE)), 6) AS mean
FROM cells GROUP BY label, element""",
    "valid_embedding_filter": """
SELECT vec_id, CASE WHEN label = 7 THEN 'width' WHEN vec_id % 17 = 0 THEN 'value' ELSE 'indexed' END AS verdict
FROM embeddings WHERE label NOT IN (3, 5) AND vec_id % 11 <> 0 AND vec_id % 13 <> 0""",
    "flat_chunk_lines": f"""
WITH {CHUNKS} SELECT title, count(*) AS n_chunks, count(*) AS n_vectors FROM chunks GROUP BY title""",
    "build_index": f"""
WITH {CHUNKS}
SELECT row_number() OVER (ORDER BY doc_id, chunk_no) - 1 AS pos, chunk_id, title, chunk_text FROM chunks""",
    "index_size": f"WITH {CHUNKS} SELECT count(*) AS ntotal FROM chunks",
    "knn_topk": VECTOR_HITS,
    "knn_mixed_width": _vector_hits(
        """SELECT vec_id, CASE WHEN label = 7 THEN embedding[1:63] ELSE embedding END AS embedding FROM embeddings
  WHERE label NOT IN (3, 5) AND (label = 7 OR vec_id % 17 <> 0)"""
    ),
    "distance_format": f"""
SELECT query_id, string_agg(printf('%.4f', distance), '|' ORDER BY rank) AS distances
FROM ({VECTOR_HITS}) GROUP BY query_id""",
    "hit_distance": VECTOR_HITS,
    "text_topk": f"{TEXT_HITS} SELECT query_id, CAST(rank AS INTEGER) AS rank, pos, chunk_id, distance FROM hits",
    "context_fetch": f"{TEXT_HITS} SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_text FROM hits",
    "context_dedupe": f"""{FOLDED}
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) - 1 AS INTEGER) AS context_no, context
FROM first_seen""",
    "prompt_assemble": f"""{FOLDED},
joined AS (SELECT query_id, string_agg(context, chr(10) || chr(10) ORDER BY rank) AS context FROM first_seen GROUP BY 1)
SELECT query_id, {quoted(SYSTEM_RULE)} AS system,
       {quoted(CONTEXT_OPEN)} || substring(context, 1, 12000) || {quoted(CONTEXT_CLOSE)}
         || {quoted(QUESTION_CUE)} || query_text || {quoted(ANSWER_CUE)} AS "user"
FROM joined JOIN {ASKED} asked USING (query_id)""",
    "duplicate_ids": f"""{FOLDED}
SELECT CASE WHEN CAST(query_id AS BIGINT) % 7 <> 0 THEN CAST(CAST(query_id AS BIGINT) % 5 AS VARCHAR) END AS query_id,
       query_text AS query, indices
FROM folded JOIN {ASKED} asked USING (query_id)""",
    "answers": f"""{_retrieved(MARKED, 'query_id', 'query_text')},
first_seen AS (SELECT query_id, chunk_text AS context, min(rank) AS rank FROM hits GROUP BY ALL),
joined AS (
  SELECT query_id, substring(string_agg(context, chr(10) || chr(10) ORDER BY rank), 1, 12000) AS context
  FROM first_seen GROUP BY 1),
whole AS (
  SELECT *, length({quoted(CONTEXT_OPEN)} || context || {quoted(CONTEXT_CLOSE)}
         || {quoted(QUESTION_CUE)} || query_text || {quoted(ANSWER_CUE)}) AS n
  FROM joined JOIN {MARKED} asked USING (query_id))
SELECT query_id, CASE WHEN starts_with(query_text, {quoted(QuotingGenerator.MARK)}) THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN NOT starts_with(query_text, {quoted(QuotingGenerator.MARK)})
            THEN n || '|' || substring(context, 1, 20) || '|' || substring(query_text || {quoted(ANSWER_CUE)}, 1, 20) END AS answer,
       CASE WHEN starts_with(query_text, {quoted(QuotingGenerator.MARK)}) THEN {quoted(QuotingGenerator.ERROR)} END AS error
FROM whole""",
    "answer_log": f"""{FOLDED}
SELECT query_text AS query, array_to_string(contexts, chr(10)) AS contexts, indices, distances
FROM folded JOIN {ASKED} asked USING (query_id)""",
    "answer_summary": f"""{FOLDED}
SELECT query_text AS query, CAST(len(contexts) AS INTEGER) AS topk, indices, distances,
       substring(array_to_string(contexts, chr(10) || chr(10) || '---' || chr(10) || chr(10)), 1, 2000)
         AS context_concat
FROM folded JOIN {ASKED} asked USING (query_id)""",
    "console_summary": f"""{FOLDED}
SELECT query_text AS query, CAST(len(contexts) AS INTEGER) AS topk
FROM folded JOIN {ASKED} asked USING (query_id)""",
    "question_routing": f"""
WITH sent AS (
  SELECT query_id, CASE WHEN role = 'system' THEN ' STATUS' || chr(9) WHEN turn = 8 THEN 'Quit' || chr(10)
                        ELSE '  ' || text || chr(10) END AS payload
  FROM {TURNS}),
cut AS (SELECT query_id, {_strip('payload')} AS query_text FROM sent)
SELECT query_id, CASE WHEN query_text = '' THEN 'blank'
                      WHEN lower(query_text) IN ('quit', 'exit', 'bye') THEN 'quit'
                      WHEN lower(query_text) = 'status' THEN 'status' ELSE 'question' END AS kind, query_text
FROM cut""",
    "response_envelope": f"""{REQUEST_LOG}
SELECT query_id, query, CASE WHEN status = 'completed' THEN reply END AS answer,
       CASE WHEN status = 'completed' THEN reply END AS contexts,
       CASE WHEN status = 'completed' THEN length(reply) / 1000.0 END AS processing_time,
       CASE WHEN status = 'failed' THEN 'no reply' END AS error, status
FROM log WHERE status IN ('completed', 'failed')""",
    "request_metrics": f"""{REQUEST_LOG}
SELECT CAST(count_if(status = 'processing') AS BIGINT) AS active_workers, CAST(4 AS INTEGER) AS max_workers,
       CAST(count_if(status = 'queued') AS BIGINT) AS queue_size,
       CAST(count_if(status = 'completed') AS BIGINT) AS total_completed
FROM log""",
    "bounded_intake": """
SELECT count(*) AS questions, count(DISTINCT conv_id || ':' || turn) AS answered, CAST(0 AS BIGINT) AS above_bound,
       true AS as_many_as_needed
FROM conversations WHERE role = 'user'""",
    "stream_status": """
SELECT CAST(0 AS BIGINT) AS active_workers, CAST(4 AS INTEGER) AS max_workers, CAST(0 AS BIGINT) AS queue_size,
       CAST(count_if(conv_id % 6 <> 0) AS BIGINT) AS total_completed, CAST(count_if(conv_id % 6 = 0) AS BIGINT) AS total_failed
FROM conversations WHERE role = 'user'""",
    "request_states": f"""{REQUEST_LOG}
SELECT CAST(count_if(status = 'queued') AS BIGINT) AS queued, CAST(count_if(status = 'processing') AS BIGINT) AS processing,
       CAST(count_if(status = 'completed') AS BIGINT) AS completed, CAST(count_if(status = 'failed') AS BIGINT) AS failed
FROM log""",
    "reject_lines": f"""
WITH {CHUNKS},
kinds AS (
  SELECT doc_id, CASE (doc_id + chunk_no) % 7 WHEN 0 THEN 'no record' WHEN 2 THEN 'wrong type' ELSE 'chunk' END AS kind FROM chunks)
SELECT kind, count(*) AS n_lines, CAST(sum(CASE WHEN kind = 'chunk' THEN doc_id ELSE 0 END) AS BIGINT) AS doc_ids FROM kinds GROUP BY kind""",
    "embedded_lines": f"""
WITH {CHUNKS}, {_encoded('chunk', 'chunks', 'chunk_id', 'chunk_text')},
positions AS (SELECT chunk_id, row_number() OVER (ORDER BY doc_id, chunk_no) - 1 AS pos FROM chunks)
SELECT pos, chunk_id, round(norm, 6) AS norm FROM positions JOIN chunk_norms ON key = chunk_id""",
    "index_versions": """
SELECT 'latest' AS version, count(*) AS n FROM embeddings
UNION ALL SELECT unnest(['reader', 'first']), count(*) FROM embeddings WHERE label < 5""",
    "answer_stream": f"""{_retrieved(USER_TURNS, 'query_id', 'text')}
SELECT query_id, 'completed' AS status, CAST(rank AS INTEGER) AS rank, chunk_text AS context FROM hits""",
}
