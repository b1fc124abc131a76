"""SQL twins of the registered queries, in the dialect of DuckDB."""

from registered.queries import COURSE

ORACLES: dict[str, str] = {}


def _tokens(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), "
        "lambda t: t <> '')"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c)


FAQ = """
faq AS (SELECT doc_id, source AS course, lang AS section,
  split_part(text, chr(10), 1) AS question, text AS answer FROM documents)"""

CHUNKS = """
chunks AS (SELECT doc_id, start, substring(text, start + 1, 2000) AS content FROM (
  SELECT doc_id, text, unnest(range(0,
    (greatest(0, ceil((length(text) - 2000) / 1000.0)::bigint) * 1000 + 1)::bigint, 1000)) AS start
  FROM documents))"""

QUESTIONS = "questions AS (SELECT item_id AS query_id, text FROM benchmark)"


def _index(table: str, fields: list[str], key: str) -> str:
    """CTEs ``counts``, ``stats`` and ``postings`` of a keyword index."""
    texts = " UNION ALL ".join(
        f"SELECT {key}, '{f}' AS field, {_tokens(f)} AS toks FROM {table}" for f in fields
    )
    return f"""
counts AS (SELECT {key}, field, term, count(*) AS tf
  FROM (SELECT {key}, field, unnest(toks) AS term FROM ({texts})) GROUP BY ALL),
stats AS (SELECT field, term, count(*) AS df,
  ln((1.0 + (SELECT count(*) FROM {table})) / (1 + count(*))) + 1 AS idf
  FROM counts GROUP BY field, term),
postings AS (SELECT {key}, field, term, tf * idf
  / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {key}, field)) AS weight
  FROM counts JOIN stats USING (field, term))"""


def _hits(
    name: str, key: str, boosts: dict[str, float], k: int, where: str = "true",
    asked: str = "questions",
) -> str:
    """CTE ``name(query_id, key, score, rank)`` of a keyword search."""
    boost = "".join(f" WHEN '{f}' THEN {b}" for f, b in boosts.items())
    factor = f"CASE field{boost} ELSE 1.0 END" if boosts else "1.0"
    order = ", ".join(["score DESC", *key.split(", ")])
    return f"""
{name}_terms AS (SELECT query_id, term, count(*) AS qtf FROM (
  SELECT query_id, unnest({_tokens('text')}) AS term FROM {asked}) GROUP BY ALL),
{name}_weights AS (SELECT query_id, field, term, ({factor}) * qtf * idf
  / sqrt(sum(qtf * idf * qtf * idf) OVER (PARTITION BY query_id, field)) AS qweight
  FROM {name}_terms JOIN stats USING (term)),
{name}_scores AS (SELECT query_id, {key}, round(sum(weight * qweight), 6) + 0.0 AS score
  FROM postings JOIN {name}_weights USING (field, term) WHERE {where} GROUP BY query_id, {key}),
{name} AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank
  FROM {name}_scores WHERE score > 0) WHERE rank <= {k})"""


def _encoded(name: str, table: str, key: str, text: str, dims: int = 64, unit: bool = True) -> str:
    """CTE ``name(key, vec)`` of feature-hashed vectors; NULL vectors are left out."""
    cols = ", ".join(f"t.{c}" for c in key.split(", "))
    value = "v / sqrt(sum(v * v) OVER (PARTITION BY " + key + "))" if unit else "v"
    keep = "WHERE sqrt(s) > 0" if unit else ""
    return f"""
{name}_feats AS (SELECT {key}, ('0x' || substring(md5(tok), 1, 7))::bigint % {dims} AS dim,
  CASE WHEN substring(md5(tok), 9, 1) >= '8' THEN -1.0 ELSE 1.0 END AS sgn
  FROM (SELECT {key}, unnest({_tokens(text)}) AS tok FROM {table})),
{name}_sums AS (SELECT {key}, dim, sum(sgn) AS v FROM {name}_feats GROUP BY ALL),
{name}_grid AS (SELECT {cols}, d.dim, coalesce(s.v, 0.0) AS v
  FROM {table} t CROSS JOIN (SELECT unnest(range({dims})) AS dim) d
  LEFT JOIN {name}_sums s ON {' AND '.join(f's.{c} = t.{c}' for c in key.split(', '))}
  AND s.dim = d.dim),
{name}_norm AS (SELECT {key}, dim, v, sum(v * v) OVER (PARTITION BY {key}) AS s FROM {name}_grid),
{name} AS (SELECT {key}, list({value.split(' / ')[0] + (' / sqrt(s)' if unit else '')}
  ORDER BY dim)::double[] AS vec FROM {name}_norm {keep} GROUP BY {key})"""


def _nearest(
    name: str, stored: str, asked: str, key: str, k: int, score: str, on: str = "true"
) -> str:
    """CTE ``name(query_id, key, score, rank)`` of an exact vector search."""
    cols = ", ".join(f"d.{c}" for c in key.split(", "))
    order = ", ".join(["score DESC", *key.split(", ")])
    return f"""
{name} AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank
  FROM (SELECT q.query_id, {cols}, round({score}, 6) + 0.0 AS score
  FROM {stored} d JOIN {asked} q ON {on})) WHERE rank <= {k})"""


DOT = "list_dot_product(d.vec, q.vec)"
COSINE = f"{DOT} / (sqrt(list_dot_product(d.vec, d.vec)) * sqrt(list_dot_product(q.vec, q.vec)))"
VECTORS = "vectors AS (SELECT vec_id, embedding::double[] AS vec, label FROM embeddings)"
ASKED = ",".join(
    [
        QUESTIONS,
        _encoded("coded", "questions", "query_id", "text"),
        "asked AS (SELECT query_id, vec, (query_id % 10)::int AS label FROM coded)",
    ]
)
CENTRES = """
centres AS (SELECT label AS cell, list(m ORDER BY dim)::double[] AS vec FROM (
  SELECT label, dim, avg(v) AS m FROM (
    SELECT label, generate_subscripts(vec, 1) AS dim, unnest(vec) AS v FROM vectors)
  GROUP BY label, dim) GROUP BY label)"""
CELLS = f"""
celled AS (SELECT vec_id, vec, label, cell FROM (SELECT d.vec_id, d.vec, d.label, q.cell,
  row_number() OVER (PARTITION BY d.vec_id ORDER BY round({COSINE}, 9) DESC, q.cell) AS r
  FROM vectors d CROSS JOIN centres q) WHERE r = 1)"""

FAQ_INDEX = _index("faq", ["question", "section", "answer"], "doc_id")
FAQ_BOOSTS = {"question": 3.0, "section": 0.5}
CHUNK_KEY = "doc_id, start"
CHUNK_INDEX = _index("chunks", ["content"], CHUNK_KEY)
IN_COURSE = f"doc_id IN (SELECT doc_id FROM faq WHERE course = '{COURSE}')"

ORACLES["compose_text"] = (
    _with(FAQ) + " SELECT doc_id, question || chr(10) || answer AS embed_text FROM faq"
)
ORACLES["path_filter"] = (
    "SELECT page_id, url FROM pages WHERE contains(url, '/en/')"
    " AND string_split(url, '.')[-1] = 'html'"
)
ORACLES["first_page"] = (
    "SELECT page_id, url, html FROM pages WHERE contains(url, '/en/') ORDER BY page_id LIMIT 1"
)
ORACLES["catalog_load"] = (
    _with(FAQ) + " SELECT doc_id, course, section, question, answer FROM faq"
)
ORACLES["catalog_arrays"] = ORACLES["catalog_load"]
ORACLES["file_tree"] = """SELECT 'page ' || page_id AS filename,
  'page ' || page_id || chr(10) || html || chr(10) AS embed_text FROM pages"""
ORACLES["vector_table"] = (
    _with(
        FAQ,
        "texts AS (SELECT doc_id, question || chr(10) || answer AS body FROM faq)",
        _encoded("encoded", "texts", "doc_id", "body", 384, unit=False),
    )
    + """ SELECT doc_id, course, section, '[' || array_to_string(
      list_transform(vec, lambda x: printf('%.1f', x + 0.0)), ',') || ']' AS literal
      FROM faq JOIN encoded USING (doc_id)"""
)
ORACLES["vector_export"] = """SELECT vec_id, '[' || array_to_string(
  list_transform(embedding, lambda x: printf('%.6f', x::double)), ',') || ']' AS literal
  FROM embeddings"""

ORACLES["chunk_sliding"] = _with(CHUNKS) + " SELECT doc_id, start, content FROM chunks"
ORACLES["term_stats"] = (
    _with(FAQ, FAQ_INDEX) + " SELECT field, term, df, round(idf, 6) AS idf FROM stats"
)
ORACLES["postings"] = (
    _with(FAQ, FAQ_INDEX)
    + """ SELECT doc_id, course, field, term, round(weight, 6) AS weight
      FROM postings JOIN faq USING (doc_id)"""
)
KEYWORD = {
    "keyword_plain": ({}, 5, "true"),
    "keyword_boosted": (FAQ_BOOSTS, 5, "true"),
    "keyword_filtered": (FAQ_BOOSTS, 5, IN_COURSE),
    "keyword_single": ({}, 1, "true"),
    "keyword_match": (
        FAQ_BOOSTS,
        5,
        "EXISTS (SELECT 1 FROM faq f WHERE f.doc_id = postings.doc_id"
        " AND f.course = 'src' || (query_id % 20))",
    ),
}
for _name, (_boosts, _k, _where) in KEYWORD.items():
    ORACLES[_name] = (
        _with(FAQ, FAQ_INDEX, QUESTIONS, _hits("hits", "doc_id", _boosts, _k, _where))
        + " SELECT query_id, doc_id, score, rank FROM hits"
    )
KEYWORD_CHUNKS = _with(
    CHUNKS, CHUNK_INDEX, QUESTIONS, _hits("hits", CHUNK_KEY, {"content": 3.0}, 5)
)
ORACLES["keyword_chunks"] = KEYWORD_CHUNKS + " SELECT query_id, doc_id, start, score, rank FROM hits"

IN_SOURCE = f"doc_id IN (SELECT doc_id FROM documents WHERE source = '{COURSE}')"
ORACLES["keyword_chunks_filtered"] = (
    _with(CHUNKS, CHUNK_INDEX, QUESTIONS, _hits("hits", CHUNK_KEY, {}, 5, IN_SOURCE))
    + " SELECT query_id, doc_id, start, score, rank FROM hits"
)

ORACLES["hash_embed"] = (
    _with(_encoded("encoded", "documents", "doc_id", "text"))
    + """ SELECT doc_id, dim, round(v, 6) + 0.0 AS value FROM (
      SELECT doc_id, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec) AS v FROM encoded)
      WHERE v <> 0"""
)
ORACLES["encode_plugin"] = """SELECT doc_id, length(text)::double AS chars,
  (length(text) - length(replace(text, 'e', '')))::double AS es,
  (length(text) - length(replace(text, chr(10), '')))::double AS breaks FROM documents"""
ORACLES["token_pooled"] = (
    _with(QUESTIONS, _encoded("encoded", "questions", "query_id", "text"))
    + """ SELECT query_id, dim, round(v, 6) + 0.0 AS value FROM (
      SELECT query_id, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec) AS v FROM encoded)
      WHERE v <> 0"""
)
ORACLES["mean_pooled"] = (
    _with(_encoded("encoded", "conversations", "conv_id, turn", "text"))
    + """ SELECT conv_id, dim, round(avg(v), 6) + 0.0 AS value FROM (
      SELECT conv_id, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec) AS v
      FROM encoded JOIN conversations USING (conv_id, turn) WHERE role <> 'system')
      GROUP BY conv_id, dim"""
)

ORACLES["vector_distance"] = (
    _with(VECTORS, CENTRES)
    + f""" SELECT vec_id, round({DOT}, 6) + 0.0 AS inner_product,
      round(1 - {COSINE}, 6) + 0.0 AS distance
      FROM vectors d JOIN centres q ON q.cell = d.label"""
)
ORACLES["vector_argmax"] = (
    _with(VECTORS, ASKED, _nearest("hits", "vectors", "asked", "vec_id", 1, DOT))
    + " SELECT query_id, vec_id, score FROM hits"
)
VECTOR = {
    "vector_topk": (DOT, "true"),
    "vector_filtered": (DOT, "d.label = q.label"),
}
for _name, (_score, _on) in VECTOR.items():
    ORACLES[_name] = (
        _with(VECTORS, ASKED, _nearest("hits", "vectors", "asked", "vec_id", 5, _score, _on))
        + " SELECT query_id, vec_id, score, rank FROM hits"
    )
ORACLES["vector_similarity"] = (
    _with(VECTORS, ASKED, _nearest("hits", "vectors", "asked", "vec_id", 5, COSINE, "d.label = 3"))
    + " SELECT query_id, vec_id, score AS similarity, rank FROM hits"
)
CHUNK_VECTORS = [
    _encoded("stored", "chunks", CHUNK_KEY, "content"),
    _encoded("asked", "questions", "query_id", "text"),
    _nearest("near", "stored", "asked", CHUNK_KEY, 5, DOT),
]
ORACLES["chunk_vectors"] = (
    _with(CHUNKS, QUESTIONS, *CHUNK_VECTORS)
    + " SELECT query_id, doc_id, start, score, rank FROM near"
)
ORACLES["ivf_assign"] = _with(VECTORS, CENTRES, CELLS) + " SELECT vec_id, cell FROM celled"
PROBES = _nearest("probes", "centres", "asked", "cell", 99, COSINE)
IVF = {"ivf_topk": (3, ""), "ivf_filtered": (4, " AND d.label = q.label")}
for _name, (_nprobe, _on) in IVF.items():
    ORACLES[_name] = (
        _with(
            VECTORS,
            ASKED,
            CENTRES,
            CELLS,
            PROBES,
            f"""probing AS (SELECT query_id, vec, label, cell
            FROM asked JOIN probes USING (query_id) WHERE rank <= {_nprobe})""",
            _nearest(
                "hits", "celled", "probing", "vec_id", 5, COSINE, "d.cell = q.cell" + _on
            ),
        )
        + " SELECT query_id, vec_id, score, rank FROM hits"
    )
ORACLES["ivf_all_cells"] = (
    _with(VECTORS, ASKED, _nearest("hits", "vectors", "asked", "vec_id", 5, COSINE))
    + " SELECT query_id, vec_id, score, rank FROM hits"
)

LEFT = "remaining AS (SELECT * FROM vectors WHERE vec_id % 10 <> 3)"
HELD = "held AS (SELECT vec_id AS query_id, vec FROM vectors WHERE vec_id % 100 = 0)"
ORACLES["ivf_grown"] = (
    _with(VECTORS, LEFT, HELD, _nearest("hits", "remaining", "held", "vec_id", 5, COSINE))
    + " SELECT query_id, vec_id, score, rank FROM hits"
)
ORACLES["ivf_compacted"] = _with(VECTORS, LEFT) + " SELECT vec_id, label FROM remaining"
ORACLES["ivf_kmeans"] = """SELECT item_id AS query_id, 5::bigint AS hits, true AS scores_exact,
  true AS recall_reached FROM benchmark"""
FAQ_VECTORS = _with(
    FAQ,
    "bodies AS (SELECT doc_id, question || chr(10) || answer AS body FROM faq)",
    _encoded("stored", "bodies", "doc_id", "body"),
    QUESTIONS,
    _encoded("asked", "questions", "query_id", "text"),
)
ORACLES["faq_vector_search"] = (
    FAQ_VECTORS
    + ","
    + _nearest("hits", "stored", "asked", "doc_id", 5, DOT, IN_COURSE.replace("doc_id IN", "d.doc_id IN", 1))
    + """ SELECT query_id, doc_id, score AS similarity, rank, course, section, question, answer
      FROM hits JOIN faq USING (doc_id)"""
)


def _fused(lists: list[str], key: str) -> str:
    """CTE ``fused(query_id, key, score, rank)`` by reciprocal rank."""
    stacked = " UNION ALL ".join(
        f"SELECT query_id, {key}, {i} AS list_no, rank FROM {n}" for i, n in enumerate(lists)
    )
    return f"""
listed AS ({stacked}),
fused AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, first_seen) AS rank
  FROM (SELECT query_id, {key}, round(sum(1 / (60.0 + rank - 1)::double), 12) AS score,
  min(list_no * 1000000 + rank) AS first_seen FROM listed GROUP BY query_id, {key}))
  WHERE rank <= 5)"""


ORACLES["rank_fusion"] = (
    _with(
        FAQ,
        FAQ_INDEX,
        QUESTIONS,
        _hits("plain", "doc_id", {}, 5),
        _hits("boosted", "doc_id", FAQ_BOOSTS, 5),
        _fused(["plain", "boosted"], "doc_id"),
    )
    + " SELECT query_id, doc_id, score, rank FROM fused"
)
HYBRID = _with(
    CHUNKS,
    QUESTIONS,
    CHUNK_INDEX,
    *CHUNK_VECTORS,
    _hits("found", CHUNK_KEY, {}, 5),
    _fused(["near", "found"], CHUNK_KEY),
)
ORACLES["hybrid_topk"] = HYBRID + " SELECT query_id, doc_id, start, score, rank FROM fused"
ORACLES["hit_lists"] = (
    HYBRID
    + """ SELECT query_id, list_no, string_agg(doc_id::varchar, ',' ORDER BY doc_id) AS names
      FROM listed GROUP BY query_id, list_no"""
)
ORACLES["fused_names"] = (
    HYBRID
    + """ SELECT query_id, string_agg(doc_id::varchar, ',' ORDER BY rank) AS names
      FROM fused GROUP BY query_id"""
)


def _context(block: str, docs: str, key: str, hits: str) -> str:
    """CTE ``contexts(query_id, text, context)``."""
    return f"""
blocks AS (SELECT query_id, trim(string_agg({block}, chr(10) || chr(10) ORDER BY rank),
  ' ' || chr(10) || chr(9) || chr(13)) AS context FROM {hits} JOIN {docs} USING ({key})
  GROUP BY query_id),
contexts AS (SELECT query_id, text, coalesce(context, '') AS context
  FROM questions LEFT JOIN blocks USING (query_id))"""


FAQ_BLOCK = "section || chr(10) || 'Q: ' || question || chr(10) || 'A: ' || answer"
CHUNK_BLOCK = "'Filename: ' || doc_id || chr(10) || 'Content: ' || content"
PROMPT = (
    "'QUESTION: ' || chr(10) || '    ' || text || chr(10) || chr(10)"
    " || 'CONTEXT:' || chr(10) || '    ' || context"
)
INSTRUCTIONS = (
    "chr(10) || 'Your task is to answer questions from the course participats based on the"
    " provided context. ' || chr(10) || 'Use the content to find relevant information and provide"
    " accurate answers.' || chr(10) || 'If the answer is not found in the context, respond with"
    """ "I don''t know."' || chr(10)"""
)
ORACLES["context_faq"] = (
    _with(
        FAQ,
        FAQ_INDEX,
        QUESTIONS,
        _hits("hits", "doc_id", FAQ_BOOSTS, 5, IN_COURSE),
        _context(FAQ_BLOCK, "faq", "doc_id", "hits"),
    )
    + " SELECT query_id, context FROM contexts"
)
ORACLES["context_chunks"] = (
    KEYWORD_CHUNKS
    + ","
    + _context(CHUNK_BLOCK, "chunks", CHUNK_KEY, "hits")
    + " SELECT query_id, context FROM contexts"
)
ORACLES["prompts"] = (
    _with(
        FAQ,
        FAQ_INDEX,
        QUESTIONS,
        _hits("hits", "doc_id", FAQ_BOOSTS, 5),
        _context(FAQ_BLOCK, "faq", "doc_id", "hits"),
    )
    + f" SELECT query_id, {PROMPT} AS prompt FROM contexts"
)
ORACLES["prompts_vector"] = (
    FAQ_VECTORS
    + ","
    + _nearest("hits", "stored", "asked", "doc_id", 5, DOT)
    + ","
    + _context(FAQ_BLOCK, "faq", "doc_id", "hits")
    + f" SELECT query_id, {PROMPT} AS prompt FROM contexts"
)
ORACLES["prompt_messages"] = (
    HYBRID
    + ","
    + _context(CHUNK_BLOCK, "chunks", CHUNK_KEY, "fused")
    + f""" SELECT query_id, 0::bigint AS turn, 'developer' AS role, {INSTRUCTIONS} AS content
      FROM contexts
      UNION ALL SELECT query_id, 1, 'user', {PROMPT} FROM contexts"""
)
ORACLES["usage_totals"] = f"""SELECT conv_id, sum(n)::bigint AS tokens,
  round(sum(n * CASE role WHEN 'assistant' THEN 2e-6 WHEN 'user' THEN 0.25e-6
  WHEN 'system' THEN 0.25e-6 ELSE 0 END), 9) + 0.0 AS cost
  FROM (SELECT conv_id, role, len({_tokens('text')}) AS n FROM conversations) GROUP BY conv_id"""

CALLS = """
calls AS (SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, text
  FROM conversations WHERE role = 'user')"""
ORACLES["history_append"] = """SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT conv_id, last + row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn,
  'tool' AS role, 'found: ' || text AS text
  FROM conversations JOIN (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id)
  USING (conv_id) WHERE role = 'user'"""
ORACLES["last_answer"] = """SELECT conv_id, max_by(text, turn) AS answer FROM conversations
  WHERE role = 'assistant' GROUP BY conv_id"""
ORACLES["round_count"] = """SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS rounds
  FROM conversations GROUP BY conv_id"""
ORACLES["open_calls"] = (
    _with(CALLS)
    + """ SELECT conv_id, turn, call_id FROM calls c WHERE NOT EXISTS (SELECT 1
      FROM conversations a WHERE a.role = 'assistant' AND a.conv_id = c.conv_id
      AND a.turn = c.turn + 1)"""
)
ORACLES["conversation_status"] = """SELECT conv_id, coalesce(
  max(turn) FILTER (WHERE role = 'assistant' AND length(text) > 200) IS NULL
  AND max(turn) FILTER (WHERE role = 'assistant') IS NOT NULL
  OR max(turn) FILTER (WHERE role = 'assistant' AND length(text) > 200)
  < max(turn) FILTER (WHERE role = 'assistant'), false) AS finished
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id"""
ORACLES["tool_dispatch"] = (
    _with(
        FAQ,
        FAQ_INDEX,
        CALLS,
        "asked AS (SELECT call_id AS query_id, text FROM calls)",
        _hits("hits", "doc_id", FAQ_BOOSTS, 5, IN_COURSE, asked="asked"),
    )
    + """ SELECT call_id, 'function_call_output' AS type, rank - 1 AS pos,
      doc_id, course, section, question, answer
      FROM calls LEFT JOIN (hits JOIN faq USING (doc_id)) ON query_id = call_id"""
)
ORACLES["tool_rejects"] = """SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id,
  CASE WHEN role = 'system' THEN 'unknown tool' WHEN role = 'assistant' THEN 'malformed arguments'
  WHEN turn = 2 THEN 'missing query' WHEN turn = 4 THEN 'query not a string'
  ELSE 'unexpected argument' END AS reason
  FROM conversations WHERE role <> 'user' OR turn <> 0"""
ORACLES["pooled_search"] = (
    _with(
        FAQ,
        FAQ_INDEX,
        """searches AS (SELECT item_id * 2 AS query_id, text FROM benchmark
        UNION ALL SELECT item_id * 2 + 1, split_part(text, chr(10), 1) FROM benchmark)""",
        _hits("hits", "doc_id", FAQ_BOOSTS, 5, asked="searches"),
    )
    + """ SELECT question_id, doc_id, score, found_by, rank FROM (SELECT *, row_number() OVER (
      PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT (query_id // 2)::bigint AS question_id, doc_id, max(score) AS score,
      count(*) AS found_by FROM hits GROUP BY ALL)) WHERE rank <= 5"""
)
