"""Oracle SQL per registered query (DuckDB over the driver's views)."""

from __future__ import annotations

from parley.oracle.ctes import bm25_ctes, query

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


_bm = bm25_ctes("qm", "qm", 500)
oracle("bm25_retrieve", query(f"SELECT qid, doc_id, score, CAST(rank AS BIGINT) AS rank FROM {_bm}", _bm))

from parley.oracle.ctes import ASTOP_SQL, STOP_SQL, norm_sql, query_ctes, tok_array_sql  # noqa: E402

# ----------------------------------------------------------------------------- sources
_COLL = "SELECT doc_id, text, source, batch_id FROM coll"
oracle("load_passages", "SELECT 'MARCO_' || CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(text, '[\\t\\n\\r]', ' ', 'g') AS text, 'MARCO' AS source, CAST(1 AS BIGINT) AS batch_id FROM documents")
oracle("load_paragraphs", "SELECT 'CAR_' || CAST(doc_id AS VARCHAR) AS doc_id, replace(text, chr(10), '') AS text, 'CAR' AS source, CAST(1 AS BIGINT) AS batch_id FROM documents")
oracle("union_collections", query(_COLL, "coll"))
_BATCH = """
    SELECT c.doc_id, 'updated ' || c.text AS text, c.source, CAST(2 AS BIGINT) AS batch_id FROM coll c
      WHERE regexp_replace(c.doc_id, '^(MARCO|CAR)_', '') IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
    UNION ALL
    SELECT 'MARCO_B' || CAST(item_id AS VARCHAR), text, 'MARCO', CAST(2 AS BIGINT) FROM benchmark
"""
_UPSERTED = f"""
SELECT doc_id, text, source, batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY batch_id DESC, text DESC) AS rn FROM (
    SELECT doc_id, text, source, batch_id FROM coll
    UNION ALL {_BATCH}
  )
) WHERE rn = 1
"""
oracle("replace_collection", query(_BATCH, "coll"))
oracle("upsert_collection", query(_UPSERTED, "coll"))
oracle("upsert_stored", query(_UPSERTED, "coll"))
oracle("ingest_counts", """
SELECT s.source, count(*) AS n_read, CAST(0 AS BIGINT) AS n_rejected, count(DISTINCT doc_id) AS n_written
FROM documents, (VALUES ('MARCO'), ('CAR')) s(source) GROUP BY s.source
""")
oracle("collection_counts", query("SELECT source, count(*) AS n_docs FROM coll GROUP BY source", "coll"))
oracle("load_topics", query("SELECT topic, turn, manual, automatic FROM conv_turns", "conv_turns"))
oracle("load_qrels", query("SELECT qid, iter, doc_id, rel FROM qrels", "qrels"))
oracle("write_run", query(
    f"SELECT qid || ' Q0 ' || doc_id || ' ' || CAST(rank AS VARCHAR) || ' ' || printf('%.4f', score) || ' Manual' AS line FROM {_bm}", _bm))
oracle("load_run", query(
    f"SELECT qid, 'Q0' AS q0, doc_id, CAST(rank AS INTEGER) AS rank, score, 'Manual' AS tag FROM {_bm}", _bm))

# ----------------------------------------------------------------------------- text
oracle("normalize", query(f"SELECT doc_id, {norm_sql('text')} AS norm FROM coll", "coll"))
_TOKS = f"list_filter({tok_array_sql('text')}, lambda x: x <> '')"
oracle("tokenize", query(f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {_TOKS} AS t FROM coll)", "coll"))
oracle("remove_stopwords", query(
    f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens FROM "
    f"(SELECT doc_id, list_filter({_TOKS}, lambda x: x NOT IN ({STOP_SQL})) AS t FROM coll)", "coll"))
oracle("build_conflation", query("SELECT surface, stem FROM conflation", "conflation"))
oracle("conflate", query("SELECT qid, query_text FROM qm_text", "qm_text"))
oracle("preprocess", query("SELECT doc_id, data FROM cindex", "cindex"))
oracle("analyze", query("""
SELECT c.doc_id, coalesce(a.terms, '') AS terms FROM cindex c LEFT JOIN
  (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS terms FROM atok GROUP BY doc_id) a ON c.doc_id = a.doc_id
""", "cindex", "atok"))

# ----------------------------------------------------------------------------- index
oracle("postings", query("SELECT doc_id, term, tf, CAST(dl AS BIGINT) AS dl FROM postings", "postings"))
oracle("term_vectors", query(
    "SELECT doc_id, string_agg(term || ':' || CAST(tf AS VARCHAR), ' ' ORDER BY term) AS vector FROM postings GROUP BY doc_id",
    "postings"))
oracle("doc_lengths", query("SELECT doc_id, CAST(sum(tf) AS BIGINT) AS dl FROM postings GROUP BY doc_id", "postings"))
oracle("term_stats", query("SELECT term, df, CAST(cf AS BIGINT) AS cf, round(idf, 6) AS idf FROM tstats", "tstats"))
oracle("coll_stats", query(
    "SELECT n_docs, CAST(sum_dl AS BIGINT) AS sum_dl, round(avgdl, 6) AS avgdl, n_terms FROM cstats", "cstats"))

# ----------------------------------------------------------------------------- retrieval
oracle("select_utterance", query("SELECT topic, turn, utterance FROM ca", "ca"))
oracle("make_qid", query("SELECT qid, topic, turn FROM cm", "cm"))
oracle("query_terms", query("SELECT qid, term, qtf FROM qm_terms", "qm_terms"))
oracle("match_any", query("""
SELECT q.qid, p.doc_id, count(*) AS n_terms
FROM qm_terms q JOIN tstats s ON q.term = s.term JOIN postings p ON p.term = q.term
GROUP BY q.qid, p.doc_id
""", "qm_terms", "tstats", "postings"))
oracle("bm25_score", query("SELECT qid, doc_id, score FROM qm_scores", "qm_scores"))
oracle("top_k", query("""
SELECT qid, doc_id, score, rank FROM (
  SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id ASC) AS rank FROM qm_scores
) WHERE rank <= 500
""", "qm_scores"))
_cbm = bm25_ctes("cm", "cm", 500)
query_ctes("ln", "ln")
oracle("empty_query_fallback", query("""
SELECT t.qid, f.doc_id, 1.0::DOUBLE AS score, f.rank FROM
  (SELECT qid FROM ln WHERE qid NOT IN (SELECT qid FROM ln_rows)) t,
  (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM coll ORDER BY doc_id LIMIT 500) f
""", "ln", "ln_rows", "coll"))
_abm = bm25_ctes("qa", "qa", 500)
oracle("bm25_automatic", query(f"SELECT qid, doc_id, score, rank FROM {_abm}", _abm))
# the same SQL over the collection with its update batch applied
_AFTER = {"coll": (("coll0",), _UPSERTED.replace("FROM coll", "FROM coll0"), True)}
for _key in ("bm25_upserted", "bm25_compacted"):
    oracle(_key, query(f"SELECT qid, doc_id, score, rank FROM {_bm}", _bm, replace=_AFTER))
oracle("upserted_term_stats", query("SELECT term, df, CAST(cf AS BIGINT) AS cf, round(idf, 6) AS idf FROM tstats", "tstats", replace=_AFTER))
oracle("bm25_topics", query(f"SELECT qid, doc_id, score, rank FROM {_cbm}", _cbm))
oracle("fetch_documents", query(
    f"SELECT b.qid, b.doc_id, b.rank, CAST(CASE WHEN c.data = '' THEN 0 ELSE len(string_split(c.data, ' ')) END AS BIGINT) AS n_tokens, c.data "
    f"FROM {_bm} b JOIN cindex c ON b.doc_id = c.doc_id", _bm, "cindex"))

# ----------------------------------------------------------------------------- evaluation
from parley.oracle.ctes import eval_ctes  # noqa: E402

_pq = eval_ctes("ev_bm", _bm)
for _key, _col in (("eval_recall", "r_1000"), ("eval_map", "map_1000"), ("eval_mrr", "mrr_1000"),
                   ("eval_ndcg_1000", "ndcg_1000"), ("eval_ndcg_3", "ndcg_3")):
    oracle(_key, query(f"SELECT qid, round({_col}, 6) AS {_col} FROM {_pq}", _pq))
_M = ("r_1000", "map_1000", "mrr_1000", "ndcg_1000", "ndcg_3")
oracle("evaluate", query(
    "SELECT count(*) AS n_queries, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in _M) + f" FROM {_pq}", _pq))
oracle("evaluate_by_turn", query(
    f"SELECT turn, count(*) AS n_queries, round(avg(ndcg_3), 6) AS ndcg_3 FROM "
    f"(SELECT CAST(split_part(qid, '_', 2) AS BIGINT) AS turn, ndcg_3 FROM {_pq}) WHERE turn <= 10 GROUP BY turn", _pq))
oracle("evaluate_by_topic", query(
    f"SELECT topic, count(*) AS n_queries, round(avg(ndcg_3), 6) AS ndcg_3 FROM "
    f"(SELECT CAST(split_part(qid, '_', 1) AS BIGINT) AS topic, ndcg_3 FROM {_pq}) GROUP BY topic", _pq))

# ----------------------------------------------------------------------------- re-ranking
from parley.oracle.ctes import dot_cte, feature_ctes, pair_score_sql, ql_cte, ranked_sql  # noqa: E402

_bm_deep = bm25_ctes("qm", "qm", 2500)
_dot = dot_cte("qm", _bm)
_feat = feature_ctes("qm", _bm_deep)
_ql = ql_cte("qm", "qm", _bm)
oracle("build_pairs", query(
    f"SELECT b.qid, b.doc_id, b.rank AS base_rank, t.query_text, c.data FROM {_bm} b "
    "JOIN qm_text t ON b.qid = t.qid JOIN cindex c ON b.doc_id = c.doc_id", _bm, "qm_text", "cindex"))
oracle("embed", query("SELECT doc_id, CAST(slot AS BIGINT) AS slot, round(v, 6) AS weight FROM dvec WHERE round(v, 6) <> 0", "dvec"))
oracle("dot_rerank", query(f"SELECT qid, doc_id, score FROM {_dot}", _dot))
oracle("rank_by_score", query(ranked_sql(_dot, 500), _dot))
oracle("rerank_same_depth", query(ranked_sql(_dot, 500), _dot))
_F = ("bm25", "coverage", "idf_coverage", "log_len", "dot")
oracle("pair_features", query(
    "SELECT qid, doc_id, bigrams, " + ", ".join(f"round({x}, 6) + 0.0::DOUBLE AS {x}" for x in _F) + f" FROM {_feat}", _feat))
oracle("pair_rerank", query(f"SELECT qid, doc_id, {pair_score_sql()} AS score FROM {_feat}", _feat))
_deep_scored = f"(SELECT qid, doc_id, base_rank, {pair_score_sql()} AS score FROM {_feat})"
oracle("deep_rank", query(ranked_sql(_deep_scored, 500), _feat))
oracle("query_likelihood", query(f"SELECT qid, doc_id, score FROM {_ql}", _ql))
oracle("ql_rerank", query(ranked_sql(_ql, None), _ql))
_adot, _afeat = dot_cte("qa", _abm), feature_ctes("qa", bm25_ctes("qa", "qa", 2500))
_aql = ql_cte("qa", "qa", _abm)
oracle("rerank_same_depth_automatic", query(ranked_sql(_adot, 500), _adot))
oracle("deep_rank_automatic", query(ranked_sql(f"(SELECT qid, doc_id, base_rank, {pair_score_sql()} AS score FROM {_afeat})", 500), _afeat))
oracle("ql_rerank_automatic", query(ranked_sql(_aql, None), _aql))
oracle("rerank_policy", query(
    f"SELECT *, 'bi_encoder' AS model FROM ({ranked_sql(_dot, 500)}) UNION ALL "
    f"SELECT *, 'cross_encoder' AS model FROM ({ranked_sql(_deep_scored, 500)})", _dot, _feat))

# ----------------------------------------------------------------------------- compare systems
from parley.oracle.ctes import cte  # noqa: E402


def _system_pq(prefix: str, kind: str) -> list[tuple[str, str, str]]:
    shallow, deep = bm25_ctes(prefix, prefix, 500), bm25_ctes(prefix, prefix, 2500)
    d, f, q = dot_cte(prefix, shallow), feature_ctes(prefix, deep), ql_cte(prefix, prefix, shallow)
    runs = {
        "bm25": (f"SELECT qid, doc_id, score FROM {shallow}", (shallow,)),
        "bert_rerank": (ranked_sql(d, 500), (d,)),
        "bert_deep": (ranked_sql(f"(SELECT qid, doc_id, base_rank, {pair_score_sql()} AS score FROM {f})", 500), (f,)),
        "t5": (ranked_sql(q, None), (q,)),
    }
    out = []
    for system, (body, deps) in runs.items():
        name = f"run_{system}_{prefix}"
        cte(name, deps, body, True)
        out.append((system, kind, eval_ctes(f"ev_{system}_{prefix}", name)))
    return out


_pqs = _system_pq("qm", "Manual") + _system_pq("qa", "Automatic")
_union = " UNION ALL ".join(
    f"SELECT '{s}' AS system, '{k}' AS kind, CAST(split_part(qid, '_', 2) AS BIGINT) AS turn, "
    f"CAST(split_part(qid, '_', 1) AS BIGINT) AS topic, {', '.join(_M)} FROM {pq}" for s, k, pq in _pqs)
_avg = ", ".join(f"round(avg({m}), 6) AS {m}" for m in _M)
oracle("compare_systems", query(f"""
SELECT system, kind, 'all' AS scope, CAST(NULL AS BIGINT) AS grp, count(*) AS n_queries, {_avg} FROM ({_union}) GROUP BY system, kind
UNION ALL
SELECT system, kind, 'turn', turn, count(*), {_avg} FROM ({_union}) WHERE turn <= 10 GROUP BY system, kind, turn
UNION ALL
SELECT system, kind, 'topic', topic, count(*), {_avg} FROM ({_union}) GROUP BY system, kind, topic
""", *[pq for _, _, pq in _pqs]))

# ----------------------------------------------------------------------------- dense vectors
oracle("embedding_topk", """
WITH ex AS (
  SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
), cent AS (
  SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM ex GROUP BY label, i
), sc AS (
  SELECT e.vec_id, e.label, round(sum(CAST(e.x AS DOUBLE) * c.c), 4) + 0.0::DOUBLE AS score
  FROM ex e JOIN cent c ON e.label = c.label AND e.i = c.i GROUP BY e.vec_id, e.label
)
SELECT label, vec_id, score, rank FROM (
  SELECT label, vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id ASC) AS rank FROM sc
) WHERE rank <= 10
""")

# ----------------------------------------------------------------------------- streaming ingest
oracle("stream_ingest", """
WITH p AS (
  SELECT 'MARCO_' || CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(text, '[\\t\\n\\r]', ' ', 'g') AS text,
         CAST(doc_id AS VARCHAR) AS raw_id
  FROM documents
), allrows AS (
  SELECT doc_id, text, 'MARCO' AS source, CAST(1 AS BIGINT) AS batch_id FROM p
  UNION ALL
  SELECT doc_id, 'updated ' || text, 'MARCO', CAST(2 AS BIGINT) FROM p WHERE raw_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
  UNION ALL
  SELECT 'MARCO_B' || CAST(item_id AS VARCHAR), regexp_replace(text, '[\\t\\n\\r]', ' ', 'g'), 'MARCO', CAST(2 AS BIGINT) FROM benchmark
)
SELECT doc_id, text, source, batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY batch_id DESC, text DESC) AS rn FROM allrows
) WHERE rn = 1
""")
