"""Reference SQL (DuckDB dialect) for the correctness oracle, as composable CTEs.

Each CTE is registered with its dependencies; :func:`query` pulls in everything a final
SELECT needs, in dependency order.  The SQL re-derives every table from the driver's
views (documents, benchmark, conversations, labels, embeddings) independently of Spark;
only the fixed word lists and suffix rules are shared with the engine.
"""

from __future__ import annotations

from parley.functions.text import ANALYZER_STOPWORDS, STOPWORDS
from parley.operators.conflation import MIN_DF, MIN_STEM_LENGTH, SUFFIX_RULES

_CTES: dict[str, tuple[tuple[str, ...], str, bool]] = {}


def cte(name: str, deps: tuple[str, ...], body: str, materialize: bool = False) -> None:
    _CTES[name] = (deps, body.strip(), materialize)


def query(final: str, *needs: str, replace: dict[str, tuple[tuple[str, ...], str, bool]] | None = None) -> str:
    """``final`` with every CTE it needs; ``replace`` swaps a CTE, whose own definition then
    goes by its name and a 0."""
    ctes = {**_CTES, **{f"{n}0": _CTES[n] for n in replace or {}}, **(replace or {})}
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in ctes[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final.strip()
    parts = []
    for n in order:
        _, body, mat = ctes[n]
        parts.append(f"{n} AS {'MATERIALIZED ' if mat else ''}(\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


def _list(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


STOP_SQL = _list(STOPWORDS)
ASTOP_SQL = _list(ANALYZER_STOPWORDS)
RULES_SQL = ", ".join(f"({i + 1}, '{s}', '{r}')" for i, (s, r) in enumerate(SUFFIX_RULES))


def norm_sql(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^0-9a-zA-Z]+', ' ', 'g'))"


def tok_array_sql(x: str) -> str:
    """T1+T2 as a list (may contain '' for empty input; filter after unnest)."""
    return f"string_split(trim({norm_sql(x)}), ' ')"


# ---------------------------------------------------------------- collection
cte("coll", (), """
SELECT CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'MARCO_' ELSE 'CAR_' END || CAST(doc_id AS VARCHAR) AS doc_id,
       CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN regexp_replace(text, '[\\t\\n\\r]', ' ', 'g')
            ELSE replace(text, chr(10), '') END AS text,
       CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'MARCO' ELSE 'CAR' END AS source,
       CAST(1 AS BIGINT) AS batch_id
FROM documents
""", True)

# ---------------------------------------------------------------- T1-T3 token rows
cte("tok", ("coll",), f"""
SELECT doc_id, pos, term FROM (
  SELECT doc_id, unnest(arr) AS term, generate_subscripts(arr, 1) AS pos
  FROM (SELECT doc_id, {tok_array_sql('text')} AS arr FROM coll)
) WHERE term <> '' AND term NOT IN ({STOP_SQL})
""", True)

cte("vocab", ("tok",), "SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term")
cte("vset", ("vocab",), f"SELECT term FROM vocab WHERE df >= {MIN_DF}", True)
cte("rules", (), f"SELECT * FROM (VALUES {RULES_SQL}) AS r(pri, suffix, repl)")
cte("conflation", ("vset", "rules"), f"""
SELECT v.term AS surface, coalesce(b.best, v.term) AS stem
FROM vset v LEFT JOIN (
  SELECT surface, min_by(cand, pri) AS best FROM (
    SELECT v.term AS surface, r.pri, left(v.term, length(v.term) - length(r.suffix)) || r.repl AS cand
    FROM vset v JOIN rules r ON right(v.term, length(r.suffix)) = r.suffix
    WHERE length(v.term) - length(r.suffix) >= {MIN_STEM_LENGTH}
  ) c WHERE cand IN (SELECT term FROM vset)
  GROUP BY surface
) b ON v.term = b.surface
""", True)
cte("stem_map", ("conflation",), "SELECT surface, stem FROM conflation WHERE stem <> surface", True)

# ---------------------------------------------------------------- T5 stored text
cte("stemmed", ("tok", "stem_map"), """
SELECT t.doc_id, t.pos, coalesce(m.stem, t.term) AS term FROM tok t LEFT JOIN stem_map m ON t.term = m.surface
""")
cte("cindex", ("coll", "stemmed"), """
SELECT c.doc_id, coalesce(d.data, '') AS data, c.source, c.batch_id
FROM coll c LEFT JOIN (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS data FROM stemmed GROUP BY doc_id) d
ON c.doc_id = d.doc_id
""", True)

# ---------------------------------------------------------------- T6 + index
cte("dtok", ("cindex",), """
SELECT doc_id, pos, term FROM (
  SELECT doc_id, unnest(arr) AS term, generate_subscripts(arr, 1) AS pos
  FROM (SELECT doc_id, string_split(data, ' ') AS arr FROM cindex)
) WHERE term <> ''
""", True)
cte("atok", ("dtok", "stem_map"), f"""
SELECT t.doc_id, t.pos, coalesce(m.stem, t.term) AS term
FROM dtok t LEFT JOIN stem_map m ON t.term = m.surface
WHERE t.term NOT IN ({ASTOP_SQL})
""")
cte("postings", ("atok",), """
SELECT doc_id, term, tf, sum(tf) OVER (PARTITION BY doc_id) AS dl
FROM (SELECT doc_id, term, count(*) AS tf FROM atok GROUP BY doc_id, term)
""", True)
cte("cstats", ("postings",), """
SELECT count(DISTINCT doc_id) AS n_docs, sum(tf) AS sum_dl,
       CAST(sum(tf) AS DOUBLE) / count(DISTINCT doc_id) AS avgdl, count(DISTINCT term) AS n_terms
FROM postings
""", True)
cte("tstats", ("postings", "cstats"), """
SELECT p.term, p.df, p.cf,
       ln(1.0::DOUBLE + (CAST(s.n_docs AS DOUBLE) - p.df + 0.5::DOUBLE) / (p.df + 0.5::DOUBLE)) AS idf
FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM postings GROUP BY term) p, cstats s
""", True)
cte("xstats", ("dtok",), """
SELECT term, count(*) AS df, sum(tf) AS cf FROM (SELECT doc_id, term, count(*) AS tf FROM dtok GROUP BY doc_id, term) GROUP BY term
""", True)
cte("xglob", ("xstats",), "SELECT sum(cf) AS c_tokens, count(*) AS v_terms FROM xstats")


# ---------------------------------------------------------------- query sets
def _turns_body(source: str) -> str:
    return f"""
SELECT topic, turn, manual,
       CASE WHEN lag(manual) OVER (PARTITION BY topic ORDER BY turn) IS NULL THEN manual
            ELSE lag(manual) OVER (PARTITION BY topic ORDER BY turn) || ' ' || manual END AS automatic
FROM ({source})
"""


cte("bench_turns", (), _turns_body(
    "SELECT CAST(floor(item_id / 12) AS BIGINT) AS topic, CAST(item_id % 12 + 1 AS BIGINT) AS turn, text AS manual FROM benchmark"
), True)
cte("conv_turns", (), _turns_body(
    "SELECT conv_id AS topic, CAST(turn AS BIGINT) AS turn, text AS manual FROM conversations WHERE role = 'user'"
), True)


def turns_cte(name: str, src: str, kind: str) -> None:
    """``name(qid, topic, turn, utterance)`` for a query set and an utterance kind."""
    col = {"Manual": "manual", "Automatic": "automatic"}[kind]
    cte(name, (src,), f"""
SELECT CAST(topic AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS qid, topic, turn, {col} AS utterance FROM {src}
""")


turns_cte("qm", "bench_turns", "Manual")
turns_cte("qa", "bench_turns", "Automatic")


def query_ctes(prefix: str, turns: str) -> None:
    """``{prefix}_rows`` (T1-T4), ``{prefix}_text`` (T5 text), ``{prefix}_terms`` (T6, qtf)."""
    cte(f"{prefix}_rows", (turns, "stem_map"), f"""
SELECT r.qid, r.pos, coalesce(m.stem, r.term) AS term FROM (
  SELECT qid, unnest(arr) AS term, generate_subscripts(arr, 1) AS pos
  FROM (SELECT qid, {tok_array_sql('utterance')} AS arr FROM {turns})
) r LEFT JOIN stem_map m ON r.term = m.surface
WHERE r.term <> '' AND r.term NOT IN ({STOP_SQL})
""", True)
    cte(f"{prefix}_text", (turns, f"{prefix}_rows"), f"""
SELECT t.qid, coalesce(x.query_text, '') AS query_text FROM {turns} t LEFT JOIN
  (SELECT qid, string_agg(term, ' ' ORDER BY pos) AS query_text FROM {prefix}_rows GROUP BY qid) x ON t.qid = x.qid
""")
    cte(f"{prefix}_terms", (f"{prefix}_rows", "stem_map"), f"""
SELECT r.qid, coalesce(m.stem, r.term) AS term, count(*) AS qtf
FROM {prefix}_rows r LEFT JOIN stem_map m ON r.term = m.surface
WHERE r.term NOT IN ({ASTOP_SQL})
GROUP BY r.qid, coalesce(m.stem, r.term)
""")


def bm25_ctes(prefix: str, turns: str, k: int, k1: float = 1.2, b: float = 0.75) -> str:
    """``{prefix}_bm25_{k}(qid, doc_id, score, rank)`` incl. the empty-query fallback."""
    name = f"{prefix}_bm25_{k}"
    if name in _CTES:
        return name
    if f"{prefix}_rows" not in _CTES:
        query_ctes(prefix, turns)
    cte(f"{prefix}_scores", (f"{prefix}_terms", "tstats", "postings", "cstats"), f"""
SELECT q.qid, p.doc_id,
       round(sum(CAST(q.qtf AS DOUBLE) * {k1 + 1.0!r}::DOUBLE * s.idf * CAST(p.tf AS DOUBLE)
                 / (CAST(p.tf AS DOUBLE) + {k1!r}::DOUBLE * ({1.0 - b!r}::DOUBLE + {b!r}::DOUBLE * CAST(p.dl AS DOUBLE) / c.avgdl))), 4) AS score
FROM {prefix}_terms q JOIN tstats s ON q.term = s.term JOIN postings p ON p.term = q.term, cstats c
GROUP BY q.qid, p.doc_id
""", True)
    cte(name, (f"{prefix}_scores", turns, f"{prefix}_rows", "coll"), f"""
SELECT qid, doc_id, score, rank FROM (
  SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id ASC) AS rank
  FROM {prefix}_scores
) WHERE rank <= {k}
UNION ALL
SELECT t.qid, f.doc_id, 1.0::DOUBLE AS score, f.rank FROM
  (SELECT qid FROM {turns} WHERE qid NOT IN (SELECT qid FROM {prefix}_rows)) t,
  (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM coll ORDER BY doc_id LIMIT {k}) f
""", True)
    return name


turns_cte("cm", "conv_turns", "Manual")
turns_cte("ca", "conv_turns", "Automatic")
# the first line of every document: some hold no term
cte("ln", (), """
SELECT CAST(doc_id AS VARCHAR) || '_1' AS qid, doc_id AS topic, CAST(1 AS BIGINT) AS turn, string_split(text, chr(10))[1] AS utterance FROM documents
""", True)

# ---------------------------------------------------------------- judgements (fixture)
cte("qrels", ("bench_turns", "coll"), f"""
SELECT s.qid, '0' AS iter, s.doc_id,
       CAST(CASE WHEN s.shared * 10 >= n.nq * 6 THEN 2 WHEN s.shared * 10 >= n.nq * 4 THEN 1 ELSE 0 END AS INTEGER) AS rel
FROM (
  SELECT q.qid, d.doc_id, count(*) AS shared
  FROM (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest({tok_array_sql('text')}) AS term FROM coll) WHERE term <> '') d
  JOIN (SELECT DISTINCT qid, term FROM (SELECT CAST(topic AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS qid,
                                               unnest({tok_array_sql('manual')}) AS term FROM bench_turns) WHERE term <> '') q
    ON d.term = q.term
  GROUP BY q.qid, d.doc_id
) s JOIN (
  SELECT qid, count(*) AS nq FROM (SELECT DISTINCT qid, term FROM (
     SELECT CAST(topic AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS qid, unnest({tok_array_sql('manual')}) AS term
     FROM bench_turns) WHERE term <> '') GROUP BY qid
) n ON s.qid = n.qid
WHERE s.shared * 10 >= n.nq * 3
""", True)


# ---------------------------------------------------------------- evaluation
def eval_ctes(prefix: str, run: str) -> str:
    """``{prefix}_pq(qid, r_1000, map_1000, mrr_1000, ndcg_1000, ndcg_3)`` per judged query."""
    name = f"{prefix}_pq"
    if name in _CTES:
        return name
    cte("judged", ("qrels",), """
SELECT qid, sum(CASE WHEN rel >= 2 THEN 1 ELSE 0 END) AS n_rel,
       sum(CASE WHEN i <= 1000 THEN CAST(greatest(rel, 0) AS DOUBLE) / log2(CAST(i AS DOUBLE) + 1.0::DOUBLE) ELSE 0.0::DOUBLE END) AS idcg_deep,
       sum(CASE WHEN i <= 3 THEN CAST(greatest(rel, 0) AS DOUBLE) / log2(CAST(i AS DOUBLE) + 1.0::DOUBLE) ELSE 0.0::DOUBLE END) AS idcg_shallow
FROM (SELECT qid, doc_id, rel, row_number() OVER (PARTITION BY qid ORDER BY rel DESC) AS i FROM qrels)
GROUP BY qid
""", True)
    cte(f"{prefix}_rs", (run, "qrels"), f"""
SELECT qid, sum(hit) AS n_hit,
       sum(CASE WHEN hit = 1 THEN CAST(cum AS DOUBLE) / r ELSE 0.0::DOUBLE END) AS ap_num,
       max(CASE WHEN hit = 1 THEN 1.0::DOUBLE / r ELSE 0.0::DOUBLE END) AS rr,
       sum(g) AS dcg_deep, sum(CASE WHEN r <= 3 THEN g ELSE 0.0::DOUBLE END) AS dcg_shallow
FROM (
  SELECT *, sum(hit) OVER (PARTITION BY qid ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         CAST(greatest(coalesce(rel, 0), 0) AS DOUBLE) / log2(CAST(r AS DOUBLE) + 1.0::DOUBLE) AS g
  FROM (
    SELECT x.qid, x.doc_id, x.r, q.rel, CASE WHEN q.rel >= 2 THEN 1 ELSE 0 END AS hit
    FROM (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id DESC) AS r FROM {run}) x
    LEFT JOIN qrels q ON x.qid = q.qid AND x.doc_id = q.doc_id
    WHERE x.r <= 1000
  )
) GROUP BY qid
""", True)
    cte(name, ("judged", f"{prefix}_rs"), f"""
SELECT j.qid,
  CASE WHEN j.n_rel > 0 THEN CAST(coalesce(s.n_hit, 0) AS DOUBLE) / j.n_rel ELSE 0.0::DOUBLE END AS r_1000,
  CASE WHEN j.n_rel > 0 THEN coalesce(s.ap_num, 0.0::DOUBLE) / j.n_rel ELSE 0.0::DOUBLE END AS map_1000,
  coalesce(s.rr, 0.0::DOUBLE) AS mrr_1000,
  CASE WHEN j.idcg_deep > 0 THEN coalesce(s.dcg_deep, 0.0::DOUBLE) / j.idcg_deep ELSE 0.0::DOUBLE END AS ndcg_1000,
  CASE WHEN j.idcg_shallow > 0 THEN coalesce(s.dcg_shallow, 0.0::DOUBLE) / j.idcg_shallow ELSE 0.0::DOUBLE END AS ndcg_3
FROM judged j LEFT JOIN {prefix}_rs s ON j.qid = s.qid
""", True)
    return name


# ---------------------------------------------------------------- re-ranking
cte("nall", ("cindex",), "SELECT count(*) AS n_all FROM cindex")
_IDF0 = "ln(1.0::DOUBLE + (CAST(n.n_all AS DOUBLE) - 0.0::DOUBLE + 0.5::DOUBLE) / (0.0::DOUBLE + 0.5::DOUBLE))"
cte("xidf", ("xstats", "nall"), """
SELECT x.term, ln(1.0::DOUBLE + (CAST(n.n_all AS DOUBLE) - x.df + 0.5::DOUBLE) / (x.df + 0.5::DOUBLE)) AS idf
FROM xstats x, nall n
""", True)
cte("idf0", ("nall",), f"SELECT {_IDF0} AS idf0 FROM nall n")


def _slot_sql(t: str) -> str:
    return f"CAST(CAST(('0x' || substr(md5({t}), 1, 8)) AS BIGINT) % 256 AS INTEGER)"


def _sign_sql(t: str) -> str:
    return f"CASE WHEN CAST(('0x' || substr(md5({t}), 9, 1)) AS INTEGER) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END"


def vec_ctes(name: str, src: str, key: str, text: str) -> None:
    """``name(key, slot, v)``: hashed, L2-normalised encoder weights of ``src.text``."""
    cte(f"{name}_w", (src, "xidf", "idf0"), f"""
SELECT {key}, slot, sum(w) AS w FROM (
  SELECT t.{key}, {_slot_sql('t.term')} AS slot,
         (1.0::DOUBLE + ln(CAST(t.tf AS DOUBLE))) * coalesce(i.idf, z.idf0) * {_sign_sql('t.term')} AS w
  FROM (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(string_split({text}, ' ')) AS term FROM {src})
        WHERE term <> '' GROUP BY {key}, term) t
  LEFT JOIN xidf i ON t.term = i.term, idf0 z
) GROUP BY {key}, slot
""", True)
    cte(name, (f"{name}_w",), f"""
SELECT w.{key}, w.slot, CASE WHEN n.norm > 0 THEN w.w / n.norm ELSE 0.0::DOUBLE END AS v
FROM {name}_w w JOIN (SELECT {key}, sqrt(sum(w * w)) AS norm FROM {name}_w GROUP BY {key}) n ON w.{key} = n.{key}
""", True)


vec_ctes("dvec", "cindex", "doc_id", "data")


def dot_cte(prefix: str, pairs: str) -> str:
    """``{pairs}_dot(qid, doc_id, base_score, base_rank, score)``: bi-encoder scores of a candidate list."""
    name = f"{pairs}_dot"
    if name in _CTES:
        return name
    if f"{prefix}_qvec" not in _CTES:
        vec_ctes(f"{prefix}_qvec", f"{prefix}_text", "qid", "query_text")
    cte(name, (pairs, f"{prefix}_qvec", "dvec"), f"""
SELECT p.qid, p.doc_id, p.score AS base_score, p.rank AS base_rank, round(coalesce(d.s, 0.0::DOUBLE), 4) + 0.0::DOUBLE AS score
FROM {pairs} p LEFT JOIN (
  SELECT p.qid, p.doc_id, sum(q.v * d.v) AS s
  FROM {pairs} p JOIN {prefix}_qvec q ON p.qid = q.qid JOIN dvec d ON d.doc_id = p.doc_id AND d.slot = q.slot
  GROUP BY p.qid, p.doc_id
) d ON p.qid = d.qid AND p.doc_id = d.doc_id
""", True)
    return name


def feature_ctes(prefix: str, pairs: str) -> str:
    """``{pairs}_feat``: the pair scorer's features over a candidate list."""
    name = f"{pairs}_feat"
    if name in _CTES:
        return name
    dots = dot_cte(prefix, pairs)
    cte(f"{prefix}_qtok", (f"{prefix}_text",), f"""
SELECT qid, pos, term FROM (
  SELECT qid, unnest(arr) AS term, generate_subscripts(arr, 1) AS pos FROM (SELECT qid, string_split(query_text, ' ') AS arr FROM {prefix}_text)
) WHERE term <> ''
""", True)
    cte(f"{prefix}_qd", (f"{prefix}_qtok", "xidf", "idf0"), f"""
SELECT q.qid, q.term, coalesce(i.idf, z.idf0) AS idf FROM (SELECT DISTINCT qid, term FROM {prefix}_qtok) q
LEFT JOIN xidf i ON q.term = i.term, idf0 z
""", True)
    cte(f"{prefix}_qb", (f"{prefix}_qtok",), f"""
SELECT DISTINCT qid, a, b FROM (SELECT qid, term AS a, lead(term) OVER (PARTITION BY qid ORDER BY pos) AS b FROM {prefix}_qtok)
WHERE b IS NOT NULL
""", True)
    cte(f"{prefix}_qn", (f"{prefix}_text", f"{prefix}_qtok", f"{prefix}_qd"), f"""
SELECT t.qid, coalesce(a.nq, 0) AS nq, coalesce(b.nd, 0) AS nq_distinct, coalesce(b.it, 0.0::DOUBLE) AS idf_total,
       greatest(512 - coalesce(a.nq, 0) - 3, 0) AS budget
FROM {prefix}_text t
LEFT JOIN (SELECT qid, count(*) AS nq FROM {prefix}_qtok GROUP BY qid) a ON t.qid = a.qid
LEFT JOIN (SELECT qid, count(*) AS nd, sum(idf) AS it FROM {prefix}_qd GROUP BY qid) b ON t.qid = b.qid
""", True)
    cte(f"{pairs}_hits", (pairs, f"{prefix}_qn", f"{prefix}_qd", "dtok"), f"""
SELECT p.qid, p.doc_id, d.pos, d.term, q.idf
FROM {pairs} p JOIN {prefix}_qn n ON p.qid = n.qid JOIN {prefix}_qd q ON q.qid = p.qid
JOIN dtok d ON d.doc_id = p.doc_id AND d.term = q.term
WHERE d.pos <= n.budget
""", True)
    cte(name, (pairs, f"{prefix}_qn", f"{pairs}_hits", f"{prefix}_qb", dots, "cindex"), f"""
SELECT p.qid, p.doc_id, p.score AS bm25, p.rank AS base_rank,
  CASE WHEN n.nq_distinct > 0 THEN CAST(coalesce(c.n_found, 0) AS DOUBLE) / n.nq_distinct ELSE 0.0::DOUBLE END AS coverage,
  CASE WHEN n.idf_total > 0 THEN coalesce(c.idf_found, 0.0::DOUBLE) / n.idf_total ELSE 0.0::DOUBLE END AS idf_coverage,
  CAST(coalesce(g.bigrams, 0) AS BIGINT) AS bigrams,
  ln(1.0::DOUBLE + CAST(least(CASE WHEN x.data = '' THEN 0 ELSE len(string_split(x.data, ' ')) END, n.budget) AS DOUBLE)) AS log_len,
  coalesce(o.score, 0.0::DOUBLE) AS dot
FROM {pairs} p JOIN {prefix}_qn n ON p.qid = n.qid
LEFT JOIN (SELECT qid, doc_id, count(*) AS n_found, sum(idf) AS idf_found
           FROM (SELECT DISTINCT qid, doc_id, term, idf FROM {pairs}_hits) GROUP BY qid, doc_id) c
  ON p.qid = c.qid AND p.doc_id = c.doc_id
LEFT JOIN (SELECT qid, doc_id, count(*) AS bigrams FROM (
             SELECT DISTINCT h.qid, h.doc_id, h.a, h.b FROM (
               SELECT qid, doc_id, term AS a, lead(term) OVER w AS b, lead(pos) OVER w - pos AS gap
               FROM {pairs}_hits WINDOW w AS (PARTITION BY qid, doc_id ORDER BY pos)
             ) h JOIN {prefix}_qb qb ON qb.qid = h.qid AND qb.a = h.a AND qb.b = h.b
             WHERE h.gap = 1
           ) GROUP BY qid, doc_id) g ON p.qid = g.qid AND p.doc_id = g.doc_id
LEFT JOIN {dots} o ON p.qid = o.qid AND p.doc_id = o.doc_id
LEFT JOIN cindex x ON x.doc_id = p.doc_id
""", True)
    return name


def pair_score_sql(f: str = "") -> str:
    return (f"round(0.0::DOUBLE + 0.1::DOUBLE * {f}bm25 + 2.0::DOUBLE * {f}coverage + 3.0::DOUBLE * {f}idf_coverage"
            f" + 0.25::DOUBLE * CAST({f}bigrams AS DOUBLE) + -0.05::DOUBLE * {f}log_len + 1.0::DOUBLE * {f}dot, 4) + 0.0::DOUBLE")


def ql_cte(prefix: str, turns: str, pairs: str) -> str:
    """``{pairs}_ql(qid, doc_id, base_score, base_rank, score)``: Dirichlet query likelihood."""
    name = f"{pairs}_ql"
    if name in _CTES:
        return name
    cte(f"{prefix}_qp", (turns, "xstats", "xglob"), f"""
SELECT q.qid, q.term, q.qtf,
       2000.0::DOUBLE * (CAST(coalesce(x.cf, 0) AS DOUBLE) + 0.5::DOUBLE) / (CAST(g.c_tokens AS DOUBLE) + 0.5::DOUBLE * (CAST(g.v_terms AS DOUBLE) + 1.0::DOUBLE)) AS mupc
FROM (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({tok_array_sql('utterance')}) AS term FROM {turns})
      WHERE term <> '' GROUP BY qid, term) q
LEFT JOIN xstats x ON q.term = x.term, xglob g
""", True)
    cte(name, (pairs, f"{prefix}_qp", "dtok", "cindex"), f"""
SELECT p.qid, p.doc_id, p.score AS base_score, p.rank AS base_rank,
  round(coalesce(f.fg, 0.0::DOUBLE) + coalesce(b.bg, 0.0::DOUBLE)
        - CAST(coalesce(b.qlen, 0) AS DOUBLE) * log10(CAST(CASE WHEN x.data = '' THEN 0 ELSE len(string_split(x.data, ' ')) END AS DOUBLE) + 2000.0::DOUBLE), 4) AS score
FROM {pairs} p
LEFT JOIN (SELECT qid, sum(qtf * log10(mupc)) AS bg, sum(qtf) AS qlen FROM {prefix}_qp GROUP BY qid) b ON p.qid = b.qid
LEFT JOIN (SELECT p.qid, p.doc_id, sum(q.qtf * log10(1.0::DOUBLE + d.tf / q.mupc)) AS fg
           FROM {pairs} p JOIN {prefix}_qp q ON p.qid = q.qid
           JOIN (SELECT doc_id, term, count(*) AS tf FROM dtok GROUP BY doc_id, term) d ON d.doc_id = p.doc_id AND d.term = q.term
           GROUP BY p.qid, p.doc_id) f ON p.qid = f.qid AND p.doc_id = f.doc_id
LEFT JOIN cindex x ON x.doc_id = p.doc_id
""", True)
    return name


def ranked_sql(src: str, k: int | None) -> str:
    cut = f"WHERE rank <= {k}" if k is not None else ""
    return f"""SELECT qid, doc_id, score, rank FROM (
  SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, base_rank ASC) AS rank FROM {src}
) {cut}"""
