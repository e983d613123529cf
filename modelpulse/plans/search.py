"""Queries for chunking, retrieval and its quality, routing, caching and BLEU."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.operators import quantised as Q
from modelpulse.operators import retrieval as RT
from modelpulse.plans.registry import query
from modelpulse.session import pin, scratch_path
from modelpulse.sources.tables import load, load_texts


@query(
    """
WITH t AS (SELECT doc_id, regexp_extract_all(text, '\\S+') AS w FROM documents),
c AS (SELECT doc_id, w, unnest(range(0, CAST(greatest(ceil((len(w) - 512) / 462.0), 0) AS BIGINT) + 1)) AS chunk FROM t WHERE len(w) > 0)
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(len(w[chunk * 462 + 1 : chunk * 462 + 512]) AS INTEGER) AS n_words,
       md5(array_to_string(w[chunk * 462 + 1 : chunk * 462 + 512], ' ')) AS digest FROM c"""
)
def document_chunks(spark, sf_dir):
    pieces = RT.chunks(load_texts(spark, sf_dir, "documents"), "doc_id", "text")
    return pieces.select("doc_id", "chunk", "n_words", F.md5("text").alias("digest"))


BM25 = """
dtok AS (SELECT doc_id, regexp_extract_all(lower(text), '\\S+') AS w FROM documents),
st AS (SELECT count(*) AS n, avg(len(w)) AS mean_len FROM dtok),
qt AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '\\S+'))) AS term FROM benchmark),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM dtok)
       WHERE term IN (SELECT term FROM qt) GROUP BY doc_id, len, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
lex AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean_len))), 6) AS score
        FROM tf JOIN dfs USING (term) JOIN qt USING (term), st GROUP BY item_id, doc_id),
lex_ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM lex)
"""
VECTOR = """
vec_ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM (
  SELECT q.vec_id AS item_id, d.vec_id AS doc_id,
         round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q JOIN benchmark ON item_id = q.vec_id, embeddings d))
"""
# Candidates that are ranked again by their vectors.
DEPTH = 100
FUSED = """
fused AS (SELECT item_id, doc_id, round(sum(1.0 / (60 + rank)), 9) AS score FROM (
  SELECT item_id, doc_id, rank FROM lex_ranked UNION ALL SELECT item_id, doc_id, rank FROM vec_ranked) GROUP BY item_id, doc_id),
fused_ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM fused)
"""
RERANKED = f"""
reranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM (
  SELECT c.item_id, c.doc_id,
         coalesce(round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6), -1.0) AS score
  FROM (SELECT * FROM lex_ranked WHERE rank <= {DEPTH}) c LEFT JOIN embeddings q ON q.vec_id = c.item_id
  LEFT JOIN embeddings d ON d.vec_id = c.doc_id))
"""


def _lexical_scores(spark, sf_dir) -> RT.Bm25Scores:
    return RT.bm25_scores(
        load_texts(spark, sf_dir, "documents"), "doc_id", "text", load(spark, sf_dir, "benchmark"), "item_id", "text"
    )


def _lexical(spark, sf_dir, k) -> DataFrame:
    return RT.top_per_query(_lexical_scores(spark, sf_dir), "item_id", "doc_id", k)


def _item_vectors(spark, sf_dir) -> DataFrame:
    """The vector that stands for each benchmark item; the tables share no other key."""
    vectors = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    items = load(spark, sf_dir, "benchmark").select("item_id")
    return vectors.join(RT.small(items, RT.table_bytes(items)), "item_id")


def _document_vectors(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def _vector(spark, sf_dir, k) -> DataFrame:
    return RT.vector_candidates(
        _document_vectors(spark, sf_dir), "doc_id", "embedding", _item_vectors(spark, sf_dir), "item_id", "embedding", k
    )


@query(f"WITH {BM25} SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM lex_ranked WHERE rank <= 10")
def lexical_search(spark, sf_dir):
    return _lexical(spark, sf_dir, 10)


@query(
    """
WITH long AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centre AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM long GROUP BY label, i) GROUP BY label),
scored AS (SELECT c.label, vec_id, round(list_cosine_similarity(c, embedding::DOUBLE[]), 6) AS score FROM centre c, embeddings),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT CAST(label AS BIGINT) AS label, vec_id, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10"""
)
def vector_search(spark, sf_dir):
    """The ten vectors nearest to the mean vector of each label."""
    vectors = load(spark, sf_dir, "embeddings")
    # Means by position, whatever the width of the vectors.
    long = vectors.select(F.col("label").cast("bigint").alias("label"), F.posexplode("embedding").alias("pos", "x"))
    means = long.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    means = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("m")).select("label", F.col("m.mean").alias("centre"))
    return RT.vector_candidates(vectors.drop("label"), "vec_id", "embedding", means, "label", "centre", 10)


def _approximate(spark, sf_dir, approximate=True):
    """Ten near vectors for every vector whose id is divisible by 20, among all vectors."""
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = vectors.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_asked"))
    centers = RT.cell_centers(vectors, "vec_id", "embedding") if approximate else None
    return RT.vector_candidates(vectors, "vec_id", "embedding", asked, "query_id", "_asked", 10, centers=centers)


@query()
def approximate_vector_search(spark, sf_dir):
    return _approximate(spark, sf_dir)


@query("SELECT 10 * count(*) AS wanted, true AS reached FROM embeddings WHERE vec_id % 20 = 0")
def approximate_search_recall(spark, sf_dir):
    measured = RT.recall(_approximate(spark, sf_dir), _approximate(spark, sf_dir, False), "query_id", "vec_id")
    return measured.select("wanted", (F.col("recall") >= 0.9).alias("reached"))


def _quantised(spark, sf_dir):
    """The same ten neighbours by codes of eight bytes, stored once, and the vectors of the best alone."""
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = vectors.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_asked"))
    books = Q.fit_codebooks(vectors, "vec_id", "embedding")
    path = scratch_path(spark, "vector-codes")
    Q.coded(vectors, "vec_id", "embedding", books).write.parquet(path)
    return Q.quantised_candidates(vectors, "vec_id", "embedding", spark.read.parquet(path), books, asked, "query_id", "_asked", 10)


@query()
def quantised_vector_search(spark, sf_dir):
    return _quantised(spark, sf_dir)


@query("SELECT 10 * count(*) AS wanted, true AS reached FROM embeddings WHERE vec_id % 20 = 0")
def quantised_search_recall(spark, sf_dir):
    measured = RT.recall(_quantised(spark, sf_dir), _approximate(spark, sf_dir, False), "query_id", "vec_id")
    return measured.select("wanted", (F.col("recall") >= 0.9).alias("reached"))


def _fused(spark, sf_dir, scores: RT.Bm25Scores, lexical: DataFrame, vector: DataFrame, k: int) -> DataFrame:
    """Fusion of the whole lists of which ``lexical`` and ``vector`` hold the beginnings."""
    candidates = pin(lexical.select("item_id", "doc_id").union(vector.select("item_id", "doc_id")).distinct())
    lists = [
        RT.exact_ranks(scores, "item_id", "doc_id", candidates),
        RT.exact_vector_ranks(_document_vectors(spark, sf_dir), "doc_id", "embedding", _item_vectors(spark, sf_dir), "item_id", "embedding", candidates),
    ]
    return RT.reciprocal_rank_fusion(lists, "item_id", "doc_id", k)


WHOLLY_FUSED = f"WITH {BM25}, {VECTOR}, {FUSED} SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM fused_ranked WHERE rank <= 10"


@query(WHOLLY_FUSED)
def hybrid_search(spark, sf_dir):
    """Fusion of the whole lists: every document counts with its rank in each, however far down."""
    depth = RT.fusion_depth(2, 10)
    scores = _lexical_scores(spark, sf_dir)
    return _fused(spark, sf_dir, scores, RT.top_per_query(scores, "item_id", "doc_id", depth), _vector(spark, sf_dir, depth), 10)


@query(WHOLLY_FUSED)
def full_hybrid_search(spark, sf_dir):
    """The same under its earlier name, when ``hybrid_search`` fused the beginnings alone."""
    return hybrid_search(spark, sf_dir)


def _reranked(spark, sf_dir, candidates):
    return RT.rerank(
        candidates, "item_id", "doc_id", _document_vectors(spark, sf_dir), "embedding", _item_vectors(spark, sf_dir), "embedding", 10
    )


@query(f"WITH {BM25}, {RERANKED} SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM reranked WHERE rank <= 10")
def two_stage_search(spark, sf_dir):
    return _reranked(spark, sf_dir, _lexical(spark, sf_dir, DEPTH))


RELEVANT = "relevant AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


@query(f"WITH {RELEVANT} SELECT * FROM relevant")
def relevance_judgements(spark, sf_dir):
    return _relevant(spark, sf_dir)


def _relevant(spark, sf_dir):
    return RT.passages_in_documents(
        load_texts(spark, sf_dir, "documents"), "doc_id", "text", load(spark, sf_dir, "benchmark"), "item_id", "text"
    )


@query(
    f"""
WITH {BM25}, {VECTOR}, {FUSED}, {RERANKED}, {RELEVANT},
results AS (SELECT 'lexical' AS strategy, item_id, doc_id FROM lex_ranked WHERE rank <= 10
            UNION ALL SELECT 'vector', item_id, doc_id FROM vec_ranked WHERE rank <= 10
            UNION ALL SELECT 'hybrid', item_id, doc_id FROM fused_ranked WHERE rank <= 10
            UNION ALL SELECT 'reranked', item_id, doc_id FROM reranked WHERE rank <= 10),
wanted AS (SELECT item_id, count(*) AS n FROM relevant GROUP BY item_id),
judged AS (SELECT strategy, item_id, count(r.doc_id) AS hits
           FROM results LEFT JOIN relevant r USING (item_id, doc_id) GROUP BY strategy, item_id)
SELECT strategy, (SELECT count(*) FROM wanted) AS queries,
       round(coalesce(sum(hits / 10) FILTER (n IS NOT NULL), 0) / (SELECT count(*) FROM wanted), 6) AS precision_at_k,
       round(coalesce(sum(hits / n), 0) / (SELECT count(*) FROM wanted), 6) AS recall_at_k
FROM judged LEFT JOIN wanted USING (item_id) GROUP BY strategy"""
)
def retrieval_quality(spark, sf_dir):
    # The ranked lists feed several strategies, so they are computed once.
    scores = _lexical_scores(spark, sf_dir)
    lexical, vector = pin(RT.top_per_query(scores, "item_id", "doc_id", DEPTH)), pin(_vector(spark, sf_dir, DEPTH))
    strategies = {
        "lexical": lexical,
        "vector": vector,
        "hybrid": _fused(spark, sf_dir, scores, lexical, vector, 10),
        "reranked": _reranked(spark, sf_dir, lexical),
    }
    return RT.retrieval_quality(strategies, _relevant(spark, sf_dir), "item_id", "doc_id", 10)


@query(
    """
WITH best AS (SELECT item_id, max(round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6)) AS score
              FROM benchmark JOIN embeddings q ON item_id = q.vec_id, embeddings d WHERE d.vec_id <> q.vec_id GROUP BY item_id)
SELECT item_id, coalesce(score, -1.0) AS best_score, CASE WHEN score >= 0.4 THEN 'answer' ELSE 'fallback' END AS route
FROM benchmark LEFT JOIN best USING (item_id)"""
)
def query_routing(spark, sf_dir):
    # Every vector of this table has a neighbour above 0.3; 0.4 divides them.
    asked = _item_vectors(spark, sf_dir)
    best = RT.vector_candidates(
        _document_vectors(spark, sf_dir), "doc_id", "embedding", asked, "item_id", "embedding", 1, skip_same=True
    )
    return RT.route(load(spark, sf_dir, "benchmark"), "item_id", best, 0.4)


CACHE = """
cached AS (SELECT q.vec_id, q.label, min(e.vec_id) FILTER (e.vec_id < q.vec_id AND
             round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) >= 0.35) AS cache_entry
           FROM embeddings q LEFT JOIN embeddings e ON q.label = e.label GROUP BY q.vec_id, q.label)
"""


@query(f"WITH {CACHE} SELECT vec_id, label, coalesce(cache_entry, -1) AS cache_entry FROM cached")
def semantic_cache(spark, sf_dir):
    # No two of these vectors reach 0.95; the lower threshold gives hits to compare.
    cached = RT.semantic_cache(load(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 0.35)
    return cached.withColumn("cache_entry", F.coalesce("cache_entry", F.lit(-1)))


@query(
    f"WITH {CACHE} SELECT label, count(*) AS queries, count(cache_entry) AS hits, round(count(cache_entry) / count(*), 9) AS hit_rate "
    "FROM cached GROUP BY label"
)
def cache_hit_rate(spark, sf_dir):
    cached = RT.semantic_cache(load(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 0.35)
    return RT.cache_hit_rate(cached, "label")


GRAMS = " UNION ALL ".join(
    f"""SELECT model, conv_id, turn, {n} AS n, {side} AS is_c,
        unnest(CASE WHEN len({col}) >= {n} THEN [array_to_string({col}[i : i + {n - 1}], ' ') FOR i IN range(1, len({col}) - {n} + 2)] ELSE [] END) AS gram FROM tok"""
    for n in range(1, 5)
    for side, col in ((1, "c"), (0, "r"))
)


@query(
    f"""
WITH tok AS (SELECT CASE WHEN a.conv_id % 2 = 0 THEN 'base' ELSE 'tuned' END AS model, a.conv_id, a.turn,
                    regexp_extract_all(b.text, '\\S+') AS c, regexp_extract_all(a.text, '\\S+') AS r
             FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
grams AS ({GRAMS}),
counted AS (SELECT model, conv_id, turn, n, gram, sum(is_c) AS nc, sum(1 - is_c) AS nr FROM grams GROUP BY ALL),
g AS (SELECT model, sum(nc) FILTER (n = 1) AS cw, sum(nr) FILTER (n = 1) AS rw,
        coalesce(sum(least(nc, nr)) FILTER (n = 1) / sum(nc) FILTER (n = 1), 0) AS p1,
        coalesce(sum(least(nc, nr)) FILTER (n = 2) / sum(nc) FILTER (n = 2), 0) AS p2,
        coalesce(sum(least(nc, nr)) FILTER (n = 3) / sum(nc) FILTER (n = 3), 0) AS p3,
        coalesce(sum(least(nc, nr)) FILTER (n = 4) / sum(nc) FILTER (n = 4), 0) AS p4 FROM counted GROUP BY model)
SELECT model, CAST(cw AS BIGINT) AS candidate_words, CAST(rw AS BIGINT) AS reference_words, round(p1, 9) AS p1, round(p2, 9) AS p2,
       round(p3, 9) AS p3, round(p4, 9) AS p4,
       round(CASE WHEN least(p1, p2, p3, p4) > 0 THEN (CASE WHEN cw > rw THEN 1.0 ELSE exp(1 - rw / cw) END)
             * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) ELSE 0.0 END, 9) AS bleu FROM g"""
)
def model_bleu(spark, sf_dir):
    """Each turn judged against the turn before it, in two groups of conversations."""
    turns = load_texts(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    replies = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("candidate"))
    pairs = turns.withColumnRenamed("text", "reference").join(replies, ["conv_id", "turn"])
    pairs = pairs.withColumn("model", F.when(F.col("conv_id") % 2 == 0, "base").otherwise("tuned"))
    return RT.corpus_bleu(pairs, ["model"], ["conv_id", "turn"], "candidate", "reference")
