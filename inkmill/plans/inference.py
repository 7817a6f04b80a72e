"""Queries on logits, entities, batch inference and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions import arrays as A, pretok as P, text as T
from ..functions.scalars import uniform
from ..operators import cells, knn, metrics, predict, vocab as vocab_ops
from . import tables as t
from .example_sets import _WORDS
from .registry import query

LOGITS = "list_transform(embedding, lambda x: x::DOUBLE)"


def _rounded(values, digits: int = 6):
    return F.transform(values, lambda x: F.round(x, digits))


@query("softmax", f"""
SELECT vec_id, i - 1 AS pos, round(exp(x - m) / sum(exp(x - m)) OVER (PARTITION BY vec_id), 9) AS p FROM (
  SELECT vec_id, unnest(l) AS x, generate_subscripts(l, 1) AS i, list_max(l) AS m FROM (SELECT vec_id, {LOGITS} AS l FROM embeddings))""")
def softmax(spark, d):
    probs = t.read(spark, d, "embeddings").select("vec_id", F.posexplode(A.softmax("embedding")).alias("pos", "p"))
    return probs.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("p", 9).alias("p"))


@query("argmax_array", "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS best FROM embeddings")
def argmax_array(spark, d):
    return t.read(spark, d, "embeddings").select("vec_id", A.argmax_array("embedding").alias("best"))


@query("topk_array", """
SELECT vec_id, string_agg((i - 1)::VARCHAR, ' ' ORDER BY rn) AS best FROM (
  SELECT vec_id, i, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) AS rn FROM (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)) WHERE rn <= 5 GROUP BY vec_id""")
def topk_array(spark, d):
    return t.read(spark, d, "embeddings").select("vec_id", t.joined(A.topk_array("embedding", 5)).alias("best"))


SQL_LABEL_OF = f"({t.SQL_LABEL_NAMES})"


@query("classify_label", f"""
SELECT vec_id, {SQL_LABEL_OF}[list_position(l, list_max(l))] AS label,
  round(1 / list_sum(list_transform(l, lambda x: exp(x - list_max(l)))), 9) AS score
FROM (SELECT vec_id, list_transform(embedding[1:9], lambda x: x::DOUBLE) AS l FROM embeddings)""")
def classify_label(spark, d):
    rows = t.read(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 9).alias("logits"))
    names = F.array(*[F.lit(n) for n in t.LABEL_NAMES])
    return predict.classify_label(rows, "logits", names).select("vec_id", "label", F.round("score", 9).alias("score"))


def turns(spark, d) -> DataFrame:
    """Turns with located words."""
    rows = t.read(spark, d, "conversations").select((F.col("conv_id") * 1000000 + F.col("turn")).alias("turn_id"), "text")
    return P.piece_offsets(rows, "text", _WORDS, "words")


SQL_TURN_WORDS = f"""SELECT turn_id, token, s, s + length(token) AS e, row_number() OVER (PARTITION BY turn_id ORDER BY pos) - 1 AS i FROM (
  SELECT *, (sum(length(token)) OVER (PARTITION BY turn_id ORDER BY pos) - length(token))::BIGINT AS s
  FROM ({t.sql_tokens('(SELECT conv_id * 1000000 + turn AS turn_id, text FROM conversations)', 'turn_id', f'regexp_extract_all(text, {t.re2(_WORDS)})')}))
WHERE NOT regexp_matches(token, {t.re2('^' + T.WHITESPACE)})"""


@query("ner_token_output", f"""
WITH l AS (SELECT *, [{', '.join(f"{t.sql_uniform('logit', 'turn_id', 'i', str(c))} * 6" for c in range(9))}] AS logits FROM ({SQL_TURN_WORDS}))
SELECT turn_id, i::INTEGER AS "index", {SQL_LABEL_OF}[list_position(logits, list_max(logits))] AS entity,
  round(1 / list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))), 9) AS score, token AS word, s::INTEGER AS start, e::INTEGER AS "end"
FROM l WHERE list_position(logits, list_max(logits)) > 1""")
def ner_token_output(spark, d):
    def logits(w, i):
        return F.array(*[uniform("logit", "turn_id", i, F.lit(c)) * 6 for c in range(9)])

    rows = turns(spark, d).select("turn_id", "words", F.transform("words", logits).alias("logits"))
    names = F.array(*[F.lit(n) for n in t.LABEL_NAMES])
    found = predict.ner_token_output(rows, "logits", "words", names)
    return found.withColumn("score", F.round("score", 9))


SQL_SPAN_ROWS = """
SELECT {key}, type, grp, min(i) AS s, max(i) AS e FROM (
  SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY i) AS grp FROM (
    SELECT *, substr(tag, 3) AS type, CASE WHEN tag <> 'O' AND (starts_with(tag, 'B-') OR before = 'O' OR substr(before, 3) <> substr(tag, 3)) THEN 1 ELSE 0 END AS opens
    FROM (SELECT *, coalesce(lag(tag) OVER (PARTITION BY {key} ORDER BY i), 'O') AS before FROM ({rows})))
  WHERE tag <> 'O') GROUP BY {key}, type, grp"""


def _sql_named_tag(key: str, pos: str, error: bool = False) -> str:
    return f"{SQL_LABEL_OF}[({t.sql_tag(key, pos, error)}) + 1]"


@query("ner_group_entities", f"""
WITH w AS MATERIALIZED (SELECT *, {_sql_named_tag('turn_id', 'i')} AS tag, {t.sql_uniform('score', 'turn_id', 'i')} AS p FROM ({SQL_TURN_WORDS})),
     g AS ({SQL_SPAN_ROWS.format(key='turn_id', rows='SELECT turn_id, i, tag FROM w')})
SELECT g.turn_id, g.type AS entity_group, round(avg(p), 9) AS score, string_agg(token, ' ' ORDER BY i) AS word, min(w.s)::INTEGER AS start, max(w.e)::INTEGER AS "end"
FROM g JOIN w ON w.turn_id = g.turn_id AND w.i BETWEEN g.s AND g.e GROUP BY g.turn_id, g.type, g.grp""")
def ner_group_entities(spark, d):
    rows = turns(spark, d).withColumn("tags", F.transform(t.word_tags(["turn_id"], "words"), t.label_name))
    rows = rows.withColumn("scores", F.transform("words", lambda w, i: uniform("score", "turn_id", i)))
    groups = predict.ner_group_entities(rows.select("turn_id", "tags", "scores", "words"), "tags", "scores", "words")
    return groups.withColumn("score", F.round("score", 9))


SQL_DOC_WORDS = f"SELECT doc_id, pos AS i, token FROM ({t.sql_tokens('documents', 'doc_id', t.sql_words('text'))})"


@query("entity_spans", f"""
WITH w AS (SELECT doc_id, i, {_sql_named_tag('doc_id', 'i')} AS tag FROM ({SQL_DOC_WORDS}))
SELECT doc_id, type, s::INTEGER AS start, e::INTEGER AS "end" FROM ({SQL_SPAN_ROWS.format(key='doc_id', rows='SELECT * FROM w')})""")
def entity_spans(spark, d):
    docs = t.spread_documents(spark, d).select("doc_id", T.words("text").alias("words"))
    tags = docs.select("doc_id", F.transform(t.word_tags(["doc_id"], "words"), t.label_name).alias("tags"))
    return tags.select("doc_id", F.inline(A.entity_spans("tags")))


@query("seqeval", f"""
WITH w AS MATERIALIZED (SELECT doc_id, i, {_sql_named_tag('doc_id', 'i')} AS y, {_sql_named_tag('doc_id', 'i', True)} AS p FROM ({SQL_DOC_WORDS})),
     a AS (SELECT doc_id, type, s, e FROM ({SQL_SPAN_ROWS.format(key='doc_id', rows='SELECT doc_id, i, y AS tag FROM w')})),
     b AS (SELECT doc_id, type, s, e FROM ({SQL_SPAN_ROWS.format(key='doc_id', rows='SELECT doc_id, i, p AS tag FROM w')})),
     j AS (SELECT coalesce(a.type, b.type) AS type, a.doc_id IS NOT NULL AS y, b.doc_id IS NOT NULL AS p
           FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.type = b.type AND a.s = b.s AND a.e = b.e),
     k AS (SELECT unnest([type, 'overall']) AS type, y, p FROM j),
     n AS (SELECT type, count(*) FILTER (y) AS y, count(*) FILTER (p) AS p, count(*) FILTER (y AND p) AS tp FROM k GROUP BY type)
SELECT type, round(tp / p, 9) AS precision, round(tp / y, 9) AS recall, round(2 * tp / (y + p), 9) AS f1, y AS number,
  CASE WHEN type = 'overall' THEN (SELECT round(avg((y = p)::INTEGER), 9) FROM w) END AS accuracy FROM n""")
def seqeval(spark, d):
    words = T.words("text")  # counted where they are found, so no word goes along with the tags
    tags = t.spread_documents(spark, d).select(t.label_names(t.word_tags(["doc_id"], words)).alias("labels"),
                                               t.label_names(t.word_tags(["doc_id"], words, error=True)).alias("predictions"))
    scores = metrics.seqeval(tags, "predictions", "labels")
    return scores.select("type", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy")], "number")


# Batch inference.

@query("batch_score", """
SELECT vec_id, c, round(sum(x * ((i - 1 + c) % 7 - 3)), 5) AS score FROM (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), (SELECT unnest(range(5)) AS c) GROUP BY vec_id, c""")
def batch_score(spark, d):
    rows = t.read(spark, d, "embeddings").select("vec_id", "embedding")
    scored = predict.batch_score(rows, ["embedding"], predict.linear_scorer(64, 5), "scores", ArrayType(DoubleType()), input_shapes=[[64]])
    out = scored.select("vec_id", F.posexplode("scores").alias("c", "score"))
    return out.select("vec_id", F.col("c").cast("bigint").alias("c"), F.round("score", 5).alias("score"))


@query("embed_text", f"""
WITH k AS (SELECT doc_id, {t.sql_hex('md5(token)')} % 16 AS dim FROM ({SQL_DOC_WORDS})),
     g AS (SELECT d.doc_id, r.dim, count(k.dim) AS n FROM documents d CROSS JOIN (SELECT unnest(range(16)) AS dim) r
           LEFT JOIN k ON k.doc_id = d.doc_id AND k.dim = r.dim GROUP BY 1, 2)
SELECT doc_id, string_agg(n::VARCHAR, ' ' ORDER BY dim) AS embedding FROM g GROUP BY doc_id""")
def embed_text(spark, d):
    docs = t.spread_documents(spark, d).select("doc_id", "text")
    embedded = predict.embed_text(docs, "text", predict.hashed_bag_scorer(16))
    return embedded.select("doc_id", t.joined(F.transform("embedding", lambda x: x.cast("bigint"))).alias("embedding"))


@query("fill_mask_topk", f"""
WITH f AS (SELECT token, count(*) AS n FROM ({SQL_DOC_WORDS}) GROUP BY token ORDER BY n DESC, token LIMIT 64),
     v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM f),
     r AS (SELECT vec_id, i - 1 AS id, x, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) - 1 AS rank FROM (
       SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings))
SELECT vec_id, rank::INTEGER AS rank, token, round(x::DOUBLE, 6) AS score, 'vector ' || vec_id || ' is ' || token || '.' AS filled FROM r JOIN v USING (id) WHERE rank < 5""")
def fill_mask_topk(spark, d):
    words = vocab_ops.explode_tokens(t.documents(spark, d), [], T.words("text"), "pos", "token").groupBy("token").agg(F.count("*").alias("n"))
    top = words.orderBy(F.desc("n"), "token").limit(64)
    vocab = top.select("token", (F.row_number().over(t.vocab_window()) - 1).alias("id"))
    none = F.array().cast("array<float>")
    rows = t.read(spark, d, "embeddings").select(
        "vec_id", F.concat(F.lit("vector "), F.col("vec_id").cast("string"), F.lit(" is [MASK].")).alias("text"),
        F.array(F.lit(101), F.lit(103), F.lit(102)).alias("ids"), F.array(none, F.col("embedding"), none).alias("logits"))
    best = predict.fill_mask_topk(rows, "text", "ids", "logits", 103, vocab, 5)
    return best.select("vec_id", "rank", "token", F.round(F.col("score").cast("double"), 6).alias("score"), "filled")


@query("mask_fill_render", """
SELECT doc_id, replace(text, ' ', '[MASK]') AS masked, replace(text, ' ', source) AS filled FROM documents""")
def mask_fill_render(spark, d):
    docs = t.documents(spark, d).select("doc_id", "source", F.replace("text", F.lit(" "), F.lit("[MASK]")).alias("masked"))
    return docs.select("doc_id", "masked", predict.mask_fill_render(F.col("masked"), F.col("source")).alias("filled"))


# Nearest neighbours.

def centroids(spark, d) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    values = t.read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = values.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return ordered.select(F.col("label").cast("bigint").alias("query_id"), F.transform("v", lambda e: e["x"]).alias("embedding"))


SQL_VALUES = "SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings"
SQL_NEAREST = """
SELECT query_id, vec_id, {sign}round(score, 6) AS score, rank::INTEGER AS rank FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) {order}, vec_id) AS rank FROM ({scores})) WHERE rank <= 5"""


def _sql_centroid_scores(measure: str) -> str:
    return f"""WITH e AS MATERIALIZED ({SQL_VALUES}), q AS MATERIALIZED (SELECT label::BIGINT AS query_id, i, avg(x) AS y FROM e GROUP BY label, i)
      SELECT query_id, vec_id, {measure} AS score FROM e JOIN q USING (i) GROUP BY query_id, vec_id"""


def _shown(found: DataFrame) -> DataFrame:
    return found.withColumn("score", F.round("score", 6))


@query("knn_exact", SQL_NEAREST.format(sign="", order="", scores=_sql_centroid_scores("sum((x - y) * (x - y))")))
def knn_exact(spark, d):
    return _shown(knn.knn_exact(t.read(spark, d, "embeddings"), centroids(spark, d), 5))


@query("knn_dot", SQL_NEAREST.format(sign="", order="DESC", scores=_sql_centroid_scores("sum(x * y)")))
def knn_dot(spark, d):
    return _shown(knn.knn_exact(t.read(spark, d, "embeddings"), centroids(spark, d), 5, "dot"))


@query("knn_cosine", SQL_NEAREST.format(sign="", order="DESC", scores=_sql_centroid_scores("sum(x * y) / sqrt(sum(x * x)) / sqrt(sum(y * y))")))
def knn_cosine(spark, d):
    return _shown(knn.knn_exact(t.read(spark, d, "embeddings"), centroids(spark, d), 5, "cosine"))


SQL_NEIGHBOURS = SQL_NEAREST.format(sign="", order="", scores="""
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(a.v, lambda x, i: (x - b.v[i]) * (x - b.v[i]))) AS score
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) a JOIN (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) b ON a.vec_id <> b.vec_id""")


@query("knn_blocked", SQL_NEIGHBOURS)
def knn_blocked(spark, d):
    base = t.read(spark, d, "embeddings")
    found = knn.knn_blocked(base, base.select(F.col("vec_id").alias("query_id"), "embedding"), 5, exclude_self=True, block_rows=200)
    return _shown(found)


@query("knn_cells", SQL_NEIGHBOURS)
def knn_cells(spark, d):
    base = t.read(spark, d, "embeddings")
    return _shown(cells.knn_cells(base, base.select(F.col("vec_id").alias("query_id"), "embedding"), 5, exclude_self=True))
