"""Queries that build model-ready examples and question-answering features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import arrays as A, pretok as P, text as T
from ..functions.once import compute_once
from ..functions.scalars import row_draws
from ..operators import examples as X, qa, user_code
from ..operators.ordering import batch_assign
from ..sources import writers
from . import tables as t
from .registry import query

IDS = t.sql_token_ids("text")


def document_ids(spark, d, *more: str) -> DataFrame:
    return t.spread_documents(spark, d).select("doc_id", *more, t.token_ids("text").alias("input_ids"))


def _sql_pad(ids: str, width: str, pad: str) -> str:
    return f"{ids} || list_transform(range({width} - len({ids})), lambda x: {pad})"


def _sql_mask(ids: str, width: str) -> str:
    return f"repeat('1', len({ids})) || repeat('0', {width} - len({ids}))"


@query("truncate", f"""
SELECT doc_id, '101 ' || array_to_string(({IDS})[1:126], ' ') || ' 102' AS input_ids FROM documents""")
def truncate(spark, d):
    docs = document_ids(spark, d)
    framed = A.template_single(A.truncate("input_ids", 128), F.lit(101), F.lit(102))
    return docs.select("doc_id", t.joined(framed).alias("input_ids"))


@query("truncate_pair_longest", f"""
WITH p AS (SELECT example_id, {t.sql_token_ids('question')} AS a, {t.sql_token_ids('context')} AS b FROM ({t.SQL_PAIRS})),
     n AS (SELECT *, CASE WHEN len(a) + len(b) <= 61 THEN len(a) WHEN len(b) < 30 THEN 61 - len(b) WHEN len(a) < 31 THEN len(a) ELSE 31 END AS ka FROM p)
SELECT example_id, array_to_string(a[1:ka], ' ') AS a, array_to_string(b[1:least(len(b), 61 - ka)], ' ') AS b FROM n""")
def truncate_pair_longest(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("question").alias("a"), t.token_ids("context").alias("b"))
    a, b = A.truncate_pair_longest("a", "b", 64)
    return ids.select("example_id", t.joined(a).alias("a"), t.joined(b).alias("b"))


@query("pad_dynamic", f"""
WITH b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id, ({IDS})[1:510] AS ids FROM documents),
     w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM b)
SELECT doc_id, batch_id, array_to_string({_sql_pad('ids', 'width', '0')}, ' ') AS input_ids, {_sql_mask('ids', 'width')} AS attention_mask FROM w""")
def pad_dynamic(spark, d):
    docs = document_ids(spark, d).withColumn("input_ids", A.truncate("input_ids", 512))
    padded = X.pad_dynamic(batch_assign(docs, 16, "doc_id"), "input_ids", ["batch_id"])
    return padded.select("doc_id", "batch_id", t.joined("input_ids").alias("input_ids"), t.joined("attention_mask", "").alias("attention_mask"))


@query("pad_max_length", f"""
SELECT example_id, array_to_string({_sql_pad('ids', '384', '0')}, ' ') AS input_ids, {_sql_mask('ids', '384')} AS attention_mask
FROM (SELECT example_id, {t.sql_token_ids('context')} AS ids FROM ({t.SQL_PAIRS}))""")
def pad_max_length(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("context").alias("input_ids"))
    padded = X.pad_max_length(ids, "input_ids", 384)
    return padded.select("example_id", t.joined("input_ids").alias("input_ids"), t.joined("attention_mask", "").alias("attention_mask"))


@query("pad_global", f"""
WITH b AS (SELECT example_id, {t.sql_token_ids('question')} AS ids FROM ({t.SQL_PAIRS})), w AS (SELECT *, max(len(ids)) OVER () AS width FROM b)
SELECT example_id, array_to_string({_sql_pad('ids', 'width', '0')}, ' ') AS input_ids FROM w""")
def pad_global(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("question").alias("input_ids"))
    return X.pad_global(ids, "input_ids").select("example_id", t.joined("input_ids").alias("input_ids"))


@query("pad_labels", f"""
WITH b AS (SELECT example_id, {t.sql_token_ids('context')} AS ids, {t.sql_token_ids('question')} AS labels FROM ({t.SQL_PAIRS}))
SELECT example_id, array_to_string({_sql_pad('labels', '384', '-100')}, ' ') AS labels FROM b""")
def pad_labels(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("context").alias("input_ids"), t.token_ids("question").alias("labels"))
    return X.pad_max_length(ids, "input_ids", 384, labels="labels").select("example_id", t.joined("labels").alias("labels"))


@query("tokenize_pair_targets", f"""
SELECT example_id, array_to_string(({t.sql_token_ids('context')})[1:127], ' ') || ' 2' AS input_ids,
       array_to_string(({t.sql_token_ids('question')})[1:29], ' ') || ' 2' AS labels FROM ({t.SQL_PAIRS})""")
def tokenize_pair_targets(spark, d):
    end = F.array(F.lit(2))
    return t.pairs(spark, d).select(
        "example_id", t.joined(F.concat(A.truncate(t.token_ids("context"), 128, 1), end)).alias("input_ids"),
        t.joined(F.concat(A.truncate(t.token_ids("question"), 30, 1), end)).alias("labels"))


SQL_PIECES = f"""SELECT doc_id, pos AS word_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS k FROM (
  SELECT doc_id, pos, regexp_extract_all(token, '.{{1,3}}') AS ps FROM ({t.sql_tokens('documents', 'doc_id', t.sql_words('text'))}))"""


@query("align_labels", f"""
SELECT doc_id, '-100 ' || string_agg((CASE WHEN k = 1 THEN label ELSE label + label % 2 END)::VARCHAR, ' ' ORDER BY word_id, k) || ' -100' AS labels
FROM (SELECT *, {t.sql_tag('doc_id', 'word_id')} AS label FROM ({SQL_PIECES})) GROUP BY doc_id""")
def align_labels(spark, d):
    docs = t.three_char_pieces(t.spread_documents(spark, d), "text")
    tagged = docs.withColumn("ner_tags", t.word_tags(["doc_id"], T.words("text")))
    return A.align_labels(tagged, "word_ids", "ner_tags", "labels").select("doc_id", t.joined("labels").alias("labels"))


@query("group_texts", f"""
WITH k AS (SELECT doc_id, pos, {t.sql_token_id('token')} AS id FROM ({t.sql_tokens('documents', 'doc_id', t.sql_words('lower(text)'))})),
     b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch_id FROM documents),
     p AS (SELECT batch_id, id, doc_id, pos, row_number() OVER (PARTITION BY batch_id ORDER BY doc_id, pos) - 1 AS place FROM k JOIN b USING (doc_id))
SELECT batch_id, place // 128 AS chunk_id, string_agg(id::VARCHAR, ' ' ORDER BY place) AS input_ids FROM p GROUP BY 1, 2 HAVING count(*) = 128""")
def group_texts(spark, d):
    chunks = X.group_texts(document_ids(spark, d), "input_ids", "doc_id", chunk=128, batch_rows=100)
    return chunks.select("batch_id", "chunk_id", t.joined("labels").alias("input_ids"))


@query("chunk_fixed", f"""
SELECT doc_id, c AS chunk_id, array_to_string(ids[c * 64 + 1 : c * 64 + 64], ' ') AS input_ids FROM (
  SELECT doc_id, ids, unnest(range(ceil(len(ids) / 64.0)::BIGINT))::INTEGER AS c FROM (SELECT doc_id, {IDS} AS ids FROM documents))""")
def chunk_fixed(spark, d):
    docs = compute_once(document_ids(spark, d), "input_ids")
    chunks = docs.select("doc_id", F.posexplode(A.chunk_fixed("input_ids", 64)).alias("chunk_id", "chunk"))
    return chunks.select("doc_id", "chunk_id", t.joined("chunk").alias("input_ids"))


@query("chunk_overflow", f"""
SELECT doc_id, c AS chunk_id, array_to_string(ids[c * 128 + 1 : c * 128 + 128], ' ') AS input_ids FROM (
  SELECT doc_id, ids, unnest(range(len(ids) // 128))::INTEGER AS c FROM (SELECT doc_id, {IDS} AS ids FROM documents))""")
def chunk_overflow(spark, d):
    return X.chunk_overflow(document_ids(spark, d), "input_ids", 128).select("doc_id", "chunk_id", t.joined("input_ids").alias("input_ids"))


def _sql_draw(kind: str) -> str:
    return t.sql_uniform(f"42:0:{kind}", "doc_id", "i - 1")


@query("mlm_mask", f"""
SELECT doc_id, array_to_string(list_transform(ids, lambda x, i: CASE WHEN NOT {_sql_draw('m')} < 0.15 THEN x WHEN {_sql_draw('a')} < 0.8 THEN 103
         WHEN {_sql_draw('a')} < 0.9 THEN floor({_sql_draw('r')} * 30000)::INTEGER ELSE x END), ' ') AS input_ids,
       array_to_string(list_transform(ids, lambda x, i: CASE WHEN {_sql_draw('m')} < 0.15 THEN x ELSE -100 END), ' ') AS labels
FROM (SELECT doc_id, {IDS} AS ids FROM documents)""")
def mlm_mask(spark, d):
    masked = X.mlm_mask(document_ids(spark, d), "input_ids", ["doc_id"], 103, 30000, special_ids=(101, 102))
    return masked.select("doc_id", t.joined("input_ids").alias("input_ids"), t.joined("labels").alias("labels"))


SQL_WHOLE_WORD = f"""
WITH p AS (SELECT doc_id, word_id, k, {t.sql_token_id('piece')} AS id, {t.sql_uniform('42:0:w', 'doc_id', 'word_id')} < 0.2 AS hit FROM ({SQL_PIECES}))
SELECT doc_id, '101 ' || string_agg((CASE WHEN hit THEN 103 ELSE id END)::VARCHAR, ' ' ORDER BY word_id, k) || ' 102' AS input_ids,
  '-100 ' || string_agg((CASE WHEN hit THEN id ELSE -100 END)::VARCHAR, ' ' ORDER BY word_id, k) || ' -100' AS labels FROM p GROUP BY doc_id"""


@query("whole_word_mask", SQL_WHOLE_WORD)
def whole_word_mask(spark, d):
    docs = t.three_char_pieces(t.spread_documents(spark, d), "text").withColumn("labels", F.col("piece_ids"))
    masked = X.whole_word_mask(docs.select("doc_id", "piece_ids", "labels", "word_ids"), "piece_ids", "labels", "word_ids", ["doc_id"], 103)
    return masked.select("doc_id", t.joined("piece_ids").alias("input_ids"), t.joined("labels").alias("labels"))


def mask_words(examples: list[dict]) -> list[dict]:
    """Whole-word masking as a user's collate function."""
    out = []
    for e in examples:
        ids, words = [str(i) for i in e["piece_ids"]], e["word_ids"]
        drawn = (row_draws(f"42:0:w:{e['doc_id']}", max((w for w in words if w is not None), default=-1) + 1) < 0.2).tolist()
        hit = [w is not None and drawn[w] for w in words]
        out.append({"doc_id": e["doc_id"], "input_ids": " ".join(["103" if h else i for h, i in zip(hit, ids)]),
                    "labels": " ".join([i if h else "-100" for h, i in zip(hit, ids)])})
    return out


@query("collate_whole_word", SQL_WHOLE_WORD)
def collate_whole_word(spark, d):
    docs = t.three_char_pieces(t.spread_documents(spark, d), "text").select("doc_id", "lang", "piece_ids", "word_ids")
    masked = user_code.collate_batches(docs, 32, "doc_id", mask_words, "doc_id bigint, input_ids string, labels string", ["lang"])
    return masked.select("doc_id", "input_ids", "labels")


@query("clm_labels", f"""
SELECT example_id, array_to_string(ids, ' ') || repeat(' -100', 300 - len(ids)) AS labels FROM (SELECT example_id, {t.sql_token_ids('context')} AS ids FROM ({t.SQL_PAIRS}))""")
def clm_labels(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("context").alias("input_ids"))
    padded = X.pad_max_length(ids, "input_ids", 300)
    return padded.select("example_id", t.joined(A.clm_labels("input_ids", 0)).alias("labels"))


@query("seq2seq_shift_right", f"""
SELECT example_id, array_to_string([0] || ids, ' ') || repeat(' 1', 60 - len(ids) - 1) AS decoder_input_ids
FROM (SELECT example_id, {t.sql_token_ids('question')} AS ids FROM ({t.SQL_PAIRS}))""")
def seq2seq_shift_right(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("question").alias("labels"))
    padded = ids.withColumn("labels", A.pad_array("labels", F.lit(60), -100))
    return padded.select("example_id", t.joined(A.shift_right("labels", 0, 1)).alias("decoder_input_ids"))


@query("training_step_count", "SELECT (ceil(count(*) / 16.0) * 3)::BIGINT AS steps FROM documents")
def training_step_count(spark, d):
    return X.training_step_count(t.documents(spark, d), 16, 3)


@query("sink_training_batches", f"""
WITH b AS (SELECT doc_id, lang AS split, (row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) - 1) // 32 AS batch_id, ({IDS})[1:128] AS ids FROM documents),
     w AS (SELECT *, max(len(ids)) OVER (PARTITION BY split, batch_id) AS width FROM b)
SELECT doc_id, split, batch_id, array_to_string({_sql_pad('ids', 'width', '0')}, ' ') AS input_ids FROM w""")
def sink_training_batches(spark, d):
    from ..session import scratch_path

    docs = document_ids(spark, d, "lang").withColumnRenamed("lang", "split").withColumn("input_ids", A.truncate("input_ids", 128, 0))
    path = scratch_path(spark, "batches")
    writers.sink_training_batches(docs, path, id_col="doc_id", ids="input_ids", batch_size=32, seed=42)
    return spark.read.parquet(path).select("doc_id", "split", "batch_id", t.joined("input_ids").alias("input_ids"))


# Question answering: the answer is words three to five of the context (the first word of a shorter one).

MAX_LENGTH, STRIDE = 160, 50


def _prefix(text: str, n_words: int, closed: bool) -> str:
    """Pattern for the text before a word (closed: to its end)."""
    ws, word = T.WHITESPACE, T.NOT_WHITESPACE
    return f"^{ws}*({word}+{ws}+){{{n_words}}}" + (f"{word}+" if closed else "")


ANSWER_START, ANSWER_END, FIRST_START, FIRST_END = (
    _prefix("", 2, False), _prefix("", 4, True), f"^{T.WHITESPACE}*", f"^{T.WHITESPACE}*{T.NOT_WHITESPACE}+")


def qa_examples(spark, d) -> DataFrame:
    """example_id, context, question and context tokens with offsets, answer_start, answer_end."""
    rows = t.pairs(spark, d)
    located = P.piece_offsets(P.piece_offsets(rows, "question", _WORDS, "q"), "context", _WORDS, "c")

    def at(pattern: str):
        return F.length(F.regexp_extract("context", pattern, 0))

    long = F.size("c") >= 5
    return located.withColumn("answer_start", F.when(long, at(ANSWER_START)).otherwise(at(FIRST_START))).withColumn(
        "answer_end", F.when(long, at(ANSWER_END)).otherwise(at(FIRST_END)))


_WORDS = T.NOT_WHITESPACE + "++|" + T.WHITESPACE + "++"


def _sql_located(column: str) -> str:
    cover = f"regexp_extract_all({column}, {t.re2(_WORDS)})"
    return f"""SELECT example_id, list(token ORDER BY pos) AS toks, list(s ORDER BY pos) AS ss, list(s + length(token) ORDER BY pos) AS es FROM (
      SELECT *, (sum(length(token)) OVER (PARTITION BY example_id ORDER BY pos) - length(token))::BIGINT AS s FROM ({t.sql_tokens('p', 'example_id', cover)}))
    WHERE NOT regexp_matches(token, {t.re2('^' + T.WHITESPACE)}) GROUP BY example_id"""


def _sql_at(pattern: str) -> str:
    return f"length(regexp_extract(context, {t.re2(pattern)}))"


SQL_WINDOWS = f"""
p AS MATERIALIZED ({t.SQL_PAIRS}), q AS ({_sql_located('question')}), c AS ({_sql_located('context')}),
j AS (SELECT p.example_id, q.toks AS qt, q.ss AS qs, q.es AS qe, c.toks AS ct, c.ss AS cs, c.es AS ce, {MAX_LENGTH} - 3 - len(q.toks) AS cap,
        CASE WHEN len(c.toks) >= 5 THEN {_sql_at(ANSWER_START)} ELSE {_sql_at(FIRST_START)} END AS a_s,
        CASE WHEN len(c.toks) >= 5 THEN {_sql_at(ANSWER_END)} ELSE {_sql_at(FIRST_END)} END AS a_e
      FROM p JOIN q USING (example_id) JOIN c USING (example_id)),
w AS (SELECT *, unnest(range(CASE WHEN len(ct) <= cap THEN 1 ELSE ceil((len(ct) - cap) / (cap - {STRIDE})::DOUBLE)::BIGINT + 1 END))::INTEGER AS win FROM j),
win AS (SELECT *, (win * (cap - {STRIDE}))::INTEGER AS ctx_from, ct[win * (cap - {STRIDE}) + 1 : win * (cap - {STRIDE}) + cap] AS wt,
        cs[win * (cap - {STRIDE}) + 1 : win * (cap - {STRIDE}) + cap] AS ws, ce[win * (cap - {STRIDE}) + 1 : win * (cap - {STRIDE}) + cap] AS we FROM w)"""


@query("qa_windows", f"""
WITH {SQL_WINDOWS} SELECT example_id, win AS "window", ctx_from,
  '[CLS] ' || array_to_string(qt, ' ') || ' [SEP] ' || array_to_string(wt, ' ') || ' [SEP]' AS tokens FROM win""")
def qa_windows(spark, d):
    windows = qa.qa_windows(qa_examples(spark, d), "q", "c", MAX_LENGTH, STRIDE)
    return windows.select("example_id", "window", "ctx_from", t.joined(qa.window_tokens("q", "ctx")).alias("tokens"))


@query("qa_span_labels", f"""
WITH {SQL_WINDOWS} SELECT example_id, win AS "window",
  CASE WHEN ws[1] > a_s OR we[-1] < a_e THEN 0 ELSE len(qt) + 2 + len(list_filter(ws, lambda x: x <= a_s)) - 1 END::INTEGER AS start_position,
  CASE WHEN ws[1] > a_s OR we[-1] < a_e THEN 0 ELSE len(qt) + 2 + len(ws) - len(list_filter(we, lambda x: x >= a_e)) END::INTEGER AS end_position FROM win""")
def qa_span_labels(spark, d):
    windows = qa.qa_windows(qa_examples(spark, d), "q", "c", MAX_LENGTH, STRIDE)
    labelled = qa.span_labels(windows, "q", "ctx", "answer_start", "answer_end")
    return labelled.select("example_id", "window", "start_position", "end_position")


@query("qa_eval_features", f"""
WITH {SQL_WINDOWS} SELECT example_id, win AS "window",
  '_ ' || repeat('_ ', len(qt)) || '_ ' || array_to_string(list_transform(ws, lambda x, i: x || ':' || we[i]), ' ') || ' _' AS offset_mapping FROM win""")
def qa_eval_features(spark, d):
    windows = qa.qa_windows(qa_examples(spark, d), "q", "c", MAX_LENGTH, STRIDE)
    windows = windows.withColumn("offsets", qa.eval_offsets(qa.offset_mapping("q", "ctx"), qa.sequence_ids("q", "ctx")))
    shown = F.transform("offsets", lambda o: F.coalesce(F.concat(o["start"].cast("string"), F.lit(":"), o["end"].cast("string")), F.lit("_")))
    return windows.select("example_id", "window", t.joined(shown).alias("offset_mapping"))


def logit_features(spark, d) -> DataFrame:
    """Features from vectors: 32 start and 32 end logits; the first four positions lie outside the context."""
    vectors = t.read(spark, d, "embeddings")
    offsets = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.when(i >= 4, F.struct(
        (i * 4).alias("start"), (i * 4 + 3).alias("end"))))
    return vectors.select(F.col("vec_id").alias("feature_id"), F.floor(F.col("vec_id") / 2).alias("example_id"),
                          F.slice("embedding", 1, 32).alias("start_logits"), F.slice("embedding", 33, 32).alias("end_logits"),
                          offsets.alias("offset_mapping"))


@query("qa_nbest_span", """
WITH l AS (SELECT vec_id, vec_id // 2 AS example_id, i, embedding[i + 1]::DOUBLE AS s, embedding[i + 33]::DOUBLE AS e
           FROM (SELECT vec_id, embedding, unnest(range(32)) AS i FROM embeddings)),
     r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, i) AS sr, row_number() OVER (PARTITION BY vec_id ORDER BY e DESC, i) AS er FROM l),
     c AS (SELECT a.example_id, a.vec_id, a.i AS si, b.i AS ei, a.s + b.e AS score, a.sr, b.er FROM r a JOIN r b ON a.vec_id = b.vec_id
           WHERE a.sr <= 20 AND b.er <= 20 AND a.i >= 4 AND b.i >= 4 AND b.i >= a.i AND b.i - a.i + 1 <= 30),
     best AS (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, vec_id, sr, er) AS rn FROM c)
SELECT d.doc_id AS example_id, coalesce(substr(text, si * 4 + 1, (ei - si) * 4 + 3), '') AS prediction_text, round(score, 6) AS score
FROM documents d LEFT JOIN best ON best.example_id = d.doc_id AND rn = 1""")
def qa_nbest_span(spark, d):
    examples = t.documents(spark, d).select(F.col("doc_id").alias("example_id"), F.col("text").alias("context"))
    best = qa.qa_nbest_span(examples, logit_features(spark, d))
    return best.withColumn("score", F.round("score", 6))


@query("join_features_to_examples", """
SELECT d.doc_id AS example_id, count(e.vec_id) AS n_features FROM documents d LEFT JOIN embeddings e ON e.vec_id // 2 = d.doc_id GROUP BY d.doc_id""")
def join_features_to_examples(spark, d):
    examples = t.documents(spark, d).select(F.col("doc_id").alias("example_id"))
    both = qa.join_features_to_examples(examples, logit_features(spark, d).select("example_id", "feature_id"))
    return both.groupBy("example_id").agg(F.count("feature_id").alias("n_features"))
