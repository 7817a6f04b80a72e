"""Corpus metrics over labels, text pairs and baseline summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..functions.scalars import round_pct
from ..operators import metrics as M
from ..operators.user_code import Metric, evaluate
from ..session import spread
from . import tables as t
from .registry import query
from .shaping import SQL_SENTENCES


SQL_ACCURACY = """
SELECT round(avg(coalesce(p = y, false)::INTEGER), 9) AS accuracy,
  round(2.0 * count(*) FILTER (p = 1 AND y = 1) / (count(*) FILTER (p = 1) + count(*) FILTER (y = 1)), 9) AS f1
FROM (SELECT (n_chars > 1000)::INTEGER AS p, quality AS y FROM documents JOIN labels USING (doc_id))"""


@query("accuracy_f1", SQL_ACCURACY)
def accuracy_f1(spark, d):
    rows = t.documents(spark, d).join(t.read(spark, d, "labels"), "doc_id")
    scores = M.accuracy_f1(rows.select((F.col("n_chars") > 1000).cast("int").alias("p"), "quality"), "p", "quality")
    return scores.select(F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1"))


def _right(rows: list[dict]) -> dict:
    pairs = [(r["p"], r["quality"]) for r in rows]
    return {"rows": len(pairs), "right": sum(p is not None and p == y for p, y in pairs), "hit": sum(p == y == 1 for p, y in pairs),
            "said": sum(p == 1 for p, _ in pairs), "true": sum(y == 1 for _, y in pairs)}


def _scores(s: dict) -> dict:
    named = s["said"] + s["true"]
    return {"accuracy": round(s["right"] / s["rows"], 9) if s["rows"] else None, "f1": round(2 * s["hit"] / named, 9) if named else 0.0}


ACCURACY_F1 = Metric("rows bigint, right bigint, hit bigint, said bigint, true bigint", "accuracy double, f1 double",
                     lambda: _right([]), _right, lambda a, b: {k: a[k] + b[k] for k in a}, _scores)


@query("metric_object", SQL_ACCURACY)
def metric_object(spark, d):
    rows = t.documents(spark, d).join(t.read(spark, d, "labels"), "doc_id")
    return evaluate(rows.select((F.col("n_chars") > 1000).cast("int").alias("p"), "quality"), ACCURACY_F1)


def _sql_gram_rows(table: str, tokens: str, orders: list[int]) -> str:
    return " UNION ALL ".join(
        f"""SELECT example_id, {n} AS n, array_to_string(ts[i : i + {n - 1}], ' ') AS gram FROM (
          SELECT example_id, ts, unnest(range(1, len(ts) - {n - 2})) AS i FROM (SELECT example_id, {tokens} AS ts FROM {table}))""" for n in orders)


def _sql_overlap(table: str, pred: str, ref: str, orders: list[int]) -> str:
    """Per pair and order: both gram counts and the clipped overlap."""
    return f"""
SELECT example_id, n, sum(p) AS pred, sum(r) AS ref, sum(least(p, r)) AS hit FROM (
  SELECT example_id, n, gram, count(*) FILTER (side = 'p') AS p, count(*) FILTER (side = 'r') AS r FROM (
    SELECT 'p' AS side, * FROM ({_sql_gram_rows(table, pred, orders)}) UNION ALL SELECT 'r', * FROM ({_sql_gram_rows(table, ref, orders)}))
  GROUP BY ALL) GROUP BY ALL"""


def _sql_bleu_tokens(text: str) -> str:
    return f"regexp_extract_all({text}, {t.SQL_BERT})"



@query("bleu", f"""
WITH p AS MATERIALIZED ({t.SQL_PAIRS}), o AS ({_sql_overlap('p', _sql_bleu_tokens('question'), _sql_bleu_tokens('context'), [1, 2, 3, 4])}),
     s AS (SELECT n, sum(pred) AS pred, sum(ref) AS ref, sum(hit) AS hit FROM o GROUP BY n),
     m AS (SELECT *, sum((hit = 0)::INTEGER) OVER (ORDER BY n) AS misses FROM s),
     l AS (SELECT avg(ln(CASE WHEN hit = 0 THEN 1.0 / (pow(2.0, misses) * pred) ELSE hit / pred END)) AS mean FROM m),
     len AS (SELECT pred AS c, ref AS r FROM s WHERE n = 1)
SELECT round(100 * CASE WHEN c >= r THEN 1.0 ELSE exp(1 - r / c) END * exp(mean), 6) AS bleu, round(CASE WHEN c >= r THEN 1.0::DOUBLE ELSE exp(1 - r / c) END, 9) AS brevity,
  c::BIGINT AS pred_len, r::BIGINT AS ref_len FROM l, len""")
def bleu(spark, d):
    score = M.bleu(spread(t.pairs(spark, d)), "example_id", "question", "context")
    return score.select(F.round("bleu", 6).alias("bleu"), F.round("brevity", 9).alias("brevity"), "pred_len", "ref_len")


def _sql_rouge_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"



def _sql_rouge(table: str, pred: str, ref: str) -> str:
    return f"""SELECT p.example_id, k.n, coalesce(hit / nullif(pred, 0), 0) AS precision, coalesce(hit / nullif(ref, 0), 0) AS recall,
      coalesce(2 * hit / nullif(pred + ref, 0), 0) AS fmeasure FROM {table} p CROSS JOIN (SELECT unnest([1, 2]) AS n) k
      LEFT JOIN ({_sql_overlap(table, _sql_rouge_tokens(pred), _sql_rouge_tokens(ref), [1, 2])}) o ON o.example_id = p.example_id AND o.n = k.n"""


@query("rouge_n", f"""
WITH p AS MATERIALIZED ({t.SQL_PAIRS})
SELECT n, round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall, round(avg(fmeasure), 9) AS fmeasure FROM ({_sql_rouge('p', 'question', 'context')}) GROUP BY n""")
def rouge_n(spark, d):
    scores = M.rouge_n(spread(t.pairs(spark, d)), "example_id", "question", "context")
    return scores.select("n", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "fmeasure")])


@query("rouge_l", f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT example_id, {_sql_rouge_tokens('question')} AS a, {_sql_rouge_tokens('context')} AS b FROM ({t.SQL_PAIRS})),
     steps AS (
       SELECT example_id, a, b, 0 AS i, list_transform(b, lambda x: 0) AS best FROM p
       UNION ALL
       SELECT example_id, a, b, i + 1, list_transform(c, lambda x, j: list_max(c[1:j])) FROM (
         SELECT example_id, a, b, i, list_transform(b, lambda x, j: CASE WHEN x = a[i + 1] THEN coalesce(best[j - 1], 0) + 1 ELSE best[j] END) AS c
         FROM steps WHERE i < len(a))),
     hits AS (SELECT len(a) AS pred, len(b) AS ref, coalesce(best[-1], 0) AS hit FROM steps WHERE i = len(a))
SELECT round(avg(coalesce(hit / nullif(pred, 0), 0)), 9) AS precision, round(avg(coalesce(hit / nullif(ref, 0), 0)), 9) AS recall,
  round(avg(coalesce(2 * hit / nullif(pred + ref, 0), 0)), 9) AS fmeasure FROM hits""")
def rouge_l(spark, d):
    means = M.mean_scores(M.rouge_l_rows(spread(t.pairs(spark, d)), "example_id", "question", "context"))
    return means.select(*[F.round(c, 9).alias(c) for c in means.columns])


@query("rouge_lsum")
def rouge_lsum(spark, d):
    lines = spread(t.pairs(spark, d)).select(
        "example_id", M.by_sentence("question").alias("question"), M.by_sentence("context").alias("context"))
    return M.mean_scores(M.rouge_lsum_rows(lines, "example_id", "question", "context"))


def lead_summaries(spark, d) -> DataFrame:
    """Documents with their first line as the title and a lead-three summary of the whole text."""
    return t.spread_documents(spark, d).select(
        F.col("doc_id").alias("example_id"), F.split("text", "\n")[0].alias("title"), T.lead_summary("text", 3).alias("summary"))


@query("lead3_baseline", f"""
WITH p AS MATERIALIZED (SELECT doc_id AS example_id, string_split(text, chr(10))[1] AS title, array_to_string(({SQL_SENTENCES})[1:3], chr(10)) AS summary FROM documents)
SELECT n, round_even(avg(fmeasure) * 100, 2) AS fmeasure FROM ({_sql_rouge('p', 'summary', 'title')}) GROUP BY n""")
def lead3_baseline(spark, d):
    scores = M.rouge_n(lead_summaries(spark, d), "example_id", "summary", "title")
    return scores.select("n", round_pct("fmeasure").alias("fmeasure"))


def _sql_squad(text: str) -> str:
    """Words without punctuation and articles; RE2 has ASCII word boundaries only, so articles go by word."""
    bare = f"regexp_replace(lower({text}), {t.re2(M.ASCII_PUNCTUATION)}, '', 'g')"
    return f"array_to_string(list_filter({t.sql_words(bare)}, lambda w: w NOT IN ('a', 'an', 'the')), ' ')"


@query("squad_em_f1", f"""
WITH p AS MATERIALIZED (SELECT example_id * 10 + k AS example_id, {_sql_squad('question')} AS q, {_sql_squad('ref')} AS r FROM (
       SELECT example_id, question, unnest(refs) AS ref, generate_subscripts(refs, 1) AS k FROM (
         SELECT example_id, question, [context, array_to_string(string_split(question, ' ')[2:], ' ')] AS refs FROM ({t.SQL_PAIRS})))),
     o AS ({_sql_overlap('p', "list_filter(string_split(q, ' '), lambda w: w <> '')", "list_filter(string_split(r, ' '), lambda w: w <> '')", [1])}),
     s AS (SELECT p.example_id // 10 AS id, max((q = r)::INTEGER) AS em, max(coalesce(2 * hit / nullif(pred + ref, 0), 0)) AS f1
           FROM p LEFT JOIN o USING (example_id) GROUP BY 1)
SELECT round(avg(em) * 100, 6) AS exact_match, round(avg(f1) * 100, 6) AS f1 FROM s""")
def squad_em_f1(spark, d):
    without_first = F.regexp_replace("question", "^[^ ]* ?", "")
    rows = spread(t.pairs(spark, d)).select("example_id", "question", F.array("context", without_first).alias("refs"))
    scores = M.squad_em_f1(rows, "example_id", "question", "refs")
    return scores.select(F.round("exact_match", 6).alias("exact_match"), F.round("f1", 6).alias("f1"))
