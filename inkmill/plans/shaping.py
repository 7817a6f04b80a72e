"""Queries on shaping, filtering, sampling and combining a corpus."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import invert_map
from ..operators import combine, ordering, sampling, shaping
from . import tables as t
from .registry import query

KEYWORDS = ["tion", "ment la", "over", "Der "]
SQL_KEYWORD_HIT = "(" + " OR ".join(f"contains(text, '{k}')" for k in KEYWORDS) + ")"
WORD_COUNT = f"len({t.sql_words('text')})"


@query("shape_reviews", f"""
SELECT source, count(*) AS n FROM documents
WHERE text IS NOT NULL AND len({t.sql_words('lower(text)')}) > 30
GROUP BY source ORDER BY n DESC, source LIMIT 20""")
def shape_reviews(spark, d):
    docs = t.documents(spark, d).filter(F.col("text").isNotNull())
    lowered = shaping.map_columns(docs, text=F.lower("text"))
    return shaping.value_counts_topn(shaping.filter_min_words(lowered, "text", 30), "source")


@query("rename_column", "SELECT doc_id AS review_id, lang AS language, n_chars FROM documents")
def rename_column(spark, d):
    docs = t.documents(spark, d).select("doc_id", "lang", "n_chars")
    return docs.withColumnRenamed("doc_id", "review_id").withColumnRenamed("lang", "language")


@query("drop_to_keep_list", "SELECT doc_id, lang, source FROM documents")
def drop_to_keep_list(spark, d):
    return shaping.keep_columns(t.documents(spark, d), ["doc_id", "lang", "source"])


@query("drop_columns", "SELECT doc_id, source, n_chars FROM documents")
def drop_columns(spark, d):
    return t.documents(spark, d).drop("text", "lang")


@query("map_overwrite", "SELECT doc_id, lower(text) AS text FROM documents")
def map_overwrite(spark, d):
    return shaping.map_columns(t.documents(spark, d), text=F.lower("text")).select("doc_id", "text")


@query("map_add", f"SELECT doc_id, {WORD_COUNT}::INTEGER AS review_length FROM documents")
def map_add(spark, d):
    return shaping.map_columns(t.spread_documents(spark, d), review_length=T.word_count("text")).select("doc_id", "review_length")


def _count_words(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": frame["doc_id"], "review_length": [len(x.split()) for x in frame["text"]]})


@query("map_batched", f"SELECT doc_id, {WORD_COUNT}::BIGINT AS review_length FROM documents")
def map_batched(spark, d):
    return shaping.map_batches(t.documents(spark, d).select("doc_id", "text"), _count_words, "doc_id bigint, review_length bigint")


@query("map_parallel", f"SELECT doc_id, {WORD_COUNT}::BIGINT AS review_length FROM documents")
def map_parallel(spark, d):
    return shaping.map_batches(t.documents(spark, d).select("doc_id", "text"), _count_words,
                               "doc_id bigint, review_length bigint", parallel=True)


def _lines(frame: pd.DataFrame) -> pd.DataFrame:
    rows = [(i, no, line) for i, text in zip(frame["doc_id"], frame["text"]) for no, line in enumerate(text.split("\n"))]
    return pd.DataFrame(rows, columns=["doc_id", "line_no", "line"])


@query("flat_map_batched", """
SELECT doc_id, i - 1 AS line_no, line FROM (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))""")
def flat_map_batched(spark, d):
    return shaping.map_batches(t.documents(spark, d).select("doc_id", "text"), _lines, "doc_id bigint, line_no bigint, line string")


@query("filter_not_null", "SELECT doc_id, source AS condition FROM documents WHERE lang <> 'de'")
def filter_not_null(spark, d):
    docs = t.documents(spark, d).select("doc_id", F.when(F.col("lang") != "de", F.col("source")).alias("condition"))
    return docs.filter(F.col("condition").isNotNull())


@query("filter_min_words", f"SELECT doc_id, lang FROM documents WHERE {WORD_COUNT} > 30")
def filter_min_words(spark, d):
    return shaping.filter_min_words(t.documents(spark, d), "text", 30).select("doc_id", "lang")


SQL_COMMENTS = "list_filter(string_split(text, chr(10)), lambda x: contains(x, ','))"


def _comments():
    return F.filter(F.split("text", "\n"), lambda x: x.contains(","))


@query("filter_bool_and_nonempty", f"""
SELECT doc_id, len(comments)::INTEGER AS n_comments FROM (
  SELECT doc_id, lang = 'en' AS is_pull_request, {SQL_COMMENTS} AS comments FROM documents)
WHERE NOT is_pull_request AND len(comments) > 0""")
def filter_bool_and_nonempty(spark, d):
    docs = t.documents(spark, d).select("doc_id", (F.col("lang") == "en").alias("is_pull_request"), _comments().alias("comments"))
    kept = shaping.filter_bool_and_nonempty(docs, "is_pull_request", "comments")
    return kept.select("doc_id", F.size("comments").alias("n_comments"))


@query("filter_in_set", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'es')")
def filter_in_set(spark, d):
    return t.documents(spark, d).filter(F.col("lang").isin("en", "es")).select("doc_id", "lang")


@query("filter_keywords", f"SELECT doc_id, text FROM documents WHERE {SQL_KEYWORD_HIT}")
def filter_keywords(spark, d):
    return shaping.filter_keywords(t.documents(spark, d), "text", KEYWORDS).select("doc_id", "text")


@query("contains_any", f"SELECT doc_id, {SQL_KEYWORD_HIT} AS hit FROM documents")
def contains_any(spark, d):
    return t.documents(spark, d).select("doc_id", T.contains_any("text", KEYWORDS).alias("hit"))


@query("keyword_retention", f"""
SELECT count(*) AS total, count(*) FILTER ({SQL_KEYWORD_HIT}) AS kept, round(avg({SQL_KEYWORD_HIT}::INTEGER), 8) AS retained
FROM documents""")
def keyword_retention(spark, d):
    out = shaping.keyword_retention(t.documents(spark, d), "text", KEYWORDS)
    return out.withColumn("retained", F.round("retained", 8))


@query("row_select", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25 OFFSET 100")
def row_select(spark, d):
    return shaping.row_slice(t.documents(spark, d), "doc_id", 100, 125).select("doc_id", "lang")


@query("text_concat", """
SELECT d.doc_id, source || ' ' || chr(10) || ' ' || text || ' ' || chr(10) || ' ' || quality AS text
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def text_concat(spark, d):
    rows = t.documents(spark, d).join(t.read(spark, d, "labels"), "doc_id")
    sep = F.lit(" \n ")
    return rows.select("doc_id", F.concat("source", sep, "text", sep, F.col("quality").cast("string")).alias("text"))


@query("nested_field_access", """
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, 'en-' || event_type AS en,
       CASE WHEN event_type = 'click' THEN event_type END AS first_text FROM events""")
def nested_field_access(spark, d):
    rows = t.read(spark, d, "events").select(
        "event_id", F.from_json("props", "k bigint").alias("props"),
        F.struct(F.concat(F.lit("en-"), "event_type").alias("en")).alias("translation"),
        F.struct(F.when(F.col("event_type") == "click", F.array("event_type")).otherwise(
            F.array().cast("array<string>")).alias("text")).alias("answers"))
    return rows.select("event_id", F.col("props.k").alias("k"), F.col("translation.en").alias("en"),
                       F.get("answers.text", F.lit(0)).alias("first_text"))


@query("preview_truncate", """
SELECT doc_id::VARCHAR AS "DOC_ID", substr(text, 1, 200) AS "TEXT", lang AS "LANG" FROM documents""")
def preview_truncate(spark, d):
    return shaping.preview(t.documents(spark, d).select("doc_id", "text", "lang"))


@query("strip", f"SELECT doc_id, {t.sql_strip('chr(160) || text || chr(10)')} AS text FROM documents")
def strip(spark, d):
    padded = F.concat(F.lit(" "), "text", F.lit("\n"))
    return t.documents(spark, d).select("doc_id", T.strip(padded).alias("text"))


@query("lower", "SELECT doc_id, lower(text) AS lowered FROM documents")
def lower(spark, d):
    return t.documents(spark, d).select("doc_id", F.lower("text").alias("lowered"))


@query("word_count", f"SELECT doc_id, {WORD_COUNT}::INTEGER AS n_words FROM documents")
def word_count(spark, d):
    return t.spread_documents(spark, d).select("doc_id", T.word_count("text").alias("n_words"))


# The entities of the table, also without their semicolon.
SQL_UNESCAPED_FULL = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '&quot;?', '\"', 'g'), '&copy;?', '©', 'g'), "
                      "'&middot;?', '·', 'g'), '&amp;?', '&', 'g')")


@query("html_unescape", f"SELECT page_id, {SQL_UNESCAPED_FULL} AS html FROM pages")
def html_unescape(spark, d):
    return t.read(spark, d, "pages").select("page_id", T.html_unescape("html").alias("html"))


@query("html_unescape_native", f"SELECT page_id, {SQL_UNESCAPED_FULL} AS html FROM pages")
def html_unescape_native(spark, d):
    return t.read(spark, d, "pages").select("page_id", T.html_unescape_native("html").alias("html"))


SQL_SENTENCES = (f"list_filter(string_split(regexp_replace({t.sql_strip('text')}, {t.re2('([.!?])' + T.WHITESPACE + '+')}, "
                 "'\\1' || chr(3), 'g'), chr(3)), lambda s: s <> '')")


@query("sent_split", f"SELECT doc_id, len(s)::INTEGER AS n, array_to_string(s, '|') AS sentences FROM (SELECT doc_id, {SQL_SENTENCES} AS s FROM documents)")
def sent_split(spark, d):
    docs = t.spread_documents(spark, d).select("doc_id", T.sent_split("text").alias("s"))
    return docs.select("doc_id", F.size("s").alias("n"), t.joined("s", "|").alias("sentences"))


@query("lead_k_summary", f"SELECT doc_id, array_to_string(({SQL_SENTENCES})[1:3], chr(10)) AS summary FROM documents")
def lead_k_summary(spark, d):
    return t.spread_documents(spark, d).select("doc_id", T.lead_summary("text", 3).alias("summary"))


@query("array_concat_text", f"SELECT doc_id, array_to_string({SQL_SENTENCES}, chr(10)) AS text FROM documents")
def array_concat_text(spark, d):
    return t.spread_documents(spark, d).select("doc_id", F.array_join(T.sent_split("text"), "\n").alias("text"))


@query("substring_by_offset", "SELECT doc_id, substr(text, 4, n_chars // 2 - 3) AS span FROM documents WHERE n_chars >= 8")
def substring_by_offset(spark, d):
    docs = t.documents(spark, d).filter("n_chars >= 8")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return docs.select("doc_id", T.substring_by_offset("text", F.lit(3), half).alias("span"))


@query("round_pct", "SELECT doc_id, round_even(n_chars / 7.0::DOUBLE * 100, 2) AS pct FROM documents")
def round_pct(spark, d):
    from ..functions.scalars import round_pct as pct

    return t.documents(spark, d).select("doc_id", pct(F.col("n_chars") / F.lit(7.0)).alias("pct"))


@query("value_counts_topn", "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY n DESC, source LIMIT 20")
def value_counts_topn(spark, d):
    return shaping.value_counts_topn(t.documents(spark, d), "source")


@query("corpus_length_stats", f"""
SELECT count(*) AS n_rows, sum(n)::BIGINT AS total, round(avg(n), 6) AS mean, min(n)::INTEGER AS min, max(n)::INTEGER AS max
FROM (SELECT {WORD_COUNT} AS n FROM documents)""")
def corpus_length_stats(spark, d):
    stats = shaping.length_stats(t.spread_documents(spark, d), T.word_count("text"))
    return stats.select("n_rows", "total", F.round("mean", 6).alias("mean"), "min", "max")


@query("unique_row_count", f"""
SELECT doc_id, count(*) AS n_features FROM (SELECT doc_id, unnest(range(len(ids) // 128)) AS c
FROM (SELECT doc_id, {t.sql_words('text')} AS ids FROM documents)) GROUP BY doc_id""")
def unique_row_count(spark, d):
    from ..operators.examples import chunk_overflow

    features = chunk_overflow(t.spread_documents(spark, d).select("doc_id", T.words("text").alias("ids")), "ids", 128)
    return features.groupBy("doc_id").agg(F.count("*").alias("n_features"))


# Order, samples and splits.

@query("batch_assign", "SELECT doc_id, lang, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 32 AS batch_id FROM documents")
def batch_assign(spark, d):
    return ordering.batch_assign(t.documents(spark, d).select("doc_id", "lang"), 32, "doc_id", ["lang"])


@query("running_offset", f"""
SELECT doc_id, batch_id, (coalesce(sum(n) OVER (PARTITION BY batch_id ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS "offset"
FROM (SELECT doc_id, {WORD_COUNT} AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch_id FROM documents)""")
def running_offset(spark, d):
    batched = ordering.batch_assign(t.spread_documents(spark, d).select("doc_id", T.word_count("text").alias("n")), 100, "doc_id")
    return ordering.running_offset(batched, F.col("n"), ["batch_id"], "doc_id").select("doc_id", "batch_id", "offset")


@query("rank_within_group", """
SELECT * FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id)::INTEGER AS rank FROM documents) WHERE rank <= 5""")
def rank_within_group(spark, d):
    docs = t.documents(spark, d).select("doc_id", "source", "n_chars")
    return ordering.rank_within_group(docs, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 5)


@query("sort_head", f"SELECT doc_id, {WORD_COUNT}::INTEGER AS review_length FROM documents ORDER BY review_length, doc_id LIMIT 3")
def sort_head(spark, d):
    return t.spread_documents(spark, d).select("doc_id", T.word_count("text").alias("review_length")).orderBy("review_length", "doc_id").limit(3)


@query("shuffle_seeded", "SELECT doc_id, lang, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position FROM documents")
def shuffle_seeded(spark, d):
    return sampling.shuffle_seeded(t.documents(spark, d).select("doc_id", "lang"), "doc_id", 42)


@query("sample_n", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 200")
def sample_n(spark, d):
    return sampling.sample_n(t.documents(spark, d).select("doc_id", "lang"), "doc_id", 200, 42)


SQL_RANKED = "SELECT doc_id, lang, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents"


@query("train_test_split_frac", f"SELECT doc_id, lang, CASE WHEN rn <= floor(0.8 * n) THEN 'train' ELSE 'validation' END AS split FROM ({SQL_RANKED})")
def train_test_split_frac(spark, d):
    docs = t.documents(spark, d).select("doc_id", "lang")
    return sampling.train_test_split_frac(docs, "doc_id", 0.8, 42, ("train", "validation"))


@query("train_test_split_abs", f"SELECT doc_id, lang, CASE WHEN rn <= 100 THEN 'train' ELSE 'test' END AS split FROM ({SQL_RANKED}) WHERE rn <= 110")
def train_test_split_abs(spark, d):
    return sampling.train_test_split_abs(t.documents(spark, d).select("doc_id", "lang"), "doc_id", 100, 10, 42)


# Sets.

@query("concat_datasets", "SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def concat_datasets(spark, d):
    docs = t.documents(spark, d).select("doc_id", "lang")
    return combine.concat_datasets(docs.filter("lang = 'en'"), docs.filter("lang = 'fr'"))


@query("interleave_datasets", """
WITH r AS (SELECT doc_id, lang, CASE lang WHEN 'en' THEN 0 ELSE 1 END AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
           FROM documents WHERE lang IN ('en', 'fr')),
     m AS (SELECT least(count(*) FILTER (part = 0), count(*) FILTER (part = 1)) AS n FROM r)
SELECT doc_id, lang, (rn - 1) * 2 + part AS position FROM r, m WHERE rn <= n""")
def interleave_datasets(spark, d):
    docs = t.documents(spark, d).select("doc_id", "lang")
    return combine.interleave_datasets([docs.filter("lang = 'en'"), docs.filter("lang = 'fr'")], "doc_id")


@query("dataset_dict_assign", f"""
SELECT doc_id, CASE WHEN rn <= floor(0.9 * n) THEN 'train' ELSE 'validation' END AS split FROM ({SQL_RANKED}) WHERE lang <> 'de'
UNION ALL SELECT doc_id, 'test' AS split FROM documents WHERE lang = 'de'""")
def dataset_dict_assign(spark, d):
    docs = t.documents(spark, d).select("doc_id", "lang")
    splits = combine.assign_splits(sampling.train_test_split_frac(docs, "doc_id", 0.9, 42), {"test": "validation"})
    splits = splits.filter("lang <> 'de'").drop("lang")
    return combine.split_off(splits, test=docs.filter("lang = 'de'").drop("lang"))


# Reshaping.

@query("explode_list", f"SELECT doc_id, unnest({SQL_SENTENCES}) AS sentence FROM documents")
def explode_list(spark, d):
    return t.spread_documents(spark, d).select("doc_id", F.explode(T.sent_split("text")).alias("sentence"))


@query("concat_arrays", f"""
SELECT batch_id, string_agg({t.sql_joined(t.sql_words('text'))}, ' ' ORDER BY doc_id) AS tokens
FROM (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id FROM documents)
WHERE len({t.sql_words('text')}) > 0 GROUP BY batch_id""")
def concat_arrays(spark, d):
    batched = ordering.batch_assign(t.spread_documents(spark, d).select("doc_id", T.words("text").alias("w")), 16, "doc_id")
    rows = F.sort_array(F.collect_list(F.struct("doc_id", "w")))
    flat = batched.groupBy("batch_id").agg(F.flatten(F.transform(rows, lambda r: r["w"])).alias("tokens"))
    return flat.select("batch_id", t.joined("tokens").alias("tokens"))


@query("to_pandas_view", "SELECT doc_id, upper(lang) AS lang FROM documents")
def to_pandas_view(spark, d):
    def upper(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(lang=frame["lang"].str.upper())

    return shaping.map_batches(t.documents(spark, d).select("doc_id", "lang"), upper, "doc_id bigint, lang string")


@query("label_maps", """
SELECT doc_id, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 END AS label, lang AS name FROM documents""")
def label_maps(spark, d):
    names = F.map_from_arrays(F.array(*[F.lit(i) for i in range(4)]), F.array(*[F.lit(x) for x in ("en", "fr", "de", "es")]))
    docs = t.documents(spark, d).select("doc_id", F.element_at(invert_map(names), F.col("lang")).alias("label"))
    return docs.withColumn("name", F.element_at(names, F.col("label")))
