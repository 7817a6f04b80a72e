"""Queries on pre-tokenisation, vocabulary statistics, training, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arrays as A, pretok as P, text as T
from ..functions.scalars import neg_log_prob, perplexity, token_perplexity
from ..operators import encoding, training, vocab
from ..session import cut_lineage, scratch_path
from . import tables as t
from .registry import query


# Pre-tokenisers.

@query("normalize_text", "SELECT doc_id, strip_accents(lower(text)) AS text FROM documents")
def normalize_text(spark, d):
    return t.spread_documents(spark, d).select("doc_id", T.normalize_text("text").alias("text"))


@query("normalize_text_full", "SELECT doc_id, strip_accents(lower(text)) AS text FROM documents")
def normalize_text_full(spark, d):
    return t.spread_documents(spark, d).select("doc_id", T.normalize_text_full("text").alias("text"))


def _pieces_row(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", F.size("pieces").alias("n"),
        t.joined(F.transform("pieces", lambda p: p["token"])).alias("tokens"),
        t.joined(F.transform("pieces", lambda p: p["start"])).alias("starts"),
        t.joined(F.transform("pieces", lambda p: p["end"])).alias("ends"))


def _sql_pieces(cover: str, keep: str = "true", shown: str = "token", table: str = "documents") -> str:
    """Located pieces of a covering list, joined per document."""
    return f"""
WITH c AS ({t.sql_tokens(table, 'doc_id', cover)}),
     o AS (SELECT doc_id, pos, token, (sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) - length(token))::BIGINT AS s FROM c),
     k AS (SELECT doc_id, pos, {shown} AS token, s, s + length(token) AS e FROM o WHERE {keep})
SELECT d.doc_id, count(pos)::INTEGER AS n, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens,
       coalesce(string_agg(s::VARCHAR, ' ' ORDER BY pos), '') AS starts, coalesce(string_agg(e::VARCHAR, ' ' ORDER BY pos), '') AS ends
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id"""


_NOT_BLANK = f"NOT regexp_matches(token, {t.re2('^' + T.WHITESPACE)})"
_WORD_COVER = f"regexp_extract_all(text, {t.re2(T.NOT_WHITESPACE + '+|' + T.WHITESPACE + '+')})"


@query("pretok_bert", _sql_pieces(f"regexp_extract_all(text, {t.re2(P.BERT_COVER)})", _NOT_BLANK))
def pretok_bert(spark, d):
    return _pieces_row(P.piece_offsets(t.spread_documents(spark, d), "text"))


@query("pretok_bytelevel", _sql_pieces(t.sql_byte_level_pieces("text"), "true", t.sql_byte_level("token")).replace("s + length(token) AS e", "s + length(o.token) AS e"))
def pretok_bytelevel(spark, d):
    return _pieces_row(P.bytelevel_offsets(t.spread_documents(spark, d), "text"))


@query("pretok_metaspace", _sql_pieces(_WORD_COVER, _NOT_BLANK, "'▁' || token").replace("s + length(token) AS e", "s + length(o.token) AS e"))
def pretok_metaspace(spark, d):
    return _pieces_row(P.metaspace_offsets(t.spread_documents(spark, d), "text"))


@query("pretok_whitespace", f"SELECT doc_id, array_to_string(regexp_extract_all(text, {t.SQL_WORD}), ' ') AS tokens FROM documents")
def pretok_whitespace(spark, d):
    return t.spread_documents(spark, d).select("doc_id", t.joined(P.pretok_whitespace("text")).alias("tokens"))


@query("pretok_sequence", f"""
SELECT doc_id, array_to_string(flatten(list_transform({t.sql_words('text')}, lambda w: regexp_extract_all(w, {t.SQL_PUNCT_SPLIT}))), ' ') AS tokens FROM documents""")
def pretok_sequence(spark, d):
    return t.spread_documents(spark, d).select("doc_id", t.joined(P.pretok_sequence("text")).alias("tokens"))


# Word tables of the three trainers.

def byte_words(spark, d) -> DataFrame:
    return vocab.word_freqs(t.spread_documents(spark, d), "doc_id", P.pretok_bytelevel_raw("text")).withColumn(
        "word", P.to_byte_level("word"))


def bert_words(spark, d) -> DataFrame:
    return vocab.word_freqs(t.spread_documents(spark, d), "doc_id", P.pretok_bert("text"))


def space_words(spark, d) -> DataFrame:
    return vocab.word_freqs(t.spread_documents(spark, d), "doc_id", P.pretok_metaspace("text"))


def _sql_freqs(tokens: str, shown: str = "token") -> str:
    return f"""SELECT {shown} AS word, freq, first_doc, first_pos, first_doc * 10000000 + first_pos AS ord FROM (
      SELECT token, count(*) AS freq, min(doc_id) AS first_doc, arg_min(pos, doc_id * 10000000 + pos) AS first_pos
      FROM ({t.sql_tokens('documents', 'doc_id', tokens)}) GROUP BY token)"""


SQL_BYTE_WORDS = _sql_freqs(t.sql_byte_level_pieces("text"), t.sql_byte_level("token"))
SQL_BERT_WORDS = _sql_freqs(f"regexp_extract_all(text, {t.SQL_BERT})")
SQL_SPACE_WORDS = _sql_freqs(f"list_transform({t.sql_words('text')}, lambda w: '▁' || w)")
SQL_SYMBOLS = "list_transform(string_split(word, ''), lambda c, i: CASE WHEN i > 1 THEN '##' || c ELSE c END)"


@query("word_freqs", f"SELECT word, freq, first_doc, first_pos FROM ({SQL_BERT_WORDS})")
def word_freqs(spark, d):
    first_doc, first_pos = vocab.first_place()
    return bert_words(spark, d).select("word", "freq", first_doc.alias("first_doc"), first_pos.alias("first_pos"))


@query("alphabet", f"""
SELECT DISTINCT 'bpe' AS kind, unnest(string_split(word, '')) AS symbol FROM ({SQL_BYTE_WORDS})
UNION ALL SELECT DISTINCT 'wordpiece', unnest({SQL_SYMBOLS}) FROM ({SQL_BERT_WORDS})""")
def alphabet(spark, d):
    plain = vocab.alphabet(byte_words(spark, d)).select(F.lit("bpe").alias("kind"), "symbol")
    return plain.unionByName(vocab.alphabet(bert_words(spark, d), "##").select(F.lit("wordpiece").alias("kind"), "symbol"))


def _sql_pairs(words: str, symbols: str) -> str:
    return f"""SELECT s[i] AS "left", s[i + 1] AS "right", sum(freq)::BIGINT AS freq, min(ord * 1000 + i) AS first FROM (
      SELECT freq, ord, s, unnest(range(1, len(s))) AS i FROM (SELECT freq, ord, {symbols} AS s FROM ({words}))) GROUP BY 1, 2"""


@query("pair_freqs", f"""SELECT "left", "right", freq FROM ({_sql_pairs(SQL_BYTE_WORDS, "string_split(word, '')")})""")
def pair_freqs(spark, d):
    return vocab.pair_freqs(training.initial_splits(byte_words(spark, d))).select("left", "right", "freq")


SQL_SCORES = f"""
WITH w AS MATERIALIZED (SELECT * FROM ({SQL_BERT_WORDS})), p AS ({_sql_pairs('SELECT * FROM w', SQL_SYMBOLS)}),
     l AS (SELECT symbol, sum(freq)::BIGINT AS freq FROM (SELECT freq, unnest({SQL_SYMBOLS}) AS symbol FROM w) GROUP BY symbol)
SELECT "left", "right", p.freq, p.freq::DOUBLE / (a.freq::DOUBLE * b.freq::DOUBLE) AS score, first
FROM p JOIN l a ON a.symbol = "left" JOIN l b ON b.symbol = "right\""""


@query("pair_scores", f"""SELECT "left", "right", freq, round(score, 12) AS score FROM ({SQL_SCORES})""")
def pair_scores(spark, d):
    scores = vocab.pair_scores(training.initial_splits(bert_words(spark, d), "##"))
    return scores.select("left", "right", "freq", F.round("score", 12).alias("score"))


@query("argmax_row", f"""
SELECT * FROM (SELECT 'bpe' AS kind, "left", "right" FROM ({_sql_pairs(SQL_BYTE_WORDS, "string_split(word, '')")}) ORDER BY freq DESC, first LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'wordpiece', "left", "right" FROM ({SQL_SCORES}) ORDER BY score DESC, first LIMIT 1)""")
def argmax_row(spark, d):
    best = vocab.argmax_pair(vocab.pair_freqs(training.initial_splits(vocab.rank_words(byte_words(spark, d)))), "freq")
    score = vocab.argmax_pair(vocab.pair_scores(training.initial_splits(vocab.rank_words(bert_words(spark, d)), "##")), "score")
    return best.select(F.lit("bpe").alias("kind"), "left", "right").unionByName(
        score.select(F.lit("wordpiece").alias("kind"), "left", "right"))


SQL_SUBSTRINGS = """SELECT word, freq, i, j, substr(word, i, j - i) AS token FROM (
  SELECT word, freq, i, unnest(range(i + 2, length(word) + 2)) AS j FROM (
    SELECT word, freq, unnest(range(1, length(word))) AS i FROM ({words})))"""


@query("subword_freqs", f"SELECT token, sum(freq)::BIGINT AS freq FROM ({SQL_SUBSTRINGS.format(words=SQL_SPACE_WORDS)}) GROUP BY token HAVING sum(freq) >= 20")
def subword_freqs(spark, d):
    return vocab.subword_freqs(space_words(spark, d), min_freq=20).select("token", "freq")


SQL_SEED = f"""
w AS MATERIALIZED (SELECT * FROM ({SQL_SPACE_WORDS})),
     c AS (SELECT token, sum(freq)::BIGINT AS freq FROM (SELECT freq, unnest(string_split(word, '')) AS token FROM w) GROUP BY token),
     s AS (SELECT token, sum(freq)::BIGINT AS freq, min(ord * 1000000 + i * 1000 + j) AS first
           FROM (SELECT s.*, w.ord FROM ({SQL_SUBSTRINGS.format(words='SELECT * FROM w')}) s JOIN w USING (word)) GROUP BY token),
seed AS MATERIALIZED (SELECT token, freq FROM c UNION ALL SELECT token, freq FROM (
  SELECT token, freq, row_number() OVER (ORDER BY freq DESC, first) AS rn FROM s) WHERE rn <= 300 - (SELECT count(*) FROM c))"""


@query("subword_topn", f"WITH {SQL_SEED} SELECT token, freq FROM seed")
def subword_topn(spark, d):
    return vocab.subword_topn(vocab.rank_words(space_words(spark, d)), 300).select("token", "freq")


SQL_CHAR_MODEL = f"""
w AS MATERIALIZED (SELECT * FROM ({SQL_SPACE_WORDS})),
c AS (SELECT token, sum(freq)::BIGINT AS freq FROM (SELECT freq, unnest(string_split(word, '')) AS token FROM w) GROUP BY token),
m AS (SELECT token, freq, -ln(freq / (SELECT sum(freq) FROM c)::DOUBLE) AS nlp FROM c)"""


def _char_model(words: DataFrame) -> DataFrame:
    chars = vocab.char_freqs(words).select("token", "freq")
    return chars.withColumn("nlp", neg_log_prob("freq", chars.agg(F.sum("freq")).scalar()))


@query("neg_log_prob", f"WITH {SQL_CHAR_MODEL} SELECT token, round(nlp, 9) AS nlp FROM m")
def neg_log_prob_query(spark, d):
    return _char_model(space_words(spark, d)).select("token", F.round("nlp", 9).alias("nlp"))


@query("corpus_loss", f"""
WITH {SQL_CHAR_MODEL}, s AS (SELECT word, any_value(u.freq) AS freq, sum(nlp) AS score FROM (
  SELECT word, freq, unnest(string_split(word, '')) AS ch FROM w) u JOIN m ON m.token = ch GROUP BY word)
SELECT round(sum(freq * score), 2) AS loss FROM s""")
def corpus_loss(spark, d):
    words = space_words(spark, d)
    chars = words.select("word", "freq", F.explode(vocab.symbols(F.col("word"))).alias("token"))
    coded = chars.join(_char_model(words).select("token", "nlp"), "token").groupBy("word", "freq").agg(F.sum("nlp").alias("score"))
    return training.corpus_loss(coded).select(F.round("loss", 2).alias("loss"))


SQL_WORD_NLL = f"""
w AS MATERIALIZED ({t.sql_tokens('documents', 'doc_id', t.sql_words('text'))}),
f AS (SELECT token, -ln(count(*)::DOUBLE / (SELECT count(*) FROM w)::DOUBLE) AS nlp FROM w GROUP BY token),
l AS (SELECT doc_id, sum(nlp) AS nll, count(*) AS n FROM w JOIN f USING (token) GROUP BY doc_id)"""


@query("perplexity", f"""
WITH {SQL_WORD_NLL} SELECT round(exp(avg(nll / n)), 4) AS mean_loss, round(exp(sum(nll) / sum(n)), 4) AS token_weighted FROM l""")
def perplexity_query(spark, d):
    tokens = vocab.explode_tokens(t.spread_documents(spark, d), ["doc_id"], T.words("text"), "pos", "token")
    freqs = tokens.groupBy("token").agg(F.count("*").alias("freq"))
    model = freqs.withColumn("nlp", neg_log_prob("freq", tokens.agg(F.count("*")).scalar()))
    per_doc = tokens.groupBy("doc_id", "token").agg(F.count("*").alias("k")).join(model, "token")
    losses = per_doc.groupBy("doc_id").agg(F.sum(F.col("nlp") * F.col("k")).alias("nll"), F.sum("k").alias("n"))
    return losses.agg(F.round(perplexity(F.col("nll") / F.col("n")), 4).alias("mean_loss"),
                      F.round(token_perplexity("nll", "n"), 4).alias("token_weighted"))


# Training. The SQL unrolls the same number of rounds.

BPE_MERGES, WORDPIECE_MERGES = 16, 6
_UNMARK = "string_split(marked[2:-2], chr(2) || chr(1))"


def _sql_rounds(words: str, symbols: str, n: int, scored: bool) -> str:
    """Rounds of pair counting and merging over marked words."""
    mark = f"array_to_string(list_transform({symbols}, lambda x: chr(1) || x || chr(2)), '')"
    parts = [f"r0 AS MATERIALIZED (SELECT freq, ord, {mark} AS marked FROM ({words}))"]
    for k in range(n):
        pairs = f"""SELECT s[i] AS l, s[i + 1] AS r, sum(freq)::BIGINT AS freq, min(ord * 1000 + i) AS first FROM (
            SELECT freq, ord, s, unnest(range(1, len(s))) AS i FROM (SELECT freq, ord, {_UNMARK} AS s FROM r{k})) GROUP BY 1, 2"""
        if scored:
            letters = f"SELECT x, sum(freq)::BIGINT AS freq FROM (SELECT freq, unnest({_UNMARK}) AS x FROM r{k}) GROUP BY x"
            pairs = f"""SELECT l, r, p.freq::DOUBLE / (a.freq::DOUBLE * b.freq::DOUBLE) AS freq, first
              FROM ({pairs}) p JOIN ({letters}) a ON a.x = l JOIN ({letters}) b ON b.x = r"""
        merged = "l || CASE WHEN starts_with(r, '##') THEN substr(r, 3) ELSE r END" if scored else "l || r"
        parts.append(f"b{k} AS MATERIALIZED (SELECT l, r, {merged} AS merged, freq FROM ({pairs}) ORDER BY freq DESC, first LIMIT 1)")
        parts.append(f"""r{k + 1} AS MATERIALIZED (SELECT r{k}.freq, ord, replace(marked, chr(1) || l || chr(2) || chr(1) || r || chr(2),
            chr(1) || merged || chr(2)) AS marked FROM r{k}, b{k})""")
    return "WITH " + ",\n".join(parts)


def _sql_merges(n: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT {k}::INTEGER AS rank, l AS "left", r AS "right", merged, round(freq::DOUBLE, 12) AS score FROM b{k}""" for k in range(n))


@query("train_bpe", _sql_rounds(SQL_BYTE_WORDS, "string_split(word, '')", BPE_MERGES, False) + _sql_merges(BPE_MERGES))
def train_bpe(spark, d):
    _, merges = training.train_bpe(byte_words(spark, d), n_merges=BPE_MERGES)
    return training.merge_table(spark, merges)


@query("train_wordpiece", _sql_rounds(SQL_BERT_WORDS, SQL_SYMBOLS, WORDPIECE_MERGES, True) + _sql_merges(WORDPIECE_MERGES))
def train_wordpiece(spark, d):
    _, merges = training.train_wordpiece(bert_words(spark, d), n_merges=WORDPIECE_MERGES)
    return training.merge_table(spark, merges).withColumn("score", F.round("score", 12))


@query("train_unigram")
def train_unigram(spark, d):
    """Pruned from 300 seed tokens to 100, as the reference does; characters stay, also where they are more."""
    scores = training.train_unigram(space_words(spark, d), vocab_size=100, seed_size=300)
    return training.score_table(spark, scores)


@query("train_from_corpus", _sql_rounds(SQL_BYTE_WORDS, "string_split(word, '')", 8, False) + f"""
SELECT round(sum(a.freq * len({_UNMARK.replace('marked', 'a.marked')}))::DOUBLE / (SELECT count(*) FROM documents), 6) AS old_tokens,
       (SELECT round(sum(freq * len({_UNMARK}))::DOUBLE / (SELECT count(*) FROM documents), 6) FROM r8) AS new_tokens FROM r0 a""")
def train_from_corpus(spark, d):
    words = byte_words(spark, d)
    _, merges = training.train_bpe(words, n_merges=8)
    coded = encoding.encode_bpe(words.withColumn("w", F.array("word")), F.col("w"), training.merge_table(spark, merges))
    n_docs = t.documents(spark, d).agg(F.count("*")).scalar()
    return coded.agg(F.round(F.sum(F.col("freq") * F.length("word")) / n_docs, 6).alias("old_tokens"),
                     F.round(F.sum(F.col("freq") * F.size(F.flatten("pieces"))) / n_docs, 6).alias("new_tokens"))


@query("merge_pair", f"""
WITH w AS MATERIALIZED (SELECT word, freq, ord, string_split(word, '') AS s FROM ({SQL_BYTE_WORDS})),
     b AS (SELECT "left" AS l, "right" AS r FROM ({_sql_pairs('SELECT * FROM w', 's')}) ORDER BY freq DESC, first LIMIT 1)
SELECT word, array_to_string(string_split((replace(array_to_string(list_transform(s, lambda x: chr(1) || x || chr(2)), ''),
  chr(1) || l || chr(2) || chr(1) || r || chr(2), chr(1) || l || r || chr(2)))[2:-2], chr(2) || chr(1)), ' ') AS syms FROM w, b""")
def merge_pair(spark, d):
    splits = training.initial_splits(cut_lineage(vocab.rank_words(byte_words(spark, d))))
    best = vocab.argmax_pair(vocab.pair_freqs(splits), "freq").first()
    return training.merge_pair(splits, best.left, best.right).select("word", t.joined("syms").alias("syms"))


# Training to full sizes; SQL would unroll thousands of rounds, so tests hold these against one merge at a time.

@query("train_bpe_25k")
def train_bpe_25k(spark, d):
    """A vocabulary of 25,000, or as many as the corpus has merges for."""
    _, merges = training.train_bpe(byte_words(spark, d), vocab_size=25_000)
    return training.merge_table(spark, merges)


@query("train_wordpiece_500")
def train_wordpiece_500(spark, d):
    _, merges = training.train_wordpiece(bert_words(spark, d), n_merges=500)
    return training.merge_table(spark, merges)


@query("train_unigram_100")
def train_unigram_100(spark, d):
    """Pruned to 100 tokens; characters stay, also where they are more."""
    return training.score_table(spark, training.train_unigram(space_words(spark, d), vocab_size=100, seed_size=300))


@query("corpus_loss_unigram")
def corpus_loss_unigram(spark, d):
    """The loss of the corpus under a trained model, by the best path of each distinct word."""
    words = cut_lineage(space_words(spark, d))
    scores = training.train_unigram(words, vocab_size=200, seed_size=300)
    return training.corpus_loss(encoding.viterbi_words(words, scores)).select(F.round("loss", 2).alias("loss"))


@query("train_from_corpus_52k")
def train_from_corpus_52k(spark, d):
    """Mean number of tokens a document before and after training to a vocabulary of 52,000."""
    words = cut_lineage(byte_words(spark, d))
    _, merges = training.train_bpe(words, vocab_size=52_000)
    coded = encoding.encode_bpe(words.withColumn("w", F.array("word")), F.col("w"), training.merge_table(spark, merges))
    n_docs = t.documents(spark, d).agg(F.count("*")).scalar()
    return coded.agg(F.round(F.sum(F.col("freq") * F.length("word")) / n_docs, 6).alias("old_tokens"),
                     F.round(F.sum(F.col("freq") * F.size(F.flatten("pieces"))) / n_docs, 6).alias("new_tokens"))


@query("encode_bpe_trained")
def encode_bpe_trained(spark, d):
    """Every document by the merges of a vocabulary of 25,000 trained on all of them."""
    _, merges = training.train_bpe(byte_words(spark, d), vocab_size=25_000)
    return _flat(encoding.encode_bpe(t.spread_documents(spark, d), P.pretok_bytelevel_raw("text"), training.merge_table(spark, merges), byte_level=True))


# Encoding.

N_RULES = 40


def _rules(spark, d) -> DataFrame:
    """The most frequent pairs of the corpus as merge rules in order."""
    pairs = vocab.pair_freqs(training.initial_splits(byte_words(spark, d))).orderBy(F.desc("freq"), "left", "right").limit(N_RULES)
    ranked = pairs.select(F.row_number().over(t.rules_window()).alias("rank"), "left", "right")
    return ranked.withColumn("merged", F.concat("left", "right"))


SQL_ENCODE_BPE = f"""
WITH w AS MATERIALIZED (SELECT * FROM ({SQL_BYTE_WORDS})),
     p AS (SELECT "left" AS l, "right" AS r, freq FROM ({_sql_pairs('SELECT * FROM w', "string_split(word, '')")}) ORDER BY freq DESC, l, r LIMIT {N_RULES}),
     rules AS (SELECT list(chr(1) || l || chr(2) || chr(1) || r || chr(2) || chr(3) || chr(1) || l || r || chr(2) ORDER BY freq DESC, l, r) AS rs FROM p),
     e AS MATERIALIZED (SELECT word, string_split((list_reduce(list_concat([array_to_string(list_transform(string_split(word, ''), lambda x: chr(1) || x || chr(2)), '')], rs),
          lambda acc, rule: replace(acc, split_part(rule, chr(3), 1), split_part(rule, chr(3), 2))))[2:-2], chr(2) || chr(1)) AS pieces FROM w, rules),
     k AS (SELECT doc_id, pos, {t.sql_byte_level('token')} AS word FROM ({t.sql_tokens('documents', 'doc_id', t.sql_byte_level_pieces('text'))}))
SELECT doc_id, sum(len(pieces))::BIGINT AS n, string_agg(array_to_string(pieces, ' '), ' ' ORDER BY pos) AS tokens FROM k JOIN e USING (word) GROUP BY doc_id"""


def _flat(coded: DataFrame, kind: str = "bigint") -> DataFrame:
    flat = coded.select("doc_id", F.flatten("pieces").alias("tokens"))
    return flat.select("doc_id", F.size("tokens").cast(kind).alias("n"), t.joined("tokens").alias("tokens"))


@query("encode_bpe", SQL_ENCODE_BPE)
def encode_bpe(spark, d):
    return _flat(encoding.encode_bpe(t.spread_documents(spark, d), P.pretok_bytelevel_raw("text"), _rules(spark, d), byte_level=True))


@query("encode_bpe_join", SQL_ENCODE_BPE)
def encode_bpe_join(spark, d):
    return _flat(encoding.encode_bpe_join(t.spread_documents(spark, d), "doc_id", P.pretok_bytelevel("text"), _rules(spark, d)))


def wordpiece_vocab(spark, d) -> DataFrame:
    """Characters and the 500 most frequent subwords of the normalised corpus, initial and continued."""
    words = vocab.word_freqs(t.spread_documents(spark, d), "doc_id", P.pretok_bert(T.normalize_text("text")))
    return vocab.wordpiece_test_vocab(cut_lineage(words), 500)  # read more than once


SQL_NORMAL = "strip_accents(lower(text))"
SQL_NORMAL_TOKENS = t.sql_tokens("documents", "doc_id", f"regexp_extract_all({SQL_NORMAL}, {t.SQL_BERT})")
SQL_WORDPIECE = f"""
w AS MATERIALIZED (SELECT token AS word, count(*) AS freq FROM ({SQL_NORMAL_TOKENS}) GROUP BY token),
top AS (SELECT token FROM ({SQL_SUBSTRINGS.format(words='SELECT * FROM w')}) GROUP BY token ORDER BY sum(freq) DESC, token LIMIT 500),
vocabulary AS MATERIALIZED (SELECT DISTINCT unnest(string_split(word, '')) AS token FROM w UNION ALL SELECT token FROM top),
spans AS (SELECT word, i, unnest(range(i + 1, length(word) + 2)) AS j FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
longest AS MATERIALIZED (SELECT word, i, max(j) AS j FROM spans WHERE substr(word, i, j - i) IN (SELECT token FROM vocabulary) GROUP BY word, i),
chain AS (
  SELECT word, 1::BIGINT AS i, j FROM longest WHERE i = 1
  UNION ALL SELECT c.word, l.i, l.j FROM chain c JOIN longest l ON l.word = c.word AND l.i = c.j),
coded AS MATERIALIZED (
  SELECT word, list(CASE WHEN i > 1 THEN '##' ELSE '' END || substr(word, i, j - i) ORDER BY i) AS pieces,
         list(i - 1 ORDER BY i) AS starts, list(j - 1 ORDER BY i) AS ends FROM chain GROUP BY word)"""


def _normal_words() -> Column:
    return P.pretok_bert(T.normalize_text("text"))


SQL_ENCODE_WORDPIECE = f"""
WITH RECURSIVE {SQL_WORDPIECE}
SELECT doc_id, sum(len(pieces))::BIGINT AS n, string_agg(array_to_string(pieces, ' '), ' ' ORDER BY pos) AS tokens
FROM ({SQL_NORMAL_TOKENS}) k JOIN coded ON coded.word = k.token GROUP BY doc_id"""


@query("encode_wordpiece", SQL_ENCODE_WORDPIECE)
def encode_wordpiece(spark, d):
    return _flat(encoding.encode_wordpiece(t.spread_documents(spark, d), _normal_words(), wordpiece_vocab(spark, d)))


@query("encode_wordpiece_join", SQL_ENCODE_WORDPIECE)
def encode_wordpiece_join(spark, d):
    return _flat(encoding.encode_wordpiece_join(t.spread_documents(spark, d), "doc_id", _normal_words(), wordpiece_vocab(spark, d)))


@query("encode_with_offsets", f"""
WITH RECURSIVE {SQL_WORDPIECE},
located AS (SELECT doc_id, token, pos, s FROM (
  SELECT doc_id, token, pos, (sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos) - length(token))::BIGINT AS s
  FROM ({t.sql_tokens('documents', 'doc_id', f'regexp_extract_all({SQL_NORMAL}, {t.re2(P.BERT_COVER)})')})) WHERE {_NOT_BLANK}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS word_id FROM located),
places AS MATERIALIZED (SELECT doc_id, list(i ORDER BY i, k) AS src FROM (
  SELECT doc_id, i, unnest(range(length(strip_accents(lower(c))))) AS k FROM (
    SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) - 1 AS i FROM documents WHERE strlen(text) <> length(text)))
  GROUP BY doc_id)
SELECT doc_id, string_agg(array_to_string(pieces, ' '), ' ' ORDER BY pos) AS tokens,
  string_agg(array_to_string(list_transform(pieces, lambda p: word_id), ' '), ' ' ORDER BY pos) AS word_ids,
  string_agg(array_to_string(list_transform(starts, lambda x: coalesce(src[x + s + 1], x + s)), ' '), ' ' ORDER BY pos) AS starts,
  string_agg(array_to_string(list_transform(ends, lambda x: coalesce(src[x + s] + 1, x + s)), ' '), ' ' ORDER BY pos) AS ends
FROM numbered k JOIN coded ON coded.word = k.token LEFT JOIN places USING (doc_id) GROUP BY doc_id""")
def encode_with_offsets(spark, d):
    docs = t.spread_documents(spark, d).select("doc_id", T.normalized_places("text").alias("places"), T.normalize_text("text").alias("text"))
    located = P.piece_offsets(docs, "text", out="words")
    coded = encoding.encode_wordpiece(located, F.col("words.token"), wordpiece_vocab(spark, d))
    coded = coded.withColumns({"spans": encoding.piece_spans("pieces", "words"), "word_ids": encoding.word_ids("pieces")})
    # Texts whose characters all stay in place keep their spans; both columns below share the others'.
    coded = coded.withColumn("spans", F.when(F.col("places").isNull(), F.col("spans")).otherwise(encoding.original_spans("spans", "places")))
    return coded.select("doc_id", t.joined(F.flatten("pieces")).alias("tokens"), t.joined("word_ids").alias("word_ids"),
                        t.joined("spans.start").alias("starts"), t.joined("spans.end").alias("ends"))


SQL_ENCODE_UNIGRAM = f"""
WITH RECURSIVE {SQL_SEED},
     m AS MATERIALIZED (SELECT token, round(-ln(freq / (SELECT sum(freq) FROM seed)::DOUBLE), 6) AS nlp FROM seed),
     spans AS (SELECT word, i, unnest(range(i + 1, length(word) + 2)) AS j FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
     cand AS MATERIALIZED (SELECT word, j - 1 AS stop, list({{'s': i - 1, 'nlp': nlp}} ORDER BY i) AS cs FROM spans JOIN m ON m.token = substr(word, i, j - i) GROUP BY word, j),
     dp AS (
       SELECT word, 0::BIGINT AS stop, [1.0::DOUBLE] AS scores, [0::BIGINT] AS starts FROM w
       UNION ALL
       SELECT word, stop + 1, list_append(scores, list_min(vs)), list_append(starts, cs[list_position(vs, list_min(vs))].s) FROM (
         SELECT dp.word, dp.stop, scores, starts, cs, list_transform(cs, lambda c: scores[c.s + 1] + c.nlp) AS vs
         FROM dp JOIN cand ON cand.word = dp.word AND cand.stop = dp.stop + 1)),
     path AS (
       SELECT word, starts, length(word)::BIGINT AS stop, starts[length(word) + 1] AS start FROM dp WHERE stop = length(word)
       UNION ALL SELECT word, starts, start, starts[start + 1] FROM path WHERE start > 0),
     coded AS MATERIALIZED (SELECT word, list(substr(word, start + 1, stop - start) ORDER BY stop) AS pieces FROM path GROUP BY word)
SELECT doc_id, sum(len(pieces))::INTEGER AS n, string_agg(array_to_string(pieces, ' '), ' ' ORDER BY pos) AS tokens
FROM ({t.sql_tokens('documents', 'doc_id', f"list_transform({t.sql_words('text')}, lambda w: '▁' || w)")}) k JOIN coded ON coded.word = k.token GROUP BY doc_id"""


def unigram_model(spark, d) -> DataFrame:
    seed = vocab.subword_topn(vocab.rank_words(space_words(spark, d)), 300).select("token", "freq")
    return seed.withColumn("neg_log_p", F.round(neg_log_prob("freq", seed.agg(F.sum("freq")).scalar()), 6))


@query("encode_unigram", SQL_ENCODE_UNIGRAM)
def encode_unigram(spark, d):
    return _flat(encoding.encode_unigram(t.spread_documents(spark, d), P.pretok_metaspace("text"), unigram_model(spark, d)), "int")


@query("encode_unigram_join", SQL_ENCODE_UNIGRAM)
def encode_unigram_join(spark, d):
    return _flat(encoding.encode_unigram_join(t.spread_documents(spark, d), "doc_id", P.pretok_metaspace("text"), unigram_model(spark, d)), "int")


# Ids and decoding.

VOCAB_SIZE = 30_000


def word_vocab(spark, d) -> DataFrame:
    """A vocabulary of a set size: words seen at least five times, numbered from 5 by frequency."""
    tokens = vocab.explode_tokens(t.spread_documents(spark, d), [], _normal_words(), "pos", "token")
    freqs = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n >= 5")
    return freqs.orderBy(F.desc("n"), "token").limit(VOCAB_SIZE).select("token", (F.row_number().over(t.vocab_window()) + 4).cast("int").alias("id"))


SQL_WORD_VOCAB = f"""SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 4)::INTEGER AS id FROM (
  SELECT token, count(*) AS n FROM ({SQL_NORMAL_TOKENS}) GROUP BY token HAVING count(*) >= 5 ORDER BY n DESC, token LIMIT {VOCAB_SIZE})"""


@query("dictionary_encode_join", f"""
WITH v AS MATERIALIZED ({SQL_WORD_VOCAB})
SELECT doc_id, string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY pos) AS ids FROM ({SQL_NORMAL_TOKENS}) k LEFT JOIN v USING (token) GROUP BY doc_id""")
def dictionary_encode_join(spark, d):
    coded = encoding.dictionary_encode_join(t.spread_documents(spark, d), "doc_id", _normal_words(), word_vocab(spark, d), 1)
    return coded.select("doc_id", t.joined("input_ids").alias("ids"))


@query("save_load_vocab", SQL_WORD_VOCAB)
def save_load_vocab(spark, d):
    path = scratch_path(spark, "vocab")
    training.save_vocab(word_vocab(spark, d), path)
    return training.load_vocab(spark, path)


@query("decode_wordpiece", f"""
WITH k AS (SELECT doc_id, pos, i, piece FROM (
  SELECT doc_id, pos, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM (
    SELECT doc_id, pos, regexp_extract_all(token, '.{{1,3}}') AS ps FROM ({t.sql_tokens('documents', 'doc_id', t.sql_words('text'))})))
)
SELECT doc_id, replace(string_agg(CASE WHEN i > 1 THEN '##' ELSE '' END || piece, ' ' ORDER BY pos, i), ' ##', '') AS text FROM k GROUP BY doc_id""")
def decode_wordpiece(spark, d):
    def cut(w: Column) -> Column:
        parts = F.regexp_extract_all(w, F.lit(".{1,3}"), F.lit(0))
        return F.transform(parts, lambda p, i: F.when(i > 0, F.concat(F.lit("##"), p)).otherwise(p))

    docs = t.spread_documents(spark, d).select("doc_id", F.flatten(F.transform(T.words("text"), cut)).alias("pieces"))
    pieces = docs.select("doc_id", F.explode("pieces").alias("token"))
    numbered = pieces.select("token").distinct().withColumn("id", F.xxhash64("token"))
    ids = docs.select("doc_id", F.concat(F.array(F.lit(0).cast("bigint")), F.transform("pieces", lambda p: F.xxhash64(p))).alias("ids"))
    special = spark.createDataFrame([("[CLS]", 0)], "token string, id bigint")
    tokens = encoding.decode_join(ids, "doc_id", F.col("ids"), numbered.unionByName(special))
    return tokens.select("doc_id", encoding.detokenize_wordpiece("tokens").alias("text"))


@query("decode_metaspace", f"SELECT doc_id, array_to_string({t.sql_words('text')}, ' ') AS text FROM documents")
def decode_metaspace(spark, d):
    return t.spread_documents(spark, d).select("doc_id", encoding.detokenize_metaspace(P.pretok_metaspace("text")).alias("text"))


@query("decode_bytelevel", "SELECT doc_id, text FROM documents")
def decode_bytelevel(spark, d):
    return t.spread_documents(spark, d).select("doc_id", P.from_byte_level(F.array_join(P.pretok_bytelevel("text"), "")).alias("text"))


@query("batch_decode_labels", f"""
WITH v AS MATERIALIZED ({SQL_WORD_VOCAB})
SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text FROM ({SQL_NORMAL_TOKENS}) k JOIN v USING (token) GROUP BY doc_id""")
def batch_decode_labels(spark, d):
    words = word_vocab(spark, d)
    coded = encoding.dictionary_encode_join(t.spread_documents(spark, d), "doc_id", _normal_words(), words, -100)
    labels = coded.select("doc_id", A.unignore("input_ids", 0).alias("labels"))
    pad = spark.createDataFrame([("[PAD]", 0)], "token string, id int")
    tokens = encoding.decode_join(labels, "doc_id", F.col("labels"), words.unionByName(pad))
    texts = tokens.select("doc_id", T.strip(encoding.detokenize_wordpiece("tokens")).alias("text"))
    return texts.filter("text <> ''")


@query("template_postprocess", f"""
SELECT example_id, '101 ' || array_to_string({t.sql_token_ids('question')}, ' ') || ' 102' AS single,
  '101 ' || array_to_string({t.sql_token_ids('question')}, ' ') || ' 102 ' || array_to_string({t.sql_token_ids('context')}, ' ') || ' 102' AS pair,
  repeat('0', len({t.sql_words('question')}) + 2) || repeat('1', len({t.sql_words('context')}) + 1) AS type_ids
FROM ({t.SQL_PAIRS})""")
def template_postprocess(spark, d):
    ids = t.pairs(spark, d).select("example_id", t.token_ids("question").alias("a"), t.token_ids("context").alias("b"))
    cls, sep = F.lit(101), F.lit(102)
    return ids.select("example_id", t.joined(A.template_single("a", cls, sep)).alias("single"),
                      t.joined(A.template_pair("a", "b", cls, sep)).alias("pair"),
                      t.joined(A.pair_type_ids("a", "b"), "").alias("type_ids"))
