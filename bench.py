"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input
and cores. Every query is run to the end by counting and hashing all of its columns.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from inkmill.functions import pretok as P, text as T  # noqa: E402
from inkmill.operators import encoding, training  # noqa: E402
from inkmill.plans import REGISTRY, tables as t  # noqa: E402
from inkmill.plans.tokenizers import wordpiece_vocab  # noqa: E402
from inkmill.session import cut_lineage, get_session, ship_package  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMED = ["shape_reviews", "word_count", "pretok_bert", "word_freqs", "subword_freqs", "train_bpe", "dictionary_encode_join",
         "train_test_split_frac", "chunk_overflow", "group_texts", "mlm_mask", "whole_word_mask", "qa_span_labels",
         "qa_nbest_span", "knn_exact", "knn_blocked", "seqeval", "bleu", "rouge_n", "rouge_l", "squad_em_f1"]


def drain(frame) -> int:
    """Evaluate every column of every row; only one number leaves the executors."""
    row = frame.select(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]).alias("h")).agg(F.count("h"), F.bit_xor("h")).first()
    return row[0]


def clean_words(text: str):
    return P.pretok_bert(T.normalize_text(text))


def native_encode(docs, vocab):
    """The same greedy encoder as expressions only, for comparison with the Arrow form."""
    longest = max(len(r.token) for r in vocab.collect())
    tokens = [r.token for r in vocab.collect()]

    def step(state, at):
        def piece(n):
            mark = F.when(at == 0, F.lit("")).otherwise(F.lit("##"))
            return F.concat(mark, F.substring(state["word"], at + 1, n))

        sizes = F.filter(F.sequence(F.least(F.lit(longest), F.length(state["word"]) - at), F.lit(1), F.lit(-1)),
                         lambda n: piece(n).isin(tokens))
        size = F.get(sizes, F.lit(0))
        return F.when(at < state["next"], state).otherwise(F.struct(
            state["word"].alias("word"), F.coalesce(at + size, F.lit(1 << 20)).alias("next"),
            F.concat(state["pieces"], F.array(F.coalesce(piece(size), F.lit("[UNK]")))).alias("pieces")))

    def encode(word):
        start = F.struct(word.alias("word"), F.lit(0).alias("next"), F.array().cast("array<string>").alias("pieces"))
        return F.aggregate(F.sequence(F.lit(0), F.length(word) - 1), start, step)["pieces"]

    return docs.select(F.transform(clean_words("text"), encode).alias("pieces"))


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    drain(REGISTRY["word_count"].run(spark, SF_DIR))
    times: dict[str, float] = {}
    only = set(sys.argv[1:])

    def timed(name, run):
        if only and name not in only:
            return
        start = time.time()
        try:
            drain(run())
            times[name] = round(time.time() - start, 3)
            print(name, times[name], file=sys.stderr, flush=True)
        except Exception as exc:  # one broken query must not hide the others
            print(name, repr(exc)[:300], file=sys.stderr, flush=True)

    # The vocabulary is made beforehand: encoding alone is timed.
    vocab = cut_lineage(wordpiece_vocab(spark, SF_DIR))
    docs = t.spread_documents(spark, SF_DIR)
    for name in NAMED:
        timed(name, lambda: REGISTRY[name].run(spark, SF_DIR))
    timed("encode_wordpiece_arrow", lambda: encoding.encode_wordpiece(docs, clean_words("text"), vocab).select("doc_id", "pieces"))
    if os.environ.get("BENCH_NATIVE"):
        timed("encode_wordpiece_native", lambda: native_encode(docs, vocab))
    n_docs = t.documents(spark, SF_DIR).count()
    encode = times.get("encode_wordpiece_arrow")
    print(json.dumps({
        "metric": "sum of headline query times", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(m.group(1)) if (m := re.search(r"sf([0-9.]+)/?$", SF_DIR)) else SF_DIR,
        "encode_docs_per_sec": round(n_docs / encode, 1) if encode else None}))


if __name__ == "__main__":
    main()
