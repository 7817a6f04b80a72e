"""Words are encoded once a worker, and alike in all texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from inkmill.llm import byte_level, token_alignment
from inkmill.llm.queries import BYTE_BPE, PIECE_BPE

ODD = [None, "", " ", "  ", "a  b", " a", "a ", "a \n b", "x\n \ny", "a<|endoftext|>b c", "it's 's x's\nfoo bar", "　 a", "a　 b c\x85 d",
       "\x1c a \x1d", "1 2 3 ١٢.", "\U0001f600 \xe9 é x", "a\tb c\td", "x, y. l'll. ., z.,", "<|endoftext|>", "  a  <|endoftext|> b",
       "a▁b c", "▁ ▁", "</s> <s> x", "\x00 a\x00", "one\n", "\none", "a \ntwo b", "plain words, here. plain words"]


def test_known_words_are_encoded_once():
    own, plain = (byte_level.Encoder(public_tokenizers.path(BYTE_BPE)) for _ in range(2))
    asked, fresh = [], own._fresh
    own.known.compute = lambda words: asked.extend(words.to_pylist()) or fresh(words)
    for texts in (ODD, ODD[::-1], [], [None], ODD):
        ids, ends = own.encode_batch(texts)
        starts = [0, *ends[:-1]]
        assert [ids[a:b].astype("<i4").tobytes() for a, b in zip(starts, ends)] == [plain.encode(t) for t in texts]
    assert len(asked) == len(set(asked)) and "here" in asked and "here." not in asked
    own.known.most = 3
    for texts in (["one two three four five six"], ["six one seven"], ODD):
        assert own.encode_batch(texts)[0].astype("<i4").tobytes() == b"".join(map(plain.encode, texts))
    assert len(byte_level.Known(lambda w: (np.zeros(len(w), np.int32), np.ones(len(w), np.int64)), 2)(pa.array(["a" * 100, "b", "c"]))[0]) == 3


def test_words_of_both_sides_are_encoded_once(spark):
    path_a, path_b = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
    (byte_side, bytes_a), (model, bytes_b, words) = token_alignment._byte_side(path_a), token_alignment._piece_side(path_b)
    assert words is not None

    def plain(text):
        want = (" " + (text or "")).encode()
        a, b = np.frombuffer(byte_side.encode_plain(" " + text), "<i4").tolist() if text else [], model.encode(text) if text else []
        return (a, b) if b"".join(bytes_a[i] for i in a) == want == b"".join(bytes_b[i] for i in b) else ([], [])

    rows = token_alignment.encode_both(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").coalesce(1), path_a, path_b).collect()
    assert {r.doc_id: (np.frombuffer(r.a, "<u2").tolist(), np.frombuffer(r.b, "<u2").tolist()) for r in rows} == {i: plain(t) for i, t in enumerate(ODD)}
