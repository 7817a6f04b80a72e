"""Near duplicates hold the Python objects of a slice of a batch, not of the whole."""

import pyarrow as pa

from inkmill.llm import near_dup
from inkmill.llm.common import text_slices


def _batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def test_text_slices_are_bounded_by_rows_and_bytes():
    texts = ["ab", None, "x" * 50, "", "cd", "ef", "gh"]
    parts = [p.column(1).to_pylist() for p in text_slices(_batch(texts), [1], 3, 8)]
    assert [t for p in parts for t in p] == texts and all(len(p) <= 3 and (len("".join(filter(None, p))) <= 8 or not any(p[1:])) for p in parts)
    assert list(text_slices(_batch([]), [1], 3, 8)) == []


def test_near_duplicates_hold_a_slice_of_a_batch():
    bands, rows = near_dup.banding(0.8)
    texts = [f"some words of text {i} and a few more words" for i in range(2 * near_dup.ROWS + 7)]
    out = list(near_dup._sign(bands, rows, 5)(iter([_batch(texts)])))
    assert max(b.num_rows for b in out) <= near_dup.ROWS and sum(b.num_rows for b in out) == len(texts)
    one = next(near_dup._sign(bands, rows, 5)(iter([_batch(texts[-3:])])))
    assert pa.Table.from_batches(out).slice(len(texts) - 3).select(["digest", "keys", "bits"]).to_pylist() == one.select(["digest", "keys", "bits"]).to_pylist()
    pairs = pa.RecordBatch.from_arrays([*[pa.array(range(len(texts)), pa.int64())] * 2, *[pa.array(texts)] * 2], ["a", "b", "ta", "tb"])
    judged = list(near_dup._compare(5)(iter([pairs])))
    assert len(judged) > 2 and all(b.column(2).equals(b.column(3)) for b in judged)
