"""Figures that must not grow with the number of slices or the size of one."""

from __future__ import annotations

import glob

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq

from costcurves.llm import pivot_join, slice_bpe, spm_tokenizers, stream_dedup
from costcurves.llm.queries import spm_model
from costcurves.llm.word_cache import AT_ONCE


def test_support_takes_few_buckets_for_few_rows(spark):
    rows = spark.range(300).selectExpr("id as doc_id", "concat('a b c d e f g ', id div 2) as text").repartition(40)
    found = pivot_join.support(rows, pivot_join.text_sets, whole=False)
    assert found.rdd.getNumPartitions() == 1
    assert found.count() == 300


def test_landed_rows_are_packed(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    stream_dedup.land(docs, str(tmp_path / "landing"))
    about = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/landing/*.parquet")]
    groups = [m.row_group(i) for m in about for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 2
    assert {g.column(i).compression for g in groups for i in range(g.num_columns)} == {"ZSTD"}


class Watched:
    def __init__(self, tokenizer):
        self.tokenizer, self.most = tokenizer, 0

    def encode_batch_fast(self, texts, **kwargs):
        self.most = max(self.most, sum(map(len, texts)))
        return self.tokenizer.encode_batch_fast(texts, **kwargs)


def test_texts_are_encoded_few_at_a_time():
    coder = slice_bpe.SliceBpe(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"{i} one  two\n three " * 500 for i in range(300)]
    want = [e.ids for e in coder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    coder.tokenizer = Watched(coder.tokenizer)
    counts, ids = coder.whole(texts)
    assert coder.tokenizer.most <= AT_ONCE + len(texts[-1])
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_sentencepiece_slices_have_few_texts(spark, monkeypatch):
    seen = []
    real = spm_tokenizers.text_slices

    def cut(batches, column, limit):
        for rows in real(batches, column, limit):
            seen.append(rows.column(column).nbytes)
            yield rows

    monkeypatch.setattr(spm_tokenizers, "text_slices", cut)
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(["a b c " * 50_000] * 30)], names=["doc_id", "text"])
    assert sum(rows.num_rows for rows in spm_tokenizers.text_slices(iter([batch]), 1, AT_ONCE)) == 30
    assert max(seen) <= AT_ONCE + 1024
    docs = spark.createDataFrame([(i, f"text {i} of some words " * 20) for i in range(50)], "doc_id long, text string")
    assert spm_tokenizers.encoded(docs, spm_model()).filter("size(ids) > 0").count() == 50


def test_pieces_are_encoded_once_by_a_worker(monkeypatch):
    """Pieces of earlier slices are not given to the library again; past the bound they are, with the same ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = pa.array([" ".join(f"word{(i + k) % 400}" for k in range(200)) for i in range(30)] + ["", "a  b\n c", "x " + "y" * 100])
    plain = slice_bpe.SliceBpe(path).tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
    for bound in (500_000, 7):
        monkeypatch.setattr(slice_bpe, "KEPT_PIECES", bound)
        coder, seen = slice_bpe.SliceBpe(path), []
        real = coder.spaced
        monkeypatch.setattr(coder, "spaced", lambda pieces, sizes: seen.append(len(pieces)) or real(pieces, sizes))  # noqa: B023
        for _ in range(3):
            counts, ids = coder.encode(texts)
            assert counts.tolist() == [len(e.ids) for e in plain] and ids.tolist() == [i for e in plain for i in e.ids]
        assert len(coder.kept) == len(coder.kept_counts) == min(bound, seen[0] - 1)  # the piece of 100 letters is not kept
        assert seen[1:] == [seen[0] - len(coder.kept)] * 2 and coder.kept_counts.sum() == len(coder.kept_ids)


def test_sentencepiece_worker_holds_little(spark, monkeypatch):
    """A worker cuts batches in slices of at most 256 KB; a longer text is a slice of its own."""
    held, seen = [], []
    words = spm_tokenizers.SpmWords(spm_model())
    monkeypatch.setattr(spm_tokenizers, "trimmed", lambda f, keeps: held.append(f) or f)
    monkeypatch.setattr(spm_tokenizers, "kept_by_worker", lambda key, make: words)
    docs = spark.createDataFrame([(0, "")], "doc_id long, text string")
    spm_tokenizers.encoded(docs, spm_model())
    real = words.encode
    monkeypatch.setattr(words, "encode", lambda texts: seen.append(sum(map(len, texts))) or real(texts))
    texts = [" ".join(f"word{(7 * i + k) % 900}" for k in range(400)) for i in range(300)] + ["", "a  b\n c", "x " * 200_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(held[0](iter([batch])))
    assert sum(seen) == sum(map(len, texts)) and sorted(seen)[-2] <= 1 << 18 and max(seen) == 400_000
    want = words.other.encode(texts, num_threads=1)
    assert out["ids"].to_pylist() == want and all(out["parity"].to_pylist())
    assert out["decoded"].to_pylist()[:300] == texts[:300]
