"""The pipeline against a plain version of its stages."""

import re

import pyarrow as pa
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from costcurves.llm import cotraining, poisson_mix, queries
from costcurves.llm.common import BATCH_BYTES

from .test_pivot_join import brute


def plain(spark, sf_dir):
    """Rows that run() must return: the same classifier and counts, the rest in plain Python."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    keep = {r["doc_id"] for r in cotraining.scored(docs, labels).collect() if r["keep"]}
    rows = sorted((r for r in docs.collect() if r["doc_id"] in keep), key=lambda r: r["doc_id"])
    first, left = set(), []
    for r in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
        if text not in first:
            first.add(text)
            left.append(r)
    linked = brute([(r["doc_id"], r["text"]) for r in left])
    left = [r for r in left if linked[r["doc_id"]][1] == r["doc_id"]]
    frame = spark.createDataFrame([tuple(r) for r in left], docs.schema)
    copies = {r["doc_id"]: r["mix_copies"] for r in poisson_mix.with_copies(frame, poisson_mix.source_rates(frame)).collect()}
    library = SentencePieceProcessor(model_proto=queries.spm_model())
    return [(r["doc_id"], library.encode(r["text"] or "")) for r in left for _ in range(copies[r["doc_id"]])], keep


def test_pipeline(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    want, keep = plain(spark, sf_dir)
    assert 0 < len(keep) < 200
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == sorted((i, tuple(ids)) for i, ids in want)
    assert all(r["round_trip"] and r["parity"] and r["n_ids"] == len(r["ids"]) for r in got)


def test_stages(spark, sf_dir):
    """All but the last stage return the columns of documents."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "jaccard_join", "mixing", "sentencepiece"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == corpus_pipeline.COLUMNS


def test_rows_with_equal_or_null_ids(spark, sf_dir):
    """Dedup stages judge rows, not ids: one row of each group stays, and no row goes for another's text."""
    words = [" ".join(f"{w}{k}" for k in range(60)) for w in "abcdef"]
    near = [w + " end" for w in words]
    rows = [(1, words[0]), (2, words[0]), (2, words[1]), (3, words[2]), (3, words[2]), (None, words[3]), (None, words[3]),
            (None, words[1]), (4, near[0]), (4, words[4]), (None, near[4]), (None, words[5]), (None, near[5]), (6, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    copies = corpus_pipeline.drop_copies(spark, docs, sf_dir)
    got = sorted([(r["doc_id"], r["text"] or "") for r in copies.collect()], key=key)
    want = [(1, words[0]), (2, words[1]), (3, words[2]), (None, words[3]), (4, near[0]), (4, words[4]),
            (None, near[4]), (None, words[5]), (None, near[5]), (6, "")]
    assert got == sorted(want, key=key)
    left = corpus_pipeline.drop_linked(spark, docs, sf_dir).select("doc_id", "text").collect()
    got = sorted([(r["doc_id"], r["text"]) for r in left if r["text"] and r["text"].split()[0] != "f0"], key=key)
    assert got == sorted([(1, words[0]), (2, words[1]), (3, words[2]), (None, words[3]), (4, words[4])], key=key)
    assert sum(r["text"] in (words[5], near[5]) for r in left) == 1


def test_empty(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_workers_get_few_bytes_at_once(spark, sf_dir, monkeypatch):
    """Batches of long texts are bounded by bytes in the last stage, not by rows alone; a session's own bound stays."""
    seen = []
    real = corpus_pipeline.spm_tokenizers.encoded

    def counted(docs, model):
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

        seen.extend(r["bytes"] for r in docs.select("doc_id", "text").mapInArrow(sizes, "bytes long").collect())
        return real(docs, model)

    monkeypatch.setattr(corpus_pipeline.spm_tokenizers, "encoded", counted)
    docs = spark.range(0, 600, 1, 1).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 10000) as text", "'en' as lang",
                                                "'s' as source", "1L as n_chars")
    before = spark.conf.get(BATCH_BYTES, None)
    try:
        spark.conf.unset(BATCH_BYTES)
        corpus_pipeline.encode(spark, docs, sf_dir)
        assert sum(seen) > 40 << 20 and max(seen) < 10 << 20
        spark.conf.set(BATCH_BYTES, "2m")
        corpus_pipeline.encode(spark, docs, sf_dir)
        assert spark.conf.get(BATCH_BYTES) == "2m"
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)
