"""Operators 6, 7 and 8."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from costcurves.llm import cotraining, queries, record_files, spm_tokenizers
from costcurves.llm.shingles import word_hashes
from costcurves.llm.slice_bpe import SliceBpe

ODD = ["", " ", "a", " a", "a ", "a  b", "a \nb", "x\n y", "it's  <|endoftext|> ok", "\0 a b", "日本語 テスト 🎉 x", "ñandú\tq  ",
       " lead", "tr ", "<s> x </s>", "x" * 5000, "word " * 3000, "  a  b", "a\r\n b"]


def plain_crc32c(data):
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = c >> 1 ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_crc32c():
    assert plain_crc32c(b"123456789") == 0xE3069283
    parts = [bytes(range(i % 256)) * 9 + b"abcd" for i in (0, 1, 7, 100, 113, 114, 227, 228, 255)]
    assert record_files.crc32c(parts).tolist() == [plain_crc32c(p) for p in parts]
    assert len(record_files.crc32c([])) == 0


def test_framing():
    data = [b"12345678" * k + b"tail" for k in (1, 2, 500)]
    blob = b"".join(record_files.framed(data))
    assert record_files.unframed(blob) == data
    n, _ = struct.unpack_from("<QI", blob)
    assert n == len(data[0])
    for at in (0, 9, 14, 23):
        broken = bytearray(blob)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            record_files.unframed(bytes(broken))


def test_bpe_words_equal_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    words = SliceBpe(path)
    for texts in (ODD, ODD[::-1], ["a"], ["a  b"], [], " ".join(ODD).split(" ")):
        want = [e.ids + [0] for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(e, "<u2").tolist() for e in words.records(pa.array(texts, pa.string()), 0)] == want


def test_record_files(spark, tmp_path):
    """Files hold all records in id order, and the index reads any of them."""
    texts = ODD * 3 + [None]
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = f"file://{tmp_path}/records"
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit(1), "file": F.lit("x")})
    manifest = record_files.write_records(df, path, folder, blocks=5, file_bytes=4000)
    found = {r["doc_id"]: r for r in record_files.read_back(manifest, 3).collect()}
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        r = found[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    files = manifest.orderBy("block", "part").collect()
    assert len(files) > 3 and sum(f["records"] for f in files) == len(rows)
    every = [x for f in files for x in record_files.read_records(f["file"])]
    assert [d for d, _ in every] == sorted(d for d, _ in rows)
    some = next(f for f in files if f["records"] > 2)
    in_order = list(record_files.read_records(some["file"]))
    for k, (doc_id, ids) in zip((2, 0, 1), record_files.read_records(some["file"], [2, 0, 1])):
        assert doc_id == in_order[k][0] and ids.tolist() == in_order[k][1].tolist()


def test_record_query_equals_unmodified_library(spark, tmp_path):
    """The query's ids are those of the library as it reads the file, also where a text spells out an added token."""
    texts = [*ODD, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "<|endof text|>"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    words = SliceBpe(path, added=True)
    for case in (texts, texts[::-1], texts):
        want = [e.ids + [0] for e in plain.encode_batch(case, add_special_tokens=False)]
        assert [np.frombuffer(e, "<u2").tolist() for e in words.records(pa.array(case), 0)] == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    start = 0
    for r in queries.op7_record_files(spark, str(tmp_path)).orderBy("doc_id").collect():
        ids = np.array(plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert 50256 in plain.encode(texts[-4], add_special_tokens=False).ids


def number(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(key, value):
    """One field of a protobuf message."""
    if isinstance(value, int):
        return number(key << 3) + number(value)
    if isinstance(value, float):
        return number(key << 3 | 5) + struct.pack("<f", value)
    return number(key << 3 | 2) + number(len(value)) + value


def unigram_model(remove_spaces=0):
    """A small unigram model written as a protobuf message."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    for i, p in enumerate(["▁", "▁the", "▁c", "a", "t", "at", "cat", "▁cat", "s", "e", "h", "▁t", "he", "c"]):
        pieces.append((p, -2.0 - 0.37 * i, 1))
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, t)) for p, s, t in pieces)
    out += field(2, field(3, 1) + field(35, 1))
    return out + field(3, field(1, b"identity") + field(3, 1) + field(4, remove_spaces) + field(5, 1))


@pytest.mark.parametrize("data", [unigram_model(), queries.spm_model()], ids=["unigram", "bpe"])
def test_spm_parity(data):
    words = spm_tokenizers.SpmWords(data)
    texts = ODD + ["the cat sat", "cats  eat", "thecat", " the  the "]
    library = SentencePieceProcessor(model_proto=data)
    for _ in range(2):
        found = words.encode(texts)
        assert [np.frombuffer(f, f"<u{words.width}").tolist() for f in found] == library.encode(texts)
        assert all(map(words.parity, texts))
        assert words.decode(found) == library.decode(library.encode(texts))


def test_spm_parity_is_checked(monkeypatch):
    words = spm_tokenizers.SpmWords(queries.spm_model())
    monkeypatch.setattr(words, "other", SentencePieceProcessor(model_proto=unigram_model()))
    words.encode(["the cat", "no  two"])
    assert not words.parity("the cat") and not words.parity("no  two")


def test_spm_operator(spark):
    rows = [(i, t) for i, t in enumerate(ODD + [None])]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("ids", F.lit(1))
    library = SentencePieceProcessor(model_proto=queries.spm_model())
    for r in spm_tokenizers.encoded(df, queries.spm_model()).collect():
        text = rows[r["doc_id"]][1] or ""
        assert r["ids"] == library.encode(text)
        assert r["decoded"] == text and r["round_trip"] and r["parity"]


def test_cotraining_held_out(spark, sf_dir):
    """Labels that were held out from fitting and calibration are told well."""
    big = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    unseen = labels.filter("doc_id % 4 = 0")
    got = cotraining.scored(docs, labels.filter("doc_id % 4 != 0")).join(unseen, "doc_id")
    rows = got.select("quality", "keep").collect()
    good = [r["keep"] for r in rows if r["quality"] == 1]
    bad = [r["keep"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) >= 0.99
    assert sum(bad) / len(bad) <= 0.1


def prose(rnd, vocabulary, n):
    return " ".join(rnd.choice(vocabulary) for _ in range(n)) + "."


def test_cotraining_reads_wording(spark):
    """Texts alike in all their shares are told apart by their words, and metadata learns from that by pseudo-labels."""
    rnd = random.Random(5)
    good, bad = (["".join(rnd.choice(letters) for _ in range(6)) for _ in range(60)] for letters in ("aeiklm", "orstuv"))
    rows = [(i, prose(rnd, bad if i % 3 == 0 else good, 40), "en", "worse" if i % 3 == 0 else "better", 280) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(120)], "doc_id long, quality int")
    got = cotraining.scored(docs, labels).collect()
    assert all(r["keep"] == (r["doc_id"] % 3 != 0) for r in got if r["doc_id"] >= 120)
    assert all((r["p_meta"] > 0.5) == (r["doc_id"] % 3 != 0) for r in got if r["doc_id"] >= 120)


def plain_means(text, weights):
    words = text.lower().split()
    raw = text.encode()
    four = [(int.from_bytes(raw[i:i + 4], "little") * 2654435761 % 2**32 >> 18) + (1 << 14) for i in range(len(raw) - 3)]
    heads = [int(word_hashes(w.encode())[0][0]) >> 50 for w in words]
    mean = lambda codes: sum(weights[c] for c in codes) / max(len(codes), 1)
    return [mean(heads), mean(four)]


def test_gram_means():
    weights = np.random.default_rng(1).normal(size=cotraining.GRAMS)
    texts = ["", "a", "abc", "abcd", "one two two", " x ", "", "ñandú \n über", "word " * 50]
    assert np.allclose(cotraining.gram_means(texts, weights), [plain_means(t, weights) for t in texts])
    assert np.allclose(cotraining.gram_means(["", ""], weights), 0)


def test_cotraining_odd_rows(spark, sf_dir):
    """Null metadata, texts and ids, repeated ids, extra columns named like the results, a text of megabytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(None, None, None, None, None), (1, "other text", None, "s", -5), (None, "null id", "xx", None, 3),
                                  (900, "very long " * 300_000, "en", "s", 3_000_000)], docs.schema)
    more = docs.unionByName(more).withColumns({"quality": F.lit("q"), "p_text": F.lit(1), "keep": F.lit(False), "fold": F.lit(None)})
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert cotraining.scored(more, labels).count() == more.count()
    kept = cotraining.accepted(more, labels)
    assert kept.columns == more.columns and 0 < kept.count() <= more.count()
    assert cotraining.scored(more.limit(0), labels).count() == 0


def test_cotraining_without_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = cotraining.scored(docs, labels).collect()
    assert all(r["keep"] and r["p_quality"] == 0.5 for r in rows)
    assert cotraining.accepted(docs, labels).count() == docs.count()
