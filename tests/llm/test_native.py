"""Operators 1, 2, 4, 5, 9 and 10 on small tables, against plain Python or their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from costcurves.llm import line_chunks, pii_boost, poisson_mix, queries, rendezvous, spotsigs, stream_dedup
from costcurves.llm.oracle_sql import oracle_sql

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["words", "lines", "chunks", "block", "guest", "slot", "shard", "digest", "content", "base", "spans", "place", "first"]


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}" if k % 5 else None, len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    return df.withColumns({c: F.lit(1) for c in CLASHING})


ODD = [None, "", " ", "\n\n", "the", "The cat and the dog.", "é à ü " * 50, "x" * 20_000, "the of and " * 3000,
       "line a\nline b\nline c\nline d\n" * 5, "same text here for all", "same text here for all"]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, sf_dir, name):
    """Whole results on the smallest tables, and on odd rows."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = queries.queries()[name](spark, sf_dir).toPandas()
    want = con.sql(oracle_sql()[name]).df()[list(got.columns)]
    same(got, want)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_odd_rows_against_sql(spark, tmp_path, name):
    df = with_clashes(table(spark, ODD * 2))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.queries()[name](spark, str(tmp_path)).toPandas()
    want = con.sql(oracle_sql()[name]).df()[list(got.columns)]
    same(got, want)


def same(got, want):
    def rows(d):
        """Columns of whole numbers with nulls come as doubles."""
        plain = lambda x: int(x) if isinstance(x, float) and x.is_integer() else x
        return sorted(repr(tuple(map(plain, r))) for r in d.astype(object).where(d.notna(), None).itertuples(index=False, name=None))

    assert [re.sub(r"np\.\w+\((.*?)\)", r"\1", r) for r in rows(got)] == [re.sub(r"np\.\w+\((.*?)\)", r"\1", r) for r in rows(want)]


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "op3_pivot_join"])
def test_empty_and_null_ids(spark, tmp_path, name):
    """An empty table gives an empty result; null and repeated ids and rows don't crash."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "a/labels.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "a/documents.parquet"))
    assert queries.queries()[name](spark, str(tmp_path / "a")).count() == 0
    spark.createDataFrame([(1, None, None), (1, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "b/labels.parquet"))
    df = with_clashes(table(spark, ["a b the c d e", "a b the c d e", "x", None, "", "z"], [1, 1, 1, None, None, 2]))
    df = df.withColumn("lang", F.when(F.col("doc_id") != 2, F.col("lang"))).withColumn("n_chars", F.lit(None).cast("long"))
    df.write.parquet(str(tmp_path / "b/documents.parquet"))
    found = queries.queries()[name](spark, str(tmp_path / "b"))
    assert found.count() == 6 or name in ("op4_poisson_mix", "op13_spelling_variants")


def test_spotsigs_signatures(spark):
    df = spotsigs.with_signatures(table(spark, ["The red fox and the blue sky of old stones", "no such words", "", None]),
                                  "text", "s", anchors=["the", "and", "of"], chain=2)
    got = {r["doc_id"]: r["s"] for r in df.collect()}
    assert got == {0: ["and blue sky", "of old stones", "the blue sky", "the red fox"], 1: ["no such words"], 2: [], 3: []}


def test_spotsigs_pruning(spark):
    sets = [[str(i) for i in range(n)] for n in (0, 1, 3, 4, 5, 9, 12, 13, 40)]
    df = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<string>, b array<string>")
    rows = df.select("a", "b", spotsigs.is_near(F.col("a"), F.col("b")).alias("near"),
                     spotsigs.likeness(F.col("a"), F.col("b")).alias("likeness")).collect()
    for r in rows:
        a, b = set(r["a"]), set(r["b"])
        assert r["likeness"] == (len(a & b) / len(a | b) if a | b else 1.0)
        assert r["near"] == (r["likeness"] >= 0.75)


def test_line_chunks_move_with_text(spark):
    """A shared passage is cut alike wherever it stands, and its later copy goes."""
    rng = random.Random(5)
    line = lambda: " ".join(rng.choices("abcdefghijk", k=8))
    passage = [line() for _ in range(40)]
    texts = ["\n".join([line() for _ in range(k)] + passage + [line() for _ in range(3)]) for k in (0, 1, 7)]
    rows = {r["doc_id"]: r for r in line_chunks.without_repeats(table(spark, texts)).collect()}
    assert rows[0]["removed_lines"] == 0 and rows[0]["clean_text"] == texts[0]
    for i in (1, 2):
        assert 25 <= rows[i]["removed_lines"] <= 40
        assert set(texts[i].split("\n")) - set(rows[i]["clean_text"].split("\n")) <= set(passage)


def plain_passages(texts):
    """Lines of each text that stay, by the rule in plain Python."""
    first, left = {}, []
    for d, text in enumerate(texts):
        lines, gone = (text or "").split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            at = first.setdefault(pair, (d, i))
            if "".join(pair).strip(" \t\n\v\f\r") and (at[0] < d or at[1] + 2 <= i):
                gone |= {i, i + 1}
        left.append([x for i, x in enumerate(lines) if i not in gone])
    return left


def test_short_passages_go(spark):
    """Passages of 2 to 6 lines of over 50 words go whole, between lines of their own; one line alone stays."""
    rng = random.Random(7)
    line = lambda: " ".join(rng.choices("abcdefghijk", k=60))
    for n in (1, 2, 3, 4, 6):
        passages = [[line() for _ in range(n)] for _ in range(12)]
        own = [[[line(), line()] for _ in range(2)] for _ in range(24)]
        texts = ["\n".join([*a, *passages[k % 12], *b]) for k, (a, b) in enumerate(own)]
        rows = {r["doc_id"]: r for r in line_chunks.without_passages(table(spark, texts)).collect()}
        for k, (a, b) in enumerate(own):
            gone = n if k >= 12 and n > 1 else 0
            assert rows[k]["removed_lines"] == gone
            assert rows[k]["clean_text"] == ("\n".join([*a, *b]) if gone else texts[k])


def test_passages_against_plain(spark, sf_dir):
    rng = random.Random(3)
    texts = ["\n".join(rng.choices(["a", "b", "c d", "", " "], k=rng.randrange(12))) for _ in range(60)]
    given = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    for case in (texts, ODD, ["a\na\na\na\na"], given):
        want = plain_passages(case)
        for r in line_chunks.without_passages(with_clashes(table(spark, case))).collect():
            assert r["clean_text"] == "\n".join(want[r["doc_id"]])
            assert r["removed_lines"] == r["n_lines"] - len(want[r["doc_id"]])


def test_poisson_steps(spark):
    rates = [0.0, 0.01, 0.93, 3.0, 40.0, 900.0]
    df = spark.createDataFrame([(r,) for r in rates], "rate double")
    for r in df.select("rate", poisson_mix.poisson_steps(F.col("rate")).alias("steps")).collect():
        if not r["rate"]:
            assert r["steps"] == []
            continue
        total = 0.0
        for k, s in enumerate(r["steps"]):
            total += math.exp(k * math.log(r["rate"]) - r["rate"] - math.lgamma(k + 1))
            assert s == pytest.approx(total, abs=1e-9)
        assert r["steps"][-1] == pytest.approx(1.0, abs=1e-7)


def test_poisson_weights(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("0123456789").alias("text"), F.lit("en").alias("lang"),
                                  F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit(10).alias("n_chars"))
    rows = poisson_mix.mixed(df, {"a": 3.0, "b": 1.0, "absent": 5.0}).groupBy("source").count().collect()
    got = {r["source"]: r["count"] for r in rows}
    # Present sources share their weights: 3/9 and 1/9 of all weight, 5/9 has no documents.
    assert got["a"] / got["b"] == pytest.approx(3.0, rel=0.12)
    order = [r["mix_order"] for r in poisson_mix.mixed(df, partitions=4).collect()]
    assert order == sorted(order)


def test_rendezvous_laws(spark):
    df = table(spark, ["x"] * 3000)
    weights = [1.0, 2.0, 1.0, 4.0]
    got = rendezvous.sharded(df, weights, 16, grown_weight=2.0).collect()
    counts = Counter(r["shard"] for r in got)
    for j, w in enumerate(weights):
        assert counts[j] / 3000 == pytest.approx(w / 8, rel=0.2)
    assert all(r["grown_shard"] in (r["shard"], 4) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["text_crc32"] == zlib.crc32(b"x") and r["size"] == 2
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stream_dedup_restarts(spark, tmp_path):
    """A second run reads new files only and knows what came before."""
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    stream_dedup.land(table(spark, ["a  b", "c", "a\tb"]), landing)
    stream_dedup.advance(spark, landing, state)
    held = {r["digest"]: (r["keep_id"], r["n"]) for r in stream_dedup.keyed_state(spark, state).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert held == {digest("a b"): (0, 2), digest("c"): (1, 1)}
    stream_dedup.land(table(spark, ["a\n b", "d", "c"], [-5, 9, None]), landing)
    stream_dedup.advance(spark, landing, state, files_per_batch=1)
    rows = stream_dedup.keyed_state(spark, state).collect()
    assert {r["digest"]: (r["keep_id"], r["n"]) for r in rows} == {
        digest("a b"): (-5, 3), digest("c"): (1, 2), digest("d"): (9, 1)}
    place = {r["digest"]: r["locator"] for r in rows}
    found = spark.read.parquet(place[digest("a b")]).filter(F.col("doc_id") == -5).collect()
    assert [r["content"] for r in found] == ["a b"]


def test_stream_dedup_compares_bytes(spark):
    """Rows whose digests collide stay apart; the others take the answer of the state, whatever the file of the first."""
    rows = [(1, "k", "x"), (2, "k", "y"), (3, "k", "x"), (4, "m", "z"), *[(i, "hot", "w") for i in range(10, 200)], (None, "hot", "w")]
    landed = spark.createDataFrame([(*r, f"file {r[0]}") for r in rows], stream_dedup.LANDED + ", file string")
    held = landed.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")).withColumn(
        "locator", F.concat(F.lit("file "), F.col("keep_id")))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in stream_dedup.verified(landed, held).collect()}
    assert {i: got[i] for i in (1, 2, 3, 4)} == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False), 4: (4, 1, True)}
    assert all(got[i] == (10, 191, i == 10) for i in [*range(10, 200), None])


def test_state_names_the_answers(spark):
    """keep_id and group_size of hits are the state's: the batch reads contents only at the locator."""
    landed = spark.createDataFrame([(5, "k", "x", "f"), (7, "k", "x", "g")], stream_dedup.LANDED + ", file string")
    held = spark.createDataFrame([("k", 5, "f", 41)], "digest string, keep_id long, locator string, n long")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in stream_dedup.verified(landed, held).collect()}
    assert got == {5: (5, 41, True), 7: (5, 41, False)}


def test_poisson_mix_without_ids(spark):
    """Documents without an id draw by their text: counts spread as Poisson ones, not all alike."""
    docs = spark.createDataFrame([(None, f"text {i}", "en", "s", 6) for i in range(500)], SCHEMA)
    rates = spark.createDataFrame([("s", 1.0)], "source string, rate double")
    counts = [r["mix_copies"] for r in poisson_mix.with_copies(docs, rates).collect()]
    assert 400 < sum(counts) < 600 and 140 < counts.count(0) < 230 and 140 < counts.count(1) < 230 and max(counts) >= 3


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_of(text):
    """The base spans, by the patterns as given."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            odd, even = digits[-1::-2], digits[-2::-2]
            luhn = (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


PII = ["mail a.b@c.d-e.org, c@d and x@y.z.", "1.2.3.4 256.1.1.1 0255.1.1.1 1.2.3.4.5 1.2.3", "4111 1111 1111 1111 4111111111111112",
       "4111-1111-1111-1111 x 5500005555555559 " + "1 2 " * 5000, "+1 (375) 555-4393 +12 +1234567890123456 +49.30.1234567",
       "é" * 30 + " ü@x.de +1 (375) 555-4393", None, "", "+1+2+3 @ . 1.1.1.1", "0" * 30_000, "a@b" * 500 + ".c"]


def test_pii_base_spans(spark, sf_dir):
    texts = PII + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = {r["doc_id"]: r for r in pii_boost.personal_data(table(spark, texts)).select(
        "doc_id", pii_boost.written(F.col("base")).alias("base"), pii_boost.written(F.col("spans")).alias("spans")).collect()}
    for i, t in enumerate(texts):
        assert rows[i]["base"] == ",".join(base_of(t)), t
        assert set(rows[i]["base"].split(",")) <= set(rows[i]["spans"].split(","))


def test_pii_adds_lookalikes(spark):
    """Numbers written like the known ones but without a plus sign are added; others aren't."""
    rng = random.Random(2)
    num = lambda n: "".join(rng.choices("23456789", k=n))
    texts = [f"please call phone +1 ({num(3)}) {num(3)}-{num(4)} soon" for _ in range(300)]
    texts += [f"order {num(7)} of batch {num(2)}-{num(6)} shipped" for _ in range(300)]
    texts += [f"please call phone 1 ({num(3)}) {num(3)}-{num(4)} soon", f"order {num(7)} only"]
    rows = {r["doc_id"]: r["spans"] for r in pii_boost.personal_data(table(spark, texts)).select(
        "doc_id", pii_boost.written(F.col("spans")).alias("spans")).collect()}
    assert rows[600] == "phone:18:34" and rows[601] == ""
    assert all(rows[i] == "" for i in range(300, 600))


def test_pii_redaction(spark):
    df = table(spark, ["call +1 (375) 555-4393 or a@b.c now"])
    spans = pii_boost.personal_data(df).join(df.select("doc_id", "text"), "doc_id")
    assert spans.select(pii_boost.redacted(F.col("text"), F.col("spans")).alias("t")).first()["t"] == "call [phone] or [email] now"


def test_secrets_are_learned_from_their_format(spark):
    """Spans of secrets equal a plain rule on the format that the trees must find; other long runs stay."""
    rnd = random.Random(4)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    texts, want = [], []
    for i in range(300):
        run, other = hexes(40), f"Part-{rnd.randrange(10**6):06d}-{'LongNameOfThing'[:8 + i % 6]}x"
        cue = ["token = \"", "api_key: ", "SECRET='"][i % 3] if i < 299 else "sum of file "
        texts.append(f"some words {cue}{run}\" and {other} here, also plainwordsofsixteenletters and 1234567890123456789012")
        start = texts[-1].index(run)
        want.append([f"secret:{start}:{start + 40}"])
    rows = {r["doc_id"]: r["spans"] for r in pii_boost.personal_data(table(spark, texts)).select(
        "doc_id", pii_boost.written(F.col("spans")).alias("spans")).collect()}
    assert [[s for s in rows[i].split(",") if s.startswith("secret")] for i in range(300)] == want
    few = pii_boost.personal_data(table(spark, texts[:5])).select(pii_boost.count_of("spans", pii_boost.SECRET).alias("n")).collect()
    assert all(r["n"] == 0 for r in few)  # too few to calibrate


def test_secrets_of_the_table(spark, sf_dir):
    """Whole table: the spans are those of quoted runs of forty hexadecimal digits after token."""
    big = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{big}/documents.parquet")
    found = {r["doc_id"]: r["n_secret"] for r in queries.op10_pii_boost(spark, big).collect()}
    plain = {r["doc_id"]: len(re.findall(r'(?i)token = "[0-9a-f]{40}"', r["text"] or "")) for r in docs.collect()}
    assert sum(plain.values()) >= 100
    assert found == plain


@pytest.mark.parametrize("name", ["op3_pivot_join", "op5_rendezvous", "op7_record_files", "op9_stream_dedup"])
def test_text_of_a_megabyte(spark, tmp_path, name):
    """A text of over a megabyte, with many lines and a very long word, beside short ones."""
    long = "\n".join(f"line {i % 900} the word{i} of it" for i in range(40_000)) + " " + "x" * 100_000
    assert len(long) > 1_000_000
    df = table(spark, [long, "a short text of the kind", None, long[:50]])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.queries()[name](spark, str(tmp_path)).count() == 4
