"""Operator 6: a quality classifier by co-training of two views.

The text view sees the text's content: shares and repetitions of its characters, words and lines, and how its
words and its four-byte grams are distributed (log-odds of hashed grams, learned from labelled texts). The metadata
view sees language, source and stored length. Each is a logistic regression on binned features. In each
round both views score all unlabelled documents, and those that one is confident of join the
other's training rows as pseudo-labels, weighted so that each class weighs no more than its labelled rows. A fitting step is one
pass over the stored features of all documents, which adds up slopes and curvatures of both views. On labelled rows held
out from this, both views are calibrated (logistic in their log-odds) and combined (logistic in both). The combined score
rejects a document below the threshold, which is set so that at most ``LOST`` of the held-out good ones fall below it.

Labels are taken from at most ``LABELLED`` rows, by a hash of their id; everything else covers all documents: bins
of numbers are quantiles of all, languages and sources are hashed into ``VALUES`` buckets, pseudo-labels are as many as the views
are sure of. Features of all documents are stored once, some 150 bytes a document; the driver sees gram counts of fixed
number, models and the held-out scores.

Defined cases: null texts read as empty, null metadata is a value of its own. Of several labels of an id the
best counts; rows that share a labelled id all have its label. With no labels, or labels of one class only, nothing is
learned: all scores are 0.5 and every document is kept. Equal rows get equal scores; null ids are scored and have no
label. Very long texts are read whole, in slices of bounded bytes otherwise. An empty table gives an empty result. The columns
read are doc_id, text, lang, source and n_chars; others named like the results are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, trimmed, whole_text
from .shingles import word_hashes
from .slice_bpe import text_slices

LABELLED = 6_000
ROUNDS = 2
#: Steps of the fit in a round; each starts from the weights before.
STEPS = 3
CONFIDENT = 0.95
HELD_OUT = 0.3
LOST = 0.002
BINS = 12
VALUES = 64
RIDGE = 1.0
CALM = 0.1
#: Tasks that add up what the partitions have found.
ADDERS = 16
#: Buckets of hashed grams: words, then grams of four bytes.
GRAM_BITS = 14
GRAMS = 2 << GRAM_BITS
#: Texts processed at once, in bytes.
AT_ONCE = 4 << 20
SHARES = ["words", "distinct", "word_length", "upper", "digits", "marks", "rare_marks", "adjacent", "lines", "repeated_lines", "top_word"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TEXT_FEATURES = [*SHARES, "wording", "spelling"]

#: Byte classes: 0 other (also bytes beyond ASCII), 1 space, 2 upper, 3 digit, 4 common mark, 5 rarer mark.
BYTE_CLASS = np.zeros(256, np.uint8)
BYTE_CLASS[[0x20, *range(0x09, 0x0E)]] = 1
BYTE_CLASS[list(range(ord("A"), ord("Z") + 1))] = 2
BYTE_CLASS[list(range(ord("0"), ord("9") + 1))] = 3
BYTE_CLASS[list(b".,;:!?'\"()-")] = 4
BYTE_CLASS[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 5


def shares(text: str) -> list[float]:
    """What a text is made of, and what repeats in it."""
    words, lines = text.split(), text.split("\n")
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(BYTE_CLASS[raw], minlength=6)
    n, size = max(len(words), 1), max(len(raw), 1)
    return [
        float(np.log1p(len(words))), len(counts) / n, (size - int(kinds[1])) / n, int(kinds[2]) / size,
        int(kinds[3]) / size, int(kinds[4]) / size, int(kinds[5]) / size, sum(map(eq, words, words[1:])) / n,
        len(lines) / n, 1 - len(set(lines)) / len(lines), max(counts.values(), default=0) / n]


def grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words and four-byte grams of texts as (buckets, ends by text), the words' buckets first."""
    raw = [t.encode() for t in texts]
    data = b"\n".join(raw)
    edges = np.cumsum([0] + [len(r) + 1 for r in raw])
    words, starts = word_hashes(data.lower())
    bounds = np.searchsorted(starts, edges)
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    four = a[:-3] | a[1:-2] << 8 | a[2:-1] << 16 | a[3:] << 24 if len(a) > 3 else np.empty(0, np.uint32)
    # Grams of a text end with it; those over the separator are left out by their weight below.
    code = (four * np.uint32(2654435761) >> np.uint32(32 - GRAM_BITS)).astype(np.int64) + (1 << GRAM_BITS)
    inside = np.minimum(np.arange(len(code)) + 4, len(a)) <= np.repeat(edges[1:] - 1, np.diff(edges))[:len(code)]
    code = code[inside]
    ends = np.concatenate([[0], np.cumsum(np.maximum(np.array([len(r) for r in raw], np.int64) - 3, 0))])
    return [((words >> np.uint64(64 - GRAM_BITS)).astype(np.int64), bounds), (code, ends)]


def gram_means(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean weight of the words and of the grams of each text; 0 without any."""
    out = []
    for code, ends in grams(texts):
        total = np.concatenate([[0.0], np.cumsum(weights[code])])
        out.append((total[ends[1:]] - total[ends[:-1]]) / np.maximum(np.diff(ends), 1))
    return np.stack(out, 1)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 50) -> np.ndarray:
    """Weights of the columns of x by Newton steps with a ridge on all but the first, which is 1.

    A step is halved until it helps: separable rows would else throw the weights far off.
    """
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = np.where(y > 0.5, 1, -1) * (x @ w)
        return float(np.logaddexp(0, -z).sum() + (penalty * w * w).sum() / 2)

    for _ in range(steps):
        p = logistic(x @ w)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step, now = np.linalg.solve(bend, x.T @ (y - p) - penalty * w), loss(w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    return w


def with_one(x: np.ndarray) -> np.ndarray:
    return np.c_[np.ones(len(x)), x]


VIEWS = ("text", "meta")
META = ["b_lang", "b_source", "f_n_chars"]


def design(view: str, columns: dict[str, np.ndarray], edges: dict[str, np.ndarray]) -> np.ndarray:
    """The view's matrix: 1, then one number an edge of each feature (1 from the edge on), one a bucket of values."""
    n = len(columns["f_n_chars"])
    above = lambda f, e: (columns[f][:, None] >= e[None, :]).astype(float)
    if view == "text":
        parts = [above(f"f_{f}", edges[f]) for f in TEXT_FEATURES]
    else:
        parts = [*(np.eye(VALUES + 1)[columns[c].astype(np.int64)] for c in ("b_lang", "b_source")), above("f_n_chars", edges["n_chars"])]
    return np.concatenate([np.ones((n, 1)), *parts], axis=1)


def numbers(part: pa.RecordBatch, names: list[str]) -> dict[str, np.ndarray]:
    return {c: part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in names}


NUMBERS = [*(f"f_{f}" for f in TEXT_FEATURES), *META]


def curvature(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the weighted log-likelihood at w and the bound of its curvature (a quarter), both without the ridge.

    A step by the bound never makes the fit worse, whatever the weights before.
    """
    return x.T @ (weight * (y - logistic(x @ w))), (x * (weight / 4)[:, None]).T @ x


def stepped(w: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> np.ndarray:
    penalty = np.full(len(w), RIDGE)
    penalty[0] = 1e-6
    return w + np.linalg.solve(bend + np.diag(penalty), slope - penalty * w)


def sure_of(p: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows without a label that a view is confident of, and their pseudo-labels."""
    return ~known & ((p >= CONFIDENT) | (p <= 1 - CONFIDENT)), (p > 0.5).astype(float)


@dataclass
class Scorer:
    grams: np.ndarray
    edges: dict[str, np.ndarray]
    weights: dict[str, np.ndarray]
    scales: dict[str, np.ndarray]
    joint: np.ndarray
    threshold: float
    sample: DataFrame

    def raw(self, columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return {v: logistic(design(v, columns, self.edges) @ self.weights[v]) for v in VIEWS}

    def score(self, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, metadata and combined scores, and what is kept."""
        p = {v: logistic(self.scales[v][0] + self.scales[v][1] * log_odds(x)) for v, x in self.raw(columns).items()}
        both = logistic(self.joint[0] + np.stack([log_odds(p[v]) for v in VIEWS], 1) @ self.joint[1:])
        return p["text"], p["meta"], both, both >= self.threshold

    def without_sample(self) -> Scorer:
        """What tasks need."""
        return replace(self, sample=None)


def sampled(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, quality, held_out, fold): at most ``labelled`` ids with a label, by their hash."""
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))
    known = docs.filter("doc_id is not null").select("doc_id").distinct().join(known, "doc_id").orderBy(order).limit(labelled)
    share = F.conv(F.substring(order, 17, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return known.select("doc_id", "quality", (share < HELD_OUT).alias("held_out"),
                        (F.conv(F.substring(order, 25, 4), 16, 10).cast("int") % 2).alias("fold"))


def gram_weights(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log-odds of each bucket: rows 0 and 1 without the labelled texts of that fold, row 2 from all of them."""
    # The sample has at most LABELLED ids by construction.
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample.filter("not held_out")), "doc_id")
    rows = rows.select("text", (F.col("fold") * 2 + F.col("quality")).alias("group"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 0, AT_ONCE):
            groups, total = part.column(1).to_pylist(), {}
            for g in sorted(set(groups)):
                texts = [t for t, k in zip(part.column(0).to_pylist(), groups, strict=True) if k == g]
                total[g] = np.bincount(np.concatenate([c for c, _ in grams(texts)]), minlength=GRAMS)
            for g, n in total.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g)), pa.array(at), pa.array(n[at])],
                                                 names=["group", "bucket", "n"])

    found = np.zeros((4, GRAMS))
    for r in rows.mapInArrow(count, "group long, bucket long, n long").groupBy("group", "bucket").agg(F.sum("n").alias("n")).collect():
        found[r["group"], r["bucket"]] = r["n"]
    folds = found.reshape(2, 2, GRAMS)
    sums = [folds[1], folds[0], folds[0] + folds[1]]
    half = 1 << GRAM_BITS
    out = []
    for s in sums:
        parts = []
        for part in (s[:, :half], s[:, half:]):
            share = (part + 1) / (part.sum(1, keepdims=True) + half)
            parts.append(np.log(share[1] / share[0]))
        out.append(np.concatenate(parts))
    return np.stack(out)


def described(docs: DataFrame, weights: np.ndarray, sample: DataFrame, schema, finish: Callable) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars, others) with quality, held_out, fold, b_* and the features f_*.

    ``finish`` makes of each batch what ``schema`` says.

    The grams of a text of the sample, which others learn from, are weighted without its own fold.
    """
    rows = docs.join(F.broadcast(sample), "doc_id", "left").select(*docs.columns, "quality", "held_out", "fold")
    place_of = lambda c: F.when(F.col(c).isNull(), F.lit(VALUES)).otherwise(
        F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(VALUES))).cast("int")
    rows = rows.withColumns({
        "b_lang": place_of("lang"), "b_source": place_of("source"),
        "f_n_chars": F.coalesce(F.ln(F.greatest(F.col("n_chars").cast("double"), F.lit(0.0)) + 1), F.lit(-1.0))})
    names, place, fold = rows.columns, docs.columns.index("text"), len(docs.columns) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, place, AT_ONCE):
            texts = [t or "" for t in part.column(place).to_pylist()]
            own = np.array([shares(t) for t in texts]).reshape(len(texts), len(SHARES))
            folds = np.array([2 if f is None else f for f in part.column(fold).to_pylist()])
            means = np.zeros((len(texts), 2))
            for f in np.unique(folds).tolist():
                at = np.flatnonzero(folds == f)
                means[at] = gram_means([texts[i] for i in at.tolist()], weights[f])
            values = [pa.array(c) for c in np.c_[own, means].T.copy()]
            full = pa.RecordBatch.from_arrays([*part.columns, *values], names=[*names, *(f"f_{f}" for f in TEXT_FEATURES)])
            yield finish(full)

    return rows.mapInArrow(trimmed(run), schema)


def dropped(batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    return batch.select([c for c in batch.schema.names if c not in names])


FEATURES = ("quality int, held_out boolean, fold int, b_lang int, b_source int, f_n_chars double, "
            + ", ".join(f"f_{f} double" for f in TEXT_FEATURES))


def pseudo_counts(rows: DataFrame, scorer: Scorer) -> dict[str, np.ndarray]:
    """For each view, how many unlabelled documents it is sure are bad and good."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            known = part.column("quality").is_valid().to_numpy(zero_copy_only=False)
            found = []
            for v, p in scorer.raw(numbers(part, NUMBERS)).items():
                sure, y = sure_of(p, known)
                found += [(v, int(c), int((sure & (y == c)).sum())) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["view", "y", "n"])

    out = {v: np.zeros(2) for v in VIEWS}
    for r in rows.mapInArrow(count, "view string, y long, n long").groupBy("view", "y").agg(F.sum("n").alias("n")).collect():
        out[r["view"]][r["y"]] = r["n"]
    return out


def step_over(rows: DataFrame, given: Scorer, now: dict[str, np.ndarray], weight: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One step of both views' fits over all documents.

    Labelled rows count 1. Unlabelled ones that the other view of ``given`` is sure of count ``weight`` of their class.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for part in batches:
            if not part.num_rows:
                continue
            columns = numbers(part, NUMBERS)
            known = part.column("quality").is_valid().to_numpy(zero_copy_only=False)
            apart = pc.fill_null(part.column("held_out"), False).to_numpy(zero_copy_only=False)
            quality = pc.fill_null(part.column("quality"), 0).to_numpy(zero_copy_only=False).astype(float)
            p = given.raw(columns)
            for v, other in zip(VIEWS, VIEWS[::-1], strict=True):
                sure, guess = sure_of(p[other], known)
                y = np.where(known, quality, guess)
                rate = np.where(known & ~apart, 1.0, np.where(sure, weight[other][y.astype(int)], 0.0))
                at = rate > 0
                x = design(v, {c: a[at] for c, a in columns.items()}, given.edges)
                slope, bend = curvature(x, y[at], rate[at], now[v])
                before = sums.get(v, (0.0, 0.0))
                sums[v] = (before[0] + slope, before[1] + bend)
        yield packed(sums)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for part in batches:
            for v, slope, bend in unpacked(part.to_pylist()):
                before = sums.get(v, (0.0, 0.0))
                sums[v] = (before[0] + slope, before[1] + bend)
        yield packed(sums)

    kind = "view string, slope binary, bend binary"
    # Some 300 kB a partition, added up by a few tasks: at most ADDERS rows a view reach the driver.
    found = rows.mapInArrow(partial, kind).repartition(ADDERS).mapInArrow(added, kind).collect()
    out = {}
    for v in VIEWS:
        mine = [(s, b) for w, s, b in unpacked([r.asDict() for r in found]) if w == v]
        out[v] = stepped(now[v], sum(s for s, _ in mine), sum(b for _, b in mine))
    return out


def packed(sums: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([s.tobytes() for s, _ in sums.values()], pa.binary()),
                                       pa.array([b.tobytes() for _, b in sums.values()], pa.binary())], names=["view", "slope", "bend"])


def unpacked(rows: list[dict]) -> list[tuple[str, np.ndarray, np.ndarray]]:
    out = []
    for r in rows:
        slope = np.frombuffer(r["slope"])
        out.append((r["view"], slope, np.frombuffer(r["bend"]).reshape(len(slope), len(slope))))
    return out


def learned(docs: DataFrame, labels: DataFrame) -> tuple[Scorer | None, DataFrame | None]:
    """The scorer and the stored features of all documents; (None, None) if the labels show one class only."""
    docs = docs.select("doc_id", whole_text().alias("text"), "lang", "source", "n_chars")
    sample = stored(sampled(docs, labels), "cotraining-sample")
    classes = {(r["held_out"], r["quality"]) for r in sample.select("held_out", "quality").distinct().collect()}
    if not {(h, q) for h in (False, True) for q in (0, 1)} <= classes:
        return None, None
    grams = gram_weights(docs, sample)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = described(docs, grams, sample, f"doc_id {kind}, {FEATURES}", lambda b: dropped(b, ["text", "lang", "source", "n_chars"]))
    rows = stored(rows, "cotraining-features")
    cuts = [(i + 1) / BINS for i in range(BINS - 1)]
    names = [*TEXT_FEATURES, "n_chars"]
    found = rows.agg(*[F.percentile_approx(f"f_{f}", cuts, 10_000).alias(f) for f in names]).first()
    edges = {f: np.unique(found[f] or []) for f in names}

    # The labelled sample has at most LABELLED ids.
    known = rows.filter("quality is not null").orderBy("doc_id", *[f"f_{f}" for f in TEXT_FEATURES]).toPandas()
    columns = {c: known[c].to_numpy(float) for c in NUMBERS}
    y, apart = known["quality"].to_numpy(float), known["held_out"].to_numpy(bool)
    weights = {v: fit_logistic(design(v, columns, edges)[~apart], y[~apart], RIDGE) for v in VIEWS}
    none = np.zeros(3)
    scorer = Scorer(grams, edges, weights, dict.fromkeys(VIEWS, none), none, 0.5, None)
    size = np.array([(y[~apart] == c).sum() for c in (0, 1)])
    for _ in range(ROUNDS):
        sure = pseudo_counts(rows, scorer)
        weight = {v: np.minimum(size / np.maximum(n, 1), 1.0) for v, n in sure.items()}
        now = scorer.weights
        for _ in range(STEPS):
            now = step_over(rows, scorer, now, weight)
        scorer = replace(scorer, weights=now)

    seen = scorer.raw({c: a[apart] for c, a in columns.items()})
    y = y[apart]
    scales = {v: fit_logistic(with_one(log_odds(seen[v])), y, CALM) for v in VIEWS}
    both = np.stack([log_odds(logistic(scales[v][0] + scales[v][1] * log_odds(seen[v]))) for v in VIEWS], 1)
    joint = fit_logistic(with_one(both), y, CALM)
    p = logistic(joint[0] + both @ joint[1:])
    threshold = float(min(0.5, np.quantile(p[y == 1], LOST)))
    # The least held-out score itself stays, however the last digit comes out.
    return replace(scorer, scales=scales, joint=joint, threshold=threshold - 1e-9, sample=sample), rows


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, p_text, p_meta, p_quality, keep) of every document."""
    scorer, rows = learned(docs, labels)
    if scorer is None:
        half = [F.lit(0.5).alias(c) for c in ("p_text", "p_meta", "p_quality")]
        return docs.select("doc_id", *half, F.lit(True).alias("keep"))
    scorer = scorer.without_sample()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, scorer.score(numbers(part, NUMBERS)))],
                                             names=["doc_id", "p_text", "p_meta", "p_quality", "keep"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, p_text double, p_meta double, p_quality double, keep boolean")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    scorer, _ = learned(docs, labels)
    if scorer is None:
        return docs
    sample, scorer = scorer.sample, scorer.without_sample()
    others = [c for c in docs.columns if c not in COLUMNS]
    rows = docs.select(*COLUMNS, *([F.struct(*others).alias("_others")] if others else []))
    names = rows.columns

    def kept(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.select(names).filter(pa.array(scorer.score(numbers(part, NUMBERS))[3]))

    found = described(rows, scorer.grams, sample, rows.schema, kept)
    return found.select(*[F.col(f"_others.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])
