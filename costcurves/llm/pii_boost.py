"""Operator 10: personal data by boosted trees over high-recall candidates.

Fixed patterns with their checks (part range, Luhn, number of digits) give the
base spans, which always stay. Looser generators propose overlapping candidates
(written-out or bracketed separators, numbers without a plus sign). Boosted trees
score a candidate from format and context features; they are fitted to how often each
feature pattern, counted over all documents, coincides with a base span. Scores are
calibrated by pooled rates, and candidates whose calibrated rate reaches
``THRESHOLD`` and that touch no base span are added.

Secrets (keys, tokens, passwords) have no base pattern. Their generator proposes every long run of letters and
digits; the trees learn from format alone which runs stand behind an assignment to a word such as key or
token, and the calibrated ones are added wherever they stand, with or without such a word.

Only pattern counts reach the driver: each feature has a few values, so their
number has a fixed bound whatever the number of documents.

Defined cases: a null text reads as empty and has no spans. Rows are independent, so
repeated rows and equal ids get one answer each; null ids pass through. An empty table gives an empty result.
Very long texts are searched whole; patterns are possessive, so very
long runs of digits need no deep recursion. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text

# The kinds in their order, the base patterns and the candidate generators.
KINDS = ["email", "ip", "card", "phone"]
SECRET = "secret"
ALL_KINDS = [*KINDS, SECRET]
BASE = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATES = {
    "email": r"[A-Za-z0-9._%+-]++ ?(?:@|[\[(]at[\])]|at) ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]|dot) ?[A-Za-z0-9-]++)++",
    "ip": r"[0-9]{1,3}+(?: ?(?:\.|[\[(]\.[\])]|[\[(]dot[\])]) ?[0-9]{1,3}+){3}",
    "card": r"[0-9](?:[\x20.-]{0,2}[0-9]){11,22}+",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,16}+",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{16,}+",
}
#: A text without a match of these holds no span and no candidate of the kind.
GATES = {"email": r"@|[\[( ]at[\]) ]", "ip": r"[0-9] ?[.\[(]", "card": r"[0-9](?:[\x20.-]{0,2}[0-9]){11}",
         "phone": r"[0-9](?:[\x20().-]{0,3}[0-9]){6}", "secret": r"[A-Za-z0-9_+/=-]{16}"}
CUES = {"email": r"(?i)mail|contact|write", "ip": r"(?i)\bip\b|host|address|server",
        "card": r"(?i)card|visa|master|credit", "phone": r"(?i)phone|tel|call|fax|mobile",
        "secret": r"(?i)(?:key|token|secret|passw(?:or)?d|pwd|auth|bearer|credential)[A-Za-z0-9_-]*+\x20?[=:]?\x20?[\x22']?$"}
FEATURES = ["digits", "groups", "opens", "written", "luhn", "left", "right", "cue", "length", "share", "case", "hex"]
CONTEXT = 24
TREES, DEPTH, RATE = 24, 2, 0.3
THRESHOLD = 0.95
#: Candidates below this count are too few to calibrate a rate.
LEAST = 20


def located(text: Column, pattern: str, gate: str) -> Column:
    """array<(start, end, part)> of the leftmost non-overlapping matches, in code points."""
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,part:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["b"])
        end = begin + F.length(x["p"])
        return F.struct(end.alias("at"), F.array_append(a["found"], F.struct(
            begin.alias("start"), end.alias("end"), x["p"].alias("part"))).alias("found"))

    pairs = F.zip_with(parts, F.slice(between, F.lit(1), F.size(parts)),
                       lambda p, b: F.struct(p.alias("p"), b.alias("b")))
    return F.when(text.rlike(gate), F.aggregate(pairs, start, step, lambda a: a["found"])).otherwise(none)


def digits_of(part: Column) -> Column:
    return F.regexp_replace(part, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(0), add) % 10 == 0)


def is_valid(kind: str, part: Column) -> Column:
    if kind == "ip":
        numbers = F.transform(F.split(part, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(numbers, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    n = F.length(digits_of(part))
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits_of(part))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """array<(start, end)>: matches of the kind's pattern that pass its check."""
    gate = {"email": "@", "phone": r"\+[0-9]"}.get(kind, GATES[kind])
    kept = F.filter(located(text, BASE[kind], gate), lambda s: is_valid(kind, s["part"]))
    return F.transform(kept, lambda s: F.struct(s["start"], s["end"]))


def side(c: Column) -> Column:
    """0 nothing or white space, 1 letter, 2 digit, 3 other."""
    return (F.when((c == "") | c.rlike(r"[\x20\x09-\x0D]"), 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2)
            .otherwise(3))


def secret_of(s: Column, before: Column, digits: Column) -> Column:
    """A long run of letters and digits with the features of its format; ``cue`` is what the trees learn to tell."""
    part, size = s["part"], F.length(s["part"])
    case = part.rlike("[a-z]").cast("int") + 2 * part.rlike("[A-Z]").cast("int")
    return F.struct(
        s["start"], s["end"], *[F.lit(0).alias(f) for f in FEATURES[:7]], before.rlike(CUES[SECRET]).cast("int").alias("cue"),
        F.least(F.floor(size / 8), F.lit(8)).cast("int").alias("length"),
        F.floor(8 * F.length(digits) / size).cast("int").alias("share"), case.alias("case"),
        part.rlike("^[0-9a-fA-F]*+$").cast("int").alias("hex"))


def candidate_spans(text: Column, kind: str) -> Column:
    """array<(start, end, features...)> of the generator's matches."""
    def described(s: Column) -> Column:
        part, digits = s["part"], digits_of(s["part"])
        before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1,
                             F.least(s["start"], F.lit(CONTEXT)))
        if kind == SECRET:
            return secret_of(s, before, digits)
        return F.struct(
            s["start"], s["end"],
            F.least(F.length(digits), F.lit(24)).alias("digits"),
            F.least(F.size(F.regexp_extract_all(part, F.lit("[0-9]+"), F.lit(0))), F.lit(6)).alias("groups"),
            part.rlike(r"\([0-9]").cast("int").alias("opens"),
            part.rlike(r"[\[(](?:at|dot|\.)[\])]| ?\b(?:at|dot)\b ?").cast("int").alias("written"),
            (luhn(digits) if kind == "card" else F.lit(False)).cast("int").alias("luhn"),
            side(F.substring(before, -1, 1)).alias("left"),
            side(F.substring(text, s["end"] + 1, F.lit(1))).alias("right"),
            before.rlike(CUES[kind]).cast("int").alias("cue"), *[F.lit(0).alias(f) for f in FEATURES[8:]])

    return F.transform(located(text, CANDIDATES[kind], GATES[kind]), described)


def touches(spans: Column, c: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base_<kind>, free_<kind>) stored once; free candidates carry ``hit``: they touch a base span."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumns({f"base_{k}": base_spans(F.col("text"), k) for k in KINDS}
                            | {f"free_{k}": candidate_spans(F.col("text"), k) for k in ALL_KINDS}).drop("text")

    def marked(k: str) -> Column:
        if k == SECRET:  # the cue is the label; as a feature it is left out
            return F.transform(f"free_{k}", lambda c: c.withField("hit", c["cue"]).withField("cue", F.lit(0)))
        return F.transform(f"free_{k}", lambda c: c.withField("hit", touches(F.col(f"base_{k}"), c).cast("int")))

    return rows.withColumns({f"free_{k}": marked(k) for k in ALL_KINDS})


@dataclass
class Node:
    value: float = 0.0
    feature: str = ""
    cut: int = 0
    low: Node | None = None
    high: Node | None = None

    def score(self, x: dict) -> float:
        if self.low is None:
            return self.value
        return (self.low if x[self.feature] <= self.cut else self.high).score(x)

    def column(self, c: Column) -> Column:
        if self.low is None:
            return F.lit(self.value)
        return F.when(c[self.feature] <= self.cut, self.low.column(c)).otherwise(self.high.column(c))


@dataclass
class Model:
    """Boosted trees with the score from which the calibrated rate reaches the threshold."""
    start: float = 0.0
    trees: list[Node] = field(default_factory=list)
    least: float = math.inf

    def score(self, x: dict) -> float:
        return sum((t.score(x) for t in self.trees), self.start)

    def column(self, c: Column) -> Column:
        total = F.lit(self.start)
        for t in self.trees:
            total = total + t.column(c)
        return total


def grow(rows: list[dict], depth: int) -> Node:
    """One regression tree on gradients ``g`` and curvatures ``h``; a row stands for a feature pattern."""
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    leaf = Node(value=RATE * g / (h + 1.0))
    if depth == 0:
        return leaf
    best = (1e-6, None)
    for f in FEATURES:
        for cut in sorted({r["x"][f] for r in rows})[:-1]:
            gl = sum(r["g"] for r in rows if r["x"][f] <= cut)
            hl = sum(r["h"] for r in rows if r["x"][f] <= cut)
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            best = max(best, (gain, (f, cut)), key=lambda b: b[0])
    if best[1] is None:
        return leaf
    f, cut = best[1]
    return Node(0.0, f, cut, grow([r for r in rows if r["x"][f] <= cut], depth - 1),
                grow([r for r in rows if r["x"][f] > cut], depth - 1))


def fit(patterns: list[dict], threshold: float = THRESHOLD, least: int = LEAST) -> Model:
    """A model of pattern counts: dicts with the features, ``n`` candidates and ``hits`` among them."""
    total, hits = sum(p["n"] for p in patterns), sum(p["hits"] for p in patterns)
    if not hits or total < least:
        return Model()
    odds = (hits + 0.5) / (total - hits + 0.5)
    model = Model(start=math.log(odds))
    rows = [{"x": p, "s": model.start} for p in patterns]
    for _ in range(TREES):
        for r in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, r["s"]))))
            r["g"], r["h"] = r["x"]["hits"] - r["x"]["n"] * p, r["x"]["n"] * p * (1 - p)
        tree = grow(rows, DEPTH)
        model.trees.append(tree)
        for r in rows:
            r["s"] += tree.score(r["x"])
    # Calibration: pool neighbouring scores until the observed rates rise with the score.
    pools: list[list[float]] = []
    for r in sorted(rows, key=lambda r: r["s"]):
        pools.append([r["s"], r["x"]["hits"], r["x"]["n"]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1][1] += last[1]
            pools[-1][2] += last[2]
    passing = [s for s, hit, n in pools if n >= least and hit >= threshold * n]
    model.least = min(passing, default=math.inf)
    return model


def fitted(spans: DataFrame) -> dict[str, Model]:
    """One model a kind, from pattern counts over all candidates."""
    def keyed(k: str) -> Column:
        return F.transform(f"free_{k}", lambda c: F.struct(F.lit(k).alias("kind"), *[c[f].alias(f) for f in FEATURES],
                                                           c["hit"].alias("hit")))

    counts = spans.select(F.explode(F.concat(*[keyed(k) for k in ALL_KINDS])).alias("c")).groupBy(
        "c.kind", *[f"c.{f}" for f in FEATURES]).agg(F.count("*").alias("n"), F.sum("c.hit").alias("hits"))
    rows = [r.asDict() for r in counts.orderBy("kind", *FEATURES).collect()]
    return {k: fit([r for r in rows if r["kind"] == k]) for k in ALL_KINDS}


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, rank, kind, end) in order, base ones and all."""
    rows = stored(with_spans(docs, id_col, text_col), "pii-spans")
    models = fitted(rows)

    def shaped(spans: str | Column, k: str) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(ALL_KINDS.index(k)).alias("rank"), F.lit(k).alias("kind"), s["end"].alias("end")))

    def passing(k: str) -> Column:
        score, least = models[k].column, models[k].least
        new = lambda c: F.lit(True) if k == SECRET else c["hit"] == 0
        return F.filter(f"free_{k}", lambda c: new(c) & (score(c) >= least - 1e-9))

    base = F.concat(*[shaped(f"base_{k}", k) for k in KINDS])
    added = [shaped(passing(k), k) for k in KINDS if models[k].least < math.inf]
    rows = rows.withColumn("base", F.sort_array(base))
    none = F.slice("base", 1, 0)
    # A candidate that touches a base span of any kind is part of what that span already covers. A secret is
    # more than the digits in it, and stays beside such a span.
    free = F.filter(F.concat(*added), lambda c: ~touches(F.col("base"), c)) if added else none
    secrets = shaped(passing(SECRET), SECRET) if models[SECRET].least < math.inf else none
    return rows.withColumn("spans", F.sort_array(F.concat("base", free, secrets))).select("doc_id", "base", "spans")


def count_of(spans: str | Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are covered once."""
    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        mark = F.when(s["end"] > a["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap, mark).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
