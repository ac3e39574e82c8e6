"""Operator 3: exact Jaccard join of word-shingle sets as a metric-space join.

Jaccard distance is a metric; links are pairs at a distance of 0.25 or less.

1. Support. Of the shingles of a linked document at least three quarters occur in
   another document. Slices of documents send their shingles (once each, so that a shingle in
   a third of all documents is one record a slice) to hash buckets and hear which others have
   them; documents with too few such shingles link with nothing. The first pass sends the
   half with the smallest hashes, which suffices by the prefix bound of ``prefix_length``.
2. Equal sets are one class, named by its smallest id; the rest works on classes.
3. Regions. A class enters the region of each shingle of its prefix, rare shingles first; two
   linked classes meet in a region.
4. Pivots. In a region of more than ``SMALL`` members the most central member and some others become
   pivots, and all members are compared with them. Members linked to a pivot are connected with
   each other through it. The others, the core, belong to the Voronoi cell of their nearest pivot, and every member of
   the region is replicated to each other cell whose core its window reaches. The window is the triangle
   inequality in the form that counts give: sets that share x and x' shingles with the pivot share at most
   min(x, x') of the pivot's with each other. Cells are regions again: a core of few members is compared with its
   cell, a larger one gets pivots of its own.
5. Links become components by the smallest id reachable.

Nothing is dropped: each prune follows from the bound or the triangle inequality.
Shingles are compared as 64-bit hashes.

Defined cases: a null text reads as empty. A text without words has the empty set, links
with nothing and is its own component. Rows that share an id but not the text are separate
documents. A row with a null id gets a null component and links with nothing. A very long text is hashed whole, in a
slice of its own. An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_in, stored, trimmed, whole_text
from .shingles import mix, shingle_sets, sliced

#: Links have 4 * intersection >= 3 * union.
SMALL = 64
FEW = 256
PIVOTS = 4
#: Rows for which the support test takes another bucket.
ROWS_A_BUCKET = 2500
RECORDS = "bucket int, ids binary, tokens binary, refs binary, sizes binary, digests binary, counts binary"
LOCAL = np.uint16(65535)


def least_overlap(n: int) -> int:
    """At least so many of n shingles are in any linked set."""
    return (3 * n + 3) // 4


def prefix_length(n: int, whole: bool) -> tuple[int, int]:
    """How many of the smallest hashes to send, and how many of them a linked set must have.

    If two sets share o or more, the first l shared ones, in any common order, are among the
    first n - o + l of each. With l = n / 4, half of the set is sent.
    """
    if whole or not n:
        return n, least_overlap(n)
    part = lambda m: (m + 3) // 4
    return n - least_overlap(n) + part(n), part(least_overlap(n))


def sent(rows: Iterator[list[tuple[int, np.ndarray]]], buckets: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Records of slices of (id, set): shingles by bucket, and the documents with what they share in the slice."""
    for part in rows:
        ids = np.array([i for i, _ in part], np.int64)
        lengths = [prefix_length(len(s), whole)[0] for _, s in part]
        tokens = np.concatenate([s[:k] for (_, s), k in zip(part, lengths, strict=True)]) if part else np.empty(0, np.int64)
        refs = np.repeat(np.arange(len(part), dtype=np.uint16), lengths)
        order = np.argsort(tokens, kind="stable")
        tokens, refs = tokens[order], refs[order]
        new = np.r_[True, tokens[1:] != tokens[:-1]] if len(tokens) else np.empty(0, bool)
        starts = np.flatnonzero(new)
        times = np.diff(np.r_[starts, len(tokens)])
        shared_here = np.repeat(times > 1, times)
        counts = np.bincount(refs[shared_here], minlength=len(part)).astype(np.int64)
        tokens, refs = tokens[starts], np.where(times > 1, LOCAL, refs[starts])
        raw = tokens.view(np.uint64)
        bucket = (raw % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        raw, refs, bucket = raw[order], refs[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        out = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            k = slice(cuts[b], cuts[b + 1])
            used, own = np.unique(refs[k], return_inverse=True)
            known = np.where(used == LOCAL, 0, used)
            own = np.where(refs[k] == LOCAL, LOCAL, own.astype(np.uint16))
            six = np.ascontiguousarray((raw[k] >> np.uint64(8)).view(np.uint8).reshape(-1, 8)[:, :6])
            out.append((b, ids[known].tobytes(), six.tobytes(), own.astype(np.uint16).tobytes(), None, None, None))
        home = home_of(ids, buckets)
        sizes = np.array([len(s) for _, s in part], np.int64)
        digests = np.frombuffer(b"".join(digest_of(s) for _, s in part), "V16")
        for b in np.unique(home).tolist():
            k = np.flatnonzero(home == b)
            out.append((b, ids[k].tobytes(), None, None, sizes[k].tobytes(), digests[k].tobytes(), counts[k].tobytes()))
        yield records(out)


RECORD_SCHEMA = [("bucket", pa.int32())] + [(c, pa.binary()) for c in ("ids", "tokens", "refs", "sizes", "digests", "counts")]


def records(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(RECORD_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, RECORD_SCHEMA, strict=True)],
                                      names=[n for n, _ in RECORD_SCHEMA])


def home_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket that gathers the answers to a document."""
    return (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def answered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The document records, and for each document how many of a bucket's shingles other slices have, by home."""
    tokens, owners, local = [], [], []
    for batch in batches:
        for r in batch.to_pylist():
            if r["tokens"] is None:
                yield records([(r["bucket"], r["ids"], None, None, r["sizes"], r["digests"], r["counts"])])
                continue
            ids = np.frombuffer(r["ids"], np.int64)
            wide = np.zeros((len(r["tokens"]) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(r["tokens"], np.uint8).reshape(-1, 6)
            refs = np.frombuffer(r["refs"], np.uint16)
            here = refs == LOCAL
            tokens.append(wide.view(np.uint64).ravel())
            owners.append(ids[np.where(here, 0, refs)])
            local.append(here)
    if not tokens:
        return
    tokens, owners, local = np.concatenate(tokens), np.concatenate(owners), np.concatenate(local)
    order = np.argsort(tokens)
    tokens = tokens[order]
    new = np.r_[True, tokens[1:] != tokens[:-1]]
    lone = new & np.r_[new[1:], True]
    heard = order[~lone]
    ids, counts = np.unique(owners[heard[~local[heard]]], return_counts=True)
    home = home_of(ids, buckets)
    out = []
    for b in np.unique(home).tolist():
        k = np.flatnonzero(home == b)
        out.append((b, ids[k].tobytes(), None, None, None, None, counts[k].astype(np.int64).tobytes()))
    yield records(out)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, digest, shared) of the documents at home here."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    every = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
    known, place = np.unique(every, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)
    for r in rows:
        if r["sizes"] is not None:
            ids = np.frombuffer(r["ids"], np.int64)
            digests = [r["digests"][16 * i:16 * i + 16] for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids), pa.array(np.frombuffer(r["sizes"], np.int64)), pa.array(digests, pa.binary()),
                pa.array(total[np.searchsorted(known, ids)])], names=["doc_id", "n", "digest", "shared"])


def support(rows: DataFrame, read: Callable, whole: bool) -> DataFrame:
    """(doc_id, n, digest, supported) of every row; ``supported``: enough of its shingles occur elsewhere."""
    # A slice sends a record to each bucket that it has shingles for, so buckets are no more than the rows need.
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    buckets = max(1, min(most, -(-rows.count() // ROWS_A_BUCKET)))

    def send(batches):
        return sent(read(batches), buckets, whole)

    def answer(batches):
        return answered(batches, buckets)

    heard = rows.mapInArrow(trimmed(send), RECORDS).repartition(buckets, "bucket").mapInArrow(trimmed(answer), RECORDS)
    flat = heard.repartition(buckets, "bucket").mapInArrow(
        trimmed(gathered), "doc_id long, n long, digest binary, shared long")
    o = lambda n: F.floor((n * 3 + 3) / 4)
    need = o(F.col("n")) if whole else F.floor((o(F.col("n")) + 3) / 4)
    return flat.select("doc_id", "n", "digest", ((F.col("n") > 0) & (F.col("shared") >= need)).alias("supported"))


def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for b in batches:
        yield from zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True)


def text_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    for part in sliced(pairs_of(batches)):
        yield list(zip([i for i, _ in part], shingle_sets([t for _, t in part]), strict=True))


def stored_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    for part in sliced(pairs_of(batches)):
        yield [(i, np.frombuffer(t, np.int64)) for i, t in part]


def digest_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_sets(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in part], pa.int64()), pa.array([digest_of(s) for _, s in part], pa.binary()),
             pa.array([s.tobytes() for _, s in part], pa.binary())], names=["doc_id", "digest", "set"])


def as_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_sets(batches):
        none = pa.nulls(len(part), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array([len(s) for _, s in part], pa.int64()), none],
                                         names=["doc_id", "n", "component_id"])


def as_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in stored_sets(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in part], pa.int64()), pa.array([s for _, s in part], pa.list_(pa.int64()))],
            names=["id", "set"])


def least_shared(na: Column, nb: Column) -> Column:
    """Two sets of these sizes link when they share so many: 4 * shared >= 3 * (na + nb - shared)."""
    return F.floor(((na + nb) * 3 + 6) / 7)


def members_of(sets: DataFrame) -> DataFrame:
    """(region, id, n, c, w, pos): each set in the regions of its prefix's shared shingles, rarest first.

    c counts the set's shingles that occur in another set; the others come first in the order and meet
    nobody. pos is the shingle's place. w sums over the shared shingles how many sets have
    them: in a family of near copies it is largest for the set closest to all others.
    """
    tokens = sets.select("id", "n", F.explode("set").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    known = tokens.join(often, "token").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known"), F.sum("df").alias("w"))
    known = known.withColumn("c", F.size("known"))
    most = F.col("c") - F.floor((F.col("n") * 3 + 3) / 4) + 1
    known = known.filter(most > 0)
    return known.select("id", "n", "c", "w", F.posexplode(F.slice("known", F.lit(1), most.cast("int"))).alias("p", "t")).select(
        F.col("t.token").alias("region"), "id", "n", "c", "w", (F.col("n") - F.col("c") + F.col("p") + 1).alias("pos"))


def with_company(members: DataFrame) -> DataFrame:
    """``members`` with the number of ``cores`` in their region, without those that no size of set in the region lets link.

    Linked sets that share o shingles at least have a common one within the first n - o + 1 of each.
    """
    n = F.col("n")
    regions = members.groupBy("region").agg(
        F.count("*").alias("size"), F.sum(F.col("core").cast("int")).alias("cores"), F.collect_set("n").alias("sizes"))

    def fits(s: Column) -> Column:
        o = least_shared(n, s)
        return (o <= F.col("c")) & (o <= s) & (F.col("pos") <= n - o + 1)

    found = members.join(regions.filter("size > 1 and cores > 0"), "region")
    return found.filter(F.exists("sizes", fits)).drop("sizes", "size")


def close_pairs(members: DataFrame) -> DataFrame:
    """(a, b): pairs of a region with a core member that may link and are not connected through a pivot.

    With x members in common with the region's pivot, two sets share at most the smaller x and, beyond the
    pivot, the smaller c - x.
    """
    a, b = members.filter("core").alias("a"), members.alias("b")
    col = F.col
    o = least_shared(col("a.n"), col("b.n"))
    window = F.least("a.x", "b.x") + F.least(col("a.c") - col("a.x"), col("b.c") - col("b.x")) >= o
    prefix = (col("a.pos") <= col("a.n") - o + 1) & (col("b.pos") <= col("b.n") - o + 1)
    apart = F.coalesce(col("a.label") != col("b.label"), F.lit(True))
    once = F.when(col("b.core"), col("a.id") < col("b.id")).otherwise(col("a.id") != col("b.id"))
    found = a.join(b, (col("a.region") == col("b.region")) & once & apart & prefix & window)
    return found.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, distance, linked) of pairs of ids."""
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(two, "b")
    both = both.withColumn("shared", F.size(F.array_intersect("set_a", "set_b")))
    both = both.withColumn("joint", F.size("set_a") + F.size("set_b") - F.col("shared"))
    return both.select("a", "b", "shared", (1 - F.col("shared") / F.col("joint")).alias("distance"),
                       (F.col("shared") * 4 >= F.col("joint") * 3).alias("linked"))


def pivoted(members: DataFrame, sets: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """The measured pairs of pivots and members, and the members of the regions' cells."""
    # Pivots are core members: the most central one, the others drawn by hash.
    core_id = F.when(F.col("core"), F.col("id"))
    draws = [F.max(F.when(F.col("core"), F.struct("w", "id")))["id"]] + [
        F.min(F.when(F.col("core"), F.struct(F.xxhash64(core_id, F.lit(level * PIVOTS + j)), "id")))["id"]
        for j in range(1, PIVOTS)]
    pivots = members.groupBy("region").agg(F.array_distinct(F.array(*draws)).alias("pivots"))
    to_pivot = members.join(pivots, "region").select(
        "region", "id", "n", "c", "w", "pos", "core", "label", "main", (F.array_position("pivots", F.col("id")) - 1).alias("own"),
        F.posexplode("pivots").alias("rank", "pivot")).filter("id != pivot")
    pair = [F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")]
    met = stored(measured(to_pivot.select(*pair).distinct(), sets), "pivot-distances")

    known = to_pivot.select("*", *pair).join(met, ["a", "b"])
    # Labels: members linked to a pivot are connected. A pivot takes over a label that one of them has from before,
    # or else the smallest rank among the pivots that it is linked to.
    labels = known.filter("linked").groupBy("region", "rank").agg(
        F.min("label").alias("old"), F.min(F.when(F.col("own") >= 0, F.col("own"))).alias("tied"))
    labels = labels.groupBy("region").agg(F.collect_list(F.struct("rank", F.coalesce(
        "old", (F.least("rank", "tied") + (level + 1) * PIVOTS).cast("long")).alias("label"))).alias("labels"))
    found = known.filter("own < 0").groupBy("region", "id", "n", "c", "w", "pos", "core", "label", "main").agg(
        F.min(F.struct("distance", "rank")).alias("near"), F.collect_list(F.struct("rank", "shared", "linked")).alias("all"))
    found = found.join(labels, "region", "left")
    new = lambda rank: F.array_max(F.transform(
        F.filter("labels", lambda x: x["rank"] == rank), lambda x: x["label"]))
    linked_to = F.transform(F.filter("all", lambda p: p["linked"]), lambda p: new(p["rank"]))
    found = found.withColumn("label", F.coalesce(F.array_min(linked_to), "label"))
    # Members with the label of the first region's central pivot are connected, so two of them need no comparison. The
    # others stay core members: they are compared with all that have another label.
    found = found.withColumn("main", F.coalesce("main", new(F.lit(0)), F.lit(-1)))
    found = found.withColumn("core", F.col("core") & ~F.col("label").eqNullSafe(F.col("main")))
    placed = found.select("region", "id", "n", "c", "w", "pos", "label", "main", "core", F.col("near.rank").alias("own"),
                          F.explode("all").alias("p"))
    placed = placed.withColumns({"cell": F.col("p.rank"), "x": F.col("p.shared")})
    placed = placed.withColumn("core", F.col("core") & (F.col("own") == F.col("cell")))
    # A cell has the core members nearest to its pivot, and all others whose window reaches one of them.
    cells = placed.filter("core").groupBy("region", "cell").agg(
        F.max("x").alias("x_most"), F.max(F.col("c") - F.col("x")).alias("y_most"), F.min("n").alias("n_least"))
    smallest = F.greatest(F.col("n_least"), F.floor((F.col("n") * 3 + 3) / 4))
    reach = F.least("x", "x_most") + F.least(F.col("c") - F.col("x"), F.col("y_most")) >= least_shared(F.col("n"), smallest)
    inner = placed.join(cells, ["region", "cell"]).filter(F.col("core") | reach)
    return met, inner.select(F.xxhash64("region", "cell", F.lit(level)).alias("region"), "id", "n", "c", "w", "pos", "core",
                             "label", "main", "x")


def links_of(sets: DataFrame) -> DataFrame:
    """(a, b): links that connect what all links between the sets connect."""
    none = F.lit(None).cast("long")
    members = members_of(sets).withColumns({"core": F.lit(True), "label": none, "main": none, "x": F.lit(0)})
    pairs, links, level = [], [], 0
    while True:
        # The bound doubles by level, so regions in which no pivot settles anything end in all pairs too.
        bound = SMALL if level == 0 else FEW << level
        members = stored(members, f"pivot-members-{level}")
        members = stored(with_company(members), f"pivot-company-{level}")
        pairs.append(close_pairs(members.filter(F.col("cores") <= bound)))
        large = members.filter(F.col("cores") > bound).drop("cores")
        if large.isEmpty():
            break
        met, members = pivoted(large, sets, level)
        links.append(met.filter("linked").select("a", "b"))
        level += 1
    every = pairs[0]
    for p in pairs[1:]:
        every = every.union(p)
    links.append(measured(every.distinct(), sets).filter("linked").select("a", "b"))
    found = links[0]
    for x in links[1:]:
        found = found.union(x)
    return stored(found.distinct(), "pivot-links")


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links reach, by propagation and pointer jumping."""
    edges = stored(links.select("a", "b").union(links.select("b", "a")), "pivot-edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component"))
    labels = stored(labels, "pivot-labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("m"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.least("component", "m").alias("component"),
                                                                  F.col("component").alias("before"))
        ahead = step.select(F.col("id").alias("at"), F.col("component").alias("further"))
        step = step.join(ahead, step["component"] == ahead["at"]).select("id", F.least("component", "further").alias(
            "component"), "before")
        step = stored(step, "pivot-labels")
        if step.filter("component != before").isEmpty():
            return step.select("id", "component")
        labels = step.select("id", "component")


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    named = rows.filter("doc_id is not null")
    flags = stored(support(named, text_sets, whole=False), "pivot-support")
    classes = flags.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("name"), F.max("supported").alias("supported"))
    # Classes are told apart by their whole digests and get numbers of their own, fixed once written.
    wanted = classes.filter("supported").select("digest", F.col("name").alias("doc_id"))
    wanted = stored(wanted.withColumn("node", F.monotonically_increasing_id()), "pivot-wanted")
    # Texts are not shuffled: a filter of fixed size leaves few besides the wanted ones, the join drops those.
    sets = maybe_in(named, wanted)[0].mapInArrow(trimmed(as_sets), "doc_id long, digest binary, set binary")
    sets = sets.join(wanted, ["doc_id", "digest"]).select(F.col("node").alias("doc_id"), "set")
    sets = stored(sets.dropDuplicates(["doc_id"]), "pivot-sets")
    # The same test on whole sets, with one set a class.
    kept = support(sets, stored_sets, whole=True).filter("supported").select("doc_id")
    lists = sets.join(kept, "doc_id", "left_semi").mapInArrow(trimmed(as_lists), "id long, set array<long>")
    lists = stored(lists.withColumn("n", F.size("set")), "pivot-lists")
    reached = components(links_of(lists))

    joined = wanted.join(reached, wanted["node"] == reached["id"]).select("digest", F.col("doc_id").alias("name"), "component")
    smallest = joined.groupBy("component").agg(F.min("name").alias("component_id"))
    joined = joined.join(smallest, "component").select("digest", "component_id")
    alone = classes.join(joined, "digest", "left").select("digest", F.coalesce("component_id", "name").alias("component_id"))
    full = flags.filter("n > 0").select("doc_id", "n", "digest").join(alone, "digest")
    empty = flags.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    unnamed = rows.filter("doc_id is null").mapInArrow(trimmed(as_sizes), "doc_id long, n long, component_id long")
    out = full.select("doc_id", "n", "component_id").unionByName(empty).unionByName(unnamed)
    return out.withColumnRenamed("n", "n_shingles")
