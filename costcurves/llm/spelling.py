"""Operator 13: spelling variants by a relational trie frontier.

Words are runs of letters, counted over all texts. Their trie is a distributed edge table (node, letter,
child). A state of the frontier is (prefix, node) after one edit: the word's letters up to the position that
``prefix`` has reached, and the trie node that they lead to with one edit. Words of one prefix share
its states, so the root is one state and not one a word. Without an edit, prefix and node are one node of the
trie, which needs no state. Level by level:

* nodes start states with an edit: two letters of their own (a replaced code point), or a letter that only the
  longer word has (an inserted one, which is a deleted one seen from the other side);
* each state reads one more letter: the edge table is joined on the prefix, and on (node, letter).

States that meet a word on both sides are terminal: those words are near. Where one word alone is left below a prefix
or a node, its remaining letters are read at once, and what they lead to is looked up in the word table.

Nodes are prefixes of two words or more, so the depth is that of the longest prefix that two words share. Prefixes
are made ``DEPTH`` letters at a time, the next ones for words that still share theirs. A node has one edge a
letter of the alphabet at most and a prefix two such sets of states a position, so no join key is hot and pairs of a
node's letters are bounded. Occurrences are counted by word before they are shuffled.

Defined cases: a null text has no words; a null id reads as empty in ``<doc_id>:<word>``. Repeated rows count
again. Very long texts and words are taken whole. An empty table gives an empty result. Only the id and text
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_TIMES, RATIO = 6, 5, 5
DROP_EVERY = 199
DEPTH = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_dropped_letters(runs: DataFrame, every: int = DROP_EVERY) -> Column:
    """``run`` without one code point where ``every`` divides the CRC-32 of ``<doc_id>:<run>``; at the sum modulo its length."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(key.cast("binary"))
    place = (h % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    return F.when(h % every == 0, less).otherwise(F.col("run"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None,
                least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of ``least_length`` code points that occur ``least_times``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(
        F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS})"), F.lit(1))).alias("run"))
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    rows = rows.select("doc_id", lowered.alias("run"))
    word = F.col("run") if drop_every is None else with_dropped_letters(rows, drop_every)
    words = rows.select(word.alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_times)


def trie_edges(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(node, letter, child, below, only, ends), stored: the edges of nodes with two words or more below them.

    ``below``: words below the child, itself included; ``only``: the word, if it is one; ``ends``: the child is a word.
    """
    found, alive, base, deep = None, words.select("word"), 0, None
    while True:
        steps = F.sequence(F.lit(base), F.least(F.length("word"), F.lit(base + depth)))
        child = F.substring(F.col("word"), F.lit(1), F.col("k"))
        nodes = alive.select("word", F.explode(steps).alias("k")).groupBy(child.alias("child")).agg(
            F.count("*").alias("below"), F.min("word").alias("only"), F.max(F.length("word") == F.col("k")).alias("ends"))
        nodes = stored(nodes, f"trie-nodes-{base}")
        size = F.length("child")
        shared = nodes.filter("below > 1").select(F.col("child").alias("node"))
        edges = nodes.filter(size > base).select(
            F.substring(F.col("child"), F.lit(1), size - 1).alias("node"), F.substring(F.col("child"), size, F.lit(1)).alias("letter"),
            "child", "below", F.when(F.col("below") == 1, F.col("only")).alias("only"), "ends").join(shared, "node", "left_semi")
        found = edges if found is None else found.unionByName(edges)
        base += depth
        deep = nodes.filter((size == base) & (F.col("below") > 1)).select(F.col("child").alias("start"))
        if deep.isEmpty():
            return stored(found, "trie-edges")
        start = F.substring(F.col("word"), F.lit(1), F.lit(base))
        alive = stored(alive.withColumn("start", start).join(deep, "start", "left_semi").select("word"), "trie-words")


SIDE = ["below", "only", "ends"]


def states_of(rows: DataFrame, a: str, b: str, prefix: Column, own: dict[str, Column] | None = None) -> DataFrame:
    """States of joined edges ``a`` (the prefix's, unless ``own`` tells) and ``b`` (the node's).

    Where one word is left on either side, both must go on alike.
    """
    mine = own or {c: F.col(f"{a}.{c}") for c in SIDE}
    rows = rows.select(prefix.alias("prefix"), *[mine[c].alias(c) for c in SIDE], F.col(f"{b}.child").alias("node"),
                       *[F.col(f"{b}.{c}").alias(f"node_{c}") for c in SIDE])
    return rows.filter(F.coalesce(rest("only", "prefix") == rest("node_only", "node"), F.lit(True)))


def rest(word: str, start: str) -> Column:
    """The letters of a word after its start."""
    return F.substring(F.col(word), F.length(start) + 1, F.length(word))


def started(edges: DataFrame, words: DataFrame) -> DataFrame:
    """The states of all nodes that have just taken their edit."""
    a, b = edges.alias("a"), edges.alias("b")
    replaced = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.letter") < F.col("b.letter")))
    # The node of an edge has two words or more; it is a word itself if the word table has it.
    longer = b.join(words.select(F.col("word").alias("own")), F.col("b.node") == F.col("own"), "left")
    inner = {"below": F.lit(2).cast("long"), "only": F.lit(None).cast("string"), "ends": F.col("own").isNotNull()}
    return states_of(replaced, "a", "b", F.col("a.child")).unionByName(states_of(longer, "a", "b", F.col("b.node"), inner))


def advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one letter on."""
    inner = states.filter("below > 1 and node_below > 1").select("prefix", "node").alias("s")
    a, b = edges.alias("a"), edges.alias("b")
    rows = inner.join(a, F.col("s.prefix") == F.col("a.node")).join(
        b, (F.col("s.node") == F.col("b.node")) & (F.col("a.letter") == F.col("b.letter")))
    # An inserted letter equal to the next one may as well be inserted after it, where another state begins.
    return states_of(rows.filter(F.col("a.child") != F.col("s.node")), "a", "b", F.col("a.child"))


def terminal(states: DataFrame) -> DataFrame:
    """(a, b): words that states lead to; one of the two may not be a word where a single one is left on the other side."""
    a = F.coalesce(F.col("only"), F.when(F.col("node_only").isNotNull(), F.concat("prefix", rest("node_only", "node"))),
                   F.when(F.col("ends") & F.col("node_ends"), F.col("prefix")))
    b = F.coalesce(F.col("node_only"), F.when(F.col("only").isNotNull(), F.concat("node", rest("only", "prefix"))),
                   F.when(F.col("ends") & F.col("node_ends"), F.col("node")))
    return states.select(a.alias("a"), b.alias("b")).filter("a is not null and b is not null")


def near_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(a, b), stored, a < b: the words that differ by one inserted, deleted or replaced code point."""
    edges = trie_edges(words, depth)
    states, pairs = stored(started(edges, words), "trie-states"), None
    while True:
        ends = terminal(states)
        pairs = ends if pairs is None else pairs.unionByName(ends)
        states = stored(advanced(states, edges), "trie-states")
        if states.isEmpty():
            break
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = words.select("word")
    pairs = pairs.join(known, pairs["a"] == known["word"], "left_semi")
    return stored(pairs.join(known, pairs["b"] == known["word"], "left_semi"), "near-words")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): forms followed to the last, by doubling pointers.

    A form occurs more often than its word, so there are no rings.
    """
    links = stored(forms.select("word", F.col("form").alias("root")), "form-links")
    while True:
        ahead = links.select(F.col("word").alias("at"), F.col("root").alias("further"))
        links = stored(links.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "form-links")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, depth: int = DEPTH) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row (word, n).

    The form is the near word of largest n, the first in code-point order of equals, if its n is ``ratio`` times
    the word's; the root is the last of the forms that follow.
    """
    words = stored(words.select("word", "n"), "word-counts")
    pairs = near_pairs(words, depth)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), "n"), "b").groupBy("a").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "b")).alias("best"))
    near = near.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n"))
    found = words.join(near, "word", "left")
    fits = F.col("form_n") >= F.col("n") * ratio
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n")),
                   "word-forms")
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None) -> DataFrame:
    """``variants`` of the words of all texts."""
    return variants(word_counts(docs, id_col, text_col, drop_every))
