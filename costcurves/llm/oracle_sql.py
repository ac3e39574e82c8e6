"""DuckDB SQL for the queries that SQL can express, over the pre-registered tables."""

from __future__ import annotations

from . import line_chunks, poisson_mix, rendezvous, spelling, spotsigs

UNIT = "(('0x' || substr(md5({0}), 1, 12))::BIGINT + 0.5) / 281474976710656.0"

#: The table t of CRC-32, one row.
CRC_TABLE = """tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_concat([i::UBIGINT], list_transform(range(8), lambda z: 0::UBIGINT)),
                        lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)))"""


def spotsigs_sql() -> str:
    anchors = "[" + ", ".join(f"'{a}'" for a in spotsigs.ANCHORS) + "]"
    chain = " || ' ' || ".join(f"content[p - k + {j * spotsigs.DISTANCE} + 1]" for j in range(spotsigs.CHAIN))
    last = (spotsigs.CHAIN - 1) * spotsigs.DISTANCE

    def sets(name: str, source: str, text: str) -> str:
        """(doc_id, sigs) of a text column. p: word before the anchor's place, k: anchors before it."""
        return f"""
{name}_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower({text}), '{spotsigs.WORD_BREAK}'), lambda w: w <> '') AS words
  FROM {source}),
{name}_parts AS (
  SELECT doc_id, words, list_filter(words, lambda w: NOT list_contains({anchors}, w)) AS content,
         list_filter(list_transform(words, lambda w, i: CASE WHEN list_contains({anchors}, w) THEN i - 1 END),
                     lambda i: i IS NOT NULL) AS places
  FROM {name}_words),
{name}_flat AS (
  SELECT doc_id, words, content, unnest(places) AS p, generate_subscripts(places, 1) - 1 AS k FROM {name}_parts),
{name}_found AS (
  SELECT doc_id, list_sort(list_distinct(list(words[p + 1] || ' ' || {chain}))) AS sigs
  FROM {name}_flat WHERE p - k + {last} < len(content) GROUP BY doc_id),
{name} AS (
  SELECT w.doc_id, CASE WHEN f.sigs IS NOT NULL THEN f.sigs
                        WHEN len(w.words) > 0 THEN list_sort(list_distinct(list_transform(
                          range(1, greatest(len(w.words) - {spotsigs.SHINGLE - 1}, 1) + 1),
                          lambda i: array_to_string(w.words[i:i + {spotsigs.SHINGLE - 1}], ' '))))
                        ELSE []::VARCHAR[] END AS sigs
  FROM {name}_words w LEFT JOIN {name}_found f USING (doc_id))"""

    def alike(a: str, b: str) -> str:
        shared = f"len(list_intersect({a}, {b}))"
        return (f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE "
                f"ELSE {shared}::DOUBLE / (len({a}) + len({b}) - {shared}) END")

    def band(a: str) -> str:
        return f"CASE WHEN len({a}) = 0 THEN -1 ELSE floor(ln(len({a})::DOUBLE) / ln({1 / spotsigs.THRESHOLD!r})) END"

    def near(a: str, b: str) -> str:
        t = spotsigs.THRESHOLD
        return (f"CASE WHEN abs({band(a)} - {band(b)}) > 1 OR least(len({a}), len({b})) < greatest(len({a}), len({b})) * {t} "
                f"THEN FALSE ELSE {alike(a, b)} >= {t} END")

    return f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edited AS (
  SELECT *, substr(text, 1, (length(text) - length(text) // 3)::BIGINT)
            || substr(next_text, 1, (length(text) // 3)::BIGINT) AS other FROM ordered),
{sets("own", "edited", "text")},
{sets("ed", "edited", "other")}
SELECT e.doc_id, length(e.text)::BIGINT AS n_chars, sha256(e.other) AS edited_sha256,
       sha256(array_to_string(o.sigs, chr(10))) AS fingerprint, sha256(array_to_string(d.sigs, chr(10))) AS edited_fingerprint,
       {alike("o.sigs", "d.sigs")} AS near_edited, {alike("o.sigs", "n.sigs")} AS near_next,
       len(o.sigs)::BIGINT AS n_signatures, ({band("o.sigs")})::BIGINT AS length_partition,
       {near("o.sigs", "d.sigs")} AS same_as_edited, {near("o.sigs", "n.sigs")} AS same_as_next
FROM edited e JOIN own o ON o.doc_id = e.doc_id JOIN ed d ON d.doc_id = e.doc_id JOIN own n ON n.doc_id = e.next_id"""


def line_chunks_sql() -> str:
    rolled = "num" + "".join(
        f" + coalesce(lag(num, {j}) OVER w, 0) * {line_chunks.BASE**j}" for j in range(1, line_chunks.WINDOW))
    return f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
flat AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
numbered AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS num FROM flat),
ends AS (SELECT doc_id, i, line, (({rolled}) % {line_chunks.SPACING} = 0)::INT AS cut
         FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS chunk FROM ends),
chunks AS (SELECT doc_id, chunk, min(i) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS bytes
           FROM placed GROUP BY doc_id, chunk),
ranked AS (SELECT *, n >= 2 AND regexp_matches(bytes, '[^\\x20\\x09-\\x0D]')
             AND row_number() OVER (PARTITION BY bytes, n >= 2 ORDER BY doc_id, first) > 1 AS gone FROM chunks),
kept AS (SELECT doc_id, count(*) AS n_chunks, sum(n) AS n_lines, count(*) FILTER (gone) AS removed_chunks,
                coalesce(sum(n) FILTER (gone), 0) AS removed_lines,
                coalesce(string_agg(bytes, chr(10) ORDER BY first) FILTER (NOT gone), '') AS clean
         FROM ranked GROUP BY doc_id)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_chunks::BIGINT AS n_chunks, removed_chunks::BIGINT AS removed_chunks,
       removed_lines::BIGINT AS removed_lines, length(clean)::BIGINT AS clean_chars, sha256(clean) AS clean_sha256
FROM kept"""


def poisson_mix_sql() -> str:
    seed, t, epochs = poisson_mix.SEED, poisson_mix.TEMPERATURE, poisson_mix.EPOCHS
    name = "coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))"
    draw, order = UNIT.format(f"'{seed}:' || {name}"), UNIT.format(f"'{seed}-order:' || {name} || ':' || copy")
    return f"""
WITH sizes AS (SELECT coalesce(source, '') AS s, sum(greatest(length(coalesce(text, '')), 1))::DOUBLE AS size
               FROM documents GROUP BY 1),
wishes AS (SELECT *, pow(size, {t})::DECIMAL(38, 9) AS wish FROM sizes),
rates AS (SELECT s, {epochs} * (wish::DOUBLE / (SELECT sum(wish)::DOUBLE FROM wishes))
                 * ((SELECT sum(size) FROM sizes) / size) AS rate FROM wishes),
steps AS (SELECT s, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
          FROM rates, LATERAL (SELECT unnest(range((rate + 12 * sqrt(rate + 1) + 12)::INT)) AS k)),
cdf AS (SELECT s, rate, list(total ORDER BY k) AS steps FROM (
          SELECT s, rate, k, sum(p) OVER (PARTITION BY s ORDER BY k ROWS UNBOUNDED PRECEDING) AS total FROM steps)
        GROUP BY s, rate),
counted AS (SELECT d.doc_id, d.text, d.lang, d.source, rate,
                   len(list_filter(steps, lambda c: c < {draw})) AS copies
            FROM documents d JOIN cdf ON cdf.s = coalesce(d.source, '')),
copied AS (SELECT *, unnest(range(copies)) AS copy FROM counted)
SELECT doc_id, text, lang, source, round(rate, 6) AS rate, copies::BIGINT AS copies, copy::BIGINT AS copy,
       {order} AS order_key FROM copied"""


def rendezvous_sql() -> str:
    def shard(n: int) -> str:
        draws = ", ".join(
            f"{{'draw': -ln({UNIT.format(f"'{rendezvous.SEED}:{j}:' || doc_id")}), 'shard': {j}}}" for j in range(n))
        return f"(list_sort([{draws}]))[1].shard::INT"

    slot = UNIT.format("'slot:' || doc_id")
    return f"""
WITH {CRC_TABLE},
docs AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS bytes, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (SELECT doc_id, bytes + 1 AS size, xor(list_reduce(
           list_concat([4294967295::UBIGINT], list_transform(range(bytes), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255::UBIGINT)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
         FROM docs, tab),
placed AS (SELECT *, {shard(rendezvous.SHARDS)} AS shard, {shard(rendezvous.SHARDS + 1)} AS grown_shard,
                  floor({slot} * {rendezvous.BLOCKS}) AS block FROM sums)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY block, doc_id, size, text_crc32) - 1)::BIGINT AS slot, grown_shard
FROM placed"""


def stream_dedup_sql() -> str:
    return """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS c FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY c) AS keep_id, count(*) OVER (PARTITION BY c) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY c) AS kept, sha256(c) AS text_sha256 FROM t"""


def spelling_sql() -> str:
    """Near words share what is left when one code point goes (a replaced one: at the same place)."""
    return f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{spelling.LETTERS}')) AS run FROM documents),
lowered AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS key,
                   translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS run, count(*) AS times FROM runs GROUP BY 1, 2),
hashed AS (SELECT run, times, xor(list_reduce(
             list_concat([4294967295::UBIGINT], list_transform(range(octet_length(encode(key))),
                         lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::UBIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255::UBIGINT)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h
           FROM lowered, tab),
words AS (SELECT CASE WHEN h % {spelling.DROP_EVERY} = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
                                                          || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
                 sum(times)::BIGINT AS n
          FROM hashed GROUP BY 1 HAVING length(word) >= {spelling.LEAST_LENGTH} AND n >= {spelling.LEAST_TIMES}),
holes AS (SELECT word, unnest(range(length(word))) AS i FROM words),
less AS (SELECT word, i, substr(word, 1, i::BIGINT) AS a, substr(word, i::BIGINT + 2) AS b FROM holes),
pairs AS (SELECT x.word AS word, y.word AS other FROM less x JOIN less y USING (i, a, b) WHERE x.word <> y.word
          UNION SELECT word, a || b FROM less WHERE a || b IN (SELECT word FROM words)
          UNION SELECT a || b, word FROM less WHERE a || b IN (SELECT word FROM words)),
near AS (SELECT p.word, p.other, w.n AS m, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, encode(p.other)) AS place,
                count(*) OVER (PARTITION BY p.word) AS n_near
         FROM pairs p JOIN words w ON w.word = p.other),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {spelling.RATIO} * n THEN other END AS form,
                  CASE WHEN m >= {spelling.RATIO} * n THEN m END AS form_n
           FROM words w LEFT JOIN near x ON x.word = w.word AND place = 1),
followed AS (SELECT word, word AS root, form AS next FROM formed
             UNION ALL SELECT f.word, g.word, g.form FROM followed f JOIN formed g ON g.word = f.next)
SELECT f.word, n, n_near::BIGINT AS n_near, form, form_n, root
FROM formed f JOIN (SELECT word, root FROM followed WHERE next IS NULL) USING (word)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_spotsigs": spotsigs_sql(), "op2_line_chunks": line_chunks_sql(), "op4_poisson_mix": poisson_mix_sql(),
            "op5_rendezvous": rendezvous_sql(), "op9_stream_dedup": stream_dedup_sql(),
            "op13_spelling_variants": spelling_sql()}
