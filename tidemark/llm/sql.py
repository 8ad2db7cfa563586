"""SQL texts of the corpus queries, for comparison with DuckDB on the same tables."""

ORACLES = {}

ORACLES["op1_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(3) AS t(k) GROUP BY 1),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
  + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
  + CASE WHEN n_words > 200000 THEN 64 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits, failed_bits & 3 <> 0 AS base_failed, failed_bits & 63 = 0 AS kept FROM b
"""

ORACLES["op3_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
o AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  23 + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g')) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM o)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM p GROUP BY 1
"""

ORACLES["op8_mixing"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT *, [3, 1, 2][(no - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM d GROUP BY 1)),
l AS (SELECT *, row_number() OVER w AS place, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level FROM s WINDOW w AS (ORDER BY cap / weight, no)),
f AS (SELECT place, level FROM l WHERE cap / weight >= level ORDER BY place LIMIT 1),
t AS (SELECT l.*, CASE WHEN l.place >= f.place THEN weight * f.level ELSE cap::DOUBLE END AS target FROM l, f),
b AS (SELECT least(1024, greatest(1, sum(floor(target)::BIGINT) // 65536))::BIGINT AS block, sum(floor(target)::BIGINT)::BIGINT AS mixed FROM t),
c AS (SELECT *, sum(floor(target)::BIGINT) OVER (ORDER BY no) AS upto FROM t),
p AS (SELECT no, floor((upto - floor(target)::BIGINT)::DOUBLE / mixed::DOUBLE * 4294967296.0::DOUBLE)::BIGINT AS low, floor(upto::DOUBLE / mixed::DOUBLE * 4294967296.0::DOUBLE)::BIGINT AS high FROM c, b),
g AS (SELECT (i * 2654435769) % 4294967296 AS u FROM b, range(0, (mixed + block - 1) // block) AS r(i)),
k AS (SELECT no, count(*) AS slots FROM g JOIN p ON u >= low AND u < high GROUP BY 1),
o AS (SELECT doc_id, size, no, (sum(size) OVER (PARTITION BY no ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING) - size) AS start FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (greatest(0, least(size, coalesce(slots, 0) * block - start)) + greatest(0, least(size, coalesce(slots, 0) * block - source_size - start)))::BIGINT AS taken
FROM o JOIN t USING (no) LEFT JOIN k USING (no), b
"""

ORACLES["op2_url_filter"] = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
r AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(says, name, start)),
m AS (SELECT u.*, CASE WHEN list_has_any(string_split_regex(host, '[.-]'), ['ads', 'adult', 'bets', 'casino', 'pills', 'spam']) THEN true ELSE false END AS listed,
  (SELECT max((length(name || start), name || start, says)) FROM r WHERE ends_with('.' || host, '.' || name) AND starts_with(path, start)) AS best FROM u)
SELECT page_id, host, path, best[2] AS rule, coalesce(best[3], CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM m
"""

ORACLES["op4_threshold_search"] = """
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS d FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, d, floor(64 * x)::BIGINT AS x FROM v),
s AS (SELECT a.vec_id AS query_id, b.vec_id, sum(a.x * b.x)::BIGINT AS score FROM q a JOIN q b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

ORACLES["op12_line_dedup"] = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line, translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
c AS (SELECT key, max(doc_id) AS holder FROM l WHERE length(key) >= 40 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, c.key IS NOT NULL AND doc_id IS DISTINCT FROM holder AS lost FROM l LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256 FROM m GROUP BY r
"""

#: The CRC-32 of a word goes through its bits, lowest of each byte first.
ORACLES["op13_importance"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
e AS (SELECT unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS word FROM benchmark),
n AS (SELECT word, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM (SELECT word, 1 AS s, 0 AS t FROM (SELECT unnest(words) AS word FROM d) UNION ALL SELECT word, 0, 1 FROM e) GROUP BY 1),
x AS (SELECT *, hex(encode(word)) AS code FROM n),
y AS (SELECT *, list_transform(range(4 * len(code)), lambda i: (('0x' || code[(i // 8) * 2 + 1:(i // 8) * 2 + 2])::BIGINT >> (i % 8)) & 1) AS bits FROM x),
b AS (SELECT word, s, t, xor(4294967295, list_reduce(list_prepend(4294967295, bits), lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)))) % 10000 AS bucket FROM y),
g AS (SELECT bucket, floor(1000 * ln((sum(t) + 1) * (sum(sum(s)) OVER () + 10000) / ((sum(s) + 1) * (sum(sum(t)) OVER () + 10000))))::BIGINT AS gain FROM b GROUP BY 1),
w AS (SELECT doc_id, sum(gain) AS weight FROM (SELECT doc_id, unnest(words) AS word FROM d) JOIN b USING (word) JOIN g USING (bucket) GROUP BY 1),
r AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, ('0x' || sha256('2024:' || doc_id)[:8])::BIGINT AS h FROM d LEFT JOIN w USING (doc_id)),
z AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM o
"""


def _rounds_of_codes(rounds: int = 6) -> str:
    """Parts against all entries, and the floored means, once a round; the last codes are final."""
    steps = [
        """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "x AS MATERIALIZED (SELECT vec_id, label, p, q[p * (len(q) // 8) + 1:(p + 1) * (len(q) // 8)] AS part FROM v, range(8) AS r(p))",
        "b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS entry FROM x QUALIFY e < 16)",
    ]
    nearest = "SELECT vec_id, label, x.p, e, entry, part, list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist FROM x JOIN b{0} b ON x.p = b.p QUALIFY row_number() OVER (PARTITION BY vec_id, x.p ORDER BY dist, e) = 1"
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({nearest.format(k)})")
        steps.append(f"m{k} AS MATERIALIZED (SELECT p, e, list(mean ORDER BY i) AS entry FROM (SELECT p, e, i, floor(sum(part[i])::DOUBLE / count(*))::BIGINT AS mean FROM a{k}, range(1, len(part) + 1) AS c(i) GROUP BY 1, 2, 3) GROUP BY 1, 2)")
        steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM b{k} b LEFT JOIN m{k} m USING (p, e))")
    steps.append(f"a AS MATERIALIZED ({nearest.format(rounds)})")
    steps.append("c AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM a GROUP BY 1)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})")
    return f"WITH {(',' + chr(10)).join(steps)}\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM c, h"


ORACLES["op11_ball_codes"] = _rounds_of_codes()
