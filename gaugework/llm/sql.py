"""DuckDB SQL that states the same results over the same tables."""

from __future__ import annotations

from gaugework.llm import hilbert_shards, mixing

CRC_TABLE = """crc_table AS (
  SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(n)
), crc_list AS (SELECT list(v ORDER BY n) AS l FROM crc_table)"""


def crc_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text; needs crc_list in scope."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    steps = f"list_prepend(4294967295::BIGINT, list_transform({pairs}, lambda p: ('0x' || p)::BIGINT))"
    return f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, l[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


def curve_sql() -> str:
    bits, dims = hilbert_shards.BITS, hilbert_shards.DIMENSIONS
    codes = ",\n".join(
        f"c{i} AS (SELECT v, ((2 * sum(n) OVER (ORDER BY v NULLS FIRST) - n) * {1 << bits}) // (2 * sum(n) OVER ()) AS x{i} FROM (SELECT {d} AS v, count(*) AS n FROM d GROUP BY 1))"
        for i, d in enumerate(dims)
    )
    joins = " ".join(f"JOIN c{i} ON d.{d} IS NOT DISTINCT FROM c{i}.v" for i, d in enumerate(dims))
    steps, last, n = [], "s0", len(dims)
    for b in range(bits - 1, 0, -1):
        for i in range(n):
            q, name = 1 << b, f"s{len(steps) + 1}"
            swap = f"(xor(x0, x{i}) & {q - 1})"
            first = f"CASE WHEN x{i} & {q} <> 0 THEN xor(x0, {q - 1}) ELSE xor(x0, {swap}) END AS x0"
            other = f", CASE WHEN x{i} & {q} <> 0 THEN x{i} ELSE xor(x{i}, {swap}) END AS x{i}" if i else ""
            steps.append(f"{name} AS (SELECT * REPLACE ({first}{other}) FROM {last})")
            last = name
    for i in range(1, n):
        steps.append(f"g{i} AS (SELECT * REPLACE (xor(x{i - 1}, x{i}) AS x{i}) FROM {last})")
        last = f"g{i}"
    term = "0"
    for b in range(bits - 1, 0, -1):
        term = f"xor({term}, CASE WHEN x{n - 1} & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    steps.append(f"t AS (SELECT *, {term} AS t FROM {last})")
    bit = " + ".join(f"((xor(x{i}, t) >> {b}) & 1) * {1 << (b * n + n - 1 - i)}" for b in range(bits) for i in range(n))
    chain = ",\n".join(steps)
    return f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, lang, source, coalesce(octet_length(encode(text)), 0) + 1 AS size, {crc_sql("coalesce(text, '')")} AS text_crc32 FROM documents, crc_list),
{codes},
s0 AS (SELECT d.*, {', '.join(f'c{i}.x{i}::BIGINT AS x{i}' for i in range(n))} FROM d {joins}),
{chain},
h AS (SELECT doc_id, size, text_crc32, ({bit})::BIGINT AS curve FROM t),
r AS (SELECT *, sum(size) OVER (ORDER BY curve, doc_id, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM h),
p AS (SELECT *, (((2 * upto - size) * 16) // (2 * total))::INTEGER AS shard FROM r)
SELECT doc_id, size, text_crc32, curve, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot, NULL::INTEGER AS grown_shard FROM p
"""


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def near_duplicates_sql(size: int = 2, percent: int = 80) -> str:
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, {WORDS.format(lowered)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: {shingle})) END AS g FROM t),
c AS (SELECT list_sort(g) AS g, min(doc_id) AS id, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY 1, 3),
e AS (SELECT id, n, unnest(g) AS x FROM c),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS k, any_value(a.n + b.n) AS n FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * k >= {percent} * (n - k)),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id AS a, id AS b FROM c UNION SELECT reach.a, two_way.b FROM reach JOIN two_way ON reach.b = two_way.a),
label AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY 1)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(label.component, s.doc_id) AS component_id, coalesce(label.component, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON list_sort(s.g) = c.g LEFT JOIN label ON label.id = c.id
"""


def jaccard_join_sql(size: int, percent: int) -> str:
    return f"SELECT doc_id, n_shingles, component_id FROM ({near_duplicates_sql(size, percent)})"


def mixing_sql(block: int = 128, shards: int = 16, share: float = 1.5, most: float = 2.0, seed: int = 1) -> str:
    def number(*parts: str) -> str:
        return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 12))::BIGINT"

    rounds, last = [], "z0"
    for r in range(1, mixing.ROUNDS + 1):
        key = f"'{seed}', no::VARCHAR, pass, '{r}'"
        pivot = f"(({number(chr(39) + 'p' + chr(39), key)} % blocks - x) % blocks + blocks) % blocks"
        rounds.append(f"m{r} AS (SELECT *, {pivot} AS y FROM {last})")
        swap = number("'s'", key, "greatest(x, y)::VARCHAR")
        rounds.append(f"z{r} AS (SELECT no, blocks, pass, CASE WHEN {swap} % 2 = 1 THEN y ELSE x END AS x FROM m{r})")
        last = f"z{r}"
    weight = f"[{', '.join(str(w) for w in mixing.WEIGHTS)}][(no % {len(mixing.WEIGHTS)}) + 1]"
    chain = ",\n".join(rounds)
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(len({WORDS.format('text')}), 0) AS size, md5('{seed}:' || doc_id::VARCHAR) AS o FROM documents),
f AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY 1),
w AS (SELECT *, {weight} AS w, {share} * sum(n) OVER () AS budget, {most} * n / {weight} AS ratio FROM f),
l AS (SELECT *, coalesce(sum({most} * n) OVER o, 0) AS capped, (budget - coalesce(sum({most} * n) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM w WHERE n > 0 WINDOW o AS (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT first(level ORDER BY ratio, no) FILTER (WHERE level <= ratio) AS least FROM l),
q AS (SELECT f.source, f.no, f.n, CASE WHEN f.n = 0 THEN 0.0 ELSE least({most} * f.n, v.least * w.w) END::DOUBLE AS target, (f.n + {block - 1}) // {block} AS blocks FROM f JOIN w USING (no), v),
b AS (SELECT *, CASE WHEN n > 0 THEN floor(target * blocks / n + 0.5)::BIGINT ELSE 0 END AS slots FROM q),
j AS (SELECT no, blocks, unnest(range(slots)) AS slot FROM b),
z0 AS (SELECT no, blocks, (slot // blocks)::VARCHAR AS pass, slot % blocks AS x FROM j),
{chain},
reads AS (SELECT no, x AS block_no, count(*) AS reads FROM {last} GROUP BY 1, 2),
i AS (SELECT doc_id, size, no, n, target, (sum(size) OVER (PARTITION BY no ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
x AS (SELECT *, unnest(range((upto - size) // {block}, CASE WHEN size > 0 THEN (upto - 1) // {block} + 1 ELSE (upto - size) // {block} END)) AS block_no FROM i),
y AS (SELECT doc_id, no, sum((least(upto, (block_no + 1) * {block}) - greatest(upto - size, block_no * {block})) * coalesce(reads, 0)) AS taken FROM x LEFT JOIN reads USING (no, block_no) GROUP BY 1, 2)
SELECT i.doc_id, i.size, i.n AS source_size, i.target, coalesce(y.taken, 0)::BIGINT AS taken FROM i LEFT JOIN y ON i.doc_id = y.doc_id AND i.no = y.no
"""


ARCHIVES_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
o AS (SELECT row_no, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM o GROUP BY 1, 2 HAVING count(DISTINCT row_no) >= 10),
s AS (SELECT lang, count(*)::HUGEINT AS kept, sum(n)::HUGEINT AS total FROM k GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * s.kept) AS p,
  1 + (1000000000 * (k.n + 2)) // (s.total + 2 * s.kept) AS q
  FROM g JOIN k USING (lang) JOIN s USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
