"""SQL of the operators that SQL can express, for the checking database."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


# crc32 of decimal text, bit by bit: 0xEDB88320 reflected, start and end inverted.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
        lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(name: str, start: str) -> str:
    """Every node of the trees above ``start`` (g, pos, digest, n), eight to one until one is left."""
    return f"""{name} AS (
    SELECT 0 AS level, g, pos, digest, n FROM {start}
    UNION ALL
    SELECT level + 1, g, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
    FROM {name} WHERE n > 1 GROUP BY level, g, pos // 8, n)"""


def _sides(tree: str, start: str, offset: str) -> str:
    """Siblings of every node of ``start`` at every level, numbered from ``offset``."""
    own = "(a.pos // CAST(pow(8, b.level) AS BIGINT))"
    return f"""SELECT a.id, b.level + {offset} AS level,
        coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < {own}), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > {own}), '') AS r
    FROM {start} a JOIN {tree} b ON a.g IS NOT DISTINCT FROM b.g AND b.n > 1 AND b.pos // 8 = {own} // 8
    GROUP BY a.id, b.level"""


OP11_SQL = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, lang AS g, {_leaf('text')} AS digest,
           CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(plain('text'))} END AS changed FROM documents),
leaves AS (SELECT *, row_number() OVER (ORDER BY g, doc_id, digest) AS id, count(*) OVER (PARTITION BY g) AS n,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM hashed),
{_tree('low', 'leaves')},
tops AS (SELECT g AS lang, CAST(1 AS INTEGER) AS g, digest, count(*) OVER () AS n,
    row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, row_number() OVER (ORDER BY g NULLS FIRST) AS id
    FROM low WHERE n = 1),
{_tree('high', 'tops')},
whole AS (SELECT digest AS root FROM high WHERE n = 1),
upper_sides AS ({_sides('high', 'tops', '100')}),
sides AS ({_sides('low', 'leaves', '0')}
    UNION ALL SELECT a.id, u.level, u.l, u.r FROM leaves a JOIN tops t ON a.g IS NOT DISTINCT FROM t.lang
    JOIN upper_sides u ON u.id = t.id),
steps AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level) AS step FROM sides),
fold AS (
    SELECT id, CAST(0 AS BIGINT) AS step, coalesce(changed, digest) AS digest FROM leaves
    UNION ALL
    SELECT f.id, s.step, sha256(s.l || f.digest || s.r) FROM fold f JOIN steps s ON s.id = f.id AND s.step = f.step + 1),
ends AS (SELECT id, arg_max(digest, step) AS folded_root FROM fold GROUP BY id),
proofs AS (SELECT id, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY id)
SELECT doc_id, a.g AS lang, changed IS NOT NULL AS tampered, a.digest AS leaf, t.digest AS subroot, root,
       sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves a JOIN tops t ON a.g IS NOT DISTINCT FROM t.lang CROSS JOIN whole
    JOIN ends ON ends.id = a.id LEFT JOIN proofs ON proofs.id = a.id
"""


def _share(count: str, total: str, kept: str) -> str:
    return f"CAST(1 + CAST(1000000000 AS HUGEINT) * ({count} + 5) // ({total} + 5 * {kept}) AS BIGINT)"


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        {plain("coalesce(text, '')")} AS text FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM c SEMI JOIN
    (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT i) >= 30) USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS in_lang FROM g JOIN kept k ON k.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY ALL),
p AS (SELECT grid.lang, grid.source, term, n, {_share('n', 't.total', 'v')} AS p, {_share('in_lang', 'l.total', 'v')} AS q
    FROM grid JOIN t ON t.lang = grid.lang AND t.source = grid.source JOIN l ON l.lang = grid.lang),
apart AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= 50
"""
