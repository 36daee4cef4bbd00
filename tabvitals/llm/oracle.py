"""The queries that SQL can express, in DuckDB."""

import hashlib


def _turns(names: list[str], size: int) -> list[int]:
    """The table of slots, by asking each shard in turn for its next free preference."""

    def preferences(name):
        digest = hashlib.md5(name.encode()).hexdigest()
        first, step = int(digest[:15], 16) % size, int(digest[16:31], 16) % (size - 1) + 1
        return ((first + j * step) % size for j in range(size))

    orders = [preferences(name) for name in names]
    owner: dict[int, int] = {}
    while len(owner) < size:
        for shard, order in enumerate(orders):
            slot = next((s for s in order if s not in owner), None)
            if slot is not None:
                owner[slot] = shard
    return [owner[s] for s in range(size)]


_SLOTS = _turns([f"shard-{i:02d}" for i in range(64)], 65537)

OP4 = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
),
d AS (
  SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest
  FROM p
),
o AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS owner FROM d
)
SELECT page_id, url, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND owner > page_id THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 1000 AND owner > page_id THEN owner END AS refers_to,
  greatest(1, CAST(ceil(payload_bytes / 1048576) AS BIGINT)) AS n_chunks
FROM o
"""

def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in words)


_ASSIGN = (
    f"({_either_case('password|passwd|secret|token|api_?key')})"
    r"""["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)"""
)
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Candidates by place in the list of kinds: pattern, what they must hold, what they must not be.
_SEGMENT = "([A-Za-z]+[0-9]{0,4}|[0-9]{0,8})"
_UUID = "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_CANDIDATES = [
    (3, "[A-Za-z0-9]{20,}", "", "^([A-Za-z]+[0-9]{0,4}|[0-9]+)$"),
    (6, "[A-Za-z0-9+/_=-]{20,}", "[-+/_=]", f"^({_SEGMENT}([-_/=+]{_SEGMENT})*|{_UUID})$"),
]
#: Spans that are no secrets: placeholders, sequences, repeated letters.
_PASSED_OVER = "|".join(
    [
        _either_case("example|sample|dummy|placeholder|changeme|xxxx|abcdefgh"),
        f"{_either_case('your')}[-_]?({_either_case('key|token|secret')})|0123456789",
        *[f"[{c}{c.upper()}]{{8}}" if c.isalnum() else f"[{c}]{{8}}" for c in _LETTERS[26:]],
    ]
)


def _found(kind: int, pattern: str, group: int) -> str:
    return (
        f"SELECT r, {kind} AS kind, string_split_regex(t, '{pattern}') AS gaps, "
        f"regexp_extract_all(t, '{pattern}') AS hits, "
        f"regexp_extract_all(t, '{pattern}', {group}) AS parts FROM d"
    )


OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  {_found(0, _ASSIGN, 2)} UNION ALL {_found(1, "AKIA[A-Z0-9]+", 0)}
  UNION ALL {_found(2, "[0-9a-f]{24,}", 0)}
  UNION ALL {" UNION ALL ".join(_found(k, pattern, 0) for k, pattern, _, _ in _CANDIDATES)}
),
p AS (
  SELECT r, kind, unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
    'at': CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS BIGINT),
    'hit': hits[i], 'part': parts[i]}})) AS x
  FROM m
),
s AS (SELECT r, kind, x.at AS a, x.at + length(x.hit) AS z, x.hit AS hit, x.part AS part FROM p),
base AS (SELECT r, kind, a, z FROM s WHERE kind < 3 AND length(part) >= [6, 20, 24][kind + 1]),
c AS (
  SELECT r, a, hit, CASE WHEN kind = 6 THEN 6 WHEN regexp_matches(hit, '^[0-9a-fA-F]+$') THEN 3
    WHEN regexp_matches(hit, '^([0-9A-Z]+|[0-9a-z]+)$') THEN 4 ELSE 5 END AS kind
  FROM s WHERE {" OR ".join(
    f"kind = {k} AND regexp_matches(hit, '{needed}') AND NOT regexp_matches(hit, '{names}')"
    for k, _, needed, names in _CANDIDATES)}
),
w AS (SELECT *, unnest(range(length(hit) - 19)) AS i FROM c),
e AS (
  SELECT *, string_split(substr(hit, CAST(i AS INTEGER) + 1, 20), '') AS letters FROM w
),
h AS (
  SELECT r, a, hit, kind, i, -list_sum(list_transform(list_distinct(letters), lambda l:
    len(list_filter(letters, lambda y: y = l)) / 20
    * log2(len(list_filter(letters, lambda y: y = l)) / 20))) AS bits FROM e
),
reached AS (
  SELECT r, kind, a + min(i) AS a, a + max(i) + 20 AS z,
    substr(hit, CAST(min(i) AS INTEGER) + 1, CAST(max(i) - min(i) + 20 AS INTEGER)) AS span
  FROM h WHERE bits >= [2.8, 3.27, 3.55, 3.65][kind - 2] GROUP BY r, h.a, hit, kind
),
outer_spans AS (
  SELECT r, kind, a, z FROM reached x WHERE NOT regexp_matches(span, '{_PASSED_OVER}')
    AND (kind < 6 OR regexp_matches(span, '[a-z]') AND regexp_matches(span, '[A-Z]')
      AND regexp_matches(span, '[0-9]'))
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = x.r AND b.a <= x.a AND x.z <= b.z)
),
added AS (
  SELECT r, kind, a, z FROM outer_spans x WHERE kind = 6 OR NOT EXISTS (
    SELECT 1 FROM outer_spans j WHERE j.kind = 6 AND j.r = x.r AND j.a <= x.a AND x.z <= j.z)
),
everything AS (SELECT * FROM base UNION ALL SELECT * FROM added),
lists AS (
  SELECT r, CAST(count_if(kind = 0) AS BIGINT) AS n_assign,
    CAST(count_if(kind = 1) AS BIGINT) AS n_access,
    CAST(count_if(kind = 2) AS BIGINT) AS n_hex,
    string_agg(['assign', 'access', 'hex', 'entropy_hex', 'entropy_single', 'entropy_mixed',
      'entropy_joined'][kind + 1]
      || ':' || a || ':' || z, ',' ORDER BY a, kind) AS spans,
    coalesce(string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || a || ':' || z, ','
      ORDER BY a, kind) FILTER (kind < 3), '') AS base
  FROM everything GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN lists USING (r)
"""

OP8 = f"""
WITH t AS (SELECT CAST([{",".join(map(str, _SLOTS))}] AS INTEGER[]) AS slots),
p AS (
  SELECT doc_id,
    CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
      % 65537 AS INTEGER) AS slot
  FROM documents
)
SELECT doc_id, slot, slots[slot + 1] AS shard,
  'shard-' || lpad(CAST(slots[slot + 1] AS VARCHAR), 2, '0') AS shard_name
FROM p, t
"""

OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS h
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

OP10 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS parts
  FROM documents
),
hosts AS (SELECT source, count(*) AS n FROM d GROUP BY source),
seen AS (
  SELECT r, source, unnest(list_distinct(list_transform(parts, lambda x: trim(x, ' ')))) AS line
  FROM d
),
bad AS (
  SELECT s.source, s.line
  FROM seen s JOIN hosts h ON s.source IS NOT DISTINCT FROM h.source
  WHERE s.line <> '' GROUP BY s.source, s.line, h.n
  HAVING count(*) >= 3 AND count(*) > CAST(0.1 AS DOUBLE) * h.n
),
lists AS (SELECT source, list(line) AS bad FROM bad GROUP BY source),
cut AS (
  SELECT d.*, CASE WHEN l.bad IS NULL THEN parts
    ELSE list_filter(parts, lambda x: NOT list_contains(l.bad, trim(x, ' '))) END AS rest
  FROM d LEFT JOIN lists l ON d.source IS NOT DISTINCT FROM l.source
)
SELECT doc_id, source, array_to_string(rest, chr(10)) AS text,
  CASE WHEN text IS NULL THEN 0 ELSE len(parts) END AS n_lines,
  CASE WHEN text IS NULL THEN 0 ELSE len(parts) - len(rest) END AS n_dropped
FROM cut
"""



def _crc_table() -> list[int]:
    """The checksum of each byte, by shifting it through the polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def _crc32(text: str) -> str:
    letters = (
        f"list_transform(range(octet_length(encode({text}))), lambda i: "
        f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
    )
    table = f"CAST([{','.join(map(str, _crc_table()))}] AS BIGINT[])"
    step = f"xor(c >> 8, {table}[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    start = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce(list_prepend({start}, {letters}), lambda c, b: {step}), {start})"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    parts = [
        f"coalesce(octet_length(encode(CAST({f} AS VARCHAR))) || ':' || CAST({f} AS VARCHAR), '-')"
        for f in fields
    ]
    return f"sha256({' || '.join(parts)})"


#: Levels written out, enough for 3 ** 9 documents of a source and 3 ** 5 sources.
_INNER, _OUTER = 9, 5


def _climb(name: str, levels: int, docs: str) -> str:
    """Nodes of each level, the siblings of each node, and the documents one level further up.

    Nodes are those of `{name}0` (tree, r, n, h); documents have tree, r, proof and folded.
    """
    out = []
    window = "OVER (PARTITION BY tree, r // 3 ORDER BY r ROWS BETWEEN"
    for k in range(levels):
        nodes = f"{name}{k}"
        out.append(
            f"{name}{k + 1} AS (SELECT tree, r // 3 AS r, (n + 2) // 3 AS n, "
            f"sha256(string_agg(h, '' ORDER BY r)) AS h FROM {nodes} WHERE n > 1 GROUP BY ALL "
            f"UNION ALL SELECT tree, r, n, h FROM {nodes} WHERE n = 1)"
        )
        before = docs if k == 0 else f"{name}_docs{k}"
        out.append(
            f"{name}_side{k} AS (SELECT tree, r, "
            f"coalesce(string_agg(h, '') {window} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lhs, "
            f"coalesce(string_agg(h, '') {window} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rhs "
            f"FROM {nodes} WHERE n > 1)"
        )
        out.append(
            f"{name}_docs{k + 1} AS (SELECT f.* REPLACE ("
            "CASE WHEN s.r IS NULL THEN f.r ELSE f.r // 3 END AS r, "
            "proof || coalesce(lhs || rhs, '') AS proof, "
            "CASE WHEN s.r IS NULL THEN folded ELSE sha256(lhs || folded || rhs) END AS folded) "
            f"FROM {before} f LEFT JOIN {name}_side{k} s ON f.tree = s.tree AND f.r = s.r)"
        )
    return ",\n".join(out)


_KEY = "coalesce(CAST(doc_id AS VARCHAR), '')"
OP13 = f"""
WITH d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_KEY} = '' OR {_crc32(_KEY)} % 2 = 0
      THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS folded
  FROM documents
),
docs AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY tree) AS n, '' AS proof
  FROM d
),
inner0 AS (SELECT tree, r, n, leaf AS h FROM docs),
{_climb("inner", _INNER, "docs")},
outer0 AS (
  SELECT 0 AS tree, tree AS r, count(*) OVER () AS n, h FROM inner{_INNER}
),
up AS (
  SELECT f.* REPLACE (0 AS tree, f.tree AS r), s.h AS subroot
  FROM inner_docs{_INNER} f JOIN inner{_INNER} s ON f.tree = s.tree
),
{_climb("outer", _OUTER, "up")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = root AS verified
FROM outer_docs{_OUTER}, (SELECT h AS root FROM outer{_OUTER})
"""

OP12 = f"""
WITH RECURSIVE runs AS (
  SELECT {_KEY} AS k, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
),
counted AS (SELECT k, run, count(*) AS n FROM runs GROUP BY k, run),
hashed AS (SELECT run, n, {_crc32("k || ':' || run")} AS h FROM counted),
thinned AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
    || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM hashed
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM thinned
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
parts AS (
  SELECT word, word AS part FROM words UNION
  SELECT word, unnest(list_transform(range(length(word)), lambda i:
    substr(word, 1, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2))) FROM words
),
pairs AS (
  SELECT DISTINCT a.word AS word, b.word AS near FROM parts a JOIN parts b USING (part)
  WHERE a.word <> b.word AND (length(a.word) <> length(b.word) OR list_sum(list_transform(
    range(length(a.word)), lambda i: CAST(substr(a.word, CAST(i AS INTEGER) + 1, 1)
      <> substr(b.word, CAST(i AS INTEGER) + 1, 1) AS INTEGER))) = 1)
    AND (length(a.word) = length(b.word)
      OR part = CASE WHEN length(a.word) < length(b.word) THEN a.word ELSE b.word END)
),
best AS (
  SELECT p.word, count(*) AS n_near, arg_min(near, (-w.n, near)) AS near, max(w.n) AS near_n
  FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word
),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
    CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
paths AS (
  SELECT word, word AS at FROM forms
  UNION SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.at WHERE f.form IS NOT NULL
),
roots AS (
  SELECT p.word, p.at AS root FROM paths p JOIN forms f ON f.word = p.at WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

ORACLE = {
    "op4_warc": OP4,
    "op7_secrets": OP7,
    "op8_sharding": OP8,
    "op9_near_duplicates": OP9,
    "op10_line_dedup": OP10,
    "op12_spelling": OP12,
    "op13_merkle": OP13,
}
