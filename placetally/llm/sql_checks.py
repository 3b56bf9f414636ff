"""SQL of the operators that need more than a few lines of it."""

# CRC-32 by bytes: the table of 256 registers, and a string's bytes folded over it.
CRC_TABLE = """
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) AS r(i))
"""


def crc32(text: str) -> str:
    """CRC-32 of a VARCHAR expression where a column ``t`` has the table."""
    byte = (
        f"16 * (strpos('0123456789ABCDEF', substr(hex(encode({text})), 2 * i + 1, 1)) - 1)"
        f" + strpos('0123456789ABCDEF', substr(hex(encode({text})), 2 * i + 2, 1)) - 1"
    )
    return (
        "xor(list_reduce(list_concat([4294967295::BIGINT],"
        f" list_transform(range(0, octet_length(encode({text}))), lambda i: ({byte})::BIGINT)),"
        " lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT)"
    )


def _words(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (
        f"SELECT {key}, list_filter(string_split_regex({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words"
        f" FROM {table}"
    )


OP12 = f"""
WITH crc AS MATERIALIZED ({CRC_TABLE}),
d AS MATERIALIZED ({_words("documents", "doc_id")}),
b AS MATERIALIZED ({_words("benchmark", "item_id")}),
f AS MATERIALIZED (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) GROUP BY ALL),
g AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY ALL),
k AS MATERIALIZED (
  SELECT word, {crc32("word")} % 10000 AS bucket
  FROM (SELECT word FROM f UNION SELECT word FROM g), crc
), s AS (SELECT bucket, sum(n) AS s FROM f JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM g JOIN k USING (word) GROUP BY bucket),
gain AS MATERIALIZED (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM f) + 10000)::DOUBLE
    / ((s.s + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM g) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), w AS (
  SELECT doc_id, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM f JOIN k USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), h AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    list_reduce(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr(sha256('2024:' || doc_id), i, 1)) - 1)::BIGINT),
      lambda a, b: a * 16 + b) AS h
  FROM d LEFT JOIN w USING (doc_id)
), p AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM p WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * many // 100 THEN place END AS rank FROM p LEFT JOIN r USING (doc_id)
"""


def _levels(of: str, levels: int) -> str:
    """Tables l0 (from ``of``: tree, at, digest) to the last, where a tree with one node left stays as it is."""
    steps = [f"{of}0 AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS many FROM {of})"]
    for k in range(levels):
        steps.append(f"""{of}{k + 1} AS MATERIALIZED (
  SELECT tree, place // 16 AS place, CASE WHEN any_value(many) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest,
    (any_value(many) + 15) // 16 AS many FROM {of}{k} GROUP BY tree, place // 16)""")
    return ",\n".join(steps)


def _runs(of: str, levels: int) -> str:
    """The digests of each run of siblings; none once a tree has one node."""
    return ",\n".join(
        f"{of}r{k} AS MATERIALIZED (SELECT tree, place // 16 AS run, list(digest ORDER BY place) AS nodes"
        f" FROM {of}{k} WHERE many > 1 GROUP BY tree, place // 16)" for k in range(levels)
    )


def _climb(of: str, levels: int, start: str) -> tuple[str, str]:
    """Tables that climb with each leaf: its place, the folded digest and the siblings so far."""
    steps, before = [], start
    for k in range(levels):
        name = f"{of}c{k}"
        own = "place % 16 + 1"
        left, right = f"array_to_string(nodes[:{own} - 1], '')", f"array_to_string(nodes[{own} + 1:], '')"
        steps.append(f"""{name} AS MATERIALIZED (
  SELECT c.* EXCLUDE (place, cur, proof), c.place // 16 AS place,
    CASE WHEN nodes IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
    CASE WHEN nodes IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
  FROM {before} c LEFT JOIN {of}r{k} r ON r.tree = c.tree AND r.run = c.place // 16)""")
        before = name
    return ",\n".join(steps), before


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# Levels that are enough for 16^6 documents of a source and as many sources.
LEVELS = 6
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_C1, _LAST1 = _climb("a", LEVELS, "start")
_C2, _LAST2 = _climb("z", LEVELS, "middle")
OP11 = f"""
WITH crc AS MATERIALIZED ({CRC_TABLE}),
d AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_leaf("text")} AS digest,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf("text")} END AS shown,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place
  FROM documents, crc
), a AS (SELECT tree, place, digest FROM d),
{_levels("a", LEVELS)},
{_runs("a", LEVELS)},
z AS MATERIALIZED (SELECT 1 AS tree, row_number() OVER (ORDER BY a{LEVELS}.tree) - 1 AS place, digest, a{LEVELS}.tree AS of FROM a{LEVELS}),
{_levels("z", LEVELS)},
{_runs("z", LEVELS)},
start AS (SELECT doc_id, tree, digest AS leaf, place, shown AS cur, '' AS proof FROM d),
{_C1},
middle AS (
  SELECT c.doc_id, c.leaf, 1 AS tree, z.place, z.digest AS subroot, c.cur, c.proof FROM {_LAST1} c JOIN z ON z.of = c.tree
),
{_C2}
SELECT doc_id, leaf, subroot, (SELECT any_value(digest) FROM z{LEVELS}) AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
  cur = (SELECT any_value(digest) FROM z{LEVELS}) AS verified
FROM {_LAST2}
"""
