"""SQL that learns and applies a few merges, one at a time, as the judge of the Spark jobs.

A word is written as ``|id||id|...``, so merging a pair everywhere is one replace.
"""

from __future__ import annotations

from textloom.functions.pretokens import SPECIAL_TOKENS, byte_ids
from textloom.operators.vocabulary import VOCAB_SIZE, base_tokens
from textloom.queries.base import N_MERGES, sql_lines, sql_pretokens, sql_strip

FIRST_MERGE = len(SPECIAL_TOKENS) + 256


def symbols(word: str) -> str:
    ids = ", ".join(map(str, byte_ids()))
    return (
        f"list_reduce(list_transform(regexp_extract_all(hex(encode({word})), '..'), "
        f"lambda h: '|' || list_extract([{ids}], CAST('0x' || h AS INTEGER) + 1) || '|'), lambda a, b: a || b)"
    )


WORD_COUNTS = f"""lines AS (
  SELECT unnest({sql_lines(sql_strip("text"))}) AS line FROM documents WHERE n_chars > 100),
words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (
    SELECT unnest({sql_pretokens(sql_strip("line"))}) AS word FROM lines) GROUP BY word)"""


def pair_table(words: str) -> str:
    """Pairs (l, r, n) of a (sym, n) table."""
    return f"""SELECT l, r, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CAST(unnest(s[:-2]) AS INTEGER) AS l, CAST(unnest(s[2:]) AS INTEGER) AS r FROM (
      SELECT n, string_split(trim(sym, '|'), '||') AS s FROM {words}) WHERE len(s) > 1) GROUP BY l, r"""


def training(n_merges: int = N_MERGES) -> str:
    """CTEs ``words``, ``p0`` ... ``p{n-1}`` (one row each: the merge with its id and count) and ``merges``."""
    parts = [WORD_COUNTS, f"w0 AS MATERIALIZED (SELECT {symbols('word')} AS sym, n FROM words)"]
    for i in range(n_merges):
        parts.append(
            f"p{i} AS MATERIALIZED (SELECT {i} AS rank, l, r, {FIRST_MERGE + i} AS id, n FROM "
            f"({pair_table(f'w{i}')}) WHERE n >= 2 ORDER BY n DESC, l, r LIMIT 1)"
        )
        parts.append(
            f"w{i + 1} AS MATERIALIZED (SELECT replace(sym, '|' || l || '||' || r || '|', '|' || id || '|') AS sym, "
            f"w.n FROM w{i} w, p{i})"
        )
    union = " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(n_merges))
    parts.append(f"merges AS ({union})")
    return ",\n".join(parts)


def token_texts(n_merges: int = N_MERGES) -> str:
    """CTEs that end in ``tokens(id, token)``: the base tokens, then each merge's joined text."""
    values = ", ".join("({}, '{}')".format(i, t.replace("'", "''")) for i, t in enumerate(base_tokens()))
    parts = [f"t0(id, token) AS (VALUES {values})"]
    for i in range(n_merges):
        parts.append(
            f"t{i + 1} AS MATERIALIZED (SELECT id, token FROM t{i} UNION ALL SELECT p.id, a.token || b.token "
            f"FROM p{i} p JOIN t{i} a ON a.id = p.l JOIN t{i} b ON b.id = p.r)"
        )
    parts.append(f"tokens AS (SELECT id, token FROM t{n_merges})")
    return ",\n".join(parts)


def encoding(texts: str, n_merges: int = N_MERGES) -> str:
    """CTEs that end in ``enc(k, ids)`` for a (k, text) table; ``ids`` is a list of integers."""
    parts = [
        training(n_merges),
        f"pt AS MATERIALIZED (SELECT k, {sql_pretokens('text')} AS words FROM {texts})",
        "tok AS MATERIALIZED (SELECT k, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM pt)",
        f"e0 AS MATERIALIZED (SELECT word, {symbols('word')} AS sym FROM (SELECT DISTINCT word FROM tok))",
    ]
    for i in range(n_merges):
        parts.append(
            f"e{i + 1} AS MATERIALIZED (SELECT word, replace(sym, '|' || l || '||' || r || '|', '|' || id || '|') "
            f"AS sym FROM e{i}, p{i})"
        )
    parts.append(
        f"""full_rows AS (
  SELECT k, string_agg(sym, '' ORDER BY pos) AS sym FROM tok JOIN e{n_merges} USING (word) GROUP BY k),
enc AS MATERIALIZED (
  SELECT t.k, CASE WHEN sym IS NULL THEN CAST([] AS INTEGER[])
    ELSE CAST(string_split(trim(sym, '|'), '||') AS INTEGER[]) END AS ids
  FROM {texts} t LEFT JOIN full_rows f ON f.k = t.k)"""
    )
    return ",\n".join(parts)


# The most pairs that one step of the whole training looks at; it only bounds how many are merged side by side.
STEP_PAIRS = 2_000


def whole_counts(texts: str, vocab_size: int = VOCAB_SIZE) -> str:
    """CTEs that end in ``enc(k, n_tokens)`` for a (k, text) table, by a vocabulary learned to its full size.

    To be put behind WITH RECURSIVE. A step merges the pairs that rank first, up to one that could meet another of
    them in a word or whose text is a token already: those before it are next to no other, the pairs they make
    rank after all of them, so they are the next merges in their order. The words of ``texts`` are merged in the
    same steps, with a count of 0 where training has them not.
    """
    values = ", ".join("('{1}', {0})".format(i, t.replace("'", "''")) for i, t in enumerate(base_tokens()))
    ids = ", ".join(map(str, byte_ids()))
    return f"""{WORD_COUNTS},
pt AS MATERIALIZED (SELECT k, {sql_pretokens('text')} AS words FROM {texts}),
seen AS MATERIALIZED (
  SELECT word, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT DISTINCT unnest(words) AS word FROM pt) FULL JOIN words USING (word)),
base(token, id) AS (VALUES {values}),
state(kind, key, sym, n) USING KEY (kind, key) AS (
  SELECT 0, word, list_transform(regexp_extract_all(hex(encode(word)), '..'),
    lambda h: list_extract([{ids}], CAST('0x' || h AS INTEGER) + 1)), n FROM seen
  UNION ALL SELECT 1, token, CAST([] AS INTEGER[]), id FROM base
  UNION (
    WITH w AS MATERIALIZED (SELECT key, sym, n FROM recurring.state WHERE kind = 0 AND len(sym) > 1),
    tokens AS MATERIALIZED (SELECT key AS token, n AS id FROM recurring.state WHERE kind = 1),
    size AS MATERIALIZED (SELECT count(*) AS n FROM tokens),
    places AS MATERIALIZED (SELECT key, n, unnest(sym) AS a, unnest(sym[2:]) AS b, generate_subscripts(sym, 1) AS pos FROM w),
    pairs AS (SELECT a, b, sum(n) AS c FROM places WHERE b IS NOT NULL GROUP BY a, b HAVING sum(n) >= 2),
    head AS MATERIALIZED (SELECT a, b, x.token || y.token AS token, row_number() OVER (ORDER BY c DESC, a, b) AS rk
      FROM (SELECT * FROM pairs ORDER BY c DESC, a, b LIMIT {STEP_PAIRS}) JOIN tokens x ON x.id = a JOIN tokens y ON y.id = b),
    stop AS (SELECT min(rk) AS rk FROM (
      SELECT h.rk FROM head h JOIN (SELECT b, min(rk) AS rk FROM head GROUP BY b) o ON h.a = o.b AND o.rk <= h.rk
      UNION ALL SELECT h.rk FROM head h JOIN (SELECT a, min(rk) AS rk FROM head GROUP BY a) o ON h.b = o.a AND o.rk <= h.rk
      UNION ALL SELECT h.rk FROM head h JOIN (SELECT token, min(rk) AS rk FROM head GROUP BY token) o ON h.token = o.token AND o.rk < h.rk
      UNION ALL SELECT h.rk FROM head h JOIN tokens USING (token))),
    chosen AS MATERIALIZED (
      SELECT a, b, token, CAST(coalesce(t.id, size.n + rk - 1) AS INTEGER) AS id
      FROM head JOIN size ON true LEFT JOIN tokens t USING (token)
      WHERE rk < greatest(2, coalesce((SELECT rk FROM stop), {STEP_PAIRS} + 1)) AND size.n + rk <= {vocab_size}),
    -- In a run of one symbol its pairs overlap: every other one is merged, from the left.
    met AS (SELECT key, pos, id, pos - row_number() OVER (PARTITION BY key ORDER BY pos) AS run FROM places JOIN chosen USING (a, b)),
    hits AS MATERIALIZED (SELECT key, pos, id FROM met QUALIFY row_number() OVER (PARTITION BY key, run ORDER BY pos) % 2 = 1),
    kept AS (SELECT p.key, p.n, p.pos, coalesce(h.id, p.a) AS id FROM places p LEFT JOIN hits h ON h.key = p.key AND h.pos = p.pos
      WHERE p.key IN (SELECT key FROM hits) AND (p.key, p.pos - 1) NOT IN (SELECT key, pos FROM hits))
    SELECT 0, key, list(id ORDER BY pos), any_value(n) FROM kept GROUP BY key
    UNION ALL SELECT 1, token, CAST([] AS INTEGER[]), id FROM chosen)),
enc AS MATERIALIZED (
  SELECT k, CAST(coalesce(sum(len(sym)), 0) AS BIGINT) AS n_tokens
  FROM (SELECT k, unnest(words) AS key FROM pt UNION ALL SELECT k, NULL FROM pt) LEFT JOIN (SELECT key, sym FROM state WHERE kind = 0) USING (key)
  GROUP BY k)"""
