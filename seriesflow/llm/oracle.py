"""The operators' results as DuckDB SQL over the same tables, where SQL can express them."""

from __future__ import annotations

from seriesflow.llm import apportion, secrets
from seriesflow.llm.queries import URL_RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT item_id, w, least(len(w), 10) AS n,
                 unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
windows AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM windows JOIN grams USING (n, gram)),
counts AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counts USING (r) LEFT JOIN items USING (r)"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _found() -> str:
    """Positions of every match of every kind, as ``(r, k, start, stop)``."""
    parts = []
    for k, (kind, pattern) in enumerate(secrets.PATTERNS.items()):
        p = _text(pattern)
        value = f"regexp_extract_all(t, {p}, 2)" if kind == "assign" else f"regexp_extract_all(t, {p})"
        passes = {
            "assign": "length(v) >= 8",
            "key": "regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')",
        }.get(kind, "true")
        parts.append(f"""
    SELECT r, {k} AS k, stop - length(m) AS start, stop FROM (
        SELECT *, sum(length(m) + length(gap)) OVER (PARTITION BY r ORDER BY i) AS stop FROM (
            SELECT r, unnest(generate_series(1, len(ms))) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(gaps[:len(ms)]) AS gap
            FROM (SELECT r, regexp_extract_all(t, {p}) AS ms, {value} AS vs, string_split_regex(t, {p}) AS gaps FROM d)))
    WHERE {passes}""")
    return " UNION ALL ".join(parts)


_NAMES = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
_LISTED = f"string_agg({_NAMES}[k + 1] || ':' || start || ':' || stop, ',' ORDER BY start, k)"

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT r, k, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM ({_found()})),
linked AS (
    SELECT a.r, a.k, a.start, a.stop FROM s a JOIN s b
      ON a.r = b.r AND b.start < a.stop + {secrets.REACH} AND b.stop > a.start - {secrets.REACH}
    WHERE a.k >= 3 GROUP BY ALL
    HAVING NOT bool_or(b.k < 3 AND b.start < a.stop AND b.stop > a.start)
       AND CASE a.k
           WHEN 3 THEN bool_or(b.k IN (0, 2, 4) AND (b.start >= a.stop OR b.stop <= a.start))
           WHEN 4 THEN bool_or(b.k IN (1, 3) AND (b.start >= a.stop OR b.stop <= a.start))
           ELSE bool_or(b.k IN (0, 2, 4) AND (b.start >= a.stop OR b.stop <= a.start))
            AND bool_or(b.k IN (1, 3) AND (b.start >= a.stop OR b.stop <= a.start)) END),
kept AS (SELECT * FROM s WHERE k < 3 UNION ALL SELECT * FROM linked),
g AS (SELECT r, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
             count(*) FILTER (WHERE k = 2) AS n_hex, {_LISTED} FILTER (WHERE k < 3) AS base,
             {_LISTED} AS spans FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)"""

URLS = f"""
WITH rules(rh, rp, rv) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
p AS (SELECT row_number() OVER () AS r, page_id,
             {_LOWER.format(r"coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), '')")} AS host,
             coalesce(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
best AS (SELECT r, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
         FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM p LEFT JOIN best USING (r)"""

CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(role) + length(regexp_replace(role, '[^\\#:]', '', 'g'))
                + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 14 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


_LOT = "CAST('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), 1, 15) AS BIGINT)"
_QUOTA = """{name}_w AS (SELECT *, sum(CAST(w AS DOUBLE)) OVER g AS w_all, count(*) OVER g AS w_cells FROM {name} WHERE w > 0
                     WINDOW g AS (PARTITION BY grp)),
{name}_b AS (SELECT *, CASE WHEN 2 * n > w_cells THEN greatest(0, CAST(floor(w * (n - w_cells / 2) / w_all + 0.5) AS BIGINT) - 1) ELSE 0 END AS base,
                    CAST(floor(w * (n + w_cells / 2) / w_all + 0.5) AS BIGINT) + 1 AS top FROM {name}_w),
{name}_o AS (SELECT *, n - sum(base) OVER (PARTITION BY grp) AS open FROM {name}_b),
{name}_k AS (SELECT *, unnest(range(base, top + 1)) AS k FROM {name}_o),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY w / (2 * k + 1) DESC, rank, shard, k) <= open AS won FROM {name}_k),
{name}_q AS (SELECT rank, shard, CAST(any_value(base) + count(*) FILTER (WHERE won) AS BIGINT) AS quota FROM {name}_r GROUP BY rank, shard)"""

_STEP = " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(apportion.STEPS))
MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(length(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS BIGINT) AS rank FROM s),
v AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM r),
f AS (SELECT *, CAST(sum(weight) OVER () AS BIGINT) AS weights, CAST(coalesce(sum(cap) OVER o, 0) AS BIGINT) AS filled,
             CAST(coalesce(sum(weight) OVER o, 0) AS BIGINT) AS spent FROM v
      WINDOW o AS (ORDER BY cap * (10 // weight), rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT *, cap * (weights - spent) <= weight * (total - filled) AS held FROM f),
l AS (SELECT *, total - coalesce(sum(cap) FILTER (WHERE held) OVER (), 0) AS rest, coalesce(sum(weight) FILTER (WHERE NOT held) OVER (), 0) AS sharing FROM h),
t AS (SELECT source, source_size, rank, total,
             CASE WHEN held THEN CAST(cap AS DOUBLE) ELSE CAST(weight * rest AS DOUBLE) / nullif(CAST(sharing AS DOUBLE), 0) END AS target,
             CASE WHEN total > 0 THEN greatest(1, CAST(floor(total / {apportion.BLOCK} + 0.5) AS BIGINT)) ELSE 0 END AS n,
             greatest(1, CAST(ceil(source_size / greatest({apportion.SHARD_WORDS}, CAST(ceil(total / {apportion.MOST_SHARDS}) AS BIGINT))) AS BIGINT)) AS shards
      FROM l),
a AS (SELECT 0 AS grp, rank, 0 AS shard, target AS w, n FROM t),
{_QUOTA.format(name="a")},
p AS (SELECT doc_id, d.source, size, source_size, target, rank, {_LOT.format(seed=apportion.SEED, parts="coalesce(CAST(doc_id AS VARCHAR), '')")} AS place, shards
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, place % shards AS shard FROM p),
c AS (SELECT rank AS grp, rank, e.shard, CAST(sum(size) AS BIGINT) AS w, any_value(quota) AS n FROM e JOIN a_q USING (rank) GROUP BY rank, e.shard),
{_QUOTA.format(name="c")},
z AS (SELECT c.rank, c.shard, w AS shard_size, greatest(1, CAST(floor(w / {apportion.BLOCK} + 0.5) AS BIGINT)) AS blocks, coalesce(c_q.quota, 0) AS quota,
             {_LOT.format(seed=apportion.SEED, parts="c.rank, c.shard")} AS lot
      FROM c LEFT JOIN c_q ON c.rank = c_q.rank AND c.shard = c_q.shard),
y AS (SELECT *, least(quota, 3 * blocks) // blocks AS passes, least(quota, 3 * blocks) % blocks AS left_over, lot % blocks AS shift,
             CASE lot % {len(apportion.STEPS)} {_STEP} END AS step FROM z),
x AS (SELECT row_number() OVER () AS id, *, CAST(sum(size) OVER (PARTITION BY rank, shard ORDER BY place, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop FROM e),
m AS (SELECT *, stop - size AS start FROM x LEFT JOIN y USING (rank, shard)),
j AS (SELECT *, unnest(range(((start + 1) * blocks - 1) // shard_size, (stop * blocks - 1) // shard_size + 1)) AS j FROM m WHERE size > 0 AND left_over > 0),
g AS (SELECT id, sum(least(stop, (j + 1) * shard_size // blocks) - greatest(start, j * shard_size // blocks)) AS part
      FROM j WHERE (step * j + shift) % blocks < left_over GROUP BY id)
SELECT doc_id, size, source_size, target, CAST(coalesce(passes, 0) * size + coalesce(part, 0) AS BIGINT) AS taken
FROM m LEFT JOIN g USING (id)"""


def statements() -> dict[str, str]:
    return {
        "op2_decontamination": DECONTAMINATION.strip(),
        "op5_secrets": SECRETS.strip(),
        "op8_url_rules": URLS.strip(),
        "op9_chat": CHAT.strip(),
        "op13_mixing": MIXING.strip(),
    }
