"""DuckDB SQL for the operators that it can state."""

from __future__ import annotations

from collections.abc import Sequence

from reportlake.llm.filter_audit import CAPITAL_SHARE, DISTINCT_SHARE, MIN_WORDS
from reportlake.llm.merkle import FAN, FIELDS


def _crc32(value: str) -> str:
    """Unsigned crc32 of a short ASCII text, a bit at a time."""
    byte = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    codes = f"list_transform(string_split({value}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _encoded(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def _leaf(columns: Sequence[str]) -> str:
    return f"sha256({' || '.join(_encoded(c) for c in columns)})"


def _tree(name: str, base: str) -> str:
    """CTEs {name} (g, lvl, pos, node, n) and {name}_beside (g, lvl, pos, l, r) over the rows of ``base`` (g, pos, node, n)."""
    return f"""
{name} AS (
  SELECT g, 0::BIGINT AS lvl, pos, node, n FROM {base}
  UNION ALL
  SELECT g, lvl + 1, pos // {FAN}, sha256(string_agg(node, '' ORDER BY pos)), (n + {FAN - 1}) // {FAN}
  FROM {name} WHERE n > 1 GROUP BY g, lvl, pos // {FAN}, n),
{name}_beside AS (
  SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a LEFT JOIN {name} b ON a.g = b.g AND a.lvl = b.lvl AND a.pos // {FAN} = b.pos // {FAN} AND a.pos <> b.pos
  WHERE a.n > 1 GROUP BY a.g, a.lvl, a.pos)"""


_TAMPERED = "CASE WHEN even THEN replace(text, chr(10), '') ELSE text END"
_POWER = f"({FAN} ** {{}}.lvl)::BIGINT"

MERKLE = f"""
WITH RECURSIVE marked AS (
  SELECT *, coalesce({_crc32("doc_id::VARCHAR")} % 2 = 0, false) AS even FROM documents),
rows_ AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {_leaf(FIELDS)} AS leaf,
         {_leaf([f'({_TAMPERED})' if f == 'text' else f for f in FIELDS])} AS altered FROM marked),
placed AS (
  SELECT *, leaf AS node, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n FROM rows_),
{_tree("tree", "placed")},
subroots AS (
  SELECT '' AS g, t.g AS name, t.node, row_number() OVER (ORDER BY t.g) - 1 AS pos, count(*) OVER () AS n FROM tree t WHERE t.n = 1),
{_tree("upper_", "subroots")},
upper_paths AS (
  SELECT s.name, s.node AS subroot, list({{'l': u.l, 'r': u.r}} ORDER BY u.lvl) FILTER (u.lvl IS NOT NULL) AS above
  FROM subroots s LEFT JOIN upper_beside u ON u.pos = s.pos // {_POWER.format('u')} GROUP BY ALL),
paths AS (
  SELECT p.doc_id, p.g, p.pos, p.leaf, p.altered, list({{'l': b.l, 'r': b.r}} ORDER BY b.lvl) FILTER (b.lvl IS NOT NULL) AS path
  FROM placed p LEFT JOIN tree_beside b ON b.g = p.g AND b.pos = p.pos // {_POWER.format('b')} GROUP BY ALL),
whole AS (
  SELECT p.doc_id, p.leaf, u.subroot, (SELECT node FROM upper_ WHERE n = 1) AS root, p.altered,
         list_concat(coalesce(p.path, []), coalesce(u.above, [])) AS path
  FROM paths p JOIN upper_paths u ON u.name = p.g),
folded AS (
  SELECT *, list_reduce(list_prepend({{'l': '', 'r': altered}}, path),
                        lambda a, s: {{'l': '', 'r': sha256(s.l || a.r || s.r)}}).r AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda s: s.l || s.r), ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
""".replace("upper_beside", "upper__beside")


AUDIT = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
tested AS (
  SELECT doc_id, part,
         (len(words) < {MIN_WORDS})::INT AS a,
         (100 * len(list_distinct(words)) < {DISTINCT_SHARE} * len(words))::INT AS b,
         (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_SHARE} * len(text))::INT AS c,
         regexp_matches(text, '[#$%&*|]')::INT AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS e FROM texts),
marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM tested LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
steps AS (
  SELECT filter_order, step, l.bit, (SELECT sum(m.bit) FROM letters m WHERE contains(left(filter_order, (step - 1)::INT), m.x)) AS earlier
  FROM orders, range(1, 6) s(step) JOIN letters l ON l.x = substr(filter_order, step, 1)),
audit AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (bit | coalesce(earlier, 0)) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & coalesce(earlier, 0) = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & coalesce(earlier, 0) > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit > 0 AND mask & coalesce(earlier, 0) = 0), 0) AS good_lost,
         coalesce(sum(bad) FILTER (mask & bit > 0 AND mask & coalesce(earlier, 0) = 0), 0) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM audit
"""
