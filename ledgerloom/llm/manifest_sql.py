"""SQL that another engine must agree with: the manifest of ``documents``, tampered rows found."""

from __future__ import annotations


def _covered(n_chars: str) -> str:
    columns = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(" + " || ".join(
        f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')" for c in columns
    ) + ")"


#: The unsigned crc32 of a text of ASCII characters, byte by byte, with the table made by its rule.
_CRC_TABLE = (
    "(SELECT list(list_reduce(list_prepend(v, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: "
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) "
    "FROM range(256) t(v))"
)


def _crc(text: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
        "lambda ch: ascii(ch)::BIGINT)), lambda c, b: "
        "xor(c >> 8, k[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def _tree(name: str, leaves: str) -> str:
    """All nodes (g, i, n, h, level) above ``leaves`` (g, i, n, h)."""
    return f"""{name} AS (
  SELECT g, i, n, h, 0 AS level FROM {leaves}
  UNION ALL
  SELECT g, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)), level + 1
  FROM {name} WHERE n > 1 GROUP BY g, i // 2, level
)"""


def _fold(name: str, tree: str, start: str) -> str:
    """From ``start`` (id, g, i, n, acc, proof) to the end of its tree, a level per step."""
    return f"""{name} AS (
  SELECT id, g, i, n, acc, proof, 0 AS level FROM {start}
  UNION ALL
  SELECT f.id, f.g, f.i // 2, (f.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN acc WHEN f.i % 2 = 1 THEN s.h || acc ELSE acc || s.h END),
    proof || coalesce(s.h, ''), f.level + 1
  FROM {name} f LEFT JOIN {tree} s ON s.g = f.g AND s.level = f.level AND s.i = xor(f.i, 1)
  WHERE f.n > 1
)"""


MANIFEST_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS k),
own AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS g, {_covered("n_chars")} AS h,
    CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 AND n_chars IS NOT NULL
      THEN {_covered("(n_chars + 1)")} ELSE h END AS acc
  FROM documents CROSS JOIN crc
),
leaves AS (
  SELECT *, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n
  FROM own
),
{_tree("nodes", "leaves")},
subroots AS (
  SELECT '' AS g, g AS of, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
{_tree("upper", "subroots")},
{_fold("lower_part", "nodes", "leaves")},
ends AS (
  SELECT p.id, s.g, s.i, s.n, p.acc, p.proof FROM lower_part p JOIN subroots s ON s.of = p.g WHERE p.n = 1
),
{_fold("upper_part", "upper", "ends")}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(p.proof) AS proof_sha256,
  p.acc AS folded_root, p.acc = r.h AS verified
FROM leaves l JOIN upper_part p ON p.id = l.id AND p.n = 1
JOIN subroots s ON s.of = l.g CROSS JOIN (SELECT h FROM upper WHERE n = 1) r
"""
