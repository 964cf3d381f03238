"""DuckDB SQL for the Merkle manifest: leaves, trees level by level, proofs, folds."""

from logengine.llm import merkle

#: Levels that the SQL writes out: trees of up to 16 ** LEVELS leaves a source.
LEVELS = 5
_FIELDS = ("doc_id", "source", "lang", "n_chars")


def crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; the row has ``crc_t``, the 256 steps of ``crc_table``."""
    hexed = f"hex(encode({text}))"
    codes = f"list_transform(range(0, length({hexed}) // 2), lambda k: CAST('0x' || substr({hexed}, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))"
    step = "xor(a >> 8, crc_t[CAST(xor(a, b) & 255 AS BIGINT) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {step}), 4294967295::BIGINT)"


_SHIFT = "list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))"
CRC_TABLE = f"crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: {_SHIFT}) crc_t)"


def _leaf(text: str) -> str:
    parts = [f"CAST({c} AS VARCHAR)" for c in _FIELDS] + [text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


def _tree(name: str, first: str, levels: int) -> list[str]:
    """CTEs of a tree's levels (s, i, c nodes in the group, h) and their nodes' siblings."""
    out = [f"{name}0 AS MATERIALIZED ({first})"]
    for k in range(levels):
        run = f"PARTITION BY s, i // {merkle.FANOUT} ORDER BY i ROWS BETWEEN"
        out += [
            f"{name}b{k} AS MATERIALIZED (SELECT s, i, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') b, "
            f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') a FROM {name}{k} WHERE c > 1)",
            f"{name}{k + 1} AS MATERIALIZED (SELECT s, i // {merkle.FANOUT} i, (any_value(c) + {merkle.FANOUT - 1}) // {merkle.FANOUT} c, "
            f"sha256(string_agg(h, '' ORDER BY i)) h FROM {name}{k} WHERE c > 1 GROUP BY s, i // {merkle.FANOUT} "
            f"UNION ALL SELECT s, i, c, h FROM {name}{k} WHERE c = 1)",
        ]
    return out


def _folds(rows: str, name: str, levels: int, at: str) -> list[str]:
    """CTEs that carry proof text and folded digest of every row through a tree's levels."""
    out, before = [], rows
    for k in range(levels):
        out.append(
            f"{name}f{k} AS (SELECT r.* EXCLUDE (proof, fold), proof || coalesce(b || a, '') proof, "
            f"CASE WHEN b IS NULL THEN fold ELSE sha256(b || fold || a) END fold FROM {before} r "
            f"LEFT JOIN {name}b{k} x ON r.{'s' if at == 'i' else 'top'} = x.s AND r.{at} // {merkle.FANOUT**k} = x.i)"
        )
        before = f"{name}f{k}"
    return out


OP11 = "WITH " + ",\n".join(
    [
        CRC_TABLE,
        f"d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END s, {_leaf('text')} leaf, "
        f"CASE WHEN coalesce({crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0, false) THEN "
        f"{_leaf(chr(39).join(['translate(text, ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ', ', 'abcdefghijklmnopqrstuvwxyz', ')']))} "
        "END claim FROM documents, crc_table)",
        "n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 i, "
        "count(*) OVER (PARTITION BY s) c FROM d)",
        *_tree("t", "SELECT s, i, c, leaf h FROM n", LEVELS),
        f"sub AS MATERIALIZED (SELECT s, h, row_number() OVER (ORDER BY encode(s)) - 1 j, count(*) OVER () c FROM t{LEVELS})",
        *_tree("u", "SELECT '' s, j i, c, h FROM sub", LEVELS),
        "r0 AS (SELECT doc_id, n.s, n.i, leaf, sub.h subroot, sub.j, '' top, '' proof, coalesce(claim, leaf) fold "
        "FROM n JOIN sub USING (s))",
        *_folds("r0", "t", LEVELS, "i"),
        *_folds(f"tf{LEVELS - 1}", "u", LEVELS, "j"),
    ]
) + (
    f"\nSELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, "
    f"fold = u.h AS verified FROM uf{LEVELS - 1} CROSS JOIN u{LEVELS} u"
)
