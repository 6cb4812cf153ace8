"""DuckDB SQL for the queries of this subpackage that SQL can state."""

from __future__ import annotations

_OP11_ROUND = r"""
assigned{r} AS (
    SELECT vec_id, copy, label, part, v, entry, distance FROM (
        SELECT p.*, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance,
            row_number() OVER (PARTITION BY p.vec_id, p.copy, p.part ORDER BY
                list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.entry) AS place
        FROM parts p JOIN books{r} b ON b.part = p.part
    ) WHERE place = 1
),
"""

_OP11_MEANS = r"""
means{n} AS (
    SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
        SELECT part, entry, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM assigned{r}, range(1, len(v) + 1) AS t(i)
        GROUP BY part, entry, i
    ) GROUP BY part, entry
),
books{n} AS (
    SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM books{r} b LEFT JOIN means{n} m ON m.part = b.part AND m.entry = b.entry
),
"""

OP11 = r"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
        row_number() OVER (PARTITION BY vec_id) AS copy
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
    SELECT vec_id, copy, label, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v
    FROM kept, range(16) AS t(part)
),
first AS (SELECT vec_id, copy, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64),
books0 AS (SELECT part, entry, v FROM parts JOIN first USING (vec_id, copy)),
""" + "".join(_OP11_ROUND.format(r=r) + _OP11_MEANS.format(r=r, n=r + 1) for r in (0, 1)) + _OP11_ROUND.format(r=2) + r"""
coded AS (
    SELECT vec_id, copy, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
        sum(distance)::BIGINT AS error
    FROM assigned2 GROUP BY vec_id, copy, label
),
digest AS (
    SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
    FROM (SELECT part, entry, i, v[i] AS x FROM books2, range(1, len(v) + 1) AS t(i))
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""

OP12 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5('0:' || coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, '-'))) AS k
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::HUGEINT AS w
    FROM sized GROUP BY source
),
-- Sources in the order in which they reach twice their size as the share of one weight grows.
filled AS (
    SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER before, 0) AS rest, 2 * sum(w) OVER onward AS among
    FROM sources
    WINDOW before AS (ORDER BY source_size::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        onward AS (ORDER BY source_size::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
level AS (
    SELECT rest::HUGEINT AS rest, among::HUGEINT AS among FROM filled WHERE 2 * source_size * among >= rest * w
    ORDER BY source_size::DOUBLE / w, source LIMIT 1
),
goals AS (
    SELECT source, source_size,
        CASE WHEN 2 * source_size * among < w * rest THEN 2.0::DOUBLE * source_size
            ELSE w::DOUBLE * (50 * rest)::DOUBLE / (50 * among)::DOUBLE END AS target,
        CASE WHEN 2 * source_size * among < w * rest THEN 2 * source_size::HUGEINT ELSE w * rest // among END::BIGINT AS budget
    FROM sources, level
),
placed AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM sized
)
SELECT doc_id, size, source_size, target,
    (CASE WHEN source_size > 0 THEN budget // source_size * size + greatest(0, least(size, budget % source_size - start)) ELSE 0 END)::BIGINT AS taken
FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source
"""

OP13 = r"""
WITH RECURSIVE crc(i, k, c) AS (
    SELECT range, 0, range::BIGINT FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, lang, source, n_chars, text,
        xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS tampered
    FROM documents, crc_table
),
leaves AS (
    SELECT row_no, doc_id, lang, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
        CASE WHEN tampered THEN sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || z) END AS changed
    FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS a, coalesce(strlen(text) || ':' || text, '-') AS z FROM docs)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes(lang, level, place, digest) AS (
    SELECT lang, 0, place, leaf FROM placed
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM nodes) WHERE n > 1 GROUP BY lang, level, place // 2
),
subroots AS (SELECT lang, arg_max(digest, level) AS subroot, max(level) AS height FROM nodes GROUP BY lang),
ordered AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_no FROM subroots),
tops(level, place, digest) AS (
    SELECT 0, lang_no, subroot FROM ordered
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, place // 2
),
top AS (SELECT arg_max(digest, level) AS root, max(level) AS top_height FROM tops),
folded(row_no, step, digest, siblings) AS (
    SELECT row_no, 0, coalesce(changed, leaf), '' FROM placed
    UNION ALL
    SELECT f.row_no, step + 1,
        sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN s.place % 2 = 0 THEN s.digest || f.digest ELSE f.digest || s.digest END),
        f.siblings || coalesce(s.digest, '')
    FROM folded f JOIN placed p ON p.row_no = f.row_no JOIN ordered o ON o.lang IS NOT DISTINCT FROM p.lang, top
    LEFT JOIN (SELECT lang_no, level, place, nodes.digest FROM nodes JOIN ordered ON ordered.lang IS NOT DISTINCT FROM nodes.lang
        UNION ALL SELECT -1, level, place, digest FROM tops) s
        ON s.lang_no = CASE WHEN step < height THEN o.lang_no ELSE -1 END
        AND s.level = CASE WHEN step < height THEN step ELSE step - height END
        AND s.place = xor(CASE WHEN step < height THEN p.place >> step ELSE o.lang_no >> (step - height) END, 1)
    WHERE step < height + top_height
)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM placed JOIN ordered ON placed.lang IS NOT DISTINCT FROM ordered.lang, top
JOIN folded ON folded.row_no = placed.row_no AND step = height + top_height
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_limb_codes": OP11, "op12_mixing": OP12, "op13_merkle": OP13}
