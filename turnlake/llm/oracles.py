"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from turnlake.llm import bundles, licenses, prefix_trie, secret_scan


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def exact_duplicates() -> str:
    return """
        WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM t JOIN g USING (text_sha256)
    """


def secrets() -> str:
    """Ids are taken to be unique here."""
    found = " UNION ALL ".join(
        f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, '{role}' AS role, {str(kind in secret_scan.BASE).lower()} AS base,
            unnest(range(len(m))) AS i, unnest(list_transform(m, lambda x: length(x))) AS n,
            unnest(list_transform(v, lambda x: length(x))) AS n_value, unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gap
            FROM (SELECT doc_id, regexp_extract_all(text, {_text(pattern)}) AS m, regexp_extract_all(text, {_text(pattern)}, {group}) AS v,
                  string_split_regex(text, {_text(pattern)}) AS g FROM documents)"""
        for rank, (kind, pattern, group, _, _, role) in enumerate(secret_scan.KINDS)
    )
    fits = " OR ".join(f"(kind = '{kind}' AND n_value >= {least} AND n_value <= {most or 10**9})" for kind, _, _, least, most, _ in secret_scan.KINDS)
    pairs = " OR ".join(f"(p.role = '{a}' AND q.role IN ({', '.join(map(_text, b))}))" for a, b in secret_scan.COMPLEMENTS.items())
    return f"""
        WITH found AS ({found}),
        placed AS (SELECT *, (sum(gap + n) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS e FROM found),
        parts AS (SELECT *, e - n AS s FROM placed WHERE {fits}),
        shown AS (SELECT * FROM parts p WHERE base OR EXISTS (SELECT 1 FROM parts q
                  WHERE q.doc_id = p.doc_id AND abs(q.s - p.s) <= {secret_scan.SCOPE} AND ({pairs}))),
        texts AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                  count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (NOT base) AS n_linked,
                  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (base) AS b,
                  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM shown GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
        FROM documents LEFT JOIN texts USING (doc_id)
    """


def license_scan() -> str:
    """Ids are taken to be unique here."""
    values = ", ".join(f"({i}, '{name}', {_text(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))
    words = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: w <> '')"
    least = licenses.LEAST
    return f"""
        WITH docs AS (SELECT doc_id, {words} AS w FROM documents),
        notices AS (SELECT template, license, {words} AS w FROM (VALUES {values}) v(template, license, text)),
        known AS (SELECT DISTINCT template, license, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT *, unnest(range(1, len(w))) AS i FROM notices)),
        sizes AS (SELECT *, count(*) OVER (PARTITION BY template) AS m FROM known),
        pairs AS (SELECT doc_id, i AS place, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT *, unnest(range(1, len(w))) AS i FROM docs)),
        places AS (SELECT * FROM pairs JOIN sizes USING (pair)),
        enough AS (SELECT doc_id, template FROM places GROUP BY doc_id, template, m HAVING count(DISTINCT pair) >= {least} / (2 - {least}) * m),
        near AS (SELECT *, lag(place) OVER (PARTITION BY doc_id, template, pair ORDER BY place) AS last FROM places SEMI JOIN enough USING (doc_id, template)),
        windows AS (SELECT b.doc_id, b.template, b.license, a.place AS start, b.place, b.m, b.place - a.place + 1 AS n,
                    sum((b.last IS NULL OR b.last < a.place)::INT) OVER (PARTITION BY a.doc_id, a.template, a.place ORDER BY b.place) AS shared
                    FROM near a JOIN near b ON a.doc_id = b.doc_id AND a.template = b.template AND b.place >= a.place AND b.place < a.place + floor(b.m * (2 - {least}) / {least} + 1e-9)),
        good AS (SELECT doc_id, template, license, max(2 * shared / (n + m)) AS dice FROM windows WHERE 2 * shared / (n + m) >= {least} GROUP BY ALL),
        texts AS (SELECT doc_id, count(DISTINCT license) AS n_licenses, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best_dice FROM good GROUP BY doc_id),
        best AS (SELECT doc_id, min(license) AS best_license FROM good JOIN texts USING (doc_id) WHERE dice = best_dice GROUP BY doc_id)
        SELECT doc_id, coalesce(n_licenses, 0) AS n_licenses, coalesce(licenses, '') AS licenses, best_license, best_dice
        FROM documents LEFT JOIN texts USING (doc_id) LEFT JOIN best USING (doc_id)
    """


def prefix_nodes() -> str:
    steps = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    checksum = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, b: {steps}), 4294967295)"
    return f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, {checksum} % {prefix_trie.SHARED} AS h, list(struct_pack(r := role, x := text) ORDER BY turn NULLS FIRST, role, text) AS seq FROM t GROUP BY conv_id),
        made AS (SELECT a.conv_id, list_concat(coalesce(b.seq[:a.h], []), a.seq[a.h + 1:]) AS seq
                 FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {prefix_trie.GROUP}),
        parts AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM made),
        nodes AS (SELECT seq[:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth), '')) AS ends_sha256,
                  (count(*) - 1) * coalesce(strlen(any_value(seq[depth].x)), 0) AS saved FROM parts GROUP BY 1, 2),
        kin AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[:n.depth] = n.node) AS n_children
                FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND n.node[:n.depth - 1] = p.node)
        SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, (count(*) FILTER (b.n_children = 0))::BIGINT AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens, a.ends_sha256
        FROM kin a JOIN kin b ON b.depth >= a.depth AND b.node[:a.depth] = a.node GROUP BY ALL
    """


def warc_bundles() -> str:
    """Ids are taken to be unique here."""
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= {bundles.SMALL} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= {bundles.SMALL} AND page_id <> first THEN first END AS refers_to
        FROM d
    """


ORACLES = {
    "op3_license_scan": license_scan(),
    "op6_secret_scan": secrets(),
    "op10_exact_duplicates": exact_duplicates(),
    "op11_prefix_trie": prefix_nodes(),
    "op13_warc_bundles": warc_bundles(),
}
