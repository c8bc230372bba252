"""The SQL that the operators' queries must agree with, where SQL can say it."""

from __future__ import annotations

from shopstream.llm import gnat, packing, reputation

WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))"


def packing_sql(
    max_len: int = packing.MAX_LEN, buckets: int = packing.BUCKETS, budget: int = packing.TOKEN_BUDGET,
    slice_rows: int = packing.SLICE_ROWS,
) -> str:
    """The dynamic programme as one common table expression per number of buckets."""
    steps = "".join(
        f"""
        , c{k} AS (
            SELECT h.j, p.j AS i, p.best + h.length * (h.upto - q.upto) AS cost
            FROM hist h JOIN b{k - 1} p ON p.j < h.j JOIN points q ON q.j = p.j
        )
        , b{k} AS (
            SELECT j, min(cost) AS best, min(i) AS start
            FROM (SELECT *, min(cost) OVER (PARTITION BY j) AS least FROM c{k}) WHERE cost = least GROUP BY j
            UNION ALL SELECT 0, 0, 0
        )"""
        for k in range(2, buckets + 1)
    )
    levels = " UNION ALL ".join(f"SELECT {k} AS k, j, best, start FROM b{k}" for k in range(1, buckets + 1))
    return f"""
        WITH RECURSIVE whole AS (SELECT doc_id, {WORDS} AS tokens FROM documents)
        , rows AS (
            SELECT doc_id, CAST(segment AS INTEGER) AS segment,
                CAST(least(tokens - segment * {max_len}, {max_len}) AS BIGINT) AS length
            FROM (SELECT *, unnest(range(0, greatest(CAST(ceil(tokens / {max_len}) AS BIGINT), 1))) AS segment FROM whole)
        )
        , hist AS (
            SELECT row_number() OVER (ORDER BY length) AS j, length,
                CAST(sum(n) OVER (ORDER BY length) AS BIGINT) AS upto
            FROM (SELECT length, count(*) AS n FROM rows WHERE length > 0 GROUP BY length)
        )
        , points AS (SELECT 0 AS j, 0 AS upto UNION ALL SELECT j, upto FROM hist)
        , b1 AS (SELECT j, length * upto AS best, 0 AS start FROM hist UNION ALL SELECT 0, 0, 0)
        {steps}
        , levels AS ({levels})
        , last AS (SELECT max(j) AS j FROM hist)
        , used AS (
            SELECT min(k) AS k FROM levels JOIN last USING (j)
            WHERE best = (SELECT min(best) FROM levels JOIN last USING (j))
        )
        , walk AS (
            SELECT used.k, last.j FROM used, last
            UNION ALL
            SELECT walk.k - 1, l.start FROM walk JOIN levels l ON l.k = walk.k AND l.j = walk.j WHERE l.start > 0
        )
        , bounds AS (SELECT length AS bucket FROM walk JOIN hist USING (j))
        , slices AS (SELECT greatest(1, CAST(ceil(count(*) / {slice_rows}) AS BIGINT)) AS n FROM rows WHERE length > 0)
        , placed AS (
            SELECT doc_id, segment, length, bucket, row_number() OVER (
                PARTITION BY bucket
                ORDER BY CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % slices.n,
                    doc_id NULLS FIRST, segment
            ) - 1 AS place
            FROM (SELECT *, (SELECT min(bucket) FROM bounds WHERE bucket >= length) AS bucket FROM rows WHERE length > 0), slices
        )
        SELECT doc_id, segment, length, bucket, CAST(place // greatest(1, {budget} // bucket) AS BIGINT) AS batch,
            CAST(place % greatest(1, {budget} // bucket) AS BIGINT) AS slot, bucket - length AS padding
        FROM placed
        UNION ALL SELECT doc_id, segment, length, NULL, NULL, NULL, NULL FROM rows WHERE length = 0
    """


def reputation_sql(limit: float = reputation.LIMIT, z: float = reputation.Z) -> str:
    after = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    two = ", ".join(f"'{s}'" for s in reputation.TWO_LABEL_SUFFIXES)
    rules = " UNION ALL ".join(
        f"SELECT '{r.verdict}' AS verdict, '{r.host}' AS rule_host, '{r.path}' AS rule_path, '{r.text}' AS rule, {i} AS place"
        for i, r in enumerate(reputation.RULES)
    )

    def strength(name: str) -> str:
        rho = (
            "sum(n * pow(k / n - prior, 2) - prior * (1 - prior)) FILTER (n > 0)"
            " / nullif(sum(prior * (1 - prior) * (n - 1)) FILTER (n > 0), 0)"
        )
        bounded = f"least({reputation.MOST_RHO}::DOUBLE, greatest({reputation.LEAST_RHO}::DOUBLE, {rho}))"
        return f"{name}_s AS (SELECT 1 / coalesce({bounded}, {reputation.LEAST_RHO}::DOUBLE) - 1 AS s FROM {name})"

    share = "(k + s * prior) / (n + s)"
    return f"""
        WITH pages_ AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{reputation.UPPER}', '{reputation.UPPER.lower()}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT page_id, coalesce({after}, '') AS rest FROM pages)
        )
        , shown AS (SELECT host, try_cast(regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})([./]|$)', 1) AS BIGINT) AS doc FROM pages_)
        , hosts AS (
            SELECT host, CAST(count(quality) AS DOUBLE) AS n, CAST(count(*) FILTER (quality = 0) AS DOUBLE) AS k,
                array_to_string(string_split(host, '.')[-2:], '.') AS two, array_to_string(string_split(host, '.')[-3:], '.') AS three,
                string_split(host, '.')[-1] AS one
            FROM shown LEFT JOIN (SELECT doc_id, quality FROM labels WHERE quality IN (0, 1)) l ON l.doc_id = doc
            GROUP BY host
        )
        , named AS (
            SELECT host, n, k, CASE WHEN two IN ({two}) THEN three ELSE two END AS domain,
                CASE WHEN two IN ({two}) THEN two ELSE one END AS suffix
            FROM hosts
        )
        , overall AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS prior FROM named)
        , suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(prior) AS prior FROM named, overall GROUP BY suffix)
        , {strength("suffixes")}
        , domains AS (
            SELECT d.domain, d.n, d.k, {share.replace("k +", "x.k +").replace("prior", "x.prior").replace("(n +", "(x.n +")} AS prior
            FROM (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM named GROUP BY domain, suffix) d
            JOIN suffixes x USING (suffix), suffixes_s
        )
        , {strength("domains")}
        , leaves AS (
            SELECT h.host, h.n, h.k, {share.replace("k +", "x.k +").replace("prior", "x.prior").replace("(n +", "(x.n +")} AS prior
            FROM named h JOIN domains x USING (domain), domains_s
        )
        , {strength("leaves")}
        , known AS (
            SELECT host, n, k, m - {z} * sqrt(m * (1 - m) / (n + s + 1)) AS lower
            FROM (SELECT host, n, k, s, {share} AS m FROM leaves, leaves_s)
        )
        , rules AS ({rules})
        , ruled AS (
            SELECT page_id, verdict, rule FROM pages_ JOIN rules
            ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, '/' || rule_path)
            QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, place) = 1
        )
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN lower > {limit} THEN 'block' ELSE 'allow' END) AS verdict,
            CAST(n AS BIGINT) AS n_labelled, CAST(k AS BIGINT) AS n_bad
        FROM pages_ JOIN known USING (host) LEFT JOIN ruled USING (page_id)
    """


# A payload's bytes are its UTF-8; DuckDB's sha1() of a text hashes just those.
WARC = """
    WITH payloads AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
    )
    , named AS (
        SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS kept FROM payloads
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN kept <> page_id THEN kept END AS refers_to
    FROM named
"""


# Works on the turns before they are made mails: a mail's outer quote is the turn before, the inner one that before it.
# Every quoted text meets every earlier turn that says it.
QUOTES = r"""
    WITH RECURSIVE turns AS (SELECT conv_id, turn, min(coalesce(text, '')) AS quoted_text FROM conversations GROUP BY ALL)
    , own_lines AS (
        SELECT conv_id, turn, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
            lambda l: lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')))), lambda l: l <> '') AS lines
        FROM conversations
    )
    , said AS (
        SELECT DISTINCT conv_id, turn, unnest(list_append(lines, array_to_string(lines, ' '))) AS words FROM own_lines WHERE len(lines) > 0
    )
    , quotes AS (
        SELECT c.conv_id, c.turn, back.n AS level, list_filter(list_transform(string_split(q.quoted_text, chr(10)),
            lambda l: lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')))), lambda l: l <> '') AS lines
        FROM (SELECT DISTINCT conv_id, turn FROM conversations) c, (VALUES (1), (2)) back(n)
        JOIN turns q ON q.conv_id = c.conv_id AND q.turn = c.turn - back.n
    )
    , units AS (
        SELECT conv_id, turn, level, words, CAST(sum(passage) AS BIGINT) AS passages, CAST(sum(line) AS BIGINT) AS lines FROM (
            SELECT conv_id, turn, level, array_to_string(lines, ' ') AS words, 1 AS passage, 0 AS line FROM quotes WHERE len(lines) > 0
            UNION ALL SELECT conv_id, turn, level, unnest(lines), 0, 1 FROM quotes
        ) GROUP BY ALL
    )
    , scored AS (
        SELECT u.conv_id, u.turn, u.level, s.turn AS original, sum(u.passages) AS passages, sum(u.lines) AS lines
        FROM units u JOIN said s ON s.conv_id = u.conv_id AND s.words = u.words AND s.turn < u.turn GROUP BY ALL
    )
    , originals AS (
        SELECT conv_id, turn, level, original FROM scored
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY passages DESC, lines DESC, original DESC) = 1
    )
    , votes AS (
        SELECT o.conv_id, o.original AS turn, i.original, count(*) AS n
        FROM originals o JOIN originals i ON i.conv_id = o.conv_id AND i.turn = o.turn AND i.level = o.level + 1 AND i.original < o.original
        GROUP BY ALL
    )
    , told AS (SELECT conv_id, turn, arg_max(original, (n, original)) AS original FROM votes GROUP BY ALL)
    , parents AS (
        SELECT conv_id, turn, coalesce(d.original, t.original) AS parent
        FROM (SELECT * FROM originals WHERE level = 1) d FULL JOIN told t USING (conv_id, turn)
    )
    , walk AS (
        SELECT conv_id, turn, turn AS here, 0 AS depth FROM turns
        UNION ALL
        SELECT w.conv_id, w.turn, p.parent, w.depth + 1 FROM walk w JOIN parents p ON p.conv_id = w.conv_id AND p.turn = w.here
    )
    , tops AS (SELECT conv_id, turn, arg_max(here, depth) AS root, max(depth) AS depth FROM walk GROUP BY conv_id, turn)
    , counts AS (
        SELECT u.conv_id, u.turn, CAST(sum(u.lines) AS BIGINT) AS quoted FROM units u
        WHERE EXISTS (SELECT 1 FROM said s WHERE s.conv_id = u.conv_id AND s.words = u.words AND s.turn < u.turn)
        GROUP BY ALL
    )
    SELECT conv_id, turn, role, coalesce(text, '') AS text, parent, root, depth, coalesce(quoted, 0) AS quoted
    FROM conversations LEFT JOIN parents USING (conv_id, turn) JOIN tops USING (conv_id, turn) LEFT JOIN counts USING (conv_id, turn)
"""


EXACT = r"""
    WITH plain AS (
        SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
        FROM documents
    )
    , kept AS (SELECT *, first_value(doc_id) OVER (PARTITION BY plain ORDER BY points DESC, doc_id) AS keep_id FROM plain)
    SELECT doc_id, keep_id, count(*) OVER (PARTITION BY plain) AS group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
    FROM kept
"""


def codes_sql(parts: int = gnat.PARTS, entries: int = gnat.ENTRIES, rounds: int = gnat.ROUNDS) -> str:
    """Every part is compared with every entry of its codebook."""
    def nearest(i: int) -> str:
        return f"""
        , near{i} AS (
            SELECT r.vec_id, r.label, r.part, r.xs, b.entry, {squared} AS error
            FROM cut r JOIN book{i} b USING (part)
            QUALIFY row_number() OVER (PARTITION BY r.vec_id, r.part ORDER BY error, b.entry) = 1
        )"""

    squared = "list_sum(list_transform(list_zip(r.xs, b.xs), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = "".join(
        nearest(i) + f"""
        , sums{i} AS (
            SELECT part, entry, place, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
            FROM (SELECT part, entry, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS place FROM near{i}) GROUP BY ALL
        )
        , means{i} AS (
            SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY place) AS xs FROM sums{i} GROUP BY part, entry
        )
        , book{i + 1} AS (SELECT part, entry, coalesce(m.xs, b.xs) AS xs FROM book{i} b LEFT JOIN means{i} m USING (part, entry))"""
        for i in range(rounds)
    )
    return f"""
        WITH whole AS (
            SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda c: c IS NULL OR NOT isfinite(c)))
        )
        , cut AS (
            SELECT vec_id, label, part, list_slice(x, part * len(x) // {parts} + 1, (part + 1) * len(x) // {parts}) AS xs
            FROM whole, range({parts}) parts(part)
        )
        , first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole ORDER BY vec_id LIMIT {entries})
        , book0 AS (SELECT part, entry, xs FROM cut JOIN first USING (vec_id))
        {steps}
        {nearest(rounds)}
        , coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
            FROM near{rounds} GROUP BY vec_id, label
        )
        , books AS (
            SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded, books
    """


ALL: dict[str, str] = {
    "op2_quotes": QUOTES,
    "op5_packing": packing_sql(),
    "op7_warc": WARC,
    "op10_reputation": reputation_sql(),
    "op11_grace": EXACT,
    "op13_gnat": codes_sql(),
}
