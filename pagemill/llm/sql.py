"""The queries that SQL can express, as DuckDB SQL over the same tables.

The others rest on a tokenizer, a learned model or a seeded hash that SQL lacks; they
are tested against brute force.
"""

from pagemill.llm import codes, divergence, jaccard, licenses, lines, vectors, warc


def _components(edges: str) -> str:
    """CTE ``reach`` of (a, class) from a CTE of directed links (a, b), both ways."""
    return f"""
    walk(a, b) AS (SELECT a, b FROM {edges} UNION SELECT w.a, e.b FROM walk w JOIN {edges} e ON e.a = w.b),
    reach AS (SELECT a, least(a, min(b)) AS class FROM walk GROUP BY a)"""


def _near_documents() -> str:
    n = jaccard.NGRAM
    return rf"""
WITH RECURSIVE ws AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
    grams AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1),
        lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS g FROM ws WHERE len(w) > 0),
    flat AS (SELECT doc_id, len(g) AS size, unnest(g) AS gram FROM grams),
    plain AS (SELECT doc_id, text FROM documents JOIN ws USING (doc_id) WHERE len(w) = 0 AND text <> ''),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b FROM flat x JOIN flat y ON x.gram = y.gram AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.size, y.size
        HAVING count(*) >= {jaccard.SIMILARITY} * (x.size + y.size - count(*))
        UNION ALL SELECT x.doc_id, y.doc_id FROM plain x JOIN plain y ON x.text = y.text AND x.doc_id <> y.doc_id),
    links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
    {_components("pairs")}
SELECT doc_id, coalesce(class, doc_id) AS class_id, coalesce(n, 0)::BIGINT AS n_links,
    coalesce(class, doc_id) = doc_id AS kept
FROM documents LEFT JOIN links l ON l.a = doc_id LEFT JOIN reach r ON r.a = doc_id"""


def _near_vectors() -> str:
    return f"""
WITH RECURSIVE fit AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM fit x JOIN fit y ON x.label = y.label AND x.vec_id <> y.vec_id
        WHERE list_cosine_similarity(x.v, y.v) >= {vectors.COSINE}),
    links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
    {_components("pairs")}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(class, vec_id) AS component_id,
    coalesce(class, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links l ON l.a = vec_id LEFT JOIN reach r ON r.a = vec_id"""


def _license_scan() -> str:
    upper, lower = licenses.ascii_uppercase, licenses.ascii_lowercase
    sets = licenses.notice_sets(licenses.NOTICES, licenses.CONTAINED)
    notices = ", ".join(f"({k}, {n.words!r}, '{n.label}', {n.need}, {n.room})" for k, n in enumerate(sets))

    def words(text: str) -> str:
        return f"regexp_extract_all(translate({text}, '{upper}', '{lower}'), '{licenses.WORD}')"

    found = []
    for phrase, label in licenses.PHRASES:
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
        found.append(
            f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM "
            f"(SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM ws) WHERE {same}"
        )
    return f"""
WITH ws AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
    places AS ({" UNION ALL ".join(found)}),
    base AS (SELECT doc_id, count(*) AS n, min(place) AS low, max(place) AS high, list(label) AS own FROM places GROUP BY doc_id),
    notice(k, nw, label, need, room) AS (VALUES {notices}),
    flat AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM ws),
    nwords AS (SELECT k, unnest(nw) AS word FROM notice),
    hits AS MATERIALIZED (SELECT doc_id, k, word, i FROM flat JOIN nwords USING (word)),
    rich AS (SELECT doc_id, k FROM hits JOIN notice USING (k) GROUP BY doc_id, k, need HAVING count(DISTINCT word) >= need),
    blocks AS (SELECT x.doc_id, k, x.i, count(DISTINCT y.word) AS n
        FROM rich JOIN hits x USING (doc_id, k) JOIN hits y USING (doc_id, k) JOIN notice USING (k)
        WHERE y.i >= x.i AND y.i < x.i + room GROUP BY ALL),
    held AS (SELECT doc_id, label, n / len(nw) AS share FROM blocks JOIN notice USING (k) WHERE n >= need),
    method AS (SELECT doc_id, list(label) AS more, max(share) AS best FROM held GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, low::BIGINT AS first_word,
    high::BIGINT AS last_word, array_to_string(list_sort(list_distinct(coalesce(own, []))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ',') AS labels,
    (CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END)::DOUBLE AS score
FROM ws d LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)"""


def _line_dedup() -> str:
    plain = r"lower(trim(regexp_replace(line, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' '))"
    return f"""
WITH cut AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
    plain AS (SELECT *, {plain} AS p FROM cut),
    spread AS (SELECT p FROM plain WHERE p <> '' GROUP BY p HAVING count(DISTINCT source) >= {lines.SITES}),
    marked AS (SELECT doc_id, pos, line, p IN (FROM spread)
        AND row_number() OVER (PARTITION BY p ORDER BY doc_id, pos) > 1 AS gone FROM plain),
    per_doc AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS dropped,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(dropped, 0)::BIGINT AS n_dropped, sha256(kept) AS text_sha256
FROM documents LEFT JOIN per_doc USING (doc_id)"""


def _revisits() -> str:
    rest = "regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    query = f"""array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '{warc.TRACKING}'))), '&')"""
    return f"""
WITH cut AS (SELECT *, {rest} AS rest, page_id * 1000 AS made, '"' || md5(html) || '"' AS tag FROM pages),
    pg AS (SELECT *, regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\\.|:(80|443)$', '', 'g')
        || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
        || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END AS key FROM cut),
    asked AS (SELECT page_id * 4 + 1 AS record_id, key, made + 400 AS seen, made - 50 AS modified, 'max-age=90' AS age,
            CASE length(html) % 3 WHEN 0 THEN tag WHEN 2 THEN '"changed"' END AS etag FROM pg
        UNION ALL SELECT page_id * 4 + 2, key, made - 400, made - 50, 'no-cache', NULL FROM pg),
    met AS (SELECT a.*, f.page_id, f.html, f.tag, f.made - 50 AS stored FROM asked a LEFT JOIN pg f
        ON f.key = a.key AND f.made < a.seen
        QUALIFY row_number() OVER (PARTITION BY a.record_id ORDER BY f.made DESC NULLS LAST) = 1),
    said AS (SELECT *, CASE WHEN page_id IS NULL THEN 'missing' WHEN etag IS NOT NULL THEN
        CASE WHEN etag = tag THEN 'etag' ELSE 'mismatch' END WHEN modified = stored THEN 'modified' ELSE 'mismatch' END AS outcome FROM met)
SELECT record_id, key, CASE WHEN outcome IN ('etag', 'modified') THEN page_id * 4 END AS full_id, outcome,
    CASE WHEN outcome IN ('etag', 'modified') THEN
        'cache-control: ' || age || '|content-type: text/html|date: ' || seen END AS headers,
    CASE WHEN outcome IN ('etag', 'modified') THEN sha256(html) END AS body_sha256
FROM said"""


def _source_divergence(table: str = "documents") -> str:
    share = f"1 + {divergence.SHARE}::HUGEINT * (n + 1) // (total + v)"
    upper, lower = licenses.ascii_uppercase, licenses.ascii_lowercase
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        coalesce(text, '') AS text FROM {table}),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    words AS MATERIALIZED (SELECT d, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term
        HAVING count(DISTINCT d) >= {divergence.LEAST_DOCS}),
    sizes AS (SELECT lang, count(*) AS v, sum(n) AS words FROM kept GROUP BY lang),
    counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
        GROUP BY lang, source, term),
    totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source)
        GROUP BY lang, source),
    shares AS MATERIALIZED (SELECT lang, source, term, coalesce(c.n, 0) AS n, total, v
        FROM totals JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source, term)),
    p AS MATERIALIZED (SELECT lang, source, term, n, {share} AS p FROM shares),
    q AS (SELECT lang, term, 1 + {divergence.SHARE}::HUGEINT * (n + 1) // (words + v) AS q FROM kept JOIN sizes USING (lang)),
    apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
        FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part
        ORDER BY value DESC, item))::INTEGER AS rank
        FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM placed WHERE part = 'pair' OR rank <= {divergence.TOP}"""


def _vector_codes() -> str:
    n, last = codes.ENTRIES, codes.ROUNDS
    gap = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"

    def assigned(book: str) -> str:
        return f"""SELECT r, p, x, min({gap} * {n} + e) % {n} AS e, min({gap} * {n} + e) // {n} AS d
        FROM parts JOIN (SELECT p, e, x AS c FROM {book}) USING (p) GROUP BY r, p, x"""

    rounds = "".join(
        f""",
    a{k} AS MATERIALIZED ({assigned(f"b{k - 1}")}),
    m{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
        SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, unnest(range(1, len(x) + 1)) t(i) GROUP BY p, e, i)
        GROUP BY p, e),
    b{k} AS MATERIALIZED (SELECT p, e, coalesce(m.x, b.x) AS x FROM b{k - 1} b LEFT JOIN m{k} m USING (p, e))"""
        for k in range(1, last + 1)
    )
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r, * FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {codes.SCALE})::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
    parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // {codes.PARTS} + 1:(p + 1) * len(v) // {codes.PARTS}] AS x
        FROM kept, unnest(range({codes.PARTS})) t(p)),
    b0 AS MATERIALIZED (SELECT p, r AS e, x::HUGEINT[] AS x FROM parts WHERE r < {n}){rounds},
    done AS MATERIALIZED ({assigned(f"b{last}")}),
    coded AS (SELECT r, string_agg(lpad(printf('%x', e::BIGINT), 2, '0'), '' ORDER BY p) AS code,
        sum(d)::BIGINT AS error FROM done GROUP BY r),
    book AS (SELECT sha256(string_agg(x[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
        FROM b{last}, unnest(range(1, len(x) + 1)) t(i))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), book"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_jaccard": _near_documents(),
        "op4_lattice_dedup": _near_vectors(),
        "op5_license_scan": _license_scan(),
        "op6_revisits": _revisits(),
        "op8_line_dedup": _line_dedup(),
        "op11_source_divergence": _source_divergence(),
        "op13_vector_codes": _vector_codes(),
    }
