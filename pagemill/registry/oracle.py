"""The registered queries as DuckDB SQL over the same tables."""

from pagemill.functions.hashing import BLOCKS, FNV_OFFSET, FNV_PRIME, signed64, block_shift
from pagemill.registry.standins import JUNK_URLS, LABELS, LEXICON, MAPPING, REST

_MOD = 1 << 64


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


def _words(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '\p{{L}}+')"


def _hashes(name: str, source: str) -> str:
    """CTEs down to ``name`` (fid, hash) from ``source`` (fid, ws list)."""
    byte = "('0x' || substr(hx, 2 * i + 1, 2))::HUGEINT"
    sums = ", ".join(f"sum((h >> {i}) & 1) AS s{i}" for i in range(64))
    bits = " + ".join(f"(CASE WHEN 2 * s{i} > n THEN {1 << i}::HUGEINT ELSE 0 END)" for i in range(64))
    return f"""
    {name}_tok AS (SELECT fid, unnest(ws) AS w FROM {source}),
    {name}_voc AS (SELECT w, hex(encode(w)) AS hx FROM (SELECT DISTINCT w FROM {name}_tok)),
    {name}_fnv AS (SELECT w, list_reduce(
        list_transform(range(length(hx) // 2), lambda i: {byte}),
        lambda h, b: (xor(h, b) * {FNV_PRIME}::HUGEINT) % {_MOD}::HUGEINT,
        {FNV_OFFSET}::HUGEINT) AS h FROM {name}_voc),
    {name}_sum AS (SELECT fid, count(*) AS n, {sums}
        FROM {name}_tok JOIN {name}_fnv USING (w) GROUP BY fid),
    {name}_big AS (SELECT fid, n, {bits} AS h FROM {name}_sum),
    {name} AS (SELECT s.fid, CASE WHEN b.n > 5 THEN
        (CASE WHEN h >= {1 << 63}::HUGEINT THEN h - {_MOD}::HUGEINT ELSE h END)::BIGINT ELSE -1 END AS hash
        FROM {source} s LEFT JOIN {name}_big b USING (fid))"""


DOCS = r"""
    docs AS (SELECT doc_id AS fid, 'http://' || source || '.example.org/' || lang || '/' || doc_id AS furl,
        split_part(text, chr(10), 1) AS ftitle, nullif(source, 'src0') AS fkeywords,
        text AS fcontent, lang FROM documents)"""
DOC_WORDS = f"{DOCS}, dw AS (SELECT fid, {_words('fcontent')} AS ws FROM docs)"
DOC_HASHES = f"{DOC_WORDS}, {_hashes('dh', 'dw')}"
PAGES = r"""
    pg AS (SELECT page_id AS fid, url AS furl, regexp_extract(html, '<title>(.*?)</title>', 1) AS ftitle,
        nullif(regexp_extract(html, '<a href="/([^"]*)"', 1), 'The') AS fkeywords, html AS fcontent FROM pages)"""
ARTICLES = f"""{DOCS},
    art AS (SELECT d.fid, ftitle, fcontent,
        CASE WHEN quality IS NOT NULL THEN lang || '_' || CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END END
            AS fcategory,
        CASE WHEN toxic = 1 THEN 1 ELSE 2 END::BIGINT AS fresource_type
        FROM docs d LEFT JOIN labels l ON l.doc_id = d.fid)"""
LOG = """
    log AS (SELECT user_id::VARCHAR AS imei, (event_id // 10)::VARCHAR AS article_id,
        event_type AS event_name, strftime(ts, '%Y%m%d')::INT AS stat_date FROM events)"""
READS = f"""{LOG},
    rd AS (SELECT imei, try_cast(article_id AS BIGINT) AS fid, count(*)::BIGINT AS sumcnt FROM log
        WHERE event_name = 'view' AND article_id <> '' GROUP BY ALL)"""
CLICKS = """
    clk AS (SELECT user_id::VARCHAR AS imei, CASE WHEN value < 5 THEN 'en good' WHEN value < 10 THEN 'FR-bad'
        WHEN value < 15 THEN 'de_other' WHEN value < 20 THEN 'es' WHEN value < 40 THEN '' END AS cat
        FROM events WHERE event_type = 'click')"""
LEX = f"lex(word, cls) AS (VALUES {_values(LEXICON)})"
_TOPICAL = "left(cls, 1) IN ('c','d','e','m','p','q','r','u','w','x','y','z')"
STOP = f"{LEX}, stop AS (SELECT list(word) AS ws FROM lex WHERE {_TOPICAL})"
MAP = f"""
    mp AS (SELECT kind, lower(src) AS src, lower(dst) AS dst FROM (VALUES {_values(MAPPING)}) v(kind, src, dst)),
    lab(label) AS (VALUES {_values([(x,) for x in LABELS])})"""
_NORM = r"regexp_replace(replace(lower(trim({c})), '其它', '其他'), '[ _-]+', ',', 'g')"

SAME = "same AS (SELECT hash, min(fid) AS fid, count(*)::BIGINT AS samelen FROM dh WHERE hash <> -1 GROUP BY hash)"
# Documents without a fingerprint stand for themselves.
SHORT = "UNION ALL SELECT fid AS rep_fid, fid FROM dh WHERE hash = -1"
MEMBERS = f"mem AS (SELECT s.fid AS rep_fid, d.fid FROM dh d JOIN same s USING (hash) {SHORT})"
JUNK = "junk AS (SELECT DISTINCT hash FROM dh WHERE fid IN (SELECT doc_id FROM labels WHERE toxic = 1))"
TITLES = "shared AS (SELECT ftitle FROM pg GROUP BY ftitle HAVING count(*) > 2)"
_SITE = "array_to_string(string_split(regexp_replace({c}, '/+$', ''), '/')[1:3], '/')"


def _mask(block: int) -> int:
    return signed64(~(0xFFFF << block_shift(block)) & _MOD - 1)


def _keys(source: str, cols: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {cols}, {b} AS block, hash & {_mask(b)}::BIGINT AS key FROM {source}" for b in range(BLOCKS)
    )


def _pairs(k: int) -> str:
    return f"""WITH {DOC_HASHES}, {SAME}
        SELECT a.fid AS fid_a, b.fid AS fid_b, bit_count(xor(a.hash, b.hash))::INT AS distance
        FROM same a JOIN same b ON a.fid < b.fid AND bit_count(xor(a.hash, b.hash)) <= {k}"""


def _round(name: str, source: str, k: int, block: int) -> str:
    """One greedy merge round as a fold over each block group in leader order."""
    near = f"bit_count(xor(w.hash, x[1].hash)) <= {k}"
    first = f"list_position(list_transform(acc, lambda w: {near}), true)"
    item = "{'fid': fid, 'hash': hash, 'samelen': samelen, 'members': [fid]}"
    grown = (
        "{'fid': w.fid, 'hash': w.hash, 'samelen': w.samelen + x[1].samelen,"
        " 'members': list_concat(w.members, x[1].members)}"
    )
    return f"""
    {name}_rows AS (SELECT list([{item}] ORDER BY samelen DESC, fid) AS rows FROM {source}
        GROUP BY hash & {_mask(block)}::BIGINT),
    {name}_fold AS (SELECT unnest(list_reduce(rows, lambda acc, x:
        CASE WHEN coalesce({first}, 0) = 0 THEN list_concat(acc, x)
        ELSE list_transform(acc, lambda w, i: CASE WHEN i = {first} THEN {grown} ELSE w END) END)) AS u
        FROM {name}_rows),
    {name} AS (SELECT u.fid AS fid, u.hash AS hash, u.samelen AS samelen, u.members AS members FROM {name}_fold)"""


def _rounds(k: int) -> str:
    sources = ["same", "r0", "r1", "r2"]
    return ", ".join(_round(f"r{b}", sources[b], k, b) for b in range(BLOCKS))


def _edges() -> str:
    """Final leader of each representative through the four rounds."""
    maps = ", ".join(
        f"m{b} AS (SELECT unnest(members) AS fid, fid AS rep FROM r{b})" for b in range(BLOCKS)
    )
    return maps


# Training rows, lines and naive Bayes

TRAIN = f"""{ARTICLES}, {STOP}, {MAP},
    norm AS (SELECT fid, {_NORM.format(c='fcategory')} AS cat FROM art),
    ex AS (SELECT fid, coalesce(dst, cat) AS cat FROM norm LEFT JOIN mp ON kind = 'exact' AND src = cat),
    pa AS (SELECT fid, coalesce(dst, cat) AS cat FROM ex LEFT JOIN mp ON kind = 'parent' AND src = split_part(cat, ',', 1)),
    mapped AS (SELECT fid, coalesce(dst, cat) AS cat FROM pa LEFT JOIN mp ON kind = 'user' AND src = cat),
    fitted AS (SELECT fid, cat, coalesce(replace(w.label, ',', '_'), p.label, c.label, 'unknow') AS label
        FROM mapped
        LEFT JOIN lab w ON w.label = cat
        LEFT JOIN lab p ON contains(cat, ',') AND p.label = split_part(cat, ',', 1)
        LEFT JOIN lab c ON contains(cat, ',') AND c.label = split_part(cat, ',', 2))"""


def _strip_html(c: str) -> str:
    steps = [
        (r"chr(10)", "' '"),
        ("'<script>.*?</script>'", "''"),
        (r"'(</p>|</br>)\n*'", "chr(10)"),
        ("'<[^>]+?>'", "' '"),
        (r"'(点击加载图片)|(查看原文)|(图片来源)|([\-#=]{3,})'", "' '"),
        (r"'\s*\n\s*'", "chr(10)"),
        (r"'[ \t]+'", "' '"),
    ]
    for pattern, replacement in steps:
        c = f"regexp_replace({c}, {pattern}, {replacement}, 'g')"
    return c


def _train_words(c: str) -> str:
    return (
        f"array_to_string(list_filter({_words(_strip_html(c))},"
        " lambda w: length(w) >= 2 AND NOT list_contains(stop.ws, w)), ' ')"
    )


TRAIN_ROWS = f"""{TRAIN},
    tr AS (SELECT a.fid, m.cat, {_train_words('ftitle')} AS title, {_train_words('fcontent')} AS content,
        fresource_type AS resource_type FROM art a JOIN mapped m USING (fid), stop
        WHERE length(trim(fcategory)) > 1)"""
LABELLED = f"""{TRAIN_ROWS},
    lb AS (SELECT f.label, content AS text FROM tr JOIN fitted f USING (fid)
        WHERE resource_type = 2 AND length(trim(tr.cat)) > 1 AND length(trim(content)) > 1)"""
LINES = f"""{LABELLED},
    own AS (SELECT split_part(label, ',', 1) AS model FROM lab GROUP BY 1 HAVING count(*) > 2 UNION ALL SELECT 'all'),
    par AS (SELECT label, regexp_replace(label, '^(.+)_[^_]*$', '\\1') AS parent, text FROM lb),
    lines AS (SELECT 'all' AS model, parent AS label, text FROM par UNION ALL
        SELECT parent, label, text FROM par WHERE parent <> label AND parent IN (SELECT model FROM own))"""
FIT = f"""{LINES},
    cnt AS (SELECT model, label, word, count(*) AS n FROM
        (SELECT model, label, unnest(string_split(text, ' ')) AS word FROM lines) WHERE word <> '' GROUP BY ALL),
    lst AS (SELECT model, label, ln(count(*) / sum(count(*)) OVER (PARTITION BY model)) AS prior
        FROM lines GROUP BY model, label),
    voc AS (SELECT model, word FROM cnt GROUP BY ALL),
    den AS (SELECT l.model, l.label, prior, ln(coalesce(t, 0) + v) AS den FROM lst l
        JOIN (SELECT model, count(*) AS v FROM voc GROUP BY 1) USING (model)
        LEFT JOIN (SELECT model, label, sum(n) AS t FROM cnt GROUP BY ALL) USING (model, label))"""


def _score(name: str, source: str) -> str:
    """CTEs down to ``name`` (fid, words, cat, prob) from ``source`` (fid, words, model)."""
    return f"""
    {name}_tok AS (SELECT fid, model, word FROM
        (SELECT fid, model, unnest(string_split(words, ' ')) AS word FROM {source}) SEMI JOIN voc USING (model, word)),
    {name}_known AS (SELECT fid, model, count(*) AS k FROM {name}_tok GROUP BY ALL),
    {name}_hit AS (SELECT fid, model, label, sum(ln(n + 1.0)) AS s FROM {name}_tok JOIN cnt USING (model, word) GROUP BY ALL),
    {name}_sc AS (SELECT fid, label, prior - k * den + coalesce(s, 0) AS sc FROM {name}_known JOIN den USING (model)
        LEFT JOIN {name}_hit USING (fid, model, label)),
    {name}_mx AS (SELECT fid, max(sc) AS m FROM {name}_sc GROUP BY fid),
    {name}_best AS (SELECT fid, min(label) FILTER (WHERE sc = m) AS cat, 1 / sum(exp(sc - m)) AS prob
        FROM {name}_sc JOIN {name}_mx USING (fid) GROUP BY fid),
    {name} AS (SELECT s.fid, words,
        CASE WHEN length(trim(coalesce(words, ''))) = 0 OR (cat IS NULL AND model = 'all') THEN 'unknow'
            WHEN cat IS NULL THEN model || '_other' ELSE cat END AS cat,
        round(CASE WHEN length(trim(coalesce(words, ''))) = 0 THEN -1.0 WHEN cat IS NULL AND model = 'all' THEN -3.0
            WHEN cat IS NULL THEN -4.0 ELSE prob END, 6)::DOUBLE AS prob
        FROM {source} s LEFT JOIN {name}_best USING (fid))"""


def _child_input(name: str, source: str) -> str:
    return (
        f"{name} AS (SELECT fid, words, cat AS model FROM {source}"
        " WHERE cat IN (SELECT model FROM lst WHERE model <> 'all'))"
    )


def _external(name: str, source: str) -> str:
    """CTEs down to ``name``: the answers of the registered external classifier."""
    first, n = "split_part(words, ' ', 1)", "len(string_split(words, ' '))"
    blank, fails, silent = "length(trim(coalesce(words, ''))) = 0", f"starts_with({first}, 'th')", f"{n} % 5 = 0"
    return f"""{name} AS (SELECT fid, words, CASE WHEN {blank} OR {fails} THEN 'unknow'
            WHEN {silent} THEN CASE WHEN model = 'all' THEN 'unknow' ELSE model || '_other' END
            ELSE left(model, 1) || left({first}, 2) END AS cat,
        round(CASE WHEN {blank} OR {fails} THEN -1.0 WHEN {silent} THEN CASE WHEN model = 'all' THEN -3.0 ELSE -4.0 END
            ELSE exp(-({n} % 7)) END, 6)::DOUBLE AS prob FROM {source})"""


DOC_INPUT = f"""{FIT}, din AS (SELECT fid, array_to_string({_words('fcontent')}, ' ') AS words, 'all' AS model FROM docs)"""
PARENTS = f"{DOC_INPUT}, {_score('pc', 'din')}"
CHILDREN = f"{PARENTS}, {_child_input('cin', 'pc')}, {_score('cc', 'cin')}"


def _strip_tags(c: str) -> str:
    trimmed = rf"regexp_replace(coalesce({c}, ''), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
    return f"regexp_replace(replace({trimmed}, chr(10), ' '), '<.*?>', ' ', 'g')"


def _joined(c: str) -> str:
    return f"array_to_string({_words(_strip_tags(c))}, ' ')"


_PREPARED = f"""
    prep AS (SELECT fid, {_joined('ftitle')} AS title_words, {_joined('fcontent')} AS content_words FROM art
        WHERE (fcategory IS NULL OR length(trim(fcategory)) <= 1) AND fid IN (SELECT fid FROM rd))"""
PREDICTIONS = f"""{FIT}, {READS}, {_PREPARED},
    tin AS (SELECT fid, title_words AS words, 'all' AS model FROM prep),
    kin AS (SELECT fid, content_words AS words, 'all' AS model FROM prep),
    {_score('tp', 'tin')}, {_child_input('tcin', 'tp')}, {_score('tc', 'tcin')},
    {_score('kp', 'kin')}, {_child_input('kcin', 'kp')}, {_score('kc', 'kcin')},
    preds AS (SELECT fid, cat, prob FROM tp UNION ALL SELECT fid, cat, prob FROM tc
        UNION ALL SELECT fid, cat, prob FROM kp UNION ALL SELECT fid, cat, prob FROM kc),
    picked AS (SELECT fid, list_reduce(
        list({{'len': length(cat), 'prob': prob, 'cat': cat}} ORDER BY length(cat), prob, cat),
        lambda a, b: CASE WHEN contains(b.cat, a.cat) OR b.prob >= a.prob THEN b ELSE a END).cat AS cat
        FROM preds WHERE cat <> 'unknow' GROUP BY fid)"""
EDITOR = """
    ed AS (SELECT fid, fcategory FROM art WHERE length(trim(fcategory)) > 1 AND fid IN (SELECT fid FROM rd))"""


def _topic_split(c: str) -> tuple[str, str]:
    topic = rf"regexp_replace(replace(lower({c}), '其它', '其他'), '[ _-]', ',', 'g')"
    parent, child = f"split_part({topic}, ',', 1)", f"string_split({topic}, ',')[2]"
    of_rest = f"CASE WHEN {child} IS NULL OR {child} = 'other' THEN {parent} || '{REST}' ELSE {child} END"
    return parent, f"CASE WHEN {c} IS NULL THEN NULL ELSE {of_rest} END"


_EVENTS = """
    ev AS (SELECT imei, cat, sumcnt AS cnt FROM rd JOIN top USING (fid) UNION ALL
        SELECT imei, cat, 1::BIGINT FROM clk WHERE cat IS NOT NULL AND cat <> '')"""
_EDITOR_EVENTS = f"{ARTICLES}, {READS}, {EDITOR}, {CLICKS}, top AS (SELECT fid, fcategory AS cat FROM ed), {_EVENTS}"
_COUNTS = "SELECT imei, {} AS pcat, {} AS ccat, sum(cnt)::BIGINT AS cnt FROM ev GROUP BY ALL".format(
    *_topic_split("cat")
)
_PAGE_WORDS = rf"pw AS (SELECT *, {_words('fcontent')} AS ws FROM pg WHERE length(trim(fcontent)) > 1)"
_JOB_HASHES = f"""{DOC_WORDS}, {STOP},
    sw AS (SELECT fid, list_filter(dw.ws, lambda w: NOT list_contains(stop.ws, w)) AS ws FROM dw, stop),
    jw AS (SELECT fid, ws FROM sw WHERE length(array_to_string(ws, ',')) > 1), {_hashes('dh', 'jw')}"""
_DOC_KEY = f"""{DOC_HASHES}, {SAME}, {JUNK}"""


def _near(hash_col: str, listed: str, k: int) -> str:
    return f"EXISTS (SELECT 1 FROM {listed} j WHERE bit_count(xor({hash_col}, j.hash)) <= {k})"


def oracle_sql() -> dict[str, str]:
    squash = "regexp_replace(coalesce({}, ''), '[\\n\\r\\t ,]+', '', 'g')"
    urls = " OR ".join(f"contains({{}}, '{u}')" for u in JUNK_URLS)
    site = _SITE.format(c="furl")
    page_job = f"""WITH {FIT}, dw AS (SELECT fid, {_words('fcontent')} AS ws FROM docs), {_hashes('dh', 'dw')}, {JUNK},
            jin AS (SELECT fid, array_to_string(ws, ' ') AS words, 'all' AS model FROM docs JOIN dw USING (fid) JOIN dh USING (fid)
            WHERE length(trim(fcontent)) > 1 AND hash <> -1 AND NOT contains({site}, 'src1.')
            AND NOT contains({site}, '//src17') AND NOT {_near('dh.hash', 'junk', 1)}), {_score('jp', 'jin')},
            {_child_input('jcin', 'jp')}, {_score('jc', 'jcin')}"""
    sql = {
        "read_day_pruned": f"WITH {LOG} SELECT imei, article_id, event_name FROM log WHERE stat_date = 20240115",
        "written_day_readback": f"WITH {DOCS} SELECT fid, ftitle, fcontent, lang FROM docs",
        "category_partition_readback": f"WITH {DOCS} SELECT fid, ftitle, fcontent FROM docs WHERE lang = 'de'",
        "dimension_read": "SELECT doc_id, lang, n_chars FROM documents",
        "list_lookup_export": f"""WITH {DOC_HASHES} SELECT fid, array_to_string(ws, ' ') AS words, hash
            FROM dw JOIN dh USING (fid) WHERE fid IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
        "parallel_scan": f"WITH {DOCS} SELECT fid, furl FROM docs",
        "balanced_scan": f"WITH {DOCS} SELECT fid, furl, md5(fcontent) AS fcontent FROM docs",
        "b64_content": "SELECT doc_id AS fid, decode(from_base64(to_base64(encode(text)))) AS content FROM documents",
        "strip_tags": f"WITH {PAGES} SELECT fid, {_strip_tags('fcontent')} AS text FROM pg",
        "strip_html": f"WITH {PAGES} SELECT fid, {_strip_html('fcontent')} AS text FROM pg",
        "squash_text": f"WITH {DOCS} SELECT fid, {squash.format('fcontent')} AS text, {squash.format('fkeywords')} AS keywords FROM docs",
        "site_of_url": f"WITH {PAGES} SELECT fid, {site} AS site FROM pg",
        "null_to_empty": f"WITH {PAGES} SELECT fid, coalesce(fkeywords, '') AS keywords FROM pg",
        "keep_script": rf"WITH {DOCS} SELECT fid, regexp_replace(fcontent, '[^\p{{L}}]+', ' ', 'g') AS text FROM docs",
        "word_list": f"WITH {DOC_WORDS} SELECT fid, length(ws)::INT AS n_words, array_to_string(ws, ',') AS words FROM dw",
        "word_class_counts": f"""WITH {DOC_WORDS}, {LEX},
            tok AS (SELECT fid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM dw)
            SELECT fid, coalesce(cls, 'n') AS cls, count(*) AS n, sum(pos)::BIGINT AS pos_sum
            FROM tok LEFT JOIN lex USING (word) GROUP BY ALL""",
        "class_filter": f"""WITH {DOC_WORDS}, {STOP} SELECT fid, array_to_string(
            list_filter(dw.ws, lambda w: NOT list_contains(stop.ws, w)), ' ') AS words FROM dw, stop""",
        "min_word_len": f"WITH {DOC_WORDS} SELECT fid, array_to_string(list_filter(ws, lambda w: length(w) >= 2), ' ') AS words FROM dw",
        "parse_tagged": f"""WITH {DOC_WORDS} SELECT fid, array_to_string(list_filter(ws,
            lambda w: length(w) <= 2 OR left(lang, 1) NOT IN ('e', 'f')), ' ') AS words FROM dw JOIN docs USING (fid)""",
        "nonblank": f"WITH {DOCS} SELECT fid, ftitle FROM docs WHERE length(trim(fkeywords)) > 1 AND length(trim(ftitle)) > 1",
        "prepared_articles": f"WITH {ARTICLES}, {READS}, {_PREPARED} SELECT * FROM prep",
        "training_rows": f"WITH {TRAIN_ROWS} SELECT cat, title, content, resource_type FROM tr",
        "prepared_pages": f"""WITH {PAGES}, {_PAGE_WORDS}, {_hashes('ph', 'pw')}
            SELECT fid, array_to_string(ws, ' ') AS words, hash, {site} AS furl, ftitle FROM pw JOIN ph USING (fid)""",
        "simhash": f"WITH {DOC_HASHES} SELECT fid, hash FROM dh",
        "hash_distance": f"""WITH {DOC_HASHES}, tw AS (SELECT fid, {_words('ftitle')} AS ws FROM docs), {_hashes('th', 'tw')}
            SELECT fid, dh.hash AS body_hash, th.hash AS title_hash FROM dh JOIN th USING (fid)
            WHERE bit_count(xor(dh.hash, th.hash)) <= 20""",
        "same_hash": f"WITH {DOC_HASHES}, {SAME} SELECT hash, fid, samelen FROM same",
        "same_members": f"WITH {DOC_HASHES}, {SAME}, {MEMBERS} SELECT rep_fid, fid FROM mem",
        "block_keys": f"WITH {DOC_HASHES} {_keys('dh', 'fid, hash')}",
        "near_pairs": _pairs(1),
        "near_pairs_3_bits": _pairs(3),
        "merge_round": f"""WITH {DOC_HASHES}, {SAME}, {_round('r', 'same', 3, 1)}
            SELECT fid, hash, samelen, length(members)::INT AS n_members FROM r""",
        "near_dup_clusters": f"WITH {DOC_HASHES}, {SAME}, {_rounds(1)} SELECT fid, hash, samelen FROM r3",
        "near_dup_clusters_3_bits": f"WITH {DOC_HASHES}, {SAME}, {_rounds(3)} SELECT fid, hash, samelen FROM r3",
        "near_dup_members": f"""WITH {DOC_HASHES}, {SAME}, {_rounds(1)}, {_edges()}
            SELECT m3.rep AS rep_fid, d.fid FROM dh d JOIN same s USING (hash)
            JOIN m0 ON m0.fid = s.fid JOIN m1 ON m1.fid = m0.rep JOIN m2 ON m2.fid = m1.rep JOIN m3 ON m3.fid = m2.rep {SHORT}""",
        "member_string": f"""WITH {DOC_HASHES}, {SAME}, {MEMBERS} SELECT rep_fid, 0::BIGINT AS part,
            string_agg(fid, ',' ORDER BY fid) AS samefid FROM mem GROUP BY rep_fid""",
        "member_string_parts": f"""WITH {DOC_HASHES}, {SAME}, {MEMBERS},
            num AS (SELECT *, (row_number() OVER (PARTITION BY rep_fid ORDER BY fid) - 1) // 3 AS part FROM mem)
            SELECT rep_fid, part, string_agg(fid, ',' ORDER BY fid) AS samefid FROM num GROUP BY rep_fid, part""",
        "hash_matches": f"WITH {_DOC_KEY} SELECT fid, hash FROM dh WHERE {_near('dh.hash', 'junk', 1)}",
        "hash_matches_2_bits": f"WITH {_DOC_KEY} SELECT fid, hash FROM dh WHERE {_near('dh.hash', 'junk', 2)}",
        "hash_matches_3_bits": f"WITH {_DOC_KEY} SELECT fid, hash FROM dh WHERE {_near('dh.hash', 'junk', 3)}",
        "hash_matches_5_bits": f"WITH {_DOC_KEY} SELECT fid, hash FROM dh WHERE {_near('dh.hash', 'junk', 5)}",
        "hash_drop_3_bits": f"WITH {_DOC_KEY} SELECT fid, hash FROM dh WHERE NOT {_near('dh.hash', 'junk', 3)}",
        "hash_drop": f"WITH {_DOC_KEY} SELECT fid, hash FROM dh WHERE NOT {_near('dh.hash', 'junk', 1)}",
        "url_drop": f"WITH {PAGES}, st AS (SELECT fid, {site} AS furl FROM pg) SELECT fid, furl FROM st WHERE NOT ({urls.format('furl', 'furl')})",
        "short_drop": f"WITH {DOC_HASHES} SELECT fid, hash FROM dh WHERE hash <> -1",
        "title_drop": f"WITH {PAGES}, {TITLES} SELECT fid, ftitle FROM pg WHERE ftitle NOT IN (SELECT ftitle FROM shared)",
        "discard": f"""WITH {_DOC_KEY} SELECT fid, array_to_string(ws, ' ') AS words, hash
            FROM docs JOIN dw USING (fid) JOIN dh USING (fid) WHERE length(trim(fcontent)) > 1 AND hash <> -1
            AND NOT contains({site}, 'src1.') AND NOT contains({site}, '//src17') AND NOT {_near('dh.hash', 'junk', 1)}""",
        "discard_with_titles": f"""WITH {PAGES}, {_PAGE_WORDS}, {_hashes('ph', 'pw')}, {TITLES},
            junk AS (SELECT hash FROM pw JOIN ph USING (fid) WHERE ftitle IN (SELECT ftitle FROM shared))
            SELECT fid, array_to_string(ws, ' ') AS words, hash FROM pw JOIN ph USING (fid)
            WHERE hash <> -1 AND NOT ({urls.format(site, site)}) AND ftitle NOT IN (SELECT ftitle FROM shared)
            AND NOT {_near('ph.hash', 'junk', 1)}""",
        "dup_report": f"""WITH {DOC_HASHES}, {SAME} SELECT fid, hash, samelen, furl, ftitle, fkeywords, fcontent
            FROM same JOIN docs USING (fid) WHERE samelen >= 2""",
        "dup_report_topics": f"""WITH {DOC_HASHES}, {SAME} SELECT fid, hash, samelen, {site} AS furl,
            {squash.format('ftitle')} AS ftitle, {squash.format('fkeywords')} AS fkeywords,
            {squash.format('fcontent')} AS fcontent, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS cat,
            toxic::DOUBLE AS prob FROM same JOIN docs USING (fid) JOIN labels ON doc_id = fid""",
        "normalized_category": f"WITH {ARTICLES} SELECT fid, {_NORM.format(c='fcategory')} AS cat FROM art",
        "mapped_category": f"WITH {TRAIN} SELECT fid, cat FROM mapped",
        "allowed_label": f"WITH {TRAIN} SELECT fid, cat, label FROM fitted",
        "parents_with_children": f"""WITH {TRAIN},
            every AS (SELECT DISTINCT replace(label, '_', ',') AS label FROM fitted UNION ALL SELECT label FROM lab)
            SELECT split_part(label, ',', 1) AS model FROM every GROUP BY 1 HAVING count(*) > 2 UNION ALL SELECT 'all'""",
        "label_parent": f"WITH {TRAIN} SELECT fid, regexp_replace(label, '^(.+)_[^_]*$', '\\1') AS parent FROM fitted",
        "topic_split": "WITH {}, x AS (SELECT fid, fcategory AS c FROM art) SELECT fid, {} AS pcat, {} AS ccat FROM x".format(
            ARTICLES, *_topic_split("c")
        ),
        "training_lines": f"WITH {LINES} SELECT model, label, text FROM lines",
        "label_counts": f"WITH {LABELLED} SELECT label, count(*) AS n FROM lb GROUP BY label",
        "fit_topic_weights": f"""WITH {FIT} SELECT model, label, word,
            round(ln(coalesce(n, 0) + 1.0) - den, 6)::DOUBLE AS log_weight, round(prior, 6)::DOUBLE AS prior
            FROM voc JOIN den USING (model) LEFT JOIN cnt USING (model, label, word)""",
        "parent_topics": f"WITH {PARENTS} SELECT fid, words, cat, prob FROM pc",
        "child_topics": f"WITH {CHILDREN} SELECT fid, words, cat, prob FROM cc",
        "child_topics_of_one": f"WITH {CHILDREN} SELECT fid, words, cc.cat, cc.prob FROM cc JOIN pc USING (fid, words) WHERE pc.cat = 'es'",
        "fallback_topics": f"""WITH {FIT}, fp AS (SELECT fid, fkeywords || 'zzz' AS words, 'all' AS model FROM docs),
            fc AS (SELECT fid, fkeywords || 'zzz' AS words, lang AS model FROM docs
                WHERE lang IN (SELECT model FROM lst WHERE model <> 'all')),
            {_score('xp', 'fp')}, {_score('xc', 'fc')}
            SELECT fid, cat, prob FROM xp UNION ALL SELECT fid, cat, prob FROM xc""",
        "external_topics": f"""WITH {DOC_WORDS},
            ein AS (SELECT fid, array_to_string(ws, ' ') AS words, 'all' AS model FROM dw), {_external('ep', 'ein')},
            ecin AS (SELECT fid, words, cat AS model FROM ep WHERE cat IN ('ain', 'aof')), {_external('ec', 'ecin')}
            SELECT fid, cat, prob FROM ep UNION ALL SELECT fid, cat, prob FROM ec""",
        "job_near_duplicates": f"""WITH {_JOB_HASHES}, {SAME}, {_rounds(1)}
            SELECT fid, hash, samelen, furl, ftitle, fkeywords, fcontent FROM r3 JOIN docs USING (fid) WHERE samelen >= 2""",
        "job_near_duplicate_members": f"""WITH {_JOB_HASHES}, {SAME}, {_rounds(1)}, {_edges()}
            SELECT m3.rep AS rep_fid, d.fid FROM dh d JOIN same s USING (hash)
            JOIN m0 ON m0.fid = s.fid JOIN m1 ON m1.fid = m0.rep JOIN m2 ON m2.fid = m1.rep JOIN m3 ON m3.fid = m2.rep {SHORT}""",
        "job_page_topics": f"{page_job} SELECT fid, words, cat, prob FROM jp",
        "job_page_topics_children": f"{page_job} SELECT fid, words, cat, prob FROM jc",
        "job_page_topics_report": f"""{page_job},
            same AS (SELECT hash, min(fid) AS fid, count(*)::BIGINT AS samelen FROM dh SEMI JOIN jin USING (fid) GROUP BY hash),
            {_rounds(1)} SELECT fid, hash, samelen, {site} AS furl, {squash.format('ftitle')} AS ftitle,
            {squash.format('fkeywords')} AS fkeywords, {squash.format('fcontent')} AS fcontent, cat, prob
            FROM r3 JOIN docs USING (fid) JOIN jc USING (fid) WHERE samelen >= 2""",
        "job_tagged_topics": f"""WITH {FIT}, gin AS (SELECT fid, array_to_string(list_filter({_words('fcontent')},
            lambda w: length(w) <= 2 OR left(lang, 1) NOT IN ('e', 'f')), ' ') AS words, 'all' AS model FROM docs),
            {_score('gp', 'gin')} SELECT fid, cat, prob FROM gp""",
        "predicted_labels": f"WITH {PARENTS} SELECT fid, cat FROM pc",
        "stacked_predictions": f"WITH {PREDICTIONS} SELECT fid, cat, prob FROM preds",
        "picked_topic": f"WITH {PREDICTIONS} SELECT fid, cat FROM picked",
        "editor_topics": f"WITH {ARTICLES}, {READS}, {EDITOR} SELECT fid, fcategory FROM ed",
        "article_topics": f"WITH {PREDICTIONS}, {EDITOR} SELECT fid, fcategory AS cat FROM ed UNION ALL SELECT fid, cat FROM picked",
        "article_topics_editor_only": f"WITH {ARTICLES}, {READS}, {EDITOR} SELECT fid, fcategory AS cat FROM ed",
        "user_reads": f"WITH {READS} SELECT imei, fid, sumcnt FROM rd",
        "distinct_reads": f"WITH {READS} SELECT DISTINCT fid FROM rd WHERE fid IS NOT NULL",
        "reads_with_topics": f"WITH {ARTICLES}, {READS}, {EDITOR} SELECT imei, fcategory AS cat, sumcnt AS cnt FROM rd JOIN ed USING (fid)",
        "clicks_union": f"WITH {_EDITOR_EVENTS} SELECT imei, cat, cnt FROM ev",
        "user_topic_counts": f"WITH {_EDITOR_EVENTS} {_COUNTS}",
        "user_topic_counts_all": f"""WITH {PREDICTIONS}, {EDITOR}, {CLICKS},
            top AS (SELECT fid, fcategory AS cat FROM ed UNION ALL SELECT fid, cat FROM picked), {_EVENTS} {_COUNTS}""",
    }
    sql["class_filter_joined"] = sql["class_filter"]
    any_id = "SELECT nullif(fid % 7, 0) AS fid, {cols} FROM ({query}), (VALUES (1), (2)) twice(n)"
    sql["class_filter_any_id"] = any_id.format(cols="words", query=sql["class_filter"])
    sql["parent_topics_any_id"] = any_id.format(cols="words, cat, prob", query=sql["parent_topics"])
    sql["job_matching_pages"] = sql["hash_matches"]
    sql["job_training_data"] = sql["label_counts"]
    sql["job_user_topics"] = sql["user_topic_counts_all"]
    sql["job_user_topics_full"] = sql["user_topic_counts_all"]
    sql["url_drop_joined"] = sql["url_drop"]
    sql["title_drop_long_list"] = sql["title_drop"]
    sql["dup_report_long_list"] = sql["dup_report"]
    return sql
