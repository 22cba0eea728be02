"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from .licenses import BASE, BASE_SCORE, TEMPLATES

# the blanks that end a word, and A-Z lower-cased alone
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _values(rows) -> str:
    return ", ".join(f"({', '.join(repr(v) for v in r)})" for r in rows)


# every template word by word; the key phrases as word lists with the place of their first word in the template
_NOTICES = _values((name, label, text) for name, label, text, _ in TEMPLATES)
_PHRASES = _values((name, ph, len((" " + text).split(" " + ph)[0].split())) for name, _, text, phrases in TEMPLATES for ph in phrases)


SQL = {
    "op11_license_scan": f"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r,
                   regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        word AS (SELECT r, unnest(range(len(w))) AS pos, unnest(w) AS word FROM d),
        b(phrase, label) AS (VALUES {_values(BASE)}),
        place AS (
            SELECT word.r, word.pos, b.label FROM word JOIN b ON word.word = split_part(b.phrase, ' ', 1) JOIN d ON d.r = word.r
            WHERE d.w[word.pos + 1 : word.pos + len(string_split(b.phrase, ' '))] = string_split(b.phrase, ' ')),
        base AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM place GROUP BY r),
        notice(template, label, body) AS (VALUES {_NOTICES}),
        tw AS (SELECT template, label, unnest(string_split(body, ' ')) AS word, unnest(range(len(string_split(body, ' ')))) AS t FROM notice),
        df AS (SELECT word, count(DISTINCT r) AS df FROM word WHERE word IN (SELECT word FROM tw) GROUP BY word),
        tdf AS (SELECT tw.*, coalesce(df, 0) AS df FROM tw LEFT JOIN df USING (word)),
        ph(template, phrase, first) AS (VALUES {_PHRASES}),
        rare AS (
            SELECT template, label, t, word FROM (
                SELECT *, dense_rank() OVER (PARTITION BY template ORDER BY df, length(word) DESC, word) AS k FROM tdf) WHERE k <= 4
            UNION
            SELECT template, label, t, word FROM (
                SELECT tdf.*, row_number() OVER (PARTITION BY ph.template, ph.phrase ORDER BY df, length(word) DESC, word, t) AS k
                FROM tdf JOIN ph ON ph.template = tdf.template AND t >= first AND t < first + len(string_split(phrase, ' '))) WHERE k = 1),
        places AS (SELECT template, count(DISTINCT t) AS places FROM rare GROUP BY template),
        vote AS (
            SELECT r, template, label, pos - t AS start, count(DISTINCT t) AS votes
            FROM word JOIN rare USING (word) GROUP BY ALL),
        found AS (
            SELECT v.r, v.label, votes / places AS score
            FROM vote v JOIN places p USING (template) JOIN d ON d.r = v.r
            WHERE votes >= least(3, places) AND NOT EXISTS (
                SELECT 1 FROM ph WHERE ph.template = v.template AND (v.start + first < 0 OR
                    d.w[v.start + first + 1 : v.start + first + len(string_split(phrase, ' '))] <> string_split(phrase, ' ')))),
        more AS (SELECT r, list(DISTINCT label) AS labels, max(score) AS score FROM found GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
               array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
               greatest(coalesce(more.score, 0), CASE WHEN n > 0 THEN {BASE_SCORE} ELSE 0 END)::DOUBLE AS score
        FROM d LEFT JOIN base ON base.r = d.r LEFT JOIN more ON more.r = d.r""",
    "op12_source_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        occ AS (
            SELECT r, lang, source, unnest(regexp_extract_all({_lower("text")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS lang_count FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
        grp AS (SELECT DISTINCT lang, source FROM d),
        cnt AS (
            SELECT g.lang, g.source, k.term, k.lang_count, coalesce(c.n, 0) AS n
            FROM grp g JOIN kept k ON g.lang = k.lang
            LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM occ GROUP BY ALL) c
                   ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        tot AS (
            SELECT *, sum(n) OVER (PARTITION BY lang, source) AS big_n, count(*) OVER (PARTITION BY lang, source) AS v,
                   sum(lang_count) OVER (PARTITION BY lang, source) AS lang_n FROM cnt),
        p AS (
            SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 5)) // (big_n + 5 * v)::HUGEINT)::BIGINT AS p,
                   (1 + (1000000000::HUGEINT * (lang_count + 5)) // (lang_n + 5 * v)::HUGEINT)::BIGINT AS q FROM tot),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                             WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
            FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, ''))::BLOB AS payload FROM pages),
        k AS (SELECT html, min(page_id) AS keeper FROM p GROUP BY html)
        SELECT p.page_id, octet_length(payload) AS payload_bytes,
               list_aggregate([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          ((('0x' || substr(sha1(payload), 1 + 5 * (i // 4), 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::INTEGER + 1, 1)
                   FOR i IN range(32)], 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keeper THEN keeper END AS refers_to
        FROM p JOIN k ON p.html = k.html""",
    "op7_exact_topk": """
        WITH v AS (
            SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
            FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op4_line_dedup": f"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        line AS (
            SELECT doc_id, pos, lines[pos] AS line, {_lower(f"trim(lines[pos], {_SPACE})")} AS k
            FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM split)),
        rep AS (
            SELECT k, min(doc_id) AS keeper FROM line WHERE length(k) >= 10
            GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
        SELECT l.doc_id, count(*) AS n_lines,
               count(*) FILTER (r.k IS NOT NULL AND l.doc_id <> r.keeper) AS n_dropped,
               sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
                   FILTER (r.k IS NULL OR l.doc_id = r.keeper), '')) AS kept_sha256
        FROM line l LEFT JOIN rep r ON l.k = r.k GROUP BY l.doc_id""",
}
