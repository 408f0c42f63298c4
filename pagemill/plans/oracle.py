"""ANSI SQL with the same result as each registered query, for DuckDB."""

from __future__ import annotations

_WS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_NOT_WS = _WS.replace("[", "[^", 1)
_URL = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_WS}+|{_WS}+\\z', '', 'g')"


def _tidy(text: str) -> str:
    return _strip(f"regexp_replace({text}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def _part(url: str, group: int) -> str:
    return f"regexp_extract({url}, '{_URL}', {group})"


def _unescape(text: str, end: str = ";?") -> str:
    """The character names of the pages. In text the semicolon may be missing."""
    for entity, char in (
        ("quot", "'\"'"),
        ("copy", "chr(169)"),
        ("middot", "chr(183)"),
        ("lt", "'<'"),
        ("gt", "'>'"),
        ("amp", "'&'"),
    ):
        text = f"regexp_replace({text}, '&{entity}{end}', {char}, 'g')"
    return text


_SITE = f"lower({_part('url', 1)}) || '://' || {_part('url', 2)}"
_DEFRAG = "split_part(url, '#', 1)"

_CTES = {
    "entries": """entries AS (
        SELECT 'https://example.com/d/' || CAST(doc_id // 2 AS VARCHAR) AS url,
               CASE WHEN doc_id % 6 = 0 THEN '' ELSE source || ' ' || CAST(doc_id AS VARCHAR) END AS title,
               text,
               CASE WHEN doc_id % 7 = 0 THEN NULL
                    WHEN doc_id % 5 = 0 THEN CAST([] AS VARCHAR[])
                    ELSE [lang, source] END AS categories,
               doc_id AS ord
        FROM documents)""",
    "curated": f"""curated AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord) AS rn FROM entries)
        WHERE rn = 1 AND length({_strip('text')}) >= 100)""",
    "pairs": r"""pairs AS (
        SELECT url,
               'Kategori: ' || CASE WHEN len(categories) > 0 THEN array_to_string(categories, ', ')
                                    ELSE 'Allmänt' END
                 || chr(10) || 'Titel: ' || title || chr(10) || chr(10) || 'Skriv text:' AS prompt,
               ' ' || text AS completion,
               md5('42:' || url) AS h
        FROM curated)""",
    "split": """split AS (
        SELECT *, CASE WHEN row_number() OVER (ORDER BY h, url)
                            <= CAST(floor(count(*) OVER () * (1 - CAST(0.1 AS DOUBLE))) AS BIGINT)
                       THEN 'train' ELSE 'val' END AS split
        FROM pairs)""",
    # Hrefs outside of comments, scripts and styles, in document order.
    "hrefs": f"""hrefs AS (
        SELECT page_id, url, generate_subscripts(h, 1) - 1 AS pos, {_unescape('unnest(h)', ';')} AS href
        FROM (SELECT page_id, url,
                     regexp_extract_all(
                         regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
                         '<a href="([^"]*)"', 1) AS h
              FROM pages))""",
    "links": f"""links AS (
        SELECT page_id, url AS src_url,
               row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) - 1 AS pos, link AS url
        FROM (SELECT page_id, url, pos, {_SITE} || split_part(href, '#', 1) AS link FROM hrefs)
        GROUP BY page_id, url, link)""",
    "articles": f"""articles AS (
        SELECT page_id, url,
               {_strip(_unescape("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS title,
               {_tidy('''array_to_string(list_filter(list_transform(
                   string_split(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1),
                                               '<[^>]*>', chr(1), 'g'), chr(1)),
                   lambda x: ''' + _strip(_unescape('x')) + '''), lambda x: x <> ''), chr(10))''')} AS text
        FROM pages)""",
    "doc_pages": f"""doc_pages AS (
        SELECT doc_id, source || lang AS title,
               {_tidy("CASE WHEN " + _strip('text') + " = '' THEN '' ELSE " + _strip('text') + " || chr(10) END || 'tail'")} AS text,
               lang || '|' || source AS categories
        FROM documents)""",
    "fetched": """fetched AS (
        SELECT *, CASE WHEN page_id % 11 = 3 THEN 404 ELSE 200 END AS status,
               CASE WHEN page_id % 13 = 5 THEN 'application/pdf'
                    ELSE 'text/html; charset=utf-8' END AS content_type
        FROM pages)""",
    "visited": f"""visited AS (
        SELECT {_DEFRAG} AS url FROM pages
        WHERE page_id < (SELECT (max(page_id) + 1) // 2 FROM pages))""",
    "queued": f"""queued AS (
        SELECT {_DEFRAG} AS url, CAST(0 AS BIGINT) AS depth, page_id AS src_ord,
               CAST(0 AS BIGINT) AS pos FROM pages)""",
    "resumed": """resumed AS (
        SELECT * FROM (
            SELECT url, depth, src_ord, pos FROM (
                SELECT *, row_number() OVER (PARTITION BY url ORDER BY depth, src_ord, pos) AS rn
                FROM queued) WHERE rn = 1
            UNION ALL
            SELECT 'https://example.com/', 0, -1, 0)
        WHERE url NOT IN (SELECT url FROM visited))""",
    "outcomes": f"""outcomes AS (
        SELECT *, CASE WHEN outcome = 'OK' THEN substring(title, 1, 60) END AS title_preview
        FROM (SELECT f.url, a.title,
                     CASE WHEN status >= 400 THEN 'ERROR'
                          WHEN NOT contains(content_type, 'text/html') THEN 'NON_HTML'
                          WHEN NOT regexp_matches({_part('f.url', 3)}, '^/\\w+/\\d+/?\\z') THEN 'CRAWL'
                          WHEN a.title = '' OR length(a.text) < 1500 THEN 'SKIP'
                          ELSE 'OK' END AS outcome
              FROM fetched f JOIN articles a USING (page_id)))""",
    "edges": """edges AS (
        SELECT i.page_id AS src, t.pos, t.dst
        FROM pages i, LATERAL (VALUES (0, 2 * i.page_id + 1), (1, 2 * i.page_id + 2),
                                      (2, i.page_id // 3)) AS t(pos, dst)
        WHERE t.dst IN (SELECT page_id FROM pages))""",
    # Breadth first: a level is ranked by its parents' rank, then by link position.
    "bfs": """bfs(node, depth, ord, parent) USING KEY (node) AS (
        SELECT CAST(3 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(-1 AS BIGINT)
        UNION
        SELECT node, depth, row_number() OVER (ORDER BY parent_ord, pos), parent
        FROM (SELECT e.dst AS node, b.depth + 1 AS depth, b.ord AS parent_ord, e.pos, b.node AS parent,
                     row_number() OVER (PARTITION BY e.dst ORDER BY b.ord, e.pos) AS rn
              FROM bfs b JOIN edges e ON e.src = b.node
              WHERE e.dst NOT IN (SELECT node FROM recurring.bfs))
        WHERE rn = 1)""",
    "ranked": """ranked AS (
        SELECT *, row_number() OVER (ORDER BY depth, ord) AS visit_rank FROM bfs)""",
    # A failed or missing page has no links.
    "site_edges": """site_edges AS (
        SELECT i.doc_id AS src, t.pos, t.dst
        FROM documents i, LATERAL (VALUES (0, 2 * i.doc_id + 1), (1, 2 * i.doc_id + 2),
                                          (2, i.doc_id // 3)) AS t(pos, dst)
        WHERE i.doc_id % 9 <> 8)""",
    "site_bfs": """site_bfs(node, depth, ord, parent) USING KEY (node) AS (
        SELECT CAST(3 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(-1 AS BIGINT)
        UNION
        SELECT node, depth, row_number() OVER (ORDER BY parent_ord, pos), parent
        FROM (SELECT e.dst AS node, b.depth + 1 AS depth, b.ord AS parent_ord, e.pos, b.node AS parent,
                     row_number() OVER (PARTITION BY e.dst ORDER BY b.ord, e.pos) AS rn
              FROM site_bfs b JOIN site_edges e ON e.src = b.node
              WHERE e.dst NOT IN (SELECT node FROM recurring.site_bfs))
        WHERE rn = 1)""",
    "site_rows": f"""site_rows AS (
        SELECT 'https://example.com' || CASE WHEN node % 4 = 0 THEN '/list/' || CAST(node AS VARCHAR)
                                             ELSE '/d/' || CAST(node AS VARCHAR) || '/x' END AS url,
               node, depth, parent, row_number() OVER (ORDER BY depth, ord) AS visit_rank,
               CASE WHEN d.doc_id IS NULL OR node % 9 = 8 THEN 'ERROR'
                    WHEN node % 4 = 0 THEN 'CRAWL'
                    WHEN length({_tidy('d.text')}) < 50 THEN 'SKIP' ELSE 'OK' END AS found,
               d.source AS title, {_tidy('d.text')} AS text, d.lang AS categories
        FROM site_bfs LEFT JOIN documents d ON d.doc_id = node)""",
    "arrived": f"""arrived AS (
        SELECT page_id FROM (
            SELECT page_id, row_number() OVER (
                       PARTITION BY {_DEFRAG}
                       ORDER BY CASE WHEN page_id % 3 < 2 THEN 0 ELSE 1 END, page_id) AS rn
            FROM pages)
        WHERE rn = 1)""",
    "delivered": f"""delivered AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (
                       PARTITION BY url ORDER BY CASE WHEN ord % 5 < 3 THEN 0 ELSE 1 END, ord) AS rn
            FROM entries)
        WHERE rn = 1)""",
}


def _sql(ctes: str, body: str) -> str:
    names = ctes.split()
    recursive = "RECURSIVE " if any(name.endswith("bfs") for name in names) else ""
    head = ",\n".join(_CTES[name] for name in names)
    return f"WITH {recursive}{head}\n{body}" if names else body


_FLAT = "title, text, array_to_string(categories, '|') AS categories"
_EXTRA_HREFS = "'#top', 'javascript:x', 'mailto:a@b.c', 'tel:1', 'JAVASCRIPT:x', '/ok'"
_DIR = f"regexp_extract({_part('url', 3)}, '(?s)^(.*/)[^/]*\\z', 1)"
_QUERY = f"CASE WHEN {_part('url', 4)} <> '' THEN '?' || {_part('url', 4)} ELSE '' END"

ORACLES: dict[str, str] = {
    "strip_text": _sql("", f"""
        SELECT doc_id, t AS text, length(t) AS chars
        FROM (SELECT doc_id, {_strip("' ' || chr(28) || ' ' || chr(9) || text || chr(12288) || chr(10) || chr(133)")} AS t
              FROM documents)"""),
    "collapse_newlines": _sql("", f"""
        SELECT doc_id, {_tidy("replace(text, '. ', repeat(chr(10), 4))")} AS text FROM documents"""),
    "token_cap": _sql("", f"""
        SELECT doc_id, len(pieces) AS n_tokens,
               CASE WHEN len(pieces) <= 512 THEN text
                    ELSE regexp_replace(regexp_extract(text, '^{_WS}+') || array_to_string(pieces[1:512], ''),
                                        '{_WS}+\\z', '') END AS text
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{_NOT_WS}+{_WS}*') AS pieces FROM documents)"""),
    "dedup_first_wins": _sql("entries curated", f"SELECT url, ord, {_FLAT} FROM curated"),
    "min_length": _sql("entries", f"""
        SELECT ord, url, text FROM entries WHERE length({_strip('text')}) >= 100"""),
    "category_label": _sql("entries", """
        SELECT ord, CASE WHEN len(categories) > 0 THEN array_to_string(categories, ', ')
                         ELSE 'Allmänt' END AS category FROM entries"""),
    "training_pairs": _sql("entries curated pairs", "SELECT url, prompt, completion FROM pairs"),
    "generation_prompts": _sql("entries", """
        SELECT ord, 'Kategori: ' || CASE WHEN len(categories) > 0 THEN array_to_string(categories, ', ')
                                         ELSE 'Allmänt' END
               || CASE WHEN title <> '' THEN chr(10) || 'Titel: ' || title ELSE '' END
               || chr(10) || chr(10) || 'Skriv text:' AS prompt
        FROM entries"""),
    "chat_render": _sql("entries curated pairs", f"""
        SELECT '<|begin_of_text|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10)
               || prompt || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>'
               || chr(10) || chr(10) || {_strip('completion')} || '<|eot_id|>' AS text
        FROM pairs"""),
    "chat_messages": _sql("", """
        SELECT conv_id, turn, CAST(1 AS BIGINT) AS n_messages, role, text AS content,
               '<|begin_of_text|><|start_header_id|>' || role || '<|end_header_id|>'
               || chr(10) || chr(10) || text
               || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>'
               || chr(10) || chr(10) AS rendered
        FROM conversations"""),
    "seeded_order": _sql("entries curated pairs", """
        SELECT url, row_number() OVER (ORDER BY h, url) - 1 AS position, prompt FROM pairs"""),
    "train_val_split": _sql("entries curated pairs split", """
        SELECT url, prompt, completion, split FROM split"""),
    "sample_pair": _sql("entries curated pairs split", """
        SELECT prompt, completion, split FROM split
        ORDER BY CASE split WHEN 'train' THEN 0 ELSE 1 END, h, url LIMIT 1"""),
    "prep_summary": _sql("entries curated pairs split", """
        SELECT (SELECT count(DISTINCT source) FROM documents) AS files,
               (SELECT count(*) FROM documents) AS records,
               count(*) FILTER (split = 'train') AS train,
               count(*) FILTER (split = 'val') AS val,
               count(*) AS entries, count(*) < 10 AS few_entries
        FROM split"""),
    "jsonl_scan": _sql("entries", f"""
        SELECT url, {_FLAT} FROM (
            SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS rn FROM entries)
        WHERE rn = 1 AND length({_strip('text')}) >= 100"""),
    "jsonl_rejects": _sql("entries", """
        SELECT CASE WHEN ord % 10 IN (3, 7) THEN 'bad' ELSE 'good' END AS kind,
               CASE WHEN ord % 10 = 3 THEN '{"url": ' || CAST(ord AS VARCHAR)
                    WHEN ord % 20 = 7 THEN '{},{}' || CAST(ord AS VARCHAR)
                    WHEN ord % 20 = 17 THEN '{} {}' || CAST(ord AS VARCHAR) ELSE text END AS value
        FROM entries"""),
    "dataset_roundtrip": _sql("entries", f"SELECT url, {_FLAT} FROM entries"),
    "pairs_read": _sql("entries curated pairs", "SELECT prompt, completion FROM pairs"),
    "split_sink": _sql("entries curated pairs split", "SELECT prompt, completion, split FROM split"),
    "prepared_files": _sql("entries curated pairs split", """
        SELECT row_number() OVER (ORDER BY split, h, url) - 1 AS position, split, prompt, completion FROM split"""),
    "training_text": _sql("entries curated pairs split", f"""
        SELECT c AS "case", CASE c WHEN 'alone' THEN 'train' ELSE split END AS split, len(pieces) AS n_tokens,
               CASE WHEN len(pieces) <= 120 THEN text
                    ELSE regexp_replace(array_to_string(pieces[1:120], ''), '{_WS}+\\z', '') END AS text
        FROM (SELECT *, regexp_extract_all(text, '{_NOT_WS}+{_WS}*') AS pieces
              FROM (SELECT split, unnest(CASE split WHEN 'val' THEN ['both', 'alone'] ELSE ['both'] END) AS c,
                           '<|begin_of_text|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10)
                           || prompt || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>'
                           || chr(10) || chr(10) || {_strip('completion')} || '<|eot_id|>' AS text
                    FROM split))"""),
    "url_parts": _sql("", f"""
        SELECT page_id, lower({_part('url', 1)}) AS scheme, {_part('url', 2)} AS netloc,
               {_part('url', 3)} AS path FROM pages"""),
    "url_defrag": _sql("", f"SELECT page_id, {_DEFRAG} AS url FROM pages"),
    "path_pattern": _sql("", f"""
        SELECT page_id, regexp_matches({_part('url', 3)}, '^/\\w+/\\d+') AS matches,
               regexp_matches({_part('url', 3)}, '^/\\w+/\\d+/\\S+/?\\z') AS matches_default
        FROM pages"""),
    "url_slug": _sql("", f"""
        SELECT page_id, url, CASE WHEN slug = '' THEN 'index' ELSE slug END AS slug
        FROM (SELECT page_id, url,
                     regexp_replace(lower(trim({_part('url', 3)}, '/')), '[^a-z0-9]+', '-', 'g') AS slug
              FROM (SELECT page_id, url FROM pages
                    UNION ALL SELECT page_id, {_SITE} FROM pages))"""),
    "href_filter": _sql("hrefs", f"""
        SELECT page_id, pos, href
        FROM (SELECT page_id, pos, href FROM hrefs
              UNION ALL
              SELECT p.page_id, coalesce(n, 0) + i, x
              FROM (SELECT page_id, unnest([{_EXTRA_HREFS}]) AS x, generate_subscripts([{_EXTRA_HREFS}], 1) - 1 AS i
                    FROM pages) p
              LEFT JOIN (SELECT page_id, count(*) AS n FROM hrefs GROUP BY page_id) USING (page_id))
        WHERE NOT (starts_with(href, '#') OR starts_with(href, 'javascript:')
                   OR starts_with(href, 'mailto:') OR starts_with(href, 'tel:'))"""),
    "resolve_links": _sql("hrefs", f"""
        SELECT page_id, pos, {_SITE} || split_part(href, '#', 1) AS url FROM hrefs"""),
    "resolve_relative": _sql("", f"""
        SELECT page_id, unnest(['', '#x', '?q=1', 'next', './next', '../up/', '../../../top',
                                '//cdn.example.org/a/../b', 'https://other.example/x#y', '/r/./s/../t']) AS href,
               unnest([{_SITE} || {_part('url', 3)} || {_QUERY},
                       {_SITE} || {_part('url', 3)} || {_QUERY},
                       {_SITE} || {_part('url', 3)} || '?q=1',
                       {_SITE} || {_DIR} || 'next',
                       {_SITE} || {_DIR} || 'next',
                       {_SITE} || regexp_replace({_DIR}, '[^/]+/\\z', '') || 'up/',
                       {_SITE} || '/top',
                       lower({_part('url', 1)}) || '://cdn.example.org/a/../b',
                       'https://other.example/x' || '',
                       {_SITE} || '/r/t']) AS url
        FROM pages"""),
    "same_domain": _sql("hrefs", f"""
        SELECT page_id, pos, {_SITE} || split_part(href, '#', 1) AS url FROM hrefs
        UNION ALL
        SELECT p.page_id, coalesce(n, 0) + 1, 'ftp://' || {_part('url', 2)} || '/x'
        FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n FROM hrefs GROUP BY page_id) USING (page_id)"""),
    "page_source": _sql("fetched", """
        SELECT url, html FROM fetched WHERE status < 400 AND contains(content_type, 'text/html')"""),
    "html_title": _sql("articles", "SELECT page_id, title FROM articles"),
    "html_text": _sql("articles", "SELECT page_id, text FROM articles"),
    "html_categories": _sql("doc_pages", """
        SELECT doc_id, categories, CAST(2 AS BIGINT) AS n FROM doc_pages"""),
    "html_roundtrip": _sql("doc_pages", """
        SELECT doc_id, title, text, categories FROM doc_pages WHERE length(text) >= 50"""),
    "extract_pages": _sql("articles", """
        SELECT page_id, url, title, text, '' AS categories FROM articles
        WHERE title <> '' AND length(text) >= 50"""),
    "extract_reject": _sql("doc_pages", """
        SELECT doc_id, CASE WHEN doc_id % 10 = 1 THEN 'no_title' WHEN doc_id % 10 = 2 THEN 'no_content'
                            WHEN length(text) < 50 THEN 'short_text' ELSE 'kept' END AS reject
        FROM doc_pages"""),
    "extract_links": _sql("hrefs links", "SELECT src_url, pos, url FROM links"),
    "page_outcomes": _sql("fetched articles outcomes", """
        SELECT url, outcome, title_preview FROM outcomes"""),
    "outcome_counts": _sql("fetched articles outcomes", """
        SELECT outcome, count(*) AS pages FROM outcomes GROUP BY outcome"""),
    "page_upsert": _sql("", f"""
        SELECT host, slug, page_id, url, chars FROM (
            SELECT *, row_number() OVER (PARTITION BY host, slug ORDER BY page_id DESC) AS rn
            FROM (SELECT page_id, url, length(html) AS chars, {_part('url', 2)} AS host,
                         regexp_replace(lower(trim({_part('url', 3)}, '/')), '[^a-z0-9]+', '-', 'g') AS slug
                  FROM pages))
        WHERE rn = 1"""),
    "page_store": _sql("", f"""
        SELECT slug, url, seq, batch, digest FROM (
            SELECT *, row_number() OVER (PARTITION BY slug ORDER BY batch DESC, seq DESC) AS rn
            FROM (SELECT 'https://example.com' || {_part('url', 3)} AS url, page_id AS seq,
                         CAST(CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch,
                         md5(html) AS digest,
                         regexp_replace(lower(trim({_part('url', 3)}, '/')), '[^a-z0-9]+', '-', 'g') AS slug
                  FROM pages))
        WHERE rn = 1"""),
    "visit_gate": _sql("hrefs links visited queued", """
        SELECT DISTINCT url FROM (SELECT url FROM queued UNION ALL SELECT url FROM links)
        WHERE url NOT IN (SELECT url FROM visited)"""),
    "frontier_next": _sql("hrefs links visited queued", """
        SELECT url, depth, src_ord, pos FROM (
            SELECT *, row_number() OVER (PARTITION BY url ORDER BY fresh, depth, src_ord, pos) AS rn
            FROM (SELECT url, depth, src_ord, pos, 0 AS fresh FROM queued
                  UNION ALL SELECT url, 1, page_id, pos, 1 FROM links
                  UNION ALL SELECT url, 1, src_ord, pos, 1 FROM queued))
        WHERE rn = 1 AND url NOT IN (SELECT url FROM visited)"""),
    "resume_frontier": _sql("visited queued resumed", "SELECT url, depth, src_ord, pos FROM resumed"),
    "resume_counts": _sql("visited queued resumed", """
        SELECT (SELECT count(*) FROM visited) AS visited, (SELECT count(*) FROM resumed) AS queued"""),
    "crawl_state": _sql("hrefs links visited queued", """
        SELECT 'visited' AS kind, url FROM visited
        UNION ALL SELECT 'visited', url FROM queued WHERE url NOT IN (SELECT url FROM visited)
        UNION ALL SELECT 'queued', url FROM links"""),
    "frontier_batch": _sql("hrefs links", """
        SELECT url, CAST(1 AS BIGINT) AS depth, page_id AS src_ord, pos FROM links
        ORDER BY page_id, pos LIMIT 40"""),
    "crawl_reachable": _sql("edges bfs ranked", """
        SELECT CAST(node AS VARCHAR) AS url, depth, visit_rank FROM ranked"""),
    "crawl_capped": _sql("edges bfs ranked", """
        SELECT CAST(r.node AS VARCHAR) AS url, r.depth, r.visit_rank, r.visit_rank <= 40 AS visited
        FROM ranked r LEFT JOIN ranked p ON p.node = r.parent
        WHERE r.visit_rank <= 40 OR p.visit_rank <= 40"""),
    "crawl_site": _sql("site_edges site_bfs site_rows", """
        SELECT url, depth, visit_rank, found AS outcome,
               CASE WHEN found = 'OK' THEN title END AS title,
               CASE WHEN found = 'OK' THEN text END AS text,
               CASE WHEN found = 'OK' THEN categories END AS categories
        FROM site_rows"""),
    "crawl_site_capped": _sql("site_edges site_bfs site_rows", """
        SELECT url, depth, visit_rank, outcome,
               CASE WHEN outcome = 'OK' THEN title END AS title,
               CASE WHEN outcome = 'OK' THEN text END AS text,
               CASE WHEN outcome = 'OK' THEN categories END AS categories
        FROM (SELECT r.*, CASE WHEN r.visit_rank > 100 THEN 'QUEUED' ELSE r.found END AS outcome
              FROM site_rows r LEFT JOIN site_rows p ON p.node = r.parent
              WHERE r.visit_rank <= 100 OR p.visit_rank <= 100)"""),
    "crawl_links_resumed": _sql("edges bfs ranked", """
        SELECT CAST(r.node AS VARCHAR) AS url,
               CASE WHEN r.visit_rank > n THEN r.depth END AS depth
        FROM ranked r LEFT JOIN ranked p ON p.node = r.parent, (SELECT 2 * (count(*) // 4) AS n FROM pages)
        WHERE r.visit_rank <= n OR p.visit_rank <= n"""),
    "stream_ingest": _sql("entries delivered", f"""
        SELECT url, {_FLAT} FROM delivered WHERE length({_strip('text')}) >= 100"""),
    "stream_resume": _sql("entries delivered", f"""
        SELECT url, CAST(CASE WHEN ord % 5 < 3 THEN 1 ELSE 2 END AS BIGINT) AS run, {_FLAT} FROM delivered"""),
    "stream_crawl": _sql("hrefs links articles arrived fetched", f"""
        SELECT url, outcome, CASE WHEN outcome = 'OK' THEN title END AS title,
               CASE WHEN outcome = 'OK' THEN md5(text) END AS digest,
               CASE WHEN outcome = 'OK' THEN '' END AS categories
        FROM (SELECT {_DEFRAG.replace('url', 'a.url')} AS url, title, text,
                     CASE WHEN status >= 400 THEN 'ERROR'
                          WHEN NOT contains(content_type, 'text/html') THEN 'NON_HTML'
                          WHEN NOT regexp_matches({_part('a.url', 3)}, '^/\\w+/\\d+/?\\z') THEN 'CRAWL'
                          WHEN title = '' OR length(text) < 50 THEN 'SKIP' ELSE 'OK' END AS outcome
              FROM articles a JOIN fetched USING (page_id) WHERE page_id IN (SELECT page_id FROM arrived))
        UNION ALL
        SELECT DISTINCT url, 'QUEUED', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM links
        WHERE page_id IN (SELECT page_id FROM arrived)
              AND page_id IN (SELECT page_id FROM fetched WHERE status < 400 AND contains(content_type, 'text/html'))
              AND url NOT IN (SELECT {_DEFRAG} FROM pages)"""),
}
ORACLES["stream_report"] = _sql("hrefs links articles arrived fetched", f"""
    , judged AS (
        SELECT page_id, {_DEFRAG.replace('url', 'a.url')} AS url, CASE WHEN page_id % 3 < 2 THEN 1 ELSE 2 END AS run,
               CASE WHEN status >= 400 THEN 'ERROR'
                    WHEN NOT contains(content_type, 'text/html') THEN 'NON_HTML'
                    WHEN NOT regexp_matches({_part('a.url', 3)}, '^/\\w+/\\d+/?\\z') THEN 'CRAWL'
                    WHEN title = '' OR length(text) < 50 THEN 'SKIP' ELSE 'OK' END AS outcome
        FROM articles a JOIN fetched USING (page_id) WHERE page_id IN (SELECT page_id FROM arrived))
    SELECT CAST(r.run AS BIGINT) AS run,
           (SELECT count(*) FROM judged j WHERE j.run = r.run AND outcome = 'OK') AS ok,
           (SELECT count(*) FROM judged j WHERE j.run = r.run AND outcome = 'SKIP') AS skip,
           (SELECT count(*) FROM judged j WHERE j.run = r.run AND outcome = 'CRAWL') AS crawl,
           (SELECT count(*) FROM judged j WHERE j.run = r.run AND outcome = 'ERROR') AS error,
           (SELECT count(*) FROM judged j WHERE j.run = r.run AND outcome = 'NON_HTML') AS non_html,
           (SELECT count(*) FROM judged j WHERE j.run <= r.run) AS visited,
           (SELECT count(DISTINCT l.url) FROM links l JOIN judged j USING (page_id)
            WHERE j.run <= r.run AND outcome NOT IN ('ERROR', 'NON_HTML')
                  AND l.url NOT IN (SELECT v.url FROM judged v WHERE v.run <= r.run)) AS queued
    FROM (VALUES (1), (2)) AS r(run)""")
# Pairs that arrive in batches are split as they would be all at once.
ORACLES["split_growing"] = ORACLES["train_val_split"]
# A crawl in batches that go on until nothing is queued comes to the same rows.
ORACLES["crawl_resumed"] = ORACLES["crawl_site"]
