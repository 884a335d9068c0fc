"""The registered queries in DuckDB's SQL, over the same tables.

Written from the rules, not from the Spark plans: windows where Spark combines
minima, RE2 patterns where Spark uses possessive ones.
"""

from __future__ import annotations

from docloom.plans import inputs as inp
from docloom.plans import queries as q

# The whitespace class, its part that does not end a line, and the line ends.
W = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(values: tuple[str, ...], key: str) -> str:
    listed = ", ".join(lit(v) for v in values)
    return f"list_extract([{listed}], CAST({key} % {len(values)} AS INTEGER) + 1)"


def sub(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(expr: str) -> str:
    return sub(expr, rf"\A{W}+|{W}+\z", "")


STEPS = {
    "strip_code_fence": lambda c: sub(c, rf"(?m)^{W}*```.*$", ""),
    "strip_image": lambda c: sub(c, r"!\[([^\]]*)\]\([^)]*\)", r"\1"),
    "strip_link": lambda c: sub(c, r"\[([^\]]*)\]\([^)]*\)", r"\1"),
    "strip_html_tag": lambda c: sub(c, r"<[^>]+>", " "),
    "strip_heading": lambda c: sub(c, rf"(?m)^{W}{{0,3}}#{{1,6}}{W}+", ""),
    "strip_block_quote": lambda c: sub(c, rf"(?m)^{W}{{0,3}}>{W}?", ""),
    "strip_bullet": lambda c: sub(c, rf"(?m)^{W}{{0,3}}[-*+]{W}+", ""),
    "strip_emphasis": lambda c: sub(c, r"(\*\*|__|\*|_|`)", ""),
    "trim_line_ends": lambda c: sub(
        f"regexp_replace({c}, {lit(BREAK)}, chr(10), 'g')", r"(?m)[\t\x1f\x20\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]+$", ""
    ),
    "squeeze_blank_lines": lambda c: f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')",
    "strip_ends": strip,
}


def plain(expr: str) -> str:
    for step in STEPS.values():
        expr = step(expr)
    return expr


def _continues(hexed: str, byte_no: str) -> str:
    return f"substr({hexed}, CAST(2 * ({byte_no}) - 1 AS INTEGER), 1) IN ('8', '9', 'A', 'B')"


def clip(expr: str, n: str) -> str:
    """Longest prefix of at most n bytes that ends between characters."""
    h = f"hex(encode({expr}))"
    cut = (
        f"CASE WHEN NOT {_continues(h, f'{n} + 1')} THEN {n} "
        f"WHEN NOT {_continues(h, n)} THEN {n} - 1 "
        f"WHEN NOT {_continues(h, f'{n} - 1')} THEN {n} - 2 ELSE {n} - 3 END"
    )
    return (
        f"CASE WHEN strlen({expr}) <= {n} THEN {expr} "
        f"ELSE decode(unhex(left({h}, CAST(2 * ({cut}) AS INTEGER)))) END"
    )


def tail_text(expr: str, n: int) -> str:
    """Last n bytes; each orphaned continuation byte becomes one replacement mark."""
    h = f"right(hex(encode({expr})), {2 * n})"
    orphans = f"regexp_extract({h}, '^((?:[89AB][0-9A-F])*)', 1)"
    return (
        f"CASE WHEN strlen({expr}) <= {n} THEN {expr} ELSE "
        f"repeat(chr(65533), CAST(length({orphans}) / 2 AS INTEGER)) || "
        f"decode(unhex(substr({h}, length({orphans}) + 1))) END"
    )


FILE_NAME = f"lang || '/d' || doc_id || {pick(inp.EXTENSIONS, 'doc_id')}"
MARKDOWN = (
    "'# ' || source || chr(10) || chr(10) || '> ' || lang || chr(10) || chr(10) || '- **' || doc_id"
    " || '** [src](http://x/' || doc_id || ') ![pic' || doc_id || '](y)' || chr(10) || chr(10)"
    " || '```py' || chr(10) || 'x_1 = `a`' || chr(10) || '```' || chr(10) || chr(10)"
    " || '<table><tr><td>' || n_chars || '</td></tr></table>  ' || chr(13) || chr(10)"
    " || chr(10) || chr(10) || chr(10) || text"
)
ARCHIVE = f"source || '-' || (doc_id // {inp.ARCHIVE_BLOCK})"


def ext_of(name: str) -> str:
    return f"lower(regexp_extract({name}, '[^/](\\.[^./]+)$', 1))"


def preflight(name: str) -> tuple[str, str, str]:
    """Code, message and missing dependency of a file name, office unreadable."""
    ext = ext_of(name)
    core = "('.pdf','.png','.jpg','.jpeg','.bmp','.tif','.tiff','.webp')"
    arch = "('.zip','.tar','.tar.gz','.tgz','.tar.bz2','.tbz2','.tar.xz','.txz')"
    office = "('.docx','.pptx','.xlsx')"
    ok = f"({ext} IN {core} OR {ext} IN {arch})"
    code = f"CASE WHEN {ok} THEN NULL WHEN {ext} IN {office} THEN 'missing_dependency' ELSE 'unsupported_format' END"
    text = (
        f"CASE WHEN {ok} THEN NULL WHEN {ext} IN {office} THEN "
        "'office documents need a converter that this host does not have' "
        f"ELSE 'no reader for `' || CASE WHEN {ext} <> '' THEN {ext} ELSE regexp_extract({name}, '[^/]*$') END || '`' END"
    )
    missing = f"CASE WHEN NOT {ok} AND {ext} IN {office} THEN 'libreoffice' WHEN NOT {ok} THEN '' END"
    return code, text, missing


# --- intake -----------------------------------------------------------------

REQUESTS = f"""
requests0 AS (
  SELECT *, base64(encode(text)) AS enc FROM documents),
requests AS (
  SELECT doc_id AS request_id,
    CASE WHEN (doc_id % 2 = 1 OR doc_id % 50 = 0) AND doc_id % 77 <> 0 THEN
      CASE WHEN doc_id % 15 = 3 THEN '/data/src1/.././' || source || '/' || doc_id
           WHEN doc_id % 15 = 7 THEN '/data/' || source || '/../../etc/' || doc_id
           ELSE '/data/' || source || '/' || doc_id END END AS path,
    CASE WHEN doc_id % 15 = 7 THEN '/etc/' || doc_id
         ELSE '/data/' || source || '/' || doc_id END AS real_path,
    CASE WHEN doc_id % 2 = 0 AND doc_id % 77 <> 0 THEN
      CASE WHEN doc_id % 38 = 0 THEN left(enc, 5) || ' ' || substr(enc, 6)
           WHEN doc_id % 46 = 0 THEN rtrim(enc, '=') ELSE enc END END AS content_base64,
    CASE WHEN doc_id % 6 = 0 THEN 'C:\\in.dir\\' || {FILE_NAME}
         WHEN doc_id % 6 = 2 THEN 'noext' WHEN doc_id % 6 = 4 THEN {FILE_NAME} END AS filename,
    strlen(text) AS size, text, {FILE_NAME} AS file_name
  FROM requests0)"""

_STRICT = (
    "regexp_full_match(content_base64, "
    "'([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?')"
)
_INSIDE = "(" + " OR ".join(
    f"(real_path = {lit(r)} OR starts_with(real_path, {lit(r + '/')}))" for r in q.ROOTS
) + ")"


def intake_requests() -> str:
    shape = "a request needs either `path` or `content_base64`, and not both"
    roots = ", ".join(q.ROOTS)
    return f"""WITH {REQUESTS},
checked AS (SELECT request_id,
  CASE WHEN (path IS NOT NULL) = (content_base64 IS NOT NULL) THEN {lit(shape)} END AS shape,
  CASE WHEN content_base64 IS NOT NULL THEN
      CASE WHEN NOT {_STRICT} THEN '`content_base64` cannot be decoded'
           WHEN size > {q.MAX_INPUT} THEN 'sent content is ' || size || ' bytes, over the {q.MAX_INPUT}-byte limit' END
    WHEN path IS NULL THEN 'missing `path`'
    WHEN NOT {_INSIDE} THEN '`' || path || {lit(f"` is not under any allowed root ({roots})")}
    WHEN size > {q.MAX_INPUT} THEN 'input is ' || size || ' bytes, over the {q.MAX_INPUT}-byte limit' END AS rejected
  FROM requests)
SELECT request_id, shape IS NULL AND rejected IS NULL AS accepted,
  CASE WHEN shape IS NULL AND rejected IS NOT NULL THEN 'input_rejected' END AS error_code,
  coalesce(shape, rejected) AS error FROM checked"""


def inline_decode() -> str:
    return f"""WITH {REQUESTS},
inline AS (SELECT *, {_STRICT} AS valid FROM requests WHERE content_base64 IS NOT NULL)
SELECT request_id, valid, CASE WHEN valid THEN size END AS n_bytes,
  CASE WHEN valid THEN size END AS size_from_text,
  CASE WHEN request_id % 6 = 2 OR filename IS NULL THEN
         CASE WHEN filename IS NULL THEN '.pdf' ELSE '.pdf' END
       ELSE regexp_extract(file_name, '(\\.[^.]+)$', 1) END AS suffix,
  CASE WHEN valid THEN md5(text) END AS digest FROM inline"""


def root_confinement() -> str:
    return f"WITH {REQUESTS} SELECT request_id, real_path AS path FROM requests WHERE path IS NOT NULL AND {_INSIDE}"


def size_cap() -> str:
    return f"""SELECT doc_id, strlen(text) AS size, CASE WHEN strlen(text) > {q.CAP_BYTES}
  THEN 'input is ' || strlen(text) || ' bytes, over the {q.CAP_BYTES}-byte limit' END AS error FROM documents"""


def format_routing() -> str:
    code, text, missing = preflight("name")
    suffixes = "('.zip','.tar','.tar.gz','.tgz','.tar.bz2','.tbz2','.tar.xz','.txz')"
    return f"""WITH named AS (SELECT doc_id, {FILE_NAME} AS name FROM documents)
SELECT doc_id, name, {ext_of('name')} AS ext,
  regexp_replace(regexp_extract(name, '[^/]*$'), '\\.[^.]+$', '') AS stem,
  len(list_filter([{suffixes[1:-1]}], lambda s: ends_with(lower(name), s))) > 0 AS is_archive,
  CASE WHEN {ext_of('name')} IN ('.pdf','.png','.jpg','.jpeg','.bmp','.tif','.tiff','.webp') THEN 'core'
       WHEN {ext_of('name')} IN {suffixes} THEN 'archive'
       WHEN {ext_of('name')} IN ('.docx','.pptx','.xlsx') THEN 'office' END AS format_class,
  {code} AS error_code, {text} AS error, {missing} AS missing FROM named"""


# Cleaned options of each text in ``inputs.OPTION_TEXTS``, worked out by hand:
# backend, method, effort, lang, device, formula, table, start_page, end_page.
_CLEANED = """
  (0, 'pipeline', 'ocr', NULL, 'en', 'cpu', NULL, NULL, 0, 3),
  (1, 'vlm-engine', NULL, NULL, 'en', 'cpu', false, NULL, NULL, NULL),
  (2, 'hybrid-engine', 'auto', 'high', 'en', 'cpu', NULL, true, NULL, NULL),
  (3, 'pipeline', NULL, NULL, NULL, 'cpu', false, NULL, NULL, NULL),
  (4, 'pipeline', NULL, NULL, 'en', 'cuda:1', NULL, NULL, NULL, NULL),
  (5, 'pipeline', NULL, NULL, 'en', 'cpu', NULL, false, NULL, NULL),
  (6, 'pipeline', NULL, NULL, 'ch_server', NULL, false, false, NULL, NULL),
  (7, 'pipeline', NULL, NULL, 'en', 'cpu', NULL, true, 12, 1),
  (8, 'pipeline', NULL, NULL, 'en', 'cpu', true, true, NULL, NULL),
  (9, 'pipeline', NULL, NULL, 'en', 'cpu', NULL, NULL, NULL, NULL),
  (10, 'hybrid-http-client', NULL, 'medium', 'en', 'mps', true, NULL, NULL, NULL)"""


def option_cleanup() -> str:
    names = "opt_backend, opt_method, opt_effort, opt_lang, opt_device, opt_formula, opt_table, opt_start_page, opt_end_page"
    return f"""SELECT event_id, {names} FROM events JOIN (VALUES {_CLEANED}
  ) AS cleaned(variant_no, {names}) ON event_id % {len(inp.OPTION_TEXTS)} = variant_no"""


def outcome_typing() -> str:
    code, text, missing = preflight("name")
    base = "regexp_extract(name, '[^/]*$')"
    tail = f"right({strip('tail0')}, 800)"
    return f"""WITH named AS (SELECT *, {FILE_NAME} AS name, {tail_text('text', 4000)} AS tail0 FROM documents),
routed AS (SELECT *, {code} AS code, {text} AS msg, {missing} AS dep FROM named),
typed AS (SELECT *, CASE WHEN strlen(text) > {q.MAX_INPUT} THEN 'input_rejected' WHEN code IS NOT NULL THEN code
    WHEN doc_id % 23 = 1 THEN 'library_missing' WHEN doc_id % 19 = 1 THEN 'timeout'
    WHEN doc_id % 17 = 1 THEN 'exit' WHEN doc_id % 13 = 1 THEN 'empty' ELSE 'ok' END AS o FROM routed)
SELECT doc_id, CASE WHEN o IN ('exit', 'empty') THEN 'parse_failed' ELSE o END AS outcome,
  CASE WHEN o = 'input_rejected' THEN 'input is ' || strlen(text) || ' bytes, over the {q.MAX_INPUT}-byte limit'
       WHEN o = 'library_missing' THEN 'the parser is not installed'
       WHEN o = 'timeout' THEN 'the parse exceeded its time budget'
       WHEN o = 'exit' THEN 'the parser exited with code 2 on `' || {base} || '`'
            || CASE WHEN {tail} <> '' THEN ': ' || {tail} ELSE '' END
       WHEN o = 'empty' THEN 'the parser extracted no text from `' || {base} || '`'
       WHEN o <> 'ok' THEN msg END AS error,
  CASE WHEN o = 'ok' THEN NULL WHEN o = code THEN dep ELSE '' END AS missing FROM typed"""


# --- archives ---------------------------------------------------------------

ENTRIES = f"""
entries AS (SELECT *, {ARCHIVE} AS archive,
    row_number() OVER (PARTITION BY {ARCHIVE} ORDER BY doc_id) - 1 AS ordinal,
    CASE WHEN (doc_id // {inp.ARCHIVE_BLOCK}) % 2 = 0 THEN 'zip' ELSE 'tar' END AS container,
    CASE WHEN doc_id % 499 = 11 THEN 'symlink' WHEN doc_id % 83 = 1 THEN 'dir' ELSE 'file' END AS kind,
    {FILE_NAME} AS plain_name,
    CASE WHEN doc_id % 397 = 5 THEN '../' || {FILE_NAME} WHEN doc_id % 401 = 7 THEN '/' || {FILE_NAME}
         WHEN doc_id % 53 = 3 THEN './' || replace({FILE_NAME}, '/', '//') ELSE {FILE_NAME} END AS name
  FROM documents),
guarded AS (SELECT *, CASE
    WHEN doc_id % 397 = 5 THEN 'entry `' || name || '` leads out of its folder'
    WHEN doc_id % 401 = 7 THEN 'entry `' || name || '` starts at the root'
    WHEN kind = 'symlink' AND container = 'zip' THEN 'entry `' || name || '` is a symbolic link'
    WHEN kind = 'symlink' THEN 'entry `' || name || '` is a link to elsewhere' END AS member_error FROM entries)"""


def member_guard() -> str:
    return f"""WITH {ENTRIES} SELECT doc_id, archive,
  CASE WHEN doc_id % 397 = 5 THEN '../' || plain_name ELSE plain_name END AS relative,
  member_error AS error FROM guarded"""


def _caps(max_members: int, max_bytes: int) -> str:
    return f"""WITH {ENTRIES},
running AS (SELECT *, sum(CASE WHEN kind = 'file' THEN strlen(text) ELSE 0 END)
    OVER (PARTITION BY archive ORDER BY ordinal) AS used FROM guarded),
reasons AS (SELECT *, CASE
    WHEN container = 'tar' AND ordinal >= {max_members} THEN 'archive lists more than {max_members} members'
    WHEN member_error IS NOT NULL THEN member_error
    WHEN kind = 'file' AND used > {max_bytes} THEN 'archive unpacks beyond the {max_bytes}-byte limit' END AS reason
  FROM running),
summed AS (SELECT archive, any_value(container) AS container, count(*) AS n_entries,
    count(*) FILTER (kind = 'file') AS n_files,
    arg_min(reason, ordinal) FILTER (reason IS NOT NULL) AS reason FROM reasons GROUP BY archive),
said AS (SELECT *, CASE WHEN container = 'zip' AND n_entries > {max_members}
    THEN 'archive lists ' || n_entries || ' entries, over the {max_members} limit' ELSE reason END AS error FROM summed)
SELECT archive, container, n_entries, n_files,
  CASE WHEN error IS NOT NULL THEN 'input_rejected' END AS error_code, error FROM said"""


def repeated_names() -> str:
    return f"""WITH {ENTRIES} SELECT archive, ordinal, lang || '/page.pdf' AS name,
  md5(last_value(text) OVER (PARTITION BY archive, lang ORDER BY ordinal
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS digest FROM entries"""


PACKED = f"""{ENTRIES},
packed AS (SELECT *, '/data/' || archive || CASE container WHEN 'zip' THEN '.zip' ELSE '.tar.gz' END AS path FROM guarded)"""


def archive_expand() -> str:
    return f"""WITH {PACKED} SELECT path AS archive, container, ordinal,
  CASE WHEN kind = 'dir' AND container = 'zip' THEN name || '/' ELSE name END AS name, kind,
  CASE WHEN kind = 'file' OR (kind = 'symlink' AND container = 'zip') THEN strlen(text) ELSE 0 END AS declared_size,
  CASE WHEN kind = 'file' THEN md5(text) END AS digest, CAST(NULL AS VARCHAR) AS error FROM packed"""


def archive_ceiling() -> str:
    """The sizes of files up to and with this one decide whether it is read."""
    return f"""WITH {PACKED}, sized AS (SELECT *, sum(CASE WHEN kind = 'file' THEN strlen(text) ELSE 0 END)
    OVER (PARTITION BY path ORDER BY ordinal) AS used FROM packed)
SELECT path AS archive, ordinal, CASE WHEN kind = 'dir' AND container = 'zip' THEN name || '/' ELSE name END AS name,
  CASE WHEN kind = 'file' AND used <= {q.CEILING} THEN md5(text) END AS digest, CAST(NULL AS VARCHAR) AS error_code FROM sized"""


def _members() -> str:
    code, text, _ = preflight("name")
    return f"""
members0 AS (SELECT *, {ARCHIVE} AS archive, {FILE_NAME} AS name,
    CASE WHEN doc_id % 41 = 0 THEN '' ELSE {MARKDOWN} END AS markdown FROM documents),
members1 AS (SELECT *, {code} AS route, {text} AS route_error, {strip('markdown')} AS body FROM members0),
members AS (SELECT archive, name, body, string_split(name, '/') AS parts, doc_id % 4 AS pages,
    coalesce(route, CASE WHEN doc_id % 331 = 8 THEN 'timeout' END) AS code,
    coalesce(route_error, CASE WHEN doc_id % 331 = 8 THEN 'the parse exceeded its time budget' END) AS msg
  FROM members1)"""


def _assembled(budget: int, members: str | None = None) -> str:
    return f"""{members or _members()},
costed AS (SELECT *, code IS NULL AND body <> '' AS good,
    '# ' || name || chr(10) || chr(10) || body AS section FROM members),
walked AS (SELECT *, sum(CASE WHEN good THEN strlen(section) + 2 ELSE 0 END)
    OVER (PARTITION BY archive ORDER BY parts) <= {budget} AS reached FROM costed),
gathered AS (SELECT archive, count(*) AS n_members, count(*) FILTER (NOT reached) AS skipped,
    bool_or(reached AND coalesce(code = 'timeout', false)) AS late,
    coalesce(string_agg(section, chr(10) || chr(10) ORDER BY parts) FILTER (reached AND good), '') AS markdown,
    coalesce(string_agg(name, chr(10) ORDER BY parts) FILTER (reached AND good), '') AS sources,
    coalesce(string_agg(name || ': ' || coalesce(msg, 'parsed to an empty document'), chr(10) ORDER BY parts)
      FILTER (reached AND NOT good), '') AS notes,
    nullif(CAST(sum(pages) FILTER (reached AND good) AS BIGINT), 0) AS page_count FROM walked GROUP BY archive),
assembled AS (SELECT archive, markdown, sources, page_count, n_members, skipped > 0 AS over_budget,
    notes || CASE WHEN skipped = 0 THEN '' ELSE CASE WHEN notes = '' THEN '' ELSE chr(10) END
      || 'no room for more: ' || skipped || ' of ' || n_members
      || ' entries are left out' END AS warnings,
    CASE WHEN n_members > {q.MAX_MEMBERS} THEN 'input_rejected' WHEN late THEN 'timeout' END AS error_code,
    CASE WHEN n_members > {q.MAX_MEMBERS} THEN 'archive lists more than {q.MAX_MEMBERS} members'
         WHEN late THEN 'the parse exceeded its time budget' END AS error FROM gathered)"""


def _assembly(budget: int) -> str:
    return f"""WITH {_assembled(budget)} SELECT archive, markdown, warnings, sources, page_count,
  over_budget, n_members, error_code, error FROM assembled"""


def parse_job_archives() -> str:
    code, text, _ = preflight("plain_name")
    members = f"""{PACKED},
refusals AS (SELECT path, arg_min(member_error, ordinal) FILTER (member_error IS NOT NULL) AS refused
  FROM packed GROUP BY path),
members AS (SELECT p.path AS archive, plain_name AS name, {strip('text')} AS body, string_split(plain_name, '/') AS parts,
    0 AS pages, {code} AS code, {text} AS msg
  FROM packed p JOIN refusals r ON r.path = p.path WHERE refused IS NULL AND kind = 'file')"""
    return f"""WITH {_assembled(q.ARCHIVE_BUDGET, members)},
ready AS (SELECT r.path, regexp_extract(r.path, '[^/]*$') AS filename, coalesce(markdown, '') AS markdown,
    coalesce(warnings, '') AS notes, coalesce(sources, '') AS sources, page_count,
    coalesce(over_budget, false) AS over_budget,
    CASE WHEN refused IS NOT NULL THEN 'input_rejected' ELSE error_code END AS error_code,
    coalesce(refused, error) AS error FROM refusals r LEFT JOIN assembled a ON a.archive = r.path),
{_shaped(q.ARCHIVE_BUDGET, q.SHARED_MIN_TEXT, 'path')}"""


def _supervised() -> str:
    """Of the documents that reach the parser, some hang and some end it."""
    odd = f"doc_id % {q.ODD_PARSES}"
    died = "'the parser exited with code 3 on `' || filename || '`: cannot go on with ' || doc_id"
    return _single(
        "path",
        f"CASE {odd} WHEN 0 THEN 'timeout' WHEN 1 THEN 'parse_failed' END",
        f"CASE {odd} WHEN 0 THEN 'the parse exceeded its time budget' WHEN 1 THEN {died} END",
    )


def _single(key: str, odd_code: str | None = None, odd_text: str | None = None) -> str:
    code, text, _ = preflight("filename")
    if odd_code:
        code, text = f"coalesce({code}, {odd_code})", f"CASE WHEN {code} IS NULL THEN {odd_text} ELSE {text} END"
    return f"""WITH named AS (SELECT *, regexp_extract({FILE_NAME}, '[^/]*$') AS filename,
    '/data/' || source || '/' || {FILE_NAME} AS path FROM documents),
ready AS (SELECT doc_id, path, filename, {MARKDOWN} AS markdown, '' AS notes, filename AS sources,
    CAST(NULL AS BIGINT) AS page_count, false AS over_budget, {code} AS error_code, {text} AS error FROM named),
{_shaped(q.SHARED_BUDGET, q.SHARED_MIN_TEXT, key)}"""


def result_sink() -> str:
    code, _, _ = preflight("path")
    return f"""WITH named AS (SELECT '/data/' || source || '/' || {FILE_NAME} AS path FROM documents)
SELECT path, CASE WHEN {code} IS NULL THEN 'succeeded' ELSE 'failed' END AS status, {code} AS error_code FROM named"""


def output_scan() -> str:
    return """SELECT 'parse=' || (page_id % 32) AS parse_id,
  CAST(sum(strlen(regexp_replace(html, '[\\r\\n]+', ' ', 'g')) + 1) AS BIGINT) AS n_bytes FROM pages GROUP BY 1"""


def document_scan() -> str:
    return "SELECT doc_id, strlen(text) + 1 AS length, md5(text || chr(10)) AS digest FROM documents"


def collect_outputs() -> str:
    tail = "right(log, 800)"
    return f"""WITH {CANDIDATES}, {LISTS},
counted AS (SELECT *, CASE shape WHEN 0 THEN greatest(k, 1) + 1 WHEN 4 THEN greatest(k, 0) + 1 END AS pages FROM lists),
pages AS (SELECT parse_id, arg_min(pages, file) FILTER (pages IS NOT NULL) AS page_count FROM counted GROUP BY parse_id),
logs AS (SELECT parse_id, arg_min(text, doc_id) AS log FROM files GROUP BY parse_id),
wanted AS (SELECT f.parse_id, f.text, row_number() OVER (PARTITION BY f.parse_id ORDER BY
      CASE WHEN doc_id = f.parse_id THEN 0 ELSE 1 END, size DESC, file) AS place
  FROM files f WHERE ends_with(file, '.md')),
read AS (SELECT parse_id, {clip('text', str(q.SHARED_BUDGET + 1))} AS kept, text FROM wanted WHERE place = 1)
SELECT l.parse_id, 'd' || l.parse_id || '.pdf' AS filename,
  kept || CASE WHEN strlen(text) > {q.SHARED_BUDGET + 1} AND strlen(kept) < {q.SHARED_BUDGET + 1} THEN chr(65533) ELSE '' END AS markdown,
  CASE WHEN kept IS NOT NULL THEN page_count END AS page_count,
  CASE WHEN kept IS NULL THEN 'parse_failed' END AS error_code,
  CASE WHEN kept IS NULL THEN 'the parser wrote no markdown for `d' || l.parse_id || '.pdf`' ||
    CASE WHEN {strip(tail)} <> '' THEN ': ' || {tail} ELSE '' END END AS error
FROM logs l LEFT JOIN read r USING (parse_id) LEFT JOIN pages p USING (parse_id)"""


def parse_requests() -> str:
    code, text, _ = preflight("name")
    shape = "a request needs either `path` or `content_base64`, and not both"
    return f"""WITH asked AS (SELECT *, {FILE_NAME} AS file_name, doc_id % 77 = 0 AS none, doc_id % 2 = 1 AS by_path,
    CASE WHEN doc_id % 9 = 4 THEN '/etc/' ELSE '/data/' END || source || '/' || {FILE_NAME} AS path FROM documents),
named AS (SELECT *, CASE WHEN by_path THEN regexp_extract(file_name, '[^/]*$')
    ELSE doc_id || regexp_extract(file_name, '(\\.[^.]+)$', 1) END AS name FROM asked),
routed AS (SELECT *, {code} AS code, {text} AS msg,
    {ext_of('name')} IN ('.zip', '.tar', '.tar.gz', '.tgz') OR ends_with(name, '.tar.gz') AS packed FROM named),
judged AS (SELECT *, CASE WHEN none THEN {lit(shape)}
    WHEN by_path AND doc_id % 9 = 4 THEN '`' || path || '` is not under any allowed root (/data)'
    WHEN by_path AND doc_id % 7 = 3 THEN 'cannot open `' || path || '`'
    WHEN strlen(text) > {q.MAX_INPUT} THEN CASE WHEN by_path THEN 'input' ELSE 'sent content' END || ' is ' || strlen(text)
      || ' bytes, over the {q.MAX_INPUT}-byte limit' END AS refused FROM routed),
ready AS (SELECT doc_id AS request_id, name AS filename, CASE WHEN packed OR refused IS NOT NULL THEN '' ELSE {lossy('text', q.SHARED_BUDGET + 1)} END AS markdown,
    '' AS notes, name AS sources, CAST(NULL AS BIGINT) AS page_count, false AS over_budget,
    CASE WHEN none THEN 'none' WHEN refused IS NOT NULL THEN 'input_rejected' WHEN packed THEN 'input_rejected' ELSE code END AS error_code,
    coalesce(refused, CASE WHEN packed THEN '`' || name || '` opens neither as zip nor as tar' ELSE msg END) AS error FROM judged),
{_shaped(q.SHARED_BUDGET, q.SHARED_MIN_TEXT, 'request_id')}"""


def lossy(expr: str, n: int) -> str:
    """At most n bytes; a cut character at the end becomes one replacement mark."""
    kept = clip(expr, str(n))
    return f"{kept} || CASE WHEN strlen({expr}) > {n} AND strlen({kept}) < {n} THEN chr(65533) ELSE '' END"


def job_stream() -> str:
    """The stream's clock stops ten seconds before its last event."""
    due = f"started_at + INTERVAL {q.TIMEOUT_SECS} SECOND"
    late = f"coalesce(coalesce(finished_at, clock) >= {due} AND coalesce(finished_at > {due}, true), false)"
    return f"""WITH {_jobs()},
timed AS (SELECT *, (SELECT max(ts) - INTERVAL 10 SECOND FROM events) AS clock FROM jobs)
SELECT job_id, CASE WHEN {late} THEN 'failed' ELSE status END AS status, created_at, started_at,
  CASE WHEN {late} THEN {due} ELSE finished_at END AS finished_at,
  CASE WHEN {late} THEN 'timeout' END AS error_code FROM timed"""


def job_stream_retained() -> str:
    return f"""SELECT * FROM ({job_stream()}) WHERE NOT coalesce(finished_at + INTERVAL {q.RETAINED_SECS} SECOND
  <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events), false)"""


def _shaped(budget: int, min_text: int, key: str) -> str:
    """From ``ready`` (key, filename, markdown, notes, sources, page_count,
    over_budget, error_code, error) to flat results."""
    mirror = (
        f"plain text is cut so that the answer stays within {budget} bytes; "
        "`markdown` holds everything"
    )
    return f"""
typed AS (SELECT * REPLACE (
    CASE WHEN error_code IS NULL AND {strip('markdown')} = '' THEN 'parse_failed' ELSE error_code END AS error_code,
    CASE WHEN error_code IS NULL AND {strip('markdown')} = ''
      THEN 'the parser extracted no text from `' || regexp_extract(filename, '[^/]*$') || '`' ELSE error END AS error)
  FROM ready),
clipped AS (SELECT *, {clip('markdown', str(budget))} AS md, {plain('markdown')} AS full_text FROM typed),
shared AS (SELECT *, {budget} - strlen(md) AS room FROM clipped),
mirrored AS (SELECT *, room >= {min_text} AND strlen(full_text) <= room AS whole_text,
    CASE WHEN room >= {min_text} THEN {clip('full_text', 'room')} ELSE '' END AS txt FROM shared)
SELECT {key}, error_code, error,
  CASE WHEN error_code IS NULL THEN md END AS markdown,
  CASE WHEN error_code IS NULL THEN txt END AS text,
  CASE WHEN error_code IS NULL THEN notes || CASE WHEN whole_text THEN ''
    ELSE CASE WHEN notes = '' THEN '' ELSE chr(10) END || {lit(mirror)} END END AS warnings,
  CASE WHEN error_code IS NULL THEN strlen(markdown) > {budget} OR over_budget END AS truncated,
  CASE WHEN error_code IS NULL THEN filename END AS filename,
  CASE WHEN error_code IS NULL THEN page_count END AS page_count,
  CASE WHEN error_code IS NULL THEN sources END AS sources,
  CASE WHEN error_code IS NULL THEN 'pipeline' END AS parse_backend FROM mirrored"""


def archive_result() -> str:
    return f"""WITH {_assembled(q.ARCHIVE_BUDGET)},
ready AS (SELECT archive, archive || '.zip' AS filename, markdown, warnings AS notes, sources,
    page_count, over_budget, error_code, error FROM assembled),
{_shaped(q.ARCHIVE_BUDGET, q.SHARED_MIN_TEXT, 'archive')}"""


def result_record() -> str:
    code, text, _ = preflight("filename")
    return f"""WITH named AS (SELECT *, {FILE_NAME} AS filename FROM documents),
ready AS (SELECT doc_id, filename, CASE WHEN doc_id % 29 = 0 THEN chr(10) || chr(9) || ' ' ELSE {MARKDOWN} END AS markdown,
    'checked ' || lang AS notes, filename AS sources, nullif(doc_id % 4, 0) AS page_count,
    false AS over_budget, {code} AS error_code, {text} AS error FROM named),
{_shaped(q.SHARED_BUDGET, q.SHARED_MIN_TEXT, 'doc_id')}"""


# --- text -------------------------------------------------------------------


def text_step(name: str) -> str:
    return _on_markdown(STEPS[name]("markdown"))


def plain_text() -> str:
    return _on_markdown(plain("markdown"))


def _on_markdown(expr: str) -> str:
    return f"WITH d AS (SELECT doc_id, {MARKDOWN} AS markdown FROM documents) SELECT doc_id, {expr} AS result FROM d"


def plain_text_html() -> str:
    return f"SELECT page_id, {plain('html')} AS result FROM pages"


def clip_bytes() -> str:
    n = q.CLIP
    longest = (
        f"list_max(list_filter(range({n // 4}, {n + 1}), lambda k: strlen(left(text, CAST(k AS INTEGER))) <= {n}))"
    )
    return f"""SELECT doc_id, CASE WHEN strlen(text) <= {n} THEN text ELSE left(text, CAST({longest} AS INTEGER)) END AS clipped,
  strlen(text) <= {n} AS whole FROM documents"""


def shared_budget() -> str:
    b, m = q.SHARED_BUDGET, q.SHARED_MIN_TEXT
    return f"""WITH d AS (SELECT doc_id, {MARKDOWN} AS body FROM documents),
clipped AS (SELECT *, {clip('body', str(b))} AS md, {plain('body')} AS full_text FROM d),
shared AS (SELECT *, {b} - strlen(md) AS room FROM clipped)
SELECT doc_id, md AS markdown, CASE WHEN room >= {m} THEN {clip('full_text', 'room')} ELSE '' END AS text,
  strlen(body) <= {b} AS whole_markdown, room >= {m} AND strlen(full_text) <= room AS whole_text FROM shared"""


def error_tail() -> str:
    return f"""WITH d AS (SELECT doc_id, {tail_text('text', 4000)} AS t FROM documents)
SELECT doc_id, {strip('t')} AS tail, right({strip('t')}, 800) AS excerpt FROM d"""


def lossy_read() -> str:
    n = q.CLIP + 1
    return f"""WITH d AS (SELECT doc_id, text, {clip('text', str(n))} AS kept FROM documents)
SELECT doc_id, kept || CASE WHEN strlen(text) > {n} AND strlen(kept) < {n} THEN chr(65533) ELSE '' END AS read FROM d"""


# --- parser outputs ---------------------------------------------------------

CANDIDATES = """
files AS (SELECT doc_id // 4 AS parse_id, doc_id, text,
    'out/' || lang || '/d' || doc_id || CASE WHEN (doc_id // 4) % 9 = 4 THEN '.json' ELSE '.md' END AS file,
    strlen(text) AS size,
    CASE WHEN (doc_id // 4) % 3 = 0 THEN 'D' || ((doc_id // 4) * 4 + 1) ELSE 'none' END AS wanted FROM documents),
picked AS (SELECT parse_id, file, size, row_number() OVER (PARTITION BY parse_id ORDER BY
      CASE WHEN 'd' || doc_id = lower(wanted) THEN 0 ELSE 1 END, size DESC, file) AS place
  FROM files WHERE ends_with(file, '.md'))"""


def pick_markdown() -> str:
    return f"WITH {CANDIDATES} SELECT parse_id, file, size FROM picked WHERE place = 1"


def no_output() -> str:
    tail = "right(text, 800)"
    return f"""WITH {CANDIDATES}
SELECT parse_id, 'd' || parse_id || '.pdf' AS filename, 'parse_failed' AS error_code,
  'the parser wrote no markdown for `d' || parse_id || '.pdf`' ||
    CASE WHEN {strip(tail)} <> '' THEN ': ' || {tail} ELSE '' END AS error
FROM (SELECT parse_id, arg_min(text, doc_id) AS text FROM files GROUP BY parse_id)
WHERE parse_id NOT IN (SELECT parse_id FROM picked)"""


LISTS = """
lists AS (SELECT event_id // 3 AS parse_id, event_id % 5 AS shape,
    'p' || event_id || '_content_list.json' AS file,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def page_count() -> str:
    return f"""WITH {LISTS},
counted AS (SELECT *, CASE shape WHEN 0 THEN greatest(k, 1) + 1 WHEN 4 THEN greatest(k, 0) + 1 END AS pages FROM lists)
SELECT parse_id, arg_min(pages, file) FILTER (pages IS NOT NULL) AS page_count FROM counted GROUP BY parse_id"""


def page_window() -> str:
    return f"""WITH {LISTS},
items AS (SELECT parse_id, file, 0 AS item_no, k AS page_idx FROM lists WHERE shape = 0
  UNION ALL SELECT parse_id, file, 3, 1 FROM lists WHERE shape = 0
  UNION ALL SELECT parse_id, file, 0, 0 FROM lists WHERE shape = 4
  UNION ALL SELECT parse_id, file, 1, k FROM lists WHERE shape = 4)
SELECT parse_id, file, CAST(item_no AS BIGINT) AS item_no, page_idx FROM items WHERE page_idx BETWEEN 0 AND 40"""


# --- job ledger -------------------------------------------------------------


def _jobs(where: str = "true") -> str:
    return f"""
log AS (SELECT user_id * 31 + day(ts) AS job_id, ts, event_id AS seq,
    CASE event_type WHEN 'view' THEN 'queued' WHEN 'click' THEN 'running' WHEN 'purchase' THEN 'succeeded'
      WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'cancelled' END AS status FROM events),
seen AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, seq) AS place FROM log WHERE {where}),
ends AS (SELECT job_id, min(place) AS end_place FROM seen
  WHERE status IN ('succeeded', 'failed', 'cancelled') GROUP BY job_id),
live AS (SELECT s.*, e.end_place FROM seen s LEFT JOIN ends e USING (job_id)
  WHERE e.end_place IS NULL OR s.place <= e.end_place),
jobs AS (SELECT job_id,
    coalesce(max(status) FILTER (place = end_place),
      CASE WHEN count(*) FILTER (status = 'running') > 0 THEN 'running' ELSE 'queued' END) AS status,
    min(ts) AS created_at, min(ts) FILTER (status = 'running') AS started_at,
    max(ts) FILTER (place = end_place) AS finished_at FROM live GROUP BY job_id)"""


def _told_jobs() -> str:
    """Jobs with what their terminal event tells, and the first file name told."""
    return f"""{_jobs()},
files AS (SELECT l.job_id, 'd' || arg_min(l.seq, l.place) || '.pdf' AS filename
  FROM seen l WHERE l.status <> 'running' GROUP BY l.job_id),
told AS (SELECT j.*, f.filename, s.seq AS end_seq, s.status AS end_status
  FROM jobs j LEFT JOIN files f USING (job_id) LEFT JOIN ends e USING (job_id)
  LEFT JOIN seen s ON s.job_id = j.job_id AND s.place = e.end_place),
detailed AS (SELECT job_id, status, created_at, started_at, finished_at, filename,
  CASE WHEN end_status = 'failed' THEN CASE WHEN end_seq % 3 = 0 THEN 'missing_dependency' ELSE 'parse_failed' END END AS error_code,
  CASE WHEN end_status = 'failed' THEN 'failed at ' || end_seq END AS error,
  CASE WHEN end_status = 'failed' AND end_seq % 3 = 0 THEN 'libreoffice' END AS missing_dependencies,
  CASE WHEN end_status = 'succeeded' THEN 'result of ' || end_seq END AS result FROM told)"""


def job_snapshot() -> str:
    return f"WITH {_told_jobs()} SELECT * FROM detailed"


def job_lookup() -> str:
    return f"""WITH {_jobs()} SELECT doc_id AS job_id, status, created_at, started_at, finished_at,
  jobs.job_id IS NULL AS unknown FROM labels LEFT JOIN jobs ON jobs.job_id = doc_id"""


def job_deadline() -> str:
    late = f"coalesce(coalesce(finished_at, TIMESTAMP '2024-01-31 00:00:00') > started_at + INTERVAL {q.TIMEOUT_SECS} SECOND, false)"
    return f"""WITH {_told_jobs()} SELECT job_id, CASE WHEN {late} THEN 'failed' ELSE status END AS status, created_at, started_at,
  CASE WHEN {late} THEN started_at + INTERVAL {q.TIMEOUT_SECS} SECOND ELSE finished_at END AS finished_at, filename,
  CASE WHEN {late} THEN 'timeout' ELSE error_code END AS error_code,
  CASE WHEN {late} THEN 'the parse exceeded its time budget' ELSE error END AS error,
  missing_dependencies, result FROM detailed"""


def job_cancel() -> str:
    keep = "status <> 'cancelled'"
    hit = "(asked IS NOT NULL AND j.job_id IS NOT NULL AND (finished_at IS NULL OR asked < finished_at))"
    return f"""WITH {_jobs(keep)},
asks AS (SELECT job_id, min(ts) AS asked FROM log WHERE status = 'cancelled' GROUP BY job_id)
SELECT coalesce(j.job_id, a.job_id) AS job_id, CASE WHEN {hit} THEN 'cancelled' ELSE status END AS status, created_at,
  CASE WHEN {hit} AND asked <= started_at THEN NULL ELSE started_at END AS started_at,
  CASE WHEN {hit} THEN asked ELSE finished_at END AS finished_at,
  CASE WHEN asked IS NULL THEN NULL WHEN j.job_id IS NULL THEN 'unknown'
       WHEN {hit} THEN 'cancelled' ELSE 'ignored' END AS cancel_outcome
FROM jobs j FULL JOIN asks a ON a.job_id = j.job_id"""


def job_retention(max_jobs: int) -> str:
    return f"""WITH {_jobs()},
placed AS (SELECT *, status IN ('succeeded', 'failed', 'cancelled') AS done,
    count(*) OVER () AS n, row_number() OVER (PARTITION BY status IN ('succeeded', 'failed', 'cancelled')
      ORDER BY created_at, job_id) AS place FROM jobs)
SELECT job_id, status, created_at, started_at, finished_at FROM placed WHERE NOT done OR place > n - {max_jobs}"""


def all_sql() -> dict[str, str]:
    sql = {
        f.__name__: f()
        for f in (
            intake_requests, inline_decode, root_confinement, size_cap, format_routing,
            option_cleanup, outcome_typing, member_guard, repeated_names, archive_result,
            plain_text, plain_text_html, clip_bytes, shared_budget, error_tail, lossy_read, result_record,
            pick_markdown, page_count, page_window, no_output, job_snapshot, job_lookup,
            job_deadline, job_cancel, archive_expand, archive_ceiling, parse_job_archives, result_sink,
            output_scan, job_stream, job_stream_retained, document_scan, collect_outputs,
        )
    }
    sql["archive_caps"] = _caps(49, 90_000)
    sql["archive_bytes_cap"] = _caps(q.MAX_MEMBERS, 90_000)
    sql["archive_assembly"] = _assembly(q.ARCHIVE_BUDGET)
    sql["archive_uncut"] = _assembly(8 * 1024 * 1024)
    sql["document_stream"] = sql["document_scan"]
    sql["result_sink_committed"] = sql["result_sink"]
    backend = "CASE request_id % 3 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'vlm-engine' ELSE 'hybrid-engine' END"
    sql["parse_requests"] = (
        f"SELECT * REPLACE (nullif(error_code, 'none') AS error_code, CASE WHEN parse_backend IS NOT NULL THEN {backend} END"
        f" AS parse_backend) FROM ({parse_requests()})"
    )
    sql["archive_expand_sql"] = sql["archive_expand_files"] = sql["archive_expand"]
    sql["parse_job_documents"] = _single("path")
    sql["parse_job_supervised"] = _supervised()
    sql["doc_stream"] = _single("doc_id")
    sql["job_stream_timers"] = job_stream()
    sql["job_listing"] = f"WITH {_jobs()} SELECT job_id, status, created_at, started_at, finished_at FROM jobs"
    sql["job_retention"] = job_retention(q.MAX_JOBS_WIDE)
    sql["job_retention_default"] = job_retention(q.MAX_JOBS)
    for name in q.TEXT_STEPS:
        sql[name] = text_step(name)
    return sql
