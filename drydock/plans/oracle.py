"""The same queries as standard SQL over the benchmark tables, for checking results.

Each query is written from the definition of its result with plain windows and groupings, not from
the Spark expressions. Common table expressions are shared through ``_sql``.
"""

from __future__ import annotations

from . import frames as fr

ORACLE: dict[str, str] = {}


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[({index}) % {len(values)} + 1]"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, *needs: str, sql: str) -> None:
    _CTES[name] = (needs, sql)


def _sql(final: str, *needs: str) -> str:
    """``final`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n" + final


def _oracle(name: str, final: str, *needs: str) -> None:
    ORACLE[name] = _sql(final, *needs)


# --- build files -------------------------------------------------------------------------------

_BEFORE = _list(a for a, _ in fr.LINE_TEMPLATES)
_AFTER = _list(b for _, b in fr.LINE_TEMPLATES)
_N = len(fr.LINE_TEMPLATES)

_cte(
    "files",
    sql=f"""SELECT * FROM (
      SELECT doc_id AS file_id, doc_id - doc_id % 3 AS repo_id,
        'r' || (doc_id - doc_id % 3) || '/' || {_pick(fr.PATHS, 'doc_id')} AS path,
        regexp_split_to_array(text, '\\. |\\n') AS frags FROM documents)""",
)
_cte(
    "build_files",
    "files",
    sql="""SELECT *, split_part(path, '/', -1) AS file_name FROM files
      WHERE lower(split_part(path, '/', -1)) = 'dockerfile' OR lower(split_part(path, '/', -1)) LIKE 'dockerfile.%'""",
)
_cte(
    "frag",
    "files",
    sql="SELECT file_id, unnest(frags) AS w, unnest(range(1, len(frags) + 1)) AS i FROM files",
)
_cte(
    "all_lines",
    "frag",
    sql=f"""
      SELECT file_id, n - 1 AS line_no, unnest AS raw FROM (
        SELECT file_id, unnest(string_split(base, chr(10))) AS unnest, unnest(range(1, len(string_split(base, chr(10))) + 1)) AS n
        FROM (SELECT file_id, {_pick(fr.BASES, 'file_id')} AS base FROM files))
      UNION ALL
      SELECT file_id, i + 1, CASE WHEN t = {fr.BLANK_TEMPLATE} THEN '' ELSE ({_BEFORE})[t + 1] || w || ({_AFTER})[t + 1] END
      FROM (SELECT *, (file_id + i * 5 + length(w)) % {_N} AS t FROM frag)""",
)
_cte("lines", "all_lines", "build_files", sql="SELECT l.* FROM all_lines l SEMI JOIN build_files USING (file_id)")
_cte("texts", "lines", sql="SELECT file_id, string_agg(raw, chr(10) ORDER BY line_no) AS content FROM lines GROUP BY file_id")
_cte(
    "all_texts",
    "all_lines",
    sql="SELECT file_id, string_agg(raw, chr(10) ORDER BY line_no) AS content FROM all_lines GROUP BY file_id",
)
_cte(
    "bodies",
    "lines",
    sql="""SELECT file_id, line_no, starts_with(t, '#') AS syn,
        CASE WHEN starts_with(t, '#') THEN t
          ELSE rtrim(regexp_extract(t, '^(?:[^"''#]+|["''][^"'']*(?:["'']|$))*', 0)) END AS body
      FROM (SELECT file_id, line_no, trim(raw) AS t FROM lines)
      WHERE t <> '' AND (NOT starts_with(t, '#') OR lower(t) LIKE '# syntax=%')""",
)
_cte(
    "pieces",
    "bodies",
    sql="""SELECT *, ends_with(body, '\\') AS cont,
        coalesce(sum(CASE WHEN ends_with(body, '\\') THEN 0 ELSE 1 END) OVER (
          PARTITION BY file_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g
      FROM bodies WHERE NOT syn AND body <> ''""",
)
_cte(
    "logical",
    "pieces",
    sql="""SELECT file_id, line_no, l FROM (
        SELECT file_id, g, max(line_no) AS line_no, arg_max(cont, line_no) AS open,
          string_agg(CASE WHEN cont THEN rtrim(body[:-2]) || ' ' ELSE body END, '' ORDER BY line_no) AS l
        FROM pieces GROUP BY file_id, g) WHERE NOT open
      UNION ALL SELECT file_id, line_no, body FROM bodies WHERE syn""",
)
_cte(
    "instr",
    "logical",
    sql="""SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY line_no) - 1 AS INTEGER) AS idx,
        CASE WHEN starts_with(l, '#') THEN 'SYNTAX' ELSE upper(regexp_extract(l, '^ *([^ ]+)', 1)) END AS instruction,
        CASE WHEN starts_with(l, '#') THEN l ELSE regexp_replace(l, '^ *[^ ]+ *', '') END AS value
      FROM logical""",
)


def _rule(rule: str, severity: str, cond: str) -> str:
    return f"SELECT file_id, idx, '{rule}' AS rule_id, '{severity}' AS severity FROM instr WHERE {cond}"


_APT = "instruction = 'RUN' AND (contains(value, 'apt-get') OR contains(value, 'apt '))"
_FILE = "SELECT file_id, -1 AS idx, '{0}' AS rule_id, '{1}' AS severity FROM per_file WHERE {2}"
_cte(
    "per_file",
    "instr",
    "build_files",
    sql="""SELECT file_id, count(*) FILTER (instruction = 'RUN') AS n_run,
        coalesce(bool_or(instruction = 'RUN' AND contains(value, 'apt-get')), false) AS apt,
        coalesce(bool_or(instruction = 'USER'), false) AS usr, coalesce(bool_or(instruction = 'HEALTHCHECK'), false) AS hc
      FROM build_files LEFT JOIN instr USING (file_id) GROUP BY file_id""",
)
_cte(
    "found",
    "per_file",
    sql=" UNION ALL ".join(
        [
            _rule("from_unpinned", "warning", "instruction = 'FROM' AND (NOT contains(value, ':') OR ends_with(trim(value), ':latest'))"),
            _rule("apt_no_recommends", "info", f"{_APT} AND NOT contains(value, '--no-install-recommends')"),
            _rule("apt_clean", "info", f"{_APT} AND NOT regexp_matches(value, 'apt-get\\s+clean') AND NOT regexp_matches(value, 'rm\\s+-rf\\s+/var/lib/apt/lists')"),
            _rule("apt_update_split", "info", f"{_APT} AND contains(value, 'apt-get update') AND NOT contains(value, 'apt-get install')"),
            _rule("pip_cache", "info", "instruction = 'RUN' AND contains(value, 'pip install') AND NOT contains(value, '--no-cache-dir')"),
            _rule("pipe_to_shell", "warning", "instruction = 'RUN' AND regexp_matches(value, '(curl|wget).*\\|.*(sh|bash)')"),
            _rule("combine_run", "info", "instruction = 'RUN' AND NOT contains(value, '&&')"),
            _rule("add_vs_copy", "info", "instruction = 'ADD' AND NOT regexp_matches(value, '\\.tar(\\.gz|\\.bz2|\\.xz)?')"),
            _FILE.format("multi_stage", "suggestion", "n_run > 3 AND apt"),
            _FILE.format("no_user", "warning", "NOT usr"),
            _FILE.format("no_healthcheck", "suggestion", "NOT hc"),
        ]
    ),
)
_KB = """CASE rule_id WHEN 'apt_no_recommends' THEN 50000 WHEN 'apt_clean' THEN 10000 WHEN 'apt_update_split' THEN 20000
  WHEN 'pip_cache' THEN 10000 WHEN 'combine_run' THEN 20000 WHEN 'multi_stage' THEN 100000 ELSE 0 END"""
_SIZE_RULES = "('apt_no_recommends', 'apt_clean', 'apt_update_split', 'pip_cache', 'combine_run', 'multi_stage')"
_cte(
    "file_kb",
    "found",
    sql=f"""SELECT file_id, count(*) AS n_size_findings, CAST(sum({_KB}) AS BIGINT) AS saving_kb
      FROM found WHERE rule_id IN {_SIZE_RULES} GROUP BY file_id""",
)

_oracle(
    "file_discovery",
    """SELECT b.file_id, path, file_name, coalesce(bool_or(NOT starts_with(trim(raw), '#') AND upper(trim(raw)) LIKE 'FROM%'), false) AS is_plausible
    FROM build_files b LEFT JOIN lines l USING (file_id) GROUP BY ALL""",
    "build_files",
    "lines",
)
_oracle("corpus_instructions", "SELECT file_id, idx, instruction, value FROM instr", "instr")
_oracle(
    "lint_findings",
    "SELECT *, CASE WHEN idx >= 0 THEN 'instruction ' || idx ELSE '(general)' END AS location FROM found",
    "found",
)
_oracle(
    "lint_rule_counts",
    "SELECT rule_id, severity, count(*) AS n_findings, count(DISTINCT file_id) AS n_files FROM found GROUP BY ALL",
    "found",
)
_oracle(
    "lint_size_only",
    "SELECT * FROM found WHERE rule_id IN ('apt_no_recommends', 'apt_clean', 'combine_run', 'add_vs_copy', 'multi_stage')",
    "found",
)
_oracle("lint_size_related", f"SELECT rule_id, count(*) AS n FROM found WHERE rule_id IN {_SIZE_RULES} GROUP BY 1", "found")
_oracle("file_savings", "SELECT * FROM file_kb", "file_kb")
_oracle("file_savings_topk", "SELECT * FROM file_kb ORDER BY saving_kb DESC, file_id LIMIT 20", "file_kb")

_RM = "contains(raw, 'rm -rf /var/lib/apt/lists')"


def _flagged(column: str, command: str, flag: str) -> str:
    return f"CASE WHEN contains({column}, '{command}') AND NOT contains({column}, '{flag}') THEN replace({column}, '{command}', '{command} {flag}') ELSE {column} END"


def _edits(column: str, command: str, flag: str) -> str:
    return f"count(*) FILTER (contains({column}, '{command}') AND NOT contains({column}, '{flag}'))"


_AI, _AF, _PI, _PF = "apt-get install", "--no-install-recommends", "pip install", "--no-cache-dir"
_oracle(
    "rewrite_flags",
    f"""SELECT file_id, CAST({_edits('raw', _AI, _AF)} AS INTEGER) AS n_apt, CAST({_edits('raw', _PI, _PF)} AS INTEGER) AS n_pip,
      md5(string_agg({_flagged(_flagged('raw', _AI, _AF), _PI, _PF)}, chr(10) ORDER BY line_no)) AS text_md5
    FROM lines GROUP BY file_id""",
    "lines",
)


def _cleanup_ctes(prefix: str, source: str) -> None:
    """``prefix_hit``: lines of ``source(file_id, line_no, raw)`` with hit flags and new text."""
    _cte(
        f"{prefix}_hit",
        source,
        sql=f"""SELECT file_id, line_no, raw, hit, hit AND ends_with(rtrim(raw), '&&') AS dangling,
          CASE WHEN NOT hit OR ends_with(rtrim(raw), '&&') THEN raw
            WHEN ends_with(rtrim(raw), '\\') THEN rtrim(raw) || chr(10) || '    && rm -rf /var/lib/apt/lists/* \\'
            ELSE rtrim(raw) || ' && rm -rf /var/lib/apt/lists/*' END AS new
        FROM (SELECT *, contains(raw, 'apt-get install') AND contains(raw, '&&') AND NOT bool_or({_RM}) OVER (
            PARTITION BY file_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS hit FROM {source})""",
    )


_cleanup_ctes("raw", "lines")
_oracle(
    "rewrite_cleanup",
    """SELECT file_id, CAST(count(*) FILTER (hit) AS INTEGER) AS n_hits, CAST(count(*) FILTER (dangling) AS INTEGER) AS n_dangling,
      md5(string_agg(new, chr(10) ORDER BY line_no)) AS text_md5 FROM raw_hit GROUP BY file_id""",
    "raw_hit",
)
_cte(
    "gates",
    "found",
    "texts",
    sql="""SELECT t.file_id, content, count(*) FILTER (rule_id = 'apt_no_recommends') AS n_apt,
        count(*) FILTER (rule_id = 'apt_clean') AS n_clean, count(*) FILTER (rule_id = 'pip_cache') AS n_pip
      FROM texts t LEFT JOIN found USING (file_id) GROUP BY ALL""",
)
_cte(
    "step1",
    "gates",
    "lines",
    sql=f"SELECT file_id, line_no, CASE WHEN n_apt > 0 THEN {_flagged('raw', _AI, _AF)} ELSE raw END AS raw FROM lines JOIN gates USING (file_id)",
)
_cleanup_ctes("first", "step1")
_cte(
    "step2",
    "first_hit",
    sql="""SELECT file_id, line_no * 2 + k AS line_no, raw FROM (
        SELECT file_id, line_no, unnest(parts) AS raw, unnest(range(0, len(parts))) AS k FROM (
          SELECT file_id, line_no, string_split(CASE WHEN n_clean > 0 THEN new ELSE raw END, chr(10)) AS parts
          FROM first_hit JOIN gates USING (file_id)))""",
)
_cleanup_ctes("second", "step2")
_cte(
    "rewritten",
    "second_hit",
    sql=f"""SELECT s.file_id, string_agg(CASE WHEN n_pip > 0 THEN {_flagged('raw', _PI, _PF)} ELSE raw END, chr(10) ORDER BY line_no) AS text,
        any_value(content) AS content,
        any_value(CASE WHEN n_pip > 0 THEN 1 ELSE 0 END) * {_edits('raw', _PI, _PF)}
          + any_value(greatest(n_clean - 1, 0)) * count(*) FILTER (dangling) AS n_late
      FROM second_hit s JOIN gates USING (file_id) GROUP BY s.file_id""",
)
_cte(
    "early",
    "first_hit",
    sql=f"""SELECT f.file_id, any_value(CASE WHEN n_apt > 0 THEN 1 ELSE 0 END) * any_value(n_edit)
        + any_value(CASE WHEN n_clean > 0 THEN 1 ELSE 0 END) * count(*) FILTER (hit) AS n_early
      FROM first_hit f JOIN gates USING (file_id)
        JOIN (SELECT file_id, {_edits('raw', _AI, _AF)} AS n_edit FROM lines GROUP BY file_id) e ON e.file_id = f.file_id
      GROUP BY f.file_id""",
)
_cte(
    "static_done",
    "rewritten",
    "early",
    "file_kb",
    sql="""SELECT r.file_id, text, content, text <> content AS changed,
        CAST(CASE WHEN text <> content THEN n_early + n_late ELSE 0 END AS BIGINT) AS n_changes,
        CAST(CASE WHEN text <> content THEN coalesce(saving_kb, 0) ELSE 0 END AS BIGINT) AS saving_kb
      FROM rewritten r JOIN early USING (file_id) LEFT JOIN file_kb USING (file_id)""",
)
_oracle(
    "static_rewrite",
    "SELECT file_id, changed, n_changes, saving_kb, md5(text) AS text_md5 FROM static_done",
    "static_done",
)

# Replies that carry a build file.
_BODY = "'FROM debian:12' || chr(10) || 'RUN make' || chr(10) || '# ' || role || chr(10) || chr(10) || 'CMD run ' || conv_id"
_F, _NL = "'```'", "chr(10)"
_cte(
    "fix_raw",
    sql=f"""SELECT conv_id * 8 + turn AS file_id, CASE (conv_id * 3 + turn) % 7
        WHEN 1 THEN {_F} || 'dockerfile' || {_NL} || {_BODY} || {_NL} || {_F}
        WHEN 2 THEN text || {_NL} || {_F} || {_NL} || {_BODY} || {_NL} || {_F} || {_NL} || text
        WHEN 3 THEN {_BODY} || {_NL} || {_F} || {_NL} || text
        WHEN 4 THEN text || {_NL} || 'RUN only' || {_NL}
        WHEN 5 THEN 'Error: 401 invalid key'
        WHEN 6 THEN text ELSE {_BODY} END AS raw FROM conversations""",
)
_cte(
    "fix_clean",
    "fix_raw",
    sql=f"""SELECT file_id, raw, trim(array_to_string(
          CASE WHEN len(parts) % 2 = 1 THEN parts ELSE parts[:-2] END, ''), ' ' || chr(10)) AS cleaned
      FROM (SELECT *, string_split(trim(raw, ' ' || chr(10)), {_F}) AS parts FROM fix_raw)""",
)
_cte(
    "fix_lines",
    "fix_clean",
    sql="""SELECT file_id, raw, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS n
      FROM (SELECT file_id, raw, string_split(cleaned, chr(10)) AS l FROM fix_clean)""",
)
_cte(
    "fixed",
    "fix_lines",
    sql="""SELECT file_id, any_value(raw) AS raw, trim(CASE
          WHEN bool_or(seen) THEN string_agg(line, chr(10) ORDER BY n) FILTER (seen)
          WHEN bool_or(kw) THEN string_agg(line, chr(10) ORDER BY n) FILTER (kw)
          ELSE string_agg(line, chr(10) ORDER BY n) END, ' ' || chr(10)) AS fixed
      FROM (SELECT *, bool_or(upper(trim(line)) LIKE 'FROM%') OVER (PARTITION BY file_id ORDER BY n) AS seen,
          regexp_matches(upper(line), 'FROM|RUN|COPY|ADD|WORKDIR') AS kw FROM fix_lines) GROUP BY file_id""",
)
_cte(
    "fix_status",
    "fixed",
    "all_texts",
    sql="""SELECT file_id, content, fixed, CASE WHEN starts_with(raw, 'Error:') OR starts_with(raw, 'LLM API error:') THEN 'api_error'
        WHEN fixed <> '' AND fixed <> content THEN 'ok' ELSE 'no_change' END AS status
      FROM fixed JOIN all_texts USING (file_id)""",
)
_oracle("fixed_files", "SELECT file_id, status, CASE WHEN status = 'ok' THEN fixed END AS fixed FROM fix_status", "fix_status")
_oracle(
    "stage_texts",
    """SELECT repo_id || '_' || file_name || '_' || stage AS variant, file_id, stage, text_md5 FROM (
      SELECT file_id, 'original' AS stage, md5(content) AS text_md5 FROM static_done
      UNION ALL SELECT file_id, 'static_optimized', md5(text) FROM static_done WHERE changed
      UNION ALL SELECT s.file_id, 'llm_optimized', md5(f.fixed) FROM static_done s JOIN fix_status f USING (file_id)
        WHERE f.status = 'ok' AND f.fixed <> s.text) JOIN build_files USING (file_id)""",
    "static_done",
    "fix_status",
    "build_files",
)

_cte(
    "commands",
    "step1",
    sql="""SELECT file_id, g, max(line_no) AS line_no, string_agg(raw, chr(10) ORDER BY line_no) AS c, any_value(n_clean) AS n_clean FROM (
        SELECT *, coalesce(sum(CASE WHEN open THEN 0 ELSE 1 END) OVER (
          PARTITION BY file_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g
        FROM (SELECT *, coalesce(last_value(CASE WHEN trim(raw) <> '' THEN ends_with(rtrim(raw), '\\') END IGNORE NULLS) OVER (
          PARTITION BY file_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), false) AS open FROM step1) JOIN gates USING (file_id)) GROUP BY file_id, g""",
)
_cte(
    "safe_lines",
    "commands",
    sql="""SELECT *, n_clean > 0 AND contains(c, 'apt-get install') AND contains(c, '&&') AND NOT contains(c, 'rm -rf /var/lib/apt/lists')
        AND NOT ends_with(rtrim(c, ' ' || chr(10)), '&&') AND NOT ends_with(rtrim(c, ' ' || chr(10)), '\\')
        AND NOT regexp_matches(c, '\n[ \t]*#[^\n]*$') AS hit FROM commands""",
)
_cte(
    "safe_done",
    "safe_lines",
    sql=f"""SELECT s.file_id, any_value(content) AS content, count(*) FILTER (hit) AS n_hit,
        string_agg(CASE WHEN hit THEN rtrim(c, ' ' || chr(10)) || ' && rm -rf /var/lib/apt/lists/*' ELSE c END, chr(10) ORDER BY line_no) AS text
      FROM safe_lines s JOIN gates USING (file_id) GROUP BY s.file_id""",
)
_cte(
    "safe_split",
    "safe_done",
    sql="SELECT file_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM safe_done",
)
_cte(
    "safe_final",
    "safe_split",
    "lines",
    sql=f"""SELECT s.file_id, any_value(content) AS content, any_value(CASE WHEN n_apt > 0 THEN n_edit ELSE 0 END) + any_value(n_hit)
          + any_value(CASE WHEN n_pip > 0 THEN 1 ELSE 0 END) * {_edits('raw', _PI, _PF)} AS n,
        string_agg(CASE WHEN n_pip > 0 THEN {_flagged('raw', _PI, _PF)} ELSE raw END, chr(10) ORDER BY line_no) AS text
      FROM safe_split s JOIN (SELECT file_id, n_apt, n_pip FROM gates) USING (file_id)
        JOIN (SELECT file_id, content, n_hit FROM safe_done) USING (file_id)
        JOIN (SELECT file_id, {_edits('raw', _AI, _AF)} AS n_edit FROM lines GROUP BY file_id) USING (file_id) GROUP BY s.file_id""",
)
_oracle(
    "safe_rewrite",
    """SELECT file_id, text <> content AS changed, CAST(CASE WHEN text <> content THEN n ELSE 0 END AS BIGINT) AS n_changes,
      md5(text) AS text_md5 FROM safe_final""",
    "safe_final",
)
_PROMPT = """'Review the container build file below. Reply with one JSON object with the fields security_risks, performance_issues, '
      || 'optimization_opportunities, runtime_concerns, best_practices_missing, estimated_wasted_space_kb, complexity_score, '
      || 'maintainability_score, overall_assessment, recommendations.' || chr(10) || chr(10) || content || chr(10)"""
_oracle("analysis_prompt", f"SELECT file_id, md5({_PROMPT}) AS prompt_md5 FROM texts", "texts")
_oracle(
    "model_call",
    f"""SELECT file_id, CASE WHEN length({_PROMPT}) % 5 = 0 THEN 'LLM API error: 429'
      ELSE 'FROM scratch' || chr(10) || '# ' || length({_PROMPT}) END AS raw FROM texts""",
    "texts",
)

_oracle(
    "model_answers",
    f"SELECT file_id, CASE WHEN length({_PROMPT}) % 5 = 0 THEN 'second ' ELSE 'first ' END || length({_PROMPT}) AS raw FROM texts",
    "texts",
)
_oracle("fresh_work", "SELECT file_id - file_id % 3 AS repo_id, file_id, file_name FROM build_files WHERE file_id % 3 <> 0", "build_files")

# --- repositories ------------------------------------------------------------------------------

_cte(
    "repo_lines",
    sql="""SELECT c_custkey AS line_no, CASE c_custkey % 6
        WHEN 0 THEN '# ' || url WHEN 1 THEN '   ' WHEN 2 THEN '  ' || url || '.git '
        WHEN 3 THEN name || ', ' || url || ' ,' || url || '/tree/master'
        WHEN 4 THEN url || ',' || url || '/b' ELSE ' # ' || name END AS line
      FROM (SELECT c_custkey, lower(c_mktsegment) AS name, 'https://git.example/' || lower(c_mktsegment) || '/r' || c_custkey AS url FROM customer)""",
)
_cte(
    "repo_parts",
    "repo_lines",
    sql="""SELECT line_no, CAST(part AS INTEGER) AS part, trim(u) AS url FROM (
        SELECT line_no, unnest(p) AS u, unnest(range(0, len(p))) AS part FROM (
          SELECT line_no, string_split(trim(line), ',') AS p FROM repo_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')))
      WHERE contains(u, 'http')""",
)
_cte(
    "repo_plain",
    "repo_lines",
    sql="SELECT line_no, trim(line) AS url FROM repo_lines WHERE trim(line) <> '' AND NOT starts_with(line, '#')",
)
_oracle(
    "repo_list",
    """SELECT line_no, part, url, replace(CASE WHEN split_part(url, '/', 6) = 'tree' THEN split_part(url, '/', 5)
      ELSE split_part(url, '/', -1) END, '.git', '') AS repo_name FROM repo_parts""",
    "repo_parts",
)
_oracle("repo_list_plain", "SELECT * FROM repo_plain", "repo_plain")
_oracle(
    "repo_list_first_and_kth",
    """SELECT 'first' AS which, arg_min(url, line_no) AS url FROM repo_plain WHERE starts_with(url, 'http')
    UNION ALL SELECT 'kth', url FROM (SELECT url, row_number() OVER (ORDER BY line_no) AS n FROM repo_plain) WHERE n = 17""",
    "repo_plain",
)
_cte(
    "sheet",
    sql="""SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'Section' ELSE CAST(c_custkey AS VARCHAR) END AS "Id",
        'https://git.example/o' || c_custkey % 25 || '/r' || c_custkey AS url,
        (['Yes', 'No', 'yes'])[c_custkey % 3 + 1] = 'Yes' AND c_mktsegment = 'MACHINERY' AS wanted FROM customer""",
)
_oracle("repo_sheet", 'SELECT "Id", url FROM sheet', "sheet")
_oracle("relevant_repos", "SELECT DISTINCT url AS repo FROM sheet WHERE wanted AND \"Id\" <> 'Section'", "sheet")
_oracle(
    "search_hits",
    """SELECT DISTINCT 'https://git.example/s/' || k AS repo_url
    FROM (SELECT c_custkey + d AS k FROM customer, (VALUES (0), (1)) v(d) WHERE c_custkey % 17 <> 0) WHERE k % 40 >= 10 AND k % 3 <> 0""",
)
_FIRST = "SELECT repo_id, path, file_id FROM (SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY {0}path) AS n FROM build_files) WHERE n = 1"
_oracle("first_file_per_repo", _FIRST.format(""), "build_files")
_EXACT = "CASE WHEN lower(file_name) = 'dockerfile' THEN 0 ELSE 1 END, "
_cte("preferred", "build_files", sql=_FIRST.format(_EXACT))
_oracle("preferred_file_per_repo", "SELECT * FROM preferred", "preferred")
_oracle(
    "repo_left_join_status",
    """SELECT c_custkey AS repo_id, file_id, path, CASE WHEN path IS NULL THEN 'no_dockerfile' ELSE 'ok' END AS status
    FROM customer LEFT JOIN build_files ON repo_id = c_custkey""",
    "build_files",
)
_oracle(
    "fresh_files",
    """SELECT file_id, sha256(content) AS content_key FROM texts WHERE content NOT IN (
      SELECT content FROM texts WHERE file_id IN (SELECT doc_id FROM labels))""",
    "texts",
)
_cte(
    "stage_builds",
    sql="""SELECT o_orderkey // 3 AS repo_id, ([0, 1, 2, 2, 0])[o_custkey % 5 + 1] AS s, o_orderstatus <> 'P' AS ok,
        CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 THEN (o_custkey % 900 + 1) || 'MB' END AS size
      FROM orders""",
)


def _stages(failed: str) -> str:
    def cell(s: int, absent: str) -> str:
        return (
            f"CASE WHEN bool_or(s = {s}) THEN coalesce(max(size) FILTER (s = {s}), "
            f"CASE WHEN bool_or(ok) FILTER (s = {s}) THEN 'N/A' ELSE '{failed}' END) ELSE '{absent}' END"
        )

    return f"""SELECT repo_id, {cell(0, failed)} AS original_size, {cell(1, 'NO_OPTIMIZATIONS')} AS static_size,
      {cell(2, 'NO_OPTIMIZATIONS')} AS llm_size FROM stage_builds GROUP BY repo_id"""


_oracle("stage_pivot", _stages("BUILD_FAILED"), "stage_builds")
_oracle("result_csv", _stages("N/A"), "stage_builds")

# --- images and containers ---------------------------------------------------------------------

_ENV12 = _list(f"V{i}={i}" for i in range(12))
_cte(
    "image",
    sql=f"""SELECT p_partkey AS image_id, p_partkey AS k, p_size, p_name,
        CAST(floor(p_retailprice * p_size * 40000) AS BIGINT) AS size,
        p_partkey % 11 = 0 OR p_partkey % 13 = 0 AS bad,
        CASE p_partkey % 6 WHEN 0 THEN ['PATH=/bin', 'PIP_NO_CACHE_DIR=1'] WHEN 1 THEN ['PYTHONUNBUFFERED=1', 'NOEQ', 'A=b=c', 'A=d']
          WHEN 2 THEN [] WHEN 4 THEN ['PIP_NO_CACHE_DIR=0', 'PIP_NO_CACHE_DIR=true'] WHEN 5 THEN {_ENV12} END AS env,
        CASE p_partkey % 5 WHEN 0 THEN ['python', 'app.py'] WHEN 1 THEN ['/bin/sh', '-c', 'Python3 x'] WHEN 2 THEN ['nginx'] WHEN 4 THEN [] END AS cmd
      FROM part""",
)
_cte(
    "layer",
    sql="""SELECT *, l_partkey AS image_id, 'sha256:' || md5(l_orderkey || '-' || l_linenumber) AS layer_id,
        CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) * 10000 END AS size_bytes,
        CASE l_suppkey % 5 WHEN 0 THEN '0B' WHEN 1 THEN q || ' MB' WHEN 2 THEN q || '.5MB' WHEN 3 THEN l_linenumber || '.25 GB'
          ELSE q || ' kB' END AS size_text
      FROM (SELECT *, CAST(floor(l_quantity * 10) AS BIGINT) AS q FROM lineitem)""",
)
_cte(
    "parsed_layer",
    "layer",
    sql="""SELECT *, TRY_CAST(regexp_extract(size_text, '^([0-9.]+) ?[A-Za-z]+$', 1) AS DOUBLE) AS v,
        upper(regexp_extract(size_text, '([A-Za-z]+)$', 1)) AS u FROM layer""",
)
_cte(
    "large_layer",
    "parsed_layer",
    sql="SELECT * FROM parsed_layer WHERE size_text NOT IN ('0B', '0 B') AND (u = 'GB' OR (u = 'MB' AND v > 200))",
)


def _image_rule(rule: str, severity: str, cond: str) -> str:
    return f"SELECT image_id, '{rule}' AS rule_id, '{severity}' AS severity, 1 AS n FROM image WHERE NOT bad AND {cond}"


_cte(
    "image_found",
    "image",
    "large_layer",
    sql=" UNION ALL ".join(
        [
            "SELECT image_id, 'image_inspect_failed' AS rule_id, 'error' AS severity, 1 AS n FROM image WHERE bad",
            _image_rule("image_size", "info", "size > 524288000"),
            _image_rule("image_layers", "info", "p_size > 20"),
            _image_rule("image_root", "warning", "k % 4 <> 3"),
            _image_rule("image_no_healthcheck", "suggestion", "k % 7 <> 0"),
            _image_rule("image_ports_unlabelled", "info", "k % 2 = 0 AND k % 3 <> 0"),
            _image_rule("image_python_buffered", "suggestion", "k % 5 IN (0, 1) AND k % 6 <> 1"),
            _image_rule("image_pip_cache", "info", "k % 6 NOT IN (0, 4)"),
            """SELECT image_id, 'image_large_layer', 'info', count(*) FROM large_layer SEMI JOIN (SELECT image_id FROM image WHERE NOT bad) USING (image_id)
               GROUP BY image_id""",
        ]
    ),
)
_oracle(
    "image_rules",
    """SELECT image_id, rule_id, severity, CAST(n AS BIGINT) AS n FROM image_found
    UNION ALL SELECT image_id, 'image_ok', 'ok', 1 FROM image ANTI JOIN image_found USING (image_id)""",
    "image_found",
)


def _signed(x: str) -> str:
    """Three significant digits, half up, from integer arithmetic."""
    units = [("KB", 1024), ("MB", 1024**2), ("GB", 1024**3), ("TB", 1024**4), ("PB", 1024**5)]
    cases = []
    for i, (name, unit) in enumerate(units):
        top = f"abs({x}) < {unit * 1024}" if i < 4 else "true"
        num = f"CAST(abs({x}) AS HUGEINT)"
        cases.append(f"WHEN {top} AND abs({x}) >= {100 * unit} THEN (({num} * 2 + {unit}) // {2 * unit}) || ' {name}'")
        for digits, low in ((1, 10), (2, 0)):
            scale = 10**digits
            r = f"(({num} * {2 * scale} + {unit}) // {2 * unit})"
            cases.append(f"WHEN {top} AND abs({x}) >= {low * unit} THEN ({r} // {scale}) || '.' || lpad(CAST({r} % {scale} AS VARCHAR), {digits}, '0') || ' {name}'")
    return f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || CASE WHEN abs({x}) < 1024 THEN abs({x}) || ' B' {' '.join(cases)} END"


def _printf(x: str, digits: int, gap: str, names: str) -> str:
    cases = " ".join(
        f"WHEN {x} < {1024 ** (i + 1)} THEN printf('%.{digits}f', {x} / {float(1024**i)}) || '{gap}{u}'" for i, u in enumerate(names.split())
    )
    return f"CASE {cases} END"


_oracle(
    "image_summary",
    f"""SELECT image_id, CASE WHEN k % 4 <> 0 THEN 'img:' || k ELSE '<none>' END AS repo_tags, '<none>' AS repo_digests,
      '2024-01-01T00:00:00Z' AS created, 'amd64' AS architecture, 'linux' AS os, {_signed('size')} AS size, {_signed('size')} AS virtual_size,
      CASE WHEN k % 4 = 3 THEN 'app' ELSE 'root' END AS "user", CASE WHEN k % 3 = 1 THEN '/srv' ELSE '/' END AS working_dir,
      CASE WHEN k % 8 = 0 THEN '/entry, --x' ELSE '<none>' END AS entrypoint,
      CASE WHEN len(cmd) > 0 THEN array_to_string(cmd, ', ') ELSE '<none>' END AS cmd,
      coalesce(array_to_string(env[:10], '|'), '') AS env,
      CASE WHEN k % 3 = 0 THEN 'org.opencontainers.image.source=' || p_name
        WHEN k % 9 = 1 THEN '{"|".join(f"l{i:02d}=v" for i in range(10))}' ELSE '' END AS labels,
      k % 9 = 1 AS more_labels
    FROM image WHERE NOT bad""",
    "image",
)
_oracle(
    "env_map",
    """SELECT image_id, split_part(e, '=', 1) AS key, arg_max(e[strpos(e, '=') + 1:], pos) AS value
    FROM (SELECT image_id, unnest(env) AS e, unnest(range(0, len(env))) AS pos FROM image WHERE NOT bad)
    WHERE contains(e, '=') GROUP BY 1, 2""",
    "image",
)
_oracle("large_layers", "SELECT image_id, layer_id, size_text FROM large_layer", "large_layer")
_oracle("large_layers_strict", "SELECT image_id, layer_id, size_text FROM large_layer WHERE contains(size_text, ' ')", "large_layer")
_oracle(
    "size_parse",
    """SELECT DISTINCT size_text, v AS value, u AS unit,
      v * CASE u WHEN 'B' THEN 1 WHEN 'KB' THEN 1024 WHEN 'MB' THEN 1048576 WHEN 'GB' THEN 1073741824 END AS bytes FROM parsed_layer""",
    "parsed_layer",
)
_oracle(
    "size_format",
    f"""SELECT n, CASE WHEN n < 1024 THEN n || 'B' ELSE {_printf('n', 2, '', 'B KB MB GB TB')} END AS compact,
      {_printf('n', 1, ' ', 'B KB MB GB TB')} AS spaced, {_signed('(-n)')} AS signed
    FROM (SELECT DISTINCT size_bytes AS n FROM layer)""",
    "layer",
)
_oracle(
    "layer_cumulative_size",
    f"""SELECT image_id, layer_no, replace(layer_id, 'sha256:', '')[:12] AS layer, size_bytes, {_signed('size_bytes')} AS size,
      CASE WHEN length(command) > 80 THEN command[:79] || '…' ELSE command END AS command,
      cumulative_bytes, {_signed('cumulative_bytes')} AS cumulative
    FROM (SELECT *, 'RUN step ' || l_returnflag || CASE WHEN l_quantity > 0 THEN ' ' || repeat('x', CAST(l_quantity * 2 AS INTEGER)) ELSE '' END
        || CASE WHEN l_linestatus = 'O' THEN ' (cached)' ELSE '' END AS command,
      row_number() OVER w AS layer_no, CAST(sum(size_bytes) OVER w AS BIGINT) AS cumulative_bytes
      FROM layer WINDOW w AS (PARTITION BY image_id ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate ROWS UNBOUNDED PRECEDING))""",
    "layer",
)
_oracle(
    "layer_digests",
    """SELECT image_id, CAST(i - 1 AS INTEGER) AS pos, 'h' || i AS layer_id, CASE WHEN i % 3 = 0 THEN 0 ELSE CAST(i * 1000 AS BIGINT) END AS size_bytes,
      CASE WHEN i % 3 <> 0 THEN 'sha256:' || md5(CAST(count(*) FILTER (i % 3 <> 0) OVER (PARTITION BY image_id ORDER BY i) AS VARCHAR)) END AS digest
    FROM (SELECT p_partkey AS image_id, unnest(range(1, p_size + 1)) AS i FROM part)""",
)


def _container_rule(rule: str, severity: str, cond: str) -> str:
    return f"SELECT event_id, user_id, ts, '{rule}' AS rule_id, '{severity}' AS severity FROM events WHERE event_id % 97 <> 0 AND {cond}"


_cte(
    "container_found",
    sql=" UNION ALL ".join(
        [
            "SELECT event_id, user_id, ts, 'container_inspect_failed' AS rule_id, 'error' AS severity FROM events WHERE event_id % 97 = 0",
            _container_rule("container_stopped", "warning", "event_type = 'error'"),
            _container_rule("container_unhealthy", "warning", "event_type <> 'error' AND CAST(floor(value) AS BIGINT) % 3 = 2"),
            _container_rule("container_root", "warning", "event_id % 4 <> 3"),
            _container_rule("container_no_restart", "suggestion", "(event_id % 10 = 9 OR event_id % 3 <> 2)"),
            _container_rule("container_privileged", "warning", "event_type = 'signup'"),
            _container_rule("container_no_memory_limit", "info", "event_id % 2 = 0"),
            _container_rule("container_log_driver", "suggestion", "event_id % 5 IN (0, 1)"),
            _container_rule("container_port_unbound", "info", "event_id % 6 = 0"),
        ]
    ),
)
_cte(
    "container_all",
    "container_found",
    sql="""SELECT event_id, user_id AS container_id, rule_id, severity FROM container_found
      UNION ALL SELECT event_id, user_id, 'container_ok', 'ok' FROM events ANTI JOIN container_found USING (event_id)""",
)
_CONTAINERS = "SELECT event_id, container_id, rule_id, severity FROM container_all"
_oracle("container_rules", _CONTAINERS, "container_all")
_oracle("stream_container_findings", _CONTAINERS, "container_all")
_cte(
    "seq",
    sql="SELECT event_id, user_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events",
)
_TRANSITIONS = """SELECT user_id AS container_id, event_id, rule_id, 'opened' AS change FROM (
      SELECT s.user_id, s.event_id, c.rule_id FROM seq s JOIN container_found c USING (event_id)
      WHERE NOT EXISTS (SELECT 1 FROM container_found p WHERE p.event_id = s.prev AND p.rule_id = c.rule_id))
    UNION ALL
    SELECT s.user_id, s.event_id, p.rule_id, 'closed' FROM seq s JOIN container_found p ON p.event_id = s.prev
    WHERE NOT EXISTS (SELECT 1 FROM container_found c WHERE c.event_id = s.event_id AND c.rule_id = p.rule_id)"""
_oracle("container_transitions", _TRANSITIONS, "container_found", "seq")
_oracle("stream_finding_transitions", _TRANSITIONS, "container_found", "seq")
_oracle(
    "listing_parse",
    """SELECT CAST(event_id AS VARCHAR) AS "ID", 'running' AS "State" FROM events
    WHERE event_id % 9 > 1 AND CAST(floor(value) AS BIGINT) % 2 = 0""",
)

# --- mining ------------------------------------------------------------------------------------

_cte(
    "pr",
    sql="""SELECT 'p' || o_orderkey % 20 AS project, o_orderkey // 40 AS pnumber, CAST(floor(o_totalprice) AS BIGINT) % 9 AS n_files,
        o_custkey % 4 AS n_commits, 'change ' || o_orderkey AS title, o_orderkey AS pos FROM orders""",
)
_cte(
    "pr_first",
    "pr",
    sql="""SELECT project, pnumber, CAST(n_files AS INTEGER) AS n_files, CAST(n_commits AS INTEGER) AS n_commits, title, pos
      FROM (SELECT *, row_number() OVER (PARTITION BY project, pnumber ORDER BY pos) AS n FROM pr) WHERE n = 1""",
)
_cte(
    "changed",
    sql=f"""SELECT 'p' || l_orderkey % 20 AS project, l_orderkey // 40 AS pnumber,
        replace({_pick(fr.DIFF_PATHS, 'l_suppkey')}, '{{}}', CAST(l_partkey % 50 AS VARCHAR)) AS path
      FROM lineitem WHERE l_linenumber <> 5""",
)
_cte(
    "pattern",
    sql="""SELECT DISTINCT 'p' || p_partkey % 20 AS project, CASE p_partkey % 3 WHEN 0 THEN 'lib' || p_size || '/' ELSE 'src/m' || p_size || '.' END AS pattern
      FROM part WHERE p_partkey % 3 <> 2""",
)
_cte(
    "counted",
    "changed",
    sql="""SELECT *, NOT (path LIKE '%.txt' OR path LIKE '%.md' OR path LIKE '%.png' OR path LIKE '%jpeg' OR path LIKE '%.in'
        OR contains(path, '/docs/') OR contains(path, '/doc/') OR contains(path, '/Documentation/')) AS ok FROM changed""",
)
_cte(
    "pattern_hit",
    "counted",
    "pattern",
    sql="SELECT DISTINCT c.project, c.pnumber, c.path FROM counted c JOIN pattern p ON p.project = c.project AND contains(c.path, p.pattern) WHERE ok",
)
_oracle("diff_changed_files", "SELECT project, pnumber, path FROM changed", "changed")
_oracle("pr_dedup", "SELECT * FROM pr_first", "pr_first")
_oracle("pattern_semi_join", "SELECT project, pnumber, path FROM pattern_hit", "pattern_hit")
_oracle(
    "pr_select",
    """SELECT f.* FROM pr_first f JOIN (
      SELECT c.project, c.pnumber, count(*) AS n, bool_or(ok AND (regexp_matches(c.path, '\\.(sh|bash|yml|yaml|cmake|config)$')
          OR regexp_matches(c.path, 'Jenkinsfile|Makefile|Dockerfile|Vagrantfile') OR h.path IS NOT NULL)) AS hit
      FROM counted c LEFT JOIN pattern_hit h ON h.project = c.project AND h.pnumber = c.pnumber AND h.path = c.path GROUP BY 1, 2) e
    ON e.project = f.project AND e.pnumber = f.pnumber WHERE n_files <> 0 AND n_commits <> 0 AND n = n_files AND hit""",
    "pr_first",
    "counted",
    "pattern_hit",
)
_cte(
    "commit_file",
    sql="""SELECT 'https://git.example/o' || user_id % 25 || '/r' || user_id AS repo_url, md5(CAST(event_id // 2 AS VARCHAR)) AS sha,
        (['Dockerfile', 'docker-compose.yml', 'main.c', '.dockerignore', 'chart.yaml'])[(CAST(floor(value) AS BIGINT) + event_id) % 5 + 1] AS filename,
        event_id % 4 <> 0 AS changed_only, 'https://github.com/o' || user_id % 25 || '/r' || user_id || '/commit/' || md5(CAST(event_id // 2 AS VARCHAR)) AS commit_url
      FROM events""",
)
_cte("docker_commit", "commit_file", sql="SELECT DISTINCT repo_url, sha, commit_url FROM commit_file WHERE changed_only AND contains(lower(filename), 'docker')")
_oracle(
    "commit_filter",
    "SELECT DISTINCT commit_url FROM docker_commit WHERE repo_url IN (SELECT url FROM sheet WHERE wanted AND \"Id\" <> 'Section')",
    "docker_commit",
    "sheet",
)
_oracle("commit_path_test", "SELECT DISTINCT commit_url FROM commit_file WHERE changed_only AND regexp_matches(filename, '(?i)(Dockerfile|docker-compose\\.yml|\\.ya?ml$|\\.helm$)')", "commit_file")
_oracle(
    "commit_url_parts",
    "SELECT DISTINCT commit_url, split_part(commit_url, '/', 4) AS owner, split_part(commit_url, '/', 5) AS repo, sha FROM docker_commit",
    "docker_commit",
)
_oracle("hash_sample", "SELECT commit_url FROM (SELECT DISTINCT commit_url FROM docker_commit) ORDER BY md5('7:' || commit_url) LIMIT 333", "docker_commit")
_cte(
    "log_line",
    sql="""SELECT source, CAST(n AS INTEGER) AS line_no, content, regexp_matches(lower(content), 'license|http|the') AS hit FROM (
        SELECT doc_id AS source, unnest(l) AS content, unnest(range(1, len(l) + 1)) AS n
        FROM (SELECT doc_id, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM (SELECT doc_id, regexp_split_to_array(text || CASE WHEN doc_id % 4 = 0 THEN chr(10) ELSE '' END, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]') AS l FROM documents)))""",
)
_CONTEXT = """SELECT m.source, m.line_no AS match_line, c.line_no, CASE WHEN c.line_no = m.line_no THEN '*' ELSE '' END AS marker, c.content
    FROM log_line m JOIN log_line c ON c.source = m.source AND c.line_no BETWEEN m.line_no - 2 AND m.line_no + 2 WHERE m.hit"""
_oracle("log_context", _CONTEXT, "log_line")
_oracle("log_context_by_line", _CONTEXT, "log_line")
_oracle("log_matches", "SELECT source, line_no, content FROM log_line WHERE hit", "log_line")

# --- model replies -----------------------------------------------------------------------------

_cte(
    "reply",
    sql=f"""SELECT *, CASE shape WHEN 5 THEN 'api_error' WHEN 6 THEN 'partial' WHEN 7 THEN 'parse_error' ELSE 'ok' END AS status,
        shape IN (0, 1, 2, 3, 4) AS whole, shape IN (0, 1, 2, 3, 4, 6) AS lists FROM (
        SELECT conv_id * 8 + turn AS id, (conv_id + turn) % 10 AS shape, conv_id, turn, role, text,
          list_transform(range(1, 1 + CASE WHEN conv_id % 20 = 6 THEN {fr.LONG_LIST} ELSE turn % 4 + conv_id % 3 END), lambda k: 'open "port" ' || (k % 4)) AS risks,
          ({_list(fr.SLOW)})[:length(text) % 5] AS perf,
          CASE conv_id % 3 WHEN 0 THEN [] WHEN 1 THEN ['use multi-stage builds'] ELSE ['minimize layers', 'pin versions'] END AS opts,
          ({_list(fr.MISSING)})[:(conv_id + turn) % 10] AS miss,
          (conv_id * 37) % 1000 * CAST(1.5 AS DOUBLE) AS waste, turn % 10 + CAST(0.5 AS DOUBLE) AS cx, CAST(conv_id % 10 AS DOUBLE) AS mt,
          conv_id % 23 AS n_rec FROM conversations)""",
)
_cte(
    "analysis",
    "reply",
    sql="""SELECT id, status, conv_id, turn, CASE WHEN lists THEN risks ELSE [] END AS risks, CASE WHEN lists THEN perf ELSE [] END AS perf,
        CASE WHEN whole THEN opts ELSE [] END AS opts, CASE WHEN whole THEN miss ELSE [] END AS miss,
        CASE WHEN whole THEN waste ELSE 0.0 END AS waste, CASE WHEN whole THEN cx ELSE 5.0 END AS cx, CASE WHEN whole THEN mt ELSE 5.0 END AS mt,
        CASE WHEN whole THEN text ELSE '' END AS assessment, CASE WHEN whole THEN n_rec ELSE 0 END AS n_rec,
        CASE status WHEN 'api_error' THEN 'LLM API error: 429 out of quota' WHEN 'parse_error' THEN 'The reply is not valid JSON' END AS error
      FROM reply""",
)


def _join(column: str) -> str:
    return f"array_to_string({column}, '|')"


_oracle(
    "response_parse",
    f"""SELECT id, status, {_join('risks')} AS security_risks, {_join('perf')} AS performance_issues, {_join('opts')} AS optimization_opportunities,
      '' AS runtime_concerns, {_join('miss')} AS best_practices_missing, waste AS estimated_wasted_space_kb, cx AS complexity_score,
      mt AS maintainability_score, assessment AS overall_assessment, CAST(n_rec AS INTEGER) AS n_recommendations FROM analysis""",
    "analysis",
)
_oracle("response_salvage", f"SELECT id, {_join('risks')} AS security_risks, {_join('perf')} AS performance_issues FROM analysis WHERE status = 'partial'", "analysis")
_oracle(
    "response_errors",
    """SELECT CASE WHEN contains(error, '429') THEN 'quota' WHEN contains(error, '401') OR contains(lower(error), 'invalid') THEN 'bad_key'
        WHEN error IS NOT NULL THEN 'other' END AS error_class, count(*) AS n
    FROM (SELECT error FROM analysis
      UNION ALL SELECT CASE WHEN starts_with(raw, 'Error:') THEN raw END FROM fix_raw) GROUP BY 1""",
    "analysis",
    "fix_raw",
)
# The size words as a pattern.
_WORDS = "size|layer|cache|no-cache|multi-stage|apt-get clean|rm -rf /var/lib/apt/lists|--no-install-recommends|--no-cache-dir|reduce|smaller|minimize|compress"
_cte(
    "size_issue",
    "analysis",
    sql=f"SELECT id, list_filter(list_concat(perf, opts), lambda t: regexp_matches(lower(t), '{_WORDS}')) AS issues, status, waste FROM analysis",
)
_oracle("model_size_issues", "SELECT id, CAST(unnest(range(0, len(issues))) AS INTEGER) AS pos, unnest(issues) AS issue FROM size_issue", "size_issue")
_cte(
    "rec",
    "analysis",
    sql=f"""SELECT id, k, ({_list(fr.CATEGORIES)})[k * k % 5 + 1] AS category, 'do ' || k AS message,
        CASE WHEN k % 3 <> 0 THEN 'high' ELSE 'medium' END AS severity, k % 4 AS line
      FROM (SELECT id, unnest(range(1, n_rec + 1)) AS k FROM analysis)""",
)
_oracle(
    "top5_per_category",
    """SELECT id, category, CAST(n_total AS INTEGER) AS n_total, CAST(rank AS INTEGER) AS rank, severity, message FROM (
      SELECT *, count(*) OVER (PARTITION BY id, category) AS n_total, row_number() OVER (PARTITION BY id, category ORDER BY k) AS rank FROM rec
      WHERE category <> 'other') WHERE rank <= 5""",
    "rec",
)
_oracle(
    "top5_issues",
    " UNION ALL ".join(
        f"""SELECT id, '{name}' AS list_name, CAST(len({f}) AS INTEGER) AS n_total, CAST(unnest(range(1, len({f}[:5]) + 1)) AS INTEGER) AS rank,
        unnest({f}[:5]) AS issue FROM analysis"""
        for name, f in (("security_risks", "risks"), ("performance_issues", "perf"), ("optimization_opportunities", "opts"), ("best_practices_missing", "miss"))
    ),
    "analysis",
)
_cte(
    "score",
    "analysis",
    sql="""SELECT *, CAST(greatest(0, 100 - 12 * len(risks)) AS DOUBLE) AS security, CAST(greatest(0, 100 - 9 * len(perf)) AS DOUBLE) AS efficiency,
        CAST(greatest(0, 100 - 12 * len(miss)) AS DOUBLE) AS best_practices FROM analysis""",
)
_cte(
    "scored",
    "score",
    sql="""SELECT * EXCLUDE (security, efficiency, best_practices, cx, mt, waste),
        CASE WHEN good THEN (CAST(security AS BIGINT) * 3 + CAST(efficiency AS BIGINT) * 4 + CAST(best_practices AS BIGINT) * 3) / CAST(10 AS DOUBLE) END AS overall,
        CASE WHEN good THEN security END AS security, CASE WHEN good THEN efficiency END AS efficiency, CASE WHEN good THEN best_practices END AS best_practices,
        CASE WHEN good THEN cx END AS complexity, CASE WHEN good THEN mt END AS maintainability, CASE WHEN good THEN waste END AS wasted_kb
      FROM (SELECT *, status IN ('ok', 'partial') AS good FROM score)""",
)
_SCORES = ("overall", "security", "efficiency", "best_practices", "complexity", "maintainability", "wasted_kb")
_oracle("issue_scores", f"SELECT id, status, {', '.join(_SCORES)} FROM scored", "scored")


def _numbered(title: str, field: str) -> str:
    items = f"list_transform(({field})[:10], lambda t, i: i || '. ' || t || chr(10))"
    return f"chr(10) || '{title} (' || len({field}) || '):' || chr(10) || array_to_string({items}, '')"


_cte(
    "rec_text",
    "rec",
    sql="""SELECT id, count(*) AS n, string_agg('- [' || upper(severity) || '] ' || category || ': ' || message
          || CASE WHEN line <> 0 THEN ' (line ' || line || ')' ELSE '' END || chr(10), '' ORDER BY k) FILTER (k <= 15) AS t
      FROM rec GROUP BY id""",
)
_oracle(
    "fix_prompt",
    f"""SELECT s.id AS file_id, 'Correct only the issues listed and return the whole build file as plain text.' || chr(10) || chr(10) || content || chr(10) || chr(10)
      || {" || ".join(f"'{n}: ' || CAST({n} AS VARCHAR) || '/100' || chr(10)" for n in ('security', 'efficiency', 'best_practices', 'overall'))}
      || {_numbered('Security risks', 'risks')} || {_numbered('Performance issues', 'perf')}
      || {_numbered('Optimisation options', 'opts')} || {_numbered('Missing practices', 'miss')}
      || CASE WHEN r.n > 0 THEN chr(10) || 'Recommendations (' || r.n || '):' || chr(10) || r.t ELSE '' END AS prompt
    FROM scored s JOIN texts ON texts.file_id = s.id LEFT JOIN rec_text r ON r.id = s.id WHERE good""",
    "scored",
    "texts",
    "rec_text",
)
_cte("before_after", "scored", sql="SELECT b.id AS file_id, b, a FROM scored b JOIN scored a ON a.id = b.id + 1 WHERE b.id % 2 = 0 AND b.good AND a.good")
_oracle(
    "score_improvement",
    " UNION ALL ".join(
        f"""SELECT file_id, '{n}' AS score_key, b.{n} AS original, a.{n} AS fixed, round(a.{n} - b.{n}, 1) AS improvement,
        CASE WHEN b.{n} > 0 THEN round((a.{n} - b.{n}) / b.{n} * 100, 1) ELSE 0.0 END AS percent_change FROM before_after"""
        for n in _SCORES[:-1]
    ),
    "before_after",
)


def _set_ops(section: str, field: str) -> str:
    b, a = f"list_distinct(b.{field})", f"list_distinct(a.{field})"

    def sorted_join(value: str) -> str:
        return f"array_to_string(list_sort({value}), '|')"

    return f"""SELECT file_id, '{section}' AS section, CAST(len({b}) AS INTEGER) AS original_count, CAST(len({a}) AS INTEGER) AS fixed_count,
      {sorted_join(f'list_filter({b}, lambda x: NOT list_contains({a}, x))')} AS fixed,
      {sorted_join(f'list_filter({a}, lambda x: NOT list_contains({b}, x))')} AS "new",
      {sorted_join(f'list_filter({a}, lambda x: list_contains({b}, x))')} AS remaining,
      CAST(greatest(0, len({b}) - len({a})) AS INTEGER) AS n_resolved, len({b}) > 0 AND len({a}) = 0 AS all_resolved FROM before_after"""


_SECTIONS = (("security_risks", "risks"), ("performance_issues", "perf"), ("missing_practices", "miss"))
_oracle("issue_set_diff", " UNION ALL ".join(_set_ops(s, f) for s, f in _SECTIONS), "before_after")

_cte(
    "card",
    "build_files",
    "scored",
    "fix_status",
    sql="""SELECT f.file_id, 'https://git.example/acme/repo-' || repo_id AS repo_url, path, b, a, x.status AS fix,
        coalesce(b.good, false) AS ok1, coalesce(b.good, false) AND coalesce(x.status = 'ok', false) AS ok2,
        coalesce(b.good, false) AND coalesce(x.status = 'ok', false) AND coalesce(a.good, false) AS ok3
      FROM build_files f LEFT JOIN (SELECT * FROM scored WHERE id % 2 = 0) b ON b.id = f.file_id
        LEFT JOIN (SELECT * FROM scored WHERE id % 2 = 1) a ON a.id = f.file_id + 1 AND f.file_id % 2 = 0
        LEFT JOIN fix_status x ON x.file_id = f.file_id""",
)
_oracle(
    "scorecard_table",
    f"""SELECT file_id, repo_url, path, {', '.join(f'b.{n} AS original_{n}' for n in _SCORES)},
      {', '.join(f'CASE WHEN ok3 THEN a.{n} WHEN ok2 THEN b.{n} END AS fixed_{n}' for n in _SCORES)},
      {', '.join(f'CASE WHEN ok3 THEN round(a.{n} - b.{n}, 1) END AS improvement_{n}' for n in _SCORES[:4])},
      {', '.join(f'CASE WHEN ok3 THEN CAST(len(list_distinct(b.{f})) AS INTEGER) END AS {s}_before, CASE WHEN ok3 THEN CAST(len(list_distinct(a.{f})) AS INTEGER) END AS {s}_after' for s, f in _SECTIONS)},
      CASE WHEN NOT ok1 THEN coalesce(b.error, 'The analysis failed') END AS llm_error,
      CASE WHEN ok1 AND NOT ok2 THEN 'No new build file in the reply' END AS fix_error,
      CASE WHEN ok2 AND NOT ok3 THEN coalesce(a.error, 'The validation failed') END AS validation_error FROM card""",
    "card",
)
_oracle(
    "run_metadata",
    "SELECT count(DISTINCT repo_url) AS repo_count, count(*) AS dockerfile_count, count(*) FILTER (ok2) AS n_success FROM card",
    "card",
)
_cte(
    "fix_base",
    "fixed",
    "static_done",
    sql="""SELECT file_id, CASE WHEN starts_with(raw, 'Error:') OR starts_with(raw, 'LLM API error:') THEN raw
        WHEN fixed <> '' AND fixed <> text THEN NULL ELSE 'No new build file in the reply' END AS fix_error
      FROM fixed JOIN static_done USING (file_id)""",
)
_cte(
    "size_run",
    "preferred",
    "static_done",
    "size_issue",
    "fix_base",
    sql="""SELECT c_custkey AS repo_id, p.file_id, coalesce(s.n_changes, 0) AS static_issues, coalesce(s.saving_kb, 0) AS static_kb,
        coalesce(CASE WHEN i.status IN ('ok', 'partial') AND x.file_id IS NOT NULL AND x.fix_error IS NULL THEN len(i.issues) END, 0) AS llm_issues,
        coalesce(CASE WHEN i.status IN ('ok', 'partial') AND len(i.issues) > 0 AND x.file_id IS NOT NULL AND x.fix_error IS NULL THEN
          list_sum(list_transform(i.issues, lambda t: CASE WHEN contains(lower(t), 'cache') OR contains(lower(t), 'clean') THEN 10000
            WHEN contains(lower(t), 'multi-stage') THEN 100000 WHEN contains(lower(t), 'layer') THEN 20000 ELSE 0 END)) + greatest(i.waste, 0) END, 0) AS llm_kb,
        CASE WHEN p.file_id IS NULL THEN 'no_dockerfile' WHEN i.id IS NULL THEN 'no reply' WHEN a.error IS NOT NULL THEN a.error
          WHEN len(i.issues) > 0 AND x.file_id IS NULL THEN 'no fix reply' WHEN len(i.issues) > 0 THEN x.fix_error END AS error
      FROM customer c LEFT JOIN preferred p ON p.repo_id = c_custkey LEFT JOIN static_done s ON s.file_id = p.file_id
        LEFT JOIN size_issue i ON i.id = p.file_id LEFT JOIN analysis a ON a.id = p.file_id
        LEFT JOIN fix_base x ON x.file_id = p.file_id""",
)
_oracle(
    "size_run",
    """SELECT repo_id, file_id, CAST(static_issues AS BIGINT) AS static_issues, CAST(static_kb AS BIGINT) AS static_kb, CAST(llm_issues AS BIGINT) AS llm_issues,
      CAST(llm_kb AS DOUBLE) AS llm_kb, CAST(static_kb + llm_kb AS DOUBLE) AS total_kb, error FROM size_run""",
    "size_run",
)
_oracle(
    "corpus_summary",
    """SELECT count(*) AS n_repos, count(*) FILTER (error IS NULL) AS n_files, CAST(sum(static_issues) AS BIGINT) AS static_changes,
      CAST(sum(llm_issues) AS BIGINT) AS llm_changes, CAST(sum(static_kb + llm_kb) AS DOUBLE) AS saving_kb,
      CAST(round(sum(static_kb + llm_kb) / 1024, 1) AS DOUBLE) AS saving_mb FROM size_run""",
    "size_run",
)

# --- builds ------------------------------------------------------------------------------------

_cte(
    "build_line",
    sql=f"""SELECT l_orderkey AS build_id, {_pick(fr.BUILD_LINES, 'l_partkey')} AS line,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rank FROM lineitem""",
)
_oracle(
    "buildlog_extract",
    """SELECT build_id, count(*) FILTER (contains(line, 'Step') AND contains(line, '/')) AS step_count,
      arg_max(size, n) FILTER (size <> '' AND n > last_tag) AS final_size
    FROM (SELECT *, regexp_replace(CASE WHEN contains(line, 'MB') OR contains(line, 'GB') THEN regexp_extract(line, '(?:^|\\s)(\\S+\\s+(?:MB|GB|KB))(?:\\s|$)', 1) ELSE '' END, '\\s+', ' ') AS size,
      max(CASE WHEN contains(line, 'Successfully tagged') THEN n ELSE 0 END) OVER (PARTITION BY build_id) AS last_tag FROM build_line) GROUP BY build_id""",
    "build_line",
)
_oracle("tail_lines", "SELECT build_id, CAST(rank AS INTEGER) AS rank, line FROM build_line WHERE rank <= 5 AND trim(line) <> ''", "build_line")
_cte("run", sql="SELECT o_orderkey AS build_id, o_orderstatus AS s, floor(o_totalprice) / 1024 AS sec FROM orders")
_oracle(
    "build_outcomes",
    """SELECT build_id, s = 'F' AS success, CASE WHEN s = 'P' AND sec >= 300 THEN 300.0 ELSE round(sec, 2) END AS build_seconds,
      CASE WHEN s = 'P' AND sec >= 300 THEN 'Build exceeded the limit of 300 s' WHEN s = 'F' THEN '' ELSE 'exit ' || s END AS error_text FROM run""",
    "run",
)
_oracle("failed_builds", "SELECT build_id FROM run WHERE s <> 'F'", "run")
_oracle(
    "status_rollup",
    """SELECT CASE o_orderkey % 4 WHEN 0 THEN 'skipped' WHEN 1 THEN 'passed' WHEN 2 THEN 'failed' ELSE 'unknown' END AS test_status,
      count(*) AS n_files, bool_and(o_orderstatus <> 'P' AND o_orderkey % 4 <> 2) AS all_ok FROM orders GROUP BY 1""",
)

# --- labels ------------------------------------------------------------------------------------

_cte(
    "rating",
    sql="""SELECT 'quality' AS question, quality AS a, CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS b FROM labels WHERE doc_id % 13 <> 0
      UNION ALL SELECT 'toxic', toxic, CASE WHEN doc_id % 11 = 0 THEN 1 - toxic ELSE toxic END FROM labels WHERE doc_id % 13 <> 0""",
)
_oracle(
    "kappa",
    """SELECT question, n AS n_items, round(o, 6) AS observed, round(e, 6) AS expected, round(CASE WHEN e < 1 THEN (o - e) / (1 - e) END, 6) AS kappa FROM (
      SELECT question, n, agree / n AS o, (a1 * CAST(b1 AS DOUBLE) + (n - a1) * CAST(n - b1 AS DOUBLE)) / (n * CAST(n AS DOUBLE)) AS e FROM (
        SELECT question, count(*) AS n, count(*) FILTER (a = b) AS agree, count(*) FILTER (a = 1) AS a1, count(*) FILTER (b = 1) AS b1 FROM rating GROUP BY 1))""",
    "rating",
)
_cte(
    "taxon",
    sql="""SELECT label, count(*) AS freq, bool_or(p_size % 4 = 0) AS is_new FROM (
        SELECT p_type || CASE WHEN p_size % 10 = 0 THEN '' ELSE '_' || p_brand || '_s' || p_size END AS label, p_size FROM part) GROUP BY 1""",
)
_oracle(
    "taxonomy_rollup",
    """SELECT coalesce(l1, '(all)') AS level1, coalesce(l2, '(all)') AS level2, CAST(2 - grouping(l1) - grouping(l2) AS INTEGER) AS depth,
      CAST(sum(freq) AS BIGINT) AS freq, count(*) AS n_labels, count(*) FILTER (is_new) AS n_new
    FROM (SELECT *, split_part(label, '_', 1) AS l1, CASE WHEN contains(label, '_') THEN split_part(label, '_', 2) ELSE '-' END AS l2 FROM taxon)
    GROUP BY ROLLUP (l1, l2)""",
    "taxon",
)
_cte(
    "relation",
    sql="""SELECT o_orderkey AS row_no, last_value(CASE WHEN o_orderkey % 5 = 1 THEN o_orderpriority || '-' || o_custkey END IGNORE NULLS)
        OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS left_label, o_orderstatus AS right_label FROM orders""",
)
_oracle("relation_fill", "SELECT row_no, left_label, right_label FROM relation", "relation")
_oracle("relation_counts", "SELECT left_label, right_label, count(*) AS occurrences FROM relation GROUP BY 1, 2", "relation")
_cte(
    "observed",
    sql="""SELECT *, coalesce(final_bytes, static_bytes, before_bytes) AS best FROM (
        SELECT p_partkey AS repo, CASE WHEN p_partkey % 9 <> 0 THEN (p_size + 0.5::DOUBLE) * 1073741824 END AS before_bytes,
          CASE WHEN p_partkey % 4 <> 0 THEN p_size * 20 * 1048576::DOUBLE END AS static_bytes,
          CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 11 = 0 THEN (p_size + 1) * 1073741824::DOUBLE END AS final_bytes,
          CASE WHEN p_partkey % 4 = 0 THEN 'no_optimizations' ELSE 'measured' END AS static_status,
          CASE WHEN p_partkey % 5 = 0 THEN 'build_failed' WHEN p_partkey % 7 = 0 THEN 'n/a' WHEN p_partkey % 11 = 0 THEN 'measured' ELSE 'n/a' END AS final_status
        FROM part)""",
)
_oracle(
    "size_reduction",
    "SELECT * EXCLUDE (best), before_bytes - best AS saved_bytes, round(best / before_bytes, 4) AS ratio FROM observed",
    "observed",
)
_oracle(
    "size_reduction_summary",
    """SELECT count(*) AS n_images, count(before_bytes) AS n_measured, sum(before_bytes - best) AS saved_bytes,
      count(*) FILTER (before_bytes < best) AS n_grown, count(*) FILTER (before_bytes > best) AS n_shrunk FROM observed""",
    "observed",
)

_cte("image_only", "image_found", sql="SELECT * FROM image_found WHERE rule_id NOT IN ('image_large_layer', 'image_ok')")
_oracle(
    "stream_image_findings",
    """SELECT * FROM image_only UNION ALL
    SELECT image_id, 'image_ok', 'ok', 1 FROM image WHERE image_id NOT IN (SELECT image_id FROM image_only)""",
    "image_only",
    "image",
)
_oracle(
    "size_reduction_percentiles",
    """SELECT quantile_cont(r, 0.1) AS ratio_p10, quantile_cont(r, 0.5) AS ratio_p50, quantile_cont(r, 0.9) AS ratio_p90
    FROM (SELECT round(best / before_bytes, 4) AS r FROM observed)""",
    "observed",
)
_oracle("batch_ok", "SELECT bool_and(o_orderstatus <> 'P' AND o_orderkey % 4 <> 2) AS all_success FROM orders")
_oracle(
    "lint_size_review",
    """SELECT rule_id, count(*) AS n FROM found WHERE rule_id IN
      ('apt_no_recommends', 'apt_clean', 'apt_update_split', 'pip_cache', 'combine_run', 'multi_stage') GROUP BY 1""",
    "found",
)
_oracle(
    "lint_missing_files",
    "SELECT file_id, CAST(-1 AS INTEGER) AS idx, 'missing_file' AS rule_id, 'error' AS severity FROM build_files WHERE file_id % 10 = 0",
    "build_files",
)
_oracle(
    "repo_list_limited",
    """(SELECT 'split' AS which, line_no, url FROM repo_parts ORDER BY line_no, part LIMIT 25)
    UNION ALL (SELECT 'plain', line_no, url FROM repo_plain ORDER BY line_no LIMIT 25)""",
    "repo_parts",
    "repo_plain",
)
_oracle(
    "large_layer_findings",
    "SELECT image_id, layer_id, size_text, 'image_large_layer' AS rule_id, 'info' AS severity FROM large_layer",
    "large_layer",
)
_oracle(
    "commit_details",
    """SELECT f.repo_url, f.sha, filename, (['ADD', 'MODIFY', 'DELETE', 'RENAME'])[f.event_id % 4 + 1] AS change_type,
      'dev' || c.event_id % 7 AS author, 'change ' || c.event_id AS message
    FROM (SELECT *, 'https://git.example/o' || user_id % 25 || '/r' || user_id AS repo_url, md5(CAST(event_id // 2 AS VARCHAR)) AS sha,
        (['Dockerfile', 'docker-compose.yml', 'main.c', '.dockerignore', 'chart.yaml'])[(CAST(floor(value) AS BIGINT) + event_id) % 5 + 1] AS filename
        FROM events) f
      JOIN (SELECT user_id, event_id // 2 AS pair, min(event_id) AS event_id FROM events GROUP BY 1, 2) c
      ON c.user_id = f.user_id AND c.pair = f.event_id // 2""",
)
_oracle("commit_list_file", "SELECT DISTINCT commit_url FROM docker_commit", "docker_commit")
# The shorter list of size words.
_oracle(
    "model_review_issues",
    """SELECT id, CAST(unnest(range(0, len(l))) AS INTEGER) AS pos, unnest(l) AS issue FROM (SELECT id, list_filter(list_concat(perf, opts), lambda t:
      regexp_matches(lower(t), 'size|layer|cache|no-cache|multi-stage|apt-get clean|rm -rf /var/lib/apt/lists|--no-install-recommends|--no-cache-dir')) AS l
    FROM analysis)""",
    "analysis",
)
_oracle("analysis_json", f"SELECT id, status, CAST(n_rec AS INTEGER) AS n_recommendations, {_join('risks')} AS risks FROM analysis", "analysis")
_oracle("pr_csv", "SELECT * FROM pr_first", "pr_first")

# --- streams -----------------------------------------------------------------------------------

_CHUNKS = """SELECT id, string_agg(CASE WHEN i = 1 THEN w ELSE ' ' || w END, '' ORDER BY i) AS text,
      CAST(count(*) AS INTEGER) AS n_chunks, CASE WHEN max(i) = any_value(n) THEN 'stop' END AS finish_reason
    FROM (SELECT conv_id * 8 + turn AS id, unnest(string_split(text, ' ')) AS w, unnest(range(1, len(string_split(text, ' ')) + 1)) AS i,
      len(string_split(text, ' ')) AS n FROM conversations) GROUP BY 1"""
_oracle("chunk_reassembly", _CHUNKS)
_oracle("stream_chunk_reassembly", _CHUNKS)

_cte(
    "on_time",
    sql="""SELECT event_id, ts, user_id FROM events, (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events)
      WHERE NOT (event_id % 50 = 7 AND (epoch_us(ts) - lo) * 4 // (hi - lo + 1) = 0)""",
)
_cte(
    "listed",
    "on_time",
    sql="""SELECT event_id, user_id, epoch_us(ts) AS "at", lag(event_id) OVER w AS prev, lag(epoch_us(ts)) OVER w + 86400000000 AS gone_at,
        lead(event_id) OVER w IS NULL AS is_last
      FROM on_time WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
_EXPIRY = """SELECT user_id AS container_id, "at", rule_id, 'opened' AS change FROM (
      SELECT l.user_id, l."at", c.rule_id FROM listed l JOIN container_found c USING (event_id)
      WHERE l."at" > l.gone_at OR NOT EXISTS (SELECT 1 FROM container_found p WHERE p.event_id = l.prev AND p.rule_id = c.rule_id))
    UNION ALL
    SELECT l.user_id, l."at", p.rule_id, 'closed' FROM listed l JOIN container_found p ON p.event_id = l.prev
    WHERE l."at" <= l.gone_at AND NOT EXISTS (SELECT 1 FROM container_found c WHERE c.event_id = l.event_id AND c.rule_id = p.rule_id)
    UNION ALL
    SELECT l.user_id, l.gone_at, p.rule_id, 'closed' FROM listed l JOIN container_found p ON p.event_id = l.prev WHERE l."at" > l.gone_at
    UNION ALL
    SELECT l.user_id, l."at" + 86400000000, c.rule_id, 'closed' FROM listed l JOIN container_found c USING (event_id)
    WHERE l.is_last AND l."at" + 86400000000 < (SELECT max("at") FROM listed) - 3600000000"""
_oracle("stream_finding_expiry", _EXPIRY, "container_found", "listed")
_oracle("finding_expiry", _EXPIRY, "container_found", "listed")
_oracle(
    "stream_finding_counts",
    """SELECT CAST("at" // 86400000000 * 86400 AS BIGINT) AS day, rule_id, count(*) AS n
    FROM listed JOIN (SELECT event_id, rule_id FROM container_all) USING (event_id)
    GROUP BY 1, 2 HAVING (day + 86400) * 1000000 <= (SELECT max("at") FROM listed) - 3600000000""",
    "container_all",
    "listed",
)
_cte(
    "timed_chunks",
    sql="""SELECT id, seq, n, text, "at", seq = n - 1 AND id % 7 <> 3 AS is_end, conv_id * 4 // all_convs = 0 AND id % 13 = 4 AND seq = 0 AS is_late
      FROM (SELECT conv_id, conv_id * 8 + turn AS id, unnest(range(0, len(p))) AS seq, unnest(p) AS text, len(p) AS n,
          1704067200 + conv_id * 300 + turn * 3 + unnest(range(0, len(p))) AS "at"
        FROM (SELECT *, string_split(text, '. ') AS p FROM conversations)), (SELECT max(conv_id) + 1 AS all_convs FROM conversations)
      WHERE NOT (id % 11 = 5 AND seq = 1)""",
)
_CLOSED = """SELECT id, string_agg(text, '' ORDER BY seq) AS text, CAST(count(*) AS INTEGER) AS n_chunks,
      CASE WHEN bool_or(is_end) THEN 'stop' END AS finish_reason,
      CASE WHEN bool_or(is_end) AND count(*) = any_value(n) THEN 'finish' ELSE 'timeout' END AS closed
    FROM timed_chunks WHERE NOT is_late GROUP BY id
    HAVING closed = 'finish' OR max("at") + 60 < (SELECT max("at") FROM timed_chunks) - 600"""
_oracle("stream_completions", _CLOSED, "timed_chunks")
_oracle("closed_completions", _CLOSED, "timed_chunks")

# --- readers -----------------------------------------------------------------------------------

_oracle(
    "read_build_tree",
    """SELECT file_id, file_name, is_plausible, md5(content) AS digest FROM (
      SELECT b.file_id, file_name, coalesce(bool_or(NOT starts_with(trim(raw), '#') AND upper(trim(raw)) LIKE 'FROM%'), false) AS is_plausible
      FROM build_files b LEFT JOIN lines l USING (file_id) GROUP BY ALL) JOIN texts USING (file_id)""",
    "build_files",
    "lines",
    "texts",
)
_oracle("read_log_tree", "SELECT source, line_no, content FROM log_line", "log_line")
_oracle(
    "read_pull_requests",
    """SELECT project, CAST(pnumber AS INTEGER) AS pnumber, pos % 2 = 0 AS is_merged, CAST(n_files AS INTEGER) AS n_files, CAST(n_commits AS INTEGER) AS n_commits,
      3 AS n_listed, title || ', "quoted"' AS title,
      'He said: "' || o_orderpriority || '"' || chr(10) || chr(10) || '- item, ' || o_custkey || CASE WHEN pos % 3 = 0 THEN chr(13) || chr(10) || ';end' || chr(10) ELSE '' END AS body,
      true AS never_merged
    FROM pr JOIN orders ON pos = o_orderkey""",
    "pr",
)
_oracle("read_patterns", "SELECT DISTINCT project, pattern FROM pattern", "pattern")
_oracle(
    "read_annotations",
    "SELECT 'p' || doc_id % 20 AS project, CAST(doc_id AS VARCHAR) AS pnumber, "
    + ", ".join(
        f"'q{k};r{r}' || chr(10) || doc_id % {k + r + 1} AS {q}_{r}"
        for k, q in enumerate(("is_challenge", "is_specific", "bad_practice", "challenge", "mitigation", "restructuring"))
        for r in (1, 2)
    )
    + " FROM labels",
)
_oracle(
    "read_taxonomy",
    """SELECT 'bad_practice' AS kind, label, CAST(len(string_split(label, '_')) AS INTEGER) AS levels, CAST(freq AS INTEGER) AS freq,
      CASE WHEN is_new THEN 'YES' ELSE 'NO' END AS is_new FROM taxon""",
    "taxon",
)
_oracle(
    "read_relations",
    """SELECT CASE WHEN o_orderkey % 5 = 1 THEN o_orderpriority || '-' || o_custkey ELSE '' END AS left_label, o_orderstatus AS right_label,
      count(*) AS n, CAST(sum(o_orderkey % 7) AS BIGINT) AS occurrences FROM orders GROUP BY 1, 2""",
)
_oracle("read_observed_sizes", "SELECT * EXCLUDE (best), before_bytes - best AS saved_bytes, round(best / before_bytes, 4) AS ratio FROM observed", "observed")
_oracle(
    "image_listing",
    "SELECT CAST(p_partkey AS VARCHAR) AS \"ID\", p_brand || ':' || CASE WHEN p_partkey % 4 = 0 THEN '<none>' ELSE 'v1' END AS name FROM part WHERE p_partkey % 10 <> 3",
)
_oracle(
    "image_history",
    """SELECT p_partkey AS image_id, CAST(i - i // 5 - 1 AS INTEGER) AS pos, 'h' || i AS "ID", i * 10 || 'MB' AS "Size"
    FROM (SELECT p_partkey, unnest(range(1, p_size + 1)) AS i FROM part) WHERE i % 5 <> 0""",
)
