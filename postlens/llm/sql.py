"""DuckDB SQL for the queries that SQL can express, written without the operators' methods."""

from __future__ import annotations

LINES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM pieces),
shared AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40
           GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, coalesce(doc_id < top, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

# Spans: the n-th match starts after the first n gaps and n - 1 matches; a window's entropy is
# summed afresh from its own characters.
SECRETS = r"""
WITH kinds(kind, rank, least) AS (VALUES ('assign', 0, 6), ('access', 1, 20), ('hex', 2, 24), ('run', 3, 20)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
hits AS (
  SELECT r, kind, rank, least,
    unnest(CASE kind
      WHEN 'assign' THEN regexp_extract_all(text, '{assign}')
      WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+')
      WHEN 'hex' THEN regexp_extract_all(text, '[0-9a-f]+')
      ELSE regexp_extract_all(text, '[A-Za-z0-9+/_=-]+') END) AS m,
    unnest(CASE kind
      WHEN 'assign' THEN string_split_regex(text, '{assign}')
      WHEN 'access' THEN string_split_regex(text, 'AKIA[A-Z0-9]+')
      WHEN 'hex' THEN string_split_regex(text, '[0-9a-f]+')
      ELSE string_split_regex(text, '[A-Za-z0-9+/_=-]+') END) AS gap,
    generate_subscripts(string_split_regex(text, CASE kind
      WHEN 'assign' THEN '{assign}'
      WHEN 'access' THEN 'AKIA[A-Z0-9]+' WHEN 'hex' THEN '[0-9a-f]+' ELSE '[A-Za-z0-9+/_=-]+' END), 1) AS i
  FROM docs, kinds),
placed AS (
  SELECT r, kind, rank, least, m,
    (sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY r, kind ORDER BY i))::BIGINT AS stop
  FROM hits),
spans AS (
  SELECT r, kind, rank, m, stop - length(m) AS start, stop FROM placed
  WHERE m IS NOT NULL AND length(CASE kind WHEN 'assign' THEN
      regexp_extract(m, '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) ELSE m END) >= least),
base AS (SELECT r, kind, rank, start, stop FROM spans WHERE kind <> 'run'),
runs AS (
  SELECT r, m, start, regexp_matches(m, '^[0-9A-Fa-f]+$') AS hex FROM spans s
  WHERE kind = 'run' AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')
    AND NOT regexp_matches(m, '^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$')
    AND NOT regexp_matches(m, '(?i)example|sample|placeholder|changeme|xxxx|your[_-]?(api|key|token)')
    AND NOT regexp_matches(m, '^[a-z]+([_/-][a-z]+)*[_/-]?[0-9]{1,4}$')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = s.r AND b.start < s.stop AND s.start < b.stop)),
windows AS (
  SELECT r, start, hex, m, unnest(range(length(m) - 19)) AS i FROM runs),
chars AS (
  SELECT r, start, hex, i, c, count(*) AS n
  FROM (SELECT r, start, hex, i, unnest(string_split(substr(m, i + 1, 20), '')) AS c FROM windows)
  GROUP BY ALL),
scored AS (
  SELECT r, start, hex, i, log2(20) - sum(n * log2(n)) / 20 AS bits FROM chars GROUP BY ALL),
entropy AS (
  SELECT r, CASE WHEN hex THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind,
         CASE WHEN hex THEN 3 ELSE 4 END AS rank, start + min(i) AS start, start + max(i) + 20 AS stop
  FROM scored WHERE bits >= CASE WHEN hex THEN 3.05 ELSE 3.81 END GROUP BY r, scored.start, hex),
listed AS (
  SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS b,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS f,
         count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex
  FROM (SELECT * FROM base UNION ALL SELECT * FROM entropy) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(f, '') AS spans
FROM docs LEFT JOIN listed USING (r)
""".replace("{assign}", ASSIGN)

ARCHIVE = r"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
firsts AS (SELECT p, min(page_id) AS first FROM payloads WHERE octet_length(encode(p)) >= 100 GROUP BY p)
SELECT page_id, octet_length(encode(p)) AS payload_bytes, sha256(p) AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS error
FROM payloads LEFT JOIN firsts USING (p)
"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text, half a byte at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    half = lambda v: f"xor(list_extract(CAST({table} AS BIGINT[]), ({v} & 15) + 1), {v} >> 4)"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    once = half("xor(c, b)")
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {half(f'({once})')}), 4294967295)"


# Totals without passing them up: a node is an own node of its smallest member, and the nodes below it
# are own nodes of its members, as deep or deeper.
TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS q
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, count(*) AS n, c - c % 100 AS base, {_crc32('c::VARCHAR')} % 6 AS h FROM turns GROUP BY c),
starts AS (
  SELECT v.*, least(v.h, coalesce(b.n, 0)) AS m FROM convs v LEFT JOIN convs b ON b.c = v.base),
rebuilt AS (
  SELECT s.c, q AS d, r, t FROM starts s JOIN turns ON turns.c = s.base AND q <= s.h
  UNION ALL SELECT s.c, q - h + m, r, t FROM starts s JOIN turns USING (c) WHERE q > h),
members AS (
  SELECT c, d, md5(string_agg(md5(length(r) || ':' || r || t), '') OVER (PARTITION BY c ORDER BY d)) AS k, length(t) AS chars FROM rebuilt
  UNION ALL SELECT c, 0, '', 0 FROM convs),
lengths AS (SELECT c, max(d) AS d FROM members GROUP BY c),
nodes AS (
  SELECT m.d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS w,
         sha256(coalesce(string_agg(CASE WHEN l.d = m.d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM members m JOIN lengths l USING (c) GROUP BY m.d, k),
named AS (SELECT m.c, m.d, n.conv_id FROM members m JOIN nodes n USING (d, k)),
placed AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN named p ON p.c = n.conv_id AND p.d = n.d - 1),
children AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM placed WHERE d > 0 GROUP BY ALL),
whole AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM placed p LEFT JOIN children USING (conv_id, d)),
below AS (
  SELECT m.c, m.d, m.conv_id, sum(CASE WHEN w.conv_id = m.c THEN w.w ELSE 0 END) OVER up AS saved,
         sum(CASE WHEN w.conv_id = m.c AND w.n_children = 0 THEN 1 ELSE 0 END) OVER up AS leaves
  FROM named m JOIN whole w ON w.conv_id = m.conv_id AND w.d = m.d
  WINDOW up AS (PARTITION BY m.c ORDER BY m.d DESC)),
totals AS (SELECT conv_id, d, sum(saved) AS saved_tokens, sum(leaves) AS n_leaves FROM below GROUP BY conv_id, d)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM whole JOIN totals USING (conv_id, d)
"""



def _repair() -> str:
    """A fold over the rows of a conversation. ``x.st`` has the cheapest edits so far by what was written
    last (nothing, system, user, assistant): cost, initials, lines. Costs decide, then initials."""

    def after(state: str, cost: str, edit: str, line: str | None) -> str:
        lines = f"{state}.o" if line is None else f"list_append({state}.o, {line})"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {lines}}}"

    start, system, user, assistant = (f"x.st[{i}]" for i in range(1, 5))
    extra = "CASE WHEN y.f = 3 THEN 3 ELSE 0 END"
    own, new = "y.r || ':' || y.t", "'{}:' || y.t"
    kept = lambda s, initial: f"CASE WHEN y.f NOT IN (1, 2) AND y.i = '{initial}' THEN {after(s, extra, 'K', own)} END"
    given = lambda s, role: f"CASE WHEN y.f NOT IN (1, 2) THEN {after(s, f'3 + {extra}', 'R', new.format(role))} END"
    deleted = lambda s: after(s, "4", "D", None)
    before_user = (start, system, assistant)
    rows = ", ".join(
        f"list_min(list_filter([{', '.join(arcs)}], lambda z: z IS NOT NULL))"
        for arcs in (
            [deleted(start)],
            [deleted(system), kept(start, "s")],
            [deleted(user), *(kept(s, "u") for s in before_user), *(given(s, "user") for s in before_user)],
            [deleted(assistant), kept(user, "a"), given(user, "assistant")],
        )
    )

    def closed(states: str) -> str:
        inserted = lambda i, role: after(f"n[{i}]", "3", "I", f"'{role}:'")
        with_user = f"[n[1], n[2], list_min([n[3], {inserted(1, 'user')}, {inserted(2, 'user')}, {inserted(4, 'user')}]), n[4]]"
        with_assistant = f"[n[1], n[2], n[3], list_min([n[4], {inserted(3, 'assistant')}])]"
        once = f"list_transform([{states}], lambda n: {with_user})"
        return f"list_transform({once}, lambda n: {with_assistant})[1]"

    none = "{'c': 1000000000000, 'a': '', 'o': ['']}"
    first = closed("[{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}, " + ", ".join([none] * 3) + "]")
    kind = "STRUCT(st STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])[], i VARCHAR, f INTEGER, r VARCHAR, t VARCHAR)"
    blank = "[\\x20\\x09-\\x0D]"
    return f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT *, {_crc32('k')} % 20 AS kind FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS r,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
ordered AS (
  SELECT *, row_number() OVER own AS p, row_number() OVER (PARTITION BY conv_id, r, t ORDER BY turn NULLS FIRST, copy) AS nth,
         lag(left(r, 1)) OVER own AS last_initial
  FROM damaged WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, t, copy)),
coded AS (
  SELECT *, CASE WHEN regexp_full_match(t, '{blank}*') THEN 1 WHEN nth > 1 THEN 2
                 WHEN NOT regexp_matches(t, '[.!?]{blank}*$') THEN 3 ELSE 0 END AS f FROM ordered),
folded AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank,
         count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
         count(*) FILTER (last_initial || left(r, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
         list_reduce(
           list_prepend({{'st': {first}, 'i': '', 'f': 0, 'r': '', 't': ''}}::{kind},
             list({{'st': NULL, 'i': left(r, 1), 'f': f, 'r': r, 't': t}}::{kind} ORDER BY p)),
           lambda x, y: {{'st': {closed(f"[{rows}]")}, 'i': '', 'f': 0, 'r': '', 't': ''}}::{kind}).st AS st
  FROM coded GROUP BY conv_id),
chosen AS (SELECT *, least(st[1], st[4]) AS best FROM folded)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN chosen USING (conv_id)
"""


SQL = {"op1_secrets": SECRETS, "op3_warc": ARCHIVE, "op8_line_dedup": LINES, "op11_trie": TRIE, "op12_repair": _repair()}
