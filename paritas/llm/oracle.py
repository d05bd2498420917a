"""DuckDB statements of the operators' queries that SQL can express. The others (hash tables,
trained models, tokenizers, approximate search) are held against brute force in tests/llm."""

from __future__ import annotations

from paritas.llm.chat import CONTROL, END, TEXT, TURN
from paritas.llm.licences import BASE, PHRASES
from paritas.llm.queries import RULES
from paritas.llm.repair import DELETE, FULL, INSERT, REROLE, STATES, STEP, TRUNCATED
from paritas.llm.url_reputation import STRENGTH


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum({len(TURN + TEXT + END)} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

ARTICLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS body FROM pages),
b AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '<br>|</?p>|</?h1>', chr(1), 'g'), '<[^>]*>', '', 'g') AS body FROM a),
c AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(replace(body, '&quot;', '"'), '&quot', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS body FROM b),
d AS (
  SELECT page_id, url, trim(regexp_replace(body, '[\x01\s]+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""

NGRAM = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams
  FROM w),
g AS (SELECT doc_id, len(grams) AS n, grams FROM s),
u AS (SELECT doc_id, n, unnest(grams) AS gram FROM g),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM u a JOIN u b ON a.gram = b.gram AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY 1, 2, 3, 4),
links AS (SELECT a, b FROM common WHERE 100 * shared >= 90 * (na + nb - shared)),
reach AS (
  SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links
  UNION
  SELECT r.x, CASE WHEN l.a = r.y THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.y OR l.b = r.y),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM g LEFT JOIN least ON doc_id = x
"""


def _rule(result: str) -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if result == 'rule' else v}'" for v, h, p in ordered) + " END"


def _level(name: str, of: str, key: str, parent: str, on: str) -> str:
    """Posterior pseudo-counts of a level below its parent's."""
    weak, strong = STRENGTH
    joined = f"SELECT l.*, p.a / (p.a + p.b) AS m FROM ({of}) l JOIN {parent} p ON {on}"
    return f"""{name}_m AS ({joined}),
{name}_k AS (
  SELECT CASE WHEN outer_ > 0 AND (spread - inner_) / outer_ > 0 THEN greatest({weak}, least({strong}, outer_ / (spread - inner_) - 1)) ELSE {strong} END AS k
  FROM (SELECT sum((bad - n * m) * (bad - n * m) / n) AS spread, sum(m * (1 - m)) AS inner_, sum((n - 1) * (m * (1 - m))) AS outer_ FROM {name}_m)),
{name} AS (SELECT {key}, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM {name}_m, {name}_k)"""


_PAGES = r"""
raw AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM raw)"""
_DOMAIN = r"""CASE WHEN len(string_split(host, '.')) > 2 AND length(string_split(host, '.')[-1]) = 2
    AND string_split(host, '.')[-2] IN ('co', 'com', 'net', 'org', 'gov', 'ac', 'edu')
  THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE array_to_string(string_split(host, '.')[-2:], '.') END"""

URLS = f"""
WITH {_PAGES},
outcome AS (
  SELECT host, 1 - quality AS bad FROM urls JOIN labels ON doc_id = try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1), '') AS BIGINT)
  WHERE quality IS NOT NULL),
hosts AS (SELECT host, {_DOMAIN} AS domain, string_split(host, '.')[-1] AS suffix, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad FROM outcome GROUP BY host),
overall AS (SELECT coalesce(sum(bad), 0) + 1 AS a, coalesce(sum(n) - sum(bad), 0) + 1 AS b FROM hosts),
{_level('s', 'SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix', 'suffix', 'overall', 'true')},
{_level('d', 'SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL', 'domain', 's', 'l.suffix = p.suffix')},
{_level('h', 'SELECT * FROM hosts', 'host', 'd', 'l.domain = p.domain')},
named AS (SELECT *, {_DOMAIN} AS domain, string_split(host, '.')[-1] AS suffix FROM urls),
post AS (
  SELECT page_id, named.host AS host, path, coalesce(h.a, d.a, s.a, o.a) AS a, coalesce(h.b, d.b, s.b, o.b) AS b
  FROM named LEFT JOIN h ON named.host = h.host LEFT JOIN d ON named.domain = d.domain LEFT JOIN s ON named.suffix = s.suffix, overall o)
SELECT page_id, host, path, {_rule('rule')} AS rule,
  coalesce({_rule('verdict')}, CASE WHEN a / (a + b) - 1.64 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM post
"""

#: CRC-32 of an ASCII string: the reflected polynomial, a byte at a time over a table made of eight shifts.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({s}, ''), lambda c: ascii(c)::UBIGINT)),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT)"""


def _states(of: dict[int, list[str]]) -> str:
    """The list of the four states' least (cost, audit, repaired text)."""
    return "[" + ", ".join(f"list_sort(list_filter([{', '.join(of.get(q, [])) or 'NULL'}], lambda x: x IS NOT NULL AND x.c IS NOT NULL))[1]" for q in STATES) + "]"


def _moved(p: int, cost: str, letter: str, text: str = "NULL") -> str:
    """State ``p`` of ``l`` one edit further; ``text`` is the row it adds."""
    add = f"CASE WHEN l[{p + 1}].t IS NULL THEN {text} ELSE l[{p + 1}].t || chr(10) || {text} END" if text != "NULL" else f"l[{p + 1}].t"
    return f"CASE WHEN l[{p + 1}] IS NOT NULL THEN {{'c': l[{p + 1}].c + {cost}, 'a': l[{p + 1}].a || '{letter}', 't': {add}}} END"


def _inserted(of: str) -> str:
    """``of`` closed under insertions: two rounds, a third insertion leads nowhere new."""
    for _ in range(2):
        moves = {q: [f"l[{q + 1}]"] for q in STATES}
        for i, full in FULL.items():
            for p, q in STEP[i].items():
                moves[q].append(_moved(p, str(INSERT), "I", f"'{full}:'"))
        of = f"list_transform([{of}], lambda l: {_states(moves)})[1]"
    return of


def _edited() -> str:
    """All edits of row ``r`` from the states ``l``."""
    live, extra = "r.fault IS DISTINCT FROM 'blank' AND r.fault IS DISTINCT FROM 'duplicate'", f"CASE WHEN r.fault = 'truncated' THEN {TRUNCATED} ELSE 0 END"
    moves = {p: [_moved(p, str(DELETE), "D")] for p in STATES}
    for i in STEP:
        for p, q in STEP[i].items():
            moves[q].append(f"CASE WHEN {live} AND r.initial = '{i}' THEN {_moved(p, extra, 'K', chr(39) * 2 + ' || r.line')} END")
            if i in FULL:
                moves[q].append(f"CASE WHEN {live} THEN {_moved(p, f'{REROLE} + {extra}', 'R', chr(39) + FULL[i] + ':' + chr(39) + ' || r.text')} END")
    return _states(moves)


_NO_STATE = "{'c': NULL::BIGINT, 'a': '', 't': NULL::VARCHAR}"
REPAIR = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)) AS t),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format(s="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM source WHERE fault <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, left(role, 1) AS initial, role || ':' || text AS line,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
r AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault
  FROM ranked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
    count_if(fault = 'truncated') AS truncated, count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM r GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {_inserted("[{'c': 0::BIGINT, 'a': '', 't': NULL::VARCHAR}, " + ", ".join([_NO_STATE] * 3) + "]")} AS l FROM counts
  UNION ALL
  SELECT w.conv_id, r.i, {_inserted("list_transform([w.l], lambda l: " + _edited() + ")[1]")} FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1),
ended AS (
  SELECT c.*, list_sort(list_filter([l[1], l[4]], lambda x: x IS NOT NULL AND x.c IS NOT NULL))[1] AS best FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

def _places(phrase: str) -> str:
    """Where the words of ``phrase`` stand one after the other in ``w``, from 0."""
    words = phrase.split(" ")
    return f"list_filter(range(len(w)), lambda i: w[i + 1] = '{words[0]}' AND w[i + 1:i + {len(words)}] = {words})"


def _labels(of: dict[str, str]) -> str:
    found = ", ".join(f"CASE WHEN len({_places(p)}) > 0 THEN '{label}' END" for p, label in of.items())
    return f"list_sort(list_distinct(list_filter([{found}], lambda x: x IS NOT NULL)))"


#: Phrases only: an expression behind an identifier tag, of which the given tables have none, is left to tests/llm.
LICENCES = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
p AS (
  SELECT doc_id, len(w) AS n_words, flatten([{', '.join(map(_places, BASE))}]) AS base, {_labels(BASE)} AS base_labels, {_labels(BASE | PHRASES)} AS labels,
    {' + '.join(f'len({_places(p)})' for p in PHRASES)} AS others
  FROM d)
SELECT doc_id, n_words::BIGINT AS n_words, len(base)::BIGINT AS n_base, list_min(base)::BIGINT AS first_word, list_max(base)::BIGINT AS last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels, coalesce(array_to_string(labels, ','), '') AS labels, 1 - pow(0.5, len(base) + others) AS score
FROM p
"""

ORACLES = {"op4_chat": CHAT, "op6_html_template": ARTICLE, "op7_ngram_join": NGRAM, "op9_url_reputation": URLS,
           "op11_conversation_repair": REPAIR, "op12_licence_scan": LICENCES}
