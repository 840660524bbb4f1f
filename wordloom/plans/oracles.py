"""Independent SQL for the registered queries, over the same parquet tables.

Plain ANSI-style SQL for an embedded analytic database whose regular expressions know no
look-around; shared steps are written once as common table expressions. The fixed values of the
cleaner and of the stemmer are stated here again, so that a wrong one on either side shows.
"""

from __future__ import annotations

from wordloom.plans.catalog import QUERIES as REGISTERED
from wordloom.sources import tables as src

ORACLES: dict[str, str] = {}

# Markup, and the character classes of the punctuation cleaner.
MARKUP = (
    r"(?s)<!--.*?(?:-->|\z)|<>|"
    r"<[^\s>\"'](?:[^\"'>]+|\"[^\"]*(?:\"|\z)|'[^']*(?:'|\z))*(?:>|\z)"
)
BRACKETS = r"\[\]\(\)"
BEFORE_SPACE = r":;'_\*%@&?!\[\]\(\)"
AFTER_SPACE = r"\.,:;'\-_\*@&/\\\?!#\[\]\(\)"
IN_URLS = r"\.,:;'\-_\*%@&/\\\?!#\[\]\(\)"
QUOTES = r"'\"\*<>"
IN_NUMBERS = r"\x{002E}\x{FE52}\x{FF0E}\x{002C}\x{FE50}\x{FF0C}\x{066B}\x{066C}"
BY_NUMBERS = (
    r"\x{0023}\x{FE5F}\x{FF03}\x{066A}\x{0025}\x{FE6A}\x{FF05}"
    r"\x{2030}\x{2031}\x{2032}\x{2033}\x{2034}\x{2057}"
)

# Letters and suffix steps of the stemmer.
STEM_VOWEL = "[aeiouy]"
STEM_CONSONANT = "[bcdfghjklmnpqrstvwxzY]"
STEM_HAS_VOWEL = "[aeiouy]|^Y"
SECOND_STEP = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "logi": "log", "entli": "ent", "ousli": "ous", "alli": "al", "bli": "ble", "eli": "e",
    "ization": "ize", "ation": "ate", "ator": "ate", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "alism": "al", "biliti": "ble", "aliti": "al", "iviti": "ive",
}
THIRD_STEP = {
    "ical": "ic", "ness": "", "icate": "ic", "iciti": "ic", "ful": "", "ative": "", "alize": "al",
}
FOURTH_STEP = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def with_(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def rx(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(13))"


# Text


def no_tags(expr: str) -> str:
    return f"regexp_replace({expr}, {rx(MARKUP)}, '', 'g')"


def punct(expr: str) -> str:
    """The seven punctuation passes without look-around (hyphen-free blanks doubled first)."""
    sq, num, mod = QUOTES, IN_NUMBERS, BY_NUMBERS
    ub, before, after, every = BRACKETS, BEFORE_SPACE, AFTER_SPACE, IN_URLS
    passes = [
        (r"[\p{Z}\p{Cc}\p{Cf}\p{Pi}\p{Pf}]", " "),
        (rf"[^\P{{Po}}{sq}{num}{every}{mod}]", " "),
        (rf"[^\P{{Ps}}{ub}]|[^\P{{Pe}}{ub}]", " "),
        (rf"[{sq}{num}{after}\p{{Pd}}\p{{Pc}}]+( |$)", r" \1"),
        (rf"( |^)[{sq}{before}\p{{Pc}}]+", r"\1 "),
        (" ", "  "),
        (r"( |^)\p{Pd}+(\p{Pd}[\p{N}\p{Sc}])", r" \2"),
        (r"( |^)\p{Pd}+([^\p{N}\p{Sc}\p{Pd}]|$)", r" \2"),
        (" +", " "),
    ]
    for pattern, to in passes:
        expr = f"regexp_replace({expr}, {rx(pattern)}, '{to}', 'g')"
    return f"trim({expr})"


def clean(expr: str) -> str:
    return punct(f"lower({no_tags(expr)})")


def gate(word: str) -> str:
    return f"(strlen({word}) < 30 AND length({word}) >= 3)"


CODE = r"^lt;|&gt$|&lt;|&gt;|=|^\$|^/|->|::"


def keyword(word: str) -> str:
    return f"({gate(word)} AND NOT regexp_matches({word}, {rx(CODE)}))"


def count_in(text: str, word: str) -> str:
    return f"((strlen({text}) - strlen(replace({text}, {word}, ''))) // strlen({word}))"


def soundex(word: str) -> str:
    codes = f"translate(regexp_replace(upper({word}), '[^A-Z]', '0', 'g'), "
    codes += "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    out = f"(left({codes}, 1) || replace(substr({codes}, 2), '7', ''))"
    for digit in "0123456":
        out = f"regexp_replace({out}, '{digit}+', '{digit}', 'g')"
    digits = f"replace(substr({out}, 2), '0', '')"
    return (
        f"CASE WHEN regexp_matches({word}, '^[A-Za-z]') "
        f"THEN rpad(upper(left({word}, 1)) || left({digits}, 3), 4, '0') ELSE {word} END"
    )


def sound(word: str) -> str:
    letters = f"upper(regexp_replace({word}, '[^A-Za-z\\x{{C0}}-\\x{{10FFFF}}]', '', 'g'))"
    codes = f"regexp_replace(translate({letters}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202'), '[^0-9]', '0', 'g')"
    out = f"(left({codes}, 1) || replace(substr({codes}, 2), '0', ''))"
    for digit in "123456":
        out = f"regexp_replace({out}, '{digit}+', '{digit}', 'g')"
    first = f"left(regexp_replace({word}, '[^A-Za-z\\x{{C0}}-\\x{{10FFFF}}]', '', 'g'), 1)"
    first = f"CASE WHEN regexp_matches({first}, '[a-z]') THEN upper({first}) ELSE {first} END"
    whole = f"({first} || substr({out}, 2))"
    return f"CASE WHEN {letters} = '' THEN '' ELSE rpad({whole}, CAST(greatest(4, length({whole})) AS INTEGER), '0') END"


# Tables

SECTION_ID = "CAST(substr(source, 4) AS INTEGER) + 1"
SECTIONS = f"""sections AS (SELECT DISTINCT {SECTION_ID} AS section_id, source AS handle,
  'Section ' || CAST({SECTION_ID} AS VARCHAR) AS name FROM documents)"""
ENTRIES = f"""entries AS (SELECT d.doc_id AS entry_id, {SECTION_ID} AS section_id, d.lang, d.text,
  d.n_chars, e.ts AS creation_date FROM documents d JOIN events e ON d.doc_id = e.event_id)"""
IDX = f"""idx AS (SELECT entry_id, section_id, creation_date, trim(text, {WS}) AS data,
  lower(trim(text, {WS})) AS data_lc FROM entries)"""
CLEANED = f"cleaned AS (SELECT entry_id, section_id, {clean('data')} AS t FROM idx)"
TOKENS = """tokens AS (SELECT entry_id, section_id, t, token, count(*) AS tf FROM
  (SELECT entry_id, section_id, t, unnest(string_split(t, ' ')) AS token FROM cleaned)
  WHERE token <> '' GROUP BY ALL)"""
POSTINGS = f"""post AS (SELECT entry_id, section_id, token AS keyword,
  CAST({count_in('t', 'token')} AS INTEGER) AS frequency, CAST(tf AS INTEGER) AS tf
  FROM tokens WHERE {keyword('token')})"""
DICT = f"""dict AS (SELECT keyword, {soundex('keyword')} AS soundex, {sound('keyword')} AS sound
  FROM (SELECT DISTINCT keyword FROM post))"""
INDEX = (ENTRIES, IDX)
WORDS = (*INDEX, CLEANED, TOKENS, POSTINGS)
PAGES = f"""pages_e AS (SELECT page_id + {src.PAGE_ID_BASE} AS entry_id, {src.PAGE_SECTION} AS section_id,
  url, html FROM pages)"""
LOGS = """logs AS (SELECT event_id AS id, ts AS date, event_type AS keywords,
  CASE WHEN event_type = 'view' THEN 'look' ELSE event_type END AS keywords_manipulated,
  'src0,src1' AS sections, 1 + CAST(floor(value) AS INTEGER) % 5 AS page,
  CAST(floor(value) AS INTEGER) AS results, CAST(user_id AS VARCHAR) AS session_id FROM events)"""
GROUPS = """groups AS (SELECT keywords, session_id, min(date) AS date,
  arg_min(keywords_manipulated, (date, id)) AS keywords_manipulated,
  arg_min(sections, (date, id)) AS sections, arg_min(results, (date, id)) AS results,
  max(page) AS depth FROM logs GROUP BY keywords, session_id)"""
TURNS = """turns AS (SELECT conv_id * 1000 + turn AS qid, text AS keywords FROM conversations
  WHERE role = 'user')"""
MARKED = """marked AS (SELECT qid, replace(replace(keywords, '. ', ' -"'), ', ', '" +') AS keywords
  FROM turns)"""
USER_WORDS = """user_words AS (SELECT DISTINCT w AS word FROM
  (SELECT unnest(string_split_regex(lower(keywords), '\\s+')) AS w FROM turns) WHERE w <> '')"""
TURN_WORDS = f"""turn_words AS (SELECT DISTINCT w AS word FROM
  (SELECT unnest(string_split({clean('keywords')}, ' ')) AS w FROM turns) WHERE {keyword('w')})"""
PART_SYN = "part_syn AS (SELECT DISTINCT p_brand AS word, p_name AS synonyms FROM part)"

# Queries

Q = f"""q(qid, keywords, sections, sort, direction, page, per_page) AS
  (VALUES {values(src.QUERIES)})"""
SYN = f"syn(word, synonyms) AS (VALUES {values(src.SYNONYMS)})"
LOOKUP = f"""lookup AS (SELECT term, min(word) AS word FROM
  (SELECT word, lower(trim(unnest(string_split(synonyms, ',')), {WS})) AS term FROM syn)
  WHERE term <> '' GROUP BY term)"""


def adjusted(source: str) -> str:
    return f"""adj AS (SELECT w.qid, trim(string_agg(w.sign || coalesce(l.word, w.term), ' ' ORDER BY w.pos), {WS})
  AS adjusted FROM (SELECT qid, pos, regexp_extract(raw, '^[+-]') AS sign,
    lower(trim(regexp_replace(raw, '^[+-]', ''), {WS})) AS term FROM
    (SELECT qid, unnest(string_split(trim(keywords, {WS}), ' ')) AS raw,
      generate_subscripts(string_split(trim(keywords, {WS}), ' '), 1) AS pos FROM {source})) w
  LEFT JOIN lookup l ON w.term = l.term GROUP BY w.qid)"""


# Keyword classes of a relation adj(qid, adjusted).
CLASSES = f"""
fm AS (SELECT qid, unnest(f) AS m, generate_subscripts(f, 1) AS i FROM
  (SELECT qid, regexp_extract_all(adjusted, '-?"[^"]+"') AS f FROM adj)),
phrases AS (SELECT qid, min(i) AS i, regexp_replace(m, '^-?"|"$', '', 'g') AS word, m[1] = '-' AS neg, m FROM fm
  GROUP BY qid, m),
exclude_phrase AS (SELECT qid, i, word FROM phrases p WHERE neg AND NOT EXISTS
  (SELECT 1 FROM fm e WHERE e.qid = p.qid AND e.i < p.i AND e.m = substr(p.m, 2))),
rest AS (SELECT qid, trim(lower(regexp_replace(regexp_replace(adjusted, '-?"[^"]+"', '', 'g'), ' +', ' ', 'g')), {WS}) AS r
  FROM adj),
ws AS (SELECT qid, unnest(string_split(r, ' ')) AS w FROM rest),
positive AS (SELECT qid, regexp_replace(w, '^\\+', '') AS word FROM ws WHERE w NOT LIKE '-%'),
classes AS (
  SELECT qid, 'include_phrase' AS class, word FROM phrases WHERE NOT neg
  UNION ALL SELECT qid, 'exclude_phrase', word FROM exclude_phrase
  UNION ALL SELECT qid, 'include_word', word FROM positive WHERE length(word) BETWEEN 3 AND 29
  UNION ALL SELECT qid, 'exclude_word', substr(w, 2) FROM ws WHERE w LIKE '-_%'
  UNION ALL SELECT DISTINCT qid, 'include_all', word FROM
    (SELECT qid, word FROM phrases WHERE NOT neg UNION ALL
     SELECT qid, word FROM positive WHERE length(word) BETWEEN 3 AND 29)
  UNION ALL SELECT DISTINCT qid, 'exclude_all', word FROM
    (SELECT qid, word FROM exclude_phrase UNION ALL SELECT qid, substr(w, 2) FROM ws WHERE w LIKE '-_%')
  UNION ALL SELECT DISTINCT qid, 'highlight', word FROM
    (SELECT qid, word FROM phrases WHERE NOT neg UNION ALL SELECT qid, word FROM positive WHERE word <> '')
),
terms AS (SELECT DISTINCT qid, lower(word) AS term, class = 'exclude_all' AS excluded FROM classes
  WHERE class IN ('include_all', 'exclude_all') AND trim(word, {WS}) <> '')"""


def resolved(source: str = "q") -> str:
    return f"""resolved AS (SELECT DISTINCT x.qid, s.section_id, s.handle, s.name FROM
  (SELECT qid, trim(unnest(string_split(CASE WHEN coalesce(sections, '') = '' THEN '{src.ALL_SECTIONS}'
    ELSE sections END, ',')), {WS}) AS h FROM {source}) x JOIN sections s ON s.handle = x.h)"""


def matches(found: str) -> str:
    """Entries where every term is found or, if excluded, not found."""
    return f"""hits AS (SELECT t.qid, i.entry_id, any_value(i.section_id) AS section_id,
  any_value(i.creation_date) AS creation_date,
  CAST(CASE WHEN bool_and(t.excluded) THEN 1
    ELSE count(*) FILTER (NOT t.excluded AND contains(i.data_lc, t.term)) END AS INTEGER) AS keywords_matched,
  CAST(CASE WHEN bool_and(t.excluded) THEN 1
    ELSE sum(CASE WHEN t.excluded THEN 0 ELSE {count_in('i.data_lc', 't.term')} END) END AS DOUBLE) AS occurrences
  FROM terms t JOIN resolved r ON r.qid = t.qid JOIN idx i ON i.section_id = r.section_id
  GROUP BY t.qid, i.entry_id HAVING bool_and(({found}) <> t.excluded))"""


LIKE = matches("contains(i.data_lc, t.term)")
WHOLE = matches(r"regexp_matches(i.data_lc, '\b' || regexp_escape(t.term) || '\b')")
SEARCH = (SECTIONS, *INDEX, Q, SYN, LOOKUP, adjusted("q"), CLASSES, resolved())
WEIGHT = "CASE (section_id - 1) % 5 WHEN 0 THEN 4.0 WHEN 1 THEN 2.0 WHEN 2 THEN 1.0 WHEN 3 THEN 0.5 ELSE 0.25 END"
WEIGHT = f"CAST({WEIGHT} AS DOUBLE)"
AGE = f"sqrt(CAST(greatest(1, datediff('day', creation_date, TIMESTAMP '{src.AS_OF}')) AS DOUBLE))"
SETTINGS = "settings AS (SELECT qid, sort, direction, page, CASE WHEN per_page > 0 THEN per_page ELSE 20 END AS per_page FROM q)"


def ranked(base: str = "occurrences", factor: str = "keywords_matched * ") -> str:
    return f"""scored AS (SELECT h.*, s.sort, s.direction, s.page, s.per_page,
  h.{base} * {WEIGHT.replace('section_id', 'h.section_id')} /
    CASE WHEN s.sort = 'score-recency' THEN {AGE} ELSE 1.0 END AS score
  FROM hits h JOIN settings s ON s.qid = h.qid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY
  (CASE WHEN direction = 'asc' THEN 1 ELSE -1 END) *
    (CASE sort WHEN 'date' THEN epoch_us(creation_date) WHEN 'id' THEN entry_id END),
  (CASE WHEN direction = 'asc' THEN 1 ELSE -1 END) *
    (CASE WHEN sort IN ('date', 'id') THEN 0 ELSE {factor}score END),
  entry_id) AS rank FROM scored)"""


PAGE = """page_rows AS (SELECT r.*, s.handle AS section FROM ranked r JOIN sections s USING (section_id)
  WHERE rank > greatest(0, (page - 1) * per_page) AND rank <= greatest(0, (page - 1) * per_page) + per_page)"""
PAGE_SELECT = f"""SELECT qid, CAST(rank AS INTEGER) AS rank, entry_id, section, keywords_matched,
  round(score, 6) AS score, {stamp('creation_date')} AS creation_date FROM page_rows"""
LIKE_PAGE = (*SEARCH, LIKE, SETTINGS, ranked(), PAGE)

# Full text

BOOL_RAW = "regexp_extract_all(lower({text}), '[+-]?\"[^\"]+\"|[^ \"]+')"


def boolean_terms(source: str, text: str) -> str:
    return f"""items AS (SELECT qid, regexp_extract(raw, '^[+-]') AS sign, contains(raw, '"') AS quoted,
  NOT contains(raw, '"') AND raw LIKE '%*' AS prefix,
  {punct("regexp_replace(raw, '^[+-]|" + '"' + "', '', 'g')")} AS body
  FROM (SELECT qid, unnest({BOOL_RAW.format(text=text)}) AS raw FROM {source})),
bterms AS (SELECT DISTINCT qid, sign, prefix, CASE WHEN quoted THEN body END AS phrase, word FROM
  (SELECT *, unnest(string_split(body, ' ')) AS word FROM items)
  WHERE length(word) >= 3 AND strlen(word) < 30),
asked AS (SELECT DISTINCT qid, sign, quoted AND contains(body, ' ') AS quoted, body FROM items),
keyed AS (SELECT b.*, d.keyword FROM bterms b JOIN dict d ON
  (NOT b.prefix AND d.keyword = b.word) OR (b.prefix AND starts_with(d.keyword, b.word)))"""


FULL_HITS = """units AS (SELECT qid, sign, quoted, body AS item FROM asked WHERE quoted AND body <> ''
  UNION SELECT qid, sign, false, word FROM bterms WHERE phrase IS NULL OR NOT contains(phrase, ' ')),
word_found AS (SELECT DISTINCT k.qid, k.sign, false AS quoted, k.word AS item, p.entry_id FROM keyed k
  JOIN post p USING (keyword) WHERE k.phrase IS NULL OR NOT contains(k.phrase, ' ')),
phrase_found AS (SELECT u.qid, u.sign, true AS quoted, u.item, c.entry_id FROM units u
  JOIN cleaned c ON contains(' ' || c.t || ' ', ' ' || u.item || ' ') WHERE u.quoted),
found AS (SELECT f.*, i.section_id, i.creation_date FROM
  (SELECT * FROM word_found UNION ALL SELECT * FROM phrase_found) f
  JOIN idx i USING (entry_id) JOIN resolved r ON r.qid = f.qid AND r.section_id = i.section_id),
full_hits AS (SELECT f.qid, f.entry_id, any_value(f.section_id) AS section_id,
  any_value(f.creation_date) AS creation_date FROM found f GROUP BY f.qid, f.entry_id
  HAVING count(*) FILTER (f.sign = '-') = 0
    AND count(*) FILTER (f.sign = '+') = (SELECT count(*) FROM units u WHERE u.qid = f.qid AND u.sign = '+')
    AND (count(*) FILTER (f.sign = '+') > 0 OR count(*) FILTER (f.sign = '') > 0))"""
RELEVANCE = """lengths AS (SELECT entry_id, sum(tf) AS doc_len FROM post GROUP BY entry_id),
corpus AS (SELECT count(*) AS docs, avg(doc_len) AS avg_len FROM lengths),
freq AS (SELECT keyword, count(*) AS df FROM post GROUP BY keyword),
relevant AS (SELECT k.qid, p.entry_id, round(sum(
    ln(1 + (c.docs - f.df + 0.5) / (f.df + 0.5)) * p.tf * 2.2
    / (p.tf + 1.2 * (0.25 + 0.75 * l.doc_len / c.avg_len))), 6) AS relevance
  FROM (SELECT DISTINCT qid, keyword FROM keyed WHERE sign <> '-') k
  JOIN post p USING (keyword) JOIN freq f USING (keyword) JOIN lengths l USING (entry_id)
  JOIN resolved r ON r.qid = k.qid AND r.section_id = p.section_id, corpus c
  GROUP BY k.qid, p.entry_id)"""


# Stems


def stems(source: str) -> str:
    """Common table expressions from ``source`` (word) to ``stems`` (word, stem)."""
    vowel, cons = STEM_VOWEL, STEM_CONSONANT
    m = lambda e: f"len(regexp_extract_all({e}, '{vowel}{cons}'))"
    cut = lambda n: f"left(w, length(w) - {n})"
    has_vowel = lambda e: f"regexp_matches({e}, '{STEM_HAS_VOWEL}')"
    short = lambda e: f"regexp_matches({e}, '{cons}{vowel}[bcdfghjklmnpqrstvz]$')"
    double = f"(right(w, 1) = substr(w, length(w) - 1, 1) AND regexp_matches(w, '{cons}{cons}$'))"
    steps = [
        "CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN left(w, length(w) - 2) WHEN w LIKE '%ss' THEN w "
        "WHEN w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END AS w",
        f"CASE WHEN w LIKE '%eed' THEN (CASE WHEN {m(cut(3))} > 0 THEN {cut(1)} ELSE w END) "
        f"WHEN w LIKE '%ing' AND {has_vowel(cut(3))} THEN {cut(3)} || '|' "
        f"WHEN w LIKE '%ed' AND {has_vowel(cut(2))} THEN {cut(2)} || '|' ELSE w END AS w",
        "w LIKE '%|' AS cut, rtrim(w, '|') AS w",
        f"CASE WHEN NOT cut THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e' "
        f"WHEN {double} AND NOT regexp_matches(w, '(ll|ss|zz)$') THEN {cut(1)} "
        f"WHEN {m('w')} = 1 AND {short('w')} THEN w || 'e' ELSE w END AS w",
        f"CASE WHEN regexp_matches(w, '[yY]$') AND {has_vowel(cut(1))} THEN {cut(1)} || 'i' ELSE w END AS w",
    ]
    for rules, least in ((SECOND_STEP, 0), (THIRD_STEP, 0), (dict.fromkeys(FOURTH_STEP, ""), 1)):
        pattern = "(" + "|".join(sorted(rules, key=len, reverse=True)) + ")$"
        suffix = f"regexp_extract(w, '{pattern}', 1)"
        if least:
            suffix = f"CASE WHEN regexp_matches(w, '[st]ion$') THEN 'ion' ELSE {suffix} END"
        swap = "CASE s " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.items()) + " ELSE '' END"
        steps.append(f"w AS w, {suffix} AS s")
        base = "left(w, length(w) - length(s))"
        steps.append(f"CASE WHEN s = '' OR {m(base)} <= {least} THEN w ELSE {base} || ({swap}) END AS w")
    steps.append(
        f"CASE WHEN w LIKE '%e' AND ({m(cut(1))} > 1 OR ({m(cut(1))} = 1 AND NOT {short(cut(1))})) "
        f"THEN {cut(1)} ELSE w END AS w"
    )
    steps.append(f"CASE WHEN w LIKE '%ll' AND {m('w')} > 1 THEN {cut(1)} ELSE w END AS w")
    ctes = [
        f"s0 AS (SELECT word, regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiou])y', '\\1Y', 'g') AS w FROM {source})"
    ]
    for i, step in enumerate(steps, 1):
        ctes.append(f"s{i} AS (SELECT word, {step} FROM s{i - 1})")
    ctes.append(
        f"stems AS (SELECT word, CASE WHEN strlen(word) <= 2 THEN word ELSE lower(w) END AS stem FROM s{len(steps)})"
    )
    return ",\n".join(ctes)


def add(name: str, *ctes: str, select: str) -> None:
    ORACLES[name] = with_(*ctes, select=select) if ctes else select


# Scans, sources, sinks

add("load_entries", ENTRIES, select=f"""SELECT entry_id, section_id, lang, text, n_chars,
  {stamp('creation_date')} AS creation_date FROM entries""")
add("doc_index", *INDEX, select="SELECT entry_id, section_id, data, data_lc FROM idx")
add(
    "append_log", *SEARCH, LIKE, LOGS,
    f"""given AS (SELECT qid, unnest(f) AS h, generate_subscripts(f, 1) AS i FROM (SELECT qid, string_split(
      CASE WHEN sections = '' THEN '{src.ALL_SECTIONS}' ELSE sections END, ',') AS f FROM q)),
    firsts AS (SELECT g.qid, trim(g.h, {WS}) AS handle, min(g.i) AS i FROM given g
      JOIN sections s ON s.handle = trim(g.h, {WS}) GROUP BY ALL),
    handles AS (SELECT qid, string_agg(handle, ',' ORDER BY i) AS sections FROM firsts GROUP BY qid)""",
    select=f"""SELECT id, {stamp('date')} AS date, keywords, keywords_manipulated, sections, page, results, session_id FROM logs
UNION ALL SELECT (SELECT max(id) FROM logs) + q.qid, {stamp(f"TIMESTAMP '{src.AS_OF}'")}, trim(q.keywords), a.adjusted,
  h.sections, q.page, CAST((SELECT count(*) FROM hits WHERE hits.qid = q.qid) AS INTEGER), 's1'
  FROM q JOIN adj a ON a.qid = q.qid LEFT JOIN handles h ON h.qid = q.qid
  WHERE EXISTS (SELECT 1 FROM resolved r WHERE r.qid = q.qid)""",
)
add("export_logs_csv", LOGS, GROUPS, select=f"""SELECT {stamp('date')} AS "Date", keywords AS "Keywords",
  keywords_manipulated AS "Adjusted Keywords", results AS "Results", depth AS "Depth",
  session_id AS "Session ID" FROM groups""")

# Index build

add("indexed_sections_only", ENTRIES, PAGES, select="""SELECT entry_id, section_id FROM
  (SELECT entry_id, section_id FROM entries UNION ALL SELECT entry_id, section_id FROM pages_e)
  WHERE section_id BETWEEN 1 AND 20""")
add("index_filters", ENTRIES, select="""SELECT entry_id, section_id, lang FROM entries WHERE section_id > 5
  OR (section_id = 1 AND lang IN ('en', 'fr')) OR (section_id = 2 AND lang = 'en')
  OR (section_id = 3 AND entry_id IN (2, 22, 42)) OR (section_id = 4 AND lang IN ('de', 'es'))
  OR (section_id = 5 AND lang IN ('en,fr', 'de'))""")
add("included_fields", ENTRIES, select=f"""SELECT entry_id, section_id, trim(CASE WHEN section_id <= 10
  THEN lang || ' ' || text || ' ' ELSE text || ' ' || CAST(n_chars AS VARCHAR) || ' ' END, {WS}) AS data FROM entries""")
add("flatten_text", select="""SELECT p_partkey AS entry_id, p_name || ' ' || p_brand || ' ' || p_type || '  '
  || p_type || ' ' || p_brand AS data FROM part""")
add("strip_tags", PAGES, select=f"SELECT entry_id, {no_tags('html')} AS data FROM pages_e")
add("decode_numeric_entities", select="SELECT doc_id, text AS data FROM documents")
add("repair_utf8", select="SELECT doc_id, text AS data FROM documents")
add("strip_punctuation", select=f"SELECT doc_id, {punct('lower(text)')} AS data FROM documents")
add("tokenize_unique", *INDEX, CLEANED, TOKENS, select="SELECT entry_id, token FROM tokens")
add("length_gate", *INDEX, CLEANED, TOKENS, select=f"SELECT entry_id, token FROM tokens WHERE {gate('token')}")
add("code_token_filter", PAGES, select=f"""SELECT DISTINCT entry_id, token FROM
  (SELECT entry_id, unnest(string_split({punct("lower(url || ' ' || html)")}, ' ')) AS token FROM pages_e)
  WHERE NOT regexp_matches(token, {rx(CODE)})""")
add("keyword_dictionary", *WORDS, PAGES, select=f"""SELECT keyword, {soundex('keyword')} AS soundex, {sound('keyword')} AS sound FROM
  (SELECT keyword FROM post UNION SELECT w FROM
    (SELECT unnest(string_split({clean('html')}, ' ')) AS w FROM pages_e) WHERE {keyword('w')})""")
add("substring_frequency", *WORDS, select="SELECT entry_id, keyword, frequency FROM post")
add("postings", *WORDS, select="SELECT entry_id, section_id, keyword, frequency, tf FROM post")

# Index maintenance

CHANGES = """changes AS (SELECT user_id AS entry_id, arg_max(CASE event_type WHEN 'error' THEN 'delete'
  WHEN 'signup' THEN 'create' ELSE 'edit' END, (ts, event_id)) AS op,
  arg_max(event_type || ' ' || CAST(event_id AS VARCHAR), (ts, event_id)) AS note FROM events GROUP BY user_id)"""
AFTER = f"""SELECT i.entry_id, i.section_id, CASE WHEN c.entry_id IS NULL THEN i.data
  ELSE trim(e.text || ' ' || c.note, {WS}) END AS data
  FROM idx i JOIN entries e ON e.entry_id = i.entry_id LEFT JOIN changes c ON c.entry_id = i.entry_id
  WHERE c.op IS NULL OR c.op <> 'delete'"""
add("upsert_entries", *INDEX, CHANGES, select=AFTER)
add("stream_index_changes", *INDEX, CHANGES, select=AFTER)
add("delete_entries", *WORDS, select="""SELECT entry_id, section_id, count(*) AS keywords,
  CAST(sum(frequency) AS BIGINT) AS frequency FROM post
  WHERE entry_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY entry_id, section_id""")
add("orphan_keywords", *WORDS, select="""SELECT DISTINCT keyword FROM post
  WHERE entry_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
add("delete_section", *INDEX, select="SELECT entry_id, section_id, data FROM idx WHERE section_id <> 3")
add("reindex_sections", *INDEX, select=f"""SELECT i.entry_id, i.section_id, CASE WHEN i.section_id IN (2, 5)
  THEN trim(e.text || ' ' || e.lang, {WS}) ELSE i.data END AS data FROM idx i JOIN entries e ON e.entry_id = i.entry_id""")

# Query text

add("synonym_table", PART_SYN, select="""SELECT DISTINCT lower(p_name) AS term, p_brand AS word FROM part""")
add("synonym_upsert", PART_SYN, select="""SELECT sha1(word) AS hash, word, synonyms FROM (
  SELECT word, synonyms FROM part_syn WHERE word NOT IN (SELECT p_brand FROM part WHERE p_type = 'ECONOMY')
    AND word NOT IN (SELECT p_brand FROM part WHERE p_size = 50)
  UNION ALL SELECT DISTINCT 'New ' || p_brand, lower(p_brand) FROM part WHERE p_type = 'ECONOMY')""")
add("apply_synonyms", TURNS, MARKED, SYN, LOOKUP, adjusted("marked"), select="SELECT qid, adjusted FROM adj")
add("apply_synonym_phrases", TURNS, MARKED, f"""turn_parts AS (SELECT qid, string_split(lower(keywords), ' ') AS w FROM turns),
phrase_terms AS (SELECT qid, unnest([array_to_string(w[1:1], ' '), array_to_string(w[2:3], ' '), array_to_string(w[2:4], ' ')]) AS listed
  FROM turn_parts),
phrase_lookup AS (SELECT term, len(string_split(term, ' ')) AS size, min('Turn ' || qid) AS word FROM
  (SELECT qid, lower(trim(unnest(string_split(replace(listed, '.', ''), ',')), {WS})) AS term FROM phrase_terms)
  WHERE term <> '' GROUP BY term),
marked_words AS (SELECT qid, list(regexp_extract(raw, '^[+-]') ORDER BY pos) AS signs,
    list(lower(trim(regexp_replace(raw, '^[+-]', ''), {WS})) ORDER BY pos) AS terms FROM
  (SELECT qid, unnest(string_split(trim(keywords, {WS}), ' ')) AS raw,
    generate_subscripts(string_split(trim(keywords, {WS}), ' '), 1) AS pos FROM marked) GROUP BY qid),
starts AS (SELECT m.qid, m.spot, max(l.size) AS size, arg_max(l.word, l.size) AS word FROM
  (SELECT qid, spot, size, array_to_string(terms[spot:spot + size - 1], ' ') AS term, array_to_string(signs[spot + 1:spot + size - 1], '') AS inner_signs
    FROM (SELECT *, unnest(range(1, len(terms) + 1)) AS spot FROM marked_words), (SELECT DISTINCT size FROM phrase_lookup)
    WHERE spot + size - 1 <= len(terms)) m
  JOIN phrase_lookup l ON l.term = m.term AND l.size = m.size WHERE m.inner_signs = '' GROUP BY m.qid, m.spot),
walk AS (SELECT qid, CAST(1 AS BIGINT) AS spot FROM marked_words
  UNION ALL SELECT k.qid, k.spot + coalesce(s.size, 1) FROM walk k JOIN marked_words m USING (qid)
  LEFT JOIN starts s ON s.qid = k.qid AND s.spot = k.spot WHERE k.spot < len(m.terms))""",
    select=f"""SELECT qid, trim(string_agg(signs[spot] || coalesce(word, terms[spot]), ' ' ORDER BY spot), {WS}) AS adjusted
  FROM walk JOIN marked_words USING (qid) LEFT JOIN starts USING (qid, spot) WHERE spot <= len(terms) GROUP BY qid""")
add("classify_keywords", TURNS, MARKED, "adj AS (SELECT qid, keywords AS adjusted FROM marked)", CLASSES,
    select="SELECT qid, class, word FROM classes")
add("require_all_and_wildcard", TURNS, MARKED, f"""tok AS (SELECT qid, unnest(f) AS w, generate_subscripts(f, 1) AS i
  FROM (SELECT qid, regexp_extract_all(trim(keywords, {WS}), '(?:"[^"]*"|[^ ])+') AS f FROM marked))""",
    select="""SELECT qid, string_agg(CASE WHEN w[1] IN ('-', '+', '"') THEN w
  ELSE '+' || w || CASE WHEN w LIKE '%*' THEN '' ELSE '*' END END, ' ' ORDER BY i) AS expanded FROM tok GROUP BY qid""")
add("stem_vocabulary", *WORDS, "vocab AS (SELECT DISTINCT keyword AS word FROM post)", stems("vocab"),
    select="SELECT word AS keyword, stem FROM stems")
add("stem_words", TURNS, USER_WORDS, stems("user_words"), select="SELECT word AS keyword, stem FROM stems")

# Match, score, sort, page

add("resolve_sections", SECTIONS, Q, resolved(), select="""SELECT qid, section_id, handle, name, CAST(NULL AS VARCHAR) AS error FROM resolved
UNION ALL SELECT qid, NULL, NULL, NULL, 'Invalid search sections' FROM q
  WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.qid = q.qid)""")
add("index_entry_join", *INDEX, select=f"""SELECT i.entry_id, e.section_id, {stamp('e.creation_date')} AS creation_date, i.data
  FROM idx i JOIN entries e ON e.entry_id = i.entry_id""")
add("section_filter", SECTIONS, *INDEX, Q, resolved(), select="""SELECT entry_id, section_id FROM idx
  WHERE section_id IN (SELECT r.section_id FROM resolved r JOIN q ON q.qid = r.qid WHERE q.sections <> '')""")
add("match_like", *SEARCH, LIKE, select="SELECT qid, entry_id FROM hits")
add("match_like_batch", *INDEX, TURNS, USER_WORDS, """words AS (SELECT word,
  CASE WHEN word LIKE '-%' THEN substr(word, 2) WHEN word LIKE '+%' THEN substr(word, 2) ELSE word END AS term,
  word LIKE '-%' AS excluded FROM user_words)""",
    select=f"""SELECT w.word AS qid, count(*) AS hits,
  CAST(sum(CASE WHEN excluded THEN 1 ELSE {count_in('i.data_lc', 'w.term')} END) AS BIGINT) AS occurrences
  FROM words w JOIN idx i ON contains(i.data_lc, w.term) <> w.excluded
  WHERE length(term) > 0 AND (excluded OR length(term) BETWEEN 3 AND 29) GROUP BY w.word""")
add("match_like_folded", *INDEX, TURNS, USER_WORDS, """words AS (SELECT word,
  strip_accents(CASE WHEN word LIKE '-%' THEN substr(word, 2) WHEN word LIKE '+%' THEN substr(word, 2) ELSE word END) AS term,
  length(ltrim(word, '+')) BETWEEN 3 AND 29 AS sized, word LIKE '-%' AS excluded FROM user_words)""",
    "folded AS (SELECT entry_id, strip_accents(data_lc) AS plain FROM idx)",
    select=f"""SELECT w.word AS qid, count(*) AS hits,
  CAST(sum(CASE WHEN excluded THEN 1 ELSE {count_in('i.plain', 'w.term')} END) AS BIGINT) AS occurrences
  FROM words w JOIN folded i ON contains(i.plain, w.term) <> w.excluded
  WHERE length(term) > 0 AND (excluded OR sized) GROUP BY w.word""")
add("match_phrases", *INDEX, select="""SELECT CAST(b.item_id AS INTEGER) AS qid, i.entry_id FROM benchmark b
  JOIN idx i ON contains(i.data_lc, lower(b.text))""")
add("match_regexp", *SEARCH, WHOLE, select="SELECT qid, entry_id FROM hits")
FULL = (*SEARCH, CLEANED, TOKENS, POSTINGS, DICT, boolean_terms("adj", "adjusted"), FULL_HITS)
add("match_fulltext", *FULL, select="SELECT qid, entry_id FROM full_hits")
add(
    "match_stemmed", SECTIONS, *INDEX,
    f"q0(qid, keywords, sections, sort, direction, page, per_page) AS (VALUES {values(src.QUERIES)})",
    """q AS (SELECT CAST(qid AS VARCHAR) || '-' || e AS qid, keywords || e AS keywords, sections FROM q0,
  (VALUES (''), ('ed'), ('ing'), ('s')) x(e))""",
    SYN, LOOKUP, adjusted("q"), CLASSES, resolved(),
    "stem_in AS (SELECT DISTINCT term AS word FROM terms WHERE NOT excluded AND NOT contains(term, ' '))",
    stems("stem_in"),
    f"""probes AS (SELECT t.*, coalesce(s.stem, t.term) AS stem FROM terms t
  LEFT JOIN stems s ON s.word = t.term AND NOT t.excluded AND s.stem <> '')""",
    matches("contains(i.data_lc, t.term) OR contains(i.data_lc, t.stem)").replace("FROM terms t", "FROM probes t"),
    select="SELECT qid, entry_id, keywords_matched, CAST(occurrences AS BIGINT) AS occurrences FROM hits",
)
add("empty_query", *SEARCH, LIKE, select="SELECT qid FROM q WHERE qid NOT IN (SELECT qid FROM hits)")
add("keywords_matched", *SEARCH, LIKE, select="SELECT qid, entry_id, keywords_matched FROM hits")
add("occurrence_score", *SEARCH, LIKE, select="SELECT qid, entry_id, occurrences FROM hits")
add("section_weighting", *SEARCH, LIKE, select=f"""SELECT qid, entry_id, {WEIGHT} AS weight,
  occurrences * {WEIGHT} AS score FROM hits""")
add("recency_decay", ENTRIES, select=f"SELECT entry_id, round(1 / {AGE}, 6) AS decay FROM entries")
FREE = (SECTIONS, *WORDS, DICT, TURNS, "q AS (SELECT qid, keywords, '' AS sections FROM turns)",
        resolved(), boolean_terms("q", "keywords"), RELEVANCE)
add("fulltext_relevance", *FREE, select="SELECT qid, entry_id, relevance FROM relevant")
add("fulltext_top", *FREE,
    select="""SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY relevance DESC, entry_id) AS INTEGER)
  AS rank, entry_id, relevance FROM relevant QUALIFY rank <= 20""")
add("sort_modes", *LIKE_PAGE, select="SELECT qid, CAST(rank AS INTEGER) AS rank, entry_id FROM page_rows")
add("paginate", *SEARCH, LIKE, SETTINGS, ranked(),
    select="SELECT qid, CAST(rank AS INTEGER) AS rank, entry_id FROM ranked WHERE rank BETWEEN 6 AND 10")
add("found_rows", *SEARCH, LIKE, SETTINGS, select="""SELECT s.qid, count(h.entry_id) AS total,
  CAST(ceil(count(h.entry_id) / any_value(s.per_page)) AS BIGINT) AS pages, any_value(s.page) AS page,
  any_value(s.per_page) AS per_page FROM settings s LEFT JOIN hits h ON h.qid = s.qid GROUP BY s.qid""")
add("search", *LIKE_PAGE, select=PAGE_SELECT)
LEFT = """idx AS (SELECT i.* FROM idx_all i WHERE entry_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))"""
add("search_stored", SECTIONS, ENTRIES, IDX.replace("idx AS", "idx_all AS"), LEFT, Q, SYN, LOOKUP, adjusted("q"),
    CLASSES, resolved(), LIKE, SETTINGS, ranked(), PAGE,
    select="SELECT qid, CAST(rank AS INTEGER) AS rank, entry_id, section, round(score, 6) AS score FROM page_rows")
add("search_batch", *INDEX, TURNS, USER_WORDS, """words AS (SELECT word,
  CASE WHEN word LIKE '-%' OR word LIKE '+%' THEN substr(word, 2) ELSE word END AS term,
  word LIKE '-%' AS excluded FROM user_words)""",
    f"""hits AS (SELECT w.word AS qid, i.entry_id,
  CASE WHEN excluded THEN 1 ELSE {count_in('i.data_lc', 'w.term')} END * {WEIGHT.replace('section_id', 'i.section_id')} AS score
  FROM words w JOIN idx i ON contains(i.data_lc, w.term) <> w.excluded
  WHERE length(term) > 0 AND (excluded OR length(term) BETWEEN 3 AND 29))""",
    select="""SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, entry_id) AS INTEGER) AS rank,
  entry_id, round(score, 6) AS score FROM hits QUALIFY rank <= 5""")
add("search_run", *LIKE_PAGE, CLEANED, TOKENS, POSTINGS, DICT,
    f"""asked_words AS (SELECT DISTINCT qid, word FROM classes WHERE class = 'include_word'
  AND qid NOT IN (SELECT qid FROM hits)),
alike AS (SELECT w.qid, w.word, d.keyword AS alternative, levenshtein(d.keyword, w.word) AS distance
  FROM (SELECT *, {sound('word')} AS s FROM asked_words) w JOIN dict d ON d.sound = w.s WHERE d.keyword <> w.word),
nearest AS (SELECT qid, word, min((distance, alternative)) AS best FROM alike GROUP BY qid, word)""",
    select="""SELECT q.qid, (SELECT count(*) FROM hits h WHERE h.qid = q.qid) AS total,
  p.shown, p.first, p.shown AS excerpts,
  (SELECT arg_min(best[2], (best[1], word)) FROM nearest n WHERE n.qid = q.qid) AS alternative,
  CASE WHEN EXISTS (SELECT 1 FROM resolved r WHERE r.qid = q.qid)
    THEN (SELECT max(event_id) FROM events) + q.qid END AS log_id
  FROM q LEFT JOIN (SELECT qid, count(*) AS shown, arg_min(entry_id, rank) AS first FROM page_rows GROUP BY qid) p
    ON p.qid = q.qid""")
add("search_regexp", *SEARCH, WHOLE, SETTINGS, ranked(), PAGE, select=PAGE_SELECT)
add("search_fulltext", *FULL, RELEVANCE,
    "hits AS (SELECT f.*, r.relevance FROM full_hits f JOIN relevant r ON r.qid = f.qid AND r.entry_id = f.entry_id)",
    SETTINGS, ranked("relevance", ""), PAGE, select=PAGE_SELECT.replace(" keywords_matched,", ""))
add("hydrate_entries", *LIKE_PAGE, select="""SELECT p.qid, CAST(p.rank AS INTEGER) AS rank, p.entry_id, e.lang, e.n_chars, e.text
  FROM page_rows p JOIN entries e ON e.entry_id = p.entry_id""")
add("filter_by_hits", *SEARCH, WHOLE, select="""SELECT doc_id, quality, toxic FROM labels
  WHERE doc_id IN (SELECT entry_id FROM hits)""")
add("filter_section", SECTIONS, ENTRIES, f"""idx AS (SELECT entry_id, section_id, creation_date, trim(text, {WS}) AS data,
  lower(trim(text, {WS})) AS data_lc FROM entries WHERE entry_id IN (SELECT doc_id FROM labels))""",
    Q.replace("q(", "q0("), "q AS (SELECT qid, keywords, 'src2' AS sections FROM q0)",
    SYN, LOOKUP, adjusted("q"), CLASSES, resolved(), LIKE,
    select="""SELECT qid, entry_id FROM hits UNION ALL SELECT q.qid, e.entry_id FROM q, entries e
  WHERE e.section_id = 3 AND q.qid NOT IN (SELECT qid FROM terms)""")

# Excerpts

HIGHLIGHT = f"""stem_in AS (SELECT DISTINCT word FROM positive WHERE word <> ''),
{stems('stem_in')},
hl AS (SELECT qid, word AS k, 0 AS side, i * 10 AS i FROM phrases WHERE NOT neg
  UNION ALL SELECT p.qid, x.k, 1, p.i * 10 + x.j FROM
    (SELECT qid, regexp_replace(w, '^\\+', '') AS word, i FROM
      (SELECT qid, unnest(string_split(r, ' ')) AS w, generate_subscripts(string_split(r, ' '), 1) AS i FROM rest)
      WHERE w NOT LIKE '-%') p JOIN stems s ON s.word = p.word,
    LATERAL (SELECT p.word AS k, 0 AS j UNION ALL SELECT s.stem, 1) x),
hl_first AS (SELECT qid, k, min((side, i)) AS place FROM hl GROUP BY qid, k),
joined AS (SELECT qid, trim(string_agg(k, ' ' ORDER BY place), '"') AS j FROM hl_first GROUP BY qid),
kws AS (SELECT qid, k, min(i) AS i FROM (SELECT qid, unnest(f) AS k, generate_subscripts(f, 1) AS i FROM
  (SELECT qid, regexp_extract_all(' ' || {punct('j')}, ' ([^" ]+)', 1) AS f FROM joined))
  WHERE k NOT LIKE 'OR%' AND length(k) >= 3 GROUP BY qid, k),
texts AS (SELECT p.qid, p.entry_id, ' ' || {no_tags("replace(replace(regexp_replace(regexp_replace(trim(i.data, " + WS + "), chr(10), '', 'g'), '\\s{2,}', ' ', 'g'), '<', ' <'), '>', '> ')")} || ' ' AS text
  FROM page_rows p JOIN idx i ON i.entry_id = p.entry_id)"""
RANGES = """letters AS (SELECT entry_id, text, unnest(range(0, length(text))) AS p,
    lower(unnest(string_split(text, ''))) AS c FROM (SELECT DISTINCT entry_id, text FROM texts)),
runs AS (SELECT entry_id, p, string_agg(c, '') OVER (PARTITION BY entry_id ORDER BY p
    ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS run FROM letters),
places AS (SELECT t.qid, t.entry_id, t.text, k.i AS k, r.p FROM texts t JOIN kws k ON k.qid = t.qid
  JOIN runs r ON r.entry_id = t.entry_id AND starts_with(r.run, k.k)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY qid, entry_id, k ORDER BY p) AS n,
  greatest(0, p - 125) AS lo, substr(text, p + 1, 125) AS tail FROM places),
cut AS (SELECT *, lo + instr(substr(text, lo + 1), ' ') - 1 AS a,
  CASE WHEN contains(tail, ' ') THEN p + length(tail) - instr(reverse(tail), ' ') END AS b FROM numbered),
usable AS (SELECT *, bool_and(b IS NOT NULL) OVER (PARTITION BY qid, entry_id, k ORDER BY n) AS ok FROM cut),
summed AS (SELECT *, coalesce(sum(b - a) OVER (PARTITION BY qid, entry_id ORDER BY n, k
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM usable WHERE ok),
taken AS (SELECT qid, entry_id, a, arg_max(b, (n, k)) AS b FROM summed WHERE used < 250 GROUP BY qid, entry_id, a),
marked_r AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY qid, entry_id ORDER BY a
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM taken),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY qid, entry_id ORDER BY a) AS island FROM marked_r),
ranges AS (SELECT qid, entry_id, CAST(min(a) AS INTEGER) AS range_from, CAST(max(b) AS INTEGER) AS range_to
  FROM islands GROUP BY qid, entry_id, island)"""
add("excerpt_ranges", *LIKE_PAGE, HIGHLIGHT, RANGES, select="SELECT qid, entry_id, range_from, range_to FROM ranges")
add("excerpts", *LIKE_PAGE, HIGHLIGHT, RANGES,
    """bodies AS (SELECT r.qid, r.entry_id, CASE WHEN min(range_from) = 0 THEN '' ELSE '...' END ||
  string_agg(substr(t.text, range_from + 1, range_to - range_from), '...' ORDER BY range_from) || '...' AS body
  FROM ranges r JOIN texts t ON t.qid = r.qid AND t.entry_id = r.entry_id GROUP BY r.qid, r.entry_id),
pats AS (SELECT qid, '(' || string_agg(regexp_escape(k), '|' ORDER BY i) || ')' AS pat FROM kws GROUP BY qid),
html AS (SELECT t.qid, t.entry_id, CASE WHEN b.body IS NULL THEN
    CASE WHEN length(t.text) > 250 THEN left(t.text, 250) || '...' ELSE t.text END
  ELSE trim(regexp_replace(regexp_replace(b.body, p.pat, chr(2) || '\\1' || chr(3), 'gi'), '\\s{2,}', ' ', 'g')) END AS h
  FROM texts t LEFT JOIN bodies b ON b.qid = t.qid AND b.entry_id = t.entry_id LEFT JOIN pats p ON p.qid = t.qid)""",
    select="""SELECT qid, entry_id, '<p>' || replace(replace(replace(replace(replace(replace(replace(h, '&', '&amp;'),
  '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(2), '<strong>'), chr(3), '</strong>'), '...', '&#8230;') || '</p>' AS excerpt
  FROM html""")

# Did-you-mean and auto-suggest

BENCH_WORDS = f"""bench_words AS (SELECT DISTINCT w AS word FROM
  (SELECT unnest(string_split({clean('text')}, ' ')) AS w FROM benchmark) WHERE {keyword('w')})"""


def alike(words: str) -> str:
    return f"""alike AS (SELECT w.word, d.keyword AS alternative, CAST(levenshtein(d.keyword, w.word) AS INTEGER) AS distance
  FROM (SELECT word, {sound('word')} AS s FROM {words}) w JOIN dict d ON d.sound = w.s WHERE d.keyword <> w.word)"""


add("soundalikes", *WORDS, DICT, BENCH_WORDS, alike("bench_words"),
    select="SELECT word, alternative, distance FROM alike")
add("soundalikes_short", *WORDS, DICT, BENCH_WORDS, f"""alike AS (SELECT w.word, levenshtein(d.keyword, w.word) AS distance
  FROM (SELECT word, {soundex('word')} AS s FROM bench_words) w JOIN dict d ON d.soundex = w.s WHERE d.keyword <> w.word)""",
    select="SELECT word, count(*) AS alternatives, CAST(min(distance) AS INTEGER) AS distance FROM alike GROUP BY word")
add("closest_alternative", *WORDS, DICT, TURNS, TURN_WORDS, alike("turn_words"),
    select="""SELECT word, alternative, distance FROM alike
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY distance, alternative) = 1""")
TYPED = (TURNS, USER_WORDS, """typed AS (SELECT word AS qid, word,
  CASE WHEN word < 'm' THEN 'src0, src1' ELSE 'nosuch' END AS sections FROM user_words)""")
SUGGESTED = """suggested AS (SELECT t.qid, p.keyword, CAST(sum(p.frequency) AS BIGINT) AS frequency
  FROM typed t JOIN post p ON starts_with(p.keyword, t.word)
  WHERE strlen(t.word) > 2 AND (t.word >= 'm' OR p.section_id IN (1, 2)) GROUP BY t.qid, p.keyword)"""
add("suggest_prefix", *WORDS, *TYPED, select="""SELECT t.qid, d.keyword FROM typed t
  JOIN (SELECT DISTINCT keyword FROM post) d ON starts_with(d.keyword, t.word) WHERE strlen(t.word) > 2""")
add("suggest_frequency", *WORDS, *TYPED, SUGGESTED, select="SELECT qid, keyword, frequency FROM suggested")
add("suggest_topk", *WORDS, *TYPED, SUGGESTED, select="""SELECT qid, keyword, frequency,
  CAST(row_number() OVER (PARTITION BY qid ORDER BY frequency DESC, keyword) AS INTEGER) AS rank FROM suggested
  QUALIFY rank <= 50""")
add("suggest_stored", *WORDS, *TYPED, SUGGESTED, select="""SELECT 'frequency' AS sort, qid, keyword, frequency,
  CAST(row_number() OVER (PARTITION BY qid ORDER BY frequency DESC, keyword) AS INTEGER) AS rank FROM suggested
  QUALIFY rank <= 50
  UNION ALL SELECT 'alphabetical', qid, keyword, frequency,
  CAST(row_number() OVER (PARTITION BY qid ORDER BY keyword) AS INTEGER) AS rank FROM suggested QUALIFY rank <= 50""")
add("keyword_handle", *WORDS, *TYPED, SUGGESTED, select="""SELECT qid,
  CAST(row_number() OVER (PARTITION BY qid ORDER BY keyword) AS INTEGER) AS rank, keyword,
  trim(regexp_replace(lower(keyword), '[^a-z0-9]+', '-', 'g'), '-') AS handle FROM suggested QUALIFY rank <= 50""")

# Search-log analytics

GROUP_COLUMNS = f"""keywords, session_id, {stamp('date')} AS date, keywords_manipulated, sections, results, depth"""
add("log_groups", LOGS, GROUPS, select=f"SELECT {GROUP_COLUMNS} FROM groups")
add("stream_log_groups", LOGS, GROUPS, select=f"SELECT {GROUP_COLUMNS} FROM groups")
add("log_filter", LOGS, select="SELECT id, keywords, session_id FROM logs WHERE keywords ILIKE '%li%'")
add("log_page", LOGS, GROUPS, select=f"""SELECT {GROUP_COLUMNS} FROM
  (SELECT * FROM groups ORDER BY results, keywords, session_id LIMIT 20 OFFSET 40)""")
add("log_count", LOGS, GROUPS, select="SELECT count(*) AS total, CAST(ceil(count(*) / 20) AS BIGINT) AS pages FROM groups")
add("unique_users", LOGS, select="SELECT count(DISTINCT session_id) AS unique_users FROM logs")
add("unique_searches", LOGS, GROUPS, select="SELECT count(*) AS unique_searches FROM groups")
add("unique_terms", LOGS, select="SELECT count(DISTINCT keywords) AS unique_terms FROM logs")
AVERAGE = "CAST(trunc(avg(results)) AS INTEGER) AS average_results"
add("average_results", LOGS, GROUPS, select=f"SELECT {AVERAGE} FROM groups")
add("log_stats", LOGS, GROUPS, select=f"""SELECT count(DISTINCT session_id) AS unique_users, count(*) AS unique_searches,
  count(DISTINCT keywords) AS unique_terms, {AVERAGE} FROM groups""")
add("unique_by_span", LOGS, """days AS (SELECT DISTINCT CAST(date AS DATE) AS day FROM logs)""",
    select="""SELECT CAST(d.day - 6 AS VARCHAR) AS first_day, CAST(d.day AS VARCHAR) AS last_day,
  count(DISTINCT l.session_id) AS unique_users, count(DISTINCT (l.keywords, l.session_id)) AS unique_searches,
  count(DISTINCT l.keywords) AS unique_terms
  FROM days d JOIN logs l ON CAST(l.date AS DATE) BETWEEN d.day - 6 AND d.day GROUP BY d.day""")
add("log_stats_filtered", """all_logs AS (SELECT * FROM events WHERE event_type ILIKE '%li%')""",
    LOGS.replace("FROM events", "FROM all_logs"), GROUPS, select=f"""SELECT count(DISTINCT session_id) AS unique_users,
  count(*) AS unique_searches, count(DISTINCT keywords) AS unique_terms, {AVERAGE} FROM groups""")
add("adjusted_keywords", LOGS, GROUPS, select="""SELECT keywords, session_id,
  CASE WHEN keywords = 'view' THEN 'look' END AS adjusted FROM groups""")
add("recent_searches", LOGS, GROUPS, select=f"""SELECT {stamp('date')} AS date, keywords, results FROM
  (SELECT * FROM groups ORDER BY date DESC, keywords, session_id LIMIT 20)""")
add("already_logged", LOGS, select="""SELECT n.id, EXISTS (SELECT 1 FROM logs o WHERE o.date < TIMESTAMP '2024-01-21'
  AND o.keywords = n.keywords AND o.sections = n.sections AND o.session_id = n.session_id) AS already_logged
  FROM logs n WHERE n.date >= TIMESTAMP '2024-01-21'""")

# Index reports

add("index_size", SECTIONS, ENTRIES, select="""SELECT s.section_id, any_value(s.name) AS name,
  CASE WHEN s.section_id = 20 THEN NULL ELSE count(e.entry_id) FILTER (e.section_id <> 19) END AS entries
  FROM sections s LEFT JOIN entries e ON e.section_id = s.section_id GROUP BY s.section_id""")
add("index_summary", SECTIONS, select="""SELECT section_id, name, CASE WHEN section_id = 20 THEN NULL
  WHEN section_id <= 10 THEN 'Text, Language' ELSE 'Text, Length' END AS fields,
  CASE WHEN section_id = 20 THEN NULL ELSE 'Medium (none)' END AS weighting FROM sections""")

assert set(ORACLES) <= set(REGISTERED)
