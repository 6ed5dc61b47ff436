"""DuckDB statements for the text queries that SQL can express, written from their contracts."""

from __future__ import annotations

from laminar.llm.chat import CLOSE, OPEN, ROLE, TEXT
from laminar.llm.licenses import BLANK_LINE, COMMENT, FILE_NAMES, KEYWORDS, SAYING, TEMPLATES, THRESHOLD, TWO_LINES

CONTROL = "</s>[INST] ok [/INST]"  # fixed by the task
_FRAME = len(OPEN + ROLE + TEXT + CLOSE)


def _escaped(col: str) -> str:
    return rf"regexp_replace({col}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"


CHAT = f"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}')
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_escaped('role')}) + length({_escaped('text')}) + {_FRAME}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""

JACCARD = r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
         THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = d.doc_id"""

_ROWS = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
_NAMES = ", ".join(f"'{n}'" for n in FILE_NAMES)

LICENSES = f"""WITH files AS (
  SELECT doc_id, text, CASE
      WHEN doc_id % 1000 = 0 THEN concat_ws('/', source, 'a' || (doc_id // 1000), 'LICENSE')
      WHEN doc_id % 100 = 0 THEN concat_ws('/', source, 'a' || (doc_id // 1000), 'b' || (doc_id // 100), 'LICENSE.txt')
      ELSE concat_ws('/', source, 'a' || (doc_id // 1000), 'b' || (doc_id // 100), 'c' || (doc_id // 10), 'f' || doc_id || '.txt')
    END AS path FROM documents),
templates(template, license, text) AS (VALUES {_ROWS}),
tterms AS (
  SELECT template, license, t, count(*) AS tf FROM (
    SELECT template, license, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS t FROM templates)
  WHERE t <> '' GROUP BY ALL),
idf AS (SELECT t, ln((1.0 + (SELECT count(*) FROM templates)) / (1 + count(DISTINCT template))) + 1 AS idf FROM tterms GROUP BY t),
tw AS (SELECT template, license, t, tf * idf AS w FROM tterms JOIN idf USING (t)),
norms AS (SELECT template, sqrt(sum(w * w)) AS norm FROM tw GROUP BY template),
declared AS (SELECT *, lower(regexp_extract(path, '([^/.]*)[^/]*$', 1)) IN ({_NAMES}) AS declares FROM files),
pieces AS (
  SELECT doc_id, 2 AS level, unnest(string_split(text, chr(10))) AS text FROM declared
  UNION ALL SELECT doc_id, 1, unnest(string_split_regex(text, '{BLANK_LINE}')) FROM declared
  UNION ALL SELECT doc_id, 1, unnest(string_split_regex(array_to_string(list_transform(string_split(text, chr(10)),
         lambda x: CASE WHEN regexp_matches(x, p) THEN x ELSE '' END), chr(10)), '\n\n+'))
  FROM declared, (VALUES ('{COMMENT}'), ('{SAYING}')) AS c(p)
  UNION ALL SELECT doc_id, 0, text FROM declared WHERE declares),
units AS (SELECT row_number() OVER () AS unit, * FROM pieces
          WHERE regexp_matches(text, '{KEYWORDS}') AND (level <> 1 OR regexp_matches(text, '{TWO_LINES}'))),
uterms AS (
  SELECT doc_id, unit, level, t, count(*) AS tf FROM (
    SELECT doc_id, unit, level, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS t FROM units) WHERE t <> '' GROUP BY ALL),
uw AS (SELECT doc_id, unit, level, u.t, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM templates)) + 1) AS w
       FROM uterms u LEFT JOIN idf ON idf.t = u.t),
lengths AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS length FROM uw GROUP BY ALL),
scores AS (
  SELECT uw.doc_id, uw.unit, uw.level, tw.template, tw.license, sum(uw.w * tw.w) / any_value(norm) / any_value(length) AS s
  FROM uw JOIN tw ON tw.t = uw.t JOIN norms ON norms.template = tw.template
  JOIN lengths ON lengths.doc_id = uw.doc_id AND lengths.unit = uw.unit GROUP BY ALL),
own AS (
  SELECT doc_id, license, score FROM (
    SELECT doc_id, license, round(s, 9) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY level, round(s, 9) DESC, template) AS r
    FROM scores WHERE round(s, 9) >= {THRESHOLD}) WHERE r = 1),
named AS (SELECT d.doc_id, path, declares, license, score, regexp_replace(path, '/?[^/]*$', '') AS dir
          FROM declared d LEFT JOIN own ON own.doc_id = d.doc_id),
dirs AS (SELECT dir, license, score FROM (
    SELECT dir, license, score, row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) AS r
    FROM named WHERE declares AND license IS NOT NULL) WHERE r = 1),
near AS (
  SELECT doc_id, dir, license, score FROM (
    SELECT n.doc_id, d.dir, d.license, d.score, row_number() OVER (PARTITION BY n.doc_id ORDER BY length(d.dir) DESC) AS r
    FROM named n JOIN dirs d ON starts_with(n.dir || '/', CASE WHEN d.dir = '' THEN '' ELSE d.dir || '/' END)
    WHERE n.license IS NULL) WHERE r = 1)
SELECT n.doc_id, n.path, coalesce(n.license, x.license) AS license, coalesce(n.score, x.score) AS score,
       CASE WHEN n.license IS NOT NULL THEN 'own' WHEN x.doc_id IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       x.dir AS from_dir
FROM named n LEFT JOIN near x ON x.doc_id = n.doc_id"""

TOP_K = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored) WHERE r <= 10"""

# CRC-32 of an ASCII string, byte by byte over the table of its 256 remainders
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS tab)"""


def _crc(text: str) -> str:
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT)), "
            "lambda c, b: xor(c >> 8, tab[CAST((xor(c, b) & 255) AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({value} AS VARCHAR))) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """Levels of the trees over ``leaves(tree, pos, digest)``, each node with its run's digests."""
    return f"""{name}(tree, height, pos, digest, n, run) AS (
  SELECT tree, 0, pos, digest, count(*) OVER (PARTITION BY tree), CAST([] AS VARCHAR[]) FROM {leaves}
  UNION ALL SELECT tree, max(height) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 2) // 3),
         list(digest ORDER BY pos) FROM {name} WHERE n > 1 GROUP BY tree, pos // 3)"""


def _sides(name: str, levels: str) -> str:
    """For each node but the top: what stands left and right of it in its run."""
    return f"""{name} AS (
  SELECT c.tree, c.height, c.pos, array_to_string(p.run[1:c.pos % 3], '') AS l, array_to_string(p.run[c.pos % 3 + 2:], '') AS r
  FROM {levels} c JOIN {levels} p ON p.tree = c.tree AND p.height = c.height + 1 AND p.pos = c.pos // 3 WHERE c.n > 1)"""


MERKLE = f"""WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf('text')} AS leaf,
         CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS seen
  FROM documents, crc_table),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
base AS (SELECT tree, pos, leaf AS digest FROM leaves),
{_tree("level", "base")},
{_sides("sides", "level")},
tops AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM level WHERE n = 1),
top_base AS (SELECT 0 AS tree, pos, digest FROM tops),
{_tree("upper", "top_base")},
{_sides("upper_sides", "upper")},
climb(tree, doc_id, start, height, pos, over, proof, folded) AS (
  SELECT tree, doc_id, pos, 0, pos, false, '', coalesce(seen, leaf) FROM leaves
  UNION ALL
  SELECT c.tree, c.doc_id, c.start, CASE WHEN s.tree IS NULL AND NOT c.over THEN 0 ELSE c.height + 1 END,
         CASE WHEN s.tree IS NOT NULL THEN c.pos // 3 WHEN u.tree IS NOT NULL THEN c.pos // 3 ELSE t.pos END,
         s.tree IS NULL, c.proof || coalesce(s.l || s.r, u.l || u.r, ''),
         CASE WHEN s.tree IS NOT NULL THEN sha256(s.l || c.folded || s.r)
              WHEN u.tree IS NOT NULL THEN sha256(u.l || c.folded || u.r) ELSE c.folded END
  FROM climb c
  LEFT JOIN sides s ON NOT c.over AND s.tree = c.tree AND s.height = c.height AND s.pos = c.pos
  LEFT JOIN upper_sides u ON c.over AND u.height = c.height AND u.pos = c.pos
  LEFT JOIN tops t ON t.tree = c.tree
  WHERE NOT c.over OR u.tree IS NOT NULL),
last AS (SELECT * FROM climb WHERE over QUALIFY row_number() OVER (PARTITION BY tree, start ORDER BY height DESC) = 1)
SELECT l.doc_id, l.leaf, t.digest AS subroot, root.digest AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = root.digest AS verified
FROM leaves l JOIN last c ON c.tree = l.tree AND c.start = l.pos JOIN tops t ON t.tree = l.tree
JOIN (SELECT digest FROM upper WHERE n = 1) root ON true"""

def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


# a way to the end: cost, edits, repaired text
def _way(cost: str, edit: str, line: str, rest: str) -> str:
    text = f"{rest}.t" if line == "''" else f"CASE WHEN {rest}.t = '' THEN {line} ELSE {line} || chr(10) || {rest}.t END"
    return f"{{'c': {cost} + {rest}.c, 'e': '{edit}' || {rest}.e, 't': {text}}}"


_FAR = "{'c': CAST(1000000000 AS BIGINT), 'e': '', 't': ''}"
_ROLE_AFTER = ("user", "user", "assistant", "user")  # what may be put in after none, s, u, a
_NEXT = (2, 2, 3, 2)
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _row_ways(state: int) -> str:
    kept = " ".join(f"WHEN '{i}' THEN {_way('CAST(cut AS BIGINT)', 'K', 'role || chr(58) || text', f'w{to}')}"
                    for (s, i), to in _KEEP.items() if s == state)
    role = _ROLE_AFTER[state]
    again = _way("3 + cut", "R", f"'{role}:' || text", f"w{_NEXT[state]}")
    return _least(_way("4", "D", "''", f"w{state}"),
                  f"CASE WHEN gone THEN {_FAR} ELSE CASE initial {kept} ELSE {_FAR} END END",
                  f"CASE WHEN gone THEN {_FAR} ELSE {again} END")


def _with_inserts(prefix: str, state: int) -> str:
    """The best of none, one or two inserts before what comes then."""
    options, lines, s = [f"{prefix}{state}"], [], state
    for n in (1, 2):
        lines.append(f"{_ROLE_AFTER[s]}:")
        s = _NEXT[s]
        options.append(_way(str(3 * n), "I" * n, " || chr(10) || ".join(f"'{x}'" for x in lines), f"{prefix}{s}"))
    return _least(*options)


REPAIR = rf"""WITH RECURSIVE {_CRC_TABLE},
said AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
harmed AS (SELECT *, {_crc('k')} % 20 AS h FROM said, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM harmed WHERE h <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                  regexp_matches(text, '[^\x20\x09-\x0D]') AS solid FROM ordered),
judged AS (
  SELECT *, NOT solid OR again AS gone, CASE WHEN solid AND NOT again AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS cut,
         left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous, count(*) OVER (PARTITION BY conv_id) AS n
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE NOT solid) AS blank,
         count(*) FILTER (WHERE solid AND again) AS duplicate, count(*) FILTER (WHERE cut > 0) AS truncated,
         count(*) FILTER (WHERE previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
back(conv_id, i, w0, w1, w2, w3) AS (
  SELECT conv_id, max(i), {{'c': CAST(0 AS BIGINT), 'e': '', 't': ''}}, {{'c': CAST(6 AS BIGINT), 'e': 'II', 't': 'user:' || chr(10) || 'assistant:'}},
         {{'c': CAST(3 AS BIGINT), 'e': 'I', 't': 'assistant:'}}, {{'c': CAST(0 AS BIGINT), 'e': '', 't': ''}} FROM judged GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, {', '.join(_with_inserts('b', s) for s in range(4))} FROM (
    SELECT b.conv_id, b.i - 1 AS i, {', '.join(f'{_row_ways(s)} AS b{s}' for s in range(4))}
    FROM back b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(w0.c, 0) AS BIGINT) AS cost, coalesce(w0.e, '') AS audit,
       sha256(coalesce(w0.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 0"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT d, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT d, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN sizes ON len(w) >= n)),
hits AS (SELECT DISTINCT d, i, n, win FROM places WHERE win IN (SELECT win FROM windows)),
marked AS (SELECT d, count(DISTINCT p) AS n_hit FROM (SELECT d, unnest(range(i, i + n)) AS p FROM hits) GROUP BY d),
named AS (SELECT DISTINCT d, item FROM hits JOIN windows USING (win)),
lists AS (SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM named GROUP BY d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (d) LEFT JOIN lists USING (d)"""

ORACLE = {
    "op1_chat_format": CHAT,
    "op4_ngram_jaccard_join": JACCARD,
    "op8_license_scan": LICENSES,
    "op10_exact_top_k": TOP_K,
    "op11_merkle_manifest": MERKLE,
    "op12_conversation_repair": REPAIR,
    "op13_decontamination": DECONTAMINATION,
}
