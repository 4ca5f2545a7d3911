"""DuckDB SQL for the queries that SQL can express, on the same tables."""

from __future__ import annotations

import re

from orderlens.llm.licenses import LEAST_COVER, NOT_WORD, PHRASES, SHIFT, TEMPLATES
from orderlens.llm.quality import CLASS_LIMIT, COMMON_WORDS, LEAST_CHARS, LEAST_SHARE, LEAST_WORDS, PUNCTUATION, WORD_LIMIT
from orderlens.llm.secrets import BASE, RULES

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACED = rf"regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+')"

TOP_K = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) AS ranked
WHERE rank <= 10"""

DECONTAMINATION = f"""WITH item_words AS (SELECT item_id, {WORDS} AS w FROM benchmark),
item_runs AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS size,
    array_to_string(w[i + 1 : i + least(10, len(w))], ' ') AS run
  FROM item_words, unnest(range(greatest(len(w) - 9, 1))) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
doc_runs AS (
  SELECT doc_id, i, size, array_to_string(w[i + 1 : i + size], ' ') AS run
  FROM docs, (SELECT DISTINCT size FROM item_runs) AS sizes, unnest(range(greatest(len(w) - size + 1, 0))) AS t(i)),
hits AS (SELECT doc_id, i, size, item FROM doc_runs JOIN item_runs USING (run, size)),
words_hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(size)) AS t(k) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)"""

NGRAM_JACCARD = f"""WITH RECURSIVE docs AS (SELECT doc_id, {SPACED} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 4], ' ') AS shingle
  FROM docs, unnest(range(greatest(len(w) - 3, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached AS (
  SELECT doc_id AS id, doc_id AS root FROM docs
  UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM docs LEFT JOIN sizes USING (doc_id)
JOIN (SELECT id AS doc_id, min(root) AS component_id FROM reached GROUP BY id) AS roots USING (doc_id)"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets_sql() -> str:
    each = []
    for kind, rule in enumerate(RULES):
        pattern = quoted(rule.pattern)
        each.append(f"""SELECT doc_id, {kind} AS kind, {quoted(rule.kind)} AS name,
    [length(x) FOR x IN regexp_split_to_array(body, {pattern})] AS gaps,
    [length(x) FOR x IN regexp_extract_all(body, {pattern})] AS wholes,
    [length(x) FOR x IN regexp_extract_all(body, {pattern}, {rule.group})] AS parts, {max(1, rule.least)} AS least
  FROM docs WHERE regexp_matches(body, {pattern})""")
    union = "\n  UNION ALL ".join(each)
    base = ", ".join(map(quoted, BASE))
    counts = ", ".join(f"count(*) FILTER (name = {quoted(k)}) AS n_{k}" for k in BASE)
    shown = "string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    zeros = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
matches AS ({union}),
spans AS (
  SELECT doc_id, kind, name, CAST(list_sum(gaps[1 : i]) + coalesce(list_sum(wholes[1 : i - 1]), 0) AS BIGINT) AS start,
    CAST(list_sum(gaps[1 : i]) + list_sum(wholes[1 : i]) AS BIGINT) AS stop
  FROM matches, unnest(range(1, len(wholes) + 1)) AS t(i) WHERE parts[i] >= least),
found AS (
  SELECT doc_id, {counts}, {shown} FILTER (name IN ({base})) AS base, {shown} AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (doc_id)"""


def licenses_sql() -> str:
    rows = []
    wordings = [(words, label, "true") for words, label in PHRASES.items()]
    wordings += [(words, label, "false") for label, words in TEMPLATES.items()]
    for number, (wording, label, exact) in enumerate(wordings):
        words = wording.split()
        rows += [
            f"({number}, {quoted(label)}, {exact}, {len(words) - 1}, {i}, {quoted(' '.join(words[i : i + 2]))})"
            for i in range(len(words) - 1)
        ]
    split = f"list_filter(regexp_split_to_array(lower(coalesce(text, '')), {quoted(NOT_WORD)}), lambda x: x <> '')"
    return f"""WITH pairs(template, label, exact, pairs, place, pair) AS (VALUES {", ".join(rows)}),
docs AS (SELECT doc_id, {split} AS w FROM documents),
votes AS (
  SELECT DISTINCT doc_id, template, label, exact, pairs, place, i - place AS diagonal
  FROM docs, unnest(range(greatest(len(w) - 1, 0))) AS t(i) JOIN pairs ON pair = w[i + 1] || ' ' || w[i + 2]),
marked AS (
  SELECT *, CASE WHEN exact OR diagonal - lag(diagonal) OVER o > {SHIFT} OR lag(diagonal) OVER o IS NULL THEN 1 ELSE 0 END
    AS new
  FROM (SELECT DISTINCT doc_id, template, label, exact, pairs, diagonal FROM votes) AS d
  WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM marked),
spans AS (
  SELECT doc_id, template, label, exact, run, min(diagonal) AS first,
    count(DISTINCT place) / CAST(pairs AS DOUBLE) AS share
  FROM votes JOIN runs USING (doc_id, template, label, exact, pairs, diagonal)
  GROUP BY doc_id, template, label, exact, pairs, run),
found AS (
  SELECT doc_id, count(*) FILTER (exact AND share = 1) AS n_base, min(first) FILTER (exact AND share = 1) AS first_word,
    max(first) FILTER (exact AND share = 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact AND share = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN exact THEN share = 1 ELSE share >= {LEAST_COVER} END)
      AS labels,
    max(share) FILTER (NOT exact OR share = 1) AS score
  FROM spans GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (doc_id)"""


BLANKS = r"\x20\x09-\x0D"


def crc32_sql(text: str) -> str:
    """The crc32 of an ASCII text, byte by byte and bit by bit."""
    start = "[CAST(4294967295 AS UBIGINT)]"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS UBIGINT))"
    bit = "lambda d, z: xor(d >> 1, CASE WHEN d & 1 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)"
    byte = f"lambda c, b: list_reduce(list_concat([xor(c, b)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS UBIGINT[])), {bit})"
    return f"CAST(xor(list_reduce(list_concat({start}, {codes}), {byte}), CAST(4294967295 AS UBIGINT)) AS BIGINT)"


PERIODS = rf"""WITH split AS (
  SELECT doc_id, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h, regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+') AS w
  FROM documents),
cut AS (SELECT *, len(w) AS n, h // 10 AS g FROM split),
placed AS (
  SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a,
    CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM cut),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM placed),
words AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs),
equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT doc_id, q AS period, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches o WHERE o.doc_id = s.doc_id AND o.period < s.period AND o.start <= s.start
      AND o.start + o.length >= s.start + s.length)),
longest AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
stay AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
  1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(body, '')) AS collapsed_sha256
FROM docs LEFT JOIN longest USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN stay USING (doc_id)"""


def _divergence_sql(count: str, n: str, share: str) -> str:
    """One bin's part of the Jensen-Shannon divergence less the allowance."""
    p = f"({count} / CAST({n} AS DOUBLE))"
    terms = [f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {share}) / 2)) ELSE 0 END" for x in (p, share)]
    return f"({terms[0]} + {terms[1]}) / 2 - least((1 - {share}) / (8 * {n} * ln(2)), {share} / 2)"


def quality_sql() -> str:
    plain = ("a-z", "A-Z", "0-9", r" \t\r\x0B\x0C", r"\n", re.escape(PUNCTUATION).replace("'", "''"))
    wide = (r"\x{80}-\x{24F}", r"\x{250}-\x{10FFFF}")
    counts = [f"len(regexp_replace(body, '[^{one}]', '', 'g'))" for one in (*plain, *wide)]
    counts.insert(6, "len(body) - " + " - ".join(counts))
    classes = ", ".join(f"CAST({one} AS DOUBLE)" for one in counts)
    return rf"""WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+') AS w,
    {SPACED} AS low FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^{BLANKS}]')) AS l FROM docs),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS span
  FROM docs, unnest(range(1, greatest(len(w) - 1, 1))) AS t(i)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, span) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest(range(3)) AS t(k) GROUP BY doc_id),
classed AS (SELECT doc_id, lang, [{classes}] AS c FROM docs),
bins AS (SELECT doc_id, lang, generate_subscripts(c, 1) AS bin, unnest(c) AS n FROM classed),
class_sums AS (SELECT lang, bin, sum(n) AS n FROM bins WHERE lang IS NOT NULL GROUP BY ALL),
class_shares AS (SELECT lang, bin, n / sum(n) OVER (PARTITION BY lang) AS share FROM class_sums),
words AS (SELECT doc_id, lang, unnest(low) AS word FROM docs),
counted AS (SELECT lang, word, count(*) AS n FROM words WHERE lang IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM counted GROUP BY lang),
known AS (SELECT * FROM totals WHERE total >= (SELECT sum(total) FROM totals) * {LEAST_SHARE}),
common AS (
  SELECT lang, word, CAST(n AS DOUBLE) / total AS share FROM counted JOIN known USING (lang)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {COMMON_WORDS}),
others AS (SELECT lang, greatest(0, 1 - sum(share)) AS share FROM common GROUP BY lang),
against AS (
  SELECT doc_id, known.lang AS reference, len(low) AS n_low, len(body) AS points FROM docs JOIN known
    ON known.lang = docs.lang OR docs.lang IS NULL OR docs.lang NOT IN (SELECT lang FROM known)
  WHERE len(low) > 0),
own AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL),
by_word AS (
  SELECT doc_id, reference, n_low, sum(coalesce(n, 0)) AS found,
    sum({_divergence_sql("coalesce(n, 0)", "n_low", "share")}) AS d
  FROM against JOIN common ON common.lang = reference LEFT JOIN own USING (doc_id, word) GROUP BY ALL),
word_distance AS (
  SELECT doc_id, reference, CASE WHEN n_low >= {LEAST_WORDS} THEN
    sqrt(greatest(0, d + {_divergence_sql("(n_low - found)", "n_low", "share")})) END AS word_distance
  FROM by_word JOIN others ON others.lang = reference),
class_distance AS (
  SELECT doc_id, reference, CASE WHEN points >= {LEAST_CHARS} THEN
    sqrt(greatest(0, sum({_divergence_sql("bins.n", "points", "share")}))) END AS class_distance
  FROM against JOIN bins USING (doc_id) JOIN class_shares ON class_shares.lang = reference AND class_shares.bin = bins.bin
  GROUP BY doc_id, reference, points),
nearest AS (
  SELECT * FROM word_distance JOIN class_distance USING (doc_id, reference) QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY coalesce(word_distance, 0) + coalesce(class_distance, 0), reference) = 1),
measured AS (
  SELECT doc_id, len(w) AS n_words, len(regexp_replace(body, '[{BLANKS}]', '', 'g')) AS word_chars,
    len(body) - len(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words, reference, class_distance, word_distance
  FROM docs JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN nearest USING (doc_id)),
failed AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, reference,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance, base_failed,
  NOT (base_failed OR coalesce(class_distance > {CLASS_LIMIT}, false) OR coalesce(word_distance > {WORD_LIMIT}, false)) AS kept
FROM failed"""


#: The turns that k insertions from a state add: a user's first, but behind a user's row an assistant's.
ADDED = "list_transform(range(k), lambda j: CASE WHEN ({behind} + j) % 2 = 0 THEN 'user:' ELSE 'assistant:' END)"
FOUR_STATES = "(VALUES (0), (1), (2), (3))"

REPAIRS = rf"""WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM numbered WHERE kind <> 0),
placed AS (
  SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^{BLANKS}])[{BLANKS}]*$', 1) AS final,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(len(role) || ':' || role || text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM damaged),
faulty AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair, CASE WHEN final = '' THEN 'blank'
    WHEN seen > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
report AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
moves AS (  -- states: 0 nothing yet, 1 behind the system row, 2 behind a user row, 3 behind an assistant row
  SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(p, role, q)),
added AS (SELECT p, q FROM moves WHERE role <> 's'),
inserted AS (  -- two insertions in a row lead from any state to every other that insertions reach
  SELECT p, p AS q, 0 AS k FROM {FOUR_STATES} AS s(p)
  UNION SELECT p, q, 1 FROM added UNION SELECT a.p, b.q, 2 FROM added a JOIN added b ON a.q = b.p),
edits AS (
  SELECT conv_id, i, p, p AS q, 2 AS cost, 'D' AS edit, '' AS line FROM faulty, {FOUR_STATES} AS s(p)
  UNION ALL SELECT conv_id, i, p, q, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', faulty.role || ':' || text
    FROM faulty JOIN moves ON moves.role = initial WHERE fault IN ('', 'truncated')
  UNION ALL SELECT conv_id, i, p, q, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R',
    CASE moves.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
    FROM faulty JOIN moves ON moves.role <> 's' WHERE fault IN ('', 'truncated')),
steps AS (
  SELECT edits.conv_id, i, inserted.p, edits.q, 5 * k + cost AS cost, repeat('I', k) || edit AS edit,
    list_concat({ADDED.format(behind="CASE WHEN inserted.p = 2 THEN 1 ELSE 0 END")},
      CASE WHEN edit = 'D' THEN CAST([] AS VARCHAR[]) ELSE [line] END) AS lines
  FROM inserted JOIN edits ON inserted.q = edits.p),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state,
    {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS weight FROM report
  UNION ALL
  SELECT best.conv_id, steps.i, steps.q, min({{'cost': CAST(weight.cost + steps.cost AS BIGINT),
    'audit': weight.audit || steps.edit, 'lines': list_concat(weight.lines, steps.lines)}})
  FROM best JOIN steps ON steps.conv_id IS NOT DISTINCT FROM best.conv_id AND steps.i = best.i + 1 AND steps.p = best.state
  GROUP BY best.conv_id, steps.i, steps.q),
ended AS (
  SELECT best.conv_id, min({{'cost': CAST(weight.cost + 5 * k AS BIGINT), 'audit': weight.audit || repeat('I', k),
    'lines': list_concat(weight.lines, {ADDED.format(behind="CASE WHEN state = 2 THEN 1 ELSE 0 END")})}}) AS weight
  FROM best JOIN report ON report.conv_id IS NOT DISTINCT FROM best.conv_id AND report.n = best.i
  JOIN inserted ON inserted.p = best.state AND inserted.q IN (0, 3) GROUP BY best.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(weight.cost, 0) AS cost,
  coalesce(weight.audit, '') AS audit, sha256(coalesce(array_to_string(weight.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN report ON report.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op3_exact_top_k": TOP_K,
    "op4_decontamination": DECONTAMINATION,
    "op5_ngram_jaccard": NGRAM_JACCARD,
    "op6_secrets": secrets_sql(),
    "op7_licenses": licenses_sql(),
    "op11_conversation_repair": REPAIRS,
    "op12_periodic_runs": PERIODS,
    "op13_quality_rules": quality_sql(),
}
