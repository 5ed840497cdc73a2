"""DuckDB statements that state the expected result of the registered queries."""

from __future__ import annotations

from facetry.plans import catalog as c
from facetry.schema import ASPECTS, ROUTE_BIGRU

# The character sets as they are expected to be, stated here on their own.
BLANKS = "".join(map(chr, (0x20, 0xA0, 0x0A, 0xFEFF, 0x0D)))
# two runs of symbols, the first with a range from the colon to U+3010; this dialect's \\s lacks
# the vertical tab
SYMBOL_RUNS = (
    r"[\s\x0b\x1c\x1d\x1e\x1f+./_,$%^*();\x{FF1B}:-\x{3010}\x{3011}']"
    r"|[+\x{2014}\x{FF01}\x{FF0C};:\x{3002}\x{3001}~#\x{FFE5}%&*\x{FF08}\x{FF09}]"
)
CHAR_CLASSES = {
    "han": r"[\x{4E00}-\x{9FFF}]",
    "not_han": r"[\x{0}-\x{4E00}\x{9FFF}-\x{10FFFF}]",
    "digit": "[0123456789]",
    "letter": "[[:alpha:]]",
    "blank": r"[\x{20}\x{A0}\x{0A}\x{FEFF}\x{0D}]",
}
# the emoji that the transliteration can put into a text: a flag of two letters, or one of a smiling
# face, a heart, a woman, a computer, a star, a skin tone, with a selector, a tone and joined ones
_FOUND = r"[\x{1F600}\x{2764}\x{1F469}\x{1F4BB}\x{2B50}\x{1F3FD}]\x{FE0F}?\x{1F3FD}?"
EMOJI_FOUND = rf"[\x{{1F1E8}}\x{{1F1F3}}][\x{{1F1E8}}\x{{1F1F3}}]|{_FOUND}(?:\x{{200D}}{_FOUND})*"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _nums(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]"


LOWER = "lower(text)"
HAN = f"translate(lower(text), {_q(c.LATIN)}, {_q(c.HAN)})"
EMOJI = f"translate(text, {_q(c.EMOJI_FROM)}, {_q(c.EMOJI_TO)})"
WORDS = f"regexp_extract_all({LOWER}, {_q(c.WORD)})"
CHARS = f"string_split({LOWER}, '')"
STOP_ONE = "".join(w for w in c.STOP_CHARS if len(w) == 1)


def _drop_stop(text: str) -> str:
    return f"translate({text}, {_q(STOP_ONE + BLANKS)}, '')"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, {_q(SYMBOL_RUNS)}, '', 'g')"


def _non_han(text: str) -> str:
    return f"regexp_replace({text}, '[\\x{{4e01}}-\\x{{9ffe}}]', '', 'g')"


IN_LIST = "({})".format(", ".join(_q(w) for w in c.STOP_CHARS))

ASPECT_VALUES = ", ".join(f"({i}, '{code}', '{name}')" for i, code, name in ASPECTS)
ASPECT_CTE = f"aspect(aspect_idx, code, aspect) AS (VALUES {ASPECT_VALUES})"


def _cell(offset: int, k: str) -> str:
    return f"embedding[((a * 8 + {offset} + {k}) % 64) + 1]::DOUBLE"


def _vec(offset: int) -> str:
    return "[" + ", ".join(_cell(offset, str(k)) for k in range(4)) + "]"


ARGMAX = "[-2, -1, 0, 1][list_position({0}, list_max({0}))]"
GOLD = "[-2, -1, 0, 1][((vec_id * 7 + a) % 4) + 1]"
CELLS = "embeddings, (SELECT unnest(range(0, 20)) AS a)"

SCORES = f"""scores AS (
  SELECT vec_id, (a + 1)::INTEGER AS aspect_idx, {_vec(0)} AS pa, {_vec(4)} AS pb, {GOLD} AS y, label
  FROM {CELLS}),
mean AS (
  SELECT *, [{', '.join(f'0.5 * pa[{k}] + 0.5 * pb[{k}]' for k in range(1, 5))}] AS p FROM scores),
pairs AS (SELECT aspect_idx, y, {ARGMAX.format('p')} AS yhat FROM mean)"""


def _report(keys: str) -> str:
    on = " AND ".join(f"x.{k.strip()} = k.{k.strip()}" for k in keys.split(","))
    return f"""conf AS (SELECT {keys}, y, yhat, count(*) AS n FROM pairs GROUP BY ALL),
classes AS (SELECT {keys}, y AS class FROM conf UNION SELECT {keys}, yhat FROM conf),
report AS (
  SELECT {', '.join('k.' + k.strip() for k in keys.split(','))}, k.class,
    coalesce(sum(n) FILTER (y = class AND yhat = class), 0) AS tp,
    coalesce(sum(n) FILTER (yhat = class), 0) AS predicted,
    coalesce(sum(n) FILTER (y = class), 0) AS actual
  FROM classes k JOIN conf x ON {on} GROUP BY ALL),
ratios AS (
  SELECT {keys}, class, tp, actual AS support,
    CASE WHEN predicted = 0 THEN 0.0 ELSE tp::DOUBLE / predicted END AS precision,
    CASE WHEN actual = 0 THEN 0.0 ELSE tp::DOUBLE / actual END AS recall,
    CASE WHEN predicted + actual = 0 THEN 0.0 ELSE 2.0 * tp::DOUBLE / (predicted + actual) END AS f1
  FROM report),
macro AS (
  SELECT {keys}, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1
  FROM ratios GROUP BY ALL)"""


HISTORY = f"""scores AS (
  SELECT label AS epoch, (a + 1)::INTEGER AS aspect_idx, {_vec(0)} AS pa, {GOLD} AS y FROM {CELLS}),
pairs AS (SELECT epoch, aspect_idx, y, {ARGMAX.format('pa')} AS yhat FROM scores),
{_report('aspect_idx, epoch')}"""


def _vocab(tokens: str, source: str = "documents", key: str = "doc_id", name: str = "vocab") -> str:
    return f"""{name}_tokens AS (
  SELECT {key} AS id, unnest({tokens}) AS token, generate_subscripts({tokens}, 1) AS pos FROM {source}),
{name} AS (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, place.id, place.pos) AS idx
  FROM (SELECT token, count(*) AS n, min({{'id': id, 'pos': pos}}) AS place FROM {name}_tokens GROUP BY token))"""


BENCH_VOCAB = _vocab(WORDS, "benchmark", "item_id", "bench")
DOC_WORDS = f"""doc_words AS (
  SELECT doc_id, unnest({WORDS}) AS token, generate_subscripts({WORDS}, 1) AS pos FROM documents)"""


def _padded(seq: str) -> str:
    return (
        f"list_concat(list_resize(CAST([] AS BIGINT[]), greatest({c.MAXLEN} - len({seq}), 0), 0),"
        f" {seq}[greatest(len({seq}) - {c.MAXLEN}, 0) + 1:])"
    )


def _encoded(doc_tokens: str, vocab: str) -> str:
    padded = _padded("coalesce(s.seq, [])")
    return f"""found AS (
  SELECT doc_id, list(idx ORDER BY pos) AS seq FROM {doc_tokens} JOIN {vocab} USING (token) GROUP BY doc_id)
SELECT d.doc_id, {c.MAXLEN} AS n, array_to_string({padded}, ' ') AS seq
FROM documents d LEFT JOIN found s USING (doc_id)"""


FRAGMENTS = """fragments AS (
  SELECT item_id, unnest(string_split_regex(text, '[.,\\n]')) AS raw,
    generate_subscripts(string_split_regex(text, '[.,\\n]'), 1) AS pos FROM benchmark),
phrases AS (
  SELECT trim(raw) AS token, row_number() OVER (ORDER BY min({'item_id': item_id, 'pos': pos})) AS ord
  FROM fragments WHERE trim(raw) <> '' GROUP BY trim(raw)),
"""

LINE_STARTS = f"""line_starts AS (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations),
phrases AS (
  SELECT token, row_number() OVER (ORDER BY token) AS ord FROM (
    SELECT DISTINCT left(line, k) AS token FROM line_starts, (SELECT unnest({c.PHRASE_SIZES}) AS k) WHERE length(line) >= k)),
"""

FOUND = """parts AS (
  SELECT doc_id, token, ord, unnest(string_split(text, token)) AS part,
    generate_subscripts(string_split(text, token), 1) AS k, len(string_split(text, token)) AS parts
  FROM documents JOIN phrases ON contains(text, token)),
found AS (
  SELECT doc_id, token, ord, k, parts,
    sum(length(part)) OVER (PARTITION BY doc_id, token ORDER BY k) + (k - 1) * length(token) AS pos
  FROM parts)"""

PHRASES = FRAGMENTS + FOUND

# The likeliest cut: dictionary words are letters only, so every other character stands alone and
# every distinct run of letters is solved once, from its end, over the words found in it.
LIKELIEST = """total AS (SELECT sum(freq)::DOUBLE AS t FROM dictionary),
weights AS (SELECT token, length(token) AS n, round(ln(freq / t) * 4294967296)::BIGINT AS w FROM dictionary, total),
parts AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}]+|(?s:.)')) AS part,
    generate_subscripts(regexp_extract_all(lower(text), '[\\p{L}]+|(?s:.)'), 1) AS pos FROM documents),
runs AS (SELECT DISTINCT part FROM parts),
places AS (SELECT part, unnest(range(1, length(part) + 1)) AS place FROM runs),
pieces AS (
  SELECT part, length(part) - place + 1 AS rest, l.n, substr(part, place, l.n) AS token
  FROM places JOIN (SELECT DISTINCT n FROM weights) l ON place + l.n - 1 <= length(part)),
found AS (
  SELECT part, rest, list({'n': w.n, 'w': w.w}) AS words
  FROM pieces JOIN weights w USING (token) GROUP BY part, rest),
open AS (
  SELECT p.part, length(p.part) - p.place + 1 AS rest, [{'n': 1, 'w': round(-ln(t) * 4294967296)::BIGINT}] AS words
  FROM places p CROSS JOIN total
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.part = p.part AND f.rest = length(p.part) - p.place + 1)),
choices AS (
  SELECT part, rest,
    CASE WHEN len(list_filter(words, lambda x: x.n = 1)) = 0 THEN list_append(words, {'n': 1, 'w': round(-ln(t) * 4294967296)::BIGINT}) ELSE words END AS words
  FROM found CROSS JOIN total
  UNION ALL SELECT part, rest, words FROM open),
solved AS (
  SELECT part, 0::BIGINT AS k, [0::BIGINT] AS best, []::BIGINT[] AS step FROM runs
  UNION ALL
  SELECT part, rest, list_append(best, top.s), list_append(step, top.n) FROM (
    SELECT s.part, c.rest, s.best, s.step,
      list_max(list_transform(c.words, lambda x: {'s': x.w + s.best[c.rest - x.n + 1], 'n': x.n})) AS top
    FROM solved s JOIN choices c ON c.part = s.part AND c.rest = s.k + 1)),
ready AS (SELECT part, step FROM solved WHERE k = length(part)),
walk AS (
  SELECT part, step, length(part) AS rest, []::VARCHAR[] AS tokens FROM ready
  UNION ALL
  SELECT part, step, rest - step[rest], list_append(tokens, substr(part, length(part) - rest + 1, step[rest]))
  FROM walk WHERE rest > 0),
cut AS (SELECT part, tokens FROM walk WHERE rest = 0),
joined AS (
  SELECT doc_id, sum(len(tokens))::INTEGER AS n_tokens, string_agg(array_to_string(tokens, '/'), '/' ORDER BY pos) AS tokens
  FROM parts JOIN cut USING (part) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(tokens, '') AS tokens FROM documents d LEFT JOIN joined USING (doc_id)"""


def _dictionary(text: str, pattern: str, name: str = "dictionary") -> str:
    return f"""{name}_words AS (SELECT unnest(regexp_extract_all({text}, {_q(pattern)})) AS token FROM benchmark),
{name} AS (SELECT token, count(*) AS freq FROM {name}_words GROUP BY token)"""


LONGEST = "(SELECT string_agg(token, '|' ORDER BY length(token) DESC, token) || '|(?s:.)' FROM dictionary)"

SEQUENCES = f"""{_vocab(WORDS)},
steps AS (
  SELECT t.id AS doc_id, t.pos - 1 AS pos, v.idx,
    CASE WHEN e.vec_id IS NULL THEN list_resize(CAST([] AS FLOAT[]), {c.DIM}, 0) ELSE e.embedding END AS v
  FROM vocab_tokens t JOIN vocab v USING (token) LEFT JOIN embeddings e ON e.vec_id + 1 = v.idx),
cells AS (
  SELECT doc_id, pos, unnest(range(0, {c.DIM}))::INTEGER AS dim, unnest(v)::DOUBLE AS x FROM steps),
grid AS (SELECT doc_id, unnest(range(0, {c.DIM}))::INTEGER AS dim FROM documents)"""

BIAS = "((3 * pos) % 7 - 3) / 20.0"
ATTENTION = f"""weights AS (
  SELECT doc_id, pos, exp(tanh(list_sum(list_transform(range(1, {c.DIM + 1}),
    lambda i: v[i]::DOUBLE * {_nums(c.ATTENTION)}[i])) + {BIAS})) AS a FROM steps),
totals AS (SELECT doc_id, sum(a) + 1e-7 AS total FROM weights GROUP BY doc_id),
attended AS (
  SELECT doc_id, dim, sum(a * x) / any_value(total) AS value
  FROM cells JOIN weights USING (doc_id, pos) JOIN totals USING (doc_id) GROUP BY doc_id, dim)"""


def _pooled(aggregate: str) -> str:
    return f"""WITH {SEQUENCES},
pooled AS (SELECT doc_id, dim, {aggregate}(x) AS value FROM cells GROUP BY doc_id, dim)
SELECT doc_id, dim, round(coalesce(value, 0.0), 6) AS value FROM grid LEFT JOIN pooled USING (doc_id, dim)"""


def _projected(vector: str, weights, j: int, size: int) -> str:
    column = _nums([row[j] for row in weights])
    return f"list_sum(list_transform(range(1, {size + 1}), lambda i: {vector}[i]::DOUBLE * {column}[i]))"


def _query_attention(w_out: list[float]) -> str:
    asked = "[" + ", ".join(f"((doc_id + {i}) % 5) / 5.0" for i in range(4)) + "]::DOUBLE[]"
    hidden = " + ".join(
        f"({w_out[j]}) * tanh({_projected('q', c.W_QUERY, j, 4)} + ({c.B_QUERY[j]})"
        f" + {_projected('v', c.W_STEP, j, c.DIM)} + ({c.B_STEP[j]}))"
        for j in range(c.HIDDEN)
    )
    return f"""WITH {SEQUENCES},
asked AS (SELECT *, {asked} AS q FROM steps),
energies AS (SELECT doc_id, pos, {hidden} + {BIAS} AS e FROM asked),
shifted AS (SELECT doc_id, pos, exp(e - max(e) OVER (PARTITION BY doc_id)) AS a FROM energies),
totals AS (SELECT doc_id, sum(a) + 1e-7 AS total FROM shifted GROUP BY doc_id),
attended AS (
  SELECT doc_id, dim, sum(a * x) / any_value(total) AS value
  FROM cells JOIN shifted USING (doc_id, pos) JOIN totals USING (doc_id) GROUP BY doc_id, dim)
SELECT doc_id, dim, round(coalesce(value, 0.0), 6) AS value FROM grid LEFT JOIN attended USING (doc_id, dim)"""


# Multinomial naive Bayes, one count added to every word and class; two classes, two aspects.
BAYES = f"""WITH {_vocab(WORDS)},
counts AS (SELECT id AS doc_id, idx, count(*) AS n FROM vocab_tokens JOIN vocab USING (token) GROUP BY ALL),
gold AS (
  SELECT doc_id, 1 AS aspect_idx, quality AS y FROM labels WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, 2, toxic FROM labels WHERE doc_id % 2 = 0),
docs AS (SELECT aspect_idx, y, count(*) AS n FROM gold JOIN documents USING (doc_id) GROUP BY ALL),
prior AS (SELECT aspect_idx, y, ln(n + 1.0::DOUBLE) - ln(sum(n) OVER (PARTITION BY aspect_idx) + 2.0::DOUBLE) AS pi FROM docs),
seen AS (SELECT aspect_idx, y, idx, sum(n) AS n FROM gold JOIN counts USING (doc_id) GROUP BY ALL),
totals AS (SELECT aspect_idx, y, sum(n) AS total FROM seen GROUP BY ALL),
theta AS (
  SELECT t.aspect_idx, t.y, v.idx, ln(coalesce(s.n, 0) + 1.0::DOUBLE) - ln(t.total + (SELECT count(*) FROM vocab)::DOUBLE) AS w
  FROM totals t CROSS JOIN (SELECT idx FROM vocab) v
  LEFT JOIN seen s ON s.aspect_idx = t.aspect_idx AND s.y = t.y AND s.idx = v.idx),
sums AS (SELECT doc_id, aspect_idx, y, sum(n * w) AS s FROM counts JOIN theta USING (idx) GROUP BY ALL),
raw AS (
  SELECT d.doc_id, p.aspect_idx, p.y, p.pi + coalesce(s.s, 0.0) AS s
  FROM documents d CROSS JOIN prior p LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.aspect_idx = p.aspect_idx AND s.y = p.y),
pair AS (
  SELECT doc_id, aspect_idx, max(s) FILTER (y = 0) AS s0, max(s) FILTER (y = 1) AS s1 FROM raw GROUP BY ALL)
SELECT doc_id, aspect_idx, round(1.0::DOUBLE / (1.0::DOUBLE + exp(s1 - s0)), 6) AS p0,
  round(1.0::DOUBLE / (1.0::DOUBLE + exp(s0 - s1)), 6) AS p1, (s1 > s0)::INTEGER AS yhat FROM pair"""


def _aspect_scores() -> str:
    """Plain gradient steps of 20 multinomial models over standardised mean vectors; -1 is the intercept."""
    labels = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS aspect_idx, "
        + " + ".join(f"((length(text) - length(replace(text, '{letter}', ''))) * 100 >= length(text) * {b})::INTEGER" for b in c.CLASS_BORDERS)
        + " AS y FROM documents WHERE length(text) > 0"
        for (i, _, _), letter in zip(ASPECTS, c.ASPECT_LETTERS, strict=True)
    )
    steps = []
    for k in range(1, c.STEPS + 1):
        steps.append(f"""{_softmax(k - 1, "WHERE doc_id % 2 = 0")},
g{k} AS (
  SELECT z.dim, p.aspect_idx, p.c, sum(z.z * (p.p - (p.c = g.y)::INTEGER)) / count(*) AS g
  FROM p{k - 1} p JOIN gold g USING (doc_id, aspect_idx) JOIN z USING (doc_id) GROUP BY ALL),
w{k} AS (
  SELECT w.dim, w.aspect_idx, w.c, w.w - {c.STEP} * (coalesce(g.g, 0.0) + CASE WHEN w.dim < 0 OR g.g IS NULL THEN 0.0 ELSE {c.REG} * w.w END) AS w
  FROM w{k - 1} w LEFT JOIN g{k} g USING (dim, aspect_idx, c))""")
    four = ", ".join(f"round(max(p) FILTER (c = {k}), 6) AS p{k}" for k in range(4))
    return f"""WITH {SEQUENCES},
pooled AS (SELECT doc_id, dim, avg(x) AS value FROM cells GROUP BY doc_id, dim),
x AS (SELECT doc_id, dim, coalesce(value, 0.0) AS x FROM grid LEFT JOIN pooled USING (doc_id, dim)),
spread AS (
  SELECT dim, avg(x) AS m, CASE WHEN sqrt(greatest(var_pop(x), 0)) < 1e-12 THEN 1.0 ELSE sqrt(greatest(var_pop(x), 0)) END AS s
  FROM x WHERE doc_id % 2 = 0 GROUP BY dim),
z AS (
  SELECT doc_id, dim, (x - m) / s AS z FROM x JOIN spread USING (dim)
  UNION ALL SELECT doc_id, -1, 1.0 FROM documents),
gold AS ({labels}),
w0 AS (
  SELECT dim, aspect_idx, c, 0.0::DOUBLE AS w FROM (SELECT DISTINCT dim FROM z), (SELECT unnest(range(1, 21)) AS aspect_idx), (SELECT unnest(range(4)) AS c)),
{", ".join(steps)},
{_softmax(c.STEPS, "")}
SELECT doc_id, aspect_idx::INTEGER AS aspect_idx, {four}, (arg_min(c, (-round(p, 6), c)) - 2)::INTEGER AS yhat FROM p{c.STEPS} GROUP BY doc_id, aspect_idx"""


def _softmax(k: int, where: str) -> str:
    return f"""s{k} AS (
  SELECT doc_id, aspect_idx, c, sum(z * w) AS s FROM (SELECT * FROM z {where}) JOIN w{k} USING (dim) GROUP BY ALL),
e{k} AS (SELECT doc_id, aspect_idx, c, exp(s - max(s) OVER (PARTITION BY doc_id, aspect_idx)) AS e FROM s{k}),
p{k} AS (SELECT doc_id, aspect_idx, c, e / sum(e) OVER (PARTITION BY doc_id, aspect_idx) AS p FROM e{k})"""


def _wide(expression: str, source: str) -> str:
    columns = ", ".join(f"any_value(v) FILTER (aspect_idx = {i}) AS {name}" for i, _, name in ASPECTS)
    return f"SELECT vec_id, {columns} FROM (SELECT vec_id, aspect_idx, {expression} AS v FROM {source}) GROUP BY vec_id"


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all({HAN}, {_q(pattern)}))"


def statements() -> dict[str, str]:
    four = ", ".join(f"round(p[{k + 1}], 9) AS p{k}" for k in range(4))
    routed = ARGMAX.format(f"(CASE WHEN aspect_idx IN {ROUTE_BIGRU} THEN pa ELSE pb END)")
    both = "(SELECT vec_id, aspect_idx, 'bigru' AS model, pa AS p FROM scores UNION ALL SELECT vec_id, aspect_idx, 'capsule', pb FROM scores)"
    class_columns = ", ".join(f"{_count(p)}::INTEGER AS {n}" for n, p in CHAR_CLASSES.items())
    keep_tokens = f"list_filter(tokens, lambda t: t NOT IN {IN_LIST})"
    stop_words = "({})".format(", ".join(_q(w) for w in c.STOP_WORDS))
    report = _report("aspect_idx")
    return {
        "soft_vote_macro_f1": f"WITH {SCORES}, {report}, {ASPECT_CTE} SELECT aspect_idx, aspect, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM macro JOIN aspect USING (aspect_idx)",
        "mean_macro_f1": f"WITH {SCORES}, {report} SELECT round(avg(f1), 9) AS mean_f1 FROM macro",
        "classification_report": f"WITH {SCORES}, {report} SELECT aspect_idx, class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support::BIGINT AS support FROM ratios",
        "classification_summary": f"WITH {SCORES}, {report} SELECT aspect_idx, round(sum(tp) / sum(support), 9) AS accuracy, round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1, round(sum(precision * support) / sum(support), 9) AS weighted_precision, round(sum(recall * support) / sum(support), 9) AS weighted_recall, round(sum(f1 * support) / sum(support), 9) AS weighted_f1, sum(support)::BIGINT AS support FROM ratios GROUP BY aspect_idx",
        "average_score_vectors": f"WITH {SCORES} SELECT vec_id, aspect_idx, {four}, {ARGMAX.format('p')} AS yhat FROM mean",
        "average_score_tables": f"WITH {SCORES} " + _wide(ARGMAX.format("p"), "mean"),
        "route_by_aspect": f"WITH {SCORES} " + _wide(routed, "scores"),
        "picked_aspects": f"WITH {SCORES}, {ASPECT_CTE} SELECT vec_id, aspect_idx, code, aspect, model, {ARGMAX.format('p')} AS yhat FROM {both} JOIN aspect USING (aspect_idx) WHERE aspect_idx IN (3, 6, 18)",
        "wide_to_long": f"WITH {SCORES}, {ASPECT_CTE} SELECT vec_id, aspect_idx, aspect, y FROM scores JOIN aspect USING (aspect_idx)",
        "long_to_wide": f"WITH {SCORES} " + _wide(ARGMAX.format("pa"), "scores"),
        "aligned_gold": f"WITH {SCORES} SELECT aspect_idx, y, {ARGMAX.format('pb')} AS yhat, count(*) AS n FROM scores GROUP BY ALL",
        "one_hot_labels": f"WITH {SCORES} SELECT vec_id, aspect_idx, " + ", ".join(f"(y = {k - 2})::INTEGER AS h{k}" for k in range(4)) + " FROM scores",
        "best_so_far_f1": f"WITH {HISTORY} SELECT aspect_idx, epoch, round(f1, 9) AS f1, round(max(f1) OVER (PARTITION BY aspect_idx ORDER BY epoch ROWS UNBOUNDED PRECEDING), 9) AS best_f1 FROM macro",
        "best_epoch": f"WITH {HISTORY}, rounded AS (SELECT aspect_idx, epoch, round(f1, 9) AS f1 FROM macro) SELECT aspect_idx, epoch, f1 FROM (SELECT *, row_number() OVER (PARTITION BY aspect_idx ORDER BY f1 DESC, epoch) AS r FROM rounded) WHERE r = 1",
        "score_vector_text_roundtrip": f"WITH {SCORES} SELECT vec_id, aspect_idx, model, {four} FROM {both}",
        "keep_han": f"SELECT doc_id, regexp_replace({HAN}, '[^\\x{{4e00}}-\\x{{9fff}}]', '', 'g') AS text FROM documents",
        "keep_non_han": f"SELECT doc_id, {_drop_stop(_non_han(HAN))} AS text FROM documents",
        "symbol_lines": f"SELECT * FROM (SELECT doc_id, {_drop_stop(_non_han(HAN))} AS text FROM documents) WHERE length(text) > 0",
        "char_class_counts": f"SELECT doc_id, {class_columns} FROM documents",
        "char_class_totals": f"WITH chars AS (SELECT unnest(string_split({HAN}, '')) AS c FROM documents) SELECT c, count(*) AS n, c BETWEEN '一' AND '鿿' AS han, c <= '一' OR c >= '鿿' AS not_han, c BETWEEN '0' AND '9' AS digit, c BETWEEN 'A' AND 'Z' OR c BETWEEN 'a' AND 'z' AS letter, c IN (' ', chr(160), chr(10), chr(65279), chr(13)) AS blank FROM chars WHERE c <> '' GROUP BY c",
        "strip_symbols": f"SELECT doc_id, {_strip(HAN)} AS text FROM documents",
        "strip_symbols_latin": f"SELECT doc_id, {_strip('text')} AS text FROM documents",
        "drop_stop_chars": f"SELECT doc_id, {_drop_stop(HAN)} AS text FROM documents",
        "spaced_chars": f"SELECT doc_id, array_to_string(string_split({_drop_stop(HAN)}, ''), ' ') AS text FROM documents",
        "char_tokens": f"SELECT doc_id, length(t)::INTEGER AS n_tokens, array_to_string(string_split(t, ''), '|') AS tokens FROM (SELECT doc_id, {_drop_stop(HAN)} AS t FROM documents)",
        "list_text_roundtrip": "SELECT doc_id, length(text)::INTEGER AS n_tokens, text FROM documents",
        "emoji_list": f"WITH found AS (SELECT doc_id, regexp_extract_all({EMOJI}, {_q(EMOJI_FOUND)}) AS e FROM documents) SELECT doc_id, (unnest(range(len(e))))::INTEGER AS ord, unnest(e) AS emoji FROM found",
        "emoji_counts": f"SELECT emoji, count(*) AS n FROM (SELECT unnest(regexp_extract_all({EMOJI}, {_q(EMOJI_FOUND)})) AS emoji FROM documents) GROUP BY emoji",
        "distinct_chars": f"WITH chars AS (SELECT doc_id, unnest(string_split({EMOJI}, '')) AS value, generate_subscripts(string_split({EMOJI}, ''), 1) AS pos FROM documents) SELECT value, row_number() OVER (ORDER BY min({{'id': doc_id, 'pos': pos}})) AS idx FROM chars WHERE value NOT IN ('', chr(10)) GROUP BY value",
        "distinct_lines": "WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) SELECT line, row_number() OVER (ORDER BY min({'id': doc_id, 'pos': pos})) AS idx FROM lines GROUP BY line",
        "dictionary_lines": "SELECT conv_id, turn, text || ' 2000' AS line FROM conversations",
        "phrase_hits": f"WITH {PHRASES} SELECT doc_id, pos::INTEGER AS pos, arg_max(token, ord) AS token FROM found WHERE k < parts GROUP BY doc_id, pos",
        "phrase_counts": f"WITH {PHRASES} SELECT doc_id, token, count(*) AS n FROM found WHERE k < parts GROUP BY doc_id, token",
        "occurrence_counts": "SELECT doc_id, (len(string_split(text, 'erer')) - 1)::INTEGER AS n FROM documents",
        "vocab_fit": f"WITH {_vocab(CHARS)} SELECT token, n, idx FROM vocab",
        "vocab_fit_words": f"WITH {_vocab(WORDS)} SELECT token, n, idx FROM vocab",
        "vocab_lookup": f"WITH {BENCH_VOCAB}, {DOC_WORDS}, found AS (SELECT doc_id, count(*) AS n, string_agg(idx, ' ' ORDER BY pos) AS seq FROM doc_words JOIN bench USING (token) GROUP BY doc_id) SELECT doc_id, coalesce(n, 0)::INTEGER AS n, coalesce(seq, '') AS seq FROM documents LEFT JOIN found USING (doc_id)",
        "vocab_lookup_zero": f"WITH {BENCH_VOCAB}, {DOC_WORDS}, found AS (SELECT doc_id, count(*) AS n, string_agg(coalesce(idx, 0), ' ' ORDER BY pos) AS seq FROM doc_words LEFT JOIN bench USING (token) GROUP BY doc_id) SELECT doc_id, coalesce(n, 0)::INTEGER AS n, coalesce(seq, '') AS seq FROM documents LEFT JOIN found USING (doc_id)",
        "encode_pad": f"WITH {_vocab(CHARS)}, doc_chars AS (SELECT id AS doc_id, token, pos FROM vocab_tokens), {_encoded('doc_chars', 'vocab')}",
        "encode_pad_words": f"WITH {BENCH_VOCAB}, {DOC_WORDS}, {_encoded('doc_words', 'bench')}",
        "segment_longest_match": f"WITH {_dictionary(LOWER, c.WORD)}, cut AS (SELECT doc_id, regexp_extract_all(lower(text), {LONGEST}) AS tokens FROM documents) SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, '/') AS tokens FROM cut",
        "segment_likeliest": f"WITH RECURSIVE {_dictionary(LOWER, c.WORD)}, {LIKELIEST}",
        "segment_large_dictionary": f"WITH cut AS (SELECT doc_id, regexp_extract_all({LOWER}, {_q(c.WORD + '|(?s:.)')}) AS tokens FROM documents) SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, '/') AS tokens FROM cut",
        "phrase_hits_large": f"WITH {LINE_STARTS}{FOUND} SELECT doc_id, pos::INTEGER AS pos, arg_max(token, ord) AS token FROM found WHERE k < parts GROUP BY doc_id, pos",
        "word_tokens": f"WITH {_dictionary(HAN, chr(91) + '一-鿿' + chr(93) + '+')}, cut AS (SELECT doc_id, regexp_extract_all({_strip(HAN)}, {LONGEST}) AS tokens FROM documents), kept AS (SELECT doc_id, {keep_tokens} AS tokens FROM cut) SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, '/') AS tokens FROM kept",
        "stop_words_removed": f"WITH kept AS (SELECT doc_id, list_filter({WORDS}, lambda t: t NOT IN {stop_words}) AS tokens FROM documents) SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM kept",
        "stop_words_joined": f"WITH {_dictionary(LOWER, c.WORD)}, {DOC_WORDS} SELECT token, count(*) AS n FROM doc_words WHERE token NOT IN (SELECT token FROM dictionary) GROUP BY token",
        "keywords_top40": f"WITH {DOC_WORDS}, tf AS (SELECT doc_id, token, count(*) AS n FROM doc_words GROUP BY doc_id, token), df AS (SELECT token, count(*) AS d FROM tf GROUP BY token), weighed AS (SELECT doc_id, token, round(n * ln((SELECT count(*) FROM documents)::DOUBLE / d), 9) AS weight FROM tf JOIN df USING (token)), ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, token) AS rank FROM weighed) SELECT doc_id, token, round(weight, 6) AS weight, rank::INTEGER AS rank FROM ranked WHERE rank <= 40",
        "extended_dictionary": f"WITH {_dictionary(LOWER, c.WORD)}, added AS (SELECT DISTINCT unnest({WORDS}) AS token FROM conversations) SELECT coalesce(a.token, d.token) AS token, CASE WHEN a.token IS NULL THEN {c.FREQ_BASE} ELSE {c.FREQ_ADDED} END::BIGINT AS freq FROM dictionary d FULL JOIN added a ON a.token = d.token",
        "embedding_rows": f"WITH {_vocab(WORDS)}, rows AS (SELECT idx, embedding AS v FROM vocab LEFT JOIN embeddings ON vec_id + 1 = idx UNION ALL SELECT 0, NULL) SELECT idx, {c.DIM} AS dim, round(coalesce(v[1], 0)::DOUBLE, 6) AS first, round(coalesce(v[{c.DIM}], 0)::DOUBLE, 6) AS last, round(coalesce(list_sum(list_transform(v, lambda x: x::DOUBLE)), 0), 6) AS total FROM rows",
        "mean_pool": _pooled("avg"),
        "max_pool": _pooled("max"),
        "attention_pool": f"WITH {SEQUENCES}, {ATTENTION} SELECT doc_id, dim, round(coalesce(value, 0.0), 6) AS value FROM grid LEFT JOIN attended USING (doc_id, dim)",
        "query_attention_pool": _query_attention(c.W_OUT),
        "query_attention_pool_joined": _query_attention(c.W_OUT_LARGE),
        "document_features": f"WITH {SEQUENCES}, {ATTENTION}, pooled AS (SELECT doc_id, dim, avg(x) AS m, max(x) AS x FROM cells GROUP BY doc_id, dim), parts AS (SELECT doc_id, dim, m AS value FROM pooled UNION ALL SELECT doc_id, dim + {c.DIM}, x FROM pooled UNION ALL SELECT doc_id, dim + {2 * c.DIM}, value FROM attended), wide AS (SELECT doc_id, unnest(range(0, {3 * c.DIM}))::INTEGER AS dim FROM documents) SELECT doc_id, dim, round(coalesce(value, 0.0), 6) AS value FROM wide LEFT JOIN parts USING (doc_id, dim)",
        "word2vec_train": f"WITH chars AS (SELECT unnest(string_split({LOWER}, '')) AS c, generate_subscripts(string_split({LOWER}, ''), 1) AS place FROM documents WHERE length(text) > 0) SELECT DISTINCT CASE WHEN place % 2 = 0 AND c = 'e' THEN upper(c) ELSE c END AS token, 100 AS dim, true AS finite, CASE WHEN place % 2 = 0 AND c = 'e' THEN c END AS nearest FROM chars",
        "csv_roundtrip": "SELECT doc_id, text, " + ", ".join(f"((doc_id * 7 + {i - 1}) % 4 - 2)::INTEGER AS {name}" for i, _, name in ASPECTS) + " FROM documents",
        "csv_append": "SELECT doc_id, text FROM documents",
        "stop_words_file": "SELECT DISTINCT regexp_replace(line, '^[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+|[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+$', '', 'g') AS token FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE token <> ''",
        "line_list_roundtrip": "SELECT translate(text, chr(13) || chr(10), '  ') AS line, count(*) AS n FROM conversations GROUP BY ALL",
        "vocabulary_roundtrip": f"WITH {_vocab(WORDS)} SELECT token, n, idx FROM vocab",
        "embedding_roundtrip": f"SELECT vec_id + 1 AS idx, unnest(range(0, {c.DIM}))::INTEGER AS dim, round(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings",
        "build_if_absent_twice": "SELECT source, count(*) AS n FROM documents GROUP BY source",
        "build_if_stale": f"SELECT doc_id, len(regexp_extract_all({LOWER}, {_q(c.WORD)}))::INTEGER AS n_tokens FROM documents",
        "vector_file_roundtrip": f"SELECT coalesce(([' ', chr(10), '', 'a b', chr(92), chr(92) || 'n', chr(9), '2 3'])[vec_id + 1], vec_id::VARCHAR) AS token, unnest(range(0, {c.DIM}))::INTEGER AS dim, round(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings",
        "aspect_scores": _aspect_scores(),
        "aspect_naive_bayes_joined": BAYES,
        "aspect_naive_bayes": BAYES,
    }


def oracle() -> dict[str, str]:
    sql = statements()
    for name in ("mean_pool", "max_pool", "attention_pool"):
        sql[f"{name}_joined"] = sql[name]
    sql["vocab_lookup_joined"] = sql["vocab_lookup_zero"]
    sql["segment_joined"] = sql["segment_large_dictionary"]
    sql["phrase_hits_joined"] = sql["phrase_hits_large"]
    return sql
