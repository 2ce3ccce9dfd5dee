"""The queries of this package as DuckDB SQL, where SQL can express them."""

from tidemark.llm import collocations as phrases
from tidemark.llm import quality_rules as rules
from tidemark.llm.embedding_graph import LEAST
from tidemark.llm.mixing import MOST, WEIGHTS
from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import DEFAULT, MIN_CONFIDENCE, MIN_SUPPORT

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_FITS = [
    (
        r.verdict, r.host + r.path,
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')",
    )
    for r in sorted(URL_RULES, key=lambda r: -len(r.host + r.path))
]


def _listed(of: int) -> str:
    return "CASE " + " ".join(f"WHEN {fit[2]} THEN '{fit[of]}'" for fit in _FITS) + " END"


URL_FILTER = rf"""
WITH parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
listed AS (
  SELECT *, {_listed(1)} AS rule, {_listed(0)} AS listed, list_sort(list_distinct(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host:' || x) ||
    list_transform(list_filter(regexp_split_to_array(path, '[/._\-]'), lambda x: x <> ''), lambda x: 'path:' || x)
  )) AS tokens
  FROM parts),
labelled AS (SELECT tokens, listed FROM listed WHERE listed IS NOT NULL),
often AS (
  SELECT token FROM (SELECT unnest(tokens) AS token FROM labelled) GROUP BY token
  HAVING count(*) >= ceil(CAST({MIN_SUPPORT} AS DOUBLE) * (SELECT count(*) FROM labelled))),
frequent AS (SELECT coalesce(list(token), []) AS all_tokens FROM often),
kept AS (
  SELECT list_filter(tokens, lambda x: list_contains(all_tokens, x)) AS tokens, listed
  FROM labelled, frequent),
masks AS (
  SELECT tokens, listed, unnest(generate_series(1, (1 << len(tokens)) - 1)) AS mask
  FROM kept WHERE len(tokens) > 0),
sets AS (
  SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS need, listed FROM masks),
counts AS (
  SELECT need, count(*) AS freq, count(*) FILTER (listed = 'allow') AS allow,
    count(*) FILTER (listed = 'block') AS block
  FROM sets GROUP BY need),
rules AS (
  SELECT need, verdict, support, support / freq AS confidence
  FROM (SELECT need, freq, 'allow' AS verdict, allow AS support FROM counts
        UNION ALL SELECT need, freq, 'block', block FROM counts)
  WHERE support >= greatest(1, ceil(CAST({MIN_SUPPORT} AS DOUBLE) * (SELECT count(*) FROM labelled)))
    AND support / freq >= CAST({MIN_CONFIDENCE} AS DOUBLE)),
found AS (
  SELECT n, arg_max(verdict, (confidence, support, -len(need), verdict)) AS mined
  FROM listed JOIN rules ON list_has_all(tokens, need)
  WHERE listed IS NULL GROUP BY n)
SELECT page_id, host, path, rule, coalesce(listed, mined, '{DEFAULT}') AS verdict
FROM listed LEFT JOIN found USING (n)
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""

LINE_DEDUP = rf"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents),
lines AS (
  SELECT n, unnest(string_split(body, chr(10))) AS line,
    unnest(range(len(string_split(body, chr(10))))) AS place
  FROM docs),
keyed AS (
  SELECT n, place, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_LOWER}) AS key
  FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT n) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked JOIN docs USING (n) GROUP BY n, doc_id
"""

_GROUP = ", ".join(f"g_{name}" for name in rules.GROUP)
_SAME = " AND ".join(f"a.g_{name} IS NOT DISTINCT FROM b.g_{name}" for name in rules.GROUP)
_AXES = range(len(rules.AXES))
_PAIRS = [(i, j) for i in _AXES for j in range(i + 1)]


def _factor(scatter: dict[tuple[int, int], str], source: str, name: str) -> str:
    """Cholesky factor, one row of it after the other."""
    ctes, at = [], source
    for n, (i, j) in enumerate(_PAIRS):
        rest = scatter[i, j] + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        value = f"sqrt({rest})" if i == j else f"({rest}) / l{j}{j}"
        then = name if n == len(_PAIRS) - 1 else f"{name}_{n}"
        ctes.append(f"{then} AS (SELECT *, {value} AS l{i}{j} FROM {at})")
        at = then
    return ",\n".join(ctes)


def _distance(rows: str, fit: str, name: str, how: str = "") -> str:
    ctes = [f"{name}_0 AS (SELECT a.*, b.* EXCLUDE ({_GROUP}) FROM {rows} a {how} JOIN {fit} b ON {_SAME})"]
    for i in _AXES:
        rest = f"{rules.AXES[i]} / {rules.GRID}.0::DOUBLE - m{i}" + "".join(
            f" - l{i}{k} * z{k}" for k in range(i))
        ctes.append(f"{name}_{i + 1} AS (SELECT *, ({rest}) / l{i}{i} AS z{i} FROM {name}_{i})")
    total = " + ".join(f"z{i} * z{i}" for i in _AXES)
    return ",\n".join([*ctes, f"{name} AS (SELECT *, {total} AS distance FROM {name}_{len(_AXES)})"])


def _step(n: int) -> str:
    factor = rules.consistency(rules.SHARE)
    scatter = {
        (i, j): f"((s{i}{j}::DOUBLE / n / {rules.GRID**2}.0::DOUBLE - m{i} * m{j}) * {factor!r}::DOUBLE"
        + (f" + {rules.FLOOR[i] ** 2!r}::DOUBLE)" if i == j else " + 0.0::DOUBLE)")
        for i, j in _PAIRS
    }
    sums = ", ".join([f"sum({axis})::BIGINT AS s{i}" for i, axis in enumerate(rules.AXES)] + [
        f"sum({rules.AXES[i]} * {rules.AXES[j]})::BIGINT AS s{i}{j}" for i, j in _PAIRS])
    means = ", ".join(f"s{i}::DOUBLE / n / {rules.GRID}.0::DOUBLE AS m{i}" for i in _AXES)
    return f"""
{_distance("passing", f"fit{n}", f"far{n}")},
bins{n} AS (SELECT {_GROUP}, floor(ln(1 + distance) * {rules.BIN ** 2}) AS bin, count(*) AS n
  FROM far{n} GROUP BY ALL),
edge{n} AS (SELECT {_GROUP}, min(bin) AS edge FROM (
    SELECT *, sum(n) OVER (PARTITION BY {_GROUP} ORDER BY bin) AS upto,
      sum(n) OVER (PARTITION BY {_GROUP}) AS total FROM bins{n})
  WHERE upto >= ceil({rules.SHARE}::DOUBLE * total) GROUP BY {_GROUP}),
near{n} AS (SELECT a.* FROM far{n} a JOIN edge{n} b ON {_SAME}
  WHERE floor(ln(1 + distance) * {rules.BIN ** 2}) <= edge),
sums{n} AS (SELECT {_GROUP}, count(*)::DOUBLE AS n, {sums} FROM near{n} GROUP BY {_GROUP}),
means{n} AS (SELECT *, {means} FROM sums{n}),
{_factor(scatter, f"means{n}", f"full{n}")},
fit{n + 1} AS (SELECT {_GROUP}, {", ".join(f"m{i}" for i in _AXES)},
  {", ".join(f"l{i}{j}" for i, j in _PAIRS)} FROM full{n})"""


_SHARES = "".join(
    f", round(ln(1 + 100 * {name} / greatest(n_words, 1)::DOUBLE) * {rules.GRID})::BIGINT AS {axis}"
    for name, axis in zip(rules.STATS[2:], rules.AXES[1:])
)
QUALITY_RULES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS body, lang, source, {_WORDS} AS words
  FROM documents),
windows AS (
  SELECT id, unnest(range(1, len(words) - 1)) AS place, unnest(list_transform(
    range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS gram
  FROM docs WHERE len(words) >= 3),
repeated AS (
  SELECT id, place FROM (SELECT *, count(*) OVER (PARTITION BY id, gram) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT id, count(DISTINCT place + d) AS n_repeat_words
  FROM repeated, (SELECT unnest([0, 1, 2]) AS d) GROUP BY id),
stats AS (
  SELECT id, doc_id, lang AS g_lang, source AS g_source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(body, chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs) LEFT JOIN covered USING (id)),
rows_ AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed,
    round(ln(greatest(word_chars, 1) / greatest(n_words, 1)::DOUBLE) * {rules.GRID})::BIGINT AS {rules.AXES[0]}
    {_SHARES}
  FROM stats),
passing AS (SELECT {_GROUP}, {", ".join(rules.AXES)} FROM rows_ WHERE NOT base_failed),
medians AS (SELECT {_GROUP}, {", ".join(
    f"quantile_disc({axis}, 0.5) / {rules.GRID}.0::DOUBLE AS m{i}" for i, axis in enumerate(rules.AXES))}
  FROM passing GROUP BY {_GROUP}),
{_factor({(i, j): f"{(rules.FLOOR[i] ** 2 if i == j else 0.0)!r}::DOUBLE" for i, j in _PAIRS}, "medians", "fit0")},
{",".join(_step(n) for n in range(rules.STEPS))},
{_distance("rows_", f"fit{rules.STEPS}", "judged", "LEFT")}
SELECT doc_id, {", ".join(rules.STATS)}, base_failed,
  NOT base_failed AND coalesce(distance <= {rules.chi_square_quantile(1 - rules.TAIL)!r}::DOUBLE, false) AS kept
FROM judged
"""

MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, coalesce(text, '') AS body,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS digest
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
    -ln((CAST('0x' || substr(digest, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
    / CASE WHEN size > 0 THEN size / (size + length(body)
        - length(regexp_replace(body, '[#*$%&|<>!]+', '', 'g')))::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, {MOST} * sum(size)::BIGINT AS lim,
    ({list(map(float, WEIGHTS))}::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1)
      % {len(WEIGHTS)} + 1] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(lim) OVER (ORDER BY lim / weight, rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
    sum(weight) OVER (ORDER BY lim / weight, rank
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM sources),
level AS (
  SELECT arg_min((total - gone)::DOUBLE / open, gone) AS level FROM levels
  WHERE (total - gone)::DOUBLE / open * weight <= lim),
targets AS (
  SELECT source, source_size, least(lim::DOUBLE, level * weight) AS target FROM levels, level),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END AS epochs,
    target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END * source_size AS budget
  FROM targets),
prefixed AS (
  SELECT k.*, source_size, target, epochs, budget, coalesce(sum(size) OVER (
    PARTITION BY k.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (epochs + CASE WHEN budget > 0 AND before + size / 2 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM prefixed
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown AS (
  SELECT *, length(replace(replace(replace(body, '\', '\b'), '</turn>', '\l/turn>'), '', '')) AS part,
    length(replace(replace(role, '\', '\b'), ':', '\c')) AS head,
    -- every # before two more becomes two characters
    len(list_filter(range(1, length(body) + 1), lambda i: substr(body, i, 3) = '###')) AS marks,
    len(list_filter(range(1, length(role) + 1), lambda i: substr(role, i, 3) = '###')) AS role_marks
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  coalesce(sum(length(body)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(body, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + head + role_marks + 2 + part + marks + 9)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
totals AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS k) WHERE len(words) >= k),
counts AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
candidates AS (SELECT *, string_split(phrase, ' ') AS parts FROM counts WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, cut, (1000::HUGEINT * c.a * n) // (x.a * y.a) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(parts[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(parts[cut + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, a, array_to_string(parts[start:start + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS start FROM (
    SELECT *, unnest(range(2, k)) AS size FROM candidates WHERE k > 2))),
longer AS (SELECT lang, phrase, max(a) AS longest FROM inner_ GROUP BY ALL)
SELECT lang, row_number() OVER best_first AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  n::BIGINT AS n, score::BIGINT AS score
FROM best LEFT JOIN longer USING (lang, phrase)
WHERE longest IS NULL OR 100 * longest < {phrases.SHARE} * a
WINDOW best_first AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= {phrases.TOP}
"""

# Spark's crc32 of a short ASCII string, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(
    string_split(conv || ':' || number, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  ), 4294967295)"""


def _option(letter: str, cost: str, after: str, role: str | None, text: str) -> str:
    """A way from a turn to the end: cost, audit and repaired text."""
    said = f"{role} || ':' || {text} || CASE WHEN {after}.said IS NULL THEN '' ELSE chr(10) || {after}.said END"
    return (f"{{'cost': {after}.cost + {cost}, 'audit': '{letter}' || {after}.audit, "
            f"'said': {f'{after}.said' if role is None else said}}}")


def _least(options: list[str]) -> str:
    return f"list_min([{', '.join(options)}])"


def _edits(follow: str, keep: str) -> str:
    """The best of Delete, Keep (where the condition holds) and Rerole, for one state."""
    role, state = ("'user'", "u") if follow == "u" else ("'assistant'", "a")
    own = {"u": [("u", "f.after.u")], "a": [("a", "f.after.a")], "0": [("s", "f.after.s"), ("u", "f.after.u")]}[keep]
    kept = [f"CASE WHEN NOT gone AND initial = '{c}' THEN {_option('K', 'extra', then, 'role', 'body')} END"
            for c, then in own]
    return _least([*kept, f"CASE WHEN NOT gone THEN {_option('R', '3 + extra', f'f.after.{state}', role, 'body')} END"])


_END = "{'cost': %d, 'audit': '%s', 'said': %s}"
_STATES = ("n", "s", "u", "a")
_FINISH = ", ".join(f"'{q}': " + _END % x for q, x in zip(_STATES, (
    (0, "", "NULL::VARCHAR"), (6, "II", "'user:' || chr(10) || 'assistant:'"), (3, "I", "'assistant:'"), (0, "", "NULL::VARCHAR"))))
_DELETED = {q: _option("D", "4", f"f.after.{q}", None, "") for q in _STATES}
TURN_REPAIR = rf"""
WITH RECURSIVE shown AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, coalesce(CAST(turn AS VARCHAR), ' ') AS number,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS body
  FROM conversations),
faulty AS (SELECT *, {_CRC} % 20 AS fault FROM shown),
damaged AS (
  SELECT conv_id, conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM faulty WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, body) AS i FROM damaged),
marked AS (
  SELECT *, substr(role, 1, 1) AS initial, NOT regexp_matches(body, '[^ 	-
]') AS blank,
    row_number() OVER (PARTITION BY conv, role, body ORDER BY i) > 1 AS again,
    NOT regexp_matches(body, '[.!?][ 	-
]*\z') AS open_end,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY i) AS before
  FROM placed),
turns AS (
  SELECT *, blank OR again AS gone, CASE WHEN open_end THEN 3 ELSE 0 END AS extra FROM marked),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open_end AND NOT gone) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS last
  FROM turns GROUP BY conv),
best AS (
  SELECT conv, last + 1 AS i, {{{_FINISH}}} AS after FROM counts
  UNION ALL
  SELECT conv, i, {{'n': least(n, {_option("I", "3", "u", "'user'", "''")}), 's': least(s, {_option("I", "3", "u", "'user'", "''")}), 'u': u, 'a': a}}
  FROM (
    SELECT conv, i, n, s, {_least(["u", _option("I", "3", "a", "'assistant'", "''")])} AS u,
      {_least(["a", _option("I", "3", "u", "'user'", "''")])} AS a
    FROM (
      SELECT f.conv, t.i,
        {_least([_DELETED["n"], _edits("u", "0")])} AS n, {_least([_DELETED["s"], _edits("u", "u")])} AS s,
        {_least([_DELETED["u"], _edits("a", "a")])} AS u, {_least([_DELETED["a"], _edits("u", "u")])} AS a
      FROM best f JOIN turns t ON t.conv = f.conv AND t.i = f.i - 1))),
done AS (SELECT conv, after.n AS x FROM best WHERE i = 1)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(x.cost, 0)::BIGINT AS cost,
  coalesce(x.audit, '') AS audit, sha256(coalesce(x.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM shown) LEFT JOIN counts USING (conv) LEFT JOIN done USING (conv)
"""

EMBEDDING_GRAPH = rf"""
WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS n, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT *, list_transform(v, lambda x: x / list_max(list_transform(v, lambda y: abs(y)))) AS w FROM rows_
  WHERE label IS NOT NULL AND list_count(v) = len(v)
    AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.n, b.n AS m FROM usable a JOIN usable b ON a.label = b.label AND a.n <> b.n AND len(a.w) = len(b.w)
  WHERE list_dot_product(a.w, b.w) / sqrt(list_dot_product(a.w, a.w)) / sqrt(list_dot_product(b.w, b.w)) >= {LEAST}::DOUBLE),
reach AS (SELECT n, n AS m FROM rows_ UNION SELECT r.n, l.m FROM reach r JOIN links l ON l.n = r.m),
least_ AS (SELECT r.n, min(vec_id) AS component_id FROM reach r JOIN rows_ o ON o.n = r.m GROUP BY r.n)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.n = rows_.n) AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows_ JOIN least_ USING (n)
"""

ORACLE = {
    "op1_url_filter": URL_FILTER,
    "op4_exact_dedup": EXACT_DEDUP,
    "op5_line_dedup": LINE_DEDUP,
    "op7_chat": CHAT,
    "op8_quality_rules": QUALITY_RULES,
    "op9_mixing": MIXING,
    "op11_collocations": COLLOCATIONS,
    "op12_turn_repair": TURN_REPAIR,
    "op13_embedding_graph": EMBEDDING_GRAPH,
}
