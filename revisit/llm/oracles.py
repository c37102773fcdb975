"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from revisit.llm import divergence, hard_negatives, line_index, mixing, phrases
from revisit.llm.common import CHARACTER_STEPS

ORACLES: dict[str, str] = {}
_LIMITS = divergence.Limits()


def _js(p: str, q: str) -> str:
    """Jensen-Shannon distance of two list columns of counts."""
    x, y = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
    part = lambda a: f"(CASE WHEN {a} > 0 THEN {a} * log2({a} / (({x} + {y}) / 2)) ELSE 0.0 END)"
    return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0.0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {part(x)} + {part(y)})) / 2)) END"


def _divergence() -> str:
    common = " ".join(f"WHEN '{k}' THEN {list(v)}" for k, v in _LIMITS.common_words.items())
    left, classes = "t", {}
    for name, pattern in CHARACTER_STEPS:
        rest = f"regexp_replace({left}, '{pattern}', '', 'g')"
        classes[name] = f"length({left}) - length({rest})"
        left = rest
    classes["other"] = f"length({left})"
    n_common = max(map(len, _LIMITS.common_words.values()))
    listed = ", ".join(f"({classes[c]})::DOUBLE" for c in divergence.CLASSES)
    places = ", ".join(f"len(list_filter(w, lambda x: coalesce(list_position(common, lower(x)), 0) = {k}))::DOUBLE" for k in range(n_common + 1))
    summed = lambda column, n: "[" + ", ".join(f"sum({column}[{i}])" for i in range(1, n + 1)) + "]"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         CASE WHEN lang IN ({", ".join(f"'{x}'" for x in _LIMITS.common_words)}) THEN lang ELSE '{divergence.REST}' END AS language,
         CASE lang {common} ELSE []::VARCHAR[] END AS common
  FROM documents),
windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
repeated AS (
  SELECT k, count(DISTINCT j) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY k),
lines AS (SELECT k, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM texts),
counted AS (
  SELECT k, doc_id, language, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         ({classes["symbol"]})::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, [{listed}] AS classes, [{places}] AS common
  FROM texts JOIN lines USING (k) LEFT JOIN repeated USING (k)),
refs AS (SELECT language, {summed("classes", len(divergence.CLASSES))} AS ref_classes, {summed("common", n_common + 1)} AS ref_common FROM counted GROUP BY language),
judged AS (
  SELECT *, n_words < {_LIMITS.min_words} OR 100 * n_repeat_words > {_LIMITS.max_repeat_percent} * n_words AS base_failed,
         CASE WHEN word_chars >= {_LIMITS.min_class_chars} THEN {_js("classes", "ref_classes")} END AS class_distance,
         CASE WHEN n_words >= {_LIMITS.min_histogram_words} AND language <> '{divergence.REST}' THEN {_js("common", "ref_common")} END AS word_distance
  FROM counted JOIN refs USING (language))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR coalesce(class_distance, 0) > {_LIMITS.max_class_distance} OR coalesce(word_distance, 0) > {_LIMITS.max_word_distance}) AS kept
FROM judged"""


ORACLES["op8_distribution_divergence"] = _divergence()


def _mix(mix: mixing.Mix) -> str:
    return f"""
WITH sizes AS (
  SELECT row_number() OVER () AS row, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM sizes GROUP BY source),
weighed AS (
  SELECT *, {list(mix.weights)}[k % {len(mix.weights)} + 1] AS weight, source_size * {mix.max_repeats} AS most, sum(source_size) OVER () * {mix.share}::DOUBLE AS total FROM ranked),
filling AS (
  SELECT *, total - coalesce(sum(most) OVER earlier, 0) AS remaining, sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS remaining_weight
  FROM weighed WINDOW earlier AS (ORDER BY most / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, most * remaining_weight <= weight * remaining AS is_full FROM filling),
goals AS (
  SELECT *, CASE WHEN is_full THEN most::DOUBLE ELSE weight * (total - coalesce(sum(most) FILTER (is_full) OVER (), 0)) / coalesce(sum(weight) FILTER (NOT is_full) OVER (), 0) END AS target FROM filled),
entries AS (
  SELECT row, size, goals.source_size, target, floor(target + 0.5)::BIGINT AS goal, k, repeat, md5(doc_id::VARCHAR || ':' || repeat::VARCHAR) AS key
  FROM sizes JOIN goals ON sizes.source IS NOT DISTINCT FROM goals.source CROSS JOIN range({mix.max_repeats}) AS r(repeat)),
placed AS (
  SELECT row, size, goal, coalesce(sum(size) OVER (PARTITION BY k ORDER BY repeat, key, row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM entries),
taken AS (SELECT row, sum(greatest(0, least(size, goal - place)))::BIGINT AS taken FROM placed GROUP BY row)
SELECT doc_id, size, source_size, target::DOUBLE AS target, taken
FROM sizes JOIN taken USING (row) JOIN goals ON sizes.source IS NOT DISTINCT FROM goals.source"""


ORACLES["op9_low_discrepancy_mix"] = _mix(mixing.Mix())


ORACLES["op4_reply_trees"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 14 + length(replace(replace(replace(replace(role, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>'), ':', '\\:'))
            + length(replace(replace(replace(text, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""


def _collocations(m: phrases.Mining) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) + 2 - {k})) AS i FROM pieces)" for k in range(1, m.longest + 1)
    )
    return f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS (
  {grams}),
counted AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k > 1 AND f >= {m.least}),
maxima AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, array_to_string(string_split(phrase, ' ')[i:j], ' ') AS phrase, f
    FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM candidates), range(1, {m.longest + 1}) AS r(j) WHERE j > i AND j <= k AND j - i + 1 < k)
  GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN maxima USING (lang, phrase) WHERE most IS NULL OR 100 * most < {m.subsumed} * f),
cuts AS (
  SELECT lang, phrase, f, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS a1, array_to_string(string_split(phrase, ' ')[cut + 1:k], ' ') AS a2
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, ({m.scale} * c.f) // (x.f + y.f) AS score, cut
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = a1 JOIN counted y ON y.lang = c.lang AND y.phrase = a2),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest JOIN sizes USING (lang))
WHERE rank <= {m.top}"""


ORACLES["op11_stripe_collocations"] = _collocations(phrases.Mining())


def _hard_negatives(m: hard_negatives.Mining) -> str:
    return f"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({m.scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.row <> b.row),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= {m.positives}),
found AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND {m.low} * p.score <= 100 * n.score AND 100 * n.score <= {m.high} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= {m.negatives}"""


ORACLES["op12_segment_hard_negatives"] = _hard_negatives(hard_negatives.Mining())


def _lines(r: line_index.Rules) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT row, doc_id, i, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{upper}', '{upper.lower()}') AS key
  FROM (SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM texts)),
repeated AS (
  SELECT key, max(doc_id) AS largest FROM lines WHERE length(key) >= {r.least} GROUP BY key HAVING count(DISTINCT row) >= {r.documents}),
judged AS (
  SELECT row, lines.doc_id, i, line, repeated.key IS NOT NULL AND lines.doc_id IS DISTINCT FROM largest AS dropped FROM lines LEFT JOIN repeated USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY row"""


ORACLES["op13_cuckoo_line_dedup"] = _lines(line_index.Rules())
