"""SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from plumelake.llm import hard_negatives as hn, quality_rules as qr, repeated_windows, substrings, topk, vectors

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def quality_rules() -> str:
    path = qr.path_of(qr.CUTOFFS)
    steps = ", ".join(f"({j}, '{r}', {c})" for j, (r, c) in enumerate(path, 1))
    risk = qr.RISK
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, lang, t,
    list_filter(regexp_split_to_array(t, '{SPACE}+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) AS l
  FROM d
), win AS (
  SELECT r, i, array_to_string(w[i:i + {qr.WINDOW - 1}], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {qr.WINDOW - 2})) AS i FROM w)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT r, sum(least({qr.WINDOW}, coalesce(nx - i, {qr.WINDOW}))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM rep) GROUP BY r
), m AS (
  SELECT w.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{SPACE}+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS BIGINT) AS capitals,
    CAST(len(l) AS BIGINT) AS lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.r = cov.r
), b AS (
  SELECT *, n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEATED} * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbol_rate,
    CASE WHEN word_chars > 0 THEN 1000 * capitals // word_chars ELSE 0 END AS capital_rate,
    CASE WHEN lines > 0 THEN 1000 * n_dup_lines // lines ELSE 0 END AS dup_line_rate,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_rate
  FROM m
), rates AS (
  UNPIVOT (SELECT r, symbol_rate, capital_rate, dup_line_rate, repeat_rate FROM b)
  ON symbol_rate, capital_rate, dup_line_rate, repeat_rate INTO NAME rule VALUE rate
), known AS (
  SELECT doc_id, min(quality) AS quality FROM labels
  WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id
), holdout AS (
  SELECT b.r, b.lang, quality FROM b JOIN known USING (doc_id) WHERE NOT base_failed
), strata AS (
  SELECT lang, sum(quality) AS n FROM holdout GROUP BY lang
), steps AS (SELECT * FROM (VALUES {steps}) AS t(step, rule, cutoff)
), hit AS (
  SELECT h.r, h.lang, h.quality, min(step) AS since
  FROM holdout h JOIN rates USING (r) JOIN steps ON steps.rule = rates.rule AND rate > cutoff GROUP BY 1, 2, 3
), tests AS (
  SELECT s.lang, step, s.n, count(*) FILTER (since <= step AND quality = 1) AS lost,
    count(*) FILTER (since <= step AND quality = 0) AS gain
  FROM strata s CROSS JOIN steps LEFT JOIN hit ON hit.lang IS NOT DISTINCT FROM s.lang GROUP BY 1, 2, 3
), tailed AS (
  SELECT lang, step, lost, gain,
    CASE WHEN lost < n * {risk!r} THEN list_sum(list_transform(range(CAST(lost AS BIGINT) + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk!r}) + (n - i) * ln(1 - {risk!r}))))
      ELSE 1 END AS tail
  FROM tests
), ends AS (
  SELECT lang, coalesce(min(step) FILTER (tail > {qr.DELTA!r} / (SELECT count(*) FROM strata)), {len(path) + 1}) AS failed
  FROM tailed GROUP BY lang
), taken AS (
  SELECT t.lang, arg_max(step, (gain - lost) * 10000 - step) AS last
  FROM tailed t JOIN ends e ON t.lang IS NOT DISTINCT FROM e.lang WHERE step < failed AND gain > lost GROUP BY t.lang
), chosen AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM taken JOIN steps ON step <= last GROUP BY lang, rule
), broken AS (
  SELECT DISTINCT b.r FROM b JOIN rates USING (r)
  JOIN chosen c ON c.rule = rates.rule AND c.lang IS NOT DISTINCT FROM b.lang WHERE rate > c.cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND b.r NOT IN (SELECT r FROM broken) AS kept
FROM b"""


def repeated_substrings() -> str:
    n = substrings.LENGTH
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
    hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT r, o, i, substr(h, 2 * i + 1, {2 * n}) AS s
  FROM (SELECT r, o, h, unnest(range(0, length(h) // 2 - {n - 1})) AS i FROM d)
), gone AS (
  SELECT r, i FROM (SELECT r, o, i, min(o) OVER (PARTITION BY s) AS low FROM s) WHERE low < o
), steps AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {n} THEN 0 ELSE 1 END AS new FROM gone
), numbered AS (
  SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM steps
), runs AS (
  SELECT r, min(i) AS a, max(i) + {n} AS b FROM numbered GROUP BY r, run
), per AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS stops
  FROM runs GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, n_spans + 1), lambda k:
    substr(h, 2 * (CASE WHEN k = 0 THEN 0 ELSE stops[k] END) + 1,
      2 * ((CASE WHEN k = n_spans THEN length(h) // 2 ELSE starts[k + 1] END)
        - (CASE WHEN k = 0 THEN 0 ELSE stops[k] END)))), '') END)) AS kept_sha256
FROM d LEFT JOIN per USING (r)"""


def top_k(k: int = 5, every: int = 50) -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.r <> v.r AND len(q.e) = len(v.e) WHERE q.vec_id % {every} = 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM n WHERE rank <= {k}"""


def repeated_word_windows() -> str:
    n = repeated_windows.LENGTH
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT r, o, i, array_to_string(w[i:i + {n - 1}], ' ') AS g
  FROM (SELECT r, o, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d)
), gone AS (
  SELECT r, i FROM (
    SELECT r, o, i, min(o) OVER (PARTITION BY g) AS low, min(i) OVER (PARTITION BY g, r) AS first FROM win)
  WHERE low < o OR first < i
), under AS (
  SELECT DISTINCT r, unnest(range(i, i + {n})) AS k FROM gone
), left_over AS (
  SELECT r, string_agg(x, ' ' ORDER BY k) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d) ANTI JOIN under USING (r, k) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (r)"""


def hard_negatives(every: int = 100) -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({vectors.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * v.e[i])) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.r <> v.r AND len(a.e) = len(v.e) WHERE a.vec_id % {every} = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s WHERE same)
  WHERE n <= {hn.POSITIVES}
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score, row_number() OVER (PARTITION BY p.r, p.n ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND {hn.LOWEST} * p.score <= 100 * s.score
    AND 100 * s.score <= {hn.HIGHEST} * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {hn.NEGATIVES}"""


def statements() -> dict[str, str]:
    return {"op11_remove_repeated_windows": repeated_word_windows(), "op13_hard_negatives": hard_negatives(),
            "op1_quality_rules": quality_rules(), "op3_remove_repeated_substrings": repeated_substrings(),
            "op9_top_k": top_k()}
