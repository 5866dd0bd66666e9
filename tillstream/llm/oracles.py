"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The same characters as words.SPACES.
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def kept_lines(documents: str) -> str:
    """Common table expressions up to shortened(doc_id, n_lines, n_dropped, kept)."""
    return f"""
    lines AS (
        SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM {documents})
    ),
    keyed AS (SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS k FROM lines),
    shared AS (
        SELECT k, min(doc_id) AS holder FROM keyed WHERE length(k) >= 10
        GROUP BY k HAVING count(DISTINCT doc_id) >= 2
    ),
    marked AS (
        SELECT doc_id, i, line, holder IS NOT NULL AND holder <> doc_id AS gone
        FROM keyed LEFT JOIN shared USING (k)
    ),
    shortened AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
        FROM marked GROUP BY doc_id
    )"""


def quality_verdicts(documents: str) -> str:
    """Common table expressions up to verdicts(doc_id, the counts, base_failed, kept)."""
    # What each rule allows above the group's own 90 per cent quantile, at least.
    rules = {"symbol_rate": 50, "line_rate": 300, "repeat_rate": 100, "letter_rate": 0}
    space = "[ \\t\\n\\x0B\\f\\r]"
    fences = []
    for name, keys in {"s": "l, s, ", "l": "l, ", "a": ""}.items():
        by = keys + "rule"
        width = "(1 << greatest(length(bin(high)) - 5, 0))"
        picks = ", ".join(
            f"max(CASE WHEN rule = '{r}' THEN high + greatest(16 * {width}, {more}) END) AS {r}"
            for r, more in rules.items()
        )
        group = f"GROUP BY {keys[:-2]}" if keys else ""
        fences.append(f"""
    cut_{name} AS (
        SELECT {by}, bucket, sum(sum(n)) OVER (PARTITION BY {by}) AS docs,
               sum(sum(n)) OVER (PARTITION BY {by} ORDER BY bucket) AS upto
        FROM sketch GROUP BY {by}, bucket
    ),
    limit_{name} AS (
        SELECT {by}, max(docs) AS docs, min(bucket) FILTER (100 * upto >= 90 * docs) AS high
        FROM cut_{name} GROUP BY {by}
    ),
    fence_{name} AS (SELECT {keys}max(docs) AS docs, {picks} FROM limit_{name} {group})""")
    fine = " AND ".join(
        f"r.{r} <= CASE WHEN fs.docs >= 100 THEN fs.{r} WHEN fl.docs >= 100 THEN greatest(fs.{r}, fl.{r}) "
        f"ELSE greatest(fs.{r}, fl.{r}, fa.{r}) END"
        for r in rules
    )
    long = " UNION ALL ".join(f"SELECT l, s, '{r}' AS rule, {r} AS v FROM rated WHERE NOT base_failed" for r in rules)
    return f"""
    numbered AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS l,
               coalesce(source, '') AS s
        FROM {documents}
    ),
    split AS (
        SELECT *, list_filter(regexp_split_to_array(text, '{space}+'), lambda w: w <> '') AS words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
        FROM numbered
    ),
    starts AS (
        SELECT row, p, array_to_string(words[p:p + 4], ' ') AS w
        FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS p FROM split)
    ),
    again AS (SELECT row, w FROM starts GROUP BY row, w HAVING count(*) > 1),
    covered AS (
        SELECT row, count(DISTINCT p + k) AS n
        FROM starts JOIN again USING (row, w), (SELECT unnest(range(5)) AS k) GROUP BY row
    ),
    counted AS (
        SELECT row, doc_id, l, s, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(covered.n, 0) AS n_repeat_words
        FROM split LEFT JOIN covered USING (row)
    ),
    rated AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               1000 * n_symbols // greatest(word_chars, 1) AS symbol_rate,
               1000 * n_dup_lines // greatest(n_lines, 1) AS line_rate,
               1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate,
               10 * word_chars // greatest(n_words, 1) AS letter_rate
        FROM counted
    ),
    long AS ({long}),
    sketch AS (
        SELECT l, s, rule, (((v >> greatest(length(bin(v)) - 5, 0)) + 1) << greatest(length(bin(v)) - 5, 0)) - 1 AS bucket,
               count(*) AS n
        FROM long GROUP BY ALL
    ),{",".join(fences)},
    verdicts AS (
        SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND {fine} AS kept
        FROM rated r LEFT JOIN fence_s fs USING (l, s) LEFT JOIN fence_l fl ON r.l = fl.l, fence_a fa
    )"""


HARD_NEGATIVES = """
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
               CAST(list_dot_product(a.parts, b.parts) AS BIGINT) AS score
        FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (
               PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5"""


def registry() -> dict[str, str]:
    return {
        "op2_quality_rules": f"WITH {quality_verdicts('documents')} SELECT * FROM verdicts",
        "op9_line_dedup": f"""
            WITH {kept_lines("documents")}
            SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM shortened""",
        "op11_hard_negatives": HARD_NEGATIVES,
    }
