"""SQL for the operators that SQL can express on whole tables, for DuckDB over the given tables."""

from __future__ import annotations

from duewatch.llm.resampling import BUCKETS, LEAST_WORDS, PERCENT, SEED
from duewatch.llm.secret_scan import ALLOWED, CLASSES, CharacterClass, most_repetition, scaled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def resampling_sql() -> str:
    """crc32 is computed from its polynomial, once for each distinct run of words."""
    runs = " UNION ALL ".join(
        f"SELECT place, unnest(list_transform(range(1, len(words) - {n - 2}), lambda i: array_to_string(words[i : i + {n - 1}], ' ')))"
        " AS run, kind FROM split" for n in (1, 2, 3)
    )
    # DuckDB's range() of a negative length is empty, so short texts have no longer runs.
    return f"""
WITH texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS place, doc_id, text FROM documents
    UNION ALL SELECT 't', 0, NULL, text FROM benchmark
), split AS (
    SELECT kind, place, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts
), runs AS (
    SELECT kind, place, run, count(*) AS n FROM ({runs}) GROUP BY ALL
), tables AS (
    SELECT list_transform(range(256), lambda v: list_reduce(list_concat([v], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), hashed AS (
    SELECT run, xor(list_reduce(list_concat([4294967295], list_transform(range(len(h) // 2), lambda i:
        16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
    FROM (SELECT DISTINCT run, hex(encode(run)) AS h FROM runs), tables
), features AS (
    SELECT kind, place, bucket, sum(n)::BIGINT AS n FROM runs JOIN hashed USING (run) GROUP BY ALL
), counts AS (
    SELECT b.bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 't'), 0)::DOUBLE AS t
    FROM range({BUCKETS}) b(bucket) LEFT JOIN features USING (bucket) GROUP BY ALL
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + {BUCKETS}) / ((s + 1) * (sum(t) OVER () + {BUCKETS}))))::BIGINT
        AS gain FROM counts
), weights AS (
    SELECT place, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM features JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY ALL
), scored AS (
    SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT
            + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM split LEFT JOIN weights USING (place) WHERE kind = 'd'
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
        {PERCENT} * count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () // 100 AS wanted FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {LEAST_WORDS} AND place <= wanted THEN place END AS rank
FROM ordered"""


def _runs_sql(kind: int, pattern: str, value: str = "run") -> str:
    return f"""
    SELECT place, {kind} AS kind, nth, run, {value} AS value,
        sum(gap + len(run)) OVER (PARTITION BY place ORDER BY nth) - len(run) AS first
    FROM (SELECT place, unnest(range(1, len(runs) + 1)) AS nth, unnest(runs) AS run, unnest(values) AS value,
        unnest(list_transform(gaps[: len(runs)], lambda g: len(g))) AS gap
      FROM (SELECT place, regexp_extract_all(text, $q${pattern}$q$) AS runs,
          regexp_extract_all(text, $q${pattern}$q$, {2 if value == 'value' else 0}) AS values,
          regexp_split_to_array(text, $q${pattern}$q$) AS gaps FROM texts))"""


def _windows_sql(number: int, kind: CharacterClass) -> str:
    """Windows of a class one by one, merged where they overlap or touch."""
    table = ", ".join(str(scaled(n)) for n in range(kind.width + 1))
    allowed = " AND ".join(f"NOT regexp_matches(run, $q${pattern}$q$)" for pattern in ALLOWED)
    return f"""
    SELECT place, {number} AS kind, first + low AS start, first + high AS "end" FROM (
        SELECT place, nth, run, first, min(low) AS low, max(low) + {kind.width} AS high FROM (
            SELECT *, count(*) FILTER (new) OVER (PARTITION BY place, nth ORDER BY low) AS island FROM (
                SELECT *, low > coalesce(lag(low) OVER (PARTITION BY place, nth ORDER BY low), -1000000) + {kind.width} AS new FROM (
                    SELECT place, nth, run, first, low FROM (
                        SELECT place, nth, run, first, low, c, count(*) AS n FROM (
                            SELECT place, nth, run, first, low,
                                unnest(string_split(substr(run, low + 1, {kind.width}), '')) AS c
                            FROM (SELECT *, unnest(range(len(run) - {kind.width - 1})) AS low FROM runs
                                WHERE kind = {number} AND regexp_matches(run, '[0-9]') AND regexp_matches(run, '[A-Za-z]')
                                AND {allowed}))
                        GROUP BY ALL)
                    GROUP BY ALL HAVING sum([{table}][n + 1]) <= {most_repetition(kind.width, kind.bits)})))
        GROUP BY place, nth, run, first, island)
    WHERE regexp_matches(substr(run, low + 1, high - low), '[0-9].*[A-Za-z]|[A-Za-z].*[0-9]')"""


def secrets_sql() -> str:
    """Case folding is spelled out, since (?i) folds more than ASCII letters here."""
    names = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in
                     ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    patterns = [assign, "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"]
    for kind in CLASSES:
        patterns.append("[" + "".join("\\" + c if c in "-]^\\" else c for c in kind.alphabet) + f"]{{{kind.width},}}")
    runs = "\n    UNION ALL".join(_runs_sql(n, p, "run" if n else "value") for n, p in enumerate(patterns))
    windows = "\n    UNION ALL".join(_windows_sql(n, kind) for n, kind in enumerate(CLASSES, 3))
    kinds = ", ".join(f"'{name}'" for name in ("assign", "access", "hex", *(c.name for c in CLASSES)))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text FROM documents),
runs AS ({runs}),
base AS (
    SELECT place, kind, first AS start, first + len(run) AS "end" FROM runs WHERE kind < 3 AND (kind > 0 OR len(value) >= 6)
), found AS ({windows}
), spans AS (
    SELECT * FROM base UNION ALL SELECT * FROM found f WHERE NOT EXISTS (
        SELECT 1 FROM base b WHERE b.place = f.place AND b.start <= f.start AND b."end" >= f."end")
), written AS (
    SELECT place, kind, start, ([{kinds}])[kind + 1] || ':' || start || ':' || "end" AS span FROM spans
), held AS (
    SELECT place, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3), '') AS base,
        string_agg(span, ',' ORDER BY start, kind) AS spans FROM written GROUP BY place
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN held USING (place)"""


CHECKS = {"op12_importance_resampling": resampling_sql(), "op13_secret_scan": secrets_sql()}
