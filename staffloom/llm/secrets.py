"""Secret scan: three fixed shapes, and strings whose letters are too evenly spread.

A candidate is a run of 20 or more characters of an alphabet in which keys are written. A
window of `WINDOW` characters slides over it. The counts of the window's characters are
kept and changed by the one that enters and the one that leaves, and with them the sum of
c * log2 c, from which the Shannon entropy follows:  H = log2 W - sum / W. The sums are
whole millionths, so they do not drift. The highest entropy of any window is judged by the
limit of the candidate's character class. An allow-list takes back what is long and varied
but no secret: plain words, numbers, UUIDs, paths, stated examples.

Nulls: a NULL text is an empty text and holds nothing. NULL keys are passed through,
repeated rows give repeated rows, empty tables empty results. Spans of different kinds
may overlap. Only key and text are looked at; columns of other names cannot clash, as the
results are made of these two alone, or of the input's own columns in `redacted`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffloom.llm.spans import found, labelled, let, replaced, written

# Fixed shapes. Possessive repeats match the same and never backtrack.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
)
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
# Bits a window may have, by the characters of the whole candidate.
HEX_CLASS, HEX_LIMIT = r"^[0-9A-Fa-f]+$", 3.0
UPPER_CLASS, UPPER_LIMIT = r"^[A-Z0-9]+$", 3.4
LOWER_CLASS, LOWER_LIMIT = r"^[a-z0-9]+$", 3.4
MIXED_LIMIT = 3.7
ALLOWED = (
    r"^[^0-9]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^/?([a-z0-9_-]{1,24}/)+[a-z0-9_-]{0,24}$",
    r"(?i)example|sample|placeholder|changeme|dummy|x{6}",
    r"(?i)^(data|abcdefgh|01234567)",
)
_FIRST, _SLOTS = ord("+"), ord("z") - ord("+") + 1
_SCALE = 1_000_000
_SUMS = [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, WINDOW + 2)]


def least_sum(candidate: Column) -> Column:
    """The least sum of c * log2 c, in millionths, over all windows; NULL if too short."""
    known = F.lit(_SUMS)

    def slide(codes: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), _SLOTS).alias("counts"),
            F.lit(0).cast("bigint").alias("sum"),
            F.lit(None).cast("bigint").alias("least"),
        )

        def step(a: Column, i: Column) -> Column:
            enters = codes[i]
            leaves = F.when(i >= WINDOW, codes[F.greatest(i - WINDOW, F.lit(0))]).otherwise(F.lit(-1))
            counts = F.transform(
                a["counts"],
                lambda c, slot: c + (slot == enters).cast("int") - (slot == leaves).cast("int"),
            )
            n_in, n_out = a["counts"][enters], a["counts"][F.greatest(leaves, F.lit(0))]
            grown = known[n_in + 1] - known[n_in]
            shrunk = F.when(leaves >= 0, known[n_out] - known[F.greatest(n_out - 1, F.lit(0))]).otherwise(0)
            change = F.when(enters == leaves, F.lit(0)).otherwise(grown - shrunk)
            return let(
                (a["sum"] + change).cast("bigint"),
                lambda s: F.struct(
                    counts.alias("counts"),
                    s.alias("sum"),
                    F.when(i >= WINDOW - 1, F.least(a["least"], s)).otherwise(a["least"]).alias("least"),
                ),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda a: a["least"]
        )

    letters = F.filter(F.split(candidate, ""), lambda c: c != "")
    return let(F.transform(letters, lambda c: F.ascii(c) - _FIRST), slide)


def _most(limit: float) -> int:
    """The greatest sum whose entropy reaches `limit` bits."""
    return round(WINDOW * (math.log2(WINDOW) - limit) * _SCALE)


def is_secret(candidate: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    most = (
        F.when(candidate.rlike(HEX_CLASS), _most(HEX_LIMIT))
        .when(candidate.rlike(UPPER_CLASS), _most(UPPER_LIMIT))
        .when(candidate.rlike(LOWER_CLASS), _most(LOWER_LIMIT))
        .otherwise(_most(MIXED_LIMIT))
    )
    return F.when(allowed, F.lit(False)).otherwise(least_sum(candidate) <= most)


def kinds_of(text: Column) -> list[tuple[str, Column]]:
    """(kind, spans) for the fixed shapes and for entropy."""
    value = F.regexp_extract
    assign = F.filter(
        found(text, ASSIGN), lambda s: F.length(value(s["text"], ASSIGN, 2)) >= ASSIGN_LEAST
    )
    spread = F.filter(found(text, CANDIDATE), lambda s: is_secret(s["text"]))
    return [*zip(KINDS, (assign, found(text, ACCESS), found(text, HEX), spread))]


def scanned(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `key`, `text`, and per kind an array column of its spans."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select("key", "text", *(spans.alias(kind) for kind, spans in kinds_of(F.col("text"))))


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the fixed shapes, digest of their spans, all spans."""
    kinds = [(kind, F.col(kind)) for kind in KINDS]
    return scanned(df, key, text).select(
        F.col("key").alias(key),
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(written(labelled(kinds[:3])), 256).alias("base_sha256"),
        written(labelled(kinds)).alias("spans"),
    )


def redacted(
    df: DataFrame, text: str = "text", mark: str = "[SECRET]", n_chars: str | None = "n_chars"
) -> DataFrame:
    """All rows of `df`, every span of a secret in `text` replaced by `mark`, and a column
    `n_chars`, where there is one, brought up to date. Rows without a secret stay as they
    are, NULL texts too."""
    marks, clean = "__secret_spans", "__secret_text"
    kinds = kinds_of(F.coalesce(F.col(text), F.lit("")))
    marked = df.withColumn(marks, labelled(kinds))
    out = {clean: replaced(F.col(text), F.col(marks), lambda s: F.lit(mark))}
    changed = marked.withColumns(out).withColumn(text, F.col(clean))
    if n_chars in df.columns:
        kind = df.schema[n_chars].dataType
        length = F.length(F.col(text)).cast(kind)
        changed = changed.withColumn(n_chars, F.when(F.size(marks) > 0, length).otherwise(F.col(n_chars)))
    return changed.select(*df.columns)


def _sql() -> str:
    """The same in SQL, window by window instead of by incremental counts."""

    def either_case(word: str) -> str:
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

    names = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    shapes = {
        "assign": rf"""({names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]{12,}",
        "hex": r"[0-9a-f]{32,}",
        "entropy": r"[A-Za-z0-9+/_=-]{20,}",
    }
    found = " UNION ALL ".join(
        f"""
  SELECT doc_id, {n} AS n, '{kind}' AS kind, hit, i,
    (sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit))::BIGINT AS start
  FROM (SELECT doc_id, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{shape}') AS hits, string_split_regex(text, '{shape}') AS gaps
              FROM texts) WHERE len(hits) > 0)
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""
        for n, (kind, shape) in enumerate(shapes.items())
    )
    assign = shapes["assign"]
    allowed = " OR ".join(f"regexp_matches(c, '{a}')" for a in ALLOWED)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
candidates AS (SELECT DISTINCT hit AS c FROM found WHERE kind = 'entropy'),
windows AS (SELECT c, substr(c, unnest(range(1, length(c) - {WINDOW - 2})), {WINDOW}) AS w FROM candidates),
letters AS (SELECT c, w, unnest(list_distinct(string_split(w, ''))) AS x FROM (SELECT DISTINCT c, w FROM windows)),
sums AS (SELECT c, w, sum({_SUMS}[{WINDOW + 1} - length(replace(w, x, ''))]) AS s FROM letters GROUP BY c, w),
least AS (SELECT c, min(s) AS s FROM sums GROUP BY c),
secret AS (
  SELECT c FROM least WHERE NOT ({allowed}) AND s <= CASE
    WHEN regexp_matches(c, '{HEX_CLASS}') THEN {_most(HEX_LIMIT)}
    WHEN regexp_matches(c, '{UPPER_CLASS}') THEN {_most(UPPER_LIMIT)}
    WHEN regexp_matches(c, '{LOWER_CLASS}') THEN {_most(LOWER_LIMIT)}
    ELSE {_most(MIXED_LIMIT)} END),
kept AS (
  SELECT doc_id, n, kind, start, concat_ws(':', kind, start, start + length(hit)) AS mark FROM found
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '{assign}', 2)) >= {ASSIGN_LEAST}
    WHEN 'entropy' THEN hit IN (SELECT c FROM secret) ELSE true END),
marks AS (
  SELECT doc_id, count(*) FILTER (n = 0) AS n_assign, count(*) FILTER (n = 1) AS n_access,
    count(*) FILTER (n = 2) AS n_hex, string_agg(mark, ',' ORDER BY start, n) FILTER (n < 3) AS base,
    string_agg(mark, ',' ORDER BY start, n) AS spans
  FROM kept GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN marks m ON t.doc_id = m.doc_id
"""


SQL = _sql()
