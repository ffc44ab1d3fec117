"""Personal data: fixed shapes, and the words that give them away.

The shapes (e-mail, IP address, card and phone number) are the protected entities. A word
near an entity discloses it if the corpus shows that who reads the word learns the entity:

    PMI(word; entity) = log2( N * n(word, entity) / (n(word) * n(entity)) )
                     >= DISCLOSES * IC(entity),      IC(entity) = log2( N / n(entity) )

with n counted over distinct texts, so that copies of a text are one witness, and with at
least `WITNESSES` different contexts of the pair, so that a rare word that once stood
beside an address is no evidence.

Most entities occur in one or two texts and never have so many contexts. There the count is
corrected to its lower bound: a name among the `NEAR_NAMES` words beside an entity that
`FEW_TEXTS` texts hold at most (a capital and small letters, not at the start of a sentence)
discloses it if no text of the corpus holds the word without the entity beside it, so that
n(word) = n(word, entity). Words of either kind are marked wherever they stand in the corpus,
and `sanitised` generalises entities to their kind and removes the words.

All of it is counted over the whole corpus: contexts are gathered around every entity,
n(word) over every text that holds a word with witnesses enough. Nothing is gathered per
entity or word but counts; a text is named by a 64-bit hash.

Nulls: a NULL text is empty; a NULL key is a key of its own. Repeated rows give repeated
rows, rows that share a key but not the text are told apart. Empty tables give empty
results. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffloom.llm.spans import found, labelled, replaced, written
from staffloom.sources.workspace import Workspace

# Fixed shapes. Possessive repeats and the checks of the character before change nothing
# of what matches: a match that could begin inside a run begins at the run.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
CARD_MOST = 19
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PHONE_DIGITS = (9, 15)
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Characters and words on either side of an entity that are its context.
AROUND, NEAR_WORDS = 160, 8
WORD = r"[\p{L}\p{M}]{3,}"
WITNESSES = 3
DISCLOSES = 0.9
# Names beside entities of few texts: words on either side, texts, and how they are written.
NEAR_NAMES, FEW_TEXTS = 3, 2
NAME = r"^\p{Lu}[\p{Ll}\p{M}]+$"
OPENING = r"([.!?:\n])[^\p{L}\p{M}]*[\p{L}\p{M}]+"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Whether the digits pass the check sum that card numbers carry."""
    figures = F.filter(F.split(F.reverse(_digits(text)), ""), lambda c: c != "")
    doubled = F.transform(
        figures,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _is_card(s: Column) -> Column:
    fits = F.length(_digits(s["text"])) <= CARD_MOST
    return F.when(fits, _luhn(s["text"])).otherwise(False)


def kinds_of(text: Column, around: int = 0) -> list[tuple[str, Column]]:
    """(kind, spans) of the fixed shapes."""
    ip = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
    return [
        ("email", found(text, EMAIL, around)),
        ("ip", F.filter(found(text, IP, around), lambda s: s["text"].rlike(ip))),
        ("card", F.filter(found(text, CARD, around), _is_card)),
        ("phone", F.filter(found(text, PHONE, around), lambda s: F.length(_digits(s["text"])).between(*PHONE_DIGITS))),
    ]


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("h", F.xxhash64("text"))


def _contexts(scanned: DataFrame) -> DataFrame:
    """(h, entity, near, names): every entity with its words on either side, lowered, and
    those right beside it that are written as names."""
    each = [
        scanned.select("h", F.lit(kind).alias("kind"), F.explode(kind).alias("s")) for kind in KINDS
    ]
    spans = each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])
    value = F.when(F.col("kind").isin("card", "phone"), _digits(F.col("s.text"))).otherwise(F.lower("s.text"))
    # A word cut by the end of the stretch is no word.
    before = F.regexp_replace("s.before", r"^[\p{L}\p{M}]+", "")
    before = F.when(F.length("s.before") < AROUND, F.col("s.before")).otherwise(before)
    after = F.regexp_replace("s.after", r"[\p{L}\p{M}]+$", "")
    after = F.when(F.length("s.after") < AROUND, F.col("s.after")).otherwise(after)
    left = F.regexp_extract_all(F.lower(before), F.lit(WORD), F.lit(0))
    right = F.regexp_extract_all(F.lower(after), F.lit(WORD), F.lit(0))

    def beside(l: Column, r: Column, n: int) -> Column:
        last = F.greatest(F.size(l) - n, F.lit(0))
        return F.concat(F.slice(l, last + 1, F.lit(n)), F.slice(r, F.lit(1), F.lit(n)))

    # Words that open a sentence say nothing by their capital; nor does the text's first.
    inner = [F.regexp_replace(c, OPENING, "$1") for c in (F.concat(F.lit("."), before), after)]
    inner = [F.regexp_extract_all(c, F.lit(WORD), F.lit(0)) for c in inner]
    named = F.filter(beside(*inner, NEAR_NAMES), lambda w: w.rlike(NAME))
    return spans.select(
        "h",
        F.concat_ws(":", "kind", value).alias("entity"),
        beside(left, right, NEAR_WORDS).alias("near"),
        F.transform(named, F.lower).alias("names"),
    )


def _tells(n_word: Column, discloses: float) -> Column:
    """Whether a word in `n_word` texts tells enough of the entity; the more, the less. With
    `few` contexts no other text may hold it."""
    told = F.log2(F.col("texts") * F.col("both") / (n_word * F.col("n_entity")))
    content = F.log2(F.col("texts") / F.col("n_entity"))
    sure = ~F.col("few") | (n_word <= F.col("both"))
    return (content > 0) & (told >= discloses * content) & sure


def disclosing(
    scanned: DataFrame,
    df: DataFrame,
    ws: Workspace,
    key: str,
    text: str,
    witnesses: int = WITNESSES,
    discloses: float = DISCLOSES,
) -> DataFrame:
    """(h, pattern): the texts that hold disclosing words, and what matches those words."""
    contexts = ws.settle(_contexts(scanned), "contexts")
    pairs = contexts.select(
        "h", "entity", F.xxhash64("near").alias("c"), "names", F.explode(F.array_distinct("near")).alias("word")
    ).withColumn("named", F.array_contains("names", F.col("word"))).drop("names")
    pairs = ws.settle(pairs, "near")
    texts = scanned.select("h").distinct().agg(F.count("h").alias("texts"))
    of_entity = contexts.groupBy("entity").agg(F.count_distinct("h").alias("n_entity"))
    # A word is in no fewer texts than it is near entities in. Pairs that even this number
    # rules out, as it does common words, are dropped before the corpus is searched.
    near = pairs.groupBy("word").agg(F.count_distinct("h").alias("n_near"))
    seen = (
        pairs.groupBy("word", "entity")
        .agg(
            F.count_distinct("c").alias("seen"),
            F.count_distinct("h").alias("both"),
            F.max("named").alias("named"),
        )
        .withColumn("few", F.col("seen") < witnesses)
        .filter(~F.col("few") | F.col("named"))
        .join(near, "word")
        .join(of_entity, "entity")
        .filter(~F.col("few") | (F.col("n_entity") <= FEW_TEXTS))
        .join(F.broadcast(texts), F.lit(True))
        .filter(_tells(F.col("n_near"), discloses))
    )
    seen = ws.settle(seen.select("word", "both", "n_entity", "texts", "few"), "pairs")
    wanted = ws.settle(seen.select("word").distinct(), "words")
    held = (
        _rows(df, key, text)
        .select("h", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("word"))
        .join(wanted, "word", "left_semi")
        .distinct()
    )
    held = ws.settle(held, "held")
    of_word = held.groupBy("word").agg(F.count("h").alias("n_word"))
    words = seen.join(of_word, "word").filter(_tells(F.col("n_word"), discloses)).select("word").distinct()
    # Of one text; a text holds no more of them than words.
    listed = held.join(words, "word").groupBy("h").agg(F.array_sort(F.collect_set("word")).alias("words"))
    return listed.select(
        "h",
        F.concat(
            F.lit(r"(?iu)(?<![\p{L}\p{M}])(?:"), F.array_join("words", "|"), F.lit(r")(?![\p{L}\p{M}])")
        ).alias("pattern"),
    )


def scanned(df: DataFrame, ws: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, h, per kind the spans of the fixed shapes, and `term`, those of words
    that disclose one of them."""
    rows = _rows(df, key, text)
    base = rows.select("key", "h", *(c.alias(n) for n, c in kinds_of(F.col("text"), AROUND)))
    base = ws.settle(base, "base")
    told = ws.settle(disclosing(base, df, ws, key, text), "disclosing")
    terms = rows.join(told, "h").select("key", "h", found(F.col("text"), F.col("pattern")).alias(TERM))
    terms = terms.groupBy("h").agg(F.first(TERM).alias(TERM))
    empty = F.array().cast(terms.schema[TERM].dataType)
    return base.join(ws.settle(terms, "terms"), "h", "left").withColumn(TERM, F.coalesce(TERM, empty))


def report(df: DataFrame, ws: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the fixed shapes, digest of their spans, all spans."""
    kinds = [(kind, F.col(kind)) for kind in (*KINDS, TERM)]
    return scanned(df, ws, key, text).select(
        F.col("key").alias(key),
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(written(labelled(kinds[:-1])), 256).alias("base_sha256"),
        written(labelled(kinds)).alias("spans"),
    )


def sanitised(df: DataFrame, ws: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text of every row, entities generalised to their kind, disclosing words
    removed."""
    kinds = [(kind, F.col(kind)) for kind in (*KINDS, TERM)]
    marks = scanned(df, ws, key, text).select("h", labelled(kinds).alias("marks"))
    marks = marks.filter(F.size("marks") > 0).dropDuplicates(["h"])
    joined = _rows(df, key, text).join(marks, "h", "left")

    def by(s: Column) -> Column:
        named = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["kind"] == TERM, F.lit("")).otherwise(named)

    none = F.array().cast(marks.schema["marks"].dataType)
    clean = replaced(F.col("text"), F.coalesce("marks", none), by)
    return joined.select(F.col("key").alias(key), clean.alias(text))


def _sql() -> str:
    """The same in SQL, for unique keys."""
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    octet = r"(0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5]))"
    figure = f"substr(reverse({digits}), j, 1)::INT"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda j: CASE WHEN j % 2 = 1 THEN {figure}"
        f" WHEN {figure} > 4 THEN 2 * {figure} - 9 ELSE 2 * {figure} END)) % 10 = 0"
    )
    shapes = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_full_match(hit, '{octet}(\.{octet}){{3}}')"),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            f"CASE WHEN length({digits}) BETWEEN 12 AND {CARD_MOST} THEN {luhn} ELSE false END",
        ),
        "phone": (PHONE, f"length({digits}) BETWEEN {PHONE_DIGITS[0]} AND {PHONE_DIGITS[1]}"),
    }

    def places(shape: str, source: str) -> str:
        return f"""
  SELECT doc_id, hit, "right"(gap, {AROUND}) AS before, "left"(next, {AROUND}) AS after,
    (sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit))::BIGINT AS start
  FROM (SELECT doc_id, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, unnest(gaps[2:]) AS next,
          generate_subscripts(hits, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{shape}') AS hits, string_split_regex(text, '{shape}') AS gaps
              FROM {source}) WHERE len(hits) > 0)
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""

    base = " UNION ALL ".join(
        f"SELECT {n} AS n, '{kind}' AS kind, * FROM ({places(shape, 'texts')}) WHERE {test}"
        for n, (kind, (shape, test)) in enumerate(shapes.items())
    )
    word = WORD
    tells = (
        "log2(texts / n_entity) > 0 AND log2(texts * shared / (n_word * n_entity))"
        f" >= {DISCLOSES} * log2(texts / n_entity)"
    )
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({base}),
contexts AS (
  SELECT t.text, concat_ws(':', kind, CASE WHEN kind IN ('card', 'phone') THEN {digits} ELSE lower(hit) END) AS entity,
    regexp_extract_all(lower(CASE WHEN length(before) < {AROUND} THEN before
      ELSE regexp_replace(before, '^[\p{{L}}\p{{M}}]+', '') END), '{word}') AS l,
    regexp_extract_all(lower(CASE WHEN length(after) < {AROUND} THEN after
      ELSE regexp_replace(after, '[\p{{L}}\p{{M}}]+$', '') END), '{word}') AS r,
    regexp_extract_all(regexp_replace('.' || CASE WHEN length(before) < {AROUND} THEN before
      ELSE regexp_replace(before, '^[\p{{L}}\p{{M}}]+', '') END, '{OPENING}', '\1', 'g'), '{word}') AS li,
    regexp_extract_all(regexp_replace(CASE WHEN length(after) < {AROUND} THEN after
      ELSE regexp_replace(after, '[\p{{L}}\p{{M}}]+$', '') END, '{OPENING}', '\1', 'g'), '{word}') AS ri
  FROM base JOIN texts t USING (doc_id)),
near AS (
  SELECT text, entity, list_concat(l[-{NEAR_WORDS}:], r[:{NEAR_WORDS}]) AS words,
    list_transform(list_filter(list_concat(li[-{NEAR_NAMES}:], ri[:{NEAR_NAMES}]),
      lambda w: regexp_matches(w, '{NAME}')), lambda w: lower(w)) AS names
  FROM contexts),
pairs AS (
  SELECT word, entity, count(DISTINCT text)::DOUBLE AS shared, count(DISTINCT words) < {WITNESSES} AS few FROM (
    SELECT text, entity, words, names, unnest(list_distinct(words)) AS word FROM near)
  GROUP BY word, entity HAVING count(DISTINCT words) >= {WITNESSES} OR bool_or(list_contains(names, word))),
entities AS (SELECT entity, count(DISTINCT text)::DOUBLE AS n_entity FROM near GROUP BY entity),
held AS (
  SELECT DISTINCT text, word FROM (
    SELECT text, unnest(list_distinct(regexp_extract_all(lower(text), '{word}'))) AS word FROM texts)
  WHERE word IN (SELECT word FROM pairs)),
counts AS (SELECT word, count(*)::DOUBLE AS n_word FROM held GROUP BY word),
telling AS (
  SELECT DISTINCT word FROM pairs JOIN counts USING (word) JOIN entities USING (entity),
    (SELECT count(DISTINCT text)::DOUBLE AS texts FROM texts)
  WHERE {tells} AND (NOT few OR (n_entity <= {FEW_TEXTS} AND n_word <= shared))),
holders AS (
  SELECT doc_id, text FROM texts WHERE text IN (SELECT text FROM held WHERE word IN (SELECT word FROM telling))),
terms AS (
  SELECT {len(KINDS)} AS n, '{TERM}' AS kind, * FROM ({places(r"[\p{L}\p{M}]+", "holders")})
  WHERE lower(hit) IN (SELECT word FROM telling)),
marks AS (
  SELECT doc_id, n, start, concat_ws(':', kind, start, start + length(hit)) AS mark
  FROM (SELECT * FROM base UNION ALL SELECT * FROM terms)),
rows AS (
  SELECT doc_id, count(*) FILTER (n = 0) AS n_email, count(*) FILTER (n = 1) AS n_ip,
    count(*) FILTER (n = 2) AS n_card, count(*) FILTER (n = 3) AS n_phone,
    string_agg(mark, ',' ORDER BY start, n) FILTER (n < {len(KINDS)}) AS base, string_agg(mark, ',' ORDER BY start, n) AS spans
  FROM marks GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
  coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN rows USING (doc_id)
"""


SQL = _sql()
