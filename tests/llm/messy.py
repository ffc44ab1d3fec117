"""Documents with every trouble the operators promise to bear."""

from __future__ import annotations

TEXT = "The quick brown fox jumps over the lazy dog near the old mill. " * 12
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, h long, key string,"
    " fingerprint string, score double, n_words long, spans string, m_key string, `range` int, label int"
)


def _row(doc_id, text, lang="en", source="a"):
    more = (7, 8, "k", "f", 0.1, 9, "s", "m", 1, 1)
    return (doc_id, text, lang, source, len(text) if text is not None else None, *more)


def rows():
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [
        _row(1, TEXT),
        _row(2, TEXT),  # a copy
        _row(3, None),
        _row(4, ""),
        _row(5, " \t\n\x0b "),
        _row(6, TEXT, None, None),
        _row(6, TEXT, None, None),  # the same row again
        _row(None, "no key at all", "de", None),
        _row(7, "x" * 50_000),
        _row(8, "1" * 50_000),
        _row(9, long, "fr", "b"),
        _row(10, "é漢😀 \x00   ﬁn <|endoftext|> née", "fr", ""),
        _row(11, TEXT.replace("lazy", "sleepy", 1), "en", "b"),
    ]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
