"""Documents with what may be odd about them, for all operators."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField(n, T.LongType() if n in ("doc_id", "n_chars") else T.StringType()) for n in ("doc_id", "text", "lang", "source", "n_chars")]
    # names that operators use, and one that differs in case alone
    + [T.StructField(n, T.StringType()) for n in ("TEXT", "score", "shard", "epoch", "size", "key", "component_id", "kept", "secrets", "count")]
)
ENGLISH = "the quick brown fox jumps over the lazy dog and then it was seen that nothing of this would ever be the same again"
GERMAN = "der schnelle braune fuchs springt über den faulen hund und dann wurde gesehen dass nichts davon je wieder so sein würde"
SPANISH = "el rápido zorro marrón salta sobre el perro perezoso y luego se vio que nada de esto volvería a ser lo mismo"
FRENCH = "le rapide renard brun saute par dessus le chien paresseux et puis on vit que rien de cela ne serait plus jamais pareil"
TEXTS = {"en": ENGLISH, "de": GERMAN, "es": SPANISH, "fr": FRENCH}


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "other", "0.5", "7", "3", "large", "k", "c", "no", "none", "9")


def odd_documents():
    """Nulls in every column, empty and very long texts, equal rows, repeated and missing ids, signs beyond Latin."""
    return [
        row(1, ENGLISH),
        row(2, ENGLISH, source="b"),
        row(2, ENGLISH, source="b"),
        row(3, None, None, None),
        row(4, ""),
        row(5, " \t\n "),
        row(6, "12345 !!! ---"),
        row(7, GERMAN, "de"),
        row(8, (ENGLISH + " ") * 1500, source=None),
        row(9, "x" * 30000),
        row(None, FRENCH, "fr"),
        row(None, FRENCH, "fr"),
        row(10, "naïve 数据 处理 🙂 <|endoftext|> a\x00b İstanbul", None),
        row(10, "another text under the same id as the one before it", None, "b"),
        row(11, ENGLISH + " indeed", source="c"),
        row(12, "As " * 400, source="c"),
        row(13, "one two three"),
        row(14, "One two  three"),
        (15, None, None, None, None, *[None] * 10),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(odd_documents() if rows is None else rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
