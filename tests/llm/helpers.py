"""Small fixtures and brute-force versions shared by the operator tests."""

import re
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
CLASHES = ("failed", "n_words", "score", "ids", "bytes", "rep", "label", "pos", "key", "kept", "n_lines", "n_dropped", "text2")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, first=0, extra=False):
    rows = [(first + i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for c in CLASHES:
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def classes(pairs, names):
    """Smallest member of each name's component."""
    up = {n: n for n in names}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in names}


#: Nulls, blanks, ties, repeats and a very long text.
ODD = [None, "", " ", "\n\n", "one", "one two three four", "a b c d e f g h " * 30, "é ñ 中文 ß   😀 it's we'll",
       "The same line of some length\nAnother line of some length", "The same line of some length\nAnother line of some length",
       "word " * 60_000, "\x00 \x1c \x85", "#*$%&|<>", "A" * 5_000]
