"""Line dedup across documents (DataFrame expressions only).

Lines are exploded as (row, position, key hash), the distinct documents of each
hash are counted, and the lines of hashes at or over the threshold are dropped
everywhere but in the largest document that holds them. The texts themselves
are shuffled once, to meet their dropped positions; long texts are rebuilt in time
proportional to their lines.

Edge cases: a null or empty text is one empty line; rows that repeat a doc_id
count as one document; a row with a null doc_id is kept whole and not counted;
an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.session import checkpoint_dir

WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """The line without outer white space and with A-Z lower-cased (other letters stay)."""
    bare = F.btrim(line, F.lit(WHITE))
    plain = F.octet_length(bare) == F.length(bare)  # lower() is the same for ASCII, and faster
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row hash, position, 128-bit key hash) of every line that is long enough to count."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.filter("doc_id is not null")
            .select("doc_id", F.xxhash64(text).alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
            .filter(F.length("line") >= MIN_CHARS)
            .select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
            .filter(F.length("key") >= MIN_CHARS)
            .select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")))


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper) of keys in ``min_docs`` documents or more; both aggregates combine map-side."""
    return (lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
            .filter(F.col("n") >= min_docs).select("h1", "h2", "keeper"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines`` and ``n_dropped``."""
    checkpoint_dir(docs.sparkSession)
    lines = _lines(docs)
    # From a checkpoint both sides of the join are plain shuffles, so a hot line's rows can be split.
    drops = (lines.join(repeated_keys(lines, min_docs).checkpoint(), ["h1", "h2"])
             .filter("doc_id != keeper")
             .groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row"))
             .agg(F.collect_set("pos").alias("__drop")))
    # The caller's columns travel in one struct, so none of them can clash with those of the join.
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    both = (docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__own"), F.col("doc_id").alias("__doc"),
                        F.coalesce(F.col("text"), F.lit("")).alias("__text"))
            .withColumn("__h", F.xxhash64("__text"))
            .join(drops, (F.col("__doc") == F.col("__id")) & (F.col("__h") == F.col("__row")), "left"))
    split = F.split("__text", "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__drop")),
                       lambda i: F.get(F.col("__split"), i))
    out = both.withColumn("__split", split).select(
        "__own",
        F.when(F.col("__drop").isNull(), F.col("__text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size("__split").cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("__drop"), F.lit(0)), F.lit(0)).cast("long").alias("n_dropped"))
    return out.select(*[F.col(f"__own.`{c}`") for c in rest], "text", "n_lines", "n_dropped")


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return line_dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
