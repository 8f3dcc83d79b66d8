"""Line dedup (operator 6), in DataFrame functions only.

Lines are exploded and normalised (ASCII white space stripped at both ends, A-Z lower-cased); their key is a 128-bit hash.
A key of at least ``min_chars`` code points that at least ``min_docs`` documents hold loses all its lines except in the
smallest document that holds it. Other lines stay and are joined again by position.

Null and empty texts are one empty line. A null id counts as one document that sorts last. Repeated rows of one id are one
document; each of them comes back. Columns other than id and text are carried along untouched under their own names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm import common as C

_STRIP = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line):
    """The normalised line."""
    return F.translate(F.btrim(line, F.lit(_STRIP)), _UPPER, _UPPER.lower())


def dropped_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _print, drops): the positions that a document loses; ``_print`` tells rows of one id with other texts apart.

    A hot line holds many occurrences: they are combined to one row of each task before the first shuffle, and the join
    back is between two written tables, of which AQE splits large partitions.
    """
    lines = C.id_and_text(docs, id_col, text_col).select(
        "_id", F.xxhash64("_text").alias("_print"), F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line")
    )
    keyed = lines.select("_id", "_print", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    # the second hash is seeded with the first, so the two make 128 bits
    keyed = keyed.select("_id", "_print", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(7), "key").alias("k2"))
    keyed = C.store(keyed, "lines")
    if min_docs == 2:
        shared = keyed.groupBy("k1", "k2").agg(F.min("_id").alias("first"), F.max("_id").alias("last")).filter("first < last")
    else:
        seen = keyed.select("k1", "k2", "_id").distinct()
        shared = seen.groupBy("k1", "k2").agg(F.min("_id").alias("first"), F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    shared = C.store(shared.select("k1", "k2", "first"), "shared-lines")
    lost = keyed.join(shared, ["k1", "k2"]).filter(F.col("_id") > F.col("first"))
    return lost.groupBy("_id", "_print").agg(F.collect_set("pos").alias("drops"))


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``text_col`` rid of repeated lines, and ``_n_lines`` and ``_n_dropped``."""
    drops = dropped_lines(docs, min_chars, min_docs, id_col, text_col)
    mine = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs[id_col].cast("long"), F.lit(C.NO_ID)).alias("_id"),
        F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("_print"),
        F.coalesce(docs[text_col], F.lit("")).alias("_text"),
    )
    both = mine.join(drops, ["_id", "_print"], "left").withColumn("lines", F.split("_text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    text = F.when(F.col("drops").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return both.select(
        *[(text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns],
        F.size("lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("_n_dropped"),
    )
