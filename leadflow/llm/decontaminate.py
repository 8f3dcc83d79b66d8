"""Benchmark decontamination (operator 9), in DataFrame functions only: template canonicalisation and a hash join of windows.

A text becomes a template: numbers, names (capitalised words inside a sentence) and units behind numbers give way to typed
placeholders, the rest is folded to lower case and rid of punctuation. Windows of ``WINDOW`` template words of documents and
benchmark items are joined by their hash. A question whose numbers, names or units were changed has the same template; so a
hit counts only where its slots agree: along one diagonal (the same shift between document and item) each value of the item
must stand for one value of the document and the other way round. Windows need ``LITERAL`` words that are not placeholders.

Items of fewer than ``WINDOW`` words, but at least ``LITERAL``, are one window of their own length. The windows of the
benchmark are counted; up to ``SENT_WINDOWS`` they are sent to all tasks (16 bytes each), so that documents' windows need no
shuffle; beyond that number the join is a shuffled one.

``decontaminated`` also looks for word-for-word copies: windows of ``WINDOW`` plain words, values included, whatever their case,
line breaks or blanks; signs of scripts without blanks are words. Items of fewer words are one window, those of fewer than
``LITERAL`` words count where they are a whole line. It judges the slots of each
template window by themselves. ``contamination`` counts template windows only and judges diagonals, as its SQL does.

Null and empty texts and items have no windows. ``contamination`` counts by id, null ids as one that sorts last;
``decontaminated`` judges each text of a null or repeated id by itself. Null item ids don't count. Ties can't arise: every item that a document holds is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm import common as C

WINDOW = 8
LITERAL = 5
SENT_WINDOWS = 1_000_000

# Units of measure that may stand behind a number.
UNITS = (
    "%|percent|km|cm|mm|m|kg|g|mg|lb|lbs|oz|l|ml|s|ms|min|minutes|h|hours|days|weeks|months|years|mph|kmh|miles|feet|ft|inches|"
    "metres|meters|grams|litres|liters|dollars|euros|pounds|cents|degrees"
)
#: Private-use signs: number, name, unit, and a separator within a number.
NUMBER, NAME, UNIT, INNER = "\ue001", "\ue002", "\ue003", "\ue004"

# The rules, in order: (pattern, replacement), in the common ground of Java's and RE2's expressions.
_NAMED = (r"([\p{L}\p{N},;] )(\p{Lu}\p{Ll}+)", "$1" + NAME + "$2")
_RULES = (
    _NAMED,
    _NAMED,  # a name right behind a name was part of the first match
    (r"([0-9])[.,:/]([0-9])", "$1" + INNER + "$2"),
    (r"([0-9])[.,:/]([0-9])", "$1" + INNER + "$2"),  # as in 1,2,3
    ("([0-9][0-9" + INNER + "]*)", NUMBER + "$1"),
    ("(?i)(" + NUMBER + "[0-9" + INNER + "]+) ?(" + UNITS + r")([^\p{L}\p{N}]|$)", "$1 " + UNIT + "$2$3"),
)
_VALUE = ("([" + NUMBER + NAME + UNIT + r"])[\p{L}\p{N}%" + INNER + "]+", "$1")
#: Signs of scripts that put no blanks between words.
_SPACELESS = (r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])", " $1 ")
_GAP = r"[^\p{L}\p{N}" + NUMBER + NAME + UNIT + INNER + "%]+"


def marked(text: Column) -> Column:
    """The text in lower case with a sign before each slot's value."""
    for pattern, replacement in _RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return F.lower(text)


def words(text: Column) -> Column:
    return F.filter(F.split(text, _GAP), lambda w: w != "")


def template(text: Column) -> Column:
    """The words of a marked text without the slots' values; they stand at the places of the marked words."""
    return words(F.regexp_replace(text, *_VALUE))


def plain(text: Column) -> Column:
    """The words of a text in lower case, values as they are."""
    return words(F.regexp_replace(F.lower(text), *_SPACELESS))


def _window_hashes(t: Column, n) -> Column:
    """Hash of each window of ``n`` words, in order; none where there are fewer words."""
    count = F.size(t) - n + 1
    at = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(t, i, n)))


def benchmark_windows(items: DataFrame, window: int, literal: int, item_col: str, text_col: str) -> DataFrame:
    """(item, n, ipos, h) of each window of an item that has enough literal words."""
    given = items.select(items[item_col].cast("long").alias("item"), items[text_col].alias("text")).dropna().distinct()
    t = given.select("item", template(marked(F.col("text"))).alias("t"))
    t = t.withColumn("n", F.least(F.size("t"), F.lit(window))).filter(F.col("n") >= literal)
    t = t.select("item", "n", "t", F.posexplode(_window_hashes(F.col("t"), F.col("n"))).alias("ipos", "h"))
    slots = F.array(F.lit(NUMBER), F.lit(NAME), F.lit(UNIT))
    plain = F.size(F.filter(F.slice("t", F.col("ipos") + 1, F.col("n")), lambda w: ~F.array_contains(slots, w)))
    return t.filter(plain >= literal).select("item", "n", "ipos", "h")


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, literal: int = LITERAL, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(_id, item, n_windows): the items whose windows a document holds with slots that agree, and how many of them."""
    return _held(docs, items, window, literal, id_col, text_col, item_col, item_text_col).groupBy("_id", "item").agg(F.sum("n").alias("n_windows"))


def _held(docs: DataFrame, items: DataFrame, window: int, literal: int, id_col: str, text_col: str, item_col: str, item_text_col: str, each: bool = False) -> DataFrame:
    """(_id, _print, item, n) of each diagonal whose slots agree, or ``each`` window's; ``_print`` tells texts of one id apart."""
    mine = C.id_and_text(docs, id_col, text_col)
    theirs = C.store(benchmark_windows(items, window, literal, item_col, item_text_col), "benchmark-windows")
    keys = theirs.select("n", "h").distinct()
    keys = F.broadcast(keys) if theirs.count() <= SENT_WINDOWS else keys
    short = [r["n"] for r in theirs.select("n").distinct().collect()]  # at most window - literal + 1 lengths
    t = mine.select("_id", F.xxhash64("_text").alias("_print"), template(marked(F.col("_text"))).alias("t"))
    parts = [t.select("_id", "_print", F.lit(n).alias("n"), F.posexplode(_window_hashes(F.col("t"), n)).alias("pos", "h")) for n in sorted(short)]
    empty = C.empty(mine.sparkSession, "_id long, _print long, n int, pos int, h long")
    found = empty
    for p in parts:
        found = p if found is empty else found.union(p)
    hits = C.store(found.join(keys, ["n", "h"]), "window-hits")
    hits = hits.join(theirs, ["n", "h"]).select("_id", "_print", "item", "n", "pos", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"))
    return _agreeing(mine, items, C.store(hits, "hits"), item_col, item_text_col, each)


def _agreeing(mine: DataFrame, items: DataFrame, hits: DataFrame, item_col: str, item_text_col: str, each: bool) -> DataFrame:
    """Hits by (document, item) along diagonals on which the slots' values stand for each other one to one."""
    spans = hits.groupBy("_id", "_print", "item", "shift").agg(F.collect_set("pos").alias("at"), F.max("n").alias("n"))
    texts = mine.withColumn("_print", F.xxhash64("_text")).join(hits.select("_id", "_print").distinct(), ["_id", "_print"], "left_semi")
    texts = texts.select("_id", "_print", words(marked(F.col("_text"))).alias("w")).dropDuplicates(["_id", "_print"])
    asked = items.select(items[item_col].cast("long").alias("item"), words(marked(items[item_text_col])).alias("v")).dropna().dropDuplicates(["item", "v"])
    both = spans.join(texts, ["_id", "_print"]).join(asked, "item")

    def slots(places: Column) -> Column:
        pair = F.transform(places, lambda p: F.struct(F.get("w", p).alias("d"), F.get("v", p - F.col("shift")).alias("b")))
        return F.array_distinct(F.filter(pair, lambda x: x["b"].rlike("^[" + NUMBER + NAME + UNIT + "]")))

    def one_to_one(slot: Column) -> Column:
        return (F.size(slot) == F.size(F.array_distinct(slot["d"]))) & (F.size(slot) == F.size(F.array_distinct(slot["b"])))

    if each:  # a conflict rejects only the windows that hold it
        agreeing = F.filter("at", lambda p: one_to_one(slots(F.sequence(p, p + F.col("n") - 1))))
        judged = both.select("_id", "_print", "item", F.size(agreeing).alias("n")).filter("n > 0")
    else:
        places = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.col("n") - 1))))
        judged = both.select("_id", "_print", "item", F.size("at").alias("n"), slots(places).alias("slot")).filter(one_to_one(F.col("slot")))
    return judged.select("_id", "_print", "item", "n")


def verbatim(docs: DataFrame, items: DataFrame, window: int, literal: int, id_col: str, text_col: str, item_text_col: str, item_col: str) -> DataFrame:
    """(_id, _print) of documents that hold a window of an item word for word, or a shorter item as a line."""
    mine = C.id_and_text(docs, id_col, text_col)
    asked = items.select(items[item_col].cast("long").alias("item"), items[item_text_col].alias("text")).dropna().select(plain(F.col("text")).alias("t"))
    asked = asked.withColumn("n", F.least(F.size("t"), F.lit(window))).filter("n > 0")
    keys = C.store(asked.select("n", F.explode(_window_hashes(F.col("t"), F.col("n"))).alias("h")).distinct(), "verbatim-windows")
    sent = F.broadcast(keys) if keys.count() <= SENT_WINDOWS else keys
    sizes = sorted(r["n"] for r in keys.select("n").distinct().collect())  # at most window lengths
    t = mine.select("_id", F.xxhash64("_text").alias("_print"), "_text", plain(F.col("_text")).alias("t"))
    found = C.empty(mine.sparkSession, "_id long, _print long, n int, h long")
    for n in sizes:
        if n >= literal:
            found = found.union(t.select("_id", "_print", F.lit(n).alias("n"), F.explode(_window_hashes(F.col("t"), n)).alias("h")))
    if sizes and sizes[0] < literal:
        lines = t.select("_id", "_print", F.explode(F.split("_text", "[\r\n]+")).alias("line")).select("_id", "_print", plain(F.col("line")).alias("t"))
        found = found.union(lines.filter(F.size("t").between(1, literal - 1)).select("_id", "_print", F.size("t").alias("n"), F.xxhash64("t").alias("h")))
    return found.join(sent, ["n", "h"], "left_semi").select("_id", "_print")


def decontaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, literal: int = LITERAL, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item's window; texts of a null or repeated id are judged one by one."""
    bad = _held(docs, items, window, literal, id_col, text_col, item_col, item_text_col, each=True).select("_id", "_print")
    bad = bad.union(verbatim(docs, items, window, literal, id_col, text_col, item_text_col, item_col)).distinct()
    key, text = F.coalesce(docs[id_col].cast("long"), F.lit(C.NO_ID)), F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(bad, (key == bad["_id"]) & (text == bad["_print"]), "left_anti")
