"""Line dedup, substring dedup, decontamination: against SQL or their definition by brute force."""

import hashlib
import random

import numpy as np
import pytest
from llm_cases import AWKWARD, awkward, empty, shipped, texts  # noqa: F401
from oracle import compare
from pyspark.sql import functions as F

from leadflow.llm import common as C
from leadflow.llm import decontaminate as D
from leadflow.llm import line_dedup as L
from leadflow.llm import queries as Q
from leadflow.llm import substring_dedup as S
from leadflow.llm import suffix_sort as X

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(Q.ORACLES))
def test_oracle(spark, duck_mid, key):
    duck_mid.execute("CREATE OR REPLACE VIEW benchmark AS SELECT * FROM read_parquet('/root/testdata/sf0.01/benchmark.parquet')")
    duck_mid.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    ok, said = compare(Q.QUERIES[key](spark, MID), duck_mid, Q.ORACLES[key])
    assert ok, said


def lines_by_hand(rows, min_docs):
    strip = " \t\n\x0b\x0c\r"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(fold)
    rank = lambda i: float("inf") if i is None else i
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(rank(i))
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == rank(i)]
        out.append((i, "\n".join(kept), len(every), len(every) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_awkward(awkward, min_docs):

    out = L.line_dedup(awkward, min_docs=min_docs)
    assert out.columns == [*awkward.columns, "_n_lines", "_n_dropped"]
    got = sorted(((r["doc_id"], r["text"] or "", r["_n_lines"], r["_n_dropped"]) for r in out.collect()), key=str)
    assert got == lines_by_hand(AWKWARD, min_docs)


def test_empty_tables(spark, empty):
    assert L.line_dedup(empty).count() == 0
    assert S.remove_repeats(empty).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(empty, items).count() == 0


def test_hot_line_is_combined_before_the_shuffle(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one line that everyone has\nown line number "), F.col("id").cast("string")).alias("text"))
    out = L.line_dedup(rows, text_col="text")
    assert out.agg(F.sum("_n_dropped")).first()[0] == 3999


# --- suffixes ----------------------------------------------------------------------------------------------------------


def sorted_by_definition(t, depth):
    n = len(t)
    return sorted((tuple(t[i : i + depth].tolist()) for i in range(n - 1)), reverse=True)


@pytest.mark.parametrize("seed", range(60))
def test_induced_sorting(seed):
    rng = np.random.default_rng(seed)
    t = rng.integers(1, rng.integers(2, 6), rng.integers(1, 150))
    if seed % 3 == 0:
        t = np.tile(t[: len(t) // 3 + 1], 4)
    t = np.r_[t, 0].astype(np.uint16)
    depth = int(rng.choice([3, 8, 50]))
    # little memory: the queue goes to disk; a small base: names are sorted by recursion
    sorter = X.Sorter(t, depth, memory=int(rng.choice([16, 300, 1 << 20])), base=int(rng.choice([2, 1 << 20])))
    runs = list(sorter.run())
    sorter.close()
    assert not sorter.folder.exists()
    at, lcp = np.concatenate([a for a, _ in runs]), np.concatenate([p for _, p in runs])
    assert sorted(at.tolist()) == list(range(len(t) - 1))
    suffixes = [tuple(t[i : i + depth].tolist()) for i in at]
    assert suffixes == sorted_by_definition(t, depth)
    for k in range(1, len(at)):
        shared = next((d for d, (x, y) in enumerate(zip(suffixes[k - 1], suffixes[k], strict=False)) if x != y), min(len(suffixes[k - 1]), len(suffixes[k])))
        assert lcp[k] == shared


def removed(df):
    return {r["_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"hot_docs": 3, "shard_bytes": 2000}])
def test_substring_dedup_against_definition(spark, options):
    rng = random.Random(3)
    base = ["".join(rng.choice("abc é\n") for _ in range(rng.randint(0, 200))) for _ in range(30)]
    rows = [(7 * i, "".join(rng.choice(base)[rng.randint(0, 40) :][: rng.randint(0, 160)] for _ in range(rng.randint(0, 4)))) for i in range(120)]
    rows += [(9001, ""), (9002, None), (9003, "a" * 400), (9004, "a" * 300), (9005, "ab" * 200), (9005, "ab" * 200)]
    got = removed(S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), **options))
    assert got == S.brute_force([(i, (t or "").encode()) for i, t in rows])


def test_substring_dedup_on_documents(spark, texts):
    rows = {r["doc_id"]: tuple(r)[1:] for r in Q.QUERIES["op3_substring_dedup"](spark, MID).collect()}
    assert rows == S.brute_force([(i, t.encode()) for i, t in texts.items()])


def test_substring_dedup_awkward(awkward):
    from leadflow.llm.common import NO_ID

    got = removed(S.remove_repeats(awkward))
    assert got == S.brute_force([(NO_ID if i is None else i, (t or "").encode()) for i, t in AWKWARD])


# --- decontamination ---------------------------------------------------------------------------------------------------

QUESTION = "We know that Tom has 12 apples in the box and Anna gives 5 km of rope to Peter, how many apples does old Tom have after 12 days of work?"


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r["_id"], r["item"]) for r in D.contamination(d, b).collect()}


def test_reparameterised_question(spark):
    changed = "Before. We know that Sue has 31 apples in the box and Mary gives 8 km of rope to Karl, how many apples does old Sue have after 31 days of work? After."
    # the first number stands twice in the item, so it must be the same twice in the document
    broken = "We know that Sue has 31 apples in the box and Mary gives 8 km of rope to Karl, how many apples does old Sue have after 32 days of work?"
    other = "Sue has 31 pears and a cat, which nobody had asked about at all when the question was put to the class."
    assert found(spark, [(1, changed), (2, broken), (3, other), (4, QUESTION.upper())], [(7, QUESTION)]) == {(1, 7)}


def test_placeholders_alone_are_no_evidence(spark):
    table = "1 2 3 4 5 6 7 8 9 10 11 12"
    assert found(spark, [(1, "20 30 40 50 60 70 80 90 21 31 41 51")], [(1, table)]) == set()


def test_short_items_nulls_and_repeats(spark):
    items = [(1, "what is the capital of"), (2, None), (None, "nothing has this item id at all"), (3, ""), (1, "what is the capital of"), (4, "too short")]
    docs = [(1, "So, what is the capital of France"), (1, "So, what is the capital of France"), (2, None), (None, "What Is the capital of"), (3, ""), (5, "nothing has this item id at all"), (6, "too short")]
    from leadflow.llm.common import NO_ID

    assert found(spark, docs, items) == {(1, 1), (NO_ID, 1)} or found(spark, docs, items) == {(1, 1)}


def test_decontaminated_keeps_columns(spark, awkward):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    out = D.decontaminated(awkward, items)
    assert out.columns == awkward.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted((r["doc_id"] for r in awkward.collect() if r["doc_id"] not in (1, 6)), key=str)


def test_null_and_repeated_ids_are_judged_one_by_one(spark):
    docs = spark.createDataFrame([(None, QUESTION), (None, "a clean text"), (None, None), (4, QUESTION), (4, "another clean text")], "doc_id long, text string")
    kept = D.decontaminated(docs, spark.createDataFrame([(7, QUESTION)], "item_id long, text string")).collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(None, "a clean text"), (None, None), (4, "another clean text")], key=str)


def test_word_for_word_copies(spark):
    short, spaceless = "Compute 12 + 35 * 4 - 7", "一辆汽车以每小时六十公里的速度行驶三个小时后停下"
    docs = [(1, QUESTION.upper()), (2, QUESTION.lower()), (3, QUESTION.replace(" ", "\n")), (4, QUESTION.replace(" ", "  "))]
    docs += [(5, f"So: {short}."), (6, "So: Compute 13 + 36 * 5 - 8."), (7, "前文" + spaceless + "后文"), (8, "first\n 2 + 2 =  4\nlast"), (9, "all of 2 2 4 here"), (10, "clean")]
    items = spark.createDataFrame([(1, QUESTION), (2, short), (3, spaceless), (4, "2 + 2 = 4"), (5, None), (6, "")], "item_id long, text string")
    kept = D.decontaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted(r["doc_id"] for r in kept) == [6, 9, 10]


def test_a_conflict_rejects_its_windows_only(spark):
    item = "Tom has 12 apples and then he walks along the road to the market where people sell 12 old books to him"
    one_changed = "Sue has 31 pears or so. Sue has 31 apples and then he walks along the river to the market where people sell 32 old books to him"
    docs = [(1, item.replace("12 old", "13 old").replace("road", "lane").replace("and then he", "and so she")), (2, one_changed), (3, "Sue has 31 pears")]
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    near = spark.createDataFrame([(8, "the 5 red cats saw the 5 red dogs")], "item_id long, text string")
    conflict = spark.createDataFrame([(1, "the 6 red cats saw the 7 red dogs"), (2, "the 6 red cats saw the 6 red dogs")], "doc_id long, text string")
    assert [r["doc_id"] for r in D.decontaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()] == [3]
    assert [r["doc_id"] for r in D.decontaminated(conflict, near).collect()] == [1]
    # template windows agree though no eight plain words do
    far = "We know that Sue has 31 apples in the box and Mary gives 8 km of rope to Karl, how many apples does old Sue have after 32 days of work?"
    b = spark.createDataFrame([(7, QUESTION)], "item_id long, text string")
    assert D.decontaminated(spark.createDataFrame([(1, far)], "doc_id long, text string"), b).count() == 0


def test_stored_tables_free_their_shuffles(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def files() -> set[str]:
        blocks = env.blockManager().diskBlockManager().getAllBlocks()
        return {n for k in range(blocks.size()) if (n := blocks.apply(k).name()).startswith("shuffle_")}

    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    before, setting = files(), spark.conf.get(C._FREE, None)
    kept = C.store(rows, "kept")
    with_kept = files()
    assert with_kept - before
    freed = C.store(rows.withColumn("k", F.col("k") + 1), "freed", free=True)
    assert not files() - with_kept
    assert spark.conf.get(C._FREE, None) == setting
    assert kept.count() == freed.count() == 100
