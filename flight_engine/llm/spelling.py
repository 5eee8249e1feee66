"""Spelling variants of corpus words by asymmetric q-chunks.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.
The shorter word (of equally long ones each in turn, the smaller in order) contributes two
disjoint chunks, its first half and the rest. The other contributes positional grams
of those lengths. One edit touches one chunk at most, so the other chunk is a
gram of the longer word, moved by no place if the edit comes after it and by the difference in
length (at most one) if it comes before; grams anywhere else cannot be the chunk that was preserved, so
they are not written. Words that share such a gram at such a place are joined and verified by edit
distance.

A chunk that very many words share (a hot one) is not joined: its words are cut again.
The rest of the word, in which the edit must lie, gives two chunks once more, and the key
becomes the chunk found first together with one of them; this goes on until a key has few
pairs for each of its rows or the rest is one code point. So no key pairs all its words, and no
pair is lost.

A word's form is its near word of the largest count, if that is ``ratio`` times its own or more; its root is
where the forms end (counts grow by the ratio each step, so this ends), found by pointer doubling.

Defined results: null, empty and letterless texts give no words; a null doc_id counts as empty
text; repeated rows count again; a very long run of letters is one word and is handled whole; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flight_engine.llm.store import release, stage

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Pairs a row of a key may cost before its words are cut again.
PAIRS_A_ROW = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame) -> DataFrame:
    """doc_id and run: each maximal run of letters of each text, A-Z lower-cased."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), 0)).alias("run"))


def planted_deletions(runs: DataFrame, every: int = 199) -> DataFrame:
    """doc_id and run, in which about one run of ``every`` (decided by document and run) lost a letter."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    return runs.select("doc_id", "run", h.alias("h")).select(
        "doc_id", F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("run"))


def word_counts(runs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of the runs that are long and frequent enough."""
    return (runs.where(F.char_length("run") >= min_length).groupBy(F.col("run").alias("word"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _halves(lo: Column, hi: Column) -> Column:
    """The two parts of a range of places; an edit lies in one of them."""
    mid = lo + F.floor((hi - lo) / 2).cast("int")
    return F.explode(F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi"))))


def _outside() -> Column:
    """What a word shares with a partner whose edit lies in [lo, hi): all before and all after it.

    ``size`` is the shorter word's length; the longer one's part after the range starts a place later.
    """
    after = F.col("hi") + F.char_length("word") - F.col("size") + 1
    return F.xxhash64("size", "lo", "hi", F.col("word").substr(F.lit(1), F.col("lo")), F.col("word").substr(after, F.char_length("word")))


def near_pairs(words: DataFrame) -> DataFrame:
    """x, x_n, y, y_n: every two near words of (word, n), once."""
    spark = words.sparkSession
    # a word is the shorter one of a pair by its own length, the longer one by its length less one
    rows = (words.select("word", "n", F.explode(F.array(F.lit(True), F.lit(False))).alias("shorter"))
            .withColumn("size", F.char_length("word") - F.when(F.col("shorter"), 0).otherwise(1))
            .select("*", _halves(F.lit(0), F.col("size")).alias("p")).select("word", "n", "shorter", "size", "p.lo", "p.hi"))
    found = None
    while True:
        keyed = stage(rows.withColumn("key", _outside()), "near-keys")
        short, long = (F.count_if(c).cast("double") for c in (F.col("shorter"), ~F.col("shorter")))
        sizes = keyed.groupBy("key").agg((short * (short - 1) / 2 + short * long).alias("pairs"), F.count(F.lit(1)).alias("rows"),
                                         F.max(F.col("hi") - F.col("lo")).alias("width"))
        hot = (F.col("pairs") > PAIRS_A_ROW * F.col("rows")) & (F.col("width") > 1)
        live = stage(sizes.where("pairs > 0").select("key", hot.alias("hot")), "near-live")
        few = stage(keyed.join(live.where("not hot"), "key").select("key", "word", "n", "shorter"), "near-few")
        a, b = few.where("shorter").alias("a"), few.alias("b")
        pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & (~F.col("b.shorter") | (F.col("a.word") < F.col("b.word")))
                        & (F.levenshtein("a.word", "b.word", 1) == 1))
                 .select(F.col("a.word").alias("x"), F.col("a.n").alias("x_n"), F.col("b.word").alias("y"), F.col("b.n").alias("y_n")))
        pairs = stage(pairs, "near-pairs")
        found = pairs if found is None else found.union(pairs)
        again = live.where("hot")
        if again.isEmpty():
            return found.dropDuplicates(["x", "y"])
        rows = (keyed.join(again.select("key"), "key", "left_semi")
                .select("word", "n", "shorter", "size", _halves(F.col("lo"), F.col("hi")).alias("p"))
                .select("word", "n", "shorter", "size", "p.lo", "p.hi"))
        release(spark)


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: where the forms that start at ``word`` end. Paths double each round."""
    paths = stage(forms.select("word", F.col("form").alias("root")), "near-paths")
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(paths.join(ahead, "root", "left").select("word", "root", "next"), "near-steps")
        if step.where("next is not null").isEmpty():
            return paths
        paths = stage(step.select("word", F.coalesce("next", "root").alias("root")), "near-paths")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of (word, n); words are distinct."""
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "near-words")
    pairs = stage(near_pairs(words), "near-found")
    both = pairs.select(F.col("x").alias("word"), F.col("x_n").alias("n"), F.col("y").alias("other"), F.col("y_n").alias("m")).union(
        pairs.select("y", "y_n", "x", "x_n"))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("other")))
    near = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b"))
    is_form = -F.col("b.m") >= ratio * F.col("n")
    near = stage(near.select("word", "n_near", F.when(is_form, F.col("b.other")).alias("form"),
                             F.when(is_form, -F.col("b.m")).alias("form_n")), "near-forms")
    roots = _roots(near.where("form is not null"))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
