"""Quality rules by distribution divergence.

A document's character classes and common words are histograms; each is compared with the reference of its
language by the Jensen-Shannon distance. The
references are counted over all documents: shares of the classes, and shares of the words that make up
one word in five hundred or more, of which a language has five hundred at most. Short texts are guarded:
a histogram of too few characters or words is not judged. Everything is DataFrame expressions; a text is
judged in its own row, so documents are never shuffled.

Defined cases: a null text has no words and fails the base rule; documents without a
language have a reference of their own; repeated rows are judged one by one; an empty table gives no row;
the input's other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.llm.arrays import BLANK, let, words_of
from reviewrank.session import written

#: Character classes: each pattern counts what the ones before it left; the last class is the rest.
CLASSES = (
    ("lower", r"\p{Ll}+"),
    ("blank", rf"{BLANK}+"),
    ("upper", r"\p{Lu}+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("digit", r"\p{Nd}+"),
    ("mark", r"\p{P}+"),
)
#: A word is common in a language if it is at least this share of its words.
COMMON = 1 / 500
SLOTS = 1024
#: Guards and limits.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
LEAST_CHARS_JUDGED, LEAST_WORDS_JUDGED = 200, 100
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.25, 0.36


def _language() -> Column:
    return F.coalesce(F.col("lang"), F.lit(""))


def class_counts(text: Column) -> Column:
    """Array of the characters of each class; each pattern only reads what is left."""

    def step(left: Column, i: int, counts: list[Column]) -> Column:
        if i == len(CLASSES):
            return F.array(*counts, F.length(left))
        rest = F.regexp_replace(left, CLASSES[i][1], "")
        return let(rest, lambda r: step(r, i + 1, [*counts, F.length(left) - F.length(r)]))

    return step(text, 0, [])


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more.

    Windows are hashed to 64 bits and sorted with their places, so that equal ones are neighbours.
    """
    last = F.size(words) - 3

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        hashed = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.sort_array(F.transform(places, lambda i: F.struct(hashed(i).alias("h"), i.alias("i"))))

    def twice(sorted_windows: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(sorted_windows, k)["h"] == x["h"], F.lit(False))
        return F.filter(sorted_windows, lambda x, k: same(x, k - 1) | same(x, k + 1))

    def covered(found: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        add = lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"))
        return F.aggregate(F.sort_array(F.transform(found, lambda x: x["i"])), start, add, lambda s: s["n"])

    return F.when(last < 1, F.lit(0)).otherwise(let(words, lambda w: let(windows(w), lambda s: covered(twice(s)))))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    worded = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(worded, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``words``, ``classes`` and the base counts, as longs but for the arrays."""
    text = F.coalesce("text", F.lit(""))
    of = {name: i for i, (name, _) in enumerate(CLASSES)}
    count = lambda name: F.get(F.col("classes"), F.lit(of[name]))
    split = docs.select("*", words_of(F.col("text")).alias("words"), class_counts(text).alias("classes"))
    return split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        (F.length(text) - count("blank")).cast("long").alias("word_chars"),
        count("symbol").cast("long").alias("n_symbols"),
        repeated_lines(text).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def references(docs: DataFrame) -> DataFrame:
    """One row per language: ``lang``, class shares, common words by hash slot, and their shares by number.

    Counted over all documents; those that name no language share a reference.
    """
    named = docs.select("text", _language().alias("lang"))
    text = F.coalesce("text", F.lit(""))
    size = len(CLASSES) + 1
    counted = named.select("lang", class_counts(text).alias("c"))
    sums = counted.groupBy("lang").agg(*(F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(size)))
    whole = sum((F.col(f"c{i}") for i in range(1, size)), F.col("c0"))
    shares = F.array(*((F.col(f"c{i}") / whole) for i in range(size)))
    classes = written(sums.where(whole > 0).select("lang", shares.alias("class_shares")), "class-shares")
    each = named.select("lang", F.explode(words_of(F.lower("text"))).alias("word"))
    counts = written(each.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("total")), "word-totals")  # small: no shuffle of words by language
    common = counts.join(totals, "lang").where(F.col("n") >= F.col("total") * COMMON)
    sorted_words = F.sort_array(F.collect_list(F.struct("word", (F.col("n") / F.col("total")).alias("share"))))
    lists = common.groupBy("lang").agg(sorted_words.alias("common"))  # 500 words at most

    def slots(common: Column) -> Column:
        numbered = F.transform(common, lambda x, i: F.struct(x["word"].alias("word"), i.alias("no"), F.pmod(F.xxhash64(x["word"]), F.lit(SLOTS)).alias("slot")))
        return let(numbered, lambda all_: F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.filter(all_, lambda x: x["slot"] == s)))

    joined = classes.join(lists, "lang", "left")
    none = F.array().cast("array<struct<word:string,share:double>>")
    return joined.select("lang", "class_shares", F.coalesce("common", none).alias("common")).select(
        "lang", "class_shares", slots(F.col("common")).alias("slots"), F.transform("common", lambda x: x["share"]).alias("word_shares")
    )


def _term(p: Column, q: Column) -> Column:
    """One cell's part of the Jensen-Shannon divergence, in bits."""
    half = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return (half(p) + half(q)) / 2


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def class_distance(counts: Column, shares: Column) -> Column:
    whole = F.aggregate(counts, F.lit(0), lambda s, x: s + x)
    return let(whole, lambda n: _distance(_total(F.zip_with(counts, shares, lambda c, q: _term(c / n, q)))))


def word_distance(words: Column, slots: Column, shares: Column) -> Column:
    """Distance of the common words' histogram; all other words share one cell.

    Numbers of the common words found are sorted, so that each word's count is the length of a run; common
    words that the text lacks add half their share.
    """

    def number(table: Column, word: Column) -> Column:
        slot = F.get(table, F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int"))
        return F.get(F.transform(F.filter(slot, lambda x: x["word"] == word), lambda x: x["no"]), F.lit(0))

    def judged(numbers: Column, q: Column) -> Column:
        n = F.size(words).cast("double")
        # The state holds the run in progress, the divergence, and the shares of the words seen.
        start = F.struct(F.lit(-1).alias("no"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("seen"))

        def close(s: Column) -> Column:
            return F.when(s["run"] > 0, _term(s["run"] / n, F.get(q, s["no"]))).otherwise(0.0)

        def add(s: Column, no: Column) -> Column:
            same = s["no"] == no
            return F.struct(
                no.alias("no"),
                F.when(same, s["run"] + 1).otherwise(1).alias("run"),
                F.when(same, s["sum"]).otherwise(s["sum"] + close(s)).alias("sum"),
                F.when(same, s["seen"]).otherwise(s["seen"] + F.get(q, no)).alias("seen"),
            )

        def finish(s: Column) -> Column:
            all_common = _total(q)
            rest = _term(1 - F.size(numbers) / n, F.greatest(F.lit(0.0), 1 - all_common))
            return _distance(s["sum"] + close(s) + rest + (all_common - s["seen"]) / 2)

        return F.aggregate(numbers, start, add, finish)

    found = let(slots, lambda t: F.sort_array(F.filter(F.transform(words, lambda w: number(t, F.lower(w))), lambda x: x.isNotNull())))
    return let(found, lambda numbers: let(shares, lambda q: judged(numbers, q)))


def judge(docs: DataFrame) -> DataFrame:
    """For every row: ``doc`` (the row itself), ``doc_id``, the base counts, ``base_failed``, the distances
    (null where the guard forbids to judge) and ``kept``."""
    table = written(references(docs), "references")  # a few kB per language; Spark broadcasts it if small
    rows = measured(docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text", _language().alias("lang")))
    compared = rows.join(table.withColumnRenamed("lang", "ref_lang"), F.col("lang") == F.col("ref_lang"), "left")
    by_class = class_distance(F.col("classes"), F.col("class_shares"))
    by_word = word_distance(F.col("words"), F.col("slots"), F.col("word_shares"))
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    judged = compared.select(
        "doc", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)).alias("base_failed"),
        F.when(F.length("text") >= LEAST_CHARS_JUDGED, by_class).alias("class_distance"),
        F.when(n >= LEAST_WORDS_JUDGED, by_word).alias("word_distance"),
    )
    near = lambda c, most: F.coalesce(F.col(c) <= most, F.lit(True))
    method = near("class_distance", MOST_CLASS_DISTANCE) & near("word_distance", MOST_WORD_DISTANCE)
    return judged.withColumn("kept", ~F.col("base_failed") & method)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    return judge(docs).where("kept").select("doc.*")
