"""How far sources of one language differ in their words: exact, from sparse document vectors.

A document's sparse vector is its different terms and their counts. Terms are led by their language, so that one
``CountVectorizer`` with a least document frequency and the largest integer as vocabulary size serves all languages in
one fit. Only document frequencies decide it, and none above the least one matters: so a task hands on lists of
different terms in which a term stands as often as it has documents there, but not more often than the least document
frequency. A term is in that many lists exactly if it is in that many documents, however texts lie in tasks.
The vectors are summed per (language, source) as ``Summarizer`` does, with partial sums in the task that makes them, but
as long integers and only where a count is not 0; of the sums, the vocabulary's terms stay. Turning terms into
the vectorizer's indices and back would read every token once more (README has the figures).

``CountVectorizer`` holds its vocabulary on the driver and sends it to all tasks. A kept term stands in
``LEAST_DOCUMENTS`` or more of the lists, whose length thus bounds the number of kept terms; where that bound is
above ``MOST_TERMS``, the number of all different terms is estimated. If that is above it too, the same
counts come from grouped tables, and nothing of the vocabulary is collected.

Defined cases: null text, language and source are ''. A group without terms has counts of 0 throughout; a
language without kept terms has pairs of value 0 and no terms. Repeated rows count each. Further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewrank.session import written

#: On UTF-8: ASCII letters, lower-cased, and all bytes of other characters stand in terms; the rest parts them.
IN_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Parts a language from its term; no term holds it.
MARK = "\x01"
LEAST_DOCUMENTS = 30
LARGEST_VOCABULARY = 2**31 - 1
#: Different terms, kept or not, up to which the vocabulary may pass through the driver.
MOST_TERMS = 5_000_000
#: Words and texts summed by a task at a time, bytes of text split at a time, rows handed to Python, and terms in a row.
WORDS_AT_ONCE, TEXT_AT_ONCE, ROWS_AT_ONCE, TERMS_IN_ROW = 3_000_000, 4 << 20, 1_000, 20_000
SCALE, SMOOTHING, TERM_RANKS = 1_000_000_000, 5, 50


def led_terms(clean: DataFrame, least_documents: int = LEAST_DOCUMENTS, words_at_once: int = WORDS_AT_ONCE) -> DataFrame:
    """``lang, source, terms, counts``: the different terms of the texts (``text, lang, source``) of a task, lower-cased
    in A-Z only and led by their language, and how often each occurs; and, with neither, ``once``: lists of led terms,
    each once in a list and in as many lists as it has documents, up to ``least_documents``."""
    in_term, mark, at_once, text_at_once, most = IN_TERM, MARK.encode(), words_at_once, TEXT_AT_ONCE, TERMS_IN_ROW

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        low, listed = np.int64(0xFFFFFFFF), pa.list_(pa.string())

        class Numbers(dict):
            def __missing__(self, value) -> int:
                self[value] = number = len(self)
                return number

        groups, langs, known = Numbers(), Numbers(), Numbers()  # (lang, source), lang and term of the texts since the last row
        words, pairs, size = [], [], 0

        def parts(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
            """Stretches of texts with all that is in no term turned into spaces, and where they begin."""
            column = column.cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], "i8")[column.offset : column.offset + len(column) + 1]
            start = 0
            while start < len(column):
                end = max(start + 1, int(np.searchsorted(ends, ends[start] + text_at_once, "right")) - 1)
                data = bytes(memoryview(column.buffers()[2] or b"")[ends[start] : ends[end]]).translate(in_term)
                places = pa.py_buffer((ends[start : end + 1] - ends[start]).astype("i8"))
                yield start, pa.LargeStringArray.from_buffers(end - start, places, pa.py_buffer(data))
                start = end

        def rows(keys: np.ndarray, leads: list[bytes], terms: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
            """Of sorted keys (group and term): each row's group, its ends, and all led terms. All groups have a row."""
            of, n = keys >> 32, len(leads)
            starts = np.searchsorted(of, np.arange(n))
            more = np.setdiff1d(np.arange(0, len(keys), most), starts)
            place, group = np.concatenate([starts, more]), np.concatenate([np.arange(n), of[more]])
            order = np.lexsort((group, place))
            led = pc.binary_join_element_wise(pa.array(leads, pa.binary()).take(pa.array(of)), terms.take(pa.array(keys & low)), pa.scalar(b"", pa.binary()))
            return group[order], pa.array(np.append(place[order], len(keys)).astype("i4")), led.cast(pa.string())

        def table(own: list, sources: list, terms: pa.Array | None, counts: pa.Array | None, once: pa.Array | None) -> pa.RecordBatch:
            none = lambda kind: pa.nulls(len(own), kind)
            lists = [terms or none(listed), counts or none(pa.list_(pa.int64())), once or none(listed)]
            strings = [pa.array(c, pa.binary()).cast(pa.string()) for c in (own, sources)]
            return pa.RecordBatch.from_arrays([*strings, *lists], ["lang", "source", "terms", "counts", "once"])

        def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The different keys in order and how often each occurs; the keys are sorted where they lie."""
            keys.sort()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
            return keys[starts], np.diff(starts, append=len(keys))

        def summed() -> Iterator[pa.RecordBatch]:
            keys, n = counted(np.concatenate(words))
            words.clear()
            names, terms = [*groups], pa.array([*known], pa.binary())
            group, ends, led = rows(keys, [lang + mark for lang, _ in names], terms)
            lists = pa.ListArray.from_arrays(ends, led), pa.ListArray.from_arrays(ends, pa.array(n.astype("i8")))
            yield table([names[g][0] for g in group], [names[g][1] for g in group], *lists, None)
            keys, n = counted(np.concatenate(pairs))
            pairs.clear()
            names = [*langs]
            for least in range(min(least_documents, int(n.max(initial=0)))):
                group, ends, led = rows(keys[n > least], [lang + mark for lang in names], terms)
                yield table([names[g] for g in group], [None] * len(group), None, None, pa.ListArray.from_arrays(ends, led))

        for batch in batches:
            own, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
            for start, texts in parts(batch.column("text")):
                end = start + len(texts)
                group = np.fromiter((groups[g] for g in zip(own[start:end], sources[start:end])), "i8", len(texts))
                lang = np.fromiter((langs[x] for x in own[start:end]), "i8", len(texts))
                split = pc.ascii_split_whitespace(texts)
                doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
                found = split.flatten()
                real = pc.not_equal(found, "")
                found, doc = found.filter(real).cast(pa.large_binary()).dictionary_encode(), doc[real.to_numpy(zero_copy_only=False)]
                numbers = np.fromiter(map(known.__getitem__, found.dictionary.to_pylist()), "i8", len(found.dictionary))
                term = numbers[found.indices.to_numpy()]
                pair = counted(doc << 32 | term)[0]
                words.append(group[doc] << 32 | term)
                pairs.append(lang[pair >> 32] << 32 | pair & low)
                size += len(term) + len(texts)
                if size >= at_once:
                    yield from summed()
                    size = 0
                    for names in (groups, langs, known):
                        names.clear()
        if size:
            yield from summed()

    raw = clean.select(*[F.col(c).cast("binary").alias(c) for c in ("text", "lang", "source")])
    return raw.mapInArrow(run, "lang string, source string, terms array<string>, counts array<bigint>, once array<string>")


def _split(term: Column) -> list[Column]:
    """Language and term; the mark may also stand inside a language, so the last one counts."""
    return [
        F.regexp_replace(term, rf"(?s){MARK}[^{MARK}]*\z", "").alias("lang"),
        F.substring_index(term, MARK, -1).alias("term"),
    ]


def vocabulary_by_vectorizer(vectors: DataFrame, least_documents: int) -> DataFrame:
    """The kept led terms, as ``t``."""
    counter = CountVectorizer(inputCol="once", outputCol="vector", minDF=float(least_documents), vocabSize=LARGEST_VOCABULARY)
    model = counter.fit(vectors.where("once is not null").select("once"))
    return vectors.sparkSession.createDataFrame([(t,) for t in model.vocabulary], "t string")


def vocabulary_by_table(vectors: DataFrame, least_documents: int) -> DataFrame:
    """The same by grouping alone, for a vocabulary of any size; terms of a task are combined before they are shuffled."""
    once = vectors.select(F.explode("once").alias("t")).groupBy("t").agg(F.count("*").alias("documents"))
    return once.where(F.col("documents") >= least_documents).select("t")


def group_sums(vectors: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, term, n`` of the kept terms, where n > 0."""
    cells = vectors.select("source", F.inline(F.arrays_zip(F.col("terms").alias("t"), F.col("counts").alias("n"))))
    sums = cells.groupBy("source", "t").agg(F.sum("n").alias("n"))
    lang, term = _split(F.col("t"))
    return sums.join(kept, "t").select(lang, "source", term, "n")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term in parts of ``SCALE``; decimals, as the product outgrows 64 bits."""
    wide = (n + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", wide, (total + kept * SMOOTHING).cast("decimal(20,0)"))
    return whole + 1


def _ranked(table: DataFrame, part: str) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return table.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long"), F.row_number().over(best).alias("rank"))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = MOST_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: per group all other sources of its language by distance
    (part ``pair``), and the 50 terms it has most above its language (part ``term``).

    The distance of two sources is summed over the terms that either has; a term that neither has adds the
    same difference each time. Differences to the other's empty share need only how many terms of a
    source have each count, not the terms.
    """
    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    vectors = written(led_terms(clean, least_documents), "term-vectors", ROWS_AT_ONCE)
    most = (vectors.where("once is not null").agg(F.sum(F.size("once"))).first()[0] or 0) // least_documents
    if most > most_terms:
        most = vectors.select(F.explode("once").alias("t")).agg(F.approx_count_distinct("t")).first()[0]
    vocabulary = vocabulary_by_vectorizer if most <= most_terms else vocabulary_by_table
    led = written(vocabulary(vectors, least_documents), "kept-terms")
    counts = written(group_sums(vectors, led), "term-counts")
    kept = led.select(*_split(F.col("t")))

    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    groups = written(
        vectors.where("source is not null").select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "present", "v")])
        .withColumn("empty", F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("v")))),
        "source-groups",
    )
    shares = written(
        counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "empty", _share(F.col("n"), F.col("total"), F.col("v")).alias("p")),
        "term-shares",
    )
    return _ranked(_pairs(groups, shares), "pair").unionByName(_ranked(_terms(counts, groups, shares), "term").where(F.col("rank") <= TERM_RANKS))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The value of each ordered pair of sources of a language, in the terms of its empty shares:

    V |za - zb| + A(a, b) + A(b, a) + the correction of the terms that both have, where
    A(a, b) sums |pa - zb| - |za - zb| over the terms of a.
    """
    own, other = groups.select("lang", "source", "v", F.col("empty").alias("za")), groups.select("lang", F.col("source").alias("item"), F.col("empty").alias("zb"))
    pairs = own.join(other, "lang").where("source <> item")
    levels = shares.groupBy("lang", "source", "empty", "p").agg(F.count("*").alias("terms"))
    apart = (
        levels.withColumnRenamed("empty", "za").join(other, "lang").where("source <> item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.expr("terms * (abs(p - zb) - abs(za - zb))")).alias("one_way"))
    )
    twin = shares.select("lang", "term", F.col("source").alias("item"), F.col("empty").alias("zb"), F.col("p").alias("pb"))
    shared = (
        shares.withColumnRenamed("empty", "za").join(twin, ["lang", "term"]).where("source < item")
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.expr("abs(p - pb) - abs(p - zb) - abs(pb - za) + abs(za - zb)")).alias("part"))
    )
    turned = lambda t: t.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "part")
    base = pairs.select("lang", "source", "item", F.coalesce(F.expr("v * abs(za - zb)"), F.lit(0)).alias("part"))
    one_way = apart.select("lang", "source", "item", F.col("one_way").alias("part"))
    parts = base
    for more in (one_way, turned(one_way), shared, turned(shared)):
        parts = parts.unionByName(more)
    return parts.groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))


def _terms(counts: DataFrame, groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Terms of a group whose share is above the language's."""
    by_lang = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(by_lang, "lang")
    q = whole.select("lang", "term", _share(F.col("n"), F.col("total"), F.col("v")).alias("q"))
    return shares.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
