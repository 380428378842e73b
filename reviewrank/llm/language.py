"""Language identification by compression.

Each language has a dictionary of raw text. A text is lower-cased and cut into pieces, every piece is compressed with
zstandard under each dictionary, and the language whose dictionary gives the smallest sum wins. The score
is the winner's lead over the runner-up, and a narrow lead is rejected. Pieces keep the memory of a task
constant and stop a long text from teaching the compressor its own words; all pieces of a text count.

Dictionaries come from a bounded sample: per language, the ``SAMPLE_DOCS`` labelled documents with the
smallest hash of id and text (equal rows count once), ``DICTIONARY_BYTES`` in all, evenly over them.

Defined cases: a null text, or one without a letter, is ``und`` with score zero; rows without a language
teach nothing; without any labelled row every text is ``und``; equal sums, as of very short texts, go to the
language with the most labelled rows, then the first by name, with score zero; repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_DOCS, DICTIONARY_BYTES, PIECE_BYTES, LEVEL = 48, 48_000, 1_024, 9
#: A lead of less than this share of the runner-up's size is narrow.
NARROW = 0.01
UNKNOWN = "und"


def dictionaries(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw-content dictionaries by language, the most frequent first, from ``doc_id, text, lang``.

    Different rows are ranked by a hash of id and text, without the text; the chosen hashes (``sample_docs`` per
    language) are sent to all tasks, so texts are not shuffled. The driver gets the dictionaries only.
    """
    key = F.xxhash64(F.lit("language"), "doc_id", "text").alias("key")
    usable = labelled.where("lang is not null and text is not null").select("lang", key, "text")
    order = Window.partitionBy("lang").orderBy("key")
    ranked = usable.select("lang", "key").distinct().withColumn("rank", F.row_number().over(order))
    chosen = ranked.where(F.col("rank") <= sample_docs)
    frequent = {r["lang"]: r["count"] for r in labelled.where("lang is not null").groupBy("lang").count().collect()}
    part = F.encode(F.substring(F.lower("text"), 1, dictionary_bytes), "UTF-8")
    found = usable.join(F.broadcast(chosen), ["lang", "key"]).select(F.col("lang").alias("of"), "rank", part.alias("part"))
    rows = found.groupBy("of", "rank").agg(F.min("part").alias("part")).collect()  # equal rows once
    by_language: dict[str, list[tuple[int, bytes]]] = {}
    for r in rows:
        by_language.setdefault(r["of"], []).append((r["rank"], bytes(r["part"])))
    order_of = sorted(by_language, key=lambda lang: (-frequent[lang], lang))
    return {lang: _evenly([p for _, p in sorted(by_language[lang])], dictionary_bytes) for lang in order_of}


def _evenly(parts: list[bytes], size: int) -> bytes:
    """At most ``size`` bytes, as much from each part as a common limit allows."""
    left, taken = size, []
    for n, part in enumerate(sorted(parts, key=len)):  # short ones leave their share to longer ones
        taken.append(part[: left // (len(parts) - n)])
        left -= len(taken[-1])
    return b"".join(taken)


def identify(docs: DataFrame, known: dict[str, bytes], piece_bytes: int = PIECE_BYTES, level: int = LEVEL, narrow: float = NARROW) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs`` (``doc_id, text``)."""
    names = list(known)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        def compressor(content: bytes):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

        compress = [compressor(known[n]).compress for n in names]

        def judge(text: str | None) -> tuple[str, float, bool]:
            if not text or not names or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, True
            data = text.lower().encode("utf-8", "surrogatepass")
            pieces = [data[i : i + piece_bytes] for i in range(0, len(data), piece_bytes)]
            sizes = sorted((sum(len(c(p)) for p in pieces), i) for i, c in enumerate(compress))
            lead = (sizes[1][0] - sizes[0][0]) / sizes[1][0] if len(sizes) > 1 else 1.0
            return names[sizes[0][1]], lead, lead < narrow

        for batch in batches:
            found = [judge(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``: the fold of a row. A null key is in fold zero."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % parts, F.lit(0))
