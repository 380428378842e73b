"""Secret scan: patterns, and character Markov models for strings that no pattern names.

Two first-order models over the characters of tokens, one of random strings and one of ordinary
identifiers, are trained from labelled samples: the values found by the patterns are random strings, other
tokens in the form of words and identifiers are ordinary. A token that no pattern covers is a secret if the log-likelihood ratio
says so with a margin, in total and per character. Everything is DataFrame expressions; spans are code
points, end exclusive, and cover the whole match.

Places of matches follow from the lengths of matches and of the pieces between them, so a text is read
by each pattern only if a cheap test has found a trace of it.

Defined cases: a null text is empty and has no span; repeated rows are scanned one by one; matches are
found in whole texts of any length; an empty corpus gives models that know only their uniform prior.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.llm.arrays import drawn, let

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
KINDS = ("assign", "access", "hex", "markov")
SPANS = "array<struct<start:int,kind_no:int,end:int>>"
#: Documents of the training sample at most (about; chosen by the hash of doc_id).
SAMPLE_DOCS = 20_000
#: Form of the training sample's ordinary identifiers: words of one case, capitalised, camel case, joined.
IDENTIFIER = r"^(?:[A-Za-z]?[a-z]++(?:[_-]?[A-Z][a-z]++|[_-][a-z]++)*|[A-Z]+)$"
#: Weight of a character's own frequency against that of its transitions.
SMOOTHING = 20.0
#: A token is random if the ratio in natural logarithms reaches both, in total and per transition.
LEAST_TOTAL, LEAST_MEAN = 8.0, 0.35


class Models(NamedTuple):
    """``ratio[i * len(ALPHABET) + j]``: log P(j after i) if random, less the same if ordinary."""

    ratio: list[float]


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of all matches whose ``group`` has ``least`` or more characters."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)  # as many as matches, and one
    value_lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda m: F.length(m))

    def placed(found: Column) -> Column:
        # Each step adds the piece before a match and the match itself to where the last one ended.
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

        def add(state: Column, m: Column) -> Column:
            start = state["at"] + m["gap"]
            end = start + m["size"]
            one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind_no"), end.alias("end")))
            kept = F.when(m["value"] >= least, F.concat(state["spans"], one)).otherwise(state["spans"])
            return F.struct(end.alias("at"), kept.alias("spans"))

        return F.aggregate(found, zero, add, lambda s: s["spans"])

    zipped = F.zip_with(
        F.zip_with(F.transform(pieces, lambda p: F.length(p)), F.transform(matches, lambda m: F.length(m)), lambda g, s: F.struct(g.alias("gap"), s.alias("size"))),
        value_lengths,
        lambda x, v: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), v.alias("value")),
    )
    return placed(F.filter(zipped, lambda m: m["size"].isNotNull()))


def _none() -> Column:
    return F.array().cast(SPANS)


def base_spans(text: Column) -> Column:
    """Spans of the patterns, by start, then kind."""
    folded = F.lower(text)
    named = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        named = named | folded.contains(word)
    assign = F.when(named, _spans(text, ASSIGN, 0, 2, ASSIGN_LEAST)).otherwise(_none())
    access = F.when(text.contains("AKIA"), _spans(text, ACCESS, 1)).otherwise(_none())
    hexes = F.when(text.rlike(HEX), _spans(text, HEX, 2)).otherwise(_none())
    return F.array_sort(F.concat(assign, access, hexes))


def token_spans(text: Column) -> Column:
    return F.when(text.rlike(TOKEN), _spans(text, TOKEN, 3)).otherwise(_none())


def _outside(spans: Column, taken: Column) -> Column:
    """Spans that share no character with those taken."""
    return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Models:
    """Both models from a bounded sample of documents, chosen by hash; what the driver gets are the counts
    of character pairs."""
    rows = docs.agg(F.count("*")).first()[0]
    picked = drawn(sample_docs, rows, F.lit("secrets"), "doc_id")
    text = F.coalesce("text", F.lit(""))
    found = docs.where(picked).select(text.alias("text")).select("text", base_spans(F.col("text")).alias("base"))
    cut = lambda s: F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])
    value = lambda m: F.regexp_replace(m, r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "")
    random = F.transform("base", lambda s: value(cut(s)))
    plain = F.filter(F.transform(_outside(token_spans_of_length(F.col("text"), 6), F.col("base")), cut), lambda t: t.rlike(IDENTIFIER))
    tokens = found.select(
        F.explode(
            F.concat(
                F.transform(random, lambda t: F.struct(F.lit(1).alias("random"), t.alias("token"))),
                F.transform(plain, lambda t: F.struct(F.lit(0).alias("random"), t.alias("token"))),
            )
        ).alias("t")
    ).groupBy("t.random", "t.token").agg(F.count("*").alias("n"))
    at = F.explode(F.sequence(F.lit(1), F.length("token") - 1))
    pairs = tokens.where("length(token) > 1").select("random", "n", "token", at.alias("at"))
    pair = F.substring(F.col("token"), F.col("at"), F.lit(2))
    counts = pairs.groupBy("random", pair.alias("pair")).agg(F.sum("n").alias("n")).collect()
    return _ratios({(r["random"], r["pair"]): r["n"] for r in counts})


def token_spans_of_length(text: Column, least: int) -> Column:
    return _spans(text, rf"[A-Za-z0-9+/_=-]{{{least},}}", 3)


def _ratios(counts: dict[tuple[int, str], int]) -> Models:
    """Transitions are smoothed by each model's own characters, and those by a uniform prior."""
    size, table = len(ALPHABET), []
    from_sum = {(r, a): sum(counts.get((r, a + b), 0) for b in ALPHABET) for r in (0, 1) for a in ALPHABET}
    to_sum = {(r, b): sum(counts.get((r, a + b), 0) for a in ALPHABET) for r in (0, 1) for b in ALPHABET}
    whole = [sum(to_sum[r, b] for b in ALPHABET) for r in (0, 1)]

    def log(r: int, a: str, b: str) -> float:
        alone = (to_sum[r, b] + 0.5) / (whole[r] + 0.5 * size)
        return math.log((counts.get((r, a + b), 0) + SMOOTHING * alone) / (from_sum[r, a] + SMOOTHING))

    for a in ALPHABET:
        table += [log(1, a, b) - log(0, a, b) for b in ALPHABET]
    return Models(table)


def _mean_and_total(token: Column, models: Models) -> Column:
    """Struct of the log-likelihood ratio's total and mean over a token's transitions."""
    ratio = F.from_json(F.lit(json.dumps(models.ratio)), "array<double>")
    size = len(ALPHABET)
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    known = F.filter(places, lambda p: p >= 0)

    def total(p: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(p) - 1)
        return F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.get(ratio, F.get(p, i - 1) * size + F.get(p, i)))

    return let(known, lambda p: let(total(p), lambda x: F.struct(x.alias("total"), (x / (F.size(p) - 1)).alias("mean"))))


def markov_spans(text: Column, base: Column, models: Models, least_total: float = LEAST_TOTAL, least_mean: float = LEAST_MEAN) -> Column:
    """Spans of tokens outside the base spans that the models call random."""

    def random(span: Column) -> Column:
        token = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        return let(_mean_and_total(token, models), lambda r: (r["total"] >= least_total) & (r["mean"] >= least_mean))

    return F.filter(_outside(token_spans(text), base), random)


def scan(docs: DataFrame, models: Models) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (all): arrays of start, kind number and end."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("base_spans", base_spans(text)).withColumn(
        "spans", F.array_sort(F.concat("base_spans", markov_spans(text, F.col("base_spans"), models)))
    )


def as_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind_no"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark; spans are by start."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], kept, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, zero, add, rest)).otherwise(text)


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; ``n_chars`` follows where there is one.

    Models are trained on these documents. Other columns are kept, whatever their names.
    """
    row = docs.select(F.struct(*docs.columns).alias("row"), "text")
    spans = scan(row, train(docs)).withColumn("clean", redact(F.col("text"), F.col("spans"), mark))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars"))
        new["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return spans.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
