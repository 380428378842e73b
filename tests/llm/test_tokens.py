"""Streaming BPE against the tokenizers library, and packing."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewrank.llm.bpe import byte_alphabet, decode_ids, encode_texts, round_trip_digests, transducer
from reviewrank.llm.packing import best_fit, complete, lower_bound, packed_documents

from .cases import ODD, docs, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODE, DECODER, REACH = transducer(PATH, byte_alphabet())


def ids(text: str) -> list[int]:
    packed = b"".join(ENCODE(text))
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r'stdmlvre019.,!-é日\u0085 \x1c​"), st.characters(codec="utf-8")), max_size=60))
def test_encodes_as_the_library(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 9_000, "ab" * 9_000, "é" * 8_000, "=" * 9_000, " " * 9_000, " \n" * 9_000, "the " * 40_000, "x<|endoftext|> y", "".join(words(1, 9_000))])
def test_long_and_special_stretches(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_lookahead_is_sufficient():
    """Tokens that end a lookahead before the end of a prefix are those of the whole."""
    rng = random.Random(3)
    for alphabet in ("ab", "etaoinshr", "=-", "ÃÂ"):
        whole = "".join(rng.choice(alphabet) for _ in range(3 * REACH))
        cut = 2 * REACH // len(alphabet[0].encode())
        full, part = (LIBRARY.encode(t, add_special_tokens=False) for t in (whole, whole[:cut]))
        stable = [t for t, (_, end) in zip(part.ids, part.offsets) if len(whole[end:cut].encode()) >= REACH]
        assert stable and full.ids[: len(stable)] == stable


def test_decoding_is_incremental():
    packed = b"".join(ENCODE("naïve 日本語 🎉"))
    feed = DECODER()
    assert "".join(feed(packed[i : i + 4], False) for i in range(0, len(packed), 4)) + feed(b"", True) == "naïve 日本語 🎉"
    cut = LIBRARY.encode("日", add_special_tokens=False).ids[:1]
    assert DECODER()(struct.pack("<I", *cut), True) == LIBRARY.decode(cut, skip_special_tokens=False)


def test_round_trip_of_documents(spark):
    table = docs(spark, ODD)
    back = {r["doc_id"]: r["text"] for r in decode_ids(encode_texts(table, PATH), PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    counts = {r["doc_id"]: r["n_tokens"] for r in round_trip_digests(table, PATH).collect()}
    assert counts == {i: len(LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(ODD)}
    assert round_trip_digests(docs(spark, []), PATH).collect() == []


@pytest.mark.parametrize("lengths", [[], [5], [2048, 2047, 1, 1], [600] * 30, [random.Random(1).randint(1, 2048) for _ in range(400)], [700, 680, 668] * 50, [1024] * 7 + [3] * 5])
def test_bin_completion(lengths):
    counts = Counter(lengths)
    found = complete(counts, 2048)
    dealt = Counter()
    for pattern, times in found:
        assert sum(x * n for x, n in pattern.items()) <= 2048 and times > 0
        for x, n in pattern.items():
            dealt[x] += n * times
    used = sum(t for _, t in found)
    assert dealt == counts
    assert lower_bound(counts, 2048) <= used <= sum(t for _, t in best_fit(counts, 2048))


def test_bin_completion_is_optimal_on_small_inputs():
    def fewest(items, bins):
        if not items:
            return len(bins)
        x, best = items[0], fewest(items[1:], [*bins, 20 - items[0]])
        for i, room in enumerate(bins):
            if room >= x and room not in bins[:i]:
                best = min(best, fewest(items[1:], [*bins[:i], room - x, *bins[i + 1 :]]))
        return best

    rng = random.Random(8)
    for _ in range(60):
        items = sorted((rng.randint(1, 14) for _ in range(8)), reverse=True)
        assert sum(t for _, t in complete(Counter(items), 20)) == fewest(items, [])


def test_packed_documents(spark):
    texts = [*ODD, *[" ".join(words(i, 100 + 40 * i)) for i in range(60)], "same same"]
    table = docs(spark, texts)
    table = table.unionByName(table.where("doc_id = 4"))  # a repeated row
    rows = packed_documents(table, PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):
        expected = LIBRARY.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert len(own) == -(-len(expected) // 2048) * (1 + (i == 4))
        for r in own:
            part = expected[r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packed_documents(docs(spark, []), PATH).collect() == []


def test_long_white_space_and_text_ids(spark):
    """A run of blanks that ends the fast encoder's stack; ids of documents that are no numbers."""
    texts = ["a" + " " * 1_500_000 + "b", " \n" * 80_000, "plain words"]
    table = docs(spark, texts).selectExpr("concat('d', doc_id) AS doc_id", "text")
    got = defaultdict(list)
    for r in packed_documents(table, PATH).collect():
        got[r["doc_id"]].append(r)
    for i, text in enumerate(texts):
        whole = [*LIBRARY.encode(text, add_special_tokens=False).ids, 0]
        for r in got[f"d{i}"]:
            piece = whole[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)) == r["ids_crc32"]
        assert sum(r["length"] for r in got[f"d{i}"]) == len(whole)


def test_a_vocabulary_out_of_order_is_refused(spark, tmp_path):
    import json

    spec = json.loads(open(PATH, encoding="utf-8").read())
    spec["model"]["merges"][:2] = spec["model"]["merges"][1::-1]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="do not follow"):
        packed_documents(docs(spark, ["a"]), str(tmp_path / "v.json"))
