"""Byte-level BPE as a bounded-lookahead streaming transducer, and incremental decoding.

Encoding reads a text in blocks that end where no pre-token can span (one space between two characters
that are no white space), so pre-tokens are stable once read. Short stretches are remembered with their
ids. A pre-token of any length runs through windows: with the merge list's sufficient lookahead L, the
tokens of a window that end L or more bytes before its end can't change whatever follows, so they are
emitted and only the rest is carried on. Memory beside the text and the ids is constant.

The lookahead follows from the merge list. Let two strings share a prefix and differ after it. Merging
rule by rule, the point up to which both have the same tokens moves only when a rule (c, t) joins the
token c before that point with the token t after it in one string but not in the other; it then moves
back by the length of c. The tokens after the point then start with c in both, never become equal again,
and the next rule that moves the point has a higher rank and a right side that has c on its left edge.
So the farthest move is the heaviest chain of rules r1 < r2 < … in which the left side of each one lies
on the left edge of the right side of the next, weighed by the left sides' lengths; ``lookahead`` finds
it in one pass over the merges.

Defined cases: a null text is encoded as an empty one; the special token's text becomes its id, as the
tokenizers library does by default; invalid bytes of an id sequence that is cut inside a character
decode to U+FFFD; repeated rows are encoded one by one; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from reviewrank.session import shipped

#: Characters of a block. Words and pre-tokens remembered with their ids, and their most characters.
BLOCK, REMEMBERED, LONGEST_REMEMBERED = 1 << 16, 1 << 19, 24


#: Fixed pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {chr(b if b in printable else next(rest)): b for b in range(256)}


def vocabulary_of(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of all byte strings, and of the special tokens, of a file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in specials}, specials


def ids_follow_merges(path: str) -> bool:
    """Whether each merge gives a token of its own and ids rise with the merges, as tiktoken takes them to."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    return all(a < b for a, b in zip(ids, ids[1:]))


def transducer(vocabulary: str, byte_alphabet: dict[str, int], pattern: str = PATTERN) -> tuple[Callable, Callable, int]:
    """``encode(text)`` yields bytes of little-endian 32-bit ids; ``decoder()`` returns ``feed(ids, last)``
    from such bytes to text; and the merge list's sufficient lookahead in bytes.

    ``vocabulary`` is the path of a tokenizer file in the JSON format of the tokenizers library, with
    ``byte_alphabet()``. All parts are nested here, so that Spark ships them by value.
    """
    import codecs
    import heapq
    import json
    import struct

    import regex

    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    raw = {t: bytes(byte_alphabet[c] for c in t) for t in spec["model"]["vocab"] if t not in specials}
    id_of = {raw[t]: i for t, i in spec["model"]["vocab"].items() if t in raw}
    bytes_of = [b""] * (1 + max([*id_of.values(), *specials.values()]))
    for t, i in [*id_of.items(), *((s.encode(), i) for s, i in specials.items())]:
        bytes_of[i] = t
    merges = [tuple(raw[x] for x in (m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
    ranks = {(id_of[a], id_of[b]): rank for rank, (a, b) in enumerate(merges)}
    joined = [id_of[a + b] for a, b in merges]
    none = len(merges)

    def lookahead() -> int:
        heaviest: dict[bytes, int] = {}  # by left side, over the rules so far
        left_part: dict[bytes, bytes] = {}
        most = 0
        for a, b in merges:
            edge, before = b, 0
            while edge:
                before = max(before, heaviest.get(edge, 0))
                edge = left_part.get(edge, b"")
            reach = len(a) + before
            heaviest[a] = max(heaviest.get(a, 0), reach)
            left_part[a + b] = a
            most = max(most, reach)
        return most

    reach = lookahead()
    single = [id_of[bytes([b])] for b in range(256)]

    def merged(data: bytes) -> list[int]:
        """Ids of a short stretch: the lowest rule first, the leftmost of equals."""
        ids = [single[b] for b in data]
        rank = [ranks.get(pair, none) for pair in zip(ids, ids[1:])]
        while rank and (least := min(rank)) < none:
            i = rank.index(least)
            ids[i : i + 2] = (joined[least],)
            del rank[i]
            if i:
                rank[i - 1] = ranks.get((ids[i - 1], ids[i]), none)
            if i < len(rank):
                rank[i] = ranks.get((ids[i], ids[i + 1]), none)
        return ids

    def merged_long(data: bytes) -> list[int]:
        """The same over a linked list and a heap."""
        ids = [single[b] for b in data]
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i) for i, pair in enumerate(zip(ids, ids[1:])) if (r := ranks.get(pair, none)) < none]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] < 0 or ranks.get((ids[i], ids[j]), none) != rank:
                continue  # one of the two has been joined meanwhile
            ids[i], ids[j], after[i] = joined[rank], -1, after[j]
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := ranks.get((ids[left], ids[right]), none)) < none:
                    heapq.heappush(heap, (r, left))
            if after[i] < n:
                before[after[i]] = i
        return [x for x in ids if x >= 0]

    window = 2 * max(reach, 16)

    def token_stream(data: bytes) -> Iterator[int]:
        """Ids of one pre-token, emitted once they are stable."""
        start = 0
        while len(data) - start > 2 * window:
            stable, end = start, start + 2 * window
            for token in merged_long(data[start:end]):
                stop = stable + len(bytes_of[token])
                if stop > end - reach:
                    break
                yield token
                stable = stop
            start = stable
        yield from (merged if len(data) - start <= 100 else merged_long)(data[start:])

    pretoken = regex.compile(pattern)
    space = regex.compile(r"\s")

    def pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    class Pretokens(dict):
        """Packed ids by pre-token."""

        def __missing__(self, text: str) -> bytes:
            packed = pack([*token_stream(text.encode("utf-8", "surrogatepass"))])
            if len(text) <= LONGEST_REMEMBERED:
                if len(self) >= REMEMBERED:
                    self.clear()
                self[text] = packed
            return packed

    pretokens = Pretokens()

    def stretch(text: str, start: int, end: int) -> Iterator[bytes]:
        """Packed ids of what lies between two safe cuts, pre-token by pre-token."""
        for found in pretoken.finditer(text, start, end):
            yield pretokens[found[0]]

    class Words(dict):
        """Packed ids by what stands between a space and the next one, with no other white space at its ends."""

        def __missing__(self, word: str) -> bytes:
            packed = b"".join(map(pretokens.__getitem__, pretoken.findall(" " + word)))
            if len(word) <= LONGEST_REMEMBERED:
                if len(self) >= REMEMBERED:
                    self.clear()
                self[word] = packed
            return packed

    remembered = Words()

    def safe_cut(text: str, start: int, end: int) -> int:
        """Place of the last space up to ``end`` with no white space beside it, or -1."""
        at = text.rfind(" ", start + 1, end)
        while at > 0 and (at + 1 >= len(text) or text[at + 1].isspace() or text[at - 1].isspace()):
            at = text.rfind(" ", start + 1, at)
        return at

    def plain(text: str) -> Iterator[bytes]:
        """Packed ids of a text without special tokens, block by block."""
        start, end = 0, len(text)
        while start < end:
            stop, reading = end, BLOCK
            while start + reading < end and (stop := safe_cut(text, start, start + reading)) < 0:
                reading *= 2
                stop = end
            if stop - start <= 2 * BLOCK:
                block = text[start:stop]  # starts with a space, but for the first block
                words = block.split(" ")
                if all(w and not w[0].isspace() and not w[-1].isspace() for w in words[bool(start) :]) and words[0][-1:].strip() == words[0][-1:]:
                    yield b"".join(map(pretokens.__getitem__, pretoken.findall(words[0])))
                    yield b"".join(map(remembered.__getitem__, words[1:]))
                    start = stop
                    continue
            yield from stretch(text, start, stop)  # irregular white space, or no safe cut for long
            start = stop

    parting = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")

    def encode(text: str) -> Iterator[bytes]:
        at = 0
        for found in parting.finditer(text):
            yield from plain(text[at : found.start()])
            yield struct.pack("<I", specials[found[0]])
            at = found.end()
        yield from plain(text[at:] if at else text)

    def decoder() -> Callable[[bytes, bool], str]:
        state = codecs.getincrementaldecoder("utf-8")("replace")  # holds the bytes of an unfinished character

        def feed(packed: bytes, last: bool = False) -> str:
            ids = struct.unpack(f"<{len(packed) // 4}I", packed)
            return state.decode(b"".join(map(bytes_of.__getitem__, ids)), last)

        return feed

    return encode, decoder, reach


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids``: packed little-endian 32-bit ids of every text."""

    build, alphabet = shipped(transducer), byte_alphabet()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode, _, _ = build(vocabulary, alphabet)
        for batch in batches:
            ids = [b"".join(encode(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""

    build, alphabet = shipped(transducer), byte_alphabet()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, decoder, _ = build(vocabulary, alphabet)
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                feed, step = decoder(), 4 * BLOCK
                parts = [feed(ids[i : i + step], i + step >= len(ids)) for i in range(0, len(ids or b""), step)]
                texts.append("".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, digested block by block as ids are emitted."""

    build, alphabet = shipped(transducer), byte_alphabet()

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        encode, decoder, _ = build(vocabulary, alphabet)
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for text in batch.column("text").to_pylist():
                ids, decoded, feed, n = hashlib.sha256(), hashlib.sha256(), decoder(), 0
                for packed in encode(text or ""):
                    n += len(packed) // 4
                    ids.update(packed)
                    decoded.update(feed(packed, False).encode())
                decoded.update(feed(b"", True).encode())
                counts.append(n)
                ids_hex.append(ids.hexdigest())
                text_hex.append(decoded.hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
