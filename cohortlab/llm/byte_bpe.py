"""Byte-level BPE encoding and decoding as a reduction over a tree.

Encodings of neighbouring stretches are combined by an associative join, so a
text is encoded in halves, recursively, at two levels:

* **text into matches** of the pre-tokeniser pattern.  Halves are matched on
  their own; where they meet, the matches of the left half whose end the
  pattern could have looked past are matched again together with a growing
  number of matches of the right half.  Matching goes from left to right
  without looking back, so as soon as a new match ends where a match of the
  right half began, everything after it stands.
* **bytes of a match into tokens**, from single bytes upwards.  Where two
  token sequences meet, a window around the border is encoded anew; it starts
  with one token a side and doubles on the side where the tokens still change.

A window is finished when its first and last token stay apart from the tokens
outside.  That proves the whole: merges go by rank, lowest first, so up to the
first merge across a border the tokens at its two sides go through the very
merges they go through alone.  If no two neighbours merge when they are
encoded together, no such first merge exists, and the sequence is the encoding
of all its bytes.  Decoding is a homomorphism: bytes of halves, concatenated.

The cost of a long match is n log n, not n squared as with rescans.  Documents
are the unit of work; a Python worker holds one Arrow batch of them, the
vocabulary and two bounded memos of distinct matches and token pairs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, show

#: Texts of at most so many characters are matched in one go.
LEAF_CHARS = 1024
#: Ids of at most so many tokens are decoded in one go.
LEAF_TOKENS = 4096
#: Entries of a worker's memos; a full memo starts anew.
MEMO = 400_000
#: Matches longer than this are not kept in a memo.
MEMO_CHARS = 64
#: Windows of at most so many bytes are merged by scanning.
SHORT_BYTES = 48
#: Last code points of ASCII, Latin-1 and Unicode: a class cut to the code
#: points that a text can have is the same class on that text, and faster.
LAST = (0x7F, 0xFF, sys.maxunicode)

#: Letters and numbers that Unicode 16 added to Unicode 15.1.
UNICODE_16_LETTERS = "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 1E5D0-1E5ED 1E5F0"
UNICODE_16_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
#: The Unicode property White_Space.
WHITE_SPACE = "9-D 20 85 A0 1680 2000-200A 2028-2029 202F 205F 3000"


def _ranges(listed: str) -> list[tuple[int, int]]:
    return [(int(r.split("-")[0], 16), int(r.split("-")[-1], 16)) for r in listed.split()]


def _points(kind: str, added: str) -> list[tuple[int, int]]:
    """Ranges of the code points of a general category and added ones."""
    points = {cp for cp in range(sys.maxunicode + 1) if unicodedata.category(chr(cp))[0] == kind}
    points.update(cp for a, b in _ranges(added) for cp in range(a, b + 1))
    firsts = sorted(cp for cp in points if cp - 1 not in points)
    return list(zip(firsts, sorted(cp for cp in points if cp + 1 not in points)))


@lru_cache(maxsize=1)
def unicode_classes() -> dict[str, list[tuple[int, int]]]:
    """Code points of the classes that patterns use, by Unicode 16."""
    return {r"\p{L}": _points("L", UNICODE_16_LETTERS), r"\p{N}": _points("N", UNICODE_16_NUMBERS), r"\s": _ranges(WHITE_SPACE)}


def explicit_pattern(pattern: str, classes: dict[str, list[tuple[int, int]]], last: int = sys.maxunicode) -> str:
    r"""``pattern`` with ``\p{L}``, ``\p{N}``, ``\s`` and ``\S`` spelled out as
    code points up to ``last``, for :mod:`re`.  The classes may stand alone or
    inside brackets (``\S`` only alone)."""
    inside = {name: "".join(f"\\U{a:08x}-\\U{min(b, last):08x}" for a, b in ranges if a <= last) for name, ranges in classes.items()}
    out, bracket, i = [], False, 0
    while i < len(pattern):
        name = next((k for k in (*inside, r"\S") if pattern.startswith(k, i)), None)
        if name == r"\S":
            out.append(f"[^{inside[chr(92) + 's']}]")
        elif name:
            out.append(inside[name] if bracket else f"[{inside[name]}]")
        elif pattern[i] == "\\":
            name = pattern[i : i + 2]
            out.append(name)
        else:
            bracket = pattern[i] == "[" or (bracket and pattern[i] != "]")
            out.append(pattern[i])
        i += len(name or " ")
    return "".join(out)


class _Memo(dict):
    """A bounded memo of a function; missing entries are made on look-up."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= MEMO:
            self.clear()
        if isinstance(key, tuple) or len(key) <= MEMO_CHARS:
            self[key] = value
        return value


class Codec:
    """Encoder and decoder of one vocabulary: ``ranks`` maps the bytes of each
    token to its rank, which is its id; all 256 single bytes are tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, classes: dict[str, list[tuple[int, int]]] | None = None):
        classes = classes or unicode_classes()
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.finders = [re.compile(explicit_pattern(pattern, classes, last)).findall for last in LAST]
        self.apart = _Memo(lambda pair: self.merged(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == [*pair])
        self.stretch = _Memo(self._reduced)
        self.packed = _Memo(lambda piece: (lambda ids: struct.pack(f"<{len(ids)}I", *ids))(self.encode_match(piece.encode())))

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a window: neighbours merged by rank, leftmost first."""
        return self._merged_short(data) if len(data) <= SHORT_BYTES else self._merged_long(data)

    def _merged_short(self, data: bytes) -> list[int]:
        """Scans for the lowest rank before each merge; ``pairs[i]`` is the
        rank of parts i and i + 1 together."""
        rank, none = self.ranks.get, len(self.ranks)
        part = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            part[i] += part.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = rank(part[i - 1] + part[i], none)
            if i < len(pairs):
                pairs[i] = rank(part[i] + part[i + 1], none)
        return [self.ranks[p] for p in part]

    def _merged_long(self, data: bytes) -> list[int]:
        """A heap of the pairs and links between neighbours: n log n."""
        n, ranks = len(data), self.ranks
        part = [data[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[data[i : i + 2]], i, 2) for i in range(n - 1) if data[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if part[i] is None or j >= n or len(part[i]) + len(part[j]) != size:
                continue  # one of the two has merged since
            part[i], part[j] = part[i] + part[j], None
            right[i] = after = right[j]
            if after < n:
                left[after] = i
            for a, b in ((left[i], i), (i, after)):
                if a >= 0 and b < n:
                    joint = part[a] + part[b]
                    if joint in ranks:
                        heapq.heappush(heap, (ranks[joint], a, len(joint)))
        return [ranks[p] for p in part if p is not None]

    def joined(self, a: list[int], b: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings, one after the other."""
        if not a or not b or self.apart[a[-1], b[0]]:
            return a + b
        i = j = 1
        while True:
            window = self.merged(b"".join([self.bytes_of[t] for t in (*a[-i:], *b[:j])]))
            left = i == len(a) or self.apart[a[-i - 1], window[0]]
            right = j == len(b) or self.apart[window[-1], b[j]]
            if left and right:
                return a[: len(a) - i] + window + b[j:]
            i = i if left else min(2 * i, len(a))
            j = j if right else min(2 * j, len(b))

    def _reduced(self, data: bytes) -> list[int]:
        if len(data) == 1:
            return [self.ranks[data]]
        half = len(data) // 2
        return self.joined(self.stretch[data[:half]], self.stretch[data[half:]])

    def encode_match(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern; a match that is a token as a
        whole is that token."""
        whole = self.ranks.get(data)
        return self._reduced(data) if whole is None else [whole]

    def match(self, text: str) -> list[str]:
        """All matches in one go, with the narrowest classes that will do."""
        if text.isascii():
            return self.finders[0](text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.finders[2](text)
        return self.finders[1](text)

    def matches(self, text: str) -> list[str]:
        """Matches of the pattern in a text, by halves."""
        if len(text) <= LEAF_CHARS:
            return self.match(text)
        half = len(text) // 2
        return self.joined_matches(self.matches(text[:half]), self.matches(text[half:]))

    def joined_matches(self, a: list[str], b: list[str]) -> list[str]:
        """Matches of two neighbouring texts from the matches of each.  A match
        that ends two or more characters before the end of what was looked at
        is settled: no alternative of the pattern looks further ahead."""
        keep, seen = len(a), 0
        while keep and seen < 2:
            keep -= 1
            seen += len(a[keep])
        take = 4
        while True:
            window = "".join(a[keep:]) + "".join(b[:take])
            starts, at = {}, seen
            for m, piece in enumerate(b[: take + 1]):
                starts[at] = m
                at += len(piece)
            new, at = self.match(window), 0
            for k, piece in enumerate(new):
                at += len(piece)
                if at in starts and (at + 2 <= len(window) or take >= len(b)):
                    return a[:keep] + new[: k + 1] + b[starts[at] :]
            if take >= len(b):
                return a[:keep] + new
            take *= 2

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.matches(text)))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids, concatenated up the tree."""
        if len(ids) <= 4 * LEAF_TOKENS:
            return b"".join(map(self.bytes_of.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: lines of a token in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


_CODECS: dict[bytes, Codec] = {}


def _codec(data: bytes, pattern: str, classes: dict) -> Codec:
    """The codec of a vocabulary, made once in each Python worker."""
    key = hashlib.sha256(data + pattern.encode()).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(read_ranks(data), pattern, classes)
    return _CODECS[key]


class Tokenizer:
    """Column functions of one vocabulary.  The rank file (a fixed file of
    about a MB, whatever the corpus) is read on the driver and broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        prepare(spark)
        with open(path, "rb") as f:
            sent = spark.sparkContext.broadcast((f.read(), pattern, unicode_classes()))

        @F.arrow_udf("binary")
        def encode(texts: pa.Array) -> pa.Array:
            codec = _codec(*sent.value)
            return pa.array([codec.encode(t.as_py() or "") for t in texts], pa.binary())

        @F.arrow_udf("binary")
        def decode(ids: pa.Array) -> pa.Array:
            codec = _codec(*sent.value)
            return pa.array([codec.decode(i.as_py() or b"") for i in ids], pa.binary())

        self._encode, self._decode = encode, decode

    def ids(self, text: Column) -> Column:
        """Packed token ids of a text; null: none."""
        return self._encode(text)

    def data(self, ids: Column) -> Column:
        """UTF-8 bytes of packed token ids; null: none."""
        return self._decode(ids)


def encode_documents(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text as little-endian
    unsigned 32-bit integers (4 bytes a token), and ``n_tokens``.

    Special tokens are ordinary text.  A null or empty text has no tokens
    (``ids`` is empty, never null); equal texts have equal ids; an empty table
    gives an empty one; an input column called like a result is replaced.  No
    shuffle: each task works on the documents it reads.
    """
    coder = Tokenizer(docs.sparkSession, path, pattern)
    docs, names = hide(docs)
    out = docs.withColumn("ids", coder.ids(F.col(names[text_col])))
    return show(out.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long")), names, "ids", "n_tokens")


def decode_documents(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes of the packed token ids; null ids:
    no bytes.  Ids that the vocabulary lacks are an error."""
    coder = Tokenizer(docs.sparkSession, path, pattern)
    docs, names = hide(docs)
    return show(docs.withColumn("decoded", coder.data(F.col(names[ids_col]))), names, "decoded")
