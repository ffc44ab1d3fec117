"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its inverse.

A text is cut into stretches of whole pre-tokens (`stretches`), so that no more than a
window is in work at a time, whatever the text is made of; a stretch into runs of visible
characters and a run into pre-tokens by the published pattern of the vocabulary. Every
pre-token goes through `Transducer`, which remembers short ones: it buffers bytes, applies
the merge list to the buffer and emits every token that ends at least `lookahead` bytes
before the buffer's end. Those tokens are stable: whether a merge at a place is taken
depends on the text to its right only along a chain of ever earlier merges, each beginning
in the last symbol of the one before, and `sufficient_lookahead` is the longest such chain
of the merge list. What follows a stable token is encoded as if it stood alone, for no merge
crossed its border. The end of a pre-token is a border too: there all that is buffered is
stable. So pre-tokens of twice the lookahead and more (256 bytes for the vocabulary in use)
come out in parts, shorter ones at their end, and one longer than a window is fed in pieces.

Decoding feeds token bytes to an incremental UTF-8 state machine; broken sequences
become U+FFFD as in the public decoders.

Nulls: a NULL text is encoded as the empty text (no ids), NULL ids decode to "".
Empty tables give empty results; repeated rows and ids are kept one for one; columns
other than those named are passed through or left out, never looked at.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pre-token pattern published with the byte-level vocabularies (fixed value).
# White space is the Unicode property, so control characters 1C to 1F are none.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The characters with the Unicode property White_Space (fixed values).
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Borders of pre-tokens beside white space, of which the pattern has more inside.
RUN = rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
# Characters of a text that are in work at once.
BLOCK_CHARS = 1 << 16
# Encoded runs and pre-tokens that a worker remembers, and the longest in characters.
REMEMBERED = 400_000
REMEMBERED_CHARS = 40
# Up to so many bytes a search for the least rank is faster than a heap.
SHORT = 48


def byte_alphabet() -> dict[str, int]:
    """Character that stands for a byte in a byte-level vocabulary -> that byte.

    Printable Latin-1 characters stand for themselves, the other bytes in order for
    the characters from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


# A merge as one number: rank, then the new symbol in the low bits.
NEW_BITS = 32
NEW = (1 << NEW_BITS) - 1
NONE = 1 << 62
MARKS = frozenset(".,;:!?")


class Vocabulary:
    """Ids, token bytes, merges by rank and special strings of a tokenizer file."""

    def __init__(self, tokens: dict[int, bytes], merges: Sequence[tuple[int, int, int]], special):
        self.tokens = tokens
        self.merges = merges
        self.special: dict[str, int] = dict(special)
        self.rank = {(a, b): (rank, c) for rank, (a, b, c) in reversed([*enumerate(merges)])}
        self.coded = {pair: rank << NEW_BITS | c for pair, (rank, c) in self.rank.items()}
        self.byte_list = [0] * 256
        for i, token in tokens.items():
            if len(token) == 1:
                self.byte_list[token[0]] = i
        self.lookahead = sufficient_lookahead(tokens, merges)
        # Token bytes one after the other.
        self.width = max(tokens, default=0) + 1
        self.token_size = np.array([len(tokens.get(i, b"")) for i in range(self.width + 1)])
        self.token_start = np.cumsum(self.token_size) - self.token_size
        flat = b"".join(tokens.get(i, b"") for i in range(self.width))
        self.token_bytes = np.frombuffer(flat, np.uint8)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        alphabet = byte_alphabet()
        ids = said["model"]["vocab"]
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        tokens = {
            i: bytes(alphabet[c] for c in s) for s, i in ids.items() if s not in special
        } | {i: s.encode() for s, i in special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        return cls(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)


def sufficient_lookahead(
    tokens: dict[int, bytes], merges: Sequence[tuple[int, int, int]]
) -> int:
    """Bytes to the right of a token's end that can have a say in it.

    `reach[x]`: how far right of symbol x the merges known so far with x on the left
    can look. A merge (a, b) looks over b, and beyond it as far as an earlier merge can
    that starts with b, or with a symbol at the right edge of b before b was complete
    (`edge`). Merges are taken by rank, so only earlier ones are counted.
    """
    reach: dict[int, int] = {}
    edge: dict[int, int] = {}
    for a, b, c in merges:
        beyond = max(edge.get(b, 0), reach.get(b, 0))
        edge[c] = max(edge.get(c, 0), beyond)
        reach[a] = max(reach.get(a, 0), len(tokens[b]) + beyond)
    longest = max((len(t) for t in tokens.values()), default=1)
    return max([longest, *reach.values(), *edge.values()])


class Transducer:
    """Pre-tokens in, in pieces of any size, ids out, in constant memory.

    `feed` takes bytes of the pre-token that is being read and gives the ids that no further
    byte can change: of tokens that end `lookahead` bytes before the last byte known. `finish`
    ends the pre-token, after which nothing can change either. `whole` is both, for a
    pre-token that is there at once, with a memo of those met before.
    """

    def __init__(self, vocabulary: Vocabulary, block: int | None = None):
        self.vocabulary = vocabulary
        self.block = block or vocabulary.lookahead
        self.buffer = b""
        self.known: dict[str, bytes] = {}

    def feed(self, data: bytes) -> Iterator[int]:
        """Ids that have become stable."""
        tokens, ahead = self.vocabulary.tokens, self.vocabulary.lookahead
        for at in range(0, len(data), self.block):
            self.buffer += data[at : at + self.block]
            if len(self.buffer) < self.block + ahead:
                continue
            end, stable = 0, len(self.buffer) - ahead
            for i in merged(self.vocabulary, self.buffer):
                if end + len(tokens[i]) > stable:
                    break
                end += len(tokens[i])
                yield i
            self.buffer = self.buffer[end:]

    def finish(self) -> Iterator[int]:
        rest, self.buffer = self.buffer, b""
        yield from merged(self.vocabulary, rest)

    def whole(self, word: str) -> bytes:
        """The packed ids of one pre-token."""
        if (ids := self.known.get(word)) is None:
            ids = array("I", self.feed(word.encode()))
            ids.extend(self.finish())
            ids = ids.tobytes()
            if len(word) <= REMEMBERED_CHARS:
                self.known[word] = ids
        return ids


def merged(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """The merge list applied to one stretch of bytes: lowest rank first, then leftmost."""
    way = _merged_short if len(data) <= SHORT else _merged_long
    return way(vocabulary, data)


def _merged_short(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """By looking for the least rank each time."""
    coded = vocabulary.coded.get
    symbols = [*map(vocabulary.byte_list.__getitem__, data)]
    codes = [coded(pair, NONE) for pair in zip(symbols, symbols[1:])]
    while codes and (least := min(codes)) < NONE:
        at = codes.index(least)
        symbols[at : at + 2] = [least & NEW]
        del codes[at]
        if at < len(codes):
            codes[at] = coded((symbols[at], symbols[at + 1]), NONE)
        if at:
            codes[at - 1] = coded((symbols[at - 1], symbols[at]), NONE)
    return symbols


def _merged_long(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """By a heap of the pairs that can be merged."""
    rank = vocabulary.rank
    symbols = [*map(vocabulary.byte_list.__getitem__, data)]
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    heap = [
        (x[0], at, symbols[at], symbols[at + 1])
        for at in range(len(symbols) - 1)
        if (x := rank.get((symbols[at], symbols[at + 1])))
    ]
    heapq.heapify(heap)
    while heap:
        _, at, a, b = heapq.heappop(heap)
        right = after[at]
        if symbols[at] != a or right < 0 or symbols[right] != b:
            continue
        symbols[at] = rank[a, b][1]
        symbols[right] = -1
        after[at] = after[right]
        if after[at] >= 0:
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] >= 0:
                pair = symbols[left], symbols[after[left]]
                if x := rank.get(pair):
                    heapq.heappush(heap, (x[0], left, *pair))
    return [s for s in symbols if s >= 0]


class Encoder:
    """Whole texts to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.runs = re.compile(RUN)
        self.pretokens = regex.compile(PRETOKEN)
        self.transducer = Transducer(vocabulary)
        self.known: dict[str, bytes] = {}
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def encode(self, text: str | None) -> bytes:
        pieces: list[bytes] = []
        for part in self.special.split(text or "") if self.special else [text or ""]:
            if self.special and part in self.vocabulary.special:
                pieces.append(self.vocabulary.special[part].to_bytes(4, "little"))
                continue
            for start, end, long in stretches(part, self.pretokens, BLOCK_CHARS):
                if long:
                    pieces.append(self._long(part, start, end))
                else:
                    pieces.append(self._runs(part[start:end]))
        return b"".join(pieces)

    def encode_many(self, texts: Iterable[str | None]) -> list[bytes]:
        return [self.encode(text) for text in texts]

    def _runs(self, text: str) -> bytes:
        """Of a stretch of whole pre-tokens."""
        runs = self.runs.findall(text)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
            self.transducer.known.clear()
        out = [*map(known.get, runs)]
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    out[i] = self._run(runs[i])
        return b"".join(out)

    def _run(self, run: str) -> bytes:
        """Of one run of visible characters, or of white space, which is remembered."""
        if (ids := self.known.get(run)) is not None:
            return ids
        core = run[1:] if run[0] == " " else run
        if core.isalpha():  # one pre-token, no pattern needed
            words = [run]
        elif core[-1:] in MARKS and core[:-1].isalpha():
            words = [run[:-1], run[-1]]
        else:
            words = self.pretokens.findall(run)
        ids = b"".join(map(self.transducer.whole, words))
        if len(run) <= REMEMBERED_CHARS:
            self.known[run] = ids
        return ids

    def _long(self, text: str, start: int, end: int) -> bytes:
        """Of one pre-token longer than a window, fed in pieces."""
        run, ids = Transducer(self.vocabulary), array("I")
        for at in range(start, end, BLOCK_CHARS):
            ids.extend(run.feed(text[at : min(end, at + BLOCK_CHARS)].encode()))
        ids.extend(run.finish())
        return ids.tobytes()


_BLANKS_END = re.compile(f"[{BLANK}][{BLANK}][^{BLANK}]")
# A long pre-token goes on as it began: letters, digits, white space or anything else.
_GOES_ON = {
    "letters": regex.compile(r"\p{L}*+"),
    "digits": regex.compile(r"\p{N}*+"),
    "blank": regex.compile(r"\p{White_Space}*+"),
    "other": regex.compile(r"[^\p{White_Space}\p{L}\p{N}]*+"),
}


def stretches(text: str, pretokens, size: int = BLOCK_CHARS) -> Iterator[tuple[int, int, bool]]:
    """The text in stretches of about `size` characters that begin and end where pre-tokens
    do; a pre-token longer than that is a stretch of its own, and said to be long."""
    start = 0
    while len(text) - start > size:
        cut = text.rfind(" ", start + 1, start + size)
        while cut > start and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", start + 1, cut)
        if cut <= start:
            # The last pre-token of a window may go on beyond it; those before it do not. A
            # stretch must not end in several blanks that visible text follows: the last of
            # them is a pre-token, and alone they would be one.
            cut = start
            for found in pretokens.finditer(text, start, start + size):
                at = found.start()
                alone = at - 2 >= start and _BLANKS_END.match(text, at - 2)
                if at > start and not alone:
                    cut = at
        if cut > start:
            yield start, cut, False
            start = cut
            continue
        ends = {name: p.match(text, start + size - 1).end() for name, p in _GOES_ON.items()}
        end = max(ends.values())
        if end == ends["blank"] and end < len(text):
            end -= 1  # the last blank belongs to what follows
        yield start, end, True
        start = end
    if start < len(text):
        yield start, len(text), False


class Decoder:
    """Ids in, text out, with the state of an unfinished character in between."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: np.ndarray) -> str:
        """Ids that the vocabulary does not hold are skipped."""
        known = self.vocabulary
        ids = np.where((ids >= 0) & (ids < known.width), ids, known.width).astype(np.int64)
        size = known.token_size[ids]
        at = np.repeat(known.token_start[ids] - np.cumsum(size) + size, size)
        return self.state.decode(known.token_bytes[at + np.arange(len(at))].tobytes())

    def finish(self) -> str:
        rest = self.state.decode(b"", final=True)
        self.state.reset()
        return rest

    def decode(self, packed: bytes, step: int = BLOCK_CHARS) -> str:
        ids = np.frombuffer(packed, "<u4")
        parts = [self.feed(ids[at : at + step]) for at in range(0, len(ids), step)]
        return "".join([*parts, self.finish()])


@lru_cache(maxsize=4)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary.from_file(path)


@lru_cache(maxsize=4)
def encoder_of(path: str) -> Encoder:
    """One per worker and file, so that its memory serves all tasks of the worker."""
    return Encoder(vocabulary_of(path))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the array of token ids of column `text`; a column named `ids` is replaced."""
    if ids in df.columns:
        df = df.drop(ids)
    names = df.columns

    def run(batches):
        encoder = encoder_of(path)
        for batch in batches:
            packed = encoder.encode_many(batch.column(names.index(text)).to_pylist())
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            column = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*names, ids])

    return df.mapInArrow(run, df.withColumn(ids, F.lit(None).cast("array<int>")).schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the text of the token ids; a column named `text` is replaced."""
    if text in df.columns:
        df = df.drop(text)
    names = df.columns

    def run(batches):
        decoder = Decoder(vocabulary_of(path))
        for batch in batches:
            texts = [
                decoder.feed(np.array(row or (), np.int64)) + decoder.finish()
                for row in batch.column(names.index(ids)).to_pylist()
            ]
            column = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*names, text])

    return df.mapInArrow(run, df.withColumn(text, F.lit(None).cast("string")).schema)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, number of ids, SHA-256 of the packed ids and of the text decoded from them."""
    from hashlib import sha256

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        encoder, decoder = encoder_of(path), Decoder(vocabulary_of(path))
        for batch in batches:
            n, ids, texts = [], [], []
            for packed in encoder.encode_many(batch.column(1).to_pylist()):
                n.append(len(packed) // 4)
                ids.append(sha256(packed).hexdigest())
                texts.append(sha256(decoder.decode(packed).encode()).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)]
            columns[2:] = [c.cast(pa.string()) for c in columns[2:]]
            yield pa.RecordBatch.from_arrays(
                columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return rows.mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
