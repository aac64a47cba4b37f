"""Byte-level BPE encoding and decoding with a vectorised pre-tokeniser.

Pre-tokenisation uses no regular expression. Every code point has a class; classes and the
next code points give a symbol; a symbol is a function from state to state, and composing
functions is associative. So blocks of symbols are composed side by side, a scan over the
blocks gives the state at each block's start, and a second pass marks where tokens begin.
Slices between the marks are merged by rank, each distinct slice once while it is cached.

Defined results: a null text is empty and has no ids; rows are encoded one by one, so
repeated rows and clashing column names do no harm; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.arrow import map_arrow, slices, texts

#: Classes of code points.
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, END = range(7)
#: Code points that count as white space. Fixed values.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Symbols of the transition functions.
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_JOINED, S_LAST, S_WHITE, S_END = range(9)
#: States: nothing open, in letters, numbers, others, after a blank that belongs to the next
#: token, in white space, one or two letters of a contraction to come.
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_WHITE, TAKE1, TAKE2 = range(8)
STATES = 8
BLOCK = 128
CACHED_PIECES = 300_000
#: Pre-tokens of more bytes are merged through a heap.
SHORT_PIECE = 200


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        first = unicodedata.category(chr(code))[0]
        if first == "L":
            table[code] = LETTER
        elif first == "N":
            table[code] = NUMBER
    table[WHITE] = SPACE
    table[32] = BLANK
    table[39] = QUOTE
    return table


@lru_cache(1)
def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a token begins, both by symbol × 8 + state."""
    after = np.zeros((9, STATES), np.uint8)
    begins = np.ones((9, STATES), bool)
    for symbol, inside in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
        after[symbol] = inside
        begins[symbol, [inside, AFTER_BLANK]] = False
    after[S_LETTER, [TAKE1, TAKE2]] = NEW, TAKE1
    begins[S_LETTER, [TAKE1, TAKE2]] = False
    for symbol, take in ((S_QUOTE1, TAKE1), (S_QUOTE2, TAKE2)):
        after[symbol] = take
        after[symbol, [IN_OTHERS, AFTER_BLANK]] = IN_OTHERS
        begins[symbol, [IN_OTHERS, AFTER_BLANK]] = False
    after[S_JOINED] = AFTER_BLANK
    after[S_LAST] = NEW
    after[S_WHITE] = IN_WHITE
    begins[S_WHITE, IN_WHITE] = False
    after[S_END] = NEW
    return after.ravel(), begins.ravel()


def symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``ends`` are the places between texts."""
    kind = code_point_classes()[codes]
    kind[ends] = END
    white = (kind == SPACE) | (kind == BLANK)
    stop = white | (kind == END)
    next_stops = np.append(stop[1:], True)
    out = np.array([S_OTHER, S_LETTER, S_NUMBER, S_WHITE, S_WHITE, S_OTHER, S_END], np.uint8)[kind]
    before_word = white & ~next_stops
    out[before_word] = np.where(kind[before_word] == BLANK, S_JOINED, S_LAST)
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        padded = np.append(codes, [0, 0])
        # A mark between texts is a code point too: it must not look like a letter.
        one, two = padded[quotes + 1], padded[quotes + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b))
        out[quotes[single]] = S_QUOTE1
        out[quotes[double]] = S_QUOTE2
    return out


def token_starts(symbol: np.ndarray) -> np.ndarray:
    """Where tokens begin, by a scan over composed transition functions."""
    after, begins = transitions()
    n = len(symbol)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, S_END, np.uint8)
    padded[:n] = symbol
    steps = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T).astype(np.intp) * STATES
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for step in steps:
        whole = after[step[:, None] + whole]
    width = 1
    while width < blocks:  # inclusive scan: every block's function after all before it
        earlier = whole[:-width]
        whole = np.concatenate([whole[:width], np.take_along_axis(whole[width:], earlier, 1)])
        width *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = whole[:-1, NEW]
    marks = np.empty((BLOCK, blocks), bool)
    for j, step in enumerate(steps):
        at = step + state
        marks[j] = begins[at]
        state = after[at]
    return np.flatnonzero(marks.T.ravel()[:n])


def pieces(batch: list[str]) -> list[tuple[list[str], np.ndarray]]:
    """Pre-tokens of each text and the code points at which they start."""
    joined = "\0".join(batch) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in batch], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    starts = token_starts(symbols(codes, ends))
    stops = np.append(starts[1:], len(codes))
    found = [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
    edges = np.searchsorted(starts, ends)
    out, first, begin = [], 0, 0
    for edge, end in zip(edges.tolist(), ends.tolist()):
        out.append((found[first:edge], starts[first:edge] - begin))
        first, begin = edge + 1, end + 1
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: neighbours of the lowest rank merge first, the left of equals."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > SHORT_PIECE:
        return merge_long(piece, ranks)
    never = len(ranks) + 1
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], never) for i in range(len(piece) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == never:
            break
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], never)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], never)
    return [ranks[part] for part in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, in n log n steps."""
    n = len(piece)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    stop = list(range(1, n + 1))
    heap = [(rank, i, 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = right[i] if stop[i] > i else n
        if stop[i] <= i or j >= n or stop[j] - i != size:
            continue  # one of the two has merged since
        stop[i], right[i] = stop[j], right[j]
        stop[j] = -1
        if right[i] < n:
            left[right[i]] = i
            k = stop[right[i]]
            if (rank := ranks.get(piece[i:k])) is not None:
                heapq.heappush(heap, (rank, i, k - i))
        if (p := left[i]) >= 0 and (rank := ranks.get(piece[p : stop[i]])) is not None:
            heapq.heappush(heap, (rank, p, stop[i] - p))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : stop[i]]])
        i = right[i]
    return out


class Encoder:
    """Ranks, and the ids of the pre-tokens met last."""

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        self.ranks = load_ranks(path)
        self.cached = cached
        self.known: dict[str, bytes] = {}

    def ids(self, found: list[str]) -> list[bytes]:
        known = self.known
        missing = set(found).difference(known)
        if len(known) + len(missing) > self.cached:
            self.known = known = {}
            missing = set(found)
        for piece in missing:
            known[piece] = array("I", merge(piece.encode(), self.ranks)).tobytes()
        return list(map(known.__getitem__, found))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after the other, and each id's start and length."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def decode_ids(ids: bytes, path: str) -> bytes:
    blob, starts, lengths = token_bytes(path)
    at = np.frombuffer(ids, "<u4").astype(np.int64)
    sizes = lengths[at]
    shift = starts[at] - (np.cumsum(sizes) - sizes)
    return blob[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()


ENCODED = "ids binary, piece_starts binary, piece_tokens binary"


def encode(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (little-endian unsigned 32-bit), and for each pre-token its first code
    point (``piece_starts``) and number of ids (``piece_tokens``), in the same form."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in slices(batches, "_text", 1_000_000):
            ids, starts, counts = [], [], []
            for found, begin in pieces(texts(batch, "_text")):
                encoded = bpe.ids(found)
                ids.append(b"".join(encoded))
                starts.append(begin.astype("<u4").tobytes())
                counts.append((np.fromiter(map(len, encoded), np.uint32, len(encoded)) // 4).astype("<u4").tobytes())
            columns = [batch.column(0), *(pa.array(c, pa.binary()) for c in (ids, starts, counts))]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "piece_starts", "piece_tokens"])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key], documents[text].alias("_text"))
    return map_arrow(rows, run, f"`{key}` {kind}, {ENCODED}")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``encoded`` (``key`` and ``ids``) with the ``decoded`` bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", 1_000_000):
            ids = batch.column(1).to_pylist()
            out = [decode_ids(x or b"", path) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], [key, "ids", "decoded"]
            )

    kind = encoded.schema[key].dataType.simpleString()
    return map_arrow(encoded.select(key, "ids"), run, f"`{key}` {kind}, ids binary, decoded binary")


def round_trip(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and the bytes ``decoded`` from them, in one pass over the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in slices(batches, "_text", 1_000_000):
            ids = [b"".join(bpe.ids(found)) for found, _ in pieces(texts(batch, "_text"))]
            out = [decode_ids(x, path) for x in ids]
            columns = [batch.column(0), pa.array(ids, pa.binary()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded"])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key], documents[text].alias("_text"))
    return map_arrow(rows, run, f"`{key}` {kind}, ids binary, decoded binary")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return decoded.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
