"""Counting quotient filters over n-grams of word ids: exact counters in few bytes.

A key is the ids of an n-gram, packed into two halves of up to 64 bits. Rounds of an invertible
mix spread it over all keys of its width, so that its first bits, the quotient, choose a slot
evenly; a slot keeps the full remainder of each of its keys. Nothing is lost: quotient,
remainder and the inverse mix give the ids back, and two n-grams never share a counter.

A filter holds the keys of one bucket (the quotient's first bits) in their order: the number of
keys of each slot, the remainders, and the counts, where all but large numbers take a byte.
Sorted filters of different tasks are merged by their keys.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Rounds of the mix, each of which changes one half by the other.
ROUNDS = 4
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def u64(value: int) -> np.uint64:
    return np.uint64(value & 0xFFFFFFFFFFFFFFFF)


def low_bits(bits: int) -> np.uint64:
    return u64((1 << bits) - 1)


def shifted(values: np.ndarray, bits: int) -> np.ndarray:
    """``values`` without their last bits; none is left of 64."""
    return np.zeros_like(values) if bits >= 64 else values >> u64(bits)


@dataclass(frozen=True)
class Shape:
    """How n-grams of ``n`` ids below ``2 ** id_bits`` are laid out."""

    n: int
    id_bits: int
    bucket_bits: int

    @property
    def left_bits(self) -> int:
        return self.id_bits * ((self.n + 1) // 2)

    @property
    def right_bits(self) -> int:
        return self.id_bits * (self.n // 2)

    @property
    def narrow(self) -> bool:
        """Whether a key fits one word of the machine."""
        return self.left_bits + self.right_bits <= 64


def shape(n: int, id_bits: int, bucket_bits: int) -> Shape:
    if not 1 <= id_bits <= 32:
        raise ValueError(f"ids of {id_bits} bits do not fit; 1 to 32 do")
    return Shape(n, id_bits, min(bucket_bits, id_bits * ((n + 1) // 2)))


def pack(ids: list[np.ndarray], form: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each n-gram; ``ids`` has an array for each place."""
    halves = []
    middle = (form.n + 1) // 2
    for part in (ids[:middle], ids[middle:]):
        half = np.zeros(len(ids[0]), np.uint64)
        for column in part:
            half = (half << u64(form.id_bits)) | column.astype(np.uint64)
        halves.append(half)
    return halves[0], halves[1]


def unpack(left: np.ndarray, right: np.ndarray, form: Shape) -> np.ndarray:
    """An array with a row of ids for each key."""
    middle = (form.n + 1) // 2
    columns = []
    for half, width in ((left, middle), (right, form.n - middle)):
        for place in range(width):
            columns.append(shifted(half, form.id_bits * (width - 1 - place)) & low_bits(form.id_bits))
    return np.stack(columns, axis=1).astype(np.int64)


def _scramble(values: np.ndarray, turn: int, bits: int) -> np.ndarray:
    x = (values + u64(ODD[turn])) * u64(ODD[(turn + 1) % ROUNDS])
    x ^= x >> u64(31)
    x *= u64(ODD[(turn + 2) % ROUNDS])
    return (x >> u64(64 - bits)) if bits else np.zeros_like(x)


def permute(left: np.ndarray, right: np.ndarray, form: Shape) -> tuple[np.ndarray, np.ndarray]:
    for turn in range(ROUNDS):
        if turn % 2:
            right = right ^ _scramble(left, turn, form.right_bits)
        else:
            left = left ^ _scramble(right, turn, form.left_bits)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, form: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permute``."""
    for turn in reversed(range(ROUNDS)):
        if turn % 2:
            right = right ^ _scramble(left, turn, form.right_bits)
        else:
            left = left ^ _scramble(right, turn, form.left_bits)
    return left, right


@dataclass
class Counted:
    """Distinct permuted keys in order, and how often each occurs."""

    left: np.ndarray
    right: np.ndarray
    times: np.ndarray


def counted(left: np.ndarray, right: np.ndarray, times: np.ndarray | None, form: Shape) -> Counted:
    """Keys with repeats, in any order, as distinct ones; ``times`` None counts each once."""
    if not len(left):
        return Counted(left, right, np.zeros(0, np.int64))
    if form.narrow:
        whole = (left << u64(form.right_bits)) | right if form.right_bits < 64 else right
        if times is None:
            whole = np.sort(whole)
        else:
            order = np.argsort(whole, kind="stable")
            whole, times = whole[order], times[order]
        head = np.concatenate([[True], whole[1:] != whole[:-1]])
        left, right = shifted(whole, form.right_bits), whole & low_bits(form.right_bits)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        times = None if times is None else times[order]
        head = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    heads = np.flatnonzero(head)
    if times is None:
        total = np.diff(np.concatenate([heads, [len(head)]])).astype(np.int64)
    else:
        total = np.add.reduceat(times, heads)
    return Counted(left[heads], right[heads], total)


def small_numbers(values: np.ndarray) -> bytes:
    """A byte each; 255 stands for a number of 8 bytes behind them."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<i8").tobytes()


def read_numbers(data: bytes, n: int) -> np.ndarray:
    values = np.frombuffer(data, np.uint8, n).astype(np.int64)
    large = values == 255
    values[large] = np.frombuffer(data, "<i8", int(large.sum()), n)
    return values


def _trimmed(values: np.ndarray, bits: int) -> bytes:
    size = (bits + 7) // 8
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _widened(data: bytes, bits: int, n: int, at: int) -> tuple[np.ndarray, int]:
    size = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    if size:
        out[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    return out.view("<u8").reshape(n).astype(np.uint64), at + n * size


def to_filters(found: Counted, form: Shape) -> list[tuple[int, int, int, bytes, bytes, bytes]]:
    """``bucket, keys, slot_bits, keys by slot, remainders, counts`` of each bucket."""
    if not len(found.left):
        return []
    bucket = shifted(found.left, form.left_bits - form.bucket_bits)
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    out = []
    for a, b in zip(heads, np.append(heads[1:], len(bucket))):
        n = int(b - a)
        # About one key a slot; a bucket of one key needs no slots.
        slot_bits = min(n.bit_length() - 1, form.left_bits - form.bucket_bits)
        rest = form.left_bits - form.bucket_bits - slot_bits
        inside = found.left[a:b] & low_bits(form.left_bits - form.bucket_bits)
        slots = np.bincount(shifted(inside, rest).astype(np.int64), minlength=1 << slot_bits)
        remainders = _trimmed(inside & low_bits(rest), rest) + _trimmed(found.right[a:b], form.right_bits)
        out.append((int(bucket[a]), n, slot_bits, small_numbers(slots), remainders, small_numbers(found.times[a:b])))
    return out


def of_filter(bucket: int, n: int, slot_bits: int, slots: bytes, remainders: bytes, counts: bytes, form: Shape) -> Counted:
    rest = form.left_bits - form.bucket_bits - slot_bits
    per_slot = read_numbers(slots, 1 << slot_bits)
    quotient = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), per_slot)
    first, at = _widened(remainders, rest, n, 0)
    right, _ = _widened(remainders, form.right_bits, n, at)
    left = first if rest >= 64 else (quotient << u64(rest)) | first
    if form.left_bits > form.bucket_bits:
        left = left | u64(bucket << (form.left_bits - form.bucket_bits))
    else:
        left = np.full(n, bucket, np.uint64)
    return Counted(left, right, read_numbers(counts, n))


def merged(parts: Iterable[Counted], form: Shape) -> Counted:
    """All counters of some filters, equal keys added up."""
    parts = list(parts)
    if len(parts) == 1:
        return parts[0]
    joined = (np.concatenate([getattr(p, f) for p in parts]) for f in ("left", "right", "times"))
    return counted(*joined, form)
