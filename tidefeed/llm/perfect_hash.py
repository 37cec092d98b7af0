"""Minimal perfect hashes over sets of terms, with the terms stored for verification.

A table of n terms gives each of them its own slot from 0 to n - 1. It is built level by level:
at a level every remaining term is hashed to one of about twice as many places; a place that one
term alone has hit is taken, its bit is set, and the rest go on to the next level. A term's slot is
the number of set bits before its place, over all levels. A term that is not in the set may get
some slot too, so whoever looks up compares the stored term of that slot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidefeed.llm.shared import Rolling, mixed, utf8

#: Places a term at each level.
PLACES = 2
LEVELS = 24
#: Longer terms are stored as a digest, so that a table's size follows its number of terms.
LONG = 200


def stored(terms: pa.Array) -> pa.Array:
    """Terms as they are stored: long ones as a digest behind a byte that no term has."""
    long = pc.greater(pc.binary_length(terms), LONG)
    if not pc.any(long).as_py():
        return terms
    values = [
        t if len(t.encode()) <= LONG else "\0" + hashlib.sha256(t.encode()).hexdigest()
        for t in terms.to_pylist()
    ]
    return pa.array(values, pa.string())


def hashes(terms: pa.Array) -> np.ndarray:
    data, offsets = utf8(terms)
    return Rolling(data).ranges(offsets[:-1], offsets[1:])


def _places(names: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mixed(names ^ salt) % np.uint64(size)).astype(np.int64)


def build(terms: pa.Array) -> dict:
    """The parts of a table of distinct ``terms``, and the order that puts them into slots."""
    terms = stored(terms)
    names, left = hashes(terms), np.arange(len(terms))
    sizes, bits, order = [], [], []
    while len(left) and len(sizes) < LEVELS:
        size = max(64, PLACES * len(left))
        place = _places(names[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        hit = alone[place]
        order.append(left[hit][np.argsort(place[hit])])
        sizes.append(size)
        bits.append(alone)
        left = left[~hit]
    order = np.concatenate([*order, left]) if len(terms) else left
    packed = np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8)
    data, offsets = utf8(terms.take(pa.array(order)))
    return {
        "sizes": np.array(sizes, np.int64).tobytes(),
        "bits": packed.tobytes(),
        "terms": data.tobytes(),
        "ends": offsets[1:].astype(np.int32).tobytes(),
        "order": order,
    }


class Table:
    """A table made ready for look-ups."""

    def __init__(self, sizes: bytes, bits: bytes, terms: bytes, ends: bytes):
        self.sizes = np.frombuffer(sizes, np.int64)
        every = int(self.sizes.sum())
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=every).view(bool)
        self.slots = np.cumsum(self.bits, dtype=np.int32) - 1
        offsets = np.append(0, np.frombuffer(ends, np.int32)).astype(np.int32)
        self.terms = pa.StringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(terms)
        )
        placed = int(self.bits.sum())
        # terms that no level could tell apart: those whose 64-bit names are equal
        self.rest = {t: placed + i for i, t in enumerate(self.terms[placed:].to_pylist())}

    def __len__(self) -> int:
        return len(self.terms)

    def find(self, terms: pa.Array, names: np.ndarray) -> np.ndarray:
        """The slot of each of ``stored`` terms, -1 for those that are not in the table."""
        slots = np.full(len(names), -1, np.int64)
        left, before = np.arange(len(names)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = _places(names[left], level, size) + before
            hit = self.bits[place]
            slots[left[hit]] = self.slots[place[hit]]
            left, before = left[~hit], before + size
            if not len(left):
                break
        if self.rest:
            for i in left.tolist():
                slots[i] = self.rest.get(terms[i].as_py(), -1)
        maybe = np.flatnonzero(slots >= 0)
        same = pc.equal(self.terms.take(pa.array(slots[maybe])), terms.take(pa.array(maybe)))
        slots[maybe[~same.to_numpy(zero_copy_only=False)]] = -1
        return slots
