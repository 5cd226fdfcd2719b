"""Patched frame-of-reference coding of token ids.

A segment is a self-contained file image: header, document table, block index, blocks, exceptions.
Ids are coded in blocks of 128. A block stores its minimum and the differences to it, packed in a bit
width that nine tenths of them fit; the others are patched from the block's exception list, which holds
their positions and whole differences. The index gives the start of every block's packed bytes and
of its exceptions, so a block is read without the ones before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 128
FIT = 0.9
MAGIC = b"PFR1"


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers to rows of bytes, ``width`` bits each."""
    raw = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(*values.shape, 4)
    bits = np.unpackbits(raw, axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), BLOCK, width)
    raw = np.zeros((len(packed), BLOCK, 32), np.uint8)
    raw[:, :, :width] = bits
    return np.packbits(raw, axis=2, bitorder="little").view("<u4").reshape(len(packed), BLOCK)


def encode_segment(doc_ids: np.ndarray, ids: list[np.ndarray]) -> bytes:
    """``ids[i]`` are the token ids of document ``doc_ids[i]``."""
    lengths = np.array([len(x) for x in ids], "<u4")
    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    n, blocks = len(flat), -(-len(flat) // BLOCK)
    padded = np.pad(flat, (0, blocks * BLOCK - n), mode="edge") if n else flat
    rows = padded.astype("<u4").reshape(blocks, BLOCK)
    least = rows.min(axis=1) if n else np.zeros(0, "<u4")
    delta = rows - least[:, None]
    bits = _bit_length(delta)
    width = np.sort(bits, axis=1)[:, int(FIT * (BLOCK - 1))].astype(np.uint8) if n else np.zeros(0, np.uint8)
    odd = bits > width[:, None]
    starts = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // 8))]).astype("<u4")
    patches = np.concatenate([[0], np.cumsum(odd.sum(axis=1))]).astype("<u4")
    data = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            packed = _pack(delta[at], int(w))
            data[starts[at].astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    header = np.array([len(doc_ids), n, blocks], "<u4")
    parts = [
        header,
        np.asarray(doc_ids, "<i8"),
        lengths,
        least.astype("<u4"),
        width,
        starts,
        patches,
        data,
        np.nonzero(odd)[1].astype(np.uint8),
        delta[odd].astype("<u4"),
    ]
    return MAGIC + b"".join(part.tobytes() for part in parts)


@dataclass
class Segment:
    doc_ids: np.ndarray
    lengths: np.ndarray
    n_ids: int
    least: np.ndarray
    width: np.ndarray
    starts: np.ndarray
    patches: np.ndarray
    data: np.ndarray
    positions: np.ndarray
    values: np.ndarray

    @classmethod
    def open(cls, image: bytes) -> Segment:
        if image[:4] != MAGIC:
            raise ValueError("not a token segment")
        at = 4

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(image, kind, int(n), at)
            at += got.nbytes
            return got

        docs, n, blocks = take("<u4", 3)
        fields = [take("<i8", docs), take("<u4", docs), int(n), take("<u4", blocks), take("u1", blocks)]
        fields += [take("<u4", blocks + 1), take("<u4", blocks + 1)]
        fields.append(take("u1", fields[5][-1]))
        fields += [take("u1", fields[6][-1]), take("<u4", fields[6][-1])]
        return cls(*fields)

    def blocks(self, which: np.ndarray) -> np.ndarray:
        """The ids of the numbered blocks, a row for each; the last block of a segment is padded."""
        out = np.zeros((len(which), BLOCK), "<u4")
        for w in np.unique(self.width[which]):
            rows = np.flatnonzero(self.width[which] == w)
            if w:
                first = self.starts[which[rows]].astype(np.int64)
                out[rows] = _unpack(self.data[first[:, None] + np.arange(int(w) * BLOCK // 8)], int(w))
        first = self.patches[which].astype(np.int64)
        counts = self.patches[which + 1].astype(np.int64) - first
        row = np.repeat(np.arange(len(which)), counts)
        at = np.arange(len(row)) + np.repeat(first - (np.cumsum(counts) - counts), counts)
        out[row, self.positions[at]] = self.values[at]
        return out + self.least[which][:, None]

    def ids(self) -> np.ndarray:
        return self.blocks(np.arange(len(self.least))).reshape(-1)[: self.n_ids]

    def document(self, i: int) -> np.ndarray:
        """The ids of the ``i``-th document, from the blocks that hold them."""
        first = int(self.lengths[:i].sum(dtype=np.int64))
        last = first + int(self.lengths[i])
        if first == last:
            return np.zeros(0, "<u4")
        which = np.arange(first // BLOCK, -(-last // BLOCK))
        return self.blocks(which).reshape(-1)[first - which[0] * BLOCK : last - which[0] * BLOCK]
