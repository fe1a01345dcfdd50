"""Access points into deflated archive members, so that parts of one can be inflated by many tasks.

A deflate stream can be entered where a block begins, given the 32 KB that
came out before.  ``access_points`` inflates a member once and finds such
places every few megabytes: bit patterns that could be a block's header are
chosen by the header's own checks (a complete code of code lengths), and one
is taken only if what inflates from there equals what the running inflation
gives.  ``InflatedFile`` reads a member from its nearest point on.  A stream
whose blocks are all stored or of fixed codes has no points and is read from
its start.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np

WINDOW = 1 << 15
PIECE = 1 << 16  # compressed bytes handled at a time
EVERY = 8 << 20  # inflated bytes between access points, about
PROOF = 1 << 10  # inflated bytes that must agree, at least


def deflated_span(zf: zipfile.ZipFile, member: str) -> tuple[int, int]:
    """Offset and length of a member's compressed bytes in the archive."""
    info = zf.getinfo(member)
    zf.fp.seek(info.header_offset)
    name, extra = struct.unpack("<26xHH", zf.fp.read(30))
    return info.header_offset + 30 + name + extra, info.compress_size


def _realigned(data: bytes, bit: int) -> bytes:
    """``data`` from its bit ``bit`` on (0 to 7), without the last partial byte."""
    if not bit:
        return data
    a = np.frombuffer(data, np.uint8)
    return ((a[:-1] >> np.uint8(bit)) | (a[1:] << np.uint8(8 - bit))).tobytes()


def block_candidates(data: bytes) -> np.ndarray:
    """Bit positions in ``data`` that may be the header of a block with codes of its own that is not the last.

    The header has the type, three counts and the lengths of the codes in
    which the other codes' lengths are written; these must make up a complete
    prefix code.
    """
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    n = len(bits) - 17 - 19 * 3
    if n <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero((bits[:n] == 0) & (bits[1:n + 1] == 0) & (bits[2:n + 2] == 1))

    def number(place: np.ndarray, width: int) -> np.ndarray:
        return sum(bits[place + i].astype(np.int64) << i for i in range(width))

    at = at[(number(at + 3, 5) <= 29) & (number(at + 8, 5) <= 29)]
    count = number(at + 13, 4) + 4
    weight = np.zeros(len(at), np.int64)
    for j in range(19):
        length = np.where(j < count, number(at + 17 + 3 * j, 3), 0)
        weight += np.where(length > 0, 128 >> length, 0)
    return at[weight == 128]


def _confirmed(piece: bytes, bit: int, state, window: bytes) -> tuple[int, bytes] | None:
    """Bytes that come out before the block at ``bit`` and the window there, if inflating from it gives the same."""
    shifted = _realigned(piece[bit // 8:], bit % 8)
    try:  # most candidates are no header at all
        zlib.decompressobj(-15, zdict=bytes(WINDOW)).decompress(shifted[:512])
    except zlib.error:
        return None
    # all of the block before ends in the byte of ``bit``, whose other bits give no output yet
    state, cut = state.copy(), -(-bit // 8)
    before = state.decompress(piece[:cut])
    window = (window + before)[-WINDOW:]
    truth = state.decompress(piece[cut:])
    try:
        mine = zlib.decompressobj(-15, zdict=window).decompress(shifted)
    except zlib.error:
        return None
    shared = min(len(mine), len(truth))
    return (len(before), window) if shared >= PROOF and mine[:shared] == truth[:shared] else None


def access_points(file, offset: int, size: int, every: int = EVERY) -> Iterator[tuple[int, int, bytes]]:
    """``(bit, out, window)`` every ``every`` inflated bytes: the compressed bit and inflated byte where a block begins."""
    file.seek(offset)
    state, window, out, done, due = zlib.decompressobj(-15), b"", 0, 0, every
    while done < size:
        piece = file.read(min(PIECE, size - done))
        if not piece:
            raise EOFError("the archive ends inside a member")
        if out >= due:
            for bit in block_candidates(piece).tolist():
                found = _confirmed(piece, bit, state, window)
                if found:
                    yield 8 * done + bit, out + found[0], found[1]
                    due = out + found[0] + every
                    break
        fresh = state.decompress(piece)
        out, done, window = out + len(fresh), done + len(piece), (window + fresh)[-WINDOW:]


class InflatedFile(io.RawIOBase):
    """A deflated member as a file to be read forward, from its start or from an access point ``(bit, out, window)``."""

    def __init__(self, zf: zipfile.ZipFile, member: str, point: tuple[int, int, bytes] | None = None):
        self.file, (self.offset, self.size) = zf.fp, deflated_span(zf, member)
        self.point = point
        self._enter(0, 0, b"")

    def _enter(self, bit: int, out: int, window: bytes) -> None:
        self.state = zlib.decompressobj(-15, zdict=window) if window else zlib.decompressobj(-15)
        self.next, self.shift, self.carry = bit // 8, bit % 8, b""
        self.at, self.held = out, b""

    def tell(self) -> int:
        return self.at

    def seek(self, place: int, whence: int = io.SEEK_SET) -> int:
        if whence != io.SEEK_SET:
            raise io.UnsupportedOperation("seek from the start")
        if self.point and self.point[1] <= place and not self.point[1] <= self.at <= place:
            self._enter(*self.point)
        elif place < self.at:
            self._enter(0, 0, b"")
        while self.at < place and self._more(min(place - self.at, 1 << 20)):
            pass
        return self.at

    def _more(self, n: int) -> bytes:
        """Up to ``n`` next bytes; none at the end."""
        while not self.held and not self.state.eof:
            data = self.state.unconsumed_tail
            if not data:
                self.file.seek(self.offset + self.next)
                data = self.file.read(min(PIECE, self.size - self.next))
                self.next += len(data)
                last = self.next >= self.size
                if self.shift:
                    data = self.carry + data + (b"\0" if last else b"")
                    self.carry = data[-1:]
                    data = _realigned(data, self.shift)
                if not data:
                    raise EOFError("the archive ends inside a member")
            self.held = self.state.decompress(data, max(n, 1 << 16))
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        return out

    def read(self, n: int = -1) -> bytes:
        parts, left = [], n if n >= 0 else 1 << 62
        while left and (part := self._more(min(left, 1 << 24))):
            parts.append(part)
            left -= len(part)
        return b"".join(parts)
