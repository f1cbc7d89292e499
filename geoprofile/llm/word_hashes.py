"""64-bit hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from .picking import SALTS, mix

LONG = 64  # bytes; longer words are hashed one by one
_ASCII = bytes(b in b" \t\n\r\x0b\x0c" for b in range(256))
_UNICODE = bytes(b in b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f" for b in range(256))  # of one byte
_LEAD = bytes(b in b"\xc2\xe1\xe2\xe3" for b in range(256))  # of all others, whose bytes are:
_WIDE = np.array(sorted(int.from_bytes(chr(c).encode(), "big") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _marked(text: bytes, marks: bytes) -> np.ndarray:
    return np.frombuffer(bytearray(text.translate(marks)), bool)


def _spaces(text: bytes, raw: np.ndarray, unicode: bool) -> np.ndarray:
    if not unicode:
        return _marked(text, _ASCII)
    out = _marked(text, _UNICODE)
    at = np.flatnonzero(_marked(text, _LEAD))
    if len(at):
        first, second, third = (raw[at + k].astype(np.int64) for k in range(3))
        two = first == 0xC2
        code = np.where(two, first << 8 | second, first << 16 | second << 8 | third)
        found = np.isin(code, _WIDE)
        at, two = at[found], two[found]
        out[at] = out[at + 1] = True
        out[at[~two] + 2] = True
    return out


def word_hashes(data: list[bytes], unicode: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each word of all texts in turn, the end of each text in them).

    Words are what stands between ASCII white space, as ``bytes.split`` has it, or with ``unicode`` between what
    ``str.split`` takes for white space in the text.  Different words of the same length up to 8 bytes have different hashes.
    """
    joined = b"".join((b" ", b" ".join(data), b" " * 9))  # a word can be read 8 bytes at a time
    raw = np.frombuffer(joined, np.uint8)
    space = _spaces(joined, raw, unicode)[:len(raw) - 8]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = edge[0::2], edge[1::2] - edge[0::2]
    text_ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    with np.errstate(over="ignore"):
        h = mix((eight[start] & _MASK[np.minimum(size, 8)]) * SALTS[0] + size.astype(np.uint64) * SALTS[1])
        more = np.flatnonzero((size > 8) & (size <= LONG))
        for done in range(8, LONG, 8):
            if not len(more):
                break
            rest = eight[start[more] + done] & _MASK[np.minimum(size[more] - done, 8)]
            h[more] = mix((h[more] ^ rest) * SALTS[2] + SALTS[1])
            more = more[size[more] > done + 8]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(joined[start[i]:start[i] + size[i]])
    return h, np.searchsorted(start, text_ends)
