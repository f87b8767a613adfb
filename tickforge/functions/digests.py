"""`values.dice` for many numbers at once: MD5 over arrays, for texts that share their length and end in a number."""

from __future__ import annotations

import numpy as np

_TURNS = [int(x) for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for _ in range(4) for x in four]
_SINES = [int(x) for x in np.floor(np.abs(np.sin(np.arange(1.0, 65.0))) * 2**32)]
_WORDS = [*range(16), *((5 * i + 1) % 16 for i in range(16)), *((3 * i + 5) % 16 for i in range(16)), *(7 * i % 16 for i in range(16))]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: A text's bytes, beside its end and its length.
MOST = 55


def _halves(words: list, shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the digests of one block; a word is a number or an array."""
    a, b, c, d = (np.full(shape, x, np.uint32) for x in _START)
    f = np.empty(shape, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        word = words[_WORDS[i]]
        plain = isinstance(word, int)
        f += a
        f += np.uint32((_SINES[i] + (word if plain else 0)) & 0xFFFFFFFF)
        if not plain:
            f += word
        np.right_shift(f, np.uint32(32 - _TURNS[i]), out=a)
        f <<= np.uint32(_TURNS[i])
        a |= f
        a += b
        a, b, c, d = d, a, b, c
    a += np.uint32(_START[0])
    b += np.uint32(_START[1])
    return a, b


def first_digits(heads: list[bytes], numbers: np.ndarray) -> np.ndarray:
    """Of each head (all of one length) and number (none negative, all with as many digits): the digest's first 15 hexadecimal digits.

    Result: a row a head, uint64.
    """
    size, digits = len(heads[0]), len(str(int(numbers[0])))
    total = size + digits
    if total > MOST:
        raise ValueError(f"texts of {MOST} bytes at most")
    own = size % 4  # bytes of the head in the word where the number begins
    tail = np.zeros((len(numbers), (own + digits) // 4 * 4 + 4), np.uint8)
    rest = numbers.astype(np.int64)
    for at in range(own + digits - 1, own - 1, -1):
        rest, last = np.divmod(rest, 10)
        tail[:, at] = last + 48
    tail[:, own + digits] = 0x80
    tail = np.ascontiguousarray(tail.view("<u4").T)
    head = np.frombuffer(b"".join(h + bytes(4 - own) for h in heads), "<u4").reshape(len(heads), -1).T
    # The longer axis is the last one, along which arrays are worked on.
    turned = len(heads) > len(numbers)
    of_head, of_number = (np.s_[None, :], np.s_[:, None]) if turned else (np.s_[:, None], np.s_[None, :])
    words: list = [0] * 16
    for at in range(size // 4):
        words[at] = head[at][of_head]
    for at, column in enumerate(tail):
        words[size // 4 + at] = column[of_number] | head[-1][of_head] if at == 0 else column[of_number]
    words[14] = 8 * total
    a, b = _halves(words, (len(numbers), len(heads)) if turned else (len(heads), len(numbers)))
    out = (a.byteswap().astype(np.uint64) << np.uint64(28)) | (b.byteswap() >> np.uint32(4)).astype(np.uint64)
    return out.T if turned else out
