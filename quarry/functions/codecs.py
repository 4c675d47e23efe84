"""Variable-byte and Elias-gamma codecs as column expressions (Q36, Q37).

Encoders map an ARRAY<BIGINT> of gaps to a lowercase hex string (VB) or a
bit string (gamma; packed into bytes by the posting table). Decoders cut the encoded string into codes with one
``regexp_extract_all`` pass (each code is recognisable by its own prefix),
so decoding is linear in the list length. The posting table's gamma streams are packed and unpacked by ``gamma_pack`` and
``gamma_unpack``, array operations over many lists at once: a place in a column's string is found by counting
characters from its begin, so cutting a long bit string piece by piece takes the square of its length.

VB: 7 data bits per byte, most significant group first; the high bit marks
the LAST byte of a number. Gamma: (length-1) ones, a zero, then the binary
offset without its leading 1; streams are padded to whole bytes with ones.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# One VB number: continuation bytes (< 0x80) followed by a final byte (>= 0x80), as hex digit pairs.
VB_CODE = "(?:[0-7][0-9a-f])*[89a-f][0-9a-f]"
MAX_GAMMA_BITS = 63


def gamma_code_pattern(max_bits: int = MAX_GAMMA_BITS) -> str:
    """Alternation of the gamma code shapes for lengths 1..max_bits (built from the rule)."""
    alts = ["0"] + [f"1{{{k}}}0[01]{{{k}}}" for k in range(1, max_bits)]
    return "|".join(alts)


def vb_bytes(g: Column) -> Column:
    """Number of VB bytes for a gap: ceil(bit length / 7), 1 for 0."""
    return F.floor((F.length(F.bin(g)) + 6) / 7).cast("int")


def vb_encode_gap(g: Column) -> Column:
    k = vb_bytes(g)
    group = lambda i: F.call_function("shiftright", g, i * 7).bitwiseAND(127)
    byte = lambda i: F.lpad(F.lower(F.hex(group(i) + F.when(i == 0, 128).otherwise(0))), 2, "0")
    return F.array_join(F.transform(F.sequence(k - 1, F.lit(0), F.lit(-1)), byte), "")


def vb_encode(gaps: Column) -> Column:
    """ARRAY<BIGINT> gaps -> hex string of the VB byte stream."""
    return F.array_join(F.transform(gaps, vb_encode_gap), "")


def vb_decode(hexs: Column) -> Column:
    """Hex VB stream -> ARRAY<BIGINT> of the encoded numbers."""
    codes = F.regexp_extract_all(hexs, F.lit(VB_CODE), 0)

    def value(code):
        nb = (F.length(code) / 2).cast("int")
        byte = lambda i: F.conv(F.substring(code, i * 2 + 1, 2), 16, 10).cast("bigint") % 128
        return F.aggregate(F.sequence(F.lit(0), nb - 1), F.lit(0).cast("bigint"), lambda acc, i: acc * 128 + byte(i))

    return F.transform(codes, value)


def gamma_code(g: Column) -> Column:
    b = F.bin(g)
    return F.concat(F.repeat(F.lit("1"), F.length(b) - 1), F.lit("0"), F.substring(b, 2, 64))


def gamma_bits(g: Column) -> Column:
    """Code length in bits: 2 * bit length - 1."""
    return (F.length(F.bin(g)) * 2 - 1).cast("bigint")


def gamma_encode(gaps: Column) -> Column:
    """ARRAY<BIGINT> gaps -> unpadded gamma bit string."""
    return F.array_join(F.transform(gaps, gamma_code), "")


def pad_bits(bits: Column, total_bits: Column | None = None) -> Column:
    """Pad with ones to a whole number of bytes (of ``total_bits`` when the stream is split)."""
    total = F.length(bits) if total_bits is None else total_bits
    pad = (F.lit(8) - total % 8) % 8
    return F.concat(bits, F.repeat(F.lit("1"), pad.cast("int")))


def bits_to_hex(bits: Column) -> Column:
    """Bit string of whole bytes -> hex digits, a digit for every four bits."""
    starts = F.sequence(F.lit(1), F.length(bits) - 3, F.lit(4))
    digits = F.transform(starts, lambda i: F.conv(F.substring(bits, i, F.lit(4)), 2, 16))
    return F.when(F.length(bits) < 4, F.lit("")).otherwise(F.array_join(digits, ""))


def hex_to_bits(hexs: Column) -> Column:
    """Hex digits -> bit string: a letter for each digit first, then four bits for each letter."""
    digits, letters = "0123456789ABCDEF", "abcdefghijklmnop"
    out = F.translate(hexs, digits, letters)
    for value, letter in enumerate(letters):
        out = F.replace(out, F.lit(letter), F.lit(f"{value:04b}"))
    return out


def gamma_decode(bits: Column) -> Column:
    """Gamma bit string (padding allowed) -> ARRAY<BIGINT>."""
    codes = F.regexp_extract_all(bits, F.lit(gamma_code_pattern()), 0)

    def value(code):
        k = ((F.length(code) - 1) / 2).cast("int")
        return F.conv(F.concat(F.lit("1"), F.substring(code, k + 2, 64)), 2, 10).cast("bigint")

    return F.transform(codes, value)


def bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits of each positive number."""
    high = x >> 32
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, np.frexp((x & 0xFFFFFFFF).astype(np.float64))[1]).astype(np.int64)


def _within(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values before each one in its list; lists of ``lengths`` lie one after the other."""
    before = np.cumsum(values) - values
    filled = lengths > 0
    return before - np.repeat(before[(np.cumsum(lengths) - lengths)[filled]], lengths[filled])


def gamma_pack(gaps: np.ndarray, lengths: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each list): gamma codes of lists of gaps, list i from bit ``offset[i]`` of its first byte on; other bits are 0."""
    size = bit_lengths(gaps)
    code = 2 * size - 1
    row = np.repeat(np.arange(len(lengths)), lengths)
    bits = np.bincount(row, weights=code, minlength=len(lengths)).astype(np.int64)
    n_bytes = (offset + bits + 7) // 8
    at = ((np.cumsum(n_bytes) - n_bytes) * 8 + offset)[row] + _within(lengths, code)
    out = np.zeros(int(n_bytes.sum()) * 8, np.uint8)
    for b in range(int(size.max(initial=1)) - 1):
        longer = size - 1 > b
        start, last, value = at[longer], (at + code)[longer] - 1, gaps[longer]
        out[start + b] = 1
        out[last - b] = (value >> b) & 1
    return np.packbits(out), n_bytes


def gamma_unpack(data: np.ndarray, n_bytes: np.ndarray, offset: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gaps, gaps of each list): what ``gamma_pack`` packed, ``bits[i]`` bits of list i."""
    flat = np.unpackbits(data)
    place = np.arange(len(flat))
    # The first zero from each bit on ends the ones of a code that begins there; as many bits follow it.
    zero = np.minimum.accumulate(np.where(flat == 0, place, len(flat))[::-1])[::-1]
    after = (2 * zero - place + 1).tolist()
    first = (np.cumsum(n_bytes) - n_bytes) * 8 + offset
    starts, lengths = [], np.zeros(len(n_bytes), np.int64)
    for i, (at, end) in enumerate(zip(first.tolist(), (first + bits).tolist(), strict=True)):
        known = len(starts)
        while at < end:
            starts.append(at)
            at = after[at]
        lengths[i] = len(starts) - known
    start = np.array(starts, np.int64)
    stop = zero[start]
    rest = stop - start
    gaps = np.ones(len(start), np.int64)
    for b in range(int(rest.max(initial=0))):
        more = rest > b
        gaps[more] = gaps[more] << 1 | flat[stop[more] + b + 1]
    return gaps, lengths


def list_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Running sums of the values of each list, its own included."""
    return _within(lengths, values) + values
