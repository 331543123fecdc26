"""WAV files as bytes: chunks, sample formats, headers, sample values."""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

# Format tags of the chunk "fmt ", and the tag whose real one stands further on.
INTEGERS, FLOATS, EXTENSIBLE = 1, 3, 0xFFFE
_PAGE = 4096


@dataclass
class Format:
    tag: int
    channels: int
    rate: int
    byte_rate: int
    align: int
    bits: int
    data_at: int
    data_bytes: int

    @property
    def frames(self) -> int:
        return self.data_bytes // self.align


class Pages:
    """Bytes of a file by position, read in pages, and how many were read."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size, self.taken, self.at, self.page = read, size, 0, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if not self.at <= at <= at + n <= self.at + len(self.page):
            # The first page holds what stands before the samples in most files; later ones are a chunk's head.
            want = min(max(n, _PAGE if at == 0 else 64), self.size - at)
            self.at, self.page = at, bytes(self.read(at, want))
            self.taken += len(self.page)
        return self.page[at - self.at : at - self.at + n]


def find_samples(pages: Pages) -> Format | None:
    """The format of a RIFF WAVE file and where its samples are, however many chunks stand before; null for other files.

    Samples are whole or floating-point numbers of whole bytes. A file that was cut off, or written without knowing its
    length, has the samples that are there.
    """
    outer = pages.get(0, 12)
    if outer[:4] != b"RIFF" or outer[8:12] != b"WAVE":
        return None
    at, found = 12, None
    while at + 8 <= pages.size:
        head = pages.get(at, 8)
        name, size = head[:4], int.from_bytes(head[4:], "little")
        if name == b"fmt ":
            form = pages.get(at + 8, min(size, 40))
            if len(form) < 16:
                return None
            tag, channels, rate, byte_rate, align, bits = struct.unpack("<HHIIHH", form[:16])
            if tag == EXTENSIBLE and len(form) >= 26:
                tag = int.from_bytes(form[24:26], "little")
            wide = bits in ((8, 16, 24, 32) if tag == INTEGERS else (32, 64) if tag == FLOATS else ())
            if not wide or not channels or not rate or align != channels * bits // 8:
                return None
            found = Format(tag, channels, rate, byte_rate, align, bits, 0, 0)
        elif name == b"data":
            if found is not None:
                found.data_at, found.data_bytes = at + 8, max(0, min(size, pages.size - at - 8))
            return found
        at += 8 + size + size % 2
    return None


def header(data_bytes: int, rate: int, channels: int, bits: int, tag: int = INTEGERS) -> bytes:
    align = channels * bits // 8
    # Lengths beyond 32 bits are written as the greatest, as streams without a known length do.
    size, outer = (min(x, 0xFFFFFFFF) for x in (data_bytes, data_bytes + 36))
    return b"RIFF" + struct.pack("<I", outer) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, tag, channels, rate, rate * align, align, bits) + b"data" + struct.pack("<I", size)


def decode(data: bytes, channels: int, bits: int, tag: int) -> np.ndarray:
    """Samples as rows of channels, in steps of 16 bits: whole numbers of 16 bits stay, others are scaled to them."""
    data = data[: len(data) - len(data) % (channels * bits // 8)]
    if tag == FLOATS:
        values = np.nan_to_num(np.frombuffer(data, f"<f{bits // 8}").astype(np.float64), nan=0.0, posinf=1.0, neginf=-1.0) * 32768
    elif bits == 8:
        values = (np.frombuffer(data, np.uint8).astype(np.float64) - 128) * 256
    elif bits == 24:
        wide = np.zeros((len(data) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, 3)
        values = wide.view("<i4").ravel() / 65536
    else:
        values = np.frombuffer(data, f"<i{bits // 8}").astype(np.float64) / (1 << (bits - 16))
    return values.reshape(-1, channels)


def encode16(values: np.ndarray) -> bytes:
    """Samples in steps of 16 bits, rounded to the nearest step, halves upwards, and held within 16 bits."""
    return np.clip(np.floor(values + 0.5), -32768, 32767).astype("<i2").tobytes()
