"""Reader for the tagged binary format of saves. Small helper for tasks."""

import gzip
import struct
import zlib

import numpy as np

# fixed values: tag number to big-endian number format
NUMBERS = {1: "b", 2: "h", 3: "i", 4: "q", 5: "f", 6: "d"}
ARRAYS = {7: ">i1", 11: ">i4", 12: ">i8"}


def inflate(payload: bytes, kind: int) -> bytes:
    """Undo chunk compression: 1 gzip, 2 zlib, 3 none."""
    if kind == 3:
        return payload
    if kind in (1, 2):
        return gzip.decompress(payload) if kind == 1 else zlib.decompress(payload)
    raise ValueError(f"unknown compression {kind}")


class _Reader:
    def __init__(self, data):
        self.data, self.at = data, 0

    def take(self, fmt):
        fmt = ">" + fmt
        out = struct.unpack_from(fmt, self.data, self.at)
        self.at += struct.calcsize(fmt)
        return out[0]

    def text(self):
        n = self.take("H")
        self.at += n
        return bytes(self.data[self.at - n:self.at]).decode("utf-8", "replace")

    def value(self, tag):
        if tag in NUMBERS:
            return self.take(NUMBERS[tag])
        if tag in ARRAYS:
            n = self.take("i")
            out = np.frombuffer(self.data, ARRAYS[tag], n, self.at)
            self.at += out.nbytes
            return out
        if tag == 8:
            return self.text()
        if tag == 9:
            inner, n = self.take("b"), self.take("i")
            return [self.value(inner) for _ in range(n)]
        if tag == 10:
            out = {}
            while (inner := self.take("b")) != 0:
                name = self.text()
                out[name] = self.value(inner)
            return out
        raise ValueError(f"unknown tag {tag}")


def read(data: bytes) -> dict:
    """Content of the root compound."""
    r = _Reader(data)
    tag = r.take("b")
    r.text()
    return r.value(tag)
