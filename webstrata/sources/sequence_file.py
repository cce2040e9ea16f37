"""SequenceFiles written record by record, for sinks that decide in the task when a file is full.

Hadoop's output formats write one file per task and refuse compression of single records. Reading stays with Hadoop."""

from __future__ import annotations

import os
import zlib

# Fixed values of the format: version 6, serialised class names, escape before a sync mark.
_TEXT = b"\x19org.apache.hadoop.io.Text"
_CODEC = b"\x2aorg.apache.hadoop.io.compress.DefaultCodec"
_ESCAPE = b"\xff\xff\xff\xff"
#: Bytes between sync marks, and of a block of records that are compressed together.
SYNC_BYTES, BLOCK_BYTES = 100_000, 1_000_000


def variable_int(n: int) -> bytes:
    """A non-negative number as a Hadoop variable-length int."""
    if n <= 127:
        return bytes([n])
    size = (n.bit_length() + 7) // 8
    return bytes([144 - size]) + n.to_bytes(size, "big")


#: Bytes at the beginning of a file that hold version, class names and flags.
HEADER_BYTES = 1024


def compression_of(header: bytes) -> str | None:
    """NONE, RECORD or BLOCK by the flags of a header, whatever its class names; None if it is none."""
    if header[:3] != b"SEQ":
        return None
    at = 4
    for _ in range(2):  # class names are shorter than 128 bytes
        at += 1 + header[at]
    compressed, block = header[at : at + 2]
    return "BLOCK" if block else "RECORD" if compressed else "NONE"


class SequenceFileWriter:
    """Appends pairs of serialised ``Text`` to a stream; ``kind`` is NONE, RECORD or BLOCK."""

    def __init__(self, stream, kind: str):
        self.stream, self.kind, self.sync = stream, kind, os.urandom(16)
        compressed = kind != "NONE"
        flags = bytes([compressed, kind == "BLOCK"])
        stream.write(b"SEQ\x06" + _TEXT + _TEXT + flags + (_CODEC if compressed else b"") + bytes(4) + self.sync)
        self.since_sync = 0
        self._new_block()

    def _new_block(self) -> None:
        self.keys: list[bytes] = []
        self.values: list[bytes] = []
        self.block_bytes = 0

    def append(self, key: bytes, value: bytes) -> None:
        if self.kind == "BLOCK":
            self.keys.append(key)
            self.values.append(value)
            self.block_bytes += len(key) + len(value)
            if self.block_bytes >= BLOCK_BYTES:
                self._flush()
            return
        if self.kind == "RECORD":
            value = zlib.compress(value)
        if self.since_sync >= SYNC_BYTES:
            self.stream.write(_ESCAPE + self.sync)
            self.since_sync = 0
        self.stream.write((len(key) + len(value)).to_bytes(4, "big") + len(key).to_bytes(4, "big") + key)
        self.stream.write(value)
        self.since_sync += 8 + len(key) + len(value)

    def _flush(self) -> None:
        """Write a block: the number of records, then lengths and bytes of keys and values, each compressed."""
        if not self.keys:
            return
        self.stream.write(_ESCAPE + self.sync + variable_int(len(self.keys)))
        for items in (self.keys, self.values):
            for data in (b"".join(variable_int(len(x)) for x in items), b"".join(items)):
                packed = zlib.compress(data)
                self.stream.write(variable_int(len(packed)))
                self.stream.write(packed)
        self._new_block()

    def close(self) -> None:
        self._flush()
        self.stream.close()
