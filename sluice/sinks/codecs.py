"""Whole-file compression for the writer.

Every piece of a file is a complete stream of its codec, and streams of these
codecs may follow each other, so a file can be put together from pieces.
"""

from __future__ import annotations

import gzip
import struct

import pyarrow as pa

from sluice.sources.streams import SNAPPY_HEADER

CODECS = ("none", "gzip", "snappy", "zstd")
_SNAPPY_BLOCK = 32 * 1024


class Encoder:
    """Compresses one piece block by block into an open stream."""

    def __init__(self, out, compression: str):
        self.out = out
        self.written = 0
        self._compression = compression
        if compression == "gzip":
            self._inner = gzip.GzipFile(fileobj=self, mode="wb", mtime=0, filename="")
        elif compression == "zstd":
            import zstandard

            self._inner = zstandard.ZstdCompressor().compressobj()
        elif compression == "snappy":
            self._inner = pa.Codec("snappy")
            self._raw(SNAPPY_HEADER)
        elif compression != "none":
            raise ValueError(f"compression must be one of {CODECS}, got {compression!r}")

    def _raw(self, data: bytes) -> int:
        self.written += len(data)
        self.out.write(data)
        return len(data)

    # GzipFile writes its output here.
    write = _raw

    def flush(self) -> None:
        pass

    def feed(self, data: bytes) -> None:
        if self._compression == "none":
            self._raw(data)
        elif self._compression == "gzip":
            self._inner.write(data)
        elif self._compression == "zstd":
            self._raw(self._inner.compress(data))
        else:
            for at in range(0, len(data), _SNAPPY_BLOCK):
                block = self._inner.compress(data[at : at + _SNAPPY_BLOCK], asbytes=True)
                self._raw(struct.pack(">i", len(block)) + block)

    def finish(self) -> int:
        """Ends the piece; the number of bytes it took."""
        if self._compression == "gzip":
            self._inner.close()
        elif self._compression == "zstd":
            self._raw(self._inner.flush())
        return self.written


def encode(data: bytes, compression: str) -> bytes:
    """A small piece, such as a separator, as a complete stream."""
    if not data:
        return b""
    import io

    buffer = io.BytesIO()
    encoder = Encoder(buffer, compression)
    encoder.feed(data)
    encoder.finish()
    return buffer.getvalue()
