"""Ogg media columns: page checksums, lacing values, logical streams and granule positions.

A stored payload is an Ogg file with two logical streams: 8-bit unsigned PCM samples, one byte a sample, and an
information stream that carries the length before padding. Reading verifies every page, so damage never passes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, types as T

from corpusmill.llm.batches import map_rows

#: Samples in a packet; a payload is padded to a multiple of it.
FRAME = 576
RATE = 48_000
#: Serial numbers of the two logical streams, so that equal payloads give equal files.
SAMPLES, INFO = 1, 2
CONTINUED, FIRST, LAST = 1, 2, 4
#: The PCM header has magic, version 0.0, format 1 (8-bit unsigned), rate, bits, channels, frames, extra headers.
PCM_HEADER = struct.Struct(">8sHHIIBBHI")
PAGE_HEADER = struct.Struct("<4sBBqIIIB")
MIRRORED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_checksum(page: bytes) -> int:
    """CRC of polynomial 0x04C11DB7, highest bit first and starting from 0, by way of the mirrored CRC of zlib."""
    state = zlib.crc32(page.translate(MIRRORED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int(f"{state:032b}"[::-1], 2)


def page(serial: int, number: int, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
    """One page with its checksum in place."""
    bare = PAGE_HEADER.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing + body
    return bare[:22] + struct.pack("<I", page_checksum(bare)) + bare[26:]


def stream_pages(serial: int, packets: list[bytes], granules: list[int]) -> list[bytes]:
    """Pages of a logical stream; the first packet has a page of its own, later ones may run over several pages."""
    pages: list[bytes] = []

    def close(lacing: bytearray, body: list[bytes], granule: int, continued: bool, last: bool) -> None:
        flags = CONTINUED * continued | FIRST * (not pages) | LAST * last
        pages.append(page(serial, len(pages), flags, granule, bytes(lacing), b"".join(body)))

    lacing, body, granule, continued = bytearray(), [], -1, False
    for k, (data, at) in enumerate(zip(packets, granules, strict=True)):
        left = b"\xff" * (len(data) // 255) + bytes([len(data) % 255])
        offset = 0
        while left:
            part, left = left[: 255 - len(lacing)], left[255 - len(lacing) :]
            n = sum(part)
            lacing += part
            body.append(data[offset : offset + n])
            offset += n
            granule = granule if left else at
            final = k == len(packets) - 1 and not left
            if len(lacing) == 255 or k == 0 and not left or final:
                close(lacing, body, granule, continued, final)
                lacing, body, granule, continued = bytearray(), [], -1, bool(left)
    return pages


def write(payload: bytes, n_bytes: int) -> bytes:
    """The Ogg file of a payload whose length is a positive multiple of FRAME."""
    head = PCM_HEADER.pack(b"PCM     ", 0, 0, 1, RATE, 8, 1, FRAME, 1)
    comment = struct.pack("<I", 0) * 2
    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    samples = stream_pages(SAMPLES, [head, comment, *frames], [0, 0, *range(FRAME, len(payload) + 1, FRAME)])
    info = stream_pages(INFO, [b"length\0\0", struct.pack("<Q", n_bytes)], [0, len(payload)])
    return b"".join([samples[0], info[0], *samples[1:-1], info[1], *samples[-1:]])


@dataclass
class Stream:
    """What is known of a logical stream while its pages pass by."""

    packets: list[bytes] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    rest: list[bytes] | None = None
    next_number: int = 0
    lost: int = 0


def pages_of(data: bytes):
    """(flags, granule, serial, number, lacing, body, sound) of each page; goes on at the next page after damage."""
    at = data.find(b"OggS")
    while 0 <= at <= len(data) - 27:
        magic, version, flags, granule, serial, number, crc, n = PAGE_HEADER.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        whole = data[at:end]
        if len(lacing) == n and end <= len(data) and page_checksum(whole[:22] + bytes(4) + whole[26:]) == crc:
            yield flags, granule, serial, number, lacing, whole[27 + n :], True
            at = data.find(b"OggS", end)
        else:
            yield flags, granule, serial, number, lacing, b"", False
            at = data.find(b"OggS", at + 4)


def demultiplex(data: bytes) -> tuple[dict[int, Stream], int, int]:
    """Logical streams by serial number, number of sound pages, number of damaged pages.

    Packets that reach into a damaged or missing page are lost. A packet's place in time is counted back from the
    granule position of the page that it ends on: one sample a byte, none for header packets (granule 0).
    """
    streams: dict[int, Stream] = {}
    sound = damaged = 0
    for flags, granule, serial, number, lacing, body, good in pages_of(data):
        if not good:
            damaged += 1
            continue
        sound += 1
        s = streams.setdefault(serial, Stream())
        if number != s.next_number:
            s.lost += s.rest is not None
            s.rest = None
        s.next_number = number + 1
        values = np.frombuffer(lacing, np.uint8)
        cuts = np.cumsum(values, dtype=np.int64)[values < 255].tolist()
        edges = [0, *cuts]
        pieces = [body[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        tail = body[edges[-1] :] if len(values) and values[-1] == 255 else None
        if flags & CONTINUED:
            if s.rest is None:  # its beginning is gone
                s.lost += bool(pieces)
                pieces = pieces[1:]
                tail = tail if cuts else None
            elif pieces:
                pieces[0] = b"".join([*s.rest, pieces[0]])
            elif tail is not None:
                s.rest.append(tail)
        elif s.rest is not None:
            s.lost += 1
        end, spans = granule, []
        for p in reversed(pieces):
            begin = max(0, end - len(p)) if granule > 0 else 0
            spans.append((begin, end))
            end = begin
        spans.reverse()
        s.packets += pieces
        s.starts += [a for a, _ in spans]
        s.ends += [b for _, b in spans]
        if pieces or not flags & CONTINUED or s.rest is None:
            s.rest = [tail] if tail is not None else None
    return streams, sound, damaged


def padded(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of a text, filled with bytes 255 up to a positive multiple of FRAME, and its length before."""
    raw = (text or "").encode()
    size = max(FRAME, -(-len(raw) // FRAME) * FRAME)
    return raw + b"\xff" * (size - len(raw)), len(raw)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts as Ogg files: id, media binary.

    Null is stored as an empty text, a text of any length whole, over as many pages as it takes; repeated rows are stored each, an empty
    table gives an empty one, and other columns are ignored, whatever their names.
    """
    return map_rows(docs, [id_col, text_col], 1, [T.StructField("media", T.BinaryType())], lambda: lambda texts: [[write(*padded(t)) for t in texts]])


def packets(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row a packet: id, serial, packet_no, data, start_sec, end_sec. Null or alien bytes have no packets."""
    kind = T.ArrayType(T.StructType([
        T.StructField("serial", T.LongType()), T.StructField("packet_no", T.IntegerType()), T.StructField("data", T.BinaryType()),
        T.StructField("start_sec", T.DoubleType()), T.StructField("end_sec", T.DoubleType()),
    ]))

    def listed(data: bytes | None) -> list[dict]:
        return [
            {"serial": serial, "packet_no": i, "data": p, "start_sec": a / RATE, "end_sec": b / RATE}
            for serial, s in sorted(demultiplex(data or b"")[0].items())
            for i, (p, a, b) in enumerate(zip(s.packets, s.starts, s.ends, strict=True))
        ]

    rows = map_rows(media, [id_col, media_col], 1, [T.StructField("packet", kind)], lambda: lambda column: [[listed(x) for x in column]])
    return rows.selectExpr(f"`{id_col}`", "inline(packet)")


def features(samples: bytes, stream: Stream, n_pages: int, damaged: int) -> str:
    """Duration from granule positions and amplitude statistics of 8-bit samples, as text."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0))) if len(x) else 0
    duration = max(stream.ends, default=0) / RATE
    mean = x.mean() if len(x) else 0.0
    power = float((x * x).mean()) if len(x) else 0.0
    return (
        f"rate={RATE};packets={len(stream.packets)};pages={n_pages};damaged={damaged};seconds={duration:.6f};"
        f"mean={mean:.4f};rms={power ** 0.5:.4f};peak={int(np.abs(x).max()) if len(x) else 0};crossings={crossings}"
    )


def read(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Read Ogg files back: id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    Null or alien bytes give an empty payload, and a file that doesn't tell its length has that of its payload; a damaged page loses its packets, and the feature tells how many
    pages were damaged. Files of any length are read whole. Repeated rows give repeated results, an empty table none; other columns are ignored.
    """
    names = [("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]

    def one(data: bytes) -> tuple:
        streams, sound, damaged = demultiplex(data)
        samples, info = streams.get(SAMPLES, Stream()), streams.get(INFO, Stream())
        payload = b"".join(samples.packets[2:])
        told = info.packets[1] if len(info.packets) > 1 else b""
        n = min(struct.unpack("<Q", told)[0], len(payload)) if len(told) == 8 else len(payload)
        return n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), features(payload, samples, sound, damaged)

    def run(column: list[bytes | None]) -> list:
        rows = [one(x or b"") for x in column]
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in names]

    return map_rows(media, [id_col, media_col], 1, [T.StructField(*x) for x in names], lambda: run)
