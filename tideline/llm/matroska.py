"""Matroska as a media column: a writer for lossless 8-bit samples and a parser of packet tables.

The parser reads variable-length EBML elements, clusters, simple blocks and
block groups with all four kinds of lacing, and cues. A packet is one frame:
track, timestamp, byte range in the file, key flag and place in its lace. The
frames of a lace follow each other by the track's default duration, or by equal
parts of the group's duration; where a file gives neither they share the block's
timestamp. A frame of a group is a key frame if the group refers to no other block.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import by_columns, columns_of

# Element identifiers of the format.
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0x18538067, 0x1549A966, 0x2AD7B1, 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
DEFAULT_DURATION, REFERENCE_BLOCK, BLOCK_DURATION = 0x23E383, 0xFB, 0x9B
CLUSTER, CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
CONTAINERS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS}
NO_LACE, XIPH, FIXED, EBML_LACE = 0, 1, 2, 3

RATE = 8000  # samples a second
FRAME = 512  # samples a frame, 64 ms
LACE = 8  # frames a block
BLOCKS = 16  # blocks a cluster


def vint(value: int, width: int = 0) -> bytes:
    """A size as a variable-length integer; all-ones is kept for "unknown"."""
    width = width or next(n for n in range(1, 9) if value < (1 << 7 * n) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes]) -> tuple[int, bytes]:
    """Flags and body of a block's frames: fixed lacing where all have one size, EBML lacing else."""
    if len(frames) == 1:
        return NO_LACE << 1, frames[0]
    sizes = [len(f) for f in frames]
    if len(set(sizes)) == 1:
        return FIXED << 1, bytes([len(frames) - 1]) + b"".join(frames)
    head = vint(sizes[0])
    for before, now in zip(sizes, sizes[1:-1], strict=False):
        diff = now - before
        width = next(n for n in range(1, 9) if abs(diff) < (1 << 7 * n - 1) - 1)
        head += vint(diff + (1 << 7 * width - 1) - 1, width)
    return EBML_LACE << 1, bytes([len(frames) - 1]) + head + b"".join(frames)


def write(samples: bytes) -> bytes:
    """A file with one track of unsigned 8-bit PCM."""
    head = element(EBML, uint(EBML_VERSION, 1) + uint(EBML_READ_VERSION, 1) + uint(EBML_MAX_ID, 4) + uint(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_VERSION, 4) + uint(DOC_READ_VERSION, 2))
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000))
    audio = element(AUDIO, element(SAMPLING, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(DEFAULT_DURATION, FRAME * 1_000_000_000 // RATE) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    body, cues, at = [info, tracks], [], len(info) + len(tracks)
    per_cluster = FRAME * LACE * BLOCKS
    for start in range(0, len(samples), per_cluster):
        time = start * 1000 // RATE
        blocks = [uint(CLUSTER_TIMESTAMP, time)]
        for offset in range(start, min(start + per_cluster, len(samples)), FRAME * LACE):
            flags, laced = lace([samples[i : i + FRAME] for i in range(offset, min(offset + FRAME * LACE, len(samples)), FRAME)])
            blocks.append(element(SIMPLE_BLOCK, vint(1) + struct.pack(">hB", offset * 1000 // RATE - time, 0x80 | flags) + laced))
        cluster = element(CLUSTER, b"".join(blocks))
        cues.append(element(CUE_POINT, uint(CUE_TIME, time) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    return head + element(SEGMENT, b"".join(body) + element(CUES, b"".join(cues)))


@dataclass
class Media:
    """What a file holds; ``error`` tells where reading stopped, if it did before the end."""

    tracks: list[dict] = field(default_factory=list)
    packets: list[tuple[int, int, int, int, bool, int, int]] = field(default_factory=list)  # track, timestamp ns, offset, size, key, lace kind, index in lace
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, cluster position
    clusters: int = 0
    scale: int = 1_000_000
    error: str | None = None


def read_vint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int]:
    """Value and next offset. A size of all ones is unknown and given as -1."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length integer at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError(f"cut short at byte {at}")
    value = int.from_bytes(data[at : at + width], "big")
    if keep_marker:
        return value, at + width
    value &= (1 << 7 * width) - 1
    return (-1 if value == (1 << 7 * width) - 1 else value), at + width


def parse(data: bytes) -> Media:
    """The packet table of a file. Damaged files give what precedes the damage, and ``error``."""
    media = Media()
    try:
        if data[:4] != EBML.to_bytes(4, "big"):
            raise ValueError("no EBML header")
        _walk(data, 0, len(data), media, {"time": 0, "cue": {}})
    except (ValueError, IndexError, struct.error) as e:
        media.error = str(e) or type(e).__name__
    return media


def _walk(data: bytes, at: int, end: int, media: Media, state: dict) -> None:
    while at < end:
        ident, at = read_vint(data, at, keep_marker=True)
        size, at = read_vint(data, at)
        stop = end if size < 0 else at + size
        if stop > end:
            raise ValueError(f"element {ident:x} at byte {at} passes its parent's end")
        if ident == CLUSTER:
            media.clusters += 1
        elif ident == TRACK_ENTRY:
            media.tracks.append({})
        elif ident == CUE_POINT:
            state["cue"] = {}
        elif ident == BLOCK_GROUP:
            state |= {"first": len(media.packets), "refers": False, "lasts": None}
        if ident in CONTAINERS:
            _walk(data, at, stop, media, state)
            if ident == BLOCK_GROUP:
                _settle_group(media, state)
            if ident == CUE_POINT and CUE_TIME in state["cue"]:
                media.cues.append((state["cue"][CUE_TIME], state["cue"].get(CUE_TRACK, 0), state["cue"].get(CUE_CLUSTER, 0)))
        elif ident in (SIMPLE_BLOCK, BLOCK):
            _frames(data, at, stop, ident == SIMPLE_BLOCK, media, state)
        elif ident == REFERENCE_BLOCK:
            state["refers"] = True
        elif ident == BLOCK_DURATION:
            state["lasts"] = int.from_bytes(data[at:stop], "big")
        elif ident == CLUSTER_TIMESTAMP:
            state["time"] = int.from_bytes(data[at:stop], "big")
        elif ident == TIMESTAMP_SCALE:
            media.scale = int.from_bytes(data[at:stop], "big")
        elif ident in (CUE_TIME, CUE_TRACK, CUE_CLUSTER):
            state["cue"][ident] = int.from_bytes(data[at:stop], "big")
        elif media.tracks and ident in (TRACK_NUMBER, TRACK_TYPE, DEFAULT_DURATION, CHANNELS, BIT_DEPTH):
            media.tracks[-1][ident] = int.from_bytes(data[at:stop], "big")
        elif media.tracks and ident == CODEC_ID:
            media.tracks[-1][ident] = data[at:stop].decode("ascii", "replace")
        elif media.tracks and ident == SAMPLING:
            media.tracks[-1][ident] = struct.unpack(">d" if stop - at == 8 else ">f", data[at:stop])[0]
        at = stop


def _frames(data: bytes, at: int, end: int, simple: bool, media: Media, state: dict) -> None:
    track, at = read_vint(data, at)
    relative, flags = struct.unpack_from(">hB", data, at)
    at += 3
    kind = flags >> 1 & 3
    if kind == NO_LACE:
        sizes = [end - at]
    else:
        count, at = data[at] + 1, at + 1
        sizes = []
        if kind == FIXED:
            if (end - at) % count:
                raise ValueError(f"uneven fixed lace at byte {at}")
            sizes = [(end - at) // count] * count
        elif kind == XIPH:
            for _ in range(count - 1):
                size = 0
                while data[at] == 255:
                    size, at = size + 255, at + 1
                sizes.append(size + data[at])
                at += 1
        else:
            for i in range(count - 1):
                raw, after = read_vint(data, at)
                sizes.append(raw if i == 0 else sizes[-1] + raw - ((1 << 7 * (after - at) - 1) - 1))
                at = after
        if kind != FIXED:
            sizes.append(end - at - sum(sizes))
        if min(sizes) < 0:
            raise ValueError(f"bad lace sizes at byte {at}")
    time = (state["time"] + relative) * media.scale
    step = next((t[DEFAULT_DURATION] for t in media.tracks if t.get(TRACK_NUMBER) == track and DEFAULT_DURATION in t), 0)
    for i, size in enumerate(sizes):
        media.packets.append((track, time + i * step, at, size, bool(simple and flags & 0x80), kind, i))
        at += size


def _settle_group(media: Media, state: dict) -> None:
    """What is known of a group's frames at its end, whatever order its elements had."""
    own = media.packets[state["first"] :]
    for k, (track, time, at, size, _, kind, i) in enumerate(own):
        if state["lasts"] and len({p[1] for p in own}) == 1:
            time += i * state["lasts"] * media.scale // len(own)
        media.packets[state["first"] + k] = (track, time, at, size, not state["refers"], kind, i)


def payload(data: bytes, media: Media, track: int = 1) -> bytes:
    """The stored samples of a track, read back by the packets' byte ranges."""
    view = memoryview(data)
    return b"".join(view[at : at + size] for number, _, at, size, *_ in media.packets if number == track)


PACKETS = "track long, timestamp_ns long, byte_offset long, n_bytes long, key boolean, lacing int, lace_index int"


def packet_table(media: DataFrame, id_col: str, data_col: str) -> DataFrame:
    """A row for each packet of each file: the id, then track, timestamp_ns, byte_offset, n_bytes, key, lacing, lace_index, error.

    A null, empty or foreign value gives one row that has only ``error``; so does a damaged file, after its good packets.
    """
    kind = media.schema[id_col].dataType.simpleString()

    def rows(idents: list, files: list) -> list:
        out = []
        for ident, data in zip(idents, files, strict=True):
            found = parse(data or b"")
            out += [(ident, *p, None) for p in found.packets]
            if found.error:
                out.append((ident, *[None] * 7, found.error))
        return columns_of(out, 9)

    return by_columns(media.select(id_col, F.col(data_col).cast("binary")), rows, f"{id_col} {kind}, {PACKETS}, error string")


def text_payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes with bytes 0 up to a positive multiple of 64, and the length without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64)), len(raw)


def feature(media: Media, samples: bytes) -> str:
    """Packets, clusters, cues and lacings of the file; mean level, zero crossings about 128 and peak of the samples."""
    level = sum(samples) / max(1, len(samples))
    halves = samples.translate(bytes(i >= 96 for i in range(256)))
    crossings = halves.count(b"\x00\x01") + halves.count(b"\x01\x00")
    lacings = "".join(str(k) for k in sorted({p[5] for p in media.packets}))
    last = media.packets[-1][1] if media.packets else 0
    return f"p{len(media.packets)}c{media.clusters}q{len(media.cues)}l{lacings}t{last // 1_000_000}m{level:.4f}x{crossings}h{max(samples, default=0)}"


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text stored as a Matroska file (column media), with n_bytes. Null text: empty, stored as 64 bytes 0.

    A row each, repeated rows and null ids too; other columns, whatever their names, are left behind; an empty table gives
    an empty one. A worker holds the samples and the file of one very long text at a time.
    """

    def rows(idents: list, texts: list) -> list:
        made = [text_payload(t) for t in texts]
        return [idents, [n for _, n in made], [write(p) for p, _ in made]]

    return by_columns(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), rows, "doc_id long, n_bytes long, media binary")


def read_features(media: DataFrame) -> DataFrame:
    """Of each stored file: digests of the payload as read back by the packet table, of the file, and the feature.

    media has doc_id, n_bytes and media, as ``store_texts`` gives them; a null file is read as one without packets.
    """

    def rows(idents: list, lengths: list, files: list) -> list:
        out = []
        for ident, n, data in zip(idents, lengths, files, strict=True):
            data = data or b""
            found = parse(data)
            back = payload(data, found)
            out.append((ident, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature(found, back)))
        return columns_of(out, 8)

    return by_columns(media.select("doc_id", "n_bytes", "media"), rows, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
