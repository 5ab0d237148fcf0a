"""Media columns from baseline JPEG: markers, Huffman-coded scans, luminance thumbnails from the DC terms alone.

``thumbnails`` reads any baseline (sequential, Huffman, 8 bits) stream or run of streams. ``picture`` writes bytes as the samples of such a
thumbnail: one 8x8 block of one grey value per byte, so reading the DC terms gives the bytes back without loss. Restart intervals make the
rows of blocks independent; numpy codes and decodes the intervals of many pictures side by side.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import fields, plain

#: Blocks a row of a written picture has, which is also its restart interval, and the most rows 65,535 lines can hold.
ROW, MAX_ROWS = 64, 8191
#: Code lengths of a written picture: differences of 0 to 8 bits, and the end of a block.
DC_COUNTS, DC_SYMBOLS = [0, 0, 6, 3] + [0] * 12, [3, 4, 5, 6, 2, 1, 0, 7, 8]
AC_COUNTS, AC_SYMBOLS = [1] + [0] * 15, [0]
#: Bytes of text coded at a time, and rows of blocks decoded at a time.
PART_BYTES, LANES = 4 << 20, 1 << 15


def _codes(counts: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length) of a canonical Huffman table."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            out[symbol] = (code, length)
            code += 1
        at, code = at + n, code << 1
    return out


def _coder() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each difference from -255 to 255, with the end of the block."""
    dc, (eob, eob_len) = _codes(DC_COUNTS, DC_SYMBOLS), _codes(AC_COUNTS, AC_SYMBOLS)[0]
    code, length = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        c, n = dc[size]
        code[d + 255] = (((c << size) | (d if d > 0 else d + (1 << size) - 1 if d else 0)) << eob_len) | eob
        length[d + 255] = n + size + eob_len
    return code, length


CODE, LENGTH = _coder()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(rows: int) -> bytes:
    """All markers up to the scan; the first quantiser is 8, so a DC step is one grey level."""
    return b"".join([
        b"\xff\xd8", _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"), _segment(0xDB, bytes([0, 8]) + bytes([1] * 63)),
        _segment(0xC0, struct.pack(">BHHB", 8, 8 * rows, 8 * ROW, 1) + bytes([1, 0x11, 0])),
        _segment(0xC4, bytes([0x00, *DC_COUNTS, *DC_SYMBOLS])), _segment(0xC4, bytes([0x10, *AC_COUNTS, *AC_SYMBOLS])),
        _segment(0xDD, struct.pack(">H", ROW)), _segment(0xDA, bytes([1, 1, 0, 0, 63, 0])),
    ])


def pictures(payloads: list[bytes]) -> list[bytes]:
    """A run of JPEG pictures for each payload, whose length is a positive multiple of ROW."""
    heights: list[list[int]] = []
    for p in payloads:
        rows = len(p) // ROW
        heights.append([min(MAX_ROWS, rows - at) for at in range(0, rows, MAX_ROWS)])
    grey = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ROW).astype(np.int64) - 128
    diff = np.diff(grey, axis=1, prepend=0) + 255
    length = LENGTH[diff]
    end = np.cumsum(length, axis=1)
    start = end - length
    value = CODE[diff].astype(np.uint32) << (24 - (start & 7) - length).astype(np.uint32)
    used = (end[:, -1] + 7) >> 3
    width = int(used.max()) + 4
    buffer = np.zeros(len(grey) * width, np.uint8)
    base = np.arange(len(grey)) * width
    for j in range(ROW):
        at, v = base + (start[:, j] >> 3), value[:, j]
        buffer[at] |= (v >> np.uint32(16)).astype(np.uint8)
        buffer[at + 1] |= (v >> np.uint32(8)).astype(np.uint8)
        buffer[at + 2] |= v.astype(np.uint8)
    spare = -end[:, -1] & 7
    buffer[base + used - 1] |= ((1 << spare) - 1).astype(np.uint8)  # the last byte is filled with ones
    number = np.concatenate([np.arange(h) for hs in heights for h in hs])
    last = np.concatenate([np.arange(h) == h - 1 for hs in heights for h in hs])
    buffer[base + used], buffer[base + used + 1] = 0xFF, 0xD0 + (number & 7)
    table = buffer.reshape(-1, width)
    column = np.arange(width)
    size = used + np.where(last, 0, 2)
    mask = column < size[:, None]
    stuffed = (table == 0xFF) & (column < used[:, None])
    data, extra = table[mask], stuffed[mask]
    repeats = 1 + extra.astype(np.int64)
    out = np.repeat(data, repeats)
    out[np.cumsum(repeats)[extra] - 1] = 0
    ends = np.cumsum(size + stuffed.sum(axis=1))
    coded, at, row, result = out.tobytes(), 0, 0, []
    for hs in heights:
        parts = []
        for h in hs:
            row += h
            parts += [_header(h), coded[at : ends[row - 1]], b"\xff\xd9"]
            at = ends[row - 1]
        result.append(b"".join(parts))
    return result


class Picture:
    """What the markers of one picture say, and where its restart intervals lie (without stuffing)."""

    def __init__(self, data: bytes, at: int):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError(f"no picture begins at byte {at}")
        at += 2
        quant, self.tables, self.interval = {}, {}, 0
        while True:
            while data[at + 1] == 0xFF:
                at += 1
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                    body = body[1 + 64 * (1 + wide) :]
            elif marker in (0xC0, 0xC1):
                if body[0] != 8:
                    raise ValueError("only 8-bit samples are baseline")
                self.height, self.width = struct.unpack(">HH", body[1:5])
                parts = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])}
            elif 0xC2 <= marker <= 0xCF and marker != 0xC4:
                raise ValueError(f"marker {marker:02x} is not baseline")
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.tables[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.interval = int.from_bytes(body, "big")
            elif marker == 0xDA:
                break
        scan = [(*parts[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
        if len(scan) != len(parts):
            raise ValueError("pictures of several scans are not read")
        if len(scan) == 1:
            scan = [(1, 1, *scan[0][2:])]
        self.h, self.v = scan[0][0], scan[0][1]
        widest, highest = max(c[0] for c in scan), max(c[1] for c in scan)
        self.across, down = -(-self.width // (8 * widest)), -(-self.height // (8 * highest))
        self.units, self.step = self.across * down, quant[scan[0][2]]
        self.interval = self.interval or self.units
        #: (is it luminance, DC table, AC table) of the blocks of a unit, in order
        self.blocks = tuple((i == 0, self.tables[c[3]], self.tables[16 + c[4]]) for i, c in enumerate(scan) for _ in range(c[0] * c[1]))
        raw = np.frombuffer(data, np.uint8, offset=at)
        ff = np.flatnonzero(raw[:-1] == 0xFF)
        after = raw[ff + 1]
        stop = ff[(after != 0) & (after != 0xFF) & ((after < 0xD0) | (after > 0xD7))]
        length = int(stop[0])
        inside = ff < length
        ff, after = ff[inside], after[inside]
        keep = np.ones(length, bool)
        keep[ff[after == 0] + 1] = False
        restarts = ff[(after >= 0xD0) & (after <= 0xD7)]
        gone = np.cumsum(~keep)
        self.starts = np.concatenate([[0], restarts + 2 - gone[restarts]]).astype(np.int64)
        self.data = raw[:length][keep]
        self.end = at + length + 2
        if data[self.end - 1] != 0xD9:
            raise ValueError("the picture does not end after its scan")


def _lookup(spec: bytes) -> np.ndarray:
    """16 bits -> symbol * 32 + length; 0 where no code fits."""
    table = np.zeros(1 << 16, np.int32)
    for symbol, (code, length) in _codes(list(spec[:16]), list(spec[16:])).items():
        table[code << (16 - length) : (code + 1) << (16 - length)] = symbol * 32 + length
    return table


_joint_tables: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _joint(dc: bytes, ac: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The DC and AC lookups, and one for whole blocks without AC terms that fit 16 bits: (difference + 4096) * 32 + length, else 0."""
    if (dc, ac) not in _joint_tables:
        if len(_joint_tables) >= 64:
            _joint_tables.clear()
        one, two = _lookup(dc), _lookup(ac)
        bits = np.arange(1 << 16, dtype=np.int64)
        symbol, n = np.minimum(one >> 5, 15), one & 31
        raw = (bits << n & 0xFFFF) >> (16 - symbol)
        diff = np.where(symbol == 0, 0, np.where(raw >> np.maximum(symbol - 1, 0) & 1, raw, raw - (1 << symbol) + 1))
        rest = two[(bits << (n + symbol)) & 0xFFFF]
        total = n + symbol + (rest & 31)
        fits = (one > 0) & (rest > 0) & (rest >> 5 == 0) & (total <= 16)
        _joint_tables[dc, ac] = one, two, np.where(fits, (diff + 4096) * 32 + total, 0).astype(np.int32)
    return _joint_tables[dc, ac]


def _decode(data: np.ndarray, starts: np.ndarray, units: np.ndarray, blocks: tuple) -> np.ndarray:
    """Luminance DC levels, (lane, unit * luminance blocks): all restart intervals (lanes) advance block by block together."""
    data = np.concatenate([data, np.full(16, 0xFF, np.uint8)])
    words = data[:-4].astype(np.int64) << 32
    for i in range(1, 5):
        words |= data[i : len(data) - 4 + i].astype(np.int64) << (32 - 8 * i)

    def peek(at, n=16):
        return words[at >> 3] >> (40 - n - (at & 7)) & ((1 << n) - 1)

    most, grey = int(units.max()), sum(b[0] for b in blocks)
    out = np.zeros((len(starts), most * grey), np.int32)
    at, level = starts * 8, np.zeros(len(starts), np.int64)
    for unit in range(most):
        on = units > unit
        everyone = bool(on.all())
        lanes = slice(None) if everyone else np.flatnonzero(on)
        place = unit * grey
        for luminance, dc, ac in blocks:
            one, two, both = _joint(dc, ac)
            entry = both[peek(at[lanes])]
            diff, step = (entry >> 5) - 4096, (entry & 31).astype(np.int64)
            slow = np.flatnonzero(entry == 0)
            if len(slow):
                pos = (at if everyone else at[lanes])[slow]
                first = pos.copy()
                e = one[peek(pos)]
                if not e.all():
                    raise ValueError("a code is not in the table")
                size = (e >> 5).astype(np.int64)
                pos += e & 31
                raw = peek(pos, 16) >> (16 - size)
                diff[slow] = np.where(size == 0, 0, np.where(raw >> np.maximum(size - 1, 0) & 1, raw, raw - (1 << size) + 1))
                pos += size
                k, live = np.ones(len(slow), np.int64), np.arange(len(slow))
                while len(live):
                    e = two[peek(pos[live])]
                    if not e.all():
                        raise ValueError("a code is not in the table")
                    run, size = (e >> 9), ((e >> 5) & 15)
                    pos[live] += (e & 31) + size
                    k[live] += run + 1
                    ended = (e >> 5 == 0) | (k[live] > 63)
                    live = live[~ended]
                step[slow] = pos - first
            at[lanes] += step
            if luminance:
                level[lanes] += diff
                out[lanes, place] = level[lanes]
                place += 1
    return out


def thumbnails(streams: list[bytes]) -> list[list[np.ndarray]]:
    """For each stream its pictures' thumbnails: a grey value for each 8x8 block of the luminance."""
    found: list[list[Picture]] = []
    for data in streams:
        own, at = [], 0
        while at < len(data):
            own.append(Picture(data, at))
            at = own[-1].end
        found.append(own)
    alike = defaultdict(list)
    for own in found:
        for p in own:
            alike[p.blocks].append(p)
    grids: dict[int, np.ndarray] = {}
    for blocks, group in alike.items():
        while group:
            part, lanes = [], 0
            while group and (not part or lanes + len(group[-1].starts) <= LANES):
                part.append(group.pop())
                lanes += len(part[-1].starts)
            sizes = np.cumsum([0, *(len(p.data) + 2 for p in part)])
            data = np.concatenate([x for p in part for x in (p.data, np.full(2, 0xFF, np.uint8))])
            starts = np.concatenate([p.starts + o for p, o in zip(part, sizes)])
            units = np.concatenate([np.minimum(p.interval, p.units - p.interval * np.arange(len(p.starts))) for p in part])
            levels = _decode(data, starts, units, blocks)
            row = 0
            for p in part:
                n = p.h * p.v
                flat = levels[row : row + len(p.starts), : min(p.interval, p.units) * n].reshape(-1)[: p.units * n]
                row += len(p.starts)
                grid = flat.reshape(-1, p.across, p.v, p.h).transpose(0, 2, 1, 3).reshape(-1, p.across * p.h)[: -(-p.height // 8), : -(-p.width // 8)]
                grids[id(p)] = np.clip((grid * p.step + 4 >> 3) + 128, 0, 255).astype(np.uint8)
    return [[grids[id(p)] for p in own] for own in found]


def thumbnail_hash(grid: np.ndarray) -> str:
    """64 bits: whether the mean of each of 8x9 parts is over that of the part to its left."""
    rows = np.linspace(0, grid.shape[0], 9).astype(int)
    columns = np.linspace(0, grid.shape[1], 10).astype(int)
    sums = np.pad(grid.astype(np.int64).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    top, bottom, left, right = rows[:-1], np.maximum(rows[1:], rows[:-1] + 1).clip(max=grid.shape[0]), columns[:-1], np.maximum(columns[1:], columns[:-1] + 1).clip(max=grid.shape[1])
    top, left = np.minimum(top, bottom - 1), np.minimum(left, right - 1)
    total = sums[np.ix_(bottom, right)] - sums[np.ix_(top, right)] - sums[np.ix_(bottom, left)] + sums[np.ix_(top, left)]
    mean = total / ((bottom - top)[:, None] * (right - left)[None, :])
    return np.packbits(mean[:, 1:] > mean[:, :-1]).tobytes().hex()


def _parts(batch: pa.RecordBatch, column: str, most: int) -> Iterator[tuple[int, list[bytes]]]:
    begun, size, held = 0, 0, []
    for i, value in enumerate(batch.column(column)):
        held.append(value.as_py())
        size += len(held[-1])
        if size >= most:
            yield begun, held
            begun, size, held = i + 1, 0, []
    if held:
        yield begun, held


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the UTF-8 bytes of each text, with zeros up to a positive multiple of 64, as baseline JPEG.

    Missing and empty texts are 64 zeros. A text over 524,224 bytes becomes a run of pictures. Rows come back for all rows.
    """
    rows = fields(docs, "doc_id", "text").select("doc_id", plain("text").cast("binary").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, texts in _parts(batch, "text", PART_BYTES):
                media = pictures([t + bytes(-len(t) % ROW if t else ROW) for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begun, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def media_columns(media: DataFrame, *keys: str) -> DataFrame:
    """The columns ``keys`` and media of a table of JPEG bytes, with width, height, pictures, thumbnail and thumb_hash.

    ``thumbnail`` holds the grey values row by row, picture after picture. ``width`` and ``height`` are those of all pictures below each other,
    and ``thumb_hash`` is the hashes of all pictures in their order. Missing or empty media give missing columns; bytes that are not baseline
    JPEG are an error.
    """
    rows = fields(media, *keys, "media")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, streams in _parts(batch.set_column(batch.schema.get_field_index("media"), "media", batch.column("media").fill_null(b"")), "media", 2 * PART_BYTES):
                grids = thumbnails(streams)
                columns = [
                    pa.array([8 * max(x.shape[1] for x in g) if g else None for g in grids], pa.int32()), pa.array([8 * sum(x.shape[0] for x in g) if g else None for g in grids], pa.int32()),
                    pa.array([len(g) or None for g in grids], pa.int32()), pa.array([b"".join(x.tobytes() for x in g) if g else None for g in grids], pa.binary()),
                    pa.array(["".join(map(thumbnail_hash, g)) if g else None for g in grids], pa.string())]
                yield pa.RecordBatch.from_arrays([*(c.slice(begun, len(streams)) for c in batch.columns), *columns], [*batch.schema.names, "width", "height", "pictures", "thumbnail", "thumb_hash"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{own}, width int, height int, pictures int, thumbnail binary, thumb_hash string")
