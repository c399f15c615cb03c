"""Baseline JPEG, grey, in numpy: entropy coding and decoding of quantised coefficients, many restart intervals at once.

A restart interval is byte-aligned and starts with no prediction, so each is a lane of its own: the decoder walks all
lanes in step, one symbol of each a turn. Images without restart markers are one lane each. Coefficients are kept in
the file's own (zigzag) order and never go through a cosine transform, so storing them is lossless.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BLOCK = 64
#: Blocks between restart markers, and coefficients that one pass works on.
INTERVAL, PASS = 4, 1 << 21
#: Step of the DC coefficient: 8 makes a block's mean the coefficient itself.
DC_STEP = 8

# Code lengths of this writer's tables: the frequent symbols by rank, all others 16 bits.
AC_LENGTHS = {0x05: 1, 0x04: 2, 0x07: 3, 0x06: 4, 0x03: 5, 0x08: 6, 0x02: 8, 0x01: 8, 0x00: 9, 0xF0: 9}
AC_LENGTHS |= {run << 4 | size: 15 for run in range(1, 16) for size in range(1, 9)}
DC_LENGTHS = {size: 4 for size in range(12)}


def canonical(lengths: dict[int, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A Huffman table as in a DHT segment, and code and length of each symbol."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    code, last = 0, 0
    codes, sizes = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    for symbol in order:
        code <<= lengths[symbol] - last
        last = lengths[symbol]
        codes[symbol], sizes[symbol] = code, last
        code += 1
    assert code <= (1 << last) - 1, "the code of ones alone stays free"
    counts = bytes(sum(n == k for n in lengths.values()) for k in range(1, 17))
    return counts + bytes(order), codes, sizes


DC_TABLE, DC_CODE, DC_SIZE = canonical(DC_LENGTHS)
AC_TABLE, AC_CODE, AC_SIZE = canonical(AC_LENGTHS)
CATEGORY = np.array([int(v).bit_length() for v in range(4096)], np.int64)


def segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def header(width: int, height: int, interval: int, comment: bytes) -> bytes:
    """Everything before the scan's data: one component, 8-bit samples."""
    steps = bytes([DC_STEP]) + bytes([1]) * (BLOCK - 1)
    return b"".join((
        b"\xff\xd8", segment(0xFE, comment), segment(0xDB, b"\x00" + steps),
        segment(0xC0, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + b"\x01\x01\x11\x00"),
        segment(0xC4, b"\x00" + DC_TABLE), segment(0xC4, b"\x10" + AC_TABLE), segment(0xDD, interval.to_bytes(2, "big")),
        segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
    ))


def extra_bits(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A coefficient's own bits: itself, or one's complement if negative."""
    return (value + np.where(value < 0, (1 << size) - 1, 0)).astype(np.uint64)


def encode_intervals(blocks: np.ndarray, first: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of restart intervals, each followed by its restart marker, and the bounds of each.

    blocks: coefficients, (n, 64). first: first block of each interval and one past the last. number: of each
    interval within its image."""
    n = len(blocks)
    dc = blocks[:, 0].astype(np.int64)
    diff = np.diff(dc, prepend=0)
    diff[first[:-1]] = dc[first[:-1]]
    dc_size = CATEGORY[np.abs(diff)]
    block, place = np.nonzero(blocks[:, 1:])
    value = blocks[block, place + 1].astype(np.int64)
    before = np.empty_like(place)
    before[0:1] = -1
    before[1:] = np.where(block[1:] == block[:-1], place[:-1], -1)
    run = place - before - 1
    skips = run >> 4
    size = CATEGORY[np.abs(value)]
    symbol = (run & 15) << 4 | size
    in_block = np.bincount(block, minlength=n)
    zeros = np.bincount(block, weights=skips, minlength=n).astype(np.int64) if skips.any() else np.zeros(n, np.int64)
    last = np.full(n, -1)
    last[block] = place
    ends = (last < BLOCK - 2).astype(np.int64)
    token_of = np.concatenate(([0], np.cumsum(1 + in_block + zeros + ends)))
    total = int(token_of[-1])
    bits, length = np.empty(total, np.uint64), np.empty(total, np.int64)
    bits[token_of[:-1]] = DC_CODE[dc_size] << dc_size.astype(np.uint64) | extra_bits(diff, dc_size)
    length[token_of[:-1]] = DC_SIZE[dc_size] + dc_size
    if zeros.any():
        bits[:], length[:] = np.where(np.isin(np.arange(total), token_of[:-1]), bits, AC_CODE[0xF0]), np.where(np.isin(np.arange(total), token_of[:-1]), length, AC_SIZE[0xF0])
    start = np.concatenate(([0], np.cumsum(in_block)))[:-1]
    skipped = np.cumsum(skips)
    at = token_of[block] + 1 + np.arange(len(block)) - start[block] + skipped - (np.concatenate(([0], np.cumsum(zeros)))[:-1])[block]
    bits[at] = AC_CODE[symbol] << size.astype(np.uint64) | extra_bits(value, size)
    length[at] = AC_SIZE[symbol] + size
    stop = token_of[1:][ends > 0] - 1
    bits[stop], length[stop] = AC_CODE[0], AC_SIZE[0]

    sums = np.concatenate(([0], np.cumsum(length)))
    edge = sums[token_of[first]]
    n_bits = np.diff(edge)
    n_bytes = (n_bits + 7) >> 3
    byte_of = np.concatenate(([0], np.cumsum(n_bytes)))
    shift = byte_of[:-1] * 8 - edge[:-1]
    position = sums[:-1] + np.repeat(shift, np.diff(token_of[first]))
    word, room = position >> 5, 32 - (position & 31) - length
    words = np.zeros((int(byte_of[-1]) + 11) // 4, np.uint64)
    head = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    fits = np.where(room >= 0, bits << np.maximum(room, 0).astype(np.uint64), bits >> np.maximum(-room, 0).astype(np.uint64))
    words[word[head]] = np.add.reduceat(fits, head)
    over = np.flatnonzero(room < 0)
    words[word[over] + 1] |= (bits[over] << (32 + room[over]).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
    raw = words.astype(">u4").view(np.uint8)[: byte_of[-1]]
    raw[byte_of[1:] - 1] |= ((1 << (n_bytes * 8 - n_bits)) - 1).astype(np.uint8)
    stuffed = raw == 0xFF
    own = np.repeat(np.arange(len(number)), n_bytes)
    place = np.arange(len(raw)) + np.concatenate(([0], np.cumsum(stuffed)))[:-1] + 2 * own
    bounds = byte_of + np.concatenate(([0], np.cumsum(stuffed)))[byte_of] + 2 * np.arange(len(byte_of))
    out = np.zeros(bounds[-1], np.uint8)
    out[place] = raw
    out[bounds[1:] - 2], out[bounds[1:] - 1] = 0xFF, 0xD0 + number % 8
    return out, bounds


def encode(payloads: list[np.ndarray]) -> list[bytes]:
    """JPEG files that hold the payloads (bytes, a positive multiple of 64 each) as coefficients less 128. The comment
    holds the number of blocks in use; the image is about square, and blocks beyond that number are grey."""
    images, parts, lengths, numbers = [], [], [], []
    for p in payloads:
        used = len(p) // BLOCK
        wide = min(8191, int(np.ceil(np.sqrt(used))))
        high = -(-used // wide)
        if high > 8191:
            raise ValueError("a payload over 4 GB needs several images")
        blocks = np.zeros((wide * high, BLOCK), np.int16)
        blocks[:used] = p.reshape(-1, BLOCK)
        blocks[:used] -= 128
        n = -(-wide * high // INTERVAL)
        images.append((wide, high, used, n))
        parts.append(blocks)
        lengths.append(np.minimum(INTERVAL, wide * high - INTERVAL * np.arange(n)))
        numbers.append(np.arange(n))
    blocks, lengths, numbers = np.concatenate(parts), np.concatenate(lengths), np.concatenate(numbers)
    first = np.concatenate(([0], np.cumsum(lengths)))
    scans, bounds, step = [], [np.zeros(1, np.int64)], max(1, PASS // BLOCK // INTERVAL)
    for i in range(0, len(lengths), step):
        j = min(len(lengths), i + step)
        data, ends = encode_intervals(blocks[first[i] : first[j]], first[i : j + 1] - first[i], numbers[i:j])
        scans.append(data)
        bounds.append(ends[1:] + bounds[-1][-1])
    scan, bounds = np.concatenate(scans), np.concatenate(bounds)
    out, at = [], 0
    for wide, high, used, n in images:
        body = scan[bounds[at] : bounds[at + n] - 2].tobytes()
        out.append(header(wide * 8, high * 8, INTERVAL, used.to_bytes(8, "big")) + body + b"\xff\xd9")
        at += n
    return out


@dataclass
class Parsed:
    """What the markers of a file say. tables: (class, number) to DHT body; scan: offset of the entropy-coded data."""

    width: int = 0
    height: int = 0
    interval: int = 0
    comment: bytes = b""
    steps: dict[int, bytes] = field(default_factory=dict)
    tables: dict[int, bytes] = field(default_factory=dict)
    scan: int = 0
    chosen: tuple[int, int] = (0, 0)
    quantiser: int = 0


def parse(file: bytes) -> Parsed:
    """Walks the marker segments up to the scan. Raises for anything but baseline files of one component."""
    if file[:2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    out, at = Parsed(), 2
    while True:
        if at + 4 > len(file) or file[at] != 0xFF:
            raise ValueError("broken marker segment")
        marker, size = file[at + 1], int.from_bytes(file[at + 2 : at + 4], "big")
        body = file[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC0:
            if body[0] != 8 or body[5] != 1:
                raise ValueError("only one component of 8 bits is read")
            out.height, out.width, out.quantiser = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), body[8]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline file")
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                out.tables[body[0]] = body[1:n]
                body = body[n:]
        elif marker == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                out.steps[body[0] & 15] = body[1 : 1 + BLOCK * wide]
                body = body[1 + BLOCK * wide :]
        elif marker == 0xDD:
            out.interval = int.from_bytes(body, "big")
        elif marker == 0xFE:
            out.comment = body
        elif marker == 0xDA:
            out.chosen = (body[2] >> 4, 0x10 | body[2] & 15)
            out.scan = at
            return out


_lookups: dict[tuple[bytes, bytes], np.ndarray] = {}


def lookup(dc: bytes, ac: bytes) -> np.ndarray:
    """For each table and each 16 bits ahead: length of the code << 8 | symbol; 0 for no code."""
    if (dc, ac) not in _lookups:
        out = np.zeros((2, 1 << 16), np.int64)
        for k, table in enumerate((dc, ac)):
            code, symbol = 0, 16
            for length in range(1, 17):
                for _ in range(table[length - 1]):
                    out[k, code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | table[symbol]
                    code, symbol = code + 1, symbol + 1
                code <<= 1
        _lookups.clear()
        _lookups[dc, ac] = out.ravel()
    return _lookups[dc, ac]


def decode_lanes(data: np.ndarray, start: np.ndarray, n_blocks: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Coefficients (blocks, 64) of all lanes, end to end. data: without stuffing, padded; start: first byte of each
    lane; n_blocks: blocks of each."""
    base = np.concatenate(([0], np.cumsum(n_blocks)))
    out = np.zeros(int(base[-1]) * BLOCK, np.int16)
    window = np.ndarray((len(data) - 8,), ">u8", data, strides=(1,))
    position, k = start * 8, np.zeros(len(start), np.int64)
    target, stop, predicted = base[:-1] * BLOCK, base[1:] * BLOCK, np.zeros(len(start), np.int64)
    turn = 0
    while len(position):
        ahead = window[position >> 3].astype(np.uint64) << (position & 7).astype(np.uint64)
        is_ac = k > 0
        entry = tables[(is_ac.astype(np.int64) << 16) + (ahead >> np.uint64(48)).astype(np.int64)]
        if not entry.all():
            raise ValueError("no such code")
        length, symbol = entry >> 8, entry & 255
        size = symbol & 15
        bits = ((ahead << length.astype(np.uint64)) >> np.uint64(1) >> (63 - size).astype(np.uint64)).astype(np.int64)
        value = bits - np.where(bits >> np.maximum(size - 1, 0) == 0, (1 << size) - 1, 0)
        position += length + size
        predicted += np.where(is_ac, 0, value)
        value = np.where(is_ac, value, predicted)
        k += np.where(is_ac, symbol >> 4, 0)
        put = ~is_ac | (size > 0)
        if put.all():
            out[target + k] = value
        else:
            out[(target + k)[put]] = value[put]
        k += 1
        k[is_ac & (symbol == 0)] = BLOCK
        over = k >= BLOCK
        if over.any():
            if (k > BLOCK).any():
                raise ValueError("more coefficients than a block has")
            target += np.where(over, BLOCK, 0)
            k[over] = 0
            turn += 1
            live = target < stop
            if not live.all():
                position, k, target, stop, predicted = (x[live] for x in (position, k, target, stop, predicted))
    return out.reshape(-1, BLOCK)


def decode(files: list[bytes]) -> list[tuple[Parsed, np.ndarray]]:
    """Markers and coefficients (blocks in raster order, zigzag within) of each file."""
    parsed = [parse(f) for f in files]
    groups: dict[tuple[bytes, bytes], list[int]] = {}
    for i, p in enumerate(parsed):
        groups.setdefault((p.tables[p.chosen[0]], p.tables[p.chosen[1]]), []).append(i)
    out: list = [None] * len(files)
    for (dc, ac), members in groups.items():
        scans = [np.frombuffer(files[i], np.uint8)[parsed[i].scan : -2] for i in members]
        data = np.concatenate(scans)
        edge = np.concatenate(([0], np.cumsum([len(s) for s in scans])))
        after = np.flatnonzero(data[:-1] == 0xFF) + 1
        restart = after[(data[after] & 0xF8) == 0xD0]
        keep = np.ones(len(data), dtype=bool)
        keep[after[data[after] == 0]] = False
        keep[restart], keep[restart - 1] = False, False
        clean = np.concatenate((data[keep], np.full(16, 0xFF, np.uint8)))
        kept_before = np.concatenate(([0], np.cumsum(keep)))
        blocks = [-(-parsed[i].width // 8) * -(-parsed[i].height // 8) for i in members]
        per = [parsed[i].interval or n for i, n in zip(members, blocks, strict=True)]
        starts = np.sort(np.concatenate((edge[:-1], restart + 1)))
        n_lanes = [-(-n // r) for n, r in zip(blocks, per, strict=True)]
        if len(starts) != sum(n_lanes):
            raise ValueError("restart markers are missing")
        lane_blocks = np.concatenate([np.minimum(r, n - r * np.arange(m)) for n, r, m in zip(blocks, per, n_lanes, strict=True)])
        starts, tables, found, at = kept_before[starts], lookup(dc, ac), [], 0
        reach = np.cumsum(lane_blocks)
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PASS // BLOCK, side="right")))
            found.append(decode_lanes(clean, starts[at:to], lane_blocks[at:to], tables))
            at = to
        coefficients, at = np.concatenate(found), 0
        for i, n in zip(members, blocks, strict=True):
            out[i] = (parsed[i], coefficients[at : at + n])
            at += n
    return out


def thumbnail(parsed: Parsed, coefficients: np.ndarray) -> np.ndarray:
    """The image at an eighth of its size, from the DC coefficients alone."""
    step = parsed.steps[parsed.quantiser][0] if len(parsed.steps[parsed.quantiser]) == BLOCK else int.from_bytes(parsed.steps[parsed.quantiser][:2], "big")
    means = (coefficients[:, 0].astype(np.int64) * step + 4) // 8 + 128
    return np.clip(means, 0, 255).astype(np.uint8).reshape(-(-parsed.height // 8), -(-parsed.width // 8))


def thumbnail_hash(image: np.ndarray) -> str:
    """64 bits, as hex: whether each of 8 x 8 cells is darker than the next to its right. Cells of small images repeat."""
    rows = np.linspace(0, image.shape[0], 9).astype(int)
    columns = np.linspace(0, image.shape[1], 10).astype(int)
    sums = np.zeros((image.shape[0] + 1, image.shape[1] + 1), np.int64)
    sums[1:, 1:] = image.astype(np.int64).cumsum(0).cumsum(1)
    top, left = np.minimum(rows[:-1], image.shape[0] - 1), np.minimum(columns[:-1], image.shape[1] - 1)
    low, right = np.maximum(rows[1:], top + 1), np.maximum(columns[1:], left + 1)
    total = sums[low][:, right] - sums[top][:, right] - sums[low][:, left] + sums[top][:, left]
    mean = total * 256 // ((low - top)[:, None] * (right - left)[None, :])
    return np.packbits(mean[:, :-1] < mean[:, 1:]).tobytes().hex()
