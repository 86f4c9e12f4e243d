"""Raster files and raster arithmetic in numpy: PNG and baseline JPEG both ways, resizing, polygons, padding, colours.

Rasters are uint8, rows of blue, green, red pixels. Decoders raise ValueError; they never give an empty picture.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from functools import lru_cache

import numpy as np

#: Quantisation at quality 50, for luminance and colour, row by row (fixed values of the JPEG standard's annex K).
LUMINANCE = [
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
]
COLOUR = [17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99] + [99] * 32
_TO_YCC = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])


@lru_cache(1)
def _dct() -> np.ndarray:
    k, x = np.mgrid[:8, :8]
    basis = np.cos((2 * x + 1) * k * np.pi / 16) / 2
    basis[0] /= np.sqrt(2)
    return basis


@lru_cache(1)
def _zigzag() -> np.ndarray:
    """Places of the 64 coefficients in zigzag order: along diagonals, by turns up and down."""
    return np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p // 8 if (p // 8 + p % 8) % 2 else p % 8))))


def _scaled(table: list[int], quality: int) -> np.ndarray:
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(table) * scale + 50) // 100, 1, 255)


def _code_lengths(counts: dict[int, int]) -> dict[int, int]:
    """Lengths of a prefix code of at most 16 bits that leaves the code of all ones free."""
    floor = 0
    while True:
        heap = [(max(n, floor), k, (s,)) for k, (s, n) in enumerate(sorted(counts.items()))] + [(0, -1, (-1,))]  # -1 takes the longest code
        heapq.heapify(heap)
        length = dict.fromkeys([*counts, -1], 0)
        tick = len(heap)
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            for s in x + y:
                length[s] += 1
            heapq.heappush(heap, (a + b, tick, x + y))
            tick += 1
        if max(length.values()) <= 16:
            longest = max(length.values())
            # The free code must be the last of the longest ones.
            if length[-1] < longest:
                other = next(s for s in length if length[s] == longest)
                length[other], length[-1] = length[-1], longest
            return {s: n for s, n in length.items() if s >= 0}
        floor = max(1, 2 * floor, max(counts.values()) >> 12)


def _canonical(lengths: dict[int, int]) -> tuple[list[int], list[int], dict[int, int]]:
    """(numbers of codes by length, symbols in order, code of each symbol)."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    numbers = [sum(n == k for n in lengths.values()) for k in range(1, 17)]
    codes, code, before = {}, 0, 0
    for s in order:
        code <<= lengths[s] - before
        codes[s], before = code, lengths[s]
        code += 1
    return numbers, order, codes


def _segment(marker: int, payload: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(payload) + 2) + payload


def encode_jpeg(bgr: np.ndarray, quality: int = 95) -> bytes:
    """A baseline JPEG without colour subsampling, its codes fitted to the picture."""
    if bgr.ndim != 3 or bgr.shape[2] != 3 or not bgr.size or bgr.dtype != np.uint8:
        raise ValueError("a picture is a non-empty uint8 raster of three channels")
    h, w = bgr.shape[:2]
    ycc = bgr[..., ::-1].astype(np.float64) @ _TO_YCC.T + [0, 128, 128]
    ycc = np.pad(ycc, ((0, -h % 8), (0, -w % 8), (0, 0)), mode="edge") - 128
    rows, columns = ycc.shape[0] // 8, ycc.shape[1] // 8
    blocks = ycc.reshape(rows, 8, columns, 8, 3).transpose(0, 2, 4, 1, 3)
    tables = [_scaled(t, quality) for t in (LUMINANCE, COLOUR)]
    quantised = np.stack([tables[0], tables[1], tables[1]]).reshape(3, 8, 8)
    found = np.rint(_dct() @ blocks @ _dct().T / quantised).astype(np.int64).reshape(-1, 64)[:, _zigzag()]
    n = len(found)
    dc = found[:, 0].reshape(-1, 3)
    found[:, 0] = np.diff(dc, axis=0, prepend=np.zeros((1, 3), np.int64)).reshape(-1)
    # Tokens: block, place in it, symbol, further bits and how many.
    size = np.zeros(1 << 12, np.int64)
    size[1:] = np.floor(np.log2(np.arange(1, 1 << 12))).astype(np.int64) + 1
    block, place = np.nonzero(found[:, 1:])
    value = found[block, place + 1]
    first = np.ones(len(block), bool)
    first[1:] = block[1:] != block[:-1]
    run = place - np.where(first, -1, np.concatenate([[0], place[:-1]])) - 1
    bits = size[np.abs(value)]
    long = np.repeat(np.arange(len(run)), run // 16)
    last = np.full(n, -1)
    last[block] = place
    open_ = np.flatnonzero(last < 62)
    dc_bits = size[np.abs(found[:, 0])]
    token = lambda b, p, s, v, k: np.stack([b, p, s, v, k])
    zero = lambda x: np.zeros(len(x), np.int64)
    tokens = np.concatenate([
        token(np.arange(n), np.full(n, -2), dc_bits, np.where(found[:, 0] < 0, found[:, 0] + (1 << dc_bits) - 1, found[:, 0]), dc_bits),
        token(block[long], 2 * place[long], np.full(len(long), 0xF0), zero(long), zero(long)),
        token(block, 2 * place + 1, (run % 16) << 4 | bits, np.where(value < 0, value + (1 << bits) - 1, value), bits),
        token(open_, np.full(len(open_), 200), zero(open_), zero(open_), zero(open_)),
    ], axis=1)
    tokens = tokens[:, np.lexsort((tokens[1], tokens[0]))]
    kind = np.where(tokens[0] % 3 > 0, 2, 0) + (tokens[1] >= 0)  # luminance and colour, first coefficients and others
    code, width, headers = np.zeros(tokens.shape[1], np.int64), np.zeros(tokens.shape[1], np.int64), b""
    for k in range(4):
        own = kind == k
        symbols, counts = np.unique(tokens[2][own], return_counts=True)
        lengths = _code_lengths(dict(zip(symbols.tolist(), counts.tolist(), strict=True)) or {0: 1})
        numbers, order, codes = _canonical(lengths)
        headers += _segment(0xC4, bytes([(k % 2) << 4 | k // 2, *numbers, *order]))
        look = np.zeros((256, 2), np.int64)
        for s, c in codes.items():
            look[s] = c, lengths[s]
        code[own], width[own] = look[tokens[2][own]].T
    code, width = code << tokens[4] | tokens[3], width + tokens[4]
    of = np.repeat(np.arange(len(width)), width)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width)
    stream = (code[of] >> (width[of] - 1 - inner)) & 1
    packed = np.packbits(np.concatenate([stream, np.ones(-len(stream) % 8, np.int64)]).astype(np.uint8))
    packed = np.insert(packed, np.flatnonzero(packed == 0xFF) + 1, 0)
    out = b"\xff\xd8" + _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0")
    for k, t in enumerate(tables):
        out += _segment(0xDB, bytes([k, *t[_zigzag()].tolist()]))
    out += _segment(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1])) + headers
    return out + _segment(0xDA, bytes([3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0])) + packed.tobytes() + b"\xff\xd9"


def _lookup(numbers: bytes, symbols: bytes) -> np.ndarray:
    """For every 16 bits the code's symbol and length (length 0: no code)."""
    table = np.zeros((1 << 16, 2), np.int32)
    code = at = 0
    for length, n in enumerate(numbers, 1):
        for s in symbols[at : at + n]:
            table[code << (16 - length) : (code + 1) << (16 - length)] = s, length
            code += 1
        code <<= 1
        at += n
    return table


def decode_jpeg(data: bytes) -> np.ndarray:
    """The raster of a baseline JPEG with one or three components, any sampling of whole factors."""
    try:
        return _decoded(data)
    except (IndexError, KeyError, struct.error, OverflowError) as error:
        raise ValueError(f"not a readable JPEG: {error!r}") from error


def _decoded(data: bytes) -> np.ndarray:
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    quantisation: dict[int, np.ndarray] = {}
    codes: dict[int, list] = {}
    parts: list[list[int]] = []
    h = w = restart = 0
    at = 2
    while True:
        if data[at] != 0xFF:
            raise ValueError("a JPEG segment is damaged")
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quantisation[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                codes[body[0]] = _lookup(body[1:17], body[17 : 17 + n]).tolist()
                body = body[17 + n :]
        elif marker in (0xC0, 0xC1):
            depth, h, w, n = struct.unpack_from(">BHHB", body)
            if depth != 8 or n not in (1, 3) or not h or not w:
                raise ValueError("only pictures of one or three components of 8 bits are read")
            parts = [[body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]] for k in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("only baseline JPEG is read")
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            break
    if not parts or body[0] != len(parts):
        raise ValueError("a JPEG without one scan of all components")
    tables = {body[1 + 2 * k]: (body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])}
    most = max(p[1] for p in parts), max(p[2] for p in parts)
    across, down = -(-w // (8 * most[0])), -(-h // (8 * most[1]))
    planes = [np.zeros((down * p[2], across * p[1], 64), np.int64) for p in parts]
    end = data.rfind(b"\xff\xd9")
    # Segments between restart marks; stuffed zeros go.
    pieces, begin, k = [], at, at
    end = len(data) if end < at else end
    while (k := data.find(b"\xff", k, end)) >= 0:
        if 0xD0 <= data[k + 1] <= 0xD7:
            pieces.append(data[begin:k])
            begin = k + 2
        k += 2
    pieces.append(data[begin:end])
    units = across * down
    for number, piece in enumerate(pieces):
        raw = piece.replace(b"\xff\x00", b"\xff") + b"\xff" * 8
        place, limit = 0, 8 * len(raw) - 32
        before = [0] * len(parts)
        first = number * restart
        for unit in range(first, min(units, first + restart) if restart else units):
            for c, (name, x_factor, y_factor, _) in enumerate(parts):
                dc, ac = codes[tables[name][0]], codes[0x10 | tables[name][1]]
                for sub in range(x_factor * y_factor):
                    block = planes[c][unit // across * y_factor + sub // x_factor, unit % across * x_factor + sub % x_factor]
                    k, table = 0, dc
                    while k < 64:
                        if place > limit:
                            raise ValueError("the JPEG ends too early")
                        word = int.from_bytes(raw[place >> 3 : (place >> 3) + 5], "big") << (place & 7) & 0xFFFFFFFFFF
                        symbol, length = table[word >> 24]
                        if not length:
                            raise ValueError("a JPEG code is damaged")
                        bits = symbol & 15
                        if k:
                            if not bits:
                                place += length
                                if symbol != 0xF0:
                                    break
                                k += 16
                                continue
                            k += symbol >> 4
                        value = word >> (40 - length - bits) & ((1 << bits) - 1)
                        place += length + bits
                        if bits and value < 1 << (bits - 1):
                            value -= (1 << bits) - 1
                        if not k:
                            before[c] += value
                            value = before[c]
                            table = ac
                        block[k] = value
                        k += 1
    out = []
    for (_, x_factor, y_factor, q), plane in zip(parts, planes, strict=True):
        values = np.zeros(plane.shape, np.float64)
        values[..., _zigzag()] = plane * quantisation[q]
        pixels = _dct().T @ values.reshape(*plane.shape[:2], 8, 8) @ _dct()
        grey = pixels.transpose(0, 2, 1, 3).reshape(plane.shape[0] * 8, plane.shape[1] * 8) + 128
        grey = np.repeat(np.repeat(grey, most[1] // y_factor, axis=0), most[0] // x_factor, axis=1)
        out.append(grey[:h, :w])
    if len(out) == 1:
        rgb = np.stack(out * 3, axis=2)
    else:
        rgb = (np.stack(out, axis=2) - [0, 128, 128]) @ np.linalg.inv(_TO_YCC).T
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)[..., ::-1].copy()


def encode_png(raster: np.ndarray) -> bytes:
    """A mask (rows of one value) or a picture."""
    if raster.dtype != np.uint8 or raster.ndim not in (2, 3) or not raster.size:
        raise ValueError("a raster is non-empty and uint8")
    h, w = raster.shape[:2]
    lines = (raster if raster.ndim == 2 else raster[..., ::-1]).reshape(h, -1)
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if raster.ndim == 2 else 2, 0, 0, 0)
    filtered = np.concatenate([np.zeros((h, 1), np.uint8), lines], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(filtered, 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """Grey pictures as rows of one value, others as blue, green, red; transparency is dropped."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, head = 8, b"", None
    try:
        while at < len(data):
            size, name = struct.unpack_from(">I4s", data, at)
            body = data[at + 8 : at + 8 + size]
            if zlib.crc32(name + body) != struct.unpack_from(">I", data, at + 8 + size)[0]:
                raise ValueError("a PNG chunk is damaged")
            at += 12 + size
            if name == b"IHDR":
                head = struct.unpack(">IIBBBBB", body)
            elif name == b"IDAT":
                packed += body
            elif name == b"IEND":
                break
        if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
            raise ValueError("only plain PNG of 8 bits is read")
        w, h, n = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
        lines = np.frombuffer(zlib.decompress(packed), np.uint8)[: h * (w * n + 1)].reshape(h, w * n + 1)
    except (struct.error, zlib.error) as error:
        raise ValueError(f"not a readable PNG: {error}") from error
    out = np.zeros((h, w, n), np.int64)
    above = np.zeros((w, n), np.int64)
    for y in range(h):
        kind, line = int(lines[y, 0]), lines[y, 1:].reshape(w, n).astype(np.int64)
        if kind == 1:
            line = np.cumsum(line, axis=0) & 255
        elif kind == 2:
            line = (line + above) & 255
        elif kind in (3, 4):
            left = corner = np.zeros(n, np.int64)
            for x in range(w):
                if kind == 3:
                    guess = (left + above[x]) // 2
                else:
                    estimate = left + above[x] - corner
                    off = np.abs(np.stack([left, above[x], corner]) - estimate)
                    guess = np.stack([left, above[x], corner])[off.argmin(axis=0), np.arange(n)]
                    corner = above[x]
                left = line[x] = (line[x] + guess) & 255
        elif kind:
            raise ValueError("a PNG line has an unknown filter")
        out[y] = above = line
    colour = out[..., : 3 if n > 2 else 1].astype(np.uint8)
    return colour[..., ::-1].copy() if n > 2 else colour[..., 0]


def decode(data: bytes) -> np.ndarray:
    """A picture from JPEG or PNG bytes, three channels."""
    if not data:
        raise ValueError("an empty picture file")
    if data[:2] == b"\xff\xd8":
        return decode_jpeg(data)
    found = decode_png(data)
    return found if found.ndim == 3 else np.repeat(found[..., None], 3, axis=2)


def _linear(n: int, size: int) -> np.ndarray:
    """Weights (size, n) of linear interpolation between pixel centres."""
    at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
    low = np.minimum(at.astype(int), max(n - 2, 0))
    out = np.zeros((size, n), np.float32)
    out[np.arange(size), low] = 1 - (at - low)
    out[np.arange(size), np.minimum(low + 1, n - 1)] += at - low
    return out


def _share(n: int, size: int) -> np.ndarray:
    """Weights (size, n) by which the old pixels cover each new one."""
    edges = np.arange(size + 1) * n / size
    old = np.arange(n)
    covered = np.minimum(edges[1:, None], old + 1) - np.maximum(edges[:-1, None], old)
    return (np.clip(covered, 0, None) * size / n).astype(np.float32)


def resize_linear(values: np.ndarray, height: int, width: int) -> np.ndarray:
    return _linear(values.shape[0], height) @ values.astype(np.float32) @ _linear(values.shape[1], width).T


def thresholded(values: np.ndarray, height: int, width: int, above: float) -> np.ndarray:
    """A mask from scores of any size: above 0 for logits, above 0.5 for shares."""
    if values.shape != (height, width):
        values = resize_linear(values, height, width)
    return (values > above).astype(np.uint8)


def shrink(bgr: np.ndarray, long_edge: int) -> np.ndarray:
    """At most long_edge on the longer side, by area; never enlarged."""
    h, w = bgr.shape[:2]
    if max(h, w) <= long_edge:
        return bgr
    scale = long_edge / max(h, w)
    new = max(1, round(h * scale)), max(1, round(w * scale))
    rows, columns = _share(h, new[0]), _share(w, new[1])
    return np.clip(np.rint(np.einsum("ih,hwc,jw->ijc", rows, bgr.astype(np.float32), columns, optimize=True)), 0, 255).astype(np.uint8)


def polygon_mask(points: np.ndarray, height: int, width: int) -> np.ndarray:
    """A filled polygon with its outline, its corners clipped to the raster; fewer than three corners give an empty mask."""
    mask = np.zeros((height, width), np.uint8)
    points = np.asarray(points, np.float64)
    if points.ndim != 2 or points.shape[0] < 3 or points.shape[1] != 2:
        return mask
    corners = np.rint(np.clip(points, 0, [width - 1, height - 1])).astype(int)
    following = np.roll(corners, -1, axis=0)
    y, x = np.mgrid[:height, :width]
    inside = np.zeros(mask.shape, bool)
    for (x0, y0), (x1, y1) in zip(corners, following, strict=True):
        if y0 != y1:
            inside ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
        steps = max(abs(x1 - x0), abs(y1 - y0), 1)
        along = np.linspace(0, 1, steps + 1)
        mask[np.rint(y0 + along * (y1 - y0)).astype(int), np.rint(x0 + along * (x1 - x0)).astype(int)] = 1
    return mask | inside.astype(np.uint8)


def mask_reason(mask: object, height: int, width: int) -> str | None:
    """Why an array is no removal mask of a picture of this size; None if it is one."""
    if not isinstance(mask, np.ndarray) or mask.ndim != 2 or mask.shape != (height, width):
        return "shape"
    if mask.dtype not in (np.dtype(bool), np.dtype(np.uint8)):
        return "type"
    return None if mask.any() else "empty"


def to_model(bgr: np.ndarray, mask: np.ndarray, modulo: int) -> tuple[np.ndarray, np.ndarray]:
    """(3, H, W) red, green, blue between 0 and 1 and (1, H, W) mask, padded to multiples of modulo: mirrored, or repeated where a side is one pixel."""
    if reason := mask_reason(mask, *bgr.shape[:2]):
        raise ValueError(f"the mask is not usable: {reason}")
    h, w = bgr.shape[:2]
    room = ((0, 0), (0, -h % modulo), (0, -w % modulo))
    picture = np.pad(bgr[..., ::-1].transpose(2, 0, 1).astype(np.float32) / 255, room, mode="reflect" if min(h, w) > 1 else "edge")
    return picture, np.pad((mask > 0)[None].astype(np.float32), room)


def from_model(tensor: np.ndarray, height: int, width: int) -> np.ndarray:
    """The picture of a model's answer, cut to its size; RuntimeError if it is not finite or not of three channels."""
    if tensor.ndim != 3 or tensor.shape[0] != 3 or tensor.shape[1] < height or tensor.shape[2] < width:
        raise RuntimeError("the answer must have three channels of the padded size")
    if not np.isfinite(tensor).all():
        raise RuntimeError("the answer holds values that are not finite")
    return np.rint(np.clip(tensor[:, :height, :width], 0, 1) * 255).astype(np.uint8).transpose(1, 2, 0)[..., ::-1].copy()


def confidence(logits: np.ndarray) -> float | None:
    """The mean probability over the positive logits, clipped at 20; None if there is none."""
    positive = logits[logits > 0]
    return float(np.mean(1 / (1 + np.exp(-np.clip(positive, -20, 20))))) if len(positive) else None
