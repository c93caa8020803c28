"""PNG pictures without an imaging library: decode, encode, grey, resize, tiles. Pixels are uint8 arrays of (height, width, channels)."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Channels by PNG colour type: grey, RGB, palette, grey with alpha, RGB with alpha (fixed values).
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def encode_png(pixels: np.ndarray) -> bytes:
    """One channel becomes grey, three RGB."""
    pixels = np.ascontiguousarray(pixels, dtype=np.uint8)
    if pixels.ndim == 2:
        pixels = pixels[:, :, None]
    height, width, channels = pixels.shape
    kind = {1: 0, 3: 2}[channels]
    rows = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(content: bytes) -> np.ndarray:
    """Pixels of a picture of 8 bits a sample that isn't interlaced; a ValueError for all else."""
    if content[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head, palette = 8, [], None, None
    while at + 8 <= len(content):
        size, name = struct.unpack_from(">I4s", content, at)
        part = content[at + 8 : at + 8 + size]
        at += 12 + size
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            body.append(part)
        elif name == b"IEND":
            break
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("a kind of PNG that isn't read here")
    width, height, step = head[0], head[1], CHANNELS[head[3]]
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error as e:
        raise ValueError(f"damaged PNG: {e}") from e
    if len(raw) != height * (1 + width * step):
        raise ValueError("a PNG of too few or too many rows")
    rows = np.frombuffer(raw, np.uint8).reshape(height, -1)
    out = np.zeros((height, width * step), np.uint8)
    above = np.zeros(width * step, np.uint8)
    for y in range(height):
        above = out[y] = unfiltered(int(rows[y, 0]), rows[y, 1:], above, step)
    pixels = out.reshape(height, width, step)
    return palette[pixels[:, :, 0]] if head[3] == 3 and palette is not None else pixels


def unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
    if kind not in (3, 4):
        raise ValueError("damaged PNG: unknown filter")
    out = [0] * len(line)
    for i, (x, up) in enumerate(zip(line.tolist(), above.tolist(), strict=True)):
        left = out[i - step] if i >= step else 0
        if kind == 3:
            guess = (left + up) // 2
        else:
            corner = int(above[i - step]) if i >= step else 0
            near = left + up - corner
            far = [abs(near - v) for v in (left, up, corner)]
            guess = (left, up, corner)[far.index(min(far))]
        out[i] = (x + guess) & 255
    return np.array(out, np.uint8)


def rgb(pixels: np.ndarray) -> np.ndarray:
    """Three channels; alpha is left out, grey is repeated."""
    if pixels.shape[2] in (1, 2):
        return np.repeat(pixels[:, :, :1], 3, axis=2)
    return pixels[:, :, :3]


def grey(pixels: np.ndarray) -> np.ndarray:
    """One channel by the weights of ITU-R 601, rounded to nearest."""
    if pixels.shape[2] in (1, 2):
        return pixels[:, :, :1]
    weighted = pixels[:, :, :3].astype(np.int64) @ np.array([19_595, 38_470, 7_471])
    return ((weighted + 32_768) >> 16).astype(np.uint8)[:, :, None]


def resize(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Each new pixel is the mean of the old ones that it covers, or the nearest one where it covers none."""

    def edges(old: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.arange(new) * old // new
        return start, np.maximum((np.arange(1, new + 1) * old) // new, start + 1)

    (top, bottom), (left, right) = edges(pixels.shape[0], height), edges(pixels.shape[1], width)
    sums = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1, pixels.shape[2]), np.int64)
    sums[1:, 1:] = pixels.astype(np.int64).cumsum(0).cumsum(1)
    total = sums[bottom][:, right] - sums[top][:, right] - sums[bottom][:, left] + sums[top][:, left]
    count = ((bottom - top)[:, None] * (right - left)[None, :])[:, :, None]
    return ((total + count // 2) // count).astype(np.uint8)
