"""TIFF media columns: a reader and a writer of baseline TIFF in numpy.

The reader walks the image directories, decodes PackBits, LZW and deflate strips or tiles, undoes the
horizontal predictor and gives one row per page. The writer makes what the reader reads.

Defined cases of the payload table: a null text has no bytes and one page of 255s; every page but the
last is full; extra columns are ignored. A damaged file gives one row with its error and no page.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import batch_of, utf8

#: Fixed values of the TIFF 6.0 format: tags, compression codes, bytes of a field type.
WIDTH, HEIGHT, DEPTH, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
PLAIN, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773
OLD_DEFLATE = 32946
FIELD = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i"}
#: Samples of a row of a page that write() makes from a payload, and most rows of such a page.
SIDE, PAGE_ROWS = 24, 24 * 2048


def unpack_bits(data: bytes, limit: int) -> bytes:
    """Up to limit bytes."""
    out, i = bytearray(), 0
    while i < len(data) and len(out) < limit:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
                i += 1
            i += 1
    return bytes(out[:limit])


def pack_bits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = 1
        while i + run < n and run < 128 and data[i + run] == data[i]:
            run += 1
        if run > 1:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        j = i + 1
        while j < n and j - i < 128 and (j + 1 >= n or data[j] != data[j + 1]):
            j += 1
        out += bytes((j - i - 1,)) + data[i:j]
        i = j
    return bytes(out)


def unpack_lzw(data: bytes, limit: int) -> bytes:
    """Up to limit bytes from codes of 9 to 12 bits, high bit first; the width grows one code early, as TIFF has it."""
    words = [bytes((i,)) for i in range(256)] + [b"", b""]
    out, last, width, have, bits, size = [], None, 9, 0, 0, 0
    for byte in data:
        bits = bits << 8 | byte
        have += 8
        if have < width:
            continue
        have -= width
        code = bits >> have
        bits &= (1 << have) - 1
        if code == 256:
            del words[258:]
            width, last = 9, None
        elif code == 257:
            break
        else:
            if code > len(words) or code >= 258 and last is None:
                raise ValueError(f"LZW code {code} of {len(words)}")
            if last is None:
                word = words[code]
            else:
                word = words[code] if code < len(words) else last + last[:1]
                if len(words) < 4096:
                    words.append(last + word[:1])
                width = 9 + (len(words) >= 511) + (len(words) >= 1023) + (len(words) >= 2047)
            out.append(word)
            size += len(word)
            if size >= limit:
                break
            last = word
    return b"".join(out)[:limit]


def pack_lzw(data: bytes) -> bytes:
    codes = {bytes((i,)): i for i in range(256)}
    bits, have, width, following = 256, 9, 9, 258
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in codes:
            word = longer
            continue
        bits, have = bits << width | codes[word], have + width
        codes[longer] = following
        following += 1
        width = 9 + (following >= 512) + (following >= 1024) + (following >= 2048)
        if following == 4094:
            bits, have = bits << width | 256, have + width
            codes = {bytes((k,)): k for k in range(256)}
            width, following = 9, 258
        word = data[i : i + 1]
    if word:
        bits, have = bits << width | codes[word], have + width
        following += 1
        width = 9 + (following >= 512) + (following >= 1024) + (following >= 2048)
    bits, have = bits << width | 257, have + width
    pad = -have % 8
    return (bits << pad).to_bytes((have + pad) // 8, "big")


def expand(data: bytes, compression: int, size: int) -> bytes:
    """The size bytes that a strip or tile must hold; never more is unpacked."""
    if compression == PLAIN:
        out = data[:size]
    elif compression == PACKBITS:
        out = unpack_bits(data, size)
    elif compression == LZW:
        out = unpack_lzw(data, size)
    elif compression in (DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(data, size) if size else b""
    else:
        raise ValueError(f"compression {compression}")
    if len(out) < size:
        raise ValueError(f"{len(out)} bytes where {size} must be")
    return out


class Directory:
    """The tags of one page."""

    def __init__(self, blob: bytes, order: str, at: int):
        (n,) = struct.unpack_from(order + "H", blob, at)
        self.tags: dict[int, tuple] = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", blob, at + 2 + 12 * i)
            if kind in FIELD:
                where = at + 10 + 12 * i
                if count * struct.calcsize(FIELD[kind]) > 4:
                    (where,) = struct.unpack_from(order + "I", blob, where)
                if where + count * struct.calcsize(FIELD[kind]) > len(blob):
                    raise ValueError(f"the values of tag {tag} lie beyond the file")
                self.tags[tag] = struct.unpack_from(f"{order}{count}{FIELD[kind]}", blob, where)
        (self.next,) = struct.unpack_from(order + "I", blob, at + 2 + 12 * n)

    def one(self, tag: int, default: int | None = None) -> int:
        value = self.tags.get(tag) or (default,)
        if value[0] is None:
            raise ValueError(f"tag {tag} is missing")
        return value[0]

    def size(self, tag: int, default: int | None = None) -> int:
        value = self.one(tag, default)
        if value < 1:
            raise ValueError(f"tag {tag} is {value}")
        return value

    def image(self, blob: bytes):
        """(width, height, compression, samples array of height x width x samples)."""
        width, height, samples = self.size(WIDTH), self.size(HEIGHT), self.size(SAMPLES, 1)
        if set(self.tags.get(DEPTH, (1,))) != {8}:
            raise ValueError("samples are not of 8 bits")
        compression, predictor, planar = self.one(COMPRESSION, PLAIN), self.one(PREDICTOR, 1), self.one(PLANAR, 1)
        if predictor not in (1, 2) or planar not in (1, 2):
            raise ValueError(f"predictor {predictor}, planes {planar}")
        tiled = TILE_WIDTH in self.tags
        w, h = (self.size(TILE_WIDTH), self.size(TILE_HEIGHT)) if tiled else (width, min(self.size(ROWS, height), height))
        across, down = -(-width // w), -(-height // h)
        planes, deep = (samples, 1) if planar == 2 and samples > 1 else (1, samples)
        starts, sizes = (self.tags.get(TILE_OFFSETS, ()), self.tags.get(TILE_COUNTS, ())) if tiled else (self.tags.get(OFFSETS, ()), self.tags.get(COUNTS, ()))
        if not len(starts) == len(sizes) == across * down * planes:
            raise ValueError(f"{len(starts)} parts and {len(sizes)} sizes where {across * down * planes} must be")
        parts = []
        for i, (a, size) in enumerate(zip(starts, sizes, strict=True)):
            rows = h if tiled else min(h, height - i % down * h)
            data = expand(blob[a : a + size], compression, rows * w * deep) if a >= 0 and size >= 0 else b""
            part = np.frombuffer(data, np.uint8).reshape(rows, w, deep)
            parts.append(np.cumsum(part, axis=1, dtype=np.uint8) if predictor == 2 else part)
        # all parts have what they must, so the image is no larger than what has been unpacked
        image = np.zeros((down * h if tiled else height, across * w, samples), np.uint8)
        for i, part in enumerate(parts):
            plane, at = divmod(i, across * down)
            y, x = at // across * h, at % across * w
            image[y : y + len(part), x : x + w, plane : plane + deep] = part
        return width, height, compression, image[:height, :width]


def pages(blob: bytes):
    """(width, height, compression, samples array) of each page, by the chain of directories; a damaged file raises ValueError."""
    try:
        if blob[:2] not in (b"II", b"MM"):
            raise ValueError("no byte order mark")
        order = "<" if blob[:2] == b"II" else ">"
        magic, at = struct.unpack_from(order + "HI", blob, 2)
        if magic != 42:
            raise ValueError("no TIFF")
        seen = set()
        while at:
            if at in seen:
                raise ValueError("directories form a ring")
            seen.add(at)
            directory = Directory(blob, order, at)
            yield directory.image(blob)
            at = directory.next
    except (struct.error, zlib.error) as e:
        raise ValueError(str(e)) from e


def write(images: list[np.ndarray], compression: int = DEFLATE, rows: int = 4096, predictor: int = 1, tile: int = 0, order: str = "<", planar: int = 1) -> bytes:
    """A file with one page per array (height, width) or (height, width, samples) of bytes; planar 2: plane after plane."""
    pack = {PLAIN: bytes, PACKBITS: pack_bits, LZW: pack_lzw, DEFLATE: lambda b: zlib.compress(b, 1)}[compression]
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for image in images:
        image = image if image.ndim == 3 else image[:, :, None]
        height, width, samples = image.shape
        if tile:
            whole = np.zeros((-(-height // tile) * tile, -(-width // tile) * tile, samples), np.uint8)
            whole[:height, :width] = image
            parts = [whole[y : y + tile, x : x + tile] for y in range(0, height, tile) for x in range(0, width, tile)]
        else:
            parts = [image[y : y + rows] for y in range(0, height, rows)]
        if planar == 2:
            parts = [part[:, :, k : k + 1] for k in range(samples) for part in parts]
        starts, sizes = [], []
        for part in parts:
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=np.zeros((len(part), 1, part.shape[2]), np.uint8))
            data = pack(part.tobytes())
            starts.append(len(out))
            sizes.append(len(data))
            out += data
        if len(out) % 2:
            out += b"\0"
        fields = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (DEPTH, 3, [8] * samples), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [1 if samples == 1 else 2]), (SAMPLES, 3, [samples]), (PLANAR, 3, [planar]), (PREDICTOR, 3, [predictor])]
        fields += [(TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]), (TILE_OFFSETS, 4, starts), (TILE_COUNTS, 4, sizes)] if tile else [(OFFSETS, 4, starts), (ROWS, 4, [rows]), (COUNTS, 4, sizes)]
        entries = b""
        for tag, kind, values in sorted(fields):
            data = struct.pack(f"{order}{len(values)}{FIELD[kind]}", *values)
            if len(data) > 4:
                where = struct.pack(order + "I", len(out))
                out += data + b"\0" * (len(data) % 2)
                data = where
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
        struct.pack_into(order + "I", out, link, len(out))
        link = len(out) + 2 + len(entries)
        out += struct.pack(order + "H", len(fields)) + entries + b"\0\0\0\0"
    return bytes(out)


def store(data: bytes, unit: int = 576) -> bytes:
    """A payload as pages of SIDE columns: filled with 255 to a positive multiple of unit, deflated with the predictor."""
    size = max(unit, -(-len(data) // unit) * unit)
    samples = np.full(size, 255, np.uint8)
    samples[: len(data)] = np.frombuffer(data, np.uint8)
    image = samples.reshape(-1, SIDE)
    return write([image[y : y + PAGE_ROWS] for y in range(0, len(image), PAGE_ROWS)], DEFLATE, predictor=2)


def decode(media: DataFrame, column: str = "media") -> DataFrame:
    """One row per page of every file: the other columns, page, width, height, compression, samples, error."""
    keep = [c for c in media.columns if c != column]
    base = media.select(*keep).schema
    schema = T.StructType([*base.fields, *[T.StructField(c, T.IntegerType()) for c in ("page", "width", "height", "compression")], T.StructField("samples", T.BinaryType()), T.StructField("error", T.StringType())])

    def scan(batches):
        for batch in batches:
            others = [batch.column(c).to_pylist() for c in keep]
            for i in range(len(batch)):
                rows = []
                try:
                    for p, (w, h, c, image) in enumerate(pages(batch.column(column)[i].as_py() or b"")):
                        rows.append((p, w, h, c, image.tobytes(), None))
                except ValueError as e:
                    rows = [(None, None, None, None, None, str(e))]
                own = [[o[i]] * len(rows) for o in others]
                names = [*keep, "page", "width", "height", "compression", "samples", "error"]
                types = [*[batch.schema.field(c).type for c in keep], pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
                yield batch_of(pa.schema(list(zip(names, types, strict=True))), [*own, *[list(x) for x in zip(*rows, strict=True)]])

    return media.mapInArrow(scan, schema)


def feature(samples: np.ndarray) -> str:
    """A difference hash of 8 x 8 bits over a 9 x 8 grid of means, the mean and the deviation."""
    edges = np.linspace(0, samples.size, 73).astype(np.int64)
    flat = samples.reshape(-1)
    sums = np.append(0, np.cumsum(flat, dtype=np.int64))
    means = (sums[edges[1:]] - sums[edges[:-1]]) * 256 // np.maximum(1, np.diff(edges))
    grid = means.reshape(8, 9)
    bits = np.packbits(grid[:, 1:] > grid[:, :-1]).tobytes().hex()
    mean = int(sums[-1]) * 1000 // max(1, flat.size)
    square = int(np.dot(flat.astype(np.float64), flat.astype(np.float64))) * 1000 // max(1, flat.size)
    return f"{bits}:{mean}:{square}"


def text_media(docs: DataFrame, unit: int = 576) -> DataFrame:
    """doc_id, n_bytes, media: every whole text stored as a TIFF."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def scan(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            for a in range(0, len(batch), 256):
                b = min(a + 256, len(batch))
                media = [store(data[off[i] : off[i + 1]].tobytes(), unit) for i in range(a, b)]
                yield batch_of(schema, [batch.column("doc_id").slice(a, b - a), np.diff(off[a : b + 1]), media])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, n_bytes long, media binary")


def digests(media: DataFrame) -> DataFrame:
    """What is read back from each stored file: the pages of a file in order are its payload."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64())]
        + [("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_pages", pa.int32())]
    )

    def scan(batches):
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                blob = batch.column("media")[i].as_py()
                parts = [image.reshape(-1) for _, _, _, image in pages(blob)]
                samples = np.concatenate(parts)
                back = samples.tobytes()
                rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(blob), hashlib.sha256(blob).hexdigest(), feature(samples), len(parts)))
            if rows:
                yield batch_of(schema, [batch.column("doc_id"), batch.column("n_bytes"), *[list(x) for x in zip(*rows, strict=True)]])

    return media.mapInArrow(scan, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages int")
