"""No byte string may do more than give an error."""

import random
import struct
import time

import numpy as np
import pytest

from foliospark.llm import tiff


def read(blob):
    try:
        return [x[3].shape for x in tiff.pages(blob)]
    except ValueError as e:
        assert str(e)
        return None


@pytest.mark.parametrize("compression", [tiff.PLAIN, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE])
def test_damaged_files(compression):
    rng = random.Random(compression)
    image = np.random.default_rng(2).integers(0, 5, (20, 33, 3), dtype=np.uint8)
    whole = tiff.write([image, image[:, :, 0]], compression, 7, 2, rng.choice([0, 16]))
    assert read(whole) == [(20, 33, 3), (20, 33, 1)]
    began = time.time()
    for cut in range(0, len(whole), 3):
        read(whole[:cut])
    for _ in range(1500):
        blob = bytearray(whole)
        for _ in range(rng.randint(1, 6)):
            blob[rng.randrange(len(blob))] = rng.choice([0, 1, 127, 128, 255, rng.randrange(256)])
        read(bytes(blob))
    assert time.time() - began < 60


def altered(tag, value, kind=4):
    """A file of one page in which a tag has another value (None: another tag's number)."""
    blob = bytearray(tiff.write([np.zeros((4, 4), np.uint8)]))
    (at,) = struct.unpack_from("<I", blob, 4)
    for i in range(struct.unpack_from("<H", blob, at)[0]):
        if struct.unpack_from("<H", blob, at + 2 + 12 * i)[0] == tag:
            if value is None:
                struct.pack_into("<H", blob, at + 2 + 12 * i, 65000)
            else:
                struct.pack_into("<HII", blob, at + 4 + 12 * i, kind, 1, value)
    return bytes(blob)


@pytest.mark.parametrize("tag", [tiff.WIDTH, tiff.HEIGHT, tiff.ROWS, tiff.OFFSETS, tiff.COUNTS, tiff.SAMPLES, tiff.DEPTH, tiff.COMPRESSION, tiff.PREDICTOR, tiff.PLANAR])
def test_odd_tags(tag):
    for value in (None, 0, 3, 65535, 4_000_000, (1 << 32) - 1):
        read(altered(tag, value))
    if tag in (tiff.WIDTH, tiff.HEIGHT, tiff.OFFSETS, tiff.COUNTS, tiff.DEPTH):
        assert read(altered(tag, None)) is None
    if tag in (tiff.WIDTH, tiff.HEIGHT):
        assert read(altered(tag, 0)) is None and read(altered(tag, 4_000_000)) is None


@pytest.mark.parametrize("tile", [0, 16])
def test_planes(tile):
    image = np.random.default_rng(4).integers(0, 256, (37, 41, 3), dtype=np.uint8)
    for predictor in (1, 2):
        (back,) = [x[3] for x in tiff.pages(tiff.write([image], tiff.LZW, 11, predictor, tile, "<", planar=2))]
        assert np.array_equal(back, image)


def test_bombs_stay_small():
    blob = tiff.write([np.zeros((2000, 2000), np.uint8)], rows=2000)
    assert len(blob) < 20000 and read(blob) == [(2000, 2000, 1)]
    (at,) = struct.unpack_from("<I", blob, 4)
    small = bytearray(blob)
    struct.pack_into("<I", small, at + 10, 10)  # a width of 10: the strip holds far more
    assert read(bytes(small)) == [(2000, 10, 1)]
