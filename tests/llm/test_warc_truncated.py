"""Bodies cut off by the crawler, or deflated without header, are decoded as far as they go."""

import gzip
import random
import zlib

import pytest

from ledgerline.llm import warc

RNG = random.Random(1)
WORDS = " ".join(str(RNG.random()) for _ in range(3000))
PAGE = f"<title>T</title><a href='/x'>y</a><p>{WORDS}".encode()
PACKED = gzip.compress(PAGE, mtime=0)


def raw(data: bytes) -> bytes:
    made = zlib.compressobj(wbits=-15)
    return made.compress(data) + made.flush()


@pytest.mark.parametrize(
    "coding, body, whole",
    [
        ("gzip", PACKED, True),
        ("gzip", PACKED[:-4], False),
        ("gzip", PACKED[: len(PACKED) // 2], False),
        ("gzip", PACKED[:-8] + bytes(8), False),  # a wrong check sum
        ("x-gzip", gzip.compress(PAGE[:50]) + gzip.compress(PAGE[50:]) + b"\0\0", True),
        ("deflate", zlib.compress(PAGE), True),
        ("deflate", zlib.compress(PAGE)[:5000], False),
        ("deflate", raw(PAGE), True),
        ("deflate", raw(PAGE)[:5000], False),
    ],
)
def test_bodies(coding, body, whole):
    plain, ended = warc.decoded([("Content-Encoding", coding)], body)
    assert ended == whole and PAGE.startswith(plain) and len(plain) > 4000
    if whole or len(body) > len(PACKED) - 5:
        assert plain == PAGE
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: {coding}\r\n\r\n".encode()
    (_, _, meta), (kind, _, text) = warc.derive("i", "http://h.example/", head + body, {})
    assert kind == "conversion" and text.startswith(b"T\ny") and b"outlink: http://h.example/x\r\n" in meta
    assert (b"payload-truncated: true\r\n" in meta) == (not whole)


def test_chunks_cut_off():
    chunked = [("Transfer-Encoding", "chunked")]
    assert warc.decoded(chunked, b"3\r\nabc\r\n5\r\nde") == (b"abcde", False)
    assert warc.decoded(chunked, b"3\r\nabc\r\n0\r\n\r\n") == (b"abc", True)


@pytest.mark.parametrize("coding", ["gzip", "deflate", "br"])
def test_other_bytes_are_no_text(coding):
    assert warc.decoded([("Content-Encoding", coding)], b"<p>not compressed at all</p>")[0] is None
