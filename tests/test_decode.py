import base64
import gzip
import zlib

import pytest

from tidemark.operators import decode
from tests.helpers import payload


def run(spark, values, codec="gzip"):
    frame = spark.createDataFrame(list(enumerate(values)), "id int, value string")
    rows = decode.decode_payload(frame, codec).orderBy("id").collect()
    return [(r.text, r.rejected) for r in rows]


def b64(data: bytes) -> str:
    return base64.b64encode(data).decode()


def test_good_and_damaged_payloads(spark):
    whole = gzip.compress(b"hello")
    members = b64(gzip.compress(b"hel") + gzip.compress("lö".encode()))
    wrapped = base64.encodebytes(gzip.compress(bytes(range(32, 127)) * 3)).decode()
    bad = ["%%%", "not base64!", b64(b"plain"), b64(whole[:-3]), b64(whole + b"junk"),
           b64(gzip.compress(b"\xff\xfe")), "", "é"]
    got = run(spark, [b64(whole), members, wrapped, payload(""), *bad, None])
    assert got[:2] == [("hello", None), ("hellö", None)]
    assert got[2] == ((bytes(range(32, 127)) * 3).decode(), None)
    assert got[3] == ("", None)
    assert got[4:] == [(None, b) for b in bad] + [(None, None)]


def test_other_codecs(spark):
    assert run(spark, [b64(zlib.compress(b"z")), payload("x")], "zlib")[0] == ("z", None)
    assert run(spark, [b64(zlib.compress(b"z")), payload("x")], "zlib")[1][0] is None
    assert run(spark, [b64(b"text"), "%%%", b64(b"\xff")], "none") == [
        ("text", None), (None, "%%%"), (None, b64(b"\xff"))
    ]
    assert run(spark, ["as it is", None], "plain") == [("as it is", None), (None, None)]
    with pytest.raises(ValueError):
        run(spark, ["x"], "lz9")


def test_other_columns_pass_and_large_texts_leave_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(decode, "FLUSH_BYTES", 1000)
    values = [(i, f"k{i}", payload("x" * (i * 37 % 900)), [i]) for i in range(200)]
    frame = spark.createDataFrame(values, "id int, name string, value string, tags array<int>")
    got = {r.id: r for r in decode.decode_payload(frame.coalesce(1)).collect()}
    assert len(got) == 200
    for i in range(200):
        assert got[i].name == f"k{i}" and got[i].tags == [i] and len(got[i].text) == i * 37 % 900
