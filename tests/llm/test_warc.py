import base64
import gzip
import hashlib
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assetlake.llm import warc as W
from assetlake.llm.common import fresh_path

SF = "/root/testdata/sf0.01"


def read(data):
    return list(W.salvage(pa.BufferReader(data)))


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    by = {}
    for r in rows:
        by.setdefault(r.html or "", []).append(r.page_id)
    want = set()
    for html, ids in by.items():
        d = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        want |= {(i, len(html.encode()), d, "response" if i == min(ids) else "revisit", None if i == min(ids) else min(ids)) for i in ids}
    got = [tuple(r) for r in W.q_warc(spark, SF).collect()]
    assert len(got) == len(rows) and set(got) == want


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_skips_damage_and_reports_gaps(packed):
    rng = random.Random(3)
    recs = [W.record(i, f"http://x/{i}", bytes(rng.randrange(256) for _ in range(300))) for i in range(20)]
    parts = [W.member(r) if packed else r for r in recs]
    at = [sum(map(len, parts[:k])) for k in range(20)]
    data = bytearray(b"".join(parts))
    data[at[4] + len(parts[4]) // 2] ^= 0xFF          # one flipped byte
    data[at[9]:at[9] + 6] = b"\0" * 6                  # lost header
    cut = bytes(data[:at[19] + 40])                    # truncated last record
    got = read(cut)
    ids = [int(h["warc-record-id"][12:-1]) for _, _, h, _, _ in got if h]
    assert ids == [i for i in range(19) if i not in (4, 9)]
    gaps = [(o, n) for o, n, h, _, _ in got if h is None]
    assert gaps == [(at[4], len(parts[4])), (at[9], len(parts[9])), (at[19], 40)]
    assert sum(n for _, n, *_ in got) == len(cut)


def test_junk_between_and_mixed_forms():
    a, b, c = (W.record(i, None, b"p%d" % i) for i in range(3))
    junk = b"\x1f\x8b\x08junk WARC/1.1\r\n more"
    got = read(W.member(a) + junk + b + W.member(b + c))
    assert [h["warc-record-id"] if h else "gap" for _, _, h, _, _ in got] == ["<urn:x-page:0>", "gap"] + [f"<urn:x-page:{i}>" for i in (1, 1, 2)]


def test_records_are_readable_gzip():
    data = W.member(W.record(7, "http://a/ b", b"<p>")) * 2
    assert gzip.GzipFile(fileobj=io.BytesIO(data)).read().count(b"WARC/1.1\r\n") == 2


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, None, None, "x", 1), (2, "u", "", "y", 2), (3, "u", "same", None, None), (3, "u", "same", None, None), (5, "v", "same", None, None),
            (None, "n", "same", None, None), (None, None, "alone", None, None), (8, "b", "é" * 200_000, None, None), (3, "w", "else", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, refers_to long")
    archives = W.write_archives(df, W._uri(fresh_path(spark, "warc")))
    recs = W.read_archives(archives).collect()
    assert len(recs) == len(rows) and all(r.gap is None for r in recs)
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in recs)
    assert got == sorted([("1", "response", "None", 0), ("2", "revisit", "1", 0), ("3", "response", "None", 4), ("3", "response", "None", 4),
                          ("5", "revisit", "3", 4), ("None", "revisit", "3", 4), ("None", "response", "None", 5), ("8", "response", "None", 400_000),
                          ("3", "response", "None", 4)])
    assert bytes(next(r.payload for r in recs if r.page_id == 8)).decode() == "é" * 200_000
    assert W.read_archives(W.write_archives(df.limit(0), W._uri(fresh_path(spark, "warc")))).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_long_headers(packed):
    recs = [W.record(i, "http://x/" + "q" * n, b"<p>") for i, n in enumerate((10, 65_000, 200_000, 9_000_000, 10))]
    got = read(b"".join(W.member(r) if packed else r for r in recs))
    assert [h and h["warc-record-id"] for _, _, h, _, _ in got] == [f"<urn:x-page:{i}>" for i in range(5)]
    assert [len(h["warc-target-uri"]) for _, _, h, _, _ in got] == [19, 65_009, 200_009, 9_000_009, 19]


def test_query_keeps_pages_with_long_urls_and_fails_at_losses(spark, tmp_path):
    rows = [(1, "http://a/" + "q" * 200_000, "same"), (2, "http://b/", "same"), (3, None, "else")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in W.q_warc(spark, str(tmp_path)).collect())
    assert got == [(1, "response", None), (2, "revisit", 1), (3, "response", None)]
    archives = W.write_archives(spark.read.parquet(f"{tmp_path}/pages.parquet"), W._uri(fresh_path(spark, "warc")))
    records = W.read_archives(archives, payload=False)
    assert W.complete(archives, records).count() == 3
    for damaged in (records.where("page_id != 2"), records.where("false"), records.withColumn("gap", F.lit("wrong length"))):
        with pytest.raises(RuntimeError, match="otherwise than written"):
            W.complete(archives, damaged)


def numbers(got):
    return [int(h["warc-record-id"][12:-1]) if h else "gap" for _, _, _, h, _, _ in got]


def parts(data):
    return list(W.salvage_parts(pa.BufferReader(bytes(data))))


def test_failed_record_inside_a_member():
    a, b, c = (W.record(i, None, b"payload %d" % i) for i in range(3))
    wrong = b.replace(b"payload 1", b"payload X")
    got = parts(W.member(a + wrong + c) + W.member(W.record(3, None, b"z")))
    assert numbers(got) == [0, "gap", 2, 3]
    assert got[1][:3] == (0, len(a), len(b)) and got[1][5] == "wrong block digest" and got[2][1] == len(a + b)
    assert got[3][1] is None
    got = parts(W.member(a + b"noise" + c[:-3]))
    assert numbers(got) == [0, "gap"] and got[1][:3] == (0, len(a), len(c) + 2)


def test_archive_in_one_stream_that_breaks_off():
    rng = random.Random(4)
    recs = [W.record(i, None, bytes(rng.randrange(256) for _ in range(5000))) for i in range(6)]
    whole = W.member(b"".join(recs))
    for cut in (len(whole) * 2 // 3, len(whole) - 3):
        got = parts(whole[:cut])
        n = 6 if cut > len(whole) - 9 else numbers(got).index("gap")
        assert numbers(got)[:n] == list(range(n)) and n >= 3 and got[-1][5] == "truncated member"
    bad = bytearray(whole + W.member(W.record(9, None, b"later")))
    bad[len(whole) * 2 // 3:len(whole) * 2 // 3 + 8] = b"\xff" * 8
    got = numbers(parts(bad))
    assert got[:3] == [0, 1, 2] and got[-1] == 9 and "gap" in got
    end = bytearray(whole + W.member(W.record(9, None, b"later")))
    end[len(whole) - 6] ^= 1                            # the member's checksum
    got = parts(end)
    assert numbers(got) == [0, 1, 2, 3, 4, 5, "gap", 9] and "incorrect data check" in got[6][5] and got[6][0] + got[6][2] == len(whole)


def test_every_damaged_byte_leaves_the_other_records():
    recs = [W.record(i, None, b"text %d " % i * 9) for i in range(3)]
    packed = [W.member(r) for r in recs]
    for k in range(len(packed[0]), len(packed[0]) + len(packed[1])):
        data = bytearray(b"".join(packed))
        data[k] ^= 0x55
        got = parts(data)
        assert numbers(got)[0] == 0 and numbers(got)[-1] == 2 and set(numbers(got)[1:-1]) <= {1, "gap"}
        assert all(h == W.parse(recs[int(h["warc-record-id"][12:-1])])[0] for *_, h, _, _ in got if h)


def test_member_longer_than_memory_is_read_in_pieces(monkeypatch):
    seen = []
    feed = W._Member._feed
    monkeypatch.setattr(W._Member, "_feed", lambda self, data: (feed(self, data), seen.append(len(self.buf)))[0])
    rng = random.Random(6)
    recs = [W.record(i, None, rng.randbytes(200_000)) for i in range(150)]
    got = W.salvage_parts(pa.BufferReader(W.member(b"".join(recs), 1)))
    assert [h["warc-record-id"] for _, _, _, h, _, _ in got] == [f"<urn:x-page:{i}>" for i in range(150)]
    assert max(seen) < 1_000_000


def test_length_beyond_the_bound_is_a_gap():
    a = W.record(0, None, b"one")
    long = a.replace(b"Content-Length: ", b"Content-Length: 99999999999")
    for data in (long + W.record(1, None, b"two"), W.member(long + W.record(1, None, b"two"))):
        assert numbers(parts(data)) == ["gap", 1] and parts(data)[0][5] == "record too long"
