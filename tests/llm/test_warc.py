"""WARC round trips, and what is saved of damaged archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import time

import pytest

from monsoon.llm import warc

SCHEMA = "page_id long, url string, html string"


def record(n, payload, digest=None, kind="response"):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + (payload if kind == "response" else b"")
    digest = digest or base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = (
        f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{n}>\r\n"
        f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Type: application/http; msgtype=response\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def payloads(n=12, seed=0):
    random.seed(seed)
    return [bytes(random.choices(range(256), k=random.randint(0, 3000))) for _ in range(n)]


def ids(found):
    return [r["record_id"].rpartition(":")[2] for r in found if not r.get("problem")]


def covered(found, size):
    """Records and gaps lie end to end over the whole file."""
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["length"]
    assert at == size


def test_plain_file():
    parts = payloads()
    data = b"".join(record(i, p) for i, p in enumerate(parts))
    found = list(warc.recovered(data))
    assert [r["payload"] for r in found] == parts
    covered(found, len(data))


def test_payload_that_looks_like_a_record():
    inner = record(7, b"inner")
    data = record(0, b"x" + inner + b"\r\n\r\nWARC/1.1\r\n") + record(1, b"next")
    assert ids(warc.recovered(data)) == ["0", "1"]


@pytest.mark.parametrize("seed", range(30))
def test_damage_costs_only_what_it_hits(seed):
    random.seed(seed)
    parts = payloads(10, seed)
    raw = [record(i, p) for i, p in enumerate(parts)]
    hurt = set(random.sample(range(10), 3))
    spoiled = []
    for i, r in enumerate(raw):
        if i in hurt:
            at = random.randrange(len(r) - 4)
            r = random.choice([
                r[:at] + bytes([r[at] ^ 0x55]) + r[at + 1 :],  # a flipped byte
                r[:at] + r[at + random.randint(1, 4) :],  # bytes lost
                r[:at] + b"\0" * 20 + r[at:],  # bytes added
                b"junk" + r,
            ])
        spoiled.append(r)
    data = b"".join(spoiled)
    found = list(warc.recovered(data))
    covered(found, len(data))
    saved = set(ids(found))
    assert {str(i) for i in range(10) if i not in hurt} <= saved
    for r in found:
        if not r.get("problem") and r["record_id"].rpartition(":")[2].isdigit():
            n = int(r["record_id"].rpartition(":")[2])
            if n not in hurt:
                assert r["payload"] == parts[n]
    for r in found:
        if r.get("problem"):
            assert r["length"] > 0


def test_cut_off_and_not_warc():
    data = record(0, b"a" * 500) + record(1, b"b" * 500)
    found = list(warc.recovered(data[:-100]))
    assert ids(found) == ["0"] and found[1]["problem"] == "cut off"
    assert [r["problem"] for r in warc.recovered(b"no archive at all")] == ["version line"]
    assert list(warc.recovered(b"")) == []


def test_members():
    parts = payloads()
    members = [gzip.compress(record(i, p)) for i, p in enumerate(parts)]
    found = list(warc.recovered(b"".join(members)))
    assert [r["payload"] for r in found] == parts
    whole = gzip.compress(b"".join(record(i, p) for i, p in enumerate(parts)))
    assert [r["payload"] for r in warc.recovered(whole)] == parts


@pytest.mark.parametrize("seed", range(10))
def test_broken_members(seed):
    random.seed(seed)
    parts = [b"page %d " % i + bytes(random.choices(range(256), k=2000)) for i in range(8)]
    members = [gzip.compress(record(i, p)) for i, p in enumerate(parts)]
    bad = random.randrange(1, 8)
    m = bytearray(members[bad])
    m[random.randrange(200, len(m) - 8)] ^= 0xFF
    members[bad] = random.choice([bytes(m), bytes(m[: len(m) // 2]), b"\x1f\x8b\x08garbage"])
    found = list(warc.recovered(b"".join(members)))
    good = [r for r in found if not r.get("problem")]
    assert {str(i) for i in range(8) if i != bad} <= set(ids(found))
    assert any(r.get("problem") for r in found)
    assert all(r["payload"] == parts[int(r["record_id"].rpartition(":")[2])] for r in good)


@pytest.mark.parametrize("at", range(4))
def test_damaged_start_costs_the_first_member_only(at):
    parts = payloads()
    members = [gzip.compress(record(i, p)) for i, p in enumerate(parts)]
    first = bytearray(members[0])
    first[at] ^= 0xFF
    data = bytes(first) + b"".join(members[1:])
    found = list(warc.recovered(data))
    assert ids(found) == [str(i) for i in range(1, 12)]
    assert found[0]["problem"] and found[0]["length"] == len(first)
    random.seed(at)
    for junk in (b"\0" * 100, b"junk" * 50, bytes(random.choices(range(256), k=5000)), b"\x1f\x8b\x08" * 40):
        found = list(warc.recovered(junk + b"".join(members)))
        assert ids(found) == [str(i) for i in range(12)]
        assert (found[0]["start"], found[0]["length"]) == (0, len(junk)) or junk.startswith(warc.MEMBER)


def test_what_a_broken_member_gave_is_kept():
    """A wrong trailer costs nothing, a break what follows it, in files of any size."""
    random.seed(2)
    for n in (12, 200):
        parts = [" ".join(random.choices(["one", "two", "three", "four"], k=300)).encode() + b" %d" % i for i in range(n)]
        data = bytearray(gzip.compress(b"".join(record(i, p) for i, p in enumerate(parts))))
        data[-8] ^= 0xFF
        assert ids(warc.recovered(bytes(data))) == [str(i) for i in range(n)]
        data[len(data) * 3 // 4] ^= 0xFF
        assert ids(warc.recovered(bytes(data)))[: n // 2] == [str(i) for i in range(n // 2)]
        assert any(r.get("problem") for r in warc.recovered(bytes(data)))


def test_damage_of_written_archives_costs_one_record(spark, tmp_path):
    path = tmp_path / "archives"
    big = "".join(random.Random(4).choices("abcdefgh", k=17 << 20))
    rows = [(i, "u", f"page {i} " * 200) for i in range(40)] + [(40, "u", big), (41, "u", None)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    warc.write_archives(df, str(path), compression="gzip")
    seen = 0
    for file in path.glob("part-*"):
        data = file.read_bytes()
        whole = ids(warc.recovered(data))
        assert not any(r.get("problem") for r in warc.recovered(data))
        assert gzip.decompress(data).count(b"WARC-Type") == len(whole)
        starts = [r["start"] for r in warc.recovered(data)]
        assert len(set(starts)) == len(whole)
        seen += len(whole)
        for n, start in enumerate(starts[:5]):
            hurt = bytearray(data)
            hurt[start + 60] ^= 0xFF
            assert set(whole) - set(ids(warc.recovered(bytes(hurt)))) <= {whole[n]}
    assert seen == len(rows)


def test_packed_payloads_of_a_plain_file():
    inner = gzip.compress(record(70, b"inner"))
    data = record(0, gzip.compress(b"text" * 50)) + record(1, inner) + record(2, b"next")
    assert ids(warc.recovered(data)) == ["0", "1", "2"]
    assert ids(warc.recovered(b"X" + data[1:])) == ["1", "2"]


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_archives_of_spark(spark, tmp_path, compression):
    rows = [
        (1, "http://a/é b", "<p>one"), (2, None, "<p>one"), (3, "http://c\r\nX: y", None), (4, "u", ""),
        (5, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n"), (6, "u", "日本 🙂"), (7, "u", "z" * 3_000_000),
        (None, "u", "<p>one"), (2, "u", "<p>one"), (None, "u", "only"), (None, "u", "only"),
    ]
    df = spark.createDataFrame([(*r, "q", 3) for r in rows], SCHEMA + ", sha1 string, payload int")
    path = str(tmp_path / "archives")
    warc.write_archives(df, path, per_file=3, compression=compression)
    read = warc.read_archives(spark, path).collect()
    assert not any(r.problem for r in read)
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    assert {int(p): r.payload for r in read if r.record_type == "response" and (p := r.record_id.rpartition(":")[2]) != "none"} == {
        i: payload[i] for i in (2, 4, 5, 6, 7)}
    got = sorted(map(tuple, warc.page_records(warc.read_archives(spark, path)).collect()), key=str)

    def line(i, html, kind, refers):
        data = (html or "").encode()
        return (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, refers)

    want = [
        line(1, "<p>one", "revisit", 2), line(2, "<p>one", "response", None), line(2, "<p>one", "response", None),
        line(None, "<p>one", "revisit", 2), line(3, None, "revisit", 4), line(4, "", "response", None),
        *(line(*r, "response", None) for r in [(5, rows[4][2]), (6, rows[5][2]), (7, rows[6][2]), (None, "only"), (None, "only")]),
    ]
    assert got == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).collect() == []


@pytest.mark.parametrize("end", [b"\n", b"\r\n"])
def test_time_grows_with_length(end):
    """Version lines without a blank line after them, or with one at the very end only."""
    lines = (b"WARC/1.1" + end + b"WARC-Type: response" + end) * 200_000
    for data in (lines, lines + b"\r\n\r\n"):
        began = time.process_time()
        [gap] = warc.recovered(data)
        assert time.process_time() - began < 10
        assert (gap["start"], gap["length"], gap["problem"]) == (0, len(data), "headers")
    good = record(3, b"kept")
    found = list(warc.recovered(lines + good))
    assert ids(found) == ["3"] and found[0]["file_length"] == len(lines)


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_gaps_are_logged_with_their_range(spark, tmp_path, monkeypatch, compression):
    """What the log names of a file holds the damage; all else is recovered."""
    path, log = tmp_path / "archives", str(tmp_path / "log")
    df = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(12)], SCHEMA).coalesce(1)
    warc.write_archives(df, str(path), compression=compression)
    assert warc.salvage(spark, str(path), log).count() == 12
    assert spark.read.text(log).count() == 0
    [file] = [f for f in path.glob("part-*") if f.stat().st_size]
    data = file.read_bytes()
    hurt = list(warc.recovered(data))[4]
    at = hurt["file_start"] + hurt["file_length"] - 20
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(data[:at] + bytes([data[at] ^ 0xFF]) + data[at + 1 :])
    left = {r.record_id for r in warc.salvage(spark, str(path), log).collect()}
    assert len(left) == 11 and hurt["record_id"] not in left
    gaps = spark.read.json(log).collect()
    assert gaps and {r.file.rsplit("/", 1)[1] for r in gaps} == {file.name}
    assert all(r.problem and hurt["file_start"] <= r.file_start <= at < r.file_start + r.file_length for r in gaps)
    monkeypatch.setattr(warc, "LARGEST_FILE", len(data) - 1)
    assert warc.salvage(spark, str(path), log).count() == 0
    [gap] = spark.read.json(log).collect()
    assert (gap.file_start, gap.file_length, gap.problem) == (0, len(data), "file: too large")
