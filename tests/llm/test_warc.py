import base64
import hashlib
import random

from pyspark.sql import functions as F

import gzip
import time

from textsignal.llm.warc import archive_files, first_pages, gaps, member, page_record, parse_archives, read_archives, records, salvage, spoiled, write_archives


def archive(n, compress):
    whole = [page_record(i, f"http://x/{i}", (b"<p>%d</p>" % i) * 40, None) for i in range(n)]
    return [member(r) for r in whole] if compress else whole


def kinds(data):
    return [(f.kind, f.start, f.end) for f in salvage(data)]


def test_sound_archives():
    for compress in (True, False):
        parts = archive(5, compress)
        at, want = 0, []
        for p in parts:
            want.append(("record", at, at + len(p)))
            at += len(p)
        assert kinds(b"".join(parts)) == want
    assert kinds(b"") == []
    assert kinds(b"no archive") == [("gap", 0, 10)]


def test_damage_costs_the_damaged_record_alone():
    rng = random.Random(6)
    for compress in (True, False):
        parts = archive(6, compress)
        edges = [sum(map(len, parts[:i])) for i in range(7)]
        for _ in range(60):
            data = bytearray(b"".join(parts))
            hit = rng.randrange(6)
            for _ in range(rng.randint(1, 4)):
                data[edges[hit] + rng.randrange(len(parts[hit]))] ^= rng.randrange(1, 256)
            found = list(salvage(bytes(data)))
            assert [f.start for f in found][0] == 0 and found[-1].end == len(data)
            assert all(a.end == b.start for a, b in zip(found, found[1:]))  # every byte is in a record or in a gap
            whole = {(f.start, f.end) for f in found if f.kind == "record"}
            assert {(edges[i], edges[i + 1]) for i in range(6) if i != hit} <= whole


def test_junk_and_cuts():
    parts = archive(4, True)
    data = b"\x1f\x8b\x08junk" + parts[0] + b"WARC/1.1\r\nbroken" + parts[1] + parts[2][:50] + parts[3] + parts[0][:-9]
    # The last member lacks its end, but its record is whole and is recovered.
    assert [k for k, _, _ in kinds(data)] == ["gap", "record", "gap", "record", "gap", "record", "record", "gap"]


def test_pages_round_trip(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for compress in (True, False):
        folder = f"file://{tmp_path}/{compress}"
        assert write_archives(pages, folder, compress=compress) == pages.count()
        parsed = read_archives(spark, folder)
        assert gaps(parsed).count() == 0
        got = {r.page_id: r for r in records(parsed).collect()}
        for r in pages.collect():
            payload = r.html.encode()
            assert got[r.page_id].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert bytes(got[r.page_id].payload) == payload and got[r.page_id].target_uri == r.url


def test_a_damaged_file_is_salvaged_and_logged(spark, tmp_path):
    pages = spark.range(200).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(concat('<p>', id), 50) AS html").coalesce(1)
    write_archives(pages, f"file://{tmp_path}/w")
    path = next((tmp_path / "w").glob("*.warc.gz"))
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 255
    path.unlink()
    (tmp_path / "w" / "hurt.warc.gz").write_bytes(data)
    parsed = read_archives(spark, f"file://{tmp_path}/w")
    assert records(parsed).count() == 199 and gaps(parsed).count() == 1


def test_edges(spark, make, tmp_path):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "x"), (0, "u\r\ninjected: 1", "x"), (None, "u", "x"), (5, "u", "é" * 3_000_000), (5, "u", "é" * 3_000_000)]
    pages = make(rows, "page_id long, url string, html string")
    refers = {(r.page_id, r.refers_to) for r in first_pages(pages).collect()}
    assert refers == {(1, None), (2, 1), (3, 0), (0, None), (None, 0), (5, None)}
    assert (2, None) in {(r.page_id, r.refers_to) for r in first_pages(pages, 1).collect()}
    assert write_archives(pages, f"file://{tmp_path}/e") == len(rows)
    got = records(read_archives(spark, f"file://{tmp_path}/e")).collect()
    assert len(got) == len(rows) and {r.page_id: r.payload_bytes for r in got} == {1: 0, 2: 0, 3: 1, 0: 1, None: 1, 5: 6_000_000}
    assert [r.record_type for r in got if r.page_id == 2] == ["revisit"]
    assert write_archives(pages.limit(0), f"file://{tmp_path}/n") == 0
    none = read_archives(spark, f"file://{tmp_path}/n")
    assert none.agg(F.count("*")).first()[0] == 0


def test_members_of_several_records():
    """A whole file as one gzip member, sound, damaged inside, cut off, and followed by others."""
    plain = archive(6, False)
    sound = list(salvage(gzip.compress(b"".join(plain))))
    assert [f.kind for f in sound] == ["record"] * 6 and sound[1].inner == (len(plain[0]), len(plain[0]) + len(plain[1]))
    hurt = plain[1].replace(b"<p>1", b"<p>9", 1)
    found = list(salvage(gzip.compress(b"".join([plain[0], hurt, *plain[2:]])) + member(plain[3])))
    assert [f.kind for f in found] == ["record", "gap", *["record"] * 5] and found[1].reason == "block digest differs"
    whole = gzip.compress(b"".join(archive(400, False)), 1)
    cut = list(salvage(whole[: len(whole) // 2]))
    assert cut[-1].kind == "gap" and sum(f.kind == "record" for f in cut) > 50
    broken = bytearray(whole)
    broken[len(whole) // 2] ^= 255
    left = list(salvage(bytes(broken) + member(plain[4])))
    assert left[-1].headers["warc-record-id"] == "<urn:page:4>" and sum(f.kind == "record" for f in left) > 50


def test_many_failures_take_linear_time():
    junk = b"".join(b"\x1f\x8b\x08junk%d" % i for i in range(60_000))
    started = time.time()
    assert [(f.kind, f.start, f.end) for f in salvage(junk + archive(1, True)[0])][0] == ("gap", 0, len(junk))
    assert time.time() - started < 20


def test_a_drill_loses_the_spoiled_records_alone(spark, tmp_path):
    pages = spark.range(300).selectExpr("id AS page_id", "'u' AS url", "repeat(concat('<p>', id), id % 7) AS html")
    write_archives(pages, f"file://{tmp_path}/d")
    parsed = parse_archives(spoiled(archive_files(spark, f"file://{tmp_path}/d"), 20, 7)).persist()
    assert {r.page_id for r in records(parsed).collect()} == {i for i in range(300) if i % 20 != 7}
    assert gaps(parsed).count() == 15 and parsed.filter("inner_start IS NOT NULL").count() == 0
