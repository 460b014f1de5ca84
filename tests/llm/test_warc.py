import base64
import gzip
import hashlib
import random

import pytest
import zstandard
from ledgerline.llm import queries, warc
from ledgerline.session import scratch_path


def brute(rows):
    """Contract over (page_id, html) rows."""
    best = {}
    for i, h in rows:
        raw = (h or "").encode()
        if i is not None:
            best[raw] = max(best.get(raw, i), i)
    out = []
    for i, h in rows:
        raw = (h or "").encode()
        keep = best.get(raw)
        revisit = keep is not None and keep != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query(spark, sf_dir):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert got(queries.op7_warc_salvage(spark, sf_dir)) == brute(rows)


def test_edges(spark, save):
    rows = [(1, "u", None), (2, None, ""), (3, "http://a/b c\r\nX: y", "WARC/1.1\r\n\r\n"), (4, "u", "é\r\n\r\n"), (5, "u", "é\r\n\r\n"),
            (5, "u", "é\r\n\r\n"), (None, "u", "solo"), (None, None, "é\r\n\r\n"), (-7, "u", "(\xb5/\xfd"), (8, "u", "x" * 3_000_000),
            *((i, "u", "copy") for i in range(100, 160))]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string")
    assert got(queries.op7_warc_salvage(spark, save(pages=df))) == brute([(i, h) for i, _, h in rows])


def test_empty(spark, save):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert queries.op7_warc_salvage(spark, save(pages=df)).count() == 0


def packed(kind, parts):
    if kind == "plain":
        return parts
    if kind == "gzip":
        return [gzip.compress(p, mtime=0) for p in parts]
    return [zstandard.ZstdCompressor(write_checksum=True).compress(p) + warc.EMPTY_FRAME.encode() for p in parts]


@pytest.mark.parametrize("kind", ["plain", "gzip", "zstd"])
def test_salvage(kind):
    rng = random.Random(8)
    pages = [bytes(rng.choice(b"abc WARC/1.0\r\n") for _ in range(rng.randint(0, 400))) for _ in range(20)]
    members = packed(kind, [warc.record(i, f"http://x/{i}", p, None, False) for i, p in enumerate(pages)])
    data = b"".join(members)
    assert [f.payload for _, _, f, _ in warc.salvage(data)] == pages
    starts = [sum(map(len, members[:i])) for i in range(21)]
    for bad in (0, 7, 19):
        broken = bytearray(data)
        middle = starts[bad] + len(members[bad]) - 20
        for i in range(middle, middle + 6):
            broken[i] ^= 0x5A
        found = list(warc.salvage(bytes(broken)))
        numbers = [int(f.headers["warc-record-id"][len("<" + warc.ID_PREFIX):-1]) for _, _, f, _ in found if f]
        assert numbers == [i for i in range(20) if i != bad]
        (gap,) = [(o, n) for o, n, f, _ in found if f is None]
        assert starts[bad] == gap[0] and starts[bad] < sum(gap) <= starts[bad + 1]
    for cut in (1, len(members[-1]) // 2):  # lost end, junk between, lost start
        assert len([f for _, _, f, _ in warc.salvage(data[:starts[19] + cut]) if f]) == 19
    junk = data[:starts[5]] + b"\x28\xb5\x2f\xfdjunk WARC/1.1\r\n" + data[starts[5]:]
    assert [f.payload for _, _, f, _ in warc.salvage(junk) if f] == pages
    assert [f.payload for _, _, f, _ in warc.salvage(data[3:]) if f] == pages[1:]


def test_reader_logs_gaps(spark):
    good = [zstandard.ZstdCompressor(write_checksum=True).compress(warc.record(i, None, b"page", None, False)) for i in range(4)]
    path = scratch_path(spark, "damaged")
    row = spark.createDataFrame([(bytearray(good[0] + good[1][:-9] + good[2] + good[3]),)], "value binary")
    row.selectExpr("cast(value as string) value").coalesce(1).write.option("lineSep", "\x00").text(path)
    rows = warc.read_archives(spark, path, glob="part-*").orderBy("offset").collect()
    assert [r.record_id for r in rows] == [f"<{warc.ID_PREFIX}0>", None, f"<{warc.ID_PREFIX}2>", f"<{warc.ID_PREFIX}3>", None]
    assert rows[1].offset == len(good[0]) and rows[1].length == len(good[1]) - 9 and rows[1].gap_reason
    assert bytes(rows[0].payload) == b"page"


def test_nothing_to_read():
    assert list(warc.salvage(b"")) == []
    assert [(o, n) for o, n, _, _ in warc.salvage(b"no records")] == [(0, 10)]


def test_members_of_many_records_and_old_versions():
    records = [warc.record(i, f"http://x/{i}", b"page %d" % i, None, False) for i in range(4)]
    bad = records[1].replace(b"page 1", b"page 7")
    pack = zstandard.ZstdCompressor().compress
    for data in (gzip.compress(b"".join(records)), pack(b"".join(records)), b"".join(map(gzip.compress, records))):
        found = list(warc.salvage(data))
        assert [r.payload for _, _, r, _ in found] == [b"page %d" % i for i in range(4)]
    for squeeze in (gzip.compress, pack):
        data = squeeze(records[0] + bad + records[2] + records[3])
        found = list(warc.salvage(data))
        assert [r and r.payload for _, _, r, _ in found] == [b"page 0", None, b"page 2", b"page 3"]
        assert {(at, n) for at, n, _, _ in found} == {(0, len(data))}
    old = b"".join(r.replace(b"WARC/1.1", b"WARC/0.18", 1) for r in (records[0], bad, records[2], records[3]))
    assert [r and r.payload for _, _, r, _ in warc.salvage(old)] == [b"page 0", None, b"page 2", b"page 3"]


def test_salvage_is_linear_in_a_damaged_run():
    import time
    record = warc.record(1, "u", b"page", None, False)
    for run in (b"WARC/1.1\r\n" * 800_000, b"WARC/1.1\r\na: b\r\n" * 400_000, b"WARC/1.1\r\nno colon" * 400_000):
        start = time.perf_counter()
        found = list(warc.salvage(run + record))
        assert [(at, r and r.payload) for at, _, r, _ in found] == [(0, None), (len(run), b"page")]
        assert time.perf_counter() - start < 10


@pytest.mark.parametrize("tasks", [1, 8])
def test_a_file_of_several_splits_reads_the_same(spark, tasks):
    rng = random.Random(3)
    rows = [(i, f"u{i}", rng.randbytes(3000).hex()) for i in range(300)]
    path = scratch_path(spark, "split")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k" if tasks == 8 else "1g")
    try:
        read = warc.read_frames(spark, path, glob="part-*")
        assert (read.rdd.getNumPartitions() >= 3) == (tasks == 8)
        got = sorted((r.record_id, bytes(r.payload), r.gap_reason) for r in read.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted((f"<{warc.ID_PREFIX}{i}>", h.encode(), None) for i, _, h in rows)
    whole = sorted((r.record_id, bytes(r.payload), r.gap_reason) for r in warc.read_archives(spark, path, glob="part-*").collect())
    assert whole == got


def test_ranged_reader_salvages(spark):
    press = zstandard.ZstdCompressor(write_checksum=True).compress
    good = [press(warc.record(i, None, b"page %d" % i, None, False)) for i in range(6)]
    empty = warc.EMPTY_FRAME.encode()
    bad = good[1][:-9] + bytes([good[1][-9] ^ 0x55]) + good[1][-8:]
    data = good[0] + empty + bad + empty + good[2] + b"P*M\x18\x01\x00\x00\x00x" + good[3] + empty + good[4][:-5] + good[5] + empty
    path = scratch_path(spark, "damaged")
    spark.createDataFrame([(bytearray(data),)], "value binary").selectExpr("cast(value as string) value").coalesce(1).write.option(
        "lineSep", "\x00").text(path)
    rows = warc.read_frames(spark, path, glob="part-*").collect()
    assert sorted(bytes(r.payload) for r in rows if r.gap_reason is None) == [b"page 0", b"page 2", b"page 3", b"page 5"]
    assert sum(r.gap_reason is not None for r in rows) >= 2
