"""WARC archives: round trips, splits at every place, broken input."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from premia.llm.archive import MAGIC, decided, inflate, members_of_range, parse, read_archive, stitched, write_archive


def expected(rows):
    groups = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page is not None:
            groups[raw] = max(page, groups.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        largest = groups.get(raw)
        revisit = largest is not None and page != largest
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    return sorted(out, key=str)


def cases():
    random.seed(2)
    text = lambda n: "".join(chr(random.choice([97, 98, 233, 0x4E2D, 10, 60])) for _ in range(n))
    rows = [(i, f"http://x/{i} y\r\nz", text(random.randrange(3000))) for i in range(60)]
    same = text(1500)
    rows += [(100 + i, None, same) for i in range(5)] + [(None, "u", same), (104, "u", same)]
    rows += [(200, "a", "x" * 999), (201, "a", "x" * 999), (202, "a", "x" * 1000), (203, "a", "x" * 1000), (204, "", None), (205, "", ""), (None, "n", text(1200)), (206, "long", text(600_000))]
    return rows


@pytest.mark.parametrize("split", ["128m", "700", "37"])
def test_round_trip_at_any_split(llm_spark, tmp_path, split):
    rows = cases() if split != "37" else cases()[:40] + cases()[60:67]
    pages = llm_spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "key": F.lit(1)}).coalesce(2)
    write_archive(pages, str(tmp_path / "a"))
    keep = {k: llm_spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        llm_spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        llm_spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for payloads in (True, False):
            back = read_archive(llm_spark, str(tmp_path / "a"), payloads)
            got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()
            assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
            if payloads:
                stored = {hashlib.sha1(r.payload).hexdigest() for r in got if r.payload is not None}
                assert stored == {e[2] for e in expected(rows)}
    finally:
        for k, v in keep.items():
            llm_spark.conf.set(k, v)


def test_files_are_plain_gzip(llm_spark, tmp_path):
    pages = llm_spark.createDataFrame([(1, "u", "hello"), (2, "u", None)], "page_id long, url string, html string").coalesce(1)
    write_archive(pages, str(tmp_path / "a"))
    data = next((tmp_path / "a").glob("part-*")).read_bytes()
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2


def gz(content, level=0):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def test_false_magic_anywhere():
    contents = [b"one", b"two " + MAGIC + b" middle " + MAGIC + b"\x00\x00\x00\x00\x00\x00\x03" + b"tail", b"x" * 50 + MAGIC, MAGIC * 5, b"", b"end"]
    data = b"".join(gz(c) for c in contents)
    for cut in range(1, len(data)):
        got, parts = [], []
        # A range owns the candidates whose magic starts in it, except at its very end, like the line reader.
        places = [i for i in range(len(data)) if data.startswith(MAGIC, i)]
        ends = places[1:] + [len(data)]
        for low, high in ((0, cut), (cut, len(data))):
            own = [data[p + 3 : e] for p, e in zip(places, ends) if low <= p < high]
            for kind, content in members_of_range(iter(([b""] if low == 0 else []) + own), low == 0):
                (got if kind == "record" else parts).append(content)
        assert sorted(got + list(stitched(parts))) == sorted(contents), cut


def test_broken_archives_raise():
    good = gz(b"content here", 6)
    assert inflate(good)[0] == "done" and inflate(good[:-3])[0] == "more" and inflate(b"\x1f\x8b\x08garbage")[0] == "bad"
    with pytest.raises(ValueError):
        list(members_of_range(iter([b"junk", good[3:]]), True))
    with pytest.raises(ValueError):
        list(stitched([good[:-3]]))
    with pytest.raises(ValueError):
        parse(b"HTTP/1.1 200 OK\r\n\r\n")


def test_empty_table(llm_spark, tmp_path):
    pages = llm_spark.createDataFrame([], "page_id long, url string, html string")
    assert decided(pages).count() == 0
    write_archive(pages, str(tmp_path / "a"))
    assert read_archive(llm_spark, str(tmp_path / "a")).count() == 0
