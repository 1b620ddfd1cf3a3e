from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import pytest

from niimble.llm import warc
from tests.llm.cases import rows_of

PAGES = "page_id long, url string, html string"


def pages(spark, n=300):
    rng = random.Random(9)
    copies = ["<p>" + "copy " * 60 + str(k) for k in range(4)]
    rows = []
    for i in range(n):
        html = rng.choice(copies) if rng.random() < 0.4 else f"<p>page {i} é " + " ".join(str(rng.random()) for _ in range(rng.randrange(200)))
        rows.append((i * 3, f"http://site{i % 7}.example/{i}", rng.choice([html, html, html, "short", "", None])))
    return spark.createDataFrame(rows, PAGES).repartition(4)


def expected(frame):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in frame.collect()]
    first = {}
    for i, p in rows:
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    found = []
    for i, p in rows:
        target = first[p] if p in first and i is not None and i > first[p] else None
        found.append((
            None if i is None else str(i), len(p), hashlib.sha256(p).hexdigest(), "revisit" if target is not None else "response",
            None if target is None else str(target), None if target is not None else p,
        ))
    return sorted(found, key=repr)


def read_back(spark, root):
    columns = ("page", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in warc.read_archives(spark, root).select(*columns).collect()), key=repr)


def test_round_trip_over_many_files(spark, tmp_path):
    frame = pages(spark)
    root = str(tmp_path / "warc")
    manifest = warc.write_archives(frame, root, shard_bytes=60_000, roll_bytes=8_000)
    assert read_back(spark, root) == expected(frame)
    files = sorted(p.name for p in Path(root).glob("*.warc.gz"))
    assert files == sorted(r["name"] for r in manifest.collect())
    assert len({f[:13] for f in files}) > 3
    assert any(f.endswith("-00001.warc.gz") for f in files)
    assert not (Path(root) / "_temporary").exists()
    assert (Path(root) / "_SUCCESS").exists()


def test_files_do_not_depend_on_partitions(spark, tmp_path):
    frame, sums = pages(spark), []
    for k, dealt in enumerate((frame, frame.repartition(9))):
        root = str(tmp_path / f"warc{k}")
        manifest = warc.write_archives(dealt, root, shard_bytes=60_000, roll_bytes=20_000)
        sums.append(rows_of(manifest, "name", "bytes", "records", "sha256"))
        for name, size, _, digest in sums[-1]:
            data = (Path(root) / name).read_bytes()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (size, digest)
    assert sums[0] == sums[1]


def test_records_are_sorted_gzip_members(spark, tmp_path):
    root = str(tmp_path / "warc")
    warc.write_archives(pages(spark), root, shard_bytes=60_000)
    seen = []
    for path in sorted(Path(root).glob("*.warc.gz")):
        with path.open("rb") as stream:
            records = list(warc.read_records(stream))
        assert records[0][0]["warc-type"] == "warcinfo"
        seen += [int(h["x-page-id"]) for h, _ in records[1:]]
        assert gzip.decompress(path.read_bytes()).count(b"WARC/1.1\r\n") == len(records)
    assert seen == sorted(seen)


def test_commit_may_be_repeated_and_leftovers_go(spark, tmp_path):
    root = tmp_path / "warc"
    frame = pages(spark)
    warc.write_archives(frame, str(root))
    (root / "_temporary" / "lost").mkdir(parents=True)
    (root / "_temporary" / "lost" / "part-00000000-00000.warc.gz").write_bytes(b"half a file")
    warc.commit(spark, str(root))
    assert not (root / "_temporary").exists()
    assert read_back(spark, str(root)) == expected(frame)


def test_a_changed_payload_is_found(spark, tmp_path):
    root = tmp_path / "warc"
    warc.write_archives(pages(spark, 5), str(root))
    path = next(root.glob("*.warc.gz"))
    data = gzip.decompress(path.read_bytes()).replace(b"<p>", b"<q>")
    path.write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.read_archives(spark, str(root)).collect()


def test_edges(spark, tmp_path):
    long = "long " * 100_000
    rows = [
        (1, None, None), (2, "", ""), (3, "http://a b\r\nX: y", "x" * 99), (4, "u", "x" * 99), (5, "u", "x" * 100), (6, "u", "x" * 100),
        (6, "u", "x" * 100), (None, "u", "x" * 100), (None, None, None), (7, "u", long), (8, "v", long), (9, "é", "\x00\r\n\r\nWARC/1.1\r\n" * 20),
    ]
    frame = spark.createDataFrame(rows, PAGES)
    root = str(tmp_path / "warc")
    warc.write_archives(frame, root)
    assert read_back(spark, root) == expected(frame)
    nothing = str(tmp_path / "none")
    assert warc.write_archives(spark.createDataFrame([], PAGES), nothing).collect() == []
    assert warc.read_archives(spark, nothing).collect() == []
