"""Archive, line, SQLite and tail sources on files made here."""

import gzip
import hashlib
import io
import json
import sqlite3
import tarfile
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from cinderlane.sources import archives
from cinderlane.streaming import tail


def test_tar_members_and_their_catalogue(spark, tmp_path):
    want = {}
    for a in range(2):
        with tarfile.open(tmp_path / f"{a}.tar", "w") as t:
            folder = tarfile.TarInfo(f"dir{a}/")
            folder.type = tarfile.DIRTYPE
            t.addfile(folder)
            for i in range(40):
                body = f"{a}/{i}/".encode() * (i * 37)
                info = tarfile.TarInfo(f"d{a}/{'long/' * 30}{i}.json")
                info.size = len(body)
                t.addfile(info, io.BytesIO(body))
                want[info.name] = body
    (tmp_path / "readme.txt").write_text("not an archive")
    rows = archives.tar_members(spark, str(tmp_path), part_bytes=3000)
    assert rows.rdd.getNumPartitions() > 10  # members of one archive in many tasks
    got = {r.member: r for r in rows.collect()}
    assert {k: bytes(r.content) for k, r in got.items()} == want and all(r.size == len(want[k]) and r.sha256 == hashlib.sha256(want[k]).hexdigest() for k, r in got.items())
    names = sorted(want)
    listed = [(n, len(want[n]), hashlib.sha256(want[n]).hexdigest()) for n in names[3:]] + [("gone", 1, "x"), ("gone", 1, "x")]
    listed[0] = (listed[0][0], 7, listed[0][2])
    listed[1] = (*listed[1][:2], "other")
    listed.append(listed[2])
    problems = archives.catalogue_check(rows, spark.createDataFrame(listed, "member string, size long, sha256 string")).collect()
    assert {r.member: r.problem for r in problems} == {**{n: "unlisted" for n in names[:3]}, names[3]: "size_differs", names[4]: "digest_differs", names[5]: "listed_twice", "gone": "missing"}


def test_numbered_lines_of_every_kind(spark, tmp_path):
    lines = [f"line {i} é" for i in range(5000)]
    text = "\n".join(lines).encode()
    (tmp_path / "a.txt").write_bytes(text)
    (tmp_path / "b.gz").write_bytes(gzip.compress(text[:1000]) + gzip.compress(text[1000:]))
    half = len(text) // 2
    (tmp_path / "c.zst").write_bytes(zstandard.compress(text[:half]) + zstandard.compress(text[half:]))
    (tmp_path / "empty.txt").write_bytes(b"")
    got = {}
    for r in archives.numbered_lines(spark, f"file://{tmp_path}").collect():
        got.setdefault(r.path.rpartition("/")[2], {})[r.n] = r.line
    assert got.keys() == {"a.txt", "b.gz", "c.zst"} and all(v == dict(enumerate(lines)) for v in got.values())


def test_sqlite_by_ranges(spark, tmp_path):
    with sqlite3.connect(tmp_path / "c.db") as db:
        db.execute('CREATE TABLE "odd ""name" (id INTEGER PRIMARY KEY, tag TEXT, at REAL, raw BLOB)')
        rows = [(i, f"t{i}" if i % 7 else None, i / 2, bytes([i % 256])) for i in range(-5, 500) if i % 3]
        db.executemany('INSERT INTO "odd ""name" VALUES (?, ?, ?, ?)', rows)
        db.execute("CREATE TABLE blank (id INTEGER PRIMARY KEY)")
    d = archives.sqlite_table(spark, str(tmp_path / "c.db"), 'odd "name', "tag string, id long, raw binary", part_rows=50)
    assert d.rdd.getNumPartitions() > 9 and [(r.id, r.tag, bytes(r.raw)) for r in d.collect()] == [(r[0], r[1], r[3]) for r in rows]
    assert archives.sqlite_table(spark, str(tmp_path / "c.db"), "blank", "id long").isEmpty()


@pytest.mark.parametrize("most", [1, 7, 50, 1 << 20])
def test_tail_ranges_hold_each_line_once(tmp_path, most):
    text = b"".join(b"x" * (i * 13 % 40) + b"\n" for i in range(60)) + b"unfinished"
    (tmp_path / "log").write_bytes(text)
    reader = archives.TailReader({"path": str(tmp_path), "partBytes": str(most)})
    end = reader.latestOffset()
    assert end == {str(tmp_path / "log"): len(text) - 10}
    got = [row for part in reader.partitions(reader.initialOffset(), end) for row in reader.read(part)]
    assert [line for _, _, line in got] == text.decode().split("\n")[:-1]
    assert [at for _, at, _ in got] == [i for i, _ in _starts(text)]


def _starts(text):
    at = 0
    for line in text.split(b"\n")[:-1]:
        yield at, line
        at += len(line) + 1


def test_collection_goes_on_where_it_stopped(spark, tmp_path):
    log, out = tmp_path / "in" / "index.jsonl", f"file://{tmp_path}/out"
    log.parent.mkdir()
    row = lambda i, **more: json.dumps({"tag": f"#{i}", "crowns": i % 5, "at": f"2024-01-01T00:{i % 60:02d}:00Z", **more}) + "\n"
    rules = {"too_many_crowns": F.col("crowns") > 3}
    run = lambda: tail.collect(spark, str(log.parent), out, "tag string, crowns int, at timestamp", "tag", "at", rules, part_bytes=200)
    log.write_text("".join(row(i) for i in range(20)) + row(3) + "not json\n" + row(20)[:15])
    run()
    rest = row(20)[15:]
    with log.open("a") as f:
        f.write(rest + row(5) + "".join(row(i) for i in range(21, 40)) + "[1]\n" + '{"crowns": 1}\n')
    run()
    run()  # nothing new
    a, r = (spark.read.option("recursiveFileLookup", True).parquet(f"{out}/{n}").collect() for n in ("accepted", "rejected"))
    assert Counter(x.tag for x in a) == Counter(f"#{i}" for i in range(40) if i % 5 < 4)
    assert Counter((x.tag, x.line, tuple(x.reasons)) for x in r) == Counter([(f"#{i}", None, ("too_many_crowns",)) for i in range(4, 40, 5)] + [(None, line, ("unreadable",)) for line in ("not json", "[1]", '{"crowns": 1}')])
    p = tail.progress(spark, out, 40).first()
    assert (p.accepted, p.rejected, p.missing, p.done, [tuple(x) for x in p.reasons]) == (32, 11, 8, False, [("too_many_crowns", 8), ("unreadable", 3)])
    assert tail.progress(spark, out, 32).first().done
