"""JSON documents cut by bytes, archives by their directories, and chunked files, against the standard library."""

import gzip
import hashlib
import io
import json
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from silverloom.sources import archives, byte_ranges, files
from silverloom.sources.json_documents import Scanner, open_documents


def nested(rnd, depth=0):
    kind = rnd.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return rnd.choice([1, -2.5, True, None, 10**12])
    if kind in (1, 2):
        return "".join(rnd.choice(['"', "\\", "\\\\", "[", "]", "{", "}", ",", ":", "é", "😀", "\n", "a", " "]) for _ in range(rnd.randrange(12)))
    if kind in (3, 4):
        return [nested(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {f'k"{i}\\': nested(rnd, depth + 1) for i in range(rnd.randrange(4))}


def document(seed):
    rnd = random.Random(seed)
    made = {"info": {"a": '"', "b": [1, {"images": [2]}]}, "version": 1, "none": [], "images": [nested(rnd) for _ in range(40)], "text": 'not "images": [1, 2]', "anns": {f"k\\{i}": nested(rnd) for i in range(30)}, "tail": [[1, 2], [3]]}
    return made, json.dumps(made, ensure_ascii=bool(seed % 2), indent=[None, 1, 3][seed % 3])


def read(documents, member):
    return [json.loads(r.element) for r in documents.elements(member).orderBy("file", "pos").collect()]


@pytest.mark.parametrize("size", [13, 64, 257, 100_000])
def test_json_elements_by_byte_ranges(spark, tmp_path, size):
    """Elements of arrays and maps, in order, wherever the cuts fall: in strings, in escapes, in keys, between elements."""
    made, text = document(size)
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    found = open_documents(spark, str(tmp_path / "a.json"), size)
    assert read(found, "images") == made["images"] and read(found, "tail") == made["tail"] and read(found, "none") == [] == read(found, "absent")
    positions = [r.pos for r in found.elements("images").orderBy("pos").collect()]
    assert positions == list(range(40))
    entries = [r.element for r in found.elements("anns").orderBy("pos").collect()]
    assert json.loads("{" + ",".join(entries) + "}") == made["anns"] and len(entries) == 30


def test_json_folder_gzip_and_fields(spark, tmp_path):
    rows = [{"id": i, "name": f"n{i}", "more": [i] * 5} for i in range(500)]
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps({"rows": rows[k * 100 : k * 100 + 100], "m": {f"x{k}": {"v": k}}}))
    (tmp_path / "z.json.gz").write_bytes(gzip.compress(json.dumps({"other": [1, {"rows": [2]}], "rows": rows[300:], "after": [9]}).encode()))
    found = open_documents(spark, str(tmp_path), 300)
    assert sorted((r.id, r.name) for r in found.rows("rows", "id:int,name:string").collect()) == [(r["id"], r["name"]) for r in rows]
    assert sorted((r.key, r.v) for r in found.entries("m", "v:int").collect()) == [("x0", 0), ("x1", 1), ("x2", 2)]
    per_file = found.elements("rows").groupBy("file").agg(F.count("*").alias("n"), F.max("pos").alias("p")).collect()
    assert sorted((r.n, r.p) for r in per_file) == [(100, 99)] * 3 + [(200, 199)]


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text(json.dumps({"images": [{"id": i, "pad": "x" * 200} for i in range(20_000)]}))
    elements = open_documents(spark, str(path)).elements("images")
    sizes = [r.n for r in elements.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 8 and sum(sizes) == 20_000 and max(sizes) < 20_000 / 4


def test_scanner_does_not_depend_on_chunks():
    _, text = document(5)
    data = text.encode()
    whole = Scanner().events(data)
    for size in (1, 2, 3, 7, 50):
        scanner, got = Scanner(), []
        for at in range(0, len(data), size):
            where, kind, depth = scanner.events(data[at : at + size])
            got += zip((where + at).tolist(), kind.tolist(), depth.tolist(), strict=True)
        assert got == list(zip(*(x.tolist() for x in whole), strict=True))


def packed(rows):
    return sorted((r.archive.rsplit("/", 1)[-1], r.member, r.size, bytes(r.content)) for r in rows.collect())


def test_archives_by_directory(spark, tmp_path, monkeypatch):
    """Members by their places, packed and stored, in zips and tars; metadata is skipped, and an own folder stripped."""
    monkeypatch.setattr(archives, "BATCH_BYTES", 1_000)
    rnd = random.Random(1)
    texts = {f"d/{i}.txt": bytes(rnd.choices(b"abc\n", k=rnd.randrange(3_000))) for i in range(50)}
    with zipfile.ZipFile(tmp_path / "w.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in texts.items():
            z.writestr(f"w/{name}", text, zipfile.ZIP_STORED if len(text) % 2 else None)
        z.writestr("__MACOSX/w/x", "skip")
        z.mkdir("w/empty")
    expected = [("w.zip", n, len(c), c) for n, c in texts.items()]
    for name, mode in (("t.tar", "w"), ("t.tar.gz", "w:gz"), ("u.tgz", "w:gz")):
        with tarfile.open(tmp_path / name, mode) as t:
            for k, (member, text) in enumerate(texts.items()):
                info = tarfile.TarInfo(f"u/{member}")
                info.size, info.mtime = len(text), 1_000 + k
                t.addfile(info, io.BytesIO(text))
        expected += [(name, n if name == "u.tgz" else f"u/{n}", len(c), c) for n, c in texts.items()]
    found = archives.archive_members(spark, str(tmp_path), task_bytes=2_000)
    assert packed(found) == sorted(expected)
    tasks = found.where(F.col("archive").endswith("w.zip")).groupBy(F.spark_partition_id()).count().count()
    assert tasks >= 3
    assert {r.modified for r in found.where(F.col("archive").endswith("t.tar")).collect()} == set(range(1_000, 1_050))
    assert archives.archive_index(spark, str(tmp_path)).where("member = 'd/7.txt'").count() == 2


def test_archive_beyond_four_gigabytes(spark, tmp_path):
    """A sparse zip whose members stand behind 5 GB: places of 64 bits, of which no more than the members are read."""
    with open(tmp_path / "big.zip", "wb") as out:
        out.seek(5 << 30)
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a.txt", b"A" * 1_000)
            z.writestr("b.txt", b"B")
    assert packed(archives.archive_members(spark, str(tmp_path))) == [("big.zip", "a.txt", 1_000, b"A" * 1_000), ("big.zip", "b.txt", 1, b"B")]


def test_bad_archives(spark, tmp_path):
    def only(name, members, **kinds):
        folder = tmp_path / name
        folder.mkdir()
        with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
            for member, text in members.items():
                z.writestr(member, text)
        return folder

    with pytest.raises(Exception, match="leaves the archive"):
        archives.archive_members(spark, str(only("out", {"../x": "x"}))).collect()
    folder = only("cut", {"x": "0123456789"})
    data = bytearray((folder / "cut.zip").read_bytes())
    data[data.index(b"0123")] = ord("9")
    (folder / "cut.zip").write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        archives.archive_members(spark, str(folder)).collect()
    (folder / "cut.zip").write_bytes(b"no zip")
    with pytest.raises(Exception, match="no zip directory"):
        archives.archive_members(spark, str(folder)).collect()
    (tmp_path / "link").mkdir()
    with tarfile.open(tmp_path / "link" / "l.tar", "w") as t:
        info = tarfile.TarInfo("x")
        info.type, info.linkname = tarfile.SYMTYPE, "/etc"
        t.addfile(info)
    with pytest.raises(Exception, match="no regular file"):
        archives.archive_members(spark, str(tmp_path / "link")).collect()


@pytest.mark.parametrize("size", [1, 999, 1_000, 1_001, 5_500])
def test_ranges_heads_and_etags(spark, tmp_path, size):
    content = random.Random(size).randbytes(size)
    (tmp_path / "f.bin").write_bytes(content)
    listed = byte_ranges.listed_files(spark, str(tmp_path))
    rows = byte_ranges.read_ranges(listed, 1_000).orderBy("range").collect()
    assert b"".join(bytes(r.data) for r in rows) == content and [r.start for r in rows] == [1_000 * r.range for r in rows]
    assert bytes(byte_ranges.read_heads(listed, 300).first().head) == content[:300]
    parts = [hashlib.md5(content[i : i + 1_000]).digest() for i in range(0, max(size, 1), 1_000)]
    expected = hashlib.md5(content).hexdigest() if len(parts) == 1 else f"{hashlib.md5(b''.join(parts)).hexdigest()}-{len(parts)}"
    assert files.multipart_etags(listed, 1_000, 128).first().etag == expected
    assert files.checksums(spark, str(tmp_path)).first().sha256 == hashlib.sha256(content).hexdigest()
