"""Growing files: no line is lost or repeated, however they grow and are cut."""

import random

import pytest

from chronomart.sources.growing import GrowingStream, Piece, files_below, lines_of, pieces, read_growing
from chronomart.streaming.ingest import ONCE


def stored(spark, path, out, **options):
    query = read_growing(spark, path, **options).writeStream.format("parquet").option("path", f"{out}/data")
    query.option("checkpointLocation", f"{out}/ckpt").trigger(**ONCE).start().awaitTermination()
    return sorted((r.path.rsplit("/", 1)[1], r.position, r.value) for r in spark.read.parquet(f"{out}/data").collect())


def expected(folder):
    out = []
    for file in folder.rglob("*.jsonl"):
        data, at = file.read_bytes(), 0
        for line in data[: data.rfind(b"\n") + 1].split(b"\n")[:-1]:
            out.append((file.name, at, line.decode()))
            at += len(line) + 1
    return sorted(out)


def test_appended_lines_arrive_once(spark, tmp_path):
    folder, out = tmp_path / "log", str(tmp_path / "out")
    (folder / "orders").mkdir(parents=True)
    day = folder / "orders" / "2026-01-01.jsonl"
    day.write_text('{"n": 1}\n{"n": 2}\n{"n": "half')
    assert stored(spark, str(folder), out) == expected(folder) and len(expected(folder)) == 2
    with day.open("a") as file:
        file.write(' line é"}\n\n' + "x" * 5000 + "\n" + '{"n": 4}')
    (folder / "_hidden.jsonl").write_text("no\n")
    (folder / "notes.txt").write_text("no\n")
    assert stored(spark, str(folder), out, pieceBytes="16") == [r for r in expected(folder) if r[0] != "_hidden.jsonl"]
    assert stored(spark, str(folder), out) == [r for r in expected(folder) if r[0] != "_hidden.jsonl"]
    with day.open("a") as file:
        file.write("\nlast\n")
    (folder / "new.jsonl").write_text("a\nb\n")
    want = [r for r in expected(folder) if r[0] != "_hidden.jsonl"]
    assert stored(spark, str(folder), out) == want and len(want) == 9
    rows = read_growing(spark, str(folder), stream=False).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.position, r.value) for r in rows) == want


def test_any_cut_gives_every_line_once(tmp_path):
    r = random.Random(1)
    file = tmp_path / "a.jsonl"
    for _ in range(60):
        lines = [b"x" * r.choice([0, 0, 1, 3, 40]) for _ in range(r.randint(0, 12))]
        file.write_bytes(b"".join(line + b"\n" for line in lines))
        size, found = file.stat().st_size, []
        for piece in pieces({}, {str(file): size}, r.randint(1, 30)):
            found += list(lines_of(str(tmp_path), piece))
        at = [sum(len(x) + 1 for x in lines[:k]) for k in range(len(lines))]
        assert found == list(zip(at, lines))


def test_lines_longer_than_a_block(tmp_path, monkeypatch):
    from chronomart.sources import growing

    monkeypatch.setattr(growing, "BLOCK", 7)
    file = tmp_path / "a.jsonl"
    file.write_bytes(b"y" * 50 + b"\nshort\n" + b"z" * 23)
    assert growing.last_line_end(str(tmp_path), str(file), 80) == 57
    assert [x[1] for x in lines_of(str(tmp_path), Piece(str(file), 0, 57, 0))] == [b"y" * 50, b"short"]


def test_missing_folder_and_shrunk_file(tmp_path):
    assert files_below(str(tmp_path / "none"), [".jsonl"]) == {}
    source = GrowingStream({"path": str(tmp_path)})
    assert source.latestOffset() == source.initialOffset() == {}
    with pytest.raises(ValueError, match="shrunk"):
        source.partitions({"a": 9}, {"a": 5})
