"""Readers, writers and the incremental run."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.sources import files
from millrace.streaming.resume import run_available

ROW = {"id": "a", "question": "q?", "context": [{"source": "s", "heading": "h", "content": "c"}], "answer": "x", "category": "api", "answerable": "full"}


def test_jsonl_round_trip_and_bad_lines(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join([json.dumps(ROW), "", json.dumps({**ROW, "id": "b", "category": "unknown"}), "{broken"]))
    loose = files.read_examples(spark, str(path), strict=False).collect()
    assert [(r.id, r.ord) for r in loose] == [("a", 1)]
    with pytest.raises(Exception, match="bad JSON at .*in.jsonl:4"):
        files.read_jsonl(spark, str(path)).collect()
    path.write_text(json.dumps(ROW) + "\n")
    out = str(tmp_path / "out")
    files.write_jsonl(files.read_examples(spark, str(path)).drop("file", "ord"), out)
    again = files.read_examples(spark, out).first()
    assert again.id == "a" and again.context[0].source == "s" and again.tags is None
    assert "tags" not in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))


def test_documentation_tree(spark, tmp_path):
    for name, data in {"p1/a b.md": b"# A", "p1/.git/x.md": b"no", "p1/build/y.md": b"no", "p2/deep/z.TXT": "è".encode(), "root.mdx": b"r", "p1/bad.md": b"\xff\xfe\xff", "p1/code.py": b"x"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {(r.project, r.relative_path): r.text for r in files.read_docs(spark, str(tmp_path)).collect()}
    assert got == {("p1", "p1/a b.md"): "# A", ("p2", "p2/deep/z.TXT"): "è", (tmp_path.name, "root.mdx"): "r", ("p1", "p1/bad.md"): None}


def test_ids_decisions_and_numbering(spark, tmp_path):
    assert files.read_ids(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "ids.txt").write_text("b\n\n a \nb\n")
    assert {r.id for r in files.read_ids(spark, str(tmp_path / "ids.txt")).collect()} == {"a", "b"}
    (tmp_path / "d.json").write_text('{"a": {"approved": true, "reason": "ok"}, "b": {"approved": false}}')
    assert {r.id: r.approved for r in files.read_decisions(spark, str(tmp_path / "d.json")).collect()} == {"a": True, "b": False}
    rows = spark.range(100).select((F.col("id") * 37 % 100).alias("k"))
    assert [r["ord"] for r in files.numbered(rows, "k").orderBy("k").collect()] == list(range(1, 101))


def test_incremental_run_resumes(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    spark.range(3).repartition(1).write.parquet(folder)
    sink = lambda batch, number: seen.extend(r.id for r in batch.collect())
    schema = spark.read.parquet(folder).schema
    assert run_available(spark, folder, schema, str(tmp_path / "cp"), sink) == 1
    assert run_available(spark, folder, schema, str(tmp_path / "cp"), sink) == 0
    spark.range(3, 5).repartition(1).write.mode("append").parquet(folder)
    run_available(spark, folder, schema, str(tmp_path / "cp"), sink)
    assert sorted(seen) == [0, 1, 2, 3, 4]
