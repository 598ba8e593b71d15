"""Incremental drop ingest: each file is committed exactly once across runs."""

from tablecraft.streaming.drops import ingest_drops


def test_ingest_drops_incremental(spark, tmp_path):
    src = tmp_path / "drops"
    src.mkdir()
    (src / "a.json").write_text('{"metadata": {"title": "a"}}\n{}\n')
    out, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    first = ingest_drops(spark, str(src), out, checkpoint=ckpt)
    assert first.count() == 2
    (src / "b.json").write_text('{"metadata": {"title": "b"}}\n')
    second = ingest_drops(spark, str(src), out, checkpoint=ckpt)
    assert second.count() == 3
    again = ingest_drops(spark, str(src), out, checkpoint=ckpt)
    assert sorted(r["metadata"]["title"] for r in again.collect() if r["metadata"]) == ["a", "b"]
