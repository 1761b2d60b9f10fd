"""What the workers of the packing query hold on to."""

from __future__ import annotations

from worksledger.llm import common, packing


def test_placing_empties_the_tables_of_the_encoders(spark, monkeypatch):
    cut = spark.createDataFrame([(1, 5, 0, 0), (2, 5, 0, 1)], "doc_id long, length long, part int, rank long")
    work = []
    kind = type(cut)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, run, *a, **k: work.append(run) or plain(df, run, *a, **k))
    placed = packing.place(cut, 10)
    held = {"vocabulary": "pieces"}
    monkeypatch.setattr(common, "TABLES", [held])
    assert list(work[0](iter([]))) == [] and not held
    assert {(r.sequence_id, r.offset) for r in placed.collect()} == {(0, 0), (0, 5)}
