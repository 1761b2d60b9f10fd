import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import cases
from worksledger.llm import langid


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    net = langid.Network.fresh(["a", "b", "c"], hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data, labels = r.integers(60, 130, (9, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    gradient = net.gradients(data, labels)[1]
    for name, w in net.weights.items():
        spot = np.unravel_index(np.abs(gradient[name]).argmax(), w.shape)
        kept, losses = w[spot], []
        for step in (1e-5, -1e-5):
            w[spot] = kept + step
            losses.append(net.gradients(data, labels)[0])
        w[spot] = kept
        assert abs((losses[0] - losses[1]) / 2e-5 - gradient[name][spot]) < 1e-5


def test_pooled_by_position_whatever_the_batch():
    net = langid.Network.fresh(["a", "b"])
    texts = [cases.prose(k, 5 + 40 * k) for k in range(6)]
    alone = np.concatenate([langid.predict(net, pa.array([t])) for t in texts])
    together = langid.predict(net, pa.array([*texts, None, ""]))
    assert np.abs(alone - together[:6]).max() < 1e-5
    assert np.abs(together[:6].sum(axis=1) - 1).max() < 1e-4 and not together[6:].any()


def test_every_part_of_a_text_counts():
    net = langid.Network.fresh(["a", "b"])
    text = cases.prose(1, 500)
    changed = text[:-40] + "ZZZZ" * 10
    a, b = langid.predict(net, pa.array([text, changed]))
    assert np.abs(a - b).max() > 0


def test_held_out_documents_are_recognised(spark, monkeypatch):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    net = langid.fit(documents.where(langid.fold() != 2), "text", "lang", F.xxhash64("doc_id"))
    rows = langid.identify(documents.select("doc_id", "text", "lang"), net).where(langid.fold() == 2).collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROUNDS", 3)
    df = cases.awkward(spark)
    net = langid.fit(df, "text", "lang", F.xxhash64("doc_id"))
    rows = langid.identify(df, net, score_to="p").collect()
    assert len(rows) == df.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und" and r["p"] == 0) if not letters else r["lang_pred"] in ("a", "b")
    nothing = langid.fit(cases.empty(spark), "text", "lang", F.xxhash64("doc_id"))
    assert nothing is None
    assert {r["lang_pred"] for r in langid.identify(df, nothing, score_to="p").collect()} == {"und"}
    assert langid.identify(cases.empty(spark), net, score_to="p").count() == 0


def test_the_sample_is_bounded_in_each_language(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(langid, "DOCUMENTS", 4)
    monkeypatch.setattr(langid, "train", lambda segments, labels, languages: seen.update(n=np.bincount(labels).tolist(), of=languages))
    rows = [(k, cases.prose(k, 20), "en") for k in range(300)] + [(1000 + k, cases.prose(k, 20), "ru") for k in range(3)] + [(2000, "x y z", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    langid.fit(df, "text", "lang", F.xxhash64("doc_id"))
    assert seen["of"] == ["en", "ru", "xx"] and seen["n"] == [4 * langid.SEGMENTS, 3 * langid.SEGMENTS, langid.SEGMENTS]
    once = dict(seen)  # the same however the rows lie
    langid.fit(df.repartition(1).orderBy(F.desc("doc_id")), "text", "lang", F.xxhash64("doc_id"))
    assert seen == once


def test_a_column_tells_what_the_operator_does(spark):
    net = langid.Network.fresh(["a", "b"])
    df = cases.awkward(spark)
    rows = langid.identify(df.select("text"), net).collect()
    for least in (0.0, 0.5):
        want = sorted(str((r["text"], r["lang_pred"] if r["lang_pred"] != langid.UNKNOWN and r["score"] >= least else None)) for r in rows)
        told = df.select("text", langid.recognised(F.col("text"), net, least).alias("p")).collect()
        assert sorted(map(str, map(tuple, told))) == want
    assert cases.empty(spark).where(langid.recognised(F.col("text"), net) == "a").count() == 0
