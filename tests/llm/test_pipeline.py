import corpus_pipeline as pipeline
from parity.compare import connect, spark_rows, sql_rows, types
from tests.conftest import SMALL
from tests.llm import cases
from tests.llm.test_jaccard import grams
from tests.llm.test_suffixes import brute_words, planted
from worksledger.llm import queries, secrets
from worksledger.llm.common import landed


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["language", "near_duplicates", "repeated_passages", "secrets", "packing"]
    kept = {"input": docs.collect()}
    for name, stage in pipeline.STAGES:
        docs = landed(stage(spark, docs, SMALL), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name])
    assert all(any(map(str.isalpha, r["text"])) for r in kept["language"]) and len(kept["language"]) >= 0.95 * len(kept["input"])
    rows = kept["near_duplicates"]
    sets = [grams(r["text"], pipeline.SHINGLE_WORDS) for r in rows]
    for a in range(len(rows)):
        for b in range(a):
            assert 100 * len(sets[a] & sets[b]) < pipeline.SIMILAR_PERCENT * len(sets[a] | sets[b])
    left = {r["doc_id"] for r in rows}
    gone = [grams(r["text"], pipeline.SHINGLE_WORDS) for r in kept["language"] if r["doc_id"] not in left]
    every = [(r["doc_id"], grams(r["text"], pipeline.SHINGLE_WORDS)) for r in kept["language"]]
    for s in gone:  # each was linked to another
        assert sum(100 * len(s & t) >= pipeline.SIMILAR_PERCENT * len(s | t) for _, t in every) > 1
    assert len({r["doc_id"] for r in kept["repeated_passages"]}) == len(kept["repeated_passages"]) >= 0.9 * len(rows)
    assert not [r for r in kept["secrets"] if secrets.base_spans(r["text"])]
    assert {r["doc_id"] for r in kept["packing"]} == {r["doc_id"] for r in kept["secrets"]}


def test_stages_take_awkward_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(pipeline.langid, "ROUNDS", 3)
    monkeypatch.setattr(pipeline, "LEAST_SCORE", 0.0)
    for docs in (cases.awkward(spark), cases.empty(spark)):
        docs = docs.drop("piece")
        first, columns = docs, docs.columns
        for name, stage in pipeline.STAGES:
            docs = landed(stage(spark, docs, ""), name)
            if name != "packing":
                assert docs.columns == columns
            if first.count():
                assert docs.count()


def test_every_operator_is_a_query():
    names = queries.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)


def test_queries_match_their_sql(spark):
    con = connect(SMALL)
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SMALL)
        assert dict(df.dtypes) == types(con, sql), name
        assert spark_rows(df) == sql_rows(con, sql), name


def test_repeated_passages_by_brute_force(spark):
    texts = planted()
    docs = cases.frame(spark, texts)
    got = cases.by_id(pipeline.repeated_passages(spark, docs, ""), "text", "n_chars")
    want = brute_words(texts, 51)
    assert got == {k: (t, len(t)) for k, t in enumerate(want) if t.strip()}
