import corpus_pipeline
from wordform.llm import stages
from wordform.llm.common import written

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double"


def test_stages_and_run(spark):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and {r["doc_id"] for r in rows} <= ids and len(rows) > 0.8 * len(ids)
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def _docs(spark):
    base = " ".join(f"the and of thing{i}" for i in range(60))
    near = base.replace("thing7 ", "other ")
    rows = [(1, base), (2, near), (2, near), (3, base), (None, base), (4, None), (5, ""), (6, "alone with few words"), (7, "alone with few words"), (8, "12 34 56"), (None, "mail to x.y@example.com please")]
    odd = f"{SCHEMA}, _own string, _key string, _mine int"  # names that the stages use themselves
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 0.5, "o", "k", 1) for i, t in rows], odd)


def test_near_duplicates_leave_one_row(spark):
    docs = _docs(spark)
    out = stages.deduplicated(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:5]) for r in out.collect()) == [(0, "mail "), (1, "the a"), (4, ""), (5, ""), (6, "alone"), (8, "12 34")]


def test_language_rejects_texts_without_any(spark):
    docs = _docs(spark)
    out = stages.identified(spark, docs, SF)
    assert out.columns == docs.columns and {(r["_own"], r["_key"], r["_mine"]) for r in out.collect()} == {("o", "k", 1)}
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 0, 1, 2, 2, 3, 6, 7]


def test_contaminated_documents_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = spark.createDataFrame([(1, f"so {item} there", "en", "s", 1, "k", 0.1), (None, item, "en", "s", 1, "k", 0.1), (2, "clean words", "en", "s", 1, "k", 0.1), (3, None, "en", "s", 1, "k", 0.1)], SCHEMA)
    assert sorted(r["doc_id"] for r in stages.decontaminated(spark, docs, SF).collect()) == [2, 3]


def test_personal_data_is_masked(spark):
    docs = _docs(spark)
    out = stages.redacted(spark, docs, SF)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = out.collect()
    assert len(rows) == docs.count()
    mail = [r for r in rows if r["text"] and r["text"].startswith("mail")][0]
    assert mail["text"] == "mail to <EMAIL> please" and mail["n_chars"] == len(mail["text"]) and mail["key"] == "k"
    assert [r["text"] for r in rows if r["doc_id"] == 4] == [None]


def test_empty_documents(spark):
    docs = _docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
