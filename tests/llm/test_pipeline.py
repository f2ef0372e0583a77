import re

import corpus_pipeline
from yarnscope.llm import oracles, queries

SF = "/root/testdata/sf0.001"


def test_stages_on_planted_rows(spark, tmp_path):
    plain = lambda k: " ".join(f"plain{(i * 7 + k * 13) % 90} the word{(i * k) % 40} of" for i in range(30)) + f" tail{k}"
    item = "these ten words are the benchmark passage that must not leak"
    near = plain(1).replace("word3 ", "other ", 1)
    rows = [(1, plain(1)), (2, near), (3, plain(1)), (4, plain(7) + " " + item), (5, plain(11) + " write to jo.do@mail.example.com now"), (6, "too short"), (7, None), (8, "dup " * 200), (9, plain(9)),
            (9, plain(9))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, "h") for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, id long, hash string")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{sf}/{k}")
        docs = spark.read.parquet(f"{sf}/{k}")
        kept[name] = sorted(r.doc_id for r in docs.collect())
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "id", "hash"]
    assert kept["quality_rules"] == [1, 2, 3, 4, 5, 9, 9]
    assert kept["near_duplicates"] == [1, 4, 5, 9]
    assert kept["benchmark_decontamination"] == kept["pii_surrogates"] == [1, 5, 9]
    assert set(kept["packing"]) == {1, 5, 9}
    text = next(r.text for r in spark.read.parquet(f"{sf}/3").collect() if r.doc_id == 5)
    assert "jo.do" not in text and re.search(r"write to [a-z]{2}\.[a-z]{2}@[a-z]{4}\.[a-z]{7}\.com now", text)


def test_one_row_of_each_group_with_null_and_shared_ids(spark):
    plain = lambda k: " ".join(f"plain{(i * 7 + k * 13) % 90} the word{(i * k) % 40} of" for i in range(30)) + f" tail{k}"
    near = lambda k, end: plain(k) + f" {end}"
    rows = [(None, plain(1)), (None, near(1, "x")), (None, near(1, "y")), (None, plain(1)),  # no id at all
            (3, plain(2)), (None, near(2, "x")), (None, near(2, "y")),  # near a document with an id
            (5, plain(3)), (5, near(3, "x")), (5, plain(4)), (2, near(4, "x")),  # a shared id: in one group, and in the group of 2
            (7, plain(5)), (7, plain(5)), (8, "")]
    docs = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, source string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert all(x in rows for x in got) and len(got) == 6
    group = sorted((t.split()[119 + 1] if t else "", d) for d, t in got)
    assert group == [("", 8), ("tail1", None), ("tail2", 3), ("tail3", 5), ("tail4", 2), ("tail5", 7)]


def test_empty_documents(spark, tmp_path):
    sf = str(tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_queries_match_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in oracles.SQL.items():
        got = queries.queries()[name](spark, SF)
        rel = con.sql(sql)
        order = [got.columns.index(c) for c in rel.columns]
        assert sorted(tuple(r[i] for i in order) for r in got.collect()) == sorted(rel.fetchall()), name


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [int(re.match(r"op(\d+)_", n).group(1)) for n in names] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "pii_surrogates", "packing"]
