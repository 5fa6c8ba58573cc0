"""Searches that give every match or every query's best, against what is known of the input."""


def test_keyword_and_has_no_last_row(spark, tmp_path):
    from docloom.plans import queries

    n = 1_000_100
    spark.range(n).selectExpr("id AS doc_id", "'mit' AS source", "'license' AS text").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.keyword_and(spark, str(tmp_path)).count() == n


def test_every_vector_query_has_its_best(spark, tmp_path, monkeypatch):
    from docloom.operators import search
    from docloom.plans import queries

    rows = [(i, [float((i * k * 7919) % 11 - 5) / 4 for k in range(1, 9)]) for i in range(130)]  # many ties
    spark.createDataFrame([*rows, (140, None)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    products = {q: sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in rows)[:10] for q, x in rows if q % 20 == 0}
    want = sorted((q, i, round(-s, 5)) for q, own in products.items() for s, i in own)
    for size in (search.BLOCK_VECTORS, 3):
        monkeypatch.setattr(search, "BLOCK_VECTORS", size)
        assert sorted(tuple(r) for r in queries.vector_topk_each(spark, str(tmp_path)).collect()) == want and len(want) == 70


def test_vector_topk_without_its_query(spark, tmp_path):
    from docloom.plans import queries

    spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert queries.vector_topk(spark, str(tmp_path)).collect() == []
