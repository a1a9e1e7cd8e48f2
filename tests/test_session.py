from chargelake.plans import queries

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_queries_keep_generated_methods_short(spark, monkeypatch):
    """The stage that builds documents is one method of 9,172 bytes, which the JVM leaves uncompiled."""
    monkeypatch.setattr(queries, "QUERIES", {})
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, 65535)
    try:
        queries.query(lambda session, _: session.range(1))(spark, "")
        assert spark.conf.get(LIMIT) == "8000"
    finally:
        spark.conf.set(LIMIT, before)
