"""Bounds that hold whatever the rows are: ranges of draw keys, rows that train the quality model."""

from pyspark.sql import functions as F

from ledgerlake.llm import factor_machine, source_mix


def test_ranges_of_any_weight_hold_few_rows(spark):
    """Sources of plain texts only, of junk only, and of both: no range holds much more than asked for."""
    n, asked = 60_000, 500
    source = F.element_at(F.array(*map(F.lit, ("plain", "junk", "both"))), (F.col("id") % 3 + 1).cast("int"))
    junk = (F.col("source") == "junk") | ((F.col("source") == "both") & (F.col("id") % 2 == 0))
    key = -F.log(source_mix.uniform(F.col("id").cast("string"), F.lit("x"))) / F.when(junk, F.lit(1.0 / 11)).otherwise(F.lit(1.0))
    rows = spark.range(n).withColumn("source", source).withColumn("key", key)
    ranges = rows.withColumn("range", source_mix.key_range(F.col("key"), F.lit(n // 3), asked)).groupBy("source", "range").agg(
        F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    ).orderBy("source", "range").collect()
    assert max(r["n"] for r in ranges) <= 1.3 * asked
    for a, b in zip(ranges, ranges[1:]):  # ranges rise with the key
        assert a["source"] != b["source"] or a["high"] < b["low"]
    assert len(ranges) < 20 * n / asked


def test_prefix_sums_over_many_ranges(spark):
    """Many small ranges of a junk source give what one range gives."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w&&& #$%"), F.repeat(F.lit("x "), (F.col("id") % 7).cast("int"))).alias("text"), F.lit("junk").alias("source"))
    one, many = (sorted(map(str, source_mix.mix_sources(docs, share=0.4, rows_per_range=k).collect())) for k in (10_000_000, 16))
    assert one == many


def test_repeated_ids_do_not_widen_the_training_sample(spark, monkeypatch):
    """One labelled id on 2,000 rows: the driver still gathers at most ``train_rows`` of them."""
    seen = []
    fit = factor_machine.FactorMachine.fit
    monkeypatch.setattr(factor_machine.FactorMachine, "fit", lambda self, rows, labels, **kw: (seen.append(sorted(labels)), fit(self, rows, labels, **kw))[1])
    texts = spark.range(2000).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("good words number "), "id").alias("text"))
    docs = texts.unionByName(spark.createDataFrame([(2, "&&& %%%")], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    first, again = (factor_machine.train(docs.repartition(p), labels, train_rows=8) for p in (3, 5))
    assert seen == [[0.0, 1.0, 1.0, 1.0, 1.0]] * 2
    assert first.score(b"good words number 77") == again.score(b"good words number 77") > 0.5
