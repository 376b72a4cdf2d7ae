"""The likelihood ratio as the corpus grows: labelled junk goes, labelled clean text stays."""

import pyarrow.parquet as pq

from ledgerlake.llm import ngram_rules


def test_labelled_junk_goes_at_ten_thousand_documents(spark):
    got = {r["doc_id"]: r for r in ngram_rules.op9(spark, "/root/testdata/sf0.1").collect()}
    labels = [r for r in pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist() if not got[r["doc_id"]]["base_failed"]]
    junk = [got[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    clean = [got[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1 and not r["toxic"]]
    assert len(junk) > 250 and sum(junk) <= 0.02 * len(junk) and sum(clean) >= 0.99 * len(clean)
