"""Near duplicates among null and repeated ids."""

from ledgerlake.llm import circulant_minhash

from . import edge
from .test_table_operators import component_rows


def frame(spark, docs):
    return edge.documents(spark, [(i, t, f"l{k}", None, None, *edge.EXTRA) for k, (i, t) in enumerate(docs)])


def groups():
    """Null-id groups, a group with a small id, and texts that share an id with another group's copy."""
    a, b, c, d, e = (edge.text(70 + k, 120) for k in range(5))
    return [
        (None, a), (None, edge.edited(a, 1, 2)), (None, edge.edited(a, 2, 3)),
        (None, b), (5, edge.edited(b, 3, 2)),
        (None, c), (None, edge.edited(c, 4, 2)),
        (8, d), (8, e), (3, edge.edited(d, 5, 2)), (9, edge.edited(e, 6, 2)),
    ]


def test_null_and_repeated_ids_do_not_join_components(spark):
    docs = groups()
    got = circulant_minhash.near_duplicates(frame(spark, docs)).collect()
    assert sorted(str(tuple(r)) for r in got) == component_rows(docs)


def test_stage_keeps_one_document_of_each_component(spark):
    a, b, c, d = (edge.text(80 + k, 120) for k in range(4))
    docs = [
        (None, a), (1, a),  # the null-id copy goes
        (None, b),  # unique: stays
        (2, c), (2, a),  # one id, two texts: only the copy of a goes
        (None, d), (None, d), (None, edge.edited(d, 1, 2)),  # null ids only: one of them stays
        (4, edge.edited(c, 2, 2)), (5, edge.text(90, 60)), (5, edge.text(91, 60)),
        (None, None), (None, ""), (None, " \n"),  # without words: all stay
    ]
    df = frame(spark, docs)
    got = circulant_minhash.drop_near_duplicates(spark, df, None)
    assert got.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    nulls = [t for i, t in kept if i is None]
    assert sorted(t for i, t in kept if i == 2) == [c] and [t for i, t in kept if i == 1] == [a]
    assert b in nulls and a not in nulls and sum(t in (d, docs[7][1]) for t in nulls) == 1
    assert sum(t is None or not t.strip() for t in nulls) == 3 and len(nulls) == 5
    assert sorted(i for i, _ in kept if i is not None) == [1, 2, 5, 5]
