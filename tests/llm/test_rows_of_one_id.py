import corpus_pipeline
from odd import documents, prose


def test_rows_of_one_id_are_judged_by_their_texts(spark, sf):
    """Of id 7 the copy of document 3 goes and the other text stays; of two near copies with id 8 one stays."""
    a, b, near = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(3, b), (7, a), (7, b + " more"), (8, near), (8, near + " more"), (9, near + " again"), (8, prose(24, 60)), (8, prose(24, 60)), (None, a), (10, a)]
    kept = corpus_pipeline.keep_one_of_each_group(spark, documents(spark, [(i, t, *[None] * 10) for i, t in rows]), sf).collect()
    found = sorted(((r.doc_id, r.text) for r in kept if r.doc_id != 8 or r.text == prose(24, 60)), key=str)
    assert found == sorted([(3, b), (7, a), (8, prose(24, 60)), (None, a)], key=str)
    assert len(kept) == 5 and [r for r in kept if r.doc_id == 8 and r.text in (near, near + " more")]
