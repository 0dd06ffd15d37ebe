"""Links of rows that share a doc_id with different texts."""

from samples import frame, sentence

from strataseek.llm.jaccard_join import near_duplicates


def test_no_text_of_a_doc_id_loses_its_links(spark):
    a, b = sentence(41, 30), sentence(42, 30)
    rows = [(5, a), (5, b), (2, a), (3, b), (9, sentence(43, 30)), (7, a), (7, a)]
    found = sorted((r.doc_id, r.component_id) for r in near_duplicates(frame(spark, rows).repartition(3)).collect())
    assert found == [(2, 2), (3, 2), (5, 2), (5, 2), (7, 2), (7, 2), (9, 9)]
