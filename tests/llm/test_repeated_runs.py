"""All repeated runs of lines are removed, against brute force over the runs."""

import pytest
from pyspark.sql import functions as F
from samples import frame, sentence

from strataseek.llm import line_dedup


def runs_expected(rows):
    """Kept text of each row: every maximal run of two or more lines that stands earlier goes."""
    texts = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    kept, before = {}, []
    for i, t in texts:
        lines, gone = t.split("\n"), set()
        for start in range(len(lines)):
            for other in [*before, lines]:
                for k in range(len(other) if other is not lines else start):
                    n = 0
                    while start + n < len(lines) and k + n < len(other) and lines[start + n] == other[k + n]:
                        n += 1
                    if n >= line_dedup.LEAST_LINES:
                        gone |= set(range(start, start + n))
        kept[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)
        before.append(lines)
    return kept


def passages():
    """One passage of eight lines, cut and framed at every place."""
    passage = [sentence(300 + k, 12) for k in range(8)]
    rows, number = [(0, "\n".join(["head", *passage, "tail"]))], 1
    for a in range(8):
        for b in range(a + 1, 9):
            rows.append((number, "\n".join([f"own {number}", *passage[a:b], f"end {number}"])))
            number += 1
    return rows + [(900, "x\nx\nx\ny"), (901, "x\nx"), (902, "p\n\n\nq"), (903, ""), (904, "p\n\n\nq\n")]


@pytest.mark.parametrize("collide", [False, True])
def test_every_repeated_run_goes(spark, odd, collide, monkeypatch):
    if collide:  # other texts under one hash stay
        monkeypatch.setattr(line_dedup, "_window_key", lambda text: F.pmod(F.xxhash64(text), F.lit(5)))
    for rows, documents in (odd, (passages(), frame(spark, passages()).repartition(3))):
        found = line_dedup.dedup_runs(documents)
        assert found.columns == [*documents.columns, "lines_removed"]
        expected = runs_expected(rows)
        wanted = [(i, *expected.get((i, t), (t, 0))) for i, t in rows]
        order = lambda r: (-1 if r[0] is None else r[0], r[1] or "", r[2])
        got = [(r["doc_id"], r["text"], r["lines_removed"]) for r in found.collect()]
        assert sorted(got, key=order) == sorted(wanted, key=order)


def test_chunks_alone_leave_repeated_runs(spark):
    """What ``dedup_runs`` is for: ``dedup_lines`` leaves lines of the same rows."""
    documents = frame(spark, passages())
    lines = {f.__name__: sum(r["lines_removed"] for r in f(documents).collect())
             for f in (line_dedup.dedup_lines, line_dedup.dedup_runs)}
    assert lines["dedup_lines"] < lines["dedup_runs"] == sum(n for _, n in runs_expected(passages()).values())


def test_empty_table(nothing):
    assert line_dedup.runs_report(nothing).count() == 0


@pytest.mark.parametrize("name", ["dedup_lines", "dedup_runs"])
def test_names_of_columns_do_not_matter(spark, name):
    rows = [(1, "a a\nb b\nc c"), (2, "a a\nb b\nc c"), (3, "x")]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    taken = {c: F.lit(c) for c in ("__gone", "__doc", "__row", "__lines", "__ends", "__others", "lines_removed", "__key", "a.b")}
    dedup = getattr(line_dedup, name)
    found = dedup(plain.withColumns(taken))
    assert sorted(found.columns) == sorted(["doc_id", "text", *taken])
    assert sorted((r.doc_id, r.text, r.lines_removed) for r in found.collect()) == \
        sorted((r.doc_id, r.text, r.lines_removed) for r in dedup(plain).collect())
    assert all(r[c] == c for r in found.collect() for c in taken if c != "lines_removed")
