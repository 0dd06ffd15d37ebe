"""Operators 1, 4, 7, 8, 9 and 10 against brute force, with odd rows."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from strataseek.llm import (components, decontamination, jaccard_join, line_dedup, lm_scoring, repeated_spans,
                            toxicity)
from strataseek.llm.common import word_hashes
from strataseek.llm.repeated_spans import LENGTH
from samples import frame, sentence, shingles, words


def lm_expected(texts, order):
    grams = [[Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) for n in range(1, order + 1)] for w in texts]
    total = [sum((g[n] for g in grams), Counter()) for n in range(order)]
    n_words = sum(map(len, texts))
    for w, own in zip(texts, grams):
        def count(gram, own=own):
            return total[len(gram) - 1][gram] - own[len(gram) - 1][gram]

        def score(context, word, w=w):
            gram = (*context, word)
            if context:
                return math.log(count(gram) / count(context)) if count(gram) else \
                    math.log(lm_scoring.BACKOFF) + score(context[1:], word)
            return math.log((count(gram) or lm_scoring.BACKOFF) / max(1, n_words - len(w)))

        yield sum(score(tuple(w[max(0, i - order + 1):i]), x) for i, x in enumerate(w))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(odd, order):
    rows, documents = odd
    found = lm_scoring.score_documents(documents, order).collect()
    expected = lm_expected([words(t) for _, t in rows], order)
    key = lambda x: (-1 if x[0] is None else x[0], x[1], round(x[2], 5))
    wanted = sorted(key((i, len(words(t)), s)) for (i, t), s in zip(rows, expected))
    got = sorted(key((r["doc_id"], r["n_words"], r["log_score"])) for r in found)
    for a, b in zip(wanted, got):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-4)


def test_packed_hashes():
    keys = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    for some in (keys, keys[:1], np.arange(5, dtype=np.uint64), np.array([3, 2 ** 64 - 1], np.uint64)):
        assert (lm_scoring.unpack(lm_scoring.pack(some)) == some).all()


def components_expected(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies():
    """Chains and clusters around the threshold, with a frequent passage in all of them."""
    hot = sentence(99, 12)
    rows = []
    for family in range(6):
        base = sentence(100 + family, 60).split()
        for k in range(12):
            copy = list(base)
            for j in range(k % 5):
                copy[(7 * k + 11 * j) % 60] = f"w{family}-{k}-{j}"
            rows.append((1000 + 13 * family + 100 * k, " ".join(copy) + (" " + hot if k % 2 else "")))
    return rows + [(5000 + k, hot) for k in range(5)] + [(6000 + k, hot + f" extra{k}") for k in range(5)]


@pytest.mark.parametrize("many", [False, True])
def test_jaccard_components(spark, odd, many, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_DOCS", 3)
    monkeypatch.setattr(jaccard_join, "PORTION", 4)
    monkeypatch.setattr(jaccard_join, "LARGE_COMPONENT", 4)
    rows = near_copies() if many else odd[0]
    documents = frame(spark, rows).repartition(3) if many else odd[1]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(documents).collect()}
    assert found == components_expected(rows)


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(60)] + [(200, 100), (100, 150), (None, 3), (7, 7)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    labels = {r["v"]: r["label"] for r in found.collect()}
    assert all(labels[k] == 0 for k in range(61)) and {labels[k] for k in (100, 150, 200)} == {100}


def spans_expected(rows):
    texts = sorted(((i, (t or "").encode()) for i, t in rows if i is not None), key=lambda r: r[0])
    first = {}
    for i, raw in texts:
        for k in range(len(raw) - LENGTH + 1):
            first.setdefault(raw[k:k + LENGTH], i)
    for i, raw in texts:
        gone = bytearray(len(raw) + 1)
        for k in range(len(raw) - LENGTH + 1):
            if first[raw[k:k + LENGTH]] < i:
                gone[k:k + LENGTH] = b"\1" * LENGTH
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        yield (i, len(raw), sum(gone), sum(gone[k] and not gone[k - 1] for k in range(len(raw))),
               hashlib.sha256(kept).hexdigest())


def repeats():
    a, b = sentence(7, 30), sentence(8, 9)
    return [(1, a), (2, b + a[20:90] + b + a[20:90]), (3, a[30:80]), (4, "zz" + a[30:80] + "zz"), (5, a[30:79]),
            (6, a[:60] + a[61:]), (7, b + "!" + b), (8, "q" * 500), (9, "q" * 49), (10, "p" + "q" * 120 + "r"),
            (11, b), (12, (b + "?") * 5), (13, ("é" * 40 + b) * 3), (14, "é" * 40 + b)]


@pytest.mark.parametrize("hot", [2000, 0])
@pytest.mark.parametrize("many", [False, True])
def test_repeated_spans(spark, odd, many, hot, monkeypatch):
    monkeypatch.setattr(repeated_spans, "HOT_BATCHES", hot)
    rows = repeats() if many else odd[0]
    documents = frame(spark, rows).repartition(3) if many else odd[1]
    found = sorted(tuple(r) for r in repeated_spans.span_report(documents).collect())
    assert found == sorted(spans_expected(rows))


def test_anchors_do_not_depend_on_segments(monkeypatch):
    texts = [sentence(5, 200).encode(), b"", b"x" * 300, sentence(6, 3).encode(), sentence(5, 200).encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def windows():
        rows, starts, sizes, hashes = repeated_spans.anchors(data, offsets)
        return sorted((int(r), int(s) + k, int(h)) for r, s, n, h in zip(rows, starts, sizes, hashes) for k in range(n))

    whole = windows()
    assert [(r, s) for r, s, _ in whole] == [(r, offsets[r] + k) for r, t in enumerate(texts)
                                             for k in range(len(t) - LENGTH + 1)]
    for segment in (64, 100, 1000):
        monkeypatch.setattr(repeated_spans, "SEGMENT", segment)
        assert windows() == whole


def test_rolling_hashes_agree_on_equal_strings():
    data = np.frombuffer(sentence(5, 200).encode() * 2, np.uint8)
    for length in (1, 20, 50):
        hashes = repeated_spans.rolling_hashes(data, length)
        strings = [bytes(data[i:i + length]) for i in range(len(data) - length + 1)]
        assert len(hashes) == len(strings) and len(set(zip(strings, hashes.tolist()))) == len(set(strings)) == len(set(hashes.tolist()))


def test_line_dedup(odd):
    rows, documents = odd
    found = line_dedup.dedup_lines(documents)
    assert found.columns == [*documents.columns, "lines_removed"]
    got = [(r["doc_id"], r["text"], r["lines_removed"]) for r in found.collect()]
    assert len(got) == len(rows)
    by_id = {i: t for i, t, _ in got}
    for i, text, removed in got:
        before = dict(rows)[i]
        if before is None or i is None:
            assert text == before and removed == 0
        else:
            assert text.count("\n") + 1 == before.count("\n") + 1 - removed or text == ""
    lines = dict(rows)[10].split("\n")
    assert by_id[10] == "\n".join(lines)
    inside = [line for line in by_id[11].split("\n") if line in lines]
    assert "new first line" in by_id[11] and "last line" in by_id[11] and len(inside) < len(lines)


def test_decontamination(spark, odd):
    items = spark.createDataFrame([
        (1, sentence(50, 30) + "\n" + sentence(51, 6)), (2, sentence(52, 20)), (3, "tiny item"), (4, None), (5, ""),
        (None, sentence(53, 20)), (2, sentence(52, 20)), (6, sentence(54, 40))], "item_id long, text string")
    one = sentence(50, 30) + "\n" + sentence(51, 6)
    edited = one.split()
    edited[15] = "changed"
    rows = [(1, one), (2, sentence(60, 500) + " " + one.upper() + " " + sentence(61, 300)), (3, " ".join(edited)),
            (4, sentence(52, 10)), (5, "a TINY item here"), (6, sentence(62, 900)), (7, None), (8, ""),
            (9, sentence(54, 40) + " x " + sentence(52, 20)), (None, one), (9, sentence(54, 40) + " x " + sentence(52, 20))]
    documents = frame(spark, rows).repartition(2)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(documents, items).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (5, 3), (9, 2), (9, 6)}
    kept = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in decontamination.decontaminate(documents, items).collect())
    assert kept == [-1, 4, 6, 7, 8]


def test_retrieval_loses_no_item_that_the_check_accepts():
    """Every item that covers enough shingles of a passage is at or above its BM25 threshold."""
    texts = [sentence(k, 15 + k) for k in range(40)]
    index = decontamination.ItemIndex(list(range(40)), texts, 70)
    for k in range(40):
        found = texts[k].split()
        cut = found[:len(found) - len(found) // 6]
        passage = (sentence(500 + k, 50) + " " + " ".join(cut)).encode()
        hashes, _ = word_hashes(np.frombuffer(passage, np.uint8), np.array([0, len(passage)]))
        _, items, _ = decontamination.candidates(index, hashes, np.array([0]), np.array([len(hashes)]))
        covered = len(shingles(passage.decode()) & shingles(texts[k])) / len(shingles(texts[k]))
        assert covered < decontamination.COVERAGE or k in index.item_ids[items]



def test_toxicity(spark, nothing):
    bad = ["scum", "idiot", "trash"]
    rows, marks = [], []
    for k in range(400):
        text = sentence(1000 + k, 40)
        toxic = k % 4 == 0
        if toxic:
            text += f" {bad[k % 3]} " + sentence(3000 + k, 5) + f" {bad[(k + 1) % 3]}"
        rows.append((k, text))
        marks.append((k, None if k % 50 == 7 else int(toxic)))
    rows += [(900, None), (901, ""), (902, sentence(1, 30000)), (903, "you scum and idiot and trash " + sentence(5, 30))]
    documents = frame(spark, rows).repartition(3)
    labels = spark.createDataFrame(marks + [(3, 0), (None, 1), (5000, 1)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.toxicity_report(documents, labels).collect()}
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found.values())
    held = [k for k in range(400) if found[k]["held_out"]]
    assert 80 < len(held) < 190
    assert sum(found[k]["predicted"] == int(k % 4 == 0) for k in held) / len(held) > 0.95
    assert found[903]["predicted"] == 1 and not any(found[k]["predicted"] for k in (900, 901, 902))
    unlabelled = toxicity.toxicity_report(documents, labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in unlabelled} == {0.5}
    assert toxicity.toxicity_report(nothing, labels).count() == 0


def test_empty_tables(spark, nothing):
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    assert lm_scoring.score_report(nothing).count() == 0
    assert decontamination.contaminated(nothing, items).count() == 0
    assert jaccard_join.near_duplicates(nothing).count() == 0
    assert repeated_spans.span_report(nothing).count() == 0
    assert line_dedup.line_report(nothing).count() == 0
    documents = frame(spark, [(1, "a b")])
    assert decontamination.contaminated(documents, items.limit(0)).count() == 0
