"""Line dedup over content-defined chunks of lines, with DataFrame functions only (operator 10).

A text is split at line feeds and each line is hashed. A chunk ends after a line when a rolling
hash over the last two line hashes is a multiple of ``DIVISOR``, so a boundary depends on nothing
but the lines beside it and inserted lines do not shift the boundaries further on. Chunks of at
least ``LEAST_LINES`` lines that occur more than once anywhere are found by their hash, compared
byte for byte with the first occurrence (smallest doc_id, then position), and all but the first are
removed. A chunk that holds other bytes under the same hash stays.

Only hashes and places are grouped, with partial sums, so a chunk that stands in a third of all
documents is one row per task. Texts travel only for chunks that repeat; hot ones are joined with
their first occurrence by a salted join. The list of removed chunks is broadcast when its measured
size allows, and else joined by document.

Null texts, and rows without doc_id, pass unchanged; an empty text is one empty line and stays. Rows
with one doc_id are told apart by their text; equal rows count as one document, so both keep what
one keeps. All columns of the input, whatever their names, come back with ``text`` replaced, and
``lines_removed`` is added, or replaced if there is one. A text of which nothing is left is empty, and its row stays.

Those chunks alone find only part of the repeated passages: a boundary depends on lines outside a passage,
and a passage may start or end within a chunk. ``dedup_runs`` extends them to whole runs. The chunks carry
the bulk: a chunk that repeats, byte for byte, goes whole wherever it stands later. What they leave is searched
by windows of ``LEAST_LINES`` lines: those that cross a boundary, and those inside each distinct chunk at its
first place. A window inside a later copy of a chunk stands in the first copy too, so no window is missed, and
a line goes exactly if some window over it stands earlier (doc_id, then place): a run that
stands earlier goes whole wherever it starts and ends, and no line beside it goes. Both kinds are grouped by hash
and their bytes compared by counting the distinct texts of each repeated hash, so a text travels once per task. A
chunk hash with several texts is left to the windows, a window hash with several is grouped again by text. Each
removed line has an equal line that is kept: the first window of its kind starts earlier, and so on
down to a line that no later copy covers. Blank lines count as lines. Equal rows, nulls and columns are
treated as above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataseek.operators.skew import balanced_join
from strataseek.session import cut_lineage, fits_broadcast

DIVISOR = 3
LEAST_LINES = 2
REMOVED = "lines_removed"
# Fixed values of the rolling hash.
HASH_DIGITS, FOLD, WEIGHT = 12, 1000003, 31


def _hold(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once: expressions are not copied across a generator."""
    return df.withColumn(name, F.explode(F.array(F.struct(value.alias("v"))))).withColumn(name, F.col(name)["v"])


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def _with_chunks(df: DataFrame) -> DataFrame:
    """Add __lines, the lines, and __ends, the place of the last line of each chunk."""
    df = _hold(df, "__lines", F.split(F.col("text"), "\n", -1))
    df = _hold(df, "__hashes", F.transform("__lines", _line_hash))
    last = F.size("__hashes") - 1

    def end(value: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col("__hashes"), i - 1) % FOLD).otherwise(F.lit(0))
        return F.when((i == last) | ((before * WEIGHT + value) % DIVISOR == 0), i)

    return _hold(df, "__ends", F.filter(F.transform("__hashes", end), lambda x: x.isNotNull())).drop("__hashes")


def _start(k: Column) -> Column:
    return F.when(k > 0, F.get(F.col("__ends"), k - 1) + 1).otherwise(F.lit(0))


def _chunk_text(k: Column) -> Column:
    first = _start(k)
    return F.array_join(F.slice("__lines", first + 1, F.get(F.col("__ends"), k) - first + 1), "\n")


def _usable(documents: DataFrame) -> DataFrame:
    return documents.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__row"), "text")


def _packed(documents: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one struct, so that none meets a name used here."""
    others = [F.col(f"`{c}`") for c in documents.columns if c not in ("doc_id", "text")]
    return documents.select("doc_id", "text", F.struct(*others, F.lit(0).alias("__none")).alias("__others"))


def _unpacked(rows: DataFrame, columns: list[str], text: Column, removed: Column) -> DataFrame:
    """The columns as they were, with the new text; ``lines_removed`` takes the place of a column of that name."""
    back = {"text": F.col("__new").alias("text"), "doc_id": F.col("doc_id")}
    done = rows.select("doc_id", "__others", text.alias("__new"), removed.cast("long").alias("__removed"))
    return done.select(*[back[c] if c in back else F.col("__others").getField(c).alias(c) for c in columns if c != REMOVED],
                       F.col("__removed").alias(REMOVED))


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """__doc, __row, __gone (places of the removed chunks) of every document that loses some."""
    chunks = (_with_chunks(_usable(documents))
              .select("__doc", "__row", F.posexplode(F.transform("__ends", lambda end, k: F.struct(
                  (end - _start(k) + 1).alias("n"), _chunk_text(k).alias("t")))).alias("__k", "__c"))
              .filter(F.col("__c.n") >= LEAST_LINES)
              .select("__doc", "__row", "__k", F.col("__c.t").alias("__t")))
    chunks = _hold(chunks, "__key", F.unhex(F.md5(F.col("__t").cast("binary"))))
    places = chunks.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"),
                                         F.min(F.struct("__doc", "__k", "__row")).alias("__first"))
    repeated = cut_lineage(places.filter("__n > 1").select("__key", "__first"), "repeated-chunks")
    hits = cut_lineage(balanced_join(chunks, repeated, ["__key"], ["__doc", "__row", "__k"], F.lit(64)),
                       "chunk-occurrences")
    is_first = F.struct("__doc", "__k") == F.struct("__first.__doc", "__first.__k")
    firsts = (hits.filter(is_first & (F.col("__row") == F.col("__first.__row")))
              .select("__key", F.col("__t").alias("__bytes")).dropDuplicates(["__key"]))
    later = hits.filter(~is_first).select("__key", "__doc", "__row", "__k", "__t")
    same = balanced_join(later, firsts, ["__key"], ["__doc", "__row", "__k"], F.octet_length("__bytes") + 32) \
        .filter(F.col("__t") == F.col("__bytes"))
    return cut_lineage(same.groupBy("__doc", "__row").agg(F.collect_set("__k").alias("__gone")), "removed-chunks")


def dedup_lines(documents: DataFrame) -> DataFrame:
    """The documents without the later copies of repeated chunks."""
    gone = repeated_chunks(documents)
    if fits_broadcast(gone, F.size("__gone") * 4 + 64):
        gone = F.broadcast(gone)
    rows = _packed(documents).join(gone, (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__row")), "left")
    rows = _with_chunks(rows.withColumn("text", F.col("text")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__ends") - 1), F.col("__gone"))
    removed = F.aggregate(F.col("__gone"), F.lit(0), lambda total, k: total + F.get(F.col("__ends"), k) - _start(k) + 1)
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, _chunk_text), "\n"))
    return _unpacked(rows, documents.columns, text, F.coalesce(removed, F.lit(0)))


def line_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_md5 of every document."""
    lines = documents.withColumn("__n", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    return dedup_lines(lines.select("doc_id", "text", "__n")).select(
        "doc_id", F.greatest(F.col("__n"), F.lit(0)).alias("n_lines"), F.col("lines_removed").alias("n_removed"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def _window_key(text: Column) -> Column:
    return F.xxhash64(text)


def _window(k: Column) -> Column:
    return F.array_join(F.slice("__lines", k + 1, LEAST_LINES), "\n")


def _at_places(rows: DataFrame, places: DataFrame, place_bytes: Column, how: str) -> DataFrame:
    """Join ``rows`` (doc_id, text) with ``places`` (__doc, __row, more), which are broadcast when they fit."""
    if fits_broadcast(places, place_bytes):
        places = F.broadcast(places)
    return rows.join(places, (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__row")), how)


def _pieces(documents: DataFrame) -> DataFrame:
    """One row per chunk: __k (its first line), __n (lines), __key (hash, null for a single line) and
    __windows, the hashes of the windows that start in it, the one across its end last."""
    rows = _with_chunks(_usable(documents))
    starts = F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), lambda k: k <= F.size("__lines") - LEAST_LINES)
    rows = _hold(rows, "__all", F.transform(starts, lambda k: _window_key(_window(k))))
    pieces = F.transform("__ends", lambda end, k: F.struct(
        _start(k).alias("k"), (end - _start(k) + 1).alias("n"),
        F.when(end > _start(k), _window_key(_chunk_text(k))).alias("key"),
        F.slice("__all", _start(k) + 1, end - _start(k) + 1).alias("w")))
    return rows.select("__doc", "__row", F.explode(pieces).alias("__c")).select(
        "__doc", "__row", F.col("__c.k").alias("__k"), F.col("__c.n").alias("__n"), F.col("__c.key").alias("__key"),
        F.col("__c.w").alias("__windows"))


def _occurrences(places: DataFrame, more: list[str], name: str) -> DataFrame:
    """__doc, __row, __hits (__k, __key, ``more``, later) of the keys that stand at several places."""
    place = F.struct("__doc", "__k", "__row")
    counted = places.groupBy("__key").agg(F.count(F.lit(1)).alias("__count"), F.min(place).alias("__first"))
    repeated = cut_lineage(counted.filter("__count > 1").select("__key", "__first"), f"repeated-{name}")
    hits = balanced_join(places, repeated, ["__key"], ["__doc", "__row", "__k"], F.lit(64))
    return cut_lineage(hits.groupBy("__doc", "__row").agg(F.collect_set(
        F.struct("__k", "__key", *more, (place != F.col("__first")).alias("later"))).alias("__hits")), f"{name}-occurrences")


def _texts_of(documents: DataFrame, hits: DataFrame, n: Column) -> DataFrame:
    """__doc, __row, __k, __key, __t: the ``n`` lines at the place of each hit."""
    usable = documents.filter("doc_id is not null and text is not null").select("doc_id", "text")
    rows = _hold(_at_places(usable, hits, F.size("__hits") * 28 + 64, "inner"), "__lines", F.split(F.col("text"), "\n", -1))
    return rows.select("__doc", "__row", "__lines", F.explode("__hits").alias("__h")).select(
        "__doc", "__row", F.col("__h.__k"), F.col("__h.__key"),
        F.array_join(F.slice("__lines", F.col("__h.__k") + 1, n), "\n").alias("__t"))


def _mixed(texts: DataFrame, name: str) -> DataFrame:
    """The hashes that stand for several texts."""
    return cut_lineage(texts.groupBy("__key", "__t").agg(F.lit(1).alias("__one")).groupBy("__key")
                       .agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__key"), f"mixed-{name}")


def repeated_runs(documents: DataFrame) -> DataFrame:
    """__doc, __row, __gone (places of the removed lines, ascending) of every document that loses some."""
    pieces = cut_lineage(_pieces(documents), "line-chunks")
    chunks = _occurrences(pieces.filter("__key is not null").select("__doc", "__row", "__k", "__n", "__key"), ["__n"], "chunks")
    mixed = _mixed(_texts_of(documents, chunks, F.col("__h.__n")), "chunks")
    copies = chunks.select("__doc", "__row", F.explode("__hits").alias("__h")).filter("__h.later").select(
        "__doc", "__row", F.col("__h.__k"), F.col("__h.__n"), F.col("__h.__key"))
    if not mixed.isEmpty():
        copies = copies.join(mixed, "__key", "left_anti")
    copies = copies.select("__doc", "__row", "__k", "__n").distinct()
    marks = copies.select("__doc", "__row", "__k", F.lit(True).alias("__copy"))
    marks = F.broadcast(marks) if fits_broadcast(marks, F.lit(32)) else marks
    inside = F.when(F.col("__copy"), F.col("__n") - 1).otherwise(0)
    searched = pieces.join(marks, ["__doc", "__row", "__k"], "left").select(
        "__doc", "__row", (F.col("__k") + inside).alias("__from"),
        F.filter("__windows", lambda w, i: i >= inside).alias("__windows"))
    windows = searched.select("__doc", "__row", "__from", F.posexplode("__windows").alias("__i", "__key")).select(
        "__doc", "__row", (F.col("__from") + F.col("__i")).alias("__k"), "__key")

    hits = _occurrences(windows, [], "windows")
    texts = _texts_of(documents, hits, F.lit(LEAST_LINES))
    mixed = _mixed(texts, "windows")
    later = hits.select("__doc", "__row", F.explode("__hits").alias("__h")).filter("__h.later").select(
        "__doc", "__row", F.col("__h.__k"), F.col("__h.__key"))
    if not mixed.isEmpty():
        place = F.struct("__doc", "__k", "__row")
        told = texts.join(mixed, "__key")
        firsts = told.groupBy("__key", "__t").agg(F.min(place).alias("__first"))
        told = told.join(firsts, ["__key", "__t"]).filter(place != F.col("__first"))
        later = later.join(mixed, "__key", "left_anti").select("__doc", "__row", "__k").union(
            told.select("__doc", "__row", "__k"))
    found = copies.unionByName(later.select("__doc", "__row", "__k", F.lit(LEAST_LINES).alias("__n")))
    covered = F.flatten(F.transform(F.collect_set(F.struct("__k", "__n")),
                                    lambda x: F.sequence(x["__k"], x["__k"] + x["__n"] - 1)))
    return cut_lineage(found.groupBy("__doc", "__row").agg(F.array_sort(F.array_distinct(covered)).alias("__gone")),
                       "removed-lines")


def dedup_runs(documents: DataFrame) -> DataFrame:
    """The documents without any run of ``LEAST_LINES`` or more lines that stands earlier."""
    rows = _at_places(_packed(documents), repeated_runs(documents), F.size("__gone") * 4 + 64, "left")
    rows = _hold(rows.withColumn("text", F.col("text")), "__lines", F.split(F.col("text"), "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda k: F.get(F.col("__lines"), k)), "\n"))
    removed = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone"))
    return _unpacked(rows, documents.columns, text, removed)


def runs_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_md5 of every document after ``dedup_runs``."""
    lines = documents.withColumn("__n", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    return dedup_runs(lines.select("doc_id", "text", "__n")).select(
        "doc_id", F.greatest(F.col("__n"), F.lit(0)).alias("n_lines"), F.col("lines_removed").alias("n_removed"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"))


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, {HASH_DIGITS}))::BIGINT AS h FROM lines),
marked AS (
  SELECT *, CASE WHEN (coalesce(lag(h) OVER w % {FOLD}, 0) * {WEIGHT} + h) % {DIVISOR} = 0 THEN 1 ELSE 0 END AS e
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(e) OVER (PARTITION BY doc_id ORDER BY i
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM marked),
chunks AS (SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM numbered GROUP BY doc_id, k),
ranked AS (SELECT *, n >= {LEAST_LINES} AND row_number() OVER (PARTITION BY t ORDER BY doc_id, k) > 1 AS gone FROM chunks)
SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS n_removed,
       md5(coalesce(string_agg(t, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_md5
FROM ranked GROUP BY doc_id
"""

#: DuckDB SQL of ``runs_report``, for unique doc_ids and windows of two lines.
RUNS_ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
followed AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM lines),
windows AS (
  SELECT doc_id, i, after IS NOT NULL
         AND row_number() OVER (PARTITION BY line, after ORDER BY doc_id, i) > 1 AS again FROM followed),
ranked AS (
  SELECT lines.*, again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone
  FROM lines JOIN windows USING (doc_id, i))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_md5
FROM ranked GROUP BY doc_id
"""
