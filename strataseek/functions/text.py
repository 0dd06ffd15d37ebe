"""Text expressions: cleaning, chunking, tokens, ids, previews and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataseek.functions.geo import let

# Fixed value: the characters Python's str.strip() removes.
STRIP_CHARS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
               "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
# A chunk may end after one of these, up to this far before its limit.
SENTENCE_ENDS = ".!?\n"
LOOK_BACK = 100
# Chunks that are gathered before they are put aside.
_SHELF = 128


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(raw: Column | str) -> Column:
    """Whitespace runs to one space, non-ASCII characters removed, spaces trimmed.

    Newlines are whitespace, so no separate newline rule is needed after the first
    step. Removing a non-ASCII character may leave two spaces side by side.
    """
    spaced = F.regexp_replace(_column(raw), r"\s+", " ")
    return F.trim(F.regexp_replace(spaced, r"[^\x00-\x7F]+", ""))


def check_chunking(size: int, overlap: int) -> None:
    """Every step must move forward, even when it ends at the earliest sentence end."""
    if size < 1 or not 0 <= overlap < min(size, max(size - LOOK_BACK, 0) + 2):
        raise ValueError(f"overlap {overlap} does not fit chunk size {size}")


def chunk_text(text: Column | str, size: int = 500, overlap: int = 50) -> Column:
    """Overlapping chunks that end at a sentence end where one is near.

    A chunk takes ``size`` characters; unless it reaches the end of the text it is
    cut after the last sentence end among the ``LOOK_BACK`` characters up to and
    including the one that follows it. The next chunk starts ``overlap`` characters
    before the cut. Chunks are stripped and empty ones dropped; a text that gives
    none is returned whole, null or empty text gives an empty array.

    The text is first split into fixed pieces, so each step reads two pieces. Chunks are
    gathered on shelves of ``_SHELF``, so a step copies no more than one shelf.
    """
    check_chunking(size, overlap)
    piece = max(4096, size + 1)
    low = max(size - LOOK_BACK, 0)
    shortest_step = low + 2 - overlap

    def cut(segment: Column) -> Column:
        # length of the chunk whose following text is ``segment`` (size + 1 characters)
        window = F.translate(F.substring(segment, low + 2, size - low),
                             SENTENCE_ENDS, "." * len(SENTENCE_ENDS))
        hit = F.instr(F.reverse(window), ".")
        return F.when(hit > 0, F.lit(size + 2) - hit).otherwise(F.lit(size))

    empty = F.array().cast("array<string>")

    def full(state: Column) -> Column:
        return F.size(state["chunks"]) >= _SHELF

    def chunks(t: Column) -> Column:
        n = F.length(t)

        def walk(pieces: Column) -> Column:
            def segment(start: Column) -> Column:
                k = F.floor(start / piece).cast("int")
                return F.substring(
                    F.concat(F.get(pieces, k), F.coalesce(F.get(pieces, k + 1), F.lit(""))),
                    start - k * piece + 1, F.lit(size + 1))

            def step(state: Column, _i: Column) -> Column:
                def advance(seg: Column) -> Column:
                    inner = state["start"] + size < n
                    return let(F.when(inner, cut(seg)).otherwise(F.lit(size)), lambda length: let(
                        F.btrim(F.substring(seg, F.lit(1), length), F.lit(STRIP_CHARS)),
                        lambda chunk: F.struct(
                            F.when(state["start"] + length < n,
                                   state["start"] + length - overlap)
                            .otherwise(F.lit(-1)).cast("int").alias("start"),
                            F.when(full(state), F.concat(state["done"], F.array(state["chunks"])))
                            .otherwise(state["done"]).alias("done"),
                            let(F.when(full(state), empty).otherwise(state["chunks"]),
                                lambda held: F.when(chunk == "", held)
                                .otherwise(F.concat(held, F.array(chunk)))).alias("chunks"))))

                return F.when(state["start"] < 0, state).otherwise(
                    let(segment(state["start"]), advance))

            steps = F.sequence(F.lit(1), F.floor(n / shortest_step).cast("int") + 1)
            begin = F.struct(F.lit(0).alias("start"),
                             F.array().cast("array<array<string>>").alias("done"),
                             empty.alias("chunks"))
            return F.aggregate(steps, begin, step, lambda s: F.concat(
                F.flatten(s["done"]), s["chunks"]))

        made = let(F.regexp_extract_all(t, F.lit(rf"(?s).{{1,{piece}}}"), F.lit(0)), walk)
        return F.when(F.coalesce(n, F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
            let(made, lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(t))))

    return let(_column(text), chunks)


def chunk_key(file_name: Column | str, chunk: Column | str) -> Column:
    return F.sha2(F.concat_ws("_", _column(file_name), _column(chunk)), 256)


def tokens(text: Column | str) -> Column:
    """Lower-case runs of ASCII letters and digits, in text order."""
    return F.regexp_extract_all(F.lower(_column(text)), F.lit(r"[a-z0-9]+"), F.lit(0))


def preview(text: Column | str, length: int = 200) -> Column:
    """First ``length`` characters, with ``...`` only when something was left out."""
    t = _column(text)
    return F.when(F.length(t) > length, F.concat(F.substring(t, 1, length), F.lit("..."))) \
        .otherwise(t)


def label(text: Column | str, length: int = 40) -> Column:
    """First ``length`` characters, always followed by ``...``."""
    return F.concat(F.substring(_column(text), 1, length), F.lit("..."))


def safe_title(title: Column | str, length: int = 50) -> Column:
    """File-name form of a title: letters, digits, space, ``-`` and ``_`` kept,
    outer spaces dropped, spaces to ``_``, first ``length`` characters."""
    kept = F.trim(F.regexp_replace(_column(title), r"[^\p{L}\p{N} _-]", ""))
    return F.substring(F.replace(kept, F.lit(" "), F.lit("_")), 1, length)


def safe_id(identifier: Column | str) -> Column:
    return F.translate(_column(identifier).cast("string"), "/ ", "__")


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    t = _column(ts)
    return F.when(F.date_format(t, "SSSSSS") == "000000",
                  F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def run_stamp(ts: Column | str) -> Column:
    return F.date_format(_column(ts), "yyyyMMdd_HHmmss")
