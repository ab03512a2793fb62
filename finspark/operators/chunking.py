"""Header-aware markdown chunking as a native Spark expression.

Rules (fixed behaviour the retrieval results depend on):

* Lines are split like ``str.splitlines``.  A line whose stripped text
  starts with ``#`` is a header: if the buffer holds at least
  ``int(0.6 * target)`` characters it is flushed first (no overlap), and the
  section becomes the header text without leading ``#`` (``root`` if empty).
* Each line adds ``len(line) + 1`` to the buffer; reaching ``target``
  flushes the buffer.  Unless it was the last line, the next buffer starts
  with the fewest trailing lines whose lengths (+1 each) reach ``overlap``.
* The buffer is always a contiguous span of lines, so the fold state is
  ``(buffer_start, buffer_len, section, spans)``; chunk text is the span's
  lines joined by newlines and stripped.  Empty texts take no index; chunks
  shorter than ``min_chars`` are dropped after indexing.

The fold runs per document inside one ``aggregate`` higher-order function:
no shuffle, no Python, documents stay where they were read.  Appending to
an array copies it, so the lines are folded in blocks of ``BLOCK_LINES``:
each block appends to its own small span array and the outer fold keeps one
array per block (flattened once at the end), which keeps the copying close
to linear in the document length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finspark.config import CHUNK_MIN_CHARS, CHUNK_OVERLAP_CHARS, CHUNK_TARGET_CHARS
from finspark.functions.text import WHITESPACE_CLASS, py_strip, split_lines

SPAN_TYPE = "array<struct<s:int,e:int,sec:string>>"
BLOCK_LINES = 256


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a let-binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _span(s: Column, e: Column, sec: Column) -> Column:
    return F.array(F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"), sec.alias("sec")))


def section_name(line: Column) -> Column:
    name = py_strip(F.regexp_replace(py_strip(line), "^#+", ""))
    return F.when(name == "", F.lit("root")).otherwise(name)


def chunk_spans(lines: Column, lens: Column, target: int = CHUNK_TARGET_CHARS,
                overlap: int = CHUNK_OVERLAP_CHARS, header_ratio: float = 0.6) -> Column:
    """Array of (start_line, end_line, section) buffer flushes, in order.

    ``lens`` must be a column holding ``length(line) + 1`` per line (not an
    expression: it is read once per step inside the fold)."""
    n = F.size(lines)
    header_min = int(target * header_ratio)

    def overlap_tail(i: Column) -> Column:
        # Fewest trailing lines ending at i whose (len + 1) sum reaches
        # `overlap`; every line adds >= 1, so at most `overlap` lines back.
        lo = F.greatest(F.lit(1), i - (overlap - 1))
        tail = F.reverse(F.slice(lens, lo, i - lo + 1))
        return F.aggregate(tail, F.struct(F.lit(0).alias("s"), F.lit(0).alias("m")),
                           lambda a, x: F.when(a["s"] >= overlap, a)
                           .otherwise(F.struct((a["s"] + x).alias("s"), (a["m"] + 1).alias("m"))))

    def step(st: Column, i: Column) -> Column:
        line = F.element_at(lines, i)
        is_header = line.rlike(f"^{WHITESPACE_CLASS}*#")
        pre_flush = is_header & (st["bs"] <= i - 1) & (st["cl"] >= header_min)
        stage1 = F.struct(
            F.when(pre_flush, F.concat(st["out"], _span(st["bs"], i - 1, st["sec"]))).otherwise(st["out"]).alias("out"),
            F.when(pre_flush, i).otherwise(st["bs"]).alias("bs"),
            (F.when(pre_flush, 0).otherwise(st["cl"]) + F.element_at(lens, i)).alias("cl"),
            F.when(is_header, section_name(line)).otherwise(st["sec"]).alias("sec"),
        )

        def after_append(v: Column) -> Column:
            full = v["cl"] >= target
            flushed = F.concat(v["out"], _span(v["bs"], i, v["sec"]))
            tail = overlap_tail(i)
            return (F.when(full & (i < n), F.struct(
                        (i - tail["m"] + 1).alias("bs"), tail["s"].alias("cl"), v["sec"].alias("sec"),
                        flushed.alias("out")))
                    .when(full, F.struct((i + 1).alias("bs"), F.lit(0).alias("cl"), v["sec"].alias("sec"),
                                         flushed.alias("out")))
                    .otherwise(F.struct(v["bs"].alias("bs"), v["cl"].alias("cl"), v["sec"].alias("sec"),
                                        v["out"].alias("out"))))

        return _let(stage1, after_append)

    def block(st: Column, b: Column) -> Column:
        # Fold one block of lines from the incoming state with a fresh,
        # block-local span array; the outer fold keeps one array per block.
        lo = b * BLOCK_LINES + 1
        hi = F.least(n, (b + 1) * BLOCK_LINES)
        start = F.struct(st["bs"].alias("bs"), st["cl"].alias("cl"), st["sec"].alias("sec"),
                         F.array().cast(SPAN_TYPE).alias("out"))
        inner = F.aggregate(F.sequence(lo, hi), start, step)
        return F.struct(inner["bs"].alias("bs"), inner["cl"].alias("cl"), inner["sec"].alias("sec"),
                        F.concat(st["blocks"], F.array(inner["out"])).alias("blocks"))

    def finish(st: Column) -> Column:
        spans = F.flatten(st["blocks"])
        return F.when(st["bs"] <= n, F.concat(spans, _span(st["bs"], n, st["sec"]))).otherwise(spans)

    def finish_single(st: Column) -> Column:
        return F.when(st["bs"] <= n, F.concat(st["out"], _span(st["bs"], n, st["sec"]))).otherwise(st["out"])

    # Documents within one block take the plain fold (no outer level).
    single_init = F.struct(F.lit(1).alias("bs"), F.lit(0).alias("cl"), F.lit("root").alias("sec"),
                           F.array().cast(SPAN_TYPE).alias("out"))
    single = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), single_init, step, finish_single)
    n_blocks = F.floor((F.greatest(n, F.lit(1)) - 1) / BLOCK_LINES).cast("int")
    outer_init = F.struct(F.lit(1).alias("bs"), F.lit(0).alias("cl"), F.lit("root").alias("sec"),
                          F.array().cast(f"array<{SPAN_TYPE}>").alias("blocks"))
    blocked = F.aggregate(F.sequence(F.lit(0), n_blocks), outer_init, block, finish)
    return (F.when(n == 0, F.array().cast(SPAN_TYPE)).when(n <= BLOCK_LINES, single)
            .otherwise(blocked))


def chunk_documents(docs: DataFrame, text_col: str = "text", source_col: str = "source_file",
                    target: int = CHUNK_TARGET_CHARS, overlap: int = CHUNK_OVERLAP_CHARS,
                    min_chars: int = CHUNK_MIN_CHARS, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs(source_file, text, ...) -> chunks(chunk_id, text, source_file,
    section, start_line, end_line, chunk_index, ...keep)."""
    with_lines = docs.select(*keep, F.col(source_col).alias("source_file"),
                             split_lines(F.col(text_col)).alias("lines"))
    with_lines = with_lines.withColumn("lens", F.transform("lines", lambda x: F.length(x) + 1))
    lines = F.col("lines")

    def materialize(sp: Column) -> Column:
        body = F.array_join(F.slice(lines, sp["s"], sp["e"] - sp["s"] + 1), "\n")
        return F.struct(py_strip(body).alias("text"), sp["sec"].alias("section"),
                        sp["s"].alias("start_line"), sp["e"].alias("end_line"))

    texts = F.filter(F.transform(chunk_spans(lines, F.col("lens"), target, overlap), materialize),
                     lambda c: c["text"] != "")
    exploded = with_lines.select(*keep, "source_file", F.posexplode(texts).alias("chunk_index", "c"))
    return exploded.where(F.length(F.col("c.text")) >= min_chars).select(
        F.concat_ws(":", "source_file", F.col("chunk_index").cast("string")).alias("chunk_id"),
        F.col("c.text").alias("text"), "source_file", F.col("c.section").alias("section"),
        F.col("c.start_line").alias("start_line"), F.col("c.end_line").alias("end_line"),
        "chunk_index", *keep)
