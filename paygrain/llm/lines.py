"""Repeated lines across documents, as compressed keep bitmaps.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
``least_chars`` code points that at least ``least_docs`` documents hold lose their lines, except
in the document with the largest id. Only 128-bit hashes of keys travel: they are partitioned by
ranges of (hash, document), so that a line which a third of all documents share is cut into many
ranges, and sorted by document and position. The stream of a range yields the first line of
every (hash, document), and these are counted per hash with sums combined in the tasks.

The result has one row per document: the number of its lines and ``keep_flips``, its keep bitmap
compressed to the positions where kept and dropped lines change ([3, 5]: lines 0-2 are kept, 3
and 4 dropped, the rest is kept; []: all are kept).

Defined cases: a null or empty text is one empty line; rows that repeat a ``doc_id`` count as
one document among the holders of a line, and each has the bitmap of its own text; a null
``doc_id`` ranks behind all others; an empty table gives an empty result; other columns keep their
values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.llm.common import GAP_CHARACTERS, ascii_lower, free_name, let, lookup, text_of
from paygrain.session import materialise

LEAST_CHARS = 40
LEAST_DOCS = 5
HASH = ("hash_a", "hash_b")


def text_hash() -> Column:
    """Tells the texts of rows with one ``doc_id`` apart."""
    return F.xxhash64(text_of(F.col("text")))


def line_array(text: Column) -> Column:
    return F.split(text_of(text), "\n")


def long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(hash_a, hash_b, doc_id, text_hash, position) of the lines that are long enough."""
    key = F.btrim(F.col("line"), F.lit(GAP_CHARACTERS))
    text = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    lines = text.select("doc_id", "text_hash", F.posexplode(line_array(F.col("text"))).alias("position", "line"))
    keys = lines.select("doc_id", "text_hash", "position", key.alias("key")).where(F.char_length("key") >= least_chars)
    keys = keys.withColumn("key", ascii_lower(F.col("key")))
    return keys.select(
        F.xxhash64("key").alias("hash_a"), F.xxhash64(F.lit("second"), "key").alias("hash_b"),
        "doc_id", "text_hash", "position",
    )


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, text_hash, position) of every line to drop."""
    rows = materialise(long_lines(docs, least_chars))
    ranges = rows.repartitionByRange(*HASH, "doc_id")
    stream = Window.partitionBy(*HASH, "doc_id").orderBy("position")
    firsts = ranges.withColumn("nth", F.row_number().over(stream)).where("nth = 1")
    repeated = firsts.groupBy(*HASH).agg(F.count("*").alias("docs"), F.max("doc_id").alias("holder"))
    repeated = repeated.where(F.col("docs") >= least_docs).drop("docs")
    found = lookup(rows, repeated, HASH, ["doc_id"])
    held = F.col("doc_id").eqNullSafe(F.col("holder"))
    return found.where(F.col("holder").isNotNull() & ~held).select("doc_id", "text_hash", "position")


def keep_flips(dropped: Column) -> Column:
    """Positions where kept and dropped lines change, from the sorted positions of the dropped."""

    def flips(gone: Column) -> Column:
        first = F.filter(gone, lambda p, i: (i == 0) | (F.get(gone, i - 1) != p - 1))
        last = F.filter(gone, lambda p, i: F.coalesce(F.get(gone, i + 1), F.lit(-1)) != p + 1)
        return F.flatten(F.zip_with(first, last, lambda a, b: F.array(a, b + 1)))

    return let(dropped, flips)


def line_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, keep_flips), one row per document."""
    count = F.size(line_array(F.col("text")))
    none = F.lit(None).cast("int")
    whole = docs.select("doc_id", text_hash().alias("text_hash"), count.alias("n_lines"), none.alias("position"))
    gone = dropped_lines(docs, least_chars, least_docs)
    gone = gone.select("doc_id", "text_hash", none.alias("n_lines"), "position")
    grouped = whole.unionByName(gone).groupBy("doc_id", "text_hash").agg(
        F.max("n_lines").cast("long").alias("n_lines"), F.sort_array(F.collect_set("position")).alias("dropped")
    )
    return grouped.select(
        "doc_id", "text_hash", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
        keep_flips(F.col("dropped")).alias("keep_flips"),
    )


def kept_lines(lines: Column, flips: Column) -> Column:
    """The lines that a bitmap keeps."""

    def spans(all_: Column, f: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor(F.size(f) / 2).cast("int")),
            lambda k: let(
                F.coalesce(F.get(f, 2 * k - 1), F.lit(0)),
                lambda start: F.slice(all_, start + 1, F.coalesce(F.get(f, 2 * k), F.size(all_)) - start),
            ),
        )

    return let(lines, lambda all_: let(flips, lambda f: F.flatten(spans(all_, f))))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as ``text`` and, as last column, the number of dropped lines.

    That column is ``n_dropped__``, or a variant of it that ``docs`` does not have. Only bitmaps
    that drop something are joined; other texts, null ones too, stay as they are.
    """
    doc, hashed, flips, dropped = (free_name(docs, wish) for wish in ("id__", "hash__", "flips__", "n_dropped__"))
    marks = bitmaps.where("n_dropped > 0").select(
        F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed),
        F.col("keep_flips").alias(flips), F.col("n_dropped").alias(dropped),
    )
    of = docs["doc_id"].eqNullSafe(marks[doc]) & (F.xxhash64(text_of(docs["text"])) == marks[hashed])
    joined = docs.join(marks, of, "left")
    kept = F.array_join(kept_lines(line_array(F.col("text")), F.col(flips)), "\n")
    text = F.when(F.col(flips).isNull(), F.col("text")).otherwise(kept).alias("text")
    return joined.select(
        *(text if c == "text" else F.col(c) for c in docs.columns), F.coalesce(dropped, F.lit(0).cast("long")).alias(dropped)
    )
