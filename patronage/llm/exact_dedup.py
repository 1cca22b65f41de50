"""Exact deduplication that a huge group of copies cannot skew.

Equal texts meet in three steps, each comparing the full normalised text and
not only its digest: map-side partial aggregation within a task, groups per
(salt, digest, text), and one global combination of the salts' winners, of which
a text has at most ``SALTS`` however often it occurs. On the way back a document finds its
group by (salt, digest), so a hot text is spread over the same salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.columns import ascii_lower, whole_row, whole_text

#: Salts per text; the set of a text's salts is one 64-bit mask.
SALTS = 64


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _bytes(digest: Column | str) -> Column:
    """A digest as bytes. It is never null, and says so: else joins would first filter
    for it, working the digest out twice."""
    return F.coalesce(F.unhex(digest), F.lit(b""))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, so null and empty texts form one group. Of equal texts the row with
    the largest id stays; a null id never wins against another, and stays
    only where its whole group has null ids. Repeated rows count in
    ``group_size``, and all rows carrying the winning id are ``kept``. An empty
    table gives no rows. Other columns of ``docs`` are not read.
    """
    keyed = docs.select(
        F.col(id_column).alias("doc_id"), ascii_lower(whole_text(text_column)).alias("norm")
    ).select(
        "doc_id",
        "norm",
        _sha256(F.col("norm")).alias("text_sha256"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    salted = (
        keyed.select("doc_id", "norm", "salt", _bytes("text_sha256").alias("digest"))
        .groupBy("salt", "digest", "norm")
        .agg(F.max("doc_id").alias("top_id"), F.count(F.lit(1)).alias("n"))
    )
    winners = (
        salted.groupBy("digest", "norm")
        .agg(
            F.max("top_id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.bit_or(F.expr("shiftleft(1L, salt)")).alias("mask"),
        )
        .select(
            "keep_id",
            "group_size",
            "digest",
            F.octet_length("norm").alias("length"),
            F.explode(
                F.filter(
                    F.sequence(F.lit(0), F.lit(SALTS - 1)),
                    lambda s: F.getbit(F.col("mask"), s) == 1,
                )
            ).alias("salt"),
        )
    )
    rows = keyed.select(
        "doc_id",
        "salt",
        "text_sha256",
        _bytes("text_sha256").alias("digest"),
        F.octet_length("norm").alias("length"),
    )
    return rows.join(winners, ["salt", "digest", "length"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, all columns kept.

    Of repeated rows with the winning id one stays, whichever. Columns of any name
    may accompany the id and the text.
    """
    def keyed(doc_id, digest):
        """Plain equality on these columns is equality of (doc_id, digest), null ids included."""
        return {"id": F.coalesce(doc_id, F.lit(0)), "no_id": doc_id.isNull(), "digest": digest}

    digest = _bytes(_sha256(ascii_lower(whole_text(text_column))))
    packed = docs.select(
        *(c.alias(n) for n, c in keyed(F.col(id_column).cast("long"), digest).items()),
        whole_row(docs).alias("row"),
    )
    kept = exact_groups(docs, id_column, text_column).where("kept")
    kept = kept.select(
        *(c.alias(n) for n, c in keyed(F.col("keep_id"), _bytes("text_sha256")).items())
    )
    # The duplicates of repeated rows lie where the join has brought them.
    key = ["id", "no_id", "digest"]
    return packed.join(kept.distinct(), key).dropDuplicates(key).select("row.*")
