"""Exact duplicates by skew-safe combining, in DataFrame functions only.

Rows are combined in three steps, and each step groups by the digest and by the full
normalised content: within an input partition (the partial aggregation before the first
shuffle), then per digest, content and salt, then over the salts. A group of copies, however
large, sends one row per task into the first shuffle and one per salt into the second.
Rows find their group again by the digest and a second, independent hash of the content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, need_columns

#: The rank of a row in its group: code points of the text, then the smaller id, as one number.
_STEP = str(2**66)
_TOP = str(2**63)


def without_space(text: Column) -> Column:
    """The text without ASCII white space; a null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in ASCII_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _number(x: Column | str, digits: int) -> Column:
    return (F.lit(x) if isinstance(x, str) else x).cast(f"decimal({digits},0)")


def _rank(length: Column, doc_id: Column) -> Column:
    under = F.coalesce(_number(_TOP, 20) - _number(doc_id, 20), _number("0", 21))
    return _number(_number(length, 10) * _number(_STEP, 21) + under, 35)


def _id_of(rank: Column) -> Column:
    under = rank % _number(_STEP, 21)
    return F.when(under != 0, (_number(_TOP, 20) - under).cast("long"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space. Of equal texts the row with the
    most code points stays, then the smallest doc_id. A null text counts as empty; empty texts
    are one group. A null id ranks after all others. Rows that repeat an id with the best text
    are all `kept`, as the id names them all. An empty table gives an empty result; other
    columns are ignored.
    """
    need_columns(docs, id_col, text_col)
    doc_id, text = docs[id_col].cast("long"), docs[text_col]
    norm = without_space(text)
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).alias("points"),
        norm.alias("norm"),
        F.sha2(norm, 256).alias("digest"),
    )
    salted = rows.groupBy(
        "digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "norm"
    ).agg(F.max(_rank(F.col("points"), F.col("doc_id"))).alias("best"), F.count("*").alias("n"))
    groups = (
        salted.groupBy("digest", "norm")
        .agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
        .select(
            F.col("digest").alias("g_digest"),
            F.xxhash64("norm").alias("g_check"),
            "best",
            "group_size",
        )
    )
    members = rows.select(
        "doc_id", _rank(F.col("points"), F.col("doc_id")).alias("rank"), "digest", F.xxhash64("norm").alias("check")
    )
    return members.join(
        groups, (F.col("digest") == F.col("g_digest")) & (F.col("check") == F.col("g_check"))
    ).select(
        "doc_id",
        _id_of(F.col("best")).alias("keep_id"),
        "group_size",
        (F.col("rank") == F.col("best")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
