"""How five filters interact under every order in which they can be applied.

A document counts only by its part, the set of filters that it fails (a mask of five bits) and
its labels, so documents are first summed to mask cells, at most 128 of them in a part. Each cell
folds across the array of the 120 orders with higher-order functions: `aggregate` walks the steps
of an order, `transform` maps all orders, and 600 structs come out, weighted by the cell's
documents. A part's cells are merged by elementwise sums. Everything is a DataFrame function.

Filter E asks for the smallest id of a text. Equal texts fail the same of the other filters, so
rows are summed by digest before they are shuffled, and a group of copies, however large, sends
one row per id into a count and a handful per text into the comparison.
"""

from __future__ import annotations

from itertools import permutations
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, need_columns

#: The filters, in the order of their bits, and all orders in which they can be applied.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

_MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<" + ",".join(f"{m}:bigint" for m in _MEASURES) + ">"


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.translate(text, ASCII_SPACE, " " * len(ASCII_SPACE)), " "), lambda w: w != "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    points = F.length(text).cast("long")
    capitals = points - F.length(F.translate(text, ascii_uppercase, ""))
    fails = {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * capitals > 10 * points, "D": text.rlike("[#$%&*|]")}
    mask = F.lit(0)
    for letter, failed in fails.items():
        mask = mask.bitwiseOR(F.when(failed, _bit(letter)).otherwise(0))
    return mask


def _labelled(rows: DataFrame, labels: DataFrame, doc_id: str, quality: str, toxic: str) -> DataFrame:
    """rows with good and toxic. Rows without an id have no label and bypass the join."""
    marks = labels.groupBy(labels[doc_id].cast("long").alias("doc_id")).agg(
        F.max(labels[quality] == 1).alias("good"), F.max(labels[toxic] == 1).alias("toxic")
    )
    # the rewritten key gives the join a shuffle of its own, so that a hot id can be split
    marks = marks.where("doc_id is not null").withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    known = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    false = F.lit(False)
    return known.withColumns({n: F.coalesce(n, false) for n in ("good", "toxic")}).unionByName(
        rows.where("doc_id is null").withColumns({"good": false, "toxic": false})
    )


def _cells(rows: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n) with filter E in the mask."""
    by_id = rows.groupBy("digest", "mask", "part", "good", "toxic", "doc_id").agg(F.count("*").alias("n"))
    by_text = by_id.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_least"),
    )
    # rows of one text here: one per part and labels
    first = F.min("least").over(Window.partitionBy("digest"))
    passing = F.when(first.isNull(), F.col("n")).when(F.col("least") == first, F.col("n_least")).otherwise(0)
    split = by_text.select("*", passing.alias("passing")).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask"), F.col("passing").alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(_bit("E"))).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )).alias("cell"),
    )
    # a part stays even if a cell of it is empty
    return split.groupBy("part", "cell.mask", "good", "toxic").agg(F.sum("cell.n").alias("n"))


def _folded(orders: Column) -> Column:
    """Of a cell (mask, good, toxic, n): an array of one struct per order and step."""
    n, mask = F.col("n"), F.col("mask")
    weight = lambda condition: F.when(condition, n).otherwise(F.lit(0).cast("long"))

    def step(state: Column, letter: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), F.ascii(letter) - F.lit(ord("A")))
        fails, alive = mask.bitwiseAND(bit) != 0, state["alive"]
        gone = alive & fails
        row = F.struct(
            weight(alive & ~fails).alias("kept"),
            weight(gone).alias("removed"),
            weight(~alive & fails).alias("redundant"),
            weight(mask == bit).alias("unique_fails"),
            weight(gone & F.col("good")).alias("good_lost"),
            weight(gone & F.col("toxic")).alias("toxic_lost"),
        )
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(row)).alias("steps"))

    def order(o: Column) -> Column:
        start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{_STEP}>").alias("steps"))
        return F.aggregate(F.split(o, ""), start, step, lambda state: state["steps"])

    return F.flatten(F.transform(orders, order))


def _summed(folds: Column) -> Column:
    """Elementwise sum of arrays of structs."""
    zero = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(m) for m in _MEASURES]), len(ORDERS) * len(FILTERS))
    add = lambda a, b: F.struct(*[(a[m] + b[m]).alias(m) for m in _MEASURES])
    return F.aggregate(folds, zero, lambda total, fold: F.zip_with(total, fold, add))


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    quality_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley: 600 rows per part, one per order of the filters A to E and step, zeros included.

    A document fails A with fewer than 100 words, B if 100 x distinct words < 80 x words, C if
    100 x capitals (A-Z) > 10 x code points, D if it holds one of #$%&*|, and E if its text is
    that of a smaller id anywhere in the table, told by SHA-256. Each count is of the part's
    documents: kept after the step, removed by it, redundant (failing its filter, removed
    before), unique_fails (failing its filter alone), good_lost and toxic_lost (removed by it
    with the label). shapley is what the step's filter removes over all 120 orders.

    A null text is empty, a null part the part ''. A null id is larger than any other and has no
    label; rows that share the smallest id of a text all pass E. An id with several labels has a
    label if any of its rows says 1; null labels say nothing. An empty table gives an empty
    result; other columns are ignored.
    """
    need_columns(docs, id_col, text_col, part_col)
    need_columns(labels, id_col, quality_col, toxic_col)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        failures(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    cells = _cells(_labelled(rows, labels, id_col, quality_col, toxic_col))
    orders = F.array(*map(F.lit, ORDERS))
    parts = cells.select("part", _folded(orders).alias("fold")).groupBy("part").agg(
        _summed(F.collect_list("fold")).alias("steps")
    )
    flat = parts.select("part", F.posexplode("steps").alias("at", "s"))
    n = F.lit(len(FILTERS))
    place = F.call_function("div", F.col("at"), n).cast("int")
    step = (F.col("at") % n + 1).cast("int")
    out = flat.select("part", orders[place].alias("filter_order"), step.alias("step"), "s.*")
    by_filter = Window.partitionBy("part", F.substr(F.col("filter_order"), F.col("step"), F.lit(1)))
    return out.withColumn("shapley", F.sum("removed").over(by_filter))
