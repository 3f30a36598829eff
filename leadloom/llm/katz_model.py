"""A Katz backoff model of any order, kept as tables, that scores any documents.

`fit` counts n-grams of all orders in one shuffle and writes, partitioned by order, a row per
n-gram with its count and probability and a row per history with its backoff weight. `score`
evaluates from these tables alone, recursively: an n-gram that the table of its order has is done;
any other takes its history's weight and goes on with the history one word shorter.

    P(w|h) = d(c(h,w)) c(h,w) / c(h)        if the n-gram was seen
    P(w|h) = a(h) P(w|h')                   if not, h' being h without its first word
    a(h) = left(h) / (1 - sum of P(w|h') over the words seen after h), 1 for a history not seen
    P(w) = d(c(w)) c(w) / N, and the rest for an unknown word

Discounts d are Good-Turing's, per order (`katz.discounts`). Where none of a history's counts is
discounted, its total is raised by one. So the probabilities after any history sum to one. With
order 2 the model is the one that `katz.katz_scores` uses; that operator never brings single
n-grams into rows, which is what makes it fit the limits of its query, and works for pairs only.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, need_columns
from .katz import CUT, discounts

#: What stands before a document and at its end; neither can be a word.
START, END = "\t", ""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tokens(text: Column) -> Column:
    """Lower-cased (A-Z) words and one end."""
    blank = F.translate(F.coalesce(text, F.lit("")), _UPPER + ASCII_SPACE, _LOWER + " " * len(ASCII_SPACE))
    return F.concat(F.filter(F.split(blank, " "), lambda w: w != ""), F.array(F.lit(END)))


def _grams(tokens: Column, orders: list[int], order: int) -> Column:
    """(n, h, w) for each token and each of the orders; h is the n - 1 tokens before it."""
    padded = F.concat(F.array_repeat(F.lit(START), order - 1), tokens)

    def at(i: Column) -> Column:
        histories = [
            F.struct(
                F.lit(n).alias("n"),
                F.array_join(F.slice(padded, i + order - n, n - 1), " ").alias("h"),
                F.get(tokens, i - 1).alias("w"),
            )
            for n in orders
        ]
        return F.array(*histories)

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(tokens)), at))


def _shorter(h: Column) -> Column:
    """A history without its first word."""
    return F.when(F.instr(h, " ") > 0, F.regexp_replace(h, "^[^ ]* ", "")).otherwise("")


def _discounted(count: Column, d: np.ndarray) -> Column:
    table = F.array(*[F.lit(float(x)) for x in d])
    return F.when(count <= CUT, F.get(table, count.cast("int"))).otherwise(1.0) * count


def fit(docs: DataFrame, path: str, order: int = 3, text_col: str = "text") -> KatzModel:
    """Learn from all documents and write the tables below path.

    A null text is empty: its only token is the end. Repeated rows count as often as they occur.
    Without documents every token is the unknown word with probability 1. Other columns are
    ignored.
    """
    if order < 1:
        raise ValueError("the order must be at least 1")
    need_columns(docs, text_col)
    spark = docs.sparkSession
    rows = docs.select(F.explode(_grams(_tokens(docs[text_col]), list(range(1, order + 1)), order)).alias("g")).select("g.*")
    rows.groupBy("n", "h", "w").agg(F.count("*").alias("count")).write.partitionBy("n").parquet(f"{path}/counts")
    counts = spark.read.schema("h string, w string, count long, n int").parquet(f"{path}/counts")
    few = counts.where(F.col("count") <= CUT + 1).groupBy("n", "count").agg(F.count("*").alias("types")).collect()
    n_r = np.zeros((order + 1, CUT + 2), np.int64)  # at most order x (CUT + 1) rows
    for r in few:
        n_r[r["n"], r["count"]] = r["types"]
    for n in range(1, order + 1):
        _write_order(spark, path, counts.where(F.col("n") == n).drop("n"), n, discounts(n_r[n]))
    return KatzModel(spark, path, order)


def _write_order(spark: SparkSession, path: str, seen: DataFrame, n: int, d: np.ndarray) -> None:
    kept = _discounted(F.col("count"), d)
    if n == 1:
        seen = seen.withColumn("below", F.lit(0.0))
    else:
        under = _probabilities(spark, path, n - 1).select(F.col("h").alias("below_h"), F.col("w").alias("below_w"), F.col("p").alias("below"))
        # a seen n-gram's last n - 1 words are a seen one of the order below
        seen = seen.withColumn("h1", _shorter(F.col("h"))).join(under, (F.col("h1") == F.col("below_h")) & (F.col("w") == F.col("below_w")))
    total, used = F.sum("count").alias("total"), F.sum(kept).alias("used")
    some = F.max(F.col("count") <= CUT).alias("low") if (d[1:] < 1).all() else F.max(
        reduce(lambda a, b: a | b, [F.col("count") == r for r in range(1, CUT + 1) if d[r] < 1], F.lit(False))
    ).alias("low")
    per_history = seen.groupBy("h").agg(total, used, F.sum("below").alias("mass"), some)
    # nothing discounted: the total is raised by one
    raised = F.when(F.col("low"), F.col("total")).otherwise(F.col("total") + 1).cast("double")
    left = F.when(F.col("low"), (F.col("total") - F.col("used")) / raised).otherwise(1 / raised)
    weights = per_history.select("h", raised.alias("raised"), F.log10(left / (1 - F.col("mass"))).alias("log_a"))
    weights.write.parquet(f"{path}/backoff/n={n}")
    kept_weights = spark.read.schema("h string, raised double, log_a double").parquet(f"{path}/backoff/n={n}")
    rated = seen.select("h", "w", "count").join(kept_weights.select("h", "raised"), "h")
    rated.select("h", "w", "count", (kept / F.col("raised")).alias("p")).write.parquet(f"{path}/ngrams/n={n}")


def _probabilities(spark: SparkSession, path: str, n: int) -> DataFrame:
    return spark.read.schema("h string, w string, count long, p double").parquet(f"{path}/ngrams/n={n}")


class KatzModel:
    """The tables below a path."""

    def __init__(self, spark: SparkSession, path: str, order: int):
        self.spark, self.path, self.order = spark, path.rstrip("/"), order

    def ngrams(self, n: int) -> DataFrame:
        """h, w, count, p of the n-grams of an order."""
        return _probabilities(self.spark, self.path, n)

    def backoff(self, n: int) -> DataFrame:
        """h, log_a: the weights of the histories of an order; of order 1 the share of unknown words."""
        weights = self.spark.read.schema("h string, raised double, log_a double").parquet(f"{self.path}/backoff/n={n}")
        return weights.select("h", "log_a")

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """grams (h, w), distinct, with log10 P(w|h)."""
        left = grams.select("h", "w", F.col("h").alias("rest"), F.lit(0.0).alias("owed"))
        done = []
        for n in range(self.order, 0, -1):
            table = self.ngrams(n).select(F.col("h").alias("seen_h"), F.col("w").alias("seen_w"), "p")
            weights = self.backoff(n).select(F.col("h").alias("weight_h"), "log_a")
            found = left.join(table, (F.col("rest") == F.col("seen_h")) & (F.col("w") == F.col("seen_w")), "left")
            done.append(found.where("p is not null").select("h", "w", (F.col("owed") + F.log10("p")).alias("log_p")))
            unseen = found.where("p is null").select("h", "w", "rest", "owed")
            left = unseen.join(weights, F.col("rest") == F.col("weight_h"), "left").select(
                "h", "w", _shorter(F.col("rest")).alias("rest"), (F.col("owed") + F.coalesce("log_a", F.lit(0.0))).alias("owed")
            )
        # what order 1 lacks is the unknown word, whose share was the last weight
        done.append(left.select("h", "w", F.col("owed").alias("log_p")))
        return reduce(DataFrame.unionByName, done)

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_tokens, score (log10 probability of the text) of every row.

        A null text is empty. Equal texts are evaluated once, and so are equal n-grams. An empty
        table gives an empty result; other columns are ignored.
        """
        need_columns(docs, id_col, text_col)
        text = F.coalesce(docs[text_col], F.lit(""))
        rows = docs.select(docs[id_col].alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
        texts = rows.groupBy("digest").agg(F.first("text").alias("text"))
        tokens = texts.select("digest", F.explode(_grams(_tokens(F.col("text")), [self.order], self.order)).alias("g"))
        used = tokens.groupBy("digest", "g.h", "g.w").agg(F.count("*").alias("times"))
        rated = used.join(self.log_probabilities(used.select("h", "w").distinct()), ["h", "w"])
        sums = rated.groupBy("digest").agg(
            F.sum("times").alias("n_tokens"), F.sum(F.col("times") * F.col("log_p")).alias("score")
        )
        return rows.select("doc_id", "digest").join(sums, "digest").select("doc_id", "n_tokens", "score")
