"""Mixing sources to target weights, in DataFrame functions only.

Documents hang on a tree of columns (domain, language, source). A token budget flows from the
root to the leaves: at each node the children share it by weight, a child never gets more than
its subtree can give (its tokens times `max_epochs`), and what a short child cannot use goes to
its siblings by weight. So a shortage reaches a parent's siblings only when the whole subtree
is used up. Each leaf then gives full epochs and one last, partial epoch: a prefix, by tokens,
of its documents in the seeded order of that epoch.

The prefix is cut without sorting a leaf in one task: documents fall into 65,536 buckets of
their seeded key, token sums find the bucket in which the cut lies, in two steps of at most 256
sums per leaf, and only that bucket is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ASCII_SPACE, need_columns, written

#: Leaves up to which the plan of the mix is broadcast; above, it is joined like any table.
BROADCAST_LEAVES = 20_000
#: Digits of the seeded key that tell buckets apart, and digits that are looked at in one step.
DIGITS, STEP = 4, 2
#: Above every key.
END = "~"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; none for a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def _weight(path: list[Column], weights: dict[tuple[str, ...], float]) -> Column:
    """The stated weight of a node among its siblings; 1 if none is stated."""
    out = F.lit(1.0)
    for names, weight in weights.items():
        if len(names) == len(path):
            here = F.lit(True)
            for c, name in zip(path, names, strict=True):
                here = here & (c == name)
            out = F.when(here, F.lit(float(weight))).otherwise(out)
    return out


def _fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds `given`: the share of the parent's `budget` by `weight`, at most `cap`."""
    w = W.partitionBy(*parent)
    up = w.orderBy(F.col("cap") / F.col("weight"), name).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0.0)
    full = F.col("cap") / F.col("weight") * (
        F.sum("weight").over(w) - F.coalesce(F.sum("weight").over(up), zero)
    ) + F.coalesce(F.sum("cap").over(up), zero) <= F.col("budget")
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(w)
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(w)
    share = F.greatest(F.col("budget") - used, zero) * F.col("weight") / open_weight
    return (
        nodes.withColumn("full", full)
        .withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), share)))
        .drop("full")
    )


def _joined(left: DataFrame, plan: DataFrame, path: list[str], n_leaves: int) -> DataFrame:
    return left.join(F.broadcast(plan) if n_leaves <= BROADCAST_LEAVES else plan, path)


def _seeded(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix_plan(
    docs: DataFrame,
    path: dict[str, Column],
    weights: dict[tuple[str, ...], float],
    budget: float,
    max_epochs: int = 1,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """One row per leaf: the path columns, docs, tokens, given (tokens to take), full_epochs and
    the cut: the last seeded key of the partial epoch that is taken (null: none).

    `path` names the levels from the root, as columns of docs; a null value is the node ''.
    `weights` maps node paths to weights among siblings (1 if not stated; 0 or less gives
    nothing). `budget` up to 1 is a share of all tokens, above it a number of tokens; what no
    leaf can give is left unused. A prefix ends before the first document that would exceed it.
    Rows that repeat an id share a seeded key and are taken or left together.
    """
    need_columns(docs, id_col, text_col)
    names = list(path)
    count = word_count(docs[text_col]) if tokens is None else tokens
    light = written(
        docs.select(
            docs[id_col].alias("_id"),
            count.cast("long").alias("_tokens"),
            *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in path.items()),
        ),
        "mix-rows",
    )
    leaves = light.groupBy(*names).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast("double"))
    # from the leaves up: weights and what each subtree can give
    levels = [leaves.select(*names, "cap", _weight([F.col(n) for n in names], weights).alias("weight")).where("weight > 0")]
    for depth in range(len(names) - 1, 0, -1):
        up = levels[0].groupBy(*names[:depth]).agg(F.sum("cap").alias("cap"))
        up = up.withColumn("weight", _weight([F.col(n) for n in names[:depth]], weights))
        levels.insert(0, up.where("weight > 0"))
    # from the root down: budgets
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    top = float(int(total * budget) if budget <= 1 else int(budget))
    given = _fill(levels[0].withColumn("budget", F.lit(top)), [], names[0])
    for depth in range(2, len(names) + 1):
        parents = given.select(*names[: depth - 1], F.col("given").alias("budget"))
        given = _fill(levels[depth - 1].join(parents, names[: depth - 1]), names[: depth - 1], names[depth - 1])
    plan = leaves.drop("cap").join(given.select(*names, "given"), names, "left")
    plan = plan.withColumn("given", F.floor(F.round(F.coalesce("given", F.lit(0.0)), 6)))
    plan = plan.withColumn("full_epochs", F.when(F.col("tokens") > 0, F.floor(F.col("given") / F.col("tokens"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("given") - F.col("full_epochs") * F.col("tokens"))
    plan = written(plan, "mix-leaves")
    n_leaves = plan.count()

    keyed = _joined(light, plan.where("rest > 0").select(*names, "full_epochs", "rest"), names, n_leaves)
    keyed = keyed.select(*names, "rest", "_tokens", _seeded(F.col("_id"), F.col("full_epochs"), seed).alias("key"))
    # the bucket of the cut, digit by digit: a leaf has at most 16^STEP sums to add up at a time
    cuts = plan.where("rest > 0").select(*names, F.lit("").alias("at"), F.lit(0).cast("long").alias("below"))
    for digits in range(STEP, DIGITS + 1, STEP):
        inside = _joined(keyed, cuts, names, n_leaves).where(F.col("key").startswith(F.col("at")))
        bucket = F.substring("key", 1, digits).alias("bucket")
        sums = inside.groupBy(*names, "rest", "below", bucket).agg(F.sum("_tokens").alias("t"))
        run = F.sum("t").over(W.partitionBy(*names).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        upto = F.col("below") + F.col("run")
        cuts = written(
            sums.withColumn("run", run)
            .groupBy(*names)
            .agg(
                # no bucket exceeds what is left to take: all documents are in
                F.coalesce(F.min(F.when(upto > F.col("rest"), F.col("bucket"))), F.lit(END)).alias("at"),
                F.coalesce(F.max(F.when(upto <= F.col("rest"), upto)), F.max("below")).alias("below"),
            ),
            "mix-cuts",
        )
        if digits < DIGITS:
            keyed = _joined(keyed, cuts.select(*names, F.col("at").alias("_at")), names, n_leaves)
            keyed = keyed.where(F.col("key").startswith(F.col("_at"))).drop("_at")
    inside = _joined(keyed, cuts, names, n_leaves).where(F.col("key").startswith(F.col("at")))
    inside = inside.groupBy(*names, "rest", "below", "key").agg(F.sum("_tokens").alias("t"))
    run = F.sum("t").over(W.partitionBy(*names).orderBy("key").rowsBetween(W.unboundedPreceding, 0))
    inside = inside.withColumn("run", run).where("below + run <= rest").groupBy(*names).agg(F.max("key").alias("last"))
    # without a key that fits in the cut bucket, the cut lies at its lower edge
    cut = cuts.join(inside, names, "left").select(*names, F.coalesce("last", "at").alias("cut"))
    return written(plan.join(cut, names, "left").drop("rest"), "mix-plan")


def mixed(docs: DataFrame, path: dict[str, Column], plan: DataFrame, seed: int = 0, id_col: str = "doc_id") -> DataFrame:
    """(row, copies): the documents, each as one struct, and how often the plan takes it."""
    names = list(path)
    given = plan.select(*names, "full_epochs", "cut")
    rows = docs.select(
        F.struct("*").alias("row"),
        docs[id_col].alias("id"),
        *(F.coalesce(c.cast("string"), F.lit("")).alias(f"p{i}") for i, c in enumerate(path.values())),
    )
    keys = [f"p{i}" for i in range(len(names))]
    out = _joined(rows, given.toDF(*keys, "full_epochs", "cut"), keys, plan.count())
    last = (_seeded(F.col("id"), F.col("full_epochs"), seed) <= F.col("cut")).cast("long")
    return out.select("row", (F.col("full_epochs") + F.coalesce(last, F.lit(0))).alias("copies"))


def mix(
    docs: DataFrame,
    path: dict[str, Column],
    plan: DataFrame,
    seed: int = 0,
    id_col: str = "doc_id",
    name: str = "_copies",
) -> DataFrame:
    """docs with the column `name`: how often the plan takes each row, 0 for rows it leaves. A
    column of docs with that name raises."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name!r} already")
    return mixed(docs, path, plan, seed, id_col).select("row.*", F.col("copies").alias(name))
