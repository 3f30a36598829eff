"""Near duplicates by SimHash, linked by a self-join of a binary trie over the fingerprints.

The distinct fingerprints form a binary trie. A pair of nodes is traversed together: the bits
in which their common prefixes differ add up, and the pair is dropped when they exceed the
budget. Two nodes whose bits can differ in no more places than the budget allows, below as
well, are linked as a whole. The upper levels are traversed on the driver, over counts per
prefix (at most 2^TOP_BITS numbers); each pair of subtrees small enough then becomes one task,
which goes on in numpy over path-compressed subtrees. A task returns a spanning star per group
of its linked fingerprints, never all pairs, and the stars are joined to components.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from .common import need_columns, written
from .components import components
from .packed import pack_sorted, unpack_sorted

#: Levels of the trie whose counts come to the driver.
TOP_BITS = 12
#: Fingerprints of two subtrees that one task takes, unless TOP_BITS is reached.
TASK_SIZE = 65_536
#: Partitions over which the pairs of subtrees are dealt, at most.
MAX_TASKS = 10_000
#: Node pairs that a task handles at once, and links that it holds before it merges them.
CHUNK = 1 << 17

_hash = partial(xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    k = min(n, shingle)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    starts = np.cumsum(sizes + 1) - sizes - 1
    a, b = starts[: n - k + 1].tolist(), (starts + sizes)[k - 1 :].tolist()
    h = np.fromiter(map(_hash, map(joined.__getitem__, map(slice, a, b))), np.uint64, len(a))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 32_768):
        bits = np.unpackbits(h[i : i + 32_768].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


class Trie:
    """A path-compressed binary trie over sorted distinct fingerprints.

    Nodes 0 to n-1 are the fingerprints; then inner nodes. `bits` is the length of the prefix
    that all fingerprints below a node share, `lo` and `hi` are its range.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        size = max(2 * n - 1, 1)
        self.bits = np.full(size, 64, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.lo = np.arange(size)
        self.hi = np.arange(size) + 1
        if n:
            diff = values[1:] ^ values[:-1]
            # number of leading bits that neighbours share
            same = 64 - np.ceil(np.log2(diff.astype(np.longdouble) + 1)).astype(np.int64)
            self._build(same.tolist(), n)
        self.rep = values[self.lo] if n else values
        self._extremes(n)

    def _build(self, same: list[int], n: int) -> None:
        stack: list[tuple[int, int]] = []  # (prefix shared with what follows, node)
        node, free = 0, n
        left, right, bits, lo, hi = self.left, self.right, self.bits, self.lo, self.hi
        for i in range(1, n + 1):
            s = same[i - 1] if i < n else -1
            while stack and stack[-1][0] > s:
                b, other = stack.pop()
                left[free], right[free], bits[free] = other, node, b
                lo[free], hi[free] = lo[other], hi[node]
                node, free = free, free + 1
            stack.append((s, node))
            node = i
        self.root = stack[0][1] if stack else 0

    def _extremes(self, n: int) -> None:
        """Bits set in all, and in any, of the fingerprints below each node."""
        self.all = self.values[np.minimum(self.lo, max(n - 1, 0))].copy() if n else self.values
        self.any = self.all.copy()
        for i in range(n, 2 * n - 1):  # children come before their parent
            a, b = self.left[i], self.right[i]
            self.all[i] = self.all[a] & self.all[b]
            self.any[i] = self.any[a] | self.any[b]


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (the smallest member's index) after further links."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def linked(values: np.ndarray, split: int | None, budget: int) -> np.ndarray:
    """Labels of the groups that links of at most `budget` bits make of sorted distinct values.

    With `split`, only links between values[:split] and values[split:] are looked for.
    """
    n = len(values)
    label = np.arange(n)
    if n < 2:
        return label
    t = Trie(values)
    if split is None:
        stack = [(np.array([t.root]), np.array([t.root]))]
    else:
        # both sides are subtrees of the whole: the smallest nodes that cover them
        def cover(lo: int, hi: int) -> int:
            return int(np.flatnonzero((t.lo == lo) & (t.hi == hi))[0])

        if not 0 < split < n:
            return label
        stack = [(np.array([cover(0, split)]), np.array([cover(split, n)]))]
    links: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def uniform() -> np.ndarray:
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        return np.where(change[t.hi - 1] == change[t.lo], label[t.lo], -1)

    whole = uniform()
    while stack:
        u, v = stack.pop()
        if len(u) > CHUNK:
            stack.append((u[CHUNK:], v[CHUNK:]))
            u, v = u[:CHUNK], v[:CHUNK]
        # bits that are constant below both nodes, their prefixes among them
        fixed = ~((t.any[u] ^ t.all[u]) | (t.any[v] ^ t.all[v]))
        keep = np.bitwise_count((t.rep[u] ^ t.rep[v]) & fixed) <= budget
        same = (whole[u] >= 0) & (whole[u] == whole[v])
        keep &= ~same
        u, v = u[keep], v[keep]
        if not len(u):
            continue
        most = np.bitwise_count((t.any[u] | t.any[v]) & ~(t.all[u] & t.all[v]))
        near = most <= budget
        for a, b in zip(u[near].tolist(), v[near].tolist(), strict=True) if near.any() else ():
            ends = np.concatenate([np.arange(t.lo[a], t.hi[a]), np.arange(t.lo[b], t.hi[b])])
            links.append((np.full(len(ends), t.lo[a]), ends))
            held += len(ends)
        u, v = u[~near], v[~near]
        if held > CHUNK or len(links) > 4096:
            label = _merged(label, *(np.concatenate(x) for x in zip(*links, strict=True)))
            links, held = [], 0
            whole = uniform()
        if not len(u):
            continue
        own = u == v
        by_u = (t.bits[u] <= t.bits[v]) & ~own
        by_v = ~by_u & ~own
        o, x, y = u[own], (u[by_u], v[by_u]), (u[by_v], v[by_v])
        new_u = [t.left[o], t.right[o], t.left[o], t.left[x[0]], t.right[x[0]], y[0], y[0]]
        new_v = [t.left[o], t.right[o], t.right[o], x[1], x[1], t.left[y[1]], t.right[y[1]]]
        u, v = np.concatenate(new_u), np.concatenate(new_v)
        leaf = (u == v) & (u < n)
        if len(u):
            stack.append((u[~leaf], v[~leaf]))
    if links:
        label = _merged(label, *(np.concatenate(x) for x in zip(*links, strict=True)))
    return label


def trie_tasks(counts: dict[int, int], top: int, budget: int, size: int) -> list[tuple[int, int, int]]:
    """Pairs of subtrees (depth, prefix a, prefix b) whose links one task looks for."""
    levels: list[dict[int, int]] = [dict(counts)]
    for _ in range(top):
        up: dict[int, int] = {}
        for p, c in levels[0].items():
            up[p >> 1] = up.get(p >> 1, 0) + c
        levels.insert(0, up)
    out, stack = [], [(0, 0, 0)] if counts else []
    while stack:
        d, a, b = stack.pop()
        if (a ^ b).bit_count() > budget:
            continue
        if d == top or levels[d][a] + (a != b) * levels[d][b] <= size:
            out.append((d, a, b))
            continue
        kids = [(a << 1, b << 1), (a << 1 | 1, b << 1 | 1), (a << 1, b << 1 | 1)]
        if a != b:
            kids.append((a << 1 | 1, b << 1))
        stack += [(d + 1, x, y) for x, y in kids if x in levels[d + 1] and y in levels[d + 1]]
    return out


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, the columns in more, fp) per row; fp is the fingerprint as a signed long."""
    need_columns(docs, id_col, text_col)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), *(docs[n] for n in more), docs[text_col].alias("text"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(b.num_columns - 1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], [*b.schema.names[:-1], "fp"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def linked_fingerprints(fps: DataFrame, max_bits: int = 4, top_bits: int = TOP_BITS, task_size: int = TASK_SIZE) -> DataFrame:
    """(node, root) of every distinct fingerprint that is within max_bits of another one."""
    spark = fps.sparkSession
    prefix = lambda depth: F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    counts = dict(fps.groupBy(prefix(top_bits).alias("p")).count().collect())
    tasks = trie_tasks(counts, top_bits, max_bits, task_size)
    used = sorted({(d, p) for d, a, b in tasks for p in (a, b)})
    depths = sorted({d for d, _ in used}) or [0]
    node = F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), prefix(d).alias("prefix")) for d in depths)))
    rows = fps.select("fp", node.alias("n")).select("fp", "n.depth", "n.prefix")
    wanted = spark.createDataFrame(used, "depth int, prefix long")

    def packed(group: pa.Table) -> pa.Table:
        values = np.sort(group.column("fp").to_numpy().view(np.uint64))
        one = {n: group.column(n)[:1] for n in ("depth", "prefix")}
        return pa.table(one | {"fps": pa.array([pack_sorted(values)], pa.binary())})

    # a subtree is one row, so a pair of them is one row, too
    nodes = rows.join(wanted, ["depth", "prefix"]).groupBy("depth", "prefix")
    nodes = written(nodes.applyInArrow(packed, "depth int, prefix long, fps binary"), "fingerprint-nodes")
    pairs = spark.createDataFrame([(k, *t) for k, t in enumerate(tasks)], "task long, depth int, a long, b long")
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select("depth", F.col("prefix").alias(side), F.col("fps").alias(f"fps_{side}")), ["depth", side])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                x, y = (unpack_sorted(b.column(f"fps_{n}")[i].as_py()) for n in ("a", "b"))
                own = b.column("a")[i] == b.column("b")[i]
                fp = x if own else np.concatenate([x, y])  # the smaller prefix comes first
                label = linked(fp, None if own else len(x), max_bits)
                far = np.flatnonzero(label != np.arange(len(fp)))
                signed = fp.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed[far]), pa.array(signed[label[far]])], ["a", "b"])

    spread = pairs.repartition(max(1, min(len(tasks), MAX_TASKS)), "task")
    return components(spread.mapInArrow(run, "a long, b long"))


def _rooted(rows: DataFrame, rank: Column, max_bits: int) -> DataFrame:
    """(fp, least, root) per distinct fingerprint: its smallest rank and its component's fingerprint."""
    distinct = written(rows.groupBy("fp").agg(F.min(rank).alias("least")), "distinct-fingerprints")
    groups = written(linked_fingerprints(distinct.select("fp"), max_bits), "fingerprint-groups")
    return distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def simhash_components(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most max_bits bits, the
    row's own included. A text of fewer words than the shingle is one shingle; texts without
    words, null texts among them, have fingerprint zero and are linked like any other. Null ids
    are no component_id unless a component has no other. Repeated rows share a component. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    tagged = _rooted(rows, F.col("doc_id"), max_bits)
    least = tagged.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = tagged.join(least, "root").select(F.col("fp").alias("g_fp"), "component_id")
    return rows.join(by_fp, rows["fp"] == by_fp["g_fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents, with all columns, of which one row per component stays: that with the
    smallest id, null ids last, and of several with that id the smallest hash of the text. Of
    rows that repeat both id and text any one stays.
    """
    need_columns(docs, id_col, text_col)
    number = F.coalesce(docs[id_col].cast("long").cast("string"), F.lit(""))
    text = F.coalesce(F.concat(F.lit(" "), docs[text_col]), F.lit(""))
    key = F.unhex(F.sha2(F.concat(number, text).cast("binary"), 256)).alias("key")
    few = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), key)
    rows = written(fingerprints(few, shingle, more=("key",)), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    least = _rooted(rows, rank, max_bits).groupBy("root").agg(F.min("least").alias("least"))
    keep = least.select("least.key", "root")
    # the documents' own columns travel as one struct, so that none can clash
    keyed = docs.select(F.struct("*").alias("row"), key)
    return keyed.join(keep, "key").dropDuplicates(["root"]).select("row.*")
