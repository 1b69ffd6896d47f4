"""N-gram Jaccard join by T-occurrence search.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches a threshold, that is when they share at least T shingles, T from their
sizes. The search looks for partners only where some can be:

1. Documents with equal sets are one class; its smallest id stands for it.
2. Linked sets differ in few elements: in at most d, a bound that follows from their size class.
   The hash space is cut into more than d parts, so that linked sets agree in the whole content of some
   part, and of the parts that a set fills in all but d. A row per document and part, the hash of its content, finds
   these. A set of which too few parts are shared by any other goes, which is repeated on what is left;
   classes that then share a part are put in one cluster. Only documents that are alike in large parts share enough,
   however many others share a passage with them. A set that leaves so many parts empty that it may agree with
   another one in empty parts alone sends rows for its empty parts, too.
3. A cluster is searched in tasks of bounded size. Inverted lists of the shingles
   are made; for each document the short ones are merged, the L longest ones
   are set aside (DivideSkip), documents met at least T - L times are probed for
   in the long lists by binary search, and those reaching T are linked.
   Clusters beyond ``BLOCK`` shingles are dealt out by size class and hash,
   and every pair of blocks whose sizes can link is one task, so that no task grows and no pair is left out.
   A task returns a spanning forest of its links, not the pairs.
4. The links' connected components.

A null or empty text and one without words have an empty set and link with nothing.
Rows with equal ids and equal texts get equal rows; rows with one id and several
texts are one node that has the links of each. A null id gets a null component
and links nothing. Further columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import slices, whole_texts, written
from probscope.llm.components import components
from probscope.llm.shingles import mix, shingle_sets

#: Size classes grow by this factor.
GROWTH = 1.5
#: Shingles that one task searches.
BLOCK = 1 << 21
#: A list this long is probed rather than merged.
LONG = 4096
#: Documents in clusters up to this many are sent to the tasks, more are joined.
SENT = 1 << 20


def set_sizes(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, digest): the size and a 128-bit digest of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                          pa.binary())], ["doc_id", "n", "digest"])

    return texts.mapInArrow(run, "doc_id long, n long, digest binary")


def schemes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """(least size of each size class, most elements in which linked sets differ whose smaller one is of the class)."""
    least = [1]
    while least[-1] <= largest:
        least.append(max(least[-1] + 1, int(least[-1] * GROWTH)))
    a = np.array(least[1:]) - 1
    return np.array(least[:-1]), (a + a * 100 // percent) * (100 - percent) // (100 + percent)


def contents(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, ...]:
    """For each filled part of each set: the set's number, its size class, the hash of the part's content, and of how
    many parts of the set and class any linked, different set has the same."""
    size = np.array([len(s) for s in sets])
    least, differ = schemes(percent, int(size.max(initial=1)))
    own = np.searchsorted(least, size, side="right") - 1
    # a set meets smaller ones in its own class, and in the one below if these may be there
    below = (size > 0) & (own > 0) & (-(-percent * size // 100) < least[own])
    number = np.concatenate([np.flatnonzero(size > 0), np.flatnonzero(below)])
    scheme = np.concatenate([own[size > 0], own[below] - 1])
    number, scheme = number[differ[scheme] > 0], scheme[differ[scheme] > 0]
    if not len(number):
        return (*(np.zeros(0, np.int64),) * 2, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    d = differ[scheme]
    parts = d + 3 + d // 8
    n = size[number]
    token = np.concatenate([sets[i] for i in number])
    row = np.repeat(np.arange(len(number)), n)
    part = ((token >> np.uint64(32)) * parts[row].astype(np.uint64)) >> np.uint64(32)
    change = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (row[1:] != row[:-1])))
    row, part = row[change], part[change]
    content = np.add.reduceat(mix(token + np.uint64(1)), change)
    need = np.bincount(row, minlength=len(number)) - d
    for i in np.flatnonzero(need <= 0):
        empty = np.setdiff1d(np.arange(parts[i]), part[row == i].astype(np.int64)).astype(np.uint64)
        row = np.concatenate([row, np.full(len(empty), i)])
        part, content = np.concatenate([part, empty]), np.concatenate([content, np.zeros(len(empty), np.uint64)])
        need[i] = 1
    place = mix((scheme[row].astype(np.uint64) << np.uint64(40)) + part + np.uint64(1))
    return number[row], scheme[row], mix(content ^ place), need[row]


def signatures(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, scheme, need, part): a row for each part of the set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            number, scheme, content, need = contents(shingle_sets(batch.column("text"), k), percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(number)), pa.array(scheme.astype(np.int16)),
                 pa.array(need.astype(np.int32)), pa.array(content.view(np.int64))], ["node", "scheme", "need", "part"])

    return texts.mapInArrow(run, "node long, scheme short, need int, part long")


def neighbours(parts: DataFrame, rounds: int = 3) -> DataFrame:
    """(a, b): each node that shares enough parts, and the smallest node that shares one of them."""
    others = "count(*) over (partition by part)"
    rows = written(parts.withColumn("others", F.expr(others)).where("others > 1").drop("others"), "parts")
    for _ in range(rounds):
        rows = rows.withColumn("shared", F.expr("count(*) over (partition by node, scheme)")).where("shared >= need")
        rows = rows.withColumn("others", F.expr(others)).where("others > 1").drop("shared", "others")
        rows = written(rows, "parts")
    return rows.select(F.col("node").alias("a"), F.expr("min(node) over (partition by part)").alias("b")).where("a != b")


def needed(a: np.ndarray, b: int, percent: int) -> np.ndarray:
    """The least overlap of sets of these sizes that link."""
    return -(-percent * (a + b) // (100 + percent))


def linked(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """The root of each of ``sets`` in a spanning forest of their links (of those between the two sides)."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order])
    side = side[order] if side is not None else None
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tokens = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(sets)), size)
    by = np.lexsort((owner, tokens))
    start = np.flatnonzero(np.append(True, tokens[by][1:] != tokens[by][:-1]))
    which = np.empty(len(tokens), np.int64)
    which[by] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(by))))
    listed = owner[by]  # inverted lists one after another, each in the order of size
    end = np.append(start[1:], len(by))
    first = np.cumsum(size) - size
    for x in range(1, len(sets)):
        mine = which[first[x]:first[x] + size[x]]
        begin, length = start[mine], end[mine] - start[mine]
        shared = length > 1
        t = -(-percent * int(size[x]) // 100)  # no partner needs less
        if shared.sum() < t:
            continue
        begin, length = begin[shared], length[shared]
        long = np.flatnonzero(length > LONG)
        long = long[np.argsort(-length[long], kind="stable")][:t - 1]
        short = np.ones(len(begin), bool)
        short[long] = False
        b, n = begin[short], length[short]
        met = listed[np.repeat(b - np.cumsum(n) + n, n) + np.arange(n.sum())]
        count = np.bincount(met, minlength=x)[:x]
        met = np.flatnonzero(count >= t - len(long))
        count = count[met]
        good = 100 * size[met] >= percent * size[x]
        if side is not None:
            good &= side[met] != side[x]
        met, count = met[good], count[good]
        for i in long:
            if not len(met):
                break
            of = listed[begin[i]:begin[i] + length[i]]
            at = np.searchsorted(of, met)
            count += of[np.minimum(at, len(of) - 1)] == met
        for y in met[count >= needed(size[met], int(size[x]), percent)].tolist():
            parent[root(x)] = root(y)
    out = np.empty(len(sets), np.int64)
    out[order] = [order[root(i)] for i in range(len(sets))]
    return out


def search(members: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links that span each group (g) of members (g, side, node, text)."""

    def run(table: pa.Table) -> pa.Table:
        parts = [shingle_sets(chunk, k) for chunk in table.column("text").chunks]
        nodes = np.array(table.column("node"), np.int64)
        side = np.array(table.column("side"), np.int64)
        found = linked([s for p in parts for s in p], percent, side if len(set(side.tolist())) > 1 else None)
        moved = np.flatnonzero(nodes != nodes[found])
        return pa.table({"a": nodes[moved], "b": nodes[found[moved]]})

    return members.groupBy("g").applyInArrow(run, "a long, b long")


def dealt(clusters: DataFrame, percent: int) -> DataFrame:
    """(node, g, side): the tasks that search each member of ``clusters`` (node, cluster, n)."""
    size = clusters.groupBy("cluster").agg(F.sum("n").alias("total"))
    rows = clusters.join(size, "cluster")
    total = rows.where(F.col("total") <= BLOCK).agg(F.sum("n")).first()[0] or 0
    bins = max(12, -(-int(total) * 2 // BLOCK))
    small = rows.where(F.col("total") <= BLOCK).select(
        "node", F.concat_ws("/", F.lit("bin"), F.pmod(F.xxhash64("cluster"), F.lit(bins)).cast("string")).alias("g"),
        F.lit(0).cast("long").alias("side"))
    # size classes: only equal and neighbouring ones can link; then blocks of about half a task
    cls: Column = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9)
    large = rows.where(F.col("total") > BLOCK).withColumn("class", cls)
    weight = large.groupBy("cluster", "class").agg(F.ceil(F.sum("n") * 2 / F.lit(BLOCK)).alias("blocks"))
    large = large.join(weight, ["cluster", "class"]).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
    own = F.struct("class", "block")
    next_blocks = weight.select("cluster", (F.col("class") - 1).alias("class"), F.col("blocks").alias("next"))
    last_blocks = weight.select("cluster", (F.col("class") + 1).alias("class"), F.col("blocks").alias("last"))
    other = lambda shift, n: F.transform(
        F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(n), F.lit(0)).cast("long")),
        lambda i: F.struct((F.col("class") + shift).alias("class"), i.alias("block")))
    wide = large.join(next_blocks, ["cluster", "class"], "left").join(last_blocks, ["cluster", "class"], "left")
    wide = wide.withColumn("other", F.explode(F.filter(
        F.concat(other(0, "blocks"), other(1, "next"), other(-1, "last")),
        lambda o: o["block"] < F.when(o["class"] == F.col("class"), F.col("blocks"))
        .when(o["class"] > F.col("class"), F.coalesce("next", F.lit(0))).otherwise(F.coalesce("last", F.lit(0))))))
    low, high = F.least(own, "other"), F.greatest(own, "other")
    text = lambda s: F.concat_ws(".", s["class"].cast("string"), s["block"].cast("string"))
    pairs = wide.select("node", F.concat_ws("/", F.col("cluster").cast("string"), text(low), text(high)).alias("g"),
                        F.when(own == low, 0).otherwise(1).cast("long").alias("side"))
    return small.union(pairs)


def join(docs: DataFrame, *, k: int = 4, percent: int = 85, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    texts = whole_texts(docs, id_col, text_col)
    sizes = written(set_sizes(texts, k), "sets")
    known = sizes.where("digest is not null and doc_id is not null")
    classes = written(known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                                                  F.count("*").alias("copies")), "classes")
    several = classes.where("copies > 1").select("digest", "node")
    copies = sizes.join(several, "digest").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("node")).alias("first"))
    copies = written(copies.where("not first").select("doc_id"), "copies")
    copies = F.broadcast(copies) if copies.count() <= SENT else copies
    parts = signatures(texts.where("doc_id is not null").join(copies, "doc_id", "left_anti"), k, percent)
    clusters = components(neighbours(parts))
    sized = classes.groupBy("node").agg(F.max("n").alias("n"))
    clusters = written(clusters.join(sized, "node").select("node", F.col("component").alias("cluster"), "n"), "clusters")
    tasks = written(dealt(clusters, percent), "tasks")
    tasks = F.broadcast(tasks) if tasks.count() <= SENT else tasks
    members = texts.join(tasks, texts["doc_id"] == tasks["node"]).select("g", "side", "node", "text")
    links = search(members, k, percent)
    found = components(links)
    node = sizes.join(several, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("node", "doc_id").alias("node"))
    return node.join(found, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node")).alias("component_id"))
