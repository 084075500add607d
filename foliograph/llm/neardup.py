"""Problem 3: near-duplicate records among all records, by a MinHash LSH forest.

A record is the set of its distinct words.  Equal sets are one class, named by
a hash of the set and not by any record.  Each class has one label for each
tree, a sequence of minima; the labels of a tree, sorted, are a prefix trie.
Labels are shortened adaptively: a class meets the others below its shortest
prefix whose subtree is small, and in crowded subtrees the prefix is no longer
than the one that meets pairs at the threshold with the target probability.
Sizes and a parity sketch discard only candidates that can't reach the
threshold; the words themselves decide about the rest.

Subtrees and classes of more than ``SPLIT`` rows are cut into blocks that are
joined block by block, so that no task holds a hot group.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import minhash
from .common import shared_table, spread
from .textform import LOOKALIKES, plain_form

#: Jaccard similarity of word sets; probability of meeting a pair that is just so alike.
ALIKE, TARGET = 0.8, 0.9993
#: Trees, and minima in a label.
TREES, LABEL = 24, 8
#: Prefixes are shortened by at most so many minima below the target's, while their subtree has at most so many classes.
SHORTER, SPARSE = 2, 8
#: Rows of one group that a task joins with each other; larger groups are split, over so many salts.
SPLIT, SALTS = 256, 64
#: Bits of the sketch.
SKETCH = 64

_WORD = re.compile(r"[^\W_]+")
_FOREIGN = re.compile("[" + "".join(LOOKALIKES) + "]")


def depth(alike: float = ALIKE, trees: int = TREES, label: int = LABEL, target: float = TARGET) -> int:
    """The longest prefix at which the trees meet pairs of similarity ``alike`` with probability ``target``."""
    for k in range(label, 0, -1):
        if 1 - (1 - alike**k) ** trees >= target:
            return k
    raise ValueError("there are too few trees for this target")


class _Words(dict):
    """Blank-separated tokens to their words; emptied at half a million entries."""

    def __missing__(self, token: str) -> list[str]:
        got = _WORD.findall(plain_form(token).lower())
        if len(token) <= 64:
            if len(self) >= 500_000:
                self.clear()
            self[token] = got
        return got


def word_set(text: str | None, memo: _Words) -> list[str]:
    """Sorted distinct words of the plain form of ``text``; the whole text is used."""
    if not text:
        return []
    out: set[str] = set()
    for token in set((plain_form(text) if _FOREIGN.search(text) else text).split()):
        out.update(memo[token])
    return sorted(out)


def word_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``words`` (sorted, distinct, parted by blanks) and ``set`` (their 128-bit hash) of each record; records without words left out."""
    src = spread(df.select(F.col(key).alias("id"), F.col(text).alias("text")))
    kind = src.schema["id"].dataType.simpleString()
    memo = _Words()

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                part = whole.slice(at, 2000)
                sets = [" ".join(word_set(t, memo)) for t in part.column(1).to_pylist()]
                keep = [i for i, s in enumerate(sets) if s]
                if keep:
                    own = [xxhash.xxh3_128_digest(sets[i]) for i in keep]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), pa.array([sets[i] for i in keep], pa.string()), pa.array(own, pa.binary())], names=["id", "words", "set"])

    return src.mapInArrow(run, f"id {kind}, words string, set binary")


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A sketch of each set: which of its ``SKETCH`` shares by hash hold an odd number of items; two differ in no more bits than the sets in items."""
    flat = np.concatenate(sets).astype(np.uint64)
    share = ((flat * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.int64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = np.bincount(row * SKETCH + share, minlength=len(sets) * SKETCH).reshape(len(sets), SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64).reshape(-1)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        got = self[word] = minhash.hash31(word)
        return got


def labels(sets: DataFrame, trees: int, most: int, shorter: int) -> DataFrame:
    """One row for each class and tree: ``root`` (tree and the shortest prefix), ``rest`` (16 bits of each further minimum up to ``most``, first one highest), ``n``, ``sketch``, ``sid``."""
    a, b = minhash.coefficients(trees * most)
    least = max(1, most - shorter)
    draw = np.random.default_rng(11)
    weights, salt = draw.integers(1, 1 << 62, (trees, least), dtype=np.uint64) | np.uint64(1), draw.integers(0, 1 << 62, trees, dtype=np.uint64)
    hashes = _Hashes()

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                # equal hashes of different words may only bring more candidates: a set of hashes loses none
                sets = [np.array([hashes[w] for w in ws.split(" ")], np.int64) for ws in part.column(1).to_pylist()]
                own = np.array([int.from_bytes(x[:8], "big", signed=True) for x in part.column(0).to_pylist()], np.int64)
                sig = minhash.signatures([s.astype(np.uint64) for s in sets], a, b).astype(np.uint64).reshape(len(sets), trees, most)
                mixed = (sig[:, :, :least] * weights).sum(2, dtype=np.uint64) + salt
                root = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64).reshape(-1)
                rest = np.zeros((len(sets), trees), np.int64)
                for k in range(least, most):
                    rest = rest << 16 | (sig[:, :, k] & np.uint64(0xFFFF)).astype(np.int64)
                n, sketch = np.array([len(s) for s in sets], np.int32), parities(sets)
                yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(rest.reshape(-1)), *(pa.array(np.repeat(x, trees)) for x in (n, sketch, own))], names=["root", "rest", "n", "sketch", "sid"])

    return sets.select("set", "words").mapInArrow(run, "root long, rest long, n int, sketch long, sid long")


def nodes(entries: DataFrame, steps: int, sparse: int) -> DataFrame:
    """``entries`` with the ``node`` of the trie at which each class meets others, and the ``size`` of its subtree; the rows of a node stand together.

    All counts are windows over one partitioning by root; a root's rows are of
    fixed size and are only counted.
    """
    counted = entries.withColumns({f"p{k}": F.shiftright("rest", 16 * (steps - k)) for k in range(1, steps + 1)})
    for k in range(steps, -1, -1):  # the longest prefix first: its order serves the shorter ones
        counted = counted.withColumn(f"c{k}", F.count(F.lit(1)).over(Window.partitionBy("root", *[f"p{j}" for j in range(1, k + 1)])))
    at, size, node = F.lit(steps), F.col(f"c{steps}"), F.col(f"p{steps}") if steps else F.lit(0).cast("long")
    for k in range(steps - 1, -1, -1):
        small = F.col(f"c{k}") <= sparse
        at, size, node = F.when(small, F.lit(k)).otherwise(at), F.when(small, F.col(f"c{k}")).otherwise(size), F.when(small, F.col(f"p{k}") if k else F.lit(0).cast("long")).otherwise(node)
    own = counted.select("root", (node * (steps + 1) + at).alias("node"), size.alias("size"), "n", "sketch", "sid").where("size > 1")
    return own.sortWithinPartitions("root", "node")


_MET = "x long, y long, root long, node long, size long, n int, sketch long"


def meet(forest: DataFrame, alike: float) -> DataFrame:
    """Possible pairs ``x``, ``y`` below the nodes of a forest; rows of nodes of over ``SPLIT`` classes come out as they are, with a null ``y``."""
    split = SPLIT

    def pairs_of(c: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        root, node, _, n, sketch, sid = c
        begin = np.flatnonzero(np.concatenate([[True], (root[1:] != root[:-1]) | (node[1:] != node[:-1])]))
        size = np.diff([*begin, len(root)])
        # each row meets those after it in its node
        after = np.repeat(begin + size, size) - np.arange(len(root)) - 1
        i = np.repeat(np.arange(len(root)), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        i, j = (v[low >= alike * high - 1e-6] for v in (i, j))
        differing = np.bitwise_count(sketch[i].view(np.uint64) ^ sketch[j].view(np.uint64)).astype(np.int64)
        ok = ((1 + alike) * differing <= (1 - alike) * (n[i].astype(np.int64) + n[j]) + 1e-6) & (sid[i] != sid[j])
        return np.minimum(sid[i], sid[j])[ok], np.maximum(sid[i], sid[j])[ok]

    def out(x, y, rest: list[np.ndarray] | None) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        own = [pa.nulls(len(x), k) for k in kinds] if rest is None else [pa.array(v, k) for v, k in zip(rest, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.nulls(len(x), pa.int64()) if y is None else pa.array(y, pa.int64()), *own], names=["x", "y", "root", "node", "size", "n", "sketch"])

    def run(batches):
        held: list[np.ndarray] | None = None  # the last node so far, of ``split`` rows at most
        for b in batches:
            if not b.num_rows:
                continue
            c = [b.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            hot = c[2] > split
            if hot.any():
                yield out(c[5][hot], None, [v[hot] for v in c[:5]])
                c = [v[~hot] for v in c]
            if held is not None:
                c = [np.concatenate([h, v]) for h, v in zip(held, c, strict=True)]
            if not len(c[0]):
                continue
            last = (c[0] == c[0][-1]) & (c[1] == c[1][-1])
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            held = [v[cut:] for v in c]
            if cut:
                yield out(*pairs_of([v[:cut] for v in c]), None)
        if held is not None and len(held[0]):
            yield out(*pairs_of(held), None)

    return forest.mapInArrow(run, _MET)


def within(rows: DataFrame, group: list[str], key: str, possible: Column | None = None) -> DataFrame:
    """``x`` and ``y``, the keys of all pairs of rows of a group (of ``size`` rows) that are ``possible`` (over aliases a, b).

    Groups of up to ``SPLIT`` rows are joined with themselves; larger ones are
    cut into blocks, and every two blocks meet in a place of their own.
    """
    ok = F.lit(True) if possible is None else possible

    def join(left: DataFrame, right: DataFrame, on: list[str], rule: Column) -> DataFrame:
        a, b = left.alias("a"), right.alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
        cond = same[0]
        for c in [*same[1:], rule, ok]:
            cond = cond & c
        return a.join(b, cond).select(F.least(f"a.{key}", f"b.{key}").alias("x"), F.greatest(f"a.{key}", f"b.{key}").alias("y"))

    small = rows.where((F.col("size") > 1) & (F.col("size") <= SPLIT))
    blocks = F.ceil(F.col("size") / SPLIT).cast("int")
    hot = rows.where(F.col("size") > SPLIT).withColumn("block", F.pmod(F.xxhash64(key), blocks).cast("int"))
    left = hot.select("*", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("low"), F.col("block").alias("high"))
    right = hot.select("*", F.explode(F.sequence(F.col("block"), blocks - 1)).alias("high"), F.col("block").alias("low"))
    rising = F.col(f"a.{key}") < F.col(f"b.{key}")
    apart = (F.col("a.low") != F.col("a.high")) | rising
    return join(small, small, group, rising).unionByName(join(left, right, [*group, "low", "high"], apart))


def _possible(alike: float) -> Column:
    """Whether rows ``a`` and ``b`` can be ``alike`` by their sizes and sketches; true of every pair that is."""
    n, m = F.col("a.n"), F.col("b.n")
    differing = F.bit_count(F.col("a.sketch").bitwiseXOR(F.col("b.sketch")))
    slack = 1e-6  # for rounding
    return (F.least(n, m) >= alike * F.greatest(n, m) - slack) & ((1 + alike) * differing <= (1 - alike) * (n + m) + slack)


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two columns of sorted distinct items."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def near_duplicates(df: DataFrame, key: str, text: str, alike: float = ALIKE) -> tuple[DataFrame, DataFrame]:
    """``base`` (id, set: one row for each record and text) and ``links`` (set_a, set_b, similarity) between different sets.

    Records whose text is null, empty or without words are in no class; a
    record delivered twice is one member, and with two texts a member of both
    classes; ties, other columns and empty tables do no harm.  A pair just at
    the threshold is met with probability ``TARGET`` or more.
    """
    most = depth(alike)
    shorter = min(SHORTER, most - 1)
    base = shared_table(word_sets(df, key, text))
    sets = base.select("set", "words").dropDuplicates(["set"])
    found = shared_table(meet(nodes(labels(sets, TREES, most, shorter), shorter, SPARSE), alike))
    hot = found.where(F.col("y").isNull()).drop("y").withColumnRenamed("x", "sid")
    met = found.where(F.col("y").isNotNull()).select("x", "y").unionByName(within(hot, ["root", "node"], "sid", _possible(alike))).distinct()
    # the 64-bit number of a set only finds its row; the row brings the set itself
    own = sets.select(_sid("set").alias("sid"), "set", "words")
    with_a = met.join(own.select(F.col("sid").alias("x"), F.col("set").alias("set_a"), F.col("words").alias("words_a")), "x")
    both = with_a.join(own.select(F.col("sid").alias("y"), F.col("set").alias("set_b"), F.col("words").alias("words_b")), "y")
    links = both.select("set_a", "set_b", jaccard(F.split("words_a", " "), F.split("words_b", " ")).alias("similarity")).where(F.col("similarity") >= alike)
    return base.select("id", "set").distinct(), links


def _sid(column: str) -> Column:
    """The first eight bytes of a binary column as a number."""
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, -10).cast("long")


def classes(base: DataFrame, links: DataFrame) -> DataFrame:
    """``id``, ``set``, ``class`` (smallest id of the set), ``size``, ``links`` (sets linked to it), ``salt``.

    Sets of more than ``SPLIT`` records are met under salted keys, so that no
    task gets them whole; ``salt`` is 0 for the others.
    """
    ends = links.select(F.explode(F.array("set_a", "set_b")).alias("set")).groupBy("set").agg(F.count(F.lit(1)).alias("links"))
    sizes = base.groupBy("set").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("size")).join(ends, "set", "left").withColumn("links", F.coalesce("links", F.lit(0).cast("long")))
    hot = sizes.where(F.col("size") > SPLIT).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    marked = base.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(hot, ["set", "salt"], "left")
    rest = marked.where(F.col("size").isNull()).select("set", "id").join(sizes.where(F.col("size") <= SPLIT), "set").withColumn("salt", F.lit(0))
    return marked.where(F.col("size").isNotNull()).unionByName(rest)


def pairs(df: DataFrame, key: str, text: str, alike: float = ALIKE) -> DataFrame:
    """All pairs ``a`` < ``b`` of different records at least ``alike``, copies included; no row twice."""
    base, links = near_duplicates(df, key, text, alike)
    members = shared_table(classes(base, links.limit(0)).select("set", "id", "size", "salt"))
    copies = within(members, ["set"], "id")
    hot = members.where(F.col("size") > SPLIT).select("set").distinct().withColumn("salts", F.sequence(F.lit(0), F.lit(SALTS - 1)))
    linked = links.select("set_a", "set_b")
    for side in ("a", "b"):
        named = lambda d: d.withColumnsRenamed({"set": f"set_{side}", "id": f"id_{side}"})  # noqa: B023, E731
        salted = linked.join(named(hot), f"set_{side}", "left").withColumn("salt", F.explode(F.coalesce("salts", F.array(F.lit(0))))).drop("salts")
        linked = salted.join(named(members.select("set", "salt", "id")), [f"set_{side}", "salt"]).drop("salt")
    linked = linked.where("id_a != id_b").select(F.least("id_a", "id_b").alias("x"), F.greatest("id_a", "id_b").alias("y"))
    return copies.unionByName(linked).distinct().select(F.col("x").alias("a"), F.col("y").alias("b"))


def groups(df: DataFrame, key: str, text: str, alike: float = ALIKE) -> DataFrame:
    """One row for each record and text: ``id``, ``class`` (smallest id with the same words), ``size`` of the class and the number of ``links`` to other classes."""
    base, links = near_duplicates(df, key, text, alike)
    return classes(base, links).select("id", "class", "size", "links")
