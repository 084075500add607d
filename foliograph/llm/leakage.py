"""Problem 7: test items whose passages stand in training documents.

Per shard of documents (one Arrow batch) a suffix array over words is built by
prefix doubling, as deep as the longest test text; every suffix of the test
items is binary-searched in it, which gives all places where a shared run
begins.  Places that follow each other make one verbatim match, so each
document and item has its longest match with both locations.  Documents never
move.  The test set goes to the shards in blocks of a bounded number of words,
each block in a pass of its own, so that its size is not limited.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import spread
from .textform import LOOKALIKES, plain_form

#: Words in a row that make a leak.
RUN = 10
#: Words of test text that one pass over the documents holds in a worker; more test text takes more passes.
BLOCK_WORDS = 2_000_000

_WORD = re.compile(r"[^\W_]+")
_GREEK = re.compile("[α-ω]")
_LATIN = re.compile("[a-z]")


@lru_cache(1)
def _twins() -> tuple[dict[int, str], dict[int, str]]:
    """Latin letters for look-alikes of scripts other than Greek, and for small Greek letters whose capitals look Latin."""
    others = {ord(k.lower()): v.lower() for k, v in LOOKALIKES.items() if not "Ͱ" <= k <= "Ͽ"}
    greek = {ord(k.lower()): v.lower() for k, v in LOOKALIKES.items() if "Α" <= k <= "Ω"}
    return others | {ord("đ"): "d", ord("ð"): "d"}, greek


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, without regard to case, accents and look-alike characters.

    A capital look-alike and the capital of a Greek letter are one character,
    so within a word of Latin letters both have the Latin letter's class.
    """
    if not text:
        return []
    t = plain_form(text).casefold()
    if t.isascii():
        return _WORD.findall(t)
    others, greek = _twins()
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).casefold().translate(others)
    found = _WORD.findall(t)
    return [w.translate(greek) if _GREEK.search(w) and _LATIN.search(w) else w for w in found] if _GREEK.search(t) else found


class _Numbers(dict):
    """Blank-separated tokens to the bytes of their word numbers; emptied at half a million entries."""

    def __init__(self, number: dict[str, int]):
        self.number = number

    def __missing__(self, token: str) -> bytes:
        got = np.array([self.number.get(w, 0) for w in words(token)], np.int32).tobytes()
        if len(token) <= 64:
            if len(self) >= 500_000:
                self.clear()
            self[token] = got
        return got


class TestSet:
    """Test texts as one array of word numbers, with the start of each suffix of ``run`` words or more."""

    __test__ = False

    def __init__(self, texts: Iterable[tuple[object, int, list[str]]], run: int = RUN):
        """``texts``: item id, field number, words."""
        self.run, self.number = run, {}
        self._memo = _Numbers(self.number)
        self.names: list = []
        stream: list[int] = []
        starts, texts_of, self.longest = [], [], run
        self.item, self.field, self.begin = [], [], []
        place: dict = {}
        for item, field, w in texts:
            if len(w) < run:
                continue
            if item not in place:
                place[item] = len(self.names)
                self.names.append(item)
            self.item.append(place[item])
            self.field.append(field)
            self.begin.append(len(stream))
            starts += range(len(stream), len(stream) + len(w) - run + 1)
            texts_of += [len(self.begin) - 1] * (len(w) - run + 1)
            stream += [self.number.setdefault(x, len(self.number) + 1) for x in w]
            stream.append(0)  # texts are parted by a word of no document
            self.longest = max(self.longest, len(w))
        self.stream = np.array([*stream, *[0] * run], np.int64)
        self.starts, self.text = np.array(starts, np.int64), np.array(texts_of, np.int64)
        self.item, self.field, self.begin = (np.array(x, np.int64) for x in (self.item, self.field, self.begin))
        grams = self.stream[self.starts[:, None] + np.arange(run)] if len(starts) else np.zeros((0, run), np.int64)
        # suffixes that begin alike are searched once
        self.grams, which = np.unique(grams, axis=0, return_inverse=True) if len(grams) else (grams, np.zeros(0, np.int64))
        which = which.reshape(-1)
        self.order = np.argsort(which, kind="stable")
        self.size = np.bincount(which, minlength=len(self.grams))
        self.first = np.cumsum(self.size) - self.size

    def ids(self, text: str | None) -> bytes:
        """The word numbers of ``text`` as bytes; 0 for words of no test text."""
        return b"".join(map(self._memo.__getitem__, text.split())) if text else b""


def suffix_array(a: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of the suffixes that begin there, compared in ``depth`` words or more.

    ``at`` holds every position whose word isn't 0, and 0 ends a suffix.
    Prefix doubling: the ranks of prefixes of h words order those of 2 h; it
    stops early once all ranks differ.
    """
    rank = a.copy()  # of a prefix of one word; 0 at places outside ``at``
    order, h = at[np.argsort(a[at], kind="stable")], 1
    while h < depth and len(at):
        beyond = np.zeros(len(a), np.int64)
        beyond[: max(0, len(a) - h)] = rank[h:]
        beyond[rank == 0] = 0
        key = rank[at] * (int(rank.max()) + 1) + beyond[at]
        by = np.argsort(key, kind="stable")
        order, k = at[by], key[by]
        fresh = np.concatenate([[1], (k[1:] != k[:-1]).astype(np.int64)]).cumsum()
        rank = np.zeros(len(a), np.int64)
        rank[order] = fresh
        h *= 2
        if fresh[-1] == len(at):
            break
    return order


def _bound(a: np.ndarray, sa: np.ndarray, grams: np.ndarray, upper: bool) -> np.ndarray:
    """Where each gram would stand in the suffix array: before or after the suffixes that begin with it."""
    run = grams.shape[1]
    left, right = np.zeros(len(grams), np.int64), np.full(len(grams), len(sa))
    while (open_ := left < right).any():
        mid = np.where(open_, (left + right) // 2, 0)
        diff = a[sa[mid][:, None] + np.arange(run)] - grams
        sign = diff[np.arange(len(diff)), (diff != 0).argmax(1)]
        go = (sign <= 0) if upper else (sign < 0)
        left, right = np.where(open_ & go, mid + 1, left), np.where(open_ & ~go, mid, right)
    return left


def _spans(n: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``n`` places from ``begin``: the number of the run and the place, one after the other."""
    return np.repeat(np.arange(len(n)), n), np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


def search(test: TestSet, texts: list[str | None]) -> dict[str, np.ndarray]:
    """Maximal verbatim matches in one shard: ``doc`` number, test ``text`` number, ``in_doc`` and ``in_text`` (words before it), ``length`` in words."""
    run = test.run
    raw = [test.ids(t) + b"\0\0\0\0" for t in texts]  # a word of no test text parts documents
    a = np.frombuffer(b"".join(raw) + bytes(4 * run), np.int32).astype(np.int64)
    begins = np.cumsum([0, *(len(r) // 4 for r in raw)])
    none = {k: np.zeros(0, np.int64) for k in ("doc", "text", "in_doc", "in_text", "length")}
    if not len(test.grams):
        return none
    # a word of no test text ends a suffix; passages of fewer than ``run`` words hold no match
    edge = np.flatnonzero(a == 0)
    for left, right in ((edge[:-1], edge[1:]), (np.array([-1]), edge[:1])):
        short = (right - left - 1 < run) & (right > left + 1)
        k, at = _spans((right - left - 1)[short], left[short] + 1)
        if len(at):
            a[at] = 0
    at = np.flatnonzero(a)
    if not len(at):
        return none
    sa = suffix_array(a, at, test.longest)
    lo, hi = _bound(a, sa, test.grams, False), _bound(a, sa, test.grams, True)
    gram, p = _spans(hi - lo, lo)
    if not len(gram):
        return none
    # each gram stands for all the test suffixes that begin with it
    hit, s = _spans(test.size[gram], test.first[gram])
    in_shard, suffix = sa[p][hit], test.order[s]
    # pairs of places on one diagonal that follow each other are one match
    diagonal = in_shard - test.starts[suffix]
    by = np.lexsort((in_shard, test.text[suffix], diagonal))
    x, d, t, s = in_shard[by], diagonal[by], test.text[suffix][by], suffix[by]
    new = np.concatenate([[True], (np.diff(x) != 1) | (np.diff(d) != 0) | (np.diff(t) != 0)])
    start = np.flatnonzero(new)
    length = np.diff([*start, len(x)]) + run - 1
    doc = np.searchsorted(begins, x[start], side="right") - 1
    return {"doc": doc, "text": t[start], "in_doc": x[start] - begins[doc], "in_text": test.starts[s[start]] - test.begin[t[start]], "length": length}


def load_tests(items: DataFrame, item: str, fields: list[str], run: int = RUN, block: int = BLOCK_WORDS) -> Iterator[TestSet]:
    """The test items in blocks of at most ``block`` words (or one item), read one after the other."""
    held, n = [], 0
    for r in items.select(item, *fields).distinct().toLocalIterator():
        if r[0] is None:
            continue
        mine = [(r[0], k, words(r[k + 1])) for k in range(len(fields))]
        size = sum(len(w) for _, _, w in mine)
        if held and n + size > block:
            yield TestSet(held, run)
            held, n = [], 0
        held += mine
        n += size
    yield TestSet(held, run)


def matches(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, fields: list[str], run: int = RUN, block: int = BLOCK_WORDS) -> DataFrame:
    """All maximal matches of ``run`` words or more: ``doc``, ``item``, ``field`` number, ``in_doc``, ``in_text`` (words before the match), ``length``.

    Null and empty texts share nothing; a repeated row gives its matches
    again; empty tables give no rows; items with a null id are skipped.
    """
    src = spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")))
    kinds = src.schema["doc"].dataType.simpleString(), items.schema[item].dataType.simpleString()
    item_type = to_arrow_type(items.schema[item].dataType)
    schema = f"doc {kinds[0]}, item {kinds[1]}, field int, in_doc long, in_text long, length long"

    def passing(sent) -> DataFrame:
        def run_(batches):
            test = sent.value
            for b in batches:
                m = search(test, b.column(1).to_pylist())
                if len(m["doc"]):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(m["doc"])), pa.array([test.names[i] for i in test.item[m["text"]]]).cast(item_type), pa.array(test.field[m["text"]].astype(np.int32)), *(pa.array(m[k]) for k in ("in_doc", "in_text", "length"))],
                        names=["doc", "item", "field", "in_doc", "in_text", "length"],
                    )

        return src.mapInArrow(run_, schema)

    sc = docs.sparkSession.sparkContext
    return reduce(DataFrame.unionAll, [passing(sc.broadcast(t)) for t in load_tests(items, item, fields, run, block)])


def leaks(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, fields: list[str], run: int = RUN, block: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document and item that share ``run`` consecutive words.

    Columns: ``doc``, ``item``, ``matches``, and of the longest one (the first
    of several) ``length``, ``field``, ``in_text`` and ``in_doc``.  A document
    delivered twice gives one row.
    """
    all_ = matches(docs, doc, text, items, item, fields, run, block).distinct()
    # numbers alone in the aggregate: the longest match first, then the earliest place
    best = F.min(F.struct((-F.col("length")).alias("l"), "field", "in_text", "in_doc"))
    g = all_.groupBy("doc", "item").agg(F.count(F.lit(1)).alias("matches"), best.alias("b"))
    return g.select("doc", "item", "matches", (-F.col("b.l")).alias("length"), "b.field", "b.in_text", "b.in_doc")


def without_leaks(docs: DataFrame, doc: str, found: DataFrame) -> DataFrame:
    """Documents that share no passage with any test item; documents with a null id can't be named and stay."""
    return docs.join(found.select(F.col("doc").alias(doc)).distinct(), doc, "left_anti")
