"""Problem 1: noise of scanned pages, found and repaired.

Words of all texts are counted.  Skip-gram vectors of the frequent words are
learned by factorising the positive pointwise mutual information of words and
context words over all texts, the matrix that skip-gram training with negative
samples factorises.  A rare word is linked to frequent words that plausible
glyph edits reach, with costs learned from how often each edit explains a rare
word; where it stands, the candidate that its neighbours' vectors, its
frequency and the edits' cost favour replaces it.  A frequent word that could
be a misreading of another is judged by the neighbours on both sides.  Page
furniture is found at the places where page numbers stand, which are learned
too; its openings find it inside questions.  What remains is joined and
reflowed into paragraphs.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import shared_table, spread
from .language import bare
from .textform import plain_form

#: A word is frequent from this count and this share of all words on; a misreading has at most RATIO of the true word's count.
LEAST, SHARE, RATIO = 8, 2e-6, 0.05
#: In context the true word must be so many times likelier, with this much support.
LIKELIER, SUPPORT = 50.0, 3
#: Context words (the most frequent ones), dimensions of the vectors, words on either side that count as context.
CONTEXTS, DIMENSIONS, WINDOW = 512, 64, 2
#: Mean fit of a rare word's correction in the accents alone to its neighbours below which the word is left alone.
FITS = 0.0
#: Cells of a page, in pixels; shares of page numbers that make a cell or a top margin furniture; lines of it at least.
CELL_W, CELL_H, FOOT_SHARE, HEAD_SHARE, CELL_LINES = 64, 16, 0.5, 0.1, 2
#: Share of a page's height that a top margin takes at most; share of different texts among its lines from which they don't recur.
MARGIN, RECURRING = 0.1, 0.5
#: Share of margin lines with which an opening counts as one of running titles.
OPENING_SHARE = 0.002

# Glyph confusions, misread form and true form.
GLYPHS = [
    ("li", "h"), ("ri", "n"), ("rn", "m"), ("ii", "u"), ("cl", "d"), ("vv", "w"), ("1", "i"), ("!", "i"), ("|", "i"), ("1", "l"), ("|", "l"), ("!", "l"),
    ("9", "g"), ("0", "o"), ("5", "s"), ("6", "b"), ("8", "b"), ("(", "c"), ("f", "t"), ("c", "e"), ("o'", "ơ"), ("u'", "ư"), ("o’", "ơ"), ("u’", "ư"), ("q", "g"), ("£", "e"), ("€", "e"),
]
# Characters that stand before a line's first word without belonging to it.
STRAY = re.compile(r"^\s*(?:>>|»|[|~^_`•¦]+|n(?= Câu))\s*(?=\S)")
_MARK = "-‐‑–—¬\xad"
_BROKEN = re.compile(rf"([^\W\d_][\w'’!|(\-]*)[{_MARK}][ \t]?$")
_NUMBER = re.compile(r"^\s*(?:[—–-]\s?\d{1,4}\s?[—–-]|\[\d{1,4}\]|(?:trang|page|tr\.?|p\.)\s?\d{1,4}(?:\s?/\s?\d{1,5})?|\d{1,4})\s*$", re.I)
_BESIDE = [
    re.compile(r"^\s*(?P<n>(?:[—–-]\s?\d{1,4}\s?[—–-]|\[\d{1,4}\]|(?:trang|page)\s?\d{1,4}(?:\s?/\s?\d{1,5})?|\d{1,4}))\s*(?:\||\.{3,}|\s{2,}|•|·)\s*(?P<t>\S.*)$", re.I),
    re.compile(r"^\s*(?P<t>\S.*?)(?:\s*\||\s*\.{3,}|\s{2,}|\s*•|\s*·)\s*(?P<n>(?:[—–-]\s?\d{1,4}\s?[—–-]|\[\d{1,4}\]|(?:trang|page)\s?\d{1,4}(?:\s?/\s?\d{1,5})?|\d{1,4}))\s*$", re.I),
]
_LETTER = re.compile(r"[^\W\d_]")
_VARIABLE = re.compile(r"^(?:\d+[a-z][²³]?|[a-z]\(.*|[a-z][²³]|-?\d[\d.,;/]*[a-zµμ]{0,2}[²³]?)$")


def core(token: str) -> str | None:
    """The word of a blank-separated token, in lower case; null for formulas, numbers and variables."""
    t = plain_form(token).strip(".,;:?\"“”…)]}*").lstrip("([{>")
    if not _LETTER.search(t) or any(c in t for c in "$\\^=<{}_"):
        return None
    low = t.lower()
    if t[-1] in _MARK:
        return None  # the first half of a broken word
    if len(low) < 2 or _VARIABLE.match(low) or (t.isascii() and t.isupper() and len(t) < 6):
        return None
    return low


class _Cores(dict):
    def __missing__(self, token: str) -> str | None:
        got = core(token)
        if len(self) > 500_000:
            self.clear()
        self[token] = got
        return got


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` over all texts, summed within batches before the shuffle."""

    def run(batches):
        cores, total = _Cores(), Counter()
        for b in batches:
            tokens: Counter = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    tokens.update(t.split())
            for k, n in tokens.items():
                if (c := cores[k]) is not None:
                    total[c] += n
            if len(total) > 200_000:
                yield _pairs(total)
                total = Counter()
        if total:
            yield _pairs(total)

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _pairs(c: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c.keys())), pa.array(list(c.values()), pa.int64())], names=["word", "n"])


class Lexicon:
    """Frequent words, links of rare words to them, and what the neighbours of words tell.

    Of bounded size: at most 1/``SHARE`` words, with a vector each, and at most
    20/``SHARE`` counts of neighbours, in arrays.
    """

    def __init__(self, known: dict[str, int]):
        self.known = known
        self.number = {w: k + 4 for k, w in enumerate(sorted(known, key=lambda w: (-known[w], w)))}  # 0 to 3 are classes
        self.longest = max(map(len, known), default=0)
        self.by_bare: dict[str, list[str]] = defaultdict(list)
        for w in known:
            self.by_bare[bare(w)].append(w)
        self.starts = {w[: i + 1] for w in known for i, c in enumerate(w) if c == "-"}
        self.near = np.zeros(0, np.int64), np.zeros(0, np.int64)  # keys of (word, side, neighbour), sorted, and counts
        self.vectors = np.zeros((len(known) + 4, DIMENSIONS), np.float16)
        self.contexts = np.zeros((CONTEXTS, DIMENSIONS), np.float32)
        self.costs = {e: 1.0 for e in GLYPHS}
        self.memo: dict[str, tuple[str, list[tuple[str, float]]]] = {}
        self._rivals: dict[str, list[str]] = {}
        self._judged: dict[tuple[str, str, str], str | None] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}, "_rivals": {}, "_judged": {}}

    def glyph_edits(self, w: str) -> Iterator[tuple[str, tuple]]:
        """All words that one glyph correction of ``w`` gives, with the correction."""
        for edit in GLYPHS:
            i = w.find(edit[0])
            while i >= 0:
                yield w[:i] + edit[1] + w[i + len(edit[0]) :], edit
                i = w.find(edit[0], i + 1)

    def glyph_candidates(self, w: str, depth: int = 2) -> dict[str, tuple]:
        """Frequent words that the fewest glyph corrections of ``w`` give, ``depth`` at most, then also in other accents, each with the cheapest corrections."""
        if len(w) > self.longest + depth:
            return {}  # each correction takes away one character at most
        seen: dict[str, tuple] = {w: ()}
        layer, cost = {w: ()}, lambda e: sum(self.costs[x] for x in e)
        for _ in range(depth):
            nxt: dict[str, tuple] = {}
            for x, done in layer.items():
                for y, edit in self.glyph_edits(x):
                    e = (*done, edit)
                    if y not in seen and (y not in nxt or cost(e) < cost(nxt[y])):
                        nxt[y] = e
            seen |= nxt
            layer = nxt
            if out := {y: e for y, e in nxt.items() if y in self.known}:
                return out
        out = {}
        for y, e in seen.items():
            if e:
                for c in self.accent_candidates(y):
                    if c not in out or cost(e) < cost(out[c]):
                        out[c] = e
        return out

    def accent_candidates(self, w: str) -> list[str]:
        """Frequent words that differ from ``w`` in the accents of one letter."""
        a = unicodedata.normalize("NFC", w)
        return [c for c in self.by_bare.get(bare(w), ()) if len(c) == len(a) and sum(x != y for x, y in zip(a, c, strict=True)) == 1]

    def status(self, w: str) -> tuple[str, list[tuple[str, float]]]:
        """('ok' | 'misread' | 'accent' | 'context' | 'unknown', candidates with the logarithm of how likely they are without context)."""
        got = self.memo.get(w)
        if got is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            got = self.memo[w] = self._status(w)
        return got

    def _status(self, w: str) -> tuple[str, list[tuple[str, float]]]:
        n = self.known.get(w, 0)
        enough = {c: e for c, e in self.glyph_candidates(w).items() if n <= RATIO * self.known[c]}
        if enough:
            return "misread", [(c, math.log(self.known[c]) - sum(self.costs[x] for x in e)) for c, e in enough.items()]
        if n:
            return ("context" if self.rivals(w) else "ok"), []
        near = self.accent_candidates(w)
        if near:
            return "accent", [(c, math.log(self.known[c])) for c in near]
        if "-" in w:  # a compound is as good as its parts
            parts = [(p, *self.status(p)) for p in w.split("-")]
            wrong = [s in ("misread", "accent") for p, s, _ in parts if len(p) > 1]
            if any(wrong) and all(s != "unknown" for p, s, _ in parts if len(p) > 1):
                return "misread", [("-".join(self.best(c) if c and len(p) > 1 else p for p, _, c in parts), 0.0)]
        return "unknown", []

    @staticmethod
    def best(candidates: list[tuple[str, float]]) -> str:
        """The likeliest candidate without context."""
        return max(candidates, key=lambda c: (c[1], c[0]))[0]

    def fits(self, words: list[str], around: list[str]) -> np.ndarray | None:
        """How well each word fits its neighbours, by their vectors: the mean information between it and each context word; null without context words."""
        places = [k for x in around if 0 <= (k := self.number.get(x, 3) - 4) < CONTEXTS]
        if not places:
            return None
        own = self.vectors[[self.number.get(w, 0) for w in words]].astype(np.float32)
        return own @ self.contexts[places].mean(0)

    def choose(self, status: str, candidates: list[tuple[str, float]], around: list[str]) -> str | None:
        """The candidate that is likeliest among its neighbours; null if they don't support a change of accents."""
        if len(candidates) == 1 and status == "misread":
            return candidates[0][0]
        fit = self.fits([c for c, _ in candidates], around)
        if fit is None:
            return self.best(candidates)
        if status == "accent" and fit.max() < FITS:
            return None
        return max(zip(candidates, fit.tolist(), strict=True), key=lambda x: (x[0][1] + WINDOW * x[1], x[0][0]))[0][0]

    def rivals(self, w: str) -> list[str]:
        if w not in self._rivals:
            self._rivals[w] = self.accent_candidates(w)
        return self._rivals[w]

    def neighbour(self, token: str | None, cores: _Cores) -> str:
        """A neighbour as a component of skip-gram vectors: a frequent word or a class."""
        if token is None:
            return "^"
        c = cores[token]
        if c is None:
            return "#" if any(x.isdigit() for x in token) else "A"
        return c if c in self.known else "?"

    def together(self, w: str, side: int, near: str) -> int:
        """How often ``near`` stands before (side 0) or after (1) ``w``."""
        key = _key(self.number[w], side, _CLASSES.get(near) if near in _CLASSES else self.number[near])
        k = bisect.bisect_left(self.near[0], key)
        return int(self.near[1][k]) if k < len(self.near[0]) and self.near[0][k] == key else 0

    def in_context(self, w: str, left: str, right: str) -> str | None:
        """The rival that fits where ``w`` stands far better than ``w`` does, or null; remembered for each place's words."""
        if (k := (w, left, right)) not in self._judged:
            if len(self._judged) > 300_000:
                self._judged.clear()
            self._judged[k] = self._in_context(w, left, right)
        return self._judged[k]

    def _in_context(self, w: str, left: str, right: str) -> str | None:
        get = self.together
        own = (get(w, 0, left) + 0.5) * (get(w, 1, right) + 0.5) / (self.known[w] + 1)
        best = None
        for c in self.rivals(w):
            x, y = get(c, 0, left), get(c, 1, right)
            if min(x, y) < SUPPORT:
                continue
            q = (x + 0.5) * (y + 0.5) / (self.known[c] + 1)
            # a word that is frequent in its own right needs far more against it, from words on both sides
            rare = self.known[w] <= RATIO * self.known[c]
            if not rare and (left in _CLASSES or right in _CLASSES):
                continue
            if q > (LIKELIER if rare else LIKELIER**2) * own and (best is None or q > best[0]):
                best = (q, c)
        return best[1] if best else None


#: Neighbours that are no frequent words: a line's edge, a number, a formula, an unknown word.
_CLASSES = {"^": 0, "#": 1, "A": 2, "?": 3}
_SIDES = 3  # before, after, within the window


def _key(w, side, near):
    return (w * _SIDES + side) * (1 << 20) + near


class _Codes(dict):
    """Blank-separated tokens to the bytes of their numbers in the lexicon."""

    def __init__(self, lexicon: Lexicon):
        self.lex, self.cores = lexicon, _Cores()

    def __missing__(self, token: str) -> bytes:
        x = self.lex.neighbour(token, self.cores)
        got = np.int32(_CLASSES[x] if x in _CLASSES else self.lex.number[x]).tobytes()
        if len(self) > 500_000:
            self.clear()
        self[token] = got
        return got


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(which, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def skipgrams(texts: DataFrame, lexicon) -> DataFrame:
    """``key`` of (word, side, neighbour) and ``n`` over all texts: neighbours of the words that have rivals, and context words within the window of each frequent word."""

    def run(batches):
        lex = lexicon.value
        codes = _Codes(lex)
        rivals = np.zeros(len(lex.known) + 4, bool)
        for w, k in lex.number.items():
            rivals[k] = bool(lex.rivals(w))
        edge, held, size = bytes(4), [], 0
        for b in batches:
            raw = []
            for t in b.column(0).to_pylist():
                for line in (t or "").split("\n"):
                    raw.append(edge)
                    raw += map(codes.__getitem__, line.split())
            a = np.frombuffer(b"".join(raw) + edge, np.int32).astype(np.int64)
            x, y = a[:-1], a[1:]
            keys = [_key(y, 0, x)[rivals[y]], _key(x, 1, y)[rivals[x]]]
            inner = np.zeros(len(a), bool)
            for d in range(1, WINDOW + 1):
                x, y = a[:-d], a[d:]
                inner[: len(x)] = (x >= 4) & (y >= 4) if d == 1 else (x >= 4) & (y >= 4) & (a[1 : len(a) - d + 1] > 0)
                ok = inner[: len(x)]
                keys += [_key(v, 2, u)[ok & (u < CONTEXTS + 4)] for u, v in ((x, y), (y, x))]
            k, n = np.unique(np.concatenate(keys), return_counts=True)
            held.append((k, n))
            size += len(k)
            if size > 1_000_000:
                held = [_summed(held)]
                size = len(held[0][0])
                if size > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], names=["key", "n"])
                    held, size = [], 0
        if size:
            k, n = _summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n, pa.int64())], names=["key", "n"])

    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _rows(frames: Iterator[pd.DataFrame], known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words and their rows of positive pointwise mutual information with the context words, from counts sorted by word."""
    total, share = known.sum(), np.zeros(CONTEXTS)
    share[: len(known)] = known[:CONTEXTS] ** 0.75
    share /= max(share.sum(), 1e-9)
    held = None
    frames = iter(frames)
    while True:
        f = next(frames, None)
        part = held if f is None else f if held is None else pd.concat([held, f])
        if part is None or not len(part):
            if f is None:
                return
            continue
        last = part["word"].iloc[-1]
        done, held = (part, None) if f is None else (part[part["word"] != last], part[part["word"] == last])
        for at in range(0, len(words := done["word"].unique()), 2000):
            own = words[at : at + 2000]
            d = done[done["word"].isin(own)]
            m = np.zeros((len(own), CONTEXTS), np.float32)
            m[np.searchsorted(own, d["word"]), d["near"].to_numpy() - 4] = d["n"]
            with np.errstate(divide="ignore", invalid="ignore"):
                m = np.log(m / np.maximum(m.sum(1, keepdims=True), 1) / share)
            yield own, np.where(np.isfinite(m), np.maximum(m, 0), 0).astype(np.float32)
        if f is None or not total:
            return


def factorise(pairs: DataFrame, lex: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the frequent words and of the context words: the leading part of the singular value decomposition of their information.

    The tasks make the matrix of context words with context words, whose
    eigenvectors are the context words' vectors; it alone reaches the driver,
    from a bounded number of tasks, and then one vector for each frequent word.
    """
    known = np.array([lex.known[w] for w in lex.number], np.float64)
    rows = pairs.select(F.floor(F.col("key") / ((1 << 20) * _SIDES)).alias("word"), F.pmod("key", F.lit(1 << 20)).alias("near"), "n").repartition(min(32, pairs.sparkSession.sparkContext.defaultParallelism), "word").sortWithinPartitions("word")

    def gram(frames):
        g = np.zeros((CONTEXTS, CONTEXTS), np.float32)
        for _, m in _rows(frames, known):
            g += m.T @ m
        yield pd.DataFrame({"gram": [g.tobytes()]})

    g = np.zeros((CONTEXTS, CONTEXTS))
    for r in rows.mapInPandas(gram, "gram binary").toLocalIterator():
        g += np.frombuffer(r[0], np.float32).reshape(g.shape)
    value, vector = np.linalg.eigh(g)
    basis = np.ascontiguousarray(vector[:, np.argsort(-value)[:DIMENSIONS]]).astype(np.float32)

    def project(frames):
        for own, m in _rows(frames, known):
            yield pd.DataFrame({"word": own, "vector": [v.tobytes() for v in (m @ basis).astype(np.float16)]})

    out = np.zeros((len(lex.known) + 4, DIMENSIONS), np.float16)
    for r in rows.mapInPandas(project, "word long, vector binary").toLocalIterator():
        out[r[0]] = np.frombuffer(r[1], np.float16)
    return out, basis


def edit_costs(rare: DataFrame, lexicon) -> dict[tuple[str, str], float]:
    """Minus the logarithm of the share of each glyph edit among those that explain rare words (``word``, ``n``)."""

    def run(frames):
        lex, c = lexicon.value, Counter()
        for f in frames:
            for w, n in zip(f["word"], f["n"], strict=True):
                found = lex.glyph_candidates(w)
                for e in set(found.values()):
                    for x in e:
                        c["\0".join(x)] += n / len(found)
        if c:
            yield pd.DataFrame({"edit": list(c.keys()), "n": list(c.values())})

    n = {tuple(r[0].split("\0")): r[1] for r in rare.mapInPandas(run, "edit string, n double").groupBy("edit").agg(F.sum("n")).toLocalIterator()}
    total = sum(n.values()) + len(GLYPHS)
    return {e: -math.log((n.get(e, 0.0) + 1) / total) for e in GLYPHS}


def learn(texts: DataFrame) -> Lexicon:
    """The lexicon of all texts.

    Words of at least ``SHARE`` of all words come to the driver: at most
    1/``SHARE`` of them, whatever the size of the input.
    """
    sc = texts.sparkSession.sparkContext
    counts = shared_table(word_counts(texts))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, int(SHARE * total))
    lex = Lexicon({r[0]: r[1] for r in counts.where(F.col("n") >= least).toLocalIterator()})
    sent = sc.broadcast(lex)
    lex.costs = edit_costs(counts.where(F.col("n") < least), sent)
    found = shared_table(skipgrams(texts, sent).where(F.col("n") >= 2))
    side = F.pmod(F.floor(F.col("key") / (1 << 20)), F.lit(_SIDES))
    near = [(r[0], r[1]) for r in found.where((side < 2) & (F.col("n") >= max(SUPPORT, least // 10))).orderBy("key").toLocalIterator()]
    lex.near = np.array([k for k, _ in near], np.int64), np.array([n for _, n in near], np.int64)
    lex.vectors, lex.contexts = factorise(found.where(side == 2), lex)
    sent.unpersist()
    lex.memo.clear()
    return lex


#: The patterns of page numbers, alone or beside a title, for the JVM.
_ANY_NUMBER = "(?iu)" + "|".join(re.sub(r"\(\?P<\w>", "(?:", p.pattern) for p in [_NUMBER, *_BESIDE])


class Geometry:
    """Where page furniture stands: the end of the top margin, and the cells of page numbers below."""

    def __init__(self, cells: dict[tuple[int, int], tuple[int, int, int]]):
        """``cells``: (column, row) to the number of lines, of page numbers and of different texts.

        The top margin is what stands above the first gap, if page numbers
        stand there too or its lines recur from page to page.
        """
        used = sorted({y for _, y in cells})
        gap = next((k for k, (y, nxt) in enumerate(zip(used, used[1:])) if nxt > y + 1), None)
        self.top = 0
        if gap is not None and used[gap] <= used[0] + MARGIN * (used[-1] - used[0]):
            n, k, d = (sum(c[j] for (_, y), c in cells.items() if y <= used[gap]) for j in range(3))
            if k >= HEAD_SHARE * n or n >= LEAST and d <= RECURRING * n:
                self.top = used[gap + 1] * CELL_H
        middle = used[len(used) // 2] if used else 0
        self.foot = {(x, y) for (x, y), (n, k, _) in cells.items() if y > middle and n >= CELL_LINES and k >= FOOT_SHARE * n}

    def is_head(self, y: int | None) -> bool:
        return y is not None and y < self.top

    def is_foot(self, x: int | None, y: int | None) -> bool:
        return x is not None and y is not None and (x // CELL_W, y // CELL_H) in self.foot


def learn_geometry(ocr: DataFrame, text: str, bbox: str) -> Geometry:
    """The geometry of all pages: counts of lines and page numbers for each cell, a few thousand at most for pages of any number."""
    x, y = F.col(f"{bbox}.x1"), F.col(f"{bbox}.y1")
    inside = ocr.where((F.length(F.trim(text)) > 0) & x.between(0, 20_000) & y.between(0, 20_000))
    number = F.col(text).rlike(r"\d") & F.col(text).rlike(_ANY_NUMBER)
    n = inside.groupBy(F.floor(x / CELL_W).alias("x"), F.floor(y / CELL_H).alias("y")).agg(F.count(F.lit(1)).alias("n"), F.count_if(number).alias("k"), F.approx_count_distinct(text).alias("d"))
    return Geometry({(r.x, r.y): (r.n, r.k, r.d) for r in n.toLocalIterator()})


def furniture(line: str) -> tuple[str | None, bool]:
    """A margin line's title (null if none) and whether it has a page number."""
    t = plain_form(line)
    if _NUMBER.match(t):
        return None, True
    for p in _BESIDE:
        if m := p.match(t):
            return m["t"].strip(" .|"), True
    return t.strip(), False


def title_opening(title: str) -> str:
    """The first two words of a title, without accents and with numbers masked."""
    w = re.findall(r"[^\W_]+", bare(plain_form(title).lower()))[:2]
    return " ".join("#" if x.isdigit() else x for x in w)


def learn_openings(ocr: DataFrame, text: str, bbox: str, top_margin: int) -> set[str]:
    """Openings that running titles of the top margin share; at most 1/``OPENING_SHARE`` of them."""
    top = ocr.where((F.col(f"{bbox}.y1") < top_margin) & (F.length(F.trim(text)) > 0)).select(text)

    def run(frames):
        for f in frames:
            c = Counter(title_opening(t) for x in f[text] if (t := furniture(x)[0]))
            yield pd.DataFrame({"opening": list(c.keys()), "n": list(c.values())})

    n = top.mapInPandas(run, "opening string, n long").groupBy("opening").agg(F.sum("n").alias("n"))
    total = n.agg(F.sum("n")).first()[0] or 0
    return {r[0] for r in n.where(F.col("n") >= max(2, OPENING_SHARE * total)).toLocalIterator()}


def is_title(line: str, openings: set[str]) -> bool:
    """Whether a line within a question looks like a running title."""
    t = plain_form(line).strip()
    if len(t) > 90 or title_opening(t) not in openings or t[-1:] in ".?!:":
        return False
    return bool(re.match(r"(?i)ch\S{2,6}\s+\d+\s?[.:]\s", t) or re.search(r"\s[–—-]\s", t))


class Reader:
    """Finds noise in the lines of one page or question and repairs them."""

    def __init__(self, lexicon: Lexicon, openings: set[str], geometry: Geometry):
        self.lex, self.openings, self.geometry, self.cores = lexicon, openings, geometry, _Cores()

    def misreadings(self, line: str) -> dict[int, str]:
        """Numbers of misread tokens with their corrections; a stray beginning of the line is token -1."""
        out: dict[int, str] = {}
        if m := STRAY.match(plain_form(line)):
            out[-1] = m[0]
        tokens = line.split()
        for i, k in enumerate(tokens):
            w = self.cores[k]
            if w is None:
                continue
            if i == len(tokens) - 1 and k[-1:] in _MARK:
                continue  # the first half of a broken word
            s, found = self.lex.status(w)
            if s == "ok" or s == "unknown":
                continue
            if s == "context":
                c = self.lex.in_context(w, self.lex.neighbour(tokens[i - 1] if i else None, self.cores), self.lex.neighbour(tokens[i + 1] if i + 1 < len(tokens) else None, self.cores))
            else:
                around = [x for t in [*tokens[max(0, i - WINDOW) : i], *tokens[i + 1 : i + 1 + WINDOW]] if (x := self.cores[t])]
                c = self.lex.choose(s, found, around)
            if c:
                out[i] = c
        return out

    def broken(self, line: str, after: str | None) -> str | None:
        """The whole word if ``line`` ends within one with a mark put there by the break, else null."""
        t = line.replace("\xad", "-") if line.rstrip().endswith("\xad") else line
        t = plain_form(t).rstrip("\n")
        m = _BROKEN.search(t)
        if not m:
            return None
        half = m[1].lower().strip("-")
        first = plain_form(after).split() if after else []
        rest = first[0].strip(".,;:?!\"”)]").lower() if first else ""
        if rest and not _LETTER.match(rest):
            return None
        if not rest:
            return None if f"{half}-" in self.lex.starts else half
        if half + rest in self.lex.known:
            return half + rest
        if f"{half}-{rest}" in self.lex.known or self.lex.status(f"{half}-{rest}")[1]:
            return None
        if found := self.lex.status(half + rest)[1]:
            return self.lex.best(found)
        if f"{half}-" in self.lex.starts:
            return None
        return half + rest if first[0][:1].islower() else None

    def question(self, text: str) -> tuple[list[str], list[tuple[int, str]]]:
        """Lines of a question and the noise in them: (line number, kind)."""
        lines = text.replace("\r\n", "\n").split("\n")
        kinds: list[tuple[int, str]] = []
        title = [False] * len(lines)
        for i, x in enumerate(lines):
            if not x.strip():
                continue
            t, number = furniture(x)
            if t and (number or i) and is_title(t, self.openings):
                title[i] = True
                kinds.append((i, "header"))
                if number:
                    kinds.append((i, "page_number"))
        drop = set(i for i, t in enumerate(title) if t)
        for i, x in enumerate(lines):
            if i in drop or not _NUMBER.match(plain_form(x)):
                continue
            if not plain_form(x).strip().isdigit() or i + 1 < len(lines) and title[i + 1]:
                kinds.append((i, "page_number"))
                drop.add(i)
            elif i and i + 1 < len(lines) and (i - 1 not in drop) and _LETTER.search(lines[i - 1]) and _LETTER.search(lines[i + 1]) and not lines[i - 1].rstrip().endswith((":", "=", "-", "+", "là", "bằng", "với", "và")) and lines[i + 1][:1].islower():
                kinds.append((i, "page_number"))
                drop.add(i)
        body = [i for i in range(len(lines)) if i not in drop and lines[i].strip()]
        kinds += self._body(lines, body)
        for i in drop:
            if title[i] and self.misreadings(lines[i]):
                kinds.append((i, "misread"))
        return lines, kinds

    def _body(self, lines: list[str], body: list[int]) -> list[tuple[int, str]]:
        kinds, cut = [], None
        for at, i in enumerate(body):
            after = lines[body[at + 1]] if at + 1 < len(body) else None
            whole = self.broken(lines[i], after) if after is not None or lines[i].rstrip()[-1:] in _MARK else None
            bad = self.misreadings(lines[i])
            if cut is not None:
                bad.pop(0, None)  # the second half of a broken word is no word
                if self.lex.status(cut)[1]:
                    kinds.append((body[at - 1], "misread"))
            if bad:
                kinds.append((i, "misread"))
            if whole is not None:
                kinds.append((i, "hyphen"))
            cut = whole
        return kinds

    def page(self, rows: list[tuple[int | None, int | None, str]]) -> list[tuple[int, str]]:
        """Noise of a page's rows (x1, y1, text) in reading order: (row number, kind)."""
        kinds: list[tuple[int, str]] = []
        body = []
        for i, (x, y, t) in enumerate(rows):
            if not t or not t.strip():
                body.append(i)
                continue
            if self.geometry.is_head(y):
                title, number = furniture(t)
                if title:
                    kinds.append((i, "header"))
                    if self.misreadings(t):
                        kinds.append((i, "misread"))
                if number:
                    kinds.append((i, "page_number"))
            elif self.geometry.is_foot(x, y) and furniture(t)[1]:
                kinds.append((i, "page_number"))
            else:
                body.append(i)
        return kinds + self._body([t or "" for _, _, t in rows], body)

    def repaired(self, lines: list[str], kinds: list[tuple[int, str]]) -> str:
        """Continuous paragraphs without furniture, breaks and misreadings."""
        by = defaultdict(set)
        for i, k in kinds:
            by[i].add(k)
        out, carry = [], None
        kept = [i for i in range(len(lines)) if lines[i].strip() and not by[i] & {"header", "page_number"}]
        for at, i in enumerate(kept):
            fixed = self.misreadings(lines[i]) if "misread" in by[i] else {}
            text = STRAY.sub("", plain_form(lines[i])) if -1 in fixed else plain_form(lines[i])
            tokens = text.split()
            if len(tokens) == len(lines[i].split()):
                for j, c in fixed.items():
                    if j >= 0:
                        tokens[j] = _like(tokens[j], c)
            if carry is not None and tokens:
                tokens[0] = carry + tokens[0]
            carry = None
            if "hyphen" in by[i] and at + 1 < len(kept) and tokens:
                carry = tokens.pop().rstrip(_MARK)
            line = " ".join(tokens)
            if out and not re.match(r"(?:[A-H][.)]\s|(?:Câu|Bài|Exercise|Exercice)\b|\d+(?:,\d+)?$)", line):
                out[-1] = f"{out[-1]} {line}".strip()
            elif line:
                out.append(line)
        if carry:
            out.append(carry)
        return "\n".join(out)


def _like(token: str, word: str) -> str:
    """``word`` in the case and between the punctuation of ``token``."""
    head = re.match(r"^[(\[{\"“]*", token)[0]
    tail = re.search(r"[.,;:?\"”)\]}…]*$", token)[0]
    body = token[len(head) : len(token) - len(tail) or None]
    w = word.upper() if body.isupper() and len(body) > 1 else word[:1].upper() + word[1:] if body[:1].isupper() else word
    return head + w + tail


def _kinds_schema(kind: str) -> str:
    return f"row_id {kind}, kind string"


def question_noise(df: DataFrame, key: str, text: str, reader) -> DataFrame:
    """``row_id``, ``kind`` for texts of several lines; nulls have none; no row twice."""
    src = spread(df.where(F.col(text).isNotNull()).select(F.col(key).alias("row_id"), F.col(text).alias("text")))

    def run(batches):
        r = reader.value
        for b in batches:
            ids, kinds = [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for x in {x for _, x in r.question(t)[1]}:
                    ids.append(k)
                    kinds.append(x)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(kinds)], names=["row_id", "kind"])

    return src.mapInArrow(run, _kinds_schema(src.schema["row_id"].dataType.simpleString())).distinct()


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one page at a time, from batches sorted by page; a row delivered twice comes once."""
    page, rows, seen = None, [], set()
    for b in batches:
        for r in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
            if r[:2] != page:
                if rows:
                    yield rows
                page, rows, seen = r[:2], [], set()
            if r[3] not in seen:
                seen.add(r[3])
                rows.append(r)
    if rows:
        yield rows


def by_page(df: DataFrame, doc: str, page: str, idx: str, key: str, text: str, bbox: str, delivered: str | None = None) -> DataFrame:
    """Lines spread over tasks by page (a document of any size is many pages) and sorted within; of a line delivered twice the one ``delivered`` last comes first."""
    src = df.select(F.col(delivered).alias("at") if delivered else F.lit(None).cast("string").alias("at"), F.col(doc).alias("doc"), F.col(page).alias("page"), F.col(idx).alias("idx"), F.col(key).alias("row_id"), F.col(text).alias("text"), F.col(f"{bbox}.x1").alias("x1"), F.col(f"{bbox}.y1").alias("y1"))
    return src.repartition("doc", "page").sortWithinPartitions("doc", "page", "idx", "row_id", F.desc_nulls_last("at"), "text").drop("at")


def page_noise(pages: DataFrame, reader) -> DataFrame:
    """``row_id``, ``kind`` for the lines of pages (of ``by_page``); null and empty lines have none; no row twice."""

    kind = to_arrow_type(pages.schema["row_id"].dataType)

    def run(batches):
        r = reader.value
        ids, kinds = [], []
        for rows in _pages(batches):
            for i, k in set(r.page([(x[5], x[6], x[4]) for x in rows])):
                ids.append(rows[i][3])
                kinds.append(k)
            if len(ids) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(kinds)], names=["row_id", "kind"])
                ids, kinds = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(kinds)], names=["row_id", "kind"])

    return pages.mapInArrow(run, _kinds_schema(pages.schema["row_id"].dataType.simpleString()))


def reader_of(ocr: DataFrame, text: str, bbox: str, exercises: DataFrame, question: str):
    """The reader of both tables, learned from all their texts, as a broadcast."""
    texts = spread(ocr.select(F.col(text).alias("text"))).unionAll(spread(exercises.select(F.col(question).alias("text"))))
    geometry = learn_geometry(ocr, text, bbox)
    return ocr.sparkSession.sparkContext.broadcast(Reader(learn(texts), learn_openings(ocr, text, bbox, geometry.top), geometry))


def repaired_questions(df: DataFrame, key: str, text: str, reader) -> DataFrame:
    """``key`` and its text as continuous paragraphs; one row for each row, null for null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        r = reader.value
        for b in batches:
            out = [None if t is None else r.repaired(*r.question(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[key, text])

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, `{text}` string")


def repaired_pages(pages: DataFrame, reader) -> DataFrame:
    """``doc``, ``page``, ``text``: each page as continuous paragraphs."""
    kinds = [pages.schema[c].dataType.simpleString() for c in ("doc", "page")]
    page_type = to_arrow_type(pages.schema["page"].dataType)

    def run(batches):
        r = reader.value
        for rows in _pages(batches):
            lines = [x[4] or "" for x in rows]
            noise = r.page([(x[5], x[6], x[4]) for x in rows])
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]]), pa.array([rows[0][1]], page_type), pa.array([r.repaired(lines, noise)])], names=["doc", "page", "text"])

    return pages.mapInArrow(run, f"doc {kinds[0]}, page {kinds[1]}, text string")
