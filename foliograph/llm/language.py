"""Problem 8: the languages of documents and of their segments.

A word model per language (word counts with a character-trigram model behind
them) is trained on a bounded sample of labelled documents and refined there
by expectation-maximisation, since labels may be wrong.  For each document,
EM estimates the language proportions from the likelihoods of its segments;
languages enter the set as long as the penalised likelihood grows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread
from .textform import plain_form

LANGUAGES = ["vi", "en", "fr", "de", "es"]
#: Labelled documents the classifier is fitted on, at most.
SAMPLE = 3000
#: Log-likelihood that a further language must add to a document, and words that make a segment a whole sentence.
PENALTY, LEAST_WORDS = 9.0, 3

# Names of the languages in common codes and spellings, lower case.
NAMES = {
    "vi": "vi vie vn vietnamese việt vietnamien vietnamesisch vietnamita tiếng-việt tieng-viet tiếng_việt viet",
    "en": "en eng english anglais englisch inglés ingles tiếng-anh tieng-anh",
    "fr": "fr fra fre french français francais französisch francés frances tiếng-pháp tieng-phap",
    "de": "de deu ger german deutsch allemand alemán aleman tiếng-đức tieng-duc",
    "es": "es spa spanish español espanol castellano castilian espagnol spanisch tiếng-tây-ban-nha",
}
_CODE = {unicodedata.normalize("NFC", n.replace("-", " ").replace("_", " ")): k for k, v in NAMES.items() for n in v.split()}

_MATH = re.compile(r"\$[^$\n]*\$|\\[A-Za-z]+|https?://\S+|<\|[a-z_]+\|>")
_QUOTE = re.compile(r"“[^”\n]*”|«[^»\n]*»")
_SENTENCE = re.compile(r"(?<=[.!?…:])[\"”»)]*\s+|\s*[\r\n]+\s*")
_WORD = re.compile(r"[^\W\d_]+")


def label_code(label: str | None) -> str | None:
    """The language that a label names, or null if it names none of ours."""
    if not label:
        return None
    t = unicodedata.normalize("NFC", label.strip().lower()).replace("_", " ").replace("-", " ")
    return _CODE.get(t) or (_CODE.get(t.split()[0]) if re.fullmatch(r"[a-z]{2,3}( [a-z]{2,4})+", t) else None)


def segments(text: str | None) -> list[str]:
    """Sentences and lines of a text, without formulas and quoted fragments."""
    if not text:
        return []
    t = _MATH.sub(" ", text)
    if "“" in t or "«" in t:
        bare = _QUOTE.sub(" ", t)
        t = bare if _WORD.search(bare) else t
    return [s for s in _SENTENCE.split(t) if s and not s.isspace()]


def token_words(token: str) -> list[str]:
    """Words of one blank-separated token; names of points and variables are none."""
    return [w.lower() for w in _WORD.findall(plain_form(token)) if len(w) > 1 and not (w.isupper() and len(w) < 6)]


def bare(word: str) -> str:
    """The word as typed without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", word.replace("đ", "d")) if not 0x300 <= ord(c) < 0x370)


class Model:
    """Log-likelihoods of words under each language."""

    def __init__(self, counts: dict[str, dict[str, float]], behind: float = 40.0):
        self.counts, self.behind = counts, behind
        self.total = np.array([sum(counts[k].values()) + behind for k in LANGUAGES])
        self.tri: list[dict[str, float]] = []
        self.two: list[dict[str, float]] = []
        for k in LANGUAGES:
            tri, two = defaultdict(float), defaultdict(float)
            for w, n in counts[k].items():
                p, n = f"^{w}$", min(n, 50.0)
                for i in range(len(p) - 1):
                    tri[p[max(0, i - 1) : i + 2]] += n
                    two[p[max(0, i - 1) : i + 1]] += n
            self.tri.append(dict(tri))
            self.two.append(dict(two))
        self.memo: dict[str, np.ndarray] = {}

    def spelled(self, w: str) -> np.ndarray:
        p = f"^{w}$"
        out = np.zeros(len(LANGUAGES))
        for j in range(len(LANGUAGES)):
            tri, two = self.tri[j], self.two[j]
            for i in range(len(p) - 1):
                out[j] += np.log((tri.get(p[max(0, i - 1) : i + 2], 0.0) + 0.02) / (two.get(p[max(0, i - 1) : i + 1], 0.0) + 1.6))
        return np.maximum(out, -60.0)

    def word(self, w: str) -> np.ndarray:
        """Natural logarithms, one for each language; rare spellings weigh no more than a limit."""
        got = self.memo.get(w)
        if got is None:
            c = np.array([self.counts[k].get(w, 0.0) for k in LANGUAGES])
            got = np.log((c + self.behind * np.exp(self.spelled(w))) / self.total)
            got = np.maximum(got, got.max() - 6.0)
            if len(self.memo) > 300_000:
                self.memo.clear()
            self.memo[w] = got
        return got


def train(rows: list[tuple[str | None, str | None]], rounds: int = 3) -> Model:
    """Fit on (text, label) rows: counts by label, then by what the model itself makes of each segment."""
    number: dict[str, int] = {}
    own: list[int] = []
    ids: list[np.ndarray] = []
    for text, label in rows:
        if (code := label_code(label)) is not None:
            for s in segments(text):
                own.append(LANGUAGES.index(code))
                ids.append(np.array([number.setdefault(w, len(number)) for t in s.split() for w in token_words(t)], np.int64))
    words, flat = list(number), np.concatenate([*ids, np.zeros(0, np.int64)])
    part = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    eye = np.eye(len(LANGUAGES))
    weight = eye[own] if own else np.zeros((0, len(LANGUAGES)))
    model = Model({k: {} for k in LANGUAGES})
    for _ in range(rounds if len(flat) else 0):
        n = np.stack([np.bincount(flat, weight[part, j], len(words)) for j in range(len(LANGUAGES))], 1)
        counts = {k: {words[i]: float(n[i, j]) for i in np.flatnonzero(n[:, j] > 0.05)} for j, k in enumerate(LANGUAGES)}
        for w, c in list(counts["vi"].items()):  # Vietnamese is also typed without accents
            if (b := bare(w)) != w:
                counts["vi"][b] = counts["vi"].get(b, 0.0) + 0.3 * c
        model = Model(counts)
        table = np.array([model.word(w) for w in words])
        s = np.stack([np.bincount(part, table[flat, j], len(ids)) for j in range(len(LANGUAGES))], 1) + np.log(0.05 + 0.75 * eye[own])
        weight = np.exp(s - s.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
    return model


def mixture(ll: np.ndarray, chosen: list[int], steps: int = 25) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over one document: log-likelihood, proportions of the chosen languages, responsibilities of its segments."""
    x = ll[:, chosen]
    top = x.max(1, keepdims=True)
    like, pi = np.exp(x - top), np.full(len(chosen), 1 / len(chosen))
    for _ in range(steps if len(chosen) > 1 else 1):
        joint = like * pi
        r = joint / joint.sum(1, keepdims=True)
        new = np.maximum(r.mean(0), 1e-6)
        new /= new.sum()
        if np.abs(new - pi).max() < 1e-4:
            break
        pi = new
    joint = like * pi
    return float((np.log(joint.sum(1)) + top[:, 0]).sum()), pi, joint / joint.sum(1, keepdims=True)


def choose(ll: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The language set of a document by penalised likelihood, its proportions and responsibilities."""
    chosen = [int(ll.sum(0).argmax())]
    score, pi, r = mixture(ll, chosen)
    while len(chosen) < len(LANGUAGES):
        tried = [(mixture(ll, [*chosen, j]), j) for j in range(len(LANGUAGES)) if j not in chosen and (ll.argmax(1) == j).any()]
        if not tried:
            break
        (s, p, q), j = max(tried, key=lambda t: t[0][0])
        if s - score < PENALTY:
            break
        chosen, score, pi, r = [*chosen, j], s, p, q
    return chosen, pi, r


class _Tokens(dict):
    """Blank-separated tokens to the bytes of the table rows of their words."""

    def __init__(self, owner: Identifier):
        self.owner = owner

    def __missing__(self, token: str) -> bytes:
        out, me = [], self.owner
        for w in token_words(token):
            if (k := me.number.get(w)) is None:
                k = me.number[w] = len(me.rows)
                me.rows.append(me.model.word(w))
            out.append(k)
        got = np.array(out, np.int32).tobytes()
        if len(self) >= 500_000:
            self.clear()
        if len(token) <= 64:
            self[token] = got
        return got


class Identifier:
    """Segments of a batch of texts with their language; texts go through tables, not through word loops."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: list[np.ndarray] = [np.zeros(len(LANGUAGES))]
        self.number: dict[str, int] = {}
        self.token = _Tokens(self)
        self.table = np.zeros((0, len(LANGUAGES)))

    def batch(self, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, list[int], np.ndarray, np.ndarray] | None]:
        """For each text: segments, words of each, log-likelihoods, chosen languages, proportions, responsibilities; or null without words."""
        if len(self.rows) > 300_000:
            self.__init__(self.model)
        segs = [segments(t) for t in texts]
        ids = [b"".join(map(self.token.__getitem__, s.split())) for own in segs for s in own]
        size = np.array([len(x) // 4 for x in ids], np.int64)
        if len(self.table) != len(self.rows):
            self.table = np.array(self.rows)
        sums = np.zeros((len(ids), len(LANGUAGES)))
        if size.sum():
            full = np.flatnonzero(size)
            begins = np.cumsum(size) - size
            sums[full] = np.add.reduceat(self.table[np.frombuffer(b"".join(ids), np.int32)], begins[full], axis=0)
        at = 0
        for own in segs:
            n, ll = size[at : at + len(own)], sums[at : at + len(own)]
            at += len(own)
            if not n.sum():
                yield None
                continue
            best = ll[n > 0].argmax(1)
            if (best == best[0]).all():
                yield own, n, ll, [int(best[0])], np.ones(1), np.ones((len(own), 1))
            else:
                yield own, n, ll, *choose(ll)


def fit(df: DataFrame, text: str, label: str, key: str) -> Model:
    """A model from at most ``SAMPLE`` labelled documents, picked by the hash of their key."""
    wanted = df.where(F.col(label).isNotNull() & (F.length(F.trim(text)) > 0)).select(key, text, label)
    ids = wanted.select(key).orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(SAMPLE)
    # the keys alone are ordered; the texts of the few picked rows are joined to them
    rows = wanted.join(F.broadcast(ids), key, "left_semi").select(text, label).orderBy(text, label).limit(2 * SAMPLE).collect()
    return train([(r[0], r[1]) for r in rows])


def _identify(df: DataFrame, key: str, text: str, label: str, each, schema: str) -> DataFrame:
    model = df.sparkSession.sparkContext.broadcast(fit(df, text, label, key))
    src = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")))
    kind = src.schema["key"].dataType.simpleString()
    held: list[Identifier] = []

    def run(batches):
        for b in batches:
            if not held:
                held.append(Identifier(model.value))
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                out = [(k, *row) for k, lab, got in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), held[0].batch(part.column(1).to_pylist()), strict=True) if got for row in each(lab, *got)]
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], part.column(0).type), *map(pa.array, columns[1:])], names=[x.split()[0] for x in schema.format(kind).split(", ")])

    return src.mapInArrow(run, schema.format(kind))


def _languages(n: np.ndarray, chosen: list[int], r: np.ndarray) -> dict[int, np.ndarray]:
    """Languages with a whole sentence, with the numbers of their segments."""
    own = r.argmax(1)
    out = {}
    for c, j in enumerate(chosen):
        at = np.flatnonzero((own == c) & (n > 0))
        if len(at) and (n[at].max() >= LEAST_WORDS or len(chosen) == 1):
            out[j] = at
    return out


def document_languages(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``key``, ``lang``, ``share`` of words, ``confidence``, ``label_ok``: one row for each language of a document.

    Documents without any words (null, empty, formulas only) have no row; a
    repeated row is judged again each time; null labels are never right.
    """

    def each(lab, own, n, ll, chosen, pi, r):
        langs = _languages(n, chosen, r)
        ok = len(langs) == 1 and label_code(lab) == LANGUAGES[next(iter(langs))]
        for j, at in langs.items():
            gap = ll[at, j].sum() - np.delete(ll[at].sum(0), j).max()
            yield LANGUAGES[j], float(n[at].sum() / n.sum()), float(1 / (1 + np.exp(-min(gap, 50.0)))), ok

    return _identify(df, key, text, label, each, "key {}, lang string, share double, confidence double, label_ok boolean").withColumnRenamed("key", key)


def segment_languages(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``key``, ``segment`` number, ``lang``, ``confidence``: each segment with words, formulas and quotations left out."""

    def each(lab, own, n, ll, chosen, pi, r):
        for i in np.flatnonzero(n):
            c = int(r[i].argmax())
            yield int(i), LANGUAGES[chosen[c]], float(r[i, c]), own[i]

    return _identify(df, key, text, label, each, "key {}, segment long, lang string, confidence double, words string").withColumnRenamed("key", key)


def mislabelled(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``key``, ``lang`` of documents with a missing or wrong label or with several languages; no row twice."""
    return document_languages(df, key, text, label).where(~F.col("label_ok")).select(key, "lang").distinct()
