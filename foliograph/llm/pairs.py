"""Problem 4: broken prompt and response pairs.

One pass over the pairs finds empty, copied and wrong-language answers, and
parts every answer into sentences.  Refusals show as templates: the sentences
of answers without any content of their own are clustered by MinHash, verified
by their runs of words; a cluster that recurs over unrelated prompts and does
not occur in answers with content is a template, and an answer made of
templates alone declines.  No word list takes part in that.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import minhash
from .common import shared_table
from .language import LANGUAGES, Identifier, Model
from .textform import plain_form
from .truncation import judged as judged_cuts

#: Shares of answer and question words in common that make a copy; words of a copy at least.
COPY_OF_ANSWER, COPY_OF_QUESTION, COPY_WORDS = 0.83, 0.45, 8
#: Similarity of sentences by runs of SHINGLE words: what is declined and why may differ.  Two just so alike are met with probability 0.999.
ALIKE, SHINGLE, BANDS, ROWS = 0.4, 2, 40, 2
#: Words of a sentence that can be a template; share of its occurrences that may stand in answers with content.
SENTENCE, ELSEWHERE = 4, 0.1
#: Share of common words from which two prompts are related.
RELATED = 0.5
#: Log-likelihood by which another language must win; words of an answer's sentences at least.
GAP, WORDS = 8.0, 4

# Headings and placeholders that are no content, folded to unaccented lower case.
EMPTY = (
    "loi giai|bai giai|giai|huong dan giai|huong dan|dap an|dap so|tra loi|ket qua|ket luan|answer|solution|reponse|corrige|respuesta|solucion|antwort|losung|"
    "n/a|na|null|none|nil|nan|tbd|todo|dang cap nhat|chua co dap an|chua co loi giai|khong co dap an|khong co loi giai|khong co|chua co|trong|bo trong|de trong|"
    "empty|blank|no answer|not available|updating|vide|vacio|leer"
)
_WORD = re.compile(r"[^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_BOX = re.compile(r"\\(?:boxed|text|mathrm|displaystyle|quad)\b")
_HEADING = re.compile(rf"^\W*(?:{EMPTY})\W*$")
_POINTS = re.compile(r"(?<![^\W_])[A-Z]{2,}(?![^\W_])")
_ASKED = re.compile(r"tieng\s+(\w+)|\b(?:in|into|to)\s+(english|french|german|spanish|vietnamese)|\ben\s+(anglais|francais|allemand|espagnol|vietnamien)|\bauf\s+(\w+)|\ben\s+(ingles|frances|aleman|espanol|vietnamita)")
# Beginnings of language names in requests.
_NAMED = {"an": "en", "ar": "en", "ph": "fr", "du": "de", "ta": "es", "vi": "vi", "en": "en", "fr": "fr", "ge": "de", "sp": "es", "al": "de", "es": "es", "in": "en", "de": "de"}


def folded(text: str) -> str:
    """Plain form in lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", plain_form(text).lower().replace("đ", "d")) if not 0x300 <= ord(c) < 0x370)


def is_empty(answer: str) -> bool:
    """Whether no content remains without markup, punctuation, headings and placeholders."""
    t = _BOX.sub(" ", folded(answer))
    lines = [x for x in re.split(r"[\n:]", t) if _WORD.search(x)]
    return all(_HEADING.match(x.replace("*", " ").replace("#", " ").strip()) for x in lines)


def repaired_words(text: str) -> list[str]:
    return _WORD.findall(re.sub(r"[-‐–—¬] ?\n", "", plain_form(text)).lower())


def is_copy(question: str, answer: str) -> bool:
    """Whether the answer holds nothing but the question or the greater part of it."""
    a = repaired_words(answer)
    if len(a) < COPY_WORDS:
        return False
    q, c = Counter(repaired_words(question)), Counter(a)
    both = sum((q & c).values())
    return both >= COPY_OF_ANSWER * len(a) and both >= COPY_OF_QUESTION * sum(q.values())


def asked(question: str) -> set[str]:
    """Languages that a question asks to be answered in."""
    return {code for m in _ASKED.finditer(folded(question)) for g in m.groups() if g and (code := _NAMED.get(g[:2]))}


def has_content(raw: str, low: str) -> bool:
    """Whether a text says something of its own: numbers, formulas, quotations, names of points, or full names within a sentence (``low``: the folded text)."""
    if re.search(r"[\d$=\\\"“”«»]", low) or _POINTS.search(raw):
        return True
    words = raw.split()
    return any(a[:1].isupper() and b[:1].isupper() and before[-1:].isalpha() for before, a, b in zip(words, words[1:], words[2:]))


def sentences(answer: str) -> list[tuple[str, str, bool]]:
    """Sentences and lines of an answer without headings: raw text, words, and whether it ends with a terminator."""
    out = []
    for x in re.split(r"(?<=[.!?:])\s+|\n", answer):
        low = folded(x)
        if _LETTERS.search(low) and not _HEADING.match(low.replace("*", " ").replace("#", " ").strip()):
            out.append((x, " ".join(_LETTERS.findall(low)), x.rstrip(" *_\"”»)").endswith((".", "!", "?"))))
    return out


def spoken(answer: str) -> tuple[list[tuple[str, bool]] | None, list[int]]:
    """Of an answer without content its sentences (words, whole or not), else null; of one with content the hashes of its whole sentences without content."""
    if has_content(answer, answer):
        own = [x for x in re.split(r"(?<=[.!?:])\s+|\n", answer) if x.count(" ") >= SENTENCE - 1 and x.rstrip().endswith((".", "!", "?")) and not has_content(x, x)]
        said = [(" ".join(_LETTERS.findall(folded(x)))) for x in own]
        return None, [minhash.xxhash.xxh64_intdigest(x) - (1 << 63) for x in said if x.count(" ") >= SENTENCE - 1]
    said = [(w, whole) for _, w, whole in sentences(answer) if w.count(" ") >= SENTENCE - 1]
    return said or None, []


def judge(df: DataFrame, key: str, question: str, answer: str, model: Model) -> DataFrame:
    """``key``, ``defects`` found in the pair alone, ``said`` (sentences of an answer without content), ``elsewhere`` (hashes of such sentences in an answer with content), ``prompt`` (hashes of its words, where ``said`` isn't null)."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()
    held: list[Identifier] = []

    def run(frames):
        for f in frames:
            if not held:
                held.append(Identifier(sent.value))
            for at in range(0, len(f), 1000):
                p = f.iloc[at : at + 1000]
                qs, ans = [x if isinstance(x, str) else "" for x in p.iloc[:, 1]], list(p.iloc[:, 2])
                langs = [held[0].batch(qs), held[0].batch(ans)]
                out = []
                for q, a, ql, al in zip(qs, ans, *langs, strict=True):
                    d, said, elsewhere = [], None, []
                    if is_empty(a):
                        d.append("empty")
                    else:
                        if is_copy(q, a):
                            d.append("copy")
                        else:
                            said, elsewhere = spoken(a)
                        if ql and al and _other_language(q, ql, al):
                            d.append("wrong_language")
                    prompt = None if said is None else sorted({minhash.hash31(w) for w in repaired_words(q)})
                    out.append((d, None if said is None else [{"words": w, "whole": e} for w, e in said], elsewhere, prompt))
                yield pd.DataFrame({key: p.iloc[:, 0].to_numpy(), **{name: [r[k] for r in out] for k, name in enumerate(("defects", "said", "elsewhere", "prompt"))}})

    return df.where(F.col(answer).isNotNull()).select(key, question, answer).mapInPandas(run, f"`{key}` {kind}, defects array<string>, said array<struct<words:string,whole:boolean>>, elsewhere array<long>, prompt array<int>")


def _other_language(question: str, q: tuple, a: tuple) -> bool:
    """Whether the answer's sentences are in another language than the question, and not in one it asks for."""
    n, ll = a[1], a[2]
    if n.max() < 3 or n.sum() < WORDS:
        return False
    total, own = ll.sum(0), int(q[2].sum(0).argmax())
    best = int(total.argmax())
    return best != own and total[best] - total[own] >= GAP and LANGUAGES[best] not in asked(question)


def _alike(a: str, b: str, share: float):
    return F.size(F.array_intersect(a, b)) >= share * F.size(F.array_union(a, b))


def recurring(said: DataFrame) -> DataFrame:
    """``words`` of each sentence with ``n`` (answers), ``whole``, one ``prompt``, and whether its prompts are ``varied``: another is unrelated to that one.

    ``said``: words, whole, prompt, one row for each sentence of an answer.
    Each sentence is first summed up in a bounded number of shares, of which
    only the extreme prompts go on; a sentence of few answers has each prompt.
    """
    share = F.pmod(F.xxhash64("prompt"), F.lit(64)).alias("share")
    part = said.groupBy("words", share).agg(F.count(F.lit(1)).alias("n"), F.bool_or("whole").alias("whole"), F.min("prompt").alias("low"), F.max("prompt").alias("high"))
    first = part.groupBy("words").agg(F.min("low").alias("prompt"))
    varied = ~_alike("low", "prompt", RELATED) | ~_alike("high", "prompt", RELATED)
    return part.join(first, "words").groupBy("words").agg(F.sum("n").alias("n"), F.bool_or("whole").alias("whole"), F.first("prompt").alias("prompt"), F.bool_or(varied).alias("varied"))


def templates(said: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """``words`` of the sentences that belong to a template.

    ``elsewhere``: hash, n of sentences in answers with content.  Sentences
    that share a band are compared with the band's most frequent whole one; a
    pivot and all that are verified to be alike are a cluster, and a sentence
    belongs to each of its pivots' clusters.
    """
    a, b = minhash.coefficients(BANDS * ROWS)

    def sign(frames):
        for f in frames:
            if not len(f):
                continue
            sets = [np.array(sorted({minhash.hash31(s) for s in minhash.shingles(o.split(), SHINGLE)}), np.uint64) for o in f["words"]]
            sig = minhash.signatures(sets, a, b).reshape(len(f), BANDS, ROWS)
            bands = [[hash((k, *row.tolist())) for k, row in enumerate(x)] for x in sig]
            yield f.assign(bands=bands, items=[s.astype(np.int64).tolist() for s in sets], hash=[minhash.xxhash.xxh64_intdigest(o) - (1 << 63) for o in f["words"]])

    kind = "words string, n long, whole boolean, prompt array<int>, varied boolean, bands array<long>, items array<long>, hash long"
    s = shared_table(recurring(said).mapInPandas(sign, kind).join(elsewhere.select("hash", F.col("n").alias("elsewhere")), "hash", "left").fillna(0, "elsewhere"))
    entries = s.select("words", "n", "whole", F.explode("bands").alias("band"))
    pivots = entries.where("whole").groupBy("band").agg(F.max(F.struct("n", "words")).alias("p")).select("band", F.col("p.words").alias("pivot"))
    met = entries.join(pivots, "band").select("words", "pivot").distinct()
    own = met.join(s.select("words", "n", "elsewhere", "prompt", "varied", "items"), "words")
    other = s.select(F.col("words").alias("pivot"), F.col("items").alias("pivot_items"), F.col("prompt").alias("first"))
    members = own.join(other, "pivot").where(_alike("items", "pivot_items", ALIKE))
    varied = F.col("varied") | ~_alike("prompt", "first", RELATED)
    clusters = members.groupBy("pivot").agg(F.sum("n").alias("n"), F.sum("elsewhere").alias("elsewhere"), F.bool_or(varied).alias("varied"))
    good = clusters.where(F.col("varied") & (F.col("elsewhere") <= ELSEWHERE * F.col("n"))).select("pivot")
    return members.select("pivot", "words").join(good, "pivot", "left_semi").select("words").distinct()


def refusals(judged: DataFrame, key: str) -> DataFrame:
    """``key`` of answers without content whose whole sentences are all templates, and one sentence at least is."""
    said = judged.where(F.col("said").isNotNull()).select(key, "prompt", F.monotonically_increasing_id().alias("answer"), F.explode("said").alias("x")).select(key, "answer", "prompt", "x.words", "x.whole")
    elsewhere = judged.select(F.explode("elsewhere").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    known = templates(said.select("words", "whole", "prompt"), elsewhere).withColumn("known", F.lit(True))
    each = said.join(known, "words", "left").select(key, "answer", "whole", F.coalesce("known", F.lit(False)).alias("known"))
    return each.groupBy(key, "answer").agg(F.bool_and(F.col("known") | ~F.col("whole")).alias("all"), F.bool_or("known").alias("any")).where(F.col("all") & F.col("any")).select(key)


def defects(df: DataFrame, key: str, question: str, answer: str, source: str, model: Model) -> DataFrame:
    """``key`` and ``defect``: one row for each defect of a pair; no row twice.

    Null answers have no defect; a null or empty question can be neither copied
    nor of another language; a record delivered twice is judged with each of
    its texts and counts once; an empty table gives no rows.
    """
    one = df.select(key, question, answer, source).where(F.col(answer).isNotNull()).distinct()
    cut = judged_cuts(one.select(key, answer, source).distinct(), key, answer, source).where("cut").select(key)
    found = shared_table(judge(one, key, question, answer, model).where(F.col("said").isNotNull() | (F.size("defects") > 0) | (F.size("elsewhere") > 0)))
    plain = found.select(key, F.explode("defects").alias("defect"))
    truncated = cut.join(plain.where("defect = 'empty'").select(key), key, "left_anti")
    return plain.unionByName(refusals(found, key).withColumn("defect", F.lit("refusal"))).unionByName(truncated.withColumn("defect", F.lit("truncated"))).distinct()
