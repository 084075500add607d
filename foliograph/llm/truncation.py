"""Problem 5: text cut off by field limits or in transfer.

A stack automaton reads the text once: formulas, brackets, quotes and markup
left open, and escapes, entities, tags and byte sequences left unfinished mean
a cut.  What is closed but has no terminator is judged by its last segment and
by its source: where a source's texts usually end without one, a missing one
says nothing.  What stays open to doubt counts as cut where its length is a
limit of its source, found from the lengths at which the source piles up.
"""

from __future__ import annotations

import codecs
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table, spread

#: A limit: a length with this share of a source's texts, this many at least, and so many times as many as the lengths around it; shorter texts pile up by themselves.
PILE, LEAST, TIMES, SHORTEST = 0.02, 5, 8, 20
#: Share of sentence-like endings without terminator from which a missing one says nothing in a source, if it has so many of these endings.
USUAL, ENDINGS = 0.5, 30
#: Sources whose limits are sent to all tasks; more of them are joined by source.
FEW_SOURCES = 100_000

# Marks put after a cut; what may end a text as it is; letters with which options begin.
_MARK = re.compile(r"(?:\.\.\.+|…|\[(?:\.\.\.|…)\]|\((?:\.\.\.|…)\)|(?<=\w)[—–]|>>+)$")
_BLANK = "​‌‍⁠﻿­"
_OPTION = re.compile(r"^\(?[A-H][.)]\s*\S.{0,60}$")
_OPTIONS = re.compile(r"(?:^|\s)A[.)]\s.*\sB[.)]\s.*\s[C-H][.)]\s+(?:\S+\s*){1,4}$")
_SERIES = re.compile(r"^[\d\s.,;:/+\-−=()]*$")
_END = re.compile(r"[.?!…:;][\"”»)\]*]*\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+")
_CLOSING_TAGS = re.compile(r"(?:\s*</[A-Za-z][A-Za-z0-9]*>)+$")
# Closing signs and what they close; elements that may stay open; elements known as markup.
_PAIRS = {")": "([", "]": "[(", "}": "{", "”": "“", "»": "«"}
_VOID = frozenset("br hr img input meta link wbr p li td th tr dt dd option".split())
_TAGS = frozenset("b i u s em strong sub sup small mark del ins code pre a span div table thead tbody ul ol dl h1 h2 h3 h4 h5 h6 blockquote center font html body math svg".split()) | _VOID
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?(/?)>")
_OPEN_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)?(?:\s[^<>]*)?$")
_ENTITY = re.compile(r"&(?:#\d{0,5}|#x[0-9a-fA-F]{0,4}|a|am|amp|ap|apo|apos|g|gt|l|lt|n|nb|nbs|nbsp|q|qu|quo|quot)$")
_ESCAPE = re.compile(r"\\u[0-9a-fA-F]{1,3}$|(?:%[0-9A-F]{2})+%[0-9A-F]?$")
_MISREAD_BYTES = re.compile("([\xc2-\xf4])([\x80-\xbf]{0,3})$")
_WHOLE_BYTES = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_STOPS = re.compile(r'[\\$"()\[\]{}“”«»<*]')


def broken_bytes(text: str) -> bool:
    """Whether the text ends within a multi-byte character: with the mark of undecodable bytes, or within bytes taken for Latin letters."""
    if text.endswith("�"):
        return True
    if m := re.search(r"(?:%[0-9A-Fa-f]{2})+$", text):
        state = codecs.getincrementaldecoder("utf-8")("replace")
        state.decode(bytes.fromhex(m[0].replace("%", "")))
        return bool(state.getstate()[0])
    m = _MISREAD_BYTES.search(text)
    if not m or not _WHOLE_BYTES.search(text[: m.start()]):
        return False
    lead = ord(m[1])
    return len(m[2]) < (1 if lead < 0xE0 else 2 if lead < 0xF0 else 3)


def unfinished(text: str) -> bool:
    """Whether the text ends within a tag, an entity, an escape or a character."""
    m = _OPEN_TAG.search(text)
    if m and (m[1] or m[2] and (m[2].lower() in _TAGS or any(t[2].lower() in _TAGS for t in _TAG.finditer(text)))):
        return True
    return bool(_ENTITY.search(text) or _ESCAPE.search(text)) or broken_bytes(text)


def open_at_end(text: str) -> str | None:
    """What the automaton still holds at the end: the innermost thing left open, or null."""
    stack: list[str] = []
    spare = 0  # closing square brackets without an opening one: open intervals begin so
    i, n = 0, len(text)
    while m := _STOPS.search(text, i):
        i = m.start()
        c = text[i]
        i += 1
        if c == "\\":
            if i >= n:
                return "\\"
            i += not text[i].isalpha()
        elif c == "$" or c == '"':
            if c in stack:
                while stack.pop() != c:  # what stood open inside ends with it
                    pass
            else:
                stack.append(c)
        elif c == "*":
            if text.startswith("*", i) and not text.startswith("**", i) and "$" not in stack:
                i += 1
                word_after, word_before = i < n and not text[i].isspace(), i > 2 and not text[i - 3].isspace()
                if "**" in stack and word_before:
                    while stack.pop() != "**":
                        pass
                elif word_after and not word_before:
                    stack.append("**")
        elif c == "<":
            t = _TAG.match(text, i - 1)
            if t and (name := t[2].lower()) in _TAGS:
                i = t.end()
                if name in _VOID or t[3]:
                    continue
                if not t[1]:
                    stack.append(f"<{name}>")
                elif f"<{name}>" in stack:
                    while stack.pop() != f"<{name}>":
                        pass
        elif c == "[" and spare and i > 1 and not text[i - 2].isspace() and (i == n or not text[i].isalnum()):
            spare -= 1
        elif c in "([{“«":
            stack.append(c)
        elif closed := next((x for x in _PAIRS[c] if x in stack), None):
            while stack.pop() != closed:
                pass
        elif c == "]":
            spare += 1
    return stack[-1] if stack else None


def verdict(text: str | None) -> str:
    """'whole'; 'cut' by its structure; 'bare', a sentence without terminator; 'ended', one with it; 'unsure' for an ending that fits both."""
    if text is None:
        return "whole"
    t = text.strip().strip(_BLANK).strip()
    if not t or not _WORD.search(t):
        return "whole" if open_at_end(t) in (None, '"') or len(t) < 8 else "cut"
    if unfinished(t):
        return "cut"
    if m := _MARK.search(t):
        rest = t[: m.start()].rstrip()
        if not _SERIES.match(rest) and _WORD.search(rest):
            return "cut"
    if open_at_end(t):
        return "cut"
    words = len(_WORD.findall(t))
    bare = _CLOSING_TAGS.sub("", t).rstrip("*_~`\"”»' ")
    if bare[-1:] in ".?!…":
        return "ended"
    if bare[-1:] in ")];":
        return "whole"
    parts = [p for p in _END.split(bare) if p.strip()]
    tail = parts[-1].strip() if parts else bare
    if bare.endswith(":"):
        return "bare" if len(parts) > 1 and words > 8 else "whole"
    if bare[-1:] in ",=+-−–<>/*^_&":
        return "cut" if words >= 3 else "unsure"
    if bare.endswith("}") or bare.endswith("$"):
        return "unsure" if "\\boxed" in tail or len(_WORD.findall(re.sub(r"\$[^$]*\$", "", tail))) < 3 else "bare"
    line = bare.rsplit("\n", 1)[-1].strip()
    if _OPTION.match(line) or _OPTIONS.search(line) or _SERIES.match(line) or re.fullmatch(r"(?:\d+(?:,\d+)?\s+)+\d+(?:,\d+)?", tail):
        return "whole"
    if len(parts) == 1 and words <= 5:
        return "unsure"
    if len(parts) > 1 and words <= 6 and re.match(r"(?i)(đáp|kết|answer|réponse|respuesta|antwort)", bare):
        return "unsure"
    return "bare"


def ending(c: Column) -> Column:
    """``verdict`` of a string column, once for each distinct value of a batch."""

    @F.pandas_udf("string")
    def udf(s):
        return s.map({None: "whole"} | {v: verdict(v) for v in s.dropna().unique()}).fillna("whole")

    return udf(c)


def limits(judged: DataFrame) -> DataFrame:
    """``source``, ``chars`` and ``bytes`` (arrays of its limits), ``usual`` (whether its sentences usually end without terminator).

    ``judged``: source, v (verdict), c and b (length in characters and bytes).
    Texts at a limit don't tell what is usual.
    A cut by bytes may lose up to three bytes more, at a character's edge.
    """
    # one row for each source and length: a bounded summary, whatever the table's size
    h = judged.groupBy("source", "c", "b").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == "bare").alias("bare"), F.count_if(F.col("v") == "ended").alias("ended"))
    total = h.groupBy("source").agg(F.sum("n").alias("all"))

    def piles(length: str, width: int, name: str) -> DataFrame:
        """Lengths L at which (L - width, L] holds a pile, compared with the ten lengths on either side."""
        one = h.groupBy("source", F.col(length).alias("at")).agg(F.sum("n").alias("n"))
        near = Window.partitionBy("source").orderBy("at")
        own = F.sum("n").over(near.rangeBetween(1 - width, 0))
        around = (F.sum("n").over(near.rangeBetween(1 - width - 10, 10)) - own) / (20 / width)
        top = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("own"), "at"))
        kept = one.withColumns({"own": own, "around": around}).join(total.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        kept = kept.where((F.col("own") > PILE * F.col("all")) & (F.col("own") >= LEAST) & (F.col("own") > TIMES * F.col("around")) & (F.col("at") >= SHORTEST))
        return kept.withColumn("r", top).where("r <= 50").groupBy("source").agg(F.collect_list("at").alias(name))  # at most 1/PILE of them exist

    out = total.select("source")
    for name, d in (("chars", piles("c", 1, "chars")), ("bytes", piles("b", 4, "bytes"))):
        out = out.join(d.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    # what a limit cut has no terminator, whatever is usual
    free = h.withColumnRenamed("source", "s").join(out, F.col("source").eqNullSafe(F.col("s"))).where(~at_limit()).groupBy("s").agg(F.sum("bare").alias("bare"), F.sum("ended").alias("ended"))
    usual = free.select("s", ((F.col("bare") > USUAL * (F.col("bare") + F.col("ended"))) & (F.col("bare") + F.col("ended") >= ENDINGS)).alias("usual"))
    return out.join(usual, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("usual", F.coalesce("usual", F.lit(False)))


def at_limit() -> Column:
    """Whether a row's length (c, b) is a limit of its source (chars, bytes)."""
    return F.coalesce(F.array_contains("chars", F.col("c")), F.lit(False)) | F.coalesce(F.exists("bytes", lambda x: (F.col("b") <= x) & (F.col("b") > x - 4)), F.lit(False))


def judged(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``key``, ``source``, ``cut`` of each row with a text (null: no row); the texts are read once.

    Blank texts are never cut; very long texts are read whole; every row,
    repeated ones too, gets its own verdict; null sources have their own
    baseline; an empty table stays empty.
    """
    texts = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text"))
    own = shared_table(texts.select("key", "source", ending(F.col("text")).alias("v"), F.length("text").alias("c"), F.octet_length("text").alias("b")))
    lim = shared_table(limits(own)).withColumnRenamed("source", "s")
    few = lim.count() <= FEW_SOURCES
    both = own.join(F.broadcast(lim) if few else lim, F.col("source").eqNullSafe(F.col("s")), "left")
    at = at_limit()
    cut = (F.col("v") == "cut") | ((F.col("v") == "bare") & (~F.col("usual") | at)) | ((F.col("v") == "unsure") & at)
    return both.select(F.col("key").alias(key), F.col("source").alias(source), cut.alias("cut"))


def found(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``key`` and ``source`` of records whose text was cut; no row twice."""
    return judged(spread(df.select(key, text, source)), key, text, source).where("cut").select(key, source).distinct()


def shares(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """For each source: texts, cut texts and their share; a record delivered twice counts once."""
    one = judged(spread(df.select(key, text, source)), key, text, source).groupBy(source, key).agg(F.max("cut").alias("cut"))
    return one.groupBy(source).agg(F.count(F.lit(1)).alias("texts"), F.count_if("cut").alias("cut_texts")).withColumn("share", F.col("cut_texts") / F.col("texts"))
