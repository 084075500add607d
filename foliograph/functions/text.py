"""Text functions of recognition and extraction: columns in, columns out, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts with which an exercise begins, as recognised (one right, four misread, three with noise before).
MARKERS = ["Câu", "Cấu", "Cầu", "Cẩu", "Côu", ">>Câu", ">> Câu", "n Câu"]
#: What the id of unknown characters stands for.
MASK = "*"
#: Exercises found on a page picture: title and box (x_min, y_min, x_max, y_max).
TITLE_LIST = T.StructType([T.StructField("exercise_title_list", T.ArrayType(T.StructType([T.StructField("exercise_title_index", T.StringType()), T.StructField("bounding_box", T.ArrayType(T.IntegerType()))])))])
#: One extracted exercise, and the list a model returns.
EXERCISE_LIST = T.StructType([T.StructField("exercise_list", T.ArrayType(T.StructType([T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())])))])


def is_marker(text: Column, prefixes: list[str] = MARKERS) -> Column:
    """Whether a line begins an exercise; an OR of prefixes, which a Parquet scan can take over."""
    out = F.lit(False)
    for p in prefixes:
        out = out | text.startswith(p)
    return out


def strip(text: Column) -> Column:
    """White space of any kind removed at both ends (``trim`` knows the space only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_repeats(text: Column) -> Column:
    """Three or more repetitions of the last word in a row become one; the word is taken literally."""
    t = strip(text)
    last = F.element_at(F.split(t, " "), -1)
    quoted = F.concat(F.lit(r"( \Q"), last, F.lit(r"\E){3,}"))
    literal = F.regexp_replace(last, r"([\\$])", r"\\$1")
    return F.when(F.length(last) > 0, F.regexp_replace(t, quoted, F.concat(F.lit(" "), literal))).otherwise(t)


def drop_dot_runs(text: Column) -> Column:
    """Runs of four dots or more removed; white space before them stays."""
    return F.regexp_replace(strip(text), r"\.{4,}", "")


def repair_line(text: Column) -> Column:
    """What recognition does with a raw line: repeated last words, then runs of dots."""
    return drop_dot_runs(collapse_repeats(text))


def threshold(given: Column, default: float = 0.6) -> Column:
    """A threshold given as text: null means the default, what isn't a number means 0.2."""
    return F.when(given.isNull(), F.lit(default)).otherwise(F.coalesce(given.try_cast("double"), F.lit(0.2)))


def gate(text: Column, confidence: Column, limit: Column) -> Column:
    """Text of low confidence becomes empty; the row stays."""
    return F.when(confidence < limit, F.lit("")).otherwise(text)


def clean_reply(reply: Column, literal: bool = False) -> Column:
    """A model's reply without its code fence; ``literal`` removes every fence mark and every "json" instead."""
    t = strip(reply)
    if literal:
        return F.replace(F.replace(t, F.lit("```")), F.lit("json"))
    return F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```$", "")


def parse_exercises(reply: Column) -> Column:
    """The exercise list of a reply, null where the reply isn't such a JSON object."""
    return F.from_json(reply, EXERCISE_LIST)["exercise_list"]


def box_pattern(depth: int = 6) -> str:
    r"""A pattern of ``\boxed{}`` with braces nested up to ``depth`` deep."""
    inner = r"[^{}]*"
    for _ in range(depth):
        inner = rf"(?:[^{{}}]|\{{{inner}\}})*"
    return rf"\\boxed\{{({inner})\}}"


def boxed(answer: Column, depth: int = 6) -> Column:
    r"""What stands in the first ``\boxed{}`` whose braces match, nested ones too; null if there is none."""
    p = box_pattern(depth).replace(")*", ")*+").replace("]*", "]*+")
    return F.when(answer.rlike(p), F.regexp_extract(answer, p, 1))


def data_url(content: Column, kind: str = "image/jpeg") -> Column:
    """Bytes as a data URL; line breaks of the encoder removed."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.translate(F.base64(content), "\r\n", ""))


def render(template: Column, **values: Column) -> Column:
    """Placeholders ``{name}`` replaced literally; a null value leaves an empty text."""
    for name, v in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return template


def encode(text: Column, vocabulary: str) -> Column:
    """Ids of the characters between 1 (start) and 2 (end); the first character has id 4, unknown ones 3."""
    ids = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(vocabulary)).cast("int") + 3)
    return F.concat(F.array(F.lit(1)), ids, F.array(F.lit(2)))


def decode(ids: Column, vocabulary: str) -> Column:
    """Text of ids: from after the first place if any id is 1, up to the first 2; 3 is the mask character, 0 and 1 the names of their marks."""
    v = F.lit(vocabulary)
    begin = F.when(F.array_contains(ids, 1), 2).otherwise(1)
    end = F.array_position(ids, 2)
    n = F.greatest(F.when(end > 0, end - begin).otherwise(F.size(ids) - begin + 1), F.lit(0))
    return F.array_join(F.transform(F.slice(ids, begin, n.cast("int")), lambda i: F.when(i > 3, F.substring(v, i - 3, F.lit(1))).when(i == 3, MASK).when(i == 0, "<pad>").otherwise("<sos>")), "")


def space_out(text: Column) -> Column:
    r"""Characters parted by blanks, words by ``\;``."""
    words = F.filter(F.split(strip(text), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.array_join(F.filter(F.split(w, ""), lambda c: c != ""), " ")), " \\; ")


def close_up(text: Column) -> Column:
    """The inverse of ``space_out``, up to white space."""
    return F.replace(F.replace(text, F.lit(" ")), F.lit("\\;"), F.lit(" "))


def join_tokens(tokens: Column, end: str = "</s>") -> Column:
    r"""Tokens up to the end mark, ``\,`` and white space dropped, ``\;`` as a space."""
    at = F.array_position(tokens, end)
    kept = F.slice(tokens, F.lit(1), F.when(at > 0, at - 1).otherwise(F.size(tokens)).cast("int"))
    return F.array_join(F.transform(kept, lambda t: F.replace(F.regexp_replace(F.replace(t, F.lit("\\,")), r"\s", ""), F.lit("\\;"), F.lit(" "))), "")


def base_name(path: Column, suffix: str = ".pdf") -> Column:
    """The last part of a path, with every ``suffix`` removed."""
    return F.replace(F.element_at(F.split(path, "/"), -1), F.lit(suffix))


def path_part(path: Column, no: int) -> Column:
    """Part ``no`` (from 0) of a path: a model's folder, its version; null beyond the end."""
    return F.get(F.split(path, "/"), F.lit(no))


def first_longest(values: Column) -> Column:
    """The longest of several texts or lists, the first one of equals; null of none."""
    sized = F.transform(values, lambda v, i: F.struct(F.length(v).alias("n"), (-i).alias("i"), v.alias("v")))
    return F.array_max(sized)["v"]


def drawable(label: Column, name: Column, colours: int = 255) -> Column:
    """Whether a recognised field is drawn: its label has a colour and it isn't a key."""
    return F.coalesce((label >= 0) & (label < colours) & ~name.startswith("key"), F.lit(False))
