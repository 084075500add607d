"""Model adapters: a protocol, deterministic stand-ins, and the operator that calls them.

Calls run in Arrow batches, once per distinct prompt of a batch; a failing
call gives an error in its row and leaves the others alone.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import raster
from ..functions.text import TITLE_LIST, boxed, clean_reply, parse_exercises

PROVIDERS = ("openai", "azure", "google", "claude")


class Model(Protocol):
    """What an adapter offers: a reply for a prompt."""

    def process(self, prompt: str) -> str: ...


@dataclass(frozen=True)
class Settings:
    """Call parameters of a remote provider; keys come from the caller and are never part of a plan."""

    provider: str
    name: str
    host: str | None = None
    version: str | None = None
    temperature: float = 0.2
    top_p: float = 0.75
    max_tokens: int = 16384
    timeout: float = 45.0
    retries: int = 3

    penalty: float = 0.5

    def arguments(self) -> dict[str, object]:
        """What a call passes on: claude takes no penalties, google no host, azure its version."""
        out = {"model": self.name, "temperature": self.temperature, "top_p": self.top_p, "max_tokens": self.max_tokens, "timeout": self.timeout, "max_retries": self.retries}
        if self.provider != "claude":
            out |= {"frequency_penalty": self.penalty, "presence_penalty": self.penalty}
        if self.host and self.provider != "google":
            out["base_url"] = self.host
        if self.provider == "azure":
            out["api_version"] = self.version
        return out

    def __post_init__(self):
        if self.provider not in PROVIDERS:
            raise ValueError(f"unknown provider {self.provider!r}")
        if self.provider == "azure" and not (self.host and self.version):
            raise ValueError("azure needs host and version")


class StubExtractor:
    """Stands in for the extraction model: one exercise for each text, its answer after the last question mark."""

    def process(self, prompt: str) -> str:
        if not prompt.strip():
            raise ValueError("empty prompt")
        head, mark, tail = prompt.rpartition("?")
        q, a = (head + mark, tail.strip() or None) if mark else (prompt, None)
        return "```json\n" + json.dumps({"exercise_list": [{"question": q.strip(), "answer": a}]}, ensure_ascii=False) + "\n```"


class StubSolver:
    """Stands in for the solver: a boxed value that depends on the prompt alone."""

    def process(self, prompt: str) -> str:
        return f"Đáp số: $\\boxed{{{int(hashlib.sha256(prompt.encode()).hexdigest()[:6], 16) % 1000}}}$"


def with_retry(call: Callable[[str], str], prompt: str, times: int = 3, wait: float = 0.0) -> tuple[str | None, str | None]:
    """Reply and error of a call, tried again up to ``times``."""
    error = None
    for k in range(times):
        try:
            return call(prompt), None
        except Exception as e:  # noqa: BLE001  whatever a model raises belongs to its row
            error = f"{type(e).__name__}: {e}"
            if wait and k + 1 < times:
                time.sleep(wait)
    return None, error


def call_model(df: DataFrame, prompt: str, make: Callable[[], Model], reply: str = "reply", retries: int = 3) -> DataFrame:
    """``df`` with the columns ``reply`` and ``error``; the model is made once per task."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(frames):
        model, memo = make(), {}
        for f in frames:
            for p in f[prompt].dropna().unique():
                if p not in memo:
                    memo[p] = with_retry(model.process, p, retries)
            got = [memo[p] if isinstance(p, str) else (None, "ValueError: null prompt") for p in f[prompt]]
            yield f.assign(**{reply: pd.Series([g[0] for g in got], index=f.index, dtype=object), "error": pd.Series([g[1] for g in got], index=f.index, dtype=object)})
            if len(memo) > 100_000:
                memo.clear()

    return df.mapInPandas(run, f"{fields}, `{reply}` string, `error` string")


def extract(df: DataFrame, text: str, make: Callable[[], Model] = StubExtractor) -> tuple[DataFrame, DataFrame]:
    """Exercises of texts (one row each, with ``seq``), and the rows whose reply couldn't be used, with the error."""
    replied = call_model(df, text, make).withColumn("list", parse_exercises(clean_reply(F.col("reply"))))
    good = replied.where("list is not null").select(*df.columns, F.posexplode("list").alias("seq", "e")).select(*df.columns, "seq", "e.question", "e.answer")
    bad = replied.where("list is null").select(*df.columns, "reply", F.coalesce("error", F.lit("not an exercise list")).alias("error"))
    return good, bad


class Renewing:
    """A model that is made anew after so many calls, and once more when a call fails."""

    def __init__(self, make: Callable[[], Model], after: int = 100):
        self.make, self.after, self.calls, self.model = make, after, 0, make()

    def process(self, prompt: str) -> str:
        self.calls += 1
        if self.calls > self.after:
            self.calls, self.model = 1, self.make()
        try:
            return self.model.process(prompt)
        except Exception:  # noqa: BLE001  whatever it raises, a fresh model tries once
            self.model = self.make()
            return self.model.process(prompt)


class StubFixer:
    """Stands in for the model that repairs replies: closes what a cut reply left open."""

    def process(self, prompt: str) -> str:
        stack, quoted, skip = [], False, False
        for c in prompt:
            if skip:
                skip = False
            elif quoted:
                skip, quoted = c == "\\", c != '"'
            elif c == '"':
                quoted = True
            elif c in "{[":
                stack.append("}" if c == "{" else "]")
            elif c in "}]" and stack:
                stack.pop()
        return prompt + '"' * quoted + "".join(reversed(stack))


def repair(bad: DataFrame, columns: list[str], make: Callable[[], Model] = StubFixer) -> tuple[DataFrame, DataFrame]:
    """Replies that were no exercise list, through a repairing model once: exercises of those that are one now, and the rows that stay bad."""
    replied = call_model(bad.select(*columns, F.coalesce(clean_reply(F.col("reply")), F.lit("")).alias("invalid"), F.col("error").alias("first_error")), "invalid", make)
    parsed = replied.withColumn("list", parse_exercises(clean_reply(F.col("reply"))))
    good = parsed.where("list is not null").select(*columns, F.posexplode("list").alias("seq", "e")).select(*columns, "seq", "e.question", "e.answer")
    return good, parsed.where("list is null").select(*columns, F.col("invalid").alias("reply"), F.coalesce("error", "first_error").alias("error"))


def solve(exercises: DataFrame, question: str, answer: str, make: Callable[[], Model] = StubSolver, step_by_step: bool = True, final: bool = True) -> DataFrame:
    """Exercises with the solver's answer in place of the extracted one, and the final answer from its box, as the flags ask; a failed call leaves the answer null and its error in ``error``."""
    out = exercises.withColumn("error", F.lit(None).cast("string"))
    if step_by_step:
        out = call_model(exercises, question, make, "__solution").withColumn(answer, F.col("__solution")).drop("__solution")
    return out.withColumn("final_answer", boxed(F.col(answer))) if final else out


def exercise_titles(replies: DataFrame, reply: str) -> DataFrame:
    """Titles and boxes that a model found on page pictures: one row each with ``seq``, ``title`` and ``box`` (x1, y1, x2, y2)."""
    rows = replies.select(*[c for c in replies.columns if c != reply], F.posexplode(F.from_json(clean_reply(F.col(reply)), TITLE_LIST)["exercise_title_list"]).alias("seq", "t"))
    b = F.col("t.bounding_box")
    box = F.when(F.size(b) == 4, F.struct(*[F.get(b, F.lit(k)).alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))]))
    return rows.withColumns({"title": F.col("t.exercise_title_index"), "box": box}).drop("t")


class StubDetector:
    """Stands in for the line detector: the darkness of a page as its probability map."""

    def process(self, page: np.ndarray) -> np.ndarray:
        return 1 - page.mean(2) / 255


class StubRecogniser:
    """Stands in for the recogniser: token ids of a line picture that depend on its size alone, and a score."""

    def process(self, batch: np.ndarray) -> list[tuple[list[int], float]]:
        return [([1, 4 + int(x.shape[2]) % 26, 2], float(min(1.0, 1 - x.mean()))) for x in batch]


PAGE_LINES = "doc string, page_idx int, line_id int, polygon array<struct<x:int,y:int>>, score double, bbox struct<x1:int,y1:int,x2:int,y2:int>, ids array<int>, confidence double, error string"


def read_pages(pages: DataFrame, detector: Callable[[], object] = StubDetector, recogniser: Callable[[], object] = StubRecogniser, batch: int = 32) -> DataFrame:
    """Recognised lines of page pictures (doc, page_idx, height, width, channels, pixels).

    A page is read once: the detector's map gives polygons, each line is cut
    out of the page, turned upright and recognised in batches of similar
    width.  A page that fails gives one row with its error; crops without
    extent give none.  Pages are spread by (doc, page_idx) before the call.
    """

    def lines(r, find, read) -> list[tuple]:
        img = np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, r.channels)
        crops = []
        for k, (polygon, score) in enumerate(raster.detect(find.process(img), (r.width, r.height))):
            (x1, y1), (x2, y2) = np.min(polygon, 0), np.max(polygon, 0)
            if x2 > x1 and y2 > y1:
                crops.append((k, polygon, score, (int(x1), int(y1), int(x2), int(y2)), raster.upright(img[y1:y2, x1:x2])))
        crops.sort(key=lambda c: c[4].shape[1] / c[4].shape[0])
        out = []
        for at in range(0, len(crops), batch):
            part = crops[at : at + batch]
            for (k, polygon, score, box, _), (ids, sure) in zip(part, read.process(raster.line_batch([c[4] for c in part])), strict=True):
                out.append((r.doc, r.page_idx, k, [{"x": x, "y": y} for x, y in polygon], score, dict(zip(("x1", "y1", "x2", "y2"), box, strict=True)), ids, sure, None))
        return sorted(out, key=lambda row: row[2])

    names = [x.split(" ")[0] for x in PAGE_LINES.split(", ")]

    def run(frames):
        find, read = detector(), recogniser()
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                try:
                    rows += lines(r, find, read)
                except Exception as e:  # noqa: BLE001  a page's failure is its own
                    rows.append((r.doc, r.page_idx, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            if rows:
                out = pd.DataFrame(rows, columns=names)
                yield out.assign(line_id=out["line_id"].astype("Int32"))

    return pages.select("doc", "page_idx", "height", "width", "channels", "pixels").repartition("doc", "page_idx").mapInPandas(run, PAGE_LINES)
