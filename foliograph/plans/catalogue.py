"""The queries of the core operators and their SQL, over whole tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import raster
from ..functions import text as T
from ..operators import annotations, batching, quality, segment
from ..session import table
from ..sources import sinks
from . import models

#: Letters of recognised text by rule: printable ASCII, and Latin letters with Vietnamese marks.  Models bring vocabularies of their own, so ids here aren't theirs.
VOCABULARY = "".join(map(chr, range(32, 127))) + "".join(chr(c) for c in [*range(0xC0, 0x180), 0x1A0, 0x1A1, 0x1AF, 0x1B0, *range(0x1EA0, 0x1EFA)])
TEMPLATE = "Môn {subject}, lớp {grade_level}: {input}"

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(fn):
        _Q[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return keep


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _ocr(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The last delivery of each line; queries on pages get it by an exchange by page that they use further on."""
    within = ("doc", "page_idx") if {"doc", "page_idx"} <= set(columns) else ()
    return segment.latest(table(spark, d, "ocr_output").select("ocr_id", *columns, "ingested_at"), "ocr_id", "ingested_at", within).drop("ingested_at")


def _exercise(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return segment.latest(table(spark, d, "exercise").select("exercise_id", *columns, "ingested_at"), "exercise_id", "ingested_at").drop("ingested_at")


OCR = "ocr as (select * from ocr_output qualify row_number() over (partition by ocr_id order by ingested_at desc) = 1)"
EX = "ex as (select * from exercise qualify row_number() over (partition by exercise_id order by ingested_at desc) = 1)"
HIT = "(" + " or ".join(f"starts_with(prediction, '{p}')" for p in T.MARKERS) + ")"
MARK = f"{OCR}, mark as (select doc, page_idx, idx, bbox.y1 as y from ocr where {HIT})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- pages, markers, bands -------------------------------------------------------------------------------------------


@_query("""with pages as (select distinct doc, page_idx from ocr_output), n as (select doc, max(page_idx) + 1 as n from pages group by doc),
w as (select job_id, j.doc, case when start_page is null then 0 when start_page < 0 then greatest(n + start_page, 0) else least(start_page, n) end as a,
case when end_page is null then n when end_page < 0 then greatest(n + end_page, 0) else least(end_page, n) end as b from pdf_job j join n on n.doc = j.doc)
select job_id, w.doc as doc, page_idx from w join pages p on p.doc = w.doc where page_idx >= a and page_idx < b""")
def page_range_slice(spark, d):
    """Pages of each job, sliced as in Python."""
    return segment.page_slice(table(spark, d, "ocr_output").select("doc", "page_idx").distinct(), table(spark, d, "pdf_job"))


@_query("""select doc_id, (unnest(generate_series(1, len(string_split(text, chr(10))))) - 1)::int as line_no, unnest(string_split(text, chr(10))) as line from documents where text is not null""")
def line_fanout(spark, d):
    """Lines of each document with their numbers."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@_query(f"with {MARK} select doc, page_idx, idx, y from mark")
def marker_filter(spark, d):
    """Lines that begin an exercise."""
    return _markers(spark, d)


def _markers(spark, d):
    return segment.latest_markers(table(spark, d, "ocr_output"))


_BAND = "select doc, page_idx, (row_number() over w - 1)::int as ex_idx, y, lag(y) over w as prev, lead(y) over w as nxt, lead(y, 2) over w as nxt2 from mark window w as (partition by doc, page_idx order by y, idx)"


@_query(f"with {MARK}, b as ({_BAND}) select doc, page_idx, ex_idx, greatest(y - 10, 0) as y_from, least(nxt + 5, 1754) as y_to from b where nxt is not null")
def exercise_bands(spark, d):
    """Bands between markers; the last marker of a page only closes one."""
    return segment.bands(_markers(spark, d))


@_query(f"with {MARK}, b as ({_BAND}) select doc, page_idx, ex_idx, greatest(y - 10, 0) as y_from, coalesce(least(nxt + 5, 1754), 1754) as y_to from b")
def bands_include_last(spark, d):
    """Bands with an open last one."""
    return segment.bands(_markers(spark, d), include_last=True)


_CONTEXT = """c as (select *, ('0x' || substr(md5(doc || '|' || page_idx || '|' || ex_idx), 1, 8))::bigint / 4294967296.0 as p from b where nxt is not null),
ctx as (select doc, page_idx, ex_idx, case when ex_idx = 0 then y when p < 0.33 then prev when p < 0.66 then y else prev end as y_from,
case when ex_idx = 0 then coalesce(nxt2, 1754) when p < 0.33 then nxt else coalesce(nxt2, 1754) end as y_to from c)"""


@_query(f"with {MARK}, b as ({_BAND}), {_CONTEXT} select * from ctx")
def context_bands(spark, d):
    """Bands with a neighbouring exercise before, after or on both sides."""
    return segment.context_bands(_markers(spark, d))


_RECORDS = """r as (select doc, page_idx, ex_idx, greatest(y - 10, 0) as y_from, least(nxt + 5, 1754) as y_to, 'tight' as variant from b where nxt is not null
union all select *, 'context' from ctx)"""


@_query(f"""with {MARK}, b as ({_BAND}), {_CONTEXT}, {_RECORDS} select *, 'data/' || doc || '/output_image/page_' || page_idx || '/' ||
case when variant = 'context' then 'padding_exercise_image_' else 'exercise_image_' end || ex_idx || '.png' as image from r""")
def exercise_records(spark, d):
    """Flagship: two records for each exercise, with the paths of their pictures."""
    m = _markers(spark, d)
    return segment.records(segment.bands(m), segment.context_bands(m))


@_query(f"""with {OCR}, x as (select doc, page_idx, idx, prediction, sum(case when {HIT} then 1 else 0 end) over (partition by doc, page_idx order by idx) as no from ocr),
y as (select *, max(no) over (partition by doc, page_idx) as al from x)
select doc, page_idx, (no - 1)::int as ex_idx, count(*) as n_lines, string_agg(coalesce(prediction, ''), chr(10) order by idx) as text from y where no >= 1 and no < al group by doc, page_idx, no""")
def exercise_band_text(spark, d):
    """Text of each band."""
    return segment.band_text(_ocr(spark, d, "doc", "page_idx", "idx", "prediction"))


@_query(f"with {EX} select exercise_id, variant from ex, (values ('tight'), ('context')) v(variant)")
def record_variants(spark, d):
    """Each exercise twice."""
    return segment.variants(_exercise(spark, d)).select("exercise_id", "variant")


@_query(f"""with {OCR}, x as (select ocr_id, doc, page_idx, idx, bbox.y2 - bbox.y1 as h from ocr),
y as (select *, count(*) over (partition by doc, page_idx) as n, row_number() over (partition by doc, page_idx order by h desc, idx) as r from x),
z as (select *, max(case when r = 3 then h end) over (partition by doc, page_idx) as m3 from y) select ocr_id, h from z where n <= 3 or h * 3 >= m3""")
def small_line_filter(spark, d):
    """Lines without those much lower than the highest of their page."""
    return segment.small_lines(_ocr(spark, d, "doc", "page_idx", "idx", "bbox")).select("ocr_id", "h")


@_query(f"with {OCR} select ocr_id, idx from ocr where idx < 1000 and least(bbox.x2 - bbox.x1, bbox.y2 - bbox.y1) >= 3 and confidence >= 0.4 and least(bbox.x2 - bbox.x1, bbox.y2 - bbox.y1) * confidence >= 20")
def candidate_filter(spark, d):
    """Lines that pass the detector's filters; a side weighted by the confidence stands for the grown one, in quarters."""
    side = F.least(F.col("bbox.x2") - F.col("bbox.x1"), F.col("bbox.y2") - F.col("bbox.y1"))
    return annotations.candidates(_ocr(spark, d, "idx", "bbox", "confidence"), "idx", side, F.col("confidence"), side * F.col("confidence") / 4).select("ocr_id", "idx")


@_query()
def reading_order(spark, d):
    """Position of each line on its page by the box comparator."""
    return annotations.reading_order(_ocr(spark, d, "doc", "page_idx", "bbox"))


# --- text ------------------------------------------------------------------------------------------------------------

_STRIP = r"regexp_replace({0}, '^[\s\x0b\x{{85}}\p{{Z}}]+|[\s\x0b\x{{85}}\p{{Z}}]+$', '', 'g')"
_S = _STRIP.format("prediction_raw")
_LAST = "string_split(t, ' ')[-1]"
_COLLAPSE = f"case when length({_LAST}) > 0 then regexp_replace(t, '( ' || regexp_escape({_LAST}) || '){{3,}}', ' ' || replace({_LAST}, chr(92), chr(92) || chr(92)), 'g') else t end"


@_query(f"with {OCR}, s as (select ocr_id, {_S} as t from ocr) select ocr_id, {_COLLAPSE} as text from s")
def repeat_collapse(spark, d):
    """Repeated last words collapsed."""
    return _ocr(spark, d, "prediction_raw").select("ocr_id", T.collapse_repeats(F.col("prediction_raw")).alias("text"))


@_query(rf"with {OCR} select ocr_id, regexp_replace({_S}, '\.{{4,}}', '', 'g') as text from ocr")
def dot_run_cleanup(spark, d):
    """Runs of dots removed."""
    return _ocr(spark, d, "prediction_raw").select("ocr_id", T.drop_dot_runs(F.col("prediction_raw")).alias("text"))


@_query(rf"with {OCR}, s as (select ocr_id, confidence, {_S} as t from ocr), c as (select ocr_id, confidence, {_COLLAPSE} as u from s) select ocr_id, case when confidence < 0.6 then '' else regexp_replace({_STRIP.format('u')}, '\.{{4,}}', '', 'g') end as text from c")
def line_repair(spark, d):
    """The whole repair of a recognised line: repeats, dots, confidence gate."""
    o = _ocr(spark, d, "prediction_raw", "confidence")
    return o.select("ocr_id", T.gate(T.repair_line(F.col("prediction_raw")), F.col("confidence"), T.threshold(F.lit(None).cast("string"))).alias("text"))


@_query(f"with {OCR} select ocr_id, confidence, case when confidence < case idx % 3 when 0 then 0.6 when 1 then 0.85 else 0.2 end then '' else prediction_raw end as gated, round(exp(-confidence), 6) as e from ocr")
def confidence_gate(spark, d):
    """Text of low confidence emptied, under no threshold, a number, and a text that is none."""
    o = _ocr(spark, d, "idx", "prediction_raw", "confidence")
    given = F.when(F.col("idx") % 3 == 1, F.lit("0.85")).when(F.col("idx") % 3 == 2, F.lit("abc"))
    return o.select("ocr_id", "confidence", T.gate(F.col("prediction_raw"), F.col("confidence"), T.threshold(given)).alias("gated"), F.round(F.exp(-F.col("confidence")), 6).alias("e"))


@_query(f"with {EX} select exercise_id, question, answer from ex")
def record_json(spark, d):
    """Records written as JSON and read back: nulls and every character survive."""
    e = _exercise(spark, d, "question", "answer")
    back = F.from_json(sinks.as_json("question", "answer"), "question string, answer string")
    return e.select("exercise_id", back["question"].alias("question"), back["answer"].alias("answer"))


def _replies(spark, d):
    """One reply for each crop: the exercises found in it as a fenced list; a reply whose last answer is missing is cut short."""
    e = _exercise(spark, d, "doc", "page_idx", "ex_idx", "seq", "question", "answer")
    one = F.struct("seq", "exercise_id", F.struct("question", "answer").alias("e"))
    crop = e.groupBy("doc", "page_idx", "ex_idx").agg(F.array_sort(F.collect_list(one)).alias("l"))  # the few exercises of one crop
    body = F.to_json(F.struct(F.transform("l", lambda x: x["e"]).alias("exercise_list")), {"ignoreNullFields": "false"})
    cut = F.element_at("l", -1)["e"]["answer"].isNull()
    return crop.select("doc", "page_idx", "ex_idx", F.concat(F.lit("```json\n"), F.when(cut, F.substring(body, 1, 20)).otherwise(body), F.lit("\n```")).alias("reply"))


_CROPS = f"""{EX}, c as (select *, row_number() over w - 1 as pos, last_value(answer) over (w rows between unbounded preceding and unbounded following) as last from ex window w as (partition by doc, page_idx, ex_idx order by seq, exercise_id))"""


@_query(f"with {_CROPS} select doc, page_idx, ex_idx, pos::int as seq, question, answer from c where last is not null")
def parse_exercise_list(spark, d):
    """Model replies cleaned and parsed to exercises; replies cut short give none."""
    r = _replies(spark, d).select("doc", "page_idx", "ex_idx", F.posexplode(T.parse_exercises(T.clean_reply(F.col("reply")))).alias("seq", "e"))
    return r.select("doc", "page_idx", "ex_idx", "seq", "e.question", "e.answer")


@_query(f"with {_CROPS} select distinct doc, page_idx, ex_idx from c where last is null")
def parse_quarantine(spark, d):
    """Replies that are no exercise list."""
    return _replies(spark, d).where(T.parse_exercises(T.clean_reply(F.col("reply"))).isNull()).select("doc", "page_idx", "ex_idx")


@_query()
def reply_repair(spark, d):
    """Replies that are no exercise list, through the repairing model: what becomes one, and what stays bad."""
    bad = _replies(spark, d).where(T.parse_exercises(T.clean_reply(F.col("reply"))).isNull()).withColumn("error", F.lit("not an exercise list"))
    good, left = models.repair(bad, ["doc", "page_idx", "ex_idx"])
    none = lambda kind: F.lit(None).cast(kind)
    return good.select("doc", "page_idx", "ex_idx", "seq", "question", "answer", none("string").alias("error")).unionByName(
        left.select("doc", "page_idx", "ex_idx", none("int").alias("seq"), none("string").alias("question"), none("string").alias("answer"), "error")
    )


@_query()
def solved_exercises(spark, d):
    """Exercises with the solver's answer (a deterministic stand-in) and the final answer from its box."""
    return models.solve(_exercise(spark, d, "question", "answer"), "question", "answer").select("exercise_id", "answer", "final_answer", "error")


@_query("select doc_id, replace(replace('```json' || chr(10) || text || '```', '```', ''), 'json', '') as text from documents")
def llm_output_clean(spark, d):
    """The literal cleaning of a fenced reply, for all documents: every fence mark and every "json" removed; white space inside the fence stays, and a null text stays null."""
    return table(spark, d, "documents").select("doc_id", T.clean_reply(F.concat(F.lit("```json\n"), "text", F.lit("```")), literal=True).alias("text"))


_BOX = T.box_pattern().replace("'", "''")


@_query(f"with {EX} select exercise_id, case when regexp_matches(answer, '{_BOX}') then regexp_extract(answer, '{_BOX}', 1) end as boxed from ex where answer is not null")
def boxed_answer(spark, d):
    """Final answers from boxes."""
    return _exercise(spark, d, "answer").where("answer is not null").select("exercise_id", T.boxed(F.col("answer")).alias("boxed"))


@_query(f"select doc_id, replace(replace(replace({_q(TEMPLATE)}, '{{subject}}', coalesce(subject, '')), '{{grade_level}}', coalesce(grade::int::varchar, '')), '{{input}}', coalesce(text, '')) as prompt from documents")
def prompt_render(spark, d):
    """Prompts from a template."""
    return table(spark, d, "documents").select("doc_id", T.render(F.lit(TEMPLATE), subject=F.col("subject"), grade_level=F.col("grade"), input=F.col("text")).alias("prompt"))


@_query("select doc_id, 'data:image/jpeg;base64,' || base64(encode(text)) as url from documents")
def image_data_url(spark, d):
    """Bytes as data URLs."""
    return table(spark, d, "documents").select("doc_id", T.data_url(F.encode("text", "UTF-8")).alias("url"))


@_query(f"with {OCR} select ocr_id, list_concat([1], list_concat(list_transform(string_split(prediction, ''), lambda c: strpos({_q(VOCABULARY)}, c)::int + 3), [2])) as ids from ocr where length(prediction) > 0")
def vocab_encode(spark, d):
    """Characters to ids."""
    return _ocr(spark, d, "prediction").where("length(prediction) > 0").select("ocr_id", T.encode(F.col("prediction"), VOCABULARY).alias("ids"))


@_query(f"with {OCR} select ocr_id, array_to_string(list_transform(string_split(prediction, ''), lambda c: case when strpos({_q(VOCABULARY)}, c) > 0 then c else '*' end), '') as text from ocr where length(prediction) > 0")
def vocab_decode(spark, d):
    """Ids back to text; unknown characters come back as the mask."""
    return _ocr(spark, d, "prediction").where("length(prediction) > 0").select("ocr_id", T.decode(T.encode(F.col("prediction"), VOCABULARY), VOCABULARY).alias("text"))


@_query(rf"with {OCR} select ocr_id, regexp_replace(prediction, '[\t\n\x0b\f\r]', '', 'g') as text from ocr where length(prediction) > 0")
def join_tokens(spark, d):
    r"""Tokens (characters, and ``\;`` for a space) up to the end mark joined to text."""
    p = F.col("prediction")
    tokens = F.concat(F.transform(F.filter(F.split(p, ""), lambda c: c != ""), lambda c: F.when(c == " ", F.lit("\\;")).otherwise(c)), F.array(F.lit("</s>"), F.lit("x")))
    return _ocr(spark, d, "prediction").where("length(prediction) > 0").select("ocr_id", T.join_tokens(tokens).alias("text"))


_WORDS = rf"list_filter(regexp_split_to_array({_STRIP.format('prediction')}, '[\s\x0b\x{{85}}\p{{Z}}]+'), lambda w: w <> '')"


@_query(rf"with {OCR} select ocr_id, array_to_string(list_transform({_WORDS}, lambda w: array_to_string(string_split(w, ''), ' ')), ' \; ') as target from ocr where length(prediction) > 0")
def token_spacing(spark, d):
    """Targets with parted characters."""
    return _ocr(spark, d, "prediction").where("length(prediction) > 0").select("ocr_id", T.space_out(F.col("prediction")).alias("target"))


@_query(rf"with {OCR} select ocr_id, array_to_string({_WORDS}, ' ') as text from ocr where length(prediction) > 0")
def token_unspacing(spark, d):
    """Targets closed up again."""
    return _ocr(spark, d, "prediction").where("length(prediction) > 0").select("ocr_id", T.close_up(T.space_out(F.col("prediction"))).alias("text"))


@_query(f"with {EX}, p as (select exercise_id, 'data/' || doc || '.pdf' as path from ex) select exercise_id, replace(string_split(path, '/')[-1], '.pdf', '') as doc from p")
def path_parts(spark, d):
    """Document names from paths."""
    return _exercise(spark, d, "doc").select("exercise_id", T.base_name(F.concat(F.lit("data/"), "doc", F.lit(".pdf"))).alias("doc"))


# --- alignment and quality -------------------------------------------------------------------------------------------


@_query(f"""with {EX}, q as (select doc, question, row_number() over (partition by doc order by exercise_id) as line_no from ex),
a as (select doc, answer, row_number() over (partition by doc order by exercise_id) as line_no from ex where answer is not null)
select q.doc as doc, q.line_no - 1 as line_no, question, answer from q join a on a.doc = q.doc and a.line_no = q.line_no""")
def positional_zip(spark, d):
    """Questions and given answers of a document by position, cut to the shorter list."""
    from ..sources.readers import number_rows

    e = _exercise(spark, d, "doc", "question", "answer")
    q = number_rows(e.select("doc", "question", "exercise_id"), ["doc"], ["exercise_id"]).drop("exercise_id")
    a = number_rows(e.where("answer is not null").select("doc", "answer", "exercise_id"), ["doc"], ["exercise_id"]).drop("exercise_id")
    return q.join(a, ["doc", "line_no"]).select("doc", F.col("line_no").cast("long").alias("line_no"), "question", "answer")


@_query(f"""with {EX}, r as (select exercise_id, max(final_answer) as got from output_record group by exercise_id),
x as (select case when r.exercise_id is null then null when ex.final_answer is not distinct from got then 1.0 else 0.0 end as acc from ex left join r on r.exercise_id = ex.exercise_id)
select count(*) as labels, round(avg(acc), 9) as mean_accuracy, round(count(*) filter (where acc = 1) / count(*), 9) as exact_share, coalesce(avg(acc) >= 0.7, false) as passed from x""")
def exact_match_summary(spark, d):
    """How many labels the written records match; labels without a record count as not matched."""
    r = table(spark, d, "output_record").groupBy("exercise_id").agg(F.max("final_answer").alias("got"), F.lit(True).alias("there"))
    x = _exercise(spark, d, "final_answer").join(r, "exercise_id", "left")
    acc = F.when(F.col("there"), F.col("final_answer").eqNullSafe(F.col("got")).cast("double"))
    return quality.summary(x.select(acc.alias("acc")), F.col("acc")).withColumns({c: F.round(c, 9) for c in ("mean_accuracy", "exact_share")})


@_query()
def text_differences(spark, d):
    """What differs between repaired and raw lines, in words."""
    return _ocr(spark, d, "prediction", "prediction_raw").select("ocr_id", quality.difference("prediction", "prediction_raw").alias("explanation"))


@_query()
def char_accuracy(spark, d):
    """Character accuracy of repaired lines against raw ones."""
    return _ocr(spark, d, "prediction", "prediction_raw").select("ocr_id", quality.char_accuracy("prediction_raw", "prediction").alias("accuracy"))


@_query("""with e as (select label, embedding[1]::double * 90 as a from embeddings), v as (select label, a, floor(a / 10) as bin from e where a >= -90 and a < 80),
b as (select label, bin, count(*) as n, avg(a) as mean from v group by all), m as (select *, row_number() over (partition by label order by n desc, bin) as r from b)
select l.label, round(coalesce(-mean, 0), 6) as angle from (select distinct label from embeddings) l left join m on m.label = l.label and r = 1""")
def modal_rotation(spark, d):
    """Page angle as the mean of the fullest bin."""
    e = table(spark, d, "embeddings")
    return quality.modal_angle(e, "label", F.element_at("embedding", 1).cast("double") * 90).withColumn("angle", F.round("angle", 6))


@_query("""with e as (select *, 'x' as k from documents)
select doc_id, ws[list_position(list_transform(ws, lambda w: length(w)), list_max(list_transform(ws, lambda w: length(w))))] as word from (select doc_id, string_split(text, ' ') as ws from e where text is not null)""")
def longest_words(spark, d):
    """The first of the longest blank-separated words of each document."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.first_longest(F.split("text", " ")).alias("word"))


@_query(r"select doc_id, string_split(path, '/')[1] as model, string_split(path, '/')[2] as version from (select doc_id, coalesce(subject, 'none') || '/' || coalesce(grade::int, 0) || '/model.onnx' as path from documents)")
def model_path_parts(spark, d):
    """Model and version from artifact paths."""
    path = F.concat_ws("/", F.coalesce("subject", F.lit("none")), F.coalesce("grade", F.lit(0)).cast("string"), F.lit("model.onnx"))
    return table(spark, d, "documents").select("doc_id", T.path_part(path, 0).alias("model"), T.path_part(path, 1).alias("version"))


@_query("select event_id from events where user_id % 300 < 255 and not starts_with('key_' || event_type, 'key_c') and not starts_with(event_type, 'key')")
def drawn_fields(spark, d):
    """Events as recognised fields: those whose label has a colour and that are no keys."""
    name = F.when(F.col("event_type").startswith("c"), F.concat(F.lit("key_"), "event_type")).otherwise(F.col("event_type"))
    return table(spark, d, "events").where(T.drawable(F.col("user_id") % 300, name)).select("event_id")


@_query(f"with {OCR} select ocr_id from ocr where bbox.x2 > bbox.x1 and bbox.y2 - bbox.y1 > ocr_id % 40")
def crops_with_extent(spark, d):
    """Lines whose crop, less a part of its height, has extent."""
    b = F.col("bbox")
    return _ocr(spark, d, "bbox").where(G.has_extent(b["x1"], b["y1"] + F.col("ocr_id") % 40, b["x2"], b["y2"])).select("ocr_id")

@_query("""select 'event_type' as "column", max(length(event_type))::int as width from events union all select 'props', max(length(props))::int from events""")
def report_column_width(spark, d):
    """Widths of report columns."""
    return sinks.column_widths(table(spark, d, "events").select("event_type", "props"))


@_query(f"""with recursive {OCR}, x as (select doc, page_idx, idx, (bbox.x2 - bbox.x1)::double / (bbox.y2 - bbox.y1) as r, row_number() over (partition by doc, page_idx order by (bbox.x2 - bbox.x1)::double / (bbox.y2 - bbox.y1), idx) as k from ocr),
f as (select doc, page_idx, idx, k, 0 as batch, 1 as n, r as pivot from x where k = 1 union all
select x.doc, x.page_idx, x.idx, x.k, case when f.n >= 8 or x.r - f.pivot >= 0.4 then f.batch + 1 else f.batch end, case when f.n >= 8 or x.r - f.pivot >= 0.4 then 1 else f.n + 1 end, case when f.n >= 8 or x.r - f.pivot >= 0.4 then x.r else f.pivot end
from f join x on x.doc = f.doc and x.page_idx = f.page_idx and x.k = f.k + 1) select doc, page_idx, idx, batch from f""")
def ratio_batches(spark, d):
    """Batches of lines of similar shape on each page."""
    o = _ocr(spark, d, "doc", "page_idx", "idx", "bbox")
    r = (F.col("bbox.x2") - F.col("bbox.x1")).cast("double") / (F.col("bbox.y2") - F.col("bbox.y1"))
    return batching.ratio_batches(o.withColumn("ratio", r), ["doc", "page_idx"], "ratio", "idx", most=8)


@_query(_SQL["ratio_batches"].replace("select doc, page_idx, idx, batch from f", """, g as (select f.*, greatest(trunc(x.r * 64 / 4)::int * 4, 4) as w from f join x on x.doc = f.doc and x.page_idx = f.page_idx and x.idx = f.idx)
select doc, page_idx, idx, batch, max(w) over (partition by doc, page_idx, batch) as padded from g"""))
def batch_widths(spark, d):
    """Width at height 64 to which each line of a batch is padded."""
    o = _ocr(spark, d, "doc", "page_idx", "idx", "bbox")
    r = (F.col("bbox.x2") - F.col("bbox.x1")).cast("double") / (F.col("bbox.y2") - F.col("bbox.y1"))
    o = o.withColumn("ratio", r).withColumn("w", F.greatest((F.col("ratio") * 64 / 4).cast("int") * 4, F.lit(4)))
    b = batching.ratio_batches(o, ["doc", "page_idx"], "ratio", "idx", most=8).join(o.select("doc", "page_idx", "idx", "w"), ["doc", "page_idx", "idx"])
    return batching.batch_widths(b, ["doc", "page_idx"], "w", "idx")


@_query("""with n as (select user_id, count(*) as n from events group by user_id), s as (select user_id, i::int as slot, round_even(i * (n - 1) / 9.0, 0)::int as at from n, generate_series(0, 9) g(i)),
e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as at from events) select s.user_id as user_id, slot, event_id from s join e on e.user_id = s.user_id and e.at = s.at""")
def even_sampling(spark, d):
    """Ten evenly spaced events of each user."""
    return batching.even_sample(table(spark, d, "events"), "user_id", ["ts", "event_id"]).select("user_id", "slot", "event_id")


# --- geometry and sizes ----------------------------------------------------------------------------------------------


def _boxes(spark, d):
    b = F.col("bbox")
    return _ocr(spark, d, "bbox").select("ocr_id", *[b[c].alias(c) for c in ("x1", "y1", "x2", "y2")], (b["x2"] - b["x1"]).alias("w"), (b["y2"] - b["y1"]).alias("h"))


BOX = f"{OCR}, box as (select ocr_id, bbox.x1 as x1, bbox.y1 as y1, bbox.x2 as x2, bbox.y2 as y2, bbox.x2 - bbox.x1 as w, bbox.y2 - bbox.y1 as h from ocr)"
PTS = "pts as (select vec_id, list_transform(range(1, 33), lambda i: struct_pack(x := embedding[2*i-1]::double, y := embedding[2*i]::double)) as p from embeddings)"


def _points(spark, d):
    e = table(spark, d, "embeddings")
    v = lambda i: F.element_at("embedding", i.cast("int")).cast("double")
    return e.select("vec_id", F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.struct(v(2 * i - 1).alias("x"), v(2 * i).alias("y"))).alias("p"))


def _flat(p) -> list:
    """Coordinates of four corners as columns ``px1`` to ``py4``."""
    return [F.get(p, F.lit(k))[c].alias(f"p{c}{k + 1}") for k in range(4) for c in ("x", "y")]


@_query(f"with {BOX} select ocr_id, x1 as px1, y1 as py1, x1 + w as px2, y1 as py2, x1 + w as px3, y1 + h as py3, x1 as px4, y1 + h as py4 from box")
def rect_to_polygon(spark, d):
    """Corners of line boxes."""
    b = _boxes(spark, d).withColumn("p", G.rectangle(F.col("x1"), F.col("y1"), F.col("w"), F.col("h")))
    return b.select("ocr_id", *_flat(F.col("p")))


@_query(f"with {PTS} select vec_id, list_min(list_transform(p, lambda q: q.x)) as x1, list_min(list_transform(p, lambda q: q.y)) as y1, list_max(list_transform(p, lambda q: q.x)) as x2, list_max(list_transform(p, lambda q: q.y)) as y2 from pts")
def polygon_bbox(spark, d):
    """Boxes of polygons."""
    return _points(spark, d).select("vec_id", G.bounds(F.col("p")).alias("b")).select("vec_id", "b.*")


_AREA = "abs(list_sum(list_transform(range(1, 33), lambda i: p[i].x * p[i % 32 + 1].y - p[i % 32 + 1].x * p[i].y))) / 2"
_PERI = "list_sum(list_transform(range(1, 33), lambda i: sqrt(pow(p[i].x - p[i % 32 + 1].x, 2) + pow(p[i].y - p[i % 32 + 1].y, 2))))"


@_query(f"""with {PTS}, a as (select vec_id, {_AREA} * 10000 as area, {_PERI} * 100 as peri, p[1].x * 90 as angle from pts)
select vec_id, round(case when area < 25 or 4 * pi() * area / (peri * peri) >= 0.8 then 0 else angle end, 6) as vote, round(area * 1.6 / peri * 1.45, 6) as outline from a""")
def rotation_votes(spark, d):
    """Angles for which polygons vote, and how far their outlines are grown."""
    big = F.transform("p", lambda q: F.struct((q["x"] * 100).alias("x"), (q["y"] * 100).alias("y")))
    x = _points(spark, d).select("vec_id", big.alias("p"), (F.col("p")[0]["x"] * 90).alias("angle"))
    return x.select("vec_id", F.round(G.vote(F.col("p"), F.col("angle")), 6).alias("vote"), F.round(G.outline_distance(F.col("p")), 6).alias("outline"))


@_query(f"with {PTS}, a as (select vec_id, {_AREA} as area, {_PERI} as peri from pts) select vec_id, round(area, 6) as area, round(4 * pi() * area / (peri * peri), 6) as roundness, round(area * 1.6 / peri, 6) as unclip from a")
def polygon_measures(spark, d):
    """Area, roundness and unclip distance of polygons."""
    p = F.col("p")
    return _points(spark, d).select("vec_id", F.round(G.area(p), 6).alias("area"), F.round(G.roundness(p), 6).alias("roundness"), F.round(G.unclip_distance(p), 6).alias("unclip"))


def _turned(x: str, y: str) -> tuple[str, str]:
    c, s_ = "cos(radians(angle))", "sin(radians(angle))"
    return f"trunc(({x} - 620) * {c} - ({y} - 877) * {s_} + 620 - 3)::int", f"trunc(({x} - 620) * {s_} + ({y} - 877) * {c} + 877 - 5)::int"


_CORNERS = [f"{v} as p{c}{n}" for n, x, y in ((1, "x1", "y1"), (2, "x2", "y1"), (3, "x2", "y2"), (4, "x1", "y2")) for c, v in zip("xy", _turned(x, y), strict=True)]


@_query(f"with {BOX}, t as (select *, (ocr_id % 7 - 3) * 2.5 as angle from box) select ocr_id, {', '.join(_CORNERS)} from t")
def rotate_points(spark, d):
    """Corners of lines on pages turned by several angles, less an offset."""
    r = G.rectangle(F.col("x1"), F.col("y1"), F.col("w"), F.col("h"))
    b = _boxes(spark, d).withColumn("p", G.rotate(r, (F.col("ocr_id") % 7 - 3) * 2.5, F.lit(1240), F.lit(1754), F.lit(3), F.lit(5)))
    return b.select("ocr_id", *_flat(F.col("p")))


@_query(f"""with {PTS}, q as (select vec_id, list_sort(list_transform(p[1:4], lambda a: struct_pack(x := a.x, y := a.y))) as s from pts),
l as (select vec_id, list_sort(list_transform(s[1:2], lambda a: struct_pack(y := a.y, x := a.x))) as lf, s[3] as r1, s[4] as r2 from q),
f as (select vec_id, lf[1] as tl, lf[2] as bl, r1, r2, pow(r1.x - lf[1].x, 2) + pow(r1.y - lf[1].y, 2) > pow(r2.x - lf[1].x, 2) + pow(r2.y - lf[1].y, 2) as first from l)
select vec_id, tl.x as tlx, tl.y as tly, case when first then r2.x else r1.x end as trx, case when first then r2.y else r1.y end as t_ry, case when first then r1.x else r2.x end as brx, case when first then r1.y else r2.y end as bry, bl.x as blx, bl.y as bly from f""")
def quad_order(spark, d):
    """Corners in order: top left, top right, bottom right, bottom left."""
    q = _points(spark, d).select("vec_id", G.order_corners(F.slice("p", 1, 4)).alias("q"))
    return q.select("vec_id", F.col("q")[0]["x"].alias("tlx"), F.col("q")[0]["y"].alias("tly"), F.col("q")[1]["x"].alias("trx"), F.col("q")[1]["y"].alias("t_ry"), F.col("q")[2]["x"].alias("brx"), F.col("q")[2]["y"].alias("bry"), F.col("q")[3]["x"].alias("blx"), F.col("q")[3]["y"].alias("bly"))


@_query(f"""with {PTS}, s as (select vec_id, list_sort(list_transform(p[1:4], lambda a: struct_pack(x := a.x, y := a.y))) as s from pts),
l as (select vec_id, list_sort(list_transform(s[1:2], lambda a: struct_pack(y := a.y, x := a.x))) as l, list_sort(list_transform(s[3:4], lambda a: struct_pack(y := a.y, x := a.x))) as r from s)
select vec_id, l[1].x as px1, l[1].y as py1, r[1].x as px2, r[1].y as py2, r[2].x as px3, r[2].y as py3, l[2].x as px4, l[2].y as py4 from l""")
def quad_order_by_height(spark, d):
    """Corners in order, both sides by their heights."""
    return _points(spark, d).select("vec_id", G.corners_by_height(F.slice("p", 1, 4)).alias("q")).select("vec_id", *_flat(F.col("q")))


@_query(f"""with {PTS}, i as (select vec_id, p, unnest(range(1, 33)) as i from pts), j as (select vec_id, p, i, unnest(range(1, 33)) as j from i),
e as (select vec_id, p, p[j].x - p[i].x as ex, p[j].y - p[i].y as ey from j where i < j), u as (select vec_id, p, ex / sqrt(ex * ex + ey * ey) as ux, ey / sqrt(ex * ex + ey * ey) as uy from e where ex <> 0 or ey <> 0),
a as (select vec_id, list_transform(p, lambda q: q.x * ux + q.y * uy) as a, list_transform(p, lambda q: q.y * ux - q.x * uy) as b from u)
select vec_id, round(min((list_max(a) - list_min(a)) * (list_max(b) - list_min(b))), 6) as area from a group by vec_id""")
def min_area_rectangles(spark, d):
    """Area of the smallest rectangle around each polygon (the SQL tries all directions between points)."""

    @F.pandas_udf("double")
    def smallest(v: pd.Series) -> pd.Series:
        return pd.Series([float(np.prod(raster.min_area_rect(np.asarray(x, np.float64)[:64].reshape(-1, 2))[1])) for x in v])

    return table(spark, d, "embeddings").select("vec_id", F.round(smallest("embedding"), 6).alias("area"))


@_query()
def detected_lines(spark, d):
    """Polygons and scores that the detector's steps find in maps of eight by eight probabilities, enlarged."""
    kind = "vec_id long, line_id int, n_points int, score double"

    def run(frames):
        for f in frames:
            rows = []
            for k, v in zip(f["vec_id"], f["embedding"], strict=True):
                prob = np.kron(np.clip(np.abs(np.asarray(v, np.float64)[:64]) * 3, 0, 1).reshape(8, 8), np.ones((6, 6)))
                rows += [(k, i, len(p), s) for i, (p, s) in enumerate(raster.detect(prob, (480, 480)))]
            yield pd.DataFrame(rows, columns=["vec_id", "line_id", "n_points", "score"]).astype({"vec_id": "int64", "line_id": "int32", "n_points": "int32"})

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, kind)


def _clip(v: str, m: int) -> str:
    return f"greatest(least(trunc({v})::int, {m}), 0)"


@_query(f"with {BOX} select ocr_id, {_clip('x1 - 0.01::double * w', 1240)} as x1, {_clip('y1 - (0.1::double * 0.08::double) * h', 1754)} as y1, {_clip('x2 + 0.04::double * w', 1240)} as x2, {_clip('y2 + (case when h < 25 then 0.3::double when h > 100 then 0.12::double else 0.2::double end) * h', 1754)} as y2 from box")
def crop_padding(spark, d):
    """Padded crops of lines."""
    c = [F.col(x) for x in ("x1", "y1", "x2", "y2")]
    return _boxes(spark, d).select("ocr_id", G.pad_line(*c, F.lit(1240), F.lit(1754)).alias("b")).select("ocr_id", "b.*")


@_query(f"""with {BOX}, r as (select *, 960::double / greatest(w, h) as k, least(trunc(1.49::double * greatest(w, h))::int, 1024) / greatest(w, h)::double as s from box),
t as (select *, trunc(w * s)::int as sw, trunc(h * s)::int as sh, (round_even(trunc(w * k)::int / 32.0, 0) * 32)::int as mw, (round_even(trunc(h * k)::int / 32.0, 0) * 32)::int as mh from r)
select ocr_id, least(greatest((ceil(trunc(48::double * w / h)::int / 10.0) * 10)::int, 32), 1024) as ocr_w, greatest(trunc(w * 64 / h::double / 4)::int * 4, 4) as line_w, sw, sh, (ceil(sw / 32.0) * 32)::int as pw, (ceil(sh / 32.0) * 32)::int as ph,
case when mw > 0 and mh > 0 then mw end as mw, case when mw > 0 and mh > 0 then mh end as mh, least(w, h) > 10 and h > 4 * w as portrait from t""")
def resize_geometry(spark, d):
    """Sizes that recognition and detection would use for each line."""
    w, h = F.col("w"), F.col("h")
    s, m = G.square_size(w, h), G.multiple_of_32(w, h)
    return _boxes(spark, d).select("ocr_id", G.ocr_width(w, h).alias("ocr_w"), G.line_width_64(w, h).alias("line_w"), s["w"].alias("sw"), s["h"].alias("sh"), s["pw"].alias("pw"), s["ph"].alias("ph"), m["w"].alias("mw"), m["h"].alias("mh"), G.is_portrait(w, h).alias("portrait"))


@_query(f"with {BOX} select ocr_id, greatest(least(round_even(x1 / 1240.0 * 736, 0), 735), 0)::int as x, trunc(x1 * (1 / 0.58::double))::int as back from box")
def rescale_boxes(spark, d):
    """Coordinates on a resized page and back."""
    return _boxes(spark, d).select("ocr_id", G.rescale(F.col("x1"), F.lit(1240), F.lit(736)).alias("x"), G.scale_back(F.col("x1"), F.lit(0.58)).alias("back"))


_CHANNEL = [(0.485, 0.229), (0.456, 0.224), (0.406, 0.225)]


@_query("select vec_id, " + ", ".join(f"round(list_sum(list_transform(range(1, 22), lambda i: (embedding[3*i-{2 - k}]::double / 255 - {m}::double) / {s_}::double)), 6) as c{k}" for k, (m, s_) in enumerate(_CHANNEL)) + ", len(list_filter(embedding, lambda v: v::double > 0.3)) as above from embeddings")
def normalize_tensor(spark, d):
    """Values as 21 pixels of three channels: sums of each channel normalised, and the values above the mask threshold."""
    e, v = F.col("embedding"), lambda i: F.element_at("embedding", i.cast("int")).cast("double")
    pixel = F.sequence(F.lit(1), F.lit(21))
    total = lambda k, m, s_: F.aggregate(F.transform(pixel, lambda i: (v(3 * i - (2 - k)) / 255 - m) / s_), F.lit(0.0), lambda a, x: a + x)
    return table(spark, d, "embeddings").select("vec_id", *[F.round(total(k, m, s_), 6).alias(f"c{k}") for k, (m, s_) in enumerate(_CHANNEL)], F.size(F.filter(e, lambda x: x.cast("double") > 0.3)).cast("long").alias("above"))


@_query("""with g as (select vec_id, unnest(range(0, 64)) as k, embedding from embeddings), m as (select vec_id, embedding, k // 8 as y, k % 8 as x from g),
n as (select *, case when y = 0 then 1 else y - 1 end as yu, case when y = 7 then 6 else y + 1 end as yd, case when x = 0 then 1 else x - 1 end as xl, case when x = 7 then 6 else x + 1 end as xr from m),
l as (select vec_id, embedding[yu*8+x+1]::double + embedding[yd*8+x+1]::double + embedding[y*8+xl+1]::double + embedding[y*8+xr+1]::double - 4 * embedding[y*8+x+1]::double as l from n)
select vec_id, round(var_pop(l), 6) as variance from l group by vec_id""")
def laplacian_blur_2d(spark, d):
    """Blur measure of pictures of eight by eight values: variance of the second difference in both directions."""

    @F.pandas_udf("double")
    def measure(v: pd.Series) -> pd.Series:
        return pd.Series([raster.laplacian_variance(np.asarray(x, np.float64)[:64].reshape(8, 8)) for x in v])

    return table(spark, d, "embeddings").select("vec_id", F.round(measure("embedding"), 6).alias("variance"))


@_query(f"with {BOX} select ocr_id, trunc(w * least(1.0::double, 1024::double / greatest(w, h)))::int as w, trunc(h * least(1.0::double, 1024::double / greatest(w, h)))::int as h from box")
def shrink_sizes(spark, d):
    """Sizes with the longer side at most 1024."""
    return _boxes(spark, d).select("ocr_id", G.shrink(F.col("w"), F.col("h")).alias("s")).select("ocr_id", "s.*")


@_query("""with l as (select vec_id, list_transform(range(2, 64), lambda i: embedding[i-1]::double - 2 * embedding[i]::double + embedding[i+1]::double) as l from embeddings)
select vec_id, round(list_var_pop(l), 6) as variance, list_var_pop(l) <= 0.05 as blurry from l""")
def laplacian_blur(spark, d):
    """Blur test on one row of values: variance of the second difference (one-dimensional analogue)."""
    at = lambda i: F.element_at("embedding", i.cast("int")).cast("double")
    lap = F.transform(F.sequence(F.lit(2), F.lit(63)), lambda i: at(i - 1) - 2 * at(i) + at(i + 1))
    n, total = F.lit(62.0), lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    x = table(spark, d, "embeddings").select("vec_id", lap.alias("l")).withColumn("m", total(F.col("l")) / n)
    var = total(F.transform("l", lambda v: (v - F.col("m")) * (v - F.col("m")))) / n
    return x.select("vec_id", F.round(var, 6).alias("variance"), (var <= 0.05).alias("blurry"))


@_query(f"""with {OCR}, x as (select doc, page_idx, idx, prediction, bbox, row_number() over (partition by doc, page_idx order by idx) - 1 as region from ocr)
select doc || '_' || page_idx || '.jpg' as file, region::int as region, prediction as text, bbox.x1 as x, bbox.y1 as y, case when idx % 2 = 0 then bbox.x1 + 1 else bbox.x2 end as x3, bbox.y2 as y3, case when idx % 2 = 0 then 3 else 4 end as points
from x where (prediction is null or trim(prediction) <> '') and idx % 5 <> 3 and idx % 7 <> 6""")
def region_flatten(spark, d):
    """Pages as annotation projects (JSON) of rectangles, polygons, other shapes and keys without text, read back and flattened to text regions."""
    o = _ocr(spark, d, "doc", "page_idx", "idx", "prediction", "bbox")
    b, i = F.col("bbox"), F.col("idx")
    none = lambda kind: F.lit(None).cast(kind)
    xs, ys = F.array(b["x1"], b["x2"], b["x1"] + 1, b["x1"]), F.array(b["y1"], b["y1"], b["y2"])
    poly = i % 2 == 0
    shape = F.struct(
        F.when(i % 7 == 6, F.lit("circle")).when(poly, F.lit("polygon")).otherwise(F.lit("rect")).alias("name"), F.when(poly, xs).alias("all_points_x"), F.when(poly, ys).alias("all_points_y"),
        F.when(poly, none("int")).otherwise(b["x1"]).alias("x"), F.when(poly, none("int")).otherwise(b["y1"]).alias("y"), F.when(poly, none("int")).otherwise(b["x2"] - b["x1"]).alias("width"), F.when(poly, none("int")).otherwise(b["y2"] - b["y1"]).alias("height"),
    )
    region = F.struct(shape.alias("shape_attributes"), F.struct(F.col("prediction").alias("text"), F.when(i % 5 == 3, F.lit("logo")).otherwise(F.lit("line")).alias("key")).alias("region_attributes"))
    file = F.concat("doc", F.lit("_"), "page_idx", F.lit(".jpg"))
    per_page = o.groupBy("doc", "page_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", region.alias("r")))), lambda s: s["r"]).alias("regions")).select(file.alias("file"), "regions")
    meta = F.create_map(F.col("file"), F.struct(F.col("file").alias("filename"), "regions"))
    text = F.to_json(F.struct(F.struct(F.struct(F.lit("pages").alias("name")).alias("project")).alias("_via_settings"), meta.alias("_via_img_metadata")))
    parsed = per_page.select(F.from_json(text, annotations.PROJECT).alias("j")).select("j.*")
    p = F.col("polygon")
    return annotations.regions(parsed).select("file", "region", "text", p[0]["x"].alias("x"), p[0]["y"].alias("y"), p[2]["x"].alias("x3"), p[2]["y"].alias("y3"), F.size(p).alias("points"))


# --- models ----------------------------------------------------------------------------------------------------------


@_query()
def model_stub_pipeline(spark, d):
    """Band texts through the extraction adapter (a deterministic stand-in); failed rows keep their error."""
    texts = segment.band_text(_ocr(spark, d, "doc", "page_idx", "idx", "prediction"))
    good, bad = models.extract(texts.select("doc", "page_idx", "ex_idx", "text"), "text")
    return good.select("doc", "page_idx", "ex_idx", "seq", "question", "answer", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("doc", "page_idx", "ex_idx", F.lit(None).cast("int").alias("seq"), F.lit(None).cast("string").alias("question"), F.lit(None).cast("string").alias("answer"), "error")
    )
