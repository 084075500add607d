"""DuckDB SQL of the text operators that SQL can express, written from the same fixed values."""

from __future__ import annotations

from .textform import IGNORABLE, LOOKALIKES, single_map

#: Runs of letters and digits.
WORD = r"[\p{L}\p{N}]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def plain(column: str) -> str:
    """Composed plain form of a text column; look-alike letters are left to ``latin``."""
    one = {k: v for k, v in single_map().items() if len(v) == 1}
    more = {k: v for k, v in single_map().items() if len(v) > 1 and (0xFB00 <= k <= 0xFB06 or 0x2100 <= k <= 0x218F or k in (0xBC, 0x132, 0x133, 0x1C4, 0x1C6))}
    gone = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in IGNORABLE)
    out = f"regexp_replace({column}, '[{gone}]', '', 'g')"
    for k, v in more.items():
        out = f"replace({out}, {_q(chr(k))}, {_q(v)})"
    return f"nfc_normalize(translate(nfc_normalize({out}), {_q(''.join(map(chr, one)))}, {_q(''.join(one.values()))}))"


def latin(word: str) -> str:
    """A word with look-alike letters replaced, unless it is wholly of another script."""
    letters, twins = "".join(LOOKALIKES), "".join(LOOKALIKES.values())
    cyrillic = "".join(c for c in LOOKALIKES if "Ѐ" <= c <= "ԯ")
    mixed = rf"regexp_matches({word}, '[A-Za-z\x{{C0}}-\x{{24F}}\x{{1E00}}-\x{{1EFF}}]') or regexp_full_match({word}, '[{cyrillic}\\d]+')"
    return f"case when {mixed} then translate({word}, {_q(letters)}, {_q(twins)}) else {word} end"


def near_duplicates() -> str:
    """Brute force over all pairs of records that share a word."""
    words = f"list_sort(list_distinct(list_transform(regexp_extract_all({plain('question')}, '{WORD}'), lambda w: lower({latin('w')}))))"
    return f"""with t as (select exercise_id as id, {words} as ws from exercise where question is not null),
    d as (select row_number() over (order by id, ws) as r, id, ws, len(ws) as n from (select distinct id, ws from t where len(ws) > 0)), u as (select r, unnest(ws) as w from d),
    c as (select a.r as ra, b.r as rb, count(*) as n from u a join u b on a.w = b.w and a.r < b.r group by all)
    select distinct least(x.id, y.id) as exercise_a, greatest(x.id, y.id) as exercise_b from c join d x on x.r = c.ra join d y on y.r = c.rb where c.n >= 0.8 * (x.n + y.n - c.n) and x.id <> y.id"""


def leaks(run: int = 10) -> str:
    """Equi-join of all runs of ``run`` words."""
    others = {k.lower(): v.lower() for k, v in LOOKALIKES.items() if not "Ͱ" <= k <= "Ͽ"} | {"đ": "d", "ð": "d"}
    greek = {k.lower(): v.lower() for k, v in LOOKALIKES.items() if "Α" <= k <= "Ω"}
    flat = lambda c: f"translate(strip_accents(lower({plain(c)})), {_q(''.join(others))}, {_q(''.join(others.values()))})"
    word = f"case when regexp_matches(w, '[a-z]') then translate(w, {_q(''.join(greek))}, {_q(''.join(greek.values()))}) else w end"
    words = lambda c: f"list_transform(regexp_extract_all({flat(c)}, '{WORD}'), lambda w: {word})"
    grams = lambda key, source: f"select {key}, array_to_string(ws[i:i + {run - 1}], ' ') as g from (select {key}, ws, unnest(range(1, len(ws) - {run - 2})) as i from ({source}) where len(ws) >= {run})"
    d = grams("doc_id", f"select doc_id, {words('text')} as ws from documents where text is not null")
    e = grams("item_id", f"select item_id, {words('t')} as ws from (select item_id, question as t from eval_item union all select item_id, answer from eval_item) where t is not null")
    return f"select distinct doc_id, item_id from ({d}) d join ({e}) e using (g)"


def clean() -> str:
    """Documents without leaks, by their numbers."""
    return f"select doc_id from documents where doc_id not in (select doc_id from ({leaks()}))"


def oracle_sql() -> dict[str, str]:
    return {"p3_found": near_duplicates(), "p7_found": leaks(), "p7_clean": clean()}
