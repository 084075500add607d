"""Text operators against brute force, exact round trips and edge cases."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("foliograph.llm")

from foliograph.llm import language, leakage, minhash, neardup, pairs, scannoise, textform, tokenizer, truncation  # noqa: E402

VI = "Hai xe khởi hành lúc buổi sáng từ Kim Giang và Tân Trạch, cách nhau 12 ki-lô-mét. Hỏi sau bao lâu hai người gặp nhau tại bến xe?"
LONG = "từ " * 60_000


# --- 1 ---------------------------------------------------------------------------------------------------------------


def noisy_tables(spark):
    lines = ["Câu 1. Hai xe khởi hành lúc buổi sáng từ bến", "xe Kim Giang, cách nhau mười hai ki-lô-mét và", "đi ngược chiều. Hỏi sau bao lâu thì gặp nhau?"]
    rows, n = [], 0
    for page in range(12):
        rows.append((n, "d", page, 0, "Chương 2. Lực ma sát và cấp số nhân", 90, 44))
        for i, t in enumerate(lines):
            rows.append((n + 1 + i, "d", page, 1 + i, t, 90, 110 + 40 * i))
        rows.append((n + 4, "d", page, 4, f"— {page + 5} —", 600, 1680))
        n += 5
    rows += [
        (900, "e", 0, 0, "Câu 1. Hai xe kliởi hành lúc b-", 90, 110), (901, "e", 0, 1, "uổi sáng từ bến xe Kim Giang, cách nhau ki-lô-", 90, 150), (902, "e", 0, 2, "mét và đi ngược chiều.", 90, 190),
        (903, "e", 0, 3, None, 90, 230), (904, "e", 0, 4, "", 90, 270), (905, "e", 0, 5, "370", 95, 1690), (900, "e", 0, 0, "Câu 1. Hai xe kliởi hành lúc b-", 90, 110),
    ]
    ocr = spark.createDataFrame([(a, b, c, d, t, (x, y, x + 500, y + 26), "clash") for a, b, c, d, t, x, y in rows], "ocr_id long, doc string, page_idx int, idx int, prediction string, bbox struct<x1:int,y1:int,x2:int,y2:int>, kind string")
    q = [(1, "Câu 1. Hai xe khởi hành lúc b¬\n— 17 —\nChương 2. Lực ma sát và cấp số nhân\nuổi sáng từ bến xe."), (2, "Số liệu đo được:\n12\n13"), (3, None), (4, ""), (5, "Hai xe cách nhau"), (5, "Hai xe cách nhau")]
    return ocr, spark.createDataFrame(q, "exercise_id long, question string")


def test_scan_noise(spark):
    ocr, ex = noisy_tables(spark)
    reader = scannoise.reader_of(ocr, "prediction", "bbox", ex, "question")
    pages = scannoise.by_page(ocr, "doc", "page_idx", "idx", "ocr_id", "prediction", "bbox")
    found = {(r.row_id, r.kind) for r in scannoise.page_noise(pages, reader).collect()}
    assert {(900, "misread"), (900, "hyphen"), (0, "header"), (4, "page_number")} <= found
    assert not {k for k in found if k[0] in (901, 902, 903, 904, 905)}
    got = {(r.row_id, r.kind) for r in scannoise.question_noise(ex, "exercise_id", "question", reader).collect()}
    assert got == {(1, "hyphen"), (1, "header"), (1, "page_number")}
    text = {r.exercise_id: r.question for r in scannoise.repaired_questions(ex, "exercise_id", "question", reader).collect()}
    assert text[1] == "Câu 1. Hai xe khởi hành lúc buổi sáng từ bến xe." and text[3] is None
    page = {(r.doc, r.page): r.text for r in scannoise.repaired_pages(pages, reader).collect()}
    assert page["e", 0].startswith("Câu 1. Hai xe khởi hành lúc buổi sáng từ bến xe Kim Giang")


def test_corrections_by_vectors(spark):
    draw = random.Random(4)
    topics = ["nước chảy vào bể đầy lít vòi".split(), "đường thẳng song song cắt góc hình".split()]
    lines = [" ".join(draw.sample(t, 4)) for _ in range(400) for t in topics]
    # two frequent words that one misreading may stand for, each among its own neighbours, and a rare word that none of them fits
    lines += [f"nước tanh vào bể lít {i % 7}" for i in range(60)] + [f"đường tanb cắt góc {i % 7}" for i in range(50)]
    lines += ["nước tan6 vào bể", "song tan8 cắt góc hình", "đầy lítt vòi"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "id long, text string")
    lex = scannoise.learn(df.select("text"))
    assert lex.status("tan6")[0] == "misread" and lex.vectors.any()
    water, lines_ = lex.fits(["nước", "đường"], ["chảy", "vòi"]), lex.fits(["nước", "đường"], ["song", "góc"])
    assert water[0] > water[1] and lines_[1] > lines_[0]
    both = [("bể", 0.0), ("góc", 0.0)]
    assert lex.choose("misread", both, ["nước", "vòi"]) == "bể" and lex.choose("misread", both, ["song", "cắt"]) == "góc"
    assert lex.costs["6", "b"] < lex.costs["vv", "w"]  # corrections that explain more words cost less
    assert lex.glyph_candidates("x" * 100_000) == {}  # longer than any word


def test_geometry():
    cells = {(1, 2): (40, 10, 38), (1, 7): (50, 0, 50), (1, 9): (50, 1, 50), (9, 100): (20, 19, 20), (1, 100): (10, 0, 10), (9, 101): (1, 1, 1)}
    g = scannoise.Geometry(cells)
    assert g.top == 7 * scannoise.CELL_H and g.foot == {(9, 100)} and g.is_head(40) and not g.is_head(120) and not g.is_head(None)
    assert scannoise.Geometry({}).top == 0 and scannoise.Geometry({(1, 2): (40, 0, 40), (1, 7): (50, 0, 50), (1, 60): (5, 0, 5)}).top == 0
    assert scannoise.Geometry({(1, 2): (40, 0, 3), (1, 7): (50, 0, 50), (1, 60): (5, 0, 5)}).top == 7 * scannoise.CELL_H


def test_scan_noise_empty(spark):
    ocr, ex = noisy_tables(spark)
    reader = scannoise.reader_of(ocr.limit(0), "prediction", "bbox", ex.limit(0), "question")
    assert scannoise.question_noise(ex.limit(0), "exercise_id", "question", reader).count() == 0


# --- 2 ---------------------------------------------------------------------------------------------------------------


def test_plain_form():
    same = {"Câu": "Ｃâｕ", "mỗi": unicodedata.normalize("NFD", "mỗi"), "hộp": "hộр", "một hai": "một\u2009hai", "vài": "v\u200bài", "fi": "ﬁ", "Đoạn": "Ðoạn", "25 °C": "25 ℃", "5 μm": "5 µm", "giữa": "ɡiữa"}
    for plain, odd in same.items():
        assert textform.plain_form(odd) == plain and textform.differs(odd) and not textform.differs(plain)
    for kept in ("x² + ½", "CO₂…", "góc α, Δt", "là энергия với", "“a” – b — c", "tập ℝ", "a\nb", "", "масса"):
        assert textform.plain_form(kept) == kept
    assert textform.plain_form(None) is None and textform.fold("Ｃâｕ") == "câu"
    assert textform.plain_form(textform.plain_form("ＡＢ\u00a0ậ")) == textform.plain_form("ＡＢ\u00a0ậ")


def test_odd_records(spark):
    df = spark.createDataFrame([(1, "Ｃâｕ", 0), (1, "Ｃâｕ", 0), (2, "Câu", 0), (3, None, 0), (4, "", 0), (5, LONG + "\u200b", 0)], "id long, t string, tbl int")
    assert sorted(r.id for r in textform.odd_records(df, "t", ["id"]).collect()) == [1, 5]
    assert textform.odd_records(df.limit(0), "t", ["id"]).count() == 0
    assert [r.x for r in df.orderBy("id").select(textform.to_plain(df.t).alias("x")).collect()][:4] == ["Câu", "Câu", "Câu", None]


def test_folded(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["ABC d", "Ｃâｕ ß", None, "", "CÂU SS"])], "i int, t string")
    assert [r.x for r in df.orderBy("i").select(textform.to_folded(df.t).alias("x")).collect()] == ["abc d", "câu ss", None, "", "câu ss"]


# --- 3 ---------------------------------------------------------------------------------------------------------------


def test_near_duplicates_against_brute_force(spark):
    random.seed(3)
    vocabulary = [f"từ{i}" for i in range(400)]
    rows = []
    for base in range(40):
        w = random.sample(vocabulary, random.choice([5, 20, 40]))
        for _ in range(random.choice([1, 2, 5])):
            v = list(w)
            for _ in range(random.choice([0, 1, 3, 8])):
                v[random.randrange(len(v))] = random.choice(vocabulary)
            random.shuffle(v)
            rows.append((len(rows), " ".join(v)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " . ", "Ｍột hai ba", "một\u00a0hai BA", LONG, LONG])]
    rows.append(rows[0])
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "id long, t string, set int")
    sets = {i: set(leakage.re.findall(r"[^\W_]+", textform.plain_form(t).lower())) for i, t in rows if t}
    sets = {i: s for i, s in sets.items() if s}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in neardup.pairs(df, "id", "t").collect()} == want
    groups = {r.id: r for r in neardup.groups(df, "id", "t").collect()}
    assert set(groups) == set(sets)
    keys = {i: frozenset(s) for i, s in sets.items()}
    for i, g in groups.items():
        assert g["class"] == min(j for j in keys if keys[j] == keys[i]) and g["size"] == sum(k == keys[i] for k in keys.values())
        assert g.links == len({keys[b if a == i else a] for a, b in want if i in (a, b)} - {keys[i]})
    assert neardup.pairs(df.limit(0), "id", "t").count() == 0
    assert neardup.groups(df.limit(0), "id", "t").count() == 0


def test_records_delivered_with_two_texts(spark):
    a = "một hai ba bốn năm sáu bảy tám chín mười"
    b = "Tính diện tích của hình thang cân có đáy lớn dài gấp đôi"
    df = spark.createDataFrame([(1, a), (1, b), (2, a + " mốt"), (3, b + " nhỏ"), (4, b)], "id long, t string")
    assert sorted((r.a, r.b) for r in neardup.pairs(df, "id", "t").collect()) == [(1, 2), (1, 3), (1, 4), (3, 4)]
    assert sorted((r.id, r["class"], r.links) for r in neardup.groups(df, "id", "t").collect()) == [(1, 1, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 1, 1)]


def test_hot_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SPLIT", 4)
    w = [f"từ{i}" for i in range(40)]
    texts = [" ".join(w)] * 15 + [" ".join([*w[:39], f"x{i}"]) for i in range(20)] + [" ".join(reversed(w))] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    assert {(r.a, r.b) for r in neardup.pairs(df, "id", "t").collect()} == {(a, b) for a in range(38) for b in range(a + 1, 38)}
    groups = neardup.groups(df, "id", "t").collect()
    assert len(groups) == 38 and {(r["class"], r["size"], r.links) for r in groups if r["size"] > 1} == {(0, 18, 20)}


def test_nodes_of_the_forest(spark):
    rows = [(1, r, 5, 0, i) for i, r in enumerate([0x10001, 0x10001, 0x10002, 0x20001])] + [(2, 7, 5, 0, 9), (3, 0x10001, 5, 0, 10), (3, 0x90001, 5, 0, 11)]
    df = spark.createDataFrame(rows, "root long, rest long, n int, sketch long, sid long")
    met = lambda sparse: sorted((r.x, r.y) for r in neardup.meet(neardup.nodes(df, 2, sparse), 0.8).collect())
    assert met(4) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (10, 11)]  # small trees meet at their roots
    assert met(3) == [(0, 1), (0, 2), (1, 2), (10, 11)]  # a crowded root meets below
    assert met(1) == [(0, 1)]  # no longer than the whole prefix


def test_no_candidate_at_the_threshold_is_discarded(spark):
    rows = []
    for seed in (900, 2824, 6778):  # a sketch of single bits of minima once discarded these
        w = [f"từ{i}" for i in random.Random(seed).sample(range(10000), 30)]
        rows += [(2 * seed, " ".join(w[:27])), (2 * seed + 1, " ".join(w[:24] + w[27:]))]  # 24 words of 30 in common
    df = spark.createDataFrame(rows, "id long, t string")
    assert sorted((r.a, r.b) for r in neardup.pairs(df, "id", "t").collect()) == [(2 * s, 2 * s + 1) for s in (900, 2824, 6778)]


def test_parities_bound_the_difference():
    draw = np.random.default_rng(4)
    for n in (1, 20, 300):
        sets = [np.unique(draw.integers(0, 3 * n, n)).astype(np.int32) * 7919 for _ in range(40)]
        p = neardup.parities(sets).tolist()
        assert all(((x ^ y) & 2**64 - 1).bit_count() <= len(np.setxor1d(a, b)) for x, a in zip(p, sets) for y, b in zip(p, sets))


def test_forest_depth():
    k = neardup.depth()
    assert 1 - (1 - 0.8**k) ** neardup.TREES >= neardup.TARGET > 1 - (1 - 0.8 ** (k + 1)) ** neardup.TREES
    with pytest.raises(ValueError):
        neardup.depth(trees=1)


def test_signatures_estimate_similarity():
    a, b = minhash.coefficients(400)
    items = np.array([minhash.hash31(str(i)) for i in range(100)], np.uint64)
    x, y = items[:80], items[20:]
    s = minhash.signatures([x, y], a, b)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.08


# --- 4, 5 ------------------------------------------------------------------------------------------------------------


CUT = [
    "Ta có điện trở ban đầu là 15 đồng, suy ra phần còn lại bằng 91 mét. Nhân cả hai vế với 32 rồi chuy", "Dễ thấy $\\frac{1}{", 'Cô giáo nói "Xin lỗi, tôi',
    "Đặt k = 7m. Lập bảng biến thiên của hàm số, ta thấy hàm số đ...", "Bước 7: Đáp s\ufffd", "Vì AB song song với CD nên hai góc bằng",
]
WHOLE = [None, "", "   ", "548", "hình thang cân", "Đáp án: B", "A. 84,66 giờ", "Suy ra ABC là hình bình hành (đpcm)", "Vậy chiều dài cần tìm là $\\boxed{84}$", "2; 5; 8; 11; …", "Kết quả đúng. Đáp số: 41.", "x^2 - 1", "1) Một ý; 2) hai ý."]


def test_verdicts():
    assert {truncation.verdict(t) for t in CUT} == {"cut", "bare"}
    assert all(truncation.verdict(t) not in ("cut", "bare") for t in WHOLE)
    assert truncation.verdict(LONG + ".") == "ended"


OPEN = [
    "Xem [1, 2 và hình [vẽ bên.", "Kết quả <b>đậm và dài hơn mọi.", "Tính <span class='x'>tổng <i>hai</i> số.", "Vậy <b>x</b> là số <stro", "Số liệu A &amp; B là đủ &nb", "mã \\u00e1 và \\u00e", "x%20y là %E1%BB",
    "Đáp số là \xc3\xa1 và \xe1\xbb", "**Kết luận: dài hơn mọi.", "Tập (1; 2 là.", "Ta viết « như trên.",
]
CLOSED = [
    "Nửa khoảng [1; 2) và (1; 2] là tập con.", "Intervalle ]1; 2[ est ouvert.", "x < y và <b>z</b> <br> là số.", "a & b &amp; c.", "Đây là hòn đá", "**Kết luận:** dài hơn.", "2**3 = 8.", "<p>Một đoạn.", "a*b và c*d.", "A <B>hai</B>.", "f[0] = 1.",
]


def test_automaton():
    for t in OPEN:
        assert truncation.verdict(t) == "cut", t
    for t in CLOSED:
        assert truncation.verdict(t) not in ("cut", "bare") or t.endswith("đá"), t
    assert [truncation.open_at_end(t) for t in ("(a [b", "$x", "<b>a", "**a", "a")] == ["[", "$", "<b>", "**", None]


def test_source_baselines(spark):
    words = "Ta suy ra điều cần tìm là quãng đường còn lại dài hơn dự kiến của đề toán đã cho trước".split()
    text = lambda i, end: " ".join(words[i % 5 :] + words[: i % 7]) + " nữa" * (i % 11) + end
    rows = [(i, text(i, "."), "ends") for i in range(60)] + [(100, "Suy ra hai góc bằng nhau và hình", "ends")]
    rows += [(200 + i, text(i, ""), "never") for i in range(60)]  # no terminators are usual here
    long = " ".join(words * 9)
    rows += [(300 + i, long[i : i + n] if i % 2 else f"{text(i, '')}.", "limit") for i in range(80) for n in [100 if i % 4 == 1 else 130]]
    df = spark.createDataFrame(rows, "id long, a string, source string")
    got = {r.id for r in truncation.found(df, "id", "a", "source").collect()}
    assert {i for i in got if i < 300} == {100} and got >= {300 + i for i in range(1, 80, 2)}
    own = df.select("source", truncation.ending(df.a).alias("v"), F.length("a").alias("c"), F.octet_length("a").alias("b"))
    lim = {r.source: r for r in truncation.limits(own).collect()}
    assert sorted(lim["limit"].chars) == [100, 130] and lim["never"].usual and not lim["ends"].usual and lim["ends"].chars is None


def test_truncation(spark):
    rows = [(i, t, "s") for i, t in enumerate(CUT + WHOLE)] + [(0, CUT[0], "s"), (100, CUT[1], None)]
    df = spark.createDataFrame(rows, "id long, a string, source string")
    assert sorted(r.id for r in truncation.found(df, "id", "a", "source").collect()) == [*range(len(CUT)), 100]
    share = {r.source: r for r in truncation.shares(df, "id", "a", "source").collect()}
    assert share[None].share == 1.0 and share["s"].cut_texts == len(CUT) and share["s"].texts == len(CUT) + len(WHOLE) - 1
    assert truncation.found(df.limit(0), "id", "a", "source").count() == 0


LABELLED = [
    (f"{t} Ngoài ra còn {i} điều nữa cần được nói rõ trong bài này." if c == "vi" else t, c)
    for i in range(12)
    for t, c in [
        (VI, "vi"),
        ("A tank near the village holds many litres and loses some of them every hour. Determine the height of the figure and round it.", "English"),
        ("Les élèves doivent se rappeler que cette expression n'est pas définie. Combien de fois faut-il ajouter dix pour dépasser cent ?", "fr-FR"),
        ("Die Schüler sollen sich merken, dass der Ausdruck nicht erklärt ist. Berechne den Umfang der Figur und runde das Ergebnis.", "de"),
        ("Los alumnos deben recordar que la expresión no está definida. Calcula el perímetro de la figura y redondea el resultado.", "es"),
    ]
]


def test_pairs(spark):
    model = language.train(LABELLED)
    english = "The height of the figure is the same as before. Determine the height of the tank and round it."
    refusals = [f"Rất tiếc, tôi chưa thể giải bài này vì đề bài thiếu {w}." for w in ("dữ kiện", "hình vẽ", "số liệu")]
    rows = [
        (1, VI, ""), (2, VI, "**Lời giải:**\n\n---"), (3, VI, "n/a"), (4, VI, VI), (5, VI, "Đề bài: " + VI), (6, VI, english), (7, VI + " Trả lời bằng tiếng Anh.", english), (8, VI, None), (9, VI, "12"),
        (10, VI, VI + " Ta có quãng đường xe thứ nhất đi được dài hơn quãng đường xe thứ hai nên thời gian cần tìm nhiều hơn dự kiến ban đầu của đề toán cũ đã cho, suy ra điều cần chứng minh."),
        (11, VI, CUT[0]), (12, None, "12"), (13, "", refusals[0]), (14, VI, refusals[1]), (15, VI, refusals[2]), (4, VI, VI), (16, VI, 'Cô giáo nói "Xin lỗi, tôi đến muộn" là lời dẫn trực tiếp.'),
    ]
    df = spark.createDataFrame([(a, b, c, "s", "x") for a, b, c in rows], "id long, q string, a string, source string, defect string")
    got = sorted((r.id, r.defect) for r in pairs.defects(df, "id", "q", "a", "source", model).collect())
    assert got == [(1, "empty"), (2, "empty"), (3, "empty"), (4, "copy"), (5, "copy"), (6, "wrong_language"), (11, "truncated"), (13, "refusal"), (14, "refusal"), (15, "refusal")]
    assert pairs.defects(df.limit(0), "id", "q", "a", "source", model).count() == 0


def test_refusals_in_other_words(spark):
    model = language.train(LABELLED)
    prompts = [VI, "Tính chu vi của hình chữ nhật có chiều dài gấp đôi chiều rộng.", "Nêu ý nghĩa nhan đề của bài thơ mà em đã học ở lớp."]
    answers = [f"{w} thể đưa ra lời giải cho đề bài trên khi chưa có đủ thông tin." for w in ("Tôi không", "Rất tiếc, tôi chưa", "Thành thật xin lỗi, hệ thống không")]
    same = [f"I am unable to answer this question {w}." for w in ("today", "here")]
    rows = [*zip(prompts, answers), *((VI, a) for a in same), (prompts[1], "Tôi thích đọc sách vào buổi sáng."), (prompts[2], "Tôi thích đọc sách vào buổi chiều.")]
    rows += [(VI, "Vậy x = 3. Tôi thích đọc sách vào buổi sáng.")]  # a sentence that stands in answers with content is no template of refusals
    df = spark.createDataFrame([(i, q, a, "s") for i, (q, a) in enumerate(rows)], "id long, q string, a string, source string")
    got = {r.id for r in pairs.defects(df, "id", "q", "a", "source", model).where("defect = 'refusal'").collect()}
    assert got == {0, 1, 2}  # 3 and 4 answer one prompt only


# --- 6 ---------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return tokenizer.read_ranks(tokenizer.vocabulary_path())


def reference(ranks):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_exact(ranks):
    enc, own = reference(ranks), tokenizer.Encoder(ranks)
    random.seed(5)
    texts = [VI, "  a  b \n\n c\t d ", "<|endoftext|> x", "don't I'll", "x² ½ 10.5", "😀🔬", " ", "\n", "a " * 50]
    texts += ["".join(random.choice("aàbđthe ọịngứ0123.-_́²½\n\t一Ⅷ😀's ") for _ in range(80)) for _ in range(150)]
    texts += ["".join(random.choice(["the", "ing", "qu", "đ", "er"]) for _ in range(400)) for _ in range(5)]
    for t in texts:
        ids = own.encode(t)
        assert ids == enc.encode_ordinary(t) and tokenizer.Decoder(ranks).decode(ids) == t


def test_stream_in_pieces(ranks):
    machine, enc = tokenizer.Transducer(ranks), reference(ranks)
    word = "".join(random.Random(2).choice(["nghiêng", "trường", "tion", "a"]) for _ in range(200))
    raw = word.encode()
    assert list(machine.stream(raw[i : i + 3] for i in range(0, len(raw), 3))) == enc.encode_ordinary(word)
    assert machine.lookahead() > machine.longest
    run, most = machine.run(), 0
    for k in range(0, len(raw) * 20, 7):
        run.feed((raw * 20)[k : k + 7])
        most = max(most, len(run.data))
    assert most <= machine.lookahead()  # the state doesn't grow with the run


def test_texts_in_pieces(ranks):
    own, enc = tokenizer.Encoder(ranks), reference(ranks)
    draw = random.Random(8)
    texts = ["".join(draw.choice(["từ ", "nghiêng", "  ", "\n", "12", "!?", " ", "'s", "😀"]) for _ in range(300)) for _ in range(30)]
    texts += ["x" * 900, " " * 900 + "x", "\n" * 500 + " x", "a" + " " * 700, "7" * 800 + "-" * 800 + " x", " \n" * 300 + "y"]
    for t in texts:
        for size, most in ((1, 5), (7, 20), (100, 60)):
            got = b"".join(own.stream((t[i : i + size] for i in range(0, len(t), size)), most))
            assert np.frombuffer(got, np.int32).tolist() == enc.encode_ordinary(t)


def test_vocabularies_of_equal_size(spark, ranks, tmp_path):
    import base64

    other = {b: len(ranks) - 1 - i for b, i in ranks.items() if len(b) == 1}
    swapped = {b: len(other) - 1 - k for k, b in enumerate(other)}
    df = spark.createDataFrame([(1, "abc")], "id long, text string").coalesce(1)
    got = []
    for k, v in enumerate((dict(zip(other, range(256))), swapped)):
        path = tmp_path / f"{k}.tiktoken"
        path.write_bytes(b"\n".join(base64.b64encode(b) + b" %d" % i for b, i in v.items()))
        got.append(tokenizer.encode_table(df, "id", "text", str(path)).first().ids == [v[c.encode()] for c in "abc"])
    assert got == [True, True]


def test_encode_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (1, "a b"), (4, LONG)], "id long, text string").withColumn("ids", tokenizer.pa.__version__ != "" and __import__("pyspark.sql.functions", fromlist=["lit"]).lit(0))
    rows = tokenizer.encode_table(df, "id", "text").collect()
    assert len(rows) == 5 and {r.id: r.ids for r in rows if r.id in (2, 3)} == {2: [], 3: []}
    assert tokenizer.encode_table(df.limit(0), "id", "text").count() == 0


# --- 7 ---------------------------------------------------------------------------------------------------------------


def test_leaks_against_brute_force(spark):
    random.seed(7)
    vocabulary = ["ba", "Đi", "mét", "x", "hai", "12", "về", "nó"]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([8, 14, 30]))), random.choice([None, " ".join(random.choices(vocabulary, k=12))])) for i in range(12)]
    docs = []
    for i in range(120):
        t = " ".join(random.choices(vocabulary, k=random.choice([0, 9, 60])))
        if i % 3 == 0:
            w = items[i % 12][1].split()
            t = t + ", " + " - ".join(w[: random.choice([9, 10, 25])]).upper().replace("Đ", "D") + " " + t
        docs.append((i, t))
    docs += [(200, None), (201, ""), (0, docs[0][1]), (202, LONG)]
    own = {}
    for i, q, a in items:
        for t in (q, a):
            w = leakage.words(t)
            for k in range(len(w) - 9):
                own.setdefault(tuple(w[k : k + 10]), set()).add(i)
    want = {(d, i) for d, t in docs for w in [leakage.words(t)] for k in range(len(w) - 9) for i in own.get(tuple(w[k : k + 10]), ())}
    d = spark.createDataFrame(docs, "doc long, text string")
    e = spark.createDataFrame(items, "item long, q string, a string")
    found = leakage.leaks(d, "doc", "text", e, "item", ["q", "a"])
    assert {(r.doc, r.item) for r in found.collect()} == want and want
    assert {(r.doc, r.item) for r in leakage.leaks(d, "doc", "text", e, "item", ["q", "a"], block=40).collect()} == want  # several passes
    assert {r.doc for r in leakage.without_leaks(d, "doc", found).collect()} == {i for i, _ in docs} - {i for i, _ in want}
    # the longest matches and their places
    text, own = dict(docs), {(i, k): leakage.words(t) for i, *ts in items for k, t in enumerate(ts)}
    for r in found.collect():
        x = leakage.words(text[r.doc])
        longest = max(n for k in (0, 1) for y in [own[r.item, k]] for p in range(len(x)) for s in range(len(y)) for n in [next((n for n in range(61) if p + n >= len(x) or s + n >= len(y) or x[p + n] != y[s + n]), 61)])
        assert r.length == longest and x[r.in_doc : r.in_doc + longest] == own[r.item, r.field][r.in_text : r.in_text + longest]
    assert leakage.leaks(d.limit(0), "doc", "text", e, "item", ["q", "a"]).count() == 0
    assert leakage.leaks(d, "doc", "text", e.limit(0), "item", ["q", "a"]).count() == 0


def test_words_of_leaks():
    plain = leakage.words("dài 5 μm, góc α và ΔT ở đây")
    for same in ("DÀI 5 ΜM, GÓC Α VÀ ΔT Ở ĐÂY", "dai 5 µm goc α va δt o day", "ｄài\u00a05\u200b μm góc α và Δt ở đâу"):
        assert leakage.words(same) == plain
    assert leakage.words("CO₂ Ⅷ") == leakage.words("co2 VIII") and leakage.words(None) == []


def test_suffix_array():
    draw = np.random.default_rng(5)
    for n, k in ((1, 2), (30, 2), (400, 3), (400, 40)):
        a = np.concatenate([draw.integers(0, k, n), np.zeros(8, np.int64)])
        at = np.flatnonzero(a)
        end = [int(np.flatnonzero(a[i:] == 0)[0]) + i for i in at]
        suffix = {i: a[i:e].tolist() for i, e in zip(at.tolist(), end)}
        got = leakage.suffix_array(a, at, 500).tolist()
        assert sorted(got) == at.tolist() and [suffix[i] for i in got] == sorted(suffix.values())


# --- 8 ---------------------------------------------------------------------------------------------------------------


def test_labels():
    assert [language.label_code(x) for x in ("VI", "vi_VN", "tiếng Việt", "eng", "en-GB", "Deutsch", " fr ", "spa", "pt", "xx", "", None, "?")] == ["vi", "vi", "vi", "en", "en", "de", "fr", "es", None, None, None, None, None]


def test_languages(spark):
    de, en = LABELLED[3][0], LABELLED[1][0]
    rows = [(100 + i, t, c) for i, (t, c) in enumerate(LABELLED)]
    rows += [(1, VI, "fr"), (2, VI, None), (3, VI + " " + en, "vi"), (4, "$x^2$ 12", "und"), (5, None, "vi"), (6, "", None), (7, unicodedata.normalize("NFD", VI), "vi"), (8, language.bare(VI), "vi"), (9, VI + " (tiếng Anh: slope)", "vi"), (10, de, "ger"), (10, de, "ger"), (11, VI * 300, "xx")]
    df = spark.createDataFrame([(a, b, c, 0) for a, b, c in rows], "id long, text string, lang string, key int")
    got = sorted((r.id, r.lang) for r in language.mislabelled(df, "id", "text", "lang").collect())
    assert got == [(1, "vi"), (2, "vi"), (3, "en"), (3, "vi"), (11, "vi")]
    segs = [r for r in language.segment_languages(df, "id", "text", "lang").where("id = 3").collect()]
    assert {r.lang for r in segs} == {"vi", "en"} and all(r.confidence > 0.9 for r in segs)
    assert language.mislabelled(df.limit(0), "id", "text", "lang").count() == 0
