import base64
import itertools
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.llm import markup, neardup, packing, quality, sameform, sentences, splitting, tokens


def tokenizer():
    import tiktoken

    with open(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", None, " ", "\n\n \t", "Olá mundo, isto é um teste.", "<|endoftext|> é texto", "aaaaaaaaaaaaaaaaaaaaaaaaa", "日本語のテキスト。中文文本！", "สวัสดีชาวโลก", "नमस्ते दुनिया", "don't we'll I'm", "x" * 3000, "a\r\nb  c   d", "👩‍🔬🇧🇷", "１２３ ﬁ e\u0301"]


# problem 6


def test_ids_equal_the_public_library(spark):
    enc = tokenizer()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(3, ODD[4]), (3, ODD[4])], "doc_id long, text string").withColumn("ids2", F.lit(1))
    got = tokens.encode_texts(df, keep=["doc_id"]).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        if r.doc_id != 3:
            assert list(r.ids) == enc.encode_ordinary(ODD[r.doc_id] or "")
    counts = {r.doc_id: r.n for r in tokens.encode_texts(df, keep=["doc_id"], out="n", only_count=True).collect() if r.doc_id != 3}
    assert counts == {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(ODD) if i != 3}
    assert tokens.encode_texts(df.limit(0), keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        tokens.encode_texts(df, keep=["ids2"], out="ids2")


def test_ids_of_random_texts_and_round_trip():
    enc, rng = tokenizer(), random.Random(5)
    texts = ["".join(rng.choice("ab eé1.,\n日สन") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    e = tokens.PartitionEncoder(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.tiktoken")
    ids, counts = e.encode(texts)
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == enc.encode_ordinary(t)
        assert enc.decode(ids[a:b].tolist()) == t


def test_long_words_take_seconds():
    import time

    enc, rng = tokenizer(), random.Random(6)
    e = tokens.PartitionEncoder(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.tiktoken")
    for text in ("a" * 100_000, "=" * 30_000, "".join(rng.choice("acgt") for _ in range(20_000)), "aab" * 5_000):
        began = time.time()
        assert e.encode([text])[0].tolist() == enc.encode_ordinary(text)
        assert time.time() - began < 5


def test_ids_decode_to_their_texts(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    back = tokens.decode_ids(tokens.encode_texts(df, keep=["doc_id"]), keep=["doc_id"]).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in enumerate(ODD)}
    odd = spark.createDataFrame([(1, [60_000, 5]), (2, None), (3, []), (4, [None])], "doc_id long, ids array<int>").withColumn("n", F.lit(1))
    assert {r.doc_id: r.text for r in tokens.decode_ids(odd, keep=["doc_id"]).collect()} == {1: None, 2: None, 3: "", 4: None}
    with pytest.raises(ValueError):
        tokens.decode_ids(odd, keep=["n"], out="n")
    monkeypatch.chdir(tmp_path)
    tokens.PartitionEncoder(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.tiktoken").encode(["palavra"])
    assert not list(tmp_path.iterdir())


# problem 4


def check_pieces(text, pieces, limits):
    words = [m.span() for m in re.finditer(r"[^ \t\r\n]+", text)]
    assert pieces[0][0] == words[0][0] and pieces[-1][1] == words[-1][1]
    for k, (s, e, n, shared) in enumerate(pieces):
        assert s < e <= s + limits.chars and n == len(re.findall(r"[^ \t\r\n]+", text[s:e])) <= limits.tokens
        if k:
            before = pieces[k - 1][1]
            assert e > before and not text[before:s].strip(" \t\r\n")
            assert shared == (len(re.findall(r"[^ \t\r\n]+", text[s:before])) if s < before else 0) <= limits.overlap


def test_pieces_are_legal_and_equal_a_greedy_walk():
    rng, limits = random.Random(6), splitting.Limits(20, 200, 4)
    texts = []
    for _ in range(120):
        ws = ["".join(rng.choice("abcdefg") for _ in range(rng.choice([1, 3, 5, 9, 60, 300]))) + rng.choice(["", "", ".", "。", "!", ".”"]) for _ in range(rng.randint(1, 60))]
        texts.append(rng.choice(["", " "]) + "".join(w + rng.choice([" ", " ", "\n", "\n\n", "  "]) for w in ws))
    texts += ["a" * 1000, "字" * 1000, "x. " * 200]
    for t, pieces in zip(texts, splitting.split_texts(texts, limits), strict=True):
        check_pieces(t, pieces, limits)
        states, begin, nxt, _, _ = splitting.successors(splitting._marks(t), limits)
        at, walk = 0, []
        while nxt[at] >= 0:
            walk.append((int(begin[at]), int(states[nxt[at]])))
            at = int(nxt[at])
        assert [p[:2] for p in pieces] == (walk or [(pieces[0][0], pieces[0][1])])


def test_overlap_is_full_and_cuts_are_natural():
    text = " ".join(f"Frase numero {i} tem oito palavras ao todo." for i in range(300))
    (pieces,) = splitting.split_texts([text])
    assert all(p[3] == 64 for p in pieces[1:]) and all(text[p[1] - 1] == "." for p in pieces)


def test_long_runs_of_separators_lose_no_token():
    texts = ["a" + " " * 7000 + "b", "w " * 200 + " " * 5800 + "longtoken" * 10 + " end", " " * 7000 + "a" + "\n" * 13000 + "b c" + " " * 6143 + "x" * 9000 + " " * 7000]
    for t, pieces in zip(texts, splitting.split_texts(texts), strict=True):
        check_pieces(t, pieces, splitting.Limits())
        held = {i for s, e, _, _ in pieces for i in range(s, e)}
        assert all(i in held for i, c in enumerate(t) if c not in " \t\r\n")


def test_split_frame(spark):
    rows = [("d", "u1", "w " * 800, ["S"]), ("d", "u1", "w " * 800, ["S"]), ("d", "u2", "curto", None), ("d", "u3", None, None), ("d", "u4", " " * 7000, None), ("d", "u5", "", None)]
    df = spark.createDataFrame(rows, "document_id string, unit_id string, text string, section_path array<string>").withColumn("piece", F.lit(1))
    got = splitting.split_oversized(df, ["document_id", "unit_id"], keep=["section_path"]).collect()
    assert {r.unit_id for r in got} == {"u1", "u4"} and len([r for r in got if r.unit_id == "u1"]) == 2
    assert all(r.section_path == ["S"] for r in got if r.unit_id == "u1")
    assert splitting.split_oversized(df.limit(0), ["document_id", "unit_id"]).count() == 0
    with pytest.raises(ValueError):
        splitting.Limits(10, 100, 10)


# problem 3


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(60):
        base = [rng.choice(vocab) for _ in range(80)]
        rows.append((f"{i:03d}a", " ".join(base)))
        for j in range(rng.randint(0, 3)):
            other = list(base)
            for _ in range(rng.randint(0, 8)):
                other[rng.randrange(len(other))] = rng.choice(vocab)
            rows.append((f"{i:03d}b{j}", " ".join(other).upper() if j else "\n".join(other)))
    rows += [("dup1", rows[0][1]), ("dup2", rows[0][1]), ("dup2", rows[0][1]), ("short", "a b c"), ("none", None), (None, rows[0][1]), ("empty", "")]
    members, links = neardup.near_duplicates(spark.createDataFrame(rows, "id string, text string").repartition(3), run=3, threshold=0.6, least_runs=30)
    got = {(r.a, r.b) for r in neardup.near_duplicate_pairs(members, links).collect()}
    sets = {}
    for i, t in rows:
        if i and t:
            w = t.lower().split()
            s = set(zip(w, w[1:], w[2:], strict=False))
            if len(s) >= 30:
                sets[i] = s
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    assert got == want and len(want) > 60
    empty = neardup.near_duplicates(spark.createDataFrame([], "id string, text string"), run=3, threshold=0.6)
    assert neardup.near_duplicate_pairs(*empty).count() == 0


def test_one_text_many_times(spark):
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(2, 62))
    rows = spark.range(5000).select(F.format_string("c%05d", "id").alias("id"), F.lit(text).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([("x1", other), ("x2", "fora " * 50)], "id string, text string"))
    members, links = neardup.near_duplicates(rows, run=3, threshold=0.6, least_runs=30)
    assert links.count() == 1
    got = {r.id: (r.cls, r.n_links) for r in neardup.near_duplicate_classes(members, links).collect()}
    assert len(got) == 5001 and {v[1] for v in got.values()} == {1} and len({v[0] for v in got.values()}) == 2
    x1 = neardup.near_duplicate_pairs(members.where("id in ('x1', 'c00001', 'c00002', 'c04999')"), links).collect()
    assert len(x1) == 6
    between = neardup.spread_pairs(links.select("a", "b"), members.select("id", "cls"))
    assert between.count() == 5000


def test_pruning_keeps_similar_pairs():
    rng = np.random.default_rng(8)
    for share, kept in ((0.6, True), (0.8, True), (0.1, False)):
        a = rng.integers(0, 65536, size=(2000, neardup.VALUES)).astype(np.uint16)
        b = np.where(rng.random(a.shape) < share, a, rng.integers(0, 65536, size=a.shape).astype(np.uint16))
        alive = neardup.likely(a, b, 0.6).mean()
        assert alive > 0.999 if kept else alive < 0.01


# problem 8


def flat_scores():
    n = sameform._alphabet()[1]
    return np.zeros((n, n), dtype=np.float32)


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Ｆｕｌｌ １２", "Full 12", True), ("cafe\u0301", "café", True), ("ﬁm", "fim", True), ("сaso", "caso", True), ("A\u200bB\u00adC", "ABC", True), ("a\u00a0b\u2007c\u202fd", "a b c d", True), ("Οlho", "Olho", True),
        ("caso", "Caso", False), ("m2", "m²", False), ("cafe", "café", False), ("a\nb", "a b", False), ("½", "1/2", False), ("a  b", "a b", False), ("l", "1", False), ("a\r\nb", "a\nb", False),
    ],
)
def test_which_texts_read_the_same(a, b, same):
    x, y = sameform.Former(flat_scores()).forms([a, b])
    assert (x == y) == same


def test_forms_stay_in_their_script():
    f = sameform.Former(flat_scores())
    russian = "Урожай региона о совете по этапу"
    mixed = russian.replace("о", "o").replace("р", "p").replace("а", "a")
    assert f.forms([russian, mixed]) == [russian, russian]
    assert f.forms(["Ο φόρος της υγείας", "O φóρoς της υγείας"])[0] == "Ο φόρος της υγείας"
    assert f.forms([None, "", "  "]) == [None, "", "  "]


def test_forms_keep_just_the_look_alike_classes():
    rng, f = random.Random(9), sameform.Former(flat_scores())
    to = {x: row[0] for row in sameform.LOOKALIKES for x in row.replace(" ", "")}
    letters = list(to) + list("bdжλ ñ1")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(500)]
    skeleton = lambda t: "".join(to.get(c, c) for c in unicodedata.normalize("NFD", t))
    for t, form in zip(texts, f.forms(texts), strict=True):
        assert skeleton(form) == skeleton(t)
    assert f.forms([skeleton(t) for t in texts]) == f.forms(texts)


def test_equal_form_pairs(spark):
    rows = [(1, "caso"), (2, "сaso"), (3, "caso"), (4, "ｃａｓｏ"), (5, "outro"), (6, None), (7, ""), (8, "\u200b"), (9, "Caso"), (None, "caso"), (2, "сaso")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit(1))
    assert {(r.a, r.b) for r in sameform.equal_form_pairs(df, "doc_id").collect()} == {(1, 2), (2, 3), (1, 4), (3, 4), (2, 4)}
    assert sameform.equal_form_pairs(df.limit(0), "doc_id").count() == 0


def learned_scores(spark, texts):
    return sameform.bigram_scores(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_search_decides_loose_readings(spark):
    prose = ["the mind under the sun runs until the kind man gets a gun and milk"] * 40 + ["ο άνθρωπος και η πόλη της νύχτας που δεν τελειώνει ποτέ"] * 40 + ["кто там живёт и как он тут работает"] * 40
    scores, flat = learned_scores(spark, prose), flat_scores()
    pairs = [("the mınd", "the mind"), ("the ɡun", "the gun"), ("the sսn", "the sun"), ("the mιnd", "the mind"), ("the rսns until", "the runs until"), ("the mιlк", "the milk")]
    form = lambda t, s: sameform.Former(s, loose=True).forms([t])[0]
    assert all(form(a, scores) == form(b, scores) == b for a, b in pairs)
    assert any(form(a, flat) != form(b, flat) for a, b in pairs)  # without scores other verdicts
    assert not any(sameform.Former(scores).forms([a]) == sameform.Former(scores).forms([b]) for a, b in pairs)  # nor without loose readings
    for own in ("η νύχτα που", "как тут", "ısı ve kısa"):  # whole words of another alphabet stay
        assert form(own, scores) == own or own.startswith("ı")


@pytest.mark.parametrize(("a", "b"), [("𝐇𝐞𝐥𝐥𝐨 𝟏𝟐", "Hello 12"), ("𝑥²", "x²"), ("Ⅳ. Ⅼⅼ", "IV. Ll"), ("Ꭺ Ꮋ", "A H"), ("cօde ԁata", "code data"), ("ϲaso", "caso"), ("ℎ", "h")])
def test_compatibility_letters_and_further_alphabets(a, b):
    x, y = sameform.Former(flat_scores(), loose=True).forms([a, b])
    assert x == y == b


def test_form_classes(spark):
    rows = [(1, "caso"), (2, "сaso"), (3, "caso"), (4, "ｃａｓｏ"), (5, "outro"), (6, None), (7, " "), (None, "caso"), (2, "сaso")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.class_id, r.n_links) for r in sameform.form_classes(sameform.form_members(df, "doc_id")).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and len({got[i] for i in (1, 2, 3, 4)}) == 1 and got[1][1] == 2 and got[5][1] == 0
    assert sameform.form_classes(sameform.form_members(df.limit(0), "doc_id")).count() == 0


# problem 5

CASES = [
    ("pt", ["O Dr. Silva mediu 3.5 km.", "A Profa. Dra. Ana concordou, p. ex., em Roma.", "Fim"]),
    ("pt", ["“A rede caiu. O valor subiu”, afirmou a Sra. Ana.", "“Uma frase.”", "(O teste passou.)", "Outra… mas não aqui…", "Nova."]),
    ("en", ["The depot belongs to Sarv & Co.", "Mr. A and Mrs. B met at 10 p.m.", "See Fig. 7, i.e. the plot.", '"Is it?" asked the team.', "In vol. 4, no. 5, it ends."]),
    ("de", ["Am 3. Oktober 2008 gilt das.", "„Stimmt es?“, fragte das Team.", "Vgl. Abb. 30, d. h. hier.", "Ende 2009.", "Neu."]),
    ("fr", ["Selon M. Dupont, c'est fini.", "« Vrai ? » demande l'équipe.", "Le dépôt appartient à X S.A.", "La fin."]),
    ("es", ["¿Por qué?", "A las 9 a. m., la beca llegó.", "¡Fin!", "R. J. Torres observó que sí."]),
    ("ru", ["По словам д-ра Ivan, рост с 2005 г. по 1996 г.", "План, т. е. схема.", "Книги, проезд и т. д.", "В т. 5, с. 7, ясно."]),
    ("el", ["Γιατί μετρά;", "Ο κ. Νίκος ξέρει, π.χ. εδώ.", "Τέλος."]),
]


@pytest.mark.parametrize(("lang", "parts"), CASES)
def test_sentences(lang, parts):
    text = " ".join(parts)
    assert [text[a:b] for a, b in sentences.sentences(text, lang)] == parts


def test_sentences_without_spaces_or_capitals():
    for text, parts in (
        ("税率修正了补贴。“合同。项目。”负责人这样说。为什么？好！", ["税率修正了补贴。", "“合同。项目。”负责人这样说。", "为什么？", "好！"]),
        ("「計画は。」と述べた。終わり……しかし続く。", ["「計画は。」と述べた。", "終わり……しかし続く。"]),
        ("डॉ. सिंह ने 3.5 प्रतिशत कहा। क्या? हाँ!", ["डॉ. सिंह ने 3.5 प्रतिशत कहा।", "क्या?", "हाँ!"]),
        ("ครัวเรือนในปี 1988 เป็นต้นมา วัคซีนยืนยัน", ["ครัวเรือนในปี 1988 เป็นต้นมา", "วัคซีนยืนยัน"]),
        ("primeira frase. segunda frase", ["primeira frase.", "segunda frase"]),
        ("Uma linha\nquebrada aqui.Sem espaço depois.", ["Uma linha\nquebrada aqui.", "Sem espaço depois."]),
    ):
        assert [text[a:b] for a, b in sentences.sentences(text)] == parts
    assert sentences.sentences(None) == sentences.sentences("") == sentences.sentences(" \n ") == []


def test_quotations_and_brackets_of_any_length():
    inner = "A rede caiu. O valor subiu. " * 400
    for a, b in ("“”", "«»", "()", "[]", '""'):
        parts = [f"{a}{inner}Fim.{b}", "Uma frase."]
        text = " ".join(parts)
        assert len(parts[0]) > 10_000 and [text[x:y] for x, y in sentences.sentences(text, "pt")] == parts


def test_marks_of_further_scripts_and_languages():
    for tag, parts in (("my", ["မြန်မာ။", "ဘာသာ။"]), ("hy", ["Բարեւ։", "Ինչպես ես։"]), ("am", ["ሰላም።", "እንዴት ነህ፧"]), ("km", ["សួស្តី។", "អរគុណ។"]), ("ro", ["Azi dl. Popescu de la București este cu noi.", "Da."]), ("it", ["Il sig. Rossi è con la figlia di Anna.", "Fine."])):
        text = " ".join(parts)
        assert [text[a:b] for a, b in sentences.sentences(text, tag)] == parts


def test_sentences_cover_the_text(spark):
    rng = random.Random(10)
    for _ in range(200):
        t = "".join(rng.choice(["a", "B", ".", " ", "\n", "“", "”", "(", ")", "。", "日", "3", "?", ";"]) for _ in range(40))
        spans = sentences.sentences(t)
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in itertools.pairwise(spans))
        assert "".join(t[a:b] for a, b in spans).replace(" ", "").replace("\n", "") == t.replace(" ", "").replace("\n", "")
    df = spark.createDataFrame([("d", "b", "Um. Dois."), ("d", "c", None)], "document_id string, block_id string, text string")
    got = sentences.split_sentences(df, ["document_id", "block_id"]).collect()
    assert [(r.start_pos, r.end_pos) for r in got] == [(0, 3), (4, 9)]
    assert sentences.split_sentences(df.limit(0), ["document_id"]).count() == 0


# problem 2


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<p>Um <b>dois</b></p>", "Um dois"), ("## Título\ntexto", "Título\ntexto"), ("a **b** _c_ `d`", "a b c d"), ("[x](http://a.example/1) y", "x y"), ("[[Vila|Torre]] z", "Torre z"), ("12\\% de \\emph{juros}", "12% de juros"),
        ("caf&eacute; &amp; p&#227;o", "café & pão"), ("um<!-- p. 3 --> dois", "um dois"), ("'''A''' ''b''", "A b"), ("Nome\n=====\nfim", "Nome\n\nfim"), ("o {{ref|ano=1}} fim", "o  fim"), ("vale $x_2$ sim", "vale x_2 sim"), ("~~a~~ b", "a b"), ("[^3] nota", " nota"),
    ],
)
def test_markup_is_found_and_removed(text, want):
    clean, n, _ = markup.clean(text)
    assert n > 0 and clean.strip("\n") == want


@pytest.mark.parametrize("text", ["7 < 18 > 1", "(p < 0,04 e n > 43)", "<não informado>", "P&D", "C# ou F#", "de R$ 3,00 a R$ 5,00", "C:\\base\\occ", "____________", "var_ab_1", "(6 * 2 * 2)", "(*)", "#42 ~35 {1, 2} [35] |r| = 0.35", "8' 31'' e 4' 11''", "| a | b |\n| --- | --- |", "- item\n1. um\na) dois", "http://a.example/x_y_z", "", None, "  "])
def test_look_alikes_of_markup_stay(text):
    assert markup.clean(text)[:2] == (text, 0)


def test_words_of_footnotes_stay():
    assert markup.clean("A vila\\footnote{Vila Marvulêlim} cresce.")[0] == "A vila Vila Marvulêlim cresce."
    assert markup.clean("\\footnote[2]{Vila Marvulêlim}")[0] == "Vila Marvulêlim"
    assert markup.clean("A vila\\label{sec} cresce.")[0] == "A vila cresce."


def test_every_match_of_a_pattern_passes_the_first_test(spark):
    texts = {
        "comment": ["<!-- a -->"], "tag": ["<b>"], "entity": ["&amp;"], "fence": ["```"], "code": ["`d`"], "image": ["![a](b)"], "link": ["[a](http://b.c)"], "reflink": ["[^3]", "[nota]: alvo", "a\n[nota]: alvo", "[a][b]"],
        "strong": ["**a**", "__a__"], "em": ["*a*", *(f"{c}_x_" for c in ("", '"', "“", "\t", "–", "-", "[", "/", "\n", " ", "("))], "half": ["a ** b"], "strike": ["~~a~~"], "heading": ["# a"], "setext": ["a\n==="], "quote": ["> a"],
        "wikihead": ["== a ==", "      == a =="], "quotes": ["''a''"], "wikilink": ["[[a]]"], "extlink": ["[http://a.b x]", "[ftp://a.b x]"], "template": ["{{a}}"], "wikitable": ["{| a", "|-", "! a !! b"], "magic": ["__TOC__"], "command": ["\\emph"], "escape": ["\\%"], "display": ["$$"], "math": ["$x_2$"],
    }
    patterns = dict(markup._COMPILED)
    assert texts.keys() == patterns.keys() and all(patterns[k].search(t) for k, ts in texts.items() for t in ts)
    rows = [(k, t) for k, ts in texts.items() for t in ts]
    got = spark.createDataFrame(rows, "kind string, text string").where(~markup.maybe_marked(F.col("text"))).collect()
    assert not got


STRUCTURED = [
    ("## Title\ntext **b**", "## Title\ntext b"), ("x <h2>A <i>b</i></h2> y", "x\n## A b\n y"), ("```py\nx = **2** # <b>&amp;\n```\nfim **a**", "```py\nx = **2** # <b>&amp;\n```\nfim a"), ("`a*b*` e <b>c</b>", "`a*b*` e c"),
    ("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>&lt;2</td></tr></table>", "| A | B |\n| --- | --- |\n| 1 | <2 |"), ("vale $\\frac{a}{b}$ e \\frac{c}{d} sim", "vale $\\frac{a}{b}$ e \\frac{c}{d} sim"),
    ("$$ x_{1} = **2** $$\n\\[ y \\] \\(z\\)", "$$ x_{1} = **2** $$\n$$ y $$ $z$"), ("\\begin{equation}\na = \\frac{1}{2}\n\\end{equation} fim", "$$\na = \\frac{1}{2}\n$$ fim"), ("\\begin{itemize}\n\\item um\n\\item dois\n\\end{itemize}", "- um\n- dois"),
    ("\\section{Um} \\textbf{b \\emph{c}} d", "## Um\n b c d"), ("<ol><li>um</li><li>dois</li></ol>", "1. um\n2. dois"), ("<ul><li>um</li><li>dois</li></ul>", "- um\n- dois"), ("== H ==\n@A @@b@@ c@ [[V|T]]".replace("@@", "''").replace("@", "'" * 3), "## H\nA b c T"),
    ("Nome\n=====\nfim", "# Nome\n\nfim"), ("{| class=x\n|-\n! a !! b\n|-\n| 1 || 2\n|}", "| a | b |\n| --- | --- |\n| 1 | 2 |"), ("<pre>a &lt; b\n  c</pre>", "```\na < b\n  c\n```"), ("\\href{http://a.b}{texto} fim", "texto fim"),
]


@pytest.mark.parametrize(("text", "want"), STRUCTURED)
def test_structure_is_kept(text, want):
    got, n, _ = markup.clean(text, form="structured")
    assert got.strip("\n") == want and n > 0
    again = markup.clean(got, form="structured")[0]
    assert again == got  # what was made of marks is stable


def test_marks_of_any_length():
    for k, text in (("em", "*" + "a" * 1000 + "*"), ("strong", "**" + "b c" * 1000 + "**"), ("template", "{{" + "x\n" * 1000 + "}}"), ("wikilink", "[[" + "y" * 900 + "]]"), ("math", "$x_" + "z" * 900 + "$"), ("strike", "~~" + "d" * 2000 + "~~"), ("quotes", "''" + "e" * 2000 + "''"), ("reflink", "[^" + "n" * 90 + "]")):
        got, n, kinds = markup.clean(f"Um {text} fim.")
        assert n >= 1 and k in kinds and not set("*{}[]$~'") & set(got), k


def test_many_open_marks_take_no_time():
    import time

    for text in ("**a " * 8000, "<b " * 8000, "\\a{" * 8000, "''a " * 8000, "$1 " * 8000, "[[a " * 8000, "{{a " * 8000, "~~a " * 8000, "\\a" * 8000):
        began = time.time()
        markup.tree(text)
        assert time.time() - began < 3, text[:5]


def test_any_candidate_passes_the_first_test(spark):
    rng = random.Random(13)
    bits = ["<", ">", "b", "/", "*", "**", "_", "`", "~", "~~", "#", "=", "==", "===", "[", "]", "(", ")", "^", "!", "|", "{", "}", "{{", "}}", "'", "''", "\\", "$", "$$", "&", ";", "amp", "x", "1", " ", "\n", '"', "—", "é", ":", "http://a", "ftp://b", "TOC", "-", "+", "%"]
    texts = sorted({"".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(20000)})
    marked = [t for t in texts if markup.candidates(t)]
    assert len(marked) > 2000
    assert spark.createDataFrame([(t,) for t in marked], "text string").where(~markup.maybe_marked(F.col("text"))).collect() == []


def test_coupling_decides():
    p = markup.trained()
    for text, whole in (("\\emph{x} e \\cite{y} em {um} dois", "x e  em um dois"), ("<p>um</p><br><nota>dois</nota> <hr>", "um\n\ndois"), ("12~15 e <não dito>", "12~15 e <não dito>"), ("C:\\base\\occ diz [sic] aqui", "C:\\base\\occ diz [sic] aqui")):
        assert markup.clean(text, p)[0].strip() == whole
    flipped = [t for t in ("C:\\base\\occ diz [sic] aqui", "D:\\a1 {nota} b", "\\\\vila\\casa [sic]", "<não dito> p.~3", "<não dito> {um} dois") if (markup.clean(t, p)[1] > 0) != (markup.clean(t, p.uncoupled())[1] > 0)]
    assert len(flipped) >= 2 and all(markup.clean(t, p)[1] == 0 for t in flipped)


def test_sum_product_equals_enumeration():
    p = markup.Potentials({}, {"x": 0.7, "y": -0.4, "z": 1.3}, ((0.5, -0.2), (-0.3, 0.6)))
    node = lambda k, *c: markup.Node(k, 0, 1, None, (), children=list(c))
    a, b, c, d = node("x"), node("y"), node("z"), node("y")
    a.children, b.children = [b, d], [c]
    root = markup.Node("root", 0, 1, None, (), children=[a])
    markup.marginals(root, p)
    total, on = 0.0, [0.0] * 4
    for s in itertools.product((0, 1), repeat=4):
        own = sum((1 if v else -1) * p.by_kind[n.kind] / 2 for v, n in zip(s, (a, b, c, d), strict=True))
        w = np.exp(own + p.coupling[0][s[0]] + p.coupling[s[0]][s[1]] + p.coupling[s[0]][s[3]] + p.coupling[s[1]][s[2]])
        total += w
        on = [x + w * v for x, v in zip(on, s, strict=True)]
    assert [n.residue for n in (a, b, c, d)] == pytest.approx([x / total for x in on], abs=1e-6)


def test_sum_product_with_kinds_of_markup_equals_enumeration():
    p = markup.trained()
    root = markup.tree("<b>um **dois**</b> {x} [y](http://a.b) <não> \\emph{z}")
    nodes, stack = [], list(root.children)
    while stack:
        n = stack.pop()
        nodes.append(n)
        stack += n.children
    markup.marginals(root, p)
    total, on = 0.0, [0.0] * len(nodes)
    for r in range(len(markup.ROOTS)):
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            of = {id(n): y for n, y in zip(nodes, labels, strict=True)}
            w = p.roots[r] + sum((y - 0.5) * p.of(n) for n, y in zip(nodes, labels, strict=True))
            w += sum(p.edge(q, c)[r if q is root else of[id(q)]][of[id(c)]] for q in (root, *nodes) for c in q.children)
            total += np.exp(w)
            on = [x + np.exp(w) * y for x, y in zip(on, labels, strict=True)]
    assert [n.residue for n in nodes] == pytest.approx([x / total for x in on], abs=1e-6)


def test_model_on_held_out_pages():
    right = seen = 0
    for text, spans in markup.labelled_pages(150, seed=99):
        root = markup.tree(text)
        markup.marginals(root, markup.trained())
        for n in root.children:
            label = next((y for a, b, y in spans if a <= n.start < b), False)
            seen += 1
            right += (n.residue > 0.5) == label
    assert seen > 300 and right / seen > 0.97


def test_markup_frame(spark):
    df = spark.createDataFrame([(1, "<b>x</b>"), (2, None), (3, "puro"), (1, "<b>x</b>")], "id int, text string")
    got = sorted((r.id, r.clean_text, r.n_marks) for r in markup.strip_markup(df, keep=["id"]).collect() if r.id != 2)
    assert got == [(1, "x", 1), (1, "x", 1), (3, "puro", 0)]
    assert markup.strip_markup(df.limit(0), keep=["id"]).count() == 0
    with pytest.raises(ValueError):
        markup.strip_markup(df.withColumn("n_marks", F.lit(1)))


# problem 7


def test_packing_is_whole_and_tight():
    rng = np.random.default_rng(11)
    for capacity in (50, 200):
        tokens_of = np.concatenate([rng.integers(1, 120, size=400), [0, 0, capacity, 3 * capacity, 2 * capacity + 1]])
        got = packing.pack(np.arange(len(tokens_of)), tokens_of, capacity)
        assert (got.groupby("bin")["n_tokens"].sum() <= capacity).all()
        assert got.groupby("id")["n_tokens"].sum().tolist() == tokens_of.tolist()
        pieces = got.groupby("id").size().to_numpy()
        assert (pieces[tokens_of <= capacity] == 1).all()
        assert got["bin"].nunique() <= np.ceil(tokens_of.sum() / capacity) * 1.02 + 1


def test_local_search_empties_containers():
    sizes = np.array([6, 6, 5, 5, 4, 4])
    poor = [[0], [1], [2, 4], [3, 5]]
    better = packing.improve(sizes, poor, 10)
    assert len(better) == 3 and sorted(i for b in better for i in b) == list(range(6))
    assert packing.improve(np.array([], dtype=int), [], 10) == []


def test_local_search_beats_best_fit():
    rng, saved, lower = np.random.default_rng(3), 0, 0
    for _ in range(60):
        sizes = rng.integers(250, 450, size=60)  # two or three items a container: best fit leaves room that exchanges gather
        first = packing.best_fit(sizes, 1000)
        done = packing.improve(sizes, [list(b) for b in first], 1000)
        assert len(done) <= len(first) and sorted(i for b in done for i in b) == list(range(60))
        saved += len(first) - len(done)
        lower += len(done) < len(first)
    assert saved >= 3 and lower >= 3


def test_repeated_ids_are_spread(spark):
    items = spark.createDataFrame([(7, 3)] * 3000 + [(i, 5) for i in range(1000, 1400)], "id long, n_tokens long")
    specs = spark.createDataFrame([(1, 32)], "spec_id int, capacity_tokens int")
    got = packing.fill_containers(items, specs, group_items=200).toPandas()
    assert len(got) == 3400 and got.groupby("container_id")["n_tokens"].sum().max() <= 32
    sevens = got[got["id"] == 7]["container_id"].str.split("-").str[1].value_counts()
    assert len(sevens) == 17 and sevens.max() < 300


def test_fill_frame(spark):
    items = spark.createDataFrame([(i, 7 * i % 31) for i in range(200)] + [(500, None), (None, 3), (501, 100)], "doc_id long, n_tokens long")
    specs = spark.createDataFrame([(1, 32, "a"), (2, 64, "b"), (3, None, "c"), (4, 0, "d")], "spec_id int, capacity_tokens int, purpose string")
    got = packing.fill_containers(items, specs, "doc_id", group_items=64).toPandas()
    assert set(got["spec_id"]) == {1, 2} and (got["container_tokens"] <= got["capacity_tokens"]).all()
    for _, g in got.groupby("spec_id"):
        assert set(g["id"]) == set(range(200)) | {501} and g.groupby("container_id")["n_tokens"].sum().max() <= g["capacity_tokens"].iloc[0]
    assert packing.fill_containers(items.limit(0), specs, "doc_id").count() == 0 and packing.fill_containers(items, specs.limit(0), "doc_id").count() == 0


# problem 1


def labelled():
    rng = random.Random(12)
    noun, verb = ["rede", "valor", "plano", "estudo", "bairro", "custo"], ["mediu", "mostrou", "reduziu", "ampliou", "indicou"]
    sentence = lambda: f"O {rng.choice(noun)} de {rng.choice(noun)} {rng.choice(verb)} a {rng.choice(noun)} em {rng.randint(1990, 2020)}."
    out = []
    for _ in range(160):
        out.append((" ".join(sentence() for _ in range(rng.randint(4, 12))), 1.0))
        out.append(("\n".join(f"- o {rng.choice(noun)} de {rng.choice(noun)}" for _ in range(8)), 0.0))
        out.append(("| a | b |\n| --- | --- |\n" + "\n".join(f"| {rng.choice(noun)} | {rng.randint(1, 99)} |" for _ in range(6)), 0.0))
    return out


def test_prose_model_on_held_out_texts():
    rows = labelled()
    half = len(rows) // 2
    model = quality.fit([t for t, _ in rows[:half]], np.array([p for _, p in rows[:half]]))
    held = rows[half:]
    got = model.prose(quality.statistics([t for t, _ in held], model.tables)) > 0.5
    assert (got == np.array([p > 0.5 for _, p in held])).mean() > 0.97


def laid_out(rng, aligned):
    """The same words and gaps; only in one of the two do gaps stand in the same columns of all lines."""
    words = [w for _ in range(6) for w in f"o {rng.choice(['valor', 'plano', 'custo'])} de {rng.choice(['rede', 'bairro', 'vila'])} mediu a {rng.choice(['obra', 'ponte'])}".split()]
    lines = []
    for i in range(0, len(words) - 3, 4):
        cells = words[i : i + 4]
        gaps = [11 - len(c) for c in cells[:3]]
        if not aligned:
            total = sum(gaps)
            cut = sorted(rng.sample(range(2, total - 1), 2))
            gaps = [cut[0], max(1, cut[1] - cut[0]), max(1, total - cut[1])]
        lines.append("".join(c + " " * g for c, g in zip(cells, [*gaps, 0], strict=True)))
    return "\n".join(lines)


def test_structure_decides():
    rng = random.Random(14)
    rows = [(laid_out(rng, i % 2 == 0), float(i % 2)) for i in range(640)]
    texts, prose = [t for t, _ in rows], np.array([p for _, p in rows])
    right = {}
    for without in ((), quality.STRUCTURE):
        model = quality.fit(texts[:400], prose[:400], without=without)
        right[without] = ((model.prose(quality.statistics(texts[400:], model.tables)) > 0.5) == (prose[400:] > 0.5)).mean()
    assert right[()] > 0.95 and right[quality.STRUCTURE] < right[()] - 0.1
    col = {c: i for i, c in enumerate(quality.NAMES)}
    s = quality.statistics(["ab   cd   ef\nxy   zw   uv\nmn   op   qr", "ab cd   ef\nxyz   w uv\nm   nopq r", "- a\n  b\n  c\n- d\n  e\n  f\n- g\n  h\n  i\n- j\n  k\n  l", "| a | b |\n| c | d |"])
    assert s[0, col["delimiter_columns"]] == 1 and s[1, col["delimiter_columns"]] == 0 and s[3, col["delimiter_columns"]] == 1
    assert s[2, col["begin_spectrum"]] > 0.3 > s[0, col["begin_spectrum"]]


def test_statistics_of_single_texts_equal_those_of_a_batch():
    texts = [t for t, _ in labelled()[:30]] + ["", "x", "\n\n", None, "日本語。テスト。"]
    together = quality.statistics(texts)
    for t, row in zip(texts, together, strict=True):
        assert np.allclose(quality.statistics([t])[0], row)


def test_statistics_frame(spark):
    rows = labelled()
    chunks = spark.createDataFrame([(f"c{i}", t) for i, (t, _) in enumerate(rows)] + [("null", None), ("blank", " "), ("c0", rows[0][0])], "chunk_id string, text string")
    labels = spark.createDataFrame([(f"c{i}", "prose" if p else "list", "a1") for i, (_, p) in enumerate(rows)] + [(None, "prose", "a1")], "chunk_id string, label string, annotator string")
    model = quality.fit_on_labels(chunks, labels, 200)
    got = {r.chunk_id: r for r in quality.text_statistics(chunks, model, keep=["chunk_id"]).collect()}
    assert got["null"].prose_score == got["blank"].prose_score == 0 and got["c0"].prose_score > 0.5 > got["c1"].prose_score
    assert got["c0"].chars == len(rows[0][0]) and got["c0"].words == len(rows[0][0].split())
    assert quality.fit_on_labels(chunks, labels.limit(0)) is None
    assert quality.text_statistics(chunks.limit(0), None, keep=["chunk_id"]).count() == 0
