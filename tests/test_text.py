import re
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from vellumflow.functions import ids, quality, text, visual
from vellumflow.operators.chunking import ChunkConfig
from vellumflow.plans import catalog


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("r")).first().r


def test_normalize_text(spark):
    cases = {
        "educa-\nção e saúde": "educação e saúde",
        "a b​c": "a bc",
        "“x” ‘y’": "\"x\" 'y'",
        "fim , sim": "fim, sim",
        "R$ 1 . 234,56 ,": "R$ 1 . 234,56 ,",
        "a\r\nb\x07": "a b",
        "": "",
    }
    for raw, want in cases.items():
        assert one(spark, raw, text.normalize_text) == want
    assert one(spark, None, text.normalize_text) == ""
    assert one(spark, "- a \n - b", lambda c: text.normalize_text(c, False)) == "- a\n- b"


def test_words(spark):
    assert one(spark, "a b  c d e", text.count_words) == 5
    assert one(spark, "a b c d e", lambda c: text.word_pieces(c, 2)) == ["a b", "c d", "e"]
    assert one(spark, None, lambda c: text.word_pieces(c, 2)) == []
    assert one(spark, "a b c", lambda c: text.truncate_words(c, 2)) == "a b"
    assert one(spark, "Um. Dois! tres. 4", text.split_sentences) == ["Um.", "Dois! tres.", "4"]


def test_headings(spark):
    rows = [("2.1.3 Métodos", None, 3), ("Apêndice A", None, 1), ("Introdução", 2, 2), ("1. Um", 4, 1), ("", None, 1)]
    df = spark.createDataFrame(rows, "t string, f int, want int")
    for r in df.select(text.heading_level(F.col("t"), F.col("f")).alias("got"), "want").collect():
        assert r.got == r.want
    kinds = {
        "Referências": "bibliography", "2 Referências": None, "1.2 Lista de figuras": "list_of_figures", "REFERÊNCIAS BIBLIOGRÁFICAS": "bibliography", "Sumário": "table_of_contents", "Índice de figuras": "list_of_figures",
        "Lista de siglas": "acronym_list", "Anexo I - Questionário": "administrative_appendix", "Apêndice B": "analytical_appendix", "Conclusão": None,
    }
    for title, want in kinds.items():
        assert one(spark, title, text.special_section) == want, title


def test_acronyms_and_profiles(spark):
    assert tuple(one(spark, "IRPF — Imposto de Renda", text.acronym)) == ("IRPF", "Imposto de Renda")
    assert tuple(one(spark, "- PIB: Produto Interno Bruto", text.acronym)) == ("PIB", "Produto Interno Bruto")
    assert one(spark, "A casa fica longe daqui.", text.acronym) is None
    profiles = {"Quais os autores citados?": "bibliographic", "Segundo os autores citados, qual foi o valor?": "quantitative", "Qual modelo foi usado?": "methodological", "Quanto custou em 2019?": "quantitative", "O que é isto?": "general"}
    for q, want in profiles.items():
        assert one(spark, q, text.query_profile) == want, q


def test_odd_words(spark):
    assert one(spark, "abc123def normal xkcdfgh aaaab", text.strange_words) == ["abc123def", "xkcdfgh", "aaaab"]
    assert one(spark, "Ta be l a fim", text.broken_words)[0].startswith("Ta be l a")
    assert one(spark, "I N P C alto", text.spaced_capitals) == "INPC alto"
    assert one(spark, None, text.strange_words) == []


def test_redaction_and_names(spark):
    assert one(spark, "redis://u:p@host:1/0", text.redact_url) == "redis://***@host:1/0"
    assert one(spark, "attachment; filename*=UTF-8''a%20b.pdf", lambda c: text.disposition_filename(c, F.lit("x"))) == "a b.pdf"
    assert one(spark, 'attachment; filename="../../e.pdf"', lambda c: text.disposition_filename(c, F.lit("x"))) == "e.pdf"
    assert one(spark, None, lambda c: text.disposition_filename(c, F.lit("x"))) == "x"


def test_noise_against_a_plain_version(spark):
    import re

    def plain(t):
        if not t:
            return 0.0
        clean = re.compile(r"[^\w\s,.;:!?()\-–—/\[\]{}@#$%&*+=<>°ºª€£¥]")
        n = len(clean.findall(t)) + len(re.findall(r"\w\s\w\s\w\s\w", t)) + sum(map(len, re.findall(r"\|{2,}|_{3,}|\.{4,}", t))) + 2 * len(re.findall(r"(?:\d\s){5,}", t))
        return min(n / len(t) * 0.5 + (1 - sum(c.isalpha() for c in t) / len(t)) * 0.3 + sum(ord(c) > 127 and not c.isalpha() for c in t) / len(t) * 0.2, 1)

    for t in ("", "Texto normal e limpo.", "t e s t e |||| ____ ....", "1 2 3 4 5 6 7", "§§ ■■ ação", "日本語。"):
        got = one(spark, t, lambda c: quality.ocr_noise(c, None))
        assert abs(got - plain(t)) < 1e-9, t


def test_rules(spark):
    def reason(t, kind="paragraph"):
        return one(spark, t, lambda c: quality.first_reason(quality.document_rules(c, F.lit(kind))))

    assert reason("") == "sem_corpo_textual"
    assert reason(None) == "sem_corpo_textual"
    assert reason("http://a.example/abcdefgh http://b.example/abcdefgh") == "apenas_urls"
    assert reason("Título curto da seção") == "apenas_titulo"
    assert reason("| - | - |\n| conteudo longo | x |", "table") == "fragmento_tabela_isolado"
    assert reason("Esta é uma frase completa, com mais de dez palavras e um fim claro.") == "aprovado"
    assert reason("palavra " * 30 + "\nsem fim") == "abaixo_do_minimo_de_caracteres"
    own = [(F.col("c") == "x", "mine")]
    assert one(spark, "x", lambda c: quality.first_reason(own)) == "mine"
    assert one(spark, "curto", lambda c: quality.chunk_reason(c, F.lit("paragraph"), F.lit(1))) == "sem_corpo_textual"
    assert one(spark, "nota de tabela", lambda c: quality.chunk_reason(c, F.lit("table"), F.lit(3))) == "aprovado"


def test_visual(spark):
    def conf(caption, note, data):
        return spark.range(1).select(visual.chart_confidence(F.lit(caption), F.lit(note), F.lit(data)).alias("r")).first().r

    assert conf("Alfabetização por UF", "", "Colômbia 3 | Argentina 4") == 0.0
    assert conf("Alfabetização", "", "") == 0.5
    assert conf("Alfabetização por ano", "", "| ano | alfabetização |") == 0.85
    assert one(spark, "3^{o}", visual.equation_confidence) == 0.25
    assert one(spark, r"y = \frac{a}{b}", visual.equation_confidence) == 0.9
    assert one(spark, "", visual.equation_confidence) == 0.0
    md = "| Ano | Valor |\n| --- | --- |\n| 2019 | 3 |\n| 2020 |  |"
    assert one(spark, md, lambda c: visual.table_rows_text(c, F.lit("Tab"))) == "Tab\nAno: 2019. Valor: 3.\nAno: 2020."
    html = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"
    assert one(spark, html, lambda c: visual.table_quality(c, F.lit("cap"), F.lit("nota"), F.lit("body"), F.lit(""))) == 1.0
    assert one(spark, "```mermaid\ngraph TD; A[Início] --> B[Fim do fluxo]", visual.mermaid_text) == "Diagrama de fluxo relacionando: Início; Fim do fluxo."
    assert spark.range(1).select(visual.image_kind(F.lit("Logotipo X"), F.lit(""), F.lit("p")).alias("r")).first().r == "logo"


def test_ids(spark):
    import uuid

    ns = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
    for v in ("a", "é", ""):
        assert one(spark, v, lambda c: ids.uuid5(ns, c)) == str(uuid.uuid5(ns, v))
    assert ids.config_hash({"a": 1, "b": 2}) == ids.config_hash({"b": 2, "a": 1})
    a = one(spark, "x  y\n", ids.text_hash)
    assert a == one(spark, "x y", ids.text_hash)
    df = spark.createDataFrame([({"a": "1", "b": None}, {"b": "2"})], "m map<string,string>, n map<string,string>")
    r = df.select(ids.drop_nulls(F.col("m")).alias("d"), ids.merge_maps(F.col("m"), F.col("n")).alias("j")).first()
    assert r.d == {"a": "1"} and r.j == {"a": "1", "b": "2"}
    assert one(spark, {"markdown": "x"}, ids.message_problem, "map<string,string>") == "forbidden_key"
    assert one(spark, {"k": "x" * 20000}, ids.message_problem, "map<string,string>") == "too_large"
    assert one(spark, {"k": "x"}, ids.message_problem, "map<string,string>") is None
    assert one(spark, "a/../b", ids.object_key_problem) == "traversal"


def test_config_reports_all_problems():
    import pytest

    with pytest.raises(ValueError) as e:
        ChunkConfig(min_tokens=900, target_tokens=800, max_tokens=700)
    assert "min_tokens" in str(e.value) and "target_tokens" in str(e.value)
    assert ChunkConfig().hash == ChunkConfig().hash != ChunkConfig(min_tokens=81).hash


def test_title_keys_of_all_scripts_equal_brute_force(spark, tmp_path):
    titles = [None, "", "Água – e Terra!", "agua e terra", "Отчёт № 5: Новый район", "Πίνακας της Ελλάδας", "年度報告（第２版）", "データ ガイド", "ｶﾞイド", "ज़िला कार्यक्रम", "น้ำท่วม – ๒๕", "تَقْرِيرٌ سنوي", "تقرير سنوي"]
    spark.createDataFrame([(str(i), t) for i, t in enumerate(titles)], "doc_id string, title string").write.parquet(f"{tmp_path}/documents.parquet")

    def key(t):
        folded = "".join(x for x in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(x))
        return " ".join(re.sub(r"[^\w\s]", " ", folded.lower()).split())

    got = {r.title_key: r.n_docs for r in catalog.queries()["title_keys"](spark, str(tmp_path)).collect()}
    assert got == Counter(map(key, titles)) and got[""] == 2 and got["agua e terra"] == 2
