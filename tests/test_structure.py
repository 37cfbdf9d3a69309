import datetime
import json
import random

from pyspark.sql import functions as F

from vellumflow.functions.text import NUMBERING
from vellumflow.operators import chunking, structure, toc
from vellumflow.operators.running import running
from vellumflow.plans import catalog
from vellumflow.sources import documents as readers

SMALL = chunking.ChunkConfig(target_tokens=10, max_tokens=20, min_tokens=3, overlap_tokens=3, max_overlap_tokens=6, table_max_tokens=15, list_max_tokens=12, force_split_above_tokens=40)
SCHEMA = "document_id string, block_id string, order_index int, block_type string, text string, page_number int, heading_level int, section_path array<string>, section_kind string, chunkable boolean, table_markdown string, caption string"


def blocks(spark, rows, doc="d"):
    made = []
    for i, r in enumerate(rows):
        r = {"block_type": "paragraph", "page_number": 1, "section_path": ["S"], "section_kind": "body", "chunkable": True} | r
        made.append(tuple({"document_id": doc, "block_id": f"block-{i:04d}", "order_index": i, "heading_level": None, "table_markdown": None, "caption": None} | r for _ in (0,))[0])
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(m[n] for n in names) for m in made], SCHEMA)


def chunked(spark, rows, cfg=SMALL, **kw):
    good, bad = chunking.chunks(blocks(spark, rows), cfg=cfg, verdict=lambda t, k, n: F.lit("aprovado"), **kw)
    return [r.asDict() for r in good.orderBy("chunk_index").collect()], bad


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


def test_running_equals_a_plain_scan(spark):
    rng = random.Random(1)
    rows = [(d, i, rng.choice([None, 1, 2, 3])) for d in "ab" for i in rng.sample(range(500), 120)]
    got = running(spark.createDataFrame(rows, "d string, o int, v int"), ["d"], "o", sums={"s": F.col("v")}, lasts={"l": F.col("v")}, maxima={"m": F.col("v")}, bucket=16).collect()
    for d in "ab":
        s, last, top = 0, None, None
        for r in sorted((r for r in got if r.d == d), key=lambda r: r.o):
            if r.v is not None:
                s, last, top = s + r.v, r.v, max(top or 0, r.v)
            assert (r.s, r.l, r.m) == (s, last, top)


def test_sections_equal_a_state_machine(spark):
    rng = random.Random(2)
    titles = ["Prefácio", "1 Introdução", "2.1 Dados", "2.1.3 Fontes", "Referências", "Sumário", "Lista de tabelas", "Apêndice A", "Anexo B - Questionário", "3 Fim", "Solto"]
    rows = []
    for d in range(6):
        for i in range(40):
            if rng.random() < 0.4:
                rows.append((f"d{d}", i, "heading", rng.choice(titles), rng.choice([None, 1, 2])))
            else:
                rows.append((f"d{d}", i, rng.choice(["paragraph", "list"]), "texto", None))
    df = spark.createDataFrame(rows, "document_id string, position int, type string, text string, level int")
    got = {(r.document_id, r.position): r for r in structure.assign_sections(df, bucket=8).collect()}
    import re

    special = {"Referências": "bibliography", "Sumário": "table_of_contents", "Lista de tabelas": "list_of_tables", "Apêndice A": "analytical_appendix", "Anexo B - Questionário": "administrative_appendix"}
    for d in range(6):
        base, current, stack = "front_matter", "front_matter", []
        for doc, i, kind, text, level in sorted(r for r in rows if r[0] == f"d{d}"):
            if kind == "heading":
                m = re.match(NUMBERING, text)
                lev = min(len(m[1].split(".")), 6) if m else level or 1
                if text in special:
                    current = special[text]
                    base = current if "appendix" in current else base
                else:
                    if m and "appendix" not in base:
                        base = "body"
                    current = base
                while stack and stack[-1][0] >= lev:
                    stack.pop()
                stack.append((lev, text))
            r = got[(doc, i)]
            assert r.section_kind == current and r.section_path == [t for _, t in stack], (doc, i)
            if kind != "heading":
                assert r.effective_type == ("reference" if current == "bibliography" else kind)


def test_furniture(spark):
    rows = [("d", p, "header", "Cabeçalho  X", p) for p in range(1, 5)] + [("d", 9, "header", "único", 1), ("d", 10, "page_number", "3", 1), ("d", 11, "footnote", "nota", 1)]
    df = spark.createDataFrame(rows, "document_id string, position int, type string, text string, page int")
    assert [(r.key, r.pages) for r in structure.repeated_furniture(df).collect()] == [("cabeçalho x", 4)]
    assert sorted(r.text for r in structure.drop_furniture(df).collect()) == ["nota", "único"]
    assert [r.text for r in structure.drop_furniture(df, keep_footnotes=False).collect()] == ["único"]
    assert structure.repeated_furniture(df.limit(0)).count() == 0


def test_page_merges(spark):
    rows = [{"text": "o valor foi de", "page_number": 1}, {"text": "10 mil reais por educa-", "page_number": 2}, {"text": "ção básica.", "page_number": 3}, {"text": "Novo começo", "page_number": 4}, {"text": "mesma página", "page_number": 4}]
    df = blocks(spark, rows).withColumn("bbox", F.lit(None).cast("array<double>"))
    got = structure.merge_over_pages(df).orderBy("order_index").collect()
    assert [r.text for r in got] == ["o valor foi de 10 mil reais por educação básica.", "Novo começo", "mesma página"]
    assert got[0].pages == [1, 2, 3] and got[0].merged and not got[1].merged


def test_paragraphs_gather_within_a_section(spark):
    got, _ = chunked(spark, [{"text": words(4)}, {"text": words(5)}])
    assert len(got) == 1 and got[0]["block_ids"] == ["block-0000", "block-0001"]
    got, _ = chunked(spark, [{"text": words(4), "section_path": ["A"]}, {"text": words(4), "section_path": ["B"]}])
    assert len(got) == 2 and all(g["overlap_token_count"] == 0 for g in got)


def test_large_blocks(spark):
    got, _ = chunked(spark, [{"text": " ".join(f"Frase {words(5, 10 * i)}." for i in range(6))}])
    assert len(got) >= 2 and {g["split_method"] for g in got} == {"sentence"}
    got, _ = chunked(spark, [{"text": words(50)}])
    assert {g["split_method"] for g in got} == {"token_fallback"} and all(g["token_count"] <= 40 for g in got)


def test_tables_and_lists(spark):
    table = "| a | b |\n| --- | --- |\n" + "\n".join(f"| {i} | x{i} |" for i in range(20))
    got, _ = chunked(spark, [{"block_type": "table", "text": table, "table_markdown": table}])
    assert len(got) >= 2 and all(g["text"].startswith("| a | b |\n| --- | --- |") for g in got)
    assert [g["is_continuation"] for g in got] == [False] + [True] * (len(got) - 1)
    assert got[0]["first_item"] == 0 and got[-1]["last_item"] == 20
    got, _ = chunked(spark, [{"block_type": "list", "text": "\n".join(f"- item {i}" for i in range(12))}])
    assert len(got) >= 2 and got[1]["is_continuation"] and got[-1]["last_item"] == 12


def test_overlap_and_references(spark):
    cfg = chunking.ChunkConfig(**{**SMALL.__dict__, "max_tokens": 30, "force_split_above_tokens": 40})
    got, _ = chunked(spark, [{"text": words(5)}, {"text": words(6, 50)}, {"text": words(12, 100)}], cfg)
    assert got[1]["overlap_token_count"] > 0 and got[1]["overlap_block_ids"]
    got, _ = chunked(spark, [{"text": words(12), "block_type": "reference"}, {"text": words(12, 50), "block_type": "reference"}])
    assert {g["content_type"] for g in got} == {"references"} and all(g["overlap_token_count"] == 0 for g in got)


def test_context_ids_and_rejections(spark):
    titles = spark.createDataFrame([("d", "Meu título")], "document_id string, title string")
    rows = [{"text": words(8), "section_path": ["1 Um", "1.1 Dois"]}]
    a, _ = chunked(spark, rows, titles=titles)
    b, _ = chunked(spark, rows, titles=titles)
    assert a[0]["contextualized_text"].startswith("Documento: Meu título\n\nSeção: 1 Um > 1.1 Dois\n\n")
    assert [g["chunk_id"] for g in a] == [g["chunk_id"] for g in b] and a[0]["previous_chunk_id"] is None
    _, bad = chunked(spark, [{"text": "| x | " + words(60) + " |", "block_type": "figure_caption"}])
    assert [r.reason for r in bad.collect()] == ["too_large"]
    cfg = chunking.ChunkConfig(**{**SMALL.__dict__, "references_mode": "metadata_only"})
    got, _ = chunked(spark, [{"text": words(5), "section_kind": "table_of_contents"}, {"text": words(6), "section_path": ["B"]}, {"text": words(5), "block_type": "reference"}], cfg)
    assert [g["text"] for g in got] == [words(6)]


def test_empty_and_null_blocks(spark):
    got, bad = chunked(spark, [{"text": None}, {"text": "  "}])
    assert got == [] and bad.count() == 0
    good, bad = chunking.chunks(blocks(spark, [{"text": "x"}]).limit(0), cfg=SMALL)
    assert good.count() == 0 and bad.count() == 0


def test_legacy(spark):
    rows = [("d", 0, "heading", "Seção"), ("d", 1, "paragraph", "Frase longa com muitas palavras aqui. " * 60), ("d", 2, "paragraph", "curto")]
    df = spark.createDataFrame(rows, "document_id string, position int, type string, text string")
    got = chunking.legacy_chunks(df).collect()
    assert len(got) > 1 and {r.section for r in got} == {"Seção"} and all(len(r.text) <= 1200 + 250 + 40 for r in got)


def block_table(spark, path, rows, section_kind="body"):
    """A folder with a table of blocks: (type, text, table_markdown, table_caption) in order."""
    schema = "document_id string, block_id string, order_index int, block_type string, text string, page_number int, heading_level int, section_path array<string>, section_kind string, chunkable boolean, bbox array<double>, metadata struct<table_caption: string, table_markdown: string>, ingested_at timestamp"
    made = [("d", f"b{i}", i, kind, text, 1, None, ["S"], section_kind, True, None, (caption, markdown), datetime.datetime(2024, 1, 1)) for i, (kind, text, markdown, caption) in enumerate(rows)]
    spark.createDataFrame(made, schema).write.parquet(f"{path}/blocks.parquet")
    return str(path)


def test_legacy_takes_every_type(spark, tmp_path):
    kinds = ["list", "quote", "list_item", "footnote", "reference", "formula", "unknown", None]
    text = lambda k: f"Bloco do tipo {k} com palavras bastantes para ficar em pé sozinho num texto."
    sf = block_table(spark, tmp_path, [("HEADING", "Seção", None, None), *((k, text(k), None, None) for k in kinds)])
    got = catalog.queries()["legacy_chunks"](spark, sf).orderBy("position").collect()
    assert [r.text for r in got] == [text(k) for k in kinds] and {(r.section, r.type) for r in got} == {("Seção", "paragraph")}


def test_large_tables_lose_no_lines(spark, tmp_path):
    markdown = "| a | b |\n| --- | --- |\n" + "\n".join(f"| {i} | x{i} |" for i in range(300))
    text = f"Quadro 1 . Cadastro\nUnidade: mil\n{markdown}\nFonte: IBGE"
    bare = words(1100)
    sf = block_table(spark, tmp_path, [("table", text, None, None), ("table", text, "", ""), ("table", bare, "| a | b |\n| --- | --- |", None), ("table", text, markdown, "Quadro 1 . Cadastro")])
    got = catalog.queries()["structural_chunks"](spark, sf).orderBy("chunk_index").collect()
    assert [r.text for r in got[:3]] == [text, text, bare]
    cut = got[3:]
    assert len(cut) > 1 and all(r.text.startswith("Quadro 1 . Cadastro\n| a | b |\n| --- | --- |\n") and r.token_count <= 1024 for r in cut)
    assert "\n".join(line for r in cut for line in r.text.split("\n")[3:]) == "\n".join(markdown.split("\n")[2:])


def test_contents_in_index_and_paragraph_blocks(spark, tmp_path):
    lines = "1 Um .... 3\n2 Dois .... 5\n3 Três .... 8\n4 Quatro .... 9\n5 Cinco .... 12"
    for kind, section in (("index", "body"), ("paragraph", "table_of_contents")):
        sf = block_table(spark, tmp_path / kind, [("heading", "1 Um", None, None), (kind, lines, None, None)], section)
        got = catalog.queries()["contents_entries"](spark, sf).orderBy("entry_no").collect()
        assert [(r.title, r.page) for r in got] == [("1 Um", 3), ("2 Dois", 5), ("3 Três", 8), ("4 Quatro", 9), ("5 Cinco", 12)]
        assert catalog.queries()["toc_report"](spark, sf).count() == 1


def test_page_lists(spark):
    inline = lambda t: [{"type": "text", "content": t}]
    pages = [
        [{"type": "title", "content": {"title_content": inline("1 Um"), "level": 1}}, {"type": "paragraph", "content": {"paragraph_content": [{"type": "text", "content": "Seja "}, {"type": "equation_inline", "content": "x^2"}]}}],
        [{"type": "list", "content": {"list_type": "text_list", "list_items": [{"item_content": inline("a")}, {"item_content": inline("b")}]}}, {"type": "page_number", "content": {"page_number_content": inline("12")}}],
        [{"type": "table", "content": {"html": "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>", "table_caption": inline("Tabela 1"), "table_footnote": inline("IBGE")}}],
    ]
    df = spark.createDataFrame([("d", json.dumps(pages)), ("flat", json.dumps(pages[0])), ("bad", "{"), ("map", "{}"), ("null", None)], "document_id string, json string")
    good, bad = readers.parse_page_lists(df)
    got = {(r.document_id, r.position): r for r in readers.typed_blocks(readers.raw_blocks(good)).collect()}
    assert got[("d", 0)].type == "heading" and got[("d", 1)].text == "Seja $x^2$"
    assert got[("d", 2)].text == "- a\n- b" and got[("d", 2)].item_count == 2 and got[("d", 2)].printed_page_number == 12
    assert got[("d", 4)].text == "Tabela 1\n| A | B |\n| --- | --- |\n| 1 | 2 |\nFonte: IBGE"
    assert ("flat", 1) in got
    assert {(r.document_id, r.reason) for r in bad.collect()} == {("bad", "not JSON"), ("map", "not a list"), ("null", "not JSON")}


def test_markdown_and_plain_text(spark):
    md = "# Um\n\nlinha a\nlinha b\n\n- x\n- y\n\n| a | b |\n| - | - |\n| 1 | 2 |\nfim"
    df = spark.createDataFrame([(1, md), (2, None), (3, "")], "doc_id int, text string")
    got = [(r.type, r.text) for r in readers.markdown_blocks(df).orderBy("position").collect()]
    assert got == [("heading", "Um"), ("paragraph", "linha a linha b"), ("list", "- x\n- y"), ("table", "| a | b |\n| - | - |\n| 1 | 2 |"), ("paragraph", "fim")]
    assert [r.text for r in readers.paragraphs(spark.createDataFrame([(1, "a\n\n b \n \nc")], "doc_id int, text string")).orderBy("position").collect()] == ["a", "b", "c"]
    html = "<nav>menu</nav><h1>T</h1><p>um <b>dois</b></p><ul><li>x</li></ul><table><tr><td>1</td><td>2</td></tr></table><script>no</script><footer>pé</footer>"
    got = [(r.type, r.text) for r in readers.html_blocks(spark.createDataFrame([(1, html), (2, None)], "d int, h string"), "d", "h").orderBy("position").collect()]
    assert got == [("header", "menu"), ("heading", "T"), ("paragraph", "um dois"), ("list_item", "x"), ("table", "| 1 | 2 |"), ("footer", "pé")]


def test_contents(spark):
    lines = ["1 Introdução ........ 5", "2 Métodos de", "pesquisa ..... 9", "3 Dados 12", "4 Resultados . 20", "5 Conclusão", "31"]
    toc_block = spark.createDataFrame([("d", "b0", 0, "list", "\n".join(lines), 1), ("d", "b1", 1, "list", "Tabela 1 – x 3\nTabela 2 – y 4\nTabela 3 – z 5", 1)], "document_id string, block_id string, order_index int, block_type string, text string, page_number int")
    entries = toc.entries(toc_block)
    got = [(r.title, r.page, r.numbering, r.lines) for r in entries.orderBy("entry_no").collect()]
    assert got == [("1 Introdução", 5, "1", 1), ("2 Métodos de pesquisa", 9, "2", 2), ("3 Dados", 12, "3", 1), ("4 Resultados", 20, "4", 1), ("5 Conclusão", 31, "5", 1)]
    heads = ["1 Introdução", "2 Metodos de pesquisa", "EVEX?", "3 Dados", "4 Resultados", "5 Conclusão"]
    rows = []
    for i, h in enumerate(heads):
        rows.append(("d", f"h{i}", 10 * i, "heading", h, 2 if h == "3 Dados" else 1, "body", 5, [0.0, 0.0, 300.0, 1.0]))
        rows.append(("d", f"p{i}", 10 * i + 1, "paragraph", "t", None, "body", 5, None))
    b = spark.createDataFrame(rows, "document_id string, block_id string, order_index int, block_type string, text string, heading_level int, section_kind string, page_number int, bbox array<double>")
    report, findings = toc.validate(b, entries)
    r = report.first()
    assert r.reliable and r.headings_matched == 5 and r.entries == 5
    f = {(x.kind, x.heading): x.blocks_affected for x in findings.collect()}
    assert f == {("likely_false_heading", "EVEX?"): 1, ("level_mismatch", "3 Dados"): None}


def test_an_island_of_very_many_drafts(spark):
    cfg = chunking.ChunkConfig(target_tokens=1, max_tokens=2, min_tokens=1, overlap_tokens=0, max_overlap_tokens=0, table_max_tokens=5, list_max_tokens=5, force_split_above_tokens=9)
    b = blocks(spark, [{"text": words(200_010)}, {"text": "fim aqui", "section_path": ["T"]}])
    good, _ = chunking.chunks(b, cfg=cfg, verdict=lambda t, k, n: F.lit("aprovado"), rejected_texts=False)
    r = good.agg(F.count("*").alias("n"), F.countDistinct("chunk_index").alias("d"), F.max("chunk_index").alias("m"), F.max_by("text", "chunk_index").alias("last"), F.count("previous_chunk_id").alias("p"), F.sum((F.col("text") == F.concat(F.lit("w"), 2 * F.col("chunk_index"), F.lit(" w"), 2 * F.col("chunk_index") + 1)).cast("int")).alias("right")).first()
    assert (r.n, r.d, r.m, r.last, r.p, r.right) == (100_006, 100_006, 100_005, "fim aqui", 100_005, 100_005)


def test_poor_tables_are_rejected_with_their_reason(spark):
    cfg = chunking.ChunkConfig(**{**SMALL.__dict__, "table_mode": "conditional"})
    good, bad = chunked(spark, [{"block_type": "table", "text": "só uma célula", "section_kind": "front"}, {"text": words(8)}], cfg)
    assert [g["text"] for g in good] == [words(8)]
    assert [(r.reason, r.text) for r in bad.collect()] == [("table_low_quality", "só uma célula")]


def test_boundaries_equal_a_plain_walk():
    from vellumflow.operators import _boundaries as B

    rng = random.Random(3)
    for _ in range(500):
        sizes = [rng.choice([0, 1, 2, 3, 5, 8, 13, 30]) for _ in range(rng.randint(0, 14))]
        target = rng.randint(1, 12)
        largest = rng.randint(target, 20)
        runs = {"within": [], "packed": [], "gathered": []}
        for name, out in runs.items():
            for i, n in enumerate(sizes):
                held = sum(sizes[out[-1] : i]) if out else 0
                opens = not out or {"within": held + n > largest, "packed": held >= target or held + n > largest, "gathered": n >= target or held + n > largest}[name]
                if opens:
                    out.append(i)
        assert B.within(sizes, largest) == runs["within"] and B.packed(sizes, target, largest) == runs["packed"] and B.gathered(sizes, target, largest) == runs["gathered"]
    pieces = B.cut_characters("Uma frase. Outra bem maior aqui. Fim.", 20, 8)
    assert pieces == ["Uma frase.", "frase. Outra bem maior aqui.", "aqui. Fim."]


def test_limits_in_subwords(spark):
    from vellumflow.functions.counting import SubwordCounter, WORDS

    counter = SubwordCounter("/opt/tokenizers/byte_bpe_50k.tiktoken")
    rows = [{"text": "这是一个没有空格的段落。" * 12}, {"text": words(9)}, {"block_type": "list", "text": "\n".join(f"- item {i}" for i in range(12))}]
    got, _ = chunked(spark, rows, counter=counter)
    assert len(got) > 6 and all(g["token_count"] == counter.count(g["text"]) for g in got) and {g["tokenizer_name"] for g in got} == {"subwords"}
    assert all(g["token_count"] <= 24 for g in got if g["content_type"] == "paragraph")  # a piece by itself may count a few tokens more
    assert "".join(g["text"] for g in got if g["split_method"] == "token_fallback").count("段落") >= 8
    plain, _ = chunked(spark, rows)
    assert len([g for g in plain if "段落" in g["text"]]) == 1 and plain[0]["tokenizer_name"] == WORDS.name
    for size in (1, 3, 7):
        for t in ("Olá mundo 日本語🇧🇷 fim", "aaa", ""):
            assert "".join("".join(counter.pieces(t, size)).split()) == "".join(t.split())
