"""Problem 5: sentence boundaries across languages and scripts.

Method: segmentation rules as ordered tables of break and no-break pairs. A rule has an expression for what
stands before a position and one for what follows; a language has a cascade of tables (first its own, then
those all languages share), and the first rule that matches a position decides it. Positions are those behind
a mark that may end a sentence, its closing quotes and brackets, and, in Thai, spaces and line breaks. Quoted
and bracketed spans are found first: no position inside one is a boundary, so a quotation belongs to the
sentence around it, or is a sentence where it stands alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.tokens import slices
from vellumflow.runtime import ship_package

#: Marks that may end a sentence, and closing marks that may follow them.
STOPS = ".!?…。！？｡．।॥؟۔" "།༎။៕។։።፧፨᙮᠃᠉᱾᱿꓿꘎꛳꛷﹒﹖﹗︒︕︖‼⁇⁈⁉⸮"
CLOSERS = "\"'”’»」』】）)\\]›｣"
SPACE = " \\t\\r\\n"
_LETTER = "\\p{L}\\p{M}"


def closers(lang: str) -> str:
    """Closing marks; the mark that opens quotations elsewhere closes them in German."""
    return CLOSERS + "“" if lang == "de" else CLOSERS



#: Abbreviations that a sentence goes on after, whatever follows, by language. A point after each is meant.
NEVER_LAST = {
    "en": "Mr Mrs Ms Dr Prof St Sec Fig Figs Eq No Nos no nos Vol vol pp ch Ch cf vs approx ca Rev Gen Sen Gov e\\.g i\\.e viz resp ed eds Ed Eds Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec",
    "pt": "Sr Sra Srs Sras Dr Dra Drs Dras Prof Profa Profs Exmo Exma Av R Pça Al Rod Tel tel art Art arts inc cf Cf vol Vol n nº n\\.º núm pp p pág págs fl fls cap caps fig Fig figs ex p\\.ex p\\. ex i\\.e i\\. e séc Ed ed Eds Rev v aprox ver min máx",
    "es": "Sr Sra Srta Sres Dr Dra Prof Profa Ing Lic Av Avda C art Art arts cf Cf vol Vol n núm Núm pág págs pp p cap fig Fig figs p\\. ej i\\. e vid Ed ed Rev aprox tel Tel",
    "fr": "M MM Dr Drs Pr Prof Me Mgr St Ste av bd art Art cf Cf vol Vol n no nos p pp chap fig Fig p\\. ex c\\.-à-d c-à-d i\\.e éd Ed Rev env tél Tél",
    "de": "Hr Fr Hrn Dr Prof Dipl Ing Bd Bde Nr S Abb Abs Art Kap vgl Vgl bzw ca d\\. h d\\.h z\\. B z\\.B u\\. a i\\. d\\. R i\\.d\\.R sog evtl ggf inkl Tab Ed Aufl Hrsg Mio Mrd St Str max min",
    "ru": "г-н г-жа д-р д-ра проф акад доц им ул пр пл рис Рис табл Табл см См ср Ср т с стр гл ст п вып № напр т\\. е т\\.е т\\. к т\\. н млн млрд тыс",
    "el": "κ κα κκ Δρ δρ Καθ καθ π\\.χ δηλ βλ Βλ πρβλ αρ σελ σ εικ Εικ πίν τόμ τ άρθρ λ\\.χ Αγ",
    "hi": "डॉ डा श्री प्रो सं पृ कु क्र",
    "ar": "د أ م ص ج ط ه ت أ\\.د",
    "th": "",
    "zh": "",
    "ja": "",
    "it": "Sig sig Sigg sigg Dott dott Dr Prof Ing Avv On Art art artt cap cfr Cfr fig Fig p pp pag pagg vol Vol n nn ecc sec es ca ed Ed P\\.es p\\. es",
    "nl": "Dhr Mevr Dr Prof Ir Ing Drs Mr nr Nr blz p pp fig Fig art Art enz bijv ca d\\.w\\.z o\\.a m\\.b\\.t vgl Vgl red",
    "pl": "dr Dr prof Prof mgr inż ul al nr Nr str s por Por np tzw tj m\\.in r ok godz tab Tab rys Rys art Art św im",
    "ro": "dl dna d-na d-l Dl Dna dr Dr prof Prof ing str Str bd nr Nr art Art alin lit pag p pp fig Fig vol cap ex etc cca lb cf",
    "tr": "Dr Prof Doç Yrd Sn Av Bkz bkz vb vd çev Cad Sok No s ss Cilt Şek Tab",
    "sv": "dr Dr prof Prof kap s sid fig Fig tab Tab t\\. ex bl\\. a d\\. v\\. s jfr Jfr ca nr Nr",
    "cs": "p pí Dr Prof Ing Mgr ul č str s obr Obr tab Tab např tj tzv resp srov kap",
    "hy": "",
    "my": "",
    "km": "",
    "am": "",
}
#: Names of months that a day and its point may stand before.
MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jan|Feb|Mär|Apr|Jun|Jul|Aug|Sep|Okt|Nov|Dez"
#: Verbs of saying that follow a quotation within the same Chinese sentence.
SAYING = "说|說|问|問|道|表示|指出|认为|写道|称|回答|补充"

#: Spellings of languages that the two-letter start of a tag doesn't show.
_NAMES = {"por": "pt", "português": "pt", "portugues": "pt", "eng": "en", "english": "en", "spa": "es", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "rus": "ru", "ell": "el", "zho": "zh", "jpn": "ja", "tha": "th", "hin": "hi", "ara": "ar"}
#: Words by which languages in Latin letters are told apart where no tag helps.
_HINTS = {
    "pt": "o a os as do da dos das em no na com não por um uma ao à e",
    "es": "el la los las del en con no por un una al y que se",
    "en": "the of and in to for on with by is at from as",
    "fr": "le la les des du en et avec par un une sur au dans",
    "de": "der die das des dem den im und mit für auf ist je zur zum",
}
#: The same for languages that only a tag brings in, so that untagged texts are told from the ones above.
_TAGGED_HINTS = {
    "it": "il la di che e in un una per con del della dei è non sono al",
    "nl": "de het een en van in is op te dat die voor met zijn niet",
    "pl": "w i na z do się nie że jest to od po za o",
    "ro": "de la și în cu pe nu este din pentru o un a al ale",
    "tr": "ve bir bu için ile da de olarak çok en olan",
    "sv": "och i att det som en på är av för med till den inte",
    "cs": "a v na se že je s z do o to pro ve by",
}

Rule = tuple[bool, str, str]


def _alternatives(words: str) -> str:
    """Expression of a list of abbreviations; an item may hold an escaped point and, after it, a space."""
    items, rest = [], words.split(" ")
    for w in rest:
        if items and items[-1].endswith("\\."):
            items[-1] += f"[{SPACE}]?" + w
        else:
            items.append(w)
    return "|".join(sorted((i for i in items if i), key=len, reverse=True))


def own_rules(lang: str) -> list[Rule]:
    """The table of one language: (break, before, after), most special first."""
    rules: list[Rule] = []
    words = _alternatives(NEVER_LAST.get(lang, ""))
    if lang == "de":
        rules.append((False, f"(?<![\\p{{N}}.,])\\p{{N}}{{1,2}}\\.[{SPACE}]+", f"(?:{MONTHS})\\b"))
        rules.append((False, f"\\b[IVX]+\\.[{SPACE}]+", "\\p{Ll}"))
    if lang == "ru":
        rules.append((True, f"(?<![{_LETTER}])т\\.[{SPACE}]?[дп]\\.[{SPACE}]+", "[«„“(]?\\p{Lu}"))
        rules.append((True, f"\\p{{N}}[{SPACE}]+г\\.[{SPACE}]+", "[«„“(]?\\p{Lu}"))
    if words:
        rules.append((False, f"(?<![{_LETTER}\\p{{N}}])(?:{words})\\.[{SPACE}]*", "."))
    if lang == "el":
        rules.append((True, f"(?<=[\\p{{Greek}}\\p{{N}}%)])[;;][{CLOSERS}]*[{SPACE}]+", "[^,;]"))
    return rules


def shared_rules(lang: str) -> list[Rule]:
    """The tables that every language goes on to."""
    stop, close, gap = f"[{STOPS}]+", f"[{closers(lang)}]*", f"[{SPACE}]"
    opening = "[\"“„«‚‘'(\\[¿¡•▪「『（]"
    return [
        # what follows says that the sentence goes on
        (False, f"{stop}{close}{gap}*", "[,;:%)\\]»”’،；，、：]"),
        (False, f"{stop}{close}{gap}*", f"(?:–|—|-){gap}*\\p{{Ll}}"),
        (False, f"[」』”»]", "(?:と|って|という)"),
        (False, "[”」』]", f"[^{STOPS}，；\\n]{{0,14}}(?:{SAYING})"),
        (False, "…+", "[\\p{Han}\\p{Hiragana}\\p{Katakana}]"),
        # a point in a number, name, address or after an initial
        (False, "\\p{N}\\.", "\\p{N}"),
        (True, f"\\b(?:S\\.A|S\\.L|S\\.A\\.S|Ltda|Ltd|Inc|Co|Cia|GmbH|etc|usw|p\\.{gap}?m|a\\.{gap}?m)\\.{close}{gap}+", f"{opening}*\\p{{Lu}}"),
        (False, f"(?:^|\\n){gap}*(?:\\p{{N}}{{1,3}}(?:\\.\\p{{N}}{{1,3}})*|[a-zA-Z])\\.{gap}+", "."),
        (False, f"(?<![{_LETTER}\\p{{N}}.])\\p{{Lu}}\\.(?:{gap}*\\p{{Lu}}\\.)*{gap}*", "\\p{Lu}[\\p{Ll}\\p{M}'’.]"),
        (False, f"(?<![{_LETTER}\\p{{N}}])\\p{{Lu}}\\.", "\\p{Lu}\\."),
        (False, f"(?<![{_LETTER}\\p{{N}}])\\p{{Ll}}\\.{gap}*", "[\\p{L}\\p{N}]"),
        (False, f"\\bet al\\.{gap}+", "[\\p{Ll}(\\p{N}]"),
        # scripts whose marks need no space
        (True, f"[。！？｡．]+{close}{gap}*", "."),
        (True, f"(?:\\?|!)+{close}{gap}*", "[\\p{Han}\\p{Hiragana}\\p{Katakana}]"),
        (True, f"[।॥؟۔།༎။៕។։።፧፨᙮᠃᠉᱾᱿꓿꘎꛳꛷﹒﹖﹗︒︕︖]+{close}{gap}*", "."),
        # letters without case
        (True, f"[.!?…]+{close}{gap}+", "[\\p{Arabic}\\p{Devanagari}\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Thai}\\p{Hangul}\\p{Hebrew}]"),
        # a small letter goes on, unless the text has no capitals
        (False, f"{stop}{close}{gap}*", "\\p{Ll}"),
        (True, f"(?<=[\\p{{Ll}}\\p{{N}}%°²³)\\]ªº]|\\p{{Lu}}{{3}}|\\p{{Ll}}[.]){stop}{close}", f"{opening}?\\p{{Lu}}(?:[\\p{{Ll}}\\p{{M}}]|[ {SPACE}])"),
        (True, f"{stop}{close}{gap}+", f"(?:{opening}{gap}*)*[\\p{{L}}\\p{{N}}$#*_`<|\\\\–—-]"),
        (True, f"{stop}{close}{gap}+", opening),
        (True, f"{stop}{close}{gap}*\\n{gap}*", "."),
    ]


#: In texts without capitals this takes the place of the rule on small letters.
UNCASED: Rule = (True, f"[{STOPS}]+[{CLOSERS}]*[{SPACE}]+", "\\p{Ll}")


@lru_cache(maxsize=64)
def cascade(lang: str, cased: bool):
    """The rules of a language as one expression: group i matches where rule i does; and which rules break."""
    import regex

    rules = own_rules(lang) + shared_rules(lang)
    if not cased:
        rules = own_rules(lang) + [UNCASED if not b and a == "\\p{Ll}" and "{0,14}" not in a else (b, x, a) for b, x, a in shared_rules(lang)]
    # the group of a rule is empty and stands at the position itself
    return regex.compile("|".join(f"(?<={before})(?={after})()" for _, before, after in rules), regex.DOTALL), [b for b, _, _ in rules]


@lru_cache(maxsize=1)
def _expressions():
    import regex

    # of any length; each stops at the next mark of its kind, so looking for them takes one pass
    spans = [
        regex.compile("„[^„“”]+[“”]"),
        regex.compile("“[^“”]+”"),
        regex.compile("«[^«»]+»"),
        regex.compile("「[^「」]+」"),
        regex.compile("『[^『』]+』"),
        regex.compile(f"(?<![{_LETTER}\\p{{N}}])\"[^\"]+\"(?![{_LETTER}\\p{{N}}])"),
        regex.compile("\\([^()]+\\)"),
        regex.compile("\\[[^\\[\\]]+\\]"),
        regex.compile("（[^（）]+）"),
    ]
    candidates = {de: regex.compile(f"[{STOPS};;]+[{closers('de' if de else '')}]*[{SPACE}]*(?=[^{SPACE}])") for de in (False, True)}
    thai = regex.compile(f"(?<=[\\p{{Thai}}”\"’)».!?])[{SPACE}]+(?=[\\p{{Thai}}“\"‘(«])")
    return spans, candidates, thai


def language(tag: str | None, text: str) -> str:
    """The language whose table is used: that of the text's script, else of its tag, else of its small words."""
    n = {s: 0 for s in ("el", "ru", "th", "hi", "ar", "ja", "zh")}
    if not text.isascii():
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for s, a, b in (("el", 0x370, 0x400), ("ru", 0x400, 0x530), ("th", 0xE00, 0xE80), ("hi", 0x900, 0x980), ("ar", 0x600, 0x700), ("ja", 0x3040, 0x3100), ("zh", 0x4E00, 0xA000)):
            n[s] = int(((code >= a) & (code < b)).sum())
        best = max(n, key=n.get)
        if n[best] * 3 > len(text):
            return "ja" if best == "zh" and n["ja"] * 10 > n["zh"] else best
    words = text.lower().split()
    score = {s: 0 for s in _HINTS}
    for s, hints in _hint_sets().items():
        score[s] = sum(w in hints for w in words)
    best = max(score, key=score.get)
    t = (tag or "").strip().lower()
    t = _NAMES.get(t, t[:2])
    if t in _TAGGED_HINTS and 2 * sum(w in _tagged_sets()[t] for w in words) >= max(1, score[best]):
        return t
    if t in score and score[t] * 2 >= score[best]:
        return t
    return best if score[best] else (t if t in NEVER_LAST else "pt")


@lru_cache(maxsize=1)
def _hint_sets() -> dict[str, frozenset[str]]:
    return {s: frozenset(w.split()) for s, w in _HINTS.items()}


@lru_cache(maxsize=1)
def _tagged_sets() -> dict[str, frozenset[str]]:
    return {s: frozenset(w.split()) for s, w in _TAGGED_HINTS.items()}


def sentences(text: str | None, tag: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence, outer separators not included. Null, empty and blank texts have none."""
    if not text:
        return []
    spans, candidates, thai = _expressions()
    lang = language(tag, text)
    rules, breaks = cascade(lang, any(c.isupper() for c in text))
    shut: list[tuple[int, int]] = []
    for s in spans:
        shut += [m.span() for m in s.finditer(text)]
    ends: list[int] = []
    for m in candidates[lang == "de"].finditer(text):
        at = m.end()
        if lang != "el" and not m[0].strip(";; \t\r\n"):
            continue
        got = rules.match(text, at)
        if got and breaks[got.lastindex - 1]:
            ends.append(at)
    for m in thai.finditer(text):
        ends.append(m.end())
    if shut:
        depth = np.zeros(len(text) + 2, dtype=np.int32)
        a, b = np.array(shut).T
        np.add.at(depth, a + 1, 1)
        np.add.at(depth, b, -1)
        inside = np.cumsum(depth) > 0
        ends = [e for e in ends if not inside[e]]
    out, start = [], 0
    for e in sorted({*ends, len(text)}):
        a, b = start, e
        while a < b and text[a] in " \t\r\n":
            a += 1
        while b > a and text[b - 1] in " \t\r\n":
            b -= 1
        if a < b:
            out.append((a, b))
        start = e
    return out


def split_sentences(df: DataFrame, keys: list[str], text: str = "text", lang: str | None = None) -> DataFrame:
    """(keys, sentence_index, start_pos, end_pos) of every sentence of every row; positions in code points, from 0.

    Null, empty and blank texts give no rows; repeated rows give theirs again. Only the named columns are
    read. Rows stay in their partition: no shuffle.
    """
    ship_package(df.sparkSession)
    tag = F.col(f"`{lang}`") if lang else F.lit(None).cast("string")
    rows = df.select(F.col(f"`{text}`").alias("__t"), tag.alias("__l"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)])
    fields = [rows.schema[f"k{i}"] for i in range(len(keys))]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([*fields, *(T.StructField(c, T.IntegerType()) for c in ("sentence_index", "start_pos", "end_pos"))])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in slices(texts):
                found = [sentences(t, g) for t, g in zip(texts[part], tags[part], strict=True)]
                n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                row = pa.array(np.repeat(np.arange(part.start, part.stop), n))
                index = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                flat = np.array([p for ps in found for p in ps], dtype=np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([*(c.take(row) for c in batch.columns[2:]), pa.array(index.astype(np.int32)), pa.array(flat[:, 0]), pa.array(flat[:, 1])], schema=arrow)

    return rows.mapInArrow(go, schema).toDF(*keys, "sentence_index", "start_pos", "end_pos")
