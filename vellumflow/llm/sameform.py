"""Problem 8: one consistent form for texts that look the same but differ in their characters.

Method: ignorable characters are deleted and compatibility forms replaced; then every letter with look-alikes becomes
a set of readings in a lattice, and a Viterbi search over each word picks the path that character bigrams of the
whole corpus, a cost for changing the script and a cost for loose readings favour.

There are two kinds of look-alikes. Twins (``LOOKALIKES``) are drawn alike in other alphabets; a twin is read as any
letter of its row, whichever stood there, so texts that differ in twins alone have one lattice and one form. Loose
readings (``LOOSE``) look much alike, one letter often like several others: there the letter found stays in the lattice
beside its readings, and bigrams and scripts decide which one is meant, so different words may be told apart or brought
together. They are open in words that no single alphabet can spell.

The search runs once for each distinct (script of the document, word) of a partition. The script of a document is the
one of most of its letters that have no twin; it also decides ties and words made of twins alone, so a Russian text
stays Russian.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.tokens import slices
from vellumflow.operators.pairs import group_pairs, spread_pairs
from vellumflow.runtime import cut, ship_package

LATIN, CYRILLIC, GREEK, ARMENIAN, CHEROKEE, NO_SCRIPT = range(6)
#: Twins, one row each, as Latin, Cyrillic, Greek, Armenian and Cherokee; a space where an alphabet has none.
LOOKALIKES = [
    "aа ", "cсϲ", "dԁ ", "eе ", "hһ ", "iі ", "jј ", "lӏ ", "oоοօ", "pрρ", "qԛ ", "sѕ ", "vѵν", "wԝ ", "xх ", "yу ",
    "AАΑ Ꭺ", "BВΒ Ᏼ", "CСϹ Ꮯ", "D   Ꭰ", "EЕΕ Ꭼ", "HНΗ Ꮋ", "IІΙ", "JЈ  Ꭻ", "KКΚ Ꮶ", "L   Ꮮ", "MМΜ Ꮇ", "N Ν", "OОΟՕ", "PРΡ Ꮲ", "QԚ ", "SЅ ՏᏚ", "TТΤ Ꭲ",
    "V   Ꮩ", "WԜ  Ꮃ", "XХΧ", "YҮΥ", "Z Ζ Ꮓ",
]
#: Loose look-alikes; a letter may stand in several pairs.
LOOSE = "aɑ gɡ iı lı aα iι kκ kк mм nη nп nո uυ uս vυ yγ yυ tτ tт wω xχ rг gց hհ oσ".split()
#: Letters of these are no ordinary part of any spelling, so a word with one is always searched.
ODD_LETTERS = "ɑɡı"
#: Log score lost where the script changes inside a word, where a word begins in another script than the document's, and for a loose reading.
SWITCH_COST, START_COST, LOOSE_COST = 12.0, 16.0, 8.0
#: Ids of letters in the bigram table: 0 is a word's edge, 1 any character without an id of its own.
_EDGE, _OTHER = 0, 1
#: End of the code points that the tables reach to.
_END = 0x1400


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, int, np.ndarray]:
    """Letter ids by code point (below _END), their number, and the script of each code point."""
    ids, script, n = np.full(_END, _OTHER, dtype=np.int16), np.full(_END, NO_SCRIPT, dtype=np.int8), 2
    for s, ranges in ((LATIN, ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x2B0))), (CYRILLIC, ((0x400, 0x530),)), (GREEK, ((0x370, 0x400),)), (ARMENIAN, ((0x531, 0x588),)), (CHEROKEE, ((0x13A0, 0x13F6),))):
        for a, b in ranges:
            for c in range(a, b):
                if unicodedata.category(chr(c)).startswith("L"):
                    script[c] = s
                    if unicodedata.normalize("NFD", chr(c)) == chr(c):
                        ids[c], n = n, n + 1
    return ids, n, script


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, dict[int, str], re.Pattern]:
    """By code point the replacement of one character (0xFFFFFFFF: deleted); replacements by several; a pattern of those."""
    one = np.arange(0x110000, dtype=np.uint32)
    many: dict[int, str] = {}
    for c in range(0x80, 0x110000):
        if 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xF900 or 0x20000 <= c < 0xE0000 :
            continue
        ch = chr(c)
        kind, parts = unicodedata.category(ch), unicodedata.decomposition(ch).split()
        if kind == "Cf" and not (0x600 <= c <= 0x605 or c in (0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD)):
            one[c] = 0xFFFFFFFF
        elif kind == "Zs":
            one[c] = 0x20
        elif parts and (parts[0] in ("<wide>", "<narrow>") or parts[0] == "<font>" and len(parts) == 2 and kind in ("Lu", "Ll", "Nd")):
            one[c] = ord(unicodedata.normalize("NFKC", ch)) if len(unicodedata.normalize("NFKC", ch)) == 1 else int(parts[1], 16)
        elif kind == "Nl" and parts and parts[0] == "<compat>":
            many[c] = unicodedata.normalize("NFKC", ch)
        elif parts and parts[0] in ("<compat>", "<isolated>", "<initial>", "<medial>", "<final>") and kind[0] == "L":
            letters = "".join(chr(int(p, 16)) for p in parts[1:])
            if 0xFB00 <= c <= 0xFEFF and c < 0xFDF0 or 0xFE70 <= c <= 0xFEFC or c in (0x132, 0x133, 0x587) or 0x1C4 <= c <= 0x1CC or 0x1F1 <= c <= 0x1F3:
                many[c] = unicodedata.normalize("NFKC", letters)
        elif c == 0xB5:
            one[c] = 0x3BC
    # fixed values: invisible characters of other categories
    for a, b in ((0x34F, 0x350), (0x115F, 0x1161), (0x17B4, 0x17B6), (0x180B, 0x1810), (0x3164, 0x3165), (0xFE00, 0xFE10), (0xFFA0, 0xFFA1), (0xE0100, 0xE01F0)):
        one[a:b] = 0xFFFFFFFF
    return one, many, re.compile("[" + "".join(map(chr, many)) + "]")


@lru_cache(maxsize=1)
def _prototypes() -> np.ndarray:
    """By code point below _END the first of its twins."""
    to = np.arange(_END, dtype=np.uint32)
    for row in LOOKALIKES:
        for x in row[1:].replace(" ", ""):
            to[ord(x)] = ord(row[0])
    return to


def plain(text: str, look_alikes: bool = True) -> str:
    """Decomposed text without invisible characters and compatibility forms; twins become their first letter."""
    if text.isascii():
        return text
    one, many, several = _folding()
    text = several.sub(lambda m: many[ord(m[0])], text)
    code = one[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    text = unicodedata.normalize("NFD", code[code != 0xFFFFFFFF].tobytes().decode("utf-32-le", "surrogatepass"))
    if not look_alikes or text.isascii():
        return text
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if code.max() < 0x300 or not ((code >= 0x370) & (code < _END)).any():
        return text
    return np.where(code < _END, _prototypes()[np.minimum(code, _END - 1)], code).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


@lru_cache(maxsize=1)
def _telling() -> np.ndarray:
    """By code point below _END the script of letters without twins."""
    script = _alphabet()[2].copy()
    for row in LOOKALIKES:
        for x in row.replace(" ", ""):
            script[ord(x)] = NO_SCRIPT
    return script


def script_of(text: str) -> int:
    """Script of most letters without twins; the first of those with as many, Latin where there are none."""
    if text.isascii():
        return LATIN
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = np.bincount(_telling()[code[code < _END]], minlength=NO_SCRIPT + 1)
    return int(np.argmax(n[:NO_SCRIPT]))


_MARKS = re.compile("[\u0300-\u036f]")
_WORD = re.compile("(?:[^\\W\\d_]|[\\u0300-\\u036f])+")


def _count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigram counts of a partition, letters as they stand in the texts."""
    ids, n, _ = _alphabet()
    total = np.zeros(n * n, dtype=np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in slices(texts):
            text = "\n".join(plain(t, look_alikes=False) for t in texts[part] if t)
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            code = code[(code < 0x300) | (code > 0x36F)]
            known = np.minimum(code, _END - 1)
            letter = np.where((code < _END) & (ids[known] != _OTHER), ids[known], _EDGE).astype(np.int64)
            letter = np.concatenate([[_EDGE], letter, [_EDGE]])
            total += np.bincount(letter[:-1] * n + letter[1:], minlength=n * n)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, type=pa.int32()), pa.array(total[at])], names=["pair", "n"])


def bigram_scores(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of each letter after each other one, from all texts.

    The table has a fixed number of entries (letters of five alphabets squared), so its rows may come to the driver.
    """
    ship_package(df.sparkSession)
    n = _alphabet()[1]
    rows = df.select(F.col(f"`{text}`").alias("t")).mapInArrow(_count_bigrams, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(n * n)
    counts[rows["pair"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    counts = counts.reshape(n, n) + 0.1
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


@lru_cache(maxsize=1)
def _readings() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point below _END: the twin in each script (0 where none); all readings, their scripts and their costs.

    Only the first letters of rows have several twins, as ``plain`` leaves no other. The readings of a letter are its
    twins and, at a cost, those of the letters it is loosely like.
    """
    script = _alphabet()[2]
    twins = np.zeros((_END, NO_SCRIPT), dtype=np.uint32)
    for c in range(_END):
        if script[c] < NO_SCRIPT:
            twins[c, script[c]] = c
    for row in LOOKALIKES:
        for s, x in enumerate(row):
            twins[ord(row[0]), s] = 0 if x == " " else ord(x)
    found: dict[int, list[tuple[int, int, float]]] = {}
    for c in range(_END):
        if script[c] < NO_SCRIPT:
            found[c] = [(int(x), s, 0.0) for s, x in enumerate(twins[c]) if x] or [(c, int(script[c]), 0.0)]
    first = _prototypes()
    more: dict[int, list[tuple[int, int, float]]] = {}
    for x, y in LOOSE:
        for a, b in ((x, y), (y, x)):
            a, b = int(first[ord(a)]), int(first[ord(b)])
            if not (b != a and chr(b) in ODD_LETTERS):  # nothing is read as an odd letter
                more.setdefault(a, []).extend((letter, s, LOOSE_COST) for letter, s, _ in found[b])
    for c, others in more.items():
        have = {letter for letter, _, _ in found[c]}
        found[c] = found[c] + [o for i, o in enumerate(others) if o[0] not in have and o not in others[:i]]
    k = max(map(len, found.values()))
    letters, scripts, costs = np.zeros((_END, k), dtype=np.uint32), np.zeros((_END, k), dtype=np.int8), np.zeros((_END, k), dtype=np.float32)
    for c, options in found.items():
        for i, (letter, s, cost) in enumerate(options):
            letters[c, i], scripts[c, i], costs[c, i] = letter, s, cost
    return twins, letters, scripts, costs


def _best_paths(code: np.ndarray, letters: np.ndarray, scripts: np.ndarray, costs: np.ndarray | None, script: int, scores: np.ndarray) -> np.ndarray:
    """Viterbi over words of one length: code points, and by word, place and reading its letter (0: none), script and cost.

    Letters of other scripts pass as they are in every state. Without costs states are scripts, which go on over them; with
    costs a change of script beside them costs nothing.
    """
    n, length = code.shape
    ids = _alphabet()[0]
    free = ~letters.any(axis=2)
    letters = np.where(free[..., None], code[..., None], letters)
    legal = letters > 0
    letter = np.where(letters < _END, ids[np.minimum(letters, _END - 1)], _OTHER).astype(np.int64)
    first = START_COST * (scripts[:, 0] != script)
    if costs is not None:
        first = np.where(free[:, :1], 0.0, first) + costs[:, 0]
    score = np.where(legal[:, 0], scores[_EDGE, letter[:, 0]] - first, -np.inf)
    back = np.zeros((n, length, letters.shape[2]), dtype=np.int8)
    for i in range(1, length):
        change = scripts[:, i - 1, :, None] != scripts[:, i, None, :]
        if costs is not None:
            change = change & ~(free[:, i - 1] | free[:, i])[:, None, None]
        step = score[:, :, None] + scores[letter[:, i - 1, :, None], letter[:, i, None, :]] - SWITCH_COST * change
        back[:, i] = step.argmax(axis=1)
        score = np.where(legal[:, i], step.max(axis=1) - (0.0 if costs is None else costs[:, i]), -np.inf)
    score = score + scores[letter[:, -1], _EDGE]
    state, rows = score.argmax(axis=1), np.arange(n)
    chosen = np.empty_like(code)
    for i in range(length - 1, -1, -1):
        chosen[:, i] = letters[rows, i, state]
        state = back[rows, i, state]
    return chosen


def best_forms(words: list[str], script: int, scores: np.ndarray, loose: bool = False) -> list[str]:
    """The best path of each word's lattice. Words are plain() text: letters, and combining marks, which no path changes.

    With ``loose`` words that no single alphabet spells, and those with an odd letter, have loose readings too.
    """
    twins, letters, scripts, costs = _readings()
    by_length: dict[int, list[int]] = {}
    bare = [_MARKS.sub("", w) for w in words]
    for i, w in enumerate(bare):
        by_length.setdefault(len(w), []).append(i)
    odd = [ord(c) for c in ODD_LETTERS]
    out = list(words)
    for length, at in by_length.items():
        if not length:
            continue
        code = np.frombuffer("".join(bare[i] for i in at).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(at), length)
        small = (code < _END)[..., None]
        known = np.minimum(code, _END - 1)
        options = np.where(small, twins[known], 0)
        several = (options > 0).sum(axis=2).max(axis=1) > 1
        wide = np.zeros(len(at), dtype=bool)
        if loose:
            spelt = ((options > 0) | ~(options > 0).any(axis=2)[..., None]).all(axis=1).any(axis=1)
            wide = ~spelt | np.isin(code, odd).any(axis=1)
        chosen = code.copy()
        if (strict := several & ~wide).any():
            used = np.flatnonzero((options[strict] > 0).any(axis=(0, 1)))
            own = np.broadcast_to(used.astype(np.int8), (int(strict.sum()), length, len(used)))
            chosen[strict] = _best_paths(code[strict], options[strict][..., used], own, None, script, scores)
        if wide.any():
            chosen[wide] = _best_paths(code[wide], np.where(small[wide], letters[known[wide]], 0), scripts[known[wide]], costs[known[wide]], script, scores)
        for i, line, same in zip(at, chosen, (chosen == code).all(axis=1), strict=True):
            if same:
                continue
            form = line.tobytes().decode("utf-32-le", "surrogatepass")
            if len(form) == len(words[i]):
                out[i] = form
            else:
                rest_of = iter(form)
                out[i] = "".join(c if "\u0300" <= c <= "\u036f" else next(rest_of) for c in words[i])
    return out


class Former:
    """Forms of texts; keeps the words seen, and of those that a search changed the result."""

    def __init__(self, scores: np.ndarray, loose: bool = False):
        self.scores, self.loose = scores, loose
        self.forget()

    def forget(self) -> None:
        self.seen: list[set[str]] = [set() for _ in range(NO_SCRIPT)]
        self.changed: list[dict[str, str]] = [{} for _ in range(NO_SCRIPT)]

    def forms(self, texts: list[str | None]) -> list[str | None]:
        if sum(map(len, self.seen)) > 600_000:
            self.forget()
        folded = [None if t is None else plain(t) for t in texts]
        script = [LATIN if t is None else script_of(t) for t in folded]
        words = [set() if t is None else set(_WORD.findall(t)) for t in folded]
        for s in set(script):
            own = [w for w, k in zip(words, script, strict=True) if k == s]
            new = list(set().union(*own).difference(self.seen[s])) if own else []
            if new:
                self.seen[s].update(new)
                self.changed[s].update((a, b) for a, b in zip(new, best_forms(new, s, self.scores, self.loose), strict=True) if a != b)
        out: list[str | None] = []
        for t, s, ws in zip(folded, script, words, strict=True):
            changed = self.changed[s]
            if t is not None and changed and not ws.isdisjoint(changed):
                t = _WORD.sub(lambda m, c=changed: c.get(m[0], m[0]), t)
            out.append(t if t is None or t.isascii() else unicodedata.normalize("NFC", t))
        return out


def same_form(df: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "form", scores: np.ndarray | None = None, loose: bool = True) -> DataFrame:
    """The ``keep`` columns of every row and the consistent form of its text.

    A null text has a null form, an empty or blank one stays empty or blank. Repeated rows stay. Letter case,
    digits, accents, superscripts, fractions and line breaks are kept apart. ``scores`` come from
    bigram_scores, by default over ``df`` itself. Without ``loose`` only twins are read as one another. An ``out``
    that is also kept is refused.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    if out in keep:
        raise ValueError(f"column {out} is already there")
    ship_package(df.sparkSession)
    scores = bigram_scores(df, text) if scores is None else scores
    rows = df.select(F.col(f"`{text}`").alias("__t"), *[F.col(f"`{c}`") for c in keep])
    fields = [rows.schema[c] for c in keep]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields] + [pa.field(out, pa.string())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        former = Former(scores, loose)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in slices(texts):
                forms = pa.array(former.forms(texts[part]), type=pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(part.start, part.stop - part.start) for c in batch.columns[1:]), forms], schema=arrow)

    return rows.mapInArrow(go, T.StructType([*fields, T.StructField(out, T.StringType())]))


def form_members(df: DataFrame, id_col: str, text: str = "text", scores: np.ndarray | None = None, loose: bool = True) -> DataFrame:
    """Membership (id, key, raw): the digest of each visible text's form and of the text itself.

    Null and blank texts are in no class, nor are rows with a null id; repeated rows count once. The result is a checkpoint.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(F.col(f"`{text}`"))).alias("raw"), F.col(f"`{text}`").alias("t"))
    scores = bigram_scores(df, text) if scores is None else scores
    formed = same_form(rows.where("id is not null and t is not null"), "t", ["id", "raw"], "form", scores, loose)
    return cut(formed.where(F.col("form").rlike(r"[^\s\p{Z}\p{C}]")).select("id", "raw", F.unhex(F.md5("form")).alias("key")).distinct())


def form_classes(members: DataFrame) -> DataFrame:
    """(id, class_id, n_links): each document's class and the number of other texts, however often stored, that read the same.

    A row for each different (id, text); copies of one text are one text. No pairs are made.
    """
    once = members
    variants = once.select("key", "raw").distinct().groupBy("key").agg((F.count(F.lit(1)) - 1).alias("n_links"))
    return once.join(variants, "key").select("id", F.lower(F.hex("key")).alias("class_id"), "n_links")


def equal_form_pairs(df: DataFrame, id_col: str, text: str = "text", scores: np.ndarray | None = None, loose: bool = True) -> DataFrame:
    """Pairs (a, b), a < b, of ids whose texts differ in characters but have one form with something visible in it.

    Identical texts are no pair; they stand as one variant, so a group of copies meets others once, and copies of it are
    spread over tasks in blocks. Null and blank texts are in no pair, nor are null ids.
    """
    rows = form_members(df, id_col, text, scores, loose)
    variants = rows.select("key", "raw").distinct()
    met = group_pairs(variants, "key", "raw").select(F.struct("key", F.col("a").alias("raw")).alias("a"), F.struct("key", F.col("b").alias("raw")).alias("b"))
    both = spread_pairs(met, rows.select(F.struct("key", "raw").alias("cls"), "id")).where("x <> y")
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
