"""Problem 2: remains of HTML, Markdown, wiki and LaTeX markup in texts.

Method: a tree-structured graphical model. Everything in a text that could be markup becomes a node; elements,
emphasis, links, formulas, commands and the like hold the nodes inside them as children, and a root stands for the text.
A node is residue (markup that a reader wouldn't see) or content (characters meant as they stand); the root is one of
``ROOTS``, the kind of markup a text is written in, or none. A node's own potential is how much likelier its signs are in
residue (a known name, a partner, spaces around it). How likely a node of its kind is residue at all depends on its
parent alone: on the root's kind of markup, or on the parent node and whether that is residue. So a doubtful mark is
decided by the marks around it. Sum-product messages go from the leaves to the root and back, and give each node's
marginal. All potentials are counted on labelled pages: generated pages, each of one kind of markup or none, of which
every inserted mark and every look-alike that is no markup is known.

Nodes that are residue with more than even odds are converted, in one of two forms. ``plain`` leaves the words alone.
``structured`` keeps headings ("## "), lists ("- ", "1. "), tables (pipes), code (backticks and fences) and formulas ("$",
"$$") of all kinds of markup in one form. In both, nothing inside fences, code and formulas is changed.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.runtime import ship_package

#: Names of HTML elements.
ELEMENTS = frozenset(
    "a abbr acronym address area article aside b base big blockquote body br button caption center cite code col colgroup dd del details div dl dt em embed "
    "figcaption figure font footer form frame h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main map mark math meta nav nobr "
    "noscript object ol option p pre q ref references s samp script section select small source span strike strong style sub summary sup svg table tbody td "
    "textarea tfoot th thead title tr tt u ul var video wbr nowiki gallery poem onlyinclude includeonly noinclude".split()
)
#: LaTeX commands, beside which any command with a braced argument counts as known.
COMMANDS = frozenset(
    "alpha beta gamma delta epsilon varepsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau phi varphi chi psi omega Gamma Delta Theta Lambda "
    "Sigma Phi Psi Omega frac sqrt sum int prod lim leq geq neq approx times cdot ldots cdots dots mid hat bar tilde vec partial infty in notin subset cup cap "
    "forall exists rightarrow leftarrow item hline begin end section subsection subsubsection chapter paragraph textbf textit emph underline cite citep citet "
    "ref eqref label footnote caption includegraphics centering toprule midrule bottomrule left right quad qquad text mathrm mathbf mathcal noindent newline "
    "newpage title author date maketitle par bf it small large par url href vspace hspace".split()
)
_PATTERNS: list[tuple[str, str]] = [
    ("comment", r"<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<!\[CDATA\["),
    ("tag", r"<\s*(?P<slash>/?)\s*(?P<name>[^\W\d_][\w:-]*)(?P<attrs>(?:\s+[^<>]*)?)(?P<empty>/?)>"),
    ("entity", r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"),
    ("fence", r"(?m)^[ \t]*(?:```|~~~)[^\n]*$"),
    ("code", r"(?<!`)`(?!`)[^`\n]+(?:\n[^`\n]+)?`(?!`)"),
    ("image", r"!\[[^\]\n]*\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)?[^()]*\)"),
    ("link", r"(?<!!)\[[^\[\]\n]+\]\((?:https?:|/|#|\.|mailto:|www\.|[\w./-]+\.\w)[^()\s]*[^()\n]*\)"),
    ("reflink", r"(?<![\w\]])\[\^[^\]\s]+\]:?|(?m:^\[[^\]\n]+\]:\s+\S+)|\[[^\[\]\n]+\]\[[^\[\]\n]*\]"),
    ("strong", r"\*\*\*?(?=[^\s*])(?:(?!\n\n|(?<=\s)\*\*(?=\S)).)+?(?<=[^\s*])\*\*\*?|(?<![\w_])__(?=[^\s_])(?:(?!\n\n|(?<=\s)__(?=\S)).)+?(?<=[^\s_])__(?![\w_])"),
    ("em", r"(?<![*\w\\])\*(?=[^\s*()])(?:(?!\n\n)[^*])+?(?<=[^\s*(])\*(?![*\w])|(?<![\w_\\])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![\w_])"),
    ("half", r"(?<!\*)\*\*(?!\*)|(?<![~])~~(?!~)"),
    ("strike", r"~~(?=[^\s~])(?:(?!\n\n|~~).)+?(?<=[^\s~])~~"),
    ("heading", r"(?m)^[ \t]{0,3}#{1,6}[ \t]+(?=\S)"),
    ("setext", r"(?m)(?<=\n)[ \t]{0,3}={3,}[ \t]*$"),
    ("quote", r"(?m)^[ \t]{0,3}>+[ \t]*(?=\S)"),
    ("wikihead", r"(?m)^[ \t]*(?P<eq>={2,6})[ \t]*(?=[^\s=])[^\n]*?(?P=eq)[ \t]*$"),
    ("quotes", r"(?<!['\w])'''(?=[^\s'])(?:(?!\n\n|''').)+?(?<=[^\s'])'''(?!')"),
    ("quotes", r"(?<!['\w])'{2,5}(?=[^\s'])(?:(?!\n\n|'').)+?(?<=[^\s'])'{2,5}(?!')"),
    ("wikilink", r"\[\[[^\[\]]+\]\]"),
    ("extlink", r"(?<!\[)\[(?:https?|ftp)://[^\s\]]+(?:\s[^\]\n]*)?\](?!\()"),
    ("template", r"\{\{(?:[^{}]|\{\{[^{}]*\}\})+\}\}"),
    ("wikitable", r"(?m)^[ \t]*(?:\{\|[^\n]*|\|-+[^|\n]*|\|\}|\|\+[^\n]*|!(?!\[)[^\n]*!![^\n]*)$|(?m:(?<=^\|-\n)\|[^|\n][^\n]*$)"),
    ("magic", r"__(?:TOC|NOTOC|FORCETOC|NOEDITSECTION|INDEX|NOINDEX)__"),
    ("command", r"\\(?P<cmd>[A-Za-z]+)\*?(?P<arg>(?:\[[^\[\]\n]*\])?\{)?"),
    ("escape", r"\\[%&_$#{},;:! ~\\](?![A-Za-z\\])|\\\\"),
    ("display", r"\\\[|\\\]|\\\(|\\\)|\$\$"),
    ("math", r"(?<![\\$\w])\$(?![\s$\d])[^$\n]+?(?<![\s\\$])\$(?![\d$])|(?<![\\$\w])\$\d(?=[^$\n]*[\\^_=])[^$\n]*\$(?!\d)"),
]
_COMPILED = [(k, re.compile(p, re.DOTALL)) for k, p in _PATTERNS]
#: Characters that are marks only where the text around them is written in the same kind of markup; they are looked for in texts
#: with another candidate alone, as by themselves they are never marks.
_COMPANIONS: list[tuple[str, re.Pattern]] = [
    ("group", re.compile(r"(?<![\\\w}\]$^_{])\{[^{}\n]*\}(?!\})")),
    ("tie", re.compile(r"(?<=[\w.)])~(?=[\w(\\$])")),
    ("shortcut", re.compile(r"(?<![\w\]!\[\\])\[(?![\^\s])[^\[\]\n]+\](?![\[(:\]])")),
    ("hash", re.compile(r"(?m)^#{1,6}(?=[^\s#])")),
]
#: JVM-side test that lets through every text in which some pattern could match.
MAYBE = r"[<`*~\\$^]|&[#A-Za-z]|\]\(|\]\[|\[\[|\[(?:http|ftp)|(?m:^\[[^\]\n]+\]:)|\{\{|''|__|(?m:^[ \t]{0,3}(?:#|>|=))|(?m:^[ \t]*==)|(?m:^[ \t]*(?:\{\||\|[-+}]|!))|(?<![\w\\])_\S"
#: Kinds of markup and the kinds of nodes that each has.
GROUPS = {
    "html": ("comment", "tag", "element", "entity"),
    "markdown": ("fence", "code", "image", "link", "reflink", "strong", "em", "half", "strike", "heading", "setext", "quote", "shortcut", "hash"),
    "wiki": ("wikihead", "quotes", "wikilink", "extlink", "template", "wikitable", "magic"),
    "latex": ("command", "escape", "display", "math", "group", "tie"),
}
GROUP_OF = {kind: group for group, kinds in GROUPS.items() for kind in kinds}
#: What a text as a whole may be written in.
ROOTS = ("none", *GROUPS)


@dataclass
class Node:
    """A possible mark: what it is, where it and its inside stand, and the signs its potential depends on."""

    kind: str
    start: int
    end: int
    inner: tuple[int, int] | None
    signs: tuple
    name: str = ""
    children: list[Node] = field(default_factory=list)
    up: tuple[float, ...] = (0.0, 0.0)
    residue: float = 0.0
    args: tuple[tuple[int, int], ...] = ()


_RUN = re.compile(r"[\w.:\\-]+")


class _Paths:
    """Which places of a text lie in a Windows or network path; runs of path characters are found once."""

    def __init__(self, text: str):
        self.text, self.runs = text, None

    def __call__(self, at: int, network: bool) -> bool:
        if self.runs is None:
            self.runs = [m.span() for m in _RUN.finditer(self.text) if "\\" in m[0]]
            self.starts = [a for a, _ in self.runs]
        k = bisect_right(self.starts, at) - 1
        if k < 0 or at >= self.runs[k][1]:
            return False
        a = self.runs[k][0]
        colon = self.text.rfind(":", a, at)
        if colon > a and self.text[colon - 1].isascii() and self.text[colon - 1].isalpha() and (colon == at - 1 or self.text[colon + 1] == "\\"):
            return True
        return network and at > a + 2 and self.text.startswith("\\\\", a) and self.text[a + 2] not in "\\:"


def _signs(kind: str, m: re.Match, text: str, path: _Paths) -> tuple:
    """Signs of a possible mark; few values each, as potentials are counted by them."""
    before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
    if kind == "tag":
        name, attrs = m["name"].lower(), m["attrs"].strip()
        attrs_ok = not attrs or bool(re.fullmatch(r"""(?:[\w:-]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?\s*)+/?""", attrs)) and ("=" in attrs or attrs == "/")
        return name in ELEMENTS, attrs_ok
    if kind == "entity":
        return (html.unescape(m[0]) != m[0],)
    if kind == "command":
        return m["cmd"] in COMMANDS, m["arg"] is not None, path(m.start(), True)
    if kind == "escape":
        return m[0] == "\\\\", path(m.start(), False)
    if kind == "math":
        body = m[0][1:-1]
        return bool(re.search(r"[\\^_={}]", body)), len(body) <= 3, bool(re.search(r"\w{3,} \w{3,} \w{2,}", body))
    if kind in ("em", "strong", "strike", "quotes"):
        body = m[0].strip("*_~'")
        return not body.strip("*_~'- ") or body[0] in " \n", "\n" in body, bool(re.search(r"\d$", before or "")), kind == "quotes" and bool(re.search(r"\d\s*$", text[max(0, m.start() - 3) : m.start()]))
    if kind == "half":
        return before.isspace() and after.isspace(),
    if kind == "quote":
        return before in ("", "\n"),
    if kind in ("group", "shortcut", "hash"):
        return bool(re.fullmatch(r"[\d\s,.;:–-]*", m[0][1:-1])) if kind != "hash" else after.isdigit(),
    return ()


def _braces(text: str) -> dict[int, int]:
    """Place of each opening brace to that of its closing one; escaped braces are none."""
    out, open_ = {}, []
    for m in re.finditer(r"\\.|[{}]", text, re.DOTALL):
        if m[0] == "{":
            open_.append(m.start())
        elif m[0] == "}" and open_:
            out[open_.pop()] = m.start()
    return out


def _arguments(text: str, brace: int, closing: dict[int, int]) -> tuple[tuple[int, int], ...]:
    """Spans of the braced arguments that begin at ``brace``, one behind the other."""
    out = []
    while brace in closing:
        out.append((brace + 1, closing[brace]))
        brace = closing[brace] + 1
    return tuple(out)


def candidates(text: str) -> list[Node]:
    """All possible marks; tags are paired by name into elements."""
    found: list[Node] = []
    spans: dict[str, list[tuple[int, int]]] = {}
    path, closing = _Paths(text), None

    def within(at: int, *kinds: str) -> bool:
        """Whether a place lies in a span of one of the kinds; spans of a kind come in order and don't overlap."""
        for k in kinds:
            own = spans.get(k, [])
            i = bisect_right(own, (at, len(text) + 1)) - 1
            if i >= 0 and own[i][0] <= at < own[i][1]:
                return True
        return False

    for kind, pattern in _COMPILED:
        open_tags: list[Node] = []
        for m in pattern.finditer(text):
            if kind == "half" and within(m.start(), "strong", "strike") or kind in ("em", "quotes") and within(m.start(), "wikitable") or kind == "quotes" and within(m.start(), "bold") and m[0].startswith("'''"):
                continue
            spans.setdefault("bold" if kind == "quotes" and m[0].startswith("'''") else kind, []).append(m.span())
            node = Node(kind, m.start(), m.end(), None, _signs(kind, m, text, path))
            if kind == "command":
                node.name = m["cmd"]
                if m["arg"]:
                    closing = _braces(text) if closing is None else closing
                    node.args = _arguments(text, m.end() - 1, closing)
                    if node.args:
                        node.end = node.args[-1][1] + 1
            if kind == "tag":
                node.name = m["name"].lower()
                if m["slash"]:
                    k = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i].name == node.name), None)
                    if k is not None:
                        first = open_tags[k]
                        del open_tags[k:]
                        found.append(Node("element", first.start, m.end(), (first.end, m.start()), (*first.signs, True), node.name))
                        continue
                elif not m["empty"]:
                    open_tags.append(node)
                    continue
                node.signs = (*node.signs, False)
            found.append(node)
        for node in open_tags:
            node.signs = (*node.signs, False)
            found.append(node)
    if found:
        found += [Node(kind, m.start(), m.end(), None, _signs(kind, m, text, path)) for kind, pattern in _COMPANIONS for m in pattern.finditer(text)]
    found.sort(key=lambda n: (n.start, -n.end))
    return found


def tree(text: str) -> Node:
    """The nodes of a text below one root, by containment."""
    root = Node("root", 0, len(text) + 1, None, ())
    stack = [root]
    for node in candidates(text):
        while not (stack[-1].start <= node.start and node.end <= stack[-1].end):
            stack.pop()
        stack[-1].children.append(node)
        if node.end - node.start > 1:
            stack.append(node)
    return root


@dataclass(frozen=True)
class Potentials:
    """Log odds of residue by (kind, signs), or by the kind where a cell is empty, and couplings with the parent.

    Without ``roots`` the root is content and ``coupling`` holds the log couplings of (parent, child) labels. With them
    (log weights of ROOTS) ``edges`` holds the log odds of residue by (state of the parent, kind of the child); a state is
    one of ROOTS, or the parent's label and kind of markup. ``by_kind`` holds those odds whatever the parent is.
    """

    own: dict[tuple, float]
    by_kind: dict[str, float]
    coupling: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    roots: tuple[float, ...] = ()
    edges: dict[tuple, float] = field(default_factory=dict)

    def of(self, node: Node) -> float:
        return self.own.get((node.kind, node.signs), 0.0 if self.roots else self.by_kind.get(node.kind, 0.0))

    def edge(self, parent: Node, child: Node) -> list[tuple[float, float]]:
        """Log couplings of each state of the parent with the child's labels."""
        if not self.roots:
            return [self.coupling[0]] if parent.kind == "root" else list(self.coupling)
        states = ROOTS if parent.kind == "root" else [(label, GROUP_OF[parent.kind]) for label in (0, 1)]
        odds = [self.edges.get((state, child.kind), self.by_kind.get(child.kind, 0.0)) for state in states]
        return [(-_log_sum(0.0, x), -_log_sum(0.0, -x)) for x in odds]  # log probabilities of content and residue

    def uncoupled(self) -> Potentials:
        """The same without any influence of the parent."""
        return Potentials(self.own, self.by_kind, roots=self.roots)


def _log_sum(*values: float) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def marginals(root: Node, p: Potentials) -> None:
    """Sum-product over the tree: sets ``residue`` of every node but the root, which has states of its own."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children
    parent = {id(c): node for node in order for c in node.children}
    edges = {id(c): p.edge(node, c) for node in order for c in node.children}
    belief: dict[int, list[float]] = {}
    for node in reversed(order):  # messages upward
        own = [0.0] * max(1, len(p.roots)) if node is root else [-p.of(node) / 2, p.of(node) / 2]
        if node is root and p.roots:
            own = list(p.roots)
        b = [x + sum(c.up[s] for c in node.children) for s, x in enumerate(own)]
        belief[id(node)] = b
        if node is not root:
            node.up = tuple(_log_sum(*(x + e for x, e in zip(b, row, strict=True))) for row in edges[id(node)])
    for node in order[1:]:  # messages downward; a parent's belief is whole before its children's
        above, row = belief[id(parent[id(node)])], edges[id(node)]
        rest = [x - u for x, u in zip(above, node.up, strict=True)]
        b = belief[id(node)]
        for s in (0, 1):
            b[s] += _log_sum(*(x + e[s] for x, e in zip(rest, row, strict=True)))
        node.residue = 1 / (1 + math.exp(max(-60.0, min(60.0, b[0] - b[1]))))


def labelled_pages(n: int = 600, seed: int = 7) -> Iterator[tuple[str, list[tuple[int, int, bool]]]]:
    """Generated pages with the spans inserted and whether each is markup. Marks nest now and then, as they do in texts."""
    rng = random.Random(seed)
    letters = "aeiou"

    def word() -> str:
        return "".join(rng.choice("bcdfglmnprstv") + rng.choice(letters) for _ in range(rng.randint(1, 4)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def number() -> str:
        return str(rng.randint(1, 99))

    def math_text() -> str:
        return rng.choice(["x_{%s}^{%s} \\leq \\alpha" % (number(), number()), "a_%s" % rng.randint(1, 9), "\\frac{a}{b} = %s" % number(), "n", "E = mc^2", "x+y=%s" % number()])

    def inline(depth: int, page: str) -> str:
        t = words(1, 3)
        if depth and rng.random() < 0.4:
            t = rng.choice([inline, inline, inline, plain_look])(depth - 1, page) + (" " + t if rng.random() < 0.5 else "")
        tag = rng.choice(["b", "i", "em", "strong", "span", "sup", "sub", "u", "EM", "B", "code", "td", "li", "p", "ref", "small", "font"])
        attrs = rng.choice(["", "", f' class="{word()}"', f' name="{word()}" id={number()}', f" style='font-size:{number()}pt'"])
        entity = rng.choice(["&amp;", "&nbsp;", "&#8211;", "&#xE9;", "&lt;", "&hellip;", "&quot;", "&eacute;", "&#9;"])
        kinds = {
            "html": [f"<{tag}{attrs}>{t}</{tag}>"] * 6 + [f'<a href="http://{word()}.example/{number()}">{t}</a>'] * 2 + [f"</{tag}><{tag}>", f"<{tag}{attrs}>", f"</{tag}>", f"<br{rng.choice(['', '/', ' /'])}>", "<BR>", "<hr/>", f"<{word()}>{t}</{word()}>", f"<{word()} {word()}='{number()}'>{t}"] + [entity] * 4 + [f"<!-- {t} -->", f"<!-- p. {number()} -->"],
            "markdown": [f"**{t}**", f"__{t}__", f"*{t}*", f"_{t}_", f"~~{t}~~", f"`{t}`", f"[{t}](http://{word()}.example/{number()})", f"![{t}](images/{word()}.png)", f"[^{number()}]", f"**{t}", f"{t} ** {t}"],
            "wiki": [f"'''{t}'''", f"''{t}''", f"[[{t}]]", f"[[{word()}|{t}]]", f"{{{{{word()}|{word()}={number()}}}}}", f"[http://{word()}.example {t}]", f"[[Category:{t}]]"],
            "latex": [f"\\textbf{{{t}}}", f"\\emph{{{t}}}", f"\\{rng.choice(['footnote', 'cite', 'ref', 'label', word()])}{{{t}}}", f"${math_text()}$", f"${math_text()}$", f"\\({math_text()}\\)", f"{number()}\\%", "\\\\ \\hline", "\\& ", f"\\{rng.choice(['alpha', 'sigma', 'leq', 'times', 'item', word()])} "],
        }
        return rng.choice(kinds[page if rng.random() < 0.85 else rng.choice(list(kinds))])

    def companion(page: str) -> str:
        t = words(1, 3)
        kinds = {"markdown": [f"[{t}]", f"[{t}]", f"\n#{t}\n"], "latex": [f"{{{t}}}", f"{{{t}}}", f"{{\\bf {t}}}", f"{word()}~{number()}", f"{word()}.~{word()}"]}
        return rng.choice(kinds[page])

    def block(page: str) -> str:
        t = words(2, 6)
        kinds = {
            "html": [f"<h2>{t}</h2>", f"<p>{t}", f"<ul><li>{t}</li></ul>"],
            "markdown": [f"{'#' * rng.randint(1, 6)} {t}", f"{t}\n{'=' * rng.randint(3, 12)}", f"> {t}", f"```{rng.choice(['', 'py'])}\n{word()} = {number()}\n```", f"[^{number()}]: {t}"],
            "wiki": [f"== {t} ==", f"=== {t} ===", f'{{| class="wikitable"\n|-\n| {number()} || {number()}\n|}}'],
            "latex": [f"\\[ {math_text()} \\]", f"$$ {math_text()} $$", f"\\begin{{{word()}}}\n\\item {t}\n\\end{{{word()}}}", f"\\section{{{t}}}"],
        }
        return rng.choice(kinds[page if rng.random() < 0.9 else rng.choice(list(kinds))])

    def plain_look(_: int = 0, page: str = "none") -> str:
        a, b = number(), number()
        return rng.choice(
            [f"{a} < {b} > {number()}", f"(p < 0,0{rng.randint(1, 9)} e n > {b})", f"<{word()} {word()}>", f"<não {word()}>", f"<{word()}@{word()}.example>", f"C:\\{word()}\\{word()}", f"D:\\{rng.choice(['base', 'item', 'text', 'section'])}\\{word()}.txt", f"\\\\{word()}\\{word()}", "P&D", "R&D;", f"AT&T",
             f"({a} * {b} * {number()})", "(*)", f"{a} * {b}", f"{word()}_{word()}_{a}", "____________", "__________", f"R$ {a},00 a R$ {b},00", f"US$ {a} and $ {b}", f"$ {a}.{b}", f"#{a}", "C# ou F#", f"{a}~{b}", f"{{{word()}}}", f"~{a}", f"~{a} to ~{b}", f"{{{a}, {b}}}", f"[{a}]", f"{a}' {b}'' e {b}' {a}''", f"{a}\" x {b}\"",
             f"| {word()} | {a} |", f"- {words(1, 3)}", f"[ OK ] [ X ]", f"{word()} -> {word()}", f"=> {word()}", f"{word()} == {a}", f"({word()})", f"[{word()}]", f"|r| = 0.{a}", f"x^{a}", f"http://{word()}.example/{word()}_{word()}_{a}"]
        )

    for _ in range(n):
        text, spans = "", []
        page = rng.choice(["none", "none", "none", *ROOTS])
        marked = 0.0 if page == "none" else rng.choice([0.3, 0.7])  # pages with few marks and with many
        for _ in range(rng.randint(2, 7)):
            text += words(2, 9) + " "
            if rng.random() < marked * 0.3:
                text = text.rstrip() + "\n"
                piece = block(page)
                spans.append((len(text), len(text) + len(piece), True))
                text += piece + "\n"
                continue
            mark = rng.random() < marked
            if not mark and page != "none" and rng.random() < 0.6:
                continue
            # companions stand beside two other marks at least
            beside = mark and page in ("markdown", "latex") and sum(y for _, _, y in spans) > 1 and rng.random() < 0.4
            piece = companion(page) if beside else inline(2, page) if mark else plain_look(0, page)
            spans.append((len(text), len(text) + len(piece), mark))
            text += piece + " "
        yield text, spans


#: Share of companions that are residue where nothing has been seen of their parent.
COMPANION_SHARE = 0.02


def root_of(marks: list[str]) -> str:
    """What a page is written in: the kind of markup of most of its marks (kinds of nodes), none without any."""
    n = {g: sum(GROUP_OF.get(k) == g for k in marks) for g in GROUPS}
    best = max(n, key=n.get)
    return best if n[best] else "none"


def learn(pages: Iterator[tuple[str, list[tuple[int, int, bool]]]], pull: float = 4.0) -> Potentials:
    """Potentials counted on labelled pages.

    An edge's odds are drawn towards those of the child's kind, those of companions towards COMPANION_SHARE, as if ``pull``
    more children had been seen with them.
    """
    signs: dict[tuple, list[float]] = defaultdict(lambda: [0.5, 0.5])
    kinds: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    edges: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    roots: dict[str, float] = dict.fromkeys(ROOTS, 1.0)
    for text, spans in pages:
        root = tree(text)

        def label(node: Node, text: str = text, spans: list = spans) -> int:
            y = next((int(y) for a, b, y in spans if a <= node.start < b), 0)
            return 0 if y and re.match(r"<(?:não|\w+@)|C:|D:", text[node.start : node.end + 3]) else y  # look-alikes nested in marks

        order, stack = [], list(root.children)
        while stack:
            node = stack.pop()
            order.append((node, label(node)))
            stack += node.children
        page = root_of([n.kind for n, y in order if y])
        roots[page] += 1
        for node, y in order:
            signs[(node.kind, node.signs)][y] += 1
            kinds[node.kind][y] += 1
            for c in node.children:
                edges[((y, GROUP_OF[node.kind]), c.kind)][label(c)] += 1
        for c in root.children:
            edges[(page, c.kind)][label(c)] += 1
    share = {k: (v[1] + 1) / (sum(v) + 2) for k, v in kinds.items()}
    cells = {k: sum(key[0] == k for key in signs) for k in kinds}
    own = {(k, s): math.log(v[1] / (kinds[k][1] + 0.5 * cells[k])) - math.log(v[0] / (kinds[k][0] + 0.5 * cells[k])) for (k, s), v in signs.items()}
    by_kind = {k: math.log(q / (1 - q)) for k, q in share.items()}
    base = {k: COMPANION_SHARE if k in dict(_COMPANIONS) else q for k, q in share.items()}
    odds = {(s, k): math.log((v[1] + pull * base[k]) / (v[0] + pull * (1 - base[k]))) for s in (*ROOTS, *((y, g) for y in (0, 1) for g in GROUPS)) for k in share for v in [edges.get((s, k), (0.0, 0.0))]}
    total = sum(roots.values())
    return Potentials(own, by_kind, roots=tuple(math.log(roots[r] / total) for r in ROOTS), edges=odds)


@lru_cache(maxsize=4)
def trained(pages: int = 1500, seed: int = 7) -> Potentials:
    return learn(labelled_pages(pages, seed))


#: LaTeX commands whose argument is no text a reader sees, headings with their levels, and formula environments.
DROPPED = frozenset("cite citep citet citeauthor citeyear nocite ref eqref pageref autoref label includegraphics vspace hspace begin end usepackage documentclass bibliography bibliographystyle input include pagestyle thispagestyle setcounter".split())
SECTIONS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "title": 1}
FORMULAS = frozenset("equation align gather multline eqnarray displaymath math flalign alignat".split())
#: LaTeX commands with arguments that belong to formulas, and stay as they are.
IN_FORMULAS = frozenset("frac dfrac tfrac sqrt hat bar tilde vec overline mathrm mathbf mathcal mathbb mathit operatorname binom left right sum int prod lim".split())


class _Writer:
    """Writes what is left of a text: its words without residue, in one of two forms."""

    def __init__(self, text: str, structured: bool):
        self.text, self.structured, self.kinds = text, structured, set()

    def inside(self, children: list[Node], a: int, b: int) -> str:
        """The span from a to b with the nodes in it converted. Paired fences and formula marks keep what is between them."""
        parts: list[str] = []
        at, i = a, 0
        while i < len(children):
            c = children[i]
            i += 1
            if c.start < at or c.end > b:
                continue
            last = self.partner(children, i - 1) if c.residue > 0.5 else None
            parts.append(self.text[at : c.start])
            if last is not None and children[last].end <= b:
                self.kinds.add(c.kind)
                parts.append(self.verbatim(c, children[last]))
                at = children[last].end
                i = last + 1
                continue
            self.node(c, parts)
            at = c.end
        parts.append(self.text[at:b])
        return "".join(parts)

    def partner(self, children: list[Node], i: int) -> int | None:
        """The node that closes a fence, a formula or a formula environment, among those of the same parent."""
        c = children[i]
        s = self.text[c.start : c.end].strip()
        if c.kind == "fence":
            closes = lambda n, t: n.kind == "fence" and t.strip(" \t").rstrip("`~") == "" and t.strip().startswith(s[:3])
        elif c.kind == "display" and s in ("$$", "\\[", "\\("):
            want = {"$$": "$$", "\\[": "\\]", "\\(": "\\)"}[s]
            closes = lambda n, t: n.kind == "display" and t == want
        elif c.kind == "command" and c.name == "begin" and c.args and self.text[slice(*c.args[0])].rstrip("*") in FORMULAS:
            closes = lambda n, t: n.kind == "command" and n.name == "end" and n.args and self.text[slice(*n.args[0])] == self.text[slice(*c.args[0])]
        else:
            return None
        return next((k for k in range(i + 1, len(children)) if children[k].residue > 0.5 and closes(children[k], self.text[children[k].start : children[k].end])), None)

    def verbatim(self, first: Node, last: Node) -> str:
        body = self.text[first.end : last.start]
        if first.kind == "fence":
            return self.text[first.start : last.end] if self.structured else body.strip("\n")
        if not self.structured:
            return body
        inline = self.text[first.start : first.end] == "\\("
        return f"${body.strip()}$" if inline else f"$${body}$$"

    def heading(self, level: int, body: str) -> str:
        body = " ".join(body.split())
        return f"{'#' * min(level, 6)} {body}" if self.structured and body else body

    def node(self, node: Node, out: list[str]) -> None:
        text, structured = self.text, self.structured
        if node.residue <= 0.5:
            out.append(self.inside(node.children, node.start, min(node.end, len(text))))
            return
        self.kinds.add(node.kind)
        s, a, b, k = text[node.start : node.end], node.start, node.end, node.kind
        if k == "element":
            self.element(node, out)
        elif k == "tag":
            out.append("\n" if node.name in ("br", "p", "div", "li", "tr", "hr") or re.fullmatch(r"h[1-6]", node.name) else " " if node.name in ("td", "th") else "")
        elif k == "entity":
            out.append(html.unescape(s))
        elif k == "code":
            out.append(s if structured else s[1:-1])
        elif k in ("strong", "em", "strike", "quotes"):
            marks = min(len(s) - len(s.lstrip("*_~'")), len(s) - len(s.rstrip("*_~'")))
            out.append(self.inside(node.children, a + marks, b - marks) if len(s) > 2 * marks else "")
        elif k in ("image", "link"):
            at = a + s.index("[") + 1
            out.append(self.inside(node.children, at, a + s.index("](")))
        elif k == "extlink":
            out.append(s[1:-1].partition(" ")[2] or s[1:-1])
        elif k == "reflink" and s.endswith("]") and "][" in s:
            out.append(s[1 : s.index("][")])
        elif k == "wikilink":
            body = s[2:-2]
            out.append(body.rpartition("|")[2] if not re.match(r"(?i)(?:category|categoria|file|ficheiro|image|imagem|datei|fichier|archivo):", body) else "")
        elif k == "wikihead":
            out.append(self.heading(len(s.strip()) - len(s.strip().lstrip("=")), s.strip(" \t=").strip()))
        elif k == "heading" and structured:
            out.append(s.strip() + " ")
        elif k == "setext":
            if structured:  # the line above is the heading
                done = "".join(out).rstrip("\n")
                head = done.rfind("\n") + 1
                out[:] = [done[:head], self.heading(1, done[head:]), "\n"]
        elif k == "wikitable" and s.lstrip()[0] in "!|" and not re.match(r"\s*\|[-}+]", s):  # cells, in the project's own form
            cells = [c.strip() for c in re.split(r"\|\||!!", s.strip()[1:])]
            out.append("| " + " | ".join(cells) + " |" + ("\n| " + " | ".join(["---"] * len(cells)) + " |" if s.lstrip()[0] == "!" else ""))
        elif k == "wikitable" and s.lstrip().startswith("|+"):
            out.append(s.strip()[2:].strip())
        elif k == "command":
            self.command(node, out)
        elif k == "escape":
            out.append("\n" if s == "\\\\" else s[1:])
        elif k == "math":
            out.append(s if structured else s[1:-1])
        elif k in ("group", "shortcut"):
            out.append(self.inside(node.children, a + 1, b - 1))
        elif k == "tie":
            out.append(" ")
        elif k == "hash" and structured:
            out.append(s + " ")
        # comments, single fences, quotation marks, templates, table and formula marks leave nothing

    def element(self, node: Node, out: list[str]) -> None:
        name, structured = node.name, self.structured
        if name in ("script", "style"):
            return
        if structured and name == "tr":
            cells = [c for c in node.children if c.kind == "element" and c.name in ("td", "th") and c.residue > 0.5]
            if cells:
                self.kinds.add("element")
                out.append("\n| " + " | ".join(" ".join(self.inside(c.children, *c.inner).split()) for c in cells) + " |\n")
                return
        if structured and name == "ol":
            items = [c for c in node.children if c.kind == "element" and c.name == "li" and c.residue > 0.5]
            if items:
                out.append("\n" + "\n".join(f"{i}. {self.inside(c.children, *c.inner).strip()}" for i, c in enumerate(items, start=1)) + "\n")
                return
        body = self.inside(node.children, *node.inner)
        if re.fullmatch(r"h[1-6]", name):
            body = f"\n{self.heading(int(name[1]), body) if structured else body.strip()}\n"
        elif name == "li":
            body = f"\n- {body.strip()}" if not re.match(r"\s*(?:[-•▪]|\d+[.)]|\w\))\s", body) else f"\n{body.strip()}"
        elif name == "pre" and structured:
            body = f"\n```\n{html.unescape(body).strip(chr(10))}\n```\n"
        elif name == "code" and structured and "\n" not in body and body.strip() and "`" not in body:
            body = f"`{body}`"
        elif name == "table" and structured:
            rows = [line for line in body.split("\n") if line.strip()]
            if rows and rows[0].startswith("| "):
                rows.insert(1, "| " + " | ".join(["---"] * (rows[0].count(" | ") + 1)) + " |")
            body = "\n" + "\n".join(rows) + "\n"
        elif name in ("p", "div", "tr", "ul", "ol", "table", "pre", "blockquote"):
            body = f"\n{body}\n"
        elif name in ("td", "th"):
            body = f" {body} "
        out.append(body)

    def command(self, node: Node, out: list[str]) -> None:
        text, name = self.text, node.name
        s = text[node.start : node.end]
        if not node.args:
            known = node.signs[0] and not node.signs[1] and name not in ("item", "hline", "noindent", "newpage", "newline", "centering", "toprule", "midrule", "bottomrule", "maketitle", "par")
            out.append(s if known else "-" + " " * (not text[node.end : node.end + 1].isspace()) if name == "item" else "\n" if name in ("newline", "par") else "")
            return
        if name in IN_FORMULAS:
            out.append(s)
            return
        if name in DROPPED:
            return
        spans = node.args[1:] if name == "href" and len(node.args) > 1 else node.args
        body = " ".join(x for x in (self.inside(node.children, *span) for span in spans) if x)
        if name in SECTIONS:
            body = ("\n" if node.start and text[node.start - 1] != "\n" else "") + self.heading(SECTIONS[name], body) + "\n" * (text[node.end : node.end + 1] != "\n") if self.structured and body else body
        elif name in ("texttt", "verb") and self.structured and body and "`" not in body:
            body = f"`{body}`"
        elif name in ("footnote", "footnotetext") and body and node.start and not text[node.start - 1].isspace():
            body = f" {body}"  # its words don't grow together with those before it
        out.append(body)


def clean(text: str | None, potentials: Potentials | None = None, form: str = "plain") -> tuple[str | None, int, list[str]]:
    """The text without residue in one of the forms plain and structured, the number of marks judged residue, and their kinds. Null stays null."""
    if form not in ("plain", "structured"):
        raise ValueError(f"unknown form {form!r}")
    if not text:
        return text, 0, []
    root = tree(text)
    if not root.children:
        return text, 0, []
    marginals(root, potentials or trained())
    n, stack = 0, list(root.children)
    kinds: set[str] = set()
    while stack:
        node = stack.pop()
        if node.residue > 0.5:
            n += 1
            kinds.add(node.kind)
        stack += node.children
    if not n:
        return text, 0, []
    done = _Writer(text, form == "structured").inside(root.children, 0, len(text))
    done = re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", done))
    if "wikitable" in kinds:
        done = re.sub(r"(?m)^(\|[^\n]*)\n\n+(?=\|)", r"\1\n", done)
    return done.strip("\n") if text.strip("\n") == text else done, n, sorted(kinds)


def maybe_marked(text: Column) -> Column:
    return text.rlike(MAYBE)


def strip_markup(df: DataFrame, text: str = "text", keep: list[str] | None = None, form: str = "plain") -> DataFrame:
    """The ``keep`` columns and clean_text in one of the forms plain and structured, n_marks (int), mark_kinds (array<string>) of every row.

    Null, empty and blank texts stay as they are with no marks; repeated rows stay. Only texts that the JVM
    finds any special character in are parsed; no shuffle. Columns that aren't named don't matter.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    if clash := {"clean_text", "n_marks", "mark_kinds"}.intersection(keep):
        raise ValueError(f"columns {sorted(clash)} are already there")
    ship_package(df.sparkSession)
    rows = df.select(F.col(f"`{text}`").alias("__t"), maybe_marked(F.col(f"`{text}`")).alias("__m"), *[F.col(f"`{c}`") for c in keep])
    fields = [rows.schema[c] for c in keep]
    from pyspark.sql.pandas.types import to_arrow_type

    added = [T.StructField("clean_text", T.StringType()), T.StructField("n_marks", T.IntegerType()), T.StructField("mark_kinds", T.ArrayType(T.StringType()))]
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in [*fields, *added]])

    potentials = trained()  # a few hundred numbers, counted once on the driver

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maybe = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            done = [clean(t, potentials, form) if m else (t, 0, []) for t, m in zip(texts, maybe, strict=True)]
            new = [pa.array([d[0] for d in done], type=pa.string()), pa.array([d[1] for d in done], type=pa.int32()), pa.array([d[2] for d in done], type=pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *new], schema=arrow)

    return rows.mapInArrow(go, T.StructType([*fields, *added]))
