"""Greedy cuts found by searching running sums of sizes: where a run that begins at an item has to end.

Every rule here is a table of successors, by item the first item that no longer belongs to a run begun there. It is
found for all items at once; the runs are the path through the table from the first item.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

from vellumflow.functions.counting import TokenCounter

#: Fixed value: where sentences end for chunking.
SENTENCE_END = re.compile(r"""(?<=[.!?…])\s+(?=[A-ZÀ-Ú0-9"'(\[])""")
#: Fixed value: where they end in the older strategy.
PLAIN_END = re.compile(r"(?<=[.!?])\s+")
#: Fixed value: a line that parts the header of a pipe table from its rows.
RULE = re.compile(r"^\s*\|?[\s\-:|]+\|?\s*$")


def path(successor: np.ndarray) -> list[int]:
    """First items of the runs."""
    out, at = [], 0
    while at < len(successor):
        out.append(at)
        at = int(successor[at])
    return out


def _upto(sizes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    total = np.cumsum(np.asarray(sizes, dtype=np.int64))
    return np.concatenate([[0], total[:-1]]) if len(total) else total, total


def within(sizes: Sequence[int], limit: int) -> list[int]:
    """Runs as long as they stay within a limit; an item above it is a run of its own."""
    before, total = _upto(sizes)
    over = np.searchsorted(total, before + limit, side="right")
    return path(np.maximum(over, np.arange(len(total)) + 1))


def packed(sizes: Sequence[int], target: int, largest: int) -> list[int]:
    """Runs up to the item that brings them to the target, or up to the one before where that one brings them above the largest size."""
    before, total = _upto(sizes)
    here = np.arange(len(total))
    reach = np.minimum(np.searchsorted(total, before + target, side="left"), len(total) - 1)
    fits = (total[reach] - before <= largest) | (reach == here)
    return path(np.where(fits, reach + 1, reach))


def gathered(sizes: Sequence[int], smallest: int, largest: int, joint: int = 0) -> list[int]:
    """Runs of an item and the small ones behind it, while together they are no larger than the largest size."""
    before, total = _upto([n + joint for n in sizes])
    over = np.searchsorted(total, before + largest + joint, side="right")
    big = np.flatnonzero(np.asarray(sizes) >= smallest)
    here = np.arange(len(total))
    next_big = np.append(big, len(total))[np.searchsorted(big, here, side="right")]
    return path(np.maximum(np.minimum(over, next_big), here + 1))


def spans(firsts: list[int], n: int) -> list[tuple[int, int]]:
    """Each run's first item and the one behind its last, of ``n`` items."""
    return list(zip(firsts, [*firsts[1:], n], strict=False))


def run_numbers(firsts: list[int], n: int) -> np.ndarray:
    """Number of the run that each of ``n`` items is in."""
    begins = np.zeros(n, dtype=np.int64)
    begins[firsts] = 1
    return np.cumsum(begins) - 1


def _sentences(text: str) -> list[str]:
    return [s for s in (x.strip() for x in SENTENCE_END.split(text)) if s]


def tail(text: str, overlap: int, largest: int, counter: TokenCounter) -> str:
    """End of a chunk that the next one begins with: its last paragraph if short enough, else the sentences at its end that the overlap holds, one at least."""
    last = next((p.strip() for p in reversed(text.split("\n\n")) if p.strip()), "")
    if 1 <= counter.count(last) <= min(largest, 2 * overlap):
        return last
    ends = _sentences(last)[-(overlap + 1) :]  # each has a token at least
    if not ends:
        return ""
    total = np.cumsum([counter.count(s) for s in reversed(ends)])
    return " ".join(ends[-max(1, int(np.searchsorted(total, overlap, side="right"))) :])


def cut_text(text: str, target: int, largest: int, overlap: int, largest_overlap: int, counter: TokenCounter) -> list[tuple[str, str, int, int]]:
    """Pieces (text, method, tokens, tokens of overlap) of an oversized block: runs of whole sentences within ``target``, sentences above ``largest`` by tokens.

    With an overlap each piece begins with the end of the one before where both fit.
    """
    ends = _sentences(text)
    sizes = [counter.count(s) for s in ends]
    made: list[tuple[str, str]] = []
    firsts = within(sizes, target)
    for a, b in spans(firsts, len(ends)):
        if b == a + 1 and sizes[a] > largest:
            made += [(p, "token_fallback") for p in counter.pieces(ends[a], largest)]
        else:
            made.append((" ".join(ends[a:b]), "sentence"))
    counts = [counter.count(t) for t, _ in made]
    out = []
    for i, ((t, method), n) in enumerate(zip(made, counts, strict=True)):
        head = tail(made[i - 1][0], overlap, largest_overlap, counter) if i and overlap > 0 else ""
        extra = counter.count(head) if head else 0
        if head and n + extra <= largest:
            t = f"{head}\n\n{t}"
            out.append((t, method, counter.count(t) if counter.joint else n + extra, extra))
        else:
            out.append((t, method, n, 0))
    return out


def cut_table(markdown: str, caption: str | None, limit: int, counter: TokenCounter) -> list[tuple[str, int, int, bool]]:
    """Row groups of a large table under its caption and header (the first line and all rule lines): (text, first row, row after the last, goes on). Without rows there are no pieces."""
    lines = [x for x in markdown.splitlines() if x.strip()]
    is_head = [i == 0 or bool(RULE.match(x)) for i, x in enumerate(lines)]
    top = [caption] * bool(caption) + [x for x, h in zip(lines, is_head, strict=True) if h]
    rows = [x for x, h in zip(lines, is_head, strict=True) if not h]
    firsts = within([counter.count(r) for r in rows], limit - sum(map(counter.count, top)))
    return [("\n".join([*top, *rows[a:b]]), a, b, a > 0) for a, b in spans(firsts, len(rows))]


def cut_list(text: str, limit: int, counter: TokenCounter) -> list[tuple[str, int, int, bool]]:
    """Items of a list in groups within the limit: (text, first item, last item, goes on), items from 1; whole if it fits."""
    items = [x for x in text.split("\n") if x.strip()]
    sizes = [counter.count(x) for x in items]
    if sum(sizes) <= limit:
        return [(text, 1, len(items), False)]
    firsts = within(sizes, limit)
    return [("\n".join(items[a:b]), a + 1, b, a > 0) for a, b in spans(firsts, len(items))]


def cut_characters(text: str, largest: int, overlap: int) -> list[str]:
    """Pieces of the older strategy, as spans of the text with single spaces between sentences.

    A piece holds the sentences that bring it to at most ``largest`` characters (the space before the last one isn't
    counted). The next one begins ``overlap`` characters before its end, or at the first space there if that lies in the
    first half of them.
    """
    parts = PLAIN_END.split(text)
    joined = " ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    out, k = [], 0
    start = len(joined) - len(joined.lstrip()) if len(parts[0]) > largest else 0
    while k < len(parts):
        # the first sentence is in; a further one adds its own length to what is there
        last = k
        while last + 1 < len(parts) and ends[last] - start + len(parts[last + 1]) <= largest:
            last += 1
        end = int(ends[last])
        out.append(joined[start:end].strip())
        begin = max(start, end - overlap) if overlap else end
        space = joined.find(" ", begin, end)
        if begin < space < begin + (end - begin) // 2:
            begin = space
        while begin < end and joined[begin].isspace():
            begin += 1
        start, k = (begin if begin < end else end + 1), last + 1
    return [p for p in out if p]
