"""Problem 7: filling containers of fixed capacity with whole texts.

Method: swap-based local search. Texts are spread over packing groups by a hash of their ids; each group is
packed by itself, so nothing grows with the corpus but the number of groups. Within a group, best-fit
decreasing gives a first packing. Then the underfull containers are improved: an item moves, or one item is
exchanged for one of another container, or two for one, wherever that raises the sum of squared fills. Items
so gather in full containers, and containers that run empty are dropped, until a round changes nothing.

An item above the capacity is cut into pieces of exactly one capacity, which fill containers of their own, and
a rest, which is packed like any item. Nothing else is split.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.operators.pairs import BROADCAST_BYTES, sized
from vellumflow.runtime import cut

#: Items of a packing group: enough that the one container a group leaves open is under a thousandth of its room.
GROUP_ITEMS = 16_384
#: Rounds of the local search. It ends by itself when a round changes nothing; this bounds its time.
MAX_ROUNDS = 60
#: Exchange partners looked at for one place before the next is tried (only those of the same container are passed over), and the
#: items of a container offered for one or two others, the largest ones, and in pairs for one other, the smallest ones. They bound a
#: round's time, not what is packed: every item is in a container whatever the search finds.
PARTNERS, SINGLES, DOUBLES = 24, 12, 6
#: Shares of the room to be filled that the first of two items taken for one has at most.
FIRST_SHARES = (0.5, 0.7, 0.85)
#: Kinds of containers asked for at once; more are refused.
MAX_SPECS = 1000

PACKED = "spec_id int, group_id int, bin int, id long, piece_index int, n_pieces int, start_token long, end_token long, n_tokens long"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: containers as lists of item numbers. Sizes are 1 to the capacity."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free room, container), sorted
    for i in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        s = int(sizes[i])
        at = bisect_left(room, (s, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if free > s:
            insort(room, (free - s, b))
    return bins


class _Open:
    """Underfull containers and their items by size, for finding exchange partners."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins = {b: set(items) for b, items in enumerate(bins)}
        self.fill = {b: int(sizes[list(items)].sum()) for b, items in self.bins.items()}
        self.of = {i: b for b, items in self.bins.items() for i in items}
        self.by_size: list[tuple[int, int]] = sorted((int(sizes[i]), i) for b, items in self.bins.items() if self.fill[b] < capacity for i in items)

    def free(self, b: int) -> int:
        return self.capacity - self.fill[b]

    def _drop(self, b: int) -> None:
        for i in self.bins[b]:
            at = bisect_left(self.by_size, (int(self.sizes[i]), i))
            if at < len(self.by_size) and self.by_size[at] == (int(self.sizes[i]), i):
                self.by_size.pop(at)

    def move(self, leave: list[tuple[int, int]]) -> None:
        """Each (item, container) goes there; containers that become full leave the search."""
        touched = {b for _, b in leave} | {self.of[i] for i, _ in leave}
        for i, b in leave:
            a = self.of[i]
            self.bins[a].discard(i)
            self.fill[a] -= int(self.sizes[i])
            self.bins[b].add(i)
            self.fill[b] += int(self.sizes[i])
            self.of[i] = b
        for b in touched:
            if self.fill[b] == self.capacity:
                self._drop(b)

    def largest(self, most: int, least: int, skip: int) -> int | None:
        """The largest item of an underfull container other than ``skip`` with a size of at least ``least`` and at most ``most``."""
        at = bisect_left(self.by_size, (most + 1, -1)) - 1
        tries = 0
        while at >= 0 and self.by_size[at][0] >= least and tries < PARTNERS:
            if self.of[self.by_size[at][1]] != skip:
                return self.by_size[at][1]
            at, tries = at - 1, tries + 1
        return None


def improve(sizes: np.ndarray, bins: list[list[int]], capacity: int, max_rounds: int = MAX_ROUNDS) -> list[list[int]]:
    """Local search over the underfull containers; never uses more containers than it was given."""
    o = _Open(sizes, bins, capacity)
    for _ in range(max_rounds):
        changed = 0
        # the fullest first: what fits best there comes from emptier ones
        for b in sorted((b for b in o.bins if 0 < o.fill[b] < capacity), key=lambda b: -o.fill[b]):
            while 0 < o.fill[b] < capacity:
                free, fill = o.free(b), o.fill[b]
                best: tuple[int, list[tuple[int, int]]] | None = None

                def offer(moves: list[tuple[int, int]], b: int = b, fill: int = fill) -> None:
                    nonlocal best
                    delta: dict[int, int] = {}
                    for i, to in moves:
                        delta[o.of[i]] = delta.get(o.of[i], 0) - int(sizes[i])
                        delta[to] = delta.get(to, 0) + int(sizes[i])
                    if any(not 0 <= o.fill[k] + d <= capacity for k, d in delta.items()):
                        return
                    gain = sum((o.fill[k] + d) ** 2 - o.fill[k] ** 2 for k, d in delta.items())
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, moves)

                j = o.largest(free, 1, b)
                if j is not None:  # move
                    offer([(j, b)])
                for i in sorted(o.bins[b], key=lambda i: -sizes[i])[:SINGLES]:
                    s = int(sizes[i])
                    j = o.largest(s + free, s + 1, b)
                    if j is not None:  # one for one
                        offer([(i, o.of[j]), (j, b)])
                        rest = s + free - int(sizes[j])
                    # two for one: two items of other containers for this one
                    for part in FIRST_SHARES:
                        first = o.largest(int((s + free) * part), 1, b)
                        if first is None:
                            continue
                        second = o.largest(s + free - int(sizes[first]), max(1, s + 1 - int(sizes[first])), b)
                        if second is not None and second != first:
                            offer([(i, o.of[first]), (first, b), (second, b)])
                items = sorted(o.bins[b], key=lambda i: sizes[i])[:DOUBLES]
                for x in range(len(items)):  # one item of another container for two of this one
                    for y in range(x + 1, len(items)):
                        s = int(sizes[items[x]] + sizes[items[y]])
                        j = o.largest(s + free, s + 1, b)
                        if j is not None:
                            offer([(items[x], o.of[j]), (items[y], o.of[j]), (j, b)])
                if best is None:
                    break
                o.move(best[1])
                changed += 1
        if not changed:
            break
    return [sorted(items) for b, items in sorted(o.bins.items()) if items]


def pack(ids: np.ndarray, tokens: np.ndarray, capacity: int, max_rounds: int = MAX_ROUNDS) -> pd.DataFrame:
    """Containers of one group: bin, id, piece_index, n_pieces, start_token, end_token, n_tokens. Items without tokens lie in the first one."""
    order = np.argsort(ids, kind="stable")
    ids, tokens = ids[order], tokens[order]
    whole = np.where(tokens > capacity, tokens // capacity, 0)
    rest = np.where(tokens > capacity, tokens % capacity, tokens)
    n_pieces = np.maximum(1, whole + (rest > 0))
    open_items = np.flatnonzero(rest > 0)
    bins = improve(rest[open_items], best_fit(rest[open_items], capacity), capacity, max_rounds) if len(open_items) else []
    of = np.zeros(len(ids), dtype=np.int64)
    for b, items in enumerate(bins):
        of[open_items[items]] = b
    full_at = np.repeat(np.arange(len(ids)), whole)
    index = np.arange(len(full_at)) - np.repeat(np.cumsum(whole) - whole, whole)
    last = np.flatnonzero((rest > 0) | (tokens == 0))
    at = np.concatenate([full_at, last])
    piece = np.concatenate([index, (n_pieces - 1)[last]])
    size = np.concatenate([np.full(len(full_at), capacity), rest[last]])
    bin_of = np.concatenate([len(bins) + np.arange(len(full_at)), of[last]])
    start = piece * capacity
    return pd.DataFrame({"bin": bin_of, "id": ids[at], "piece_index": piece, "n_pieces": n_pieces[at], "start_token": start, "end_token": start + size, "n_tokens": size})


def fill_containers(items: DataFrame, specs: DataFrame, id_col: str = "id", tokens: str = "n_tokens", group_items: int = GROUP_ITEMS, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """spec_id, container_id, id, piece_index, n_pieces, start_token, end_token, n_tokens, container_tokens, capacity_tokens.

    ``items`` has an integer id and a number of tokens; rows with a null id or number are left out, a row
    without tokens lies in a container of its group and takes no room, repeated rows are packed each.
    ``specs`` (spec_id, capacity_tokens) is small by nature, a row for each kind of container; rows with a null
    or non-positive capacity are left out. Items are counted once to choose the number of groups. Rows of an id that is
    repeated more than a quarter of a group's size are spread over all groups.
    """
    rows = cut(items.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{tokens}`").cast("long").alias("n")).where("id is not null and n is not null"))
    groups = max(1, round(rows.count() / group_items))
    kinds = specs.select(F.col("spec_id").cast("int").alias("spec_id"), F.col("capacity_tokens").cast("long").alias("capacity")).where("spec_id is not null and capacity > 0").distinct().limit(MAX_SPECS + 1).collect()
    if len(kinds) > MAX_SPECS:
        raise ValueError(f"more than {MAX_SPECS} kinds of containers")
    wanted = F.array(*[F.struct(F.lit(k.spec_id).alias("spec_id"), F.lit(k.capacity).cast("long").alias("capacity")) for k in kinds]) if kinds else F.array().cast("array<struct<spec_id:int,capacity:long>>")
    # an id may hold a third of all rows; its rows are alike, so it doesn't matter which of them is where
    hot = cut(rows.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > max(1, group_items // 4)).select("id", F.lit(True).alias("hot")))
    n_hot, held = sized(hot)
    spread = rows.withColumn("hot", F.lit(False))
    if n_hot:
        spread = rows.join(F.broadcast(hot) if held <= BROADCAST_BYTES else hot, "id", "left")
    salt = F.when(F.coalesce("hot", F.lit(False)), F.monotonically_increasing_id()).otherwise(0)
    spread = spread.withColumn("group_id", F.pmod(F.xxhash64("id", salt), F.lit(groups)).cast("int"))
    each = spread.select("id", "n", "group_id", F.inline(wanted))

    def go(f: pd.DataFrame) -> pd.DataFrame:
        done = pack(f["id"].to_numpy(), f["n"].to_numpy(), int(f["capacity"].iloc[0]), max_rounds)
        done.insert(0, "group_id", f["group_id"].iloc[0])
        done.insert(0, "spec_id", f["spec_id"].iloc[0])
        done["capacity_tokens"] = f["capacity"].iloc[0]
        done["container_tokens"] = done.groupby("bin")["n_tokens"].transform("sum")
        return done

    packed = each.repartition("spec_id", "group_id").groupBy("spec_id", "group_id").applyInPandas(go, PACKED + ", capacity_tokens long, container_tokens long")
    container = F.concat_ws("-", F.col("spec_id"), F.col("group_id"), F.col("bin")).alias("container_id")
    return packed.select("spec_id", container, "id", "piece_index", "n_pieces", "start_token", "end_token", "n_tokens", "container_tokens", "capacity_tokens")
