"""Problem 6: encoding a corpus with a public byte-level BPE tokenizer.

Method: in each partition the distinct pre-tokens become token-position rows in DuckDB; a recursive
query joins the rows of each word with the merge table and contracts the word's pairs of minimum rank,
leftmost first, until no pair is left; an ordered aggregation gives each word's ids. Documents are then
put together from their words' ids by array gathering. An ordered aggregation also decodes.

Two exact reductions keep the recursion small. Each distinct word is encoded once a partition. A word
is cut before the recursion wherever two neighbouring bytes stand side by side in no token of the
vocabulary: no merge can reach over such a place. This cuts Chinese or Thai runs, which hardly repeat
as a whole, into a few characters that do.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.runtime import ship_package

#: Folder of the tokenizer files; a parameter of every operator here.
TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the pattern that splits text before merges in byte_bpe_50k and byte_bpe_multi_50k.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words and bytes sent through one recursive query, and words remembered in a partition. They bound memory only.
SLICE_PIECES, SLICE_BYTES = 20_000, 250_000
REMEMBERED_WORDS = 400_000
#: Characters of text split into words at once.
SLICE_CHARS = 1_000_000

#: A round contracts, in every word, all places of the word's pair of least rank, from the left where they overlap. A merged
#: token takes part in later ranks only, so this gives what contracting the leftmost place again and again gives. Only the
#: newest state of a position is kept.
CONTRACT_SQL = """
WITH RECURSIVE step(piece, pos, tok, gone) USING KEY (piece, pos) AS (
    SELECT piece, pos, tok, false FROM start_rows
  UNION
    SELECT piece, pos, CASE WHEN head THEN best ELSE tok END, coalesce(lag(head) OVER w, false)
    FROM (
        SELECT *, coalesce(merged = best, false) AND (n - coalesce(max(CASE WHEN merged IS DISTINCT FROM best THEN n END) OVER w, 0)) % 2 = 1 AS head
        FROM (
            SELECT p.*, min(merged) OVER (PARTITION BY piece) AS best
            FROM (
                SELECT s.piece, s.pos, s.tok, s.n, m.merged
                FROM (SELECT piece, pos, tok, lead(tok) OVER v AS next_tok, row_number() OVER v AS n
                      FROM recurring.step WHERE NOT gone AND piece IN (SELECT piece FROM step) WINDOW v AS (PARTITION BY piece ORDER BY pos)) s
                LEFT JOIN merges m ON m.pair = (s.tok::BIGINT << 32) | s.next_tok
            ) p
        ) q
        WHERE best IS NOT NULL
        WINDOW w AS (PARTITION BY piece ORDER BY pos ROWS UNBOUNDED PRECEDING)
    ) r
    WINDOW w AS (PARTITION BY piece ORDER BY pos)
)
SELECT piece, list(tok ORDER BY pos) AS ids FROM step WHERE NOT gone GROUP BY piece
"""
#: Ordered aggregation of the bytes of each text's ids.
DECODE_SQL = """
SELECT row_no, string_agg(hex(bytes), '' ORDER BY place) AS raw, bool_or(bytes IS NULL) AS unknown
FROM (SELECT i.row_no, i.place, v.bytes FROM id_rows i LEFT JOIN vocab v ON v.id = i.id)
GROUP BY row_no
"""


def vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a rank file: ids of the 256 bytes, merges as (left << 32 | right), merged ids, and which byte pairs stand in a token.

    A token's pair is the one its own merges of lower rank leave at last.
    """
    ranks: dict[bytes, int] = {}
    with open(path, "rb") as f:
        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
    joinable = np.zeros((256, 256), dtype=bool)
    pairs, merged = [], []
    for token, rank in ranks.items():
        if len(token) < 2:
            continue
        raw = np.frombuffer(token, dtype=np.uint8)
        joinable[raw[:-1], raw[1:]] = True
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if ranks.get(parts[best] + parts[best + 1], 1 << 40) >= rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            pairs.append(ranks[parts[0]] << 32 | ranks[parts[1]])
            merged.append(rank)
    return byte_ids, np.array(pairs, dtype=np.int64), np.array(merged, dtype=np.int32), joinable


@lru_cache(maxsize=2)
def _loaded(path: str):
    return vocabulary(path)


def connect():
    """A connection that works in memory alone and writes no file anywhere."""
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})


class PartitionEncoder:
    """Encodes the texts of one partition; ``words`` keeps each distinct word's place in the flat store of ids."""

    def __init__(self, path: str):
        import regex

        self.byte_ids, pairs, merged, self.joinable = _loaded(path)
        self.split = regex.compile(PATTERN).findall
        self.db = connect()
        self.db.register("merge_arrow", pa.table({"pair": pairs, "merged": merged}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_arrow")
        self.db.unregister("merge_arrow")
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.flat = [np.empty(0, dtype=np.int32)]
        self.lengths = [np.empty(0, dtype=np.int64)]

    def contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, flat, and how many each has."""
        flat, lengths = [], []
        at = 0
        while at < len(pieces):
            ahead = np.cumsum([len(p) for p in pieces[at : at + SLICE_PIECES]])
            part = pieces[at : at + max(1, int(np.searchsorted(ahead, SLICE_BYTES)))]
            at += len(part)
            sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            if sizes[0] > SLICE_BYTES:  # one word longer than a slice has as much room as it needs, about 600 bytes for each of its own
                self.db.execute(f"SET memory_limit = '{300 + int(sizes[0]) * 600 // 1_000_000}MB'")
            raw = np.frombuffer(b"".join(part), dtype=np.uint8)
            rows = pa.table(
                {
                    "piece": np.repeat(np.arange(len(part), dtype=np.int32), sizes),
                    "pos": np.arange(len(raw), dtype=np.int32),
                    "tok": self.byte_ids[raw],
                }
            )
            self.db.register("start_rows", rows)
            got = self.db.sql(CONTRACT_SQL).to_arrow_table()
            self.db.unregister("start_rows")
            piece = got.column("piece").to_numpy()
            ids = got.column("ids").combine_chunks()
            starts = ids.offsets.to_numpy()[:-1].astype(np.int64)
            counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            order = np.argsort(piece)
            lengths.append(counts[order])
            flat.append(gather(ids.values.to_numpy(), starts[order], counts[order]))
        return np.concatenate(flat).astype(np.int32), np.concatenate(lengths)

    def learn(self, words: list[str]) -> None:
        """Encodes words not seen before."""
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        joined = b"".join(coded)
        raw = np.frombuffer(joined, dtype=np.uint8)
        ends = np.cumsum(sizes)
        is_end = np.zeros(len(raw) + 1, dtype=bool)
        is_end[1:-1] = ~self.joinable[raw[:-1], raw[1:]]
        is_end[ends] = True
        cuts = np.flatnonzero(is_end)
        starts = np.concatenate([[0], cuts[:-1]])
        owner = np.searchsorted(ends, starts, side="right")
        seen: dict[bytes, int] = {}
        piece_of = np.fromiter(
            (seen.setdefault(joined[a:b], len(seen)) for a, b in zip(starts.tolist(), cuts.tolist(), strict=True)),
            dtype=np.int64,
            count=len(starts),
        )
        ids, counts = self.contract(list(seen))
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.flat.append(gather(ids, first[piece_of], counts[piece_of]))
        self.lengths.append(np.bincount(owner, weights=counts[piece_of], minlength=len(words)).astype(np.int64))
        base = len(self.words)
        self.words.update(zip(words, range(base, base + len(words)), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of ids of each; null and empty texts have none."""
        if len(self.words) > REMEMBERED_WORDS:
            self.forget()
        found = [self.split(t) if t else [] for t in texts]
        new = {w for ws in found for w in ws}.difference(self.words)
        if new:
            self.learn(list(new))
        n_words = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        get = self.words.__getitem__
        at = np.fromiter((get(w) for ws in found for w in ws), dtype=np.int64, count=int(n_words.sum()))
        self.flat, self.lengths = [np.concatenate(self.flat)], [np.concatenate(self.lengths)]
        counts = self.lengths[0]
        first = np.concatenate([[0], np.cumsum(counts)])[:-1] if len(counts) else counts
        per_word = counts[at]
        total = np.concatenate([[0], np.cumsum(per_word)])
        bounds = np.concatenate([[0], np.cumsum(n_words)])
        return gather(self.flat[0], first[at], per_word), np.diff(total[bounds])


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + counts[i]] of every i, one after the other."""
    total = int(counts.sum())
    if not total:
        return values[:0]
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return values[np.repeat(starts - before, counts) + np.arange(total)]


def slices(texts: list[str | None]) -> Iterator[slice]:
    """Cuts a batch where its texts reach SLICE_CHARS characters, so that long texts don't add up in memory."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _encode_batches(path: str, text_at: int, schema: pa.Schema, only_count: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            encoder = encoder or PartitionEncoder(path)
            for part in slices(texts):
                ids, counts = encoder.encode(texts[part])
                if only_count:
                    last = pa.array(counts, type=pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), type=pa.int32()), pa.array(ids, type=pa.int32()))
                kept = [c.slice(part.start, part.stop - part.start) for i, c in enumerate(batch.columns) if i != text_at]
                yield pa.RecordBatch.from_arrays([*kept, last], schema=schema)

    return run


def _arrow_schema(fields: list[T.StructField], last: pa.Field) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields] + [last])


def encode_texts(df: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "ids", tokenizer_dir: str = TOKENIZER_DIR, name: str = "byte_bpe_50k", only_count: bool = False) -> DataFrame:
    """The ``keep`` columns of every row and the ids of its text, without special tokens, as ``out`` array<int>.

    With ``only_count`` ``out`` is the number of ids (bigint). Null, empty: no ids, an empty list. Blank
    texts, strings of special tokens and lone surrogates are ordinary text. Repeated rows stay. Only the
    named columns are read, so further columns of any name don't matter; an ``out`` that is also kept is
    refused. No shuffle: each partition is encoded by itself.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    if out in keep:
        raise ValueError(f"column {out} is already there")
    ship_package(df.sparkSession)
    path = os.path.join(tokenizer_dir, f"{name}.tiktoken")
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    last = pa.field(out, pa.int64() if only_count else pa.list_(pa.int32()))
    fields = [rows.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(out, T.LongType() if only_count else T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(_encode_batches(path, len(keep), _arrow_schema(fields, last), only_count), schema)


def _decode_batches(path: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = None
        for batch in batches:
            if db is None:
                db = connect()
                with open(path, "rb") as f:
                    pairs = [line.split() for line in f]
                db.register("v", pa.table({"id": pa.array([int(r) for _, r in pairs], type=pa.int32()), "bytes": pa.array([base64.b64decode(t) for t, _ in pairs], type=pa.binary())}))
                db.execute("CREATE TABLE vocab AS SELECT * FROM v")
            lists = batch.column(batch.num_columns - 1)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            first, start = 0, 0
            ends = np.cumsum(sizes)
            texts: list[str | None] = [None if null else "" for null in lists.is_null().to_pylist()]
            while first < len(sizes):  # as many rows as hold SLICE_BYTES ids, one at least
                last = max(first + 1, int(np.searchsorted(ends, start + SLICE_BYTES, side="right")))
                ids = lists.slice(first, last - first).flatten()
                own = sizes[first:last]
                db.register("id_rows", pa.table({"row_no": np.repeat(np.arange(first, last), own), "place": np.arange(int(own.sum())), "id": ids}))
                for row, raw, unknown in db.execute(DECODE_SQL).fetchall():
                    texts[row] = None if unknown else bytes.fromhex(raw).decode("utf-8", "replace")
                db.unregister("id_rows")
                first, start = last, int(ends[last - 1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, type=pa.string())], schema=schema)

    return run


def decode_ids(df: DataFrame, ids: str = "ids", keep: list[str] | None = None, out: str = "text", tokenizer_dir: str = TOKENIZER_DIR, name: str = "byte_bpe_50k") -> DataFrame:
    """The ``keep`` columns of every row and the text its ids stand for, put together by an ordered aggregation in DuckDB.

    An empty list gives an empty text; a null list, and one with a null or an id that isn't in the vocabulary, gives null.
    Bytes that are no UTF-8 become U+FFFD. Repeated rows stay; an ``out`` that is also kept is refused. No shuffle.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != ids]
    if out in keep:
        raise ValueError(f"column {out} is already there")
    ship_package(df.sparkSession)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").cast("array<int>").alias("__ids"))
    fields = [rows.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(out, T.StringType())])
    return rows.mapInArrow(_decode_batches(os.path.join(tokenizer_dir, f"{name}.tiktoken"), _arrow_schema(fields, pa.field(out, pa.string()))), schema)


def token_count(text: Column) -> Column:
    """Tokens as TESTDATA.md defines them: runs of characters other than space, tab, LF and CR. JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0))
