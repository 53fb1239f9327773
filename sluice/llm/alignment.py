"""Cross-tokenizer alignment: which tokens of two vocabularies end at the same byte.

Side A is a byte-level BPE of ``tokenizers`` applied to a space and the text,
side B a ``sentencepiece`` model, which puts the space in front by itself. Both
split the same bytes, so byte offsets are a common ruler:

1. A task's documents become two Arrow list columns of ids. The lists are
   flattened, each id with the index of its document; a segmented cumulative sum
   of token lengths gives the byte at which every token ends in its document.
2. An Acero hash join on (document, end) finds the *links*: pairs of an A and a
   B token that end together. They cut the document into *groups*.
3. ``Table.group_by`` counts the links of each id pair per task; Spark adds the
   partial counts up. One token of a link is a suffix of the other, so there are
   no more pairs than suffixes shared by the two vocabularies
   (:func:`most_pairs`, below a million here), whatever the corpus: the counts
   are safe to broadcast.
4. A second pass over the stored ids joins counts to links.

Documents are tokenized once; their ids are stored in the shared folder, a batch
of documents as one compressed Arrow stream, so that Spark moves few rows. A null
or empty text has no tokens, nor has one whose joined A or B bytes are not the
space and the text (texts that hold U+2581, for example): no groups, no links,
zeros and an empty digest. Rows with equal or null ids are documents of their
own. A text is aligned as a whole, so the longest must fit a task's memory with
its tokens; batches hold about ``BATCH_BYTES`` of text otherwise. An empty table
gives no rows. Other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep, ready

BATCH_BYTES = 1 << 20
MERGE_ROWS = 1 << 20  # partial counts are merged when they reach this many rows
ENCODED = "ids binary, count_a array<int>, count_b array<int>, count_n array<long>"
SUMMARY = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
GROUPS = "doc_id long, group long, start long, end long, a array<int>, b array<int>"


# --- the two vocabularies -------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for U+0100 and on.
    """
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers and the bytes of all their tokens; one per Python worker."""

    def __init__(self, spec: dict):
        import sentencepiece
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(spec["tokenizer"])
        self.exact.encode_special_tokens = True  # their strings in a text are ordinary text
        self.quick, self.odd = None, None
        if spec["ranks"]:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, spec["ranks"].splitlines())}
            self.quick = tiktoken.Encoding("ranks", pat_str=spec["pattern"], mergeable_ranks=ranks, special_tokens={})
            self.odd = re.compile("[^\x00-ɏ]")  # beyond it the two may split white space and letters differently
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=spec["model"])
        letters = _byte_letters()
        vocab = self.exact.get_vocab(with_added_tokens=True)
        a = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            known = all(c in letters for c in token)
            a[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.a = pa.array(a, pa.large_binary())
        self.b = pa.array([self._piece(i) for i in range(self.pieces.get_piece_size())], pa.large_binary())
        self.sizes = [pc.binary_length(side).cast(pa.int64()) for side in (self.a, self.b)]

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode("utf-8", "surrogatepass")

    def encode_a(self, text: str) -> list[int]:
        if self.quick and not self.odd.search(text):
            return self.quick.encode_ordinary(" " + text)
        return self.exact.encode(" " + text, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of both sides; empty lists where a side does not give back the space and the text."""
        whole = [t or "" for t in texts]
        ids = pa.list_(pa.int32())
        a = pa.array([self.encode_a(t) if t else [] for t in whole], ids)
        b = pa.array(self.pieces.encode(whole, num_threads=1) if whole else [], ids)
        raw = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in whole]
        good = self._spells(a, self.a, raw) & self._spells(b, self.b, raw)
        if not good.all():
            none = pa.scalar([], ids)
            a, b = (pc.if_else(pa.array(good), side, none) for side in (a, b))
        return a, b

    @staticmethod
    def _spells(ids: pa.ListArray, tokens: pa.LargeBinaryArray, raw: list[bytes]) -> np.ndarray:
        """Whether the joined bytes of each list are the bytes given."""
        taken = tokens.take(ids.flatten())
        place = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
        ends = place[ids.offsets.to_numpy() - ids.offsets[0].as_py()]
        data = memoryview(taken.buffers()[2] or b"").cast("B")
        return np.array([data[s:e] == r for s, e, r in zip(ends[:-1], ends[1:], raw, strict=True)], bool)


_OPEN: dict[int, Vocabularies] = {}


def _vocabularies(shared) -> Vocabularies:
    """Built once per worker and broadcast."""
    if shared.value["key"] not in _OPEN:
        _OPEN.clear()
        _OPEN[shared.value["key"]] = Vocabularies(shared.value)
    return _OPEN[shared.value["key"]]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can be linked at all: those of which one token is a suffix of the other."""

    def counts(side: list[bytes]) -> dict[bytes, int]:
        found: dict[bytes, int] = {}
        for token in side:
            if token:
                found[token] = found.get(token, 0) + 1
        return found

    of_a, of_b = counts(a), counts(b)
    total = sum(n * of_b.get(t[i:], 0) for t, n in of_a.items() for i in range(len(t)))
    return total + sum(n * of_a.get(t[i:], 0) for t, n in of_b.items() for i in range(1, len(t)))


# --- the alignment of a batch -----------------------------------------------------------


def ends(ids: pa.ListArray, sizes: pa.Array) -> pa.Table:
    """``doc, end, at, id`` of every token: flattened, with a cumulative sum that starts anew in each list."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(sizes.take(flat))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total])
    starts = pc.subtract(ids.offsets, ids.offsets[0]).slice(0, len(ids))
    end = pc.subtract(total, before.take(starts).take(parent))
    at = pa.array(np.arange(len(flat), dtype=np.int64))
    return pa.table({"doc": parent, "end": end, "at": at, "id": flat})


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """``doc, end, a_at, a, b_at, b`` of all pairs that end together, in order."""
    left = a.rename_columns(["doc", "end", "a_at", "a"])
    right = b.rename_columns(["doc", "end", "b_at", "b"])
    found = left.join(right, ["doc", "end"], join_type="inner", use_threads=False, coalesce_keys=True)
    return found.take(np.lexsort((found["b_at"].to_numpy(), found["a_at"].to_numpy()))).combine_chunks()


def _pair_counts(found: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(found)
    return table.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])


def _batches(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[list, list]]:
    held_ids, held, size = [], [], 0
    for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
        held_ids.append(doc_id)
        held.append(text.as_py())
        size += 64 + len(held[-1] or "")
        if size >= BATCH_BYTES:
            yield held_ids, held
            held_ids, held, size = [], [], 0
    if held:
        yield held_ids, held


_COUNTS = {"a": pa.int32(), "b": pa.int32(), "n": pa.int64()}
_STORED = ["ids", "count_a", "count_b", "count_n"]


def _count_row(table: pa.Table) -> pa.RecordBatch:
    columns = [pa.array([table[c].to_numpy()], pa.list_(t)) for c, t in _COUNTS.items()]
    return pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), *columns], names=_STORED)


def _ids_row(doc_ids: list, a: pa.ListArray, b: pa.ListArray) -> pa.RecordBatch:
    """The batch as a compressed Arrow stream, ids in two bytes where they fit."""
    columns = [pa.array(doc_ids, pa.int64())]
    for side in (a, b):
        small = pc.max(side.flatten()).as_py() or 0
        columns.append(side.cast(pa.list_(pa.uint16() if small < 1 << 16 else pa.int32())))
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "a", "b"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    none = [pa.nulls(1, pa.list_(t)) for t in _COUNTS.values()]
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), *none], names=_STORED)


def encode(
    docs: DataFrame,
    tokenizer: str,
    model: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Encoded:
    """Tokenizes every document once and counts links.

    ``tokenizer`` and ``model`` are the files of sides A and B, ``ranks`` and
    ``pattern`` the vocabulary of A for ``tiktoken``, which is faster on texts
    of Latin characters. The files, a few MB, are read on the driver and
    broadcast.
    """
    spark = ready(docs)
    spec = {"tokenizer": _read(tokenizer).decode(), "model": _read(model), "pattern": pattern}
    spec["ranks"] = _read(ranks).decode() if ranks else None
    spec["key"] = hash((spec["tokenizer"], spec["model"], spec["ranks"], pattern))
    shared = spark.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _vocabularies(shared)
        counts: list[pa.Table] = []
        for batch in batches:
            for ids, texts in _batches(batch.column(0), batch.column(1)):
                a, b = both.encode(texts)
                found = links(*(ends(x, s) for x, s in zip((a, b), both.sizes, strict=True)))
                one = pa.array(np.ones(len(found), np.int64))
                counts.append(_pair_counts([found.select(["a", "b"]).append_column("n", one)]))
                if sum(map(len, counts)) > MERGE_ROWS:
                    counts = [_pair_counts(counts)]
                yield _ids_row(ids, a, b)
        if counts:
            yield _count_row(_pair_counts(counts))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return Encoded(keep(rows.mapInArrow(run, ENCODED), "token-ids"), shared)


class Encoded:
    """The stored ids of a table, and what can be asked of them."""

    def __init__(self, stored: DataFrame, shared):
        self.stored, self.shared = stored, shared

    @property
    def batches(self) -> DataFrame:
        return self.stored.where("ids IS NOT NULL").select("ids")

    def tokens(self) -> DataFrame:
        """``doc_id, a, b``: the ids of both sides; no ids where they do not spell the text."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, a, b in _stored(batches):
                yield pa.RecordBatch.from_arrays([ids, a, b], names=["doc_id", "a", "b"])

        return self.batches.mapInArrow(run, "doc_id long, a array<int>, b array<int>")

    def pair_counts(self) -> DataFrame:
        """``a_id, b_id, n, best``: the links of each id pair; best if none of the same B id has more."""
        each = self.stored.where("count_n IS NOT NULL").select(F.inline(F.arrays_zip("count_a", "count_b", "count_n")))
        total = each.groupBy(F.col("count_a").alias("a_id"), F.col("count_b").alias("b_id")).agg(
            F.sum("count_n").alias("n")
        )
        total = keep(total, "pair-counts")
        most = total.groupBy("b_id").agg(F.max("n").alias("most"))
        return total.join(most, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))

    def groups(self) -> DataFrame:
        """``doc_id, group, start, end, a, b``: the byte range and the ids of every group."""
        shared = self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both = _vocabularies(shared)
            for ids, a, b in _stored(batches):
                left, right = (ends(x, s) for x, s in zip((a, b), both.sizes, strict=True))
                cut = _Cut(a, b, links(left, right))
                last = np.flatnonzero(cut.last_a)
                doc, end = left["doc"].to_numpy()[last], left["end"].to_numpy()[last]
                fresh = np.r_[np.ones(min(1, len(doc)), bool), doc[1:] != doc[:-1]]
                start = np.where(fresh, 0, np.r_[np.zeros(min(1, len(end)), np.int64), end[:-1]])
                number = np.arange(len(doc)) - np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), side["id"].combine_chunks())
                    for n, side in ((cut.n_a, left), (cut.n_b, right))
                ]
                columns = [ids.take(pa.array(doc)), *(pa.array(x.astype(np.int64)) for x in (number, start, end)), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "group", "start", "end", "a", "b"])

        return self.batches.mapInArrow(run, GROUPS)

    def summary(self) -> DataFrame:
        """One row per document: sizes, links with the counts of their pairs, and a digest of the groups."""
        counts = self.pair_counts().orderBy("b_id", "a_id").toArrow()  # bounded by the vocabularies
        a, b = (counts[c].to_numpy().astype(np.int64) for c in ("a_id", "b_id"))
        known = (b << 32 | a, counts["n"].to_numpy(), counts["best"].to_numpy())
        known = self.stored.sparkSession.sparkContext.broadcast(known)
        shared = self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both = _vocabularies(shared)
            for ids, a, b in _stored(batches):
                found = links(*(ends(x, s) for x, s in zip((a, b), both.sizes, strict=True)))
                cut = _Cut(a, b, found)
                keys, n, best = known.value
                at = np.searchsorted(keys, found["b"].to_numpy().astype(np.int64) << 32 | found["a"].to_numpy())
                doc = found["doc"].to_numpy()
                edges = np.searchsorted(doc, np.arange(len(a) + 1))

                def per_doc(values: np.ndarray, edges=edges) -> np.ndarray:
                    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
                    return total[edges[1:]] - total[edges[:-1]]

                group_doc = np.searchsorted(a.offsets.to_numpy(), np.flatnonzero(cut.last_a), side="right") - 1
                columns = [
                    ids,
                    *(pc.list_value_length(x).cast(pa.int64()) for x in (a, b)),
                    pa.array(np.bincount(group_doc, minlength=len(a)).astype(np.int64)),
                    pa.array(per_doc(np.ones(len(at), np.int64))),
                    pa.array(per_doc(best[at])),
                    pa.array(per_doc(n[at])),
                    pa.array(cut.digests(), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[p.split()[0] for p in SUMMARY.split(", ")])

        return self.batches.mapInArrow(run, SUMMARY)


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.ListArray, pa.ListArray]]:
    """The stored batches of documents."""
    for batch in batches:
        for stored in batch.column(0):
            table = pa.ipc.open_stream(stored.as_buffer()).read_all().combine_chunks()
            ids, a, b = (table.column(i).chunk(0) for i in range(3))
            yield ids, a.cast(pa.list_(pa.int32())), b.cast(pa.list_(pa.int32()))


class _Cut:
    """Groups of a batch: which tokens end one, and how many of each side they hold."""

    def __init__(self, a: pa.ListArray, b: pa.ListArray, found: pa.Table):
        self.a, self.b = a, b
        self.last_a, self.last_b = np.zeros(len(a.flatten()), bool), np.zeros(len(b.flatten()), bool)
        self.last_a[found["a_at"].to_numpy()] = True
        self.last_b[found["b_at"].to_numpy()] = True
        self.n_a, self.n_b = (np.diff(np.r_[-1, np.flatnonzero(last)]) for last in (self.last_a, self.last_b))

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each document; '' without tokens.

        Ids with their separators are taken from a table of strings, in order,
        so the buffer of the result is the joined text.
        """
        many = [len(self.last_a), len(self.last_b)]
        group_a, group_b = (np.cumsum(last) - last for last in (self.last_a, self.last_b))
        before_b = np.r_[0, np.cumsum(self.n_b)]  # B tokens before each group
        through_a = np.cumsum(self.n_a)  # A tokens up to the end of each group
        place = np.empty(sum(many), np.int64)
        ids = [side.flatten().to_numpy() for side in (self.a, self.b)]
        texts, width = _separated(max(16, int(max((x.max() for x in ids if len(x)), default=0)).bit_length()))
        at_a, at_b = np.arange(many[0]) + before_b[group_a], np.arange(many[1]) + (through_a[group_b] if many[1] else 0)
        place[at_a] = ids[0] + np.where(self.last_a, width, 0)
        place[at_b] = ids[1] + np.where(self.last_b, 2 * width, 0)
        joined = texts.take(pa.array(place))
        offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
        data = memoryview(joined.buffers()[2] or b"")
        tokens = self.a.offsets.to_numpy().astype(np.int64) + self.b.offsets.to_numpy()
        edges = offsets[tokens]
        return [hashlib.sha256(data[s : e - 1]).hexdigest() if s < e else "" for s, e in zip(edges[:-1], edges[1:], strict=True)]


@lru_cache(maxsize=2)
def _separated(bits: int) -> tuple[pa.Array, int]:
    """All numbers of so many bits followed by a comma, then by a bar, then by a semicolon."""
    width = 1 << bits
    return pa.array([f"{i}{end}" for end in ",|;" for i in range(width)], pa.large_string()), width


def align(docs: DataFrame, tokenizer: str, model: str, **options) -> DataFrame:
    """:meth:`Encoded.summary` of the documents; ``options`` are those of :func:`encode`."""
    return encode(docs, tokenizer, model, **options).summary()


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
