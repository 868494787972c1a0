"""Alignment of two tokenizers over the same texts: shared boundaries, groups between them, and linked token pairs.

Both tokenizers cut the bytes of ' ' + text.  Where tokens of both end, a group closes; two tokens are linked if their byte ranges
overlap.  The core works on Arrow columns of a block of documents:

1. Token lists are flattened; a parent index says which document a token belongs to.  Joined token bytes (`take` on the table
   of token bytes) are compared with the text, so a document that either tokenizer doesn't give back exactly has no tokens.
2. Cumulative sums of token lengths, offset by where the document starts in the block, are end keys that name document and byte.
3. An Acero full outer join of both token tables on that key, sorted, gives the elementary segments.  A segment lies in one token
   of either side: the next one to end.  Filling nulls backwards names them, so segments are links, and keys found on both
   sides end groups.
4. `Table.group_by` counts the links of a block by (document, pair) and the documents of a pair.

Spark merges the partial counts of the blocks and brings the corpus-wide counts back to them by the block's own list of pairs.
A block holds `BLOCK_BYTES` of text (one longer text is a block of its own) and all that is shuffled for it is bounded by
that.  Tokens are not shuffled: a document keeps its distinct pairs and how often each links.

Defined results: null and empty texts, and texts that a tokenizer changes (characters it normalises, U+2581 in the text), have
zeros and groups_sha256 ''.  Rows of one doc_id are documents of their own.  Extra columns are not read; an empty table gives
no rows.  The vocabulary files must be at the given paths on every executor.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from care_episodes.llm.buffers import slices
from care_episodes.session import materialize

#: Vocabularies: a byte-level BPE file and a sentencepiece model.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

#: Bytes of text in a block.
BLOCK_BYTES = 1 << 20
#: Characters encoded at a time.
ENCODE_CHARS = 1 << 17
#: Words whose tokens a worker keeps.
KNOWN_PARTS = 400_000

#: A pair is a's id times this plus b's id.
B_IDS = 1 << 20

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# ---- vocabularies ---------------------------------------------------------------------------
def byte_level_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, take the characters from U+0100 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_bpe_table(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    alphabet = byte_level_alphabet()
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    table = [b""] * (max(ids.values()) + 1)
    special = {t["content"] for t in spec.get("added_tokens", ())}
    for token, i in ids.items():
        table[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
    return table


def piece_table(model) -> list[bytes]:
    """Bytes of each id of a sentencepiece model: U+2581 is a space, <0xHH> is a byte."""
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        table.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return table


def _splits_at_spaces(path: str) -> bool:
    """Whether a byte-level vocabulary's pattern puts a space to the word after it (the usual one does; others encode texts whole)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kind = spec.get("pre_tokenizer") or {}
    return not spec.get("normalizer") and kind.get("type") == "ByteLevel" and bool(kind.get("use_regex", True)) and not kind.get("add_prefix_space")


class Tokenizers:
    """Both tokenizers with the byte tables of their ids; built once per Python worker."""

    _known: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, byte_bpe: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_a = pa.array(byte_bpe_table(byte_bpe), pa.large_binary())
        self.bytes_b = pa.array(piece_table(self.b), pa.large_binary())
        pieces_apart = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.apart = pieces_apart and _splits_at_spaces(byte_bpe)
        self._forget()

    @classmethod
    def at(cls, byte_bpe: str, pieces: str) -> Tokenizers:
        if (byte_bpe, pieces) not in cls._known:
            cls._known[byte_bpe, pieces] = cls(byte_bpe, pieces)
        return cls._known[byte_bpe, pieces]

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Token ids of the texts as list columns.

        A space between two characters that are no white space is a border of both tokenizers, whatever stands around: the one's
        pattern starts a word with the space, and the other has no piece with a space after another character.  So texts are
        split there, each distinct part is encoded once, and its tokens are taken for every place it stands at.  Parts stay known
        from block to block, up to `KNOWN_PARTS`.  A text with white space beside a split is encoded whole.
        """
        parts = pc.split_pattern(texts, " ")
        of_text = pc.list_parent_indices(parts).to_numpy()
        coded = pc.list_flatten(parts).dictionary_encode()
        distinct, codes = coded.dictionary, coded.indices.to_numpy()
        trimmed = pc.and_(pc.equal(pc.utf8_trim_whitespace(distinct), distinct), pc.not_equal(distinct, ""))
        apart = trimmed.to_numpy(zero_copy_only=False) & self.apart
        whole = np.zeros(len(texts), bool)
        whole[of_text[~apart[codes]]] = True
        kept = ~whole[of_text]
        places, sizes = np.flatnonzero(~whole), np.bincount(of_text[kept], minlength=len(texts))[~whole]
        order = pa.array(np.argsort(np.concatenate([places, np.flatnonzero(whole)])))
        number = np.cumsum(apart) - 1
        places_known = self._known_places(distinct.filter(pa.array(apart)).to_pylist())
        wanted = pa.array(places_known[number[codes[kept]]])
        rest = texts.filter(pa.array(whole)).to_pylist()
        out = []
        for encode, known in ((self._encode_a, self.tokens[0]), (self._encode_b, self.tokens[1])):
            taken = known.lists().take(wanted)
            ends = taken.offsets.to_numpy()[np.concatenate([[0], np.cumsum(sizes)])]
            joined = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), taken.values)
            whole_ones = [x for batch in _some(rest) for x in encode(batch)]
            out.append(pa.concat_arrays([joined, _lists(whole_ones)]).take(order))
        return out[0], out[1]

    def _known_places(self, parts: list[str]) -> np.ndarray:
        """Where the tokens of the parts lie among those known; new ones are encoded first."""
        if len(self.place) > KNOWN_PARTS:
            self._forget()
        new = [p for p in parts if p not in self.place]
        if new:
            for encode, table, known in ((self._encode_a, self.bytes_a, self.tokens[0]), (self._encode_b, self.bytes_b, self.tokens[1])):
                known.add(*_part_tokens(new, encode, pc.binary_length(table).to_numpy()))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        return np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.tokens = (_Lists(), _Lists())

    def _encode_a(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(x.ids, np.int32) for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def _encode_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(x, np.int32) for x in self.b.encode(texts, num_threads=1)]


class _Lists:
    """Lists of token ids that grow at the end."""

    def __init__(self):
        self.ids, self.ends, self.n_ids, self.n = np.zeros(1024, np.int32), np.zeros(1024, np.int64), 0, 0

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(counts) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.ends[self.n + 1 : self.n + len(counts) + 1] = self.n_ids + np.cumsum(counts)
        self.n_ids, self.n = self.n_ids + len(ids), self.n + len(counts)

    def lists(self) -> pa.Array:
        return pa.LargeListArray.from_arrays(pa.array(self.ends[: self.n + 1]), pa.array(self.ids[: self.n_ids]))


def _part_tokens(parts: list[str], encode, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the parts, and how many each has.  Many are encoded as one text, joined by spaces, and told apart by the bytes of their tokens."""
    found, counts = [], []
    for some in _some(parts):
        ids = encode([" ".join(some)])[0]
        sizes = pc.binary_length(pa.array(some, pa.large_string())).to_numpy(zero_copy_only=False)
        ends, wanted = np.cumsum(lengths[ids]), np.cumsum(sizes + 1)
        at = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and (ends[at] == wanted).all():
            found.append(ids)
            counts.append(np.diff(at + 1, prepend=0))
        else:  # a part that isn't given back byte by byte: each on its own
            each = encode(some)
            found += each
            counts.append(np.array([len(x) for x in each], np.int64))
    return np.concatenate(found), np.concatenate(counts)


def _some(texts: list[str]) -> Iterator[list[str]]:
    """Texts some at a time: the libraries' own token objects are large."""
    start = 0
    while start < len(texts):
        end, size = start + 1, len(texts[start])
        while end < len(texts) and size + len(texts[end]) <= ENCODE_CHARS:
            size += len(texts[end])
            end += 1
        yield texts[start:end]
        start = end


def _lists(values: list[np.ndarray]) -> pa.Array:
    at = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(flat, pa.int32()))


# ---- one block ------------------------------------------------------------------------------
def _same_bytes(ids: pa.Array, table: pa.Array, wanted: pa.Array) -> np.ndarray:
    """Whether the joined bytes of each list of ids equal the wanted text."""
    parts = table.take(ids.flatten())
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(parts).to_numpy(zero_copy_only=False))])
    ends = ends[ids.offsets.to_numpy()]
    buffer = np.frombuffer(parts.buffers()[2] or b"", np.uint8)
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buffer)])
    return pc.equal(joined, wanted).to_numpy(zero_copy_only=False)


def _per_document(documents: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(documents, minlength=n)


def segments(len_a: pa.Array, len_b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, whether both end there) of each elementary segment of a block, in byte order.

    Token lengths are given in byte order; both sides cover the same bytes, so running sums are keys of (document, end).
    """
    a = pa.table({"end": pc.cumulative_sum(len_a), "a": pa.array(np.arange(len(len_a), dtype=np.int32))})
    b = pa.table({"end": pc.cumulative_sum(len_b), "b": pa.array(np.arange(len(len_b), dtype=np.int32))})
    ends = a.join(b, "end", join_type="full outer", use_threads=False)
    ends = ends.take(pc.array_sort_indices(ends["end"].combine_chunks()))
    both = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"]))
    filled = [pc.fill_null_backward(ends[side].combine_chunks()).to_numpy(zero_copy_only=False) for side in ("a", "b")]
    return filled[0], filled[1], both.to_numpy()


_SEPARATORS = (b"", b",", b"|", b";")


def _decimal_table(n: int) -> pa.Array:
    """Decimal ids followed by each separator: id times 4 plus the separator's number."""
    return pa.array([b"%d%s" % (i, s) for i in range(n) for s in _SEPARATORS], pa.large_binary())


_decimals: dict[int, pa.Array] = {}


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, last_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All groups of a block as bytes `a1,a2|b1;a3|b2,b3`, and the end of each group in them.

    `group_a`, `group_b` number the group of each token; `last_group` marks groups that end a document.
    """
    n = int(max(ids_a.max(initial=0), ids_b.max(initial=0))) + 1
    table = _decimals.get(n) or next((t for k, t in _decimals.items() if k >= n), None)
    if table is None:
        _decimals.clear()
        table = _decimals[max(n, 1 << 16)] = _decimal_table(max(n, 1 << 16))
    groups = len(last_group)
    size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    at_a = np.arange(len(ids_a)) + before_b[group_a]
    at_b = np.arange(len(ids_b)) + (before_a + size_a)[group_b]
    sep_a = np.ones(len(ids_a), np.int64)
    sep_a[np.cumsum(size_a) - 1] = 2
    sep_b = np.ones(len(ids_b), np.int64)
    sep_b[np.cumsum(size_b) - 1] = np.where(last_group, 0, 3)
    cells = np.empty(len(ids_a) + len(ids_b), np.int64)
    cells[at_a] = ids_a.astype(np.int64) * 4 + sep_a
    cells[at_b] = ids_b.astype(np.int64) * 4 + sep_b
    written = table.take(pa.array(cells))
    ends = np.cumsum(pc.binary_length(written).to_numpy(zero_copy_only=False))
    return np.frombuffer(written.buffers()[2] or b"", np.uint8), ends[np.cumsum(size_a + size_b) - 1]


def align_block(texts: pa.Array, tokenizers: Tokenizers) -> tuple[dict, pa.Table]:
    """Per document: counts, hash of the groups and distinct linked pairs; per pair of the block: how many documents hold it."""
    n = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    used = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    plain = texts.take(pa.array(used))
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), plain, pa.scalar("", pa.large_string())).cast(pa.large_binary())
    ids_a, ids_b = tokenizers.encode(plain)
    good = _same_bytes(ids_a, tokenizers.bytes_a, spaced) & _same_bytes(ids_b, tokenizers.bytes_b, spaced)
    used = used[good]
    ids_a, ids_b = ids_a.filter(pa.array(good)), ids_b.filter(pa.array(good))
    flat_a, flat_b = pc.list_flatten(ids_a), pc.list_flatten(ids_b)
    parent_a = used[pc.list_parent_indices(ids_a).to_numpy()]
    parent_b = used[pc.list_parent_indices(ids_b).to_numpy()]
    len_a = pc.binary_length(tokenizers.bytes_a).take(flat_a)
    len_b = pc.binary_length(tokenizers.bytes_b).take(flat_b)
    out = {"n_a": _per_document(parent_a, n), "n_b": _per_document(parent_b, n)}
    a, b, both = segments(len_a, len_b)
    flat_a, flat_b = flat_a.to_numpy(), flat_b.to_numpy()
    document = parent_a[a]
    out["n_links"] = _per_document(document, n)
    out["n_groups"] = _per_document(document[both], n)
    # A group's number is how many groups ended before; a token's group is that of the segment it ends in.
    number = np.cumsum(both) - both
    group_a, group_b = np.empty(len(flat_a), np.int64), np.empty(len(flat_b), np.int64)
    group_a[a], group_b[b] = number, number
    of_group = document[both]
    last = np.append(of_group[1:] != of_group[:-1], True) if len(of_group) else np.zeros(0, bool)
    written, ends = group_texts(flat_a, flat_b, group_a, group_b, last) if len(of_group) else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
    hashes, start = [""] * n, 0
    whole = memoryview(written.tobytes())
    for d, end in zip(of_group[last].tolist(), ends[last].tolist(), strict=True):
        hashes[d], start = hashlib.sha256(whole[start:end]).hexdigest(), end
    out["groups_sha256"] = hashes
    # Partial counts: links by (document, pair), then documents by pair.
    pair = flat_a[a].astype(np.int64) * B_IDS + flat_b[b]
    links = pa.table({"document": document.astype(np.int32), "pair": pair})
    held = links.group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")])
    held = held.take(pc.array_sort_indices(held["document"].combine_chunks()))
    at = np.searchsorted(held["document"].to_numpy(), np.arange(n + 1)).astype(np.int64)
    out["pairs"] = pa.LargeListArray.from_arrays(pa.array(at), held["pair"].combine_chunks())
    out["times"] = pa.LargeListArray.from_arrays(pa.array(at), held["count_all"].combine_chunks().cast(pa.int32()))
    return out, held.group_by("pair", use_threads=False).aggregate([([], "count_all")])


# ---- the corpus -----------------------------------------------------------------------------
def aligned_blocks(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """One row per document (`whole` false) with its block, and one per block (`whole` true) with its pairs and how many documents hold each."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"block long, whole boolean, doc_id {doc_id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    schema = to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers.at(byte_bpe, pieces)
        block = TaskContext.get().partitionId() << 32
        for some in slices(batches, "text", BLOCK_BYTES, 1 << 16):
            n = some.num_rows
            found, held = align_block(some.column("text"), tokenizers)
            columns = {"block": pa.repeat(pa.scalar(block, pa.int64()), n), "whole": pa.repeat(pa.scalar(False), n), "doc_id": some.column("doc_id"), **found}
            yield pa.RecordBatch.from_arrays([_as(columns[f.name], f.type) for f in schema], schema=schema)
            if held.num_rows:
                one = {"block": block, "whole": True, "pairs": held["pair"].combine_chunks(), "times": held["count_all"].combine_chunks()}
                arrays = []
                for f in schema:
                    if f.name in ("pairs", "times"):
                        values = one[f.name].cast(f.type.value_type)
                        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(f.type))
                    else:
                        arrays.append(pa.array([one.get(f.name)], f.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            block += 1

    return docs.select("doc_id", "text").mapInArrow(blocks, ddl)


def _as(values, kind: pa.DataType) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return values if values.type == kind else values.cast(kind)


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, count, best) from partial counts: documents that hold the pair, and whether no pair of its a-token is held by more."""
    counts = partial.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("id_a", F.col("pair").bitwiseAND(F.lit(~(B_IDS - 1))))
    most = counts.groupBy(F.col("id_a").alias("of_a")).agg(F.max("count").alias("most"))
    return counts.join(most, F.col("id_a") == F.col("of_a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_corpus(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """One row per document: doc_id, the six counts and groups_sha256."""
    parts = materialize(aligned_blocks(docs, byte_bpe, pieces))
    listed = F.explode(F.arrays_zip("pairs", "times")).alias("one")
    partial = parts.where("whole").select("block", listed).select("block", F.col("one.pairs").alias("pair"), F.col("one.times").alias("n"))
    counts = materialize(pair_counts(partial))
    wanted = partial.join(counts, "pair").select(F.col("block").alias("of_block"), "pair", "count", "best")
    own = parts.where("not whole").select("block", "doc_id", *_COUNTS, "groups_sha256", "pairs", "times")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {doc_id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    schema = to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)

    def score(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("pair")
        lists = documents["pairs"].combine_chunks()
        at = np.searchsorted(pairs["pair"].to_numpy(), lists.flatten().to_numpy())
        times = documents["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
        best = times * pairs["best"].to_numpy()[at]
        count = times * pairs["count"].to_numpy()[at]
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]).astype(np.int64)
        sums = {k: np.diff(np.concatenate([[0], np.cumsum(v)])[ends]) for k, v in (("n_best", best), ("count_sum", count))}
        return pa.Table.from_arrays([_as(sums[f.name], f.type) if f.name in sums else documents[f.name].cast(f.type) for f in schema], schema=schema)

    return own.groupBy("block").cogroup(wanted.groupBy("of_block")).applyInArrow(score, ddl)
