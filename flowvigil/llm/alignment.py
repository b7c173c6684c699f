"""Alignment of two tokenizers over the same texts, in Arrow tables.

Texts are cut into segments that no token of either tokenizer crosses. A segment is encoded once per lot of
texts, and tokens of all segments are lists that are taken, flattened and given their parents. Running sums of
byte lengths, begun anew for each document, give every token its document-end key. A full outer hash join of the
two sides on that key leaves one row per stretch of bytes: where both sides are present a group ends, and a
missing side is the next token of that side. So a row is a link, and links need no search.

Counts of pairs are partial tables per block of links, merged by Spark. A block keeps its links as numbers into
its own list of pairs; the merged counts come back to blocks by a join per pair and block, never per link.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowvigil.llm.shared import cogrouped, id_and_bytes, int_lists, lots, remembering, text_bytes
from flowvigil.staging import Staging

#: Bytes of text whose segments are listed together, segments that are joined at once, links of a block.
LOT_BYTES = 4 << 20
SLICE = 150_000
BLOCK_LINKS = 1_000_000
#: Segments a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: A key is a document's number in its lot, then so many bits of its byte offset.
OFFSET_BITS = 40


class TwoTokenizers:
    """Token ids of segments under a byte-level BPE (A) and a sentencepiece BPE with byte fallback (B)."""

    def __init__(self, byte_level_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.bytes_a = _byte_level(self.a)
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.name_a = pa.array([str(i) for i in range(len(self.bytes_a))])
        self.name_b = pa.array([str(i) for i in range(len(self.bytes_b))])
        self.cuts = self._cuts()
        self.known: dict[bytes, tuple[bytes, bytes] | None] = {}

    def _cuts(self) -> np.ndarray:
        """For two bytes side by side, whether a token of either side can hold both; where none can, a text is cut.

        A keeps letters and digits apart from punctuation. White space starts a token of A where it follows a
        character that is none. B is searched for every such pair.
        """
        word = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]
        signs = [x for x in range(0x21, 0x7F) if x not in word]
        if any(piece[1:].strip(b" ").find(b" ") >= 0 or re.search(rb"[^ ] $", piece) for piece in self.bytes_b):
            raise ValueError("the second tokenizer has tokens with a space behind other characters")
        table = np.zeros((256, 256), bool)
        table[0x21:0x7F, [0x20, 0x0A]] = True
        table[np.ix_(word, signs)] = True
        for piece in self.bytes_b:
            table[list(piece[:-1]), list(piece[1:])] = False
        return table

    def learn(self, segments: list[bytes]) -> None:
        """Encode what is not remembered; None stands for a segment whose bytes a tokenizer does not give back."""
        texts = [x.decode() for x in segments]
        ids_a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # A line feed is a byte token: behind it a segment is encoded without the space that B adds to a text.
        ids_b = self.b.encode(["\n" + x for x in texts], num_threads=1)
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        for segment, a, b in zip(segments, ids_a, ids_b):
            b = b[2:]
            same = b"".join([bytes_a[i] for i in a]) == segment == b"".join([bytes_b[i] for i in b])
            self.known[segment] = (array("i", a).tobytes(), array("i", b).tobytes()) if same else None

    def encoded(self, segments: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        known = self.known
        if len(known) + len(segments) > REMEMBERED:
            known.clear()
        new = [x for x in segments if x not in known]
        for at in range(0, len(new), 20_000):
            self.learn(new[at : at + 20_000])
        return [known[x] for x in segments]


def _byte_level(tokenizer) -> list[bytes]:
    """Bytes of every entry: printable characters stand for themselves, the other bytes for 256 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in plain}
    byte |= {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in set(plain))}
    entries = [b""] * tokenizer.get_vocab_size()
    for piece, i in tokenizer.get_vocab().items():
        entries[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
    return entries


def _piece_bytes(piece: str) -> bytes:
    as_byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode()


@functools.cache
def _tokenizers(byte_level_file: str, piece_file: str) -> TwoTokenizers:
    return TwoTokenizers(byte_level_file, piece_file)


def tokenizers_of(byte_level_file: str, piece_file: str) -> TwoTokenizers:
    remembering("alignment", _tokenizers.cache_clear)
    return _tokenizers(byte_level_file, piece_file)


def segments_of(texts: pa.BinaryArray, cuts: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Segments of all texts, and the number of the text each belongs to; an empty text has none.

    A segment starts where ``cuts`` allows it, at a space or line feed behind a letter of two bytes (U+00C0 to
    U+07FF, none of which is white space or in a token with a space behind it), and at the start of a text.
    """
    data, bounds = text_bytes(texts)
    starts, lengths = bounds[:-1], np.diff(bounds)
    cut = np.zeros(len(data), bool)
    cut[1:] = cuts[data[:-1], data[1:]]
    letter = (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF) & (data[1:-1] >= 0x80)
    cut[2:] |= letter & ((data[2:] == 0x20) | (data[2:] == 0x0A))
    cut[starts[lengths > 0]] = True
    begins = np.flatnonzero(cut)
    parent = np.repeat(np.arange(len(texts)), lengths)[begins]
    ends = np.append(begins, len(data)).astype(np.int32)
    values = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
    return values, parent


def _side(lists: pa.ListArray, codes: np.ndarray, docs: np.ndarray, lengths: np.ndarray, name: str) -> pa.Table:
    """Document-end key and id of every token, in order."""
    taken = lists.take(pa.array(codes))
    ids = pc.list_flatten(taken)
    doc = docs[pc.list_parent_indices(taken).to_numpy()]
    ends = pc.cumulative_sum(pa.array(lengths[ids.to_numpy()])).to_numpy()
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    before = np.zeros(len(ids), np.int64)
    before[first[1:]] = ends[first[1:] - 1]
    ends = ends - np.maximum.accumulate(before)
    return pa.table({"key": (doc << OFFSET_BITS) + ends, name: ids})


class Links:
    """Rows of one block: links of documents, by document and pair of ids."""

    def __init__(self):
        self.docs: list[dict] = []
        self.tables: list[pa.Table] = []
        self.links = 0

    def flushed(self, block: int) -> dict:
        """Columns of the documents' rows, then one row with the block's pairs, their counts and the links."""
        counted = pa.concat_tables(self.tables).group_by(["row", "pair"], use_threads=False).aggregate([([], "count_all")]) if self.tables else pa.table(
            {"row": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "count_all": pa.array([], pa.int64())}
        )
        partial = counted.group_by("pair", use_threads=False).aggregate([("count_all", "sum")]).sort_by([("count_all_sum", "descending")])
        pairs = partial["pair"].combine_chunks()
        place = pc.index_in(counted["pair"].combine_chunks(), pairs).to_numpy().astype(np.int32)
        rows, times = counted["row"].to_numpy().astype(np.int32), counted["count_all"].to_numpy().astype(np.int32)
        order = np.lexsort((place, rows))
        links = pa.compress(np.concatenate([rows[order], place[order], times[order]]).tobytes(), codec="zstd", asbytes=True)
        n = len(self.docs) + 1
        columns = {"block": [block] * n, "row": [*range(n - 1), None]}
        for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
            columns[name] = [x[name] for x in self.docs] + [None]
        empty = [None] * (n - 1)
        return columns | {
            "pairs": [*empty, pairs.to_pylist()],
            "counts": [*empty, partial["count_all_sum"].to_pylist()],
            "links": [*empty, links],
            "n_distinct": [*empty, len(rows)],
        }


def align(own: TwoTokenizers, texts: pa.BinaryArray) -> tuple[dict[str, np.ndarray], list[str], Iterator[pa.Table]]:
    """Counts per text, SHA-256 of its groups, and tables (row, pair) of all links, pair being a * |B| + b.

    ``texts`` hold the space in front; an empty one has no tokens.
    """
    segments, parent = segments_of(texts, own.cuts)
    coded = segments.dictionary_encode()
    found = own.encoded(coded.dictionary.to_pylist())
    bad = np.array([x is None for x in found], bool)
    codes = coded.indices.to_numpy()
    spoilt = np.zeros(len(texts), bool)
    spoilt[parent[bad[codes]]] = True
    codes, parent = codes[~spoilt[parent]], parent[~spoilt[parent]]
    lists_a = int_lists([x[0] if x else b"" for x in found])
    lists_b = int_lists([x[1] if x else b"" for x in found])
    counts = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    hashes: dict[int, object] = {}
    tables = []
    for at in range(0, len(codes), SLICE):
        # A segment's end is a token's end on both sides, so slices of a document are aligned by themselves.
        part, docs = codes[at : at + SLICE], parent[at : at + SLICE].astype(np.int64)
        a = _side(lists_a, part, docs, own.length_a, "a")
        b = _side(lists_b, part, docs, own.length_b, "b")
        joined = a.join(b, "key", join_type="full outer", use_threads=False).combine_chunks()
        joined = joined.take(pc.sort_indices(joined["key"]))
        has_a, has_b = (joined[x].combine_chunks().is_valid().to_numpy(zero_copy_only=False) for x in "ab")
        both, row = has_a & has_b, joined["key"].to_numpy() >> OFFSET_BITS
        for name, rows in (("n_a", row[has_a]), ("n_b", row[has_b]), ("n_groups", row[both]), ("n_links", row)):
            counts[name] += np.bincount(rows, minlength=len(texts))
        id_a = pc.fill_null_backward(joined["a"]).to_numpy().astype(np.int64)
        id_b = pc.fill_null_backward(joined["b"]).to_numpy().astype(np.int64)
        tables.append(pa.table({"row": row, "pair": id_a * len(own.length_b) + id_b}))
        groups = pc.binary_join_element_wise(
            _joined(own.name_a.take(a["a"].combine_chunks()), both[has_a]), _joined(own.name_b.take(b["b"].combine_chunks()), both[has_b]), "|"
        )
        ends = row[both]
        first = np.flatnonzero(np.diff(ends, prepend=-1))
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(first, len(ends)).astype(np.int32)), groups), ";")
        for doc, text in zip(ends[first].tolist(), whole):
            text = text.as_buffer()
            if doc in hashes:
                hashes[doc].update(b";")
                hashes[doc].update(text)
            else:
                hashes[doc] = hashlib.sha256(text)
    digests = [hashes[i].hexdigest() if i in hashes else "" for i in range(len(texts))]
    return counts, digests, tables


def _joined(names: pa.Array, last: np.ndarray) -> pa.Array:
    """Names of each group with commas; ``last`` marks the last name of a group."""
    offsets = np.concatenate([[0], np.flatnonzero(last) + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names), ",")


ENCODED = (
    "block bigint, row int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, counts array<bigint>, links binary, n_distinct bigint"
)
ARROW = pa.schema(
    [("block", pa.int64()), ("row", pa.int32()), *[(x, pa.int64()) for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()),
     ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("links", pa.binary()), ("n_distinct", pa.int64())]
)


def encode(df: DataFrame, byte_level_file: str, piece_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of documents and of blocks (see ``Links.flushed``), by one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, block = tokenizers_of(byte_level_file, piece_file), 0, Links()
        base = TaskContext.get().partitionId() << 32
        for lot in lots(batches, LOT_BYTES):
            texts = lot["text"].combine_chunks()
            spaced = pc.binary_join_element_wise(b"", texts, b" ")
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar(b""), spaced)
            counts, digests, tables = align(own, texts)
            shift = len(block.docs)
            for at, doc_id in enumerate(lot["doc_id"].to_pylist()):
                block.docs.append({"doc_id": doc_id, "groups_sha256": digests[at]} | {k: int(v[at]) for k, v in counts.items()})
            for table in tables:
                block.tables.append(pa.table({"row": pc.add(table["row"], shift), "pair": table["pair"]}))
                block.links += table.num_rows
            if block.links >= BLOCK_LINKS:
                yield pa.RecordBatch.from_pydict(block.flushed(base + number), ARROW)
                number, block = number + 1, Links()
        if block.docs:
            yield pa.RecordBatch.from_pydict(block.flushed(base + number), ARROW)

    return id_and_bytes(df, id_column, text_column).mapInArrow(run, ENCODED)


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def pair_counts(encoded: DataFrame, width: int) -> DataFrame:
    """a, b, count of every linked pair of ids, and whether no pair of this b has a larger count."""
    partial = encoded.where(F.col("row").isNull()).select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    counted = partial.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("count"))
    best = Window.partitionBy("b")
    return (
        counted.select("pair", F.floor(F.col("pair") / width).cast("bigint").alias("a"), (F.col("pair") % width).alias("b"), "count")
        .withColumn("best", F.col("count") == F.max("count").over(best))
    )


def aligned(
    df: DataFrame, staging: Staging, byte_level_file: str, piece_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Per document its tokens, groups and links, and the corpus' pairs of ids with their counts.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent of its b, ties
    included), count_sum (counts of all links' pairs), groups_sha256. Pairs: a, b, count, best.
    Texts that are null or empty, and those a tokenizer does not give back byte for byte, have zeros and an empty
    string. A null doc_id stays null and repeated rows stay repeated, their links counting each time. Texts of any
    length are read whole. Other columns are not read, so their names do not matter; an empty table gives none.
    """
    encoded = staging.table(encode(df, byte_level_file, piece_file, id_column, text_column), "encoded")
    width = len(tokenizers_of(byte_level_file, piece_file).length_b)
    pairs = staging.table(pair_counts(encoded, width), "pairs")
    blocks = encoded.where(F.col("row").isNull())
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    facts = asked.join(pairs.select("pair", "count", "best"), "pair").select("block", "place", "count", "best")
    rows = encoded.select("block", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")

    def summed(rows: pa.Table, facts: pa.Table) -> pa.Table:
        """Rows and facts of one block, whose size BLOCK_LINKS bounds."""
        order = pc.sort_indices(facts["place"])
        count = facts["count"].take(order).to_numpy()
        best = facts["best"].take(order).to_numpy().astype(np.int64)
        held = rows.filter(pc.is_null(rows["row"]))["links"][0].as_buffer()
        docs = rows.filter(pc.is_valid(rows["row"])).sort_by("row")
        row, place, times = _unpacked(held)
        sums = np.zeros((2, docs.num_rows), np.int64)
        np.add.at(sums[0], row, times * best[place])
        np.add.at(sums[1], row, times * count[place])
        columns = {x: docs[x] for x in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        columns |= {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
        return pa.table({x.split()[0]: columns[x.split()[0]] for x in RESULT.split(", ")})

    documents = cogrouped(rows, facts, ["block"]).applyInArrow(summed, RESULT)
    return documents, pairs.select("a", "b", "count", "best")


def _unpacked(held: pa.Buffer) -> np.ndarray:
    """Rows, places and times of a block's links."""
    import zstandard

    reader = zstandard.ZstdDecompressor().decompressobj()
    return np.frombuffer(reader.decompress(held.to_pybytes()), np.int32).astype(np.int64).reshape(3, -1)
