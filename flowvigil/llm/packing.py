"""Harmonic packing of documents into training sequences.

Every class of pieces is a reciprocal of the capacity: pieces of class ``k`` are at most
``capacity / k`` long, and a bin of that class takes exactly ``k`` of them. A worker fills the bins
of its own rows and needs nothing of the others.

Documents may be cut, so long pieces are cut to the reciprocals that are powers of two: 4096,
2048, ... down to ``SMALLEST``, which fill their bins without padding. What is left of a document
is shorter than ``SMALLEST`` and goes to class ``capacity // length``, where less than one piece's
length of a bin is padding. Bins that are not full when a worker's rows end are emptied into one
stream, which is cut at the capacity and, at its end, into powers of two.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections import ChainMap
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from flowvigil.llm.shared import id_and_bytes, int_lists, lots, remembering, split_words

CAPACITY = 4096
SMALLEST = 64
#: Chunks of text whose ids a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: Signs and letters below U+017F whose lower case and normal form are plain; no white space, no controls.
PLAIN = regex.compile("[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u0148\u014a-\u017e]+")
#: Bytes of text whose chunks are looked up together.
LOT_BYTES = 4 << 20
#: Pieces in one output batch.
BATCH = 20_000

Encode = Callable[[bytes], bytes]


class ChunkEncoder:
    """Ids of a whole text from the ids of its chunks between ASCII white space.

    For BPE tokenizers that drop white space and never merge or match across it; then chunks are
    encoded alike alone and in their text, special strings included. Chunks of plain Latin letters are cut
    further by the tokenizer's own pattern. Parts not seen before are encoded many at once, with a space
    between; as the last token of a part is one that ends a word, the ids can be told apart.
    """

    def __init__(self, tokenizer_file: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        if self._ids(" a  b\n") != self._ids("a") + self._ids("b"):
            raise ValueError("this tokenizer keeps white space; its texts can't be encoded in chunks")
        described = json.loads(self.tokenizer.to_str())
        self.pattern = regex.compile(described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        suffix = described["model"]["end_of_word_suffix"]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.chunks: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.end = np.array([end_id], dtype="<u4").tobytes()
        # Between a letter and a sign the pattern always cuts.
        letters = [*range(0x41, 0x5B), *range(0x61, 0x7B)]
        signs = [x for x in range(0x21, 0x7F) if x not in letters and not 0x30 <= x < 0x3A]
        self.cuts = np.zeros((256, 256), bool)
        self.cuts[np.ix_(letters, signs)] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _new_parts(self, parts: list[str]) -> None:
        if len(self.parts) + len(parts) > REMEMBERED:
            self.parts.clear()
        lines = [" ".join(parts[at : at + 100]) for at in range(0, len(parts), 100)]
        ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts) or stops[-1] != len(ids):
            for part in parts:
                self.parts[part] = np.array(self._ids(part), dtype="<u4").tobytes()
            return
        whole = ids.tobytes()
        for part, a, b in zip(parts, [0, *stops[:-1].tolist()], stops.tolist()):
            self.parts[part] = whole[4 * a : 4 * b]

    def _new_chunks(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        cut: dict[bytes, list[str]] = {}
        out: dict[bytes, bytes] = {}
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            if text.isalpha() and (text.isascii() or PLAIN.fullmatch(text)):
                cut[chunk] = [text.lower()]
            elif PLAIN.fullmatch(text) and "<|" not in text:
                cut[chunk] = self.pattern.findall(text.lower())
            else:
                out[chunk] = np.array(self._ids(text), dtype="<u4").tobytes()
        wanted = {part for parts in cut.values() for part in parts}
        known = self.parts
        missing = [part for part in wanted if part not in known]
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                missing = list(wanted)
            self._new_parts(missing)
        for chunk, parts in cut.items():
            out[chunk] = b"".join([known[part] for part in parts])
        return out

    def __call__(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of the text, then the end id."""
        chunks, known, fresh = text.split(), self.chunks, {}
        missing = set(chunks).difference(known)
        if missing:
            fresh = self._new_chunks(missing)
            if len(known) + len(fresh) > REMEMBERED:
                fresh.update((x, known[x]) for x in set(chunks) if x in known)
                known.clear()
            known.update((x, ids) for x, ids in fresh.items() if len(x) < 200)
            if any(x not in known for x in fresh):
                known = ChainMap(known, fresh)
        return b"".join([*map(known.__getitem__, chunks), self.end])

    def encoded(self, texts: pa.BinaryArray) -> Iterator[bytes]:
        """What the call gives for each text; chunks that texts share are looked up once."""
        chunks, sizes = split_words(texts, cuts=self.cuts)
        coded = chunks.dictionary_encode()
        distinct, known, fresh = coded.dictionary.to_pylist(), self.chunks, {}
        missing = {x for x in distinct if x not in known}
        if missing:
            fresh = self._new_chunks(missing)
        lists = int_lists([known[x] if x in known else fresh[x] for x in distinct])
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
        known.update((x, ids) for x, ids in fresh.items() if len(x) < 200)
        counts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy()[coded.indices.to_numpy()])])
        ids = pc.list_flatten(lists.take(coded.indices)).to_numpy()
        bounds = counts[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        # A special string would be cut at its signs.
        special = pc.match_substring(texts, "<|").to_pylist()
        for at, (a, b) in enumerate(zip(bounds, bounds[1:])):
            yield self(texts[at].as_py()) if special[at] else ids[a:b].tobytes() + self.end


@functools.cache
def _chunk_encoder(tokenizer_file: str, end_id: int) -> ChunkEncoder:
    return ChunkEncoder(tokenizer_file, end_id)


def chunk_encoder(tokenizer_file: str, end_id: int) -> ChunkEncoder:
    """The worker's encoder for a tokenizer."""
    remembering("packing", _chunk_encoder.cache_clear)
    return _chunk_encoder(tokenizer_file, end_id)


class Packer:
    """Bins of one worker. A piece is (doc_id, document's ids, start, its own ids as bytes)."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, smallest: int = SMALLEST):
        if capacity & (capacity - 1) or smallest & (smallest - 1) or not smallest <= capacity:
            raise ValueError("capacity and smallest are powers of two")
        self.next, self.capacity, self.smallest = first_sequence, capacity, smallest
        self.bins: dict[int, list[tuple]] = {}

    def _emit(self, pieces: list[tuple]) -> list[tuple]:
        """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of a full bin."""
        rows, offset = [], 0
        for doc_id, tokens, start, ids in pieces:
            length = len(ids) // 4
            rows.append((doc_id, start, length, zlib.crc32(ids), tokens, self.next, offset, ids))
            offset += length
        self.next += 1
        return rows

    def add(self, doc_id: object, ids: bytes) -> list[tuple]:
        """Cut a document; rows of the bins that became full."""
        rows, start, size, tokens = [], 0, self.capacity, len(ids) // 4
        while start < tokens:
            left = tokens - start
            while size > left and size > self.smallest:
                size //= 2
            length = min(size, left)
            fixed = self.capacity // length
            held = self.bins.setdefault(fixed, [])
            held.append((doc_id, tokens, start, ids[4 * start : 4 * (start + length)]))
            if len(held) == fixed:
                rows += self._emit(self.bins.pop(fixed))
            start += length
        return rows

    def rest(self) -> list[tuple]:
        """Rows of all bins that are not full, their pieces cut anew."""
        left = [piece for fixed in sorted(self.bins) for piece in self.bins[fixed]]
        total = sum(len(ids) // 4 for *_, ids in left)
        self.bins = {}

        def largest() -> int:
            return 1 << (min(total, self.capacity).bit_length() - 1) if total else 0

        rows, held, room = [], [], largest()
        for doc_id, tokens, start, ids in left:
            while ids:
                part = min(len(ids) // 4, room)
                held.append((doc_id, tokens, start, ids[: 4 * part]))
                start, ids, room, total = start + part, ids[4 * part :], room - part, total - part
                if not room:
                    rows += self._emit(held)
                    held, room = [], largest()
        return rows


def pack(
    df: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
    number_rows: bool = False,
) -> DataFrame:
    """Pack whole documents; one row per piece.

    Columns: doc_id, start and length (of the piece among the document's ids), ids_crc32,
    doc_tokens, sequence_id, offset, and with ``keep_ids`` the piece's ids as ``ids`` (little-endian
    unsigned 32-bit), and with ``number_rows`` ``row``, one number for each row of ``df`` that has its
    pieces. A null or empty text is the end id alone. A null doc_id stays null and
    repeated rows are documents of their own. A sequence is a run of a task's rows: its id holds
    the task's partition, so a task that runs again gives the same ids.
    """
    fields = [("doc_id", pa.int64())] + [
        (name, pa.int64()) for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ]
    if keep_ids:
        fields.append(("ids", pa.binary()))
    if number_rows:
        fields.insert(0, ("row", pa.int64()))
    arrow = pa.schema(fields)
    schema = ", ".join(f"{name} {'binary' if name == 'ids' else 'bigint'}" for name, _ in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_encoder(tokenizer_file, end_id)
        packer = Packer(TaskContext.get().partitionId() << 36, capacity)
        rows: list[tuple] = []
        number = TaskContext.get().partitionId() << 36

        def batch() -> pa.RecordBatch:
            # The ids, last in a row, are left off unless they are asked for.
            found = [(*row[0][::-1], *row[1:]) for row in rows] if number_rows else rows
            columns = [pa.array(column, field.type) for column, field in zip(zip(*found), arrow)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for given in lots(batches, LOT_BYTES):
            for doc_id, ids in zip(given["doc_id"].to_pylist(), encode.encoded(given["text"].combine_chunks())):
                rows += packer.add((doc_id, number) if number_rows else doc_id, ids)
                number += 1
                if len(rows) >= BATCH:
                    yield batch()
        rows += packer.rest()
        if rows:
            yield batch()

    return id_and_bytes(df, id_column, text_column).mapInArrow(run, schema)
