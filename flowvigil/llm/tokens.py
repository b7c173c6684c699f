"""Exact token counts of every prefix of a text, without encoding the prefixes.

``last[j]`` is the last token of the encoding of the first ``j`` characters, and the encoding
of that prefix is the encoding of its first ``j - len(last[j])`` characters plus that token.
Of the tokens that end at ``j``, exactly one goes with the last token before it, that is: the two,
joined and encoded, give the two again. So counts come from a dynamic program over prefixes.

The program runs per segment. A text is cut before each run of spaces and between two
characters that are neighbours in no token: no merge crosses such a cut, so segments are
encoded independently and their tables are joined. A worker keeps the tables of segments.

The table of a text has one signed byte per character: how much the count changes when that
character joins the prefix. Running sums of it answer truncation and budget questions.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowvigil.llm.shared import map_batches, remembering

SPACE = "▁"
#: Segments, their parts and pairs of tokens that a worker remembers before it starts afresh.
REMEMBERED = 300_000
REMEMBERED_PARTS = 600_000


class PrefixCounter:
    """Prefix tables of texts under a sentencepiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=model_file)
        encoder, plain = self.encoder, []
        for i in range(encoder.get_piece_size()):
            if not (encoder.is_control(i) or encoder.is_unknown(i) or encoder.is_byte(i) or encoder.is_unused(i)):
                plain.append(encoder.id_to_piece(i))
        if any(SPACE in piece.lstrip(SPACE) for piece in plain):
            raise ValueError("tokens of this model go on past a space; cuts at spaces would not be exact")
        self.pieces = set(plain)
        # By their last three characters (or fewer): the lengths of the tokens, longest first.
        ends: dict[str, set[int]] = {}
        for piece in plain:
            ends.setdefault(piece[-3:], set()).add(len(piece))
        self.ends = {end: sorted(lengths, reverse=True) for end, lengths in ends.items()}
        self.neighbours = {piece[i : i + 2] for piece in plain for i in range(len(piece) - 1)}
        self.goes_with: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _pieces_of(self, text: str) -> list[str]:
        """Encoding of text that stands after something: a line feed, which is a byte, keeps the added space away."""
        return self.encoder.encode("\n" + text, out_type=str)[2:]

    def _fits(self, before: str, token: str) -> bool:
        key = (before, token)
        known = self.goes_with.get(key)
        if known is None:
            if len(self.goes_with) >= REMEMBERED_PARTS:
                self.goes_with.clear()
            joined = self._pieces_of(before + token)
            known = self.goes_with[key] = (
                joined == [before, token]
                if before in self.pieces and token in self.pieces
                else joined == [*self._alone(before), *self._alone(token)]
            )
        return known

    @functools.lru_cache(1 << 17)  # noqa: B019
    def _alone(self, token: str) -> tuple[str, ...]:
        return (token,) if token in self.pieces else tuple(self._pieces_of(token))

    @functools.lru_cache(1 << 17)  # noqa: B019
    def _encodes_to_itself(self, token: str) -> bool:
        return len(token) == 1 or self._pieces_of(token) == [token]

    def _part(self, text: str) -> bytes:
        """Dynamic program over one segment without safe cuts inside."""
        last, counts, pieces, fits, ends = [""], [0], self.pieces, self.goes_with, self.ends
        for end in range(1, len(text) + 1):
            for width in (*(ends.get(text[end - 3 : end], ()) if end > 2 else ()), 2, 1):
                start = end - width
                token = text[max(start, 0) : end]
                if start < 0 or token not in pieces and width > 1:
                    continue
                before = last[start]
                if before:
                    good = fits.get((before, token))
                    if good is None:
                        good = self._fits(before, token)
                else:
                    good = self._encodes_to_itself(token)
                if good:
                    # A character that is no token is written as its bytes.
                    last.append(token)
                    counts.append(counts[start] + (1 if token in pieces else len(self._alone(token))))
                    break
            else:
                raise AssertionError(f"no token ends {text[:end]!r}")
        return bytes([(b - a) % 256 for a, b in zip(counts, counts[1:])])

    def _segment(self, text: str) -> bytes:
        """Table of a run of spaces and what follows it."""
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in self.neighbours]
        tables = []
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            part = text[a:b]
            table = self.parts.get(part)
            if table is None:
                if len(self.parts) >= REMEMBERED_PARTS:
                    self.parts.clear()
                table = self.parts[part] = self._part(part)
            tables.append(table)
        return b"".join(tables)

    def deltas(self, text: str) -> bytes:
        """One signed byte per character; the added space counts with the first one."""
        if not text:
            return b""
        whole, tables = self.whole, []
        for segment in re.findall(r"▁*[^▁]+|▁+", SPACE + text.replace(" ", SPACE)):
            table = whole.get(segment)
            if table is None:
                if len(whole) >= REMEMBERED:
                    whole.clear()
                table = self._segment(segment)
                if len(segment) < 200:
                    whole[segment] = table
            tables.append(table)
        joined = b"".join(tables)
        return bytes([(joined[0] + joined[1]) % 256]) + joined[2:]


@functools.cache
def _counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def counter(model_file: str) -> PrefixCounter:
    """The worker's counter for a model."""
    remembering("tokens", _counter.cache_clear)
    return _counter(model_file)


def counts_at(deltas: bytes) -> np.ndarray:
    """Token count of every non-empty prefix, shortest first."""
    return np.cumsum(np.frombuffer(deltas, dtype=np.int8), dtype=np.int64)


def characters_within(counts: np.ndarray, budget: int) -> int:
    """Length of the longest prefix of at most ``budget`` tokens."""
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) + 1 if len(fitting) else 0


def _mapped(df: DataFrame, id_column: str, text_column: str, schema: str, fields: list, make: Callable) -> DataFrame:
    rows = df.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    arrow = pa.schema([("doc_id", pa.int64()), *fields])

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), **make(batch.column("text"))}

    return map_batches(rows, run, f"doc_id bigint, {schema}", arrow)


def prefix_tables(
    df: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and ``deltas`` (see the module) of every whole text; ``counts_at`` reads them."""

    def make(texts: pa.Array) -> dict:
        own = counter(model_file)
        return {"deltas": [own.deltas(x) for x in texts.to_pylist()]}

    return _mapped(df, id_column, text_column, "deltas binary", [("deltas", pa.binary())], make)


def token_counts(
    df: DataFrame,
    model_file: str,
    budgets: Sequence[int] = (4096,),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Counts of every whole text, answered from its prefix table.

    Columns: doc_id, n_bytes, n_tokens, and per budget ``over_<b>`` and ``kept_chars_<b>``, the
    length of the longest prefix within it. A null text counts as empty, with no tokens. A null
    doc_id stays null; repeated rows stay repeated. Texts of any length are read whole.
    """
    schema = "n_bytes bigint, n_tokens bigint" + "".join(
        f", over_{b} boolean, kept_chars_{b} bigint" for b in budgets
    )
    fields = [("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
    for b in budgets:
        fields += [(f"over_{b}", pa.bool_()), (f"kept_chars_{b}", pa.int64())]

    def make(texts: pa.Array) -> dict:
        own, out = counter(model_file), {name: [] for name, _ in fields}
        for text in texts.to_pylist():
            counts = counts_at(own.deltas(text))
            total = int(counts[-1]) if len(counts) else 0
            out["n_bytes"].append(len(text.encode()))
            out["n_tokens"].append(total)
            for b in budgets:
                out[f"over_{b}"].append(total > b)
                out[f"kept_chars_{b}"].append(len(text) if total <= b else characters_within(counts, b))
        return out

    return _mapped(df, id_column, text_column, schema, fields, make)
