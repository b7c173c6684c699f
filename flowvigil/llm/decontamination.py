"""Benchmark decontamination by a distributed positional inverted index.

The index has one row per word and segment: the places where the word stands in the segment, which is a run of
whole documents of bounded size. It is stored, so many benchmarks can be searched in it.

A phrase visits the segments that hold its rarest word, by the counts of the whole index. There its places, moved
by the word's offset in the phrase, are intersected with the moved places of the next rarer words until none or
all words are left. A proximity search chains the nearest places of the words before and behind the rarest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowvigil.llm.shared import cogrouped, id_and_bytes, lots, split_words
from flowvigil.staging import Staging

#: Bytes of text in a segment, about; a longer document is a segment of its own.
SEGMENT_BYTES = 12 << 20
#: Phrases that are searched in a segment by one task; more are dealt to further tasks.
LOT_PHRASES = 50_000
#: Words of a window.
WORDS = 10
#: Words for SQL functions: what is left when these characters separate.
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Bytes that belong to no word; bytes from 0x80 are parts of characters beyond ASCII.
APART = np.ones(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    APART[_low:_high] = False


INDEX = "segment bigint, word binary, n bigint, places binary, row int, doc_id bigint"
ARROW = pa.schema(
    [("segment", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("places", pa.binary()), ("row", pa.int32()), ("doc_id", pa.int64())]
)


def _segment(table: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
    """Rows of one segment: its words with their places, then its documents with their numbers of words."""
    words, sizes = split_words(table["text"].combine_chunks(), APART)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable").astype(np.int32)
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    by_word = pc.sort_indices(coded.dictionary)
    bounds = np.concatenate([[0], np.cumsum(counts)]) * 4
    places = pa.BinaryArray.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(order.tobytes())]
    )
    docs, n = table.num_rows, len(counts)
    columns = {
        "segment": pa.array(np.full(n + docs, number)),
        "word": pa.concat_arrays([coded.dictionary.take(by_word), pa.nulls(docs, pa.binary())]),
        "n": pa.concat_arrays([pa.array(counts.astype(np.int64)).take(by_word), pa.array(sizes.astype(np.int64))]),
        "places": pa.concat_arrays([places.take(by_word), pa.nulls(docs, pa.binary())]),
        "row": pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.arange(docs, dtype=np.int32))]),
        "doc_id": pa.concat_arrays([pa.nulls(n, pa.int64()), *table["doc_id"].chunks]),
    }
    yield from pa.table(columns, schema=ARROW).to_batches(max_chunksize=20_000)


def index(df: DataFrame, staging: Staging, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The stored index of all words of all whole texts.

    Rows with a word hold its count in the segment and its places there (32-bit numbers of words, in order); rows
    without a word are the documents of the segment in order, with their numbers of words. A null text has no
    words; a null doc_id stays null; repeated rows are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, lot in enumerate(lots(batches, SEGMENT_BYTES)):
            yield from _segment(lot.combine_chunks(), base + number)

    return staging.table(id_and_bytes(df, id_column, text_column).mapInArrow(run, INDEX), "postings")


def item_words(text: Column) -> Column:
    """Words of a text as an array, A-Z lower-cased; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, NOT_A_WORD), lambda w: w != "")


def windows(items: DataFrame, size: int = WORDS, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """item_id and words of every window of ``size`` consecutive words; of a shorter item, all its words.

    Rows without an item_id name no item and have none.
    """
    words = items.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("item_id"), item_words(F.col(text_column)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return words.where(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, size))).alias("words")
    ).distinct()


def _plans(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases all of whose words occur: id, words and the order of their offsets, rarest word first."""
    words = phrases.select("phrase", F.posexplode("words").alias("at", "word"))
    known = words.withColumn("word", F.col("word").cast("binary")).join(counts, "word")
    plan = known.groupBy("phrase").agg(
        F.sort_array(F.collect_list(F.struct("total", "at", "word"))).alias("steps")
    )
    return plan.join(phrases.select("phrase", F.size("words").alias("length")), "phrase").where(F.size("steps") == F.col("length"))


def _exact(steps: list, places: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every occurrence of a phrase; steps are (offset, word), rarest first."""
    offset, word = steps[0]
    starts = places[word] - offset
    for offset, word in steps[1:]:
        if not len(starts):
            break
        other = places.get(word)
        if other is None:
            return starts[:0], starts[:0]
        at = np.searchsorted(other, starts + offset)
        starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == starts + offset)]
    return starts, starts + len(steps) - 1


def _near(steps: list, places: dict[bytes, np.ndarray], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the tightest occurrence around each place of the rarest word."""
    anchor, word = steps[0]
    first = last = places[word]
    by_offset = {offset: places.get(word) for offset, word in steps}
    if any(x is None for x in by_offset.values()):
        return first[:0], first[:0]
    for offset in range(anchor + 1, len(steps)):
        other = by_offset[offset]
        at = np.searchsorted(other, last, "right")
        keep = at < len(other)
        first, last = first[keep], other[at[keep]]
    for offset in range(anchor - 1, -1, -1):
        other = by_offset[offset]
        at = np.searchsorted(other, first) - 1
        keep = at >= 0
        first, last = other[at[keep]], last[keep]
    keep = last - first + 1 - len(steps) <= slop
    return first[keep], last[keep]


FOUND = "segment bigint, row int, phrase bigint, first array<int>, last array<int>"


def search(postings: DataFrame, phrases: DataFrame, staging: Staging, slop: int = 0) -> DataFrame:
    """Occurrences of phrases (``phrase`` bigint, ``words`` array) in the index, a row per document and phrase.

    Columns: segment and row of the document, phrase, and the first and last place (numbers of words in the
    document) of each occurrence. With ``slop`` 0 the words stand side by side; otherwise in order with at most so
    many other words between them, and an occurrence is the tightest one around a place of the rarest word.
    """
    held = postings.where(F.col("word").isNotNull())
    # A staged table has a known size: few words are sent to the index, and many are shuffled with it.
    asked = phrases.select(F.explode("words").alias("word")).distinct().select(F.col("word").cast("binary").alias("word"))
    asked = staging.table(asked.coalesce(1) if phrases.count() < LOT_PHRASES else asked, "asked")
    relevant = staging.table(held.select("segment", "word", "n", "places").join(asked, "word"), "relevant")
    counts = relevant.groupBy("word").agg(F.sum("n").alias("total"))
    plans = staging.table(_plans(phrases, counts), "plans")
    lots = max(1, -(-plans.count() // LOT_PHRASES))
    rarest = plans.select(
        (F.pmod(F.xxhash64("phrase"), F.lit(lots))).alias("lot"), "phrase", "steps", F.col("steps")[0]["word"].alias("word")
    )
    # A phrase goes to the segments of its rarest word; it carries its steps as two short lists.
    visits = relevant.select("segment", "word").join(rarest, "word").select(
        "segment", "lot", "phrase", F.col("steps.at").alias("at"), F.col("steps.word").alias("words")
    )
    each_lot = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lots - 1).cast("bigint")))
    lists = relevant.select("segment", "word", "places", F.lit(None).cast("int").alias("row"), F.lit(None).cast("bigint").alias("n")).unionByName(
        postings.where(F.col("word").isNull()).select("segment", F.lit(None).cast("binary").alias("word"), F.lit(None).cast("binary").alias("places"), "row", "n")
    ).withColumn("lot", each_lot)

    def find(visits: pa.Table, lists: pa.Table) -> pa.Table:
        """Phrases of a lot in one segment, whose size SEGMENT_BYTES bounds."""
        words = lists.filter(pc.is_valid(lists["word"]))
        places = {w: np.frombuffer(p, np.int32) for w, p in zip(words["word"].to_pylist(), words["places"].to_pylist())}
        sizes = lists.filter(pc.is_null(lists["word"])).sort_by("row")["n"].to_numpy()
        starts = np.concatenate([[0], np.cumsum(sizes)])
        out = {"row": [], "phrase": [], "first": [], "last": []}
        for phrase, at, own in zip(*(visits[x].to_pylist() for x in ("phrase", "at", "words"))):
            steps = list(zip(at, own))
            first, last = _near(steps, places, slop) if slop else _exact(steps, places)
            if not len(first):
                continue
            row = np.searchsorted(starts, first, "right") - 1
            inside = last < starts[row + 1]
            first, last, row = first[inside], last[inside], row[inside]
            bounds = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
            for a, b in zip(bounds[:-1], bounds[1:]):
                out["row"].append(row[a])
                out["phrase"].append(phrase)
                out["first"].append(first[a:b] - starts[row[a]])
                out["last"].append(last[a:b] - starts[row[a]])
        segment = visits["segment"][0].as_py() if visits.num_rows else 0
        kinds = {"row": pa.int32(), "phrase": pa.int64(), "first": pa.list_(pa.int32()), "last": pa.list_(pa.int32())}
        return pa.table({"segment": pa.array([segment] * len(out["row"]), pa.int64())} | {k: pa.array(v, kinds[k]) for k, v in out.items()})

    return cogrouped(visits, lists, ["segment", "lot"]).applyInArrow(find, FOUND)


def contamination(
    df: DataFrame,
    items: DataFrame,
    staging: Staging,
    size: int = WORDS,
    slop: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """What each document holds of the items' windows of ``size`` words.

    Columns: doc_id, n_words, n_hit (words inside any occurrence of a window), n_items (items of which a window
    occurs), items_sha256 (of their ids, sorted as strings, with commas), contaminated (n_hit above 0). ``slop``
    lets windows occur with so many other words in between; they count as hit.

    A null or empty text has no words. A null doc_id stays null; repeated rows stay repeated. Rows of the same
    item_id are one item; rows without one are left out. Texts are read whole, other columns not at all, so their
    names do not matter. No items: nothing is hit. No documents: no rows.
    """
    postings = index(df, staging, id_column, text_column)
    of_items = staging.table(windows(items, size).withColumn("phrase", F.xxhash64("words")), "windows")
    phrases = of_items.groupBy("words").agg(F.min("phrase").alias("phrase"))
    if phrases.agg(F.count("*") == F.countDistinct("phrase")).first()[0] is False:
        raise RuntimeError("two windows have the same 64-bit hash")
    found = staging.table(search(postings, phrases, staging, slop), "found")
    document = ["segment", "row"]
    spans = found.select(*document, F.explode(F.arrays_zip("first", "last")).alias("x")).select(*document, "x.first", "x.last")
    earlier = Window.partitionBy(*document).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("last") - F.greatest(F.col("first") - 1, F.coalesce(F.max("last").over(earlier), F.lit(-1)))
    hit = spans.distinct().select(*document, F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy(*document).agg(F.sum("fresh").cast("bigint").alias("n_hit"))
    named = found.select(*document, "phrase").join(of_items.select("phrase", "item_id"), "phrase").select(*document, F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy(*document).agg(F.sort_array(F.collect_list("item")).alias("items"))
    docs = postings.where(F.col("word").isNull()).select(*document, "doc_id", F.col("n").alias("n_words"))
    joined = docs.join(hit, document, "left").join(listed, document, "left")
    items_of = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
