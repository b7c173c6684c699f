"""SpotSigs fingerprints: chains of content words that follow common words.

Every occurrence of a common word (an anchor) starts a chain: the anchor and the next
``CHAIN`` words that are not common. A text's fingerprint is the set of its chains, each a
32-bit hash, written as base64 of the sorted little-endian values; two fingerprints are as alike as
their sets (Jaccard). A text without a chain has the hash of all its words as its only member,
or, without words, of its characters: only an equal text is then like it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from flowvigil.llm.shared import map_batches, remembering, shuffle_width, small_batches
from flowvigil.staging import Staging

#: Common words of English, French, German and Spanish.
ANCHORS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its of on or she that the their they "
    "this to was we were which with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur lui mais ne ou par pas pour qu que qui sa se "
    "ses son sont sur un une "
    "als am auf aus bei bin da dass dem den der die ein eine einem einen einer er es für ich ihr im ist mit nach nicht "
    "sie sind so und vom von war wie zu zum zur "
    "al como con del el ella ellos era eran esta este ha hay las lo los más me mi muy no nos o para pero por porque "
    "si sin su sus te todo y ya yo".split()
)
CHAIN = 2
WORD = re.compile(r"\w+")
#: Odd multipliers that keep a chain's order.
FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64
)
REMEMBERED = 300_000
_HASHES: dict[str, int] = {}


def _word_hashes(words: list[str]) -> np.ndarray:
    remembering("spotsigs", _HASHES.clear)
    known = _HASHES
    missing = {w for w in words if w not in known}
    if missing:
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = set(words)
        # An anchor's hash is odd, that of any other word even.
        known.update((w, xxh64_intdigest(w) & ~1 | (w in ANCHORS)) for w in missing)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def signature_set(text: str) -> np.ndarray:
    """Sorted distinct 32-bit chain hashes of a whole text, never empty."""
    words = WORD.findall(text.lower())
    if words:
        hashes = _word_hashes(words)
        anchor = (hashes & np.uint64(1)).astype(bool)
        content = hashes[~anchor]
        at = np.flatnonzero(anchor)
        following = at - np.arange(len(at))  # content words before the anchor
        good = following + CHAIN <= len(content)
        at, following = at[good], following[good]
        if len(at):
            mixed = hashes[at] * FACTORS[0]
            for i in range(CHAIN):
                mixed = (mixed ^ (mixed >> np.uint64(29))) + content[following + i] * FACTORS[i + 1]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * FACTORS[0]
            return np.unique((mixed >> np.uint64(32)).astype("<u4"))
    alone = "w" + " ".join(words) if words else "c" + text
    return np.array([xxh64_intdigest(alone) >> 32], dtype="<u4")


def written(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of distinct values."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_signatures and signatures (ascending, as bigint) of every row; null is empty."""
    rows = df.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    arrow = pa.schema([("doc_id", pa.int64()), ("n_signatures", pa.int64()), ("signatures", pa.list_(pa.int64()))])

    def run(batch: pa.RecordBatch) -> dict:
        sets = [signature_set(x).astype(np.int64) for x in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n_signatures": list(map(len, sets)), "signatures": sets}

    return map_batches(rows, run, "doc_id bigint, n_signatures bigint, signatures array<bigint>", arrow)


def similar_sets(df: DataFrame, staging: Staging, least: float = 0.8, **columns) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): every document's class, and all pairs of classes of Jaccard ``least`` or more.

    members: doc_id and class_id, the smallest doc_id with the same signature set; copies are one class.
    pairs: class_id, other_id (larger), likeness. Texts as in ``fingerprints``; null ids take no part.

    Sets are partitioned by length: a length class spans a factor of 1 / least, so alike sets lie in one
    class or in neighbours. Within it only sets that share one of their rarest signatures meet, few enough that
    without any of them the likeness can't be reached; pairs whose lengths rule it out are pruned before
    the sets are compared.
    """
    docs = staging.table(fingerprints(df, **columns).where(F.col("doc_id").isNotNull()), "signatures")
    sets = docs.groupBy("signatures").agg(F.min("doc_id").alias("class_id"), F.first("n_signatures").alias("n"))
    sets = staging.table(sets, "signature-sets")
    members = docs.join(sets, "signatures").select("doc_id", "class_id")
    spread = sets.select("class_id", "n", F.explode("signatures").alias("signature"))
    counts = spread.groupBy("signature").agg(F.count("*").alias("held_by"))
    # A window holds one set.
    rarest = Window.partitionBy("class_id").orderBy("held_by", "signature")
    prefix = (
        spread.join(counts, "signature")
        .where(F.col("held_by") > 1)
        .withColumn("place", F.row_number().over(rarest))
    )
    # The signatures that no other set holds stand before all others.
    alone = F.col("n") - F.count("*").over(Window.partitionBy("class_id"))
    prefix = prefix.withColumn("place", F.col("place") + alone).where(
        F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1
    )
    length_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(least)) + 1e-9)
    placed = prefix.select("class_id", "n", "signature", length_class.alias("length"))
    shorter = placed.select(
        F.col("class_id").alias("other"), F.col("n").alias("m"), "signature",
        F.explode(F.array("length", F.col("length") + 1)).alias("length"),
    )
    fits = (F.col("m") >= F.col("n") * least - 1e-9) & (
        (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("other") < F.col("class_id")))
    )
    met = placed.join(shorter, ["signature", "length"]).where(fits).select("class_id", "other").distinct()
    one = sets.select("class_id", F.col("signatures").alias("a"))
    two = sets.select(F.col("class_id").alias("other"), F.col("signatures").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    alike = met.join(one, "class_id").join(two, "other").withColumn(
        "likeness", shared / (F.size("a") + F.size("b") - shared)
    )
    pairs = alike.where(F.col("likeness") >= least).select(
        F.least("class_id", "other").alias("class_id"), F.greatest("class_id", "other").alias("other_id"), "likeness"
    )
    return members, pairs


def with_next(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Compare every text with its edited text and with the next document's text.

    The next document is the one after it by ascending doc_id (equal ids: by text; a null id
    stands before all others); the first follows the last. Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts are
    empty. A table of one row follows itself; an empty table gives an empty result.

    Rows are dealt in id order to ranges, whose borders are one id per shuffle partition. The
    first document of a range is also sent to the range before it, so every range has all
    it needs and no row is held longer than until the next one is read.
    """
    rows = small_batches(df).select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    width = shuffle_width(df.sparkSession)
    order = F.coalesce("doc_id", F.lit(-(2**63)))
    ids = rows.select(order.alias("at"))
    borders = ids.agg(F.percentile_approx("at", [i / width for i in range(1, width)], 10_000)).first()[0] or []
    inner = F.array(*[F.lit(int(x)).cast("bigint") for x in sorted(set(borders))]).cast("array<bigint>")

    def range_of(value: F.Column) -> F.Column:
        return F.size(F.filter(inner, lambda border: border <= value)).cast("int")

    # At most one row per range.
    firsts = ids.groupBy(range_of(F.col("at")).alias("range")).agg(F.min("at").alias("at")).collect()
    firsts = sorted((r["range"], r["at"]) for r in firsts)
    before = {at: firsts[i - 1][0] for i, (_, at) in enumerate(firsts)}
    lent = F.lit(None).cast("int")
    if before:
        lender = F.create_map(*[x for at, held in before.items() for x in (F.lit(at).cast("bigint"), F.lit(held))])
        lent = F.try_element_at(lender, order)
    own = F.struct(range_of(order).alias("range"), F.lit(False).alias("lent"))
    borrowed = F.struct(lent.alias("range"), F.lit(True).alias("lent"))
    places = F.when(lent.isNull(), F.array(own)).otherwise(F.array(own, borrowed))
    dealt = rows.select("doc_id", "text", F.explode(places).alias("place")).select(
        "doc_id", "text", "place.range", "place.lent"
    )
    sorted_rows = dealt.repartitionByRange(width, "range").sortWithinPartitions("range", "lent", "doc_id", "text")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    arrow = pa.schema(list(zip(names, kinds)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, out = None, []
        for batch in batches:
            for doc_id, text, place, is_lent in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if pending and pending[0] == place:
                    _, own_id, own_text, own_set = pending
                    own_set = signature_set(own_text) if own_set is None else own_set
                    next_set = signature_set(text)
                    new_text = edited(own_text, text)
                    new_set = signature_set(new_text)
                    out.append(
                        (
                            own_id,
                            len(own_text),
                            hashlib.sha256(new_text.encode()).hexdigest(),
                            written(own_set),
                            written(new_set),
                            likeness(own_set, new_set),
                            likeness(own_set, next_set),
                        )
                    )
                else:
                    next_set = None
                # Of the lent rows only the first has a place after the range's own last row.
                pending = None if is_lent else (place, doc_id, text, next_set)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema=arrow)
                out = []

    return sorted_rows.mapInArrow(
        compare,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
