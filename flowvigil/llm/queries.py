"""The registered queries of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowvigil.llm import alignment, decontamination, extraction, manifest, mixing, packing, passages, pseudo_likelihood, quality, simhash, spotsigs, tokens, topk
from flowvigil.llm.shared import table
from flowvigil.llm.stages import END_ID, QUALITY_BOUND
from flowvigil.staging import Staging

TOKEN_LIMIT = 4096
#: Slots of 128 words in an output shard of the mix.
MIX_SHARD = 1024


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"), Staging(spark))
    return quality.score(docs, model).withColumn(
        "predicted", F.when(F.col("score") >= QUALITY_BOUND, 1).otherwise(0)
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokens.token_counts(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), (TOKEN_LIMIT,)
    )
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        F.col(f"over_{TOKEN_LIMIT}").alias("over_limit"),
        F.col(f"kept_chars_{TOKEN_LIMIT}").alias("kept_chars"),
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeats(table(spark, folder, "documents"), Staging(spark))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), Staging(spark))


def op5_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID
    )


def op6_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.with_next(table(spark, folder, "documents"))


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), Staging(spark), shard_slots=MIX_SHARD)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "n_shards")


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extraction.extract(pages, extraction.fit(pages, Staging(spark)))


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), Staging(spark), F.col("vec_id") % 50 == 0)


def op10_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.fit_and_score(table(spark, folder, "documents"), Staging(spark))


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned(docs, Staging(spark), *files)[0]


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.document_proofs(table(spark, folder, "documents"), Staging(spark))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), Staging(spark))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_simhash": op4_simhash,
    "op5_harmonic_packing": op5_harmonic_packing,
    "op6_spotsigs": op6_spotsigs,
    "op7_source_mixing": op7_source_mixing,
    "op8_html_extraction": op8_html_extraction,
    "op9_topk": op9_topk,
    "op10_pseudo_likelihood": op10_pseudo_likelihood,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_decontamination": op13_decontamination,
}



def _scrambled(x: str) -> str:
    return f"list_reduce([({x}) % 2147483648, 16, 15, 13]::BIGINT[], lambda h, n: (xor(h, h >> n) * 73244475) % 2147483648)"


#: The same rules over plain windows: water line, draws of all slots, their correction, the permutation and the words of every slot.
OP7_SQL = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM by_source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + rank % 3]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS most FROM ranked),
leveled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (
      ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
line AS (SELECT arg_min(level, most / weight) AS line FROM leveled WHERE most / weight > level),
targets AS (
  SELECT rank, source, source_size,
    CASE WHEN most / weight <= level THEN most ELSE line * weight END AS target FROM leveled LEFT JOIN line ON true),
counted AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words, ((source_size + 127) // 128)::BIGINT AS blocks FROM targets WHERE source_size > 0),
quotas AS (
  SELECT rank, source_size, blocks, words // source_size AS passes, words % source_size AS over,
    (words // source_size) * blocks + (words % source_size + 127) // 128 AS slots FROM counted),
ranges AS (
  SELECT *, coalesce(sum(slots) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_slot, sum(slots) OVER ()::BIGINT AS total FROM quotas),
ids AS (SELECT unnest(generate_series(0, (SELECT max(total) FROM ranges) - 1)) AS id),
highs AS (SELECT id, {_scrambled(_scrambled("42 + id // 2147483648") + " + id")} AS high FROM ids),
places AS (SELECT id // {MIX_SHARD} AS shard, (high * 2147483648 + {_scrambled("high + id")}) % (SELECT max(total) FROM ranges) AS place FROM highs),
drawn AS (
  SELECT rank, shard, any_value(slots) AS slots, count(*) AS drawn FROM places JOIN ranges ON place >= first_slot AND place < first_slot + slots GROUP BY rank, shard),
kept AS (
  SELECT rank, shard, drawn, least(drawn, greatest(slots - coalesce(sum(drawn) OVER (
    PARTITION BY rank ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0))::BIGINT AS n FROM drawn),
free AS (SELECT shard, row_number() OVER (ORDER BY shard) AS k FROM (SELECT shard, unnest(generate_series(1, sum(drawn - n)::BIGINT)) FROM kept GROUP BY shard)),
lacks AS (
  SELECT rank, row_number() OVER (ORDER BY rank) AS k
  FROM (SELECT rank, unnest(generate_series(1, slots - coalesce(held, 0))) FROM quotas LEFT JOIN (SELECT rank, sum(n)::BIGINT AS held FROM kept GROUP BY rank) USING (rank))),
shards AS (
  SELECT shard, rank, sum(n)::BIGINT AS n FROM (SELECT shard, rank, n FROM kept UNION ALL SELECT shard, rank, 1 FROM free JOIN lacks USING (k)) GROUP BY shard, rank),
dealt AS (
  SELECT shard, rank, unnest(generate_series(1, n)) FROM shards),
slots AS (
  SELECT rank, shard, source_size, blocks, passes, over, slots, slot, slot // blocks AS turn, slot % blocks AS index
  FROM (SELECT shard, rank, row_number() OVER (PARTITION BY rank ORDER BY shard) - 1 AS slot FROM dealt) JOIN quotas USING (rank)),
keyed AS (
  SELECT rank, slot, index, blocks - 1 AS full_blocks, ceil(sqrt(blocks - 1))::BIGINT AS width, {_scrambled(_scrambled("43 + rank") + " + turn")} AS key
  FROM slots WHERE index < blocks - 1),
walk AS (
  SELECT rank, slot, key, full_blocks, width, ceil(full_blocks / width)::BIGINT AS height, index AS x, 0 AS k FROM keyed
  UNION ALL
  SELECT rank, slot, key, full_blocks, width, height, r2 * width + l2, k + 1
  FROM (SELECT *, (r1 + {_scrambled("key + 46457589 + l2")}) % height AS r2
  FROM (SELECT *, (l1 + {_scrambled("key + 30971726 + r1")}) % width AS l2
  FROM (SELECT *, (r0 + {_scrambled("key + 15485863 + l1")}) % height AS r1
  FROM (SELECT *, (l0 + {_scrambled("key + r0")}) % width AS l1
  FROM (SELECT *, x % width AS l0, x // width AS r0 FROM walk WHERE k = 0 OR x >= full_blocks)))))),
mapped AS (
  SELECT rank, shard, CASE WHEN index = blocks - 1 THEN index ELSE x END AS block,
    CASE WHEN turn = passes AND slot = slots - 1 THEN over - index * 128
      WHEN index = blocks - 1 THEN source_size - index * 128 ELSE 128 END AS words
  FROM slots LEFT JOIN (SELECT rank, slot, x FROM walk WHERE k > 0 AND x < full_blocks) USING (rank, slot)),
placed AS (
  SELECT row_number() OVER () AS row, t.rank, doc_id, size, source_size, target,
    sum(size) OVER (PARTITION BY t.rank ORDER BY doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT *, unnest(generate_series((start // 128)::BIGINT, ((start + size - 1) // 128)::BIGINT)) AS block
  FROM placed WHERE size > 0),
parts AS (
  SELECT row, shard, greatest(least(start + size - p.block * 128, 128, words) - greatest(start - p.block * 128, 0), 0) AS taken
  FROM pieces p JOIN mapped m ON p.rank = m.rank AND p.block = m.block),
taken AS (
  SELECT row, sum(taken)::BIGINT AS taken, count(DISTINCT shard) AS n_shards FROM parts WHERE taken > 0 GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, coalesce(n_shards, 0)::BIGINT AS n_shards FROM placed LEFT JOIN taken USING (row)
"""

#: Every pair of a query and a row, by plain products.
OP9_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: Windows as joined text; a word is hit if an occurrence of a window covers its place.
OP13_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
starts AS (
  SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS s FROM item_words WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[s:s + 9], ' ') AS w FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT row, words, n, unnest(generate_series(1, len(words) - n + 1)) AS s FROM lowered, sizes WHERE len(words) >= n),
held AS (SELECT row, n, s, array_to_string(words[s:s + n - 1], ' ') AS w FROM places),
found AS (SELECT row, s, held.n, item_id FROM held JOIN windows USING (n, w)),
hits AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(generate_series(s, s + n - 1)) AS p FROM found) GROUP BY row),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_HEAD = " || ".join(_FIELD.format(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))
#: CRC-32 bit by bit: bytes of the number go in, -1 stands for a shift.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x::BIGINT) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""
#: Levels by recursion over runs of 16, and folding by recursion over a leaf's levels.
OP12_SQL = f"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS row, doc_id, source, {_HEAD} AS head, text, coalesce({_CRC} % 5 = 0, false) AS chosen FROM documents),
leaves AS (
  SELECT row, doc_id, source, sha256(head || {_FIELD.format('text')}) AS leaf,
    CASE WHEN chosen THEN sha256(head || {_FIELD.format(_LOWER.format('text'))}) ELSE sha256(head || {_FIELD.format('text')}) END AS changed FROM fields),
trees AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM leaves)),
ranked AS (
  SELECT row, doc_id, leaf, changed, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM leaves JOIN trees ON leaves.source IS NOT DISTINCT FROM trees.source),
nodes AS (
  SELECT 0 AS level, tree, rank AS idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM ranked
  UNION ALL
  SELECT level + 1, tree, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 15) // 16 FROM nodes WHERE n > 1 GROUP BY level, tree, idx // 16),
subroots AS (SELECT tree, digest AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS idx, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 15) // 16 FROM tops WHERE n > 1 GROUP BY level, idx // 16),
runs AS (SELECT level, tree, idx // 16 AS run, list(digest ORDER BY idx) AS ds FROM nodes WHERE n > 1 GROUP BY level, tree, idx // 16),
top_runs AS (SELECT level, idx // 16 AS run, list(digest ORDER BY idx) AS ds FROM tops WHERE n > 1 GROUP BY level, idx // 16),
steps AS (
  SELECT row, level AS step, ds, (rank // pow(16, level)::BIGINT) % 16 AS place FROM ranked JOIN runs USING (tree) WHERE run = rank // pow(16, level + 1)::BIGINT
  UNION ALL
  SELECT row, 100 + level, ds, (tree // pow(16, level)::BIGINT) % 16 FROM ranked JOIN top_runs ON run = tree // pow(16, level + 1)::BIGINT),
paths AS (
  SELECT row, row_number() OVER (PARTITION BY row ORDER BY step) AS k, array_to_string(ds[1:place], '') AS lefts, array_to_string(ds[place + 2:], '') AS rights FROM steps),
folds AS (
  SELECT row, 0 AS k, changed AS digest FROM ranked
  UNION ALL
  SELECT folds.row, folds.k + 1, sha256(lefts || digest || rights) FROM folds JOIN paths ON paths.row = folds.row AND paths.k = folds.k + 1),
ends AS (SELECT row, arg_max(digest, k) AS folded_root FROM folds GROUP BY row),
proofs AS (SELECT row, sha256(string_agg(lefts || rights, '' ORDER BY k)) AS proof_sha256 FROM paths GROUP BY row)
SELECT doc_id, leaf, subroot, digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = digest AS verified
FROM ranked JOIN subroots USING (tree) JOIN ends USING (row) LEFT JOIN proofs USING (row) JOIN tops ON n = 1
"""

ORACLE: dict[str, str] = {"op7_source_mixing": OP7_SQL, "op9_topk": OP9_SQL, "op12_merkle_manifest": OP12_SQL, "op13_decontamination": OP13_SQL}
