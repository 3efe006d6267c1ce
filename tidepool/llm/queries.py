"""The registered queries of this folder, with their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import application_dir
from . import (
    decontamination,
    importance_resampling,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    periodic_runs,
    quality_fm,
    robust_outliers,
    secrets,
    severity,
    slot_sharding,
    token_files,
)
from .tables import held_out, table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed package of public tokenizers has a vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return severity.score(docs, severity.train(docs, labels, "toxic", flags=True))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hit_runs")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out("doc_id", 3, 1)
    machine = quality_fm.train(docs, labels.where(~out), "quality")
    return quality_fm.score(docs, machine).withColumn("held_out", out)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_outliers.judged(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    return language_id.predict(docs, language_id.train(docs.where(~out))).withColumn("held_out", out)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampled(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{application_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.read_tokens(spark, path)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{application_dir(spark)}/shards-{uuid.uuid4().hex}"
    stored = slot_sharding.shard(table(spark, sf_dir, "documents"), path)
    return stored.select(
        "doc_id",
        slot_sharding.record_size().alias("size"),
        slot_sharding.text_crc32().alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_benchmark_decontamination": op2_benchmark_decontamination,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_line_dedup": op4_line_dedup,
        "op5_robust_outliers": op5_robust_outliers,
        "op6_secret_scan": op6_secret_scan,
        "op7_language_id": op7_language_id,
        "op8_source_mixing": op8_source_mixing,
        "op9_token_files": op9_token_files,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_slot_sharding": op12_slot_sharding,
        "op13_importance_resampling": op13_importance_resampling,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
),
found AS (SELECT doc_id, item_id, n, i FROM places JOIN windows USING (n, words)),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# A run of four lines, a line of 50 words, or the shortest run of two or three lines that
# reaches 50 words, that stands at an earlier place too.
OP4_SQL = r"""
WITH d AS (SELECT doc_id, text, CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS k, string_split(text, chr(10)) AS l FROM documents),
t AS (
  SELECT DISTINCT doc_id, k, list_transform(l, lambda x: regexp_replace(x, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')) AS l,
    list_transform(l, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS n
  FROM d WHERE text IS NOT NULL AND doc_id IS NOT NULL
),
spots AS (SELECT doc_id, k, l, n, unnest(range(1, len(l) + 1)) AS i FROM t),
w AS (
  SELECT doc_id, k, i - 1 AS start, 4 AS size, l[i : i + 3] AS content FROM spots WHERE i + 3 <= len(l)
  UNION ALL
  SELECT doc_id, k, i - 1, 1, l[i : i] FROM spots WHERE n[i] >= 50
  UNION ALL
  SELECT doc_id, k, i - 1, 2, l[i : i + 1] FROM spots WHERE n[i] BETWEEN 1 AND 49 AND i + 1 <= len(l) AND n[i] + n[i + 1] >= 50
  UNION ALL
  SELECT doc_id, k, i - 1, 3, l[i : i + 2] FROM spots
  WHERE n[i] BETWEEN 1 AND 49 AND i + 2 <= len(l) AND n[i] + n[i + 1] < 50 AND n[i] + n[i + 1] + n[i + 2] >= 50
),
f AS (
  SELECT *, first_value(doc_id) OVER p AS d0, first_value(k) OVER p AS k0, first_value(start) OVER p AS s0
  FROM w WINDOW p AS (PARTITION BY size, content ORDER BY doc_id, k, start)
),
r AS (
  SELECT DISTINCT doc_id, k, unnest(range(start, start + size)) AS place FROM f
  WHERE doc_id <> d0 OR k <> k0 OR start >= s0 + size
),
g AS (SELECT doc_id, k, list(place) AS removed FROM r GROUP BY doc_id, k)
SELECT d.doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(removed), 0) AS n_removed,
  sha256(CASE WHEN removed IS NULL THEN text ELSE
    array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(removed, i - 1)), lambda i: l[i]), chr(10))
  END) AS text_sha256
FROM d LEFT JOIN g USING (doc_id, k)
"""


def _crc32(hex_bytes: str) -> str:
    """crc32 of bytes given as hexadecimal digits."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    values = f"list_transform(regexp_extract_all({hex_bytes}, '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {values}), lambda c, b: {step}))"


# Words of a text with planted runs; runs from the places where five words stand again at a
# distance, joined to stretches; those with a smaller period inside a run of it are left out.
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  {_crc32("hex(encode(CAST(doc_id AS VARCHAR)))")} AS h FROM documents),
s AS (SELECT doc_id, w, h, len(w) AS n, CASE WHEN len(w) > 0 AND h % 10 = 0 THEN (h // 10) % len(w) END AS a FROM d),
t AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END)
  END AS w FROM s),
five AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + 5], ' ') AS words
  FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM t)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM five x JOIN five y USING (doc_id, words)
  WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island),
long AS (SELECT * FROM stretches WHERE length >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long l WHERE NOT EXISTS (SELECT 1 FROM long m WHERE m.doc_id = l.doc_id AND m.q < l.q
  AND m.start <= l.start AND m.start + m.length >= l.start + l.length)),
best AS (SELECT DISTINCT ON (doc_id) * FROM runs ORDER BY doc_id, CAST(length AS DOUBLE) / q DESC, start, q),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS list
  FROM runs GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT place) AS gone
  FROM (SELECT doc_id, unnest(range(start + q, start + length)) AS place FROM runs) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
  sha256(coalesce(list, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM t LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

# The slots' sizes as one list, and the map edited a slot at a time: the last step is the one
# from which no slot of the fullest shard can move.
OP12_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, {_crc32("hex(encode(coalesce(text, '')))")} AS text_crc32 FROM documents
),
d AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_crc32), 1, 8) AS BIGINT) % 4096 AS virtual_slot FROM sized),
sums AS (SELECT list(coalesce(b, 0) ORDER BY s) AS b FROM range(4096) r(s)
  LEFT JOIN (SELECT virtual_slot, CAST(sum(size) AS BIGINT) AS b FROM d GROUP BY virtual_slot) ON s = virtual_slot),
edits AS (
  SELECT 0 AS step, list_transform(range(4096), lambda s: s % 8) AS owner
  UNION ALL
  SELECT step + 1, list_transform(range(4096), lambda s: CASE WHEN s = moved THEN empty ELSE owner[s + 1] END) FROM (
    SELECT *, list_position(movable, list_max(movable)) - 1 AS moved FROM (
      SELECT step, owner, empty, list_transform(range(4096), lambda s:
        CASE WHEN owner[s + 1] = full_one AND 2 * b[s + 1] <= loads[full_one + 1] - loads[empty + 1] THEN b[s + 1] ELSE 0 END) AS movable
      FROM (
        SELECT *, list_position(loads, list_max(loads)) - 1 AS full_one, list_position(loads, list_min(loads)) - 1 AS empty FROM (
          SELECT step, owner, b, list_transform(range(8), lambda k:
            CAST(list_sum(list_transform(range(4096), lambda s: CASE WHEN owner[s + 1] = k THEN b[s + 1] ELSE 0 END)) AS BIGINT)) AS loads
          FROM edits, sums)))
    WHERE list_max(movable) > 0)
),
final AS (SELECT owner FROM edits ORDER BY step DESC LIMIT 1),
places AS (SELECT unnest(range(4096)) AS virtual_slot, unnest(owner) AS shard FROM final)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, doc_id NULLS FIRST, text_crc32) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, CAST(virtual_slot AS INTEGER) AS virtual_slot
FROM d JOIN places USING (virtual_slot)
"""

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT r, unnest(w) AS word FROM d),
goal AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
bucket_of AS (SELECT word, {_crc32("hex(encode(word))")} % 10000 AS bucket FROM (SELECT word FROM words UNION SELECT word FROM goal)),
s AS (SELECT bucket, count(*) AS s FROM words JOIN bucket_of USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN bucket_of USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM words) + 10000.0::DOUBLE)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM goal) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
),
weighed AS (
  SELECT r, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM words JOIN bucket_of USING (word) JOIN gains USING (bucket) GROUP BY r
),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (r)
),
ranked AS (
  SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS many
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * many // 100 THEN place END AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontamination": OP2_SQL,
        "op4_line_dedup": OP4_SQL,
        "op11_periodic_runs": OP11_SQL,
        "op12_slot_sharding": OP12_SQL,
        "op13_importance_resampling": OP13_SQL,
    }
