"""One query per operator, over whole tables, with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.llm import (
    collocations, exact_dedup, fingerprints, language_id, licenses, middle, mixing, near_dedup, packing, private_data, quality,
    secret_scan, toxicity,
)
from loomgrain.llm.common import crc_remainder, documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
  FROM documents),
w AS (
  SELECT digest, count(*) AS group_size, max(chars) AS keep_chars,
         arg_min(doc_id, (-chars, doc_id)) AS keep_id
  FROM d GROUP BY digest)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, digest AS text_sha256
FROM d JOIN w USING (digest)
"""


@register("op4_exact_dedup", EXACT_SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.decisions(documents(spark, sf_dir), exact_dedup.scratch_index(spark))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s),
l AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS stops FROM w),
v AS (
  SELECT *,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY stops, source ASC NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY stops, source ASC NULLS LAST
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM l),
t AS (
  SELECT source, source_size,
    least(weight * (SELECT arg_min(level, stops) FROM v WHERE level <= stops), CAST(3 * source_size AS DOUBLE)) AS target,
    CAST(('0x' || substr(md5('mix-1|' || coalesce('=' || source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM v),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * least(floor(place * each + shift) - floor((place - 1) * each + shift), 3) AS BIGINT) AS taken
FROM r
"""


@register("op7_mixing", MIX_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(documents(spark, sf_dir))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op1_secrets")
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed")


@register("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("found")


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (crc_remainder(quality.HOLD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@register("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=2)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary files have ``name``; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(), plain_specials=False)


@register("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (crc_remainder(toxicity.HOLD_OUT) == toxicity.HELD).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.ACCEPT).cast("int").alias("predicted"),
    )


@register("op3_private_data")
def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return private_data.scan(docs, private_data.fit(docs)).drop("found")


MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         [CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT) for i in range(4)] AS r
  FROM d),
c AS (
  SELECT doc_id, text, units, n, r, least(r[1] % (n + 1), r[2] % (n + 1)) AS one, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
         WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:one], ''), '') AS prefix,
         coalesce(array_to_string(units[one + 1:two], ''), '') AS middle, coalesce(array_to_string(units[two + 1:n], ''), '') AS suffix
  FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@register("op11_fill_in_middle", MIDDLE_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = middle.fill_in_middle(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(middle.restored(), 256).alias("restored_sha256"),
    )


COLLOCATION_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, k, unnest([array_to_string(words[i:i + k - 1], ' ') FOR i IN range(1, len(words) - k + 2)]) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS v(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 10),
x AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r,
         CAST(1000000 * a::HUGEINT * a::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS BIGINT) AS score
  FROM c, (VALUES (1), (2)) AS v(cut), f AS x, f AS y
  WHERE cut < c.k AND x.lang = c.lang AND y.lang = c.lang
    AND x.phrase = array_to_string(c.words[1:cut], ' ') AND y.phrase = array_to_string(c.words[cut + 1:], ' ')),
s AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM c WHERE k = 3)
  GROUP BY ALL),
z AS (
  SELECT s.lang, s.phrase, a, l, r, score FROM s LEFT JOIN i ON s.lang = i.lang AND s.phrase = i.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


@register("op12_collocations", COLLOCATION_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@register("op13_language")
def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language_id.identify(docs, language_id.fit(docs))
    held_out = (crc_remainder(language_id.HOLD_OUT) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "second", "ambiguous")
