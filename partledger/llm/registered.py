"""Queries of this package over the whole given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.llm import (
    collocations,
    decontamination,
    jaccard,
    languages,
    linededup,
    manifest,
    mixing,
    quality_rules,
    sharding,
    site_quality,
    suffixdedup,
    toxicity,
    urlrules,
)
from partledger.llm.common import crc_mod, read_table

SHARDS = 40


def learn_lexicon(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Lexicon:
    """The lexicon of the labels whose documents are not held out."""
    labels = read_table(spark, sf_dir, "labels").filter(crc_mod(F.col("doc_id"), 5) != 0)
    return toxicity.learn(docs, labels)


def op1_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages, labels = (read_table(spark, sf_dir, t) for t in ("documents", "pages", "labels"))
    return site_quality.judge_quality(docs, site_quality.page_sites(pages), labels)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(read_table(spark, sf_dir, "pages"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(read_table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(read_table(spark, sf_dir, "pages"), urlrules.rule_table(spark))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), learn_lexicon(spark, docs, sf_dir))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = languages.learn(docs.filter(crc_mod(F.col("doc_id"), 4) != 2))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    predicted = languages.predict_languages(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = decontamination.find_contamination(docs.select("doc_id", "text"), benchmark).select("doc_id", "found.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["to"] - s["from"]))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    bare = F.when(crc_mod(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claim = manifest.leaf_digest(*(F.col(c) for c in fields[:-1]), bare)
    proved = manifest.proofs(manifest.build_manifest(docs, fields, claim=claim))
    digests = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return proved.select(
        F.col("leaf_id").alias("doc_id"),
        digests["leaf"].alias("leaf"),
        digests["subroot"].alias("subroot"),
        digests["root"].alias("root"),
        digests["proof"].alias("proof_sha256"),
        digests["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = suffixdedup.kept_texts(docs, suffixdedup.repeated_spans(docs))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]))
    digest = F.sha2("kept", 256).alias("cut_sha256")
    found = found.select("k1", "k2", removed.alias("removed"), F.size("spans").cast("long").alias("runs"), digest)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("sha256"),
        *suffixdedup.text_keys(text),
    )
    none = F.lit(0).cast("long")
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", none).alias("n_removed"),
        F.coalesce("runs", none).alias("n_spans"),
        F.coalesce("cut_sha256", "sha256").alias("kept_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_RULES = ", ".join(
    f"('{host}', '{path}', '{verdict}')" for host, path, verdict in urlrules.RULES
)
URL_SQL = rf"""
WITH cut AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    row_number() OVER () AS k FROM pages),
rules(h, p, v) AS (VALUES {_RULES}),
fit AS (SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, '{urlrules.DEFAULT}') AS verdict FROM cut LEFT JOIN fit USING (k)
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = rf"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item, least(len(w), {decontamination.WINDOW}) AS n,
    array_to_string(list_slice(w, i, i + least(len(w), {decontamination.WINDOW}) - 1), ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {decontamination.WINDOW} + 1, least(len(w), 1)) + 1)) AS i FROM items)),
docs AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT k, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows WHERE n > 0))),
hits AS (SELECT k, item, i, places.n FROM places JOIN windows USING (n, phrase)),
words AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM hits) GROUP BY k),
found AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (k) LEFT JOIN found USING (k)
"""

#: CRC-32 of a text's UTF-8 bytes, bit by bit: the reflected polynomial is a fixed value.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(strlen({0})), lambda i: ord({0}[i + 1])::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)"""


def _sql_field(column: str) -> str:
    return f"coalesce(strlen(({column})::VARCHAR)::VARCHAR || ':' || ({column})::VARCHAR, '-')"


_FIELDS = " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS (SELECT row_number() OVER () AS id, source, doc_id,
    sha256({_FIELDS} || {_sql_field("text")}) AS leaf,
    sha256({_FIELDS} || {_sql_field("CASE WHEN " + _CRC.format("(doc_id::VARCHAR)") + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS claim
  FROM documents),
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM leaves GROUP BY source),
placed AS (SELECT id, doc_id, leaf, claim, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM leaves JOIN sources ON leaves.source IS NOT DISTINCT FROM sources.source),
low AS (SELECT 0 AS level, tree, rank AS pos, leaf AS digest, n FROM placed
  UNION ALL SELECT level + 1, tree, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM low WHERE n > 1 GROUP BY level, tree, pos // 3, n),
subroots AS (SELECT tree, digest, level AS height FROM low WHERE n = 1),
up AS (SELECT 0 AS level, tree AS pos, digest, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY level, pos // 3, n),
top AS (SELECT digest AS root FROM up WHERE n = 1),
steps AS (SELECT id, low.level, low.pos AS pos, (rank // (3 ** low.level)::BIGINT) AS me, low.digest FROM placed JOIN low USING (tree)
    JOIN subroots USING (tree) WHERE low.level < height AND low.pos // 3 = rank // (3 ** (low.level + 1))::BIGINT
  UNION ALL SELECT id, height + up.level, up.pos, (tree // (3 ** up.level)::BIGINT), up.digest FROM placed JOIN subroots USING (tree)
    JOIN up ON up.pos // 3 = tree // (3 ** (up.level + 1))::BIGINT WHERE up.n > 1),
ways AS (SELECT id, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < me), '') AS before_me,
    coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > me), '') AS after_me FROM steps GROUP BY id, level),
proofs AS (SELECT id, sha256(string_agg(before_me || after_me, '' ORDER BY level)) AS proof FROM ways GROUP BY id),
folded AS (SELECT id, 0 AS level, claim AS digest FROM placed
  UNION ALL SELECT folded.id, folded.level + 1, sha256(before_me || folded.digest || after_me) FROM folded JOIN ways USING (id, level)),
ends AS (SELECT id, arg_max(digest, level) AS digest FROM folded GROUP BY id)
SELECT doc_id, leaf, subroots.digest AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, ends.digest AS folded_root,
  ends.digest = root AS verified
FROM placed JOIN subroots USING (tree) JOIN ends USING (id) LEFT JOIN proofs USING (id), top
"""

SUFFIX_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS b FROM documents),
places AS (SELECT k, i, md5(array_slice(b, i, i + {suffixdedup.LENGTH - 1})) AS h
  FROM (SELECT k, b, unnest(range(1, octet_length(b) - {suffixdedup.LENGTH - 2})) AS i FROM docs)),
hits AS (SELECT k, i FROM places WHERE h IN (SELECT h FROM places GROUP BY h HAVING count(*) > 1)),
marked AS (SELECT k, i, (i > lag(i) OVER (PARTITION BY k ORDER BY i) + {suffixdedup.LENGTH})::INT AS fresh FROM hits),
numbered AS (SELECT k, i, sum(coalesce(fresh, 0)) OVER (PARTITION BY k ORDER BY i) AS run FROM marked),
runs AS (SELECT k, min(i) AS lo, max(i) + {suffixdedup.LENGTH - 1} AS hi FROM numbered GROUP BY k, run),
gaps AS (SELECT k, lag(hi, 1, 0) OVER (PARTITION BY k ORDER BY lo) + 1 AS f, lo - 1 AS t FROM runs
  UNION ALL SELECT k, max(hi) + 1, octet_length(any_value(b)) FROM runs JOIN docs USING (k) GROUP BY k),
kept AS (SELECT k, sha256(unhex(string_agg(CASE WHEN t >= f THEN hex(array_slice(b, f, t)) ELSE '' END, '' ORDER BY f))) AS digest
  FROM gaps JOIN docs USING (k) GROUP BY k),
sums AS (SELECT k, sum(hi - lo + 1)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY k)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  coalesce(digest, sha256(b)) AS kept_sha256
FROM docs LEFT JOIN sums USING (k) LEFT JOIN kept USING (k)
"""

COLLOCATION_SQL = rf"""
WITH pieces AS (SELECT row_number() OVER () AS id, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) sizes(k)),
f AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL
  HAVING count(*) >= {collocations.MIN_COUNT}),
cuts AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
scores AS (SELECT cuts.lang, cuts.k, cuts.phrase, a, cut, x.f AS l, y.f AS r,
    ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(list_slice(w, 1, cut), ' ')
    JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(list_slice(w, cut + 1, cuts.k), ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, unnest([array_to_string(list_slice(string_split(phrase, ' '), 1, 2), ' '),
    array_to_string(list_slice(string_split(phrase, ' '), 2, 3), ' ')]) AS phrase, f FROM f WHERE k = 3),
kept AS (SELECT * FROM best WHERE NOT EXISTS (SELECT 1 FROM longer
  WHERE longer.lang = best.lang AND longer.phrase = best.phrase AND 100 * longer.f >= {collocations.COVERED_PERCENT} * best.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (
        op1_site_quality,
        op2_line_dedup,
        op3_source_mixing,
        op4_url_rules,
        op5_toxicity,
        op6_virtual_slots,
        op7_ngram_jaccard,
        op8_language_id,
        op9_quality_rules,
        op10_decontamination,
        op11_merkle_manifest,
        op12_suffix_dedup,
        op13_collocations,
        pipeline,
    )
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": linededup.SQL,
        "op4_url_rules": URL_SQL,
        "op10_decontamination": DECONTAMINATION_SQL,
        "op11_merkle_manifest": MANIFEST_SQL,
        "op12_suffix_dedup": SUFFIX_SQL,
        "op13_collocations": COLLOCATION_SQL,
    }
