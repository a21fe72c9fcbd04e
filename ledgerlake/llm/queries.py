"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (blocksearch, fingerprints, lm, minhash, mixing, packing, periodic, quality_rules, resampling, rulefit,
                            secrets, substrings, urlrules)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_shingles", "component_id", "kept")


URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return urlrules.judge(spark, table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secrets.find(documents, secrets.learn(spark, documents), "doc_id")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.coalesce(F.sha2("kept_text", 256), "words_sha256").alias("kept_sha256"))


def remainder(n: int) -> Column:
    """The fold of a row: crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.interpolated(spark, table(spark, sf_dir, "documents"), remainder(7) != 2, remainder(7) == 3)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_rulefit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rulefit.train_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=remainder(4) != 2)
    return out.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(spark, table(spark, sf_dir, "documents"))


def op10_near_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.near_classes(spark, table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def with_periods(documents: DataFrame) -> DataFrame:
    """The documents; those with crc32(doc_id as text) % 10 = 0 repeat a stretch of their words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        word = lambda i: F.element_at(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int") + 1)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), word), " "))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    changed = F.element_at(F.transform(F.array(words), repeated), 1)
    return documents.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(changed, "text")).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_periods(table(spark, sf_dir, "documents")))
    most = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, start, period = (F.col("most").getField(f) * sign for f, sign in (("n", 1), ("s", -1), ("p", -1)))
    return found.withColumn("most", most).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocksearch.top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_url_rules": op2_url_rules,
    "op3_quality_rules": op3_quality_rules,
    "op4_substrings": op4_substrings,
    "op5_lm": op5_lm,
    "op6_rulefit": op6_rulefit,
    "op7_secrets": op7_secrets,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_fingerprints": op10_fingerprints,
    "op10_near_classes": op10_near_classes,
    "op11_resampling": op11_resampling,
    "op12_runs": op12_runs,
    "op13_topk": op13_topk,
}
ORACLE: dict[str, str] = {
    "op2_url_rules": """
with cut as (
  select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as rest from pages),
parts as (
  select page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from cut),
rules(rule, rule_host, rule_path, verdict) as (values
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
judged as (
  select page_id, host, path,
         (select max_by(struct_pack(rule := rule, verdict := verdict), length(rule)) from rules
          where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as best
  from parts)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from judged
""",
    "op11_resampling": """
with hex_bits as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, i: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1))) as t),
every as (
  select doc_id as id, true as own, text from documents union all select item_id, false, text from benchmark),
split as (
  select id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from every),
word_counts as (select id, own, word, count(*) as n from (select id, own, unnest(words) as word from split) group by all),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, strlen(word) + 1), lambda i: ('0x' || substr(hex(word), 2 * i - 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct word from word_counts), hex_bits),
placed as (select id, own, bucket, sum(n)::BIGINT as n from word_counts join hashed using (word) group by all),
sums as (
  select bucket, coalesce(sum(n) filter (own), 0)::DOUBLE as s, coalesce(sum(n) filter (not own), 0)::DOUBLE as t from placed group by bucket),
gained as (
  select bucket, floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000))))::BIGINT as gain from sums),
weighed as (
  select id, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT as mean from placed join gained using (bucket) where own group by id),
scored as (
  select id as doc_id, len(words)::BIGINT as n_features, coalesce(mean, 0) as weight,
         coalesce(mean, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT as score
  from split left join weighed using (id) where own),
placed_scores as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as many from scored where n_features >= 20)
select doc_id, n_features, weight, score, if(place <= many * 10 // 100, place, null) as rank
from scored left join placed_scores using (doc_id)
""",
    "op13_topk": """
with sound as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT as score
  from sound as q join sound as c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank::INTEGER as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs) where rank <= 5
""",
}
