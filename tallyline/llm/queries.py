"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import conversation_repair, decontamination, exact_dedup, fill_in_middle, labelled_findings, languages, packing, quality, secret_scan, simhash, substring_dedup, token_counts, token_shards, url_filter
from tallyline.llm.frames import kept_table, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SIMHASH_SHINGLE, SIMHASH_DISTANCE = 4, 4
#: Domains whose pages are blocked where no rule decides. Fixed values.
LISTED_DOMAINS = [
    "adult-x.example.com", "ads-track.example.com", "casino-win.example.net", "cheap-pills.example.com",
    "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org",
]
#: The rules (verdict, host, path). Fixed values.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


@query
def op2_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_shards.write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_shards.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("found.items", lambda i: i.cast("string"))), ",")
    n_hit = decontamination.n_hit()
    return found.select(
        "doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), F.col("found.longest").alias("longest_match"),
    )


@query
def op5_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op6_count_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return table(spark, folder, "documents").select("doc_id", counted.alias("c")).select("doc_id", "c.n_tokens", "c.score")


@query
def op7_popcount_grid(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), SIMHASH_SHINGLE, SIMHASH_DISTANCE)
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


@query
def op8_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    domains = spark.createDataFrame([(d,) for d in LISTED_DOMAINS], "domain string")
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES, domains)


ORACLES["op8_url_cascade"] = rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule FROM hosts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN {" OR ".join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in LISTED_DOMAINS)} THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op10_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.ledger(table(spark, folder, "documents"))
    judged = rows.withColumns({"base_failed": quality.fails(quality.BASE), "kept": ~quality.fails(quality.STRICT)})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


ORACLES["op10_quality_ledger"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS window_words
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM parts)),
found AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, window_words) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + o) AS n FROM (SELECT r, i, unnest(range(0, 5)) AS o FROM found) GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM parts LEFT JOIN covered USING (r)),
failed AS (
  SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words))::INT
    + 16 * (2 * n_dup_lines > n_lines)::INT AS BIGINT) AS fail_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  fail_bits = 0 AS kept, fail_bits
FROM failed
"""


@query
def quality_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of each policy does, from the stored ledger."""
    return quality.all_ablations(quality.kept_ledger(table(spark, folder, "documents")))


_POLICIES = ", ".join(f"('{p.version}', {p.mask})" for p in quality.POLICIES)
_RULES = ", ".join(f"('{name}', {1 << bit})" for bit, (name, _) in enumerate(quality.RULES))
ORACLES["quality_ablations"] = f"""
SELECT policy, rule, CAST(count(*) FILTER ((b & bit) <> 0) AS BIGINT) AS failed, CAST(count(*) FILTER (b = bit) AS BIGINT) AS failed_alone,
  CAST(count(*) FILTER ((b & ~bit) = 0) AS BIGINT) AS kept_without
FROM (SELECT policy, rule, bit, fail_bits & mask AS b FROM ({ORACLES["op10_quality_ledger"]})
  CROSS JOIN (VALUES {_POLICIES}) AS p(policy, mask) CROSS JOIN (VALUES {_RULES}) AS r(rule, bit) WHERE (mask & bit) <> 0)
GROUP BY policy, rule
"""


@query
def op9_forest_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, trained_forest(docs))
    # from an outer generator no filter on the array is inferred, which would write the scan out once more
    each = found.select("doc_id", F.explode_outer("secrets").alias("s")).where("s IS NOT NULL")
    return each.select("doc_id", "s.number", "s.start", "s.secret", "s.score")


def trained_forest(docs: DataFrame) -> secret_scan.Forest:
    """From the labelled findings, with the words that are common in these documents."""
    return secret_scan.train(labelled_findings.labelled(docs.sparkSession), secret_scan.common_words(docs))


def held_out(key: str = "doc_id") -> Column:
    """The third of the documents that no classifier learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def learned_languages(docs: DataFrame) -> languages.Model:
    return languages.fit(docs.where(~held_out()).select("text", "lang"))


@query
def op3_family_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = languages.predicted(learned_languages(docs), spark, F.col("text"))
    return docs.select("doc_id", held_out().alias("held_out"), found.alias("p")).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


@query
def op1_fixed_blocks(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "spans")


@query
def op11_misra_gries(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op11_misra_gries"] = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER best = 1 AS kept, text_sha256
FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST, r)
"""


@query
def op12_skip_list(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    made = docs.select("doc_id", fill_in_middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("f")).select("doc_id", "f.*")
    sums = {"output_sha256": F.col("output"), "restored_sha256": fill_in_middle.restore(F.col("output"), F.col("form"))}
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[F.sha2(c, 256).alias(n) for n, c in sums.items()])


ORACLES["op12_skip_list"] = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
drawn AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM texts),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


@query
def op13_deepening_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    messages = conversation_repair.messages(conversation_repair.damaged(rows))
    found = kept_table(conversation_repair.repairs(messages), "repairs")
    hashes = conversation_repair.line_digests(conversation_repair.repaired(messages, found))
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["conv"]), "left").drop("conv")
    joined = joined.join(hashes, joined["conv_id"].eqNullSafe(hashes["conv"]), "left")
    counts = [F.when(F.col("audit").isNull(), F.lit(0).cast("bigint")).otherwise(F.col(c)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


ORACLES["op13_deepening_repair"] = r"""
WITH RECURSIVE keyed AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS t,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
sums AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, y: list_reduce(list_concat([xor(x, y)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 20 AS what
  FROM keyed),
damaged AS (
  SELECT r, conv_id, turn, unnest(CASE WHEN what = 3 THEN [1, 2] ELSE [1] END) AS copy, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS t
  FROM sums WHERE what <> 0),
placed AS (
  SELECT conv_id, turn, role, t, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    lag(role) OVER w AS role_before, regexp_extract(t, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending,
    row_number() OVER (PARTITION BY conv_id, role, t ORDER BY turn NULLS FIRST, r, copy) > 1 AS again
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(t), r, copy)),
judged AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
edits(state, letter, edit, cost, after, gets) AS (VALUES
  (0, '', 'D', 4, 0, ''), (1, '', 'D', 4, 1, ''), (2, '', 'D', 4, 2, ''), (3, '', 'D', 4, 3, ''),
  (0, 's', 'K', 0, 1, ''), (0, 'u', 'K', 0, 2, ''), (1, 'u', 'K', 0, 2, ''), (2, 'a', 'K', 0, 3, ''), (3, 'u', 'K', 0, 2, ''),
  (0, '', 'R', 3, 2, 'user'), (1, '', 'R', 3, 2, 'user'), (2, '', 'R', 3, 3, 'assistant'), (3, '', 'R', 3, 2, 'user')),
fills(state, lead, fill, lines, state_then) AS (VALUES
  (0, '', 0, '', 0), (1, '', 0, '', 1), (2, '', 0, '', 2), (3, '', 0, '', 3),
  (0, 'I', 3, chr(10) || 'user:', 2), (1, 'I', 3, chr(10) || 'user:', 2), (2, 'I', 3, chr(10) || 'assistant:', 3), (3, 'I', 3, chr(10) || 'user:', 2),
  (0, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:', 3), (1, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:', 3),
  (2, 'II', 6, chr(10) || 'assistant:' || chr(10) || 'user:', 2), (3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:', 3)),
paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': 0, 'audit': '', 'lines': ''} AS best FROM placed
  UNION ALL
  SELECT p.conv_id, j.i, e.after, min({'cost': p.best.cost + f.fill + e.cost + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 3 ELSE 0 END,
    'audit': p.best.audit || f.lead || e.edit,
    'lines': p.best.lines || f.lines || CASE e.edit WHEN 'D' THEN '' ELSE chr(10) || CASE e.edit WHEN 'K' THEN j.role ELSE e.gets END || ':' || j.t END})
  FROM paths p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1
    JOIN fills f ON f.state = p.state
    JOIN edits e ON e.state = f.state_then AND (e.letter = '' OR e.letter = left(j.role, 1)) AND (e.edit = 'D' OR j.fault IN ('', 'truncated'))
  GROUP BY p.conv_id, j.i, e.after),
ended AS (
  SELECT p.conv_id, min({'cost': p.best.cost + f.fill, 'audit': p.best.audit || f.lead, 'lines': p.best.lines || f.lines}) AS best
  FROM paths p JOIN (SELECT conv_id, max(i) AS n FROM judged GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.n = p.i
    JOIN fills f ON f.state = p.state AND f.state_then IN (0, 3) GROUP BY p.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (role_before IS NOT NULL AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
