"""The registered queries of this package, over whole tables, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, html, lengths, metric_join, minhash, packing, quality, repair, resampling, sharding, suffix_dedup, warc
from .common import reachable, scratch_path, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies from 85 % of shared 5-word shingles up: each document's set size, component and whether it is the component's smallest id. Null and empty texts stand alone."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, appended as 16 arrivals of small shards one after another, compacted, and read back through the manifest."""
    store = sharding.ShardStore(spark, scratch_path(spark, "shards"), target_bytes=32 << 20)
    dealt, path = sharding.arrivals(table(spark, sf_dir, "documents"), 16, "doc_id", "_arrival"), scratch_path(spark, "arrivals")
    dealt.write.option("compression", "zstd").partitionBy("_arrival").parquet(path)
    landed = spark.read.schema(dealt.schema).parquet(path)
    for i in range(16):
        store.append(landed.filter(F.col("_arrival") == i).drop("_arrival"))
    store.compact()
    store.vacuum(grace_seconds=0)  # nobody else writes to it
    return store.read().select(
        "doc_id", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_md5"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the production rules for every document; null and empty texts fail the base rule."""
    judged = quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col(judged.columns[-1])
    return judged.select("doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens; a null or empty text is the end token alone."""
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything is read back from the formatted examples; the longest example of a conversation holds all its turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    seen = chat.read_back(chat.chat_examples(turns.unionByName(own)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # targets come in the order of the turns, so example and target_turn order the losses
    losses = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("target_turn") >= 0, F.struct("example", "loss_text")))), lambda x: x["loss_text"]), "")
    return (
        seen.select("conv_id", "example", "target_turn", "loss_text", "n_chars", F.size("turns").alias("n"), F.sha2(whole, 256).alias("sha"))
        .groupBy("conv_id")
        .agg(F.max("n").cast("long").alias("n_turns"), F.max_by("sha", "n").alias("turns_sha256"), losses.alias("losses"), F.sum("n_chars").alias("formatted_chars"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("losses").cast("long").alias("loss_chars"), F.sha2("losses", 256).alias("loss_sha256"), "formatted_chars")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back; null and empty pages have equal, empty payloads."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page; empty where there is none."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens at, above and cut at every length that occurs; null and empty texts have length 0."""
    return lengths.suffix_sums(written(lengths.length_histogram(table(spark, sf_dir, "documents").select("text")), "lengths"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to strings of 50 bytes that a smaller doc_id has; null and empty texts lose nothing."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark found in each document; null and empty texts have no words."""
    seen = decontamination.occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return seen.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged and repaired; one of which no row is left has zeros, an empty audit and the empty string's hash. Nulls are one space."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = repair.damaged(rows)
    reports = written(repair.reports(turns), "repairs")
    digests = repair.digests(repair.repaired(turns, reports)).withColumnRenamed("conv_id", "_told")
    ids = rows.select(F.col("conv_id").alias("_all")).distinct()
    out = ids.join(reports, F.col("_all").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("_all").eqNullSafe(F.col("_told")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_all").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighted towards the benchmark's texts, and the tenth of the long enough ones that is drawn. Null and empty texts have weight 0."""
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    return resampling.resample(docs, target, n_max=1, n_buckets=10_000, percent=10, min_words=20, seed=2024)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, whatever their labels, with their links of cosine 0.95 or more; vectors that can't be linked stand alone."""
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.95)


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_sharding": op2_sharding,
    "op3_quality_rules": op3_quality_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_warc": op6_warc,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))


def _rule_sql(r: quality.Rule) -> str:
    ratio = {
        "mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "word_chars"), "exclamation_ratio": ("n_exclamations", "n_words"),
        "upper_ratio": ("n_upper", "n_letters"), "letter_word_ratio": ("n_letter_words", "n_words"), "stop_word_ratio": ("n_stop_words", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
    }[r.metric]
    value = f"({ratio[0]} / nullif({ratio[1]}, 0)::DOUBLE)"
    tests = [f"{value} < {r.low}"] * (r.low is not None) + [f"{value} > {r.high}"] * (r.high is not None)
    return f"(n_words >= {r.min_words} AND coalesce({' OR '.join(tests)}, false))"


_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM (SELECT i,
      list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i)))"""


def _crc_sql(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes; ``crc_table`` has to be in scope."""
    octets = f"list_transform(range(strlen({text})), lambda j: ('0x' || substr(hex(encode({text})), 2 * j + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLE_SQL = {
    "op2_sharding": "SELECT doc_id, lang, source, n_chars::BIGINT AS n_chars, strlen(text)::BIGINT AS n_bytes, md5(text) AS text_md5 FROM documents",
    "op3_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
 win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS u(i)),
 twice AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1),
 hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win JOIN twice USING (doc_id, g), unnest(range(0, 5)) AS v(k) GROUP BY doc_id),
 m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
      coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines, len(regexp_extract_all(t, '!')) AS n_exclamations,
      len(regexp_extract_all(t, '\\p{{L}}')) AS n_letters, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper,
      len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter_words,
      len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words
   FROM d LEFT JOIN hit USING (doc_id)),
 b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(_rule_sql(r) for r in quality.RULES)}) AS kept FROM b""",
    "op5_chat_formatting": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
   UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
 e AS (SELECT *, role = 'assistant' AS target, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
   length(replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'))
   + length(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) + 20 AS c
   FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
 s AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM e)
SELECT conv_id, max(n)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
   coalesce(length(string_agg(text, '' ORDER BY pos) FILTER (target)), 0)::BIGINT AS loss_chars,
   sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (target), '')) AS loss_sha256,
   sum(CASE WHEN target OR pos = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
 d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, x,
   array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     (((('0x' || substr(x, 1 + 10 * (k // 8)::INT, 10))::UBIGINT >> (35 - 5 * (k % 8))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest FROM p),
 f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
   CASE WHEN page_id <> first THEN first END AS refers_to FROM f""",
    "op10_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
 b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
 win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
   FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
 sizes AS (SELECT DISTINCT n FROM win),
 dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)),
 hit AS (SELECT DISTINCT doc_id, n, i, item_id FROM dw JOIN win USING (n, g)),
 words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS v(k) GROUP BY doc_id),
 items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE {_CRC_TABLE},
 hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
     {_crc_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fault FROM conversations, crc_table),
 rows AS (SELECT conv_id, turn, copy, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
     CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
   FROM hit, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
 seen AS (SELECT *, row_number() OVER o AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
     left(role, 1) AS x, lag(left(role, 1)) OVER o AS before FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
 flagged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS flaw FROM seen),
 facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (flaw = 'b') AS blank,
     count(*) FILTER (flaw = 'd') AS duplicate, count(*) FILTER (flaw = 't') AS truncated, count(*) FILTER (before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM flagged GROUP BY conv_id),
 put(q, q2, price, letters) AS (VALUES ('-', '-', 0, ''), ('-', 'u', 5, 'I'), ('-', 'a', 10, 'II'), ('s', 's', 0, ''), ('s', 'u', 5, 'I'), ('s', 'a', 10, 'II'),
     ('u', 'u', 0, ''), ('u', 'a', 5, 'I'), ('a', 'a', 0, ''), ('a', 'u', 5, 'I')),
 best(conv_id, i, q, way) AS (
   SELECT conv_id, 0::BIGINT, q2, printf('%09d', price) || letters FROM facts, put WHERE q = '-'
   UNION ALL
   SELECT conv_id, i, q2, min(printf('%09d', cost + price) || audit || letters) FROM (
     SELECT b.conv_id, r.i, left(b.way, 9)::BIGINT + e.cost + CASE WHEN e.op <> 'D' AND r.flaw = 't' THEN 5 ELSE 0 END AS cost, substr(b.way, 10) || e.op AS audit,
       CASE WHEN e.op = 'D' THEN b.q WHEN e.op = 'L' THEN 's' WHEN b.q = 'u' THEN 'a' ELSE 'u' END AS q
     FROM best b JOIN flagged r ON r.conv_id = b.conv_id AND r.i = b.i + 1, (VALUES ('K', 0), ('L', 0), ('R', 1), ('D', 2)) AS e(op, cost)
     WHERE e.op = 'D' OR (r.flaw NOT IN ('b', 'd') AND CASE e.op WHEN 'L' THEN b.q = '-' AND r.x = 's' WHEN 'K' THEN r.x = CASE b.q WHEN 'u' THEN 'a' ELSE 'u' END
       ELSE r.x <> CASE b.q WHEN 'u' THEN 'a' ELSE 'u' END END)) AS step JOIN put USING (q)
   GROUP BY conv_id, i, q2),
 last AS (SELECT conv_id, left(way, 9)::BIGINT AS cost, substr(way, 10) AS letters FROM (SELECT conv_id, min(way) AS way FROM best JOIN facts USING (conv_id) WHERE i = n AND q IN ('-', 'a') GROUP BY conv_id)),
 edits AS (SELECT *, count(*) FILTER (op <> 'I') OVER w AS i, count(*) FILTER (op <> 'D') OVER w - CASE WHEN letters LIKE '%L%' THEN 1 ELSE 0 END AS k
   FROM (SELECT conv_id, letters, p, substr(letters, p, 1) AS op FROM last, unnest(range(1, length(letters) + 1)) AS u(p)) WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
 texts AS (SELECT e.conv_id, string_agg(CASE WHEN op IN ('K', 'L') THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE op WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t
   FROM edits e LEFT JOIN flagged r ON r.conv_id = e.conv_id AND r.i = e.i WHERE op <> 'D' GROUP BY e.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, replace(coalesce(letters, ''), 'L', 'K') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN last USING (conv_id) LEFT JOIN texts USING (conv_id)""",
    "op12_importance_resampling": rf"""
WITH {_CRC_TABLE},
 words AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
 wanted AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
 buckets AS (SELECT w, {_crc_sql("w")} % 10000 AS b FROM (SELECT w FROM words UNION SELECT w FROM wanted), crc_table),
 s AS (SELECT b, count(*) AS n FROM words JOIN buckets USING (w) GROUP BY b), t AS (SELECT b, count(*) AS n FROM wanted JOIN buckets USING (w) GROUP BY b),
 gain AS (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000) / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000))))::BIGINT AS g FROM s LEFT JOIN t USING (b)),
 d AS (SELECT doc_id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM words JOIN buckets USING (w) JOIN gain USING (b) GROUP BY doc_id),
 scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
     coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN d USING (doc_id)),
 placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * able // 100 THEN r END::BIGINT AS rank FROM scored LEFT JOIN placed USING (doc_id)""",
    "op13_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
 reached AS (SELECT u, u AS w FROM links UNION SELECT reached.u, links.w FROM reached JOIN links ON reached.w = links.u),
 least AS (SELECT u, min(w) AS w FROM reached GROUP BY u), many AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(w, vec_id) AS component_id, coalesce(w, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON least.u = vec_id LEFT JOIN many ON many.u = vec_id""",
}
