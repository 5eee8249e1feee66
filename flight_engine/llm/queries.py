"""Registered queries of the operators: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.llm.store import lean_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.quality_rules import rule_verdicts
    return rule_verdicts(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.license_scan import scan_licences
    return scan_licences(_table(spark, sf_dir, "documents"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.ngram_join import similar_components
    return similar_components(_table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.decontaminate import contained_items
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.suffix_dedup import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents"), copies="all").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.language_id import identify
    return identify(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.mixing import mixing_rates
    return mixing_rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.warc import read_records, write_archives
    from flight_engine.session import scratch_path
    path = scratch_path(spark, "warc")
    write_archives(_table(spark, sf_dir, "pages"), path)
    return read_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.secret_scan import secret_digests
    return secret_digests(_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.pii import pii_digests
    return pii_digests(_table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.sharding import shard_slots
    return shard_slots(_table(spark, sf_dir, "documents"), 8)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.spelling import letter_runs, planted_deletions, variants, word_counts
    runs = letter_runs(_table(spark, sf_dir, "documents")).where(F.char_length("run") >= 6)
    return variants(word_counts(planted_deletions(runs)))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flight_engine.llm.importance import resample
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op11_sharding": op11_sharding,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_importance_resampling": op13_importance_resampling,
    "op6_pii": op6_pii,
    "op3_secret_scan": op3_secret_scan,
    "op2_warc_chunks": op2_warc_chunks,
    "op9_mixing": op9_mixing,
    "op5_language_id": op5_language_id,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op10_license_scan": op10_license_scan,
    "op7_quality_rules": op7_quality_rules,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = f"""
    SELECT DISTINCT id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') || ' .'
                             ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM (SELECT id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
          FROM (SELECT {{id}} AS id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {{table}})
          WHERE len(w) > 0)"""

#: CRC-32 by its table, which the rule of the polynomial makes.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i::BIGINT)) AS t)"""
_CRC = """xor(list_reduce(list_transform(regexp_extract_all(hex({text}), '..'),
            lambda x: 16 * (instr('0123456789ABCDEF', x[1]) - 1) + instr('0123456789ABCDEF', x[2]) - 1),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295)"""
_HEX = """list_reduce(list_transform(range(1, {n} + 1), lambda i: (instr('0123456789abcdef', {text}[i]) - 1)::UHUGEINT),
        lambda a, b: a * 16 + b)"""
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE: dict[str, str] = {
    "op11_sharding": f"""
        WITH RECURSIVE {_CRC_TABLE},
        keys AS (SELECT DISTINCT doc_id, sha256(coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
        jumps AS (
            SELECT doc_id, g, {_HEX.format(n=16, text="s")} AS state, -1::BIGINT AS shard, 0::BIGINT AS ahead
            FROM keys, (VALUES (8), (9)) AS v(g)
            UNION ALL
            SELECT doc_id, g, drawn, ahead, floor((ahead + 1)::DOUBLE * (2147483648::DOUBLE / (drawn // 8589934592 + 1)::DOUBLE))::BIGINT
            FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS drawn FROM jumps WHERE ahead < g)),
        placed AS (SELECT doc_id, max(shard) FILTER (g = 8) AS shard, max(shard) FILTER (g = 9) AS grown_shard FROM jumps GROUP BY doc_id),
        d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, coalesce({_CRC.format(text="coalesce(text, '')")}, 0) AS text_crc32
              FROM documents, crc_table)
        SELECT d.doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
               grown_shard::INTEGER AS grown_shard
        FROM d JOIN placed ON d.doc_id IS NOT DISTINCT FROM placed.doc_id""",
    "op12_spelling_variants": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT doc_id, run, count(*) AS c
                 FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
                 WHERE length(run) >= 6 GROUP BY ALL),
        hashed AS (SELECT run, c, {_CRC.format(text="coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table),
        words AS (SELECT word, sum(c)::BIGINT AS n
                  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
                        FROM hashed)
                  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
        cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS d
                 FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        longer AS (SELECT DISTINCT c.word AS x, c.n AS x_n, w.word AS y, w.n AS y_n FROM cuts c JOIN words w ON c.d = w.word),
        near AS (SELECT x AS word, x_n AS n, y AS other, y_n AS m FROM longer
                 UNION ALL SELECT y, y_n, x, x_n FROM longer
                 UNION ALL SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN cuts b ON a.d = b.d AND a.i = b.i AND a.word <> b.word),
        best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word, n),
        forms AS (SELECT word, n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM best),
        paths AS (SELECT word, word AS root, 0 AS steps FROM words
                  UNION ALL SELECT p.word, f.form, steps + 1 FROM paths p JOIN forms f ON p.root = f.word WHERE f.form IS NOT NULL)
        SELECT w.word, f.form, r.root, w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
        FROM words w LEFT JOIN forms f ON w.word = f.word
             JOIN (SELECT word, arg_max(root, steps) AS root FROM paths GROUP BY word) r ON w.word = r.word""",
    "op13_importance_resampling": f"""
        WITH {_CRC_TABLE},
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        f AS (SELECT r, word, count(*) AS c FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY ALL),
        q AS (SELECT word, count(*) AS c FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY ALL),
        b AS (SELECT word, {_CRC.format(text="word")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM f UNION SELECT word FROM q), crc_table),
        s AS (SELECT bucket, sum(c) AS n FROM f JOIN b USING (word) GROUP BY bucket),
        t AS (SELECT bucket, sum(c) AS n FROM q JOIN b USING (word) GROUP BY bucket),
        gains AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
                                                   / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
                  FROM s LEFT JOIN t ON s.bucket = t.bucket),
        weights AS (SELECT r, sum(c * gain)::BIGINT AS weight FROM f JOIN b USING (word) JOIN gains USING (bucket) GROUP BY r),
        scored AS (SELECT r, doc_id, len(w) AS n, coalesce(weight, 0) AS weight,
                          {_HEX.format(n=8, text="sha256('2024:' || coalesce(doc_id::VARCHAR, ''))")}::DOUBLE AS h
                   FROM d LEFT JOIN weights USING (r)),
        final AS (SELECT r, doc_id, n, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored),
        ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS every
                  FROM final WHERE n >= 20)
        SELECT doc_id, n AS n_features, weight, score, CASE WHEN place <= every * 10 // 100 THEN place END AS rank
        FROM final LEFT JOIN ranks USING (r)""",
    "op2_warc_chunks": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
             f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
        SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
               CASE WHEN n < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN n < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM p LEFT JOIN f ON p.d = f.d AND n >= 100""",
    "op4_benchmark_decontamination": f"""
        WITH q AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
             d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
             n AS (SELECT id, count(*) AS n FROM q GROUP BY id)
        SELECT d.id AS doc_id, q.id AS item_id, n.n AS n_item_shingles, count(*) AS n_shared,
               count(*) / n.n AS containment
        FROM d JOIN q ON d.s = q.s JOIN n ON n.id = q.id
        GROUP BY d.id, q.id, n.n HAVING 100 * count(*) >= 80 * n.n""",
}
