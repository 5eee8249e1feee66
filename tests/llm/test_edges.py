"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import brute
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    long_text = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", 0, 1, "x"), (2, "", None, "a", 0, 1, "x"), (3, " \n\t ", "en", None, 3, 1, "x"),
        (4, "one two", "en", "a", 7, 1, "x"), (5, "one two", "en", "a", 7, 1, "x"), (5, "one two", "en", "a", 7, 1, "x"),
        (None, "a row without an id but with some words in it to read", "en", "a", None, 1, None),
        (7, long_text, "en", "a", len(long_text), 1, "x"), (8, long_text, "en", "b", len(long_text), 1, "x"),
        (9, "é" * 3000, None, None, 3000, 1, "x"), (10, "x" * 5000, "fr", "b", 5000, 1, "x"), (11, "= " * 300 + "-" * 300, "de", "a", 900, 1, "x"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def no_documents(spark, odd_documents):
    return spark.createDataFrame([], odd_documents.schema)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None)], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 1, 0), (7, 0, 1), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")


def operators(benchmark, labels):
    from flight_engine.llm import decontaminate, language_id, license_scan, mixing, ngram_join, pii, quality_rules, secret_scan, suffix_dedup
    return {
        "join": ngram_join.similar_components, "one": ngram_join.one_per_group,
        "contained": lambda d: decontaminate.contained_items(d, benchmark), "clean": lambda d: decontaminate.clean_documents(d, benchmark),
        "language": language_id.identify, "licence": license_scan.scan_licences, "mix": lambda d: mixing.mixing_rates(d, labels),
        "mixed": lambda d: mixing.mix_documents(d, labels), "pii": pii.pii_digests, "redact": pii.redact, "verdicts": quality_rules.rule_verdicts,
        "keep": quality_rules.keep_documents, "secrets": secret_scan.secret_digests, "strip": suffix_dedup.remove_repeats,
        "strip_all": lambda d: suffix_dedup.remove_repeats(d, "all"),
    }


NAMES = ["join", "one", "contained", "clean", "language", "licence", "mix", "mixed", "pii", "redact", "verdicts", "keep", "secrets", "strip", "strip_all"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(no_documents, benchmark, labels, name):
    assert operators(benchmark, labels)[name](no_documents).count() == 0


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("one", "contained", "clean", "mixed", "keep")])
def test_a_row_for_every_row(odd_documents, benchmark, labels, name):
    out = operators(benchmark, labels)[name](odd_documents)
    ids = sorted(str(r["doc_id"]) for r in out.collect())
    assert ids == sorted(str(r["doc_id"]) for r in odd_documents.collect())


@pytest.mark.parametrize("name", ["one", "clean", "redact", "keep"])
def test_documents_keep_their_columns(odd_documents, benchmark, labels, name):
    out = operators(benchmark, labels)[name](odd_documents)
    assert out.columns == odd_documents.columns and [t for _, t in out.dtypes] == [t for _, t in odd_documents.dtypes]


def test_defined_results(odd_documents, benchmark, labels):
    ops = operators(benchmark, labels)
    join = {(r.doc_id, r.n_shingles, r.component_id) for r in ops["join"](odd_documents).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (7, 997, 7), (8, 997, 7)} <= join
    assert any(i is None and c is None for i, _, c in join)
    kept = [r.doc_id for r in ops["one"](odd_documents).collect()]
    assert sorted(i for i in kept if i is not None) == [1, 2, 3, 4, 7, 9, 10, 11] and kept.count(None) == 1
    language = {r.doc_id: r for r in ops["language"](odd_documents).collect()}
    assert all(language[i].lang_pred == "und" and language[i].score == 0 for i in (1, 2, 3, 11))
    licence = {r.doc_id: r for r in ops["licence"](odd_documents).collect()}
    assert (licence[1].n_words, licence[1].labels, licence[1].first_word, licence[1].score) == (0, "", None, 0.0)
    verdict = {r.doc_id: r for r in ops["verdicts"](odd_documents).collect()}
    assert all(verdict[i].base_failed and not verdict[i].kept for i in (1, 2, 3, 4))
    secret = {r.doc_id: r for r in ops["secrets"](odd_documents).collect()}
    assert (secret[1].spans, secret[1].base_sha256) == ("", brute.sha(""))
    strip = {r.doc_id: r for r in ops["strip_all"](odd_documents).collect()}
    assert len(strip[7].kept) == len(strip[8].kept) == 0 and len(strip[9].kept) == 0 and strip[1].n_bytes == 0
    assert len({r.doc_id: r for r in ops["strip"](odd_documents).collect()}[8].kept) == 0


def test_mixing_without_labels_leaves_rates_at_one(spark, odd_documents, labels):
    from flight_engine.llm.mixing import mixing_rates
    none = spark.createDataFrame([], labels.schema)
    rows = mixing_rates(odd_documents, none).collect()
    assert all(r.domain == "all" and r.rate == 1.0 and r.copies == 1 for r in rows)


def test_warc_of_an_empty_table(spark):
    from flight_engine.llm.warc import read_records, write_archives
    from flight_engine.session import scratch_path
    path = scratch_path(spark, "t-warc-empty")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_records(spark, path).count() == 0


def test_decontamination_without_items(spark, odd_documents):
    from flight_engine.llm.decontaminate import clean_documents, contained_items
    none = spark.createDataFrame([], "item_id long, text string")
    assert contained_items(odd_documents, none).count() == 0
    assert clean_documents(odd_documents, none).count() == odd_documents.count()


def test_components_of_long_chains_and_stars(spark):
    from flight_engine.llm.components import components
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (2001, 2000), (2000, 2001)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}, 2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kernels_do_not_depend_on_block_size(spark):
    import numpy as np
    import pyarrow as pa
    from flight_engine.llm import text as tx
    texts = ["Ab cd  ef", None, "", "x" * 5000 + " yé zz", "a b c d e f g"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    out = []
    for block in (1, 64, 1 << 20):
        parts = [tx.shingles(h, e, 3)[0] for _, d, o in tx.text_blocks(iter([batch]), block=block) for h, _, _, e in [tx.word_hashes(d, o)]]
        out.append(np.concatenate(parts))
    assert (out[0] == out[1]).all() and (out[0] == out[2]).all()
    assert tx.hash_of("ab") == int(tx.word_hashes(*tx.text_buffer(pa.array(["q AB"])))[0][1])


def test_pipeline_stages(spark):
    import corpus_pipeline
    from brute import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII",
                                                      "mixing sources to target weights"]
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    assert out.columns[:len(docs.columns)] == docs.columns and 0 < len(rows) < docs.count()
    assert all(r.mix_copies >= 1 and r.n_chars == len(r.text) and not brute.pii(r.text) for r in rows)
    bench = [brute.shingles(r.text, 5) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert not any(100 * len(q & brute.shingles(r.text, 5)) >= 80 * len(q) for r in rows for q in bench)
    assert out.select(F.countDistinct("doc_id")).first()[0] == len(rows)


def test_one_per_group_with_clashing_names(spark):
    from flight_engine.llm.ngram_join import one_per_group
    a = " ".join(f"a{i}" for i in range(30))
    rows = [(1, a, 7, 8, 9, "x"), (2, a + " more", 7, 8, 9, "x"), (3, "b " * 9, 7, 8, 9, "x"), (3, "c d e f g h i", 7, 8, 9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, many_id int, own_id int, component string")
    out = one_per_group(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 3]
