"""Every operator and stage on odd rows, on an empty table, and with columns of clashing names."""

import pytest

import corpus_pipeline
from headway.llm import bpe, decontaminate, language, lines, minhash, phrases, quality, repeats, secrets, url_filter
from headway.llm.queries import URL_RULES, table, vocabulary

ROWS = 13


def benchmark(spark, sf):
    return table(spark, sf, "benchmark")


OPERATORS = {
    "secrets": lambda d, sf: secrets.scan_secrets(d, vocabulary(secrets.VOCABULARY)),
    "phrases": lambda d, sf: phrases.fingerprint_neighbours(d),
    "minhash": lambda d, sf: minhash.near_duplicates(d),
    "repeats": lambda d, sf: repeats.remove_repeats(d),
    "bpe": lambda d, sf: bpe.encode_decode(d, vocabulary("word_bpe_49k.json")),
    "lines": lambda d, sf: lines.dedup_lines(d),
    "language": lambda d, sf: language.identify(d, language.train(language.training_sample(d))),
    "quality": lambda d, sf: quality.score_quality(d, None),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_every_document(name, odd, sf_dir):
    assert OPERATORS[name](odd, sf_dir).toPandas().shape[0] == ROWS


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(name, odd, sf_dir):
    assert OPERATORS[name](odd.limit(0), sf_dir).toPandas().empty


def test_leaks_on_odd_rows(spark, odd, sf_dir):
    found = decontaminate.find_leaks(odd, benchmark(spark, sf_dir))
    assert found.count() == 0
    assert decontaminate.drop_leaks(odd, benchmark(spark, sf_dir)).count() == ROWS
    none = benchmark(spark, sf_dir).limit(0)
    assert decontaminate.find_leaks(odd, none).count() == 0 and decontaminate.drop_leaks(odd, none).count() == ROWS
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " "), (None, "another text of the same id")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.distance) for r in decontaminate.find_leaks(odd, blank).collect()] == [(8, None, 0)]


def test_model_without_training_rows(odd, labels):
    assert quality.fit(odd, labels.limit(0)) is None
    assert {r.score for r in quality.score_quality(odd, None).collect()} == {0.5}
    assert language.train([]) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}


def test_results_on_odd_rows(odd):
    near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert near[1, 12] == (1, True) and near[2, 12] == (1, False)
    assert near[3, 0] == (3, True) and near[4, 0] == (4, True) and near[5, 0] == (5, True) and near[None, 0] == (None, True)
    assert near[9, 1] == (9, True)
    gone = {r.doc_id: r for r in repeats.remove_repeats(odd).collect()}
    assert gone[2].n_removed == gone[2].n_bytes and gone[1].n_removed == 0 and gone[None].n_removed == 0
    assert gone[7].n_removed == gone[7].n_bytes - 4 and gone[7].n_spans == 1
    assert gone[9].n_removed == 0
    kept = {(r.doc_id, r.text) for r in lines.dedup_lines(odd).collect()}
    assert (2, "") in kept and (3, None) in kept and (4, "") in kept


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(k, spark, odd, sf_dir):
    name, stage = corpus_pipeline.STAGES[k]
    documents = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for df in (documents, odd):
        out = stage(spark, df, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == df.columns
        assert out.count() <= ROWS
        assert stage(spark, df.limit(0), sf_dir).count() == 0


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.org", "https://a.Example.ORG/es/x?y#z", "ftp://x.com/de/#/fr/",
            "http://com/fr/", "http://xcom/fr/", "x://y://org/", "http://example.org/en/1\n2", "http://a..org/", "http://é.org/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] * 2, "page_id long, url string, salt string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.rules_frame(spark, URL_RULES)).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("example.org", "", None, "allow"), 5: ("a.example.org", "/es/x", "example.org/es/", "block"),
        6: ("x.com", "/de/", "com/de/", "block"), 7: ("com", "/fr/", "com/fr/", "allow"), 8: ("xcom", "/fr/", None, "allow"),
        9: ("y:", "//org/", None, "allow"), 10: ("example.org", "/en/1\n2", "example.org/en/1", "block"),
        11: ("a..org", "/", "org/", "allow"), 12: ("é.org", "/", "org/", "allow"),
    }
    assert url_filter.filter_urls(pages.limit(0), url_filter.rules_frame(spark, URL_RULES)).count() == 0
    assert url_filter.filter_urls(pages, url_filter.rules_frame(spark, [])).filter("rule is not null").count() == 0
