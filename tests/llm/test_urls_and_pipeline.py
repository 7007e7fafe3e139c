import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from llm_helpers import documents, edge_docs, empty_docs
from strideframe.llm import catalog, urlfilter
from strideframe.plans.oracle_check import duck, rows_of

DAY = 86_400


def test_op1_equals_its_oracle(spark, sf_small):
    got = catalog.op1_url_filter(spark, sf_small)
    cur = duck(sf_small).execute(catalog.oracle_sql()["op1_url_filter"])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, cur.fetchall())


def run(spark, captures, entries):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at long, rule string")
    e = spark.createDataFrame(entries, "rule string, pattern string, action string, listed_at long")
    return urlfilter.filter_urls(c, e)


def test_intervals_begin_and_end_at_entries(spark):
    entries = [
        ("host", "a.com", "block", 10 * DAY),
        ("host", "a.com", "remove", 50 * DAY),
        ("host", "a.com", "allow", 90 * DAY),
        ("host", "a.com", "allow", 90 * DAY),
        ("host", "a.com", "block", 90 * DAY),
        ("domain", "b.com", "block", 5 * DAY),
        ("host", "good.b.com", "allow", 20 * DAY),
        ("prefix", "good.b.com/ads", "block", 0),
        ("domain", None, "block", 0),
        ("other", "a.com", "block", 0),
    ]
    times = {"http://a.com/": [9, 10, 49, 50, 89, 90, 400], "https://u@X.good.B.com:80/ads/x?q": [6], "http://good.b.com/ads/": [30], "http://good.b.com/adsx": [4, 10, 30]}
    captures = [(i, u, t * DAY, None) for i, (u, t) in enumerate((u, t) for u, ts in times.items() for t in ts)]
    captures += [(100, None, DAY, None), (101, "not a url", DAY, None), (102, "http://a.com", None, None), (None, "http://a.com", 20 * DAY, "x"), (103, "http://a.com", 20 * DAY, None), (103, "http://a.com", 20 * DAY, None)]
    rows = run(spark, captures, entries).collect()
    assert len(rows) == len(captures)
    got = {r["page_id"]: (r["blocked"], r["rule"], r["verdict"]) for r in rows}
    assert [got[i][0] for i in range(7)] == [False, True, True, False, False, True, True]
    assert got[7] == (True, "domain", "block")
    assert got[8] == (True, "prefix", "block")
    assert [got[i] for i in (9, 10, 11)] == [(False, None, None), (True, "domain", "block"), (False, "host", "allow")]
    assert [got[i][0] for i in (100, 101, 102, None, 103)] == [False, False, False, True, True]


def test_empty_list_and_empty_captures(spark):
    assert [r["blocked"] for r in run(spark, [(1, "http://a.com", 5, None)], []).collect()] == [False]
    assert run(spark, [], [("host", "a.com", "block", 0)]).count() == 0


def test_url_filter_has_no_python_nodes(spark, sf_small):
    plan = catalog.op1_url_filter(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- pipeline


def test_pipeline_stages_keep_the_columns(spark, sf_small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "secret_scan", "bpe"]
    docs = documents(spark, sf_small)
    for table in (docs, empty_docs(spark), edge_docs(spark)):
        n = table.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_small)
            assert out.columns == docs.columns and out.count() <= n
        assert corpus_pipeline.STAGES[-1][1](spark, table, sf_small).count() == n


def test_pipeline_equals_its_parts_by_brute_force(spark, sf_small):
    from test_corpus_operators import brute_classes
    from test_text_operators import brute_contamination
    from strideframe.llm import langid, secrets

    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_small).collect()}
    docs = documents(spark, sf_small)
    model = langid.fit(docs)
    kept = [(r["doc_id"], r["text"]) for r in langid.identify(docs, model).filter("not lang_rejected").collect()]
    classes = brute_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = brute_contamination(kept, items)
    kept = {i: t for i, t in kept if not dirty[i][4]}
    assert set(rows) == set(kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in kept.items():
        for rule in secrets.RULES:
            for m in rule.compiled().finditer(text):
                if m.end(rule.group) - m.start(rule.group) >= rule.min_group:
                    assert rows[i]["n_tokens"] > 0
        decoded = tokenizer.decode(list(rows[i]["ids"]), skip_special_tokens=False)
        assert not any(len(m[0]) >= 16 for m in re.finditer("[0-9a-f]+", decoded))
        if decoded != text:
            assert "[secret]" in decoded
            assert len(re.split(re.escape("[secret]"), decoded)[0]) <= len(text) and text.startswith(decoded.split("[secret]")[0])


def test_pipeline_stages_bound_their_batches(spark, sf_small):
    docs = documents(spark, sf_small)
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, sf_small)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20


def test_pipeline_near_copies_leave_the_least_document(spark):
    base = " ".join(f"word{i}" for i in range(120))
    docs = spark.createDataFrame([(3, base, "en", "s", 1), (1, base + " more", "en", "s", 1), (2, "other text here that is quite different", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.count() == 2 and {r["doc_id"] for r in kept.collect()} >= {2}


def test_entry_lists_the_llm_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert set(entry.oracle_sql()) <= names
