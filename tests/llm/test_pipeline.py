"""The pipeline: its stages judged on their own inputs, and the whole run."""

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES
from test_lines_and_mix import expected as expected_lines
from test_ngram_join import expected as expected_groups
from tidemark.plans.storage import stage


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, results = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"test-{name}")
        results.append([r.asDict() for r in docs.collect()])
        if name != STAGES[-1][0]:
            assert docs.columns == COLUMNS
    clean, lines, single, mixed, encoded = results
    assert 800 < len(clean) < 1000
    assert sorted((r["doc_id"], r["text"]) for r in lines) == sorted(
        (d, t) for d, t, _, _ in expected_lines([(r["doc_id"], r["text"]) for r in clean]))
    groups = expected_groups([(r["doc_id"], r["text"]) for r in lines], 5, 80)
    assert sorted(r["doc_id"] for r in single) == sorted(d for d, _, c in groups if d == c)
    words = {r["doc_id"]: len(r["text"].split()) for r in single}
    assert 1.3 * sum(words.values()) < sum(words[r["doc_id"]] for r in mixed) <= 1.5 * sum(words.values())
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed)
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in encoded)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.ids) for r in whole.select("doc_id", "ids").collect()) == sorted((r["doc_id"], r["ids"]) for r in encoded)


def test_stages_take_odd_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "a text", "en", "a", 6), (3, "a text", None, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for some in (docs, docs.limit(0)):
        now = some
        for _, step in STAGES:
            now = stage(step(spark, now, sf_dir), "test-odd")
        assert now.count() <= 2 * some.count()


def test_last_stage_encodes_and_decodes(spark, sf_dir, odd_texts):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = odd_texts + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(texts)))
    for r in out:
        ids = library.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, library.decode(ids))


def test_near_copies_are_judged_row_by_row(spark, sf_dir):
    base = [f"w{i}" for i in range(60)]
    text, near, other, third = " ".join(base), " ".join(base[:-1]), "quite another text that stands alone here", "one more text like no other at all"
    rows = [(1, text, "en", "a"), (5, near, "en", "a"), (5, other, "en", "a"),  # one text of id 5 is a copy, the other is not
            (7, third, "en", "b"), (7, third, "en", "b"), (7, third, "en", "b"),  # equal rows
            (8, third + " x", "en", "a"), (8, "a b c d e f g", "de", "a"),
            (9, "p q r s t u", "en", "a"), (9, "v w x y z a b", "en", "a"),  # different texts, both alone
            (11, "same id two sources here now", "en", "b"), (11, "same id two sources here now", "en", "c"),
            (None, text, "en", "a"), (None, text, "en", "a"), (12, "", "en", "a"), (12, "", "en", "a"), (13, None, "en", "a")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    near_copies = dict(STAGES)["near_copies"]
    got = [[(r.doc_id, r.text, r.source) for r in near_copies(spark, d, sf_dir).collect()] for d in (docs, docs.repartition(5), docs.orderBy("text"))]
    key = lambda r: repr(r)
    elevens = [sorted((r for r in g if r[0] == 11), key=key) for g in got]
    assert len(elevens[0]) == 1 and elevens[0] == elevens[1] == elevens[2]
    want = [(1, text, "a"), (5, other, "a"), (7, third, "b"), (8, "a b c d e f g", "a"), (9, "p q r s t u", "a"), (9, "v w x y z a b", "a"),
            (None, text, "a"), (None, text, "a"), (12, "", "a"), (12, "", "a"), (13, None, "a")]
    for g in got:
        assert sorted((r for r in g if r[0] != 11), key=key) == sorted(want, key=key)
