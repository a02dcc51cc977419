"""Licence scan, SentencePiece and toxicity against brute force, the library and held-out labels."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.licenses import PHRASES, TEMPLATES, Automaton, scan_licenses
from tidemark.llm.pieces import PrefixTable, encode_texts, read_model
from tidemark.llm.toxicity import Model, held_out, score_documents, train, trained_on

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrase_places(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(words))
             if words[i:i + len(p.split())] == p.split()]
    return len(words), sorted(found)


def test_licenses(make_docs, odd_texts):
    header = TEMPLATES["apache-2.0"][1].upper().replace(" ", ", ")
    texts = [*odd_texts, "CC-BY cc by, CC BY", "GNU General Public License; general public license", "cc", "by cc", header,
             "x " * 5 + header + " y" * 9 + " All rights\nreserved", "Released under the MIT License.", "license " * 5_000]
    rows = [(i, t) for i, t in enumerate(texts)] * 2
    out = scan_licenses(make_docs(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, sorted((p["first"], p["label"]) for p in r.phrases)) == phrase_places(r.text)
    spans = {r.doc_id: {s["label"] for s in r.spans} for r in out}
    at = len(odd_texts)
    assert spans[at + 4] == {"apache-2.0"} and spans[at + 5] == {"apache-2.0"} and spans[at + 6] == {"mit"} and not spans[at]
    span = next(s for r in out if r.doc_id == at + 5 for s in r.spans if s["cover"] == 1.0 and s["last"] - s["first"] > 20)
    assert span["first"] == 5
    assert scan_licenses(make_docs([]).limit(0)).collect() == []


def test_automaton_against_all_stretches():
    rng = random.Random(5)
    for _ in range(300):
        letters = [b"a", b"b", b"c"]
        templates = [(f"t{k}", [rng.choice(letters) for _ in range(rng.randint(1, 9))]) for k in range(rng.randint(1, 4))]
        phrases = [(f"p{k}", [rng.choice(letters) for _ in range(rng.randint(1, 3))]) for k in range(2)]
        automaton, words = Automaton(templates, phrases), [rng.choice(letters) for _ in range(25)]
        codes, found, matches, start = [automaton.vocabulary.get(w, -1) for w in words], [], [], 0
        for run in re.finditer(r"1+", "".join("1" if c >= 0 else "0" for c in codes)):
            automaton.stream(codes[run.start():run.end()], run.start(), 2, found, matches)
        assert sorted(found) == sorted((i, label) for label, p in phrases for i in range(25) if words[i:i + len(p)] == p)
        known = {tuple(t[i:j]) for _, t in templates + phrases for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        longest = [next(n for n in range(e + 1, -1, -1) if n == 0 or tuple(words[e - n + 1:e + 1]) in known) for e in range(25)]
        ends = [(e - longest[e] + 1, longest[e]) for e in range(25) if longest[e] >= 2 and (e == 24 or longest[e + 1] <= longest[e])]
        assert sorted((a, n) for a, n, _ in matches) == sorted(ends)
        for a, n, state in matches:
            places = {(k, e) for k, (_, t) in enumerate(templates) for e in range(n - 1, len(t)) if t[e - n + 1:e + 1] == words[a:a + n]}
            assert automaton.ends[state] == places


@pytest.fixture(scope="module")
def model_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_pieces_equal_the_library(spark, make_docs, odd_texts, model_path, sf_dir):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    texts = odd_texts + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    out = encode_texts(make_docs(list(enumerate(texts)) + [(0, None)]), model_path).collect()
    assert len(out) == len(texts) + 1
    for r in out:
        ids = library.encode(r.text or "")
        assert r.ids == ids and r.decoded == library.decode(ids)
    assert encode_texts(make_docs([]).limit(0), model_path).collect() == []


def test_random_texts_and_ids_round_trip(model_path):
    import sentencepiece

    library, coder = sentencepiece.SentencePieceProcessor(model_file=model_path), PrefixTable(read_model(model_path))
    rng, pieces = random.Random(3), list(coder.pieces)
    for _ in range(1_500):
        text = rng.choice(["".join(rng.choice(pieces).replace("▁", " ") for _ in range(rng.randint(1, 12))),
                           "".join(chr(rng.choice([rng.randint(0, 127), rng.randint(0, 0x3000), rng.randint(0x10000, 0x1FFFF)]))
                                   for _ in range(20)), "".join(rng.choice("aeinrst  \n\t▁é€x0<>,!") for _ in range(40))])
        text = text.encode("utf-8", "ignore").decode()
        ids = memoryview(coder.encode(text)).cast("i").tolist()
        assert ids == library.encode(text) and coder.decode(ids) == library.decode(ids)
        assert coder.encode_and_decode(text) == (coder.encode(text), library.decode(ids))
    loose = [coder.byte_ids[200], coder.byte_ids[65], *coder.pieces["▁the"][:1], coder.byte_ids[226], coder.byte_ids[130]]
    assert coder.decode(loose) == library.decode(loose)


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(held_out(F.col("doc_id")))
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id")
    out = score_documents(docs, trained_on(spark, sf)).select("toxic", "score").collect()
    clean, toxic = [r.score for r in out if r.toxic == 0], [r.score for r in out if r.toxic == 1]
    # Part of the toxic labels are noise: such texts hold no sign of it.
    assert sum(s >= 0.5 for s in clean) <= 0.01 * len(clean) and sum(s >= 0.5 for s in toxic) >= 0.75 * len(toxic)


def test_toxicity_at_the_edges(spark, make_docs, odd_texts):
    model = Model({"idiot": 6.0, "worth*": 2.0}, -3.0, 0.02)
    rows = [*enumerate(odd_texts), (90, "Fine. You IDIOT! Fine"), (90, "Fine. You IDIOT! Fine"), (None, "worthy")]
    out = score_documents(make_docs(rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert [r.score for r in out if not r.text] == [pytest.approx(0.02)] * 2
    bad = [r for r in out if r.doc_id == 90]
    assert [(s["sentence"], s["text"]) for s in bad[0].offending] == [(1, "You IDIOT")] and bad[0].score == bad[1].score > 0.9
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert train(make_docs(rows), none).weights == {}
    assert train(make_docs([(1, "x")]), spark.createDataFrame([(1, 1), (1, 1), (None, 0), (2, None)], "doc_id bigint, toxic int")).leak == 1.0
    assert score_documents(make_docs([]).limit(0), model).collect() == []
