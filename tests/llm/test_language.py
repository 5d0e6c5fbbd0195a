from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from casebook.llm import language
from tests.llm.frames import documents, edge_documents, empty

SF = "/root/testdata/sf0.01"
RUSSIAN = "это простой текст на русском языке и он довольно короткий "
ENGLISH = "this is a plain text in the english language and it is rather short "
GERMAN = "dies ist ein einfacher text in deutscher sprache und er ist ziemlich kurz "


def model(spark):
    rows = [(t * 3, lang) for lang, t in (("ru", RUSSIAN), ("en", ENGLISH), ("de", GERMAN)) for _ in range(4)]
    return language.fit(spark.createDataFrame([*rows, (None, "en"), ("x", None)], "text string, lang string"), "text", "lang")


def test_held_out_accuracy(spark):
    found = language.op7_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    row = found.join(docs, "doc_id").where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert row[0] > 0.98
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_spans_of_mixed_text_round_trip(spark):
    text = ENGLISH + RUSSIAN + GERMAN
    found = language.identify(documents(spark, [(1, text)]), model(spark), spans=True, keep=("doc_id",)).first()
    assert [s.lang for s in found.spans] == ["en", "ru", "de"]
    assert [text[s.start : s.end].split()[0] for s in found.spans] == ["this", "это", "dies"]
    assert found.spans[-1].end == len(text.rstrip())


def test_script_narrows_candidates(spark):
    m = model(spark)
    found = language.identify(documents(spark, [(1, "щщщ жжж"), (2, "zzz qqq")]), m).collect()
    assert found[0].lang_pred == "ru"
    assert found[1].lang_pred in ("en", "de")


def test_decoding_agrees_with_one_text_at_a_time():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 5, 1, 40, 7, 0, 40])
    scores = rng.normal(size=(sizes.sum(), 3)).astype(np.float32) * 3
    labels, _ = language.decode(scores, sizes, np.zeros((len(sizes), 3), np.float32), 2.0)
    at = 0
    for n in sizes:
        own = scores[at : at + n].astype(float)
        best, back = np.zeros(3), []
        for s in own:
            move = best.max() - 2.0
            back.append(np.where(best >= move, np.arange(3), best.argmax()))
            best = np.maximum(best, move) + s
        want, now = [], int(best.argmax())
        for b in reversed(back):
            want.append(now)
            now = int(b[now])
        assert labels[at : at + n].tolist() == want[::-1]
        at += n


def test_long_text_in_pieces_counts_every_letter(spark, monkeypatch):
    m, kinds = model(spark), language.letter_table()
    text = (ENGLISH + RUSSIAN) * 30
    whole, _ = language.label_texts([text], m, kinds, 8.0, False)
    monkeypatch.setattr(language, "PIECE", 100)
    parts, _ = language.label_texts([text], m, kinds, 8.0, False)
    letters = sum(c.isalpha() for c in text)
    assert whole.sum() == parts.sum() == letters
    assert abs(whole - parts).max() < 0.05 * letters
    assert "".join(p for _, p in language.pieces(text, 50)) == text


def test_edge_rows(spark):
    found = language.identify(edge_documents(spark), model(spark), keep=("doc_id", "TEXT"), spans=True)
    rows = found.collect()
    assert len(rows) == 14
    und = sorted(r.doc_id for r in rows if r.lang_pred == language.UNDETERMINED)
    assert und == [0, 1, 2, 6]
    assert all(r.score == 0 and not r.spans for r in rows if r.lang_pred == "und")
    assert language.identify(empty(edge_documents(spark)), model(spark)).count() == 0


def test_without_labels_all_is_undetermined(spark):
    none = language.fit(spark.createDataFrame([], "text string, lang string"), "text", "lang")
    assert {r.lang_pred for r in language.identify(documents(spark, [(1, "some text")]), none).collect()} == {"und"}


def test_labels_do_not_depend_on_pieces(spark, monkeypatch):
    m, kinds = model(spark), language.letter_table()
    rng = np.random.default_rng(5)
    words = (ENGLISH + " " + RUSSIAN).split() + ["x" * 70, "İß", "-", "7"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 400))) for _ in range(12)] + ["y" * 500, "", " ".join(words)]
    whole = language.label_texts(texts, m, kinds, 4.0, True)
    for size in (1, 17, 100):
        monkeypatch.setattr(language, "PIECE", size)
        counts, spans = language.label_texts(texts, m, kinds, 4.0, True)
        assert counts.tolist() == whole[0].tolist()
        assert spans == whole[1]


def test_columns_may_have_the_names_of_results(spark):
    names = ["c2", "lang_pred", "score", "doc_id", "text", "spans", "c0"]
    df = spark.createDataFrame([(7, "mine", 0.5, "d-1", ENGLISH, "s", 1)], names)
    found = language.identify(df, model(spark), keep=tuple(names))
    assert found.columns == names + ["lang_pred", "score"]
    assert tuple(found.first())[:7] == (7, "mine", 0.5, "d-1", ENGLISH, "s", 1) and found.first()[7] == "en"
