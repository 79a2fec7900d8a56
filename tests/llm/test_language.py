import numpy as np

from shelfcast.llm import language
from shelfcast.llm.language import fit_language, op3_language, predict_language, window_bytes


def test_windows_cover_every_byte():
    texts = [b"", b"a" * 5, b"b" * 192, b"c" * 1000]
    x, owner, sizes = window_bytes(texts)
    assert owner.tolist() == [0, 1, 2] + [3] * 6
    for k, t in enumerate(texts):
        assert x[owner == k].tobytes().rstrip(b"\0") == t
        assert sizes[owner == k].sum() == len(t)


def test_tables_equal_the_plain_network():
    texts = [b"der hund und die katze " * 30, b"the dog and the cat " * 30, b"x"]
    model = language.train(texts[:2], ["de", "en"])
    predictor = language.Predictor(model)
    x, _, _ = window_bytes(texts)
    known = model["used"][x]
    plain = []
    for w in language.WIDTHS:
        kernel = model[f"k{w}"] * model["used"][None, :, None]
        plain.append(np.maximum(language.responses(x, kernel, model[f"b{w}"]).max(axis=1), 0))
    expected = language.softmax(np.concatenate(plain, axis=1) @ model["v"] + model["c"])
    assert known.any() and np.allclose(predictor.windows(x), expected, atol=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = op3_language(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_messy_rows_and_empty_tables(spark, messy, empty):
    model = fit_language(messy)
    rows = predict_language(messy, model).collect()
    assert len(rows) == messy.count()
    by = {r["doc_id"]: r for r in rows}
    for i in (2, 3, 4, 9):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[1]["lang_pred"] in {"en", "de", "fr"}
    assert fit_language(empty) is None
    assert predict_language(empty, None).count() == 0
    assert {r["lang_pred"] for r in predict_language(messy, None).collect()} == {"und"}


def test_whole_table_against_the_plain_network(spark, small):
    """Every text, window by window, through the untabled network; the query must say the same."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = fit_language(docs)
    got = {r["doc_id"]: r for r in op3_language(spark, small).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert got[r["doc_id"]]["lang_pred"] == "und"
            continue
        x, _, sizes = window_bytes([r["text"].encode()])
        seen = model["used"][x]
        pooled = []
        for w in language.WIDTHS:
            places = x.shape[1] - w + 1
            out = np.zeros((len(x), places, language.FILTERS)) + model[f"b{w}"]
            for j in range(w):
                out += model[f"k{w}"][j][x[:, j : j + places]] * seen[:, j : j + places, None]
            pooled.append(np.maximum(out.max(axis=1), 0))
        p = language.softmax(np.concatenate(pooled, axis=1) @ model["v"] + model["c"])
        p = (p * sizes[:, None]).sum(axis=0) / sizes.sum()
        assert np.isclose(got[r["doc_id"]]["score"], p.max(), atol=1e-3)
        if np.sort(p)[-1] - np.sort(p)[-2] > 1e-3:
            assert got[r["doc_id"]]["lang_pred"] == model["names"][int(p.argmax())]
