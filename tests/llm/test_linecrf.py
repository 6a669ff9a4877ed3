import random
import zlib

import numpy as np
from helpers import frame, junk, odd_documents, prose, with_clashes

from geoloom.llm import linecrf as L


def corpus(seed, n):
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        good = prose(rng, rng.randint(10, 150), line=8)
        if k % 3 == 0:
            good += "\n" + "\n".join(junk(rng, 15) for _ in range(rng.randint(3, 9)))
        texts.append(good)
        labels.append(float(k % 3 != 0))
    return texts, np.array(labels)


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 0, 4])
    emission, moves = rng.normal(size=8), np.exp(rng.normal(size=(2, 2)))
    got, pairs, norm = L.Chains(lengths).marginals(emission, moves)
    at, want, seen, total = 0, [], np.zeros((2, 2)), 0.0
    for n in lengths:
        z, good = 0.0, np.zeros(n)
        moved = np.zeros((2, 2))
        for code in range(2**n) if n else []:
            y = [code >> k & 1 for k in range(n)]
            p = np.exp(sum(emission[at + k] for k in range(n) if y[k]))
            for a, b in zip(y, y[1:]):
                p *= moves[a, b]
            z += p
            good += p * np.array(y)
            for a, b in zip(y, y[1:]):
                moved[a, b] += p
        if n:
            want += list(good / z)
            seen += moved / z
            total += np.log(z)
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, seen) and np.isclose(norm, total)


def test_line_features():
    x, size = L.line_features("One two two.\n\n ## $$ $$\nOne two two.")
    assert x.shape == (3, L.WIDTH) and list(size) == [12, 9, 12]
    assert x[2, 6] == 1 and x[0, 6] == 0  # repeats an earlier line
    assert x[1, 1] == 1 and x[0, 1] == 0  # odd signs
    assert np.allclose(x[0, 1 + L.MEASURES + L.SHARED + 1 :][: L.SHARED], x[1, 1 : 1 + L.SHARED])  # the next line's measures


def test_neighbours_matter():
    model = L.Model(np.eye(L.WIDTH)[2] * -6 + np.eye(L.WIDTH)[0], np.array([[4.0, 0.2], [0.2, 4.0]]), 1, 0)
    plain = "and so on.\n"
    alone, among = model.quality([plain, "$$ ## &&\n" * 3 + plain + "$$ ## &&\n" * 3])
    assert among < alone


def test_held_out_accuracy():
    model = L.fit(*corpus(1, 300))
    texts, labels = corpus(2, 150)
    assert ((model.score(texts) >= 0.5) == (labels == 1)).mean() > 0.97


def test_odd_documents_score_and_repeat(spark):
    rows = odd_documents()
    labels = [(i, 0 if 40 <= i < 55 else 1) for i, *_ in rows if i is not None and i >= 20] + [(None, 1), (21, None), (22, 7), (23, 1)]
    labelled = spark.createDataFrame([(i, y, "x") for i, y in labels], "doc_id bigint, quality int, text string")
    got = L.quality(with_clashes(frame(spark, rows)), labelled).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["fp"] == "kept as it is" for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"], r["score"]) == r["score"]
    assert by_text[None] == by_text[""] == by_text[" \n\t "] == min(by_text.values())
    assert all(r["predicted"] == int(r["doc_id"] < 40) for r in got if r["doc_id"] and r["doc_id"] >= 20)


def test_held_out_rows_do_not_train(spark):
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 3 == 1]
    df = frame(spark, [(k, "good words here.", "en", "s", 1) for k in range(200)])
    assert {r[0] for r in df.where(L.held_out(df["doc_id"])).collect()} == set(held)
    labels = spark.createDataFrame([(k, int(k not in held)) for k in range(200)], "doc_id bigint, quality int")
    # only label 1 is left: no model, the score is the share of label 1
    assert L.train(df, labels).slope == 0


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = L.quality(frame(spark, odd_documents()), none).collect()
    assert {r["score"] for r in got} == {0.5}
    assert L.quality(frame(spark, []), none).count() == 0
