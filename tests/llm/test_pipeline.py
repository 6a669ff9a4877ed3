import random

import pytest
from helpers import frame, junk, odd_documents, prose
from test_linededup import brute as brute_lines
from test_mixing import words
from test_similar import brute_groups, brute_set

import __spark_entry__ as entry
import corpus_pipeline as P
from geoloom.llm import linecrf


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of all kinds with their labels, as Parquet."""
    rng = random.Random(11)
    rows = odd_documents()
    rows += [(100 + k, prose(rng, rng.randint(20, 200)), "en", f"src{k % 5}", 1) for k in range(120)]
    rows += [(300 + k, junk(rng, rng.randint(20, 200)), "de", f"src{k % 7}", 1) for k in range(60)]
    passage = "Passage starts here. " + prose(rng, 70, line=10).replace("\n", " ")
    rows += [(400 + k, f"{prose(rng, 30)} before. {passage} {prose(rng, 30)}", "en", "src0", 1) for k in range(10)]
    base = prose(rng, 1500).split(" ")
    for k in range(8):
        near = list(base)
        near[rng.randrange(len(near))] = "changed"
        rows.append((500 + k, f"only here {k} " + " ".join(w + "z" if j % 60 == k else w for j, w in enumerate(near)), "en", "src1", 1))
    path = tmp_path_factory.mktemp("pipeline")
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(not (40 <= r[0] < 55 or 300 <= r[0] < 400))) for r in rows if r[0] is not None and r[0] >= 20]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_against_brute_force(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, kept[-1], tables)
        out.write.parquet(f"{tmp_path}/{k}")
        kept.append(spark.read.parquet(f"{tmp_path}/{k}"))
    for df in kept[1:-1]:
        assert df.dtypes == docs.dtypes
    rows = [df.collect() for df in kept]
    # quality: junk goes, clean documents stay
    assert {r["doc_id"] for r in rows[1]} >= {*range(20, 40), *range(100, 220), *range(400, 410)}
    assert not {r["doc_id"] for r in rows[1]} & {*range(40, 55), *range(300, 360)}
    model = linecrf.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    assert len(rows[1]) == sum(model.score([r["text"]])[0] >= 0.5 for r in rows[0])
    # lines
    from pyspark.sql import functions as F

    hashed = kept[1].select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).collect()
    want = brute_lines([tuple(r) for r in hashed], 50)
    lines = [(r["doc_id"], *want[tuple(r)]) for r in hashed]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in rows[2]))) == sorted(map(repr, ((i, t) for i, t, n in lines if not n or words(t))))
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2] if r["doc_id"] in range(401, 410))
    # near duplicates: one of each group of five-word similarity 0.8
    part = brute_groups([r["text"] for r in rows[2]])
    assert len(rows[3]) == len(set(part.values())) == len({part[brute_set(r["text"])] for r in rows[3]})
    # mixing: a part of the documents, at most the share of the tokens
    texts = {(r["doc_id"], r["text"]) for r in rows[3]}
    assert len(rows[4]) < len(rows[3]) and {(r["doc_id"], r["text"]) for r in rows[4]} <= texts
    total = sum(words(r["text"]) for r in rows[3])
    assert 0.7 * total < sum(words(r["text"]) for r in rows[4]) <= P.MIX_SHARE * total
    # packing: every document, every sequence within its length
    assert {r["doc_id"] for r in rows[5]} == {r["doc_id"] for r in rows[4]}
    used = {}
    for r in rows[5]:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 1024


def test_run_gives_the_last_stage(spark, tables):
    out = entry.queries()["pipeline"](spark, tables)
    assert {"doc_id", "piece", "ids", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert 4 <= len(P.STAGES) <= 5


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0
