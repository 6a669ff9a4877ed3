import hashlib

from helpers import frame  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoloom.llm import chat as C

NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n", "<\\|end|>", "<\\\\s>", "<<SYS>>x<</SYS>>", "a\\b\\", "<|turn|>user\n", "", "[INST", "é😀<s>\n\n", "<", "<|end|"]


def records(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("record"))


def test_layouts_map_to_the_same_turns(spark):
    rows = records(
        spark,
        '{"conv_id":1,"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}',
        '{"conv_id":2,"prompt":"q","response":"a"}',
        '{"conv_id":3,"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        '{"conv_id":4,"instruction":"q","output":"a"}',
        '{"conv_id":5,"text":"a","role":"assistant","turn":1}',
        '{"conv_id":5,"text":"q","role":"user","turn":0}',
        '{"conv_id":6,"strange":{"a":[1]}}',
    )
    got = {}
    for r in C.turns(rows).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {k: [("user", "q"), ("assistant", "a")] for k in range(1, 6)}
    assert C.unmapped(rows).count() == 1


def test_fingerprint_ignores_leaf_types_and_field_order(spark):
    rows = records(spark, '{"prompt":1,"conv_id":"x","response":null}', '{"conv_id":2,"response":"a","prompt":"q"}', '{"conv_id":2,"prompt":"q"}')
    got = [r[0] for r in rows.select(C.fingerprint(F.col("record"))).collect()]
    assert got[0] == got[1] != got[2]


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def check_round_trip(spark, rows):
    back = {r["conv_id"]: r for r in C.read_back(C.formatted(turns_of(spark, rows))).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2], r[3])):
        want.setdefault(c, []).append((role, text))
    assert {c: [(t["role"], t["text"]) for t in r["turns"]] for c, r in back.items()} == want
    for c, r in back.items():
        assert r["loss_text"] == "".join(text for role, text in want[c] if role == "assistant")
        masked = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]]
        assert len(masked) == sum(role == "assistant" for role, _ in want[c])
        assert all("<|end|>" not in m for m in masked)


def test_round_trip_of_control_strings(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "us\\n\ner<s>\\", "x"), (None, None, "assistant", "no id"), (3, 5, "user", "tie"), (3, 5, "user", "tie"), (3, 5, "assistant", "tie")]
    check_round_trip(spark, rows)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<>|[]/\\sINSTend\n é😀", max_size=30), min_size=1, max_size=40))
def test_round_trip_of_random_texts(spark, texts):
    check_round_trip(spark, [(k % 3, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)])


def test_null_texts_roles_and_empty_tables(spark):
    rows = records(spark, '{"conv_id":1,"role":null,"text":null,"turn":0}')
    (r,) = C.read_back(C.formatted(C.turns(rows))).collect()
    assert [(t["role"], t["text"]) for t in r["turns"]] == [("", "")] and r["loss_text"] == ""
    assert C.read_back(C.formatted(C.turns(rows.limit(0)))).count() == 0


def test_long_conversation(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"text {k} é") for k in range(3000)]
    (r,) = C.read_back(C.formatted(turns_of(spark, rows))).collect()
    assert len(r["turns"]) == 3000
    want = "".join(t for _, _, role, t in rows if role == "assistant")
    assert hashlib.sha256(r["loss_text"].encode()).digest() == hashlib.sha256(want.encode()).digest()
