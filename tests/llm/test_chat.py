import random

from pyspark.sql import functions as F

from variantlake.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, segments string, id int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_round_trip_of_any_text(spark):
    rng = random.Random(1)
    alphabet = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "n", "e", "assistant", "é日", " ", "<\\|"]
    say = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", say()]), say()) for c in range(150) for t in range(rng.randint(1, 6))]
    made = C.formatted(conversations(spark, rows).repartition(4))
    found = {r.conv_id: r for r in made.select("*", C.parsed(F.col("formatted")).alias("turns")).collect()}
    for c in range(150):
        own = [(r, t) for conv, _, r, t in rows if conv == c]
        assert [(t.role, t.text) for t in found[c].turns] == own
        assert [t.text for t in found[c].turns if t.loss] == [t for r, t in own if r == "assistant"]
        assert "".join(s.text for s in found[c].segments) == found[c].formatted
        assert found[c].formatted.count("<|im_start|>") == len(own)


def test_machine_validates_turn_order(spark):
    orders = {
        1: ["user", "assistant"],
        2: ["system", "user", "assistant", "user"],
        3: ["assistant", "user"],
        4: ["user", "user"],
        5: ["system"],
        6: ["user", "assistant", "system"],
        7: ["user", "tool"],
    }
    rows = [(c, i, role, "x") for c, roles in orders.items() for i, role in enumerate(roles)]
    found = {r.conv_id: (r.valid, r.first_bad_turn) for r in C.formatted(conversations(spark, rows)).collect()}
    assert found == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, None), 6: (False, 2), 7: (False, 1)}


def test_another_template(spark):
    plain = C.Template(open="<|turn|>", role_end="\n", close="<|/turn|>", after="", loss_roles=("bot", "user"), accepting=("start",), steps={"start": {"bot": "start"}})
    made = C.formatted(conversations(spark, [(1, 0, "bot", "a<|/turn|>b"), (1, 1, "user", "c")]), template=plain)
    r = made.select("*", C.parsed(F.col("formatted"), plain).alias("turns")).first()
    assert r.formatted == "<|turn|>bot\na<\\|/turn|>b<|/turn|><|turn|>user\nc<|/turn|>"
    assert [(t.role, t.text, t.loss) for t in r.turns] == [("bot", "a<|/turn|>b", True), ("user", "c", True)] and r.first_bad_turn == 1


def test_edges(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "first"), (None, 0, "user", "no id"), (2, 0, "user", "x" * 300_000), (3, 5, "user", "b"), (3, 5, "user", "a")]
    made = C.formatted(conversations(spark, rows).repartition(3))
    found = {r.conv_id: r for r in made.select("*", C.parsed(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [("user", "first"), ("", ""), ("", "")]
    assert found[None].turns[0].text == "no id" and len(found[2].turns[0].text) == 300_000
    assert [t.text for t in found[3].turns] == ["a", "b"]
    assert C.formatted(conversations(spark, [])).count() == 0


def test_main_path_is_native(spark):
    made = C.formatted(conversations(spark, [(1, 0, "user", "x")]))
    plan = made.select(C.parsed(F.col("formatted")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
