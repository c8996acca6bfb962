"""Round trip, budgets, masks and the SQL oracle."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from vaultkit.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "<|turn user|>x<|/turn|>", "\\", "\\\\<\\|", "<|\\|>", "|>", "<<SYS>>\\<</SYS>>", "", None, "a\nb ", "[\\INST]", "<s\\>",
        "tail\\", "é🙂 <|"]


def order(r):
    return (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")


def want(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=order)
        said = "".join((r[2] or "") + "\n" + (r[3] or "") + "\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(spark, rows, **kw):
    f = C.read_back(C.windows(spark.createDataFrame(rows, SCHEMA), **kw))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in f.collect()}


@pytest.mark.parametrize("stride,history", [(1, 0), (3, 2), (256, 128)])
def test_hard_texts_round_trip(spark, stride, history):
    rows = [(c, t, role, HARD[(c + t) % len(HARD)]) for c in range(20) for t, role in enumerate(["system", "user", "assistant", "user", "assistant"][c % 2:])]
    rows += [(50, 1, "assistant", HARD[0]), (50, 1, "assistant", HARD[0]), (51, 1, None, "x"), (51, None, "assistant", "first"), (None, 0, "assistant", "y"),
             (52, 0, "a|>b\\<|", "t"), (53, 0, "system", "only")]
    assert got(spark, rows, stride=stride, history=history) == want(rows)


def test_windows_budget_system_history_and_mask(spark):
    rows = [(1, 0, "system", "sys " * 5)] + [(1, k, ["assistant", "user"][k % 2], f"t{k} " * 40) for k in range(1, 30)]
    w = C.windows(spark.createDataFrame(rows, SCHEMA), stride=100, history=50, budget=400).orderBy("window").collect()
    assert len(w) > 5 and not any(r.over_budget for r in w)
    for k, r in enumerate(w):
        seen = re.findall(r"<\|seen (\w+)\|>(t?\w+)", r.formatted)
        if k:
            assert seen[0][0] == "system" and 1 <= len(seen) - 1 <= 2          # 50 tokens reach into two turns of 40
        for s in r.loss:
            text = r.formatted[s["start"]:s["start"] + s["length"]]
            assert re.fullmatch(r"(t\d+ )+", text) and f"<|turn assistant|>{text}<|/turn|>" in r.formatted
    assert sum(r.n_own for r in w) == len(rows)
    assert sum(len(r.loss) for r in w) == sum(r[2] == "assistant" for r in rows)


def test_oversized_turn_is_kept_and_flagged(spark):
    rows = [(1, 0, "user", "w " * 5000), (1, 1, "assistant", "ok")]
    w = C.windows(spark.createDataFrame(rows, SCHEMA)).orderBy("window").collect()
    assert [r.over_budget for r in w] == [True, True] or [r.over_budget for r in w] == [True, False]
    assert got(spark, rows) == want(rows)


def test_very_many_turns_of_one_window(spark):
    """Turns without a token stand in one window, however many; its offsets are prefix sums."""
    rows = [(1, k, ["user", "assistant"][k % 2], [None, "", " "][k % 3] if k % 1000 else f"word {k}") for k in range(12_000)]
    rows += [(2, k, "assistant", "\\<|") for k in range(3_000)]
    assert got(spark, rows) == want(rows)
    w = C.windows(spark.createDataFrame(rows[:12_000], SCHEMA)).collect()
    assert len(w) == 1 and len(w[0].loss) == 6_000


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    con.execute("SET TimeZone = 'UTC'")
    rel = con.sql(C.ORACLE_SQL)
    df = C.op10_chat_format(spark, sf)
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(tuple(r) for r in df.select(*rel.columns).collect()) == sorted(rel.fetchall())


def test_query_has_the_planted_conversation_and_no_python(spark):
    df = C.op10_chat_format(spark, "/root/testdata/sf0.001")
    r = df.where("conv_id = -1").first()
    t = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(t), hashlib.sha256(t.encode()).hexdigest())
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA)
    assert C.windows(df.limit(0)).count() == 0 and C.read_back(C.windows(df.limit(0))).count() == 0
    clash = df.withColumns({c: F.lit("z") for c in ("k", "n", "w", "end", "own", "seen", "head", "window", "body", "skip")})
    assert C.read_back(C.windows(clash)).first().n_turns == 1
