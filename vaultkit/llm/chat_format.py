"""Chat formatting into budgeted windows (operator 10), DataFrame functions only.

Turns get token counts and prefix sums. A window takes the turns whose prefix starts inside one
stride of the sum, so windows are turn-aligned and found without a sequential pass; each is led by
the conversation's system turn and by the last turns before it, as far as ``HISTORY`` tokens reach.
Those repeats are written as seen turns and carry no loss; the loss covers the assistant texts of
the window's own turns, so every assistant text is a target exactly once.

Template: ``<|turn ROLE|>TEXT<|/turn|>``, and ``<|seen ROLE|>TEXT<|/turn|>`` for repeats. Inside roles
and texts a backslash is doubled, then each control string gets a backslash after its first
character; dropping every single escape backslash restores the text.

Defined cases: null text or role: empty; repeated turns are ordered by (turn, role, text), null turn
first; a null conv_id is one conversation; a turn longer than the stride is kept whole and its window
flagged; an empty table gives no rows; other columns are ignored. A conversation's digest needs its
text in one row, so the longest conversation must fit into one row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from vaultkit.llm.common import table

STRIDE = 256       # tokens of own turns per window, up to the last turn's length more
HISTORY = 128      # tokens of repeated history
BUDGET = 1024      # a longer window is flagged

# Control strings that must not be read out of a text.
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

END = "<|/turn|>"


def escape(c: Column) -> Column:
    c = F.regexp_replace(c, r"\\", r"\\\\")
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def n_tokens(c: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+"))


def windows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            stride: int = STRIDE, history: int = HISTORY, budget: int = BUDGET) -> DataFrame:
    """(conv_id, window, formatted, loss array<struct<start,length>>, n_own, n_tokens, over_budget)."""
    t = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = t.withColumn("n", n_tokens(F.col("text"))).withColumn("k", F.row_number().over(by))
    t = t.withColumn("end", F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn("w", F.floor((F.col("end") - F.col("n")) / F.lit(stride)))
    mark = F.concat(escape(F.col("role")), F.lit("|>"), escape(F.col("text")), F.lit(END))
    t = t.withColumn("body", mark).withColumn("skip", F.length(escape(F.col("role"))) + F.lit(len("<|turn ") + 2))
    t = t.withColumn("chars", F.length(escape(F.col("text")))).withColumn("size", F.length("body") + F.lit(len("<|turn ")))
    t = t.withColumn("upto", F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    turns_ = t.select("conv_id", "w", F.struct("k", "role", "n", "end", "body", "skip", "chars", "upto").alias("t"))
    own = turns_.groupBy("conv_id", "w").agg(F.array_sort(F.collect_list("t")).alias("own"))
    own = own.withColumn("from", F.element_at("own", 1)["k"]).withColumn("at", F.element_at("own", 1)["end"] - F.element_at("own", 1)["n"])
    # History: turns of the window before that start less than HISTORY tokens back; the system turn
    # leads every window after its own.
    whole = Window.partitionBy("conv_id").orderBy("w")
    own = own.withColumn("before", F.collect_list(F.col("own")).over(whole.rowsBetween(-1, -1)))
    first = F.first(F.element_at("own", 1)).over(whole)
    own = own.withColumn("lead", F.when((first["role"] == "system") & (F.col("from") > 1), F.array(first)).otherwise(F.array()))
    back = F.filter(F.flatten("before"), lambda x: (F.col("at") - x["end"] + x["n"] <= history)
                    & ~F.coalesce(F.get(F.col("lead.k"), F.lit(0)) == x["k"], F.lit(False)))
    own = own.withColumn("seen", F.concat("lead", back))
    head = F.array_join(F.transform("seen", lambda x: F.concat(F.lit("<|seen "), x["body"])), "")
    tail = F.array_join(F.transform("own", lambda x: F.concat(F.lit("<|turn "), x["body"])), "")
    own = own.withColumn("head", head).withColumn("formatted", F.concat("head", tail))
    # Own turns follow each other, so the conversation's prefix sum of marked lengths gives each one's offset.
    base = F.length("head") - F.element_at("own", 1)["upto"]
    mine = F.filter("own", lambda x: x["role"] == "assistant")
    loss = F.transform(F.array(base), lambda at: F.transform(mine, lambda x: F.struct(
        (at + x["upto"] + x["skip"]).cast("int").alias("start"), x["chars"].alias("length"))))
    own = own.withColumn("loss", F.element_at(loss, 1))
    total = F.aggregate(F.concat("seen", "own"), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return own.select("conv_id", F.col("w").alias("window"), "formatted", "loss", F.size("own").alias("n_own"),
                      total.alias("n_tokens"), (total > budget).alias("over_budget"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted windows alone."""
    marked = F.filter(F.split("formatted", re.escape(END)), lambda p: p.startswith("<|turn "))
    turns = F.transform(marked, lambda p: F.substring(p, F.lit(len("<|turn ") + 1), F.length(p)))
    line = F.transform(turns, lambda p: F.concat(unescape(F.substring_index(p, "|>", 1)), F.lit("\n"),
                                                 unescape(F.substring(p, F.instr(p, "|>") + 2, F.length(p))), F.lit("\n")))
    target = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    w = formatted.select("conv_id", F.struct("window", F.size(turns).alias("n"), F.array_join(line, "").alias("turns"),
                                             F.array_join(target, "").alias("loss"), F.length("formatted").alias("chars")).alias("w"))
    g = w.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    loss = F.array_join("w.loss", "")
    total = lambda f: F.aggregate(F.col(f"w.{f}"), F.lit(0).cast("long"), lambda a, x: a + x)
    return g.select("conv_id", total("n").alias("n_turns"), F.sha2(F.array_join("w.turns", "").cast("binary"), 256).alias("turns_sha256"),
                    F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                    total("chars").alias("formatted_chars"), F.size("w").cast("long").alias("n_windows"))


def op10_chat_format(spark, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return read_back(windows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)))


def _sql_escape(c: str) -> str:
    c = f"replace({c}, '\\', '\\\\')"
    for s in CONTROL:
        c = f"replace({c}, '{s}', '{s[0]}\\{s[1:]}')"
    return c


# The turn that leads a window counts once, also if it lies in the history.
ORACLE_SQL = rf"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM src),
p AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) AS e,
         length({_sql_escape('role')}) + length({_sql_escape('text')}) + {len('<|turn ') + 2 + len(END)} AS chars FROM t),
w AS (SELECT *, (e - n) // {STRIDE} AS w FROM p),
s AS (SELECT conv_id, w, min(k) AS k0, min(e - n) AS at, row_number() OVER (PARTITION BY conv_id ORDER BY w) AS nth FROM w GROUP BY conv_id, w),
h AS (
  SELECT s.conv_id, sum(x.chars) AS chars FROM s
  LEFT JOIN s AS b ON b.conv_id IS NOT DISTINCT FROM s.conv_id AND b.nth = s.nth - 1
  JOIN w AS x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.k < s.k0
   AND ((x.k = 1 AND x.role = 'system') OR (x.w = b.w AND s.at - x.e + x.n <= {HISTORY}))
  GROUP BY s.conv_id),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
         sum(chars) AS own, count(DISTINCT w) AS n_windows FROM w GROUP BY conv_id)
SELECT g.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
       (own + coalesce(h.chars, 0))::BIGINT AS formatted_chars, n_windows
FROM g LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM g.conv_id
"""
