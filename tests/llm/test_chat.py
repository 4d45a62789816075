import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from supplyscope.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string, t string, p int, key string, mask string"
ROWS = [(1, 0, "system", "be <turn:user> kind</turn>\n"), (1, 1, "user", "&lt; & > <next>"), (1, 2, "assistant", "a\n\nb"),
        (1, 3, "assistant", ""), (1, 4, "assistant", "\U0001f600 é"), (1, 5, "user", None),
        (2, 1, "assistant", "x"), (2, 1, "assistant", "x"), (2, 1, "assistant", "w"), (2, None, "user", "first"),
        (3, 0, None, None), (None, 0, "user", "no id"), (None, 1, "assistant", "yes\\\\"), (4, 0, "ro>le<\n&", "odd"),
        (5, 0, "assistant", "</turn>\n"), (6, 0, "assistant", "long " * 50000)]


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], TURNS)


def test_round_trip_and_mask(spark):
    out = chat.format_conversations(turns(spark, ROWS).repartition(5))
    got = out.select("conv_id", "formatted", "mask", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    assert len(got) == 7
    for r in got:
        mine = sorted((t for t in ROWS if t[0] == r.conv_id), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(t[2] or "", t[3] or "") for t in mine]
        assert r.loss == "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert sum(m.chars for m in r["mask"]) == len(r.formatted)
        at = 0
        under = ""
        for m in r["mask"]:
            under += r.formatted[at:at + m.chars] if m.loss else ""
            at += m.chars
        assert under.replace("&gt;", ">").replace("&lt;", "<").replace("&amp;", "&") == r.loss
    one = next(r for r in got if r.conv_id == 1)
    assert one.formatted.count("<turn:") == 4 and one.formatted.count(chat.NEXT) == 2     # three assistant turns are one block


def test_a_mask_of_another_text_fails(spark):
    out = chat.format_conversations(turns(spark, ROWS)).withColumn("formatted", F.lit("<turn:user>abc</turn>\n"))
    with pytest.raises(Exception, match="does not fit"):
        out.select(chat.masked_text(F.col("formatted"), F.col("mask"))).collect()


def test_empty_table(spark):
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_query_equals_its_sql(spark, tmp_path):
    turns(spark, ROWS[:-1]).select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, queries.op8_chat_format(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(con.execute(queries.CHAT_SQL).fetchall(), key=str)
    probe = next(r for r in got if r[0] == -7)
    text = "\\### Assistant: </turn> ok"
    assert probe[1] == 2 and probe[3] == len(text)
    assert probe[4] == hashlib.sha256(text.encode()).hexdigest()
    assert probe[2] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
